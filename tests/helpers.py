import random


def tied_scores(n=200, seed=7):
    """(id, score, label): scores on a 0.05 grid, five percent nulls."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        score = None if draw.random() < 0.05 else round(draw.randrange(21) * 0.05, 2)
        chance = 0.3 if score is None else 0.2 + 0.6 * score
        rows.append((f"id-{i:03d}", score, int(draw.random() < chance)))
    return rows


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()

"""Data-quality expectations and the row-level customer contract."""

from functools import reduce

from pyspark.sql import functions as F

from stayline import schema as S

# Fixed values of the expectation suite.
ID_PATTERNS = [r"^[0-9A-Za-z\-]+$"]
TOTAL_CHARGES_MOSTLY = 0.995
MONTHLY_RANGE = (0, 200)
TENURE_RANGE = (0, 100)


def expectations(df):
    """One row per expectation: success, evaluated, unexpected, percentage, missing.

    All counters come from one pass that shuffles nothing but partial sums; only the
    ids are shuffled, to find repeated ones.
    """

    def total(condition):
        return F.sum(F.coalesce(condition, F.lit(False)).cast("bigint"))

    id_, churn = F.col(S.ID), F.col(S.TARGET)
    matches = reduce(lambda a, b: a | b, [id_.rlike(p) for p in ID_PATTERNS])
    counters = {
        "n": F.count(F.lit(1)),
        "id_null": total(id_.isNull()),
        "id_bad": total(~matches),
        "churn_null": total(churn.isNull()),
        "churn_bad": total(~churn.isin(S.YES_NO)),
        "total_null": total(F.col("TotalCharges").isNull()),
        "monthly_null": total(F.col("MonthlyCharges").isNull()),
        "monthly_bad": total(~F.col("MonthlyCharges").between(*MONTHLY_RANGE)),
        "tenure_null": total(F.col("tenure").isNull()),
        "tenure_bad": total(~F.col("tenure").between(*TENURE_RANGE)),
    }
    repeated = (
        df.where(id_.isNotNull())
        .groupBy(S.ID)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .agg(F.coalesce(F.sum("n"), F.lit(0)))
    )
    counts = df.agg(
        *[F.coalesce(c, F.lit(0)).alias(name) for name, c in counters.items()]
    ).withColumn("id_repeated", repeated.scalar())
    n, zero = F.col("n"), F.lit(0).cast("bigint")

    def row(name, unexpected, missing, mostly=1.0, whole=False):
        base = n if whole else n - missing
        share = F.coalesce(F.try_divide(unexpected, base), F.lit(0.0))
        return F.struct(
            F.lit(name).alias("expectation"),
            (1 - share >= mostly).alias("success"),
            n.alias("element_count"),
            unexpected.alias("unexpected_count"),
            (share * 100).alias("unexpected_percent"),
            missing.alias("missing_count"),
        )

    width = len(df.columns)
    rows = [
        row("not_null:customerID", F.col("id_null"), zero, whole=True),
        row("unique:customerID", F.col("id_repeated"), F.col("id_null")),
        F.struct(
            F.lit("column_count").alias("expectation"),
            F.lit(width == len(S.CUSTOMER_COLUMNS)).alias("success"),
            F.lit(width).cast("bigint").alias("element_count"),
            zero.alias("unexpected_count"),
            F.lit(0.0).alias("unexpected_percent"),
            zero.alias("missing_count"),
        ),
        row("in_set:Churn", F.col("churn_bad"), F.col("churn_null")),
        row("regex:customerID", F.col("id_bad"), F.col("id_null")),
        row("not_null:TotalCharges", F.col("total_null"), zero, TOTAL_CHARGES_MOSTLY, whole=True),
        row("between:MonthlyCharges", F.col("monthly_bad"), F.col("monthly_null")),
        row("between:tenure", F.col("tenure_bad"), F.col("tenure_null")),
    ]
    return counts.select(F.inline(F.array(*rows)))


def suite_summary(results):
    passed = F.sum(F.col("success").cast("bigint"))
    total = F.count(F.lit(1))
    return results.agg(
        F.min("success").alias("success"),
        total.alias("evaluated"),
        passed.alias("successful"),
        (total - passed).alias("unsuccessful"),
        (passed / total * 100).alias("success_percent"),
    )


def quality_gate(results):
    """Whether what follows may run, and the expectations that forbid it, in one row."""
    failed = F.array_sort(F.collect_list(F.when(~F.col("success"), F.col("expectation"))))
    return results.agg(
        (F.size(failed) == 0).alias("open"), F.concat_ws(", ", failed).alias("failed"))


def require_quality(results):
    """Stop what follows if an expectation failed."""
    gate = quality_gate(results).first()
    if not gate.open:
        raise ValueError(f"data quality checks failed: {gate.failed}")


def without_nulls(*columns):
    """Array of the non-null values, each once. `array_compact` would leave generated code."""
    return F.array_except(F.array(*columns), F.array(F.lit(None).cast("string")))


def contract_rules():
    """One column per rule, in column order: its message if a row breaks it, else null."""

    def check(name, broken, message):
        return F.when(F.coalesce(broken, F.lit(True)), F.lit(f"{name}: {message}"))

    rules = [check(S.ID, F.col(S.ID).isNull(), "missing")]
    for name in S.CUSTOMER_COLUMNS:
        col = F.col(name)
        if name in S.DOMAINS:
            rules.append(check(name, ~col.isin(S.DOMAINS[name]), "not an allowed value"))
        elif name == "SeniorCitizen":
            rules.append(check(name, ~col.between(0, 1), "outside 0..1"))
        elif name in ("tenure", "MonthlyCharges"):
            rules.append(check(name, col < 0, "missing or negative"))
        elif name == "TotalCharges":
            rules.append(check(name, F.coalesce(col < 0, F.lit(False)), "negative"))
    return rules


def contract_errors():
    """Array of messages for the rules a row breaks, in column order; empty for a valid row."""
    return without_nulls(*contract_rules())


def settled(df, name, column):
    """Add a column behind a generator.

    A filter on it then stays where it is. Pushed into the inputs, a rule over some twenty
    computed columns makes the optimizer infer a constraint for every combination of them.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))


def with_errors(df):
    return settled(df, "errors", contract_errors())


def split_valid(df):
    """(valid, rejected): valid rows unchanged, rejected rows with their errors."""
    checked = with_errors(df)
    is_valid = F.size("errors") == 0
    return checked.where(is_valid).drop("errors"), checked.where(~is_valid)

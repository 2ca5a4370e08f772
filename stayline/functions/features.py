"""Derived customer features as column expressions."""

from functools import reduce

from pyspark.sql import functions as F

from stayline import schema as S

# Right-closed bucket edges and their labels.
TENURE_EDGES = [0, 12, 24, 36, 48, 60, 72, 100]
TENURE_LABELS = ["0-12", "13-24", "25-36", "37-48", "49-60", "61-72", "73+"]
MONTHLY_EDGES = [0, 35, 50, 65, 80, 100, 120]
MONTHLY_LABELS = ["0-35", "36-50", "51-65", "66-80", "81-100", "101-120"]
TOTAL_EDGES = [0, 500, 1000, 2000, 3000, 5000, 10000]
TOTAL_LABELS = ["0-500", "501-1000", "1001-2000", "2001-3000", "3001-5000", "5001+"]


def bucket(value, edges, labels, include_lowest=False):
    """Label of the right-closed interval around `value`; null outside all of them."""
    first = value >= edges[0] if include_lowest else value > edges[0]
    chain = F.when(first & (value <= edges[1]), labels[0])
    for low, high, label in zip(edges[1:], edges[2:], labels[1:]):
        chain = chain.when((value > low) & (value <= high), label)
    return chain


def tenure_bucket(tenure, edges=TENURE_EDGES, labels=TENURE_LABELS):
    return bucket(tenure, edges, labels, include_lowest=True)


def service_count(columns=S.SERVICES):
    return reduce(
        lambda total, c: total + F.when(F.col(c) == "Yes", 1).otherwise(0), columns, F.lit(0)
    )


def charges_ratio(monthly, total):
    return F.when(total > 0, monthly / total)


def avg_monthly_charge(total, tenure):
    return F.when(tenure > 0, total / tenure)


def charge_increase_flag(monthly, average):
    return F.coalesce(monthly > average, F.lit(False)).cast("int")


def clv_proxy(total, monthly, contract, default_months=12):
    months = (
        F.when(contract == "One year", 12).when(contract == "Two year", 24).otherwise(default_months)
    )
    return F.coalesce(total, F.lit(0.0)) + monthly * months


def predicted_clv(
    revenue, tenure, p, lifetime_months=24, discount_rate=0.10, monthly_growth=0.0
):
    """Discounted revenue of the expected remaining months, as a geometric sum."""
    months = F.greatest(F.lit(0.0), (1 - p) * (lifetime_months - tenure)).cast("bigint")
    step = (1 + monthly_growth) / (1 + discount_rate) ** (1 / 12)
    if step == 1.0:
        return revenue * months
    return revenue * (1 - F.pow(F.lit(step), months)) / (1 - step)

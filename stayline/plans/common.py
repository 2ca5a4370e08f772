"""What the registered queries share: rounding, inputs, and the SQL of the same inputs."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline import schema as S
from stayline.operators import cohorts
from stayline.sources import derived

DIGITS = 6


def tidy(df, digits=DIGITS, **special):
    """Round every double, so that sums in another order compare equal.

    `special` sets the digits of single columns: fewer where exact values could end
    in a 5 right behind the last kept digit.
    """
    fixes = {
        f.name: F.round(F.col(f"`{f.name}`"), special.get(f.name, digits)) + F.lit(0.0)
        for f in df.schema.fields
        if isinstance(f.dataType, T.DoubleType)
    }
    return df.select(
        *[fixes.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns]
    )


def scored(spark, folder):
    return cohorts.scored_customers(
        derived.customers(spark, folder), derived.predictions(spark, folder)
    )


BASE = """
o AS (SELECT o_custkey, min(o_orderdate) AS f FROM orders GROUP BY 1),
c0 AS (SELECT c_custkey AS k, (c_custkey * 7919) % 10007 AS h,
    CAST(round((c_acctbal + 1000) * 100) AS BIGINT) % 10000 + 2000 AS mc, f
  FROM customer LEFT JOIN o ON o_custkey = c_custkey),
c1 AS (SELECT k, h, mc,
    coalesce(least(72, greatest(0,
      (date_diff('day', f, TIMESTAMP '2001-08-01') // 30) - (h % 60))), 0) AS tenure,
    CASE WHEN h % 20 < 11 THEN 'Month-to-month' WHEN h % 20 < 15 THEN 'One year'
         ELSE 'Two year' END AS ct,
    (h // 3) % 2 AS s1, (h // 5) % 2 AS s2, (h // 7) % 2 AS s3,
    (h // 11) % 2 AS s4, (h // 13) % 2 AS s5, (h // 17) % 2 AS s6 FROM c0),
c2 AS (SELECT *, s1 + s2 + s3 + s4 + s5 + s6 AS sc FROM c1),
c3 AS (SELECT *, greatest(200, least(9800,
    (CASE ct WHEN 'Month-to-month' THEN 5500 WHEN 'One year' THEN 2500 ELSE 1000 END)
    + 2988 - tenure * 83 + ((mc * 2) // 5) - 2800 - (sc - 3) * 200)) AS bp FROM c2),
base AS (SELECT concat('C-', CAST(k AS VARCHAR)) AS "customerID", k, bp, mc,
    CASE WHEN h % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    CAST(CASE WHEN h % 6 = 0 THEN 1 ELSE 0 END AS INT) AS "SeniorCitizen",
    CASE WHEN (h // 2) % 2 = 0 THEN 'Yes' ELSE 'No' END AS "Partner",
    CASE WHEN h % 3 = 0 THEN 'Yes' ELSE 'No' END AS "Dependents",
    CAST(tenure AS INT) AS tenure,
    CASE WHEN h % 10 < 9 THEN 'Yes' ELSE 'No' END AS "PhoneService",
    CASE WHEN h % 10 = 9 THEN 'No phone service'
         WHEN (h // 4) % 2 = 0 THEN 'Yes' ELSE 'No' END AS "MultipleLines",
    CASE WHEN sc = 0 THEN 'No' WHEN h % 5 < 2 THEN 'DSL'
         ELSE 'Fiber optic' END AS "InternetService",
    {services},
    ct AS "Contract",
    CASE WHEN (h // 8) % 2 = 0 THEN 'Yes' ELSE 'No' END AS "PaperlessBilling",
    CASE h % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
         WHEN 2 THEN 'Bank transfer (automatic)'
         ELSE 'Credit card (automatic)' END AS "PaymentMethod",
    CAST(mc AS DOUBLE) / 100 AS "MonthlyCharges",
    CASE WHEN tenure = 0 THEN NULL ELSE CAST(mc * tenure AS DOUBLE) / 100 END AS "TotalCharges",
    CASE WHEN (h * 31) % 10000 < bp THEN 'Yes' ELSE 'No' END AS "Churn",
    CAST(bp AS DOUBLE) / 10000 AS churn_probability
  FROM c3)
""".format(
    services=", ".join(
        f"CASE WHEN sc = 0 THEN 'No internet service' WHEN s{i} = 1 THEN 'Yes' ELSE 'No' END"
        f' AS "{name}"'
        for i, name in enumerate(S.SERVICES, 1)
    )
)

COLUMNS = ", ".join(f'"{c}"' for c in S.CUSTOMER_COLUMNS)

#: Place of a customer in the seeded split, from 0 to 9999.
SLOT = "CAST('0x' || substr(md5(concat(\"customerID\", '|42')), 1, 8) AS BIGINT) % 10000"

SERVICE_COUNT = "(" + " + ".join(f"(\"{c}\" = 'Yes')::INT" for c in S.SERVICES) + ")"

SCORED = f"""
{BASE},
customers AS (SELECT {COLUMNS} FROM base),
counted AS (SELECT {COLUMNS}, churn_probability, churn_probability AS p, k, bp, mc,
    "MonthlyCharges" AS rev, {SERVICE_COUNT} AS service_count FROM base),
scored AS (SELECT *,
    CASE WHEN bp >= 7500 THEN 'critical' WHEN bp >= 5000 THEN 'high'
         WHEN bp >= 3000 THEN 'medium' ELSE 'low' END AS risk_level,
    CASE WHEN mc >= 10000 AND tenure >= 36 THEN 'vip'
         WHEN tenure >= 24 AND mc >= 5000 THEN 'loyal'
         WHEN tenure < 12 AND mc >= 8000 THEN 'growing'
         WHEN bp >= 5000 AND mc >= 5000 THEN 'at_risk'
         WHEN tenure < 6 THEN 'new'
         WHEN service_count <= 2 AND mc < 5000 THEN 'disengaged'
         WHEN bp >= 5000 THEN 'at_risk' ELSE 'loyal' END AS segment,
    CASE WHEN bp >= 7500 THEN 'at_risk' WHEN tenure < 3 THEN 'acquisition'
         WHEN tenure < 6 THEN 'onboarding' WHEN tenure < 12 THEN 'growth'
         WHEN tenure < 24 THEN 'maturity' ELSE 'retention' END AS journey_stage
  FROM counted)
"""


def sql(select, floats=(), ctes="", digits=DIGITS, **special):
    """Full statement over the derived tables, with the named doubles rounded."""
    more = f", {ctes}" if ctes else ""
    body = select
    if floats:
        fixed = ", ".join(
            f'round("{c}", {special.get(c, digits)}) + 0e0 AS "{c}"' for c in floats
        )
        body = f"SELECT * REPLACE ({fixed}) FROM ({select})"
    return f"WITH {SCORED}{more} {body}"


def unpivot_sql(columns, source="customers", keep=(), kind="DOUBLE"):
    """Union of (keep, feature, value) rows."""
    kept = "".join(f'"{c}", ' for c in keep)
    return " UNION ALL ".join(
        f"SELECT {kept}'{c}' AS feature, CAST(\"{c}\" AS {kind}) AS value FROM {source}"
        for c in columns
    )

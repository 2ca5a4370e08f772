"""Queries of intake: files, snapshots, data quality, profiling."""

from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions import features as X
from stayline.operators import features, profile, quality, splits
from stayline.plans.common import COLUMNS, SERVICE_COUNT, sql, tidy, unpivot_sql
from stayline.session import scratch_path
from stayline.sources import customers as files
from stayline.sources import derived, snapshots

QUERIES, ORACLE = {}, {}
KEEP_SPACES = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def query(name, oracle=None):
    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLE[name] = oracle
        return function

    return add


def _csv(df, name):
    path = scratch_path(df.sparkSession, name)
    df.write.options(header=True, **KEEP_SPACES).csv(path)
    return path


_RAW = ", ".join(
    {
        S.ID: "CASE WHEN k % 97 <> 0 THEN concat(' ', \"customerID\", ' ') END AS \"customerID\"",
        "TotalCharges": "coalesce(printf('%.2f', \"TotalCharges\"), ' ') AS \"TotalCharges\"",
    }.get(c, f'"{c}"')
    for c in S.CUSTOMER_COLUMNS
)


@query("scan_customers", sql(f"SELECT {_RAW} FROM base"))
def scan_customers(spark, folder):
    return files.read_customers(spark, _csv(derived.raw_customers(spark, folder), "customers"))


@query("clean_customers", sql(f"SELECT {COLUMNS} FROM base WHERE k % 97 <> 0"))
def clean_customers(spark, folder):
    raw = derived.raw_customers(spark, folder)
    return files.clean_customers(raw.toDF(*[f" {c} " for c in raw.columns]))


@query("scan_scores", sql('SELECT "customerID", churn_probability FROM base'))
def scan_scores(spark, folder):
    return files.read_scores(spark, _csv(derived.predictions(spark, folder), "scores"))


@query("scan_labels", sql(
    "SELECT \"customerID\", CAST(\"Churn\" = 'Yes' AS INT) AS label FROM base"))
def scan_labels(spark, folder):
    labels = derived.customers(spark, folder).select(
        S.ID, (F.col(S.TARGET) == "Yes").cast("int").alias("label")
    )
    return files.read_labels(spark, _csv(labels, "labels"))


def _snapshots(spark, folder):
    path = scratch_path(spark, "snapshots")
    return snapshots.write_snapshot(derived.snapshots(spark, folder), path)


@query("latest_snapshot", sql(
    f"SELECT {COLUMNS}, '20240103T000000Z' AS snapshot_ts FROM base"))
def latest_snapshot(spark, folder):
    return snapshots.read_snapshot(spark, _snapshots(spark, folder))


@query("snapshot_pair", sql("""
    SELECT 'reference' AS side, '20240102T000000Z' AS snapshot_ts, count(*) AS n,
           count(*) FILTER ("Churn" = 'Yes') AS churners FROM base WHERE k % 3 <= 1
    UNION ALL
    SELECT 'current', '20240103T000000Z', count(*), count(*) FILTER ("Churn" = 'Yes') FROM base"""))
def snapshot_pair(spark, folder):
    reference, current = snapshots.snapshot_pair(spark, _snapshots(spark, folder))

    def counted(df, side):
        return df.groupBy(F.lit(side).alias("side"), "snapshot_ts").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("Churn") == "Yes").alias("churners")
        )

    return counted(reference, "reference").unionByName(counted(current, "current"))


@query("sample_n", sql(f"""
    SELECT {COLUMNS} FROM base
    ORDER BY md5(concat("customerID", '|42')), "customerID" LIMIT 100"""))
def sample_n(spark, folder):
    return splits.sample_customers(derived.customers(spark, folder), 100)


_DIRTY = f"""
dirty0 AS (SELECT * REPLACE (
    CASE WHEN k % 101 = 0 THEN NULL WHEN k % 103 = 0 THEN 'bad id!' ELSE "customerID" END AS "customerID",
    CASE WHEN k % 109 = 0 THEN 'Maybe' ELSE "Churn" END AS "Churn",
    CASE WHEN k % 113 = 0 THEN 250e0 ELSE "MonthlyCharges" END AS "MonthlyCharges",
    CASE WHEN k % 127 = 0 THEN 101 WHEN k % 137 = 0 THEN -1 ELSE tenure END AS tenure,
    CASE WHEN k % 131 = 0 THEN 'X' ELSE gender END AS gender,
    CASE WHEN k % 139 = 0 THEN 2 ELSE "SeniorCitizen" END AS "SeniorCitizen",
    CASE WHEN k % 149 <> 0 THEN "Contract" END AS "Contract") FROM base),
dirty AS (SELECT {COLUMNS} FROM dirty0 UNION ALL SELECT {COLUMNS} FROM dirty0 WHERE k % 107 = 0)
"""

_EXPECTED = f"""{_DIRTY},
repeated AS (SELECT coalesce(sum(n), 0) AS n FROM
    (SELECT count(*) AS n FROM dirty WHERE "customerID" IS NOT NULL GROUP BY "customerID") WHERE n > 1),
found(expectation, mostly, bad, missing, whole) AS (
    SELECT 'not_null:customerID', 1e0, count(*) FILTER ("customerID" IS NULL), 0, true FROM dirty
    UNION ALL SELECT 'unique:customerID', 1e0, (SELECT n FROM repeated),
        count(*) FILTER ("customerID" IS NULL), false FROM dirty
    UNION ALL SELECT 'in_set:Churn', 1e0, count(*) FILTER ("Churn" NOT IN ('Yes', 'No')),
        count(*) FILTER ("Churn" IS NULL), false FROM dirty
    UNION ALL SELECT 'regex:customerID', 1e0,
        count(*) FILTER (NOT regexp_matches("customerID", '^[0-9A-Za-z\\-]+$')),
        count(*) FILTER ("customerID" IS NULL), false FROM dirty
    UNION ALL SELECT 'not_null:TotalCharges', 0.995e0,
        count(*) FILTER ("TotalCharges" IS NULL), 0, true FROM dirty
    UNION ALL SELECT 'between:MonthlyCharges', 1e0,
        count(*) FILTER ("MonthlyCharges" NOT BETWEEN 0 AND 200),
        count(*) FILTER ("MonthlyCharges" IS NULL), false FROM dirty
    UNION ALL SELECT 'between:tenure', 1e0, count(*) FILTER (tenure NOT BETWEEN 0 AND 100),
        count(*) FILTER (tenure IS NULL), false FROM dirty),
results AS (
    SELECT expectation,
        1 - coalesce(bad / nullif(n - CASE WHEN whole THEN 0 ELSE missing END, 0), 0) >= mostly AS success,
        n AS element_count, CAST(bad AS BIGINT) AS unexpected_count,
        coalesce(bad / nullif(n - CASE WHEN whole THEN 0 ELSE missing END, 0), 0) * 100 AS unexpected_percent,
        CAST(missing AS BIGINT) AS missing_count
    FROM found, (SELECT count(*) AS n FROM dirty)
    UNION ALL SELECT 'column_count', true, 21, 0, 0, 0)"""


@query("dq_expectations", sql("SELECT * FROM results", ["unexpected_percent"], _EXPECTED))
def dq_expectations(spark, folder):
    return tidy(quality.expectations(derived.dirty_customers(spark, folder)))


@query("dq_summary", sql("""
    SELECT bool_and(success) AS success, count(*) AS evaluated,
        count(*) FILTER (success) AS successful, count(*) FILTER (NOT success) AS unsuccessful,
        count(*) FILTER (success) / count(*) * 100 AS success_percent FROM results""",
    ["success_percent"], _EXPECTED))
def dq_summary(spark, folder):
    return tidy(
        quality.suite_summary(quality.expectations(derived.dirty_customers(spark, folder)))
    )


@query("quality_gate", sql("""
    SELECT count(*) FILTER (NOT success) = 0 AS open,
        coalesce(string_agg(expectation, ', ' ORDER BY expectation) FILTER (NOT success), '') AS failed
    FROM results""", ctes=_EXPECTED))
def quality_gate(spark, folder):
    return quality.quality_gate(quality.expectations(derived.dirty_customers(spark, folder)))


def errors_sql():
    """SQL list of the contract errors of a row, in column order."""
    rules = ["CASE WHEN \"customerID\" IS NULL THEN 'customerID: missing' END"]
    for c in S.CUSTOMER_COLUMNS:
        if c in S.DOMAINS:
            values = ", ".join(f"'{v}'" for v in S.DOMAINS[c])
            broken, text = f'coalesce("{c}" NOT IN ({values}), true)', "not an allowed value"
        elif c == "SeniorCitizen":
            broken, text = f'coalesce("{c}" NOT BETWEEN 0 AND 1, true)', "outside 0..1"
        elif c in ("tenure", "MonthlyCharges"):
            broken, text = f'coalesce("{c}" < 0, true)', "missing or negative"
        elif c == "TotalCharges":
            broken, text = f'"{c}" < 0', "negative"
        else:
            continue
        rules.append(f"CASE WHEN {broken} THEN '{c}: {text}' END")
    return f"list_filter([{', '.join(rules)}], lambda e: e IS NOT NULL)"


@query("dq_row_errors", sql(
    f'SELECT "customerID", unnest({errors_sql()}) AS error FROM dirty', ctes=_DIRTY))
def dq_row_errors(spark, folder):
    checked = quality.with_errors(derived.dirty_customers(spark, folder))
    return checked.select(S.ID, F.explode("errors").alias("error"))


# --- profiling ---------------------------------------------------------------------------

@query("label_distribution", sql("""
    SELECT "Churn" AS label, count(*) AS n,
        round_even(count(*) / (SELECT count(*) FROM customers), 3) AS share
    FROM customers GROUP BY 1""", ["share"]))
def label_distribution(spark, folder):
    return tidy(profile.label_distribution(derived.customers(spark, folder)))


@query("missingness", sql(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, avg((\"{c}\" IS NULL)::INT) AS share FROM customers"
        for c in S.CUSTOMER_COLUMNS
    ) + ") WHERE share > 0", ["share"]))
def missingness(spark, folder):
    return tidy(profile.missingness(derived.customers(spark, folder)))


_LONG = f"long AS ({unpivot_sql(S.NUMERIC)})"


@query("numeric_summary", sql("""
    SELECT feature, round_even(avg(value), 3) AS mean, round_even(stddev_samp(value), 3) AS std,
        round_even(min(value), 3) AS min, round_even(quantile_cont(value, 0.5), 3) AS median,
        round_even(max(value), 3) AS max FROM long GROUP BY 1""",
    ["mean", "std", "min", "median", "max"], _LONG))
def numeric_summary(spark, folder):
    return tidy(profile.numeric_summary(derived.customers(spark, folder)))


_TEXT = [c for c in S.CUSTOMER_COLUMNS if c not in S.NUMERIC]


@query("cardinality", sql(
    "SELECT feature, count(DISTINCT value) AS n_unique FROM long GROUP BY 1 HAVING count(DISTINCT value) <= 50",
    ctes=f"long AS ({unpivot_sql(_TEXT, kind='VARCHAR')})"))
def cardinality(spark, folder):
    return profile.cardinality(derived.customers(spark, folder))


@query("duplicates", sql("""
    SELECT CAST((SELECT count(*) FROM dirty) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty))
             AS BIGINT) AS duplicate_rows,
        CAST((SELECT count(*) FROM dirty) - (SELECT count(*) FROM (SELECT DISTINCT "customerID" FROM dirty))
             AS BIGINT) AS duplicate_keys""", ctes=_DIRTY))
def duplicates(spark, folder):
    return profile.duplicates(derived.dirty_customers(spark, folder))


RATE_COLUMNS = [
    "gender", "SeniorCitizen", "Partner", "Dependents", "PhoneService", "InternetService",
    "Contract", "PaperlessBilling", "PaymentMethod", *S.SERVICES,
]


def _rate_ctes(columns, source="customers"):
    parts = [
        f"SELECT '{c}' AS feature, "
        + (f"CASE WHEN \"{c}\" = 1 THEN 'Yes' ELSE 'No' END" if c == "SeniorCitizen"
           else f'CAST("{c}" AS VARCHAR)')
        + f" AS value, \"Churn\" FROM {source}"
        for c in columns
    ]
    return f"""long AS ({" UNION ALL ".join(parts)}),
    rates AS (SELECT feature, value, count(*) AS n, count(*) FILTER ("Churn" = 'Yes') AS positives,
        count(*) FILTER ("Churn" = 'Yes') / count(*) * 100 AS rate_pct
        FROM long WHERE value IS NOT NULL GROUP BY 1, 2)"""


@query("churn_by_category", sql("SELECT * FROM rates", ["rate_pct"], _rate_ctes(RATE_COLUMNS)))
def churn_by_category(spark, folder):
    return tidy(profile.rate_by_category(derived.customers(spark, folder), RATE_COLUMNS))


@query("churn_rate_mean", sql(
    "SELECT feature, avg(rate_pct) AS mean_rate_pct FROM rates GROUP BY 1",
    ["mean_rate_pct"], _rate_ctes(RATE_COLUMNS)))
def churn_rate_mean(spark, folder):
    return tidy(profile.mean_rate(
        profile.rate_by_category(derived.customers(spark, folder), RATE_COLUMNS)
    ))


def bucket_sql(column, edges, labels, include_lowest=False):
    low = ">=" if include_lowest else ">"
    cases = [f"WHEN {column} {low} {edges[0]} AND {column} <= {edges[1]} THEN '{labels[0]}'"] + [
        f"WHEN {column} > {a} AND {column} <= {b} THEN '{t}'"
        for a, b, t in zip(edges[1:], edges[2:], labels[1:])
    ]
    return f"CASE {' '.join(cases)} END"


CUTS = ["tenure_cut", "monthly_cut", "total_cut"]
_CUT = f"""cut AS (SELECT "Churn",
    {bucket_sql('tenure', X.TENURE_EDGES, X.TENURE_LABELS)} AS tenure_cut,
    {bucket_sql('"MonthlyCharges"', X.MONTHLY_EDGES, X.MONTHLY_LABELS)} AS monthly_cut,
    {bucket_sql('"TotalCharges"', X.TOTAL_EDGES, X.TOTAL_LABELS)} AS total_cut FROM customers)"""


@query("churn_by_bucket", sql(
    "SELECT * FROM rates", ["rate_pct"], f"{_CUT}, {_rate_ctes(CUTS, 'cut')}"))
def churn_by_bucket(spark, folder):
    return tidy(profile.rate_by_category(
        profile.with_eda_buckets(derived.customers(spark, folder)), CUTS
    ))


DESCRIBED = ["tenure", "MonthlyCharges", "TotalCharges"]


@query("describe_by_label", sql("""
    SELECT "Churn", feature, count(value) AS rows, avg(value) AS mean, min(value) AS min,
        max(value) AS max, stddev_samp(value) AS std, quantile_cont(value, 0.25) AS p25,
        quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS p75
    FROM long GROUP BY 1, 2""", ["mean", "min", "max", "std", "p25", "median", "p75"],
    f"long AS ({unpivot_sql(DESCRIBED, keep=['Churn'])})"))
def describe_by_label(spark, folder):
    return tidy(profile.describe(derived.customers(spark, folder), DESCRIBED, ["Churn"]))


@query("iqr_outliers", sql("""
    SELECT f.feature, lower_bound, upper_bound,
        count(*) FILTER (value < lower_bound OR value > upper_bound) AS outliers,
        count(*) FILTER (value < lower_bound OR value > upper_bound) / count(*) * 100 AS outlier_pct
    FROM long JOIN (SELECT feature, q1 - 1.5 * (q3 - q1) AS lower_bound,
            q3 + 1.5 * (q3 - q1) AS upper_bound
        FROM (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
              FROM long GROUP BY 1)) f ON f.feature = long.feature
    GROUP BY ALL""", ["lower_bound", "upper_bound", "outlier_pct"],
    f"long AS ({unpivot_sql(DESCRIBED)})"))
def iqr_outliers(spark, folder):
    return tidy(profile.iqr_outliers(derived.customers(spark, folder), DESCRIBED))


CORRELATED = [*S.NUMERIC, "churn_flag"]
_FLAGGED = "flagged AS (SELECT *, (\"Churn\" = 'Yes')::INT AS churn_flag FROM customers)"


@query("correlations", sql(
    " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr(\"{a}\"::DOUBLE, \"{b}\"::DOUBLE) AS r FROM flagged"
        for a in CORRELATED for b in CORRELATED
    ), ["r"], _FLAGGED))
def correlations(spark, folder):
    flagged = derived.customers(spark, folder).withColumn(
        "churn_flag", (F.col("Churn") == "Yes").cast("int")
    )
    return tidy(profile.correlations(flagged, CORRELATED))


ENGINEERED = ["tenure_bucket", "service_count", "charge_increase_flag"]
_ENGINEERED = f"""engineered AS (SELECT *,
    {bucket_sql('tenure', X.TENURE_EDGES, X.TENURE_LABELS, True)} AS tenure_bucket,
    {SERVICE_COUNT} AS service_count,
    CASE WHEN "TotalCharges" > 0 THEN "MonthlyCharges" / "TotalCharges" END AS charges_ratio,
    CASE WHEN tenure > 0 THEN "TotalCharges" / tenure END AS avg_monthly_charge,
    coalesce("MonthlyCharges" > CASE WHEN tenure > 0 THEN "TotalCharges" / tenure END, false)::INT
        AS charge_increase_flag,
    coalesce("TotalCharges", 0) + "MonthlyCharges" *
        CASE "Contract" WHEN 'Two year' THEN 24 ELSE 12 END AS clv_approximation
    FROM customers)"""


@query("churn_by_feature", sql(
    "SELECT * FROM rates", ["rate_pct"], f"{_ENGINEERED}, {_rate_ctes(ENGINEERED, 'engineered')}"))
def churn_by_feature(spark, folder):
    return tidy(profile.rate_by_category(
        features.engineer(derived.customers(spark, folder)), ENGINEERED
    ))


def histogram_sql(bins, by="", density=False):
    extra = (
        ", n / (sum(n) OVER (PARTITION BY " + by + "feature) * nullif(width, 0)) AS density"
        if density else ""
    )
    return f"""
    SELECT {by}feature, bin, low + bin * width AS bin_start, n{extra} FROM (
      SELECT {by}s.feature, low, width, CAST(CASE WHEN width = 0 THEN 0
          ELSE least({bins - 1}, floor((value - low) / width)) END AS INT) AS bin, count(*) AS n
      FROM long JOIN (SELECT feature, min(value) AS low, (max(value) - min(value)) / {bins} AS width
                      FROM long GROUP BY 1) s ON s.feature = long.feature
      WHERE value IS NOT NULL GROUP BY ALL)"""


@query("histogram", sql(histogram_sql(50, '"Churn", '), ["bin_start"],
                        f"long AS ({unpivot_sql(DESCRIBED, keep=['Churn'])})"))
def histogram(spark, folder):
    return tidy(profile.histogram(derived.customers(spark, folder), DESCRIBED, 50, ["Churn"]))


_PROFILE = f"""{_LONG}, texts AS ({unpivot_sql(_TEXT, kind='VARCHAR')}),
  stats AS (SELECT feature, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
      quantile_cont(value, 0.5) AS median, max(value) AS max FROM long GROUP BY 1),
  profiled(section, item, measure, value) AS (
    SELECT 'overview', 'table', 'rows', count(*)::DOUBLE FROM customers
    UNION ALL SELECT 'overview', 'table', 'columns', 21
    UNION ALL SELECT 'label', "Churn", 'n', count(*) FROM customers GROUP BY 2
    UNION ALL SELECT 'label', "Churn", 'share',
        round_even(count(*) / (SELECT count(*) FROM customers), 3) FROM customers GROUP BY 2
    UNION ALL SELECT 'missing', column_name, 'share', share FROM (
        {" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, avg((\"{c}\" IS NULL)::INT) AS share FROM customers"
            for c in S.CUSTOMER_COLUMNS)}) WHERE share > 0
    {"".join(f"UNION ALL SELECT 'numeric', feature, '{m}', round_even({m}, 3) FROM stats "
             for m in ["mean", "std", "min", "median", "max"])}
    UNION ALL SELECT 'cardinality', feature, 'n_unique', count(DISTINCT value) FROM texts
        GROUP BY 2 HAVING count(DISTINCT value) <= 50)"""


@query("profile", sql("SELECT * FROM profiled", ["value"], _PROFILE))
def profile_overview(spark, folder):
    return tidy(profile.profile(derived.customers(spark, folder)))

"""Queries of features, splits and scoring."""

from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions import features as X
from stayline.operators import explain, features, scoring, splits
from stayline.plans.common import SERVICE_COUNT, SLOT, sql, tidy, unpivot_sql
from stayline.plans.intake import _DIRTY, _ENGINEERED, errors_sql
from stayline.sources import derived

QUERIES, ORACLE = {}, {}


def query(name, oracle=None):
    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLE[name] = oracle
        return function

    return add


def _engineered(spark, folder):
    return features.engineer(derived.customers(spark, folder))


@query("tenure_bucket", sql(
    'SELECT "customerID", tenure, tenure_bucket FROM engineered', ctes=_ENGINEERED))
def tenure_bucket(spark, folder):
    return derived.customers(spark, folder).select(
        S.ID, "tenure", X.tenure_bucket(F.col("tenure")).alias("tenure_bucket")
    )


@query("service_count", sql('SELECT "customerID", service_count FROM engineered', ctes=_ENGINEERED))
def service_count(spark, folder):
    return derived.customers(spark, folder).select(S.ID, X.service_count().alias("service_count"))


@query("revenue_signals", sql(
    """SELECT "customerID", charges_ratio, avg_monthly_charge, charge_increase_flag
       FROM engineered""", ["charges_ratio", "avg_monthly_charge"], _ENGINEERED))
def revenue_signals(spark, folder):
    return tidy(_engineered(spark, folder).select(
        S.ID, "charges_ratio", "avg_monthly_charge", "charge_increase_flag"
    ))


@query("clv_proxy", sql(
    'SELECT "customerID", clv_approximation FROM engineered', ["clv_approximation"], _ENGINEERED))
def clv_proxy(spark, folder):
    return tidy(_engineered(spark, folder).select(S.ID, "clv_approximation"))


_NUM = features.NUMERIC_FEATURES


def _fitted(strategy="avg(value)"):
    fills = ", ".join(f'coalesce("{c}"::DOUBLE, fill_{i}) AS "{c}"' for i, c in enumerate(_NUM))
    means = ", ".join(
        f'{strategy.replace("value", chr(34) + c + chr(34) + "::DOUBLE")} AS fill_{i}'
        for i, c in enumerate(_NUM)
    )
    scale = ", ".join(
        f'avg("{c}") AS m_{i}, stddev_pop("{c}") AS s_{i}' for i, c in enumerate(_NUM)
    )
    return f"""{_ENGINEERED}, fills AS (SELECT {means} FROM engineered),
    filled AS (SELECT * REPLACE ({fills}) FROM (
        SELECT e.* REPLACE ({", ".join(f'"{c}"::DOUBLE AS "{c}"' for c in _NUM)}), fills.*
        FROM engineered e, fills)),
    scales AS (SELECT {scale} FROM filled)"""


def _scaled(names):
    return ", ".join(
        f'("{c}" - m_{i}) / CASE WHEN s_{i} = 0 THEN 1 ELSE s_{i} END AS "{n}"'
        for (i, c), n in zip(enumerate(_NUM), names)
    )


_NUM_NAMES = [f"num__{c}" for c in _NUM]


@query("impute_scale", sql(
    f'SELECT "customerID", {_scaled(_NUM_NAMES)} FROM filled, scales', _NUM_NAMES, _fitted()))
def impute_scale(spark, folder):
    rows = derived.customers(spark, folder)
    model = features.fit_features(rows, categorical=[])
    return tidy(model.transform(rows, keep=[S.ID]))


@query("impute_median", sql(
    f'SELECT "customerID", {_scaled(_NUM_NAMES)} FROM filled, scales', _NUM_NAMES,
    _fitted("quantile_cont(value, 0.5)")))
def impute_median(spark, folder):
    rows = derived.customers(spark, folder)
    model = features.fit_features(rows, categorical=[], strategy="median")
    return tidy(model.transform(rows, keep=[S.ID]))


_CAT = features.CATEGORICAL_FEATURES


@query("one_hot", sql(
    """SELECT "customerID", feature, value AS category FROM longs
       JOIN (SELECT feature, min(value) AS first FROM longs GROUP BY 1) USING (feature)
       WHERE value <> first""",
    ctes=f"{_ENGINEERED}, longs AS ({unpivot_sql(_CAT, 'engineered', ['customerID'], 'VARCHAR')})"))
def one_hot(spark, folder):
    rows = derived.customers(spark, folder)
    model = features.fit_features(rows, numeric=[], categorical=_CAT)
    marked = model.transform(rows, keep=[S.ID])
    marks = F.array_compact(F.array(*[
        F.when(
            F.col(f"`cat__{c}_{v}`") == 1,
            F.struct(F.lit(c).alias("feature"), F.lit(v).alias("category")),
        )
        for c, values in model.categories.items() for v in values[1:]
    ]))
    return marked.select(S.ID, F.inline(marks))


_DUMMIES = [
    (c, v, f"cat__{c}_{v}")
    for c, values in {**S.DOMAINS, "tenure_bucket": X.TENURE_LABELS[:6]}.items()
    for v in sorted(values)[1:]
]


@query("feature_matrix", sql(
    f"""SELECT "customerID", CASE "Churn" WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS label,
        {_scaled(_NUM_NAMES)},
        {", ".join(f'''("{c}" = '{v}')::INT::DOUBLE AS "{n}"''' for c, v, n in _DUMMIES)}
        FROM filled, scales""", _NUM_NAMES, _fitted()))
def feature_matrix(spark, folder):
    rows = derived.customers(spark, folder)
    return tidy(features.fit_features(rows).transform(rows))


CATALOGUED = ["tenure", "MonthlyCharges", "TotalCharges"], ["Contract", "PaymentMethod", "gender"]


def _described(spark):
    return spark.createDataFrame(
        [("tenure", "Months with the company", "retention", ["numeric"])],
        "feature string, description string, owner string, tags array<string>",
    )


_CATALOGUE = f"""
snaps AS (SELECT *, printf('2024010%dT000000Z', i + 1) AS v FROM base, (VALUES (0), (1), (2)) t(i)
          WHERE k % 3 <= i),
numbers AS ({unpivot_sql(CATALOGUED[0], 'snaps', ['v'])}),
texts AS ({unpivot_sql(CATALOGUED[1], 'snaps', ['v'], 'VARCHAR')}),
catalogue AS (
  SELECT v AS version, feature, CASE feature WHEN 'tenure' THEN 'int' ELSE 'double' END AS dtype,
      avg((value IS NULL)::INT) AS null_share, avg(value) AS mean, min(value) AS min,
      max(value) AS max, count(DISTINCT value) AS n_distinct FROM numbers GROUP BY 1, 2
  UNION ALL
  SELECT v, feature, 'string', avg((value IS NULL)::INT), NULL, NULL, NULL, count(DISTINCT value)
  FROM texts GROUP BY 1, 2)
"""


@query("feature_catalogue", sql(
    f"""SELECT *, CASE WHEN feature = 'tenure' THEN 'Months with the company' END AS description,
       CASE WHEN feature = 'tenure' THEN 'retention' END AS owner,
       CASE WHEN feature = 'tenure' THEN 'numeric' ELSE '' END AS tags,
       '{",".join([*CATALOGUED[0], *CATALOGUED[1]])}' AS column_order,
       '{{"scale":"standard"}}' AS transformer_config FROM catalogue""",
    ["null_share", "mean", "min", "max"], _CATALOGUE))
def feature_catalogue(spark, folder):
    catalogue = features.feature_catalogue(
        derived.snapshots(spark, folder), *CATALOGUED, metadata=_described(spark),
        transformer_config={"scale": "standard"},
    )
    return tidy(catalogue.withColumns({
        "tags": F.concat_ws(",", "tags"), "column_order": F.concat_ws(",", "column_order"),
        "transformer_config": F.to_json("transformer_config")}))


@query("feature_catalogue_latest", sql(
    """SELECT feature, null_share, n_distinct, 'Feature: ' || feature AS description
       FROM catalogue WHERE version = (SELECT max(version) FROM catalogue)""",
    ["null_share"], _CATALOGUE))
def feature_catalogue_latest(spark, folder):
    catalogue = features.feature_catalogue(derived.snapshots(spark, folder), *CATALOGUED)
    return tidy(features.latest_version(catalogue).select(
        "feature", "null_share", "n_distinct", "description"
    ))


# --- splits ------------------------------------------------------------------------------

@query("stratified_split", sql(
    f"""SELECT "customerID", "Churn", CASE WHEN {SLOT} < 2000 THEN 'test'
        WHEN {SLOT} < 3600 THEN 'validation' ELSE 'train' END AS split FROM customers"""))
def stratified_split(spark, folder):
    rows = derived.customers(spark, folder).select(S.ID, S.TARGET)
    return splits.stratified_split(rows)


@query("stratified_split_exact", sql(
    """SELECT "customerID", "Churn", CASE WHEN r <= t THEN 'test' WHEN r <= t + round((n - t) * 0.2e0)
          THEN 'validation' ELSE 'train' END AS split
       FROM (SELECT *, round(n * 0.2e0) AS t FROM (
         SELECT "customerID", "Churn", count(*) OVER (PARTITION BY "Churn") AS n,
           row_number() OVER (PARTITION BY "Churn"
             ORDER BY md5(concat("customerID", '|42')), "customerID") AS r FROM customers))"""))
def stratified_split_exact(spark, folder):
    rows = derived.customers(spark, folder).select(S.ID, S.TARGET)
    return splits.stratified_split(rows, exact=True)


@query("kfold_balance", sql(
    f"""SELECT CAST({SLOT} % 5 AS INT) AS fold, count(*) AS n,
        avg(("Churn" = 'Yes')::INT) AS positive_rate FROM customers GROUP BY 1""",
    ["positive_rate"]))
def kfold_balance(spark, folder):
    return tidy(splits.fold_balance(splits.kfold(derived.customers(spark, folder))))


@query("kfold_stratified", sql(
    """SELECT "customerID", "Churn", CAST((r - 1) % 5 AS INT) AS fold FROM (
         SELECT "customerID", "Churn", row_number() OVER (PARTITION BY "Churn"
           ORDER BY md5(concat("customerID", '|42')), "customerID") AS r FROM customers)"""))
def kfold_stratified(spark, folder):
    rows = derived.customers(spark, folder).select(S.ID, S.TARGET)
    return splits.kfold(rows, label=S.TARGET)


@query("class_weights", sql(
    """SELECT "Churn" AS label, count(*) AS n,
       (SELECT count(*) FROM customers) / (2 * count(*)) AS weight FROM customers GROUP BY 1""",
    ["weight"]))
def class_weights(spark, folder):
    return tidy(splits.class_weights(derived.customers(spark, folder)))


def _labelled(spark, folder):
    return derived.customers(spark, folder).select(
        S.ID, (F.col(S.TARGET) == "Yes").cast("int").alias("label"),
        F.col("tenure").cast("double").alias("tenure"), "MonthlyCharges",
    )


_BALANCED = """SELECT (c = 'Yes')::INT AS label, s AS synthetic, n FROM (
    SELECT "Churn" AS c, false AS s, count(*) AS n FROM customers GROUP BY 1
    UNION ALL SELECT arg_min(c, n), true, max(n) - min(n)
    FROM (SELECT "Churn" AS c, count(*) AS n FROM customers GROUP BY 1))"""


def _oversampled(spark, folder, method):
    rows = splits.oversample(
        _labelled(spark, folder), ["tenure", "MonthlyCharges"], method=method
    )
    return rows.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"))


@query("oversample", sql(_BALANCED))
def oversample(spark, folder):
    return _oversampled(spark, folder, "neighbours")


@query("oversample_duplicate", sql(_BALANCED))
def oversample_duplicate(spark, folder):
    return _oversampled(spark, folder, "duplicate")


# --- scoring and explanation -------------------------------------------------------------

@query("score_scorecard", sql("""
    SELECT "customerID", churn_probability, bp >= 5000 AS churn_prediction, 0.5e0 AS threshold
    FROM base""", ["churn_probability", "threshold"]))
def score_scorecard(spark, folder):
    return tidy(scoring.score_scorecard(derived.customers(spark, folder)))


_CHECKED = f"""{_DIRTY},
checked AS (SELECT *, {errors_sql()} AS errors, greatest(200, least(9800, 788
      + CASE "Contract" WHEN 'Month-to-month' THEN 5500 WHEN 'One year' THEN 2500 ELSE 1000 END
      - 83 * tenure + (CAST(round("MonthlyCharges" * 100) AS BIGINT) * 2) // 5
      - 200 * {SERVICE_COUNT})) AS points FROM dirty)"""


@query("score_with_rejects", sql("""
    SELECT "customerID", CASE WHEN len(errors) = 0 THEN points / 10000 END AS churn_probability,
        CASE WHEN len(errors) > 0 THEN array_to_string(errors, '; ') END AS error FROM checked""",
    ["churn_probability"], _CHECKED))
def score_with_rejects(spark, folder):
    ok, rejected = scoring.score_with_rejects(derived.dirty_customers(spark, folder))
    return tidy(
        ok.select(S.ID, "churn_probability").unionByName(rejected, allowMissingColumns=True)
    )


@query("score_totals", sql("""
    SELECT count(*) AS total_customers, count(*) FILTER (len(errors) = 0) AS scored,
        count(*) FILTER (len(errors) > 0) AS rejected FROM checked""", ctes=_CHECKED))
def score_totals(spark, folder):
    return scoring.score_totals(derived.dirty_customers(spark, folder))


_TERMS = f"""
terms AS (SELECT "customerID",
    CASE "Contract" WHEN 'Month-to-month' THEN 5500e0 WHEN 'One year' THEN 2500e0 ELSE 1000e0 END
        AS contract_points,
    tenure::DOUBLE AS tenure, ((mc * 2) // 5)::DOUBLE AS charge_points,
    service_count::DOUBLE AS service_count FROM counted),
means AS (SELECT avg(contract_points) AS m1, avg(tenure) AS m2, avg(charge_points) AS m3,
    avg(service_count) AS m4 FROM terms),
parts AS (
    SELECT "customerID", 'contract_points' AS feature, (contract_points - m1) / 10000 AS contribution,
        contract_points AS value FROM terms, means
    UNION ALL SELECT "customerID", 'tenure', (tenure - m2) * -83 / 10000, tenure FROM terms, means
    UNION ALL SELECT "customerID", 'charge_points', (charge_points - m3) / 10000, charge_points
        FROM terms, means
    UNION ALL SELECT "customerID", 'service_count', (service_count - m4) * -200 / 10000, service_count
        FROM terms, means)"""


def _contributions(spark, folder, top=None):
    terms = scoring.scorecard_terms(derived.customers(spark, folder))
    return explain.linear_contributions(terms, scoring.SCORECARD.weights, scale=1e-4, top=top)


@query("explain_topk", sql("""
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY "customerID"
        ORDER BY round(abs(contribution), 9) DESC, feature) AS INT) AS rank_no FROM parts) WHERE rank_no <= 3""",
    ["contribution", "value"], _TERMS))
def explain_topk(spark, folder):
    return tidy(_contributions(spark, folder, top=3))


@query("global_importance", sql("""
    SELECT feature, avg(abs(contribution)) AS mean_abs_contribution,
        avg(contribution) AS mean_contribution FROM parts GROUP BY 1""",
    ["mean_abs_contribution", "mean_contribution"], _TERMS))
def global_importance(spark, folder):
    return tidy(explain.global_importance(_contributions(spark, folder), top=20))


@query("explain_extreme", sql("""
    SELECT * FROM parts WHERE "customerID" =
        (SELECT "customerID" FROM base ORDER BY churn_probability DESC, "customerID" LIMIT 1)""",
    ["contribution", "value"], _TERMS))
def explain_extreme(spark, folder):
    rows = derived.customers(spark, folder)
    top = explain.highest_score(scoring.score_scorecard(rows)).select(S.ID).scalar()
    return tidy(_contributions(spark, folder).where(F.col(S.ID) == top))

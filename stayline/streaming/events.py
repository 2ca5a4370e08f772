"""Customer events: parsing, normalisation, validation, scoring.

Every function works on a batch or a streaming DataFrame with a JSON column `value`.
"""

import re

from pyspark.sql import functions as F

from stayline import schema as S
from stayline.operators.quality import contract_rules, settled
from stayline.operators.scoring import scorecard_probability, scorecard_terms

REQUIRED = [S.ID, "tenure", "MonthlyCharges"]
FIELDS = [c for c in S.CUSTOMER_COLUMNS if c != S.TARGET]
TOPIC = "customer_events"


_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z0-9]+")


def snake_case(name):
    """The words of a name, in lower case and joined by underscores."""
    return "_".join(_WORDS.findall(name)).lower()


def spellings():
    """Names under which an event may carry each field, the preferred one first."""
    found = {name: [name, snake_case(name)] for name in FIELDS}
    # Fixed extras: a capital gender, and the required fields in lower case.
    found["gender"].append("Gender")
    for name in REQUIRED:
        found[name].append(name.lower())
    return {name: list(dict.fromkeys(names)) for name, names in found.items()}


SPELLINGS = spellings()


def kafka_source(spark, servers, topic=TOPIC, offsets="latest"):
    """Streaming source on a topic; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", offsets)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def file_source(spark, folder, files_per_batch=None):
    """Streaming source on text files with one JSON event per line."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def _number(text, kind):
    value = text.try_cast("double")
    return F.when(value == F.floor(value), value.try_cast("int")) if kind == "int" else value


def normalize_events(events):
    """Customer columns with defaults, event_timestamp, and the error or null.

    The error names the missing required fields, or else the broken rules.
    """
    kept = [c for c in events.columns if c != "value"]
    # One parse: names that differ in case only are different keys of a map.
    # Behind a generator, so that the optimizer does not repeat the parse inside of what reads it.
    parsed = settled(events, "_sent", F.from_json("value", "map<string,string>")).drop("value")
    sent = lambda name: F.try_element_at(F.col("_sent"), name)
    # One expression finds all fields. As one column each they make a method that Java does not compile.
    names = F.array(*[F.array(*map(F.lit, SPELLINGS[name])) for name in FIELDS])
    texts = F.transform(names, lambda own: F.try_element_at(
        F.filter(F.transform(own, sent), lambda text: text != ""), F.lit(1)))
    found = parsed.select(
        *kept,
        texts.alias("_texts"),
        sent(F.lit(S.ID)).alias("_sent_id"),
        sent(F.lit("timestamp")).alias("event_timestamp"),
    )
    read = found.select(
        *kept, *[F.col("_texts")[i].alias(f"_{name}") for i, name in enumerate(FIELDS)],
        "_sent_id", "event_timestamp",
    )
    columns = {}
    for name in FIELDS:
        kind, text = S.CUSTOMERS[name].dataType.simpleString(), F.col(f"_{name}")
        if name == S.ID:
            columns[name] = text
        elif name == "TotalCharges":
            columns[name] = F.nullif(_number(text, kind), F.lit(0.0))
        elif kind == "string":
            columns[name] = F.coalesce(text, F.lit(S.EVENT_DEFAULTS[name]))
        else:
            default = F.lit(S.EVENT_DEFAULTS[name]).cast(kind)
            columns[name] = F.when(text.isNull(), default).otherwise(_number(text, kind))
    missing = F.concat_ws(
        ", ", *[F.when(F.col(f"_{c}").isNull(), F.lit(c)) for c in REQUIRED]
    )
    unreadable = F.col("_TotalCharges").isNotNull() & _number(
        F.col("_TotalCharges"), "double"
    ).isNull()
    wide = read.select(
        *kept,
        *[columns[c].alias(c) for c in FIELDS],
        "event_timestamp", "_sent_id",
        missing.alias("_missing"),
        F.when(unreadable, F.lit("TotalCharges: not a number")).alias("_extra"),
    )
    # Again one expression, judged once a row; the generator below names it twice.
    rules = F.array(*contract_rules(), F.col("_extra"))
    judged = wide.withColumn("_broken", F.concat_ws("; ", F.filter(rules, lambda rule: rule.isNotNull())))
    broken = F.col("_broken")
    error = F.when(
        F.col("_missing") != "",
        F.concat(F.lit("Invalid data: Missing required fields in event: "), "_missing"),
    ).when(broken != "", F.concat(F.lit("Invalid data: "), broken))
    return settled(judged, "error", error).drop("_missing", "_extra", "_broken")


def valid_events(normalized):
    return normalized.where("error IS NULL").drop("error", "_sent_id")


def event_rejects(normalized):
    """Dead letters: the id as sent or `unknown`, the error, when it was handled."""
    kept = [c for c in normalized.columns if c in ("event_id",)]
    return normalized.where("error IS NOT NULL").select(
        *kept,
        F.coalesce("_sent_id", F.lit("unknown")).alias(S.ID),
        "error",
        F.current_timestamp().alias("processed_at"),
    )


def score_events(normalized, threshold=0.5, score=None):
    """Score valid events. `score` maps rows to rows with `churn_probability`; the default
    is the scorecard. Nothing is shuffled, so it holds for streams as well."""
    rows = valid_events(normalized)
    extra = [c for c in ("event_id", "ts") if c in rows.columns]
    if score is None:
        terms = scorecard_terms(rows, [*extra, "event_timestamp"])
        scored = terms.withColumn("churn_probability", scorecard_probability())
    else:
        scored = score(rows)
    return scored.select(
        *extra, S.ID, "churn_probability",
        (F.col("churn_probability") >= threshold).alias("churn_prediction"),
        F.lit(float(threshold)).alias("threshold"),
        "event_timestamp",
        F.current_timestamp().alias("processed_at"),
    )

"""Queries of the event stream: batch twins and real streaming runs over files."""

from pyspark.sql import functions as F

from stayline import schema as S
from stayline.plans.common import SERVICE_COUNT, sql, tidy
from stayline.session import scratch_path
from stayline.sources import derived
from stayline.streaming import events as E
from stayline.streaming import sinks
from stayline.streaming.log_source import log_offsets, replay
from stayline.streaming.upsert import BucketedTable

QUERIES, ORACLE = {}, {}


def query(name, oracle=None):
    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLE[name] = oracle
        return function

    return add


_FIELDS = [c for c in S.CUSTOMER_COLUMNS if c not in (S.TARGET, "tenure", "gender", "MonthlyCharges")]
_EVENTS = f"""
sent AS (SELECT event_id, ts, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_timestamp,
    {", ".join(f'"{c}"' for c in _FIELDS)},
    CASE WHEN event_id % 50 = 1 THEN 'X' ELSE gender END AS gender,
    CASE WHEN event_id % 50 = 0 THEN 0 ELSE tenure END AS tenure,
    CAST(mc + event_id % 7 * 100 AS DOUBLE) / 100 AS "MonthlyCharges",
    greatest(200, least(9800,
        (CASE "Contract" WHEN 'Month-to-month' THEN 5500 WHEN 'One year' THEN 2500 ELSE 1000 END)
        + 788 - tenure * 83 + ((mc + event_id % 7 * 100) * 2) // 5 - 200 * {SERVICE_COUNT})) AS bp,
    CASE WHEN event_id % 50 = 0 THEN 'Invalid data: Missing required fields in event: tenure'
         WHEN event_id % 50 = 1 THEN 'Invalid data: gender: not an allowed value' END AS error,
    CASE WHEN event_id % 2 = 0 THEN "customerID" ELSE 'unknown' END AS sent_id
  FROM events JOIN base ON user_id = k),
accepted AS (SELECT event_id, ts, "customerID", CAST(bp AS DOUBLE) / 10000 AS churn_probability,
    bp >= 5000 AS churn_prediction, event_timestamp FROM sent WHERE error IS NULL),
newest AS (SELECT * FROM accepted
    QUALIFY row_number() OVER (PARTITION BY "customerID" ORDER BY ts DESC, churn_probability DESC) = 1),
alive AS (SELECT * FROM newest WHERE ts > (SELECT max(ts) FROM accepted) - INTERVAL 1 HOUR)"""


@query("normalize_events", sql(f"""
    SELECT event_id, event_timestamp, error, {", ".join(f'"{c}"' for c in E.FIELDS)} FROM sent""",
    ctes=_EVENTS))
def normalize_events(spark, folder):
    return E.normalize_events(derived.events(spark, folder)).drop("ts", "_sent_id")


@query("event_rejects", sql(
    'SELECT event_id, sent_id AS "customerID", error FROM sent WHERE error IS NOT NULL', ctes=_EVENTS))
def event_rejects(spark, folder):
    normalized = E.normalize_events(derived.events(spark, folder))
    return E.event_rejects(normalized).drop("processed_at")


@query("score_events", sql(
    'SELECT event_id, "customerID", churn_probability, churn_prediction FROM accepted',
    ["churn_probability"], _EVENTS))
def score_events(spark, folder):
    scored = E.score_events(E.normalize_events(derived.events(spark, folder)))
    return tidy(scored.select("event_id", S.ID, "churn_probability", "churn_prediction"))


@query("latest_scores", sql(
    'SELECT "customerID", event_id, churn_probability FROM alive', ["churn_probability"], _EVENTS))
def latest_scores(spark, folder):
    scored = E.score_events(E.normalize_events(derived.events(spark, folder)))
    return tidy(sinks.latest_scores(scored).select(S.ID, "event_id", "churn_probability"))


def _event_files(spark, folder, part=None):
    """Folder of event files; `part` of two adds one half of the events to it."""
    path = part[0] if part else scratch_path(spark, "events")
    rows = derived.events(spark, folder)
    if part:
        rows = rows.where(F.col("event_id") % 2 == part[1])
    # A file is a batch of `upsert_scores`; more of them than tasks run at once would only add batches.
    rows.select("value").coalesce(spark.sparkContext.defaultParallelism).write.mode("append").text(path)
    return path


def _run(spark, folder, counts=None):
    """Stream all event files once; the folder of the scores."""
    scores = scratch_path(spark, "scores")
    sinks.run_available(
        E.file_source(spark, _event_files(spark, folder)),
        sinks.split_sink(scores, scratch_path(spark, "rejects"), counts=counts),
        scratch_path(spark, "offsets"),
    )
    return scores


@query("stream_score", sql(
    'SELECT "customerID", churn_probability, churn_prediction, event_timestamp FROM accepted',
    ["churn_probability"], _EVENTS))
def stream_score(spark, folder):
    scores = spark.read.parquet(_run(spark, folder))
    return tidy(scores.select(S.ID, "churn_probability", "churn_prediction", "event_timestamp"))


@query("stream_run", sql("""
    SELECT count(*) AS processed_count, count(error) AS errors, count(error) = 0 AS success FROM sent""",
    ctes=_EVENTS))
def stream_run(spark, folder):
    counts = sinks.RunCounts()
    _run(spark, folder, counts)
    return counts.report(spark)


@query("event_replay", sql("""
    SELECT "customerID", event_timestamp, tenure, "MonthlyCharges", error FROM sent WHERE event_id % 2 = 1""",
    ["MonthlyCharges"], _EVENTS))
def event_replay(spark, folder):
    """What was added to a log after its offsets were taken, read again by these offsets."""
    log = scratch_path(spark, "log")
    _event_files(spark, folder, (log, 0))
    start = log_offsets(log)
    _event_files(spark, folder, (log, 1))
    sent = E.normalize_events(replay(spark, log, start).select("value"))
    return tidy(sent.select(S.ID, "event_timestamp", "tenure", "MonthlyCharges", "error"))


_LATEST = ["churn_probability", "churn_prediction", "event_timestamp"]


@query("latest_state", sql(
    'SELECT "customerID", churn_probability, churn_prediction, event_timestamp FROM alive',
    ["churn_probability"], _EVENTS))
def latest_state(spark, folder):
    """Two runs from one checkpoint, each over what is there; the state that is left."""
    files, checkpoint = scratch_path(spark, "events"), scratch_path(spark, "state")
    emitted = scratch_path(spark, "emitted")
    with sinks.rocksdb_state(spark):
        for half in (0, 1):
            _event_files(spark, folder, (files, half))
            scored = E.score_events(E.normalize_events(E.file_source(spark, files)))
            sinks.run_available(
                sinks.latest_state(scored),
                lambda batch, i: batch.write.mode("overwrite").parquet(f"{emitted}/batch={i}"),
                checkpoint, mode="update")
    return tidy(sinks.read_state(spark, checkpoint).select(S.ID, *_LATEST))


@query("upsert_scores", sql(
    'SELECT "customerID", churn_probability, churn_prediction, event_timestamp FROM newest',
    ["churn_probability"], _EVENTS))
def upsert_scores(spark, folder):
    schema = f"{S.ID} string, {sinks.STATE_COLUMNS}"
    table = BucketedTable(spark, scratch_path(spark, "latest"), schema, order=("event_timestamp", "churn_probability"))
    files = _event_files(spark, folder)
    # Two runs with checkpoints of their own; the second brings every event again.
    for run in ("first", "second"):
        sink = table.sink(run, lambda batch: E.score_events(E.normalize_events(batch)))
        sinks.run_available(
            E.file_source(spark, files, files_per_batch=1), sink, scratch_path(spark, f"offsets-{run}"))
        table.merge()
    return tidy(table.read().select(S.ID, *_LATEST))

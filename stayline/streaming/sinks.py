"""Keyed results of the event stream: latest score, keyed state, run counts."""

from contextlib import contextmanager

from pyspark.sql import Observation, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from stayline import schema as S
from stayline.session import checkpointed
from stayline.streaming.events import event_rejects, normalize_events, score_events

STATE_FIELDS = ["churn_probability", "churn_prediction", "event_timestamp"]
STATE_COLUMNS = "churn_probability double, churn_prediction boolean, event_timestamp string"
TTL_SECONDS = 3600
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def latest_scores(scored, as_of=None, ttl_seconds=TTL_SECONDS, order=("ts", "event_id")):
    """Newest score per customer not older than the time to live.

    `as_of` defaults to the newest event. An aggregate with partial results, so a hot
    customer does not land on one task as rows.
    """
    at = order[0]
    newest = newest_per_customer(scored, order)
    if as_of is None:
        # These rows hold the newest event of all; written once, so events are parsed once.
        newest = checkpointed(newest)
    now = newest.agg(F.max(at)).scalar() if as_of is None else F.lit(as_of)
    return newest.where(F.col(at) > now - F.expr(f"INTERVAL {ttl_seconds} SECONDS"))


def newest_per_customer(scored, order=("ts", "event_id")):
    payload = F.struct(*[c for c in scored.columns if c != S.ID])
    return (
        scored.groupBy(S.ID)
        .agg(F.max_by(payload, F.struct(*order)).alias("_row"))
        .select(S.ID, "_row.*")
    )


class RunCounts:
    """What a run has written, counted by the writes themselves.

    A replayed batch replaces its own counts.
    """

    def __init__(self):
        self.batches = {}

    def add(self, batch_id, scored, failed):
        self.batches[batch_id] = (scored, failed)

    def report(self, spark):
        """processed_count, errors and success of the run, in one row."""
        scored, failed = (sum(x) for x in zip((0, 0), *self.batches.values()))
        return spark.createDataFrame(
            [(scored + failed, failed, failed == 0)], "processed_count long, errors long, success boolean")


def written(df, path):
    """Write a table and give the number of its rows, counted on the way."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return seen.get.get("n", 0)


def split_sink(scores_folder, rejects_folder, score=None, threshold=0.5, counts=None):
    """foreachBatch function: valid events to scores, broken ones to rejects.

    Each batch overwrites its own folder, so a replay adds nothing twice. The parsed batch
    is kept while both sides are written. `counts` (RunCounts) learns how much was written.
    """
    counts = RunCounts() if counts is None else counts

    def write(batch, batch_id):
        normalized = normalize_events(batch).persist()
        try:
            counts.add(
                batch_id,
                written(score_events(normalized, threshold, score), f"{scores_folder}/batch={batch_id}"),
                written(event_rejects(normalized), f"{rejects_folder}/batch={batch_id}"),
            )
        finally:
            normalized.unpersist()

    return write


def run_available(stream, write, checkpoint, timeout=None, mode="append"):
    """Process what is there now, then stop; the query's own failure is raised.

    `timeout` is a limit in seconds that the caller may set.
    """
    query = (
        stream.writeStream.foreachBatch(write).outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream still running after {timeout} s")
    return query


@contextmanager
def rocksdb_state(spark):
    """Queries started inside keep their state in RocksDB, which keyed state needs."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, STATE_STORE)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


class Latest(StatefulProcessor):
    """Newest score of a customer; a timer in event time ends it after the time to live."""

    def init(self, handle):
        self.handle = handle
        self.latest = handle.getValueState("latest", f"{STATE_COLUMNS}, at long")

    def handleInputRows(self, key, rows, timerValues):
        old = self.latest.get() if self.latest.exists() else None
        # (time, score) decides, so ties go to the higher score in any order of the rows.
        newest = max(((r.at, r.churn_probability, r.churn_prediction, r.event_timestamp) for r in rows))
        if old is not None and (old[3], old[0]) >= newest[:2]:
            return
        if old is not None:
            self.handle.deleteTimer(self.expiry(old[3]))
        at, probability, prediction, stamp = newest
        self.latest.update((probability, prediction, stamp, at))
        self.handle.registerTimer(self.expiry(at))
        yield Row(**{S.ID: key[0]}, churn_probability=probability, churn_prediction=prediction, event_timestamp=stamp, expired=False)

    def expiry(self, at):
        # The watermark is behind by the time to live already; timers count milliseconds.
        return at // 1000 + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        probability, prediction, stamp, _ = self.latest.get()
        self.latest.clear()
        yield Row(**{S.ID: key[0]}, churn_probability=probability, churn_prediction=prediction, event_timestamp=stamp, expired=True)

    def close(self):
        pass


def latest_state(scored, ttl_seconds=TTL_SECONDS):
    """Streaming twin of `latest_scores`: keyed state that expires after the time to live.

    `scored` is a stream with the columns of `score_events`. A row is emitted whenever a
    customer's newest score changes, and with `expired` once it ends. The clock is the
    newest event, so a run over what is there ends by itself, and a run from the same
    checkpoint goes on where it ended. Start it inside `rocksdb_state`.

    Each Arrow batch passes on one row per customer, so that a frequent customer does not
    reach its task as rows.
    """
    rows = scored.select(
        S.ID, *STATE_FIELDS, F.to_timestamp("event_timestamp").alias("ts")
    ).where(F.col("ts").isNotNull())

    def newest(frames):
        for frame in frames:
            yield frame.sort_values(["ts", "churn_probability"]).drop_duplicates(S.ID, keep="last")

    timed = rows.mapInPandas(newest, rows.schema).withWatermark("ts", f"{ttl_seconds} seconds")
    return timed.withColumn("at", F.unix_micros("ts")).groupBy(S.ID).transformWithState(
        statefulProcessor=Latest(), outputStructType=f"{S.ID} string, {STATE_COLUMNS}, expired boolean",
        outputMode="Update", timeMode="EventTime")


def read_state(spark, checkpoint, ttl_seconds=TTL_SECONDS):
    """The rows that the state of a stopped `latest_state` run holds, read from its checkpoint.

    Timers fire by the millisecond after the newest event; the comparison here is exact.
    """
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "latest").load()
    rows = state.select(f"key.{S.ID}", "value.*")
    newest = rows.agg(F.max("at")).scalar()
    return rows.where(F.col("at") > newest - ttl_seconds * 1_000_000).drop("at")

import json

import pytest
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.streaming import events as E
from stayline.streaming import sinks
from stayline.streaming.upsert import BucketedTable
from tests.helpers import plan_text


def _event(i, **changes):
    row = {"customerID": f"SIM-{i}", "gender": "Female", "tenure": 12 + i, "MonthlyCharges": 70.5 + 5 * i,
           "TotalCharges": 845.0 + 50 * i, "Contract": "One year", "timestamp": f"2024-01-01 00:00:{i:02d}"}
    row.update(changes)
    return json.dumps({k: v for k, v in row.items() if v is not None})


def _frame(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def _write(lines, folder, name):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


@pytest.mark.parametrize("name, expected", [("customerID", "customer_id"), ("MonthlyCharges", "monthly_charges"),
                                            ("StreamingTV", "streaming_tv"), ("tenure", "tenure"), ("URLPath2", "url_path2")])
def test_snake_case(name, expected):
    assert E.snake_case(name) == expected


def test_spellings_and_defaults(spark):
    lines = [
        _event(1),
        json.dumps({"customer_id": "s", "tenure": "7", "monthly_charges": 20, "senior_citizen": 1, "payment_method": "Mailed check"}),
        json.dumps({"customerid": "l", "tenure": 7.0, "monthlycharges": "20.5", "Gender": "Female", "TotalCharges": 0}),
    ]
    rows = E.normalize_events(_frame(spark, lines)).collect()
    assert [r.error for r in rows] == [None, None, None]
    assert rows[0].Contract == "One year" and rows[0].PaymentMethod == "Electronic check"
    assert (rows[1].customerID, rows[1].tenure, rows[1].SeniorCitizen, rows[1].PaymentMethod) == ("s", 7, 1, "Mailed check")
    assert (rows[2].customerID, rows[2].MonthlyCharges, rows[2].gender, rows[2].TotalCharges) == ("l", 20.5, "Female", None)


def test_an_event_is_parsed_once(spark):
    plan = plan_text(E.score_events(E.normalize_events(_frame(spark, [_event(1)]))))
    assert plan.count("from_json") == 1


def test_bad_events_become_dead_letters(spark):
    lines = [
        _event(1, tenure=None), _event(2, gender="X"), _event(3, MonthlyCharges="abc"), "not json",
        _event(4, TotalCharges="abc"), _event(5, tenure=1.5), _event(6),
    ]
    normalized = E.normalize_events(_frame(spark, lines))
    rejects = {r.customerID: r.error for r in E.event_rejects(normalized).collect()}
    assert rejects["SIM-1"] == "Invalid data: Missing required fields in event: tenure"
    assert rejects["SIM-2"] == "Invalid data: gender: not an allowed value"
    assert "MonthlyCharges" in rejects["SIM-3"] and "TotalCharges" in rejects["SIM-4"] and "tenure" in rejects["SIM-5"]
    assert rejects["unknown"].startswith("Invalid data: Missing required fields in event: customerID, tenure")
    assert [r.customerID for r in E.score_events(normalized).collect()] == ["SIM-6"]


def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path):
    lines = [_event(i) for i in range(10)] + [_event(11, tenure=None)]
    source = _write(lines[:6], tmp_path / "in", "a.txt")
    _write(lines[6:], tmp_path / "in", "b.txt")
    scores, rejects = str(tmp_path / "scores"), str(tmp_path / "rejects")
    counts = sinks.RunCounts()
    sinks.run_available(
        E.file_source(spark, source, files_per_batch=1), sinks.split_sink(scores, rejects, counts=counts), str(tmp_path / "offsets"))
    streamed = spark.read.parquet(scores).select(S.ID, "churn_probability")
    batch = E.score_events(E.normalize_events(_frame(spark, lines))).select(S.ID, "churn_probability")
    assert streamed.exceptAll(batch).count() == 0 and streamed.count() == batch.count() == 10
    assert tuple(counts.report(spark).first()) == (11, 1, False)
    assert spark.read.parquet(rejects).count() == 1
    # Files of the same age come in any order, so batch 0 holds either of them.
    first = lines[:6] if spark.read.parquet(f"{scores}/batch=0").count() == 6 else lines[6:]
    sinks.split_sink(scores, rejects, counts=counts)(_frame(spark, first), 0)
    assert spark.read.parquet(scores).count() == 10
    assert tuple(counts.report(spark).first()) == (11, 1, False)
    assert tuple(sinks.RunCounts().report(spark).first()) == (0, 0, True)


@pytest.fixture
def upserted(spark, tmp_path):
    return BucketedTable(spark, str(tmp_path / "table"), "customerID string, score double, at int", order=("at", "score"), buckets=4)


def _rows(table):
    return {r.customerID: r.score for r in table.read().collect()}


def _files(table):
    fs, root = table._fs(f"{table.folder}/_bucket=*/_version=*/part-*")
    return {str(s.getPath()): s.getModificationTime() for s in fs.globStatus(root) or ()}


def test_upsert_is_idempotent_and_survives_merges(spark, upserted):
    def batch(*rows):
        return spark.createDataFrame(rows, "customerID string, score double, at int")

    assert upserted.read().count() == 0 and upserted.merge() == []
    upserted.write(batch(("a", 0.1, 1), ("a", 0.2, 2), ("b", 0.5, 1), (None, 0.4, 1)), 0)
    upserted.write(batch(("a", 0.3, 3), ("c", 0.9, 1)), 1)
    upserted.write(batch(("a", 0.3, 3), ("c", 0.9, 1)), 1)
    expected = {"a": 0.3, "b": 0.5, "c": 0.9, None: 0.4}
    assert _rows(upserted) == expected
    assert upserted.merge() and _rows(upserted) == expected and upserted.merge() == []
    upserted.write(batch(("b", 0.7, 2), ("a", 0.0, 1)), 2)
    assert _rows(upserted) == {**expected, "b": 0.7}
    # A new checkpoint numbers its batches from 0 again; of equal times the higher score counts.
    upserted.write(batch(("d", 0.4, 1), ("c", 0.2, 2), ("d", 0.6, 1)), 0, run="1")
    expected |= {"b": 0.7, "c": 0.2, "d": 0.6}
    assert _rows(upserted) == expected
    assert upserted.merge() and _rows(upserted) == expected
    upserted.vacuum()
    again = BucketedTable(spark, upserted.folder, "customerID string, score double, at int", order=("at", "score"), buckets=4)
    assert _rows(again) == expected and all(len(v) == 1 for v in again.versions().values())


def test_merge_shuffles_nothing_and_leaves_other_buckets(spark, upserted):
    upserted.write(spark.range(200).selectExpr("concat('k', id) AS customerID", "id / 200 AS score", "1 AS at"), 0)
    before = _files(upserted)
    upserted.write(spark.createDataFrame([("k7", 0.9, 2)], "customerID string, score double, at int"), 1)
    touched = {b for b, v in upserted.versions().items() if len(v) > 1}
    assert len(touched) == 1
    plan = plan_text(upserted._newest(upserted._rows({b: v for b, v in upserted.versions().items() if b in touched})))
    assert "Exchange" not in plan and "Bucketed: true" in plan and "Exchange" not in plan_text(upserted.read())
    assert upserted.merge() == sorted(touched)
    merged = [f for f in _files(upserted) if "_version=merge-" in f]
    assert len(merged) == 1 and f"_bucket={min(touched)}/" in merged[0]
    assert {f: t for f, t in _files(upserted).items() if f in before} == before
    assert upserted.read().count() == 200 and _rows(upserted)["k7"] == 0.9


def test_merge_without_its_manifest_changes_nothing(spark, upserted, monkeypatch):
    upserted.write(spark.createDataFrame([("a", 0.1, 1), ("b", 0.2, 1)], "customerID string, score double, at int"), 0)
    upserted.write(spark.createDataFrame([("a", 0.5, 2)], "customerID string, score double, at int"), 1)
    monkeypatch.setattr(upserted, "_publish", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        upserted.merge()
    assert _rows(upserted) == {"a": 0.5, "b": 0.2}


def test_latest_scores_expire(spark):
    rows = [("a", 0.1, "2024-01-01 00:00:00", 1), ("a", 0.2, "2024-01-01 01:30:00", 2), ("b", 0.3, "2024-01-01 00:10:00", 3),
            ("c", 0.4, "2024-01-01 02:00:00", 4)]
    df = spark.createDataFrame(rows, "customerID string, churn_probability double, at string, event_id int").withColumn("ts", F.to_timestamp("at"))
    latest = {r.customerID: r.churn_probability for r in sinks.latest_scores(df).collect()}
    assert latest == {"a": 0.2, "c": 0.4}


def test_keyed_state_expires_and_goes_on_from_its_checkpoint(spark, tmp_path):
    """Four runs from one checkpoint end by themselves; state and batch twin agree after each."""
    checkpoint, sent, emitted = str(tmp_path / "state"), [], []
    day = "2024-01-01 "
    runs = [
        [("a", "00:00:00", 1), ("a", "00:05:00.000250", 9), ("b", "00:10:00", 3), ("a", "00:01:00", 4)],
        [("c", "01:05:00", 5), ("b", "00:09:00", 6)],
        [("d", "01:05:00.000250", 7), ("c", "01:05:00", 8), ("c", "01:05:00", 2)],
        [("e", "02:10:00", 2)],
    ]
    for k, run in enumerate(runs):
        lines = [_event(0, customerID=c, timestamp=day + t, tenure=n) for c, t, n in run]
        sent += lines
        source = _write(lines, tmp_path / "in", f"{k}.txt")
        with sinks.rocksdb_state(spark):
            scored = E.score_events(E.normalize_events(E.file_source(spark, source)))
            query = sinks.run_available(
                sinks.latest_state(scored), lambda batch, i: emitted.extend(batch.collect()), checkpoint, timeout=300, mode="update")
        assert not query.isActive
        batch = E.score_events(E.normalize_events(_frame(spark, sent))).withColumn("ts", F.to_timestamp("event_timestamp"))
        expected = sinks.latest_scores(batch, order=("ts", "churn_probability"))
        fields = [S.ID, *sinks.STATE_FIELDS]
        assert sorted(sinks.read_state(spark, checkpoint).select(*fields).collect()) == sorted(expected.select(*fields).collect()), k
    assert {r.customerID for r in emitted if r.expired} >= {"a", "b"}

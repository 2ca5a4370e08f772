"""The event log: offsets, growing files, ranges cut anywhere, replay."""

import json

import pytest

from stayline.streaming import log_source, sinks
from stayline.streaming.log_source import EventLog, Log


def _values(df):
    return sorted(r.value for r in df.collect())


@pytest.mark.parametrize("task_bytes", [1, 7, 30, 10**6])
def test_ranges_cut_anywhere_give_every_line_once(tmp_path, monkeypatch, task_bytes):
    monkeypatch.setattr(log_source, "BLOCK", 4)
    lines = ["", "a", "é" * 9, "x" * 50, "", "last"]
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\nhalf a li", encoding="utf-8")
    (tmp_path / "b.txt").write_text("only half")
    (tmp_path / "_hidden").write_text("no\n")
    log = Log(str(tmp_path))
    ends = log.ends()
    assert ends["b.txt"] == 0 and ends.keys() == {"a.txt", "b.txt"}
    rows = [tuple(r.values()) for part in log.ranges({}, ends, task_bytes) for b in log.read(part) for r in b.to_pylist()]
    assert [v for _, _, v in rows] == lines
    raw = (tmp_path / "a.txt").read_bytes()
    assert all(raw[p:].startswith(v.encode() + b"\n") for _, p, v in rows)


def test_stream_goes_on_from_its_checkpoint_and_reads_growth(spark, tmp_path):
    folder, seen = tmp_path / "log", []
    folder.mkdir()
    (folder / "a.txt").write_text("1\n2\n3")
    run = lambda offsets, name: sinks.run_available(
        log_source.event_log(spark, str(folder), offsets), lambda batch, i: seen.extend(_values(batch)), str(tmp_path / name), timeout=120)
    run("earliest", "one")
    assert seen == ["1", "2"]
    with open(folder / "a.txt", "a") as file:
        file.write("3\n4\n")
    (folder / "b.txt").write_text("5\n")
    run("earliest", "one")
    assert seen == ["1", "2", "33", "4", "5"]
    run("earliest", "one")
    assert len(seen) == 5


def test_latest_starts_at_the_end(spark, tmp_path):
    folder, seen = tmp_path / "log", []
    folder.mkdir()
    (folder / "a.txt").write_text("old\n")
    stream = log_source.event_log(spark, str(folder))
    for _ in range(2):
        sinks.run_available(stream, lambda batch, i: seen.extend(_values(batch)), str(tmp_path / "offsets"), timeout=120)
        (folder / "b.txt").write_text("new\n")
    assert seen == ["new"]


def test_replay_of_a_range(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\n2\n")
    first = log_source.log_offsets(tmp_path)
    assert json.loads(first) == {"a.txt": 4}
    (tmp_path / "a.txt").write_text("1\n2\n3\n")
    (tmp_path / "b.txt").write_text("4\n5\n")
    second = log_source.log_offsets(tmp_path)
    (tmp_path / "c.txt").write_text("6\n")
    folder = str(tmp_path)
    assert _values(log_source.replay(spark, folder, first, second)) == ["3", "4", "5"]
    assert _values(log_source.replay(spark, folder, end=first)) == ["1", "2"]
    assert _values(log_source.replay(spark, f"file://{folder}", second)) == ["6"]
    spark.dataSource.register(EventLog)
    rows = spark.read.format("event_log").option("taskBytes", 3).load(folder)
    assert _values(rows) == list("123456") and rows.rdd.getNumPartitions() == 5
    empty = tmp_path / "none"
    assert log_source.replay(spark, str(empty)).count() == 0

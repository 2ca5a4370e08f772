"""A log of event files as a source with offsets: start at either end, replay any range.

The log is a folder of text files with one event a line. Files may be added and may grow;
what is written stays. An offset says how far each file has been read, in bytes up to the
end of a line, so a stream goes on where its checkpoint ended and a batch can read the
same range again.

    spark.dataSource.register(EventLog)
    spark.readStream.format("event_log").option("startingOffsets", "latest").load(folder)
    spark.read.format("event_log").option("startingOffsets", json).load(folder)
"""

import json
import os
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = pa.schema([("file", pa.string()), ("position", pa.int64()), ("value", pa.string())])
COLUMNS = "file string, position long, value string"
#: Bytes that one task reads at most, and that are read at a time to find the end of a line.
TASK_BYTES, BLOCK = 64 << 20, 1 << 16


@dataclass
class Range(InputPartition):
    """Bytes of one file; lines that begin in it belong to it. `limit` ends the last line of all."""

    file: str
    start: int
    end: int
    limit: int
    whole_lines: bool


class Log:
    """The files of a folder, on any file system that pyarrow opens."""

    def __init__(self, path):
        if "://" in path or path.startswith("file:"):
            self.fs, self.root = pyarrow.fs.FileSystem.from_uri(path)
        else:
            self.fs, self.root = pyarrow.fs.LocalFileSystem(), path
        self.root = self.root.rstrip("/")

    def sizes(self):
        """{name: bytes} of the files; names with a leading dot or underscore are not part of the log."""
        found = self.fs.get_file_info(pyarrow.fs.FileSelector(self.root, allow_not_found=True))
        return {f.base_name: f.size for f in found if f.is_file and f.base_name[0] not in "._"}

    def open(self, name):
        return self.fs.open_input_file(f"{self.root}/{name}")

    def line_end(self, name, size):
        """Bytes up to the end of the last whole line of the first `size` bytes."""
        with self.open(name) as file:
            at = size
            while at > 0:
                start = max(0, at - BLOCK)
                file.seek(start)
                place = file.read(at - start).rfind(b"\n")
                if place >= 0:
                    return start + place + 1
                at = start
        return 0

    def ends(self):
        """How far each file can be read now."""
        return {name: self.line_end(name, size) for name, size in sorted(self.sizes().items())}

    def ranges(self, start, end, task_bytes=TASK_BYTES):
        """What lies between two offsets, in parts for tasks."""
        out = []
        for name, last in sorted(end.items()):
            first = start.get(name, 0)
            for at in range(first, last, task_bytes):
                out.append(Range(name, at, min(last, at + task_bytes), last, at == first))
        return out

    def _next_line(self, file, at, limit):
        """Place behind the first line end from `at` on."""
        while at < limit:
            file.seek(at)
            block = file.read(min(BLOCK, limit - at))
            place = block.find(b"\n")
            if place >= 0:
                return at + place + 1
            at += len(block)
        return limit

    def read(self, part):
        """Record batches of the lines that begin in a range of a file."""
        limit = part.limit
        with self.open(part.file) as file:
            at = part.start
            if not part.whole_lines:
                # A line that began before belongs to the part before: go on behind its end.
                at = self._next_line(file, at - 1, limit)
            file.seek(at)
            positions, values = [], []
            while at < part.end:
                block = file.read(min(16 * BLOCK, limit - at))
                while b"\n" not in block and at + len(block) < limit:
                    block += file.read(min(16 * BLOCK, limit - at - len(block)))
                last = block.rfind(b"\n") + 1
                for line in block[:last].split(b"\n")[:-1]:
                    if at >= part.end:
                        break
                    positions.append(at)
                    values.append(line.decode("utf-8", "replace"))
                    at += len(line) + 1
                file.seek(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.file] * len(values), pa.string()), pa.array(positions, pa.int64()),
                     pa.array(values, pa.string())], schema=SCHEMA)
                positions, values = [], []


def offsets_of(text, log, default):
    """Offsets from an option: `earliest`, `latest` or JSON of {file: bytes}."""
    text = text or default
    if text == "earliest":
        return {}
    return log.ends() if text == "latest" else {k: int(v) for k, v in json.loads(text).items()}


class _Ranged:
    """What both readers share. Built on the driver, read on the executors."""

    def __init__(self, options):
        self.path = options["path"]
        self.start = options.get("startingoffsets")
        self.end = options.get("endingoffsets")
        self.task_bytes = int(options.get("taskbytes", TASK_BYTES))

    def read(self, part):
        # Without any part Spark still runs one task.
        if part is not None:
            yield from Log(self.path).read(part)


class LogReader(_Ranged, DataSourceReader):
    def partitions(self):
        log = Log(self.path)
        start, end = offsets_of(self.start, log, "earliest"), offsets_of(self.end, log, "latest")
        return log.ranges(start, end, self.task_bytes)


class LogStream(_Ranged, DataSourceStreamReader):
    def initialOffset(self):
        return offsets_of(self.start, Log(self.path), "latest")

    def latestOffset(self):
        return Log(self.path).ends()

    def partitions(self, start, end):
        return Log(self.path).ranges(start, end, self.task_bytes)

    def commit(self, end):
        pass


class EventLog(DataSource):
    """Format `event_log`: file, position (of the line's first byte) and value of every event."""

    @classmethod
    def name(cls):
        return "event_log"

    def schema(self):
        return COLUMNS

    def reader(self, schema):
        return LogReader(self.options)

    def streamReader(self, schema):
        return LogStream(self.options)


def log_offsets(folder):
    """The offsets of a log now, as text for an option."""
    return json.dumps(Log(os.fspath(folder)).ends())


def event_log(spark, folder, offsets="latest"):
    """Stream of the log from `earliest`, `latest` or given offsets on."""
    spark.dataSource.register(EventLog)
    return spark.readStream.format("event_log").option("startingOffsets", offsets).load(folder)


def replay(spark, folder, start="earliest", end="latest"):
    """The events between two offsets, as a table."""
    spark.dataSource.register(EventLog)
    return spark.read.format("event_log").option("startingOffsets", start).option("endingOffsets", end).load(folder)

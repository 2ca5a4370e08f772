"""Fill-in-middle transformation by secondary sort.

A document is emitted as small pieces keyed by document and place in the output. Spark
shuffles the pieces by document and sorts each partition by (document, place), so a task
streams outputs piece by piece and never holds a whole one. What it reads it takes apart
again at the marks; a second sort inside the same partitions brings the parts into the
order of the text, and the rebuilt text is streamed once more.

Repartitioning by the document key with a sort inside the partitions is the DataFrame form
of `repartitionAndSortWithinPartitions`: one shuffle, sorted by Spark, spilled if large.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

from stayline.llm import texts as X

# The marks, and for each form the parts of its output in order. Part 0 of a
# text is its prefix, 1 the middle, 2 the suffix.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ORDER = {
    "plain": (),
    "psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)),
    "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)),
}
FORMS = ("plain", "psm", "spm")

FACTS = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.int32()),
         ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
FACT_COLUMNS = "doc_id long, n long, form int, prefix_chars long, middle_chars long"
PIECES = pa.schema([("key", pa.int64()), ("at", pa.int64()), *FACTS, ("piece", pa.binary())])
PIECE_COLUMNS = f"key long, at long, {FACT_COLUMNS}, piece binary"
PARTS = pa.schema([("key", pa.int64()), ("part", pa.int32()), ("at", pa.int64()), *FACTS,
                   ("output_sha256", pa.string()), ("piece", pa.binary())])
PART_COLUMNS = f"key long, part int, at long, {FACT_COLUMNS}, output_sha256 string, piece binary"
RESULT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
                    ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                    ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
RESULT_COLUMNS = ("doc_id long, n long, form string, prefix_chars long, middle_chars long,"
                  " output_sha256 string, restored_sha256 string")


def draws(doc_id, seed="1"):
    """Four numbers below 2^32 that depend on the document id and the seed only."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]


def plan(doc_id, text, seed="1", transformed=90, spm=20):
    """Form of a document's output, and the code points after which prefix and middle end.

    `transformed` percent of the documents are rearranged, `spm` percent of these with the
    suffix first. Empty texts and texts with a mark in them stay plain.
    """
    h1, h2, h3, h4 = draws(doc_id, seed)
    n = len(text)
    if not n or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= transformed:
        return "plain", None, None
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    return ("spm" if h4 % 100 < spm else "psm"), first, second


def output_parts(form, text, first, second):
    """The (mark, part of the text) pairs that make up the output, in order."""
    if form == "plain":
        return [("", text)]
    parts = (text[:first], text[first:second], text[second:])
    return [(mark, parts[part]) for mark, part in ORDER[form]]


class Sink:
    """Rows collected into record batches of bounded size."""

    def __init__(self, schema, rows=1024, size=1 << 20):
        self.schema, self.rows, self.size = schema, rows, size
        self.held, self.bytes = [], 0

    def add(self, row, size=0):
        self.held.append(row)
        self.bytes += size

    def full(self):
        return len(self.held) >= self.rows or self.bytes >= self.size

    def batch(self):
        columns = zip(*self.held)
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
        self.held, self.bytes = [], 0
        return out


def pieces(docs, chunk=1024, **choice):
    """Every document as the pieces of its output: key, at, facts of the document, piece.

    A piece has at most `chunk` units (code points) and a mark before the first of a part.
    `key` tells rows apart by their place in the scan, so repeated ids and repeated rows
    stay documents of their own and no id can gather the rows of others.
    """
    source = docs.select(
        F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"))

    def work(batches):
        sink = Sink(PIECES)
        for batch in X.slices(batches, limit=1 << 18):
            for key, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text = text or ""
                form, first, second = plan(doc_id, text, **choice)
                facts = (doc_id, len(text), FORMS.index(form), first, None if first is None else second - first)
                at = 0
                for mark, part in output_parts(form, text, first, second):
                    for start in range(0, max(1, len(part)), chunk):
                        piece = (mark if start == 0 else "") + part[start:start + chunk]
                        raw = piece.encode()
                        sink.add((key, at, *facts, raw), len(raw))
                        at += len(piece)
                        if sink.full():
                            yield sink.batch()
        if sink.held:
            yield sink.batch()

    return source.mapInArrow(work, PIECE_COLUMNS)


class Parts:
    """Takes an output apart as it streams by: (part, bytes) of what stands between the marks."""

    def __init__(self, form):
        self.marks = [(mark.encode(), part) for mark, part in ORDER[form]]
        self.part, self.rest = 0, b""

    def feed(self, piece):
        data, out = self.rest + piece, []
        while self.marks:
            mark, part = self.marks[0]
            i = data.find(mark)
            if i < 0:
                break
            out.append((self.part, data[:i]))
            data, self.part = data[i + len(mark):], part
            del self.marks[0]
        # The start of a mark may end a piece.
        held = max((k for k in (1, 2) if self.marks and data.endswith(self.marks[0][0][:k])), default=0)
        self.rest = data[len(data) - held:]
        out.append((self.part, data[:len(data) - held]))
        return [x for x in out if x[1]]

    def end(self):
        return [(self.part, self.rest)] if self.rest else []


def rows_of(batches, rows=512):
    """The rows of record batches as tuples, a few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, rows).columns))


def assemble(batches):
    """Sorted pieces to digests of the outputs and to parts of the texts."""
    sink = Sink(PARTS)
    now = digest = reader = facts = None
    at = 0

    def put(found):
        nonlocal at
        for part, raw in found:
            sink.add((now, part, at, *facts, None, raw), len(raw))
            at += 1

    for key, _, *rest, piece in rows_of(batches):
        if key != now:
            if now is not None:
                put(reader.end())
                sink.add((now, 3, 0, *facts, digest.hexdigest(), b""))
            now, facts, at = key, rest, 0
            digest, reader = hashlib.sha256(), Parts(FORMS[rest[2]])
        digest.update(piece)
        put(reader.feed(piece))
        if sink.full():
            yield sink.batch()
    if now is not None:
        put(reader.end())
        sink.add((now, 3, 0, *facts, digest.hexdigest(), b""))
        yield sink.batch()


def restore(batches):
    """Parts in the order of the text to digests of the rebuilt texts."""
    sink = Sink(RESULT)
    digest = hashlib.sha256()
    for _, part, _, doc_id, n, form, prefix, middle, output, piece in rows_of(batches):
        if part < 3:
            digest.update(piece)
            continue
        sink.add((doc_id, n, FORMS[form], prefix, middle, output, digest.hexdigest()))
        digest = hashlib.sha256()
        if sink.full():
            yield sink.batch()
    if sink.held:
        yield sink.batch()


def fill_in_middle(docs, chunk=1024, **choice):
    """Form, cuts and digests of every document's output and of the text rebuilt from it.

    Columns: doc_id, n (code points), form, prefix_chars, middle_chars (null if plain),
    output_sha256, restored_sha256. A null text is empty; an empty text is plain. A null
    doc_id draws from the seed alone. Repeated rows are documents of their own; an empty
    table gives none; other columns are ignored. Texts of any length pass as pieces.
    """
    found = pieces(docs, chunk, **choice).repartition("key").sortWithinPartitions("key", "at")
    parts = found.mapInArrow(assemble, PART_COLUMNS).sortWithinPartitions("key", "part", "at")
    return parts.mapInArrow(restore, RESULT_COLUMNS)


def training_texts(docs, **choice):
    """doc_id, form and the whole output text of every document, in one scan."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("form", pa.string()), ("output", pa.string())])

    def work(batches):
        for batch in X.slices(batches, limit=1 << 20):
            rows = []
            for doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(2))):
                text = text or ""
                form, first, second = plan(doc_id, text, **choice)
                rows.append((doc_id, form, "".join(m + p for m, p in output_parts(form, text, first, second))))
            ids, forms, outputs = zip(*rows)
            yield X.batch_of(schema, doc_id=ids, form=forms, output=outputs)

    return source.mapInArrow(work, "doc_id long, form string, output string")

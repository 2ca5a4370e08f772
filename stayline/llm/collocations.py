"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are runs of `longest - 1` words, edges runs of `longest` words between overlapping
nodes, weighted by how often they occur. Only edges and the ends of pieces are counted in
the texts. The count of a shorter phrase is what flows out of its node plus the pieces that
end in it, level by level down to single words. Every level is one shuffle of packed
counts, dealt by the hash of the whole phrase, so no word or node gathers in one task.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayline.llm import texts as X
from stayline.session import checkpointed, scratch_path

# What separates pieces, and what separates words besides.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"

_BREAK = np.zeros(256, np.int64)
_BREAK[list(BREAKS)] = 1
_GAP = _BREAK.astype(bool)
_GAP[list(BLANKS)] = True

#: One packed table of counts: the words' keys, the phrases as places in them, the counts.
PACKED = pa.schema([
    ("bucket", pa.int32()), ("width", pa.int32()), ("done", pa.bool_()),
    ("words", pa.binary()), ("grams", pa.binary()), ("counts", pa.binary())])
PACKED_COLUMNS = "bucket int, width int, done boolean, words binary, grams binary, counts binary"
LONG_WORD = 1 << 16
SPELLED = pa.struct([("key", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])


def language_key(lang):
    """64-bit key of a language; words of different languages have different keys."""
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def word_places(raw):
    """Starts and ends of the words of lower-cased bytes, and the piece breaks before each start."""
    buffer = np.frombuffer(raw, np.uint8)
    gap = np.concatenate([[True], _GAP[buffer], [True]])
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    breaks = np.concatenate([[0], np.cumsum(_BREAK[buffer])])
    return buffer, starts, ends, breaks


def word_keys(raw, buffer, starts, ends, salt):
    """64-bit key of each word under a language key."""
    if len(starts) == 1 and ends[0] - starts[0] > LONG_WORD:
        out = np.zeros(1, np.uint64)
    else:
        out = X.Rolling(X.byte_values(buffer))(starts, ends)
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        out[i] = int.from_bytes(hashlib.blake2b(raw[starts[i]:ends[i]], digest_size=8).digest(), "little")
    return X.mixed(out ^ salt)


def chunks(text, size=1 << 18):
    """Ranges of a lower-cased text that end at a gap, each of about `size` bytes."""
    start = 0
    while start < len(text):
        end = min(len(text), start + size)
        while end < len(text) and not _GAP[text[end]]:
            end += 1
        yield text[start:end]
        start = end


def words_of(batches, size=1 << 18):
    """(languages, text of each word, keys, pieces, raw, starts, ends) of some texts at a time.

    Short texts go together; a long one is cut at gaps. `pieces` number the pieces, and a
    number goes on where a long text was cut inside a piece.
    """
    piece = 0
    for batch in batches:
        for part in X.slices([batch], limit=size):
            langs = [lang if lang is not None else "und" for lang in part.column("lang").to_pylist()]
            texts = [(t or b"").lower() for t in part.column("text").to_pylist()]
            runs = [(langs, [b"\n".join(texts)], [len(t) + 1 for t in texts])]
            if len(texts) == 1 and len(texts[0]) > 2 * size:
                runs = [(langs, chunks(texts[0], size), [len(texts[0]) + 1])]
            for own, raws, lengths in runs:
                piece += 1
                for raw in raws:
                    buffer, starts, ends, breaks = word_places(raw)
                    text = np.zeros(len(starts), np.int64)
                    if len(own) > 1:
                        text = np.searchsorted(np.cumsum(lengths), starts, "right")
                    salts = np.array([language_key(x) for x in own], np.uint64)[text]
                    yield own, text, word_keys(raw, buffer, starts, ends, salts), piece + breaks[starts], raw, starts, ends
                    piece += int(breaks[-1])


def summed(ids, counts):
    """Distinct rows of `ids` (columns of equal length, each below 2^32) with summed counts."""
    if not len(counts):
        return ids, counts
    bits = max(1, int(max(x.max() for x in ids)).bit_length())
    if bits * len(ids) <= 63:
        key = ids[0].astype(np.int64)
        for x in ids[1:]:
            key = (key << bits) | x
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
    else:
        order = np.lexsort(ids[::-1])
        new = np.zeros(len(counts), bool)
        new[0] = True
        for x in ids:
            new[1:] |= x[order][1:] != x[order][:-1]
    first = np.flatnonzero(new)
    return [x[order[first]] for x in ids], np.add.reduceat(counts[order], first)


def batch_of_rows(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), PACKED)], schema=PACKED)


def row_of(bucket, vocabulary, ids, counts, done=False):
    """One packed row."""
    used, place = np.unique(np.concatenate(ids), return_inverse=True)
    place = place.astype("<u2" if len(used) <= 1 << 16 else "<u4").reshape(len(ids), -1)
    # First words rise, and so do keys: steps and byte planes are what the shuffle compresses well.
    place[0, 1:] = np.diff(place[0])
    most = int(counts.max())
    kind = "<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<i8"
    planes = vocabulary[used].astype("<u8").view(np.uint8).reshape(-1, 8).T
    return int(bucket), len(ids), done, planes.tobytes(), place.tobytes(), counts.astype(kind).tobytes()


def dealt(vocabulary, ids, counts, buckets):
    """Packed rows of the counts, one for each bucket; buckets go by the whole phrase."""
    if not len(counts):
        return
    mix = vocabulary[ids[0]]
    for x in ids[1:]:
        mix = X.mixed(mix * np.uint64(X.BASE) + vocabulary[x])
    bucket = (X.mixed(mix) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for own in np.split(order, cuts):
        yield row_of(bucket[own[0]], vocabulary, [x[own] for x in ids], counts[own])


def batches_of(rows, most=32):
    """Record batches of packed rows."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield batch_of_rows(held)
            held = []
    if held:
        yield batch_of_rows(held)


def unpacked(words, grams, counts, width):
    """Word keys, places in them and counts of one packed row."""
    keys = np.ascontiguousarray(np.frombuffer(words, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)
    ids = np.frombuffer(grams, "<u2" if len(keys) <= 1 << 16 else "<u4").reshape(width, -1).astype(np.uint32)
    ids[0] = np.cumsum(ids[0])
    n = ids.shape[1]
    kind = {1: "<u1", 2: "<u2", 8: "<i8"}[len(counts) // n]
    return keys, ids, np.frombuffer(counts, kind).astype(np.int64)


class Block:
    """Words of consecutive pieces, until their graph is emitted.

    The last words stay for the next block, so that no edge is lost where blocks meet.
    """

    def __init__(self, longest, buckets):
        self.longest, self.buckets = longest, buckets
        self.keys, self.pieces, self.size, self.old = [], [], 0, 0

    def add(self, keys, pieces):
        self.keys.append(keys)
        self.pieces.append(pieces)
        self.size += len(keys)

    def graph(self, last):
        """Edges of the block as packed rows dealt by phrase, and its piece ends, one row a width."""
        keys, pieces, old, longest = np.concatenate(self.keys), np.concatenate(self.pieces), self.old, self.longest
        n = len(keys)
        vocabulary, ids = np.unique(keys, return_inverse=True)
        ids = ids.astype(np.int32)
        start = np.arange(max(0, old - longest + 1), n - longest + 1)
        edge = start[pieces[start] == pieces[start + longest - 1]]
        columns, counts = summed([ids[edge + k] for k in range(longest)], np.ones(len(edge), np.int64))
        yield from dealt(vocabulary, columns, counts, self.buckets)
        # An end is known once the next word is: that of the last word waits for the next block.
        end = np.arange(max(0, old - 1), n if last else n - 1)
        final = np.ones(len(end), bool)
        inner = end + 1 < n
        final[inner] = pieces[end[inner]] != pieces[end[inner] + 1]
        end = end[final]
        for width in range(1, longest):
            own = end[end - width + 1 >= 0]
            own = own[pieces[own - width + 1] == pieces[own]]
            if len(own):
                columns, counts = summed([ids[own - width + 1 + k] for k in range(width)], np.ones(len(own), np.int64))
                # Ends are only carried to the level of their width, so any bucket will do.
                yield row_of(X.mixed(keys[own[:1]])[0] % np.uint64(self.buckets), vocabulary, columns, counts)
        kept = min(n, longest - 1)
        self.keys, self.pieces, self.size, self.old = [keys[n - kept:]], [pieces[n - kept:]], kept, kept


def edges(docs, longest, buckets, words=600_000):
    """Packed counts of the edges and of the piece ends, one table a block of about `words` words."""
    source = docs.select("lang", F.col("text").cast("binary").alias("text"))

    def work(batches):
        block = Block(longest, buckets)
        for _, _, keys, pieces, *_ in words_of(batches):
            for start in range(0, len(keys), words):
                block.add(keys[start:start + words], pieces[start:start + words])
                if block.size >= words:
                    yield from batches_of(block.graph(last=False))
        if block.size:
            yield from batches_of(block.graph(last=True))

    return source.mapInArrow(work, PACKED_COLUMNS)


def merged(tables):
    """Vocabulary, places and counts of several tables of one width, equal phrases summed."""
    vocabulary, place = np.unique(np.concatenate([t[0] for t in tables]), return_inverse=True)
    place = place.astype(np.uint32)
    shift = np.cumsum([0, *[len(t[0]) for t in tables]])
    width = len(tables[0][1])
    ids = [np.concatenate([place[s:][t[1][k]] for t, s in zip(tables, shift)]) for k in range(width)]
    return vocabulary, *summed(ids, np.concatenate([t[2] for t in tables]))


def flow(table, width, buckets, least):
    """One level down: phrases of `width` words are summed, and flow into their nodes.

    Phrases found `least` times or more go on as results. What flows into a node meets the
    pieces that end in it. `buckets` are those of the next level.
    """

    def work(group):
        columns = [group.column(c) for c in PACKED.names[1:]]
        bucket = group.column("bucket")[0].as_py() % buckets
        own, ends, rows = [], [], []
        for w, done, words, grams, counts in zip(*(c.to_pylist() for c in columns)):
            if done or w < width - 1:
                rows.append((bucket, w, done, words, grams, counts))
            else:
                (own if w == width else ends).append(unpacked(words, grams, counts, w))
        if own:
            vocabulary, ids, counts = merged(own)
            often = counts >= least
            if often.any():
                rows.append(row_of(bucket, vocabulary, [x[often] for x in ids], counts[often], done=True))
            if width > 1:
                ends.append((vocabulary, *summed(ids[:-1], counts)))
        del own
        out = list(batches_of(rows))
        if ends:
            out += batches_of(dealt(*merged(ends), buckets))
        return pa.Table.from_batches(out, PACKED)

    return table.groupBy("bucket").applyInArrow(work, PACKED_COLUMNS)


def phrase_counts(docs, longest=3, least=10, buckets=None):
    """Counts of all phrases of up to `longest` words found `least` times or more.

    Columns: width, words (array of word keys), a. One shuffle a level; a task holds the
    counts of one bucket. Without `buckets` there are twice as many for the edges as
    `spark.sql.shuffle.partitions`, and half as many for each level below.
    """
    buckets = buckets or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = edges(docs, longest, buckets)
    for width in range(longest, 0, -1):
        buckets = max(1, buckets // 2)
        table = flow(table, width, buckets, least)
    # Written first, so that no task needs two Python workers at once.
    path = scratch_path(docs.sparkSession, "phrase-tables")
    table.where("done").drop("bucket", "done").write.parquet(path)
    schema = pa.schema([("width", pa.int32()), ("words", pa.list_(pa.int64())), ("a", pa.int64())])

    def rows(batches):
        for batch in batches:
            for width, words, grams, counts in zip(*(batch.column(c).to_pylist() for c in ("width", "words", "grams", "counts"))):
                keys, ids, a = unpacked(words, grams, counts, width)
                flat = keys.view(np.int64)[ids.T.reshape(-1)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width), pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([pa.array([width] * len(a), pa.int32()), lists, pa.array(a)], schema=schema)

    return docs.sparkSession.read.parquet(path).mapInArrow(rows, "width int, words array<long>, a long")


def spelled(docs, wanted, bits=24):
    """Language and text of the wanted word keys, and the number of words of each language.

    Columns: key, lang, word, n. Rows with a null key hold the n words of their language.
    `wanted` (key) passes a filter of 2^bits bits on its way to the tasks, so what the
    driver gets and broadcasts has a fixed size (2 MB); the exact join follows.
    """
    spark = docs.sparkSession
    place = F.pmod("key", F.lit(1 << bits))
    marked = wanted.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit")).groupBy(
        "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow()
    places = np.zeros(1 << bits >> 6, np.int64)
    places[marked.column("word").to_numpy()] = marked.column("bits").to_numpy()
    shared = spark.sparkContext.broadcast(places)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select("lang", F.col("text").cast("binary").alias("text"))
    packed = pa.schema([("bucket", pa.int32()), ("rows", pa.list_(SPELLED))])

    def rows(found, n):
        """Rows by bucket, the words of a task as lists."""
        out = {}
        for key, (lang, word) in found.items():
            out.setdefault(key % buckets, []).append({"key": key, "lang": lang, "word": word, "n": None})
        for lang, count in n.items():
            out.setdefault(0, []).append({"key": None, "lang": lang, "word": None, "n": count})
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(out), pa.int32()), pa.array(list(out.values()), packed.field("rows").type)], schema=packed)

    def work(batches):
        wanted, found, n = shared.value, {}, {}
        for langs, text, keys, _, raw, starts, ends in words_of(batches):
            for i, count in enumerate(np.bincount(text, minlength=len(langs)).tolist()):
                n[langs[i]] = n.get(langs[i], 0) + count
            own, first = np.unique(keys.view(np.int64), return_index=True)
            place = own % (1 << bits)
            hit = (wanted[place >> 6] >> (place & 63)) & 1 == 1
            for key, i in zip(own[hit].tolist(), first[hit].tolist()):
                if key not in found:
                    found[key] = langs[text[i]], raw[starts[i]:ends[i]].decode()
            if len(found) > 1 << 18:
                yield from rows(found, n)
                found, n = {}, {}
        yield from rows(found, n)

    def once(group):
        words, n = {}, {}
        for own in group.column("rows").to_pylist():
            for row in own:
                if row["key"] is None:
                    n[row["lang"]] = n.get(row["lang"], 0) + row["n"]
                else:
                    words[row["key"]] = row
        counted = [{"key": None, "lang": lang, "word": None, "n": count} for lang, count in n.items()]
        return pa.Table.from_struct_array(pa.array([*words.values(), *counted], SPELLED))

    kind = "struct<key: long, lang: string, word: string, n: long>"
    return source.mapInArrow(work, f"bucket int, rows array<{kind}>").groupBy("bucket").applyInArrow(
        once, "key long, lang string, word string, n long")


def unary_paths(edges, longest):
    """Compacts the graph: edges that meet in a node without another edge are one path.

    `edges` has words (array of `longest` word keys). Gives edge (hash of its words) and
    path_words, the number of words of its compacted path, for edges in a path of several;
    null for rings, which have no end. Pointers double each round, so a path of n edges
    takes log2(n) rounds.
    """
    edges = edges.select(
        F.xxhash64("words").alias("edge"), F.xxhash64(F.slice("words", 1, longest - 1)).alias("source"),
        F.xxhash64(F.slice("words", 2, longest - 1)).alias("target"))
    out = edges.groupBy(F.col("source").alias("node")).agg(F.count("*").alias("outs"), F.first("edge").alias("end"))
    into = edges.groupBy(F.col("target").alias("node")).agg(F.count("*").alias("ins"), F.first("edge").alias("edge"))
    inner = checkpointed(out.join(into, "node").where("outs = 1 and ins = 1").select("edge", "end"))
    more = inner.select(F.col("edge").alias("end"), F.lit(True).alias("open"))
    jump = checkpointed(inner.join(more, "end", "left").select(
        "edge", "end", F.lit(1).cast("long").alias("steps"), F.coalesce("open", F.lit(False)).alias("open")))
    waiting = jump.where("open").count()
    while waiting:
        ahead = jump.select(F.col("edge").alias("end"), F.col("end").alias("far"), F.col("steps").alias("more"), F.col("open").alias("still"))
        moved = jump.where("open").join(ahead, "end").select(
            "edge", F.col("far").alias("end"), (F.col("steps") + F.col("more")).alias("steps"), F.col("still").alias("open"))
        jump = checkpointed(jump.where("not open").unionByName(moved))
        before, waiting = waiting, jump.where("open").count()
        if waiting == before:
            break
    length = jump.where("not open").groupBy("end").agg((F.max("steps") + longest).alias("path_words"))
    inside = jump.where("not open").select("edge", "end").unionByName(length.select(F.col("end").alias("edge"), "end"))
    rings = jump.where("open").select("edge", F.lit(None).cast("long").alias("path_words"))
    return inside.join(length, "end").select("edge", "path_words").unionByName(rings)


def chosen_cut(lefts, rights, a):
    """Score and counts of the lowest-scoring cut: struct score, k, l, r; ties to the smallest k.

    Counts below 10^13 keep every product within 38 digits.
    """
    whole = lambda x: x.cast("decimal(13,0)")
    cuts = F.transform(F.sequence(F.lit(1), F.size(lefts)), lambda k: F.struct(
        F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * whole(a) * whole(a),
                        whole(F.element_at(lefts, k)) * whole(F.element_at(rights, F.size(lefts) + 1 - k))).alias("score"),
        k.alias("k"), F.element_at(lefts, k).alias("l"), F.element_at(rights, F.size(lefts) + 1 - k).alias("r")))
    return F.array_min(cuts)


def scored(grams, words, longest):
    """Candidates of two words and more with their language, text and counts of all parts.

    A phrase is put together from its two longest parts, so each width takes two joins.
    `lefts` are the counts of its first 1, 2, ... words, `rights` those of its last ones.
    """
    part = grams.where("width = 1").select(
        F.col("words")[0].alias("key"), F.col("a")).join(words.where("key is not null").drop("n"), "key").select(
        F.array("key").alias("words"), "lang", F.array("word").alias("phrase"), "a",
        F.array().cast("array<bigint>").alias("lefts"), F.array().cast("array<bigint>").alias("rights"))
    out = []
    for width in range(2, longest + 1):
        first = part.select(F.col("words").alias("head"), "lang", F.col("phrase").alias("start"),
                            F.concat("lefts", F.array("a")).alias("lefts"))
        second = part.select(F.col("words").alias("tail"), F.element_at("phrase", -1).alias("end"),
                             F.concat("rights", F.array("a")).alias("rights"))
        own = grams.where(F.col("width") == width).select(
            "words", "a", F.slice("words", 1, width - 1).alias("head"), F.slice("words", 2, width - 1).alias("tail"))
        part = own.join(first, "head").join(second, "tail").select(
            "words", "lang", F.concat("start", F.array("end")).alias("phrase"), "a", "lefts", "rights")
        path = scratch_path(grams.sparkSession, f"phrases-{width}")
        part.write.parquet(path)
        part = grams.sparkSession.read.parquet(path)
        out.append(part)
    return out


def collocations(docs, longest=3, least=10, share=50, top=2000, buckets=None):
    """The `top` phrases of each language by the strength of their weakest cut.

    `docs` has text and lang (null: `und`); a null or empty text has no words. A-Z count as
    a-z; pieces end at `[.,;:!?\\x0A-\\x0D]`, words are `[^\\x20\\x09]+` in a piece. Candidates
    have 2 to `longest` words and a count of `least` or more. One that lies inside a longer
    candidate with at least `share` percent of its count goes. Score: the lowest
    floor(1000000 a a / (l r)) over the cuts, ties to the first. Order: score, count (both
    falling), phrase in byte order, so ranks have no ties.

    Columns: lang, rank, phrase, a, l, r, n (words of the language), score, k (words before
    the cut), path_words (words of the compacted path through a longest phrase, null for
    shorter phrases and rings). An empty table gives no rows; repeated rows count each;
    other columns are ignored. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "phrase-counts")
    phrase_counts(docs, longest, least, buckets).write.parquet(path)
    grams = spark.read.parquet(path)
    path = scratch_path(spark, "phrase-words")
    wanted = grams.where("width = 2").select(F.explode("words").alias("key")).distinct()
    spelled(docs, wanted).write.parquet(path)
    words = spark.read.parquet(path)
    tables = scored(grams, words, longest)
    found = []
    for width, part in enumerate(tables, 2):
        if width < longest:
            longer = tables[width - 1]
            inside = longer.select(F.slice("words", 1, width).alias("words"), "a").unionByName(
                longer.select(F.slice("words", 2, width).alias("words"), "a")).groupBy("words").agg(F.max("a").alias("most"))
            part = part.join(inside, "words", "left").where(
                F.col("most").isNull() | (F.lit(100) * F.col("most") < F.lit(share) * F.col("a")))
            part = part.drop("most").withColumn("edge", F.lit(None).cast("long"))
        else:
            part = part.withColumn("edge", F.xxhash64("words"))
        found.append(part.withColumn("cut", chosen_cut(F.col("lefts"), F.col("rights"), F.col("a"))).select(
            "lang", F.concat_ws(" ", "phrase").alias("phrase"), "a", "cut.l", "cut.r", "cut.score", "cut.k", "edge"))
    rows = found[0]
    for part in found[1:]:
        rows = rows.unionByName(part)
    # The best of each slice first, so that no task sorts all phrases of a language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slices = F.pmod(F.xxhash64("phrase"), F.lit(32))
    rows = rows.withColumn("place", F.row_number().over(W.partitionBy("lang", slices).orderBy(*order))).where(
        F.col("place") <= top)
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(
        F.col("rank") <= top)
    totals = words.where("key is null").select("lang", "n")
    lengths = unary_paths(tables[-1].select("words"), longest)
    rows = rows.join(totals, "lang").join(lengths, "edge", "left")
    return rows.select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score", F.col("k").cast("long").alias("k"),
        "path_words")

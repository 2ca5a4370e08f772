"""Hidden Markov language model over word classes, trained by Baum-Welch.

States emit word classes; a class emits its words by their smoothed counts. A frequent
word is a class of its own, all other words share a fixed number of hashed classes, so
the model is small while word counts cover the whole corpus:
p(text) = p(classes of its tokens | states) * product of p(word | its class).
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F

from stayline.llm import texts as X
from stayline.session import scratch_path

BLOCKS = pa.schema([
    ("block", pa.int64()), ("hashes", pa.list_(pa.int64())), ("seen", pa.list_(pa.int32())),
    ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("bounds", pa.list_(pa.int64())),
    ("ids", pa.binary()),
])
BLOCK_COLUMNS = (
    "block long, hashes array<long>, seen array<int>, doc_ids array<long>, held array<boolean>,"
    " bounds array<long>, ids binary"
)
SEQUENCES = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("base_score", pa.float64()), ("within", pa.float64()),
    ("classes", pa.binary()),
])
SEQUENCE_COLUMNS = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double,"
    " within double, classes binary"
)
#: Expected counts are summed as integers of this unit, so that no order of sums matters.
UNIT = 4096


def encoded(docs, held, words=2_000_000):
    """One row for each block of documents: its distinct words, their training counts, and
    every document as places in that word list."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held"),
        F.col("text").cast("binary").alias("text"))

    def rows(batches):
        """(ids, held, hashes of all words, words of each) of about `words` words at a time."""
        ids, held, hashes, size = [], [], [], []
        for batch in X.slices(batches):
            found = X.Words(batch.column("text").to_pylist())
            ids += batch.column("doc_id").to_pylist()
            held += batch.column("held").to_pylist()
            hashes.append(found.hashes(lower=True))
            size.append(np.diff(found.bounds))
            if sum(map(len, hashes)) > words:
                yield ids, held, np.concatenate(hashes), np.concatenate(size)
                ids, held, hashes, size = [], [], [], []
        if ids:
            yield ids, held, np.concatenate(hashes), np.concatenate(size)

    def work(batches):
        block = TaskContext.get().partitionId() << 33
        for ids, held, found, size in rows(batches):
            hashes, place = np.unique(found, return_inverse=True)
            trained = ~np.repeat(np.array(held, bool), size)
            yield X.batch_of(
                BLOCKS, block=[block], hashes=[hashes.view(np.int64)],
                seen=[np.bincount(place[trained], minlength=len(hashes)).astype(np.int32)],
                doc_ids=[ids], held=[held], bounds=[np.concatenate([[0], np.cumsum(size)])],
                ids=[place.astype("<i4").tobytes()])
            block += 1

    return source.mapInArrow(work, BLOCK_COLUMNS)


class Lexicon:
    """Word classes and their totals; its size depends on the parameters only."""

    def __init__(self, counts, ends, head, buckets):
        known = counts.where("c > 0")
        top = known.orderBy(F.desc("c"), "hash").limit(head).collect()
        self.head = np.array(sorted(r["hash"] for r in top), np.int64)
        self.buckets = buckets
        self.total = np.zeros(1 + len(top) + buckets)
        self.kinds = np.zeros(1 + len(top) + buckets)
        self.total[0], self.kinds[0] = ends, float(ends > 0)
        for r in top:
            k = 1 + np.searchsorted(self.head, r["hash"])
            self.total[k], self.kinds[k] = r["c"], 1
        self.n, self.v = ends, int(ends > 0)
        rows = known.groupBy(F.pmod("hash", F.lit(buckets)).alias("k")).agg(
            F.sum("c").alias("c"), F.count("*").alias("v")).collect()
        for r in rows:
            self.n, self.v = self.n + r["c"], self.v + r["v"]
            self.total[1 + len(top) + r["k"]], self.kinds[1 + len(top) + r["k"]] = r["c"], r["v"]
        for r in top:
            k = 1 + len(top) + r["hash"] % buckets
            self.total[k], self.kinds[k] = self.total[k] - r["c"], self.kinds[k] - 1

    def classes(self, hashes):
        """Class of each word, and whether it is a class of its own."""
        place = np.minimum(np.searchsorted(self.head, hashes), max(0, len(self.head) - 1))
        own = self.head[place] == hashes if len(self.head) else np.zeros(len(hashes), bool)
        return np.where(own, 1 + place, 1 + len(self.head) + hashes % self.buckets), own

    def base(self, count):
        return np.log10((count + 0.1) / (self.n + 0.1 * (self.v + 1)))

    def within(self, count, classes, own):
        """log10 of a word's probability in its class."""
        share = (count + 0.1) / (self.total[classes] + 0.1 * (self.kinds[classes] + 1))
        return np.where(own, 0.0, np.log10(share))


def sequences(blocks, counts, ends, lexicon):
    """Every document as a sequence of classes, with its scores that need no states."""
    words = blocks.select("block", F.posexplode("hashes").alias("place", "hash"))
    found = words.join(counts, "hash").groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("place", "c"))).alias("found"))
    rows = blocks.join(found.select(F.col("block").alias("block2"), F.col("found.c").alias("counts")),
                       F.col("block") == F.col("block2"), "left")
    rows = rows.select("hashes", "counts", "doc_ids", "held", "bounds", "ids")

    def numbers(column, i):
        return column[i].values.to_numpy(zero_copy_only=False) if column[i].is_valid else np.zeros(0, np.int64)

    def work(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                hashes, count = numbers(batch.column("hashes"), i), numbers(batch.column("counts"), i)
                kind, own = lexicon.classes(hashes)
                ids = np.frombuffer(batch.column("ids")[i].as_py(), "<i4")
                bounds = numbers(batch.column("bounds"), i)
                n = len(bounds) - 1
                text = np.repeat(np.arange(n), np.diff(bounds))
                total = lambda x: np.bincount(text, weights=x[ids], minlength=n)
                kinds = kind[ids].astype("<i2")
                yield X.batch_of(
                    SEQUENCES, doc_id=batch.column("doc_ids")[i].values,
                    held_out=batch.column("held")[i].values, n_tokens=np.diff(bounds) + 1,
                    n_known=total((count > 0).astype(float)).astype(np.int64) + int(ends > 0),
                    base_score=total(lexicon.base(count)) + lexicon.base(ends),
                    within=total(lexicon.within(count, kind, own)),
                    classes=[np.append(kinds[a:b], np.int16(0)).astype("<i2").tobytes()
                             for a, b in zip(bounds[:-1], bounds[1:])])

    return rows.mapInArrow(work, SEQUENCE_COLUMNS)


class Chains:
    """Several class sequences side by side, the longest first, one step at a time."""

    def __init__(self, rows):
        self.order = np.argsort([-len(r) for r in rows], kind="stable")
        length = np.array([len(rows[i]) for i in self.order])
        self.active = np.searchsorted(-length, -np.arange(length[0]), side="left")
        self.start = np.concatenate([[0], np.cumsum(self.active)])
        text = np.repeat(np.arange(len(rows)), length)
        step = np.arange(len(text)) - np.repeat(np.cumsum(length) - length, length)
        self.seen = np.empty(len(text), np.int64)
        self.seen[self.start[step] + text] = np.concatenate([rows[i] for i in self.order])

    def forward(self, model):
        """Scaled forward variables of every step, and the scales."""
        first, move, emit = model
        given = emit[self.seen]
        scale = np.empty(len(self.seen))
        for t, n in enumerate(self.active):
            now = given[self.start[t]:self.start[t] + n]
            now *= first if t == 0 else given[self.start[t - 1]:self.start[t - 1] + n] @ move
            own = scale[self.start[t]:self.start[t] + n]
            np.sum(now, axis=1, out=own)
            now /= own[:, None]
        return given, scale

    def scores(self, model):
        """log10 likelihood of each sequence, in the order given."""
        _, scale = self.forward(model)
        text = np.arange(len(self.seen)) - np.repeat(self.start[:-1], self.active)
        out = np.empty(len(self.order))
        out[self.order] = np.bincount(text, weights=np.log10(scale), minlength=len(self.order))
        return out

    def expected(self, model):
        """log10 likelihood of all sequences, and their expected first states, moves and emissions."""
        first, move, emit = model
        alpha, scale = self.forward(model)
        moves = np.zeros_like(move)
        beta = np.ones((self.active[-1], len(first)))
        gamma = np.empty_like(alpha)
        for t in range(len(self.active) - 1, -1, -1):
            n, at = self.active[t], self.start[t]
            if t + 1 < len(self.active):
                after, n2 = self.start[t + 1], self.active[t + 1]
                pull = emit[self.seen[after:after + n2]] * beta / scale[after:after + n2, None]
                moves += alpha[at:at + n2].T @ pull
                beta = np.ones((n, len(first)))
                beta[:n2] = pull @ move.T
            gamma[at:at + n] = alpha[at:at + n] * beta
        emitted = np.stack([np.bincount(self.seen, weights=g, minlength=len(emit)) for g in gamma.T])
        return np.log10(scale).sum(), gamma[:self.active[0]].sum(axis=0), moves * move, emitted


def batched(batches, tokens=400_000):
    """Rows of (batch, class sequences) of like length, about `tokens` tokens at a time.

    Sequences of like length keep a step of the recursion wide to its end.
    """
    for batch in batches:
        size = pc.binary_length(batch.column("classes")).to_numpy() // 2
        order = np.argsort(-size, kind="stable")
        part = np.cumsum(size[order], dtype=np.int64) // tokens
        for rows in np.split(order, np.flatnonzero(np.diff(part)) + 1):
            if len(rows):
                own = batch.take(pa.array(rows))
                yield own, [np.frombuffer(x, "<i2") for x in own.column("classes").to_pylist()]


def companions(rows, lexicon, top=64):
    """Counts of every class in the sequences that hold one of the `top` most frequent classes.

    Gives these classes and a matrix with a row for each; its size depends on the parameters only.
    """
    size = len(lexicon.total)
    common = np.argsort(-lexicon.total[1:], kind="stable")[:top] + 1

    def work(batches):
        total = np.zeros((len(common), size))
        for _, rows in batched(batches, tokens=60_000):
            # A dense row of counts for each text, so only so many texts at a time.
            for seqs in (rows[i:i + 500] for i in range(0, len(rows), 500)):
                text = np.repeat(np.arange(len(seqs)), [len(s) for s in seqs])
                seen = np.concatenate(seqs).astype(np.int64)
                counts = np.bincount(text * size + seen, minlength=len(seqs) * size).reshape(len(seqs), size)
                total += (counts[:, common] > 0).T.astype(np.float64) @ counts
        value = np.rint(total.ravel()).astype(np.int64)
        used = np.flatnonzero(value)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(value[used])], ["key", "n"])

    out = np.zeros(len(common) * size)
    source = rows.where("not held_out").select("classes")
    for r in source.mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect():
        out[r["key"]] = r["n"]
    return common, out.reshape(len(common), size)


def distinct_start(rows, lexicon, states, seed=7):
    """A model whose states differ: each gives more to the classes that keep company with its own
    frequent class. These classes are picked one by one, the next being the one whose company
    is least like that of those before. States are likely to stay."""
    usual = (lexicon.total + 0.1) / (lexicon.total + 0.1).sum()
    _, counts = companions(rows, lexicon)
    share = np.full((len(usual), states), 1 / states)
    profile = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))
    if len(counts):
        picked = [0]
        while len(picked) < min(states, len(counts)):
            picked.append(int((profile @ profile[picked].T).max(axis=1).argmin()))
        own = counts[picked].T + 0.01
        share[:, :len(picked)] = own / own.sum(axis=1, keepdims=True)
    draw = np.random.Generator(np.random.PCG64(seed))
    emit = usual[:, None] * (share + 0.02) * draw.uniform(0.9, 1.1, share.shape)
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return np.full(states, 1 / states), move, emit / emit.sum(axis=0)


def train(rows, lexicon, states=8, rounds=8, close=0.001, seed=7):
    """First-state, move and emission probabilities by Baum-Welch over all training rows.

    Each round is one pass over the data; every task sums the expected counts of its
    sequences and the sums of all tasks meet in one aggregation. Rounds end once the
    likelihood of the round's start is less than `close` (log10 a token) above that of the
    round before, or after `rounds`.
    """
    usual = (lexicon.total + 0.1) / (lexicon.total + 0.1).sum()
    size = len(usual)
    model = distinct_start(rows, lexicon, states, seed)
    source = rows.where("not held_out").select("classes")
    before = None
    for _ in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast(model)

        def work(batches, shared=shared):
            total = np.zeros(1 + states + states * states + states * size)
            for _, seqs in batched(batches):
                total += np.concatenate([np.ravel(x) for x in Chains(seqs).expected(shared.value)])
            value = np.rint(total * UNIT).astype(np.int64)
            used = np.flatnonzero(value)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(value[used])], ["key", "n"])

        sums = np.zeros(1 + states + states * states + states * size)
        for r in source.mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect():
            sums[r["key"]] = r["n"] / UNIT
        likelihood, first, move, emit = np.split(sums, [1, 1 + states, 1 + states + states * states])
        first, move, emit = first + 0.1, move.reshape(states, states) + 0.1, emit.reshape(states, size).T + usual[:, None]
        model = (first / first.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
        if before is not None and likelihood[0] - before < close * max(1, lexicon.n):
            break
        before = likelihood[0]
    return model


def scored(rows, model):
    """Exact log10 probability of every sequence by the scaled forward recursion."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    keep = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
    schema = pa.schema([*(SEQUENCES.field(c) for c in keep), ("score", pa.float64())])

    def work(batches):
        for batch, seqs in batched(batches):
            score = Chains(seqs).scores(shared.value)
            within = batch.column("within").to_numpy()
            yield X.batch_of(schema, **{c: batch.column(c) for c in keep}, score=score + within)

    return rows.mapInArrow(
        work, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def language_model(docs, held, states=8, rounds=8, head=1024, buckets=1024):
    """Scores of all documents by a model of those that `held` (a Column) doesn't hold out.

    Tokens are lower-cased words and one end. Returns doc_id, held_out, n_tokens, n_known
    (tokens seen in training), train_tokens, base_score (smoothed unigram) and score (the
    hidden Markov model), both log10. Words are told apart by 64-bit hashes.

    A null text is empty and has its end only. A null `held` counts as false. Repeated
    rows are trained on and scored each on its own; without training rows the counts are
    0 and the model stays at its start; an empty table gives an empty result. Columns
    beside doc_id and text are ignored.
    """
    if head + buckets > 32_000:
        raise ValueError("classes are stored in 16 bits")
    spark = docs.sparkSession

    def stored(df, name):
        path = scratch_path(spark, name)
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)

    blocks = stored(encoded(docs, held), "blocks")
    pairs = blocks.select(F.explode(F.arrays_zip("hashes", "seen")).alias("x")).select(
        F.col("x.hashes").alias("hash"), F.col("x.seen").alias("n"))
    counts = stored(pairs.groupBy("hash").agg(F.sum("n").alias("c")), "counts")
    ends = blocks.select(F.size(F.filter("held", lambda h: ~h)).alias("n")).agg(F.sum("n")).first()[0] or 0
    lexicon = Lexicon(counts, ends, head, buckets)
    rows = stored(sequences(blocks, counts, ends, lexicon), "sequences")
    return scored(rows, train(rows, lexicon, states, rounds)).withColumn(
        "train_tokens", F.lit(lexicon.n).cast("long"))

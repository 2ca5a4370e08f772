"""Operators with one right answer, against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stayline.llm import chat, decontam, fmindex, minhash, packing, repeats, suffixarray
from stayline.llm.queries import TOKENIZER

SCHEMA = "doc_id long, text string, row string, spans long, start long"


def frame(spark, rows):
    """Documents with columns whose names clash with those the operators use."""
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)


def patchwork(seed, symbols, n=90):
    """Texts glued from pieces of a few base texts; some null, empty or repeated."""
    draw = random.Random(seed)
    base = [[draw.choice(symbols) for _ in range(200)] for _ in range(4)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(draw.randrange(5)):
            at = draw.randrange(150)
            words += draw.choice(base)[at:at + draw.randrange(5, 50)]
        rows.append((None if i % 17 == 5 else i, None if i % 13 == 7 else " ".join(words)))
    return rows + [rows[0], rows[1], (500, ""), (501, " ".join(base[0]) * 3)]


def without_repeats(rows, split, join, width):
    seen = Counter()
    for _, text in rows:
        x = split(text)
        seen.update(tuple(x[k:k + width]) for k in range(len(x) - width + 1))
    out = []
    for doc, text in rows:
        x = split(text)
        gone = np.zeros(len(x), bool)
        for k in range(len(x) - width + 1):
            if seen[tuple(x[k:k + width])] > 1:
                gone[k:k + width] = True
        out.append(str((doc, len(x), int(gone.sum()), join([w for w, g in zip(x, gone) if not g]))))
    return sorted(out)


@pytest.mark.parametrize("classes", [6000, 3])
def test_substrings_equal_brute_force(spark, monkeypatch, classes):
    """With few classes a shard, frequent anchors are split and merged by digests."""
    start = repeats.Repeats.__init__
    monkeypatch.setattr(
        repeats.Repeats, "__init__",
        lambda self, *a: start(self, *a, shard_bytes=3000, shard_classes=classes))
    rows = patchwork(1, ["a", "b", "ccé", "d"])
    docs = frame(spark, rows)
    found = suffixarray.remove_repeats(docs, 30, 8).collect()
    assert sorted(str((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept))) for r in found) == without_repeats(
        rows, lambda t: (t or "").encode(), bytes, 30)
    passages = [str(eval(r)[::2]) for r in without_repeats(rows, lambda t: (t or "").split(), lambda words: 0, 9)]
    again = suffixarray.remove_repeats(docs, 30, 8, words=9).collect()
    assert sorted(str((r.doc_id, r.n_passage_words)) for r in again) == sorted(passages)
    found = fmindex.remove_repeats(docs, 12, 3).collect()
    assert sorted(str((r.doc_id, r.n_words, r.n_removed, bytes(r.kept))) for r in found) == without_repeats(
        rows, lambda t: (t or "").encode().split(), b" ".join, 12)


@pytest.mark.parametrize("slice_bytes", [40, 300])
def test_long_texts_are_read_in_parts(spark, monkeypatch, slice_bytes):
    """Texts of many parts, and words longer than a part, give what whole texts give."""
    from stayline.llm import texts

    monkeypatch.setattr(repeats, "SLICE", slice_bytes)
    parts = repeats.overlapping
    monkeypatch.setattr(suffixarray, "overlapping", lambda v, w, **k: parts(v, w, step=50, **k))
    monkeypatch.setattr(fmindex, "overlapping", lambda v, w, **k: parts(v, w, step=20, **k))
    rows = patchwork(5, ["a", "b", "ccé", "d"], 40) + [(700, "x " + "y" * 400 + " z"), (701, "q " + "y" * 400 + " z")]
    docs = frame(spark, rows)
    found = suffixarray.remove_repeats(docs, 30, 8).collect()
    assert sorted(str((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept))) for r in found) == without_repeats(
        rows, lambda t: (t or "").encode(), bytes, 30)
    found = fmindex.remove_repeats(docs, 12, 3).collect()
    assert sorted(str((r.doc_id, r.n_words, r.n_removed, bytes(r.kept))) for r in found) == without_repeats(
        rows, lambda t: (t or "").encode().split(), b" ".join, 12)
    text = b"a bb " + b"c" * 100 + b" d " + b"e" * 9
    for size in (3, 10, 64, 1000):
        assert texts.long_words(text, size).tolist() == texts.Words([text]).hashes().tolist()


def test_frequent_keys_are_dealt_over_parts(spark):
    df = spark.createDataFrame([(1, i) for i in range(900)] + [(2, i) for i in range(5)] + [(3, 0)], "k int, v int")
    counts = df.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    found = repeats.spread(df, counts, ["k"], ["v"], share=0.1, least=10)
    assert found.columns == df.columns and sorted(map(tuple, found.collect())) == sorted(map(tuple, df.where("k < 3").collect()))


def test_neighbouring_quotations_stay(spark):
    """Thirty words of one document and thirty of another are no passage of over 50 words."""
    draw = random.Random(9)
    words = lambda n: " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(n))
    first, second = words(120), words(120)
    quoted = " ".join(first.split()[20:50] + second.split()[60:90])
    rows = [(1, first), (2, second), (3, f"{words(20)} {quoted} {words(20)}")]
    out = {r.doc_id: r.text for r in suffixarray.without_repeats(frame(spark, rows)).collect()}
    assert out == dict(rows)
    shared = " ".join(first.split()[20:71])
    rows[2] = (3, f"start {shared} end")
    out = {r.doc_id: r.text for r in suffixarray.without_repeats(frame(spark, rows)).collect()}
    assert out[3] == "start  end" and len(out[1].split()) == 69 and out[2] == second


def test_odd_column_names(spark):
    names = ["doc_id", "text", "a b", "c.d", "e`f"]
    rows = [(1, "some words of a text", 1, 2, 3), (1, "some words of a text", 1, 2, 3), (2, None, 4, 5, 6)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "x", "y", "z"]).toDF(*names[:4], "e_f")
    assert sorted(map(tuple, minhash.one_of_each(docs).collect()), key=str) == sorted(set(rows), key=str)
    out = suffixarray.without_repeats(docs, 400, 32)
    assert out.columns == docs.columns and out.count() == 3
    benchmark = spark.createDataFrame([(1, "another text entirely of a benchmark")], "item_id long, text string")
    assert decontam.decontaminated(docs, benchmark).columns == docs.columns


def test_removed_spans_leave_valid_texts(spark):
    rows = [(1, "é" * 40), (2, "ũ" + "é" * 40 + "!"), (3, None), (4, "short")]
    out = suffixarray.without_repeats(frame(spark, rows), 21, 8)
    assert out.columns == ["doc_id", "text", "row", "spans", "start"]
    assert {r.doc_id: r.text for r in out.collect()} == {1: "", 2: "ũ!", 3: None, 4: "short"}


def test_suffix_array_and_prefixes():
    text = np.frombuffer(b"abracadabra abracadabra", np.uint8).astype(np.int64)
    order = suffixarray.suffix_array(text, 1)
    raw = text.tolist()
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    prefix = suffixarray.common_prefixes(text, order)
    for a, b in zip(order[:-1], order[1:]):
        k = next((k for k, (x, y) in enumerate(zip(raw[a:], raw[b:])) if x != y), min(len(raw) - a, len(raw) - b))
        assert prefix[b] == k


def test_near_duplicates_equal_brute_force(spark):
    draw = random.Random(4)
    base = [[f"w{draw.randrange(4000)}" for _ in range(draw.choice([1, 4, 5, 9, 40, 150]))] for _ in range(40)]
    rows = []
    for i in range(160):
        words = [w if draw.random() > 0.012 else "new" for w in draw.choice(base)]
        rows.append((i, " ".join(words).upper() if i % 3 else " ".join(words)))
    rows += [(900, None), (901, ""), (902, " \n"), (None, rows[0][1]), (5, rows[5][1])]
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i, t] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}
    label = {i: i for i, _ in rows if i is not None}
    changed = True
    while changed:
        changed = False
        for (i, s), a in sets.items():
            for (j, t), b in sets.items():
                if None not in (i, j) and a and 100 * len(a & b) >= 75 * len(a | b) and label[j] < label[i]:
                    label[i], changed = label[j], True
    found = minhash.near_duplicates(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.component_id == (None if r.doc_id is None else label[r.doc_id])
    assert sorted(r.n_shingles for r in found) == sorted(len(sets[k]) for k in rows)
    kept = minhash.one_of_each(frame(spark, rows))
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(set(label.values()))


def test_pieces_hold_every_id_once(spark):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = [(i, t) for i, t in enumerate([
        None, "", "one", "It's THE end!! of\tµß É 12.5 <|endoftext|> x", "a" * 3000, "naïve — «quoted», e.g. 3:4 ...",
        " ".join(f"Word{k % 97}, étre" for k in range(4000)), "don't .,. 'll", "x\x1cy\xa0z w ǅ İ ﬁ",
    ])] * 2 + [(None, "no id")]
    found = packing.pack(frame(spark, rows), TOKENIZER, max_segments=7, max_loss=4000).collect()
    total = Counter()
    for r in found:
        ids = [*tokenizer.encode(dict(rows)[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert r.doc_tokens == len(ids)
        assert bytes(r.ids) == np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
        total[r.doc_id] += r.length
    assert all(total[i] == n * len([*tokenizer.encode(dict(rows)[i] or "", add_special_tokens=False).ids, 2])
               for i, n in Counter(i for i, _ in rows).items())
    for s in {r.sequence_id for r in found}:
        own = sorted((r for r in found if r.sequence_id == s), key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        length = sum(r.length for r in own)
        assert length <= 4096 and len(own) <= 7 and sum(r.loss_tokens for r in own) <= 4000
        assert length == 4096 or length & (length - 1) == 0


def test_reply_trees_and_round_trip(spark):
    odd = ["<|im_end|>", "<\\|x<\\\\|", "a\nb\\n", None, "<", "", "\\"]
    rows = [
        ("t", 1, None, "user", odd[0], 0.0), ("t", 2, 1, "assistant", odd[1], 1.0), ("t", 3, 1, "assi\\n\nst", odd[2], 5.0),
        ("t", 4, 3, "user", odd[3], 0.0), ("t", 5, 3, None, odd[4], None), ("t", 5, 3, None, odd[4], None),
        (None, 1, 99, "assistant", odd[6], 1.0),
    ]
    messages = spark.createDataFrame(rows, "tree string, message long, parent long, role string, text string, score double")
    messages = messages.withColumn("t", F.lit(1)).withColumn("path", F.lit(2))
    out = chat.reply_trees(messages).withColumn("turns", chat.read_back(F.col("formatted"))).withColumn(
        "loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()
    found = {(r.tree, r["rank"]): [tuple(x) for x in r.turns] for r in out}
    root, third = ("user", odd[0]), ("assi\\n\nst", odd[2])
    assert found == {
        ("t", 1): [root, third, ("user", "")], ("t", 2): [root, third, ("", "<")],
        ("t", 3): [root, ("assistant", odd[1])], (None, 1): [("assistant", "\\")]}
    assert {(r.tree, r["rank"]): r.loss for r in out} == {
        ("t", 1): "", ("t", 2): "", ("t", 3): odd[1], (None, 1): "\\"}
    assert chat.reply_trees(messages.limit(0)).count() == 0
    loop = spark.createDataFrame([(1, 1, 2, "u", "a", 0.0), (1, 2, 1, "u", "b", 0.0)], messages.drop("t", "path").schema.simpleString()[7:-1].replace("tree:string", "tree:long").replace(":", " "))
    # A cycle is left out; the other trees of the table are not touched by it.
    whole = loop.unionByName(spark.createDataFrame([(2, 1, None, "u", "c", 0.0), (1, 3, 1, "u", "d", 0.0)], loop.schema))
    assert [(r.tree, r.n_turns) for r in chat.reply_trees(whole).collect()] == [(2, 1)]
    assert sorted(map(tuple, chat.rootless(whole).collect())) == [(1, 1), (1, 2), (1, 3)]


@pytest.mark.parametrize("seed", [1, 2])
def test_branches_equal_walks_to_the_root(spark, seed):
    """Random trees, with a chain longer than any power of two below it."""
    draw = random.Random(seed)
    parent = {("a", i): (i - 1 if i else None) for i in range(37)}
    parent |= {("b", i): (draw.randrange(i) if i and draw.random() < 0.95 else None) for i in range(60)}
    score = {k: float(draw.randrange(4)) for k in parent}
    rows = [(t, i, p, "user", f"{t}{i}", score[t, i]) for (t, i), p in parent.items()]
    messages = spark.createDataFrame(rows, "tree string, message long, parent long, role string, text string, score double")
    replied = {(t, p) for (t, _), p in parent.items() if p is not None}
    expected = {}
    for t in "ab":
        walks = []
        for tree, leaf in parent:
            if tree == t and (t, leaf) not in replied:
                path, at = [], leaf
                while at is not None:
                    path.insert(0, at)
                    at = parent[t, at]
                walks.append((-sum(score[t, i] for i in path), leaf, path))
        for rank, (s, _, path) in enumerate(sorted(walks)[:5], 1):
            expected[t, rank] = (-s, [f"{t}{i}" for i in path])
    found = chat.reply_trees(messages, keep=5).withColumn("turns", chat.read_back(F.col("formatted"))).collect()
    assert {(r.tree, r["rank"]): (r.score, [x.text for x in r.turns]) for r in found} == expected


def test_templates_catch_other_values(spark):
    item = "Alice walked 12 km from the old station to Paris and then paid Bob 30 euros for the long way back home"
    docs = frame(spark, [
        (1, "Before. " + item + " After that."),
        (2, item.replace("Alice", "Carol").replace("12", "77").replace("30", "5").replace("Paris", "Rome")),
        (3, "Nothing of it at all here, only other words that say nothing of interest to anyone."),
        (4, None), (5, ""), (None, item),
    ])
    benchmark = spark.createDataFrame([(7, item), (8, None), (9, "tiny item")], "item_id long, text string")
    found = {r.doc_id: r for r in decontam.contaminated(docs, benchmark).collect()}
    assert set(found) == {1, 2, None} and found[1].n_changed == 0 and found[2].n_changed >= 3
    left = decontam.decontaminated(docs, benchmark)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 5]
    assert zlib.crc32(b"") == 0 and decontam.contaminated(docs, benchmark.limit(0)).count() == 0


def canonical(text):
    """(kind, value, unsure) of every token, word by word."""
    out, start, number = [], True, False
    for word in (text or "").split():
        value, kind, unit, capital, end = decontam._kind(word.encode())
        if kind != decontam.NOTHING:
            unsure = False
            if kind == decontam.LITERAL and unit and number:
                kind = decontam.UNIT
            elif kind == decontam.LITERAL and capital:
                kind, unsure = (decontam.LITERAL, True) if start else (decontam.NAME, False)
            out.append((kind, value, unsure))
        number, start = kind == decontam.NUMBER, end
    return out


def readings(tokens, at, width):
    """The window's symbols under one or two readings, with its kinds."""
    own = [(k, v) for k, v, _ in tokens[at:at + width]]
    for named in (False, True)[:1 + tokens[at][2]]:
        if named:
            own = [(decontam.NAME, own[0][1]), *own[1:]]
        yield tuple(v if k == decontam.LITERAL else k for k, v in own), [k for k, _ in own], [v for _, v in own]


def brute_matches(docs, items, width, min_windows, min_share):
    out = []
    for doc, text in docs:
        d = canonical(text)
        for item, passage in items:
            b = canonical(passage)
            w = min(width, len(b))
            diagonals = {}
            for own in range(len(b) - w + 1 if b else 0):
                for key, kinds, values in readings(b, own, w):
                    for at in range(len(d) - w + 1):
                        for other, _, found in readings(d, at, w):
                            if other == key:
                                places, slots = diagonals.setdefault(at - own, (set(), set()))
                                places.add(own)
                                slots |= {(k, x, y) for k, x, y in zip(kinds, values, found) if k != decontam.LITERAL}
            matched, mapping = set(), {}
            for _, (places, slots) in sorted(diagonals.items(), key=lambda x: (-len(x[1][0]), x[0])):
                merged = dict(mapping)
                if all(merged.setdefault((k, x), y) == y for k, x, y in slots):
                    matched, mapping = matched | places, merged
            n = len(b) - w + 1
            if matched and (len(matched) >= min_windows or len(matched) >= min_share * n):
                out.append((doc, item, n, len(matched), len(mapping), sum(x != y for (_, x), y in mapping.items())))
    return out


def test_template_matches_equal_brute_force(spark):
    draw = random.Random(11)
    names, units, plain = ["Alice", "Bob", "Carol", "Rome"], ["km", "kg", "euros"], "the has and walked from to apples that then paid old way".split()

    def passage(n):
        words = [draw.choice([draw.choice(plain), draw.choice(plain), draw.choice(names), str(draw.randrange(50))]) for _ in range(n)]
        for i, word in enumerate(words):
            if word.isdigit() and draw.random() < 0.5:
                words[i] += " " + draw.choice(units)
            elif draw.random() < 0.1:
                words[i] += draw.choice([".", "?", ","])
        words[0] = words[0].capitalize()
        return " ".join(words)

    def changed(text):
        swap = dict(zip(names, draw.sample(names, 4))) if draw.random() < 0.7 else {}
        return " ".join(
            str(draw.randrange(50)) if w.isdigit() and draw.random() < 0.5 else swap.get(w, w) if draw.random() < 0.95 else "other"
            for w in text.split())

    items = [(i, passage(draw.choice([1, 3, 5, 8, 12, 20]))) for i in range(14)] + [(50, None), (51, ""), (52, " ... ")]
    items += [(60, items[3][1])]
    docs = []
    for i in range(60):
        parts = [passage(draw.randrange(1, 20)) if draw.random() < 0.4 else changed(draw.choice(items[:14])[1]) for _ in range(draw.randrange(4))]
        docs.append((i if i % 9 else None, None if i % 13 == 5 else " ".join(parts)))
    docs += [docs[1], docs[2], (500, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1))
    for width, least, share in ((8, 5, 0.5), (3, 2, 0.3)):
        found = decontam.contaminated(frame(spark, docs), benchmark, width, least, share).collect()
        expected = brute_matches(docs, [(i, t) for i, t in items if t is not None], width, least, share)
        assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected)) and len(expected) > 40
        left = decontam.decontaminated(frame(spark, docs), benchmark, width, least, share)
        gone = {str(m[0]) for m in expected if m[0] is not None}
        assert {str(r.doc_id) for r in left.where("doc_id is not null").collect()} == {str(i) for i, _ in docs if i is not None} - gone


def test_first_words_and_contradicting_slots(spark):
    item = "Alice has 5 apples and 3 pears"
    docs = frame(spark, [
        (1, "We know that Carol has 7 apples and 2 pears"), (2, "So Alice has 5 apples and 3 pears"),
        (3, "Yes. Carol has 7 apples and 2 pears"), (4, "We know that Carol has 7 oranges and 2 pears")])
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r.doc_id for r in decontam.contaminated(docs, benchmark).collect()} == {1, 2, 3}
    # Each half alone is too short; together they say that Alice is both Carol and Dave.
    long = "and then Alice walked to the old station with her dog and paid for it so that Alice had no coins left for the way"
    half = long.replace("Alice walked", "Carol walked").replace(" so that Alice", " but so that Dave")
    same = half.replace("Dave", "Carol")
    benchmark = spark.createDataFrame([(2, long)], "item_id long, text string")
    found = {r.doc_id for r in decontam.contaminated(frame(spark, [(1, half), (2, same)]), benchmark, 8, 10, 0.9).collect()}
    assert found == {2}

"""Phrase counts and scores against brute force."""

import random
import re
from collections import Counter

import pytest

from stayline.llm import collocations

SCHEMA = "doc_id long, text string, lang string, words string, a long, edge long"


def pieces_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[ \t]+", p) if w] for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower)]


def brute(rows, longest, least, share, top):
    out = []
    for lang in {l or "und" for _, _, l in rows}:
        f, n = Counter(), 0
        for _, text, own in rows:
            if (own or "und") == lang:
                for words in pieces_of(text):
                    n += len(words)
                    for w in range(1, longest + 1):
                        f.update(tuple(words[i:i + w]) for i in range(len(words) - w + 1))
        kept = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        ranked = []
        for g, a in kept.items():
            if any(100 * b >= share * a and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))
                   for h, b in kept.items() if len(h) > len(g)):
                continue
            score, k = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            ranked.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]], k))
        for rank, (score, a, phrase, l, r, k) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score, k))
    return sorted(out)


def texts(seed, n=120):
    draw = random.Random(seed)
    common = ["a", "B", "c", "é", "der", "x-1", "'s"]
    fixed = ["new york city", "a a a a", "Der der der hund", "one two three four five six seven"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(draw.randrange(30)):
            parts.append(draw.choice(common) if draw.random() < 0.6 else draw.choice(fixed) if draw.random() < 0.4 else f"rare{draw.randrange(300)}")
            parts.append(draw.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!?", "\x0b", " "]))
        rows.append((i, None if i % 17 == 3 else "".join(parts), draw.choice(["en", "de", None])))
    return rows + [rows[0], (900, "", "fr"), (901, None, "it"), (902, "only", "en")]


FIELDS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "k"]


@pytest.mark.parametrize("seed, longest, words, chunk", [(1, 3, 1_000_000, 1 << 18), (2, 3, 16, 40), (3, 2, 50, 1 << 18), (4, 4, 7, 9)])
def test_equal_to_brute_force(spark, monkeypatch, seed, longest, words, chunk):
    """Small blocks and chunks cut pieces and long texts anywhere."""
    start, read = collocations.edges, collocations.words_of
    monkeypatch.setattr(collocations, "edges", lambda docs, longest, buckets: start(docs, longest, buckets, words))
    rows = texts(seed)
    docs = spark.createDataFrame([(i, t, l, "w", 1, 2) for i, t, l in rows], SCHEMA)
    found = collocations.collocations(docs, longest, least=4, top=25, buckets=5)
    expected = [x for x in brute(rows, longest, 4, 50, 25)]
    assert sorted(tuple(r[c] for c in FIELDS) for r in found.collect()) == expected and expected
    assert read is collocations.words_of


@pytest.mark.parametrize("size", [1, 7, 64])
def test_chunks_of_long_texts_keep_words_and_pieces(size):
    import pyarrow as pa

    text = " ".join(f"word{i}" + ("." if i % 9 == 0 else "") for i in range(200)) + "x" * 300 + ". End"
    batch = pa.record_batch({"lang": ["en"], "text": pa.array([text.encode()], pa.binary())})

    def read(size):
        keys, pieces = [], []
        for _, _, k, p, *_ in collocations.words_of([batch], size):
            keys += k.tolist()
            pieces += p.tolist()
        first = [i for i in range(1, len(pieces)) if pieces[i] != pieces[i - 1]]
        return keys, first

    assert read(size) == read(1 << 18)


def test_long_words_have_one_key(monkeypatch):
    monkeypatch.setattr(collocations, "LONG_WORD", 10)
    raw = b"short averyveryverylongword"
    buffer, starts, ends, _ = collocations.word_places(raw)
    import numpy as np

    together = collocations.word_keys(raw, buffer, starts, ends, np.uint64(5))
    alone = raw[6:]
    buffer, starts, ends, _ = collocations.word_places(alone)
    assert collocations.word_keys(alone, buffer, starts, ends, np.uint64(5))[0] == together[1]


def test_unary_paths_are_compacted(spark):
    chain = [[i, i + 1, i + 2] for i in range(10)]
    fork = [[100, 101, 102], [101, 102, 103], [101, 102, 104]]
    ring = [[201, 202, 203], [202, 203, 201], [203, 201, 202]]
    edges = spark.createDataFrame([(x,) for x in chain + fork + ring], "words array<long>")
    names = {r.h: tuple(r.words) for r in edges.selectExpr("xxhash64(words) AS h", "words").collect()}
    found = {names[r.edge]: r.path_words for r in collocations.unary_paths(edges, 3).collect()}
    assert found == {**{tuple(x): 12 for x in chain}, **{tuple(x): None for x in ring}}


def test_empty_tables_and_exact_products(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, "a b", "en", "w", 1, 2)], SCHEMA)).count() == 0
    big = spark.createDataFrame([(9_999_999_999_999 - 7, [9_999_999_999_998], [9_999_999_999_997])], "a long, l array<long>, r array<long>")
    from pyspark.sql import functions as F

    row = big.select(collocations.chosen_cut(F.col("l"), F.col("r"), F.col("a")).alias("c")).first().c
    assert row.score == 1000000 * (9_999_999_999_992 ** 2) // (9_999_999_999_998 * 9_999_999_999_997)

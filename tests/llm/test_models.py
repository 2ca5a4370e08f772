"""Trained operators: exact parts against brute force, the rest on held-out rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import hmm, langid, licenses, quality, queries
from tests.llm.test_exact import frame


@pytest.fixture(scope="module")
def documents(spark, folder):
    return [(r.doc_id, r.text) for r in queries.table(spark, folder, "documents").select("doc_id", "text").collect()]


def test_languages_of_held_out_documents(spark, folder, documents):
    found = queries.op8_language_id(spark, folder).collect()
    lang = {r.doc_id: r.lang for r in queries.table(spark, folder, "documents").collect()}
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in documents if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    assert len(found) == len(documents) and all(0 <= r.score <= 1 for r in found)


def test_mixture_finds_both_languages():
    draw = np.random.Generator(np.random.PCG64(1))
    probability = draw.dirichlet(np.full(200, 0.3), 3).T + 1e-6
    counts = draw.multinomial(900, probability[:, 0]) + draw.multinomial(300, probability[:, 2])
    used = np.flatnonzero(counts)
    share = langid.selected(counts[used].astype(float), probability[used])
    assert share[1] == 0 and abs(share[0] - 0.75) < 0.05 and abs(share.sum() - 1) < 1e-9


def test_language_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "the end of the day"), (None, "le jour de la fin")]
    train = spark.createDataFrame([("the day and the night of it", "en"), ("le jour et la nuit de la vie", "fr"), (None, "de"), ("x", None)], "text string, lang string")
    model = langid.fit(train)
    found = {r.doc_id: r.lang_pred for r in langid.identify(frame(spark, rows), model).collect()}
    assert found == {1: "und", 2: "und", 3: "und", 4: "en", None: "fr"}
    assert sorted(str(r.doc_id) for r in langid.known_language(frame(spark, rows), model).collect()) == ["4", "None"]
    assert langid.identify(frame(spark, rows), langid.fit(train.limit(0))).where("lang_pred <> 'und'").count() == 0


def test_rule_measures_equal_brute_force(spark, folder, documents):
    extra = [(-5, None), (-6, ""), (-7, "a b c a b c\na b c a b c\n \n#<é é é é"), (None, "x y")]
    docs = frame(spark, documents + extra)
    found = quality.likelihood_filter(docs, queries.table(spark, folder, "labels")).collect()
    assert len(found) == len(documents) + len(extra)
    texts = dict(documents + extra)
    for r in found:
        text = texts[r.doc_id] or ""
        words = text.encode().split()
        grams = Counter(zip(words, words[1:], words[2:]))
        marked = {k + d for k, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert r.n_words == len(words) and r.n_repeat_words == len(marked)
        assert r.word_chars == sum(len(w.decode()) for w in words)
        assert r.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(words) < 50 or 100 * len(marked) > 50 * len(words))
        assert not (r.kept and r.base_failed)
    good = {r.doc_id for r in queries.table(spark, folder, "labels").where("quality = 1 and toxic = 0").collect()}
    judged = [r for r in found if r.doc_id in good and not r.base_failed]
    assert sum(r.kept for r in judged) >= 0.98 * len(judged)
    none = quality.likelihood_filter(docs.limit(0), queries.table(spark, folder, "labels").limit(0))
    assert none.count() == 0


def test_held_out_trusted_documents_stay(spark):
    data = "/root/testdata/sf0.01"
    docs = queries.table(spark, data, "documents")
    labels = {r.doc_id: (r.quality, r.toxic) for r in queries.table(spark, data, "labels").collect()}
    held = lambda text: zlib.crc32((text or "").encode()) % 2 == 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    known = [(i, *labels[i]) for i in labels if not held(texts.get(i))]
    found = quality.likelihood_filter(docs, spark.createDataFrame(known, "doc_id long, quality long, toxic long")).collect()
    judged = [r for r in found if labels.get(r.doc_id) == (1, 0) and held(texts[r.doc_id]) and not r.base_failed]
    assert len(judged) > 100 and sum(r.kept for r in judged) >= 0.97 * len(judged)
    poor = [r for r in found if labels.get(r.doc_id) == (0, 0) and held(texts[r.doc_id])]
    assert sum(r.kept for r in poor) <= 0.5 * len(poor)


def test_base_scores_and_forward_recursion(spark, documents):
    rows = documents[:80] + [(-5, None), (-6, ""), (-6, ""), (None, "the and")]
    held = langid.held_out(F.col("doc_id"), 10, 0)
    found = hmm.language_model(frame(spark, rows), held, states=3, rounds=2, head=50, buckets=20).collect()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    count = Counter(w for i, t in tokens if not out(i) for w in t)
    n, v = sum(count.values()), len(count)
    want = sorted((len(t), sum(count[w] > 0 for w in t), round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for _, t in tokens)
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found) == want
    assert all(r.train_tokens == n and r.held_out == out(r.doc_id) and r.score < 0 for r in found)
    assert hmm.language_model(frame(spark, []), held, rounds=1).count() == 0


def test_held_out_texts_gain_by_the_model(spark, folder):
    """The states differ from the start on, so that a few rounds beat the unigram by a margin."""
    docs = queries.table(spark, folder, "documents")
    found = hmm.language_model(docs, langid.held_out(F.col("doc_id"), 10, 0))
    sums = found.where("held_out").agg(F.sum("base_score"), F.sum("score"), F.sum("n_tokens")).first()
    assert (sums[1] - sums[0]) / sums[2] > 0.1


def test_company_tells_classes_apart(spark):
    rows = [(i, " ".join(["the", "of", "cat", "dog"] if i % 2 else ["le", "de", "chat", "chien"]) + f" w{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stored = hmm.encoded(docs, F.lit(False)).cache()
    pairs = stored.select(F.explode(F.arrays_zip("hashes", "seen")).alias("x")).select(F.col("x.hashes").alias("hash"), F.col("x.seen").alias("n"))
    counts = pairs.groupBy("hash").agg(F.sum("n").alias("c"))
    lexicon = hmm.Lexicon(counts, 40, 8, 16)
    common, company = hmm.companions(hmm.sequences(stored, counts, 40, lexicon), lexicon, top=8)
    # Two groups of four words that never meet, 20 texts each.
    meet = company[:, common] > 0
    assert sorted(meet.sum(axis=1).tolist()) == [4] * 8 and company[:, common].max() == 20
    _, move, emit = hmm.distinct_start(hmm.sequences(stored, counts, 40, lexicon), lexicon, 2)
    assert np.allclose(emit.sum(axis=0), 1) and np.allclose(move.sum(axis=1), 1)
    sides = emit[common].argmax(axis=1)
    assert all((sides[i] == sides[j]) == meet[i, j] for i in range(8) for j in range(8))


def test_forward_equals_sum_over_paths_and_training_gains():
    draw = np.random.Generator(np.random.PCG64(3))
    model = (draw.dirichlet(np.ones(2)), draw.dirichlet(np.ones(2), 2), draw.dirichlet(np.ones(4), 2).T)
    rows = [draw.integers(0, 4, n).astype("<i2") for n in (1, 6, 3, 6)]
    for row, score in zip(rows, hmm.Chains(rows).scores(model)):
        total = 0.0
        for path in np.ndindex(*[2] * len(row)):
            p = model[0][path[0]]
            for t, s in enumerate(path):
                p *= model[2][row[t], s] * (model[1][path[t - 1], s] if t else 1)
            total += p
        assert abs(score - math.log10(total)) < 1e-9
    before = hmm.Chains(rows).scores(model).sum()
    likelihood, first, move, emit = hmm.Chains(rows).expected(model)
    assert likelihood == pytest.approx(before)
    assert abs(first.sum() - 4) < 1e-9 and abs(emit.sum() - 16) < 1e-9 and abs(move.sum() - 12) < 1e-9
    better = (first / first.sum(), move / move.sum(axis=1, keepdims=True), (emit / emit.sum(axis=1, keepdims=True)).T)
    assert hmm.Chains(rows).scores(better).sum() > before


def test_licence_statements(spark, documents):
    rows = documents[:60] + [
        (-1, "Some words here.\nReleased under the MIT License.\nMore."), (-2, "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0"),
        (-3, None), (-4, ""), (None, "This work is licensed under the GNU General Public License, version 3."), (-1, "All rights reserved."),
    ]
    found = licenses.scan(frame(spark, rows), sample=60).collect()
    own = sorted((str(r.doc_id), r.paragraph, r.family) for r in found if r.doc_id is None or r.doc_id < 0)
    assert own == [("-1", 0, "reserved"), ("-1", 1, "mit"), ("-2", 0, "apache"), ("None", 0, "gpl")]
    for r in found:
        text = bytes(r.text).decode().lower()
        assert r.family == "unknown" or "licen" in text or "reserved" in text
    assert licenses.scan(frame(spark, [])).count() == 0


def test_licence_notices_over_lines_and_in_long_lines(spark, documents):
    mit = licenses.TEMPLATES["mit"][2].split()
    wrapped = "\n".join("# " + " ".join(mit[i:i + 7]) for i in range(0, len(mit), 7))
    prose = " ".join(t.replace("\n", " ") for _, t in documents[:40]).split()
    long = " ".join([*prose[:900], "Licensed under the Apache License, Version 2.0.", *prose[900:1800]])
    apart = "\n\n".join(" ".join(mit[i:i + 7]) for i in range(0, len(mit), 7))
    rows = documents[:60] + [(-1, f"First line.\n\n{wrapped}\n\nLast line."), (-2, long), (-3, apart)]
    found = [r for r in licenses.scan(frame(spark, rows), sample=60).collect() if r.doc_id < 0 and r.family != "unknown"]
    assert sorted((r.doc_id, r.paragraph, r.family) for r in found) == [(-2, 0, "apache"), (-1, 1, "mit")]
    one = next(r for r in found if r.doc_id == -1)
    assert one.similarity == 1 and bytes(one.text).endswith(b"without restriction.")


# Licences of no family that training has not seen.
OTHERS = [
    "Licensed under the PostgreSQL License.", "Distributed under the University of Illinois/NCSA Open Source License.",
    "This file is licensed under the GNU Free Documentation License.", "Licensed under the Reciprocal Public License 1.5.",
    "This database is made available under the Open Data Commons Attribution License.",
    "Licensed under the Q Public License version 1.0.", "Use of this source code is subject to the Vim license.",
    "Licensed under the Intel Open Source License.", "Distributed under the W3C Software License.",
    "Licensed under the European Space Agency Public License v2.4.", "Licensed under the Sleepycat License.",
    "The code is available under the Zope Public License 2.1.", "Released under the Beerware license, revision 42.",
    "The Software shall be used for Good, not Evil; see the JSON licence.", "Licensed under the Nokia Open Source License.",
]


def test_licences_of_no_family_are_unknown(spark, documents):
    rows = documents[:60] + [(-i, t) for i, t in enumerate(OTHERS, 1)]
    found = [r for r in licenses.scan(frame(spark, rows), sample=60).collect() if r.doc_id < 0]
    assert {r.family for r in found} == {"unknown"} and len({r.doc_id for r in found}) >= 11


def test_probabilities_are_reliable_on_new_statements(documents):
    class Draw:
        def __init__(self, seed):
            self.draw = np.random.default_rng(seed)
            self.random = self.draw.random

        def choice(self, given):
            return given[self.draw.integers(len(given))]

    lines = [t.split("\n")[0].encode() for _, t in documents if t]
    lines = [t for t in lines if licenses.best_template(t)[0] < 0.3]
    model, draw = licenses.Classifier(lines[::2]), Draw(99)
    rows = [(v, f) for f, own in licenses.TEMPLATES.items() for t in own for v in licenses.varied(t, draw, 3)]
    rows += [(v, "unknown") for t in OTHERS for v in licenses.varied(t, draw, 3)]
    rows = [(t.encode(), f) for t, f in rows] + [(t, "none") for t in lines[1::2]]
    p = model.probabilities(np.stack([licenses.vector(t, model.size) for t, _ in rows]) @ model.weights, np.ones(len(rows)))
    right = np.array([model.labels[k] == f for k, (_, f) in zip(p.argmax(axis=1), rows)])
    sure = p.max(axis=1)
    gap = 0
    for low, high in ((0, 0.5), (0.5, 0.8), (0.8, 0.95), (0.95, 1.1)):
        own = (sure >= low) & (sure < high)
        if own.any():
            gap += abs(sure[own].mean() - right[own].mean()) * own.mean()
    assert gap < 0.05 and right[sure >= 0.95].mean() > 0.97


def test_target_counts_leave_out_ids_that_share_a_filter_place(spark, monkeypatch):
    """With a filter of 64 places most documents pass it, and the counts stay those of a join."""
    rows = [(i if i % 11 else None, f"Word{i % 7} word{i % 5} x{i % 3}", i) for i in range(400)] + [(5, "again word1", 0), (6, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fold int")
    trusted = spark.createDataFrame([(i,) for i in range(0, 400, 9)] + [(None,), (0,), (9999,)], "doc_id long")

    def counts(bits, few):
        monkeypatch.setattr(quality, "FILTER_BITS", bits)
        monkeypatch.setattr(quality, "BROADCAST_IDS", few)
        return sorted(map(tuple, quality.ngram_counts(docs, trusted, 8, 3).where("raw <> 0").collect()))

    wide, narrow, joined = counts(24, 10), counts(6, 1000), counts(6, 0)
    assert wide == narrow == joined
    known = {i for i in range(0, 400, 9)}
    grams = sum(max(0, 2 * len((t or "").split()) - 1) for i, t, _ in rows)
    target = sum(max(0, 2 * len((t or "").split()) - 1) for i, t, _ in rows if i in known)
    assert (sum(r[1] for r in wide), sum(sum(r[2:]) for r in wide)) == (grams, target)

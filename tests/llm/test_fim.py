"""Fill-in-middle texts: exact round trip against a plain version."""

import hashlib
import random

from stayline.llm import fim

SCHEMA = "doc_id long, text string, key string, at long, piece string, n string"


def plain(doc_id, text):
    """(form, prefix, middle, output) as the contract says it, on one string."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


def rows():
    draw = random.Random(2)
    pool = "ab é 漢字 <SPM> \n\t𝄞"
    out = [(i, "".join(draw.choice(pool) for _ in range(draw.choice([1, 2, 9, 200, 3000])))) for i in range(150)]
    out += [(200 + i, t) for i, t in enumerate([None, "", "<", "<P", "a<P>b", "x<M>", "<<S>>", "no <p> mark", "𝄞" * 5000])]
    return out + [out[0], out[1], (out[2][0], "another text under an id that is taken"), (None, "no id"), (None, "no id")]


def test_outputs_and_restored_texts_equal_the_plain_version(spark):
    given = rows()
    docs = spark.createDataFrame([(i, t, "k", 1, "p", "n") for i, t in given], SCHEMA)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    expected = []
    for i, t in given:
        form, p, m, output = plain(i, t)
        expected.append(str((i, len(t or ""), form, p, m, sha(output), sha(t or ""))))
    for chunk in (3, 1024):
        found = fim.fill_in_middle(docs, chunk=chunk)
        assert sorted(str(tuple(r)) for r in found.collect()) == sorted(expected)
    texts = fim.training_texts(docs)
    assert sorted(str(tuple(r)) for r in texts.collect()) == sorted(str((i, *plain(i, t)[::3])) for i, t in given)
    assert {r[2] for r in found.collect()} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(docs.limit(0)).count() == 0


def test_parts_are_found_wherever_pieces_end():
    text = "one < two <P three"
    output = "<S>" + text[9:] + "<P>" + text[:4] + "<M>" + text[4:9]
    for size in range(1, len(output) + 1):
        reader, parts = fim.Parts("spm"), {0: b"", 1: b"", 2: b""}
        for at in range(0, len(output), size):
            for part, raw in reader.feed(output[at:at + size].encode()):
                parts[part] += raw
        for part, raw in reader.end():
            parts[part] += raw
        assert (parts[0] + parts[1] + parts[2]).decode() == text


def test_one_shuffle_sorts_for_both_passes(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = fim.fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 2

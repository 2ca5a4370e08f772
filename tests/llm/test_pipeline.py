import random

import corpus_pipeline
from stayline.llm import queries


def test_stages_keep_the_columns_and_clean_documents(spark, folder):
    docs = queries.table(spark, folder, "documents")
    columns = docs.columns
    whole = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), "doc_id long, text string, lang string, source string, n_chars long")
    assert 0.6 * whole < docs.count() < whole
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_repeated_passages_of_short_words_go(spark):
    draw = random.Random(4)
    words = lambda n, size: " ".join("".join(draw.choices("abcdefgh", k=size)) for _ in range(n))
    short, line, long = words(51, 1), words(50, 2), words(60, 9)
    own = [words(90, 5) for _ in range(6)]
    rows = [(i, f"{text} {shared} {text[::-1]}") for i, (text, shared) in enumerate(zip(own, [short, short, line, line, long, long]))]
    docs = spark.createDataFrame(
        [(i, t, "en", "x", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r for r in corpus_pipeline.suffix_array_dedup(spark, docs, None).collect()}
    for i, text in rows:
        left = text if i in (2, 3) else own[i] + own[i][::-1]
        assert found[i].text.replace(" ", "") == left.replace(" ", "") and found[i].n_chars == len(found[i].text)


def test_every_statement_has_a_query():
    assert queries.ORACLE.keys() <= queries.QUERIES.keys()

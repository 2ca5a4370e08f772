"""The training-data pipeline over `documents`, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs.
"""

from stayline.llm import decontam, langid, minhash, packing, suffixarray
from stayline.llm.queries import TOKENIZER, table
from stayline.session import scratch_path


def language_id(spark, docs, sf_dir):
    """Documents with a language; learned from the texts and lang of all documents.

    A missing lang is filled with the language found. Null and empty texts have none and go;
    repeated rows are judged one by one; an empty table stays empty.
    """
    return langid.known_language(docs, langid.fit(docs))


def minhash_near_dedup(spark, docs, sf_dir):
    """One document of each group of near-duplicates, the one with the least id.

    Null texts have no words and stay, as do rows with a null id; of rows that repeat an id
    and its text one stays; an empty table stays empty.
    """
    return minhash.one_of_each(docs)


def suffix_array_dedup(spark, docs, sf_dir):
    """Texts without the passages that they share; documents left without text go.

    A shared passage has over 50 words, or at least the 400 bytes of op7. Null texts and
    null ids stay; repeated rows count as copies of each other; an empty table stays empty.
    """
    return suffixarray.without_repeats(docs).where("text is null or trim(text) <> ''")


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that match no benchmark item.

    Null and empty texts match nothing and stay; repeated rows are judged one by one; without
    a benchmark all stay.
    """
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def sequence_packing(spark, docs, sf_dir):
    """Pieces of the documents in training sequences, with their token ids.

    A null text counts as empty and has its end token only; an empty table gives no pieces.
    """
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language_id", language_id),
    ("minhash_near_dedup", minhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", sequence_packing),
]

# The stages learn, hash and tokenize; SQL has no form of them.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""From raw documents to token ids: the five stages of the corpus pipeline.

Each stage is written as Parquet in the folder that ``spark.checkpoint.dir``
names and read again, so a lost executor costs no more than the stage it was
working on.  All stages but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, language, repeats, simhash
from millrace.llm.batches import columns, fresh
from millrace.llm.queries import RANKS, table
from millrace.llm.scratch import Scratch

#: Strings of this many bytes that occur twice are cut.  A passage of over 50 words has that many:
#: of 28,128 stretches of 51 words of the test documents, 98.8 % do.
REPEATED_BYTES = 250

#: No SQL form: a trained network, suffix arrays and byte-pair merges.  Tested against brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in a known language; null, letterless and unrecognised texts go.

    Without a labelled row to learn from, only null and letterless texts go.
    """
    return language.known_language(docs, "text", "lang", "doc_id")


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints (4-word shingles) link at 4 bits or fewer.

    The one with the smallest id stays, of rows that repeat it one; texts without
    words, null among them, are one group.
    """
    return simhash.first_of_groups(spark, docs, "doc_id", "text", shingle=4, radius=4)


def cut_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without strings of REPEATED_BYTES bytes that also start elsewhere.

    Characters that a cut parts are dropped; n_chars, where it is a column,
    follows the text.  Null stays null, and documents that lose all text stay
    with an empty one.
    """
    names = tuple(fresh(docs.columns, "bytes", "removed", "spans", "kept"))
    found = repeats.without_repeats(spark, docs, docs.columns, "doc_id", "text", REPEATED_BYTES, names, characters=True)
    text = F.when(F.col(names[1]) == 0, F.col("text")).otherwise(F.col(names[3]))
    cut = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col(names[1]) == 0, F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return cut.select(*columns(docs.columns))


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of which less than one word in 20 stands in a 13-word window of a benchmark item.

    Null and empty texts stay, and with an empty benchmark all do.
    """
    return decontaminate.clean(docs, "text", table(spark, folder, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Number of byte-level BPE ids, digests of the ids and of the bytes they decode to; null counts as empty."""
    return bpe.digest_rows(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("language", identify_language),
    ("simhash", drop_near_copies),
    ("repeats", cut_repeats),
    ("decontaminate", drop_benchmark_text),
    ("encode", encode_tokens),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The stages one after the other over the documents of ``folder``."""
    docs = table(spark, folder, "documents")
    scratch = Scratch(spark, "pipeline")
    for n, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, folder), f"{n}-{name}")
        if n:
            scratch.drop(f"{n - 1}-{STAGES[n - 1][0]}")
    return docs

"""A training-corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark decontamination, packing.

Every stage decides row by row.  Rows are told apart by their number in the table that the stage is given (`numbered`),
not by doc_id, which may be null or repeated.

Defined results: a row with a null doc_id is judged like any other; so are rows that share a doc_id, each by its own
text; a null text is empty to every stage and stays null; rows without words have one fingerprint and are near copies
of each other; of rows that are equal in everything one stays; an empty table gives an empty one; columns of the input
that `documents` doesn't have are dropped, so none can clash.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import stored, table
from waymark.llm.decontaminate import find_leaks
from waymark.llm.line_dedup import dedup_lines
from waymark.llm.packing import pack
from waymark.llm.queries import WORD_TOKENIZER
from waymark.llm.simhash import similar_documents
from waymark.llm.toxicity import score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def numbered(docs: DataFrame) -> DataFrame:
    """docs with `row`, the row's number: the same whenever the same files are read, as each stage's input is."""
    return docs.select(F.monotonically_increasing_id().alias("row"), *COLUMNS)


def as_rows(docs: DataFrame) -> DataFrame:
    """Rows under their numbers, for operators that tell documents by doc_id."""
    return docs.select(F.col("row").alias("doc_id"), "text")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic."""
    return score_toxicity(docs, table(spark, sf_dir, "labels"), keep=COLUMNS).where("predicted = 0").select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier one is near; documents of which nothing but white space is left go."""
    left = dedup_lines(docs.select(COLUMNS)).where("size(dropped) = 0 OR text RLIKE '\\\\S'")
    n_chars = F.when(F.size("dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts that share 0.8 or more of their shingles of five words: the one with the
    smallest doc_id (null last), the first of them in the table."""
    docs = numbered(docs)
    found = similar_documents(as_rows(docs)).select(F.col("doc_id").alias("row"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    kept = found.join(docs.select("row", "doc_id"), "row").groupBy("component_id").agg(F.min(order)["row"].alias("row")).select("row")
    return docs.join(stored(kept).hint("merge"), "row", "left_semi").select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    docs = numbered(docs)
    leaks = find_leaks(as_rows(docs), table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("row"))
    return docs.join(stored(leaks).hint("merge"), "row", "left_anti").select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path(WORD_TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]
#: No stage of the five can be told in SQL: they learn dictionaries, hash, decompose matrices and tokenize.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, each over what the one before it kept."""
    docs = table(spark, sf_dir, "documents").select(COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

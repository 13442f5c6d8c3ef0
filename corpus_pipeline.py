"""Corpus preparation in five stages, each of which works on all that the one before kept.

Every stage function takes (spark, docs, sf_dir), where docs has the columns of documents,
and returns a DataFrame that is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import lines, minhash, packing, secrets, toxicity
from daybook.llm.common import ship
from daybook.session import settle


def _spare(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    while name in docs.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents predicted toxic go.

    Null and empty texts stay. Repeated rows and shared or null doc_ids are judged each on its own.
    """
    labels = ship(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: later copies of line runs go, and documents of which nothing is left but had words.

    n_chars follows the text. Texts that are null, empty or without a word stay, as do rows
    without a doc_id; repeated rows lose the same lines. Other columns stay as they are.
    """
    ship(spark)
    # Columns of the documents that are called like the operator's counts are put aside.
    aside = {name: _spare(docs, f"own_{name}") for name in lines.ADDED if name in docs.columns}
    left = lines.remove_lines(docs.withColumnsRenamed(aside))
    left = left.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
    left = left.withColumn("n_chars", F.coalesce(changed, F.col("n_chars"))).drop(*lines.ADDED)
    return left.withColumnsRenamed({new: name for name, new in aside.items()}).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each group of near duplicates stays.

    Of repeated rows one stays. Texts without a word are no one's duplicates.
    """
    ship(spark)
    return minhash.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: secrets give way to the name of their kind; n_chars follows the text.

    Null and empty texts stay as they are; every row stays.
    """
    ship(spark)
    before = _spare(docs, "before")
    clean = secrets.redact(docs.withColumn(before, F.length("text")))
    changed = F.when(F.length("text") != F.col(before), F.length("text").cast("long"))
    return clean.withColumn("n_chars", F.coalesce(changed, F.col("n_chars"))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: what is left is packed into training sequences; the last stage's rows are pieces."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: SQL cannot express a trained classifier or byte-level BPE; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written to the shared folder."""
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Corpus pipeline: language, near duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``.  All but the last keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import op02_decontaminate, op04_language, op05_pii, op06_packing, op08_minhash
from tessera.llm.common import table
from tessera.session import cut_lineage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts whose language the model cannot tell: without a letter, or of no learned language beyond chance."""
    return op04_language.known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the one with the smallest id.

    Of rows that share an id, the first by text and then by the other columns stays, null texts last.  Rows
    without an id are no duplicates of anything and all stay.
    """
    kept = op08_minhash.near_duplicates(docs).where("kept and doc_id is not null")
    kept = cut_lineage(kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__rows")))
    # kept ids grow with the corpus: a merge join at every size
    single = docs.join(kept.where("__rows = 1").select("doc_id").hint("merge"), "doc_id", "left_semi")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    first = F.min(F.struct(F.col("text").isNull().alias("none"), "text", *others)).alias("first")
    one = docs.join(kept.where("__rows > 1").select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(first)
    one = one.select(*["doc_id" if c == "doc_id" else F.col(f"first.`{c}`") for c in docs.columns])
    return single.select(*[f"`{c}`" for c in docs.columns]).unionByName(one).unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out; documents that are mostly such passages go."""
    return op02_decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    return op05_pii.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs token pieces into sequences."""
    return op06_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("packing", packing)]
#: Trained labels, sketches and tokenizers have no SQL form; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs

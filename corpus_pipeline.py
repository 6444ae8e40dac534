"""A corpus made ready for training: quality, near duplicates, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
documents (further columns stay as they are); the last returns the pieces of sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexloom.llm import decontaminate, minhash, packing, pii, quality
from lexloom.llm.store import keep, row_key, scratch
from lexloom.session import spread


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents don't have."""
    while name in docs.columns:
        name += "_"
    return name


def _told_apart(docs: DataFrame) -> tuple[DataFrame, str, DataFrame | None]:
    """(docs, name, ids): a column that tells rows with different texts apart. It is doc_id, unless an id has several texts: then each row
    of such an id has an id of its own in a further column, a negative hash of both, and ids are these doc_ids."""
    said = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    texts = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(said).alias("a"), F.max(said).alias("b"))
    row, shared = _unused(docs, "_row"), _unused(docs, "_shared")
    ids = keep(texts.where("a <> b").select(F.col("doc_id").alias(shared)), "shared")
    if ids.isEmpty():
        return docs, "doc_id", None
    own = F.xxhash64(F.col("doc_id"), said).bitwiseOR(F.lit(-(1 << 63)))
    told = docs.join(ids, F.col("doc_id") == F.col(shared), "left").withColumn(row, F.when(F.col(shared).isNull(), F.col("doc_id").cast("long")).otherwise(own)).drop(shared)
    return told, row, ids.select(F.col(shared).alias("doc_id"))


def _by_row(told: DataFrame, row: str) -> DataFrame:
    """The documents with the ids of rows as doc_id, for operators that judge by it."""
    return told if row == "doc_id" else told.drop("doc_id").withColumnRenamed(row, "doc_id")


def _without(told: DataFrame, row: str, rejected: DataFrame) -> DataFrame:
    """Rows that are not among the rejected (by row, as doc_id); those of null id stay. The rejected grow with the corpus: never broadcast."""
    name = _unused(told, "_rejected")
    return told.join(rejected.select(F.col("doc_id").alias(name)).distinct().hint("merge"), F.col(row) == F.col(name), "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go, and so do those without words. Rows of null id stay; an empty table stays empty."""
    told, row, ids = _told_apart(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    if ids is not None:
        # The labels of an id that several texts share are those of each.
        more = told.join(ids, "doc_id", "left_semi").select("doc_id", row).distinct().join(labels, "doc_id").drop("doc_id").withColumnRenamed(row, "doc_id")
        labels = labels.unionByName(more.select(*labels.columns))
    return _without(told, row, quality.quality(_by_row(told, row), labels, every_context=True).where("not kept")).select(*docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, that of the smallest id; of rows that repeat an id and its text, one. Rows of null id stay."""
    told, row, _ = _told_apart(docs)
    kept = _without(told, row, minhash.near_duplicates(_by_row(told, row)).where("not kept")).select(*docs.columns)
    return kept.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(kept.where("doc_id is null"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; the others keep their whole text. Rows of null id stay."""
    told, row, _ = _told_apart(docs)
    hits = decontaminate.benchmark_hits(_by_row(told, row), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(told, row, hits.where("contaminated")).select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; n_chars follows the new text. All rows stay, null texts as they are."""
    key, spans = _unused(docs, "_key"), _unused(docs, "_spans")
    found = keep(pii.personal_data(docs).where("size(found) > 0").select(F.col("k").alias(key), F.col("found").alias(spans)), "spans").dropDuplicates([key])
    joined = docs.withColumn(key, row_key("doc_id", "text")).join(found.hint("merge"), key, "left")
    changed = joined.withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(pii.sanitised("text", spans)))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return changed.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed to sequences: (doc_id, piece, start, length, ids_crc32, sequence_id, offset). Null texts are the one id 0."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: SQL can't express a Kneser-Ney model, tokenization or best-fit packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each result but the last written and read again; what a stage wrote on its way is deleted
    after it."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            result = stage(spark, docs, sf_dir)
            docs = keep(result, name, lasting=True)
    return STAGES[-1][1](spark, docs, sf_dir)

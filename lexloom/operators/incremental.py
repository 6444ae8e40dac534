"""What is still to be done: inventories, deltas, progress, coverage, upserts. Spark chooses each join by the sides' sizes."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, Window, functions as F

from lexloom.functions.text import chunk_name, stem


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items whose key is not among the done ones (deltas, progress, markers, an index's own ids)."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def without_chunks(raw: DataFrame, chunked: DataFrame, name: str = "name") -> DataFrame:
    """Raw files whose chunk file is not among the chunked ones (the first delta)."""
    return raw.join(chunked.select(F.col(name).alias("_done")).distinct(), chunk_name(F.col(name)) == F.col("_done"), "left_anti")


def not_indexed(chunked: DataFrame, index: DataFrame, name: str = "name", key: str = "doc_id") -> DataFrame:
    """Chunk files whose document is not in the index (the second delta)."""
    return chunked.join(index.select(F.col(key).alias("_done")).distinct(), stem(F.concat(F.lit("/"), F.col(name))) == F.col("_done"), "left_anti")


def unmarked(items: DataFrame, markers: DataFrame, marker, path: str = "path") -> DataFrame:
    """Items whose marker file, a column of items, is not listed among the markers."""
    return items.join(markers.select(F.col(path).alias("_done")).distinct(), marker == F.col("_done"), "left_anti")


def difference(items: DataFrame, done: DataFrame) -> DataFrame:
    """The set of rows that are not among the done ones."""
    return items.subtract(done)


def per_partition(rows: DataFrame, by: str, most: int = 100) -> DataFrame:
    """Rows of each partition, in its order; at most so many partitions. The total is that of all rows: rows.count()."""
    return rows.groupBy(by).agg(F.count("*").alias("docs")).orderBy(by).limit(most)


def first_of_each(rows: DataFrame, by: str, most: int, *order: str) -> DataFrame:
    """The first rows of each partition, with their place."""
    return in_order(rows, by, *order).where(F.col("place") <= most)


def summary(inventories: DataFrame, by: str = "year", files: str = "file_count") -> DataFrame:
    """How many partitions there are, how many files, and which partitions, in their order."""
    return inventories.agg(F.count("*").alias("years"), F.sum(files).alias("files"), F.sort_array(F.collect_set(by)).alias("listed"))


def run_statistics(rows: DataFrame, by: list[str], ok) -> DataFrame:
    """(total, ok, rate) of rows by group: rate is the share of those for which ok holds, in percent."""
    out = rows.groupBy(*by).agg(F.count("*").alias("total"), F.count(F.when(ok, 1)).alias("ok"))
    return out.withColumn("rate", success_rate("ok", "total"))


class Meter:
    """Counts rows as an action of its own frame passes them, without a job more: docs and docs_per_sec once that is done."""

    def __init__(self) -> None:
        self.seen, self.began = Observation(), time.time()

    def watch(self, rows: DataFrame) -> DataFrame:
        self.began = time.time()
        return rows.observe(self.seen, F.count(F.lit(1)).alias("docs"))

    def result(self) -> dict:
        docs = self.seen.get["docs"]
        return {"docs": docs, "docs_per_sec": docs / max(time.time() - self.began, 1.0)}


def present(items: DataFrame, index: DataFrame, key: str) -> DataFrame:
    return items.join(index.select(key).distinct(), key, "left_semi")


def inventory(files: DataFrame, keys: list[str], file: str) -> DataFrame:
    """Per partition: sorted distinct file names and their number."""
    return files.groupBy(*keys).agg(F.sort_array(F.collect_set(file)).alias("files")).withColumn("file_count", F.size("files").cast("long"))


def name_digests(files: DataFrame, by: str, file: str) -> DataFrame:
    """(by, file_count, digest): how many different names each partition has, and the sum of a hash of each, as text. Digests and counts of parts
    without common names add up to those of the whole; partitions that agree in both have the same names. A row for each name goes to
    the task of its own hash: no task or row holds a partition."""
    number = F.conv(F.substring(F.md5(F.col(file).cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")
    return files.where(F.col(file).isNotNull()).select(by, file).distinct().groupBy(by).agg(F.count("*").alias("file_count"), F.sum(number).cast("string").alias("digest"))


def changed_partitions(old: DataFrame, new: DataFrame, by: str) -> DataFrame:
    """Partitions of name_digests() that differ, or that only one of the two has."""
    same = old.join(new, [by, "file_count", "digest"], "left_semi")
    return old.select(by).unionByName(new.select(by)).distinct().join(same.select(by), by, "left_anti")


def merged(*inventories: DataFrame) -> DataFrame:
    """The union of sets."""
    out = inventories[0]
    for more in inventories[1:]:
        out = out.unionByName(more)
    return out.distinct()


def coverage(expected: DataFrame, found: DataFrame, key: str, by: str, least: float = 0.99) -> DataFrame:
    """Per partition: how many keys are found, their share (1 of nothing), and whether that reaches `least`."""
    hit = expected.join(found.select(key).distinct().withColumn("_hit", F.lit(1)), key, "left")
    out = hit.groupBy(by).agg(F.count("*").alias("total"), F.count("_hit").alias("found"))
    ratio = F.when(F.col("total") > 0, F.col("found") / F.col("total")).otherwise(1.0)
    return out.withColumn("ratio", ratio).withColumn("uploaded", ratio >= least)


def first_seen(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row of each key: the first in the order."""
    names = [F.col(c) for c in rows.columns]
    return rows.groupBy(F.col(key).alias("_k")).agg(F.min_by(F.struct(*names), F.struct(*(F.col(o) for o in order))).alias("_r")).select("_r.*")


def lookup_path(wanted: DataFrame, first: DataFrame, second: DataFrame, name: str = "name", path: str = "path") -> DataFrame:
    """Each name's path: the least of the first listing, else of the second, else null."""
    a, b = (x.groupBy(name).agg(F.min(path).alias(p)) for x, p in ((first, "_a"), (second, "_b")))
    return wanted.join(a, name, "left").join(b, name, "left").withColumn(path, F.coalesce("_a", "_b")).drop("_a", "_b")


def last_of_each(rows: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One row of each key, a null key too: the last by order, then the greatest row."""
    names = [F.col(f"`{c}`") for c in rows.columns]
    last = F.max_by(F.struct(*names), F.struct(*(F.col(o) for o in order or []), *names))
    return rows.groupBy(F.col(key).alias("_k")).agg(last.alias("_r")).select("_r.*")


def upsert(existing: DataFrame, new: DataFrame, key: str, order: list[str] | None = None, repeated: bool = True) -> DataFrame:
    """Rows of `new` replace those of their key, also of a null one. Of new rows with one key the last by order stays, or the greatest; repeated says that
    there may be such."""
    one = last_of_each(new, key, order) if repeated else new
    have = one.select(F.col(key).alias("_upserted"))
    return existing.join(have, F.col(key).eqNullSafe(F.col("_upserted")), "left_anti").unionByName(one, allowMissingColumns=True)


def success_rate(ok: str, total: str):
    return F.when(F.col(total) > 0, F.col(ok) * 100.0 / F.col(total)).otherwise(0.0)


def in_order(rows: DataFrame, by: str, *order: str) -> DataFrame:
    """Rows numbered from 1 within a partition."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*order)))

"""Choosing chunks of a document: plain and weighted top-k, and siblings of the same role."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lexloom.functions.vectors import cosine


def top_k(chunks: DataFrame, k: int, doc: str, pos: str, score: str) -> DataFrame:
    """The k best of each document, ties by position; all other columns are kept."""
    w = Window.partitionBy(doc).orderBy(F.desc(score), pos)
    return chunks.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def weighted_top_k(chunks: DataFrame, k: int, weights: dict[str, float], doc: str = "doc", pos: str = "pos", role: str = "role", sim: str = "sim") -> DataFrame:
    """k chunks of each document, shared among roles in proportion to their count and weight; one shuffle by document.

    A document of k chunks or fewer keeps all. A missing role is "Others", an unknown one has weight 1, and roles of weight 0
    or less are left out, unless all are: then the best k stay. Each role gets its share rounded down, of its best chunks;
    what is left goes to the best of the rest, ties by their role's first appearance and their rank in it. Weights count in
    tenths, so that shares are exact.
    """
    pairs = [F.lit(x) for name, w in weights.items() for x in (name, round(w * 10))]
    known = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,int>")
    c = chunks.withColumn("_role", F.coalesce(F.col(role), F.lit("Others"))).withColumn("_s", F.coalesce(F.col(sim).cast("double"), F.lit(0.0)))
    c = c.withColumn("_w", F.coalesce(F.try_element_at(known, F.col("_role")), F.lit(10)).cast("long"))
    d, dr = Window.partitionBy(doc), Window.partitionBy(doc, "_role")
    c = c.withColumns({"_n": F.count("*").over(d), "_tot": F.sum(F.greatest("_w", F.lit(0))).over(d), "_gr": F.row_number().over(d.orderBy(F.desc("_s"), pos))})
    c = c.withColumns({"_nr": F.count("*").over(dr), "_f": F.min(pos).over(dr), "_rk": F.row_number().over(dr.orderBy(F.desc("_s"), pos))})
    c = c.withColumn("_base", F.coalesce(F.expr(f"_tot > 0 and _w > 0 and _rk <= ({k} * _nr * _w) div nullif(_tot, 0)"), F.lit(False)))
    c = c.withColumn("_nb", F.sum(F.col("_base").cast("int")).over(d)).withColumn("_open", (F.col("_w") > 0) & ~F.col("_base"))
    c = c.withColumn("_fr", F.row_number().over(Window.partitionBy(doc, "_open").orderBy(F.desc("_s"), "_f", "_rk")))
    kept = (F.col("_n") <= k) | ((F.col("_tot") == 0) & (F.col("_gr") <= k)) | F.col("_base") | (F.col("_open") & (F.col("_tot") > 0) & (F.col("_fr") <= k - F.col("_nb")))
    return c.where(kept & (F.lit(k) > 0)).select(*chunks.columns)


def same_role_ids(chunks: DataFrame, doc: str, role: str, pos: str, id_: str, name: str = "same_role_ids") -> DataFrame:
    """With the ids of the document's other chunks of the same role, in order; no self-join."""
    w = Window.partitionBy(doc, role).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return chunks.withColumn(name, F.array_remove(F.collect_list(id_).over(w), F.col(id_)))


def adjacent_cosines(rows: DataFrame, by: str, order: str, vector: str = "v", name: str = "cosine") -> DataFrame:
    """Rows with the cosine of their vector and the last one's in their group; the first of a group is left out. One shuffle."""
    w = Window.partitionBy(by).orderBy(order)
    return rows.withColumn("_last", F.lag(vector).over(w)).where("_last is not null").withColumn(name, cosine("_last", vector)).drop("_last")


def with_weights(rows: DataFrame, weights: dict[str, float], role: str = "role", default: float = 1.0, name: str = "weight") -> DataFrame:
    """Rows with the weight of their role."""
    known = F.create_map(*(F.lit(x) for kv in weights.items() for x in kv))
    return rows.withColumn(name, F.coalesce(F.try_element_at(known, F.col(role)), F.lit(default)))

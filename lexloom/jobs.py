"""Whole runs: chunk files to an index, year by year, with what is already done left out; verification; inventories."""

from __future__ import annotations

import argparse
import importlib
import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexloom.config import WEIGHTS
from lexloom.functions.vectors import encoded
from lexloom.operators import acts, incremental as I, records as R
from lexloom.operators.select import same_role_ids, weighted_top_k
from lexloom.sources import files, services, sinks


def index_documents(chunks: DataFrame, top_k: int, weights: dict[str, float], embed: str | Callable | None = None) -> DataFrame:
    """One record a document: its metadata and its best chunks in order, each with the ids of all the document's other chunks of the same
    role, and with the vector of its text if embed names a provider. Only chosen chunks are encoded."""
    own = "same_role_chunk_ids"
    known = chunks if own in chunks.columns else same_role_ids(chunks, "doc_id", "role", "chunk_id", "chunk_id", own)
    best = weighted_top_k(known, top_k, weights, "doc_id", "chunk_id", "role", "doc_similarity")
    if embed is not None:
        best = encoded(best, "text", "embedding", embed)
    fields = [c for c in (*acts.CHUNK_FIELDS, "embedding") if c in best.columns]
    return R.parents(best, "doc_id", "chunk_id", fields, [c for c in acts.JUDGMENT_FIELDS if c in best.columns and c != "doc_id"])


def index_year(spark: SparkSession, source: str, index: str, log: str, year: int, top_k: int = 12, weights: str = "retrieval", resume: bool = True) -> dict:
    """Index one year's documents that neither the log nor the index has; what was done. The chunks are read once: documents are counted
    as they are written, and which there are is asked of their ids alone."""
    meter = I.Meter()
    chunks = files.partitioned(spark, source, [year])
    logged = files.progress(spark, log).select(F.col("id").alias("doc_id"))
    ids = chunks.select("doc_id").distinct().persist()
    try:
        left = ids
        if resume:
            left = I.pending(left, logged, "doc_id")
            if sinks.has_table(spark, index):
                left = I.pending(left, sinks.read_table(spark, index), "doc_id")
        docs = index_documents(chunks.join(left, "doc_id", "left_semi"), top_k, WEIGHTS[weights])
        sinks.upsert_table(meter.watch(docs), index, "doc_id")
        sent = meter.result()
        # All of the year's, so that a run that died before this line is caught up.
        done = I.present(ids, sinks.read_table(spark, index), "doc_id")
        sinks.append_progress(I.pending(done, logged, "doc_id").select(F.col("doc_id").alias("id")), log)
        total = ids.count()
    finally:
        ids.unpersist()
    return {"year": year, "total": total, "uploaded": sent["docs"], "skipped": total - sent["docs"], "docs_per_sec": sent["docs_per_sec"]}


def index_years(spark: SparkSession, source: str, index: str, log: str, years: list[int], reverse: bool = False, recreate: bool = False, **options) -> list[dict]:
    """index_year() for each year in order; with recreate, from an empty index and log."""
    if recreate:
        sinks.purge(spark, [index], [log])
    return [index_year(spark, source, index, log, y, **options) for y in sorted(set(years), reverse=reverse)]


def missing(spark: SparkSession, source: str, index: str, log: str) -> DataFrame:
    """(year, missing): documents of the log that the index hasn't."""
    ids = files.progress(spark, log).select(F.col("id").alias("doc_id"))
    lost = I.pending(ids, sinks.read_table(spark, index), "doc_id")
    of = spark.read.parquet(source).select("doc_id", "year").distinct()
    return lost.join(of, "doc_id", "left").groupBy("year").agg(F.count("*").alias("missing"))


def build_inventories(spark: SparkSession, source: str, out: str, years: list[int], suffix: str = "_all_chunks.json", index: str | None = None, least: float = 0.99) -> list[dict]:
    """The names of the years' files as sorted rows with digests (sinks.write_inventory), and, with an index, how many of their documents it has; a
    line for each year. Folders are `year=Y` or `Y` under the source. An inventory that is there already says which years have changed."""
    listed = files.year_files(spark, source, years, suffix).where(~F.col("name").startswith("_")).select("year", "name")
    old = [r.asDict() for r in spark.read.parquet(f"{out}/digests").collect()] if files.exists(spark, f"{out}/digests") else []  # a row for each year
    sinks.write_inventory(listed, out, "year", "name")
    now = {r.year: r.asDict() for r in spark.read.parquet(f"{out}/digests").collect()}
    known = {r["year"]: (r["file_count"], r["digest"]) for r in old}
    lines = {y: {"year": y, "files": r["file_count"], "changed": known.get(y) != (r["file_count"], r["digest"])} for y, r in now.items()}
    if index is not None and sinks.has_table(spark, index):
        ids = spark.read.parquet(f"{out}/names").select("year", F.regexp_replace("name", f"{re.escape(suffix)}$", "").alias("doc_id"))
        covered = I.coverage(ids, sinks.read_table(spark, index), "doc_id", "year", least)
        covered.write.mode("overwrite").parquet(f"{out}/coverage")
        for r in spark.read.parquet(f"{out}/coverage").collect():
            lines[r.year] |= {"indexed": r.found, "ratio": r.ratio, "uploaded": r.uploaded}
    return [lines[y] for y in sorted(lines)]


def index_dictionary(spark: SparkSession, schema: str, fetch_page: Callable[[int, int], list[tuple]], index: str, key: str = "id", text: str = "definition", embed: str | Callable | None = None, total: int | None = None, size: int = 1000, resume: bool = True) -> dict:
    """Entries of a service that gives them by offset, those that the index has not yet, with the vector of their text if embed names a
    provider; how many were written. An empty text has no vector and is left out, as is an entry without a key."""
    entries = services.paged(spark, schema, fetch_page, total, size).where(F.col(key).isNotNull() & (F.trim(F.coalesce(F.col(text), F.lit(""))) != ""))
    if resume and sinks.has_table(spark, index):
        entries = I.pending(entries, sinks.read_table(spark, index), key)
    meter = I.Meter()
    rows = encoded(entries, text, "embedding", embed) if embed is not None else entries
    touched = sinks.upsert_table(meter.watch(rows), index, key)
    return {"uploaded": meter.result()["docs"], "folders": len(touched), "docs_per_sec": meter.result()["docs_per_sec"]}


def plug_in(name: str) -> Callable:
    """The function that `package.module:function` names."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexloom", description="Chunk tables to an index, year by year; inventories of files; dictionaries of services.")
    p.add_argument("--job", choices=("index", "inventory", "dictionary"), default="index")
    p.add_argument("--source", help="index: table of chunks, partitioned by year; inventory: folder of files by year")
    p.add_argument("--index")
    p.add_argument("--log", help="index: ids that are done")
    p.add_argument("--out", help="inventory: where it is written")
    p.add_argument("--service", help="dictionary: package.module:function of (offset, size) that gives rows")
    p.add_argument("--schema", default="id string, term string, part_of_speech string, definition string", help="dictionary: columns of the service's rows")
    which = p.add_mutually_exclusive_group()
    which.add_argument("--years", nargs="+", type=int, help="these years; without any, all that the source has")
    which.add_argument("--year-range", nargs=2, type=int, metavar=("FROM", "TO"), help="years of the source between these two, in either order")
    p.add_argument("--top-k", type=int, default=12)
    p.add_argument("--weights", choices=sorted(WEIGHTS), default="retrieval")
    p.add_argument("--no-resume", action="store_true", help="leave nothing out that is done already")
    p.add_argument("--recreate-index", action="store_true", help="delete the index and the log first")
    p.add_argument("--verify-resume", action="store_true", help="only say what the log has and the index hasn't")
    p.add_argument("--reverse", action="store_true", help="latest year first")
    return p


#: What each job can't do without.
NEEDS = {"index": ("source", "index", "log"), "inventory": ("source", "out"), "dictionary": ("service", "index")}


def chosen_years(spark: SparkSession, args: argparse.Namespace) -> list[int]:
    """The years that the arguments name; a range, or nothing, is answered by the folders that the source has."""
    if args.years:
        return sorted(set(args.years))
    have = sorted({int(f.removeprefix("year=")) for f in files.folders(spark, args.source) if re.fullmatch(r"(year=)?\d{4}", f)})
    ends = args.year_range or have
    return [y for y in have if min(ends) <= y <= max(ends)]


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> list[dict]:
    """The command line; its result is also printed, a line of JSON each."""
    from lexloom.session import session

    args = parser().parse_args(argv)
    if lacking := [f"--{n}" for n in NEEDS[args.job] if getattr(args, n) is None]:
        parser().error(f"{args.job} needs {', '.join(lacking)}")
    spark = spark or session()
    if args.job == "inventory":
        out = build_inventories(spark, args.source, args.out, chosen_years(spark, args), index=args.index)
    elif args.job == "dictionary":
        if args.recreate_index:
            sinks.purge(spark, [args.index], [])
        out = [index_dictionary(spark, args.schema, plug_in(args.service), args.index, resume=not args.no_resume)]
    elif args.verify_resume:
        out = [r.asDict() for r in missing(spark, args.source, args.index, args.log).orderBy("year").collect()]
    else:
        out = index_years(spark, args.source, args.index, args.log, chosen_years(spark, args), args.reverse, args.recreate_index, top_k=args.top_k, weights=args.weights, resume=not args.no_resume)
    for line in out:
        print(json.dumps(line))
    return out

"""Files as tables: listings, JSON records, JSON lines, PDF headers, progress logs, partitions, inventories."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from lexloom.sources.paths import exists, place


def listing(spark: SparkSession, path: str | list[str], suffix: str = "", recursive: bool = True) -> DataFrame:
    """(path, length, name) of files whose name ends in suffix; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", recursive).load(path)
    return files.select("path", "length", F.regexp_extract("path", "[^/]+$", 0).alias("name"))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of the folders in a folder; none if it is missing."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def file_names(spark: SparkSession, path: str, suffix: str, but: tuple[str, ...] = ("_inventory.json",)) -> DataFrame:
    """(name) of the files under a path that end in suffix, without those of the given names."""
    return listing(spark, path, suffix).where(~F.col("name").isin(*but)).select("name")


def _json(spark: SparkSession, schema: StructType | str):
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED")


def json_records(spark: SparkSession, paths: str | list[str], schema: StructType | str) -> DataFrame:
    """Records of files that hold an object or an array each, with _source_file; damaged files are left out."""
    return _json(spark, schema).json(paths).withColumn("_source_file", F.col("_metadata.file_path"))


def fetch(spark: SparkSession, path: str, schema: StructType | str, suffix: str = ".json", max_files: int | None = None) -> DataFrame:
    """Records of all files under a path, or of the first max_files of them by path, as json_records()."""
    if max_files is None:
        rows = _json(spark, schema).option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").json(path)
        return rows.withColumn("_source_file", F.col("_metadata.file_path"))
    paths = [r.path for r in listing(spark, path, suffix).orderBy("path").limit(max_files).collect()]
    return json_records(spark, paths, schema) if paths else spark.createDataFrame([], schema).withColumn("_source_file", F.lit(None).cast("string"))


def one_by_one(records: DataFrame) -> Iterator[Row]:
    """The records, a partition at a time on the driver: for a consumer that is no Spark job."""
    return records.toLocalIterator(prefetchPartitions=True)


def valid_chunk_files(files: DataFrame, chunks: str = "chunks") -> DataFrame:
    """Files that hold a list of chunks with anything in it (sources.checked says why others don't)."""
    return files.where(F.size(chunks) > 0)


def valid_documents(records: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Records with an id that is not empty."""
    return records.where(F.coalesce(F.col(doc_id).cast("string"), F.lit("")) != "")


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Records of JSON lines; blank and damaged lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def progress(spark: SparkSession, *paths: str) -> DataFrame:
    """Distinct ids of progress logs: a JSON string on each line, a JSON array, or bare text in quotes. Paths that are missing have none."""
    have = [p for p in paths if exists(spark, p)]
    if not have:
        return spark.createDataFrame([], "id string")
    lines = spark.read.text(have).select(F.trim("value").alias("v")).where("v <> ''")
    ids = F.when(F.col("v").startswith("["), F.from_json("v", "array<string>")).otherwise(F.array(F.coalesce(F.get_json_object(F.concat(F.lit('{"x":'), "v", F.lit("}")), "$.x"), F.expr("trim(both '\"' from v)"))))
    return lines.select(F.explode(ids).alias("id")).distinct()


def valid_pdfs(spark: SparkSession, path: str, least: int = 1024) -> DataFrame:
    """(path, length) of files of more than `least` bytes that begin as PDF."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.where((F.col("length") > least) & F.expr("startswith(content, X'255044462D')")).select("path", "length")


#: Pages of one file that a task reads at a time.
PAGES = 8


def _valid_pdf_paths(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.where((F.col("length") > 1024) & F.expr("startswith(content, X'255044462D')")).select("path")


def pdf_texts(spark: SparkSession, path: str, pages: Callable[[bytes], list[str]], recognise: Callable[[bytes], list[str]] | None = None) -> DataFrame:
    """(path, text, page_count, ocr_applied) of the valid PDF files under a path.

    pages: a plug-in that gives the text of each page; texts that don't pass the gate of operators.pages.good_pages go to recognise, if
    there is one, whose result must have 500 characters. A file that neither can read has a null text. Tasks read their files themselves,
    so that one file at a time is in a task's memory.
    """
    from lexloom.functions.text import clean_ocr
    from lexloom.operators.pages import good_pages

    def read(paths: DataFrame, plug_in: Callable[[bytes], list[str]], name: str) -> DataFrame:
        def each(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for frame in frames:
                for one in frame.column("path").to_pylist():
                    try:
                        found = list(plug_in(file_bytes(one)))
                    except Exception:  # noqa: BLE001 - whatever a plug-in raises, the file counts as unreadable
                        found = None
                    yield pa.RecordBatch.from_arrays([pa.array([one]), pa.array([found], pa.list_(pa.string()))], names=["path", name])

        return paths.mapInArrow(each, f"path string, {name} array<string>")

    out = read(_valid_pdf_paths(spark, path), pages, "_pages")
    joined = lambda c: F.array_join(F.transform(c, clean_ocr), "\n\n")
    good = F.coalesce(good_pages(F.col("_pages")), F.lit(False))
    own, count = F.when(good, joined("_pages")), F.coalesce(F.size("_pages"), F.lit(0))
    if recognise is None:
        return out.select("path", own.alias("text"), F.greatest(count, F.lit(0)).alias("page_count"), F.lit(False).alias("ocr_applied"))
    out = out.join(read(out.where(~good).select("path"), recognise, "_ocr"), "path", "left")
    seen = F.when(F.length(joined("_ocr")) >= 500, joined("_ocr"))
    return out.select("path", F.coalesce(own, seen).alias("text"), F.greatest(count, F.coalesce(F.size("_ocr"), F.lit(0)), F.lit(0)).alias("page_count"), (own.isNull() & seen.isNotNull()).alias("ocr_applied"))


def file_bytes(path: str) -> bytes:
    """A whole file, for tasks."""
    where, at = place(path)
    with where.open_input_file(at) as f:
        return f.read()


def pdf_page_texts(spark: SparkSession, path: str, count: Callable[[bytes], int], recognise: Callable[[bytes, int], str]) -> DataFrame:
    """(path, page, text) of each page, from 0, of the valid PDF files under a path: for recognition, which takes seconds a page.

    count gives a file's pages, recognise the text of one. Pages are rows of their own and dealt to all tasks PAGES at a time, so that a file of a
    thousand pages uses all cores; each task opens the file for its pages. A page that fails has a null text; a file whose pages
    can't be counted has one row without a page.
    """

    def counted(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for one in frame.column("path").to_pylist():
                try:
                    n = int(count(file_bytes(one)))
                except Exception:  # noqa: BLE001 - whatever a plug-in raises
                    n = None
                yield pa.RecordBatch.from_arrays([pa.array([one]), pa.array([n], pa.int32())], names=["path", "n"])

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for one, first, n in zip(*(frame.column(c).to_pylist() for c in ("path", "first", "n")), strict=True):
                content, places, texts = None, list(range(first, min(first + PAGES, n))), []
                for i in places:
                    try:
                        content = file_bytes(one) if content is None else content
                        texts.append(recognise(content, i))
                    except Exception:  # noqa: BLE001 - whatever a plug-in raises, the page counts as unreadable
                        texts.append(None)
                yield pa.RecordBatch.from_arrays([pa.array([one] * len(places)), pa.array(places, pa.int32()), pa.array(texts, pa.string())], names=["path", "page", "text"])

    files = _valid_pdf_paths(spark, path).mapInArrow(counted, "path string, n int")
    parts = files.where("n > 0").select("path", "n", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {PAGES}").cast("int"))).alias("part"))
    cores = spark.sparkContext.defaultParallelism
    dealt = parts.select("path", "n", (F.col("part") * PAGES).alias("first")).repartition(max(cores, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    none = files.where("n is null").select("path", F.lit(None).cast("int").alias("page"), F.lit(None).cast("string").alias("text"))
    return dealt.mapInArrow(read, "path string, page int, text string").unionByName(none)


def assembled(page_texts: DataFrame, least: int = 500) -> DataFrame:
    """(path, text, page_count) of pdf_page_texts(): cleaned pages in their order, parted by empty lines; null if there are fewer than `least`
    characters. A group is one file's pages."""
    from lexloom.functions.text import clean_ocr

    ordered = F.sort_array(F.collect_list(F.when(F.col("page").isNotNull(), F.struct("page", F.coalesce("text", F.lit("")).alias("text")))))
    text = F.array_join(F.filter(F.transform("_pages", lambda p: clean_ocr(p["text"])), lambda t: t != ""), "\n\n")
    out = page_texts.groupBy("path").agg(ordered.alias("_pages"))
    return out.select("path", F.when(F.length(text) >= least, text).alias("text"), F.size("_pages").alias("page_count"))


def partitioned(spark: SparkSession, path: str, years: list[int] | None = None, low: int = 1900, high: int = 2100) -> DataFrame:
    """A table partitioned by year, pruned to a list or a range of years (ends in either order)."""
    table = spark.read.parquet(path)
    year = F.col("year")
    return table.where(year.isin(years) if years is not None else year.between(min(low, high), max(low, high)))


def year_files(spark: SparkSession, path: str, years: list[int], suffix: str = ".json") -> DataFrame:
    """(path, length, name, year) of the files in folders `year=Y` or `Y` of the years under a path; only these folders are listed."""
    have = set(folders(spark, path))
    named = [f"{path}/{f}" for y in years for f in (f"year={y}", str(y)) if f in have]
    if not named:
        return spark.createDataFrame([], "path string, length long, name string, year int")
    return listing(spark, named, suffix).withColumn("year", F.regexp_extract("path", r"/(?:year=)?(\d{4})/(?!.*/(?:year=)?\d{4}/)", 1).cast("int"))


def states(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of the states that have a folder `state=S` under a path."""
    return [f.removeprefix("state=") for f in folders(spark, path) if f.startswith("state=")]


def of_state(spark: SparkSession, path: str, state: str, schema: StructType | str) -> DataFrame:
    """Records of one state's folder alone."""
    return fetch(spark, f"{path}/state={state}", schema)


def inventory_names(spark: SparkSession, path: str, *where: Column) -> DataFrame:
    """(name), distinct, of the files in an inventory table; none if there is no such table."""
    if not exists(spark, path):
        return spark.createDataFrame([], "name string")
    table = spark.read.parquet(path)
    for w in where:
        table = table.where(w)
    return table.select(F.explode("files").alias("name")).distinct()


def export_files(files: DataFrame, target: str) -> int:
    """Copy files (path) to a local folder under their names alone; of equal names the last by path stays. The number of paths.
    For a driver's own disk: files come one at a time."""
    from pathlib import Path

    spark = files.sparkSession
    Path(target).mkdir(parents=True, exist_ok=True)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    for row in files.select("path").orderBy("path").toLocalIterator():
        source = hadoop.Path(row.path)
        source.getFileSystem(conf).copyToLocalFile(False, source, hadoop.Path(f"file://{Path(target).resolve()}/{source.getName()}"), True)
        n += 1
    return n

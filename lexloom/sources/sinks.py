"""Tables to files: JSON bundles, versioned upserts, progress logs, manifests, indexes."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from lexloom.functions.values import safe_rows
from lexloom.operators.incremental import name_digests
from lexloom.sources import keyed
from lexloom.sources.files import progress
from lexloom.sources.paths import delete, exists, file_system, files_in, make_folder, read_text, write_text  # noqa: F401 - part of this module's interface

#: Versions of a table that are kept beside the newest, for readers that still use them.
OLD_VERSIONS = 1


def safe_json(row: Column) -> Column:
    """JSON of a struct; NaN and infinities must have been made 0 by functions.values.safe."""
    return F.to_json(row, {"ignoreNullFields": "false"})


def write_json(df: DataFrame, path: str, *, one_file: bool = False) -> None:
    safe_rows(df.coalesce(1) if one_file else df).write.mode("overwrite").json(path)


def write_chunks(chunks: DataFrame, path: str, id_: str = "chunk_id") -> Row:
    """A folder of JSON for each chunk, named after its id (`unknown` without one); the row (total, uploaded, failed, success_rate).
    For few chunks: a file for each is what a file system bears least. Names are counted from what was written."""
    named = safe_rows(chunks).withColumn("_name", F.coalesce(F.col(id_).cast("string"), F.lit("unknown")))
    total = named.count()
    named.repartition("_name").write.mode("overwrite").partitionBy("_name").json(path)
    written = chunks.sparkSession.read.json(path).count() if total else 0
    return Row(total=total, uploaded=written, failed=total - written, success_rate=100.0 * written / total if total else 0.0)


def write_bundle(base: str, timestamp: str | None = None, stats: dict | None = None, spark: SparkSession | None = None, **tables: DataFrame | None) -> dict[str, bool]:
    """Several results under one folder, or one named after a time in it; which of them were written. None is left out."""
    at = f"{base}/{timestamp}" if timestamp else base
    done = {}
    for name, df in tables.items():
        if df is not None:
            write_json(df, f"{at}/{name}")
            done[name] = True
    if stats is not None:
        session = spark or next(df for df in tables.values() if df is not None).sparkSession
        write_text(session, f"{at}/processing_stats.json", json.dumps(stats))
        done["stats"] = True
    return done


def write_marker(spark: SparkSession, path: str, facts: dict | None = None) -> None:
    """A file that says that something is done."""
    write_text(spark, path, json.dumps(facts or {}))


def append_progress(ids: DataFrame, path: str) -> None:
    """Add ids to a log that sources.files.progress reads: a JSON string on each line."""
    ids.select(F.to_json(F.struct(F.col("id").cast("string").alias("x"))).alias("j")).distinct().select(F.regexp_extract("j", r'(?s)^\{"x":(.*)\}$', 1).alias("value")).where("value <> ''").write.mode("append").text(path)


def append_lines(rows: DataFrame, path: str) -> None:
    """Add rows to a folder of JSON lines."""
    safe_rows(rows).write.mode("append").json(path)


def seed_progress(spark: SparkSession, inventory: str, log: str, index_inventory: str) -> bool:
    """Begin an index's progress from the inventory of chunk files: the inventory is copied as uploaded, and its documents' names
    become the log, unless that already has as many ids. Whether it did."""
    files = spark.read.parquet(inventory)
    replace_table(files.withColumn("es_uploaded", F.lit(True)).withColumn("es_seeded_from", F.lit(inventory)), index_inventory)
    ids = files.select(F.explode("files").alias("f")).select(F.regexp_replace("f", r"_all_chunks\.json$", "").alias("id"))
    if progress(spark, log).count() >= ids.count():
        return False
    delete(spark, log)
    append_progress(ids, log)
    return True


def _current(spark: SparkSession, path: str) -> str | None:
    """The folder of a versioned table's newest version; a folder without versions is one itself."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return None
    versions = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith("v"))
    done = [v for v in versions if exists(spark, f"{path}/{v}/_SUCCESS")]
    if done:
        return f"{path}/{done[-1]}"
    return path if not versions and exists(spark, f"{path}/_SUCCESS") else None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that upsert_table() wrote, or the newest whole version of one that replace_table() wrote."""
    if keyed.is_keyed(spark, path):
        return keyed.read(spark, path)
    at = _current(spark, path)
    if at is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.parquet(at)


def replace_table(df: DataFrame, path: str) -> None:
    """A new version of a table. It counts once Spark has marked it as written, so that a run that dies leaves the last one; versions
    before the last are deleted after that."""
    spark = df.sparkSession
    last = _current(spark, path)
    number = int(last.rsplit("/v", 1)[1]) + 1 if last and last != path else 0
    df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{path}/v{number:012d}")
    for more in ("keyed.json", "pending", "rows"):
        delete(spark, f"{path}/{more}")
    fs, p = file_system(spark, path)
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if not name.startswith("v") or int(name[1:]) < number - OLD_VERSIONS:
            fs.delete(s.getPath(), True)


def has_table(spark: SparkSession, path: str) -> bool:
    return keyed.is_keyed(spark, path) or _current(spark, path) is not None


def upsert_table(new: DataFrame, path: str, key: str, order: list[str] | None = None, buckets: int = keyed.BUCKETS) -> list[int]:
    """Merge rows into a table by key (keyed.upsert_rows); the folders that were rewritten. A version that replace_table() wrote becomes the
    table's first rows. A run that dies leaves a whole state, and the same rows again change nothing."""
    spark = new.sparkSession
    if not keyed.is_keyed(spark, path) and (at := _current(spark, path)):
        old = spark.read.parquet(at)
        delete(spark, f"{path}/rows")
        delete(spark, f"{path}/moving")
        keyed.upsert_rows(old, f"{path}/moving", key, buckets=buckets)
        fs, p = file_system(spark, f"{path}/moving/rows")
        fs.rename(p, file_system(spark, f"{path}/rows")[1])
        # The table is keyed from here on; its versions aren't read any more.
        write_text(spark, f"{path}/keyed.json", read_text(spark, f"{path}/moving/keyed.json"))
        delete(spark, f"{path}/moving")
        if at != path:
            for version in files_in(spark, path):
                if version.startswith("v"):
                    delete(spark, f"{path}/{version}")
    return keyed.upsert_rows(new, path, key, order, buckets)


# Column types of an index's field types.
_TYPES: dict[str, DataType] = {"keyword": StringType(), "text": StringType(), "boolean": BooleanType(), "integer": IntegerType(), "long": LongType(), "float": FloatType(), "double": DoubleType(), "date": StringType(), "dense_vector": ArrayType(FloatType())}


def index_schema(mapping: dict | str) -> StructType:
    """The columns of an index from its JSON mapping; nested fields are arrays of structs, unknown types text."""
    mapping = json.loads(mapping) if isinstance(mapping, str) else mapping
    fields = mapping.get("mappings", mapping).get("properties", {})

    def kind(f: dict) -> DataType:
        if "properties" in f:
            inner = index_schema({"properties": f["properties"]})
            return ArrayType(inner) if f.get("type") == "nested" else inner
        return _TYPES.get(f.get("type", ""), StringType())

    return StructType([StructField(name, kind(f)) for name, f in fields.items()])


def ensure_index(spark: SparkSession, path: str, mapping: dict | str, *, recreate: bool = False, shards: int | None = None, replicas: int | None = None) -> bool:
    """An empty table of an index's columns at a path, if there is none or it is to be made anew; whether it was made. Its settings
    (shards 8 and replicas 1 unless the mapping or the arguments say otherwise) are kept beside it."""
    mapping = json.loads(mapping) if isinstance(mapping, str) else mapping
    if recreate:
        delete(spark, path)
        delete(spark, path + ".settings.json")
    if has_table(spark, path):
        return False
    own = mapping.get("settings", {})
    settings = {"number_of_shards": shards or own.get("number_of_shards", 8), "number_of_replicas": own.get("number_of_replicas", 1) if replicas is None else replicas}
    replace_table(spark.createDataFrame([], index_schema(mapping)), path)
    write_text(spark, path + ".settings.json", json.dumps(settings))
    return True


# The columns of a flat search index, and what each kind of collection adds.
SEARCH_FIELDS = "id string, doc_id string, jurisdiction string, date string, start_char int, end_char int, num_sentences int, avg_similarity double, doc_similarity double, role string, confidence double, title string, text string, embedding array<float>"
SEARCH_MORE = {"sc": "source_file string, all_chunks_path string", "hc": "judge string, pdf_link string, cnr string, court string, all_chunks_path string"}


def search_schema(collection: str) -> StructType:
    return StructType.fromDDL(f"{SEARCH_FIELDS}, {SEARCH_MORE[collection]}")


def ensure_search_index(spark: SparkSession, path: str, collection: str, *, recreate: bool = False) -> bool:
    """An empty flat search index at a path, if there is none or it is to be made anew; whether it was made."""
    if recreate:
        delete(spark, path)
    if has_table(spark, path):
        return False
    replace_table(spark.createDataFrame([], search_schema(collection)), path)
    return True


def purge(spark: SparkSession, indexes: list[str], folders: list[str]) -> dict[str, bool]:
    """Delete indexes, their settings, and processed files, for a run from the beginning; what was there."""
    done = {path: delete(spark, path) for path in (*indexes, *folders)}
    for path in indexes:
        delete(spark, path + ".settings.json")
    return done


def manifest(files: DataFrame, by: str, key: str) -> DataFrame:
    """(by, keys): the sorted different keys of each partition, for partitions that fit in a row; write_inventory() is for larger ones."""
    return files.groupBy(by).agg(F.sort_array(F.collect_set(key)).alias("keys"))


def write_inventory(files: DataFrame, path: str, by: str, name: str) -> None:
    """The different names of each partition as sorted rows, parted by range over the tasks, and beside them counts and digests of the partitions
    (`names` and `digests` under the path)."""
    names = files.where(F.col(name).isNotNull()).select(by, name).distinct().repartitionByRange(by, name).sortWithinPartitions(by, name)
    names.write.mode("overwrite").partitionBy(by).parquet(f"{path}/names")
    name_digests(files.sparkSession.read.parquet(f"{path}/names"), by, name).write.mode("overwrite").parquet(f"{path}/digests")


def index_statistics(df: DataFrame) -> DataFrame:
    """Documents, bytes of their JSON, and KB a document."""
    size = F.sum(F.length(F.to_json(F.struct(*df.columns))))
    return df.agg(F.count("*").alias("docs"), size.alias("bytes"), F.round(size / F.greatest(F.count("*"), F.lit(1)) / 1024, 2).alias("kb_per_doc"))

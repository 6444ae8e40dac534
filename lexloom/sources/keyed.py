"""Tables with one row for each key, in folders by a hash of the key: an upsert reads and writes the folders of its keys alone.

Folders are Spark's own partitions, replaced by dynamic partition overwrite. What an upsert makes of the touched folders is first written
beside the table, as a whole: once Spark has marked that as written the upsert counts, and readers take these folders from there. A run
that dies before leaves the last state, one that dies later leaves the new one, and the next upsert puts it in its place.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

from lexloom.operators.incremental import last_of_each, upsert
from lexloom.sources.files import folders
from lexloom.sources.paths import delete, exists, make_folder, read_text, write_text

#: Folders of a new table. A touched folder is rewritten as a whole, so that large tables need more of them.
BUCKETS = 64
_BUCKET = "_bucket"


def _facts(spark: SparkSession, path: str) -> dict | None:
    return json.loads(read_text(spark, f"{path}/keyed.json")) if exists(spark, f"{path}/keyed.json") else None


def is_keyed(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/keyed.json")


def _bucket(key: str, schema: StructType, buckets: int) -> Column:
    """A key's folder: its hash as a value of the table's own type, whatever type the new rows have."""
    return F.pmod(F.xxhash64(F.col(key).cast(schema[key].dataType)), F.lit(buckets)).cast("int")


def _stored(spark: SparkSession, at: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields]).add(_BUCKET, IntegerType())).parquet(at)


def _pending(spark: SparkSession, path: str) -> str | None:
    """The touched folders of an upsert that counts and isn't in its place yet."""
    done = [f for f in folders(spark, f"{path}/pending") if exists(spark, f"{path}/pending/{f}/merged/_SUCCESS")]
    return f"{path}/pending/{done[0]}" if done else None


def _touched(spark: SparkSession, at: str) -> list[int]:
    return sorted(int(f.removeprefix(f"{_BUCKET}=")) for f in folders(spark, at) if f.startswith(f"{_BUCKET}="))


def _rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table with its folder numbers, those of an upsert that isn't in its place yet as that has them."""
    rows = _stored(spark, f"{path}/rows", schema)
    if (at := _pending(spark, path)) is None:
        return rows
    schema = StructType.fromJson(json.loads(read_text(spark, f"{at}/schema.json")))
    rows = _stored(spark, f"{path}/rows", schema)
    return rows.where(~F.col(_BUCKET).isin(_touched(spark, f"{at}/merged"))).unionByName(_stored(spark, f"{at}/merged", schema))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows."""
    return _rows(spark, path, StructType.fromJson(_facts(spark, path)["schema"])).drop(_BUCKET)


def create(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int = BUCKETS) -> None:
    """An empty table, where there is none."""
    make_folder(spark, f"{path}/rows")
    write_text(spark, f"{path}/keyed.json", json.dumps({"key": key, "buckets": buckets, "schema": schema.jsonValue()}))


def _merged_schema(old: StructType, new: StructType) -> StructType:
    """The old columns, and those that only new rows have."""
    return StructType([*old.fields, *(f for f in new.fields if f.name not in old.names)])


def upsert_rows(new: DataFrame, path: str, key: str, order: list[str] | None = None, buckets: int = BUCKETS) -> list[int]:
    """Merge rows into the table at a path, which is made if there is none; the numbers of the folders that were rewritten.

    Of new rows with one key the last by order stays, or without one the greatest row; a null key is a key. Columns that only new rows have
    are null in the others, and columns that they lack are null in them.
    """
    spark = new.sparkSession
    finish(spark, path)
    facts = _facts(spark, path)
    if facts is None:
        create(spark, path, new.schema, key, buckets)
        facts = _facts(spark, path)
    if facts["key"] != key:
        raise ValueError(f"the table at {path} has the key {facts['key']!r}, not {key!r}")
    old = StructType.fromJson(facts["schema"])
    schema = _merged_schema(old, new.schema)
    for leftover in folders(spark, f"{path}/pending"):
        delete(spark, f"{path}/pending/{leftover}")
    at = f"{path}/pending/{uuid.uuid4().hex}"
    rows = last_of_each(new, key, order).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name in new.columns))
    rows = rows.withColumn(_BUCKET, _bucket(key, schema, facts["buckets"]))
    # Written first, so that the source is read once and its folders are known by name.
    rows.write.partitionBy(_BUCKET).parquet(f"{at}/new")
    touched = _touched(spark, f"{at}/new")
    if touched:
        incoming = spark.read.schema(rows.schema).parquet(f"{at}/new")
        existing = _stored(spark, f"{path}/rows", old).where(F.col(_BUCKET).isin(touched))
        merged = upsert(existing, incoming, key, repeated=False).select(*schema.names, _BUCKET).hint("rebalance", _BUCKET)
        write_text(spark, f"{at}/schema.json", json.dumps(schema.jsonValue()))
        merged.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").partitionBy(_BUCKET).parquet(f"{at}/merged")
        finish(spark, path)
    delete(spark, at)
    return touched


def finish(spark: SparkSession, path: str) -> bool:
    """Put what an upsert that counts has written in its place; whether there was any. To do so again changes nothing."""
    if (at := _pending(spark, path)) is None:
        return False
    schema = StructType.fromJson(json.loads(read_text(spark, f"{at}/schema.json")))
    _stored(spark, f"{at}/merged", schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(f"{path}/rows")
    facts = _facts(spark, path)
    if facts["schema"] != schema.jsonValue():
        write_text(spark, f"{path}/keyed.json", json.dumps(facts | {"schema": schema.jsonValue()}))
    return delete(spark, at)

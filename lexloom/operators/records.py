"""Records for an index: metadata of documents, chunk rows, nested parents, safe values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexloom.functions.text import first_filled

# Keys of raw records that are not metadata.
NOT_METADATA = ("text", "full_text", "judgment_text", "embedding", "_source_file", "raw_html_text")
NOT_NESTED = ("raw_html", "description")


def flat_metadata(extra: str = "extra", nested: str = "metadata") -> Column:
    """One map of the keys beside the text: nested ones overwrite those above them."""
    top = F.map_filter(extra, lambda k, v: ~k.isin(*NOT_METADATA))
    low = F.map_filter(F.coalesce(nested, F.expr("cast(map() as map<string,string>)")), lambda k, v: ~k.isin(*NOT_NESTED))
    upper = F.map_filter(top, lambda k, v: ~F.map_contains_key(low, k))
    return F.map_concat(upper, low)


def resolve_date(date: Column, decision_date: Column, year: Column) -> Column:
    return first_filled(date, decision_date, year)


def chunk_rows(chunks: DataFrame, metadata: str = "metadata") -> DataFrame:
    """Chunk rows in which the document's own metadata win over what was computed for id, date and jurisdiction, and lose to the rest."""
    own = [F.coalesce(F.try_element_at(metadata, F.lit(c)), F.col(c)).alias(c) for c in ("doc_id", "date", "jurisdiction")]
    return chunks.select(*own, *(c for c in chunks.columns if c not in ("doc_id", "date", "jurisdiction")))


def parents(chunks: DataFrame, doc: str, order: str, fields: list[str], metadata: list[str]) -> DataFrame:
    """One row a document: metadata of its first chunk, and its chunks with the given fields in order. One shuffle."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), *(F.col(f) for f in fields))))
    out = chunks.groupBy(doc).agg(*(F.min_by(m, order).alias(m) for m in metadata), rows.alias("_c"))
    return out.withColumn("chunks", F.transform("_c", lambda c: F.struct(*(c[f].alias(f) for f in fields)))).drop("_c")


def search_documents(chunks: DataFrame, id_: str = "id", collection: str | None = None) -> DataFrame:
    """Flat rows for a search index: / and space in ids become _, null texts empty, null numbers 0. With a kind of collection (sc, hc),
    exactly its columns, in their order and types: missing ones have these values, an id is by default the chunk's, and source_file
    is the original path."""
    fill = {"string": F.lit(""), "double": F.lit(0.0), "float": F.lit(0.0), "int": F.lit(0), "bigint": F.lit(0)}
    if collection:
        from lexloom.sources.sinks import search_schema

        names = chunks.columns
        source = lambda f: "original_source_path" if f == "source_file" else f
        out = []
        for f in search_schema(collection).fields:
            kind = f.dataType.simpleString()
            empty = fill[kind].cast(kind) if kind in fill else F.expr(f"cast(array() as {kind})")
            value = F.col(source(f.name)).cast(kind) if source(f.name) in names else F.lit(None).cast(kind)
            if f.name == "id":
                value = first_filled(value, F.col("chunk_id").cast("string") if "chunk_id" in names else F.lit("unknown"))
            out.append(F.coalesce(value, empty).alias(f.name))
        return chunks.select(*out).withColumn(id_, F.translate(id_, "/ ", "__"))
    columns = [F.coalesce(F.col(c), fill[t]).cast(t).alias(c) if t in fill else F.col(c) for c, t in chunks.dtypes]
    return chunks.select(*columns).withColumn(id_, F.translate(id_, "/ ", "__"))

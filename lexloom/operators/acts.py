"""Documents of acts: from metadata, a file and its text to a record with chunks, and the records of an index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructType

from lexloom.functions.text import file_name, first_filled, to_bool

# The fields of records that an index keeps.
JUDGMENT_FIELDS = (
    "doc_id", "date", "jurisdiction", "doc_name", "year", "bench", "court_code", "title", "judge", "pdf_link", "cnr", "date_of_registration", "decision_date",
    "disposal_nature", "court", "pdf_exists", "original_source_path", "all_chunks_path", "source_file",
)
ACT_FIELDS = (
    "doc_id", "act_name", "act_number", "year", "state", "state_display", "jurisdiction", "source", "source_url", "handle_id", "pdf_url", "pdf_exists", "pdf_file_size_bytes",
    "language_original", "language_confidence", "ocr_applied", "ocr_page_count", "total_page_count", "_is_translated", "total_chars", "total_chunks", "scrape_timestamp", "processed_at",
)
CHUNK_FIELDS = ("chunk_id", "text", "role", "same_role_chunk_ids")
BOOLEANS = ("pdf_exists", "ocr_applied", "_is_translated")
# Languages that a translator takes, and its codes.
LANGUAGES = {
    "hi": "hin_Deva", "kn": "kan_Knda", "mr": "mar_Deva", "ta": "tam_Taml", "te": "tel_Telu", "ml": "mal_Mlym", "gu": "guj_Gujr", "pa": "pan_Guru", "bn": "ben_Beng", "or": "ory_Orya",
    "as": "asm_Beng", "ur": "urd_Arab", "ne": "npi_Deva", "mai": "mai_Deva", "mni": "mni_Mtei", "kok": "kok_Deva", "doi": "doi_Deva", "sd": "snd_Arab", "ks": "kas_Arab", "sat": "sat_Olck",
}
#: Chunks from which a document is more than its metadata.
LEAST_CHUNKS = 2


def only(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Those of the fields that df has, in their order."""
    return df.select(*(F.col(f"`{c}`") for c in fields if c in df.columns))


def slim_chunks(chunks: str | Column, kind: StructType, fields: tuple[str, ...] = CHUNK_FIELDS) -> Column:
    """An array of chunks, structs of a kind, with only those of the fields that they have."""
    return F.transform(chunks, lambda c: F.struct(*(c[f].alias(f) for f in fields if f in kind.names)))


def with_service_type(df: DataFrame, column: str = "subservice") -> DataFrame:
    """service_type lifted from a struct, or from JSON text that holds an object; where that is neither, nothing is added or the value is null."""
    if column not in df.columns:
        return df
    kind = df.schema[column].dataType
    if isinstance(kind, StructType):
        return df.withColumn("service_type", F.col(column)["service_type"]) if "service_type" in kind.names else df
    return df.withColumn("service_type", F.get_json_object(column, "$.service_type")) if isinstance(kind, StringType) else df


def with_chunks_path(df: DataFrame, fallback: str, name: str = "all_chunks_path") -> DataFrame:
    """The path of a document's chunks, by default that in the column fallback."""
    return df.withColumn(name, F.coalesce(F.col(name), F.col(fallback)) if name in df.columns else F.col(fallback))


def jurisdiction(df: DataFrame, constant: str | None = None) -> Column:
    """The configured one, else that of the record, else its court, else its bench."""
    if constant:
        return F.lit(constant)
    return first_filled(*(F.col(c) if c in df.columns else F.lit(None).cast("string") for c in ("jurisdiction", "court", "bench")))


def needs_translation(lang: Column) -> Column:
    """Whether a translator should get texts of a language."""
    return F.coalesce(~lang.isin("en", "unknown") & lang.isin(*LANGUAGES), F.lit(False))


def translator_code(lang: Column) -> Column:
    """The translator's code of a language; null if it has none."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in LANGUAGES.items() for x in kv)), lang)


def state_name(key: Column) -> Column:
    """A state's key as its name: words in capitals but for `and`, which names of two parts have between them."""
    # Keys of which the rule leaves a word out.
    odd = {"andaman_nicobar": "Andaman and Nicobar Islands", "dadra_nagar_haveli_daman_diu": "Dadra and Nagar Haveli and Daman and Diu", "jammu_kashmir": "Jammu and Kashmir"}
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in odd.items() for x in kv)), key), F.initcap(F.translate(key, "_", " ")))


def not_bookkeeping(path: Column) -> Column:
    """Whether a path is a document's: neither an inventory nor a marker."""
    return ~path.endswith("_inventory.json") & ~path.contains("_done_")


def with_pdf(acts: DataFrame, files: DataFrame, name: str = "act_name", doc_id: str = "doc_id") -> DataFrame:
    """Acts with pdf_name, pdf_exists and pdf_file_size_bytes: the file is named after the act's title, else after its id. files: (name,
    length), of each name the first. Two equi-joins; Spark chooses how by the sides' sizes."""
    one = files.groupBy("name").agg(F.min("length").alias("length"))
    first, second = (one.select(F.col("name").alias(f"_n{i}"), F.col("length").alias(f"_l{i}")) for i in (1, 2))
    out = acts.join(first, F.concat(file_name(F.coalesce(name, F.lit("Unknown"))), F.lit(".pdf")) == F.col("_n1"), "left").join(second, F.concat(doc_id, F.lit(".pdf")) == F.col("_n2"), "left")
    out = out.withColumns({"pdf_name": F.coalesce("_n1", "_n2"), "pdf_file_size_bytes": F.coalesce("_l1", "_l2", F.lit(0)).cast("long")})
    return out.withColumn("pdf_exists", F.col("pdf_name").isNotNull()).drop("_n1", "_n2", "_l1", "_l2")


def record(acts: DataFrame, source: str, country: str) -> DataFrame:
    """Records of acts without their chunks: missing values are empty text, year 0 and `Unknown`."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c) if c in acts.columns else F.lit("").alias(c)
    year = F.coalesce(F.col("year").cast("int"), F.lit(0)).alias("year")
    rest = [c for c in acts.columns if c not in ("doc_id", "act_name", "act_number", "year", "jurisdiction", "source", "pdf_url", "handle_id", "text")]
    return acts.select("doc_id", F.coalesce("act_name", F.lit("Unknown")).alias("act_name"), text("act_number"), year, F.lit(country).alias("jurisdiction"), F.lit(source).alias("source"), text("pdf_url"), text("handle_id"), text("text"), *rest)


def processed(records: DataFrame, chunks: DataFrame, fields: tuple[str, ...] = ("chunk_id", "text"), least: int = LEAST_CHUNKS) -> DataFrame:
    """Records without their text and with their chunks in order, ids made of the document's and the chunk's; fewer than `least` chunks
    are none. chunks: (doc_id, chunk_id, ...). One shuffle of each side by document."""
    named = chunks.withColumn("_i", F.col("chunk_id")).withColumn("chunk_id", F.concat_ws("_", "doc_id", "chunk_id"))
    own = named.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("_i", *fields))).alias("_c"))
    own = own.where(F.size("_c") >= least).select("doc_id", F.transform("_c", lambda c: F.struct(*(c[f].alias(f) for f in fields))).alias("chunks"))
    out = records.drop("text").join(own, "doc_id", "left")
    kind = own.schema["chunks"].dataType.simpleString()
    out = out.withColumn("chunks", F.coalesce("chunks", F.expr(f"cast(array() as {kind})")))
    return out.withColumn("total_chunks", F.size("chunks").cast("long"))


def index_records(docs: DataFrame, fields: tuple[str, ...] = ACT_FIELDS) -> DataFrame:
    """Records for an index: the fields and chunks, text truth values made boolean, ids from the file's name where they are missing."""
    out = docs
    for c in BOOLEANS:
        if c in docs.columns and isinstance(docs.schema[c].dataType, StringType):
            out = out.withColumn(c, to_bool(F.col(c)))
    if "path" in docs.columns:
        out = out.withColumn("doc_id", first_filled(F.col("doc_id"), F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)))
    return only(out, (*fields, "chunks"))

"""Queries of the library's operators over the test tables, and the same in DuckDB's SQL."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lexloom import jobs
from lexloom.functions import text as T, values, vectors as V
from lexloom.operators import acts, chunking, incremental as I, language, pages as P, records as R, roles, select as S
from lexloom.session import spread
from lexloom.sources import checked, files, services
from lexloom.streaming import events as E

WEIGHTS = {"user": 3.0, "assistant": 0.4, "system": 2.5}
SOME_ZERO = {"user": 3.0, "assistant": 0.0, "system": 2.5}
HEADERS = ("", "THE SUPREME COURT REPORTS [2020] 1 S.C.R.) ", "(A. B. SINGH, C. D. RAO JJ.) SUPREME COURT REPORTS 12] ", "(2019) (2019 AIR SC 12) inter- national ")


#: Tables of texts, whose rows take long.
LARGE = ("documents", "pages")


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    table = spark.read.parquet(f"{d}/{name}.parquet")
    return spread(table) if name in LARGE else table


def _headed(spark: SparkSession, d: str) -> DataFrame:
    head = F.element_at(F.array(*[F.lit(h) for h in HEADERS]), (F.col("doc_id") % 4 + 1).cast("int"))
    return _t(spark, d, "documents").withColumn("text", F.concat(head, F.coalesce("text", F.lit(""))))


_HEADED = "(select doc_id, lang, source, n_chars, case doc_id % 4 " + " ".join(f"when {i} then '{h}'" for i, h in enumerate(HEADERS)) + " end || coalesce(text, '') as text from documents)"
_CLEAN = "text"
for _p, _b, _f in ((r"THE SUPREME COURT REPORTS.*?\)", "", "gi"), (r"\([A-Z\.\s,;:]+JJ?\.\)", "", "g"), (r"SUPREME COURT REPORTS.*?\]", "", "gi"), (r"\(\d{4}[^)]*[A-Z]{2,}[^)]*\)", "", "g"), (r"-\s+", "", "g"), (r"\s+", " ", "g")):
    _CLEAN = f"regexp_replace({_CLEAN}, '{_p}', '{_b}', '{_f}')"
_CLEAN = f"trim({_CLEAN})"
_SENTENCES = f"list_filter(list_transform(string_split(regexp_replace(c, '([.!?])\\s+([A-Z])', '\\1‖\\2', 'g'), '‖'), lambda x: trim(x)), lambda x: x <> '')"


_HITS = ", ".join(f"len(list_filter(l, lambda x: x in ({', '.join(repr(w) for w in own)}))) as {lang}" for lang, own in language.COMMON.items())
_BEST = f"greatest({', '.join(language.COMMON)})"
_LANG = rf"""with w as (select doc_id, string_split_regex(lower(text[:{language.HEAD}]), '[^\p{{L}}]+') as l from documents), s as (select doc_id, {_HITS} from w)
        select doc_id, case when coalesce({_BEST}, 0) = 0 then 'unknown' {" ".join(f"when {x} = {_BEST} then '{x}'" for x in language.COMMON)} end as detected,
            case when coalesce({_BEST}, 0) = 0 then 0.0 else round({_BEST} / ({" + ".join(language.COMMON)}), 4) end as prob from s"""


_WORDS_SQL = "regexp_extract_all(lower({}), '[\\p{{L}}\\p{{N}}_]+')"
_BUCKET = "(('0x' || substr(md5(w), 1, 8))::bigint % 64)"
def _chunks_sql(threshold: float, least: int, most: int, roles: dict[str, list[str]] | None = None) -> str:
    """Chunks of documents; with roles, those that a change of role closes too, and what roles their sentences have."""
    names = list(roles or {"": []})
    centers = V.hashed_embedding([" ".join(x) for x in (roles or {"": []}).values()])
    known = ", ".join(f"({i}, {b}, {w!r}::double)" for i, c in enumerate(centers.tolist()) for b, w in enumerate(c) if w or not b)
    named = "case role " + " ".join(f"when {i} then '{n}'" for i, n in enumerate(names)) + " end"
    of_roles = f""", rr as (select g.doc_id, g.g, role, count(*) as n, min(g.i) as first from g join sr on sr.doc_id = g.doc_id and sr.i = g.i group by 1, 2, 3),
    rc as (select doc_id, g, arg_min({named}, (-n, first)) as dominant_role, round(max(n) / sum(n), 4) as role_purity, string_agg({named} || ':' || n, ',' order by {named}) as counts from rr group by 1, 2)
    select k.doc_id, k.id as chunk_id, k.n as num_sentences, pos::bigint as start_char, (pos + length(t))::bigint as end_char, dominant_role, role_purity, counts from k join rc on rc.doc_id = k.doc_id and rc.g = k.g"""
    chunks = f"""with recursive d as (select doc_id, {_CLEAN} as c from documents where text is not null),
    s as (select doc_id, generate_subscripts(s, 1) as i, unnest(s) as s from (select doc_id, {_SENTENCES} as s from d)),
    v as (select doc_id, i, b, count(*) as n from (select doc_id, i, {_BUCKET} as b from (select doc_id, i, unnest({_WORDS_SQL.format("s")}) as w from s)) group by 1, 2, 3),
    q as (select doc_id, i, sqrt(sum(n * n)) as norm from v group by 1, 2),
    m as (select a.doc_id, b.i, sum(a.n * b.n) as p from v a join v b on a.doc_id = b.doc_id and a.i + 1 = b.i and a.b = b.b group by 1, 2),
    x as (select s.doc_id, s.i, coalesce(p / (e.norm * f.norm), 0) as x from s left join m on m.doc_id = s.doc_id and m.i = s.i left join q e on e.doc_id = s.doc_id and e.i = s.i left join q f on f.doc_id = s.doc_id and f.i = s.i - 1 where s.i > 1),
    sr as (select s.doc_id, s.i, coalesce(min(role) filter (where p = best), 0) as role from s left join (select *, max(p) over (partition by doc_id, i) as best from (select v.doc_id, v.i, role, round(sum(v.n * w) / any_value(norm), 9) as p from v join (values {known}) c(role, b, w) on c.b = v.b join q on q.doc_id = v.doc_id and q.i = v.i group by 1, 2, 3)) p on p.doc_id = s.doc_id and p.i = s.i group by 1, 2),
    z as (select x.*, role from x join sr on sr.doc_id = x.doc_id and sr.i = x.i),
    f as (select doc_id, i, 1::bigint as g, 1::bigint as cur, role from sr where i = 1
        union all select f.doc_id, z.i, case when (x < {threshold} or cur >= {most} or z.role <> f.role) and cur >= {least} then g + 1 else g end, case when (x < {threshold} or cur >= {most} or z.role <> f.role) and cur >= {least} then 1 else cur + 1 end,
            case when (x < {threshold} or cur >= {most} or z.role <> f.role) and cur >= {least} then z.role else f.role end from f join z on z.doc_id = f.doc_id and z.i = f.i + 1),
    l as (select doc_id, max(g) as last, max_by(cur, i) as cur from f group by 1),
    g as (select f.doc_id, f.i, case when f.g = last and last > 1 and l.cur < {least} then last - 1 else f.g end as g from f join l using (doc_id)),
    o as (select doc_id, i, sum(length(s) + 1) over (partition by doc_id order by i) - length(s) - 1 as pos from s),
    c as (select g.doc_id, g.g, string_agg(s, ' ' order by g.i) as t, count(*) as n, min(pos) as pos, avg(case when g.i > h.first then x.x end) as near
        from g join s on s.doc_id = g.doc_id and s.i = g.i join o on o.doc_id = g.doc_id and o.i = g.i join (select doc_id, g, min(i) as first from g group by 1, 2) h on h.doc_id = g.doc_id and h.g = g.g left join x on x.doc_id = g.doc_id and x.i = g.i group by 1, 2),
    k as (select *, row_number() over (partition by doc_id order by g) as id from c where length(t) >= 100)"""
    if roles:
        return chunks + of_roles
    return chunks + f""",
    cv as (select doc_id, id, b, count(*) as n from (select doc_id, id, {_BUCKET} as b from (select doc_id, id, unnest({_WORDS_SQL.format("t")}) as w from k)) group by 1, 2, 3),
    dv as (select doc_id, b, count(*) as n from (select doc_id, {_BUCKET} as b from (select doc_id, unnest({_WORDS_SQL.format("c")}) as w from d)) group by 1, 2),
    r as (select cv.doc_id, id, sum(cv.n * dv.n) / (sqrt(sum(cv.n * cv.n)) * any_value(w.norm)) as sim from cv left join dv on dv.doc_id = cv.doc_id and dv.b = cv.b join (select doc_id, sqrt(sum(n * n)) as norm from dv group by 1) w on w.doc_id = cv.doc_id group by 1, 2)
    select k.doc_id, k.id as chunk_id, md5(t) as chunk_md5, k.n as num_sentences, pos::bigint as start_char, (pos + length(t))::bigint as end_char, round(coalesce(near, 1.0), 4) as avg_similarity, round(coalesce(sim, 0), 4) as doc_similarity
    from k left join r on r.doc_id = k.doc_id and r.id = k.id"""


def clean_text(spark, d):
    c = T.clean(F.col("text"))
    return _headed(spark, d).select("doc_id", F.md5(c.cast("binary")).alias("cleaned_md5"), F.length(c).cast("long").alias("n"), F.round(T.reduction_percent(F.col("text"), c), 4).alias("reduction"))


def sentence_stats(spark, d):
    s = _headed(spark, d).select("doc_id", T.sentences(T.clean(F.col("text"))).alias("s"))
    return s.where(F.size("s") > 0).select("doc_id", F.size("s").cast("long").alias("n_sentences"), F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("n_chars"))


def ocr_clean(spark, d):
    page = F.concat(F.lit("a\t\tb  c-\nd\n\n\n\n"), F.col("text"))
    return _t(spark, d, "documents").select("doc_id", F.md5(T.clean_ocr(page).cast("binary")).alias("page_md5"))


def doc_id_from_path(spark, d):
    path = F.concat(F.lit("app/raw/"), F.regexp_replace("url", "^https?://", ""), F.lit("/x y-"), F.col("page_id"), F.lit(".json"))
    return _t(spark, d, "pages").select("page_id", T.document_id(path).alias("id"), T.stem(path).alias("stem"), T.chunk_file(path).alias("chunk_path"))


def act_slug(spark, d):
    h = F.concat(F.lit("00"), F.col("p_partkey"), F.lit("/"), F.col("p_size"))
    return _t(spark, d, "part").select("p_partkey", T.act_slug(h).alias("slug"), T.act_slug(F.col("p_name")).alias("plain"))


def filename_sanitize(spark, d):
    return _t(spark, d, "part").select("p_partkey", T.file_name(F.concat(F.col("p_name"), F.lit(' : a/b?  "c" '), F.col("p_type"))).alias("file"))


def year_extract(spark, d):
    return _t(spark, d, "part").select("p_partkey", T.year(F.concat(F.lit("Act of "), F.col("p_partkey") + 1500), F.col("p_name"), F.concat(F.lit("No. 7 of 18"), F.col("p_size"))).alias("year"))


def html_title_links(spark, d):
    h = F.col("html")
    links = P.links(h)
    return _t(spark, d, "pages").select("page_id", P.title(h).alias("title"), F.size(links).cast("long").alias("n_links"), F.array_join(F.array_distinct(links), "|").alias("links"), P.english_pdf(F.concat(F.col("url"), F.lit("/a.PDF"))).alias("pdf"))


def role_distribution(spark, d):
    return roles.distribution(_t(spark, d, "conversations"))


def per_conv_roles(spark, d):
    shares = chunking.role_shares(_t(spark, d, "conversations"), ["conv_id"], "role", "turn")
    counts = F.array_join(F.transform(F.array_sort(F.map_entries("role_distribution")), lambda x: F.concat_ws(":", x["key"], x["value"])), ",")
    return shares.select("conv_id", F.col("dominant_role").alias("dominant"), F.round("role_purity", 6).alias("purity"), counts.alias("counts"))


def same_role_ids(spark, d):
    c = _t(spark, d, "conversations").dropDuplicates(["conv_id", "turn"])
    out = S.same_role_ids(c.withColumn("id", F.concat_ws("-", "conv_id", "turn")), "conv_id", "role", "turn", "id")
    return out.select("conv_id", "turn", F.array_join("same_role_ids", ",").alias("others"))


def topk_by_similarity(spark, d):
    c = _t(spark, d, "conversations").withColumn("sim", F.floor(F.length("text") / 200).cast("long"))
    return S.top_k(c, 3, "conv_id", "turn", "sim").select("conv_id", "turn", "sim")


def _weighted(weights, sim):
    def query(spark, d):
        c = _t(spark, d, "conversations").withColumn("sim", F.expr(sim))
        return S.weighted_top_k(c, 3, weights, "conv_id", "turn", "role", "sim").select("conv_id", "turn", "role")

    return query


def _weighted_sql(weights, sim):
    w = "case role " + " ".join(f"when '{r}' then {round(10 * x)}" for r, x in weights.items()) + " else 10 end"
    return f"""with c as (select conv_id as doc, turn as pos, role, {sim} as sim, {w} as w from conversations),
    a as (select *, count(*) over (partition by doc) n, count(*) over (partition by doc, role) nr, min(pos) over (partition by doc, role) f,
        row_number() over (partition by doc, role order by sim desc, pos) rk, row_number() over (partition by doc order by sim desc, pos) gr,
        sum(greatest(w, 0)) over (partition by doc) tot from c),
    b as (select *, coalesce(tot > 0 and w > 0 and rk <= (3 * nr * w) // nullif(tot, 0), false) base from a),
    e as (select *, sum(base::int) over (partition by doc) nb, w > 0 and not base as o from b),
    g as (select *, row_number() over (partition by doc, o order by sim desc, f, rk) fr from e)
    select doc as conv_id, pos as turn, role from g where n <= 3 or (tot = 0 and gr <= 3) or base or (o and tot > 0 and fr <= 3 - nb)"""


def adjacent_cosine(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), F.floor(F.col("vec_id") / 25).alias("doc"))
    return S.adjacent_cosines(e, "doc", "vec_id").select("vec_id", F.round("cosine", 6).alias("cosine"))


def semantic_groups(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), F.floor(F.col("vec_id") / 25).alias("doc"))
    g = e.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "v"))), lambda x: x["v"]).alias("v"))
    g = g.withColumn("sims", F.zip_with(F.slice("v", 1, F.size("v") - 1), F.slice("v", 2, F.size("v")), V.cosine))
    return g.select("doc", F.array_join(chunking.group_lengths("sims", 0.1, 2, 12), ",").alias("lengths"))


def centroid_roles(spark, d):
    centers = {f"r{i}": [1.0 if j % 5 == i else 0.0 for j in range(64)] for i in range(5)}
    e = _t(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return roles.nearest_centroid(e, centers).select("vec_id", "role")


def softmax_argmax(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return e.select("vec_id", V.argmax("v").cast("long").alias("best"), F.round(F.array_max(V.softmax("v")), 6).alias("p"))


def unit_vectors(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda x: x * 3).alias("v"))
    return e.select("vec_id", F.round(F.element_at(V.unit("v"), 1), 6).alias("first"))


def semantic_chunks(spark, d):
    return chunking.semantic_chunks(_t(spark, d, "documents"), threshold=0.47, embed=V.hashed_counts).select("doc_id", "chunk_id", F.md5(F.col("text").cast("binary")).alias("chunk_md5"), "num_sentences", "start_char", "end_char", "avg_similarity", "doc_similarity")


def translation_segments(spark, d):
    s = _t(spark, d, "documents").select("doc_id", F.posexplode(chunking.translation_segments("text")).alias("place", "segment"))
    return s.select("doc_id", F.col("place").cast("long").alias("place"), F.md5(F.col("segment").cast("binary")).alias("segment_md5"))


def _raw_names(spark, d):
    return _t(spark, d, "documents").select(F.concat(F.col("doc_id"), F.lit(".json")).alias("name"))


def delta1(spark, d):
    return I.without_chunks(_raw_names(spark, d), _t(spark, d, "labels").select(T.chunk_name(F.concat(F.col("doc_id"), F.lit(".json"))).alias("name")))


def delta2(spark, d):
    chunked = _raw_names(spark, d).select(T.chunk_name(F.col("name")).alias("name"))
    return I.not_indexed(chunked, _t(spark, d, "labels").select(F.col("doc_id").cast("string").alias("doc_id")))


def marker_filter(spark, d):
    path = lambda name: F.concat(F.lit("app/raw/"), F.col(name), F.lit(".json"))
    items = _t(spark, d, "documents").select("doc_id", T.marker_file(path("doc_id")).alias("marker"))
    left = I.unmarked(items, _t(spark, d, "labels").select(T.marker_file(path("doc_id")).alias("path")), F.col("marker"))
    return left.select("doc_id", "marker", T.document_key(F.col("marker")).alias("key"))


def progress_filter(spark, d):
    return I.pending(_t(spark, d, "customer").select("c_custkey", "c_name"), _t(spark, d, "events").select(F.col("user_id").alias("c_custkey")), "c_custkey")


def index_prefilter(spark, d):
    return I.present(_t(spark, d, "customer").select("c_custkey", "c_name"), _t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


def _years(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").cast("long").alias("year"))


def coverage_flag(spark, d):
    c = I.coverage(_years(spark, d), _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "year")
    return c.select("year", "total", "found", F.round("ratio", 6).alias("ratio"), "uploaded")


def verify_missing(spark, d):
    return I.pending(_years(spark, d), _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey").groupBy("year").agg(F.count("*").alias("missing"))


def first_path_lookup(spark, d):
    docs = _t(spark, d, "documents").select(F.col("n_chars").alias("name"), F.concat_ws("/", "source", "doc_id").alias("path"))
    wanted = docs.select("name").union(docs.select(F.col("name") + 1)).distinct()
    return I.lookup_path(wanted, docs.where("path like 'src1/%'"), docs).select("name", "path")


def inventory_build(spark, d):
    inv = I.inventory(_years(spark, d).withColumn("file", F.concat(F.col("o_orderkey"), F.lit(".json"))), ["year"], "file")
    return inv.select("year", "file_count", F.md5(F.array_join("files", ",").cast("binary")).alias("files_md5"))


def inventory_merge(spark, d):
    raw = _years(spark, d)
    found = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.year("l_shipdate").cast("long").alias("year"))
    return I.merged(raw, found.select("o_orderkey", "year")).groupBy("year").agg(F.count("*").alias("n"))


def inventory_summary(spark, d):
    out = I.summary(_years(spark, d).groupBy("year").agg(F.count("*").alias("file_count")))
    return out.select("years", "files", F.array_join("listed", ",").alias("listed"))


def set_diff_progress(spark, d):
    return I.difference(_t(spark, d, "documents").select("doc_id"), _t(spark, d, "labels").select("doc_id"))


def progress_union(spark, d):
    return I.merged(_t(spark, d, "events").select(F.col("user_id").alias("id")), _t(spark, d, "orders").select(F.col("o_custkey").alias("id")))


def dedup_first_seen(spark, d):
    return I.first_seen(_t(spark, d, "events").select("event_id", "ts", "user_id", "event_type"), "user_id", "ts", "event_id").select("user_id", "event_id", "event_type")


def count_per_year(spark, d):
    return I.per_partition(_years(spark, d), "year")


def year_filter_limit(spark, d):
    y = _years(spark, d).where(F.col("year").between(1996, 1998))
    return I.first_of_each(y, "year", 10, "o_orderkey").select("year", "o_orderkey", F.col("place").cast("long").alias("place"))


def bool_coerce(spark, d):
    value = F.when(F.col("l_linenumber") == 1, " True ").when(F.col("l_linenumber") == 2, "false").otherwise(F.col("l_returnflag"))
    return _t(spark, d, "lineitem").groupBy(T.to_bool(value).alias("flag")).agg(F.count("*").alias("n"))


def int_coerce(spark, d):
    v = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.get_json_object("props", "$.k"))
    return _t(spark, d, "events").select("event_id", T.int_or_same(F.concat(F.lit(" "), v)).alias("n"))


def coalesce_fields(spark, d):
    docs = _t(spark, d, "documents").join(_t(spark, d, "labels").dropDuplicates(["doc_id"]), "doc_id", "left")
    date = R.resolve_date(F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("source")), F.col("quality").cast("string"), F.col("lang"))
    return docs.select("doc_id", date.alias("date"), T.first_filled(F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("lang")), F.col("source")).alias("court"))


def nested_parent_docs(spark, d):
    c = _t(spark, d, "conversations").dropDuplicates(["conv_id", "turn"])
    p = R.parents(c.withColumn("n", F.length("text")), "conv_id", "turn", ["role", "n"], ["role"])
    return p.select("conv_id", F.col("role").alias("first_role"), F.array_join(F.transform("chunks", lambda x: F.concat_ws(":", x["role"], x["n"])), ",").alias("chunks"))


def json_sanitize(spark, d):
    v = F.when(F.col("vec_id") % 7 == 0, F.lit(float("nan"))).when(F.col("vec_id") % 11 == 0, F.lit(float("inf"))).otherwise(F.element_at("embedding", 1).cast("double"))
    return _t(spark, d, "embeddings").select("vec_id", F.round(T.finite(v), 6).alias("x"))


def upsert_index(spark, d):
    """All customers, with what their latest order says."""
    c = _t(spark, d, "customer").select("c_custkey", F.col("c_name").alias("said"), F.round("c_acctbal", 2).alias("amount"), F.lit(None).cast("long").alias("of_order"))
    o = _t(spark, d, "orders").select((F.col("o_custkey") + F.when(F.col("o_orderstatus") == "O", 0).otherwise(10_000_000)).alias("c_custkey"), F.col("o_orderpriority").alias("said"), F.round("o_totalprice", 2).alias("amount"), F.col("o_orderkey").alias("of_order"))
    return I.upsert(c, o, "c_custkey", ["of_order"])


def _known_to_service(index, keys):
    """A stand-in for a search service: it knows most of each year's orders, all of some years', and is down for one year."""
    if index == 1995:
        raise OSError("no such index")
    return {k for k in keys if index % 2 or k % 400}


def probe_coverage(spark, d):
    found = services.probed(_years(spark, d), _known_to_service, "o_orderkey", "year", attempts=2, delay=0.0)
    return services.probed_coverage(found, by="year").withColumn("ratio", F.round("ratio", 6))


_DAMAGE = ("'{\"id\": \"' || doc_id || '\", \"chunks\": [1, 2]}'", "'{\"id\": \"' || doc_id", "'[]'", "'{\"id\": \"\", \"chunks\": [1]}'", "'[{\"id\": \"' || doc_id || '\", \"chunks\": []}, {\"id\": \"x' || doc_id || '\", \"chunks\": [3]}]'", "cast(null as string)")


def inventory_digests(spark, d):
    """What the years of two inventories say of their names, and which years differ."""
    o = I.name_digests(_t(spark, d, "orders").select(F.year("o_orderdate").cast("long").alias("year"), F.concat("o_orderkey", F.lit(".json")).alias("name")), "year", "name")
    line = _t(spark, d, "lineitem").select("l_orderkey").distinct().withColumnRenamed("l_orderkey", "o_orderkey").join(_years(spark, d), "o_orderkey")
    n = I.name_digests(line.select("year", F.concat("o_orderkey", F.lit(".json")).alias("name")), "year", "name")
    changed = I.changed_partitions(o, n, "year").withColumn("changed", F.lit(True))
    return o.join(changed, "year", "left").withColumn("changed", F.coalesce("changed", F.lit(False)))


def _word_scores():
    """A stand-in for a classifier: its scores are counts in the text."""
    return lambda texts: [[t.count(" ") / 4.0, t.count("e") / 8.0, 1.0] for t in texts]


def role_probabilities(spark, d):
    c = _t(spark, d, "conversations").select("conv_id", "turn", "text")
    got = roles.classified(c, _word_scores, ["words", "letters", "none"])
    each = [F.col("probabilities")[n].alias(f"p_{n}") for n in ("words", "letters", "none")]
    return got.select("conv_id", "turn", "predicted_role", *each)


def read_rejects(spark, d):
    """Files of six kinds, one for each document: how many records are good, and why others aren't."""
    content = F.expr(f"case doc_id % {len(_DAMAGE)} " + " ".join(f"when {i} then {x}" for i, x in enumerate(_DAMAGE)) + " end")
    read = _t(spark, d, "documents").select(F.col("source").alias("path"), content.alias("content"), F.when(content.isNull(), "OSError: gone").alias("error"))
    rows = checked.checked(read, StructType.fromDDL("id string, chunks array<int>"), "id", "chunks")
    return rows.groupBy("path", F.coalesce("reason", F.lit("good")).alias("reason")).agg(F.count("*").alias("n"), F.sum(F.length("record.id")).alias("id_chars"))


def stats_rollup(spark, d):
    return I.run_statistics(_t(spark, d, "events"), ["event_type"], F.col("value") > 5).withColumn("rate", F.round("rate", 4))


def role_weight_map(spark, d):
    return S.with_weights(_t(spark, d, "conversations"), WEIGHTS).select("conv_id", "turn", "weight")


def label_encode(spark, d):
    return roles.label_codes(_t(spark, d, "documents"), "lang").select(F.col("code").cast("long").alias("code"), "lang")


def search_documents(spark, d):
    c = _t(spark, d, "conversations").select(F.concat_ws("/ ", "conv_id", "turn").alias("id"), F.when(F.col("turn") % 2 == 0, F.col("role")).alias("role"), F.col("turn").alias("n"))
    return R.search_documents(c)


def search_index_documents(spark, d):
    c = _t(spark, d, "conversations").select(F.concat_ws("/ ", "conv_id", "turn").alias("chunk_id"), "role", F.length("text").alias("end_char"), F.col("turn").cast("string").alias("court"))
    return R.search_documents(c, collection="hc").drop("embedding")


def lang_detect(spark, d):
    found = language.by_words("text")
    return _t(spark, d, "documents").select("doc_id", found["lang"].alias("detected"), found["prob"].alias("prob"))


def language_model(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text", "lang")
    return language.detect(language.train(docs), docs).select("doc_id", "lang", "language", "language_confidence")


def ocr_normalise(spark, d):
    page = F.concat(F.lit("a\t\tb  c-\nd\n\n\n\n"), F.col("text"))
    return _t(spark, d, "documents").select("doc_id", F.md5(T.normalise_ocr(page).cast("binary")).alias("page_md5"))


def act_pdf_match(spark, d):
    part = _t(spark, d, "part")
    acts_ = part.select(F.concat(F.lit("CA_"), "p_partkey").alias("doc_id"), F.concat_ws(": ", "p_name", "p_partkey").alias("act_name"))
    title = part.where("p_size <= 20").select(F.concat(T.file_name(F.concat_ws(": ", "p_name", "p_partkey")), F.lit(".pdf")).alias("name"), F.col("p_size").alias("length"))
    own = part.where("p_size between 15 and 35").select(F.concat(F.lit("CA_"), "p_partkey", F.lit(".pdf")).alias("name"), (F.col("p_size") + 100).alias("length"))
    return acts.with_pdf(acts_, title.unionByName(own)).select("doc_id", "pdf_name", "pdf_exists", "pdf_file_size_bytes")


def act_documents(spark, d):
    c = _t(spark, d, "conversations").dropDuplicates(["conv_id", "turn"]).withColumn("doc_id", F.col("conv_id").cast("string"))
    named = c.select("doc_id", F.lit(None).cast("string").alias("act_name"), F.lit(None).cast("int").alias("year")).distinct()
    short = c.where("role <> 'system'").select("doc_id", F.col("turn").alias("chunk_id"), "text")
    out = acts.processed(acts.record(named, "somewhere", "Nowhere"), short)
    ids = F.array_join(F.transform("chunks", lambda x: x["chunk_id"]), ",")
    return out.select("doc_id", "act_name", F.col("year").cast("long").alias("year"), T.year_folder(F.col("year")).alias("folder"), "total_chunks", ids.alias("chunk_ids"))


def act_index_records(spark, d):
    docs = _t(spark, d, "documents").select(F.when(F.col("n_chars") > 500, F.col("doc_id").cast("string")).otherwise("").alias("doc_id"), F.concat(F.lit("x/y."), "doc_id", F.lit(".json")).alias("path"), F.col("lang").alias("state"), F.concat(F.lit(" "), F.initcap((F.col("n_chars") > 900).cast("string"))).alias("pdf_exists"), F.struct(F.col("source").alias("service_type")).alias("subservice"), F.array(F.lit("c")).alias("chunks"))
    lifted = acts.with_service_type(docs)
    return acts.index_records(lifted, (*acts.ACT_FIELDS, "service_type")).select("doc_id", "state", "pdf_exists", "service_type", F.size("chunks").cast("long").alias("n"))


def state_names(spark, d):
    return _t(spark, d, "nation").select("n_nationkey", acts.state_name(F.lower(F.translate("n_name", " ", "_"))).alias("state"))


def translation_gate(spark, d):
    lang = F.element_at(F.create_map(*(F.lit(x) for x in ("de", "hi", "en", "en", "es", "unknown", "fr", "zz"))), F.col("lang"))
    return _t(spark, d, "documents").select("doc_id", acts.needs_translation(lang).alias("translate"), acts.translator_code(lang).alias("code"))


def jurisdictions(spark, d):
    c = _t(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("turn") > 2, "").otherwise(F.col("role")).alias("jurisdiction"), F.nullif(F.col("role"), F.lit("user")).alias("court"), F.lit("b").alias("bench"))
    return c.select("conv_id", "turn", acts.jurisdiction(c).alias("own"), acts.jurisdiction(c, "X").alias("fixed"))


def iso_timestamps(spark, d):
    return _t(spark, d, "events").select("event_id", T.iso_timestamp(F.col("ts")).alias("at"))


def similarity_range(spark, d):
    c = _t(spark, d, "conversations").withColumn("sim", F.length("text").cast("double"))
    out = chunking.similarity_range(c, "conv_id", "sim")
    return out.select("conv_id", F.round("mean", 4).alias("mean"), "least", "most")


def role_accuracy(spark, d):
    c = _t(spark, d, "conversations").withColumn("guess", F.when(F.length("text") < 300, "user").otherwise("assistant"))
    return roles.accuracy(c, "role", "guess").select("n", F.round("accuracy", 6).alias("accuracy"))


def training_rows(spark, d):
    return roles.training_rows(_t(spark, d, "conversations")).groupBy("role", "label").agg(F.count("*").alias("n"))


def json_nested(spark, d):
    bad = F.transform(F.col("embedding"), lambda x: F.when(x > 0.2, F.lit(float("inf"))).when(x < -0.2, F.lit(float("nan"))).otherwise(x).cast("double"))
    e = values.safe_rows(_t(spark, d, "embeddings").select("vec_id", F.struct(bad.alias("v"), F.encode(F.lit("é"), "UTF-8").alias("b")).alias("s")))
    return e.select("vec_id", F.round(F.aggregate("s.v", F.lit(0.0), lambda a, x: a + x), 4).alias("total"), F.col("s.b").alias("text"))


def html_details(spark, d):
    row = F.expr("if(page_id % 3 = 0, concat('<table><tr><th>Act Number:<td>', page_id % 50, '&nbsp;of ', 1900 + page_id % 100, '</table><a href=\"/act/h/', page_id, '.PDF\">text</a>'), '')")
    out = P.detail_records(_t(spark, d, "pages").withColumn("html", F.concat("html", row)), "https://base.example/x/y")
    return out.select("act_name", "handle_id", "act_number", F.col("year").cast("long").alias("year"), "pdf_url", "pdf_exists", "source_url")


def html_lists(spark, d):
    page = _t(spark, d, "pages").select(F.col("page_id").alias("offset"), F.regexp_replace("html", 'href="/', 'href="/handle/1?view_type=browse&offset=7&').alias("html"))
    out = P.list_pages(page, "https://base.example/x/y")
    return out.select("offset", F.array_join("links", "|").alias("links"), "has_next")


def path_exclusions(spark, d):
    names = _t(spark, d, "part").select("p_partkey", F.concat("p_partkey", F.when(F.col("p_size") > 30, "_inventory.json").when(F.col("p_size") > 20, "_done_0.json").otherwise(".json")).alias("path"))
    return names.where(acts.not_bookkeeping(F.col("path")))


def valid_reads(spark, d):
    c = _t(spark, d, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.collect_list(F.when(F.col("role") == "system", F.col("turn"))).alias("chunks"))
    kept = files.valid_documents(files.valid_chunk_files(c).withColumn("name", F.when(F.col("doc_id") > 10, F.col("doc_id").cast("string")).otherwise("")), "name")
    return kept.select("doc_id", F.size("chunks").cast("long").alias("n"))


ROLES = {"opening": ["the of and", "is to"], "middle": ["that with", "for by"], "end": ["this from", "as are"]}


def role_chunks(spark, d):
    out = chunking.semantic_chunks(_t(spark, d, "documents"), threshold=0.47, roles=ROLES, embed=V.hashed_counts)
    counts = F.array_join(F.transform(F.array_sort(F.map_entries("role_distribution")), lambda x: F.concat_ws(":", x["key"], x["value"])), ",")
    return out.select("doc_id", "chunk_id", "num_sentences", "start_char", "end_char", "dominant_role", "role_purity", counts.alias("counts"))


def top_chunks(spark, d):
    return chunking.best_chunks(_t(spark, d, "documents"), 3, threshold=0.77, embed=V.hashed_counts).select("doc_id", "chunk_id")


def index_documents(spark, d):
    c = _t(spark, d, "conversations").dropDuplicates(["conv_id", "turn"])
    c = c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk_id"), "role", "text", F.length("text").alias("doc_similarity"), F.lit("t").alias("title"))
    out = jobs.index_documents(c, 3, WEIGHTS)
    chunks = F.array_join(F.transform("chunks", lambda x: F.concat_ws(":", x["chunk_id"], x["role"], F.array_join(x["same_role_chunk_ids"], "/"))), ",")
    return out.select("doc_id", "title", chunks.alias("chunks"))


def role_classifier(spark, d):
    rows = _t(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return roles.predict(roles.train(rows, 1 << 12), rows).select("conv_id", "turn", "role", "predicted_role", "confidence")


def stream_dedup_counts(spark, d):
    name = "stream_" + tempfile.mktemp(prefix="", dir="").strip("/").replace("-", "_")
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    stream = E.once(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d), "user_id")
    q = E.counts(stream.withColumn("bucket", F.col("user_id") % 10), "bucket").writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


ORACLE = {
    "clean_text": f"select doc_id, md5(c) as cleaned_md5, length(c) as n, round(case when length(text) > 0 then (length(text) - length(c)) * 100.0::double / length(text) else 0 end, 4) as reduction from (select *, {_CLEAN} as c from {_HEADED})",
    "sentence_stats": f"select doc_id, len(s)::bigint as n_sentences, list_sum(list_transform(s, lambda x: length(x)))::bigint as n_chars from (select doc_id, {_SENTENCES} as s from (select doc_id, {_CLEAN} as c from {_HEADED})) where len(s) > 0",
    "doc_id_from_path": r"""with p as (select page_id, regexp_replace(url, '^https?://', '') || '/x y-' || page_id as u from pages),
        q as (select page_id, u, list_filter(string_split('app/raw/' || u, '/'), lambda x: x <> '' and x not in ('raw', 'newapp', 'input', 'data', 'app')) as l from p),
        r as (select page_id, u, l, lower(replace(replace(array_to_string(l, '_'), '-', '_'), ' ', '_')) as w from q)
        select page_id, case when length(w) > 200 then lower(replace(replace(l[-1], '-', '_'), ' ', '_')) || '_' || substring(md5('app/raw/' || u || '.json'), 1, 8) else w end as id,
            regexp_extract(u, '([^/]+)$', 1) as stem, 'processed/raw/' || u || '_all_chunks.json' as chunk_path from r""",
    "act_slug": "select p_partkey, 'CA_' || ltrim(cast(p_partkey as varchar), '0') || '_' || p_size as slug, replace(p_name, '/', '_') as plain from part",
    "filename_sanitize": "select p_partkey, substring(trim(regexp_replace(regexp_replace(p_name || ' : a/b?  \"c\" ' || p_type, '[<>:\"/\\\\|?*]', '_', 'g'), '\\s+', ' ', 'g')), 1, 200) as file from part",
    "year_extract": r"select p_partkey, coalesce(try_cast(nullif(regexp_extract('Act of ' || (p_partkey + 1500), '\b(1[89][0-9]{2}|20[0-2][0-9])\b', 1), '') as int), try_cast(nullif(regexp_extract(p_name, '\b(1[89][0-9]{2}|20[0-2][0-9])\b', 1), '') as int), try_cast(nullif(regexp_extract('No. 7 of 18' || p_size, '\b(1[89][0-9]{2}|20[0-2][0-9])\b', 1), '') as int)) as year from part",
    "ocr_clean": r"""with p as (select doc_id, chr(97) || chr(9) || chr(9) || 'b  c-' || chr(10) || 'd' || repeat(chr(10), 4) || text as t from documents)
        select doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '[^\x20-\x7E\x{a0}-\x{24f}\x{2010}-\x{2027}\x{2030}-\x{205e}\x{2060}-\x{206f}\n\t]', ' ', 'g'), '-\n(\w)', '\1', 'g'), '[ \t]{2,}', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) as page_md5 from p""",
    "html_title_links": r"""with p as (select page_id, url, nullif(trim(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')), '') as title, regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1) as l from pages),
        o as (select page_id, string_agg(u, '|' order by i) as links from (select page_id, u, min(i) i from (select page_id, unnest(l) u, generate_subscripts(l, 1) i from p) group by 1, 2) group by 1)
        select p.page_id, title, len(l)::bigint as n_links, coalesce(links, '') as links,
            not contains(url, '/help/') and not contains(lower(url), 'hindi') and not regexp_matches(url || '/a.PDF', '/[Hh]\d*\.') as pdf from p left join o on o.page_id = p.page_id""",
    "centroid_roles": """with e as (select vec_id, embedding::double[] as v from embeddings), c as (select range as i from range(5)),
        s as (select vec_id, i, list_sum(list_transform(range(1, 65), lambda j: case when (j - 1) % 5 = i then v[j] else 0 end)) / sqrt(case when i < 4 then 13.0 else 12.0 end) as s from e cross join c)
        select vec_id, 'r' || i as role from (select *, row_number() over (partition by vec_id order by s desc, i) k from s) where k = 1""",
    "lang_detect": _LANG,
    "role_distribution": "select role, count(*) as n from conversations group by 1",
    "per_conv_roles": """with c as (select conv_id, role, count(*) n, min(turn) f from conversations group by 1, 2), r as (select *, row_number() over (partition by conv_id order by n desc, f, role desc) k, sum(n) over (partition by conv_id) t from c), l as (select conv_id, string_agg(role || ':' || n, ',' order by role) counts from c group by 1) select r.conv_id, role as dominant, round(n / t, 6) as purity, counts from r join l on l.conv_id = r.conv_id where k = 1""",
    "same_role_ids": "with c as (select distinct conv_id, turn, role from conversations) select a.conv_id, a.turn, coalesce(string_agg(b.conv_id || '-' || b.turn, ',' order by b.turn), '') as others from c a left join c b on a.conv_id = b.conv_id and a.role = b.role and a.turn <> b.turn group by 1, 2",
    "topk_by_similarity": "select conv_id, turn, sim from (select conv_id, turn, length(text) // 200 as sim, row_number() over (partition by conv_id order by length(text) // 200 desc, turn) r from conversations) where r <= 3",
    "weighted_topk": _weighted_sql(WEIGHTS, "length(text) // 200"),
    "weighted_topk_zero_sim": _weighted_sql(SOME_ZERO, "0"),
    "adjacent_cosine": "with e as (select vec_id, embedding::double[] as v, vec_id // 25 as doc from embeddings), p as (select b.vec_id, a.v as a, b.v as b from e a join e b on a.doc = b.doc and b.vec_id = a.vec_id + 1) select vec_id, round(list_cosine_similarity(a, b), 6) as cosine from p",
    "softmax_argmax": "with e as (select vec_id, embedding::double[] as v from embeddings) select vec_id, (list_position(v, list_max(v)) - 1)::bigint as best, round(1 / list_sum(list_transform(v, lambda x: exp(x - list_max(v)))), 6) as p from e",
    "unit_vectors": "with e as (select vec_id, list_transform(embedding::double[], lambda x: x * 3) as v from embeddings) select vec_id, round(v[1] / sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) as first from e",
    "delta1": """select doc_id || '.json' as name from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)""",
    "delta2": """select doc_id || '_all_chunks.json' as name from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)""",
    "progress_filter": "select c_custkey, c_name from customer where not exists (select 1 from events where user_id = c_custkey)",
    "index_prefilter": "select c_custkey, c_name from customer where exists (select 1 from orders where o_custkey = c_custkey)",
    "coverage_flag": "with o as (select year(o_orderdate)::bigint as year, exists (select 1 from lineitem where l_orderkey = o_orderkey) as hit from orders) select year, count(*) as total, count(*) filter (where hit) as found, round(count(*) filter (where hit) / count(*), 6) as ratio, count(*) filter (where hit) / count(*) >= 0.99 as uploaded from o group by 1",
    "verify_missing": "select year(o_orderdate)::bigint as year, count(*) as missing from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey) group by 1",
    "first_path_lookup": """with d as (select n_chars as name, source || '/' || doc_id as path from documents), a as (select name, min(path) p from d where path like 'src1/%' group by 1), b as (select name, min(path) p from d group by 1) select w.name, coalesce(a.p, b.p) as path from (select name from d union select name + 1 from d) w left join a on a.name = w.name left join b on b.name = w.name""",
    "inventory_build": "select year(o_orderdate)::bigint as year, count(distinct o_orderkey) as file_count, md5(string_agg(distinct o_orderkey || '.json', ',' order by o_orderkey || '.json')) as files_md5 from orders group by 1",
    "inventory_merge": """select year, count(*) as n from (select year(o_orderdate)::bigint as year, o_orderkey from orders union select year(l_shipdate)::bigint, l_orderkey from lineitem) group by 1""",
    "inventory_summary": "with y as (select year(o_orderdate) as year, count(*) n from orders group by 1) select count(*) as years, sum(n)::bigint as files, string_agg(year::varchar, ',' order by year::varchar) as listed from y",
    "set_diff_progress": """select doc_id from documents except select doc_id from labels""",
    "progress_union": "select user_id as id from events union select o_custkey from orders",
    "dedup_first_seen": "select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts, event_id) r from events) where r = 1",
    "count_per_year": "select year(o_orderdate)::bigint as year, count(*) as docs from orders group by 1",
    "year_filter_limit": "select * from (select year(o_orderdate)::bigint as year, o_orderkey, row_number() over (partition by year(o_orderdate) order by o_orderkey) as place from orders where year(o_orderdate) between 1996 and 1998) where place <= 10",
    "bool_coerce": "select lower(trim(case l_linenumber when 1 then ' True ' when 2 then 'false' else l_returnflag end)) = 'true' as flag, count(*) as n from lineitem group by 1",
    "int_coerce": """select event_id, coalesce(try_cast(trim(v) as int)::varchar, v) as n from (select event_id, ' ' || case when event_id % 3 = 0 then event_type else json_extract_string(props, '$.k') end as v from events)""",
    "coalesce_fields": "with l as (select doc_id, min(quality) as quality from labels group by 1) select d.doc_id, coalesce(nullif(case when d.doc_id % 2 = 0 then '' else source end, ''), nullif(quality::varchar, ''), lang) as date, coalesce(nullif(case when d.doc_id % 3 = 0 then '' else lang end, ''), source) as court from documents d left join l on l.doc_id = d.doc_id",
    "nested_parent_docs": "with c as (select distinct conv_id, turn, role, length(text) n from conversations) select conv_id, min_by(role, turn) as first_role, string_agg(role || ':' || n, ',' order by turn) as chunks from c group by 1",
    "json_sanitize": "select vec_id, round(case when vec_id % 7 = 0 or vec_id % 11 = 0 then 0.0 else embedding[1]::double end, 6) as x from embeddings",
    "upsert_index": """with n as (select o_custkey + case when o_orderstatus = 'O' then 0 else 10000000 end as k, max(o_orderkey) as of_order from orders group by 1)
        select c_custkey, c_name as said, round(c_acctbal, 2) as amount, null::bigint as of_order from customer where c_custkey not in (select k from n)
        union all select k, o_orderpriority, round(o_totalprice, 2), of_order from n join orders on o_orderkey = of_order""",
    "probe_coverage": """with y as (select year(o_orderdate)::bigint as year, o_orderkey as k from orders),
        c as (select year, count(*) as total, case when year <> 1995 then count(*) filter (where year % 2 = 1 or k % 400 <> 0) end as found from y group by 1)
        select year, total, found, round(found / total, 6) as ratio, found / total >= 0.99 as uploaded from c""",
    "inventory_digests": """with n as (select year(o_orderdate)::bigint as year, o_orderkey, exists (select 1 from lineitem where l_orderkey = o_orderkey) as also, ('0x' || substr(md5(o_orderkey || '.json'), 1, 15))::bigint as h from (select distinct o_orderdate, o_orderkey from orders))
        select year, count(*) as file_count, sum(h)::varchar as digest, count(*) filter (where not also) > 0 as changed from n group by 1""",
    "role_probabilities": r"""with c as (select conv_id, turn, regexp_extract(coalesce(text, ''), '^(?:\s*\S+){0,512}') as t from conversations),
        l as (select conv_id, turn, (length(t) - length(replace(t, ' ', ''))) / 4.0::double as a, (length(t) - length(replace(t, 'e', ''))) / 8.0::double as b, 1.0::double as c from c),
        e as (select *, exp(a - greatest(a, b, c)) as x, exp(b - greatest(a, b, c)) as y, exp(c - greatest(a, b, c)) as z from l)
        select conv_id, turn, case when a >= b and a >= c then 'words' when b >= c then 'letters' else 'none' end as predicted_role,
            round(x / (x + y + z), 6) as p_words, round(y / (x + y + z), 6) as p_letters, round(z / (x + y + z), 6) as p_none from e""",
    "read_rejects": """with k as (select source as path, unnest(case doc_id % 6 when 0 then ['good'] when 1 then ['damaged'] when 2 then ['empty'] when 3 then ['no id'] when 4 then ['no chunks', 'good'] else ['unreadable'] end) as reason,
            doc_id % 6 as kind, length(doc_id::varchar) as n from documents)
        select path, reason, count(*) as n, sum(case when reason = 'good' then n + (kind = 4)::int end)::bigint as id_chars from k group by 1, 2""",
    "stats_rollup": "select event_type, count(*) as total, count(*) filter (where value > 5) as ok, round(count(*) filter (where value > 5) * 100.0::double / count(*), 4) as rate from events group by 1",
    "role_weight_map": "select conv_id, turn, (case role when 'user' then 3.0 when 'assistant' then 0.4 when 'system' then 2.5 else 1.0 end)::double as weight from conversations",
    "label_encode": "select (row_number() over (order by lang) - 1)::bigint as code, lang from (select distinct lang from documents where lang is not null)",
    "search_documents": "select conv_id || '__' || turn as id, case when turn % 2 = 0 then role else '' end as role, turn as n from conversations",
    "semantic_groups": """with recursive e as (select vec_id // 25 as doc, row_number() over (partition by vec_id // 25 order by vec_id) as i, embedding::double[] as v from embeddings),
        s as (select b.doc, b.i, list_cosine_similarity(a.v, b.v) as x from e a join e b on a.doc = b.doc and b.i = a.i + 1),
        f as (select doc, 1::bigint as i, []::bigint[] as done, 1::bigint as cur from e where i = 1
            union all select f.doc, s.i, case when (x < 0.1 or cur >= 12) and cur >= 2 then list_append(done, cur) else done end, case when (x < 0.1 or cur >= 12) and cur >= 2 then 1 else cur + 1 end from f join s on s.doc = f.doc and s.i = f.i + 1),
        l as (select *, row_number() over (partition by doc order by i desc) as k from f)
        select doc, array_to_string(case when cur < 2 and len(done) > 0 then list_append(done[:-2], done[-1] + cur) else list_append(done, cur) end, ',') as lengths from l where k = 1""",
    "translation_segments": r"""with recursive p as (select doc_id, generate_subscripts(l, 1) as para, unnest(l) as p, text from (select doc_id, text, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') as l from documents where text is not null)),
        w as (select *, len(string_split_regex(p, '\s+')) as n from p),
        s as (select doc_id, para, generate_subscripts(l, 1) as i, unnest(l) as s from (select doc_id, para, string_split(regexp_replace(p, '([।.!?])\s+', '\1‖', 'g'), '‖') as l from w where n > 120)),
        t as (select *, len(string_split_regex(s, '\s+')) as n from s),
        f as (select doc_id, para, i, 1::bigint as seg, n from t where i = 1
            union all select t.doc_id, t.para, t.i, case when f.n > 0 and f.n + t.n > 120 then seg + 1 else seg end, case when f.n > 0 and f.n + t.n > 120 then t.n else f.n + t.n end from f join t on t.doc_id = f.doc_id and t.para = f.para and t.i = f.i + 1),
        o as (select t.doc_id, t.para, seg, string_agg(s, ' ' order by t.i) as segment from t join f on t.doc_id = f.doc_id and t.para = f.para and t.i = f.i group by 1, 2, 3
            union all select doc_id, para, 1, p from w where n <= 120
            union all select doc_id, 1, 1, text[:500] from documents where text is not null and doc_id not in (select doc_id from p))
        select doc_id, row_number() over (partition by doc_id order by para, seg) - 1 as place, md5(segment) as segment_md5 from o""",
    "marker_filter": """select doc_id, 'processed/raw/' || doc_id || '_done_0.json' as marker, 'raw/' || doc_id as key from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)""",
    "search_index_documents": """select conv_id || '__' || turn as id, '' as doc_id, '' as jurisdiction, '' as date, 0 as start_char, length(text)::int as end_char, 0 as num_sentences, 0.0::double as avg_similarity, 0.0::double as doc_similarity, role, 0.0::double as confidence, '' as title, '' as text, '' as judge, '' as pdf_link, '' as cnr, turn::varchar as court, '' as all_chunks_path from conversations""",
    "ocr_normalise": r"""with p as (select doc_id, chr(97) || chr(9) || chr(9) || 'b  c-' || chr(10) || 'd' || repeat(chr(10), 4) || text as t from documents)
        select doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '-\n(\w)', '\1', 'g'), '[ \t]{2,}', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) as page_md5 from p""",
    "act_pdf_match": r"""with p as (select 'CA_' || p_partkey as doc_id, substring(trim(regexp_replace(regexp_replace(p_name || ': ' || p_partkey, '[<>:"/\\|?*]', '_', 'g'), '\s+', ' ', 'g')), 1, 200) || '.pdf' as title, p_size from part)
        select doc_id, case when p_size <= 20 then title when p_size <= 35 then doc_id || '.pdf' end as pdf_name, p_size <= 35 as pdf_exists, (case when p_size <= 20 then p_size when p_size <= 35 then p_size + 100 else 0 end)::bigint as pdf_file_size_bytes from p""",
    "act_documents": """with c as (select distinct conv_id, turn, role from conversations), o as (select conv_id, count(*) as n, string_agg(conv_id || '_' || turn, ',' order by turn) as ids from c where role <> 'system' group by 1) select a.conv_id::varchar as doc_id, 'Unknown' as act_name, 0::bigint as year, 'unknown' as folder, case when n >= 2 then n else 0 end as total_chunks, case when n >= 2 then ids else '' end as chunk_ids from (select distinct conv_id from c) a left join o on o.conv_id = a.conv_id""",
    "act_index_records": """select case when n_chars > 500 then doc_id::varchar else 'y.' || doc_id end as doc_id, lang as state, n_chars > 900 as pdf_exists, source as service_type, 1::bigint as n from documents""",
    "state_names": """select n_nationkey, array_to_string(list_transform(string_split(replace(lower(n_name), '_', ' '), ' '), lambda w: upper(w[1]) || w[2:]), ' ') as state from nation""",
    "translation_gate": """select doc_id, coalesce(lang = 'de', false) as translate, case when lang = 'de' then 'hin_Deva' end as code from documents""",
    "jurisdictions": """select conv_id, turn, coalesce(nullif(case when turn > 2 then '' else role end, ''), nullif(nullif(role, 'user'), ''), 'b') as own, 'X' as fixed from conversations""",
    "iso_timestamps": """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as at from events""",
    "similarity_range": """select conv_id, round(avg(length(text)), 4) as mean, min(length(text))::double as least, max(length(text))::double as most from conversations group by 1""",
    "role_accuracy": """select count(*) as n, round(avg((coalesce(role = case when length(text) < 300 then 'user' else 'assistant' end, false))::int), 6) as accuracy from conversations where role is not null""",
    "training_rows": """select role, dense_rank() over (order by role) - 1 as label, count(*) as n from conversations where role is not null and text is not null group by role""",
    "json_nested": """select vec_id, round(list_sum(list_transform(embedding::double[], lambda x: case when x > 0.2 or x < -0.2 then 0.0 else x end)), 4) as total, 'é' as text from embeddings""",
    "html_details": r"""with p as (select page_id % 3 = 0 as more, page_id, url, nullif(trim(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g')), '') as t from pages)
        select t as act_name, regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '^/(handle/)?', '') as handle_id, case when more then page_id % 50 || ' of ' || (1900 + page_id % 100) else '' end as act_number, case when more then 1900 + page_id % 100 else try_cast(nullif(regexp_extract(t, '\b(1[89][0-9]{2}|20[0-2][0-9])\b', 1), '') as bigint) end as year, case when more then 'https://base.example/act/h/' || page_id || '.PDF' else '' end as pdf_url, more as pdf_exists, url as source_url from p where t is not null""",
    "html_lists": r"""with p as (select page_id as offset_, regexp_extract_all(replace(html, 'href="/', 'href="/handle/1?view_type=browse&offset=7&'), '<a[^>]*href="([^"]*)"', 1) as l from pages),
        u as (select offset_, u, min(i) as i from (select offset_, unnest(l) as u, generate_subscripts(l, 1) as i from p) where contains(u, 'view_type=browse') group by 1, 2),
        o as (select offset_, string_agg('https://base.example' || u, '|' order by i) as links from u group by 1)
        select p.offset_ as "offset", coalesce(links, '') as links, 7 > p.offset_ and links is not null as has_next from p left join o on o.offset_ = p.offset_""",
    "path_exclusions": """select p_partkey, p_partkey || '.json' as path from part where p_size <= 20""",
    "valid_reads": """select conv_id as doc_id, count(*) as n from conversations where role = 'system' and conv_id > 10 group by 1""",
    "semantic_chunks": _chunks_sql(0.47, 2, 10),
    "role_chunks": _chunks_sql(0.47, 2, 10, ROLES),
    "top_chunks": f"select doc_id, chunk_id from (select *, row_number() over (partition by doc_id order by doc_similarity desc, chunk_id) as r from ({_chunks_sql(0.77, 3, 11)})) where r <= 3",
    "index_documents": f"""with s as ({_weighted_sql(WEIGHTS, "length(text)")}), c as (select distinct conv_id, turn, role from conversations),
        o as (select a.conv_id, a.turn, coalesce(string_agg(b.turn::varchar, '/' order by b.turn), '') as others from c a left join c b on a.conv_id = b.conv_id and a.role = b.role and a.turn <> b.turn group by 1, 2)
        select s.conv_id as doc_id, 't' as title, string_agg(s.turn || ':' || s.role || ':' || others, ',' order by s.turn) as chunks from s join o on o.conv_id = s.conv_id and o.turn = s.turn group by 1""",
    "stream_dedup_counts": "select user_id % 10 as bucket, count(distinct user_id) as n from events group by 1",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        clean_text, sentence_stats, ocr_clean, doc_id_from_path, act_slug, filename_sanitize, year_extract, html_title_links, role_distribution, per_conv_roles, same_role_ids,
        topk_by_similarity, adjacent_cosine, semantic_groups, centroid_roles, softmax_argmax, unit_vectors, semantic_chunks, translation_segments, delta1, delta2, progress_filter,
        index_prefilter, coverage_flag, verify_missing, first_path_lookup, inventory_build, inventory_merge, inventory_summary, set_diff_progress, progress_union, dedup_first_seen,
        count_per_year, year_filter_limit, bool_coerce, int_coerce, coalesce_fields, nested_parent_docs, json_sanitize, upsert_index, stats_rollup, role_weight_map, label_encode,
        search_documents, lang_detect, role_classifier, stream_dedup_counts, marker_filter, search_index_documents, language_model, ocr_normalise, act_pdf_match, act_documents,
        act_index_records, state_names, translation_gate, jurisdictions, iso_timestamps, similarity_range, role_accuracy, training_rows, json_nested, html_details, html_lists,
        path_exclusions, valid_reads, probe_coverage, read_rejects, inventory_digests, role_probabilities, role_chunks, top_chunks, index_documents,
    )
    length = "length(text) div 200"
    return {f.__name__: f for f in named} | {"weighted_topk": _weighted(WEIGHTS, length), "weighted_topk_zero_sim": _weighted(SOME_ZERO, "0")}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

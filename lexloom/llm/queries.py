"""The queries of this subpackage: each operator on its whole table, and the digest columns of its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexloom.llm import decontaminate, htmltext, licenses, minhash, neighbours, packing, pii, ppm, prefixtrie, quality, substrings, warc, whitening
from lexloom.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents. A null text has no words; rows that share an id, or have none, have a result each; an empty
    benchmark hits nothing, an empty table gives no rows."""
    hits = decontaminate.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that a repeated string of 400 bytes covers, and words that a repeated passage of 50 words covers. A null text
    is empty; repeated rows lose what they share; rows keep their ids, also null ones; an empty table gives no rows."""
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"), with_words=True)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated_words")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in all documents. A null text is empty and names none; a row has a result of its own, whatever its id; an empty
    table gives no rows."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op4_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages. A null or empty page has an empty text; repeated rows and null ids are kept; an empty table gives no
    rows."""
    return htmltext.main_text(table(spark, sf_dir, "pages"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents. A null text is empty and has no spans; rows of null or repeated ids are kept as they are; an
    empty table gives no rows."""
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back. A null page is empty; pages of null id revisit one with an id, or are responses;
    equal rows are responses each; an empty table gives no rows."""
    records = warc.read_archive(warc.write_archive(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token sequences. A null or empty text is the one id 0; repeated rows are packed each; an empty table gives no
    rows."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by a model of the trusted ones. Null texts and those without words are rejected; rows of null id are
    never trusted; repeated rows come back repeated; without trusted texts only toxic and empty ones are rejected."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), every_context=True)


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours, among all vectors, of those whose id is divisible by 20. Vectors that are null, zero, or hold null or non-finite
    entries take no part; of few candidates all are returned; ties go to the smaller id; an empty table gives no rows."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near duplicates among all documents. A text that is null or has no words has an empty set and is linked with nothing; a
    null id is kept; rows of one id share a component; an empty table gives no rows."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefixes of all conversations. Null turns come first, null roles and texts are empty, ties are ordered by role and
    text, repeated rows are turns each; rows without a conv_id take no part; an empty table gives no rows."""
    return prefixtrie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents. A null text is empty and has its end alone; rows of null id are trained on; repeated rows
    count and come back each; an empty table gives no rows."""
    return ppm.score(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of all vectors. Vectors that are null, empty, of an odd length, or hold null or non-finite entries are
    dropped; repeated rows and null ids are kept; components without variance are left out; an empty table gives no rows."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP1 = f"""with b as (select item_id::varchar as item, {_WORDS} as l from benchmark where text is not null and item_id is not null),
    i as (select distinct item, array_to_string(l[a : a + 12], ' ') as win, least(13, len(l)) as n from (select item, l, unnest(range(1, greatest(len(l) - 12, 1) + 1)) as a from b where len(l) > 0)),
    w as (select distinct win, n from i), sizes as (select distinct n from w),
    d as (select doc_id, row_number() over () as r, coalesce({_WORDS}, []::varchar[]) as l from documents),
    p as (select r, l, n, unnest(range(1, greatest(len(l) - n + 1, 0) + 1)) as a from d, sizes),
    h as (select r, a, p.n, win from (select r, a, n, array_to_string(l[a : a + n - 1], ' ') as win from p) p join w using (win, n)),
    c as (select r, count(distinct x) as n_hit from (select r, unnest(range(a, a + n)) as x from h) group by r),
    m as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct r, item from h join i using (win, n)) group by r)
    select doc_id, len(l)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
        coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(l) as contaminated
    from d left join c using (r) left join m using (r)"""
_SOLID = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
_OP10 = f"""with recursive d as (select doc_id, coalesce({_SOLID}, []::varchar[]) as l from documents),
    s as (select doc_id, unnest(list_distinct(case when len(l) >= 5 then list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i : i + 4], ' ')) when len(l) > 0 then [array_to_string(l, ' ')] else [] end)) as s from d),
    z as (select doc_id, count(*) as n from s group by 1),
    k as (select doc_id, md5(string_agg(s, chr(0) order by s)) as set_ from s group by 1),
    f as (select set_, min(doc_id) as first from k group by 1), u as (select k.doc_id, first from k join f using (set_)),
    o as (select s.* from s semi join f on s.doc_id = f.first),
    q as (select a.doc_id as a, b.doc_id as b, count(*) as both_ from o a join o b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
    e as (select a, b from q join z x on x.doc_id = a join z y on y.doc_id = b where 100 * both_ >= 75 * (x.n + y.n - both_)),
    g as (select a as x, b as y from e union all select b, a from e),
    t as (select first as x, first as y from f union select t.x, g.y from t join g on t.y = g.x),
    m as (select x, min(y) as component from t group by 1)
    select d.doc_id, coalesce(z.n, 0) as n_shingles, coalesce(component, d.doc_id) as component_id, coalesce(component, d.doc_id) = d.doc_id as kept
    from d left join z using (doc_id) left join u using (doc_id) left join m on m.x = u.first"""

_CRC = "xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)), lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295)"
_OP11 = f"""with t as (select conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as m, length(coalesce(text, '')) as chars,
        row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i from conversations where conv_id is not null),
    l as (select conv_id, list(struct_pack(m := m, c := chars) order by i) as own from t group by 1),
    h as (select conv_id, own, {_CRC} % 6 as h from l),
    r as (select a.conv_id, list_concat(coalesce(b.own, [])[: a.h], a.own[a.h + 1 :]) as path from h a left join l b on b.conv_id = a.conv_id - a.conv_id % 100),
    p as (select conv_id, len(path) as len, d as depth, md5(array_to_string(list_transform(path[: d], lambda x: x.m), ',')) || d as k,
        case when d > 0 then md5(array_to_string(list_transform(path[: d - 1], lambda x: x.m), ',')) || (d - 1) end as up, case when d > 0 then path[d].c else 0 end as chars
        from (select conv_id, path, unnest(range(0, len(path) + 1)) as d from r)),
    n as (select k, any_value(depth) as depth, any_value(up) as up, any_value(chars) as chars, min(conv_id) as conv_id, count(*) as n_convs from p group by 1),
    c as (select up as k, count(*) as n from n where up is not null group by 1),
    w as (select n.*, coalesce(c.n, 0) as n_children from n left join c using (k)),
    s as (select v.k, sum(case when w.n_children = 0 then 1 else 0 end) as n_leaves, sum((w.n_convs - 1) * w.chars) as saved
        from w join p v on v.conv_id = w.conv_id and v.depth <= w.depth group by 1),
    e as (select k, string_agg(conv_id::varchar, ',' order by conv_id) as ends from p where depth = len group by 1)
    select w.conv_id, w.depth::bigint as depth, u.conv_id as parent_conv_id, w.n_convs, w.n_children::bigint as n_children, s.n_leaves::bigint as n_leaves, s.saved::bigint as saved_tokens,
        sha256(coalesce(ends, '')) as ends_sha256
    from w left join n u on u.k = w.up join s on s.k = w.k left join e on e.k = w.k"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_benchmark_decontamination, op2_suffix_array_dedup, op3_license_scan, op4_html_main_text, op5_pii, op6_warc, op7_best_fit_packing, op8_kneser_ney_quality, op9_nearest_neighbours, op10_minhash_near_dedup, op11_prefix_trie, op12_ppm_scores, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_benchmark_decontamination": _OP1,
        "op10_minhash_near_dedup": _OP10,
        "op11_prefix_trie": _OP11,
        "op6_warc": """
            with p as (select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
            f as (select payload_digest, min(page_id) as rep from p where payload_bytes >= 100 group by 1)
            select page_id, payload_bytes, p.payload_digest, case when rep is not null and page_id <> rep then 'revisit' else 'response' end as record_type,
                case when page_id <> rep then rep end as refers_to
            from p left join f on p.payload_digest = f.payload_digest and p.payload_bytes >= 100""",
    }

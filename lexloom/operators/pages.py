"""Records from HTML lists and detail pages by patterns, and text from recognised pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexloom.functions.text import act_year, normalise_ocr
from lexloom.operators.tables import table_values

# Character references that short HTML fragments hold.
REFERENCES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def plain(html: Column) -> Column:
    """The text of a fragment: tags as white space, the most frequent character references decoded, squeezed, trimmed."""
    out = F.regexp_replace(html, "<[^>]*>", " ")
    for name, character in REFERENCES:
        out = F.replace(out, F.lit(name), F.lit(character))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def title(html: Column, in_table: Column | None = None) -> Column:
    """The title by id, else from a table row (in_table, if that is known), else the first heading; null if there is none."""
    found = (F.regexp_extract(html, r'(?is)id="short_title"[^>]*>(.*?)<', 1), table_value(html, "short title") if in_table is None else in_table, F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1))
    return F.coalesce(*(F.nullif(F.trim(F.regexp_replace(f, "<[^>]*>", "")), F.lit("")) for f in found))


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'<a[^>]*href="([^"]*)"'), F.lit(1))


def absolute(url: Column, base: str) -> Column:
    """A link as an address: whole ones stay, //host/path gets the base's scheme, /path its host, others follow its last folder."""
    scheme, rest = base.split("://", 1)
    host = f"{scheme}://{rest.split('/', 1)[0]}"
    folder = f"{scheme}://{rest.rsplit('/', 1)[0]}/" if "/" in rest else f"{host}/"
    return F.when(url.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), url).when(url.startswith("//"), F.concat(F.lit(f"{scheme}:"), url)).when(url.startswith("/"), F.concat(F.lit(host), url)).otherwise(F.concat(F.lit(folder), url))


def detail_links(html: Column, base: str | None = None) -> Column:
    """Links to details, each once, in order; with a base, as addresses."""
    found = F.filter(links(html), lambda u: u.contains("view_type=browse") & u.contains("/handle/"))
    return F.array_distinct(found if base is None else F.transform(found, lambda u: absolute(u, base)))


def has_next(html: Column, offset: Column) -> Column:
    """Whether a link leads to a later page of the list."""
    pages = F.transform(F.regexp_extract_all(html, F.lit(r"offset=([0-9]+)"), F.lit(1)), lambda x: x.cast("long"))
    return F.exists(pages, lambda x: x > offset)


def list_pages(pages: DataFrame, base: str, html: str = "html", offset: str = "offset") -> DataFrame:
    """(offset, links, has_next) of list pages."""
    return pages.select(offset, detail_links(F.col(html), base).alias("links"), has_next(F.col(html), F.col(offset)).alias("has_next"))


def table_value(html: Column, label: str) -> Column:
    """The second cell of the first row whose first holds the label, in any case, by a pattern: for one label of flat tables
    (tables.table_values reads nested ones, and several labels in one pass)."""
    quoted = "\\Q" + label.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    return F.trim(F.regexp_extract(html, rf"(?is)<tr[^>]*>\s*<t[dh][^>]*>(?:(?!</t[dh]>).)*?{quoted}(?:(?!</t[dh]>).)*</t[dh]>\s*<t[dh][^>]*>(.*?)</t[dh]>", 1))


def english_pdf(url: Column) -> Column:
    """Whether a link is an English document: not a help page, not a Hindi version."""
    return url.rlike(r"(?i)\.pdf$") & ~url.contains("/help/") & ~F.lower(url).contains("hindi") & ~url.rlike(r"/[Hh]\d*\.")


def english_pdfs(files: DataFrame, url: str = "url", content: str = "content", least: int = 1024) -> DataFrame:
    """Fetched files that are what they should be: larger than `least` bytes, beginning as PDF, at an address that is not of a Hindi version."""
    address = F.col(url)
    return files.where((F.octet_length(content) > least) & F.expr(f"startswith({content}, X'255044462D')")).where(~F.lower(address).contains("hindi") & ~address.rlike(r"/[Hh]\d*\."))


def to_fetch(acts: DataFrame, files: DataFrame, name: str = "pdf_name", least: int = 1024) -> DataFrame:
    """Acts whose file is missing, or not larger than `least` bytes. files: (name, length)."""
    return acts.join(files.where(F.col("length") > least).select(F.col("name").alias(name)).distinct(), name, "left_anti")


def alternates(handle_id: Column, base: str, slots: int = 5) -> Column:
    """Addresses at which an item's files may be, by slot."""
    return F.transform(F.sequence(F.lit(1), F.lit(slots)), lambda i: F.concat(F.lit(f"{base}/bitstream/"), handle_id, F.lit("/"), i, F.lit("/")))


def handle(url: Column) -> Column:
    return F.regexp_replace(F.try_parse_url(url, F.lit("PATH")), "^/(handle/)?", "")


def detail_records(pages: DataFrame, base: str, html: str = "html", url: str = "url") -> DataFrame:
    """(act_name, handle_id, act_number, year, pdf_url, pdf_exists, source_url) of detail pages; those without a title are left out.

    The year is that of the first labelled row that says anything (of the act, of its enactment, plain), else of the number, else of the title; the
    link is the first to an English document.
    """
    h = F.col(html)
    labels = {"title": "short title", "number": "act number", "y1": "act year", "y2": "enacted year", "y3": "year"}
    read = pages.select(h.alias("_h"), F.col(url).alias("source_url"), table_values(h, labels).alias("_v"))
    h, pdf, value = F.col("_h"), F.try_element_at(F.filter(links(F.col("_h")), english_pdf), F.lit(1)), lambda name: plain(F.col(f"_v.{name}"))
    d = read.select(title(h, F.col("_v.title")).alias("act_name"), handle(F.col("source_url")).alias("handle_id"), value("number").alias("act_number"), value("y1").alias("_y1"), value("y2").alias("_y2"), value("y3").alias("_y3"), absolute(pdf, base).alias("_pdf"), "source_url").where("act_name is not null")
    year = act_year(F.col("_y1"), F.col("_y2"), F.col("_y3"), number=F.col("act_number"), title=F.col("act_name"))
    return d.select("act_name", "handle_id", "act_number", year.alias("year"), F.coalesce("_pdf", F.lit("")).alias("pdf_url"), F.col("_pdf").isNotNull().alias("pdf_exists"), "source_url")


def good_pages(pages: Column) -> Column:
    """The gate of extracted text: 500 characters, and half of the pages with 50."""
    good = F.size(F.filter(pages, lambda p: F.length(F.trim(p)) >= 50))
    return F.coalesce((F.length(F.trim(F.array_join(pages, "\n"))) >= 500) & (F.try_divide(good, F.size(pages)) >= 0.5), F.lit(False))


def recognised_text(pages: Column, least: int = 500) -> Column:
    """The text of recognised pages, arrays of blocks (reading_order, html, skipped): blocks in reading order without those that were
    skipped or are empty, a line each, pages parted by empty lines; null if it has fewer than `least` characters."""

    def page(blocks: Column) -> Column:
        ordered = F.array_sort(F.transform(F.filter(blocks, lambda b: ~F.coalesce(b["skipped"], F.lit(False))), lambda b: F.struct(b["reading_order"].alias("o"), plain(F.coalesce(b["html"], F.lit(""))).alias("t"))))
        return F.array_join(F.filter(F.transform(ordered, lambda b: b["t"]), lambda t: t != ""), "\n")

    text = normalise_ocr(F.array_join(F.filter(F.transform(pages, page), lambda p: p != ""), "\n\n"))
    return F.when(F.length(text) >= least, text)

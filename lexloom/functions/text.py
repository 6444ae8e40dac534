"""Text functions as Column expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# White space as the cleaning rules understand it, and the rules in their order (pattern, replacement).
SPACE = r"[\t-\r\x1c-\x20\x85\xa0  -     　]"
CLEANING = (
    (r"(?idu)THE SUPREME COURT REPORTS.*?\)", ""),
    (rf"\((?:[A-Z.,;:]|{SPACE})+JJ?\.\)", ""),
    (r"(?idu)SUPREME COURT REPORTS.*?\]", ""),
    (r"\(\p{Nd}{4}[^)]*[A-Z]{2,}[^)]*\)", ""),
    (rf"-{SPACE}+", ""),
    (rf"{SPACE}+", " "),
)
# Cleaning of recognised pages.
NOISE = r"[^\x20-\x7E\xa0-ɏ‐-‧‰-⁞⁠-⁯\n\t]"
OCR = ((NOISE, " "), (r"-\n(\w)", "$1"), (r"[ \t]{2,}", " "), (r"\n{3,}", "\n\n"))
# A year between 1800 and 2029; characters that file names cannot have; path parts that name no document.
YEAR = r"\b(1[89][0-9]{2}|20[0-2][0-9])\b"
UNSAFE = r'[<>:"/\\|?*]'
GENERIC_PARTS = ("raw", "newapp", "input", "data", "app")
SENTENCE_END = r"\s(?<=[.!?]\s)\s*+(?=[A-Z])"  # white space between an end mark and a capital: the mark is sought only where white space is


def _replaced(text: Column, rules: tuple) -> Column:
    for pattern, by in rules:
        text = F.regexp_replace(text, pattern, by)
    return text


def clean(text: Column) -> Column:
    """Report headers, judges' names and citations removed, hyphens at line ends joined, white space squeezed, trimmed."""
    return F.trim(_replaced(text, CLEANING))


def clean_ocr(text: Column) -> Column:
    """A recognised page: noise to spaces, words joined over line ends, runs squeezed, trimmed."""
    return F.regexp_replace(_replaced(text, OCR), r"^\s+|\s+$", "")


def reduction_percent(before: Column, after: Column) -> Column:
    """By how many percent a text got shorter; 0 for an empty one."""
    return F.when(F.length(before) > 0, (F.length(before) - F.length(after)) * 100.0 / F.length(before)).otherwise(0.0)


def sentences(cleaned: Column) -> Column:
    """Sentences of cleaned text: cut at white space between an end mark and an ASCII capital."""
    # A lambda: F.trim itself has a second parameter, for which transform would give the sentence's number as characters to trim.
    return F.filter(F.transform(F.split(cleaned, SENTENCE_END), lambda s: F.trim(s)), lambda s: s != "")


def document_id(path: Column, collections: tuple[str, ...] = ()) -> Column:
    """The id that a path stands for: generic parts dropped, joined by _, lower case; long ones shortened by a digest."""
    plain = F.regexp_replace(path, r"\.json$", "")
    parts = F.filter(F.split(plain, "/"), lambda p: (p != "") & ~p.isin(*GENERIC_PARTS, *collections))
    whole = F.lower(F.translate(F.array_join(parts, "_"), "- ", "__"))
    last = F.lower(F.translate(F.try_element_at(parts, F.lit(-1)), "- ", "__"))
    return F.when(F.length(whole) > 200, F.concat(last, F.lit("_"), F.substring(F.md5(path.cast("binary")), 1, 8))).otherwise(whole)


def stem(path: Column) -> Column:
    """The document's name in a path to its raw or its chunk file."""
    return F.regexp_extract(path, r"([^/]+?)(_all_chunks)?\.json$", 1)


def chunk_file(path: Column, base: str = "processed") -> Column:
    """Where the chunks of a raw file are stored."""
    return F.concat(F.lit(base + "/"), F.regexp_replace(F.regexp_replace(path, r"^app/", ""), r"\.json$", "_all_chunks.json"))


def act_slug(handle: Column, prefix: str = "CA") -> Column:
    """A handle `a/b` as prefix_a_b, a without leading zeros; other handles with _ for /."""
    parts = F.split(handle, "/")
    two = F.concat_ws("_", F.lit(prefix), F.regexp_replace(parts[0], "^0+", ""), F.try_element_at(parts, F.lit(2)))
    return F.when(F.size(parts) == 2, two).otherwise(F.translate(handle, "/", "_"))


def file_name(title: Column) -> Column:
    """A title as a file name of 200 characters at most."""
    return F.substring(F.trim(F.regexp_replace(F.regexp_replace(title, UNSAFE, "_"), r"\s+", " ")), 1, 200)


def year(*texts: Column) -> Column:
    """The first year in the first text that has one."""
    return F.coalesce(*(F.nullif(F.regexp_extract(t, YEAR, 1), F.lit("")).try_cast("int") for t in texts))


def to_bool(value: Column) -> Column:
    """Whether a text says true, in any case."""
    return F.lower(F.trim(value)) == "true"


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor empty; else the last."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values[:-1]), values[-1])


def finite(value: Column) -> Column:
    """0 for NaN and infinities."""
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), F.lit(0.0)).otherwise(value)


def normalise_ocr(text: Column) -> Column:
    """Recognised text whose characters are all kept: words joined over line ends, runs squeezed, trimmed."""
    return F.regexp_replace(_replaced(text, OCR[1:]), r"^\s+|\s+$", "")


def marker_file(path: Column, index: int = 0, base: str = "processed") -> Column:
    """Where the marker of a processed raw file is stored."""
    return F.regexp_replace(chunk_file(path, base), r"_all_chunks\.json$", f"_done_{index}.json")


def document_key(marker: Column, index: int = 0, base: str = "processed") -> Column:
    """The document's key in a marker's path: without the base folder and the marker's ending."""
    return F.regexp_replace(F.regexp_replace(marker, rf"^{base}/", ""), rf"_done_{index}\.json$", "")


def chunk_name(name: Column) -> Column:
    """The name of a raw file's chunk file."""
    return F.regexp_replace(name, r"\.json$", "_all_chunks.json")


def state_slug(handle: Column, state: Column) -> Column:
    """A handle `a/b` as SA_state_b; other handles with _ for /."""
    parts = F.split(handle, "/")
    return F.concat_ws("_", F.lit("SA"), state, F.when(F.size(parts) == 2, F.try_element_at(parts, F.lit(2))).otherwise(F.translate(handle, "/", "_")))


def iso_timestamp(time: Column) -> Column:
    """A time in UTC, to the second."""
    return F.date_format(F.to_utc_timestamp(time, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def year_folder(year: Column) -> Column:
    """A year as the name of a folder: unknown if it is missing or 0."""
    return F.coalesce(F.nullif(year.cast("int"), F.lit(0)).cast("string"), F.lit("unknown"))


def int_or_same(value: Column) -> Column:
    """A whole number as text without what surrounds it; any other text as it is."""
    return F.coalesce(F.trim(value).try_cast("int").cast("string"), value)


def act_year(*labelled: Column, number: Column, title: Column) -> Column:
    """The year in the first of the labelled values that says anything, else in the number, else in the title."""
    first = F.coalesce(*(F.nullif(F.trim(v), F.lit("")) for v in labelled))
    return F.coalesce(year(first), year(number), year(title))

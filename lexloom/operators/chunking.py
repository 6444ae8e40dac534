"""Sentences grouped to chunks by an ordered fold over their similarities; everything stays in the document's row."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from lexloom.functions.text import clean, sentences
from lexloom.functions.vectors import directions, rounded, row_cosines, units
from lexloom.operators.select import top_k

#: Sentences, and bytes of texts, that are taken out of Arrow, embedded and grouped at once; a larger document is worked on alone.
BATCH, BATCH_BYTES = 4_000, 1 << 20
_ROLE = "dominant_role string, role_distribution map<string,long>, role_purity double"
_CHUNK = "doc_id {}, chunk_id long, text string, num_sentences long, avg_similarity double, doc_similarity double, start_char long, end_char long, " + _ROLE


def group_lengths(sims: str, threshold: float, least: int, most: int, roles: str | None = None) -> Column:
    """Lengths of consecutive groups of size(sims) + 1 sentences.

    A group is closed before a sentence whose similarity to the last lies under the threshold, that has another role than
    the group's first, or that would exceed `most`, if the group has `least` sentences; a short tail joins the last group.
    """
    if roles is None:
        pairs, same = f"transform({sims}, x -> named_struct('x', x, 'r', cast(null as string)))", "false"
        first = "cast(null as string)"
    else:
        pairs, same = f"zip_with({sims}, slice({roles}, 2, size({roles})), (x, r) -> named_struct('x', x, 'r', r))", "not (p.r <=> a.role)"
        first = f"try_element_at({roles}, 1)"
    return F.expr(f"""aggregate({pairs}, named_struct('done', cast(array() as array<int>), 'cur', 1, 'role', {first}),
        (a, p) -> if((p.x < {threshold} or a.cur >= {most} or {same}) and a.cur >= {least},
            named_struct('done', concat(a.done, array(a.cur)), 'cur', 1, 'role', p.r),
            named_struct('done', a.done, 'cur', a.cur + 1, 'role', a.role)),
        a -> if(a.cur < {least} and size(a.done) > 0,
            concat(slice(a.done, 1, size(a.done) - 1), array(element_at(a.done, -1) + a.cur)),
            concat(a.done, array(a.cur))))""")


def grouped(sims: list[float], threshold: float, least: int, most: int, roles: list[str] | None = None) -> list[int]:
    """As group_lengths(), of one document in Python."""
    done, size, role = [], 1, roles[0] if roles else None
    for i, x in enumerate(sims, 1):
        if size >= least and (x < threshold or size >= most or roles is not None and roles[i] != role):
            done.append(size)
            size, role = 0, roles[i] if roles else None
        size += 1
    if size < least and done:
        done[-1] += size
    else:
        done.append(size)
    return done


def dominant(roles: list[str]) -> tuple[str, dict[str, int], float]:
    """The most frequent role (the first of equals), how often each stands, and the share of the most frequent."""
    counts = Counter(roles)
    best = max(counts, key=counts.__getitem__)
    return best, dict(counts), counts[best] / len(roles)


def place(text: str, chunk: str, first: str, at: int) -> int:
    """Where a chunk starts in a text, sought from a place on; else where its first sentence does; else that place."""
    found = text.find(chunk, at)
    if found < 0:
        found = text.find(first, at)
    return found if found >= 0 else at


def blocks(frame: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows in order, in parts of BATCH sentences and BATCH_BYTES of text at most, or of one row: a batch of 10,000 long texts
    never becomes Python objects as a whole."""
    n = np.cumsum(np.r_[0, pc.list_value_length(frame.column("s")).to_numpy(zero_copy_only=False)])
    size = np.cumsum(np.r_[0, pc.binary_length(frame.column("cleaned")).to_numpy(zero_copy_only=False)], dtype=np.int64)
    a = 0
    while a < frame.num_rows:
        b = max(a + 1, int(min(np.searchsorted(n, n[a] + BATCH, side="right"), np.searchsorted(size, size[a] + BATCH_BYTES, side="right"))) - 1)
        yield frame.slice(a, b - a)
        a = b


def _assemble(embed: Callable, threshold: float, least: int, most: int, min_chars: int, centroids: dict[str, list[str]] | None, boundaries: bool, with_similarity: bool, named: bool):
    def assemble(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = list(centroids or {})
        centers = np.asarray(embed([" ".join(centroids[n]) for n in names]), dtype=np.float64) if names else None

        def work(ids: list, texts: list[str], own: list[list[str]]) -> pa.RecordBatch:
            v = np.asarray(embed([s for x in own for s in x]), dtype=np.float64)
            near = row_cosines(v[:-1], v[1:])
            # Unit vectors of a provider decide where chunks end, as a model gives them; the similarities that are returned are the more exact ones.
            unit = units(v) if named else None
            steps = row_cosines(unit[:-1], unit[1:]) if named else near
            best = None
            if names:
                norms = np.linalg.norm(v, axis=1)[:, None] * np.linalg.norm(centers, axis=1)[None, :]
                best = np.round(np.where(norms > 0, v @ centers.T / np.where(norms > 0, norms, 1), 0.0), 9).argmax(axis=1)  # the first of those that differ by rounding alone
            rows: list[tuple] = []
            of: list[int] = []
            at = 0
            for d, (doc, text, parts) in enumerate(zip(ids, texts, own, strict=True)):
                sims, own_steps = near[at : at + len(parts) - 1].tolist(), steps[at : at + len(parts) - 1].tolist()
                roles = [names[i] for i in best[at : at + len(parts)]] if names else None
                first = cursor = number = 0
                for size in grouped(own_steps, threshold, least, most, roles if boundaries else None):
                    chunk = " ".join(parts[first : first + size])
                    # Dropped chunks are passed over too: where lines repeat, a chunk may be found inside the one before it.
                    start = place(text, chunk, parts[first], cursor)
                    cursor = start + len(chunk)
                    if len(chunk) >= min_chars:
                        number += 1
                        mean = reduce(add, sims[first : first + size - 1]) / (size - 1) if size > 1 else 1.0  # one by one, as SQL adds: sum() compensates
                        rows.append((doc, number, chunk, size, mean, start, cursor, *(dominant(roles[first : first + size]) if roles else (None, None, None))))
                        of.append(d)
                    first += size
                at += len(parts)
            c = list(zip(*rows, strict=True)) or [[] for _ in range(10)]
            sim = np.zeros(len(rows))
            if with_similarity and rows:
                sim = row_cosines(np.asarray(embed(list(c[2])), dtype=np.float64), np.asarray(embed(texts), dtype=np.float64)[of])
            counts = pa.array([list(x.items()) if x else None for x in c[8]], pa.map_(pa.string(), pa.int64()))
            purity = [None if x is None else round(x, 4) for x in c[9]]
            return pa.record_batch(
                [pa.array(c[0], kind), pa.array(c[1], pa.int64()), pa.array(c[2], pa.string()), pa.array(c[3], pa.int64()), pa.array(rounded(c[4])), pa.array(rounded(sim)), pa.array(c[5], pa.int64()), pa.array(c[6], pa.int64()), pa.array(c[7], pa.string()), counts, pa.array(purity, pa.float64())],
                ["doc_id", "chunk_id", "text", "num_sentences", "avg_similarity", "doc_similarity", "start_char", "end_char", "dominant_role", "role_distribution", "role_purity"],
            )

        for frame in frames:
            kind = frame.schema.field("doc_id").type
            for part in blocks(frame):
                yield work(*(part.column(c).to_pylist() for c in ("doc_id", "cleaned", "s")))

    return assemble


def semantic_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5, least: int = 2, most: int = 10, min_chars: int = 100, embed="hashed", roles: dict[str, list[str]] | None = None, role_boundaries: bool = True, doc_similarity: bool = True) -> DataFrame:
    """(doc_id, chunk_id, text, num_sentences, avg_similarity, doc_similarity, start_char, end_char, dominant_role, role_distribution,
    role_purity): the chunks of documents.

    Texts are cleaned and cut into sentences in the JVM; sentences are embedded in batches, grouped and joined in one Arrow pass. embed:
    the name of a provider, or a function from a list of texts to a matrix, whose cosines decide as they are (a threshold met exactly
    is met; unit vectors may miss it by their last digit). roles: descriptions of roles by name; then each
    sentence has the role of the nearest centroid, a change of role closes a chunk (unless role_boundaries is off), and chunks have their
    most frequent role, the first of equals, its share, and all counts; else these columns are null. Documents without
    sentences have no chunks; chunks of fewer than min_chars characters are dropped and the rest numbered from 1. No shuffle.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), clean(F.col(text)).alias("cleaned"))
    d = d.withColumn("s", sentences(F.col("cleaned"))).where(F.size("s") > 0)
    kind = docs.schema[doc_id].dataType.simpleString()
    return d.mapInArrow(_assemble(directions(embed), threshold, least, most, min_chars, roles, role_boundaries, doc_similarity, isinstance(embed, str)), _CHUNK.format(kind))


def split_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """semantic_chunks() with the defaults of a single call: threshold 0.8, 3 to 11 sentences."""
    return semantic_chunks(docs, doc_id, text, **({"threshold": 0.8, "least": 3, "most": 11} | options))


def best_chunks(docs: DataFrame, k: int, doc_id: str = "doc_id", text: str = "text", sort_by: str = "doc_similarity", **options) -> DataFrame:
    """The k chunks of each document that come first by a score, in their order."""
    return top_k(split_text(docs, doc_id, text, **options), k, "doc_id", "chunk_id", sort_by)


def similarity_range(chunks: DataFrame, doc_id: str = "doc_id", score: str = "doc_similarity") -> DataFrame:
    """Mean, least and greatest similarity of each document's chunks."""
    return chunks.groupBy(doc_id).agg(F.avg(score).alias("mean"), F.min(score).alias("least"), F.max(score).alias("most"))


def role_shares(chunks: DataFrame, by: list[str], role: str = "role", order: str = "place") -> DataFrame:
    """Per group of rows: the most frequent role (the first of equals by order), its share, and all counts as a map."""
    counts = chunks.groupBy(*by, role).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    best = F.max_by(role, F.struct("n", (-F.col("_first")).alias("f")))
    shares = F.map_from_entries(F.array_sort(F.collect_list(F.struct(role, "n"))))
    return counts.groupBy(*by).agg(best.alias("dominant_role"), (F.max("n") / F.sum("n")).alias("role_purity"), shares.alias("role_distribution"))


def translation_segments(text: str, most: int = 120, fallback: int = 500) -> Column:
    """Paragraphs for translation, trimmed: those of more than `most` words are cut into sentences, packed in order to that many words.
    A text without any is its first `fallback` characters."""
    segments = rf"""flatten(transform(filter(transform(split({text}, '\\n\\n'), p -> regexp_replace(p, '^\\s+|\\s+$', '')), p -> p <> ''), p -> if(size(split(p, '\\s+')) <= {most}, array(p),
        aggregate(split(p, '(?<=[।.!?])\\s+'), named_struct('done', cast(array() as array<string>), 'cur', '', 'n', 0),
            (a, s) -> if(a.n > 0 and a.n + size(split(s, '\\s+')) > {most},
                named_struct('done', concat(a.done, array(a.cur)), 'cur', s, 'n', size(split(s, '\\s+'))),
                named_struct('done', a.done, 'cur', if(a.n = 0, s, concat(a.cur, ' ', s)), 'n', a.n + size(split(s, '\\s+')))),
            a -> if(a.n > 0, concat(a.done, array(a.cur)), a.done)))))"""
    return F.expr(f"if(size({segments}) > 0, {segments}, array(left({text}, {fallback})))")


def translated(docs: DataFrame, doc_id: str, text: str, lang: str, translate: Callable[[list[str], str], list[str]], batch: int = 8) -> DataFrame:
    """docs with the translation of their text: segments go to translate(segments, language) in batches, a batch that fails stays as
    it is, and the results are joined by empty lines. Rows of null text or language stay as they are. No shuffle."""

    def work(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            out = []
            for original, parts, language in zip(*(frame.column(c).to_pylist() for c in (text, "_segments", lang)), strict=True):
                if original is None or language is None:
                    out.append(original)
                    continue
                done: list[str] = []
                for at in range(0, len(parts), batch):
                    some = parts[at : at + batch]
                    try:
                        done += translate(some, language)
                    except Exception:  # noqa: BLE001 - whatever a model raises, its batch keeps the original
                        done += some
                out.append("\n\n".join(done))
            i = frame.schema.get_field_index(text)
            frame = frame.set_column(i, text, pa.array(out, pa.string()))
            yield frame.drop_columns(["_segments"])

    return docs.withColumn("_segments", translation_segments(text)).mapInArrow(work, docs.schema)

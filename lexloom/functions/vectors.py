"""Vectors as arrays of doubles."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

_WORDS = re.compile(r"\w+")


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity, 0 if either vector is zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(0.0)


def unit(v: Column | str) -> Column:
    norm = F.sqrt(dot(v, v))
    return F.transform(v, lambda x: F.when(norm > 0, x / norm).otherwise(x))


def softmax(v: Column | str) -> Column:
    top = F.array_max(v)
    total = F.aggregate(F.transform(v, lambda x: F.exp(x - top)), F.lit(0.0), lambda s, x: s + x)
    return F.transform(v, lambda x: F.exp(x - top) / total)


def argmax(v: Column | str) -> Column:
    """The first place, from 0, of the largest value."""
    return F.array_position(v, F.array_max(v)).cast("int") - 1


_buckets: dict[str, int] = {}
#: Words whose numbers a worker remembers, at most.
REMEMBERED = 100_000


def hashed_counts(texts: list[str], dim: int = 64) -> np.ndarray:
    """Words counted in buckets of their MD5 (its first four bytes as a number, modulo dim)."""
    own = [_WORDS.findall(t.lower()) for t in texts]
    flat = list(chain.from_iterable(own))
    if len(_buckets) > REMEMBERED:
        _buckets.clear()
    _buckets.update((w, int.from_bytes(hashlib.md5(w.encode()).digest()[:4])) for w in set(flat).difference(_buckets))
    place = np.fromiter(map(_buckets.__getitem__, flat), dtype=np.int64, count=len(flat)) % dim
    of = np.repeat(np.arange(len(texts)), [len(w) for w in own])
    return np.bincount(of * dim + place, minlength=len(texts) * dim).reshape(len(texts), dim).astype(np.float64)


def hashed_embedding(texts: list[str], dim: int = 64) -> np.ndarray:
    """A deterministic stand-in for a sentence model: hashed_counts() brought to length 1."""
    return units(hashed_counts(texts, dim))


def units(v: np.ndarray) -> np.ndarray:
    """Rows brought to length 1; zero rows stay."""
    norms = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norms > 0, norms, 1)


#: Embedding providers by name: functions from a list of texts to a matrix of vectors.
PROVIDERS: dict[str, Callable[[list[str]], np.ndarray]] = {"hashed": hashed_embedding}
#: Vectors of the same directions whose products and squares are whole numbers, so that cosines have no error but the last roots' and quotient's.
WHOLE: dict[str, Callable[[list[str]], np.ndarray]] = {"hashed": hashed_counts}


def provider(embed: str | Callable[[list[str]], np.ndarray]) -> Callable[[list[str]], np.ndarray]:
    return PROVIDERS[embed] if isinstance(embed, str) else embed


def directions(embed: str | Callable[[list[str]], np.ndarray]) -> Callable[[list[str]], np.ndarray]:
    """A provider for cosines alone: its vectors, or longer ones that are more exact."""
    return WHOLE.get(embed) or PROVIDERS[embed] if isinstance(embed, str) else embed


def encoded(rows: DataFrame, text: str = "text", name: str = "embedding", embed: str | Callable = "hashed", normalise: bool = False) -> DataFrame:
    """Rows with the vector of their text (null texts as empty), encoded in batches; brought to length 1 if asked."""
    model = provider(embed)

    @F.pandas_udf("array<float>")
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series(list(np.asarray(model(texts.fillna("").tolist()), dtype=np.float32)))

    v = encode(F.col(text))
    return rows.withColumn(name, F.transform(unit(F.transform(v, lambda x: x.cast("double"))), lambda x: x.cast("float")) if normalise else v)


def row_cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of two matrices, 0 where either is zero."""
    norms = np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)
    return np.where(norms > 0, (a * b).sum(axis=1) / np.where(norms > 0, norms, 1), 0.0)


def rounded(x: np.ndarray | list[float], places: int = 4) -> np.ndarray:
    """Rounded as SQL does: halves away from zero, after multiplication."""
    scaled = np.asarray(x, dtype=np.float64) * 10.0**places
    whole = np.trunc(scaled)
    return (whole + np.where(np.abs(scaled - whole) >= 0.5, np.sign(scaled), 0.0)) / 10.0**places

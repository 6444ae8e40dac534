"""Words of many texts at once: byte arrays instead of one Python string a word.

Texts are joined to one byte array, blocks of bounded size at a time. A word is a maximal run of bytes that a table of
256 flags accepts; as every byte of a non-ASCII character is 0x80 or more, one table serves UTF-8 as it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; one longer text makes a block of its own.
BLOCK = 1 << 20

_mix = np.random.default_rng(20250101)
_CODE = _mix.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: list[np.ndarray] = []


def lower_table() -> np.ndarray:
    """A byte to itself, A-Z to a-z."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = lower_table()
#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ in text in which A-Z are lower-cased.
ALNUM = np.array([c >= 128 or 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 for c in range(256)])
#: Bytes of words [^\x20\x09-\x0D]+.
SOLID = np.array([not (c == 32 or 9 <= c <= 13) for c in range(256)])


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base of the word hash and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, min(2 * len(_powers[0]) if _powers else 1 << 16, BLOCK + (BLOCK >> 1)))
        _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(n - 1, b, dtype=np.uint64)]) for b in (_BASE, _UNBASE)]
    return _powers[0], _powers[1]


def _sum_long(data: np.ndarray) -> np.uint64:
    """The sum that hashes() makes for one very long word, a part at a time."""
    up, total = powers(BLOCK)[0], 0
    for at in range(0, len(data), BLOCK):
        part = data[at : at + BLOCK]
        total += int((_CODE[part] * up[: len(part)]).sum(dtype=np.uint64)) * pow(int(_BASE), at, 2**64)
    return np.uint64(total % 2**64)


@dataclass
class Words:
    """The words of a block of texts.

    data: lower-cased bytes, a 0 after each text. start, end: bytes of each word. first: number of the first word of
    each text, and then the count of all words. at: where each text starts in data, and then the length of data.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    at: np.ndarray
    raw: bytes

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words."""
        out = np.empty(len(self.start), dtype=np.uint64)
        i = 0
        while i < len(out):
            # As many words as stand in BLOCK bytes, one at least: sums relative to the first give the same hashes.
            low = int(self.start[i])
            j = max(i + 1, int(np.searchsorted(self.end, low + BLOCK, side="right")))
            size = int(self.end[j - 1]) - low
            if size > 2 * BLOCK:
                out[i] = _sum_long(self.data[low : low + size])
            else:
                start, end = self.start[i:j] - low, self.end[i:j] - low
                up, down = powers(size + 1)
                sums = np.zeros(size + 1, dtype=np.uint64)
                np.cumsum(_CODE[self.data[low : low + size]] * up[:size], out=sums[1:])
                out[i:j] = (sums[end] - sums[start]) * down[start]
            i = j
        return mix(out + (self.end - self.start).astype(np.uint64))

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def split(texts: list[bytes], table: np.ndarray = ALNUM) -> Words:
    raw = b"\x00".join(texts) + b"\x00"
    data = LOWER[np.frombuffer(raw, dtype=np.uint8)]
    at = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    flag = table[data]
    if table[0]:
        flag[at[1:] - 1] = False
    edge = np.flatnonzero(flag[1:] != flag[:-1]) + 1
    if flag[0]:
        edge = np.r_[0, edge]
    start, end = edge[0::2], edge[1::2]
    return Words(data, start, end, np.searchsorted(start, at), at, raw)


def batches(frames: Iterable[pa.RecordBatch], *columns: str, text: str = "text") -> Iterator[tuple[list, list[bytes]]]:
    """Blocks of (lists of columns, texts as UTF-8 with null as empty) of bounded size from Arrow batches."""
    kept: list[list] = [[] for _ in columns]
    texts: list[bytes] = []
    size = 0
    for frame in frames:
        column = frame.column(text).cast(pa.binary()) if pa.types.is_string(frame.column(text).type) else frame.column(text).cast(pa.large_binary())
        others = [frame.column(c).to_pylist() for c in columns]
        for i, value in enumerate(column):
            value = value.as_py() or b""
            if texts and size + len(value) > BLOCK:
                yield kept, texts
                kept, texts, size = [[] for _ in columns], [], 0
            for have, own in zip(kept, others, strict=True):
                have.append(own[i])
            texts.append(value)
            size += len(value) + 1
    if texts:
        yield kept, texts


_GAP = re.compile(rb"[\x20\t-\r]")


def slices(text: bytes, size: int) -> list[bytes]:
    """A text cut at white space, after so many bytes at least; what is cut at begins the next slice."""
    cut, at = [0], size
    while at < len(text) and (gap := _GAP.search(text, at)):
        cut.append(gap.start())
        at = gap.start() + size
    return [text[a:b] for a, b in zip(cut, [*cut[1:], len(text)], strict=True)]

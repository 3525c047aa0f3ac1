"""Array kernels shared by the text operators.

Spark partitions and shuffles the work; inside a task the operators see Arrow batches of
whole texts. These helpers work on the UTF-8 bytes of many texts laid end to end, so the
cost per word is a few vector instructions and no Python object exists per word.

A word is `[^\\x20\\x09-\\x0D]+`. The separators are single ASCII bytes, which never occur
inside a multi-byte UTF-8 sequence, so splitting bytes equals splitting characters.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Bytes of text handled at once inside a task: bounds the temporary arrays (30 to 150 bytes
# of temporaries per byte of text). A longer text is still handled whole, alone.
CHUNK_BYTES = 512 << 10
# And at most so many texts (operators with a dense row per text).
CHUNK_ROWS = 1 << 16

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3

_U = np.uint64
_M1, _M2, _M3 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x9E3779B97F4A7C15)
_S30, _S27, _S31, _S29 = _U(30), _U(27), _U(31), _U(29)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of terms: all ASCII but letters and digits.
NO_TERM = np.ones(256, dtype=bool)
NO_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_TAIL = np.array([0] + [(1 << (8 * n)) - 1 for n in range(1, 8)] + [2**64 - 1], dtype=np.uint64)


class Texts(NamedTuple):
    """Texts end to end: `data[offsets[i]:offsets[i + 1]]` is text i."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    """Words of `Texts` in order: byte ranges, and for text i the words first[i]:first[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def texts_of(column: pa.Array) -> Texts:
    """The bytes of a string column; a null text is empty. Eight zero bytes follow the
    last text so that words can be read eight bytes at a time."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    lo, hi = (int(offsets[0]), int(offsets[-1])) if len(column) else (0, 0)
    data = np.zeros(hi - lo + 8, dtype=np.uint8)
    if hi > lo:
        data[:-8] = np.frombuffer(raw, dtype=np.uint8)[lo:hi]
    return Texts(data, offsets - lo if len(column) else np.zeros(1, dtype=np.int64))


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES,
           rows: int = CHUNK_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of `batch` with at most `limit` bytes of text (or one longer text) and at
    most `rows` texts each."""
    col = batch.column(batch.schema.get_field_index(column))
    sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
    at = 0
    total = np.concatenate(([0], np.cumsum(sizes)))
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(total, total[at] + limit, side="right")) - 1)
        to = min(to, at + rows)
        yield batch.slice(at, to - at)
        at = to


def terms_of(texts: Texts) -> tuple[Words, np.ndarray]:
    """Terms (runs of letters, digits and non-ASCII characters, A-Z in lower case) and
    their hashes."""
    low = lowered(texts)
    words = words_of(low, NO_TERM)
    return words, span_hash(low.data, words.start, words.end)


def lowered(texts: Texts) -> Texts:
    """A-Z in lower case, all else unchanged."""
    return Texts(_LOWER[texts.data], texts.offsets)


def words_of(texts: Texts, separators: np.ndarray = _IS_SPACE) -> Words:
    """The words of all texts; `separators` says which bytes are between words."""
    data, offsets = texts
    size = int(offsets[-1])
    inside = np.zeros(size + 1, dtype=bool)
    inside[:size] = ~separators[data[:size]]
    begins = inside[:size].copy()
    begins[1:] &= ~inside[:size - 1] if size else begins[1:]
    cut = offsets[:-1][np.diff(offsets) > 0]
    begins[cut] = inside[cut]  # a text begins a word of its own
    ends = inside[:size] & ~inside[1:size + 1]
    ends[cut[1:] - 1] = inside[cut[1:] - 1]  # and the one before it ends there
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on every bit."""
    h = h ^ (h >> _S30)
    h *= _M1
    h ^= h >> _S27
    h *= _M2
    h ^= h >> _S31
    return h


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte range, eight bytes a round; ranges that are done drop out."""
    lanes = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    length = end - start
    h = (length.astype(np.uint64) + _U(seed & (2**64 - 1))) * _M3
    live, at = None, start
    left = length
    while True:
        part = lanes[at] & _TAIL[np.minimum(left, 8)]
        if live is None:
            h = mix(h ^ part)
        else:
            h[live] = mix(h[live] * _M3 ^ part)
        more = left > 8
        if not more.any():
            return h
        live = np.flatnonzero(more) if live is None else live[more]
        at, left = at[more] + 8, left[more] - 8


def run_hash(word_hash: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """Hash of each n consecutive words (element i covers words i .. i + n - 1)."""
    size = max(len(word_hash) - n + 1, 0)
    h = np.full(size, seed, dtype=np.uint64)
    for k in range(n):
        h *= _M3
        h ^= word_hash[k:k + size]
        h = h ^ (h >> _S29)
        h *= _M1
    return mix(h)


def fold(word_hash: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 7) -> np.ndarray:
    """Hash of each range of words of any length: the sum of the words' hashes, each mixed
    with its place in the range, so it is one pass whatever the lengths are. Needs ranges
    that don't overlap and are in order."""
    n = end - start
    place = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(np.cumsum(n) - n, n)
    index = np.repeat(start, n) + place
    each = mix(word_hash[index] ^ mix((place.astype(np.uint64) + _U(seed)) * _M3))
    total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(each, dtype=np.uint64)))
    upto = np.cumsum(n)
    return mix((total[upto] - total[upto - n]) ^ (n.astype(np.uint64) * _M2))


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return h.view(np.int64)


def gather(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The ranges values[start[i]:start[i] + length[i]] end to end."""
    total = int(length.sum())
    if not total:
        return values[:0].copy()
    shift = np.repeat(start - (np.cumsum(length) - length), length)
    shift += np.arange(total)
    return values[shift]


@lru_cache(maxsize=1)
def code_classes() -> np.ndarray:
    """Class of each code point (SPACE, LETTER, NUMBER, OTHER), from Unicode properties."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            a, b = ord(m[0][0]), ord(m[0][-1])
            table[a:b + 1] = kind
    table[0xD800:0xE000] = OTHER
    return table


def codes_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, and the byte at which each begins."""
    size = int(texts.offsets[-1])
    raw = texts.data[:size]
    code = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    return code, np.flatnonzero((raw & 0xC0) != 0x80)


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of `flags` (one value per byte, word or code point) within each text."""
    total = np.concatenate((np.zeros(1, dtype=np.float64 if flags.dtype.kind == "f" else np.int64), np.cumsum(flags)))
    return total[bounds[1:]] - total[bounds[:-1]]

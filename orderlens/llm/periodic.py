"""Runs of words that repeat with a period, by the dictionary of basic factors.

Words: `[^\\x20\\x09-\\x0D]+`. A run is a stretch of consecutive words of one document with
smallest period q, at least `LEAST` words and `TIMES` periods long, that no neighbouring word
extends. Per batch of whole documents, laid end to end:

1. Dictionary. Level k names each stretch of 2^k words: equal stretches of one document have
   equal names. Level 0 names the words themselves, level k + 1 pairs the names of two halves;
   names are numbers dealt by sorting, so equality is exact and nothing is hashed. A stretch
   that occurs once in its document has no name and is in no longer one that occurs again, so
   levels shrink fast in ordinary text.
2. Proposals. Occurrences of a name in order, each with its successor within twice the
   length of the stretch: three in arithmetic progression, the first of which doesn't go on
   to the left, propose their difference as a period. A run of period q shows at the level
   with q <= 2^k < 2q, where its stretches recur at multiples of q only: from its first word
   on they are such a progression.
3. Extension. Names from the highest level down say how far a stretch equals the one a period
   later. The nearest successor makes the period the smallest.
4. Runs found at several levels are kept once.

Cost: n log n for each level that still has names; n words of a document are at most
log2(n) + 1 levels of four bytes a word.

Results for edge cases: null or empty text, or one without words: no words, no runs, the
empty text; rows that share an id, and null ids, are rows of their own; an empty table gives
none; other columns are ignored; texts are whole, however long (one document in one task).
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernel as K
from .frames import map_texts

LEAST, TIMES = 6, 4


def word_ids(texts: K.Texts, words: K.Words) -> np.ndarray:
    """A number for each word, equal for equal words of one document only."""
    size = words.end - words.start
    offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
    data = K.gather(texts.data, words.start, size)
    plain = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    kinds = plain.dictionary_encode()
    return words.doc * max(len(kinds.dictionary), 1) + np.asarray(kinds.indices, dtype=np.int64)


def _extended(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of words from a on that equal those from b > a on."""
    start, n = a, len(levels[0])
    a, b = a.copy(), b.copy()
    for k in range(len(levels) - 1, -1, -1):
        live = np.arange(len(a))
        while len(live):
            live = live[b[live] < n]
            x = levels[k][a[live]]
            live = live[(x >= 0) & (x == levels[k][b[live]])]
            a[live] += 1 << k
            b[live] += 1 << k
            if k < len(levels) - 1:
                break
    return a - start


def find(word: np.ndarray, first: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period. `word` numbers the words
    of documents end to end (see `word_ids`), document d has words first[d]:first[d + 1]. At
    least three periods make a run, so `times` is 3 or more."""
    n = len(word)
    ends = np.repeat(first[1:], np.diff(first))
    at, key, k = np.arange(n), word, 0
    levels, heads, gaps = [], [], []
    while len(at):
        order = np.argsort(key, kind="stable")
        place, key = at[order], key[order]
        again = key[1:] == key[:-1]
        named = np.zeros(len(at), bool)
        named[1:] |= again
        named[:-1] |= again
        name = np.full(n, -1, np.int32)
        name[place[named]] = np.cumsum(np.concatenate(([True], ~again)))[named]
        levels.append(name)
        gap = np.where(again, place[1:] - place[:-1], 0)
        near = (gap > 0) & (gap <= 2 << k)
        three = np.flatnonzero(near[:-1] & (gap[:-1] == gap[1:]))
        head, step = place[three], gap[three]
        before = (head > 0) & (word[np.maximum(head - 1, 0)] == word[np.maximum(head - 1, 0) + step])
        heads.append(head[~before])
        gaps.append(step[~before])
        at = np.flatnonzero(name >= 0)
        at = at[at + (2 << k) <= ends[at]]
        at = at[name[at + (1 << k)] >= 0]
        key = name[at].astype(np.int64) << 32 | name[at + (1 << k)]
        k += 1
    if not levels:
        return (np.zeros(0, np.int64),) * 3
    start, period = np.concatenate(heads), np.concatenate(gaps)
    order = np.lexsort((period, start))
    start, period = start[order], period[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (period[1:] != period[:-1])
    start, period = start[fresh], period[fresh]
    length = period + _extended(levels, start, start + period)
    enough = length >= np.maximum(least, times * period)
    return start[enough], length[enough], period[enough]


def joined(texts: K.Texts, words: K.Words, index: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """For text i the words index[bounds[i]:bounds[i + 1]], joined by single spaces."""
    start, size = words.start[index], (words.end - words.start)[index]
    space = np.ones(len(index), bool)
    space[bounds[1:][np.diff(bounds) > 0] - 1] = False  # none after a text's last word
    size = size + space
    out = K.gather(texts.data, start, size)
    total = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
    out[total[1:][space] - 1] = 0x20
    offsets = np.ascontiguousarray(total[bounds])
    return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.string())


def _rows(part: pa.RecordBatch) -> list[pa.Array]:
    texts = K.texts_of(part.column(1))
    words = K.words_of(texts)
    first = words.first
    start, length, period = find(word_ids(texts, words), first)
    inside = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(inside, start + period, 1)
    np.add.at(inside, start + length, -1)
    keep = np.cumsum(inside[:-1]) == 0
    bounds = np.concatenate((np.zeros(1, np.int64), np.cumsum(keep)))[first]
    doc = np.searchsorted(first, start, side="right") - 1
    own = start - first[doc]
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (own, length, period)], names=["start", "length", "period"])
    offsets = pa.array(np.searchsorted(start, first).astype(np.int32))
    return [part.column(0), pa.array(np.diff(first), pa.int64()), pa.ListArray.from_arrays(offsets, runs),
            joined(texts, words, np.flatnonzero(keep), bounds)]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) of each row: its runs (start as a word number, length in
    words, period) by start and period, and its words joined by single spaces without those
    that some run holds after its first period."""
    return map_texts(docs, id_col, text_col,
                     "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string", _rows)

"""Benchmark decontamination: every passage queries a BM25 index of test items.

The items are indexed by term (runs of letters, digits and non-ASCII characters, lower
case): each posting holds its BM25 impact as a share of the item's own full score, so a
passage that has all of an item's terms scores 1. Postings are in blocks of `BLOCK_ITEMS`
items with the largest impact of each term and block. A document is cut into passages of
twice the longest length class that overlap by half, so any span as long as an item lies within one
passage. For all passages of a batch at once, in the manner of block-max WAND: the sum of
its terms' largest impacts drops passages that can't reach the threshold, the sum of block
maxima drops blocks, and postings of the blocks left are scored in full. Every item at or
above `THRESHOLD` is retrieved (there is no top-k), then verified in the passages of its own
length class (`_LEAST` terms times a power of two), which lie within those of the longest class: one of
them must reach `THRESHOLD` again, and the shares of the shingles of three terms of the question
(all but the last quarter of the item) and of the answer (the last quarter) that it contains must
both be `OVERLAP` or more. So neither longer items nor the shards change what is found.

The items are a stated query set against all documents: the index is made in shards of at
most `SHARD_BYTES` of item text, each sent to the tasks whole, and the documents are scanned once
a shard.

Results for edge cases: null or empty documents and items match nothing; an item of fewer
than three terms has its whole sequence as one shingle; repeated rows get their matches each;
empty tables give none; null ids stay; other columns are ignored; texts are whole.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from . import kernel as K
from .frames import keep_texts

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, SHINGLE = 0.6, 0.6, 3
BLOCK_ITEMS, SHARD_BYTES = 64, 16 << 20
_LEAST = 32  # terms of the shortest half passage
POSTINGS = 1 << 18  # spread out at once


class Index(NamedTuple):
    """Postings of one shard, sorted by (term, item)."""

    ids: list
    terms: np.ndarray    # sorted hashes
    most: np.ndarray     # largest impact of each term
    at: np.ndarray       # first posting of each term
    item: np.ndarray
    impact: np.ndarray
    block_at: np.ndarray  # first block of each term
    block: np.ndarray
    block_most: np.ndarray
    block_first: np.ndarray  # first posting of each block, and one past the last
    step: int
    own_terms: list[np.ndarray]  # of each item, with their impacts
    own_impact: list[np.ndarray]
    own_step: list[int]
    question: list[np.ndarray]
    answer: list[np.ndarray]


def _shingles(h: np.ndarray) -> np.ndarray:
    if not len(h):
        return h
    if len(h) < SHINGLE:
        return K.fold(h, np.array([0]), np.array([len(h)]))
    return np.unique(K.run_hash(h, SHINGLE))


def build(rows: list[tuple], total: int, df: dict[int, int] | None = None, mean: float | None = None) -> Index:
    """The index of some items (id, text); `total`, `df` and `mean` (terms an item) are
    statistics of all shards (by default of these items)."""
    texts = K.texts_of(pa.array([t for _, t in rows], pa.string()))
    words, h = K.terms_of(texts)
    doc, length = words.doc, np.diff(words.first)
    mean = max(float(length.mean()) if mean is None and len(length) else mean or 1.0, 1.0)
    pair_order = np.lexsort((doc, h))
    th, td = h[pair_order], doc[pair_order]
    new = np.ones(len(th), dtype=bool)
    new[1:] = (th[1:] != th[:-1]) | (td[1:] != td[:-1])
    first = np.flatnonzero(new)
    tf = np.diff(np.append(first, len(th)))
    th, td = th[first], td[first]
    terms, at, n = np.unique(th, return_index=True, return_counts=True)
    if df is not None:
        n = np.array([df[int(x)] for x in K.signed(terms)])
    idf = np.log1p((total - n + 0.5) / (n + 0.5))
    which = np.repeat(np.arange(len(terms)), np.diff(np.append(at, len(th))))
    impact = idf[which] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[td] / mean))
    own = np.bincount(td, weights=impact, minlength=len(rows))
    impact = impact / np.where(own > 0, own, 1)[td]
    by_item = np.argsort(td, kind="stable")
    cuts = np.searchsorted(td[by_item], np.arange(1, len(rows)))
    own_terms, own_impact = np.split(terms[which][by_item], cuts), np.split(impact[by_item], cuts)
    own_step = [_LEAST << max(-(-int(n) // _LEAST) - 1, 0).bit_length() for n in length]
    block = td // BLOCK_ITEMS
    cut = np.ones(len(td), dtype=bool)
    cut[1:] = (which[1:] != which[:-1]) | (block[1:] != block[:-1])
    starts = np.flatnonzero(cut)
    block_most = np.maximum.reduceat(impact, starts) if len(starts) else impact
    most = np.maximum.reduceat(impact, at) if len(at) else impact
    question, answer = [], []
    for a, b in zip(words.first[:-1], words.first[1:]):
        end = b - max((b - a) // 4, min(SHINGLE, b - a))
        question.append(_shingles(h[a:end]))
        answer.append(_shingles(h[end:b]))
    return Index([i for i, _ in rows], terms, most, np.append(at, len(td)), td, impact,
                 np.searchsorted(starts, np.append(at, len(td))), block[starts], block_most, np.append(starts, len(td)),
                 max(own_step, default=_LEAST), own_terms, own_impact, own_step, question, answer)


def _summed(passage: np.ndarray, key: np.ndarray, value: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, key, sum) of the pairs whose sum reaches `least`."""
    width = int(key.max()) + 1 if len(key) else 1
    pairs, at = np.unique(passage * width + key, return_inverse=True)
    total = np.bincount(at, weights=value, minlength=len(pairs))
    good = total >= least - 1e-9
    return pairs[good] // width, pairs[good] % width, total[good]


def _slices(index: Index, passage: np.ndarray, term: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole passages (in order) whose terms have `POSTINGS` postings together, or one
    passage with more: what is spread out at once doesn't grow with the number of items."""
    upto = np.cumsum(index.at[term + 1] - index.at[term])
    ends = np.append(np.flatnonzero(passage[1:] != passage[:-1]) + 1, len(passage))
    a = 0
    while a < len(passage):
        base = int(upto[a - 1]) if a else 0
        k = np.searchsorted(ends, np.searchsorted(upto, base + POSTINGS, side="right"), side="right") - 1
        b = int(ends[max(k, np.searchsorted(ends, a, side="right"))])
        yield a, b
        a = b


def _candidates(index: Index, passage: np.ndarray, term: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(passage, item) whose full score reaches the threshold, of pairs (passage, term)."""
    size = index.block_at[term + 1] - index.block_at[term]
    spread = K.gather(np.arange(len(index.block)), index.block_at[term], size)
    p, b, _ = _summed(np.repeat(passage, size), index.block[spread], index.block_most[spread], threshold)
    width = int(index.block.max()) + 1
    keep = np.isin(np.repeat(passage, size) * width + index.block[spread], p * width + b)
    passage, spread = np.repeat(passage, size)[keep], spread[keep]
    size = index.block_first[spread + 1] - index.block_first[spread]
    posting = K.gather(np.arange(len(index.item)), index.block_first[spread], size)
    return _summed(np.repeat(passage, size), index.item[posting], index.impact[posting], threshold)[:2]


def _passages(index: Index, h: np.ndarray, first: int, a: int, b: int, i: int) -> list[tuple[int, int]]:
    """The passages of item i's length class within the terms a:b of a text that begins at
    `first`, those with a term of the item."""
    step = index.own_step[i]
    if step == index.step:
        return [(a, b)]
    at = (a - first + np.flatnonzero(np.isin(h[a:b], index.own_terms[i]))) // step
    starts = np.unique(np.concatenate((at, at - 1))) * step + first
    starts = np.unique(np.maximum(starts, a))
    return [(x, min(x + 2 * step, b)) for x in starts.tolist()]


def search(index: Index, texts: K.Texts, threshold: float = THRESHOLD) -> list[tuple[int, int, float, float, float]]:
    """(text, item, score, question overlap, answer overlap) of all retrieved pairs: for
    each the passage with most overlap, before all others one with enough of both."""
    words, h = K.terms_of(texts)
    if not len(h) or not len(index.terms):
        return []
    n, step = np.diff(words.first), index.step
    place = np.minimum(np.searchsorted(index.terms, h), len(index.terms) - 1)
    hit = np.flatnonzero(index.terms[place] == h)
    term, doc = place[hit], words.doc[hit]
    half = (hit - words.first[doc]) // step
    # Passage k of a text has its halves k and k + 1; they are numbered through all texts.
    base = np.concatenate(([0], np.cumsum(n // step + 2)))
    number = base[doc] + half + 1
    passage = np.concatenate((number, number - 1))
    owned = np.unique(passage * len(index.terms) + np.concatenate((term, term)))
    passage, term = owned // len(index.terms), owned % len(index.terms)
    bound = np.bincount(passage, weights=index.most[term])
    alive = bound[passage] >= threshold - 1e-9
    passage, term = passage[alive], term[alive]
    met = [_candidates(index, passage[x:y], term[x:y], threshold) for x, y in _slices(index, passage, term)]
    best: dict[tuple[int, int], tuple[tuple, tuple[float, float, float]]] = {}
    for k, i in ((k, i) for p, item in met for k, i in zip(p.tolist(), item.tolist())):
        d = int(np.searchsorted(base, k, side="right")) - 1
        a = words.first[d] + max(k - base[d] - 1, 0) * step
        b = min(words.first[d] + (k - base[d] + 1) * step, words.first[d + 1])
        for x, y in _passages(index, h, int(words.first[d]), int(a), int(b), i):
            s = float(index.own_impact[i][np.isin(index.own_terms[i], h[x:y])].sum())
            if s < threshold - 1e-9:
                continue
            have = _shingles(h[x:y])
            q, r = (float(np.isin(z, have).mean()) if len(z) else 1.0 for z in (index.question[i], index.answer[i]))
            rank = (min(q, r) >= OVERLAP, q + r, s)
            if (d, i) not in best or rank > best[d, i][0]:
                best[d, i] = (rank, (s, q, r))
    return [(d, i, *x) for (d, i), (_, x) in sorted(best.items())]


def _statistics(items: DataFrame) -> tuple[int, DataFrame]:
    """Number of items, and how many have each term (t, n) how often (tf): over all shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch):
                words, h = K.terms_of(K.texts_of(part.column(1)))
                pairs = Counter((int(d), int(x)) for d, x in zip(words.doc, K.signed(h)))
                yield pa.RecordBatch.from_arrays([pa.array([x for _, x in pairs], pa.int64()), pa.array(pairs.values(), pa.int64())], names=["t", "tf"])

    rows = items.mapInArrow(run, "t long, tf long").groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.sum("tf").alias("tf"))
    return items.filter("text != ''").count(), rows


def _shards(items: DataFrame, shard_bytes: int) -> Iterator[Index]:
    """The index of `items` (item, text), in parts of about `shard_bytes` of text."""
    total, df = _statistics(items)
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = -(-size // shard_bytes) or 1
    mean = (df.agg(F.sum("tf")).first()[0] or 0) / max(total, 1) if shards > 1 else None
    for k in range(shards):
        mine = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == k)
        rows = [(r["item"], r["text"]) for r in mine.orderBy("item", "text").collect()]  # about shard_bytes
        if not rows:
            continue
        counts = None
        if shards > 1:
            _, h = K.terms_of(K.texts_of(pa.array([t for _, t in rows], pa.string())))
            wanted = items.sparkSession.createDataFrame([(int(x),) for x in np.unique(K.signed(h))], "t long")
            counts = {r["t"]: r["n"] for r in df.join(wanted, "t").collect()}
        yield build(rows, total, counts, mean)


def _items(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return (items.select(items[item_col].alias("item"), F.lower(items[text_col].cast("string")).alias("text"))
            .filter("text IS NOT NULL AND text != ''"))


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", threshold: float = THRESHOLD, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(id, item_id, score, question_overlap, answer_overlap, leaked boolean): all retrieved
    pairs of a document and an item."""
    items = _items(items, item_col, item_text_col)
    docs = docs.select(docs[id_col].alias("id"), F.lower(docs[text_col].cast("string")).alias("text"))
    kind, item_kind = (x.schema[c].dataType for x, c in ((docs, "id"), (items, "item")))
    found = [_scan(docs, index, kind, item_kind, threshold) for index in _shards(items, shard_bytes)]
    schema = f"id {kind.simpleString()}, item {item_kind.simpleString()}, score double, question_overlap double, answer_overlap double, leaked boolean"
    out = reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)
    return out.withColumnsRenamed({"id": id_col, "item": "item_id"})


def remove_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", threshold: float = THRESHOLD, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The rows of `docs` (all columns) that contain no item."""
    def keep(index: Index):
        def clean(texts: pa.Array) -> np.ndarray:
            found = search(index, K.texts_of(texts), threshold)
            good = np.ones(len(texts), dtype=bool)
            good[[d for d, _, _, q, a in found if q >= OVERLAP and a >= OVERLAP]] = False
            return good

        return clean

    # Lower case as in `matches` and in the items: one engine does it for all three.
    low = "_low"
    while low in docs.columns:
        low += "_"
    docs = docs.withColumn(low, F.lower(docs[text_col].cast("string")))
    for index in _shards(_items(items, item_col, item_text_col), shard_bytes):
        docs = keep_texts(docs, low, keep(index))
    return docs.drop(low)


def _scan(docs: DataFrame, index: Index, kind, item_kind, threshold: float) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    item_type = to_arrow_type(item_kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch):
                got = search(index, K.texts_of(part.column(1)), threshold)
                ids = part.column(0).take(pa.array([g[0] for g in got], pa.int64()))
                columns = [pa.array([g[c] for g in got], pa.float64()) for c in (2, 3, 4)]
                leaked = pa.array([g[3] >= OVERLAP and g[4] >= OVERLAP for g in got], pa.bool_())
                yield pa.RecordBatch.from_arrays([ids, pa.array([index.ids[g[1]] for g in got], item_type), *columns, leaked],
                                                 names=["id", "item", "score", "question_overlap", "answer_overlap", "leaked"])

    return docs.mapInArrow(run, f"id {kind.simpleString()}, item {item_kind.simpleString()}, score double, question_overlap double, answer_overlap double, leaked boolean")


def leaks(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """Verified pairs only."""
    return matches(docs, items, **names).filter("leaked").drop("leaked")

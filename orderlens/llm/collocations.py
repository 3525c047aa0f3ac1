"""Phrase collocations by dynamic itemset counting.

Texts (null: empty; A-Z in lower case) are cut at `[.,;:!?\\x0A-\\x0D]` into pieces and these
into words `[^\\x20\\x09]+`; a phrase is up to `LONGEST` words that follow each other in a piece,
of one language (null: `und`). All counts are exact, over all documents.

The documents, as words, are dealt into `SHARDS` shards, scanned in a cycle. A visit of a shard
counts phrases of all lengths that are active, each in its first visit since it became so:

- single words are active from the beginning;
- a longer phrase becomes active as soon as both its subphrases, without the last and without
  the first word, have reached the threshold in what was counted so far. As a phrase is no
  more frequent than its parts, each that reaches the threshold becomes active;
- after one full cycle its count is complete, as each shard has counted it once.

When a whole cycle brings no phrase to the threshold, all active phrases are complete.

What tasks know of the phrases that reached the threshold is a Bloom filter of `FILTER_BITS`
bits, whatever the data, built in Spark and broadcast. It has no false negatives; a false
positive only makes a phrase active early, and its count is as exact as any. A task counts what
is active by the present filter and wasn't by the filter of this shard's last visit, so no
occurrence is counted twice or left out. Within a task equal phrases are found by 64-bit hashes;
between tasks the phrases themselves are the keys, aggregated map-side first.

Counts are carried from visit to visit: each adds its own to those of phrases whose cycle isn't
over, in one aggregate. A phrase whose cycle is over leaves, with its full count if that
reaches the threshold. More shards make phrases active earlier in a cycle, and carry each count
through more steps.

Results for edge cases: an empty table, or texts without words, give no rows; ids aren't read,
repeated rows count again; other columns are ignored; texts are whole, however long.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import kernel as K
from .frames import stored
from .periodic import joined

#: Shards of a cycle, longest phrase, least number of occurrences, rows for each language.
SHARDS, LONGEST, SUPPORT, TOP = 2, 5, 100, 2000
#: Size of the broadcast filter in bits (a power of two) and bytes of text counted at once.
FILTER_BITS, CHUNK = 1 << 26, 4 << 20
#: A language's rows are ranked in so many parts first.
PARTS = 64
UNKNOWN = "und"

_U = np.uint64
_PIECE = np.zeros(256, bool)
_PIECE[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_CUT = _PIECE.copy()
_CUT[[0x20, 0x09]] = True
_SCAN = np.zeros(256, bool)
_SCAN[[0x20, 0x0A]] = True


# ------------------------------------------------------------------ inside a task
def _normal(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts as words, joined by a space within a piece, by a line feed between pieces, and
    their numbers of words."""
    texts = K.lowered(K.texts_of(column))
    words = K.words_of(texts, _CUT)
    plain = joined(texts, words, np.arange(len(words.start)), words.first)
    made = K.texts_of(plain)
    data, n = made.data.copy(), len(words.start)
    if n > 1:
        pieces = np.concatenate((np.zeros(1, np.int64), np.cumsum(_PIECE[texts.data])))
        new = pieces[words.start[1:]] != pieces[words.end[:-1]]
        inner = np.ones(n - 1, bool)  # words that have a next one in their text
        inner[words.first[1:-1][(words.first[1:-1] > 0) & (words.first[1:-1] < n)] - 1] = False
        size = words.end - words.start
        gap = np.append(inner, False)
        after = np.cumsum(size + gap) - 1  # the byte that follows each word that has a next one
        data[after[:-1][new & inner]] = 0x0A
    offsets = np.ascontiguousarray(made.offsets)
    text = pa.Array.from_buffers(pa.large_string(), len(plain), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return text.cast(pa.string()), np.diff(words.first)


def _hashes(texts: K.Texts, langs: pa.Array) -> tuple[K.Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of normal texts; hash of (language, word) and of the word of each; whether the
    next word is of the same piece."""
    words = K.words_of(texts, _SCAN)
    plain = K.span_hash(texts.data, words.start, words.end)
    names = K.texts_of(langs)
    kind = K.span_hash(names.data, names.offsets[:-1], names.offsets[1:], seed=3)
    first = K.mix(plain ^ np.repeat(kind, np.diff(words.first)))
    near = texts.data[words.end] == 0x20
    near[words.first[1:][np.diff(words.first) > 0] - 1] = False
    return words, first, plain, near


def _longer(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase and one more word."""
    return K.mix(h * K._M3 ^ word)


def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash in the filter."""
    mask = _U(FILTER_BITS - 1)
    return (h & mask).astype(np.int64), ((h >> _U(32)) * K._M1 >> _U(20) & mask).astype(np.int64)


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    a, b = _places(h)
    found = bits[a >> 3] >> (a & 7).astype(np.uint8) & 1
    at = np.flatnonzero(found)
    b = b[at]
    found[at] = bits[b >> 3] >> (b & 7).astype(np.uint8) & 1
    return found.astype(bool)


def _active(texts: K.Texts, langs: pa.Array, now: np.ndarray, before: np.ndarray | None, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, places, hashes) of the phrases of k words to count: active by the filter `now` and,
    if the shard was visited already, not by the one of that visit."""
    words, h, word, near = _hashes(texts, langs)
    if before is None:
        yield 1, np.arange(len(h)), h
    at = np.arange(len(h))
    old = np.zeros(len(h) + 1, bool)  # was active, and has reached the threshold, before
    alive = np.zeros(len(h) + 1, bool)  # the same now
    for k in range(2, longest + 1):
        reached = _has(now, h)
        was = old[at] if k > 2 else np.ones(len(at), bool)
        old[:] = False
        if before is not None:
            old[at] = was & _has(before, h)
        alive[:] = False
        alive[at] = reached
        both = reached & alive[at + 1] & near[at + k - 2]
        at, h = at[both], h[both]
        if not len(at):
            return
        h = _longer(h, word[at + k - 1])
        done = old[at] & old[at + 1]
        old[:] = False
        old[at] = done
        yield k, at[~done], h[~done]


def _counter(now: np.ndarray, before: np.ndarray | None, longest: int):
    """The function for mapInArrow that counts active phrases of (lang, text) rows. Its filters
    travel compressed: with few phrases most of their bits are zero."""
    sent, last = zlib.compress(now, 1), None if before is None else zlib.compress(before, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = (None if x is None else np.frombuffer(zlib.decompress(x), np.uint8) for x in (sent, last))
        for batch in batches:
            for part in K.chunks(batch, limit=CHUNK):
                texts, langs = K.texts_of(part.column(1)), part.column(0)
                words = K.words_of(texts, _SCAN)
                for k, at, h in _active(texts, langs, now, before, longest):
                    if not len(at):
                        continue
                    order = np.argsort(h)
                    h = h[order]
                    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
                    rep = at[order[first]]
                    start, end = words.start[rep], words.end[rep + k - 1]
                    offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(end - start)))
                    phrase = pa.Array.from_buffers(pa.large_string(), len(rep), [
                        None, pa.py_buffer(offsets), pa.py_buffer(K.gather(texts.data, start, end - start))])
                    doc = np.searchsorted(words.first, rep, side="right") - 1
                    yield pa.RecordBatch.from_arrays([
                        langs.take(pa.array(doc)), pa.array(np.full(len(rep), k, np.int32)), phrase.cast(pa.string()),
                        pa.array(np.diff(np.append(first, len(h))))], names=["lang", "k", "phrase", "n"])

    return run


def _bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, bits): the filter's bits of (lang, phrase) rows, 64 to a slot."""
    for batch in batches:
        texts = K.texts_of(batch.column(1))
        words, first, plain, _ = _hashes(texts, batch.column(0))
        at, size = words.first[:-1], np.diff(words.first)
        h = first[at]
        for k in range(1, int(size.max(initial=1))):
            more = size > k
            h[more] = _longer(h[more], plain[at[more] + k])
        place = np.concatenate(_places(h))
        yield pa.RecordBatch.from_arrays([
            pa.array(place >> 6), pa.array((_U(1) << (place & 63).astype(_U)).view(np.int64))], names=["slot", "bits"])


# ------------------------------------------------------------------ Spark
def _added(bits: np.ndarray, reached: DataFrame, longest: int) -> np.ndarray:
    """The filter with the phrases of `reached` that longer ones can begin or end with. At most
    FILTER_BITS / 64 slots come to the driver."""
    slots = (reached.filter(F.col("k") < longest).select("lang", "phrase").mapInArrow(_bits_of, "slot long, bits long")
             .groupBy("slot").agg(F.bit_or("bits").alias("bits"))).toArrow()
    out = bits.copy().view("<u8")
    at = np.asarray(slots.column("slot")).astype(np.int64)
    out[at] |= np.asarray(slots.column("bits")).astype(np.int64).view(_U)
    return out.view(np.uint8)


def count_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                  longest: int = LONGEST, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, n) of every phrase of k = 1 .. `longest` words with n >= `support`
    occurrences, and (lang, n) of all words."""
    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch):
                text, words = _normal(part.column(2))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), text, pa.array(words)], names=["shard", "lang", "text", "words"])

    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    plain = docs.select(F.pmod(F.xxhash64(text), F.lit(shards)).cast("int").alias("shard"),
                        F.coalesce(docs[lang_col].cast("string"), F.lit(UNKNOWN)).alias("lang"), text.alias("text"))
    scans = stored(plain.mapInArrow(normal, "shard int, lang string, text string, words long"), "shards", partition_by="shard")

    key = ["lang", "k", "phrase"]
    filters, carried, full = [np.zeros(FILTER_BITS // 8, np.uint8)], None, []
    while True:
        step = len(full)
        before = filters[step - shards] if step >= shards else None
        rows = scans.filter(F.col("shard") == step % shards).select("lang", "text")
        counted = rows.mapInArrow(_counter(filters[step], before, longest), "lang string, k int, phrase string, n long").withColumn("first", F.lit(step))
        if carried is not None:
            counted = counted.unionByName(carried)
        open_yet = F.col("first") > step - shards + 1  # first counted in this visit or one whose cycle goes on
        sums = counted.groupBy(*key).agg(F.sum("n").alias("n"), F.min("first").alias("first"))
        sums = stored(sums.filter(open_yet | (F.col("n") >= support)), f"visit-{step}")
        carried = sums.filter(open_yet)
        full.append(stored(sums.filter(F.col("n") >= support).drop("first"), f"reached-{step}"))
        filters.append(_added(filters[step], full[-1], longest))
        if step >= shards - 1 and all(np.array_equal(filters[-1], f) for f in filters[-1 - shards:-1]):
            break
        if step >= shards:
            filters[step - shards] = None  # of no more use
    counts = reduce(DataFrame.unionByName, full).groupBy(*key).agg(F.max("n").alias("n"))
    words = scans.groupBy("lang").agg(F.sum("words").alias("n")).filter("n > 0")
    return stored(counts, "phrases"), stored(words, "words")


def _words(first: Column | int, count: Column | int) -> Column:
    """`count` words of the phrase from word `first` (1-based) on."""
    return F.array_join(F.slice(F.split("phrase", " "), first, count), " ")


def _score() -> Column:
    """floor(1000 a n / (l r)) in 38 digits."""
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    return F.call_function("div", F.lit(1000).cast("decimal(38,0)") * wide("a") * wide("n"), wide("l") * wide("r")).cast("long")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                 longest: int = LONGEST, top: int = TOP, cover: int = 100, shards: int = SHARDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first `top` phrases. A phrase
    of a occurrences, cut into parts of l and r, scores floor(1000 a n / (l r)) at the cut where
    that is least; one that lies in a longer phrase with at least `cover` % of its occurrences is
    dropped."""
    counts, words = count_phrases(docs, text_col, lang_col, support, longest, shards)
    found = counts.filter("k > 1").withColumnRenamed("n", "a")
    # Dropped: the sums over longer phrases are taken part by part, at most k (k - 1) / 2 of each.
    parts = found.filter("k > 2").select(
        "lang", "a", F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda size: F.transform(
            F.sequence(F.lit(1), F.col("k") - size + 1), lambda at: _words(at, size))))).alias("phrase"))
    longer = parts.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = (found.join(longer, ["lang", "phrase"], "left")
            .filter(F.col("most").isNull() | (100 * F.col("most") < cover * F.col("a"))).drop("most"))
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("*", _words(F.lit(1), F.col("cut")).alias("head"), _words(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail"))
    side = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    cuts = cuts.join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"), ["lang", "tail"]).join(words, "lang")
    scored = cuts.withColumn("score", _score())
    best = (scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
            .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score"))
    # Two steps, so that no task ranks all phrases of a language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = best.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    first = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

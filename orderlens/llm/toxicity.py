"""Toxicity scores of restored text: a noisy channel and a lexicon learned from labels.

Writers hide words by leetspeak (`1d10t`), spacing (`i d i o t`, `i.d.i.o.t`) and
repetition (`idiooot`). Each such token is a lattice: every character may stand for itself
or, if it is a substitute character, for one of the letters in `SUBSTITUTES`; a separator
inside may be noise or the boundary of two words (`idiot/moron`); a run of one letter may
be one or two. Characters one at a time (`a 1 d 1 0 t`) are one token whose separators are
the spaces. Separators are ASCII symbols and, outside ASCII, all but letters, marks and
numbers (Unicode spaces part tokens). The Viterbi path under a
character trigram model is the restored word. The trigram model counts all words of the
whole corpus (a table of 28 x 28 x 28, so the model doesn't grow with the corpus, but what
is counted does). Tokens without a substitute, inner separator or long run have one path
only, which is the token itself: they aren't decoded.

Restored words (without edge punctuation, runs squeezed) are looked up in a lexicon of
words that mark toxic texts; of a token with symbols inside, also the pieces between its
separators, those between all its symbols, and the reading without any boundary. The lexicon is a greedy list: words that most exceed the base
rate in the labelled texts not yet explained by an earlier word, copies of one text
counting once in every count, the choice of candidates included. Score: noisy-or of the lexicon words in the text over the base rate of
texts without any. Fitted on a bounded sample of labelled rows (`SAMPLE`); everything else
covers all rows and whole texts.

Results for edge cases: a null or empty text (no words) scores the base rate; unlabelled
rows are not learned from, of an id's differing labels the more frequent one counts (1 if
equally frequent); with no labels the score is 0; repeated rows get their result
each time; other columns are ignored. Runs of two or more substitute symbols at a token's
edge (`the$$$`) are decoration, not letters; runs of digits (`57up1d`) may be either.
"""
from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import kernel as K
from .frames import decided, keep_texts, map_texts, sampled

#: Labelled rows that the lexicon is fitted on.
SAMPLE = 20_000
#: A word enters the lexicon at this support, precision and excess over the base rate.
#: MIN_SHARE: of all toxic texts of the sample; so there are at most 1 / MIN_SHARE times as
#: many candidates as a toxic text has different words, and 1 / MIN_SHARE lexicon words.
MIN_TOXIC, MIN_SHARE, MIN_PRECISION, MIN_SIGMAS = 4, 0.01, 0.6, 5.0
#: Sums of weights like 1/3 that reach a bound but for rounding reach it.
_ROUNDING = 1e-9
#: What leaving out substitute characters at an edge of a token costs a reading.
EDGE_COST = 0.5
#: So many characters one at a time may be a spaced word.
SPACED = 2
# Letters that a substitute character can stand for.
SUBSTITUTES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t",
               "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c"}
_SYMBOLS = 28  # boundary, a-z, any other letter

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[range(97, 123)] = range(1, 27)
_SYMBOL[128:] = 27
_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[range(97, 123)] = True
_IS_LETTER[128:] = True
_IS_SUB = np.zeros(256, dtype=bool)
_IS_SUB[[ord(c) for c in SUBSTITUTES]] = True
_IS_DIGIT = np.zeros(256, dtype=bool)
_IS_DIGIT[range(48, 58)] = True
_NOT_LAST = "!(|"  # substitutes that are punctuation at the end of a token


class Model(NamedTuple):
    """Trigram costs; lexicon hashes (sorted) with their rates; rate of texts with none."""

    cost: np.ndarray
    words: np.ndarray
    rates: np.ndarray
    base: float


@lru_cache(maxsize=1)
def _separators() -> np.ndarray:
    """For each code point outside ASCII: the byte that stands for it, 0 if it is part of words."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for code in range(0x80, 0x110000):
        kind = unicodedata.category(chr(code))
        if kind[0] not in "LMN":
            table[code] = ord(" ") if kind[0] == "Z" else ord(".")
    return table


def prepared(texts: K.Texts) -> K.Texts:
    """A-Z in lower case; separators outside ASCII as spaces or dots of the same length."""
    low = K.lowered(texts)
    data = low.data
    at = np.flatnonzero(data >= 0xC2)
    if not len(at):
        return low
    lead = data[at].astype(np.int64)
    c1, c2, c3 = ((data[at + k] & 63).astype(np.int64) for k in (1, 2, 3))
    code = np.where(lead < 0xE0, (lead & 31) << 6 | c1,
                    np.where(lead < 0xF0, (lead & 15) << 12 | c1 << 6 | c2, (lead & 7) << 18 | c1 << 12 | c2 << 6 | c3))
    mark = _separators()[code]
    some = mark > 0
    width = 2 + (lead[some] >= 0xE0) + (lead[some] >= 0xF0)
    data[K.gather(np.arange(len(data)), at[some], width)] = np.repeat(mark[some], width)
    return low


def trigram_counts(texts: K.Texts) -> np.ndarray:
    """Counts of symbol trigrams of words; a word begins after two boundaries."""
    size = int(texts.offsets[-1])
    data = prepared(texts).data[:size]
    keep = (data & 0xC0) != 0x80  # one symbol a character
    s = _SYMBOL[data]
    text = np.repeat(np.arange(len(texts)), np.diff(texts.offsets))[keep]
    s = s[keep]
    if not len(s):
        return np.zeros(_SYMBOLS**3, dtype=np.int64)
    change = np.flatnonzero(np.diff(text)) + 1
    s = np.insert(s, change, 0)
    s = np.concatenate(([0, 0], s, [0]))
    keep = np.r_[True, True, (s[2:] > 0) | (s[1:-1] > 0)]  # one boundary between words
    s = s[keep]
    before = np.where(s[1:-1] == 0, 0, s[:-2])
    return np.bincount((before * _SYMBOLS + s[1:-1]) * _SYMBOLS + s[2:], minlength=_SYMBOLS**3)


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigram costs (negative logarithms) from the words of all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            for part in K.chunks(batch):
                total += trigram_counts(K.texts_of(part.column(0)))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["gram", "n"])

    rows = (docs.select(docs[text_col].cast("string").alias("text")).mapInArrow(run, "gram int, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).collect())
    n = np.zeros(_SYMBOLS**3)
    for r in rows:
        n[r["gram"]] = r["n"]
    n = n.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)
    pair = n.sum(axis=0) + 0.5
    backed = pair / pair.sum(axis=1, keepdims=True)
    weight = 5.0
    return -np.log((n + weight * backed[None]) / (n.sum(axis=2, keepdims=True) + weight))


def _in_word(c: str) -> bool:
    return c.isalpha() or c >= "\x80" and unicodedata.category(c)[0] in "LMN"


def _edges(items: list[tuple[str, bool]], at: int, step: int) -> list[int]:
    """Where a token's word may begin (step -1) or end (1): at its outermost letter `at`,
    a substitute further, or at the outermost substitute that isn't decoration."""
    far, n = at, len(items)
    parted = lambda i, j: not (0 <= i < n and 0 <= j < n) or items[max(i, j)][1]
    while 0 <= far + step < n:
        i, out = far + step, far + 2 * step
        c = items[i][0]
        if step > 0 and c in _NOT_LAST or not c.isdigit() and not parted(i, out) and items[out][0] == c:
            break
        if parted(far, i) and not parted(i, out):  # a group of its own, not one of spaced characters
            break
        far = i
    return list(dict.fromkeys((at, at + step if far != at else at, far)))


def _readings(token: str) -> list[tuple[list[tuple[str, bool]], float]]:
    """Lattices of a token: with and without substitutes at its edges, runs as one or two,
    separators as noise or also as boundaries. An element: its letters, and whether a
    boundary may come before."""
    items: list[tuple[str, bool]] = []  # letters and substitutes; whether a separator is before
    parted = False
    for c in token:
        if c in SUBSTITUTES or _in_word(c):
            items.append((c, parted and bool(items)))
            parted = False
        else:
            parted = True
    letters = [i for i, (c, _) in enumerate(items) if c not in SUBSTITUTES]
    if not letters:
        return []
    begins, ends = _edges(items, letters[0], -1), _edges(items, letters[-1], 1)
    found: list[tuple[list[tuple[str, bool]], float]] = []
    for a, b in [(a, b) for b in ends for a in begins]:
        extra = EDGE_COST * ((a != begins[-1]) + (b != ends[-1]))
        ways = [(SUBSTITUTES.get(c, c), parted and i > a) for i, (c, parted) in enumerate(items[a:b + 1], a)]
        for most in (1, 2):
            kept: list[tuple[str, bool]] = []
            run = 0
            for w, parted in ways:
                run = run + 1 if kept and w == kept[-1][0] else 1
                if run <= most:
                    kept.append((w, parted))
            for lattice in ([(w, False) for w, _ in kept], kept):
                if lattice not in [x for x, _ in found]:
                    found.append((lattice, extra))
    return found


def _pieces(token: str) -> list[str]:
    """What is between a token's separators, and between all of its symbols."""
    out = []
    for parts in (lambda c: c not in SUBSTITUTES and not _in_word(c), lambda c: not c.isdigit() and not _in_word(c)):
        split = "".join(" " if parts(c) else c for c in token).split()
        out += split if len(split) > 1 else []
    return list(dict.fromkeys(out))


def decode(tokens: list[str], cost: np.ndarray) -> list[tuple[str, ...]]:
    """The most likely reading of each token's lattices (one a lattice, best first); words
    of a reading are parted by a space."""
    lattices, extra, owner = [], [], []
    for i, token in enumerate(tokens):
        for ways, edges in _readings(token):
            lattices.append(ways)
            extra.append(edges)
            owner.append(i)
    out: list[list[tuple[float, str]]] = [[] for _ in tokens]
    widths = [max(len(w) * (1 + cut) for w, cut in x) for x in lattices]
    order = sorted(range(len(lattices)), key=lambda k: (widths[k], len(lattices[k])))
    at = 0
    while at < len(order):
        to = at + 1  # lattices of one width and nearly one length, bounded in size together
        while (to < len(order) and widths[order[to]] == widths[order[at]] and (to - at + 1) * len(lattices[order[to]]) <= 60_000
               and len(lattices[order[to]]) <= len(lattices[order[at]]) + 3):
            to += 1
        some = [lattices[k] for k in order[at:to]]
        for k, (c, word) in zip(order[at:to], _viterbi(some, widths[order[at]], cost)):
            out[owner[k]].append((c + extra[k], word))
        at = to
    return [tuple(dict.fromkeys(w for _, w in sorted(x))) for x in out]


def _viterbi(lattices: list[list[tuple[str, bool]]], width: int, cost: np.ndarray) -> list[tuple[float, str]]:
    """Best path of each lattice and its cost a letter; states are the last two readings. A
    reading is a letter, or a boundary and a letter."""
    n, size = len(lattices), max(map(len, lattices))
    length = np.array([len(x) for x in lattices])
    code = np.zeros((n, size + 1, width), dtype=np.int64)
    there = np.zeros((n, size + 1, width), dtype=bool)
    cut = np.zeros((n, size + 1, width), dtype=bool)
    for i, ways in enumerate(lattices):
        for j, (w, parted) in enumerate(ways):
            for k, c in enumerate(w + w if parted else w):
                code[i, j, k] = ord(c) - 96 if "a" <= c <= "z" else 27
                there[i, j, k] = True
                cut[i, j, k] = k >= len(w)
        there[i, len(ways):, 0] = True  # the boundary, code 0
    big = 1e9
    cuts = bool(cut.any())
    score = np.where(there[:, 0], cost[0, 0][code[:, 0]], big)[:, None, :].repeat(width, axis=1)
    score[:, 1:, :] = big
    before = np.zeros((n, width), dtype=np.int64)
    back = np.zeros((size + 1, n, width, width), dtype=np.int8)
    prev = code[:, 0]
    first = before
    for j in range(1, size + 1):
        context = np.where(cut[:, j - 1][:, None, :], 0, first[:, :, None])  # a word begins after two boundaries
        step = cost[context[..., None], prev[:, None, :, None], code[:, j][:, None, None, :]]
        if cuts:
            parted = cost[context, prev[:, None, :], 0][..., None] + cost[0, 0][code[:, j]][:, None, None, :]
            step = np.where(cut[:, j][:, None, None, :], parted, step)
        live = (j <= length)[:, None, None, None]
        total = score[:, :, :, None] + np.where(live, step, 0) + np.where(there[:, j][:, None, None, :], 0, big)
        back[j] = total.argmin(axis=1)
        score = total.min(axis=1)
        first, prev = prev, code[:, j]
    flat = score.reshape(n, -1)
    best = flat.argmin(axis=1)
    b, c = best // width, best % width
    picks = np.zeros((n, size + 1), dtype=np.int64)
    rows = np.arange(n)
    for j in range(size, 0, -1):
        picks[:, j], picks[:, j - 1] = c, b
        b, c = back[j][rows, b, c], b
    return [(flat[i, best[i]] / (len(x) + 1), "".join((" " if k >= len(w) else "") + w[k % len(w)] for k, (w, _) in zip(picks[i].tolist(), x)))
            for i, x in enumerate(lattices)]


def restored_words(texts: K.Texts, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts after restoration (runs squeezed), and each one's
    text. Words without a letter have none."""
    low = prepared(texts)
    words = K.words_of(low)
    data, size = low.data, int(low.offsets[-1])
    every = words.doc
    doc = every
    letter = _IS_LETTER[data[:size]]
    places = np.flatnonzero(letter)
    a, b = np.searchsorted(places, words.start), np.searchsorted(places, words.end)
    some = np.flatnonzero(b > a)
    start, end, doc = words.start[some], words.end[some], doc[some]
    first, last = places[a[some]], places[b[some] - 1]
    inner = (last - first + 1) > (b[some] - a[some])
    padded = np.concatenate(([0, 0], data, [0, 0]))
    at = lambda i: padded[i + 2]
    lead = (first > start) & _IS_SUB[at(first - 1)] & (_IS_DIGIT[at(first - 1)] | (first - 1 == start) | (at(first - 2) != at(first - 1)))
    trail = ((last + 1 < end) & _IS_SUB[at(last + 1)] & ~np.isin(at(last + 1), [ord(c) for c in _NOT_LAST])
             & (_IS_DIGIT[at(last + 1)] | (last + 2 == end) | (at(last + 2) != at(last + 1))))
    same = np.zeros(size + 1, dtype=np.int64)
    if size > 2:
        same[1:size - 1] = np.cumsum((data[:size - 2] == data[1:size - 1]) & (data[1:size - 1] == data[2:size]) & letter[:size - 2] & (data[:size - 2] < 128))
        same[size - 1:] = same[size - 2]
    long_run = same[np.maximum(last - 1, first)] > same[first]
    # Characters one at a time: a run of tokens with one letter or one substitute each.
    begins = (data[:size] & 0xC0) != 0x80
    upto = [np.concatenate(([0], np.cumsum(x))) for x in (letter & begins, _IS_SUB[data[:size]], begins)]
    letters, subs, chars = (x[words.end] - x[words.start] for x in upto)
    single = (chars <= 2) & ((letters == 1) | ((letters == 0) & (subs == 1)))
    group = np.cumsum(~np.r_[False, single[1:] & single[:-1] & (every[1:] == every[:-1])][:len(single)])
    counts, with_letters = np.bincount(group, minlength=1), np.bincount(group, weights=letters, minlength=1)
    run = single & (counts[group] >= SPACED) & (with_letters[group] > 0)
    spaced = run[some]
    odd = (inner | lead | trail | long_run) & ~spaced
    plain = ~odd & ~spaced
    # Plain words: letters between the edges, runs squeezed.
    s, e = first[plain], last[plain] + 1
    flat = K.gather(data, s, e - s)
    begin = np.cumsum(e - s) - (e - s)
    keep = np.ones(len(flat), dtype=bool)
    keep[1:] = (flat[1:] != flat[:-1]) | (flat[1:] >= 128)
    keep[begin] = True
    upto = np.concatenate(([0], np.cumsum(keep)))
    hashes = K.span_hash(np.concatenate((flat[keep], np.zeros(8, dtype=np.uint8))), upto[begin], upto[begin + (e - s)])
    docs = [doc[plain]]
    out = [hashes]
    tokens: list[bytes] = [data[i:j].tobytes() for i, j in zip(start[odd], end[odd])]
    owner = doc[odd].tolist()
    if run.any():
        g, where = group[run], np.flatnonzero(run)
        for k in np.split(where, np.flatnonzero(np.diff(g)) + 1):
            tokens.append(b" ".join(data[words.start[i]:words.end[i]].tobytes() for i in k))
            owner.append(int(every[k[0]]))
    if tokens:
        distinct = sorted(set(tokens))
        whole = [t.decode("utf-8", "replace") for t in distinct]
        pieces = [_pieces(t) for t in whole]
        parts = sorted({*whole, *(p for x in pieces for p in x)})
        read = dict(zip(parts, decode(parts, cost)))
        index = {t: i for i, t in enumerate(distinct)}
        found = [list(dict.fromkeys(_squeezed(w) for p in (t, *x) for r in read[p] for w in r.split(" "))) for t, x in zip(whole, pieces)]
        flat_words = [w for x in found for w in x]
        sizes = np.array([len(x) for x in found])
        begin = np.cumsum(sizes) - sizes
        made = K.texts_of(pa.array(flat_words, pa.string()))
        h = K.span_hash(made.data, made.offsets[:-1], made.offsets[1:])
        which = np.array([index[t] for t in tokens])
        out.append(K.gather(h, begin[which], sizes[which]))
        docs.append(np.repeat(np.array(owner), sizes[which]))
    return np.concatenate(out), np.concatenate(docs)


def _squeezed(word: str) -> str:
    return "".join(c for i, c in enumerate(word) if not i or c != word[i - 1] or c >= "\x80")


def restore(docs: DataFrame, cost: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, restored string): the text in lower case with each hidden word replaced by its
    most likely reading; other words stay."""
    def rows(part: pa.RecordBatch):
        texts = part.column(1).to_pylist()
        split = [(t or "").lower().split() for t in texts]
        # Characters one at a time are read together.
        def single(w: str) -> bool:
            subs = sum(c in SUBSTITUTES for c in w)
            letters = sum(c not in SUBSTITUTES and _in_word(c) for c in w)
            return len(w) <= 2 and (letters == 1 or letters == 0 and subs == 1)

        for words in split:
            i = 0
            while i < len(words):
                j = i
                while j < len(words) and single(words[j]):
                    j += 1
                if j - i >= SPACED and any(c not in SUBSTITUTES and _in_word(c) for w in words[i:j] for c in w):
                    words[i:j] = [" ".join(words[i:j])]
                    j = i
                i = max(i + 1, j)
        need = sorted({w for words in split for w in words if any(c in SUBSTITUTES or not c.isalnum() for c in w) or any(w[k] == w[k + 1] == w[k + 2] for k in range(len(w) - 2))})
        best = {w: (x[0] if x else w) for w, x in zip(need, decode(need, cost))}
        return [part.column(0), pa.array([" ".join(best.get(w, w) for w in words) for words in split], pa.string())]

    return map_texts(docs, id_col, text_col, "restored string", rows)


def _select(row: np.ndarray, word: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> list[tuple[int, float]]:
    """The greedy list: words (numbers) and the rate of toxic texts among those they
    explain. `word[i]` is in the text `row[i]`."""
    left = np.ones(len(toxic), dtype=bool)
    least_toxic = max(MIN_TOXIC, MIN_SHARE * float(weight[toxic].sum()))
    words = int(word.max()) + 1 if len(word) else 0
    chosen: list[tuple[int, float]] = []
    while True:
        n = float(weight[left].sum())
        t = float(weight[left & toxic].sum())
        base = min(max(t / n, 0.01), 0.5) if n else 0.5
        keep = left[row]
        row, word = row[keep], word[keep]
        nw = np.bincount(word, weights=weight[row], minlength=words)
        tw = np.bincount(word, weights=(weight * toxic)[row], minlength=words)
        able = (tw >= least_toxic - _ROUNDING) & (tw >= MIN_PRECISION * nw - _ROUNDING)
        # Rounded: equal words stay equal whatever the order of the sums; the first one wins.
        sigmas = np.where(able, np.round((tw - nw * base) / np.sqrt(np.maximum(nw, _ROUNDING) * base * (1 - base)), 9), 0.0)
        best = int(sigmas.argmax()) if words else 0
        if not words or sigmas[best] <= MIN_SIGMAS:
            return chosen
        chosen.append((best, min((tw[best] + 1) / (nw[best] + 1.5), 0.99)))
        left[row[word == best]] = False


def fit(docs: DataFrame, labels: DataFrame, cost: np.ndarray, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn the lexicon from `labels` (id, label): a bounded sample of its rows."""
    empty = Model(cost, np.zeros(0, dtype=np.uint64), np.zeros(0), 0.0)
    rows = decided(labels, id_col, label_col, "toxic")
    rows = sampled(rows, "id", SAMPLE)
    texts = (docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
             .join(F.broadcast(rows), "id").select("toxic", "text"))  # bounded: SAMPLE rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch):
                t = K.texts_of(part.column(1))
                h, doc = restored_words(t, cost)
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])][:len(h)]
                h, doc = h[new], doc[new]
                w = K.words_of(t)
                # Copies of a text share the least hash of five words (or all, if fewer).
                each = K.span_hash(t.data, w.start, w.end)
                five = K.run_hash(each, 5)
                least = [int(five[a:b - 4].min()) if b - a >= 5 else int(K.run_hash(each[a:b], b - a)[0]) if b > a else 0
                         for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist())]
                bounds = np.searchsorted(doc, np.arange(len(t) + 1))
                words = pa.ListArray.from_arrays(bounds.astype(np.int32), K.signed(h))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(least, dtype=np.uint64).view(np.int64)), words], names=["toxic", "copy", "words"])

    sample = texts.mapInArrow(run, "toxic int, copy long, words array<long>").withColumn("row", F.monotonically_increasing_id()).persist()
    try:
        n = sample.count()
        if not n:
            return empty
        copies = sample.groupBy("toxic", "copy").agg(F.count(F.lit(1)).alias("copies"))  # bounded: SAMPLE rows
        each = sample.join(F.broadcast(copies), ["toxic", "copy"]).withColumn("weight", 1 / F.col("copies"))
        about = each.select("row", "toxic", "weight").toArrow()
        row = about["row"].to_numpy()
        order = np.argsort(row)
        row, toxic, weight = row[order], about["toxic"].to_numpy()[order] == 1, about["weight"].to_numpy()[order]
        least_toxic = max(MIN_TOXIC, MIN_SHARE * float(weight[toxic].sum()))
        in_text = each.select("row", "weight", F.when(F.col("toxic") == 1, F.col("weight")).otherwise(0.0).alias("bad"), F.explode("words").alias("w"))
        per_word = (in_text.groupBy("w").agg(F.sum("bad").alias("t"), F.sum("weight").alias("n"))
                    .filter((F.col("t") >= least_toxic - _ROUNDING) & (F.col("t") >= MIN_PRECISION * F.col("n") - _ROUNDING)))
        pairs = in_text.join(F.broadcast(per_word.select("w")), "w").select("row", "w").toArrow()  # bounded: see MIN_SHARE
    finally:
        sample.unpersist()
    at = np.searchsorted(row, pairs["row"].to_numpy())
    words, word = np.unique(pairs["w"].to_numpy(), return_inverse=True)
    order = np.lexsort((at, word))
    at, word = at[order], word[order]
    chosen = [(int(words[k]), rate) for k, rate in _select(at, word, toxic, weight)]
    rest = np.ones(len(toxic), dtype=bool)
    rest[at[np.isin(words[word], [w for w, _ in chosen])]] = False
    base = float((weight * toxic)[rest].sum() / max(weight[rest].sum(), 1e-9)) if rest.any() else float(toxic.mean())
    h = np.array([w for w, _ in chosen], dtype=np.int64).view(np.uint64)
    order = np.argsort(h)
    return Model(cost, h[order], np.array([p for _, p in chosen])[order] if chosen else np.zeros(0), min(base, 0.5))


def _scores(model: Model, texts: K.Texts) -> tuple[np.ndarray, np.ndarray]:
    n = len(texts)
    clean, marks = np.full(n, np.log1p(-model.base)), np.zeros(n, dtype=np.int64)
    if len(model.words):
        h, doc = restored_words(texts, model.cost)
        at = np.minimum(np.searchsorted(model.words, h), len(model.words) - 1)
        hit = model.words[at] == h
        pair = np.unique(doc[hit] * len(model.words) + at[hit])
        which, word = pair // len(model.words), pair % len(model.words)
        clean = clean + np.bincount(which, weights=np.log1p(-model.rates)[word], minlength=n)
        marks = np.bincount(which, minlength=n)
    return -np.expm1(clean), marks


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score double, n_marks long): the chance that the text is toxic, and how many
    different lexicon words its restored text has."""
    def rows(part: pa.RecordBatch):
        return [part.column(0), *map(pa.array, _scores(model, K.texts_of(part.column(1))))]

    return map_texts(docs, id_col, text_col, "score double, n_marks long", rows)


def reject(docs: DataFrame, model: Model, at: float, text_col: str = "text") -> DataFrame:
    """The rows of `docs` (all columns) whose score is below `at`."""
    return keep_texts(docs, text_col, lambda texts: _scores(model, K.texts_of(texts))[0] < at)

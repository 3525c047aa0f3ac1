"""Quality scores by a factorisation machine.

Inputs of a text: hashed words (their share of the text, `DIMS` hashes), and statistics of
its structure and size (`STATS`): shares of capitals, digits, symbols and spaces, word and
line lengths, repetition of words and of whole lines, decorated words, length; and metadata, if
columns are named: each (column, value) is one hashed feature among the words, a number by its
sign and order of magnitude, a null as a value of its own. So words, structure and metadata
all interact. The score is a logistic function of w0 + sum w_i x_i + sum_(i<j) <v_i, v_j> x_i x_j with rank `RANK`
vectors v; the pairwise sum is computed in linear time as half the sum over factors of
(sum v x)^2 - sum (v x)^2.

The model is fitted on a bounded sample of labelled rows (`SAMPLE`); scores cover all rows
and whole texts. Its size is DIMS x (RANK + 1) numbers, whatever the corpus.

Results for edge cases: a null or empty text has zero words and statistics and gets the
score of that point; rows without a label aren't learned from, of an id's differing labels the
more frequent one counts (1 if equally frequent); with no labels every score is 0.5; repeated
rows get their result each time; columns that aren't named are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from . import kernel as K
from .frames import decided, sampled

DIMS, RANK, SAMPLE = 1 << 13, 8, 6_000
EPOCHS, RATE, DECAY, SEED = 12, 0.05, 1e-4, 7
STATS = ("capitals", "digits", "symbols", "spaces", "non_ascii", "word_length", "distinct_words", "repeated_next",
         "decorated", "line_length", "distinct_lines", "separate_symbols", "log_words", "ends_sentence", "long_words")

_UPPER, _DIGIT, _SYMBOL = (np.zeros(256, dtype=bool) for _ in range(3))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_SYMBOL[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_PROSE = np.zeros(256, dtype=bool)
_PROSE[[ord(c) for c in ".,;:'\"()-"]] = True


class Model(NamedTuple):
    """Scaling of the statistics; bias, weights and vectors (words, then statistics)."""

    mean: np.ndarray
    sd: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray


def features(texts: K.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed words (text, hash, value) and statistics, one row a text."""
    size, n = int(texts.offsets[-1]), len(texts)
    data = texts.data[:size]
    words, h = K.terms_of(texts)
    spaced = K.words_of(texts)
    count, doc = np.diff(words.first), words.doc
    chars = np.maximum(np.diff(texts.offsets), 1)
    every = np.maximum(count, 1)
    bucket = (h >> np.uint64(40)).astype(np.int64) % DIMS
    pair, times = np.unique(doc * DIMS + bucket, return_counts=True)
    owner, word = pair // DIMS, pair % DIMS
    share = lambda flags: K.per_text(flags, texts.offsets) / chars
    distinct = np.bincount(np.unique(doc.astype(np.uint64) << np.uint64(40) | h >> np.uint64(24)).astype(np.int64) >> 40, minlength=n) if len(h) else np.zeros(n)
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    length = (words.end - words.start).astype(np.float64)
    # Tokens that end in a symbol that isn't prose, and tokens that are one symbol.
    last = data[spaced.end - 1] if len(spaced.end) else np.zeros(0, dtype=np.uint8)
    odd = _SYMBOL[last] & ~_PROSE[last]
    tokens = np.maximum(np.diff(spaced.first), 1)
    lone = (spaced.end - spaced.start == 1) & _SYMBOL[last]
    dot = last == ord(".")
    # Lines.
    breaks = np.zeros(256, dtype=bool)
    breaks[10] = True
    lines = K.words_of(texts, breaks)
    n_lines = np.maximum(np.diff(lines.first), 1)
    line_hash = K.span_hash(texts.data, lines.start, lines.end)
    line_doc = lines.doc
    new_lines = np.bincount(np.unique(line_doc.astype(np.uint64) << np.uint64(40) | line_hash >> np.uint64(24)).astype(np.int64) >> 40, minlength=n) if len(line_hash) else np.zeros(n)
    stats = np.column_stack((
        share(_UPPER[data]), share(_DIGIT[data]), share(_SYMBOL[data]), share(data == 32), share(data >= 128),
        K.per_text(length, words.first) / every, distinct[:n] / every, K.per_text(again, words.first) / every,
        K.per_text(odd, spaced.first) / tokens, np.log1p(chars / n_lines), new_lines[:n] / n_lines, K.per_text(lone, spaced.first) / tokens,
        np.log1p(count), K.per_text(dot, spaced.first) / tokens, K.per_text(length > 20, words.first) / every))
    stats[count == 0] = 0
    return owner, word, times / every[owner], stats


def _hashed_metadata(docs: DataFrame, columns: Sequence[str]) -> Column:
    """array<int>: the feature of each named column's value."""
    def value(c: str) -> Column:
        if not isinstance(docs.schema[c].dataType, NumericType):
            return docs[c].cast("string")
        x = docs[c].cast("double")
        return F.concat(F.signum(x).cast("int").cast("string"), F.lit(":"), F.floor(F.log2(1 + F.abs(x))).cast("string"))

    each = [F.pmod(F.xxhash64(F.lit(f"metadata {c}"), value(c)), F.lit(DIMS)).cast("int") for c in columns]
    return F.array(*each) if each else F.array().cast("array<int>")


def _texts(docs: DataFrame, id_col: str, text_col: str, metadata: Sequence[str]) -> DataFrame:
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"), _hashed_metadata(docs, metadata).alias("metadata"))


def _inputs(text: pa.Array, metadata: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """`features` with those of the metadata among the words."""
    doc, word, value, stats = features(K.texts_of(text))
    more = np.asarray(metadata.flatten(), dtype=np.int64)
    owner = np.repeat(np.arange(len(metadata)), len(more) // max(len(metadata), 1))
    doc = np.concatenate((doc, owner))
    order = np.argsort(doc, kind="stable")
    return doc[order], np.concatenate((word, more))[order], np.concatenate((value, np.ones(len(more))))[order], stats


def _sums(x_doc, x_word, x_value, n: int, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text and factor: the sum of v x, and of its squares."""
    each = v[x_word] * x_value[:, None]
    bounds = np.searchsorted(x_doc, np.arange(n + 1))
    one, two = (np.vstack((np.zeros((1, each.shape[1])), np.cumsum(e, axis=0))) for e in (each, each * each))
    return one[bounds[1:]] - one[bounds[:-1]], two[bounds[1:]] - two[bounds[:-1]]


def _logits(model: Model, doc, word, value, stats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits, factor sums and scaled statistics of some texts."""
    n = len(stats)
    z = np.clip((stats - model.mean) / model.sd, -4, 4)
    one, two = _sums(doc, word, value, n, model.v[:DIMS])
    s = model.v[DIMS:]
    one, two = one + z @ s, two + (z * z) @ (s * s)
    linear = np.bincount(doc, weights=model.w[word] * value, minlength=n) + z @ model.w[DIMS:]
    return model.w0 + linear + 0.5 * (one * one - two).sum(axis=1), one, z


def train(doc: np.ndarray, word: np.ndarray, value: np.ndarray, stats: np.ndarray, label: np.ndarray) -> Model:
    """Fit by Adagrad on mini-batches; the order of rows is fixed by the seed."""
    rng = np.random.default_rng(SEED)
    n, size = len(label), DIMS + stats.shape[1]
    mean, sd = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-6)
    w, v, w0 = np.zeros(size), rng.normal(0, 0.02, (size, RANK)), float(np.log((label.mean() + 1e-3) / (1 - label.mean() + 1e-3)))
    gw, gv, g0 = np.full(size, 1e-3), np.full((size, RANK), 1e-3), 1e-3
    bounds = np.searchsorted(doc, np.arange(n + 1))
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, 256):
            rows = order[at:at + 256]
            m = len(rows)
            length = bounds[rows + 1] - bounds[rows]
            take = K.gather(np.arange(len(doc)), bounds[rows], length)
            d, x, k = np.repeat(np.arange(m), length), value[take], word[take]
            y, one, z = _logits(Model(mean, sd, w0, w, v), d, k, x, stats[rows])
            error = (1 / (1 + np.exp(-np.clip(y, -30, 30))) - label[rows]) / m
            dw = np.concatenate((np.bincount(k, weights=error[d] * x, minlength=DIMS), error @ z)) + DECAY * w
            each = error[d, None] * x[:, None] * (one[d] - v[k] * x[:, None])
            dv = np.zeros_like(v)
            for f in range(RANK):
                dv[:DIMS, f] = np.bincount(k, weights=each[:, f], minlength=DIMS)
            dv[DIMS:] = z.T @ (error[:, None] * one) - ((z * z).T @ error)[:, None] * v[DIMS:]
            dv += DECAY * v
            gw += dw * dw
            gv += dv * dv
            g0 += error.sum() ** 2
            w -= RATE * dw / np.sqrt(gw)
            v -= RATE * dv / np.sqrt(gv)
            w0 -= RATE * error.sum() / np.sqrt(g0)
    return Model(mean, sd, w0, w, v)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        metadata: Sequence[str] = ()) -> Model | None:
    rows = decided(labels, id_col, label_col, "label")
    rows = sampled(rows, "id", SAMPLE)
    texts = (_texts(docs, id_col, text_col, metadata)
             .join(F.broadcast(rows), "id").select("id", "label", "text", "metadata"))  # bounded: SAMPLE rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch):
                doc, word, value, stats = _inputs(part.column(2), part.column(3))
                at = np.searchsorted(doc, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1),
                    pa.array([word[a:b].astype(np.int32).tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                    pa.array([value[a:b].astype(np.float32).tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                    pa.array([s.tobytes() for s in stats], pa.binary())], names=["id", "label", "word", "value", "stats"])

    def learn(table: pa.Table) -> pa.Table:
        """The sample, in one task: at most about SAMPLE rows of DIMS hashes."""
        table = table.sort_by([("id", "ascending"), ("stats", "ascending")])
        word = [np.frombuffer(x, dtype=np.int32) for x in table.column("word").to_pylist()]
        value = [np.frombuffer(x, dtype=np.float32) for x in table.column("value").to_pylist()]
        stats = np.frombuffer(b"".join(table.column("stats").to_pylist())).reshape(-1, len(STATS))
        doc = np.repeat(np.arange(len(word)), [len(x) for x in word])
        m = train(doc, np.concatenate(word).astype(np.int64), np.concatenate(value).astype(np.float64), stats, table.column("label").to_numpy().astype(np.float64))
        parts = [m.mean, m.sd, np.array([m.w0]), m.w, m.v.ravel()]
        return pa.table({"model": [np.concatenate(parts).tobytes()]})

    kind = rows.schema["id"].dataType.simpleString()
    made = (texts.mapInArrow(run, f"id {kind}, label int, word binary, value binary, stats binary")
            .withColumn("one", F.lit(1)).groupBy("one").applyInArrow(learn, "model binary").collect())
    if not made:
        return None
    flat, s = np.frombuffer(bytes(made[0]["model"])), len(STATS)
    size = DIMS + s
    return Model(flat[:s], flat[s:2 * s], float(flat[2 * s]), flat[2 * s + 1:2 * s + 1 + size], flat[2 * s + 1 + size:].reshape(size, RANK))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", metadata: Sequence[str] = ()) -> DataFrame:
    """(id, score double): the chance that the label is 1. `metadata` as in `fit`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch):
                made = np.full(part.num_rows, 0.5)
                if model is not None:
                    y, _, _ = _logits(model, *_inputs(part.column(1), part.column(2)))
                    made = 1 / (1 + np.exp(-np.clip(y, -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made)], names=["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _texts(docs, id_col, text_col, metadata).mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)

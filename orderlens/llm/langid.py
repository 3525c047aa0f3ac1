"""Language identification by nearest centroid.

A text is a vector of hashed byte trigrams (letters in lower case, each run of
other ASCII as one separator), weighted by TF-IDF and scaled to length 1. Each language has several
centroids: spherical k-means on a bounded sample of its labelled texts finds the clusters,
and one pass over every labelled text assigns it to the nearest cluster of its language
and averages the clusters anew. A text gets the language of the nearest centroid by
cosine; it is rejected when its distance is far outside the distances that the texts of
that centroid had in training (`REJECT_SIGMAS` standard deviations beyond the mean).

Statistics (document frequencies, centroids, distances) cover all training rows; the only
sample is the k-means start: `SAMPLE_PER_LANG` different texts a language. The model is
languages x CLUSTERS x DIMS numbers, whatever the size of the corpus.

Results for edge cases: a null text, or one without a letter, is `und` with score 0; rows
with a null language or text are not learned from; a repeated row gets its result each
time; with no training rows every text is `und`; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import kernel as K
from .frames import map_texts

DIMS = 2048
CLUSTERS = 4
SAMPLE_PER_LANG = 400
REJECT_SIGMAS = 6.0
UNDETERMINED = "und"
_ROWS = 1024  # texts with a dense vector at once
_BYTES = 2 << 20  # of text at once: sums and products in single precision are rounded once a chunk

_FOLD = np.full(256, ord(" "), dtype=np.uint32)
_FOLD[range(ord("a"), ord("z") + 1)] = range(ord("a"), ord("z") + 1)
_FOLD[range(ord("A"), ord("Z") + 1)] = range(ord("a"), ord("z") + 1)
_FOLD[128:] = range(128, 256)


class Model(NamedTuple):
    """Inverse document frequencies; unit centroids; each one's language, and the mean and
    deviation of its texts' cosine."""

    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    mean: np.ndarray
    sd: np.ndarray


def counts(texts: K.Texts) -> np.ndarray:
    """Trigram counts, one row of DIMS a text."""
    n, size = len(texts), int(texts.offsets[-1])
    if size < 3:
        return np.zeros((n, DIMS), dtype=np.float32)
    b = _FOLD[texts.data[:size]]
    doc = np.repeat(np.arange(n, dtype=np.int64) * DIMS, np.diff(texts.offsets))
    keep = np.ones(size, dtype=bool)  # a run of separators is one
    keep[1:] = (b[1:] != 32) | (b[:-1] != 32)
    keep[texts.offsets[:-1][np.diff(texts.offsets) > 0]] = True  # whatever the text before ends with
    b, doc = b[keep], doc[keep]
    code = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761) >> np.uint32(32 - 11)
    inside = doc[:-2] == doc[2:]
    flat = np.bincount((doc[:-2] + code)[inside], minlength=n * DIMS)
    return flat.reshape(n, DIMS).astype(np.float32)


def vectors(texts: K.Texts, idf: np.ndarray) -> np.ndarray:
    v = counts(texts) * idf
    length = np.sqrt(np.einsum("ij,ij->i", v, v))
    return v / np.where(length > 0, length, 1)[:, None]


def has_letter(texts: K.Texts) -> np.ndarray:
    code, at = K.codes_of(texts)
    letter = K.code_classes()[code] == K.LETTER
    return K.per_text(letter, np.searchsorted(at, texts.offsets)) > 0


def _document_frequency(train: DataFrame) -> tuple[int, np.ndarray]:
    """Number of training texts, and of those with each trigram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMS, dtype=np.int64), 0
        for batch in batches:
            for part in K.chunks(batch, limit=_BYTES, rows=_ROWS):
                total += (counts(K.texts_of(part.column(0))) > 0).sum(axis=0)
                n += part.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, DIMS), pa.int32()), pa.array([n, *total.tolist()], pa.int64())], names=["dim", "n"])

    rows = train.select("text").mapInArrow(run, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()
    found = {r["dim"]: r["n"] for r in rows}
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(DIMS)], dtype=np.float64)


def _clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from spread starts (each the row least like those before it)."""
    k = min(k, len(x))
    chosen = [0]
    near = x @ x[0]
    while len(chosen) < k:
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    c = x[chosen].copy()
    for _ in range(rounds):
        at = np.argmax(x @ c.T, axis=1)
        for j in range(k):
            if (at == j).any():
                m = x[at == j].sum(axis=0)
                c[j] = m / max(np.linalg.norm(m), 1e-12)
    return c


def _sample(train: DataFrame) -> DataFrame:
    """About SAMPLE_PER_LANG different texts of each language (all, if there are fewer),
    chosen by a hash of the text: copies come together, so they count once."""
    texts = train.select("lang", "text", F.xxhash64("text").alias("h"))
    sizes = {r["lang"]: r["n"] for r in texts.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    grain = 1_000_000
    share = F.coalesce(*[F.when(F.col("lang") == g, F.lit(int(grain * min(1.0, SAMPLE_PER_LANG / max(n, 1))) + 1)) for g, n in sizes.items()], F.lit(0))
    return texts.filter(F.pmod("h", F.lit(grain)) < share).dropDuplicates(["lang", "h"]).select("lang", "text")


def _starts(train: DataFrame, idf: np.ndarray) -> dict[str, np.ndarray]:
    """k-means of a bounded sample of each language: one small group a language."""
    sample = _sample(train)

    def vector_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, "text", limit=_BYTES, rows=_ROWS):
                v = vectors(K.texts_of(part.column(1)), idf).astype(np.float32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.tobytes() for x in v], pa.binary())], names=["lang", "v"])

    def fit(table: pa.Table) -> pa.Table:
        x = np.frombuffer(b"".join(table.column("v").to_pylist()), dtype=np.float32).reshape(-1, DIMS)
        x = x[np.lexsort(x.T[:8])]  # the order of rows in a group isn't fixed
        c = _clusters(x, CLUSTERS)
        return pa.table({"lang": table.column("lang").to_pylist()[:1] * len(c), "c": [r.astype(np.float32).tobytes() for r in c]})

    rows = (sample.select("lang", "text").mapInArrow(vector_rows, "lang string, v binary")
            .groupBy("lang").applyInArrow(fit, "lang string, c binary").collect())
    out: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], bytes(r["c"]))):
        out.setdefault(r["lang"], []).append(np.frombuffer(bytes(r["c"]), dtype=np.float32))
    return {g: np.stack(c) for g, c in out.items()}


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", where: Column | None = None) -> Model | None:
    """Learn from the rows of `docs` that `where` keeps (None if there are none)."""
    if where is not None:
        docs = docs.filter(where)
    train = (docs.select(docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang"))
             .filter("text IS NOT NULL AND lang IS NOT NULL AND text != ''"))
    n, df = _document_frequency(train)
    if not n:
        return None
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    starts = _starts(train, idf)
    langs = [g for g in sorted(starts) for _ in starts[g]]
    c0 = np.concatenate([starts[g] for g in sorted(starts)])
    own = {g: np.flatnonzero(np.array(langs) == g) for g in starts}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(c0), DIMS + 3))  # sums, then texts, cosines and their squares
        for batch in batches:
            for part in K.chunks(batch, "text", limit=_BYTES, rows=_ROWS):
                v = vectors(K.texts_of(part.column(1)), idf)
                cos = v @ c0.T
                lang = np.array(part.column(0).to_pylist(), dtype=object)
                for g, mine in own.items():
                    rows = np.flatnonzero(lang == g)
                    if len(rows):
                        at = np.argmax(cos[np.ix_(rows, mine)], axis=1)
                        for j, c in enumerate(mine):
                            r = rows[at == j]
                            s = cos[r, c].astype(np.float64)
                            total[c, :DIMS] += v[r].sum(axis=0)
                            total[c, DIMS:] += len(r), s.sum(), (s * s).sum()
        at, dim = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(dim.astype(np.int32)), pa.array(total[at, dim])], names=["c", "dim", "s"])

    total = np.zeros((len(c0), DIMS + 3))
    for r in train.select("lang", "text").mapInArrow(run, "c int, dim int, s double").groupBy("c", "dim").agg(F.sum("s").alias("s")).collect():
        total[r["c"], r["dim"]] = r["s"]
    size = np.maximum(total[:, DIMS], 1)
    length = np.linalg.norm(total[:, :DIMS], axis=1)
    centroids = np.where(length[:, None] > 0, total[:, :DIMS] / np.where(length > 0, length, 1)[:, None], c0)
    mean = total[:, DIMS + 1] / size
    sd = np.sqrt(np.maximum(total[:, DIMS + 2] / size - mean * mean, 0))
    # The language with most texts first: it wins ties, such as a text with no trigram.
    of_lang = np.array([size[own[g]].sum() for g in langs])
    order = np.argsort(-of_lang, kind="stable")
    return Model(idf, centroids[order].astype(np.float32), [langs[i] for i in order], mean[order], sd[order])


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected): the nearest centroid's language, its cosine, and
    whether the distance is outside what training texts had (a reader that wants rejection
    by distance takes `und` for those rows). `und`: null text or no letter."""
    def rows(part: pa.RecordBatch):
        texts = K.texts_of(part.column(1))
        n = len(texts)
        if model is None:
            return [part.column(0), pa.array([UNDETERMINED] * n, pa.string()), pa.array(np.zeros(n)), pa.array(np.ones(n, dtype=bool))]
        cos = vectors(texts, model.idf) @ model.centroids.T
        at = np.argmax(cos, axis=1) if n else np.zeros(0, dtype=np.int64)
        best = np.clip(cos[np.arange(n), at], 0, 1).astype(np.float64)
        known = has_letter(texts)
        lang = np.array([*model.langs, UNDETERMINED], dtype=object)[np.where(known, at, len(model.langs))]
        far = best < model.mean[at] - REJECT_SIGMAS * np.maximum(model.sd[at], 0.01)
        return [part.column(0), pa.array(lang.tolist(), pa.string()), pa.array(np.where(known, best, 0.0)), pa.array(far | ~known)]

    return map_texts(docs, id_col, text_col, "lang_pred string, score double, rejected boolean", rows, limit=_BYTES, max_rows=_ROWS)

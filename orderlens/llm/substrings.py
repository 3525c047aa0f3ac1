"""Removal of repeated word spans over a token de Bruijn graph.

Words: `[^\\x20\\x09-\\x0D]+`, unchanged. An edge of the graph is a window of `WINDOW` = 20
consecutive words of one document. Edges are not handled one by one:

1. Paths. Neighbouring windows that share one least 4-word hash (their minimizer) make a
   path of up to 17 edges; equal windows always have equal minimizers. A path is
   (minimizer, hash of its whole word sequence, document).
2. Joins. Minimizers that occur in one document only have no repeated edge and go. Paths
   that remain are aggregated by (minimizer, content): where a minimizer has one content,
   the path doesn't branch and is compacted: the document with the least id has its first
   occurrence, and all others repeat it as a whole. A path that isn't its content's first
   occurrence is removed as a whole, branching or not.
3. Branching. Only for first occurrences at minimizers with several contents are single
   edges compared, again by an aggregate and a join on (minimizer, edge).
4. Source coordinates. Each document's removed paths and edges are found again in its whole
   text, word by word; repeats inside the document are found there too, and the words that
   a removed window covers go.

No step collects a minimizer's occurrences; a passage that a third of all documents share
is combined before it is shuffled. Its join rows meet in one task: adaptive execution doesn't
split a join whose stage also aggregates by the key.
Equality is by 64-bit hashes of the edge together with its minimizer (128 bits).

Results for edge cases: null or empty text: no words, the digest of the empty text;
documents of fewer than 20 words lose nothing; rows that share an id are judged by
themselves and against other ids, not against each other; a null id is judged by itself only; an
empty table gives none; other columns are ignored; texts are whole, however long.
"""
from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from . import kernel as K
from .frames import stored

WINDOW, SEED = 20, 4
_SPAN = WINDOW - SEED + 1  # seeds in a window


class Paths(NamedTuple):
    """Windows by their first word, and the paths that they make: path i is the windows
    first[i] .. first[i] + size[i] - 1."""

    words: K.Words
    edge: np.ndarray
    inside: np.ndarray
    first: np.ndarray
    size: np.ndarray
    minimizer: np.ndarray
    content: np.ndarray
    doc: np.ndarray


def paths_of(texts: K.Texts) -> Paths:
    words = K.words_of(texts)
    h = K.span_hash(texts.data, words.start, words.end)
    doc, n = words.doc, len(h) - WINDOW + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return Paths(words, none.view(np.uint64), none.astype(bool), none, none, none.view(np.uint64), none.view(np.uint64), none)
    edge = K.run_hash(h, WINDOW, seed=11)
    inside = doc[:n] == doc[WINDOW - 1:]
    # Least seed of each window, the leftmost if there are several: by doubling.
    value = K.run_hash(h, SEED, seed=5)
    place = np.arange(len(value))
    span = 1

    def joined(step: int) -> tuple[np.ndarray, np.ndarray]:
        left, right = value[:-step], value[step:]
        later = right < left
        return np.where(later, right, left), np.where(later, place[step:], place[:-step])

    while span * 2 <= _SPAN:
        value, place = joined(span)
        span *= 2
    if span < _SPAN:
        value, place = joined(_SPAN - span)
    new = np.ones(n + 1, dtype=bool)
    new[1:n] = (place[1:n] != place[:n - 1]) | (inside[1:] != inside[:-1]) | (doc[1:n] != doc[:n - 1])
    bounds = np.flatnonzero(new)
    good = inside[bounds[:-1]]
    first, size = bounds[:-1][good], np.diff(bounds)[good]
    last = first + size - 1
    content = K.mix(K.mix(edge[first]) + edge[last] * np.uint64(0x9E3779B97F4A7C15) + size.astype(np.uint64))
    return Paths(words, edge, inside, first, size, value[first], content, doc[first])


def _each_chunk(rows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch):
                yield rows(part)

    return run


def _once(*columns: np.ndarray) -> np.ndarray:
    """Places of the distinct rows."""
    order = np.lexsort(columns)
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
    return order[new]


def _path_rows(docs: DataFrame, kind: str, contents: bool) -> DataFrame:
    """Distinct (m, id) or (m, c, id) of each document."""
    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        p = paths_of(K.texts_of(part.column(1)))
        keep = _once(p.minimizer, p.doc, p.content) if contents else _once(p.minimizer, p.doc)
        ids = part.column(0).take(pa.array(p.doc[keep]))
        hashes = [pa.array(K.signed(x[keep])) for x in ((p.minimizer, p.content) if contents else (p.minimizer,))]
        return pa.RecordBatch.from_arrays([*hashes, ids], names=["m", "c", "id"] if contents else ["m", "id"])

    return docs.mapInArrow(_each_chunk(rows), f"m long, c long, id {kind}" if contents else f"m long, id {kind}")


def _listed(part: pa.RecordBatch, column: int, docs: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which (document, key) are in the lists of the part's column."""
    lists = part.column(column)
    sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0), dtype=np.int64)
    flat = np.asarray(pa.compute.list_flatten(lists), dtype=np.int64).view(np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    salt = K.mix(np.arange(len(sizes), dtype=np.uint64) + np.uint64(1))
    return np.isin(keys ^ salt[docs], flat ^ salt[owner])


def repeats(docs: DataFrame, kind: str) -> DataFrame:
    """(id, paths array<long>, edges array<long>): contents of paths and hashes of single
    edges of a document that occur in a document with a smaller id. `docs`: id, text."""
    known = docs.filter("id IS NOT NULL")
    spread = (_path_rows(known, kind, False).groupBy("m").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("m"))
    shared = stored(_path_rows(known, kind, True).join(spread, "m"), "sub-paths")
    units = stored(shared.groupBy("m", "c").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "sub-units")
    later = shared.join(units.filter("n > 1").select("m", "c", "least"), ["m", "c"]).filter("id > least").select("id", F.col("c").alias("path"))
    branching = units.groupBy("m").agg(F.count(F.lit(1)).alias("ways")).filter("ways > 1").select("m")
    firsts = (units.join(branching, "m").groupBy(F.col("least").alias("id")).agg(F.collect_set("c").alias("paths")))

    def edge_rows(part: pa.RecordBatch) -> pa.RecordBatch:
        p = paths_of(K.texts_of(part.column(1)))
        some = _listed(part, 2, p.doc, p.content)
        first, size = p.first[some], p.size[some]
        at = K.gather(np.arange(len(p.edge)), first, size)
        m, doc, e = np.repeat(p.minimizer[some], size), np.repeat(p.doc[some], size), p.edge[at]
        keep = _once(e, m, doc)
        return pa.RecordBatch.from_arrays([pa.array(K.signed(m[keep])), pa.array(K.signed(e[keep])), part.column(0).take(pa.array(doc[keep]))], names=["m", "e", "id"])

    edges = stored(known.join(firsts, "id").select("id", "text", "paths").mapInArrow(_each_chunk(edge_rows), f"m long, e long, id {kind}"), "sub-edges")
    least = edges.groupBy("m", "e").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").select("m", "e", "least")
    again = edges.join(least, ["m", "e"]).filter("id > least").select("id", F.col("e").alias("edge"))
    found = later.select("id", "path", F.lit(None).cast("long").alias("edge")).union(again.select("id", F.lit(None).cast("long"), "edge"))
    return found.groupBy("id").agg(F.collect_set("path").alias("paths"), F.collect_set("edge").alias("edges"))


def _removed(p: Paths, part: pa.RecordBatch) -> np.ndarray:
    """Which words a repeated window covers."""
    gone = np.zeros(len(p.edge), dtype=bool)
    if len(gone):
        whole = _listed(part, 2, p.doc, p.content)
        gone[K.gather(np.arange(len(gone)), p.first[whole], p.size[whole])] = True
        doc = p.words.doc[:len(gone)]
        gone |= _listed(part, 3, doc, p.edge) & p.inside
        at = np.flatnonzero(p.inside)
        order = at[np.lexsort((at, p.edge[at], doc[at]))]  # repeats inside a document
        same = (p.edge[order][1:] == p.edge[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        gone[order[1:][same]] = True
    cover = np.zeros(len(p.words.start) + 1, dtype=np.int64)
    starts = np.flatnonzero(gone)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + WINDOW, -1)
    return np.cumsum(cover)[:-1] > 0


def _kept(texts: K.Texts, words: K.Words, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kept words joined by one space: bytes and bounds; words and removed words a text."""
    keep = ~gone
    start, size = words.start[keep], (words.end - words.start)[keep] + 1
    flat = K.gather(texts.data, start, size)
    upto = np.concatenate(([0], np.cumsum(size)))
    flat[upto[1:] - 1] = 0x20
    n_words, n_gone = np.diff(words.first), K.per_text(gone, words.first)
    at = upto[np.concatenate(([0], np.cumsum(n_words - n_gone)))]
    return flat, at, n_words, n_gone


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs`, all columns, with each text replaced by its kept words joined by one space,
    or as it is if nothing is removed (a null text stays null)."""
    kind = docs.schema[id_col].dataType.simpleString()
    row = F.struct(*[docs[c] for c in docs.columns if c != text_col]).alias("row")
    wide = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"), row)

    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = K.texts_of(part.column(1))
        p = paths_of(texts)
        flat, at, _, lost = _kept(texts, p.words, _removed(p, part))
        old = part.column(1).to_pylist()
        new = [flat[at[i]:max(at[i], at[i + 1] - 1)].tobytes().decode() if lost[i] else old[i] for i in range(len(old))]
        return pa.RecordBatch.from_arrays([pa.array(new, pa.string()), part.column(4)], names=["text", "row"])

    joined = wide.join(repeats(wide.select("id", "text"), kind), "id", "left").select("id", "text", "paths", "edges", "row")
    out = joined.mapInArrow(_each_chunk(rows), joined.select("text", "row").schema)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of each row: the same removal, with the digest
    of the kept words joined by one space."""
    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = K.texts_of(part.column(1))
        p = paths_of(texts)
        flat, at, n, lost = _kept(texts, p.words, _removed(p, part))
        plain = memoryview(flat)
        sha = [sha256(plain[at[i]:max(at[i], at[i + 1] - 1)]).hexdigest() for i in range(len(n))]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(n.astype(np.int64)), pa.array(lost.astype(np.int64)), pa.array(sha, pa.string())],
                                          names=["id", "n_words", "n_removed", "kept_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    joined = docs.join(repeats(docs, kind), "id", "left").select("id", "text", "paths", "edges")
    return (joined.mapInArrow(_each_chunk(rows), f"id {kind}, n_words long, n_removed long, kept_sha256 string")
            .withColumnRenamed("id", id_col))

"""Near-duplicate embeddings by random-hyperplane sign hashing.

Vectors are compared only when labels (and lengths) are equal: linked when the cosine in
double precision is at least `COSINE`. Equal vectors with equal labels are one class,
represented by the least id and its number of rows, so copies are never paired.

The signs of a vector against `bits` random planes are its code in one table; a pair at the
threshold agrees in one table with probability (1 - angle/pi)^bits, and the number of tables
makes the chance to meet in none `MISS` or less. Bits follow from the number of classes
(about one class a bucket), so buckets stay small as data grow. A bucket is compared inside a task, in
blocks of `BLOCK` members (a large bucket is all pairs of its blocks, so nothing is capped);
a pair counts only in the first table in which it meets. Tasks give link counts and
links that span their components, not pairs; components come from joins.

Results for edge cases: a vector that is null, empty, zero or holds a null or non-finite
value, or has a null label or id, has no links and is its own component; repeated rows count as
vectors of their own (one result row each); an empty table gives none; other columns are
ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import kernel as K
from .frames import stored
from .graph import components

COSINE, MISS, SEED = 0.93, 1e-3, 20240101
BLOCK = 512


def tables_for(classes: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for so many classes."""
    bits = min(max(math.ceil(math.log2(max(classes, 2))), 6), 24)
    met = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-met))


def _planes(dims: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng(SEED + dims).standard_normal((dims, bits * tables))


def _codes(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """`classes` with codes array<long>: the sign code in each table."""
    weights = np.int64(1) << np.arange(bits, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                v = part.column(1)
                size = np.asarray(pa.compute.list_value_length(v), dtype=np.int64)
                flat = np.asarray(pa.compute.list_flatten(v), dtype=np.float64)
                begin = np.cumsum(size) - size
                codes = np.zeros((len(size), tables), dtype=np.int64)
                for dims in np.unique(size):
                    rows = np.flatnonzero(size == dims)
                    x = K.gather(flat, begin[rows], size[rows]).reshape(-1, dims)
                    signs = x @ _planes(int(dims), bits, tables) >= 0
                    codes[rows] = signs.reshape(len(rows), tables, bits) @ weights
                yield pa.RecordBatch.from_arrays([part.column(0), pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), tables).cast(pa.list_(pa.int64()))], names=["rep", "codes"])

    kind = classes.schema["rep"].dataType.simpleString()
    return classes.select("rep", "v").mapInArrow(run, f"rep {kind}, codes array<long>")


def _compare(cosine: float):
    def run(group: pa.Table) -> pa.Table:
        """Link counts and spanning links of one bucket, or of two blocks of it."""
        rep, side = group.column("rep"), group.column("side").to_numpy()
        copies, table = group.column("copies").to_numpy(), group.column("t")[0].as_py()
        x = np.asarray(pa.compute.list_flatten(group.column("v").combine_chunks()), dtype=np.float64).reshape(group.num_rows, -1)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        codes = np.asarray(pa.compute.list_flatten(group.column("codes").combine_chunks()), dtype=np.int64).reshape(group.num_rows, -1)
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        p, q = np.nonzero(x[left] @ x[right].T >= cosine)
        a, b = left[p], right[q]
        if (side == 2).any():  # one block with itself: each pair once
            a, b = a[a < b], b[a < b]
        links = np.zeros(group.num_rows, dtype=np.int64)
        root = np.arange(group.num_rows)
        out: list[tuple[int, int]] = []
        if len(a):
            fresh = ~(codes[a, :table] == codes[b, :table]).any(axis=1)
            np.add.at(links, a[fresh], copies[b[fresh]])
            np.add.at(links, b[fresh], copies[a[fresh]])

            def find(k: int) -> int:
                while root[k] != k:
                    root[k] = k = root[root[k]]
                return k

            for i, j in zip(a.tolist(), b.tolist()):
                u, w = find(i), find(j)
                if u != w:
                    root[u] = w
                    out.append((i, j))
        some = np.flatnonzero(links)
        i = pa.array(np.r_[some, [k for k, _ in out]].astype(np.int64))
        other = pa.concat_arrays([pa.nulls(len(some), rep.type), rep.combine_chunks().take(pa.array([k for _, k in out], pa.int64()))])
        n = np.r_[links[some], np.zeros(len(out), dtype=np.int64)]
        return pa.table({"rep": rep.take(i), "other": other, "n": pa.array(n)})

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    cosine: float = COSINE, miss: float = MISS) -> DataFrame:
    """(id, n_links long, component_id, kept boolean) of each row."""
    rows = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].cast("array<double>").alias("v"), vectors[label_col].alias("label"))
    good = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
            & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("v", lambda e: e != 0))
    # Adding 0.0 makes -0.0 and 0.0 one value of the grouping key.
    known = rows.filter(good).withColumn("v", F.transform("v", lambda e: e + F.lit(0.0)))
    classes = stored(known.groupBy("label", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
                     .withColumn("key", F.monotonically_increasing_id()), "emb-classes")
    bits, tables = tables_for(classes.count(), cosine, miss)
    unit = classes.select("key", "label", F.size("v").alias("dims"), "v", "copies").withColumnRenamed("key", "rep")
    coded = stored(unit.join(_codes(unit, bits, tables), "rep"), "emb-codes")
    held = coded.select("rep", "label", "dims", F.posexplode("codes").alias("t", "code"))
    held = held.select("rep", "t", F.struct("label", "dims", "t", "code").alias("bucket"))
    sizes = held.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    held = held.join(sizes, "bucket").select("rep", "t", "bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    held = held.withColumn("mine", F.pmod(F.xxhash64("rep", "t"), "blocks").cast("int"))
    # Block i meets blocks i..last as the left side, and the earlier ones as the right side.
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
        F.least(k, F.col("mine")).alias("i"), F.greatest(k, F.col("mine")).alias("j"),
        F.when(k == F.col("mine"), 2).when(k > F.col("mine"), 0).otherwise(1).alias("side")))
    held = held.select("rep", "t", "bucket", F.explode(pairs).alias("p"))
    met = (held.join(coded.select("rep", "v", "codes", "copies"), "rep")
           .select("bucket", "t", "p.i", "p.j", "p.side", "rep", "v", "codes", "copies")
           .groupBy("bucket", "i", "j").applyInArrow(_compare(cosine), "rep long, other long, n long"))
    met = stored(met, "emb-links")
    names = classes.select(F.col("key"), F.col("rep"))
    counts = met.groupBy("rep").agg(F.sum("n").alias("n")).withColumnRenamed("rep", "key")
    spans = met.filter("other IS NOT NULL").select("rep", "other")
    named = (spans.join(names.select(F.col("key").alias("rep"), F.col("rep").alias("a")), "rep")
             .join(names.select(F.col("key").alias("other"), F.col("rep").alias("b")), "other").select("a", "b"))
    component = components(named).withColumnRenamed("node", "rep")
    result = (classes.join(counts, "key", "left").join(component, "rep", "left")
              .select("label", "v", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    alone = rows.filter(~F.coalesce(good, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = known.join(result, ["label", "v"]).select("id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))).withColumnRenamed("id", id_col)

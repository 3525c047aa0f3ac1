"""Near-duplicate documents by bottom-k sketches.

Words: `[^\\x20\\x09-\\x0D]+` after A-Z become lower case. A document's set is its distinct
shingles of five words (fewer words: the whole sequence as one). Two documents are linked
when 100 * |A and B| >= 75 * |A or B|.

1. One hash function orders all shingles; a document's sketch is its K least values.
   Documents with equal sets (equal size and 128-bit set fingerprint) are one class with
   its least id as representative: copies are never paired.
2. Inverted lists of retained values. Similar sets share most of the K least values of
   their union, each of which is in both sketches: `MIN_SHARED` = 28 of 64 or more, except
   with a chance of about 1e-8 at the threshold itself. So a document needs to appear only
   in the lists of its K - 28 + 1 rarest values (values in no other sketch count as the
   rarest): two similar documents still meet in one list, and values of a passage that
   half the corpus shares make no list for documents of which it is a smaller part.
3. Overlaps. A long list isn't paired with itself. Round one compares each member with the
   list's least member and with its neighbour in a random order; the estimate on the
   union sketch filters and the full sets verify; the links give components. Round two
   compares only members of one list that are in different components by then: those of
   short lists (`SHORT` members) pair by pair as in round one; those of long lists in
   blocks of bounded size, each pair of blocks that share a list once, where one matrix
   product over the full sets gives all overlaps inside the task and only links come out.
   Pairs of blocks within one component are left out. So no list emits all its pairs, and
   no link between components is missed.
4. Verification builds the full sets of only those documents that a surviving pair names.

Results for edge cases: no words, empty or null text: no shingles and linked with nothing;
rows that share an id are one document (one row each, one component; linked if any of
their texts is); a null id is linked with nothing and gets a null component and kept =
true; an empty table gives none; other columns are ignored; texts are whole, however long.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import kernel as K
from .frames import map_texts, stored
from .graph import components

WORDS, SKETCH, MIN_SHARED = 5, 64, 28
SAME, OF = 75, 100  # similarity of at least SAME / OF
_BLOCK = 512  # members of a list that are put in a random order together
SHORT = 64  # members of a list that may be paired one by one
#: Members, and shingles of all members, of a block that is compared within a task.
BLOCK_ROWS, BLOCK_SHINGLES = 256, 1_000_000
_SLAB = 4096  # shingles in one matrix product


def shingle_sets(texts: K.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text (signed, ascending) and their bounds."""
    low = K.lowered(texts)
    words = K.words_of(low)
    h = K.span_hash(low.data, words.start, words.end)
    n = np.diff(words.first)
    five, doc = K.run_hash(h, WORDS), words.doc
    inside = doc[:len(five)] == doc[WORDS - 1:] if len(five) else np.zeros(0, dtype=bool)
    values, owner = K.signed(five[inside]), doc[:len(five)][inside]
    short = np.flatnonzero((n > 0) & (n < WORDS))
    if len(short):
        whole = K.fold(h, words.first[short], words.first[short + 1], seed=WORDS)
        values, owner = np.concatenate((values, K.signed(whole))), np.concatenate((owner, short))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(texts) + 1))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n long, f1 long, f2 long, sketch array<long>): set size, set fingerprint and
    the SKETCH least values."""
    def rows(part: pa.RecordBatch):
        values, at = shingle_sets(K.texts_of(part.column(1)))
        n = np.diff(at)
        u = values.view(np.uint64)
        one = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(K.mix(u ^ np.uint64(0x5851F42D4C957F2D)))))
        two = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(K.mix(u * np.uint64(0xD1342543DE82EF95)))))
        size = np.minimum(n, SKETCH)
        sketch = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(size))).astype(np.int32), K.gather(values, at[:-1], size))
        return [part.column(0), pa.array(n.astype(np.int64)), pa.array(K.signed(one[at[1:]] - one[at[:-1]])),
                pa.array(K.signed(two[at[1:]] - two[at[:-1]])), sketch]

    return map_texts(docs, id_col, text_col, "n long, f1 long, f2 long, sketch array<long>", rows)


def _lists(reps: DataFrame) -> DataFrame:
    """(v, rep, n): each document in the lists of its rarest retained values."""
    posted = reps.select("rep", "n", F.size("sketch").alias("k"), F.explode("sketch").alias("v"))
    shared = posted.groupBy("v").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    posted = posted.join(shared, "v")
    mine = Window.partitionBy("rep", "n")
    need = F.least(F.ceil(F.col("n") * SAME / OF), F.lit(MIN_SHARED))
    alone = F.col("k") - F.count(F.lit(1)).over(mine)  # values in no other sketch come first
    ranked = posted.select("v", "rep", "n", (F.row_number().over(mine.orderBy("df", "v")) + alone).alias("at"), (F.col("k") - need + 1).alias("most"))
    return ranked.filter("at <= most").select("v", "rep", "n")


def _similar_size(a: Column, b: Column) -> Column:
    return F.least(a, b) * OF >= F.greatest(a, b) * SAME


def _estimated(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs that the union sketch lets through."""
    one = reps.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = reps.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
    met = (pairs.join(one, "a").join(two, "b").filter(_similar_size(F.col("na"), F.col("nb")))
           .select("a", "b", F.size(union).alias("k"), F.size(F.array_intersect(union, F.array_intersect("sa", "sb"))).alias("x")))
    enough = F.when(F.col("k") < SKETCH, F.col("x") * OF >= F.col("k") * SAME).otherwise(F.col("x") >= MIN_SHARED)
    return met.filter(enough).select("a", "b").distinct()


def _full_sets(ids: DataFrame, docs: DataFrame, kind: str) -> DataFrame:
    """(id, full array<long>) of the documents in `ids`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch):
                values, at = shingle_sets(K.texts_of(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(at.astype(np.int32), values)], names=["id", "full"])

    # A stored table: the planner knows its size and broadcasts it only if it is small.
    wanted = stored(ids.distinct(), "near-wanted")
    return stored(docs.join(wanted, "id", "left_semi").select("id", "text").mapInArrow(run, f"id {kind}, full array<long>"), "near-sets")


def _verified(pairs: DataFrame, docs: DataFrame, kind: str) -> DataFrame:
    """The pairs whose full sets are similar: (a, b)."""
    full = _full_sets(pairs.select(F.col("a").alias("id")).union(pairs.select("b")), docs, kind)
    one = full.select(F.col("id").alias("a"), F.col("full").alias("fa"))
    two = full.select(F.col("id").alias("b"), F.col("full").alias("fb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                x, y = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (2, 3))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = both > 0 and both * OF >= (len(x) + len(y) - both) * SAME
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "fa", "fb").mapInArrow(check, f"a {kind}, b {kind}").distinct()


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one block with all of the other."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    x, y = np.concatenate(left), np.concatenate(right)
    i, j = np.repeat(np.arange(len(left)), [len(s) for s in left]), np.repeat(np.arange(len(right)), [len(s) for s in right])
    both = np.intersect1d(x, y)
    if not len(both):
        return out.astype(np.int64)
    px, py = np.minimum(np.searchsorted(both, x), len(both) - 1), np.minimum(np.searchsorted(both, y), len(both) - 1)
    kx, ky = both[px] == x, both[py] == y
    px, i, py, j = px[kx], i[kx], py[ky], j[ky]
    ox, oy = np.argsort(px, kind="stable"), np.argsort(py, kind="stable")
    px, i, py, j = px[ox], i[ox], py[oy], j[oy]
    for at in range(0, len(both), _SLAB):
        a, b = np.searchsorted(px, (at, at + _SLAB)), np.searchsorted(py, (at, at + _SLAB))
        m, n = (np.zeros((r, _SLAB), dtype=np.float32) for r in out.shape)
        m[i[a[0]:a[1]], px[a[0]:a[1]] - at] = 1
        n[j[b[0]:b[1]], py[b[0]:b[1]] - at] = 1
        out += m @ n.T
    return out.astype(np.int64)


def _block_links(group: pa.Table) -> pa.Table:
    """Links between the two blocks of a group (or inside one block): those that join
    components not yet joined by an earlier one."""
    side = group.column("side").to_numpy()
    rep = group.column("rep").to_pylist()
    _, comp = np.unique(np.array(group.column("c").to_pylist()), return_inverse=True)
    sets = [np.asarray(x.values) for x in group.column("full").combine_chunks()]
    left = np.flatnonzero(side != 1)
    right = np.flatnonzero(side != 0)
    found: list[tuple[int, int]] = []
    if len(left) and len(right):
        both = overlaps([sets[k] for k in left], [sets[k] for k in right])
        size = np.array([len(s) for s in sets])
        near = both * OF >= (size[left][:, None] + size[right][None, :] - both) * SAME
        near &= (comp[left][:, None] != comp[right][None, :]) & (both > 0)
        root = list(range(int(comp.max()) + 1))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = k = root[root[k]]
            return k

        for p, q in zip(*np.nonzero(near)):
            a, b = left[p], right[q]
            x, y = find(int(comp[a])), find(int(comp[b]))
            if x != y:
                root[x] = y
                found.append((int(a), int(b)))
    return pa.table({"a": pa.array([rep[a] for a, _ in found], group.schema.field("rep").type),
                     "b": pa.array([rep[b] for _, b in found], group.schema.field("rep").type)})


def _long_lists(placed: DataFrame, docs: DataFrame, kind: str) -> DataFrame:
    """(a, b): links between members of one long list that are in different components."""
    home = placed.groupBy("rep").agg(F.min("v").alias("g"), F.max("n").alias("n"), F.min("c").alias("c"))
    salts = home.groupBy("g").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_ROWS, F.sum("n") / BLOCK_SHINGLES)).alias("salts"))
    home = stored(home.join(salts, "g").select("rep", "c", F.xxhash64("g", F.pmod(F.xxhash64("rep"), "salts")).alias("block")), "near-blocks")
    blocks = home.groupBy("block").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    held = placed.select("v", "rep").join(home, "rep").select("v", "block").distinct().join(blocks, "block")
    x, y = held.alias("x"), held.alias("y")
    one = (F.col("x.lo") == F.col("x.hi")) & (F.col("y.lo") == F.col("y.hi")) & (F.col("x.lo") == F.col("y.lo"))
    pairs = stored(x.join(y, (F.col("x.v") == F.col("y.v")) & (F.col("x.block") <= F.col("y.block")) & ~one)
                   .select(F.col("x.block").alias("i"), F.col("y.block").alias("j")).distinct(), "near-block-pairs")
    full = _full_sets(home.select(F.col("rep").alias("id")), docs, kind).withColumnRenamed("id", "rep")
    member = home.join(full, "rep")
    inside = F.col("i") == F.col("j")
    roles = (pairs.select("i", "j", F.when(inside, 2).otherwise(0).alias("side"), F.col("i").alias("block"))
             .union(pairs.filter(~inside).select("i", "j", F.lit(1), F.col("j"))))
    return (roles.join(member, "block").select("i", "j", "side", "rep", "c", "full")
            .groupBy("i", "j").applyInArrow(_block_links, f"a {kind}, b {kind}"))


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def links(docs: DataFrame, reps: DataFrame, kind: str) -> DataFrame:
    """(a, b): verified links between class representatives that give all components."""
    lists = _lists(reps)
    about = lists.groupBy("v").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("least")).filter("size > 1")
    lists = stored(lists.join(about, "v"), "near-lists")
    block = F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / _BLOCK))
    around = Window.partitionBy("v", "block").orderBy(F.xxhash64("rep", "v"))
    beside = lists.withColumn("block", block).select("rep", F.lag("rep").over(around).alias("other")).filter("other IS NOT NULL")
    tried = stored(lists.select("rep", F.col("least").alias("other")).union(beside)
                   .filter("rep != other").select(*_pair("rep", "other")).distinct(), "near-tried")
    first = stored(_verified(stored(_estimated(tried, reps), "near-pairs"), docs, kind), "near-links")
    # Round two: members of one list in different components.
    component = components(first, rounds=2).withColumnRenamed("node", "rep")  # parts are enough here
    placed = lists.join(component, "rep", "left").select("v", "rep", "n", "size", F.coalesce("component", "rep").alias("c"))
    mixed = placed.groupBy("v").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo != hi").select("v")
    placed = stored(placed.join(mixed, "v"), "near-mixed")
    x, y = placed.filter(F.col("size") <= SHORT).alias("x"), placed.filter(F.col("size") <= SHORT).alias("y")
    apart = (x.join(y, (F.col("x.v") == F.col("y.v")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.c") != F.col("y.c")) & _similar_size(F.col("x.n"), F.col("y.n")))
             .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
             .join(tried, ["a", "b"], "left_anti"))
    second = _verified(stored(_estimated(apart, reps), "near-pairs"), docs, kind)
    return first.union(second).union(_long_lists(placed.filter(F.col("size") > SHORT), docs, kind).select(*_pair("a", "b")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles long, component_id, kept boolean) of each row."""
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    sketched = stored(sketches(docs, "id"), "near-sketches")
    known = sketched.filter("n > 0 AND id IS NOT NULL")
    classes = known.groupBy("n", "f1", "f2").agg(F.min("id").alias("rep"))
    member = known.join(classes, ["n", "f1", "f2"])
    reps = stored(member.filter("id = rep").select("rep", "n", "f1", "f2", "sketch").dropDuplicates(["rep", "n", "f1", "f2"]).drop("f1", "f2"), "near-reps")
    found = links(docs.filter("id IS NOT NULL"), reps, kind)
    # Copies hang on their representative; rows that share an id are one document.
    copies = member.filter("id != rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    several = known.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("id")
    hung = copies.join(several, F.col("a") == several["id"], "left_semi")
    component = components(found.union(hung)).withColumnRenamed("node", "rep")
    own = member.select("id", "rep").distinct().join(component, "rep", "left").select("id", F.coalesce("component", "rep").alias("c"))
    own = own.groupBy("id").agg(F.min("c").alias("c"))
    out = sketched.select("id", "n").join(own, "id", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("c", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))).withColumnRenamed("id", id_col)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` (all columns) that are kept: one document of each component. Rows
    with a null id stay."""
    kept = near_duplicates(docs, id_col, text_col).filter(F.col("kept") & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_kept")).distinct()
    return (docs.join(kept, docs[id_col] == kept["_kept"], "left_semi")
            .unionByName(docs.filter(docs[id_col].isNull())))

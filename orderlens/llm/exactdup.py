"""Exact duplicates by counting quotient filters, confirmed byte by byte.

1. Fingerprints. Each text (null: empty) gets a 64-bit fingerprint and its SHA-256; one row a
   document, without the text, is stored.
2. Filters. Every partition counts its fingerprints in counting quotient filters: the leading
   bits say which slice of the hash space a filter covers, the next ones are the quotient (its
   place, kept as one bit), the rest is the remainder, sorted within its quotient, with a
   counter where it was seen more than once. Quotient and remainder together are the whole
   fingerprint, so filters of any sizes merge without loss, slice by slice, by their sorted
   remainders. Copies within a partition are one entry: a text that a third of all rows repeat
   adds one entry a partition. The number of slices follows the number of documents
   (`SLICE_ROWS` a slice), so a merge never holds more than a slice.
3. Verification. A fingerprint counted once belongs to one document, whose text isn't read
   again. Texts whose fingerprint was counted more often are compared byte by byte: they are
   aggregated by (fingerprint, text), combined before the shuffle. Different texts that share a
   fingerprint part here.
4. Verdicts. Each document looks up its class by (fingerprint, SHA-256).

Hot groups: a fingerprint with more than 1 / `HOT` of all rows is in a list of less than `HOT`
rows (no more can have so many), which is broadcast; its rows are dealt over several tasks by
a salt, and its class is repeated for each salt. So no task gets more than about that share.

Results for edge cases: null texts are empty texts, and equal to them; rows that share an id
are rows of their own (they count in `group_size`, and those with the id that stays all have
`kept`); a null id never stays unless all ids of its group are null, and then keep_id is null
and nothing is kept; an empty table gives none; other columns are ignored, whatever their
names; texts are whole, however long.
"""
from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .frames import stored

#: Fingerprint bits: 64, fewer only to force collisions in tests.
BITS = 64
#: Documents to a slice of the merged filter, and the least number of slices (as a power of two).
SLICE_ROWS, LEAST_SLICES = 1 << 18, 5
#: Fingerprints counted by one filter at most; a larger partition makes several.
FILTER_ROWS = 1 << 20
#: A key with more than 1 / HOT of the rows is spread over several tasks.
HOT = 1024

_U = np.uint64


# ------------------------------------------------------------------ the filter
def pack(values: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    """The filter of ascending different `values` (of `width` bits) with their counts: a bit for
    each quotient (occupied), a bit for each entry (last of its run), remainders, counters."""
    size = len(values)
    quotient_bits = min(max(int(size - 1).bit_length(), 0), width)
    low = width - quotient_bits
    quotient = (values >> _U(low)).astype(np.int64) if low < 64 else np.zeros(size, np.int64)
    remainder = values & _U((1 << low) - 1)
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotient] = True
    last = np.ones(size, bool)
    last[:-1] = quotient[1:] != quotient[:-1]
    many = counts > 1
    nbytes = -(-low // 8)
    return b"".join([
        struct.pack("<QBB", size, quotient_bits, low), np.packbits(occupied).tobytes(), np.packbits(last).tobytes(),
        np.packbits(many).tobytes(), np.ascontiguousarray(remainder.astype("<u8").view(np.uint8).reshape(size, 8)[:, :nbytes]).tobytes(),
        counts[many].astype("<i8").tobytes()])


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The values and counts of a filter, ascending."""
    size, quotient_bits, low = struct.unpack_from("<QBB", blob)
    at = 10

    def flags(n: int) -> np.ndarray:
        nonlocal at
        raw = np.frombuffer(blob, np.uint8, -(-n // 8), at)
        at += len(raw)
        return np.unpackbits(raw, count=n).astype(bool)

    occupied, last, many = flags(1 << quotient_bits), flags(size), flags(size)
    nbytes = -(-low // 8)
    wide = np.zeros((size, 8), np.uint8)
    wide[:, :nbytes] = np.frombuffer(blob, np.uint8, size * nbytes, at).reshape(size, nbytes)
    at += size * nbytes
    counts = np.ones(size, np.int64)
    counts[many] = np.frombuffer(blob, "<i8", int(many.sum()), at)
    run = np.cumsum(last) - last
    high = np.flatnonzero(occupied)[run].astype(_U)
    value = wide.view("<u8").ravel().astype(_U)
    return (value | (high << _U(low)) if low < 64 else value), counts


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One list of ascending values with the sums of their counts. The parts are sorted runs,
    which the stable sort merges."""
    values, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


# ------------------------------------------------------------------ Spark
def repeated(prints: DataFrame, rows: int, bits: int = BITS) -> DataFrame:
    """(fp, n) of each value of the long column `fp` that occurs more than once."""
    slices = min(max((-(-rows // SLICE_ROWS) - 1).bit_length(), LEAST_SLICES), bits)
    width = bits - slices

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def made() -> pa.RecordBatch:
            values, counts = merge(parts)
            piece = (values >> _U(width)).astype(np.int64) if width < 64 else np.zeros(len(values), np.int64)
            cut = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
            ends = np.append(cut[1:], len(values))
            low = values & _U((1 << width) - 1)
            return pa.RecordBatch.from_arrays([
                pa.array(piece[cut], pa.int64()),
                pa.array([pack(low[a:b], counts[a:b], width) for a, b in zip(cut, ends)], pa.binary())], names=["slice", "filter"])

        for batch in batches:
            fp = np.asarray(batch.column(0)).astype(np.int64).view(_U)
            for at in range(0, len(fp), FILTER_ROWS):
                parts.append(np.unique(fp[at:at + FILTER_ROWS], return_counts=True))
                held += len(parts[-1][0])
                if held >= FILTER_ROWS:
                    yield made()
                    parts, held = [], 0
        if held:
            yield made()

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        low, counts = merge([unpack(x.as_py()) for x in table.column("filter")])
        many = counts > 1
        fp = low[many] | _U(key[0].as_py() << width if width < 64 else 0)
        return pa.table({"fp": fp.view(np.int64), "n": counts[many]})

    return prints.select("fp").mapInArrow(count, "slice long, filter binary").groupBy("slice").applyInArrow(merged, "fp long, n long")


def _with_group(rows: DataFrame, groups: DataFrame, on: list[str], total: int, how: str) -> DataFrame:
    """`rows` (id, fp, ...) joined with `groups` (fp, n, ...), the rows of hot fingerprints dealt
    over several tasks."""
    salts = F.ceil(F.col("n") * F.lit(float(HOT)) / F.lit(float(max(total, 1)))).cast("int")
    hot = groups.filter(salts > 1).groupBy("fp").agg(F.max(salts).alias("salts"))  # less than HOT rows
    n_salts = F.coalesce("salts", F.lit(1))
    left = (rows.join(F.broadcast(hot), "fp", "left")
            .withColumn("salt", F.pmod(F.xxhash64("id"), n_salts.cast("long")).cast("int")).drop("salts"))
    right = groups.join(F.broadcast(hot), "fp", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), n_salts - 1))).drop("salts")
    return left.join(right, [*on, "salt"], how).drop("salt")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     normalise: Callable[[Column], Column] | None = None, bits: int = BITS) -> DataFrame:
    """(id, keep_id, group_size long, kept boolean, text_sha256 string) of each row. Texts are
    equal if their bytes are, after `normalise` if that is given; the largest id stays."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    text = normalise(text) if normalise else text
    docs = docs.select(docs[id_col].alias("id"), text.alias("text"))
    print_of = F.shiftrightunsigned(F.xxhash64("text"), 64 - bits) if bits < 64 else F.xxhash64("text")
    docs = docs.withColumn("fp", print_of)
    prints = stored(docs.select("id", "fp", F.unhex(F.sha2("text", 256)).alias("sha")), "prints")
    total = prints.count()
    groups = stored(repeated(prints, total, bits), "repeated")
    texts = _with_group(docs, groups, ["fp"], total, "inner")
    same = texts.groupBy("fp", "text").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    classes = stored(same.select("fp", F.unhex(F.sha2("text", 256)).alias("sha"), "keep_id", "n"), "classes")
    # A class left join: fingerprints counted once have none.
    found = _with_group(prints, classes, ["fp", "sha"], total, "left")
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("id").alias(id_col), keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("id") == keep, F.lit(False)).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def keep_last(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """The rows of `docs`, all columns, without those whose text a row with a larger id has
    too. Rows with a null id are dropped where a row with an id has their text."""
    verdict = exact_duplicates(docs, id_col, text_col, normalise).filter(~F.col("kept")).filter("keep_id IS NOT NULL")
    gone = stored(verdict.select(F.col(id_col).alias("_gone_id"), F.unhex("text_sha256").alias("_gone_sha")).distinct(), "dropped")
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    text = normalise(text) if normalise else text
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_gone_id"]) & (F.unhex(F.sha2(text, 256)) == gone["_gone_sha"]), "left_anti")

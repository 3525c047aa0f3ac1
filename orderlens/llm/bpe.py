"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

A vocabulary file of the tokenizers library (a path: never copied, never trained) gives
merges, tokens and special tokens. Inside a task:

1. code points are classed by table lookup (letter, number, space, other) and the
   pre-token boundaries of the byte-level split pattern follow from neighbouring classes;
2. pre-tokens are hashed; those not met before in this worker are merged together: the
   symbols of all of them lie in one flat array, a binary search over the sorted pair keys
   gives the rank of every neighbouring pair, each word merges its lowest-ranked pair
   (leftmost first where occurrences overlap), and words without a pair drop out;
3. the ids of a text are gathered from the words' ids; decoding gathers the bytes of the
   ids. Encoding is checked by that round trip: a text whose decoded bytes differ from its
   own (two pre-tokens with one 64-bit hash) is encoded again word by word.

Work grows with the distinct words of a worker plus a few vector steps per byte. The word
cache is bounded (`CACHE_WORDS`) and starts anew when full.

Results for edge cases: a null or empty text has no ids and decodes to the empty text;
repeated rows (and repeated or null ids) give one result each; an empty table gives none;
other columns are ignored. Text is never cut.
"""
from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernel as K
from .frames import map_texts

#: Distinct pre-tokens that a worker remembers before it starts anew (about 100 MB).
CACHE_WORDS = 1_000_000
_NONE = np.int64(2**31 - 1)


def _byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(plain))
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """Merges and tokens of one byte-level BPE file, as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([ids[a] for a, _ in merges], dtype=np.int64)
        right = np.array([ids[b] for _, b in merges], dtype=np.int64)
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        symbol = _byte_symbols()
        self.byte_ids = np.array([ids[symbol[b]] for b in range(256)], dtype=np.int64)
        byte_of = {c: b for b, c in symbol.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        size = max([*ids.values(), *self.special.values()]) + 1
        pieces = [b""] * size
        for token, i in ids.items():
            pieces[i] = bytes(byte_of[c] for c in token) if token not in self.special else b""
        for token, i in self.special.items():
            pieces[i] = token.encode()
        self.piece_len = np.array([len(p) for p in pieces], dtype=np.int64)
        self.piece_at = np.concatenate(([0], np.cumsum(self.piece_len)[:-1]))
        self.piece_bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.seen = np.zeros(0, dtype=np.uint64)  # hashes of known words, sorted
        self.word = np.zeros(0, dtype=np.int64)   # and their places below
        self.ids_at = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int64)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over many words at once: ids end to end, and ids per word."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        names = np.arange(len(lengths))

        def ranks_at(i: np.ndarray) -> np.ndarray:
            """Rank of the pair that begins at each place; none at the end of a word."""
            pair = symbols[i] << 32 | symbols[np.minimum(i + 1, len(symbols) - 1)]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            return np.where((self.keys[at] == pair) & ~last[i], self.ranks[at], _NONE)

        def ends() -> np.ndarray:
            flags = np.zeros(len(symbols), dtype=bool)
            flags[np.cumsum(lengths) - 1] = True
            return flags

        if len(lengths):
            last = ends()
            rank = ranks_at(np.arange(len(symbols)))
        while len(lengths):
            least = np.minimum.reduceat(rank, np.cumsum(lengths) - lengths)
            done = least == _NONE
            if done.any():
                gone = np.repeat(done, lengths)
                out.append((names[done], lengths[done], symbols[gone]))
                symbols, rank = symbols[~gone], rank[~gone]
                names, lengths, least = names[~done], lengths[~done], least[~done]
                if not len(lengths):
                    break
            owner = np.repeat(np.arange(len(lengths)), lengths)
            hit = np.flatnonzero(rank == least[owner])
            # Of pairs that overlap (a a a), every second one from the left of their run.
            run = np.r_[True, np.diff(hit) > 1]
            begin = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - begin) % 2 == 0]
            symbols[hit] = self.merged[rank[hit]]
            lengths = lengths - np.bincount(owner[hit], minlength=len(lengths))
            keep = np.ones(len(symbols), dtype=bool)
            keep[hit + 1] = False
            symbols, rank = symbols[keep], rank[keep]
            hit -= np.arange(len(hit))  # where the merged symbols are now
            last = ends()
            near = np.concatenate((hit, hit[hit > 0] - 1))  # only pairs beside a merge are new
            rank[near] = ranks_at(near)
        if not out:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        words = np.concatenate([x[0] for x in out])
        sizes, flat = np.concatenate([x[1] for x in out]), np.concatenate([x[2] for x in out])
        order = np.argsort(words)
        return K.gather(flat, (np.cumsum(sizes) - sizes)[order], sizes[order]), sizes[order]

    def learn(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Encode words that aren't known yet and remember them."""
        symbols = self.byte_ids[K.gather(data, start, end - start)]
        ids, sizes = self.merge(symbols, end - start)
        known = len(self.ids_at) - 1
        self.ids = np.concatenate((self.ids, ids))
        self.ids_at = np.concatenate((self.ids_at, self.ids_at[-1] + np.cumsum(sizes)))
        seen = np.concatenate((self.seen, hashes))
        word = np.concatenate((self.word, known + np.arange(len(hashes))))
        order = np.argsort(seen)
        self.seen, self.word = seen[order], word[order]

    def encode(self, texts: K.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's ids begin (and end)."""
        start, end, special, first = split(texts, self.special)
        h = K.span_hash(texts.data, start, end)
        distinct, at, inverse = np.unique(h, return_index=True, return_inverse=True)

        def unknown() -> np.ndarray:
            if not len(self.seen):
                return np.arange(len(distinct))
            place = np.minimum(np.searchsorted(self.seen, distinct), len(self.seen) - 1)
            return np.flatnonzero(self.seen[place] != distinct)

        new = unknown()
        if len(new) and len(self.seen) + len(new) > CACHE_WORDS:
            self._forget()
            new = unknown()
        if len(new):
            self.learn(distinct[new], texts.data, start[at[new]], end[at[new]])
        word = self.word[np.searchsorted(self.seen, distinct)][inverse] if len(distinct) else np.zeros(0, dtype=np.int64)
        begin, size = self.ids_at[word], self.ids_at[word + 1] - self.ids_at[word] if len(word) else np.zeros(0, dtype=np.int64)
        ids = K.gather(self.ids, begin, np.where(special >= 0, 1, size))
        upto = np.concatenate(([0], np.cumsum(np.where(special >= 0, 1, size))))
        marked = np.flatnonzero(special >= 0)
        ids[upto[marked]] = special[marked]
        return ids, upto[first]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids end to end."""
        return K.gather(self.piece_bytes, self.piece_at[ids], self.piece_len[ids])


def split(texts: K.Texts, specials: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pre-tokens as byte ranges; the id of those that are special tokens, else -1; and
    text i's pre-tokens are first[i]:first[i + 1]. By the byte-level split pattern
    (contractions, then letters, numbers or others with at most one space before them,
    then spaces, the last of which goes to what follows)."""
    data, offsets = texts
    size = int(offsets[-1])
    if not size:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, np.zeros(len(offsets), dtype=np.int64)
    raw = data[:size].tobytes()
    code, at = K.codes_of(texts)
    n = len(code)
    cut = np.zeros(n + 1, dtype=bool)  # a text, or a special token, begins or has ended here
    cut[np.searchsorted(at, offsets)] = True
    inner = np.zeros(n, dtype=bool)
    marked: dict[int, int] = {}
    for token, number in specials.items():
        piece, place = token.encode(), raw.find(token.encode())
        while place >= 0:
            text = np.searchsorted(offsets, place, side="right")
            if place + len(piece) <= offsets[text]:  # not across two texts
                a, b = np.searchsorted(at, (place, place + len(piece)))
                cut[[a, b]] = True
                inner[a:b] = True
                marked[int(a)] = number
                place = raw.find(piece, place + len(piece))
            else:
                place = raw.find(piece, place + 1)
    kind = K.code_classes()[code]
    begins = cut[:n].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    # The last space before something else: alone, or with what follows if it is 0x20.
    last = np.flatnonzero((kind[:-1] == K.SPACE) & (kind[1:] != K.SPACE) & ~cut[1:n])
    begins[last] = True
    begins[last + 1] = code[last] != 0x20
    # Contractions: an apostrophe that begins a pre-token, and the letters after it.
    mark = np.flatnonzero((code == 0x27) & begins)
    after = np.concatenate((code, np.zeros(2, dtype=np.uint32)))
    one = mark[np.isin(after[mark + 1], [ord(c) for c in "stmd"]) & ~cut[np.minimum(mark + 1, n)]]
    pair = after[mark + 1].astype(np.int64) << 32 | after[mark + 2]
    two = mark[np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")]) & ~cut[np.minimum(mark + 1, n)] & ~cut[np.minimum(mark + 2, n)]]
    for found, length in ((one, 2), (two, 3)):
        begins[found + 1] = False
        begins[(found + length)[found + length < n]] = True
    begins[inner] = False
    begins[list(marked)] = True
    place = np.flatnonzero(begins)
    start = at[place]
    special = np.full(len(place), -1, dtype=np.int64)
    if marked:
        where = np.searchsorted(place, sorted(marked))
        special[where] = [marked[k] for k in sorted(marked)]
    return start, np.append(start[1:], size), special, np.searchsorted(start, offsets)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_texts(vocab: Vocabulary, texts: K.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and their offsets, decoded bytes and their offsets; encoding is checked by the
    round trip and repeated word by word if a hash collision shows."""
    ids, upto = vocab.encode(texts)
    back = vocab.decode(ids)
    if len(back) != len(texts.data) - 8 or not np.array_equal(back, texts.data[:-8]):
        start, end, special, first = split(texts, vocab.special)
        symbols = vocab.byte_ids[texts.data[:-8]]
        flat, sizes = vocab.merge(symbols, end - start)
        begin = np.cumsum(sizes) - sizes
        take = np.where(special >= 0, 1, sizes)
        ids = K.gather(flat, begin, take)
        bounds = np.concatenate(([0], np.cumsum(take)))
        ids[bounds[:-1][special >= 0]] = special[special >= 0]
        upto, back = bounds[first], vocab.decode(ids)
    size = np.concatenate(([0], np.cumsum(vocab.piece_len[ids])))
    return ids, upto, back, size[upto]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) of each row: the token ids of its text, and
    the text that they decode to."""
    def rows(part: pa.RecordBatch):
        texts = K.texts_of(part.column(1))
        ids, upto, back, size = encode_texts(vocabulary(path), texts)
        decoded = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(size.astype(np.int64)), pa.py_buffer(back))
        return [part.column(0), pa.ListArray.from_arrays(upto.astype(np.int32), ids.astype(np.int32)), decoded.cast(pa.string())]

    return map_texts(docs, id_col, text_col, "ids array<int>, decoded string", rows)


def digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each row, by the same encoder as
    `encode`, without moving ids and texts out of the tasks."""
    def rows(part: pa.RecordBatch):
        texts = K.texts_of(part.column(1))
        ids, upto, back, size = encode_texts(vocabulary(path), texts)
        flat, plain, n = memoryview(ids.astype("<u4")), memoryview(back), len(texts)
        return [part.column(0), pa.array(np.diff(upto).astype(np.int64)),
                pa.array([sha256(flat[upto[i]:upto[i + 1]]).hexdigest() for i in range(n)], pa.string()),
                pa.array([sha256(plain[size[i]:size[i + 1]]).hexdigest() for i in range(n)], pa.string())]

    return map_texts(docs, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", rows)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): the text of each array of ids; null ids give the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            texts = [vocab.decode(np.asarray(x or [], dtype=np.int64)).tobytes().decode("utf-8", "replace")
                     for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return (encoded.select(encoded[id_col].alias("id"), encoded[ids_col].alias("ids"))
            .mapInArrow(run, f"id {encoded.schema[id_col].dataType.simpleString()}, text string")
            .withColumnRenamed("id", id_col))

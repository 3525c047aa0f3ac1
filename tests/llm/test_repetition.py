"""Exact dedup, periodic runs and collocations against brute force and on edge cases."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

pytest.importorskip("orderlens.llm.queries")
from orderlens.llm import collocations, exactdup, kernel, periodic  # noqa: E402
from orderlens.llm.queries import queries  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns of `documents`, and more with names that the operators use inside.
SCHEMA = ("doc_id long, text string, lang string, id string, fp long, n int, salt string, keep_id string, sha string, "
          "k int, phrase string, shard string, runs int, slice int, rank int, score string")


def docs_of(spark, rows, schema=SCHEMA):
    """rows: (doc_id, text) or (doc_id, text, lang)."""
    return spark.createDataFrame([(i, t, *(lang or [None]), *[None] * 13) for i, t, *lang in rows], schema).repartition(3)


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


# ------------------------------------------------------------------ exact duplicates
def duplicates_brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i is not None and i == keep, sha(t)))
    return sorted(out, key=repr)


def copies(seed=4, n=400):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(("hot copy of one text", f"text {i}", f"pair {i // 2}", None, "", "É", "é", "é"))) for i in range(n)]
    return rows + [(n, "long " * 40_000), (n + 1, "long " * 40_000), (n + 2, "long " * 40_000 + "x")]


@pytest.mark.parametrize("bits", [64, 4, 12])
def test_exact_duplicates_equal_brute_force(spark, bits):
    """With few fingerprint bits, different texts collide: their bytes tell them apart."""
    rows = copies()
    got = exactdup.exact_duplicates(docs_of(spark, rows), bits=bits)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == duplicates_brute(rows)


def test_exact_duplicates_spread_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(exactdup, "HOT", 7)
    rows = copies(seed=9)
    got = exactdup.exact_duplicates(docs_of(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == duplicates_brute(rows)


def test_exact_duplicates_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(7, "a"), (7, "a"), (9, "a"), (None, "a"), (None, "b"), (None, "b"), (3, "c"), (3, "d")]
    got = exactdup.exact_duplicates(docs_of(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == duplicates_brute(rows)
    assert exactdup.exact_duplicates(docs_of(spark, [])).collect() == []


def test_keep_last_returns_whole_rows(spark):
    docs = docs_of(spark, [(1, "a"), (5, "a"), (2, None), (4, ""), (6, "A"), (None, "a"), (None, "z")])
    kept = exactdup.keep_last(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == [(4, ""), (5, "a"), (6, "A"), (None, "z")]
    from pyspark.sql import functions as F

    assert {r.doc_id for r in exactdup.keep_last(docs, normalise=F.lower).collect()} == {4, 6, None}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**20 - 1), max_size=60), min_size=1, max_size=5), st.sampled_from([20, 33, 63, 64]))
def test_filters_merge_without_loss(parts, width):
    """Filters of different sizes, packed and read again, hold what one count of all holds."""
    blobs, want = [], Counter()
    for part in parts:
        wide = [x << (width - 20) | x >> 3 for x in part]
        want.update(wide)
        if wide:
            values, counts = np.unique(np.array(wide, np.uint64), return_counts=True)
            blobs.append(exactdup.pack(values, counts, width))
    if blobs:
        values, counts = exactdup.merge([exactdup.unpack(b) for b in blobs])
        assert list(values) == sorted(want) and dict(zip(values.tolist(), counts.tolist())) == want


# ------------------------------------------------------------------ periodic runs
def runs_brute(words):
    n, found = len(words), set()
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(6, 4 * p):
                stretch = words[i:j + p]
                if not any(all(stretch[x] == stretch[x + q] for x in range(len(stretch) - q)) for q in range(1, p)):
                    found.add((i, j + p - i, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed_brute(words, runs):
    gone = set()
    for s, length, p in runs:
        gone.update(range(s + p, s + length))
    return " ".join(w for x, w in enumerate(words) if x not in gone)


def find(texts):
    part = pa.record_batch([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["id", "text"])
    _, n, runs, text = periodic._rows(part)
    return [(a, [tuple(r.values()) for r in b], c) for a, b, c in zip(n.to_pylist(), runs.to_pylist(), text.to_pylist())]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.sampled_from("aabc"), min_size=1, max_size=7), st.integers(1, 9)), max_size=6), min_size=1, max_size=4))
def test_runs_equal_brute_force(documents):
    """Several documents at once, of repeated blocks, also of blocks that hold runs."""
    words = [[w for block, times in d for w in block * times] for d in documents]
    for w, (n, runs, text) in zip(words, find([" ".join(w) for w in words])):
        want = runs_brute(w)
        assert (n, runs, text) == (len(w), want, collapsed_brute(w, want))


def test_runs_of_long_texts_and_edges(spark):
    rnd = random.Random(6)
    block = [f"w{rnd.randrange(40)}" for _ in range(900)]
    fibonacci = ["a", "b"]
    while len(fibonacci) < 3000:
        fibonacci = [x for c in fibonacci for x in (["a", "b"] if c == "a" else ["a"])]
    long = {1: ["x"] * 30_000, 2: block * 5 + ["end"], 3: (["a"] * 9 + ["b"]) * 700, 4: fibonacci}
    rows = [(i, " ".join(w)) for i, w in long.items()]
    rows += [(5, None), (6, ""), (7, " \n"), (8, "one"), (9, "a\ta \n a a a  a"), (9, "a a a a a"), (None, "b b b b b b"), (10, "A a A a A a A a")]
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.find_runs(docs_of(spark, rows)).collect()), key=repr)
    found = {r[0]: r for r in got}
    assert found[1][2:] == ([(0, 30_000, 1)], "x") and (0, 4500, 900) in found[2][2]
    assert (0, 7000, 10) in found[3][2] and len(found[3][2]) == 701
    assert found[4][2] == []  # no fourth power in a Fibonacci word
    assert found[5][1:] == found[6][1:] == found[7][1:] == (0, [], "")
    assert found[8][1:] == (1, [], "one") and found[None][1:] == (6, [(0, 6, 1)], "b") and found[10][2] == [(0, 8, 2)]
    assert sorted(r[1:] for r in got if r[0] == 9) == [(5, [], "a a a a a"), (6, [(0, 6, 1)], "a")]
    assert periodic.find_runs(docs_of(spark, [])).collect() == []


def test_periodic_query_equals_brute_force(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(("a", "b", "cc", f"w{rnd.randrange(30)}")) for _ in range(rnd.choice((0, 1, 5, 60, 200))))) for i in range(150)]
    rows += [(200, None), (201, "tab\tand\nline  x"), (203, "z " * 50), (204, "é " * 9 + "ß")]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    made = 0
    for r in queries()["op12_periodic_runs"](spark, str(tmp_path)).collect():
        w = WORD.findall(dict(rows)[r.doc_id] or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w, made = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)], made + 1
        runs = runs_brute(w)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        want = (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines), sha(collapsed_brute(w, runs)))
        assert tuple(r)[1:] == want
    assert made > 5


# ------------------------------------------------------------------ collocations
def phrases_brute(rows, support, top, cover=100, longest=5):
    count, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                count[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in count.items():
        found = [p for p, a in c.items() if len(p) > 1 and a >= support]
        held = Counter()
        for p in found:
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        held[p[i:j]] = max(held[p[i:j]], c[p])
        scored = []
        for p in found:
            if p in held and 100 * held[p] >= cover * c[p]:
                continue
            score, k = min((1000 * c[p] * total[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -c[p], " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def phrase_corpus(seed=2, n=220):
    rnd = random.Random(seed)
    words = ["Da", "le", "é", "x'y", "<b>", "zu", *[f"w{i}" for i in range(25)]]
    fixed = ["of the old new town hall", "Le petit, chat", "w1 w2 w3 w4 w5 w6 w7"]
    rows = []
    for i in range(n):
        parts = [rnd.choice(fixed) if rnd.random() < 0.2 else rnd.choice(words) for _ in range(rnd.choice((0, 3, 40)))]
        text = "".join(p + rnd.choice((" ", " ", "  ", "\t", ", ", "\n", ".")) for p in parts)
        rows.append((i, rnd.choice((text, text, text, None, "")), rnd.choice(("en", "fr", None))))
    return rows + [(n, " ".join(rnd.choice(words) for _ in range(60_000)), "long"), (n + 1, "Same " * 500, "hot"), (n + 2, "...", "none")]


@pytest.mark.parametrize("shards, cover", [(1, 100), (3, 100), (4, 80)])
def test_collocations_equal_brute_force(spark, shards, cover):
    rows = phrase_corpus()
    got = collocations.collocations(docs_of(spark, rows), support=6, top=40, shards=shards, cover=cover)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == phrases_brute(rows, 6, 40, cover)


def test_collocations_with_a_full_filter(spark, monkeypatch):
    """A filter too small for the phrases makes too much active, and changes no result."""
    monkeypatch.setattr(collocations, "FILTER_BITS", 64)
    rows = phrase_corpus(seed=5, n=60)[:60]
    want = phrases_brute(rows, 4, 2000)
    # The patched size must reach the tasks, so the counting functions run here.
    low, _ = collocations._normal(pa.array([t for _, t, _ in rows]))
    langs = pa.array([lang or "und" for *_, lang in rows])
    shards = [(langs.take(pa.array(range(s, 60, 3))), low.take(pa.array(range(s, 60, 3)))) for s in range(3)]
    filters, visits = [np.zeros(8, np.uint8)], []
    for step in range(40):
        before = filters[step - 3] if step >= 3 else None
        batch = pa.record_batch(list(shards[step % 3]), names=["lang", "text"])
        count = Counter()
        for b in collocations._counter(filters[step], before, 5)(iter([batch])):
            for r in b.to_pylist():
                count[r["lang"], r["phrase"]] += r["n"]
        visits.append(count)
        recent = sum(visits[-3:], Counter())
        reached = [key for key, n in recent.items() if n >= 4 and len(key[1].split()) < 5]
        bits = filters[step].copy().view("<u8")
        if reached:
            part = pa.record_batch([pa.array([a for a, _ in reached]), pa.array([b for _, b in reached])], names=["lang", "phrase"])
            for b in collocations._bits_of(iter([part])):
                np.bitwise_or.at(bits, np.asarray(b.column(0)), np.asarray(b.column(1)).view(np.uint64))
        filters.append(bits.view(np.uint8))
    total = sum(visits, Counter())
    for lang, _, phrase, a, *_ in want:
        assert total[lang, phrase] == a


def test_collocations_scores_beyond_64_bits(spark):
    rows = [(3 * 10**12, 10**13 + 7, 9 * 10**12 + 1, 3 * 10**12 + 11), (100, 10**14, 100, 100), (7, 9, 8, 7)]
    got = spark.createDataFrame(rows, "a long, n long, l long, r long").select(collocations._score().alias("s")).collect()
    assert [r.s for r in got] == [1000 * a * n // (l * r) for a, n, l, r in rows]


def test_collocations_edges(spark):
    assert collocations.collocations(docs_of(spark, [])).collect() == []
    assert collocations.collocations(docs_of(spark, [(1, None, None), (2, "...", "en")]), support=1).collect() == []
    rows = [(1, "a b", None), (1, "a b", None), (None, "a b", "und")]
    got = collocations.collocations(docs_of(spark, rows), support=3).collect()
    assert [tuple(r) for r in got] == [("und", 1, "a b", 3, 3, 3, 6, 2000)]


def test_normal_texts():
    texts = ["A b.c", None, "", "x", " , . ", "é\tB\n\nc d ,e  f", "last"]
    text, words = collocations._normal(pa.array(texts))
    assert text.to_pylist() == ["a b\nc", "", "", "x", "", "é b\nc d\ne f", "last"] and words.tolist() == [3, 0, 0, 1, 0, 6, 1]
    assert len(kernel.texts_of(collocations._normal(pa.array([], pa.string()))[0])) == 0

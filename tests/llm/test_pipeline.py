"""The corpus pipeline against a brute-force version of its stages, and on empty tables."""
import hashlib
import random
import struct

import pytest

pytest.importorskip("orderlens.llm.queries")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
from orderlens.llm.queries import tokenizer_path  # noqa: E402

from test_operators import WORD, near_brute  # noqa: E402

#: Columns of `documents`, and more with names that the operators use inside.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, rep long, row int, _kept int"
TOXIC = "grobnik"


def tables(spark, folder, docs, labels, items):
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def row(i, text):
    return (i, text, None, None, None, "x", 1, None, 0)


def corpus():
    """(id, text, kind): clean, toxic, near copies, a shared passage, test items, nulls."""
    rnd = random.Random(8)
    vocabulary = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(3, 8))) for _ in range(800)]
    make = lambda k: [rnd.choice(vocabulary) for _ in range(k)]
    items = [(k, " ".join(make(rnd.randint(30, 40)))) for k in range(6)] + [(6, None), (None, "")]
    passage, out = make(60), []
    for i in range(150):
        w = make(rnd.choice((30, 60, 200)))
        kind = ("clean", "toxic", "near", "passage", "clean")[i % 5]
        if kind == "toxic":
            for k in range(0, len(w), 15):
                w[k] = TOXIC
        elif kind == "passage":
            w[len(w) // 2:len(w) // 2] = passage
        elif kind == "near":
            w = WORD.findall(out[-2][1])
            w[-1] = "changed"
        out.append((i, " ".join(w), kind))
    out += [(200 + k, " ".join([*make(40), text, *make(40)]), "leak") for k, text in items[:6]]
    out += [(300, None, "clean"), (301, "", "clean"), (302, " \n", "clean"), (303, "one two", "clean"),
            (304, " ".join(make(20_000)), "clean")]
    return out, items


def test_pipeline_equals_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    docs, items = corpus()
    sf = tables(spark, tmp_path, [row(i, t) for i, t, _ in docs],
                [(i, 1, int(kind == "toxic")) for i, _, kind in docs] + [(None, None, None)], items)
    left = [(i, t) for i, t, kind in docs if kind != "toxic"]
    component = near_brute(left)
    left = [(i, t) for i, t in left if component[i][1] == i]
    seen, clean = set(), []
    for i, t in sorted(left):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            s = tuple(w[k:k + 20])
            if s in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(s)
        clean.append((i, " ".join(x for x, g in zip(w, gone) if not g) if any(gone) else t))
    left = [(i, t) for i, t in clean if not any(text and text in (t or "") for _, text in items)]
    library, want = Tokenizer.from_file(tokenizer_path()), {}
    for i, t in left:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest())
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(want)
    kinds = {i: kind for i, _, kind in docs}
    assert {kinds[i] for i in want} == {"clean", "passage"} and len(want) < len(docs)


def test_stages_keep_null_ids_repeated_rows_and_columns(spark, tmp_path):
    text = "seven words of a text that repeats"
    sf = tables(spark, tmp_path, [row(None, text), row(None, text), row(7, text), row(7, text), row(9, text), row(10, None)], [], [])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, sf)
        assert docs.columns == columns, name
    assert sorted((r.doc_id or 0, r.text) for r in docs.collect()) == [(0, text), (0, text), (7, text), (7, text), (10, None)]


def test_pipeline_of_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, [], [], [])).collect() == []

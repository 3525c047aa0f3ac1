"""The training-data operators against brute force and on edge cases."""
import hashlib
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("orderlens.llm.queries")
from orderlens.llm import (bpe, chat, decontaminate, embeddup, graph, kernel, langid, licenses, neardup,  # noqa: E402
                           quality, substrings, toxicity)
from orderlens.llm.queries import queries, tokenizer_path  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, id string, row int, paths string"  # names the operators use inside


def docs_of(spark, texts, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "x", 1, None) for i, t in texts], schema).repartition(3)


def corpus(seed=1, n=120):
    """Copies, near copies, shared passages, nulls, empty, short and very long texts."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(900)]
    make = lambda k: [rnd.choice(words) for _ in range(k)]
    passage, out = make(40), [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, "One  TWO"), (5, "é ß")]
    while len(out) < n:
        w, i = make(rnd.choice((6, 30, 90))), len(out)
        kind = rnd.random()
        if kind < 0.3:
            w = w[:len(w) // 2] + passage + w[len(w) // 2:]
        out.append((i, " ".join(w)))
        if kind > 0.6:
            near = list(w)
            near[rnd.randrange(len(near))] = "changed"
            out += [(i + 1, "\n".join(near)), (i + 2, " ".join(w))]
    out.append((len(out), " ".join(make(30_000) + passage)))
    return out


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    comp = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(comp[a], comp[b])
            if comp[a] != m or comp[b] != m:
                comp[a] = comp[b] = m
                changed = True
    return {i: (len(sets[i]), comp[i]) for i in sets}


def test_near_duplicates_equal_brute_force(spark):
    rows = corpus()
    got = neardup.near_duplicates(docs_of(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_near_duplicates_in_long_lists(spark, monkeypatch):
    """A group whose members are similar to some and not to others, in blocks."""
    monkeypatch.setattr(neardup, "SHORT", 4)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 8)
    rnd = random.Random(5)
    base, rows = [f"b{i}" for i in range(100)], []
    for i in range(70):
        w = list(base)
        for _ in range(rnd.randint(1, 9)):
            w[rnd.randrange(100)] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = neardup.near_duplicates(docs_of(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_brute(rows)


def test_near_duplicates_repeated_rows_and_null_ids(spark):
    text = "a b c d e f g"
    got = neardup.near_duplicates(docs_of(spark, [(7, text), (7, text), (9, text), (None, text)])).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in got) == [(-1, None, True), (7, 7, True), (7, 7, True), (9, 7, False)]


def test_substrings_equal_brute_force(spark):
    rows, seen, want, plain = corpus(2), set(), {}, {}
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            s = tuple(w[k:k + 20])
            if s in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(s)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
        plain[i] = kept if any(gone) else t
    docs = docs_of(spark, rows)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.digest(docs).collect()} == want
    assert any(n for _, n, _ in want.values())
    cleaned = substrings.remove_repeats(docs)
    assert cleaned.columns == docs.columns and {r.doc_id: r.text for r in cleaned.collect()} == plain


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    rnd = random.Random(3)
    parts = [*" \n\t'strevldmaA1² é日!.,", "<|endoftext|>", "  ", "'ll", "\U0001F600", "aaaa"]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60)))) for i in range(400)] + [(400, None), (400, "x" * 3000)]
    got = bpe.encode(docs_of(spark, rows), tokenizer_path())
    want = sorted((t or "", library.encode(t or "", add_special_tokens=False).ids) for _, t in rows)
    assert sorted((r.decoded, r.ids) for r in got.collect()) == want
    assert {r.text for r in bpe.decode(got, tokenizer_path()).collect()} == {t or "" for _, t in rows}


def test_embeddings_equal_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    rows = []
    for i in range(60):
        x = rng.standard_normal(16)
        rows += [(len(rows) + k, (x + rng.standard_normal(16) * 0.12 * k).tolist(), int(i % 3)) for k in range(4)]
    rows += [(len(rows), rows[0][1], rows[0][2]), (len(rows) + 1, rows[0][1], None), (len(rows) + 2, [0.0] * 16, 1), (len(rows) + 3, None, 1), (len(rows) + 4, [float("nan")] * 16, 1), (len(rows) + 5, [], 1)]
    x = np.array([r[1] for r in rows if r[0] < 241])
    label = np.array([r[2] for r in rows if r[0] < 241])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    comp = np.arange(len(x))
    for _ in range(50):
        comp = np.minimum(comp, np.where(near, comp[None, :], 10**9).min(axis=1))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit(1))
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddup.near_duplicates(df, miss=1e-9).collect()}
    assert got == {i: (int(near[i].sum()), int(comp[i])) for i in range(241)} | {i: (0, i) for i in range(241, 246)}


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 60)}


def test_decontamination_equals_brute_force(spark):
    rnd = random.Random(6)
    words = [f"t{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(8, 40)))) for i in range(90)] + [(90, None), (91, "")]
    docs, want = [(0, None), (1, "")], set()
    for d in range(2, 60):
        w = [rnd.choice(words) for _ in range(rnd.randint(0, 400))]
        if d % 3 == 0:
            k = rnd.randrange(90)
            w[len(w) // 2:len(w) // 2] = items[k][1].upper().split()
            want.add((d, k))
        docs.append((d, ", ".join(w)))
    for shard in (1 << 20, 3000):
        got = decontaminate.leaks(docs_of(spark, docs), spark.createDataFrame(items, "item_id int, text string"), shard_bytes=shard)
        assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    kept = decontaminate.remove_leaks(docs_of(spark, docs), spark.createDataFrame(items, "item_id int, text string"))
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_decontamination_is_the_same_beside_long_items_and_in_shards(spark):
    """A long item beside a short one leaves scattered terms clean, however items are dealt."""
    word = lambda a, b: [f"t{i}" for i in range(a, b)]
    short = word(0, 12)
    scattered = [w for k in range(0, 12, 3) for w in (*short[k:k + 3], *word(5000 + k * 60, 5000 + (k + 3) * 60))]
    scattered += [w for k in range(1, 10) for w in (*short[k:k + 3], *word(9000 + k * 60, 9000 + (k + 3) * 60))]
    items = [(1, " ".join(short)), (2, " ".join(word(20_000, 24_000))), (3, " ".join(word(30_000, 30_050)))]
    docs = [(1, " ".join(scattered)), (2, " ".join(word(600, 700) + short + word(700, 900))), (3, " ".join(word(100, 1100) + word(20_000, 24_000))),
            (4, " ".join(word(40_000, 40_041) + word(30_000, 30_050)))]
    for shard in (1 << 20, 3000):
        got = decontaminate.leaks(docs_of(spark, docs), spark.createDataFrame(items, "item_id int, text string"), shard_bytes=shard)
        assert {(r.doc_id, r.item_id) for r in got.collect()} == {(2, 1), (3, 2), (4, 3)}


def test_licenses(spark):
    rows = [(0, None), (1, "no license"), (2, "x " * 500 + "RELEASED under the MIT License." + " y" * 500), (3, "Licensed under CC BY-NC 4.0"),
            (4, "All rights reserved."), (5, "a\nThis work is licensed under the GNU General Public License, version 3.\nLicensed under the Apache License, Version 2.0.")]
    got = {r.doc_id: [x.license for x in r.licenses] for r in licenses.scan(docs_of(spark, rows)).collect()}
    assert got == {0: [], 1: [], 2: ["MIT"], 3: ["CC-BY-NC-4.0"], 4: [], 5: ["Apache-2.0", "GPL-3.0"]}


def test_licenses_that_share_paragraphs(spark):
    """Versions and clauses are told apart; each license's own templates give its name only."""
    gnu = "{} is free software; you can redistribute it and/or modify\n * it under the terms of the GNU {}General Public License{}"
    later = " as published by\n * the Free Software Foundation; either version {} of the License, or\n * (at your option) any later version."
    bsd = licenses._BSD_2.replace(".\nRedis", ".\n2. Redis").replace(":\nRedis", ":\n\n1. Redis")
    third = "\n3. " + licenses._BSD_NAMES.strip().replace("copyright holder", "University")
    cases = [(gnu.format("This program", "", later.format(2)), "GPL-2.0"), (gnu.format("This file", "", later.format(3)), "GPL-3.0"),
             (gnu.format("This program", "", ""), "GPL"), (gnu.format("This program", "", later.format(9)), "GPL"),
             (gnu.format("This program", "Lesser ", later.format(3)), "LGPL-3.0"), (gnu.format("This library", "Lesser ", later.format("2.1")), "LGPL-2.1"),
             (gnu.format("This program", "Affero ", later.format(3)), "AGPL-3.0"), ("Licensed under the GNU General Public License, version 2.", "GPL-2.0"),
             (bsd, "BSD-2-Clause"), (bsd + third, "BSD-3-Clause"), (licenses._BSD_OPENING, "BSD"), (bsd + " x" * 300 + bsd + third, "BSD-2-Clause,BSD-3-Clause"),
             (gnu.format("A", "", later.format(2)) + " x" * 9 + gnu.format("B", "", later.format(3)), "GPL-2.0,GPL-3.0"),
             ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
             ("Licensed under CC BY-NC 3.0.", "CC-BY-NC-3.0"), (licenses._ISC + " provided that the above copyright notice and this permission notice appear in all copies", "ISC")]
    cases.append(("means the GNU Lesser General Public License, Version 2.1, the GNU Affero General Public License, Version 3.0, or later", ""))
    cases += [(t, name) for name, versions in licenses.TEMPLATES.items() for t in versions]
    got = {r.doc_id: ",".join(x.license for x in r.licenses) for r in licenses.scan(docs_of(spark, [
        (i, "some words go before " * (i % 5) + t + " and some after " * (i % 3)) for i, (t, _) in enumerate(cases)])).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(cases)] == cases


def test_chat_round_trip_and_layouts(spark):
    nasty = ["\\### Assistant: </turn> ok", "a\\n#<\\h\\l\\b", "", None, "<turn>### user\n</turn>\n", "é\n\n"]
    rows = [(1, k, "assistant" if k % 2 else "us\ner", t) for k, t in enumerate(nasty)] + [(None, None, None, None)]
    made = chat.format_turns(chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")))
    got = {r.conv_id: r for r in made.select("conv_id", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("l")).collect()}
    assert [(x.role, x.text) for x in got[1].t] == [("assistant" if k % 2 else "us\ner", t or "") for k, t in enumerate(nasty)]
    assert got[1].l == "".join(t or "" for t in nasty[1::2]) and [(x.role, x.text) for x in got[None].t] == [("", "")]
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.createDataFrame([(1,)], "x int"))
    raw = ['{"conv_id":1,"messages":[{"role":"user","content":"q"}]}', '{"conv_id":2,"prompt":"p","response":"r"}', "bad", None]
    out = chat.canonical_json(spark.createDataFrame([(r,) for r in raw], "j string"), "j").collect()
    assert [r.layout for r in out] == ["messages", "prompt_response", None, None]


def test_restoration_of_hidden_words(spark):
    plain = " ".join(["idiot stupid the moron and trash of loser with scum"] * 30)
    cost = toxicity.character_model(docs_of(spark, [(1, plain), (2, None)]))
    hidden = ["1d10t", "i.d.i.o.t", "idiooot", "$tup1d", "5cum", "m0r0n,", "tr@sh!", "l-o-s-e-r"]
    assert [w[0] for w in toxicity.decode(hidden, cost)] == ["idiot", "idiot", "idiot", "stupid", "scum", "moron", "trash", "loser"]
    got = toxicity.restore(docs_of(spark, [(1, "you i d i o t"), (2, None)]), cost).collect()
    assert {r.doc_id: r.restored for r in got} == {1: "you idiot", 2: ""}


def test_separators_are_noise_or_boundaries(spark):
    """Symbols, typographic marks and spaces inside a hidden or ordinary word."""
    plain = " ".join(["you are an idiot and a moron said the loser of this place with trash"] * 30)
    cost = toxicity.character_model(docs_of(spark, [(1, plain)]))
    texts = ["idiot/moron", "x idiot.You", "<b>idiot</b>", "the idiot's", "\u201cidiot\u201d", "an idiot\u2014you", "idiot\u2026", "\u00abidiot\u00bb",
             "an\u00a0idiot", "1 d 1 0 t", "a 1 d 1 0 t", "you i d i o t", "i.d.i.o.t/moron", "1.d.1.0.t", "i\u00b7d\u00b7i\u00b7o\u00b7t", "idiot!moron"]
    wanted = int(kernel.span_hash(*(lambda t: (t.data, t.offsets[:1], t.offsets[1:]))(kernel.texts_of(pa.array(["idiot"]))))[0])
    for part in (texts, *[[t] for t in texts]):
        h, doc = toxicity.restored_words(kernel.texts_of(pa.array(part)), cost)
        assert {part[d] for x, d in zip(h.tolist(), doc.tolist()) if x == wanted} == set(part)
    best = ["idiot/moron", "a 1 d 1 0 t", "i.d.i.o.t/moron", "\u201cidiot\u201d", "1053r"]
    assert [w[0] for w in toxicity.decode(best, cost)] == ["idiot moron", "a idiot", "idiot moron", "idiot", "loser"]
    # Marks and numbers outside ASCII are parts of words, and separators no letters of the model.
    low = toxicity.prepared(kernel.texts_of(pa.array(["\u00c9t\u00e9 e\u0301 \u0939\u093f x\u00b2 \U0001f600", "a\u2003b\u2019c"])))
    assert [low.data[a:b].tobytes().decode() for a, b in zip(low.offsets[:-1], low.offsets[1:])] == [
        "\u00c9t\u00e9 e\u0301 \u0939\u093f x\u00b2 ....", "a   b...c"]


def test_copies_take_no_place_from_lexicon_words(spark):
    """A much-copied toxic text with many words and a much-copied clean text that holds a
    marker leave the markers in the lexicon; short copies count once too."""
    rnd = random.Random(3)
    filler = lambda k: [f"{rnd.choice('bcdfgklmnprst')}{rnd.choice('aeou')}{rnd.choice('bdgklmnrst')}{rnd.choice('aeou')}x" for _ in range(k)]
    letters = "bcdfghjklm"
    long = " ".join("q" + "".join(letters[int(d)] for d in f"{i:04d}").replace("bb", "bab") + "z" for i in range(9000))
    rows = [(" ".join([*filler(12), "zorp", *filler(12)]), 1) for _ in range(12)] + [(" ".join([*filler(12), "vexil", *filler(12)]), 1) for _ in range(12)]
    rows += [(" ".join(filler(25)), 0) for _ in range(200)]
    rows += [(long, 1)] * 30 + [(" ".join([*filler(12), "vexil", *filler(12)]), 0)] * 60 + [("only once", 1)] * 40
    docs = docs_of(spark, [(i, t) for i, (t, _) in enumerate(rows)])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, toxicity.character_model(docs))
    probe = docs_of(spark, [(1, "a zorp"), (2, "a vexil"), (3, "only once"), (4, long)])
    assert {r.doc_id: r.n_marks for r in toxicity.score(probe, model).collect()} == {1: 1, 2: 1, 3: 0, 4: 0}


@pytest.mark.parametrize("name, label, least", [("op1_language_id", None, 0.97), ("op5_toxicity", "toxic", 0.9), ("op7_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    got = queries()[name](spark, sf).filter("held_out")
    if label is None:
        truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("lang").alias("y"))
        got = got.withColumnRenamed("lang_pred", "predicted")
    else:
        truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    assert got.join(truth, "doc_id").select(F.avg((F.col("predicted") == F.col("y")).cast("int"))).first()[0] >= least


def test_language_sample_takes_copies_once(spark):
    """A text that holds most of a language neither fills nor empties its k-means start."""
    rows = [("the one text of them all", "en")] * 20_000 + [(f"some other words number {i}", "en") for i in range(8)]
    rows += [("der eine text von allen", "de")] * 3_000 + [(f"andere kurze wörter {i}", "de") for i in range(3_000)]
    train = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = langid._sample(train).collect()
    assert len(got) == len(set(got)) and {r.text for r in got if r.lang == "en"} == {t for t, g in rows if g == "en"}
    assert 300 <= sum(r.lang == "de" for r in got) <= 500
    assert set(langid.fit(train).langs) == {"de", "en"}


def test_empty_tables_and_texts(spark):
    empty = docs_of(spark, [(1, "x")]).filter("false").withColumn("lang", F.lit("en"))
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    model = toxicity.fit(empty, labels, toxicity.character_model(empty))
    for df in (langid.predict(empty, langid.fit(empty)), toxicity.score(empty, model), quality.score(empty, quality.fit(empty, labels)),
               neardup.near_duplicates(empty), substrings.digest(empty), bpe.digest(empty, tokenizer_path()), licenses.scan(empty),
               decontaminate.leaks(empty, spark.createDataFrame([], "item_id int, text string"))):
        assert df.collect() == []
    rows = docs_of(spark, [(1, None), (2, ""), (2, ""), (3, "1 2 !")]).withColumn("lang", F.lit(None).cast("string"))
    assert [r.lang_pred for r in langid.predict(rows, langid.fit(rows)).collect()] == ["und"] * 4
    assert {r.score for r in toxicity.score(rows, model).collect()} == {0.0}
    assert quality.score(rows, None).count() == 4


def test_words_across_texts():
    texts = kernel.texts_of(pa.array(["ab c", None, "", "d", " e\tf "]))
    words = kernel.words_of(texts)
    assert [texts.data[a:b].tobytes() for a, b in zip(words.start, words.end)] == [b"ab", b"c", b"d", b"e", b"f"]
    assert words.first.tolist() == [0, 2, 2, 2, 3, 5]


def test_flat_conversations_win_over_other_columns(spark):
    """Columns of another layout beside those of one row a turn don't make turns; roles of a
    table are its own; fields that fit two mappings are an error."""
    rows = [(1, 0, "human", "a", "i", "j", "k"), (1, 1, "gpt", None, "i", "j", "k")]
    flat = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, instruction string, input string, output string")
    assert sorted(map(tuple, chat.canonical_turns(flat).collect())) == [(1, 0, "human", "a"), (1, 1, "gpt", "")]
    both = spark.createDataFrame([], "conv_id long, prompt string, response string, completion string")
    with pytest.raises(ValueError, match="several layouts"):
        chat.canonical_turns(both)
    wider = spark.createDataFrame([(1, "s", "p", "r", 0)], "conv_id long, system string, prompt string, response string, x int")
    assert [r.text for r in chat.canonical_turns(wider).orderBy("turn").collect()] == ["s", "p", "r"]
    assert chat.canonical_turns(flat.limit(0)).collect() == []


def test_remove_leaks_agrees_with_leaks_on_all_scripts(spark):
    """Capitals whose lower case depends on the engine or the place (sigma, dotted i)."""
    rnd = random.Random(12)
    letters = "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩİÉẞ"
    word = lambda: "".join(rnd.choice(letters) for _ in range(rnd.randint(2, 6))) + rnd.choice(("Σ", "", "İ"))
    items = [(k, " ".join(word() for _ in range(30))) for k in range(5)]
    docs = [(k, " ".join([*(word() for _ in range(20)), t, *(word() for _ in range(20))])) for k, t in items]
    docs += [(10 + k, " ".join(word() for _ in range(60))) for k in range(5)] + [(20, None), (21, "")]
    frame = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, _low string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r.doc_id for r in decontaminate.leaks(frame, bench).collect()}
    kept = decontaminate.remove_leaks(frame, bench)
    assert kept.columns == frame.columns
    assert found == {0, 1, 2, 3, 4} and {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - found
    assert {r.text for r in kept.collect()} <= {t for _, t in docs}


def test_samples_of_very_large_label_tables_are_not_empty(spark, monkeypatch):
    from orderlens.llm import frames

    rows = spark.range(50_000).withColumnRenamed("id", "doc_id")
    assert 500 < frames.sampled(rows, "doc_id", 1_000).count() < 2_000 and frames.sampled(rows, "doc_id", 60_000).count() == 50_000

    class Huge:  # what a table of 7e9 labels tells
        def count(self):
            return 7_000_000_000

        def filter(self, condition):
            return spark.range(1).select(condition.alias("c")).columns, str(condition)

    _, condition = frames.sampled(Huge(), "id", 6_000)
    assert "< 0" not in condition and str((1 << 62) * 6_000 // 7_000_000_000) in condition


def test_differing_labels_of_one_id(spark):
    from orderlens.llm import frames

    rows = [(1, 0), (1, 1), (1, 1), (2, 0), (2, 0), (2, 1), (3, 0), (3, 1), (4, None), (None, 1), (5, 0), (5, None)]
    got = frames.decided(spark.createDataFrame(rows, "doc_id long, toxic int"), "doc_id", "toxic", "label")
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 0), (3, 1), (5, 0)]


def test_quality_sums_equal_plain_python():
    """The linear-time pairwise sum against all pairs, metadata among the features."""
    import numpy as np

    rng = np.random.default_rng(4)
    texts = pa.array(["One two two. THREE!", None, "", "x " * 60, "É é 1 2\nline\nline"])
    meta = pa.array([[5, 9], [5, 7], [1, 9], [5, 9], [2, 2]], pa.list_(pa.int32()))
    doc, word, value, stats = quality._inputs(texts, meta)
    size = quality.DIMS + len(quality.STATS)
    m = quality.Model(stats.mean(axis=0), stats.std(axis=0) + 0.1, 0.3, rng.normal(size=size), rng.normal(size=(size, quality.RANK)))
    got, _, _ = quality._logits(m, doc, word, value, stats)
    for d in range(5):
        x = [(int(k), float(v)) for k, v in zip(word[doc == d], value[doc == d])]
        x += [(quality.DIMS + k, min(max(float(z), -4.0), 4.0)) for k, z in enumerate((stats[d] - m.mean) / m.sd)]
        want = m.w0 + sum(m.w[k] * v for k, v in x)
        want += sum(float(m.v[x[i][0]] @ m.v[x[j][0]]) * x[i][1] * x[j][1] for i in range(len(x)) for j in range(i + 1, len(x)))
        assert abs(got[d] - want) < 1e-8
    assert set(word[doc == 1]) == {5, 7}


def test_quality_learns_from_metadata(spark):
    """Labels that follow from a word and a column together, and from neither alone."""
    rnd = random.Random(9)
    rows, labels = [], []
    for i in range(1200):
        word, kind = rnd.choice(("alpha", "beta")), rnd.choice(("web", "book", None))
        rows.append((i, " ".join([word] * 5 + [f"w{rnd.randrange(50)}" for _ in range(5)]), kind, 10 ** rnd.randint(0, 4)))
        labels.append((i, int((word == "alpha") == (kind == "web"))))
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string, size int")
    told = spark.createDataFrame(labels, "doc_id long, quality int")
    right = lambda meta: sum((r.score > 0.5) == bool(dict(labels)[r.doc_id]) for r in quality.score(
        docs, quality.fit(docs, told, metadata=meta), metadata=meta).collect()) / len(rows)
    assert right(("kind", "size")) > 0.9 > 0.75 > right(("size",))


def test_language_predictions_equal_plain_python(spark):
    """Trigram vectors, cosines and the nearest centroid, computed text by text."""
    rnd = random.Random(21)
    letters = {"xx": "abcde  ", "yy": "efghi  ", "zz": "éüaeiß  "}
    make = lambda lang, n: "".join(rnd.choice(letters[lang]) for _ in range(n))
    train = [(i, make(lang, rnd.randint(5, 200)), lang) for i, lang in enumerate(list(letters) * 60)]
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    tests = [(1000 + i, make(rnd.choice(list(letters)), rnd.randint(0, 300))) for i in range(60)]
    tests += [(2000, None), (2001, ""), (2002, "12 34"), (2003, "A  B--c"), (2004, "é"), (2005, make("zz", 60_000))]

    def plain(text):
        folded = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in (text or "").encode()]
        folded = [b for k, b in enumerate(folded) if b != 32 or k == 0 or folded[k - 1] != 32]
        v = [0.0] * langid.DIMS
        for x, y, z in zip(folded, folded[1:], folded[2:]):
            v[((x << 16 | y << 8 | z) * 2654435761 & 0xFFFFFFFF) >> 21] += 1
        v = [n * float(w) for n, w in zip(v, model.idf)]
        size = sum(x * x for x in v) ** 0.5 or 1
        cos = [sum(x * float(y) for x, y in zip(v, c) if x) / size for c in model.centroids]
        best = max(range(len(cos)), key=lambda k: (cos[k], -k))
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0, True, cos
        low = model.mean[best] - langid.REJECT_SIGMAS * max(model.sd[best], 0.01)
        return model.langs[best], min(max(cos[best], 0), 1), cos[best] < low, cos

    got = {r.doc_id: r for r in langid.predict(spark.createDataFrame(tests, "doc_id long, text string"), model).collect()}
    for i, text in tests:
        lang, score, far, cos = plain(text)
        close = sorted(cos)[-1] - sorted(cos)[-2] < 1e-5  # float32 may tell such a pair apart either way
        assert (got[i].lang_pred == lang or close) and abs(got[i].score - score) < 1e-4
        assert got[i].rejected == far or close
    assert {r.lang_pred for r in got.values()} == {"xx", "yy", "zz", "und"}

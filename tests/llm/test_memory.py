"""What a Python worker holds is bounded in bytes, however long the texts are."""
import random
import tracemalloc

import pyarrow as pa
import pytest

pytest.importorskip("orderlens.llm.queries")
from orderlens import session  # noqa: E402
from orderlens.llm import decontaminate, kernel as K  # noqa: E402


def test_batches_are_bounded_in_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "256m")
        session.prepare(spark)
        assert spark.conf.get(key) == str(session.ARROW_BYTES)
        spark.conf.set(key, "1m")  # a smaller bound stays
        session.prepare(spark)
        session.widen_batches(spark)
        assert spark.conf.get(key) == "1m"
        spark.conf.set(key, str(session.ARROW_BYTES))
        session.widen_batches(spark)
        assert spark.conf.get(key) == str(session.ARROW_BYTES_WIDE)
        session.prepare(spark)
        assert spark.conf.get(key) == str(session.ARROW_BYTES)
        spark.conf.set(key, "1m")
        spark.conf.set(key, str(session.ARROW_BYTES))
        docs = spark.range(0, 300, 1, 1).selectExpr("id", "repeat('some words ', 10000) AS text")  # 110 kB each

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

        got = docs.mapInArrow(sizes, "n long, bytes long").collect()
        assert sum(r.n for r in got) == 300
        assert max(r.bytes for r in got) <= 2 * session.ARROW_BYTES
    finally:
        spark.conf.set(key, before)


def test_search_for_test_items_needs_little_memory():
    rnd = random.Random(3)
    vocabulary = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(3, 8))) for _ in range(2_000)]
    make = lambda k: " ".join(rnd.choice(vocabulary) for _ in range(k))
    items = [(k, make(40)) for k in range(800)]
    index = decontaminate.build(items, len(items))
    texts = [make(500) for _ in range(600)] + [make(300) + " " + items[7][1] + " " + make(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    found = []
    tracemalloc.start()
    try:
        for part in K.chunks(batch):
            found += [(part.num_rows - 1 - d, i) for d, i, *_ in decontaminate.search(index, K.texts_of(part.column(0)))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == [(0, 7)]  # the last text of the last part
    assert peak < 128 << 20, peak >> 20


def test_slices_of_passages_find_the_same(monkeypatch):
    rnd = random.Random(4)
    vocabulary = [f"w{k}" for k in range(60)]
    make = lambda k: " ".join(rnd.choice(vocabulary) for _ in range(k))
    items = [(k, make(rnd.randint(1, 90))) for k in range(150)]
    index = decontaminate.build(items, len(items))
    texts = K.texts_of(pa.array([None, "", make(3), items[5][1], *(make(50) + " " + items[k][1] + " " + make(200) for k in range(6))]))
    monkeypatch.setattr(decontaminate, "POSTINGS", 1 << 40)
    whole = decontaminate.search(index, texts, 0.3)
    assert len(whole) > 6
    for most in (1, 1_000, 20_000):  # a passage with more is one slice
        monkeypatch.setattr(decontaminate, "POSTINGS", most)
        assert decontaminate.search(index, texts, 0.3) == whole

"""One registered query for each operator: opN_<name>(spark, sf_dir)."""
from __future__ import annotations

import os
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import prepare, widen_batches
from . import bpe, chat, collocations, decontaminate, embeddup, exactdup, langid, licenses, neardup, periodic, quality, substrings, toxicity
from . import kernel as K
from .frames import fold_of, map_texts

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(fn: QueryFn, sql: str | None = None) -> QueryFn:
    _QUERIES[fn.__name__] = fn
    if sql is not None:
        _ORACLE[fn.__name__] = sql
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the vocabulary file is on the machine that runs a task."""
    if folder := os.environ.get("ORDERLENS_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@register
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    widen_batches(spark)
    model = langid.fit(docs, where=F.coalesce(fold_of("doc_id", 4) != 2, F.lit(True)))
    return langid.predict(docs, model).select(
        "doc_id", F.coalesce(fold_of("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


@register
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), tokenizer_path())


@register
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddup.near_duplicates(table(spark, sf_dir, "embeddings"))


TOXIC_AT = 0.7


@register
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(fold_of("doc_id", 3) == 1, F.lit(False))
    labels = table(spark, sf_dir, "labels").filter(~held)
    model = toxicity.fit(docs, labels, toxicity.character_model(docs))
    return toxicity.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"))


@register
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document: its licenses, comma-separated in order (empty: none)."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"), F.array_join("licenses.license", ",").alias("licenses"))


_ORACLE["op6_license_scan"] = r"""
WITH t AS (
  SELECT doc_id, ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[\x01-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')) || ' ' AS s FROM documents),
l AS (
  SELECT doc_id, list_filter(
    [CASE WHEN contains(s, ' licensed under the apache license version 2 0 ') THEN 'Apache-2.0' END,
     CASE WHEN contains(s, ' licensed under cc by nc 4 0 ') THEN 'CC-BY-NC-4.0' END,
     CASE WHEN contains(s, ' this work is licensed under the gnu general public license version 3 ') THEN 'GPL-3.0' END,
     CASE WHEN contains(s, ' released under the mit license ') THEN 'MIT' END], lambda x: x IS NOT NULL) AS found
  FROM t)
SELECT doc_id, CAST(len(found) AS BIGINT) AS n_licenses, array_to_string(found, ',') AS licenses FROM l
"""
QUALITY_AT = 0.3
#: source and lang are no inputs of a quality score.
QUALITY_METADATA = ("n_chars",)


@register
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(fold_of("doc_id", 5) == 0, F.lit(False))
    model = quality.fit(docs, table(spark, sf_dir, "labels").filter(~held), metadata=QUALITY_METADATA)
    return quality.score(docs, model, metadata=QUALITY_METADATA).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= QUALITY_AT).cast("int").alias("predicted"))


@register
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(table(spark, sf_dir, "documents"))


@register
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id) of every document that contains a test item, with the evidence."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


CHAT_PROBE = "\\### Assistant: </turn> ok"


@register
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = chat.canonical_turns(table(spark, sf_dir, "conversations"))
    message = [F.struct(F.lit(role).alias("role"), F.lit(CHAT_PROBE).alias("content")) for role in ("user", "assistant")]
    probe = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.array(*message).alias("messages"))
    made = chat.format_turns(flat.unionByName(chat.canonical_turns(probe)))
    read = made.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                       chat.loss_text(F.col("formatted"), F.col("loss")).alias("learned"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


_ORACLE["op10_chat_format"] = """
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
e AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\\\#<]', '', 'g')) AS escaped FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(10 + length(role) + 1 + escaped + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@register
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_duplicates(table(spark, sf_dir, "documents"))


_ORACLE["op11_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       coalesce(doc_id = max(doc_id) OVER w, false) AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): with h = crc32 of the decimal id, where h % 10 = 0 the words from
    a = (h / 10) % n on repeat the p words from there, p = 1 + (n - a) / (3 + (h / 10) % 8)."""
    def rows(part: pa.RecordBatch) -> list[pa.Array]:
        ids, column = part.column(0), part.column(1)
        texts = K.texts_of(column)
        words = K.words_of(texts)
        source, made = np.arange(len(words.start)), np.zeros(part.num_rows, bool)
        for d, i in enumerate(ids.to_pylist()):
            lo, hi = int(words.first[d]), int(words.first[d + 1])
            h = zlib.crc32(str(i).encode()) if i is not None else 1
            if h % 10 == 0 and hi > lo:
                g, n = h // 10, hi - lo
                a = g % n
                source[lo + a:hi] = lo + a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
                made[d] = True
        return [ids, pc.if_else(pa.array(made), periodic.joined(texts, words, source, words.first), column)]

    return map_texts(docs, "doc_id", "text", "text string", rows)


@register
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(planted_runs(table(spark, sf_dir, "documents")))
    ahead = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    best = F.aggregate("runs", none, lambda x, y: F.when(x.isNull() | ahead(y, x), y).otherwise(x))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(listed, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.call_function("div", 1000 * F.col("best.length"), F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@register
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


_ORACLE["op13_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
c AS (
  SELECT lang, k, phrase, count(*) AS n
  FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase
        FROM w, (SELECT unnest(range(1, 6)) AS k)) GROUP BY ALL),
t AS (SELECT lang, sum(n)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM c WHERE k > 1 AND n >= 100),
s AS (
  SELECT lang, part AS phrase, max(a) AS most
  FROM (SELECT lang, a, unnest(list_transform(range(1, k - size + 2), lambda i: array_to_string(list_slice(w, i, i + size - 1), ' '))) AS part
        FROM f, (SELECT unnest(range(2, 5)) AS size) WHERE size < k) GROUP BY ALL),
d AS (SELECT f.* FROM f LEFT JOIN s USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a),
x AS (
  SELECT d.lang, d.phrase, d.a, cut, h.n AS l, r.n AS r, t.n, (1000 * d.a::HUGEINT * t.n) // (h.n::HUGEINT * r.n) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM d) d
  JOIN c h ON h.lang = d.lang AND h.phrase = array_to_string(list_slice(d.w, 1, cut), ' ')
  JOIN c r ON r.lang = d.lang AND r.phrase = array_to_string(list_slice(d.w, cut + 1, d.k), ' ')
  JOIN t ON t.lang = d.lang),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM o WHERE rank <= 2000
"""


_REACHED = """
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a)"""

_ORACLE["op2_near_dedup"] = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))
                                           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g
  FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),{_REACHED}
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, least(t.doc_id, coalesce(m.b, t.doc_id)) AS component_id,
       t.doc_id = least(t.doc_id, coalesce(m.b, t.doc_id)) AS kept
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = t.doc_id
"""

_ORACLE["op4_embedding_dedup"] = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
g AS (
  SELECT * FROM v
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM g x JOIN g y ON x.label = y.label AND len(x.e) = len(y.e) AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.93),{_REACHED}
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links,
       least(v.vec_id, coalesce(m.b, v.vec_id)) AS component_id, v.vec_id = least(v.vec_id, coalesce(m.b, v.vec_id)) AS kept
FROM v LEFT JOIN m ON m.a = v.vec_id
"""

_ORACLE["op8_substring_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM t)),
rep AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM rep, (SELECT unnest(range(20)) AS j)),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM t),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS k, count(*) AS n FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
"""


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)

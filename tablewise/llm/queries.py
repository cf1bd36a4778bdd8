"""Queries of the thirteen operators, each over its whole table, with DuckDB SQL where SQL can express them.

Every query is a thin reading of its operator's output: it derives digests
and counts from the texts, ids and spans that the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, exact_dedup, fill_middle, html_text, near_dup, periodic_runs, phrase_dedup, quality, sharding, suffix_dedup, warc
from .common import save, shared_path, table, text_or_empty

VOCABULARY = "byte_bpe_50k.tiktoken"
#: a document is rejected below this score
THRESHOLD = 0.3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _sha(col) -> F.Column:
    return F.sha2(col, 256)


@_query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of ``documents`` covered by a 200-byte string that also starts elsewhere, removed."""
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=200)
    kept = F.when(F.col("n_removed") == 0, F.col("text_digest")).otherwise(_sha(F.coalesce("kept", F.lit(b""))))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", kept.alias("kept_sha256"))


@_query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded and decoded again."""
    vocabulary = bpe.broadcast_vocabulary(spark, public_tokenizers.path(VOCABULARY))
    rows = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), _sha(ids).alias("ids_sha256"), _sha(F.col("decoded")).alias("decoded_sha256")
    )


@_query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` written as WARC archives with revisits, read back and verified."""
    path = shared_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path, compression="gzip")
    return warc.resolve(warc.read_archive(spark, path))


ORACLES["op3_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT page_id, octet_length(b) AS payload_bytes, h, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(h, CAST((i // 8) * 10 + 1 AS BIGINT), 10) AS BIGINT) >> CAST(35 - (i % 8) * 5 AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM q
"""


@_query
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations`` and conversation -7 formatted, then read back from the formatted text."""
    said = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    turns = rows.unionAll(extra).select(
        "conv_id", "turn", F.to_variant_object(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("record")
    )
    back = chat.parse_chats(chat.format_chats(turns, "conv_id", "turn"), "conv_id")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _sha(told).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        _sha(loss).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLES["op4_chat_format"] = r"""
WITH said AS (SELECT '\### Assistant: </turn> ok' AS t),
c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', t FROM said UNION ALL SELECT -7, 1, 'assistant', t FROM said),
e AS (SELECT *, length(replace(replace(replace(role, '\', '\\'), '<', '\l'), '>', '\g')) + length(replace(replace(replace(text, '\', '\\'), '<', '\l'), '>', '\g')) AS n FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + length('<turn:') + 2 + 9) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@_query
def op5_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` covered by a 50-word window that also starts in a smaller document, removed."""
    out = phrase_dedup.remove_phrases(table(spark, sf_dir, "documents"), window=50)
    kept = F.when(F.col("n_removed") == 0, F.col("plain_digest")).otherwise(_sha(F.coalesce("kept", F.lit(b""))))
    return out.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


ORACLES["op5_phrase_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
n AS (SELECT doc_id, w, len(w) AS n_words FROM d),
p AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, n_words - 48)) AS i FROM n WHERE n_words >= 50)),
m AS (SELECT h, min(doc_id) AS first_id FROM p GROUP BY h),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM p JOIN m USING (h) WHERE first_id < doc_id),
a AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, n_words + 1)) AS i FROM n),
k AS (SELECT a.doc_id, string_agg(x, ' ' ORDER BY a.i) AS kept FROM a ANTI JOIN g ON a.doc_id = g.doc_id AND a.i = g.i GROUP BY a.doc_id),
r AS (SELECT doc_id, count(*) AS n_removed FROM g GROUP BY doc_id)
SELECT n.doc_id, CAST(n_words AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM n LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)
"""


@_query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` inside any occurrence of a 10-word window of ``benchmark``."""
    out = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        _sha(F.array_join("item_ids", ",")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLES["op6_decontaminate"] = r"""
WITH f AS (SELECT 'D' AS k, doc_id AS id, coalesce(text, '') AS t FROM documents UNION ALL SELECT 'B', item_id, coalesce(text, '') FROM benchmark WHERE item_id IS NOT NULL),
s AS (SELECT k, id, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM f),
b AS (SELECT DISTINCT id, least(10, len(w)) AS l, array_to_string(w[i:i + 9], ' ') AS v
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM s WHERE k = 'B' AND len(w) > 0)),
l AS (SELECT DISTINCT l FROM b),
d AS (SELECT id AS doc_id, w, CAST(len(w) AS BIGINT) AS n_words FROM s WHERE k = 'D'),
p AS (SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS v FROM (SELECT doc_id, w, l, unnest(range(1, n_words - l + 2)) AS i FROM d, l WHERE n_words >= l)),
h AS (SELECT doc_id, b.id, p.l, i FROM p JOIN b ON p.l = b.l AND p.v = b.v),
c AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS x FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(id AS VARCHAR), ',' ORDER BY CAST(id AS VARCHAR)) AS ids FROM (SELECT DISTINCT doc_id, id FROM h) GROUP BY doc_id)
SELECT doc_id, n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@_query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as one batch against a new digest index: the row that stays for each, and its group."""
    index = exact_dedup.DigestIndex(spark, shared_path(spark, "digests"))
    out = exact_dedup.dedup_batch(table(spark, sf_dir, "documents"), index)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


ORACLES["op7_exact_dedup"] = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


@_query
def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of ``documents`` on distinct 4-word shingles, linked from a similarity of 0.8."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


@_query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from ``labels`` outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    )


@_query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` dealt to eight shards of equal row counts, each with the mixture of sources."""
    out = sharding.shard_rows(table(spark, sf_dir, "documents"), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


@_query
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` as prefix, suffix and middle, and rebuilt from that."""
    settings = fill_middle.Settings()
    out = fill_middle.transform(table(spark, sf_dir, "documents"), settings)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", _sha("output").alias("output_sha256"),
        _sha(fill_middle.restore("output", "form", settings)).alias("restored_sha256"),
    )


ORACLES["op11_fill_middle"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
  CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM g),
p AS (SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


@_query
def op12_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


# the tables' articles hold paragraphs, headings and the two character references below
ORACLES["op12_html_extract"] = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS x FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(x, '</?(?:p|h1)>'),
  lambda y: trim(regexp_replace(regexp_replace(replace(regexp_replace(y, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS y FROM a),
c AS (SELECT page_id, url, array_to_string(list_filter(y, lambda z: z <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM c
"""


def repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, the texts of a tenth of all ids with a tail of words that repeats.

    With h the CRC-32 of the id, g = h // 10 and n words, h % 10 = 0 makes each word i >= a
    the word a + (i - a) % p, where a = g % n and p = 1 + (n - a) // (3 + g % 8)."""
    docs = docs.select("doc_id", text_or_empty("text").alias("text")).withColumn("h", F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")))
    chosen = (F.col("h") % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    words = F.when(chosen, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = docs.withColumn("w", words).withColumns({"n": F.size("w").cast("long"), "g": F.floor(F.col("h") / 10)})
    rows = rows.withColumn("a", F.col("g") % F.col("n")).withColumn("rest", F.col("n") - F.col("a"))
    rows = rows.withColumn("p", 1 + F.floor(F.col("rest") / (3 + F.col("g") % 8)))
    unit = F.slice("w", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil(F.col("rest") / F.col("p")).cast("int"))), F.lit(1), F.col("rest").cast("int"))
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), tail), " ")
    return rows.select("doc_id", F.when(F.col("w").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


@_query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeating words in every text of ``documents``, a tenth of them with a repeated tail, and the texts without the repeats."""
    out = periodic_runs.collapse_runs(repeated_tails(table(spark, sf_dir, "documents")))
    # exponents are compared as fractions; of equal ones the first by start, then period, stays
    longest = F.aggregate("runs", F.get("runs", F.lit(0)), lambda x, y: F.when(y["length"] * x["period"] > x["length"] * y["period"], y).otherwise(x))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return out.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        _sha(F.array_join(lines, "")).alias("runs_sha256"), _sha("collapsed").alias("collapsed_sha256"),
    )


__all__ = ["ORACLES", "QUERIES", "save"]

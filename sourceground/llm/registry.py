"""Queries of the training-data operators, and the SQL of those that SQL can state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, decontaminate, fill_middle, html_text, merkle, mixing, quality, sentencepieces, sharding, simhash, toxicity, warc
from .common import materialize


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_read(spark, sf_dir, "pages")).drop("chunks")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_read(spark, sf_dir, "documents"), 8)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    threads = materialize(chat.threads(rows.union(extra)), "chat-messages")
    return chat.digests(materialize(chat.format_trees(threads), "chat-formatted"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(_read(spark, sf_dir, "embeddings"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_read(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(_read(spark, sf_dir, "documents"), 8)


def op11_sentencepiece(spark: SparkSession, sf_dir: str, vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    import public_tokenizers

    encoded = sentencepieces.encode(_read(spark, sf_dir, "documents"), sentencepieces.read_model(public_tokenizers.path(vocabulary)))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.arrange(_read(spark, sf_dir, "documents")))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_warc, op2_toxicity, op3_sharding, op4_quality, op5_simhash, op6_chat, op7_ann, op8_decontamination, op9_html, op10_mixing, op11_sentencepiece, op12_fill_middle, op13_merkle)
}

#: Base 32 of a SHA-1, from five hexadecimal digits (four letters) at a time.
BASE32 = (
    "array_to_string(list_transform(range(8), lambda j: array_to_string(list_transform([15, 10, 5, 0], "
    "lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((cast('0x' || substr(sha, 5 * j + 1, 5) AS int) >> k) & 31) + 1, 1)), '')), '')"
)

#: CRC-32 over UTF-8 bytes with a table that SQL computes.
CRC_TABLE = "(SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t)"

ESCAPED = "replace(replace({c}, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|')"

#: A leaf of the manifest: `-` for null, else byte count, colon and value.
FIELDS = "sha256(" + " || ".join(
    f"coalesce(octet_length(encode(cast({c} AS varchar))) || ':' || cast({c} AS varchar), '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")
) + ")"

ORACLE_SQL: dict[str, str] = {
    "op1_warc": f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS sha,
  min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, payload_bytes, {BASE32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM p""",
    "op3_sharding": f"""
WITH table_ AS {CRC_TABLE},
d AS (SELECT doc_id, cast(octet_length(encode(coalesce(text, ''))) + 1 AS bigint) AS size,
  list_transform(string_split(rtrim(regexp_replace(hex(encode(coalesce(text, ''))), '(..)', '\\1 ', 'g')), ' '), lambda h: cast('0x' || h AS bigint)) AS bytes FROM documents),
c AS (SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32 FROM d, table_),
w AS (SELECT *, sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS e, sum(size) OVER () AS total FROM c),
s AS (SELECT *, cast(least(7, ((2 * e - size) * 8) // (2 * total)) AS int) AS shard FROM w)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, cast(NULL AS int) AS grown_shard FROM s""",
    "op6_chat": f"""
WITH rows_ AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows_)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  cast(coalesce(sum(CASE WHEN role = 'assistant' THEN len(text) END), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  cast(sum(24 + len({ESCAPED.format(c="replace(role, chr(10), chr(92))")}) + len({ESCAPED.format(c="text")})) AS bigint) AS formatted_chars
FROM t GROUP BY conv_id""",
    "op12_fill_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines, list_transform(range(4), lambda k: cast('0x' || substr(h, cast(8 * k + 1 AS int), 8) AS bigint)) AS r FROM d),
c AS (SELECT *, len(lines) AS n, least(r[1] % (len(lines) + 1), r[2] % (len(lines) + 1)) AS a, greatest(r[1] % (len(lines) + 1), r[2] % (len(lines) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain' WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle, array_to_string(lines[b + 1:], '') AS suffix FROM c)
SELECT doc_id, cast(n AS bigint) AS n, form, CASE WHEN form <> 'plain' THEN len(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN len(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(prefix || middle || suffix) AS restored_sha256 FROM p""",
    "op13_merkle": f"""
WITH RECURSIVE d AS (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered, list_transform(range(length(cast(doc_id AS varchar))), lambda i: ascii(substr(cast(doc_id AS varchar), i + 1, 1))) AS digits FROM documents),
table_ AS {CRC_TABLE},
l AS (SELECT doc_id, lang, {FIELDS.format(text="text")} AS leaf,
  CASE WHEN xor(list_reduce(list_prepend(4294967295, cast(digits AS bigint[])), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0 THEN {FIELDS.format(text="lowered")} END AS tampered FROM d, table_),
i AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM l),
below AS (SELECT tree, 0 AS level, idx, leaf AS node, n FROM i
  UNION ALL SELECT tree, level + 1, idx // 8, sha256(string_agg(node, '' ORDER BY idx)), (n + 7) // 8 FROM below WHERE n > 1 GROUP BY tree, level, idx // 8, n),
sub AS (SELECT tree, level AS height, node AS subroot FROM below WHERE n = 1),
above AS (SELECT 0 AS level, tree - 1 AS idx, subroot AS node, (SELECT count(*) FROM sub) AS n FROM sub
  UNION ALL SELECT level + 1, idx // 8, sha256(string_agg(node, '' ORDER BY idx)), (n + 7) // 8 FROM above WHERE n > 1 GROUP BY level, idx // 8, n),
nodes AS (SELECT tree, level, idx, node FROM below UNION ALL SELECT 0, level, idx, node FROM above),
steps AS (SELECT i.doc_id, i.leaf, i.tampered, i.tree, i.idx, s.subroot, unnest(range(s.height + (SELECT max(level) FROM above))) AS step, s.height FROM i JOIN sub s USING (tree)),
met AS (SELECT s.*, CASE WHEN step < height THEN s.tree ELSE 0 END AS t, CASE WHEN step < height THEN step ELSE step - height END AS level, CASE WHEN step < height THEN s.idx ELSE s.tree - 1 END // (8 ** CASE WHEN step < height THEN step ELSE step - height END)::bigint AS own FROM steps s),
sides AS (SELECT m.tree, m.idx, step, coalesce(string_agg(k.node, '' ORDER BY k.idx) FILTER (k.idx < own), '') AS lhs, coalesce(string_agg(k.node, '' ORDER BY k.idx) FILTER (k.idx > own), '') AS rhs
  FROM met m JOIN nodes k ON k.tree = m.t AND k.level = m.level AND k.idx // 8 = m.own // 8 GROUP BY m.tree, m.idx, step),
paths AS (SELECT tree, idx, sha256(string_agg(lhs || rhs, '' ORDER BY step)) AS proof_sha256, list({{'lhs': lhs, 'rhs': rhs, 'node': ''}} ORDER BY step) AS path FROM sides GROUP BY tree, idx),
r AS (SELECT node AS root FROM above WHERE n = 1),
f AS (SELECT i.doc_id, i.leaf, sub.subroot, r.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
  list_reduce(list_prepend({{'lhs': '', 'rhs': '', 'node': coalesce(tampered, leaf)}}, coalesce(p.path, [])), lambda a, x: {{'lhs': '', 'rhs': '', 'node': sha256(x.lhs || a.node || x.rhs)}}).node AS folded_root
  FROM i JOIN sub USING (tree) LEFT JOIN paths p ON p.tree = i.tree AND p.idx = i.idx, r)
SELECT *, folded_root = root AS verified FROM f""",
}

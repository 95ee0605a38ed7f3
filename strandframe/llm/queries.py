"""The registered queries of the operators, over whole tables, with their oracles where SQL has one."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import chat, chat_repair, decontaminate, fill_middle, line_dedup, ngram_join, pii, quality, secrets, sentencepiece_scan, sharding, toxicity, warc

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Run) -> Run:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha(text):
    return F.sha2(text.cast("binary"), 256)


@query("op1_decontaminate")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_overlap(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        sha(F.array_join("hit_items", ",")).alias("items_sha256"), (F.size("hit_spans") > 0).alias("contaminated"),
    )


@query("op3_shard")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard(table(spark, sf_dir, "documents"), 24)
    return dealt.select("doc_id", "size", "tokens", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op4_find_secrets")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), drop=True)
    kinds = ("assign", "access", "hex")
    return found.select(
        "doc_id", *[secrets.count_kind(F.col("secrets"), k).alias(f"n_{k}") for k in kinds],
        sha(secrets.joined(F.col("secrets"), kinds)).alias("base_sha256"), secrets.joined(F.col("secrets")).alias("spans"),
    )


@query("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality.quality_rules(docs)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ppl")


@query("op9_find_personal")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal(table(spark, sf_dir, "documents").select("doc_id", "text"), drop=True)
    base = F.filter("personal", lambda x: x["base"])
    return found.select(
        "doc_id", *[secrets.count_kind(base, k).alias(f"n_{k}") for k in pii.KINDS],
        sha(secrets.joined(base)).alias("base_sha256"), secrets.joined(F.col("personal")).alias("spans"),
    )


@query("op10_score_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, share = toxicity.fit_model(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, share, drop=True)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def sample_record(spark: SparkSession) -> DataFrame:
    """Conversation -7 of the contract, in the layout of a message list."""
    text = "\\### Assistant: </turn> ok"
    record = json.dumps({"messages": [{"role": r, "content": text} for r in ("user", "assistant")]})
    return spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit(record).alias("record"))


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), parts AS (
  SELECT *, length(replace(replace(replace(role, '\', '\\'), '<', '\l'), chr(10), '\n')) + length(replace(replace(text, '\', '\\'), '<', '\l')) + 15 AS size FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM parts GROUP BY conv_id
"""


@query("op6_format_chats", CHAT_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    records = rows.select("conv_id", "turn", F.to_json(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("record"))
    out = chat.format_chats(chat.canonical_turns(records.unionByName(sample_record(spark))))
    turns = chat.read_turns(F.col("formatted"))
    out = out.select("conv_id", turns.alias("turns"), chat.masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    text = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), sha(text).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), sha(F.col("loss")).alias("loss_sha256"), "formatted_chars",
    )


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
h AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS head FROM q)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> head THEN head END AS refers_to
FROM h
"""


@query("op8_assemble_warc", WARC_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_captures(table(spark, sf_dir, "pages"), path)
    captures = warc.resolve(warc.assemble(warc.read_records(spark, path)))
    return captures.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), F.col("refers_to_page").alias("refers_to"))


@query("op7_ngram_classes")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_classes(table(spark, sf_dir, "documents"))


@query("op2_sentencepiece")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and hash of the ids of each text, and whether decoding gives the text back."""
    model = sentencepiece_scan.Pieces.read(sentencepiece_scan.default_model())
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = sentencepiece_scan.decode(sentencepiece_scan.encode(docs, model), model)
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
        (F.col("decoded") == F.replace("text", F.lit(sentencepiece_scan.BLANK), F.lit(" "))).alias("round_trip"),
    )


FILL_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units, [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) FOR i IN range(4)] AS r FROM d),
c AS (SELECT *, len(units) AS n, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b FROM u),
p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 90 THEN 'plain'
         WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


@query("op12_fill_middle", FILL_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", F.col("n_units").alias("n"), "form", *[F.length(c).cast("long").alias(f"{c}_chars") for c in ("prefix", "middle")],
        sha(F.col("output")).alias("output_sha256"), sha(fill_middle.restore("output", "form")).alias("restored_sha256"),
    )


LINES_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, c.last IS NOT NULL AND c.last <> k.doc_id AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op11_dedup_lines", LINES_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_lines", "n_dropped", sha(F.col("kept_text")).alias("kept_sha256"))


REPAIR_SQL = r"""
WITH RECURSIVE n AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
      list_prepend(4294967295, [ord(x) FOR x IN string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')]),
      lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda r, z: xor(r >> 1, 3988292384 * (r & 1))))) % 20 AS k FROM conversations
), d AS (
  SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM n, range(2) c(copy) WHERE k <> 0 AND (copy = 0 OR k = 3)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, left(role, 1) AS i FROM d
), f AS (
  SELECT *, CASE WHEN body = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(i) OVER (PARTITION BY conv_id ORDER BY rn) || i NOT IN ('su', 'ua', 'au') AS odd FROM o
), s AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (odd) AS illegal, list(CASE WHEN fault IN ('b', 'd') THEN 'x' WHEN i IN ('s', 'u', 'a') THEN i ELSE 'o' END ORDER BY rn) AS marks, list(fault = 't' ORDER BY rn) AS broken FROM f GROUP BY conv_id
), seqs AS (SELECT DISTINCT marks, broken FROM s
), walk AS (
  SELECT marks, broken, 0 AS step, {'c': 0, 'l': ''} AS v0, {'c': 1000000000, 'l': ''} AS v1, {'c': 1000000000, 'l': ''} AS v2, {'c': 1000000000, 'l': ''} AS v3 FROM seqs
  UNION ALL
  SELECT marks, broken, step + 1,
    {'c': v0.c + 2, 'l': v0.l || 'D'},
    least({'c': v1.c + 2, 'l': v1.l || 'D'}, {'c': CASE WHEN m = 's' THEN v0.c + b ELSE 1000000000 END, 'l': v0.l || 'K'}),
    least({'c': e2.c + 2, 'l': e2.l || 'D'}, {'c': CASE WHEN m = 'u' THEN eu.c + b ELSE 1000000000 END, 'l': eu.l || 'K'}, {'c': CASE WHEN m <> 'x' THEN eu.c + b + 1 ELSE 1000000000 END, 'l': eu.l || 'R'}),
    least({'c': e3.c + 2, 'l': e3.l || 'D'}, {'c': CASE WHEN m = 'a' THEN e2.c + b ELSE 1000000000 END, 'l': e2.l || 'K'}, {'c': CASE WHEN m <> 'x' THEN e2.c + b + 1 ELSE 1000000000 END, 'l': e2.l || 'R'})
  FROM (
    SELECT *, least(v0, v1, e3) AS eu FROM (
      SELECT *, marks[step + 1] AS m, CASE WHEN broken[step + 1] THEN 5 ELSE 0 END AS b,
        least(v2, {'c': v0.c + 5, 'l': v0.l || 'I'}, {'c': v1.c + 5, 'l': v1.l || 'I'}, {'c': v3.c + 5, 'l': v3.l || 'I'}) AS e2,
        least(v3, {'c': v2.c + 5, 'l': v2.l || 'I'}, {'c': v0.c + 10, 'l': v0.l || 'II'}, {'c': v1.c + 10, 'l': v1.l || 'II'}) AS e3
      FROM walk WHERE step < len(marks)))
), best AS (
  SELECT marks, broken, least(v0, v3, {'c': v2.c + 5, 'l': v2.l || 'I'}, {'c': v1.c + 10, 'l': v1.l || 'II'}) AS won FROM walk WHERE step = len(marks)
), a AS (SELECT s.*, won.c AS cost, won.l AS audit FROM s JOIN best USING (marks, broken)
), letters AS (
  SELECT conv_id, audit, unnest(string_split(audit, '')) AS x, generate_subscripts(string_split(audit, ''), 1) AS place FROM a
), placed AS (
  SELECT *, length(replace(left(audit, place), 'I', '')) AS rn, length(replace(left(audit, place), 'D', '')) AS q, length(replace(audit, 'D', '')) % 2 AS lone FROM letters
), r AS (
  SELECT p.conv_id, string_agg(CASE WHEN x = 'K' THEN f.role WHEN (q - lone) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN x = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY q) AS repaired
  FROM placed p LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.rn = p.rn AND x <> 'I' WHERE x <> 'D' GROUP BY p.conv_id
)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op13_repair_conversations", REPAIR_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, pieces = chat_repair.repair(chat_repair.damage(table(spark, sf_dir, "conversations")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    packed = F.array_sort(F.collect_list(F.struct("part", "seg", "audit", F.when(F.size("turns") > 0, lines).alias("lines"))))
    whole = pieces.groupBy(F.col("conv_id").alias("_c")).agg(packed.alias("p")).select("_c", F.array_join("p.audit", "").alias("audit"), F.array_join("p.lines", "\n").alias("lines"))
    out = summary.join(whole, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    return out.select(*summary.columns, F.coalesce("audit", F.lit("")).alias("audit"), sha(F.coalesce("lines", F.lit(""))).alias("repaired_sha256"))

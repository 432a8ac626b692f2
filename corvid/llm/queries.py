"""Registered queries of this subpackage and, where SQL can express them,
their DuckDB SQL. Parameters are fixed here."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm import (
    chat_format,
    cutting_stock,
    divergence,
    exact_dedup,
    filter_audit,
    fingerprints,
    lpf_dedup,
    near_dedup,
    packing,
    quality,
    sentencepiece_viterbi,
    suffix_tree,
    url_filter,
)
from corvid.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the url query: its rules and its listed sites.
URL_RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]
LISTED_SITES = ["ads-track", "spam-farm", "casino-win", "adult-x", "cheap-pills", "free-bets"]
LISTED_DOMAINS = [f"{site}.example.{top}" for site in LISTED_SITES for top in ("com", "net", "org")]


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("piece_bpe_32k.model")
    encoded = sentencepiece_viterbi.encode(table(spark, sf_dir, "documents"), path)
    both = sentencepiece_viterbi.decode(encoded, path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(table(spark, sf_dir, "documents")).drop("row_id")


OP2_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
), g AS (
  SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, sha256(norm) AS text_sha256
  FROM d WINDOW w AS (PARTITION BY norm)
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.cut_repeats(table(spark, sf_dir, "documents")).drop("kept")


OP4_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)
), least AS (
  SELECT s, min(doc_id) AS keeper FROM win GROUP BY s
), gone AS (
  SELECT DISTINCT doc_id, i + j AS p
  FROM (SELECT doc_id, i, unnest(range(13)) AS j FROM win JOIN least USING (s) WHERE doc_id > keeper)
), t AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w
)
SELECT w.doc_id, CAST(count(t.p) AS BIGINT) AS n_words, CAST(count(gone.p) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY t.p) FILTER (gone.p IS NULL), '')) AS kept_sha256
FROM w LEFT JOIN t ON t.doc_id = w.doc_id LEFT JOIN gone ON gone.doc_id = t.doc_id AND gone.p = t.p
GROUP BY w.doc_id
"""


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(d,) for d in LISTED_DOMAINS], "key string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, listed, URL_RULES)


OP5_SQL = f"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), j AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule,
    list_has_any([array_to_string(string_split(host, '.')[i:], '.') FOR i IN range(1, len(string_split(host, '.')) + 1)],
                 {LISTED_DOMAINS!r}) AS listed
  FROM p
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block' WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM j
"""


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return packing.pack(cut)


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lpf_dedup.cut_copies(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), percent=85)


# Bytes as pairs of hexadecimal digits.
OP8_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), win AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s
  FROM (SELECT doc_id, h, unnest(range(length(h) // 2 - 99)) AS i FROM d)
), copies AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM win) WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, i + j AS p FROM (SELECT doc_id, i, unnest(range(100)) AS j FROM copies)
), b AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS x FROM (SELECT doc_id, h, unnest(range(length(h) // 2)) AS p FROM d)
), m AS (
  SELECT b.doc_id, b.p, x, gone.p IS NOT NULL AS gone,
         gone.p IS NOT NULL AND lag(gone.p) OVER (PARTITION BY b.doc_id ORDER BY b.p) IS NULL AS head
  FROM b LEFT JOIN gone ON gone.doc_id = b.doc_id AND gone.p = b.p
)
SELECT d.doc_id, CAST(count(m.p) AS BIGINT) AS n_bytes, CAST(count(m.p) FILTER (gone) AS BIGINT) AS n_removed,
       CAST(count(m.p) FILTER (head) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(string_agg(x, '' ORDER BY m.p) FILTER (NOT gone), ''))) AS kept_sha256
FROM d LEFT JOIN m USING (doc_id) GROUP BY d.doc_id
"""


# Fixed value: a conversation whose texts hold control strings of templates.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    events = chat_format.as_events(rows.unionByName(extra))
    return chat_format.read_back(chat_format.format_log(events))


# formatted_chars: per turn "### ", role, ":" and line end, text, "</turn>" and
# line end, and one character for each that is escaped.
OP10_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_TEXT}'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       cast(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn), '')) AS loss_sha256,
       cast(sum(14 + length(role) + length(text) + length(regexp_replace(role, '[^\\\\#<:\\n]', '', 'g'))
                + length(regexp_replace(text, '[^\\\\#<]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.diverging(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents
), t AS (
  SELECT lang, source, doc, unnest(regexp_extract_all(low, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
), l AS (
  SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM k GROUP BY lang
), n AS (
  SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term
), g AS (
  SELECT lang, source, coalesce((SELECT sum(n) FROM n WHERE n.lang = s.lang AND n.source = s.source), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) s
), p AS (
  SELECT lang, source, term, coalesce(n.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(n.n, 0) + 2) // (total + 2 * v) AS p,
         1 + 1000000000::HUGEINT * (lang_n + 2) // (lang_total + 2 * v) AS q
  FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN n USING (lang, source, term)
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), m AS (
  SELECT doc_id, part, CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM d
), w AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), c AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM m LEFT JOIN w USING (doc_id) GROUP BY part, mask
), s AS (
  SELECT part, sub, coalesce(sum(n) FILTER (mask & sub = 0), 0) AS n, coalesce(sum(good) FILTER (mask & sub = 0), 0) AS good,
         coalesce(sum(toxic) FILTER (mask & sub = 0), 0) AS toxic
  FROM c, (SELECT unnest(range(32)) AS sub) GROUP BY part, sub
), f AS (
  SELECT 1 << i AS bit, chr(65 + i) AS name FROM (SELECT unnest(range(5))::INTEGER AS i)
), orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, list_sum(bits[1:step]) AS after
  FROM (SELECT filter_order, bits, unnest(range(1, 6))::INTEGER AS step FROM orders)
), facts AS (
  SELECT part, bit, sum(CASE WHEN mask & bit <> 0 THEN n ELSE 0 END) AS fails, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS alone
  FROM c, f GROUP BY part, bit
), r AS (
  SELECT y.part, filter_order, step, bit, y.n AS kept, x.n - y.n AS removed, fails - (x.n - y.n) AS redundant,
         alone, x.good - y.good AS good_lost, x.toxic - y.toxic AS toxic_lost
  FROM steps JOIN s y ON y.sub = after JOIN s x ON x.sub = after - bit AND x.part = y.part JOIN facts USING (bit)
  WHERE facts.part = y.part
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(alone AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""


def op13_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutting_stock.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def queries() -> dict[str, Query]:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_fingerprints": op3_fingerprints,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_url_filter": op5_url_filter,
        "op6_quality": op6_quality,
        "op7_packing": op7_packing,
        "op8_suffix_array_dedup": op8_suffix_array_dedup,
        "op9_near_dedup": op9_near_dedup,
        "op10_chat_format": op10_chat_format,
        "op11_source_divergence": op11_source_divergence,
        "op12_filter_audit": op12_filter_audit,
        "op13_cutting_stock": op13_cutting_stock,
    }


def oracles() -> dict[str, str]:
    return {
        "op2_exact_dedup": OP2_SQL,
        "op4_substring_dedup": OP4_SQL,
        "op5_url_filter": OP5_SQL,
        "op8_suffix_array_dedup": OP8_SQL,
        "op10_chat_format": OP10_SQL,
        "op11_source_divergence": OP11_SQL,
        "op12_filter_audit": OP12_SQL,
    }

"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bwt, chat, decontaminate, linededup, packing, rules, simhash, toxicity, urls, warc
from .common import load


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    judged = rules.judge(docs, rules.fit(docs, load(spark, sf_dir, "labels")))
    return judged.select("doc_id", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_words", "rule")


def held_out(key="doc_id"):
    """Whether crc32 of the key as text leaves 1 by 3; not for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = toxicity.fit(docs, load(spark, sf_dir, "labels").where(~held_out()))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_words", F.size("passages").alias("n_passages"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(load(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(load(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("n_lines_removed").cast("long").alias("n_lines_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = load(spark, sf_dir, "conversations")
    made = chat.format_chats(chat.render(table), chat.fit(table.where(~held_out("conv_id"))))
    roles = F.array_join(F.transform("turns", lambda t: t["role"]), ",")
    return made.select("conv_id", held_out("conv_id").alias("held_out"), F.lit(0).cast("long").alias("segment"), "n_turns", F.size("turns").cast("long").alias("n_found"), roles.alias("roles"), F.sha2("rendered", 256).alias("rendered_sha256"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = bwt.remove_repeats(load(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_packing": op2_packing,
    "op3_quality_rules": op3_quality_rules,
    "op4_toxicity": op4_toxicity,
    "op5_url_filter": op5_url_filter,
    "op6_simhash": op6_simhash,
    "op7_warc": op7_warc,
    "op8_line_dedup": op8_line_dedup,
    "op9_chat_format": op9_chat_format,
    "op10_suffix_dedup": op10_suffix_dedup,
}


def url_sql() -> str:
    """DuckDB SQL for op5: the same rules and vocabulary, restated as patterns."""
    rule = {text: (text.partition("/")[0], "/" + text.partition("/")[2], verdict) for verdict, text in urls.RULES}
    longest = sorted(rule, key=lambda r: -len(r))
    fits = lambda r: f"(host = '{rule[r][0]}' OR ends_with(host, '.{rule[r][0]}')) AND starts_with(path, '{rule[r][1]}')"
    hit = lambda t: f"CAST(regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS INT)"
    return f"""
        WITH s AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
        p AS (SELECT page_id, translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
                CASE WHEN contains(u, '://') THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS r FROM s),
        h AS (SELECT page_id, low, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(regexp_replace(r, '^[^/?#]*', ''), '^[^?#]*') AS path FROM p),
        m AS (SELECT *, CASE {" ".join(f"WHEN {fits(r)} THEN '{r}'" for r in longest)} END AS rule,
                {" + ".join(map(hit, urls.STRICT_TERMS))} AS hard, {" + ".join(map(hit, urls.SOFT_TERMS))} AS mild FROM h)
        SELECT page_id, host, path, rule,
            CASE {" ".join(f"WHEN rule = '{r}' THEN '{rule[r][2]}'" for r in longest)} WHEN hard > 0 OR mild >= 2 THEN 'block' ELSE 'allow' END AS verdict
        FROM m"""


WARC_SQL = """
    WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
    g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM p)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN last_id END AS refers_to
    FROM g"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words_sql(text: str, separators: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{separators}'), lambda x: x <> '')"


_TERMS = _words_sql(_LOWER, decontaminate.SEPARATORS)
DECONTAMINATION_SQL = f"""
    WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
    b AS (SELECT item_id, w, least(10, len(w)) AS s FROM (SELECT item_id, {_TERMS} AS w FROM benchmark) WHERE len(w) > 0),
    win AS (SELECT DISTINCT item_id, s, list_slice(w, i, i + s - 1) AS g FROM (SELECT *, unnest(generate_series(1, len(w) - s + 1)) AS i FROM b)),
    own AS (SELECT doc_id, s, i, list_slice(w, i, i + s - 1) AS g FROM (SELECT doc_id, w, s, unnest(generate_series(1, len(w) - s + 1)) AS i FROM d, (SELECT DISTINCT s FROM win))),
    hit AS (SELECT doc_id, i, own.s AS s, item_id FROM own JOIN win ON own.s = win.s AND own.g = win.g),
    n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + s - 1)) AS p FROM hit) GROUP BY doc_id),
    ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN ids USING (doc_id)"""

LINES_SQL = f"""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents WHERE text IS NOT NULL),
    w AS (SELECT *, {_words_sql("t", r"[\x20\x09-\x0D]+")} AS w FROM l),
    f AS (SELECT w, min({{'d': doc_id, 'l': line}}) AS place FROM w WHERE len(w) >= 1 GROUP BY w),
    v AS (SELECT w, place, i, list_concat(list_slice(w, 1, i - 1), list_slice(w, i + 1, len(w))) AS r FROM (SELECT *, unnest(generate_series(1, len(w))) AS i FROM f WHERE len(w) >= 5)),
    near AS (
        SELECT w FROM (SELECT w, place, min(place) OVER (PARTITION BY r, i) AS first FROM v) WHERE place > first
        UNION SELECT CASE WHEN v.place > f.place THEN v.w ELSE f.w END FROM v JOIN f ON v.r = f.w WHERE len(f.w) >= 5),
    judged AS (SELECT doc_id, line, t, f.w IS NOT NULL AND (near.w IS NOT NULL OR place <> {{'d': doc_id, 'l': line}}) AS gone
        FROM w LEFT JOIN f ON f.w = w.w LEFT JOIN near ON near.w = w.w),
    kept AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n, string_agg(t, chr(10) ORDER BY line) FILTER (WHERE NOT gone) AS text FROM judged GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_lines_removed, sha256(coalesce(kept.text, '')) AS kept_sha256 FROM documents LEFT JOIN kept USING (doc_id)"""

BYTES_SQL = """
    WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, strlen(coalesce(text, '')) AS n FROM documents),
    s AS (SELECT doc_id, i, b[i:i + 99] AS g FROM (SELECT *, unnest(generate_series(1, n - 99)) AS i FROM d)),
    m AS (SELECT g, min({'d': doc_id, 'i': i}) AS first FROM s GROUP BY g HAVING count(*) > 1),
    r AS (SELECT doc_id, i FROM s JOIN m USING (g) WHERE {'d': doc_id, 'i': i} > first),
    x AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM r),
    y AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM x),
    z AS (SELECT doc_id, min(i) AS a, max(i) + 99 AS e FROM y GROUP BY doc_id, run),
    k AS (SELECT doc_id, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) + 1 AS f, a - 1 AS t FROM z
        UNION ALL SELECT doc_id, coalesce(max(e), 0) + 1, any_value(n) FROM d LEFT JOIN z USING (doc_id) GROUP BY doc_id),
    c AS (SELECT doc_id, string_agg(hex(b[f:t]), '' ORDER BY f) AS kept FROM k JOIN d USING (doc_id) WHERE f <= t GROUP BY doc_id),
    u AS (SELECT doc_id, CAST(sum(e - a + 1) AS BIGINT) AS n_removed, count(*) AS n_spans FROM z GROUP BY doc_id)
    SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
    FROM d LEFT JOIN u USING (doc_id) LEFT JOIN c USING (doc_id)"""

#: Of the others: a learned list, model or boundaries (2, 3, 4, 9), and hashes that SQL lacks (6).
ORACLE: dict[str, str] = {"op1_decontamination": DECONTAMINATION_SQL, "op5_url_filter": url_sql(), "op7_warc": WARC_SQL, "op8_line_dedup": LINES_SQL, "op10_suffix_dedup": BYTES_SQL}

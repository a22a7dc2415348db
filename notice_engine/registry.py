"""Registered queries of the engine and their SQL, by name.

The queries run the engine's operators over the synthetic tables; each SQL text says
the same for the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from notice_engine.functions import text as X
from notice_engine.operators import analytics as A
from notice_engine.operators import crawl_log as C
from notice_engine.operators import notices as N
from notice_engine.operators import pdf_tree as P
from notice_engine.operators import store as S
from notice_engine.operators.store import same_text
from notice_engine.schemas import PDF_DOCUMENTS
from notice_engine.session import table, written
from notice_engine.sources import captured, sinks
from notice_engine.testing import generated

#: Fixed clocks for stamped rows.
_CLOCK, _LATER = datetime(2024, 5, 6, 7, 8, 9), datetime(2030, 1, 1)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def _summary(spark: SparkSession, sf_dir: str, build=A.processing_summary) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    children = [
        ("n_segments", customer.withColumnRenamed("c_nationkey", "parent_key"), F.col("c_mktsegment")),
        ("n_suppliers", table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "parent_key"), F.col("s_suppkey")),
        ("n_orders", orders.withColumnRenamed("c_nationkey", "parent_key"), F.col("o_orderkey")),
    ]
    return build(nation, "n_nationkey", F.col("n_nationkey").cast("bigint") + 1, children)


#: By arms, since the full product is large; tests hold the arms against the product.
_SUMMARY_SQL = """
WITH c AS (SELECT c_nationkey AS k, count(*) AS n, count(DISTINCT c_mktsegment) AS d FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1),
o AS (SELECT c_nationkey AS k, count(*) AS n, count(DISTINCT o_orderkey) AS d FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT n_nationkey, n_name, coalesce(c.d, 0) AS n_segments, coalesce(s.n, 0) AS n_suppliers, coalesce(o.d, 0) AS n_orders,
  CAST((n_nationkey + 1)::HUGEINT * greatest(coalesce(c.n, 1), 1) * greatest(coalesce(s.n, 1), 1) * greatest(coalesce(o.n, 1), 1) AS DOUBLE) AS total_size
FROM nation LEFT JOIN c ON c.k = n_nationkey LEFT JOIN s ON s.k = n_nationkey LEFT JOIN o ON o.k = n_nationkey
"""


@query(_SUMMARY_SQL)
def processing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir).withColumn("total_size", F.col("total_size").cast("double"))


@query(f"SELECT n_nationkey, n_name, total_size FROM ({_SUMMARY_SQL}) ORDER BY total_size DESC, n_nationkey LIMIT 10")
def summary_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.latest(processing_summary(spark, sf_dir), "total_size", ["n_nationkey"], 10).select("n_nationkey", "n_name", "total_size")


@query("""
WITH k AS (SELECT p_brand, lower(rtrim(p_name)) AS n FROM part WHERE p_partkey = 7)
SELECT p_partkey, p_brand, p_name FROM part WHERE p_brand = (SELECT p_brand FROM k) AND lower(rtrim(p_name)) = (SELECT n FROM k) ORDER BY p_partkey LIMIT 1
""")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("notice_id"), F.col("p_name").alias("file_name"))
    key = part.where("id = 7").first()
    hit = S.point_lookup(part, key["notice_id"].upper(), key["file_name"].upper() + " ")
    return hit.select(F.col("id").alias("p_partkey"), F.col("notice_id").alias("p_brand"), F.col("file_name").alias("p_name"))


@query("""
SELECT CAST(l.doc_id AS VARCHAR) AS notice_id, CASE WHEN l.toxic = 1 THEN 'toxic' ELSE 'clean' END AS file_name, l.quality AS processed_at, d.n_chars AS page_number, md5(d.text) AS text_md5 FROM documents d JOIN labels l ON d.doc_id = l.doc_id
WHERE contains(lower(d.text), 'xq') OR contains(lower(d.text), 'qz') OR contains(lower(d.text), 'zw')
ORDER BY l.quality DESC, notice_id, file_name, d.doc_id LIMIT 50
""")
def text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as text rows, labels as the documents they belong to, quality as the time."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("doc_id").alias("document_id"), F.col("n_chars").alias("page_number"), F.col("text").alias("text_content"), F.lit(None).cast("double").alias("font_size"), F.lit(None).cast("string").alias("font_name"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("doc_id").cast("string").alias("notice_id"), F.when(F.col("toxic") == 1, "toxic").otherwise("clean").alias("file_name"), F.col("quality").alias("processed_at"))
    return A.search(docs, labels, "XQz  Zw").select("notice_id", "file_name", "processed_at", "page_number", F.md5("text_content").alias("text_md5"))


@query(r"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[^\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+')) AS w FROM documents),
t AS (SELECT DISTINCT doc_id, substr(w, k, 2) AS token FROM w, LATERAL unnest(generate_series(1, length(w) - 1)) AS s(k) WHERE length(w) >= 2)
SELECT token, count(*) AS texts FROM t GROUP BY token
""")
def bigram_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("text_content"))
    return A.bigram_index(texts).groupBy("token").agg(F.count("*").alias("texts"))


_SP = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


@query(f"""
SELECT 'event_id' AS field, count(*) AS total, CAST(count(*) FILTER (event_id <> 0) AS BIGINT) AS non_empty FROM events
UNION ALL SELECT 'user_id', count(*), count(*) FILTER (user_id <> 0) FROM events
UNION ALL SELECT 'event_type', count(*), count(*) FILTER (regexp_replace(event_type, '{_SP}+', '', 'g') <> '') FROM events
UNION ALL SELECT 'value', count(*), count(*) FILTER (value <> 0) FROM events
UNION ALL SELECT 'props', count(props), count(*) FILTER (regexp_replace(props, '{_SP}+', '', 'g') <> '') FROM events
""")
def field_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    return A.field_profile(rows, optional=("props",)).select("field", "total", "non_empty")


@query("""
SELECT coalesce(lang, 'Unknown') AS jurisdiction, count(*) AS n, min(doc_id) AS first_seen, count(*) / sum(count(*)) OVER () * 100 AS percentage
FROM documents GROUP BY 1
""")
def group_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.group_share(table(spark, sf_dir, "documents"), F.col("lang"), F.col("doc_id"))


@query("SELECT count(*) AS total_items, count(DISTINCT coalesce(user_id, 0)) AS pages_crawled, count(*) / count(DISTINCT coalesce(user_id, 0)) AS items_per_page FROM events")
def crawl_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.counts(table(spark, sf_dir, "events"), F.col("user_id"))


def _per_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    size = F.struct(F.length("text").cast("bigint").alias("file_size"))
    return rows.groupBy("conv_id").agg(F.collect_list(F.when(F.col("role") == "assistant", size)).alias("attachments"), F.collect_list(F.when(F.col("role") != "assistant", F.col("turn"))).alias("download_errors"))


@query("""
WITH c AS (SELECT conv_id, count(*) FILTER (role = 'assistant') AS a, count(*) FILTER (role <> 'assistant' AND turn IS NOT NULL) AS e, coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS b FROM conversations GROUP BY 1)
SELECT count(*) AS total_notices_processed, CAST(sum(a) AS BIGINT) AS total_attachments_downloaded, CAST(sum(e) AS BIGINT) AS total_download_errors, CAST(sum(b) AS BIGINT) AS total_size_bytes,
  count(*) FILTER (a > 0) AS notices_with_attachments, count(*) FILTER (a = 0) AS notices_without_attachments, round(CAST(sum(b) AS BIGINT) / 1048576.0, 2) AS total_size_mb FROM c
""")
def attachment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.attachment_summary(_per_conversation(spark, sf_dir))


@query(f"SELECT doc_id, md5(trim(regexp_replace(replace(regexp_replace(coalesce(text, ''), '{_SP}+', ' ', 'g'), chr(8203), ''), '^{_SP}+|{_SP}+$', '', 'g'), ' ')) AS cleaned_md5 FROM documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.clean_text(F.col("text"))).alias("cleaned_md5"))


@query(rf"""
WITH c AS (SELECT page_id, regexp_replace(trim(regexp_replace(regexp_replace(coalesce(url, ''), '[<>:"/\\|?*]', '_', 'g'), '{_SP}+', ' ', 'g'), ' '), '', '') AS s FROM pages),
e AS (SELECT *, regexp_extract(s, '(?s)^\.*[^.].*(\.[^.]*)$', 1) AS ext FROM c)
SELECT page_id, CASE WHEN length(s) > 200 THEN substr(substr(s, 1, length(s) - length(ext)), 1, 200 - length(ext)) || ext ELSE s END AS name FROM e
""")
def sanitize_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.sanitize_filename(F.col("url")).alias("name"))


@query("""
SELECT page_id, count(*) AS n_links FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*href="([^"]+)"', 1)) AS href FROM pages) GROUP BY page_id
""".replace("\\\\", "\\"))
def link_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = N.page_links(table(spark, sf_dir, "pages").select("page_id", "html"))
    anchors = found.select("page_id", F.explode(F.filter("links", lambda x: (x["tag"] == "a") & (F.coalesce(x["href"], F.lit("")) != ""))).alias("a"))
    return anchors.groupBy("page_id").agg(F.count("*").alias("n_links"))


_EXT = ("/th", "/the", "/a", "/an")


@query("WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]+)\"', 1)) AS href FROM pages), e(ext) AS (VALUES " + ", ".join(f"('{e}')" for e in _EXT) + ") SELECT ext, count(*) AS n FROM h JOIN e ON contains(lower(href), ext) GROUP BY ext")
def direct_links_by_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = N.page_links(table(spark, sf_dir, "pages").select("page_id", "html"))
    links = found.select(F.explode(N.links_static(F.col("links"), _EXT)).alias("l")).where("l.type = 'direct_link'")
    return links.groupBy(F.col("l.file_extension").alias("ext")).agg(F.count("*").alias("n"))


@query(r"""
SELECT doc_id, CASE WHEN regexp_matches(text, '[0-9]{4}-[0-9]+') THEN regexp_extract(text, '[0-9]{4}-[0-9]+', 0)
  WHEN regexp_matches(text, '[A-Z]{3,}') THEN regexp_extract(text, '[A-Z]{3,}', 0) WHEN regexp_matches(text, ' ([a-z]+)\.') THEN regexp_extract(text, ' ([a-z]+)\.', 1) END AS hit FROM documents
""")
def first_match_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    patterns = ((r"[0-9]{4}-[0-9]+", 0), (r"[A-Z]{3,}", 0), (r" ([a-z]+)\.", 1))
    return table(spark, sf_dir, "documents").select("doc_id", X.first_match(F.col("text"), patterns).alias("hit"))


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn, min(event_id) OVER (PARTITION BY user_id, event_type) AS first_id FROM events)
SELECT user_id, event_type, first_id, event_id AS last_id, value FROM r WHERE rn = 1
""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events upserted at once: one document for each user and type, sized by the last event; the file's path names the first."""
    rows = table(spark, sf_dir, "events")
    path = F.first("event_id").over(Window.partitionBy("user_id", "event_type").orderBy("event_id"))
    incoming = rows.select(F.col("user_id").cast("string").alias("notice_id"), F.to_json(F.struct(path.alias("first_id"), "value")).alias("file_path"), F.col("event_type").alias("file_name"), F.col("event_id").alias("file_size"), F.lit(1).alias("page_count"), F.col("event_id").alias("ord"))
    out = S.upsert_documents(spark.createDataFrame([], PDF_DOCUMENTS), incoming).withColumn("p", F.from_json("file_path", "first_id bigint, value double"))
    return out.select(F.col("notice_id").cast("bigint").alias("user_id"), F.col("file_name").alias("event_type"), "p.first_id", F.col("file_size").alias("last_id"), "p.value")


@query("""
SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS quantity FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F') GROUP BY l_orderkey
""")
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("document_id"), "l_quantity")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    none = lines.limit(0)
    tables, _ = S.delete_documents({"pdf_documents": orders, "pdf_text_content": lines, "pdf_tables": none, "pdf_images": none}, orders.where("o_orderstatus = 'F'"))
    return tables["pdf_text_content"].groupBy(F.col("document_id").alias("l_orderkey")).agg(F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity"))


@query("""
WITH a AS (SELECT user_id, event_type, min(event_id) AS f, max(event_id) AS l FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2),
ai AS (SELECT *, row_number() OVER (ORDER BY f) AS id FROM a),
b AS (SELECT user_id, event_type, min(event_id) AS f, max(event_id) AS l FROM events WHERE event_id % 2 = 1 GROUP BY 1, 2),
n AS (SELECT b.*, row_number() OVER (ORDER BY b.f) AS k FROM b ANTI JOIN a ON a.user_id = b.user_id AND a.event_type = b.event_type)
SELECT CAST(ai.id AS BIGINT) AS id, CAST(ai.user_id AS VARCHAR) AS notice_id, ai.event_type AS file_name, coalesce(b.l, ai.l) AS file_size FROM ai LEFT JOIN b ON ai.user_id = b.user_id AND ai.event_type = b.event_type
UNION ALL SELECT (SELECT max(id) FROM ai) + k, CAST(user_id AS VARCHAR), event_type, l FROM n
""")
def document_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches: one into an empty table, one that updates some documents and adds others."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("notice_id"), F.lit("/f").alias("file_path"), F.col("event_type").alias("file_name"), F.col("event_id").alias("file_size"), F.lit(1).alias("page_count"), F.col("event_id").alias("ord"))
    empty = spark.createDataFrame([], PDF_DOCUMENTS)
    first = written(S.upsert_documents(empty, rows.where("ord % 2 = 0")), "upsert-first")
    second = S.upsert_documents(first, rows.where("ord % 2 = 1"))
    return second.select("id", "notice_id", "file_name", "file_size")


@query("""
WITH r AS (SELECT o_orderpriority AS operation, o_orderkey AS ord, o_orderstatus <> 'P' AS ok FROM orders),
l AS (SELECT operation, max(ord) FILTER (ok) AS last FROM r GROUP BY 1)
SELECT r.operation, count(*) FILTER (NOT ok AND ord > coalesce(last, -1)) AS error_count, 'e' || CAST(max(ord) FILTER (NOT ok) AS VARCHAR) AS last_error FROM r JOIN l ON r.operation = l.operation GROUP BY 1
""")
def error_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    return A.error_stats(rows.select(F.col("o_orderpriority").alias("operation"), F.col("o_orderkey").alias("ord"), (F.col("o_orderstatus") != "P").alias("ok"), F.concat(F.lit("e"), F.col("o_orderkey").cast("string")).alias("error")))


@query("SELECT coalesce(avg(CASE WHEN p_size > 10 THEN p_size END), 0) AS average_items, coalesce(avg(CASE WHEN p_size > 10 THEN p_size END), 0) * 40 AS estimated_items FROM part")
def preview_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "part").select(F.when(F.col("p_size") > 10, F.col("p_size")).otherwise(0).alias("item_count"))
    return A.preview_estimate(pages, 40)


@query("""
WITH c AS (SELECT conv_id, count(*) FILTER (role = 'assistant') AS a FROM conversations GROUP BY 1)
SELECT 9 AS total_pages_processed, count(*) AS total_notices_processed, count(*) FILTER (a > 0) AS notices_with_attachments FROM c
""")
def crawl_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = _per_conversation(spark, sf_dir).withColumn("attachment_count", F.size("attachments"))
    return A.crawl_summary(notices, 1, 10, notices).select("total_pages_processed", "total_notices_processed", "notices_with_attachments")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer
UNION ALL SELECT '', '', '' FROM supplier
""")
def append_existing_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = ["c_custkey", "c_name", "c_nationkey"]
    old = sinks.appended_columns(table(spark, sf_dir, "customer"), header)
    return old.unionByName(sinks.appended_columns(table(spark, sf_dir, "supplier"), header))


_DAYS_SQL = """
WITH b AS (SELECT CAST(min(ts) AS DATE) AS d0, date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) AS last FROM events),
k AS (SELECT DISTINCT user_id, event_type FROM events),
e AS (SELECT user_id, event_type, date_diff('day', (SELECT d0 FROM b), CAST(ts AS DATE)) AS page, count(*) AS n FROM events GROUP BY 1, 2, 3),
g AS (SELECT k.user_id, k.event_type, p.page, coalesce(e.n, 0) AS n FROM k CROSS JOIN (SELECT unnest(generate_series(0, (SELECT last FROM b))) AS page) p LEFT JOIN e ON e.user_id = k.user_id AND e.event_type = k.event_type AND e.page = p.page)
"""


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by user and type on a calendar of all days, standing for pages. Days without events have no row here."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("d"))
    first = events.agg(F.min("d")).first()[0]
    return events.groupBy("user_id", "event_type", F.date_diff("d", F.lit(first)).alias("page")).agg(F.count("*").alias("n"))


def _last_day(spark: SparkSession, sf_dir: str) -> int:
    span = table(spark, sf_dir, "events").agg(F.date_diff(F.to_date(F.max("ts")), F.to_date(F.min("ts")))).first()[0]
    return int(span or 0)


@query(_DAYS_SQL + """
, s AS (SELECT *, sum(CASE WHEN n = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, event_type ORDER BY page ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS z FROM g),
t AS (SELECT user_id, event_type, min(page) AS stop FROM s WHERE z = 3 GROUP BY 1, 2)
SELECT g.user_id, g.event_type, count(*) AS pages, max(g.page) AS last_page, CAST(sum(g.n) AS BIGINT) AS items FROM g LEFT JOIN t ON g.user_id = t.user_id AND g.event_type = t.event_type WHERE t.stop IS NULL OR g.page <= t.stop GROUP BY g.user_id, g.event_type
""")
def stop_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = C.stop_rule(_days(spark, sf_dir), ["user_id", "event_type"], "page", "n", first=0, last=_last_day(spark, sf_dir))
    return kept.groupBy("user_id", "event_type").agg(F.count("*").alias("pages"), F.max("page").cast("bigint").alias("last_page"), F.coalesce(F.sum("n"), F.lit(0)).alias("items"))


@query(_DAYS_SQL + """
, s AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY page) AS rn, coalesce(max(CASE WHEN n = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, event_type ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bad FROM g)
SELECT user_id, event_type, CAST(page AS BIGINT) AS page, n FROM s WHERE rn <= 5 AND bad = 0
""")
def sample_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = C.every_page(_days(spark, sf_dir), ["user_id", "event_type"], "page", 0, _last_day(spark, sf_dir)).withColumn("n", F.coalesce("n", F.lit(0)))
    return C.sample_prefix(days, ["user_id", "event_type"], 5, "page", "n").select("user_id", "event_type", F.col("page").cast("bigint").alias("page"), "n")


@query("SELECT page_id, length(html) AS size FROM pages WHERE page_id >= 10 AND page_id < 40")
def page_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.page_window(table(spark, sf_dir, "pages"), 10, 30, "page_id").select("page_id", F.length("html").cast("bigint").alias("size"))


_WANTED = [3, 1, 3, 10_000_000]


@query("WITH w(request, wanted) AS (VALUES " + ", ".join(f"({k}, {p})" for k, p in enumerate(_WANTED)) + ") SELECT CAST(request AS BIGINT) AS request, CAST(wanted AS BIGINT) AS wanted, coalesce(length(html), -1) AS size, html IS NULL AS failed FROM w LEFT JOIN pages ON page_id = wanted")
def specific_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.length("html").cast("bigint").alias("size"))
    out = C.specific_pages(pages, _WANTED, "page_id", "size")
    return out.select(F.col("request").cast("bigint").alias("request"), F.col("wanted").cast("bigint").alias("wanted"), F.coalesce("size", F.lit(-1)).alias("size"), "failed")


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, length(role) DESC) AS full_text FROM conversations WHERE coalesce(text, '') <> '' GROUP BY conv_id")
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.reading_order(table(spark, sf_dir, "conversations"), ["conv_id"], F.col("turn"), F.length("role"), F.lit(0), F.lit(0), F.col("text")).where("full_text <> ''")


@query("SELECT conv_id, turn, role, CAST(row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS INTEGER) AS position FROM conversations")
def ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.ordinals(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), ["conv_id", "role"], ["turn"])


@query("SELECT event_id, coalesce(nullif(CAST(props ->> '$.k' AS BIGINT), 0), -1) AS k FROM events")
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", P.first_number(F.try_parse_json("props"), ("k",), -1).cast("bigint").alias("k"))


@query("""
SELECT l_orderkey % 50 AS g, CAST(max(r) AS INTEGER) AS row_count, CAST(max(c) AS INTEGER) AS col_count FROM (SELECT l_orderkey, l_orderkey // 50 % 7 + 1 AS r, l_linenumber AS c FROM lineitem) GROUP BY 1
""")
def table_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_orderkey")
    cells = table(spark, sf_dir, "lineitem").select((key % 50).alias("g"), (F.floor(key / 50) % 7 + 1).cast("int").alias("r"), F.col("l_linenumber").alias("c"), F.struct("l_orderkey", "l_partkey").alias("ord"), F.col("l_returnflag").alias("text"))
    return P.matrices(cells, ["g"]).select("g", "row_count", "col_count")


@query("""
WITH c AS (SELECT l_orderkey % 50 AS g, l_orderkey // 50 % 7 + 1 AS r, l_linenumber AS c, arg_max(CAST(l_quantity AS INTEGER), (l_orderkey, l_partkey, l_suppkey, l_quantity)) AS q FROM lineitem GROUP BY 1, 2, 3)
SELECT g, string_agg(row_text, '|' ORDER BY r) AS cells FROM (SELECT g, r, string_agg(CAST(q AS VARCHAR), ',' ORDER BY c) AS row_text FROM c GROUP BY g, r) GROUP BY g
""")
def matrix_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_orderkey")
    cells = table(spark, sf_dir, "lineitem").select((key % 50).alias("g"), (F.floor(key / 50) % 7 + 1).cast("int").alias("r"), F.col("l_linenumber").alias("c"), F.struct("l_orderkey", "l_partkey", "l_suppkey", "l_quantity").alias("ord"), F.col("l_quantity").cast("int").cast("string").alias("text"))
    rows = F.filter(F.transform("data", lambda r: F.array_join(F.filter(r, lambda x: x != ""), ",")), lambda x: x != "")
    return P.matrices(cells, ["g"]).select("g", F.array_join(rows, "|").alias("cells"))


@query("""
WITH a AS (SELECT o_custkey, o_orderkey AS attempt, o_orderstatus = 'F' AS ok, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY ok DESC, CASE WHEN ok THEN k ELSE -k END) AS n FROM a WHERE k <= 3)
SELECT o_custkey, attempt AS o_orderkey, ok FROM r WHERE n = 1
""")
def retry_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    attempts = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderstatus") == "F").alias("ok"), place.alias("attempt"))
    return C.outcome_of_attempts(attempts, ["o_custkey"]).select("o_custkey", "o_orderkey", "ok")


@query("""
WITH s AS (SELECT user_id, event_id, epoch(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY epoch(ts)) - 1 AS k FROM events)
SELECT user_id, CAST(floor(max(start)) AS BIGINT) AS last_start, count(*) AS calls FROM (
  SELECT user_id, max(t - 3600.0 * k) OVER (PARTITION BY user_id ORDER BY t, k ROWS UNBOUNDED PRECEDING) + 3600.0 * k AS start FROM s) GROUP BY user_id
""")
def rate_limiter(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = table(spark, sf_dir, "events").select("user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("ts"))
    out = C.rate_limited(calls, ["user_id"], F.lit(3600.0))
    return out.groupBy("user_id").agg(F.floor(F.max("start")).cast("bigint").alias("last_start"), F.count("*").alias("calls"))


@query("SELECT count(DISTINCT o_custkey) FILTER (o_orderstatus = 'F') AS notices, count(*) FILTER (o_orderstatus = 'F') AS documents, count(*) FILTER (o_orderstatus <> 'F') AS failed FROM orders")
def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "ok").otherwise("failed")
    return A.batch_totals(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("notice_id"), status.alias("status")))


@query("SELECT doc_id, source, lang, CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT) AS notice_id, n_chars FROM documents WHERE regexp_matches(source, '^src[0-9]+$')")
def discovery_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    listing = docs.withColumn("path", F.concat(F.lit("/d/notice_"), F.regexp_extract("source", r"\Asrc([0-9]+)\z", 1), F.lit("_t/"), F.col("doc_id").cast("string"), F.lit(".pdf"))).withColumn("length", F.col("n_chars"))
    found = captured.discovered(listing.select("path", "length"))
    ids = found.select(F.regexp_replace("file", r"\.pdf\z", "").cast("bigint").alias("doc_id"), F.col("notice_id").cast("bigint").alias("notice_id"))
    return docs.join(ids, "doc_id").select("doc_id", "source", "lang", "notice_id", "n_chars")


@query("SELECT user_id, CASE WHEN count(*) > 0 THEN count(*) / 30.0 ELSE 0 END AS items_per_second FROM events GROUP BY user_id")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return A.run_metrics(n, F.col("n"), F.lit(30.0)).select("user_id", "items_per_second")


# Operators on page and document formats that the synthetic tables do not hold run on pages and
# documents made of those tables; the SQL says what must come out of them from the tables alone.

_LISTED = """
WITH c AS (SELECT *, c_custkey // 20 AS page, row_number() OVER (PARTITION BY c_custkey // 20 ORDER BY c_custkey) AS place FROM customer),
fit AS (SELECT *, CAST(c_custkey AS VARCHAR) AS k FROM c WHERE c_custkey % 11 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 17 <> 0)
"""


def _list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generated.list_pages(table(spark, sf_dir, "customer"))


def _detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generated.detail_pages(table(spark, sf_dir, "part"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.documents(generated.json_documents(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")))


def _entries(c: str) -> Column:
    """A map as text, in order of its keys."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda x: F.concat_ws("=", x["key"], x["value"])), ";")


@query(_LISTED + """
SELECT CAST(page AS INTEGER) AS page_number, CAST(place AS INTEGER) AS row_number, k AS sequence_number, c_mktsegment AS jurisdiction, c_name || 'trustee' AS bankruptcy_trustee,
  'Lot ' || k || ' & more' || CASE WHEN c_custkey % 3 = 0 THEN 'file' ELSE 'none' END AS notice_title, CAST(c_custkey % 7 AS VARCHAR) AS view_count,
  CASE WHEN c_custkey % 4 = 0 THEN 'additional_field_5=more ' || k || ';additional_field_6=ab' ELSE '' END AS additional,
  'Lot  ' || k || ' & more>/view.do?seq_id=' || k || '&p=1' || CASE WHEN c_custkey % 3 = 0 THEN ';file>' || k || '.pdf' ELSE '' END AS hrefs, '2024-05-06T07:08:09' AS extraction_date
FROM fit
""")
def list_row_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = N.list_rows(_list_pages(spark, sf_dir), now=_CLOCK)
    hrefs = F.array_join(F.transform("links", lambda x: F.concat(x["text"], F.lit(">"), x["href"])), ";")
    return rows.select("page_number", "row_number", *N.FIELDS, _entries("additional_fields").alias("additional"), hrefs.alias("hrefs"), "extraction_date")


@query("""
WITH p AS (SELECT c_custkey // 20 AS n, count(*) FILTER (c_custkey % 11 = 0 OR c_custkey % 13 <> 0) AS filled, count(*) FILTER (c_custkey % 17 = 0 AND c_custkey % 11 <> 0 AND c_custkey % 13 <> 0) AS none FROM customer GROUP BY 1)
SELECT CAST(n AS INTEGER) AS page_number, CAST(CASE WHEN n % 5 = 4 OR n % 7 = 3 THEN 1 ELSE n END AS INTEGER) AS current_page, n % 3 <> 0 AS has_next, n % 4 = 1 AS has_previous, none = 0 AND filled > 0 AS has_data FROM p
""")
def pagination_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _list_pages(spark, sf_dir)
    return N.page_info(pages).where("total_pages is null").join(N.has_data(pages), "page_number").drop("total_pages")


_DETAILED = """
WITH p AS (SELECT p_partkey AS n, CAST(p_partkey AS VARCHAR) AS k, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS size FROM part),
d AS (SELECT n, k,
  CASE WHEN n % 4 IN (0, 2) THEN p_name || ' second line ' || k WHEN n % 4 = 1 AND length(repeat(p_name || ' ', 12)) - 1 > 100 THEN rtrim(repeat(p_name || ' ', 12)) ELSE '' END AS notice_content,
  CASE WHEN n % 3 = 0 THEN '2024-1-' || CAST(n % 28 + 1 AS VARCHAR) WHEN n % 3 = 1 THEN '2023년  5월 1일' ELSE '' END AS notice_date,
  CASE WHEN n % 6 = 0 THEN '서울 법원  ' || k ELSE '' END AS jurisdiction_full,
  CASE WHEN n % 5 = 0 THEN 'A-' || k WHEN n % 5 = 1 THEN '2024하합' || k ELSE '' END AS case_details,
  CASE WHEN n % 7 = 0 THEN '02-' || k ELSE '' END AS contact_info, CASE WHEN n % 8 = 0 THEN k || '일' ELSE '' END AS deadline_info,
  'k=v' || k || ';size=' || size || ';type=last ' || k AS additional FROM p)
"""
_DETAILS = ("notice_content", "notice_date", "jurisdiction_full", "case_details", "contact_info", "deadline_info")


@query(_DETAILED + f"SELECT k AS sequence_number, {', '.join(_DETAILS)}, additional, CAST(NULL AS VARCHAR) AS error, '2024-05-06T07:08:09' AS extraction_date FROM d")
def detail_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.details(_detail_pages(spark, sf_dir), now=_CLOCK).select("sequence_number", *_DETAILS, _entries("additional_info").alias("additional"), "error", "extraction_date")


_SCRIPTED = "'javascript:download(''' || k || '_1.pdf'',''Lot%20' || k || '%ZZ+a.hwp'')'"
_LINKS = ("type", "file_id", "display_name", "link_text", "href", "file_extension", "filename", "onclick")


@query(f"""
WITH p AS (SELECT p_partkey AS n, CAST(p_partkey AS VARCHAR) AS k FROM part),
l(o, type, file_id, display_name, link_text, href, file_extension, filename, onclick, k) AS (
  SELECT 0, 'javascript_download', k || '_1.pdf', 'Lot%20' || k || '%ZZ+a.hwp', 'script', {_SCRIPTED}, NULL, NULL, NULL, k FROM p
  UNION ALL SELECT 10, 'direct_link', NULL, NULL, 'script', {_SCRIPTED}, '.pdf', NULL, NULL, k FROM p
  UNION ALL SELECT 20, 'direct_link', NULL, NULL, 'form', '/files/' || k || '.docx?x=1', '.doc', NULL, NULL, k FROM p WHERE n % 2 = 0
  UNION ALL SELECT 30, 'direct_link', NULL, NULL, 'form', '/files/' || k || '.docx?x=1', '.docx', NULL, NULL, k FROM p WHERE n % 2 = 0
  UNION ALL SELECT 40, 'direct_link', NULL, NULL, 'script', {_SCRIPTED}, '.hwp', NULL, NULL, k FROM p
  UNION ALL SELECT 50, 'direct_link', NULL, NULL, 'upper', 'http://h/p/B.XLS', '.xls', NULL, NULL, k FROM p WHERE n % 9 = 0
  UNION ALL SELECT 60, 'onclick_download', NULL, NULL, 'b', NULL, NULL, NULL, 'Download(1)', k FROM p WHERE n % 10 = 0
  UNION ALL SELECT 61, 'onclick_download', NULL, NULL, 'c', NULL, NULL, NULL, 'download(2)', k FROM p WHERE n % 10 = 0)
SELECT k AS sequence_number, CAST(row_number() OVER (PARTITION BY k ORDER BY o) - 1 AS INTEGER) AS position, {', '.join(_LINKS)} FROM l
""")
def attachment_links_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.attachment_rows(N.details(_detail_pages(spark, sf_dir))).drop("planned_name")


@query(f"""
WITH p AS (SELECT p_partkey AS n, CAST(p_partkey AS VARCHAR) AS k FROM part),
l(o, type, file_id, display_name, link_text, href, file_extension, filename, onclick, k, name) AS (
  SELECT 0, 'javascript_download', k || '_1.pdf', 'Lot ' || k || '%ZZ+a.hwp', 'script', {_SCRIPTED}, NULL, NULL, NULL, k, 'Lot ' || k || '%ZZ+a.hwp' FROM p
  UNION ALL SELECT 10, 'direct_link', NULL, NULL, 'script', {_SCRIPTED}, NULL, 'download(''' || k || '_1.pdf'',''Lot%20' || k || '%ZZ+a.hwp'')', NULL, k, 'download(''' || k || '_1.pdf'',''Lot%20' || k || '%ZZ+a.hwp'').pdf' FROM p
  UNION ALL SELECT 20, 'direct_link', NULL, NULL, 'form', '/files/' || k || '.docx?x=1', NULL, k || '.docx', NULL, k, k || '.docx' FROM p WHERE n % 2 = 0
  UNION ALL SELECT 61, 'onclick_download', NULL, NULL, 'c', NULL, NULL, NULL, 'download(2)', k, 'c.pdf' FROM p WHERE n % 10 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY o) AS i FROM l)
SELECT k AS sequence_number, CAST(i - 1 AS INTEGER) AS position, {', '.join(_LINKS)}, lpad(CAST(i AS VARCHAR), 2, '0') || '_' || name AS planned_name FROM r
""")
def attachment_links_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.attachment_rows(N.details(_detail_pages(spark, sf_dir), live=True))


@query(_LISTED.strip() + ", " + _DETAILED.strip().removeprefix("WITH ") + """
SELECT fit.k AS sequence_number, c_mktsegment AS jurisdiction, coalesce(d.notice_content, '-') AS notice_content, coalesce(d.additional, '-') AS additional, d.n IS NULL AS detail_processing_failed,
  CASE WHEN d.n IS NULL THEN '2024-05-06T07:08:09' ELSE '2030-01-01T00:00:00' END AS extraction_date, CASE WHEN d.n IS NOT NULL THEN '/view.do?seq_id=' || fit.k END AS detail_url
FROM fit LEFT JOIN d ON d.n = fit.c_custkey AND d.n % 3 <> 0
""")
def notice_detail_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices of which a third have no detail page."""
    part = table(spark, sf_dir, "part").where("p_partkey % 3 <> 0")
    pages = generated.detail_pages(part).withColumn("detail_url", F.concat(F.lit("/view.do?seq_id="), "sequence_number"))
    out = N.merged(N.list_rows(_list_pages(spark, sf_dir), now=_CLOCK), N.details(pages, now=_LATER))
    return out.select("sequence_number", "jurisdiction", F.coalesce("notice_content", F.lit("-")).alias("notice_content"), F.coalesce(_entries("additional_info"), F.lit("-")).alias("additional"), "detail_processing_failed", "extraction_date", "detail_url")


_LINES = """
WITH o AS (SELECT * FROM orders WHERE o_orderkey % 50 <> 0),
l AS (SELECT l.*, o_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS i FROM lineitem l JOIN o ON o_orderkey = l_orderkey),
t(doc_key, ord, path, page_number, element_type, text, x0, y0, x1, y1, font, font_size, heading_level) AS (
  SELECT o_orderkey, 0, '0', 1, 'heading', o_orderstatus, 0.0, 0.0, 0.0, 0.0, 'F', NULL, 2 FROM o
  UNION ALL SELECT k, i, '1/' || CAST(i - 1 AS VARCHAR), l_linenumber, 'paragraph', l_returnflag || ' ' || CAST(l_partkey AS VARCHAR), 10.0 * l_linenumber, 0.0, 100.0, l_quantity, NULL, CASE WHEN l_linenumber % 2 = 0 THEN 9.5 END, NULL FROM l)
"""


@query(_LINES + "SELECT doc_key, CAST(ord AS INTEGER) AS ord, path, CAST(page_number AS INTEGER) AS page_number, element_type, text, CAST(x0 AS DOUBLE) AS x0, CAST(y0 AS DOUBLE) AS y0, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, font, CAST(font_size AS DOUBLE) AS font_size, CAST(coalesce(heading_level, -1) AS INTEGER) AS heading_level FROM t")
def pdf_tree_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.texts(_documents(spark, sf_dir)).select("*", "bbox.*").drop("bbox").withColumns({"path": F.array_join(F.col("path").cast("array<string>"), "/"), "heading_level": F.coalesce("heading_level", F.lit(-1))})


@query("""
SELECT o_orderkey AS doc_key, CASE WHEN o_orderkey % 50 <> 0 THEN 'o' || CAST(o_orderkey AS VARCHAR) || '.pdf' END AS file_name,
  CAST(CASE WHEN o_orderkey % 50 = 0 THEN -1 WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_orderkey % 3 END AS INTEGER) AS page_count, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderpriority END AS title, o_orderkey % 50 = 0 AS failed FROM orders
""")
def pdf_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.headers(_documents(spark, sf_dir)).select("doc_key", "file_name", F.coalesce("page_count", F.lit(-1)).alias("page_count"), F.col("metadata")["title"].alias("title"), F.col("error").isNotNull().alias("failed"))


@query(_LINES + """
SELECT k AS doc_key, 1 AS table_index, 2 AS page_number, CAST(max(i) AS INTEGER) AS row_count, 3 AS col_count, string_agg(l_returnflag || ' ' || l_linestatus || ',,' || CAST(l_partkey AS VARCHAR), '|' ORDER BY i) AS cells FROM l GROUP BY k
""")
def pdf_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.array_join(F.transform("data", lambda r: F.array_join(r, ",")), "|")
    return P.tables(_documents(spark, sf_dir)).select("doc_key", "table_index", "page_number", "row_count", "col_count", rows.alias("cells"))


@query("""
SELECT o_orderkey AS doc_key, CAST(i AS INTEGER) AS image_index, CASE WHEN i = 0 THEN 2 ELSE 0 END AS page_number, CASE WHEN i = 0 THEN 'a.png' END AS image_path, CASE WHEN i = 0 THEN 4.5 ELSE 0.0 END::DOUBLE AS y1
FROM orders, (VALUES (0), (1)) AS v(i) WHERE o_orderkey % 2 = 0 AND o_orderkey % 50 <> 0
""")
def pdf_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.images(_documents(spark, sf_dir)).select("doc_key", "image_index", "page_number", "image_path", "bbox.y1")


@query(_LINES + "SELECT doc_key, string_agg(text, chr(10) ORDER BY page_number, y1 DESC, x0, ord) AS full_text FROM t GROUP BY doc_key")
def pdf_full_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.full_text(_documents(spark, sf_dir)).where("full_text is not null")


@query("""
WITH RECURSIVE c AS (SELECT o_custkey, CAST(o_orderkey AS DOUBLE) AS ts, o_orderstatus = 'F' AS ok, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders),
r AS (
  SELECT o_custkey, ts, ok, i, 'closed' AS state, true AS allowed, CASE WHEN ok THEN 0 ELSE 1 END AS n, CASE WHEN ok THEN 0.0 ELSE ts END AS since FROM c WHERE i = 1
  UNION ALL
  SELECT o_custkey, ts, ok, i, state, state <> 'open', CASE WHEN state = 'open' THEN n WHEN ok AND state = 'half_open' THEN 0 WHEN ok THEN n ELSE n + 1 END, CASE WHEN state = 'open' OR ok THEN since ELSE ts END
  FROM (SELECT c.o_custkey, c.ts, c.ok, c.i, CASE WHEN r.n < 3 THEN 'closed' WHEN r.allowed AND r.state = 'half_open' AND r.ok THEN 'closed' WHEN c.ts - r.since < 1500 THEN 'open' ELSE 'half_open' END AS state, r.n, r.since FROM r JOIN c ON c.o_custkey = r.o_custkey AND c.i = r.i + 1))
SELECT o_custkey, ts, ok, state, allowed FROM r
""")
def circuit_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer as calls, their keys as seconds."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").cast("double").alias("ts"), (F.col("o_orderstatus") == "F").alias("ok"))
    return C.breaker(rows, ["o_custkey"], failures=3, rest_seconds=1500.0)


_PROBES = [(1, 100_000), (3, 57), (1_000_000, 1_000_050)]


@query("WITH d AS (SELECT page_id + 1 AS p FROM pages), a(start, most) AS (VALUES " + ", ".join(map(str, _PROBES)) + """),
j AS (SELECT start, most, unnest(generate_series(start, most, 10)) AS p FROM a),
g AS (SELECT a.start, a.most, (SELECT min(p) FROM j WHERE j.start = a.start AND p NOT IN (SELECT p FROM d)) AS gap, (SELECT max(p) FROM j WHERE j.start = a.start) AS top FROM a),
b AS (SELECT start, most, CASE WHEN gap IS NULL THEN top ELSE greatest(gap - 10, start) END AS base FROM g)
SELECT start AS first, CAST(coalesce((SELECT min(x) - 1 FROM (SELECT p + 1 AS x FROM d WHERE p >= base AND p + 1 NOT IN (SELECT p FROM d) UNION ALL SELECT most + 1) WHERE base IN (SELECT p FROM d)), start) AS INTEGER) AS last_page FROM b
""")
def last_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select((F.col("page_id") + 1).cast("int").alias("page_number"), F.lit(True).alias("has_data"))
    found = [C.last_page(pages, start, most).select(F.lit(start).alias("first"), "last_page") for start, most in _PROBES]
    return found[0].union(found[1]).union(found[2])

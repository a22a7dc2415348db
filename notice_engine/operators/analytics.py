"""Summaries and searches over the store and over crawled notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notice_engine.functions.text import SPACE

BIG = "decimal(38,0)"


def processing_summary(parents: DataFrame, key: str, size: Column, children: list[tuple[str, DataFrame, Column | None]]) -> DataFrame:
    """Per parent: for each child (name, rows with ``parent_key``, what is counted as distinct or None for rows) a count, and total_size.

    total_size is the sum of the parent's size over the join of parent and all
    children, that is the size times the number of rows of each child that has any.
    Children are aggregated before they are joined, so the product never exists as rows.
    """
    out = parents
    factor = F.lit(1).cast(BIG)
    for k, (name, rows, distinct) in enumerate(children):
        n = F.count("*").alias(f"_n{k}")
        counted = F.countDistinct(distinct) if distinct is not None else F.count("*")
        small = rows.groupBy(F.col("parent_key").alias(f"_k{k}")).agg(n, counted.alias(name))
        out = out.join(small, out[key] == small[f"_k{k}"], "left").drop(f"_k{k}").withColumn(name, F.coalesce(name, F.lit(0)).cast("bigint"))
        factor = (factor * F.greatest(F.coalesce(f"_n{k}", F.lit(1)), F.lit(1)).cast("decimal(12,0)")).cast(BIG)
    out = out.withColumn("total_size", F.coalesce((size.cast("decimal(20,0)") * factor).cast(BIG), F.lit(0).cast(BIG)))
    return out.drop(*[f"_n{k}" for k in range(len(children))])


def naive_summary(parents: DataFrame, key: str, size: Column, children: list[tuple[str, DataFrame, Column | None]]) -> DataFrame:
    """The same by joining everything and aggregating afterwards; for tests and the bench."""
    out, names = parents.withColumn("_size", size), parents.columns
    aggs = []
    for k, (name, rows, distinct) in enumerate(children):
        tagged = rows.withColumn("_row", F.monotonically_increasing_id()) if distinct is None else rows.withColumn("_row", distinct)
        tagged = tagged.select(F.col("parent_key").alias(f"_k{k}"), F.col("_row").alias(f"_r{k}"))
        out = out.join(tagged, out[key] == tagged[f"_k{k}"], "left")
        aggs.append(F.countDistinct(f"_r{k}").alias(name))
    total = F.coalesce(F.sum(F.col("_size").cast(BIG)), F.lit(0).cast(BIG)).cast(BIG)
    return out.groupBy(*names).agg(*aggs, total.alias("total_size"))


def store_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """The store's summary view."""
    docs = tables["pdf_documents"].select("id", "notice_id", "file_name", "page_count", "processed_at", "file_size")
    child = lambda name: tables[name].withColumnRenamed("document_id", "parent_key")
    out = processing_summary(docs, "id", F.col("file_size"), [("pages_with_text", child("pdf_text_content"), F.col("page_number")), ("total_tables", child("pdf_tables"), None), ("total_images", child("pdf_images"), None)])
    return out.select("notice_id", "file_name", "page_count", "processed_at", "pages_with_text", "total_tables", "total_images", F.col("total_size").alias("total_file_size_bytes"))


def latest(rows: DataFrame, at: str, ties: list[str], n: int = 100) -> DataFrame:
    """The newest rows; ties in a fixed order."""
    return rows.orderBy(F.desc(at), *ties).limit(n)


def search_terms(term: str) -> list[str]:
    """Two-character tokens of a lower-cased term; tokens do not span white space."""
    found = [w[k : k + 2] for w in term.lower().split() for k in range(len(w) - 1)]
    return list(dict.fromkeys(found))


def matches(text: Column, term: str) -> Column:
    """Whether a text has any of the term's tokens. The tokens are literals, so the scan tests them without building arrays."""
    met = F.lit(False)
    for token in search_terms(term):
        met = met | F.contains(F.lower(text), F.lit(token))
    return met


def search(texts: DataFrame, documents: DataFrame, term: str, n: int = 50) -> DataFrame:
    """Text rows that match, with their documents, newest first."""
    hit = texts.where(matches(F.col("text_content"), term))
    docs = documents.select(F.col("id").alias("document_id"), "notice_id", "file_name", "processed_at")
    found = hit.join(docs, "document_id").select("notice_id", "file_name", "page_number", "text_content", "font_size", "font_name", "processed_at", "id")
    return found.orderBy(F.desc("processed_at"), "notice_id", "file_name", "id").limit(n).drop("id")


def bigram_index(texts: DataFrame) -> DataFrame:
    """(token, id): an inverted index for large stores, each token of a text once."""
    words = F.filter(F.split(F.lower("text_content"), rf"(?U){SPACE}+"), lambda w: F.length(w) >= 2)
    tokens = F.flatten(F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda k: F.substr(w, k, F.lit(2)))))
    return texts.select("id", F.explode(F.array_distinct(tokens)).alias("token"))


def search_indexed(index: DataFrame, texts: DataFrame, documents: DataFrame, term: str, n: int = 50) -> DataFrame:
    ids = index.where(F.col("token").isin(search_terms(term))).select("id").distinct()
    return search(texts.join(ids, "id", "left_semi"), documents, term, n)


def counts(rows: DataFrame, page: Column) -> DataFrame:
    """Rows, different pages (missing ones are page 0) and rows per page."""
    out = rows.agg(F.count("*").alias("total_items"), F.countDistinct(F.coalesce(page, F.lit(0))).alias("pages_crawled"))
    return out.withColumn("items_per_page", F.when(F.col("pages_crawled") > 0, F.col("total_items") / F.col("pages_crawled")).otherwise(0.0))


def filled(c: Column, kind: str) -> Column:
    """Whether a value counts as filled: not null, not 0, not false, not empty, not blank as text."""
    if kind == "string":
        return F.coalesce(F.regexp_replace(c, rf"(?U)\A{SPACE}+|{SPACE}+\z", "") != "", F.lit(False))
    if kind == "boolean":
        return F.coalesce(c, F.lit(False))
    if kind.startswith(("array", "map")):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return F.coalesce(c != 0, F.lit(False))
    return c.isNotNull()


def field_profile(rows: DataFrame, optional: tuple[str, ...] = ()) -> DataFrame:
    """field, total (rows that have the field: all, for ``optional`` ones those not null), non_empty, fill_rate. One pass, then as many rows as columns."""
    kinds = dict(rows.dtypes)
    aggs = []
    for c in rows.columns:
        total = F.count(F.col(c)) if c in optional else F.count("*")
        aggs.append(F.struct(F.lit(c).alias("field"), total.alias("total"), F.count_if(filled(F.col(c), kinds[c])).alias("non_empty")).alias(c))
    out = rows.agg(*aggs).select(F.inline(F.array(*[F.col(f"`{c}`") for c in rows.columns])))
    return out.where("total > 0").withColumn("fill_rate", F.col("non_empty") / F.col("total") * 100)


def group_share(rows: DataFrame, group: Column, order: Column, name: str = "jurisdiction") -> DataFrame:
    """Rows of each group and their share, largest first, ties by first appearance; missing groups are ``Unknown``."""
    out = rows.groupBy(F.coalesce(group, F.lit("Unknown")).alias(name)).agg(F.count("*").alias("n"), F.min(order).alias("first_seen"))
    return out.withColumn("percentage", F.col("n") / F.sum("n").over(Window.partitionBy()) * 100).orderBy(F.desc("n"), "first_seen")


def attachment_summary(rows: DataFrame, attachments: str = "attachments", errors: str = "download_errors") -> DataFrame:
    """One row over per-notice arrays; megabytes are rounded half to even."""
    total = F.coalesce(F.sum(F.aggregate(F.transform(attachments, lambda a: F.coalesce(a["file_size"].cast("bigint"), F.lit(0).cast("bigint"))), F.lit(0).cast("bigint"), lambda s, x: s + x)), F.lit(0))
    n = F.coalesce(F.size(attachments), F.lit(0))
    out = rows.agg(
        F.count("*").alias("total_notices_processed"),
        F.coalesce(F.sum(n), F.lit(0)).alias("total_attachments_downloaded"),
        F.coalesce(F.sum(F.size(errors)), F.lit(0)).alias("total_download_errors"),
        total.alias("total_size_bytes"),
        F.count_if(n > 0).alias("notices_with_attachments"),
        F.count_if(n <= 0).alias("notices_without_attachments"),
    )
    return out.withColumn("total_size_mb", F.bround((F.col("total_size_bytes") / 1048576.0).cast("decimal(38,12)"), 2).cast("double"))


def crawl_summary(notices: DataFrame, start_page: int, current_page: int, downloads: DataFrame | None = None) -> DataFrame:
    """Totals of a crawl; those of the downloads replace its own where both have them."""
    out = notices.agg(F.count("*").alias("total_notices_processed"), F.count_if(F.coalesce("attachment_count", F.lit(0)) > 0).alias("notices_with_attachments")).withColumn("total_pages_processed", F.lit(current_page - start_page))
    if downloads is None:
        return out
    summary = attachment_summary(downloads)
    mine = [c for c in out.columns if c not in summary.columns]
    one = F.lit(1)
    return out.select(*mine, one.alias("_k")).join(summary.withColumn("_k", one), "_k").drop("_k")


def run_metrics(rows: DataFrame, items: Column, seconds: Column) -> DataFrame:
    return rows.withColumn("items_per_second", F.when(seconds > 0, items / seconds).otherwise(0.0))


def preview_estimate(pages: DataFrame, last_page: int) -> DataFrame:
    """(item_count) of sampled pages -> average over those with data, times the last page."""
    mean = F.coalesce(F.avg(F.when(F.col("item_count") > 0, F.col("item_count"))), F.lit(0.0))
    return pages.agg(mean.alias("average_items"), (mean * last_page).alias("estimated_items"))


def batch_totals(outcomes: DataFrame) -> DataFrame:
    """(notice_id, status) -> notices with documents, documents, failures."""
    ok = F.col("status") == "ok"
    return outcomes.agg(F.countDistinct(F.when(ok, F.col("notice_id"))).alias("notices"), F.count_if(ok).alias("documents"), F.count_if(~ok).alias("failed"))


def error_stats(events: DataFrame) -> DataFrame:
    """(operation, ok, ord, and error if there is such a column): failures since the last success of each operation, and its last error."""
    last = events.groupBy("operation").agg(F.max(F.when(F.col("ok"), F.col("ord"))).alias("_last"))
    said = [F.max_by(F.when(~F.col("ok"), F.col("error")), F.when(~F.col("ok"), F.col("ord"))).alias("last_error")] if "error" in events.columns else []
    return events.join(last, "operation").groupBy("operation").agg(F.count_if(~F.col("ok") & (F.col("ord") > F.coalesce("_last", F.lit(-1)))).alias("error_count"), *said)

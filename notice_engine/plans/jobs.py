"""Jobs: what a crawl, and a batch of documents, do with captured inputs."""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notice_engine.operators import analytics as A
from notice_engine.operators import crawl_log as C
from notice_engine.operators import notices as N
from notice_engine.operators.store import SnapshotStore
from notice_engine.session import written
from notice_engine.sources import captured, sinks


@dataclass
class PipelineConfig:
    downloads: str = "downloads"
    json_output: str = "output/pdf_json"
    images: str | None = None
    formats: tuple[str, ...] = ("json",)
    hybrid: str | None = None
    hybrid_url: str | None = None
    hybrid_fallback: bool = True

    def converter_options(self) -> dict[str, object]:
        """Hybrid settings are passed on only when there is a hybrid backend."""
        out: dict[str, object] = {"format": ",".join(self.formats)}
        if self.hybrid:
            out |= {"hybrid": self.hybrid, "hybrid_fallback": self.hybrid_fallback} | ({"hybrid_url": self.hybrid_url} if self.hybrid_url else {})
        return out


@dataclass
class DatabaseConfig:
    host: str = "localhost"
    port: int = 3306
    user: str = "root"
    password: str = field(default="", repr=False)
    database: str = "notices"

    @classmethod
    def from_environment(cls, environment=os.environ) -> DatabaseConfig:
        names = {"host": "DB_HOST", "port": "DB_PORT", "user": "DB_USER", "password": "DB_PASSWORD", "database": "DB_NAME"}
        given = {k: environment[v] for k, v in names.items() if v in environment}
        return cls(**(given | ({"port": int(given["port"])} if "port" in given else {})))


def crawl(pages: DataFrame, start: int = 1, most: int | None = None) -> DataFrame:
    """Captured list pages (page_number, html, status) -> notices of the pages that a crawl would visit before it stops."""
    pages = C.page_window(pages, start, most).select("page_number", "html", "status")
    rows = written(N.list_rows(pages.where("status = 'ok'").select("page_number", "html")), "crawl-rows")
    counted = rows.groupBy("page_number").agg(F.count("*").alias("n"))
    log = pages.select("page_number", "status").join(counted, "page_number", "left").select("page_number", F.when(F.col("status") == "ok", F.coalesce("n", F.lit(0))).alias("item_count"))
    kept = C.stop_rule(log, [])
    return rows.join(kept.select("page_number"), "page_number", "left_semi")


def crawl_with_details(pages: DataFrame, details: DataFrame, start: int = 1, most: int | None = None) -> DataFrame:
    """``details``: captured (href, html). Each notice with the detail its first link opens."""
    notices = written(crawl(pages, start, most).withColumn("detail_url", F.col("links")[0]["href"]), "crawl-notices")
    targets = N.detail_targets(notices.where("detail_url is not null").select(F.col("detail_url").alias("href")).distinct(), details)
    found = notices.join(targets, notices["detail_url"] == targets["href"]).select("sequence_number", F.col("html"))
    out = N.merged(notices, N.details(found.dropDuplicates(["sequence_number"])))
    return out.withColumn("attachment_count", F.coalesce(F.size("attachment_links"), F.lit(0)))


def process_downloads(spark: SparkSession, config: PipelineConfig, convert=None) -> DataFrame:
    """Discover, convert (with the given hook; else existing JSON is used), read and tell successes from failures."""
    found = written(captured.discovered(captured.pdf_listing(spark, config.downloads)), "discovered")
    staged = found.withColumn("stem", captured.staged_name(F.col("idx"), F.col("notice_id"), F.regexp_replace("file", r"\.pdf\z", "")))
    if convert is not None:
        captured.convert([(r["stem"], r["source_path"]) for r in staged.select("stem", "source_path").toLocalIterator()], convert)
    return captured.conversion_outcome(staged, captured.json_documents(spark, config.json_output))


def store_batch(store: SnapshotStore, outcome: DataFrame) -> DataFrame:
    good = outcome.where("status = 'ok'").select("notice_id", "source_path", F.col("length").alias("file_size"), F.struct("folder", "file").alias("_o"), F.col("doc").withField("file_name", F.col("file")).alias("doc"))
    return store.save(good.withColumn("ord", F.to_json("_o")).drop("_o"))


def arguments() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(description="Notices from captured pages, and documents from extractor JSON")
    sub = out.add_subparsers(dest="job", required=True)
    c = sub.add_parser("crawl")
    c.add_argument("--pages-table", required=True)
    c.add_argument("--details-table")
    c.add_argument("--start-page", type=int, default=1)
    c.add_argument("--max-pages", type=int)
    c.add_argument("--pages", help="comma-separated page numbers")
    c.add_argument("--format", choices=("csv", "json", "both"), default="both")
    c.add_argument("--output", default="output")
    d = sub.add_parser("documents")
    d.add_argument("--downloads", default="downloads")
    d.add_argument("--json-output", default="output/pdf_json")
    d.add_argument("--store")
    return out


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if args.job == "crawl":
        pages = captured.captured_pages(spark, args.pages_table)
        if args.pages:
            pages = pages.where(F.col("page_number").isin([int(p) for p in args.pages.split(",")]))
        rows = crawl_with_details(pages, spark.read.parquet(args.details_table), args.start_page, args.max_pages) if args.details_table else crawl(pages, args.start_page, args.max_pages)
        for kind, path in sinks.save(rows, args.output, "notices", args.format).items():
            print(kind, path)
        return
    outcome = written(process_downloads(spark, PipelineConfig(args.downloads, args.json_output)), "outcome")
    print(A.batch_totals(outcome).first().asDict())
    if args.store:
        store_batch(SnapshotStore(spark, args.store), outcome).show(truncate=False)


if __name__ == "__main__":
    main()

import json
import random
from datetime import datetime

from pyspark.sql import functions as F

from notice_engine.operators import analytics as A
from notice_engine.operators import crawl_log as C
from notice_engine.plans import jobs
from notice_engine.sources import sinks
from notice_engine.testing import fixtures


def python_stop(items):
    kept, empty = [], 0
    for page, n in enumerate(items, start=1):
        kept.append(page)
        empty = 0 if n else empty + 1
        if empty == 3:
            break
    return kept


def test_stop_rule(spark):
    rng = random.Random(5)
    runs = [[rng.choice([None, 0, 4, 1]) for _ in range(12)] for _ in range(40)] + [[1, 0, 0, 2, 0, None, 0, 5]]
    log = spark.createDataFrame([(k, p, n) for k, items in enumerate(runs) for p, n in enumerate(items, start=1)], "k int, page_number int, item_count int")
    got: dict[int, list[int]] = {}
    for r in C.stop_rule(log, ["k"]).collect():
        got.setdefault(r["k"], []).append(r["page_number"])
    assert {k: sorted(v) for k, v in got.items()} == {k: python_stop(items) for k, items in enumerate(runs)}


def python_last(data, start, most, step=10):
    page, last = start, start
    while page <= most and page in data:
        last, page = page, page + step
    page = last
    while page <= most and page in data:
        last, page = page, page + 1
    return last


def test_last_page(spark):
    rng = random.Random(2)
    for data in (set(), {1}, set(range(1, 38)), set(range(1, 38)) - {34}, set(range(2, 30)), {p for p in range(1, 60) if rng.random() < 0.9}):
        pages = spark.createDataFrame([(p, True) for p in sorted(data)] + [(99, False)], "page_number int, has_data boolean")
        for most in (20, 50):
            assert C.last_page(pages, 1, most).first()["last_page"] == python_last(data, 1, most), (sorted(data), most)


def test_pages_attempts_and_rate(spark):
    pages = spark.createDataFrame([(1, 5), (2, None), (3, 0)], "page_number int, item_count int")
    got = C.specific_pages(pages, [3, 1, 3, 9, 2]).collect()
    assert [(r["wanted"], r["failed"]) for r in got] == [(3, False), (1, False), (3, False), (9, True), (2, True)] and C.page_range([3, 1, 9]) == "1-9"
    assert [r["page_number"] for r in C.sample_prefix(spark.createDataFrame([(1, 4), (2, 0), (3, 1)], "page_number int, item_count int"), [], 3).orderBy("page_number").collect()] == [1, 2]
    assert [r["page_number"] for r in C.sample_prefix(pages, [], 3).collect()] == [1]
    tries = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("a", 3, True), ("b", 1, False), ("b", 2, False), ("b", 4, True)], "k string, attempt int, ok boolean")
    assert {r["k"]: (r["attempt"], r["ok"]) for r in C.outcome_of_attempts(tries, ["k"]).collect()} == {"a": (2, True), "b": (2, False)}
    calls = spark.createDataFrame([(0.0,), (0.5,), (5.0,), (5.1,)], "ts double").withColumn("k", F.lit(1))
    assert [r["start"] for r in C.rate_limited(calls, ["k"], F.lit(2.0)).orderBy("ts").collect()] == [0.0, 2.0, 5.0, 7.0]
    assert C.retry_delays(3, 2.0) == [2.0, 3.0, 4.5]


def test_missing_pages_are_failed_pages(spark):
    log = spark.createDataFrame([(1, 3), (2, 0), (6, 4), (9, 1)], "page_number int, item_count int")
    assert sorted(r["page_number"] for r in C.stop_rule(log, []).collect()) == [1, 2, 3, 4]
    assert C.stop_rule(log.limit(0), []).count() == 0


def test_breaker(spark):
    events = [(float(t), ok) for t, ok in [(0, True), *[(k, False) for k in range(1, 6)], (6, True), (65, True), (71, False)]]
    rows = C.breaker(spark.createDataFrame(events, "ts double, ok boolean").withColumn("k", F.lit(1)), ["k"]).orderBy("ts").collect()
    assert [(r["state"], r["allowed"]) for r in rows] == [("closed", True)] * 6 + [("open", False), ("half_open", True), ("closed", True)]


def test_field_profile_and_shares(spark):
    rows = spark.createDataFrame([("a", 0, ["x"], None, True), (" ", 1, [], "o", False), ("", None, None, None, None), ("b", 2, ["y"], " ", True)], "s string, n int, l array<string>, opt string, f boolean")
    got = {r["field"]: (r["total"], r["non_empty"]) for r in A.field_profile(rows, optional=("opt",)).collect()}
    assert got == {"s": (4, 2), "n": (4, 2), "l": (4, 2), "opt": (2, 1), "f": (4, 2)}
    shares = A.group_share(spark.createDataFrame([(1, "b"), (2, "a"), (3, "a"), (4, "b"), (5, None), (6, "")], "o int, j string"), F.col("j"), F.col("o")).collect()
    assert [(r["jurisdiction"], r["n"]) for r in shares] == [("b", 2), ("a", 2), ("Unknown", 1), ("", 1)]


def test_attachment_summary_rounds_half_even(spark, tmp_path):
    kind = "attachments array<struct<file_size:bigint>>, download_errors array<string>, attachment_count int"
    rows = spark.createDataFrame([([(131072,)], ["e"], 1), ([], [], 0)], kind)
    got = A.attachment_summary(rows).first().asDict()
    assert got["total_size_mb"] == 0.12 and (got["notices_with_attachments"], got["notices_without_attachments"], got["total_download_errors"]) == (1, 1, 1)
    path = sinks.save_attachment_summary(A.attachment_summary(rows), str(tmp_path), datetime(2024, 1, 2))
    assert path.endswith("attachment_summary_20240102_000000.json") and spark.read.json(path).first()["total_size_bytes"] == 131072
    both = A.crawl_summary(rows, 1, 4, rows).first().asDict()
    assert both["total_pages_processed"] == 3 and both["total_attachments_downloaded"] == 1


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "서울", [("t", "h")], None), (2, "부산", None, "x")], "page_number int, jurisdiction string, links array<struct<text:string,href:string>>, extra string")
    now = datetime(2024, 5, 6, 7, 8, 9)
    paths = sinks.save(rows, str(tmp_path), "notices", "both", now, "v1")
    assert paths["csv"].endswith("notices_20240506_070809_v1.csv")
    back = spark.read.option("header", True).option("escape", '"').csv(paths["csv"])
    assert back.columns == ["extra", "jurisdiction", "links", "page_number"]
    assert json.loads(back.where("page_number = 1").first()["links"]) == [{"text": "t", "href": "h"}]
    assert sinks.save(rows.limit(0), str(tmp_path / "none"), "p") == {} and not (tmp_path / "none").exists()
    assert sinks.append(spark.createDataFrame([(3, "new")], "page_number int, unknown string"), paths["csv"])
    assert spark.read.option("header", True).csv(paths["csv"]).count() == 3
    assert not sinks.append(rows, str(tmp_path / "missing.csv"))
    assert sinks.bom_csv(rows).startswith("﻿extra,jurisdiction,links,page_number")
    assert json.loads(sinks.pretty_json(rows))[1]["jurisdiction"] == "부산"
    report = "\n".join(r["value"] for r in sinks.report(rows, now).collect())
    assert "Total Items: 2" in report and "100.0" in report and "50.0" in report


def test_crawl_job(spark, tmp_path):
    pages = fixtures.list_pages(spark).withColumn("status", F.lit("ok"))
    more = spark.createDataFrame([(5, None, "failed"), (6, fixtures.LIST_PAGES[2], "ok")], "page_number int, html string, status string")
    rows = jobs.crawl(pages.unionByName(more))
    assert sorted({r["page_number"] for r in rows.collect()}) == [1, 2]  # 3, 4 and 5 are empty or failed
    details = spark.createDataFrame([("/view.do?seq_id=12&p=1", fixtures.DETAIL_PAGES["12"])], "href string, html string")
    out = {r["sequence_number"]: r for r in jobs.crawl_with_details(pages, details).collect()}
    assert out["12"]["case_details"] == "2024하합101142" and out["11"]["detail_processing_failed"]


def test_documents_job(spark, tmp_path):
    from notice_engine.operators.store import SnapshotStore

    (tmp_path / "d/notice_5_t").mkdir(parents=True)
    for n in ("a.pdf", "b.pdf"):
        (tmp_path / "d/notice_5_t" / n).write_bytes(b"%PDF")
    (tmp_path / "j").mkdir()
    seen = []

    def convert(paths):
        seen.append(len(paths))
        (tmp_path / "j/notice_5__0000__a.json").write_text(fixtures.DOCUMENTS["a"], encoding="utf-8")

    config = jobs.PipelineConfig(str(tmp_path / "d"), str(tmp_path / "j"))
    outcome = jobs.process_downloads(spark, config, convert)
    assert seen == [2] and {r["file"]: r["status"] for r in outcome.collect()} == {"a.pdf": "ok", "b.pdf": "failed"}
    stored = jobs.store_batch(SnapshotStore(spark, str(tmp_path / "s")), outcome).collect()
    assert len(stored) == 1 and stored[0]["pdf_text_content"] == 5
    assert "hybrid_url" not in config.converter_options() and jobs.PipelineConfig(hybrid="x", hybrid_url="u").converter_options()["hybrid_url"] == "u"
    assert jobs.DatabaseConfig.from_environment({"DB_PORT": "1", "DB_NAME": "n"}).port == 1


def test_stream_of_upserts(spark, tmp_path):
    from notice_engine.operators.store import SnapshotStore
    from notice_engine.streaming.incremental import upsert_stream

    kind = "notice_id string, file_path string, file_name string, file_size bigint, page_count int, ord int"
    store = SnapshotStore(spark, str(tmp_path / "s"))
    for k, path in enumerate(("/a", "/b")):
        spark.createDataFrame([("1", path, "a.pdf", 1, 1, 1), ("1", path, f"{k}.pdf", 1, 1, 2)], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = upsert_stream(spark.readStream.schema(kind).parquet(str(tmp_path / "in")), store, str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
    assert {r["file_name"]: r["file_path"] for r in store.read("pdf_documents").collect()} == {"a.pdf": "/b", "0.pdf": "/a", "1.pdf": "/b"}

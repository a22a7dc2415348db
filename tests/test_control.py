import asyncio

import pytest

from notice_engine.operators import notices as N
from notice_engine.plans import control as K
from notice_engine.sources.live import NoticePages, page_list
from notice_engine.testing import fixtures


def failing(times):
    left = [times]

    def call():
        if left[0]:
            left[0] -= 1
            raise OSError("no")
        return "done"

    return call


def test_retries_wait_longer_each_time():
    waits, counts = [], K.ErrorCounts()
    assert K.retry(3, 2.0, counts=counts, wait=waits.append)(failing(2))() == "done"
    assert waits == [2.0, 3.0] and counts.stats()["total_errors"] == 0
    with pytest.raises(OSError):
        K.retry(1, counts=counts, wait=waits.append)(failing(5))()
    assert counts.stats() == {"total_errors": 2, "error_counts": {"call": 2}, "last_errors": {"call": "no"}, "total_functions_with_errors": 1}
    K.retry(0, counts=counts)(failing(0))()
    assert counts.stats() == {"total_errors": 0, "error_counts": {"call": 0}, "last_errors": {"call": "no"}, "total_functions_with_errors": 1}
    with pytest.raises(OSError):  # another kind of error is neither counted nor tried again
        K.retry(3, counts=counts, wait=waits.append, errors=(ValueError,))(failing(1))()
    assert counts.stats()["total_errors"] == 0
    counts.reset()
    assert counts.counts == counts.last == {}

    async def nothing(_):
        return None

    inner = failing(1)

    async def call():
        return inner()

    assert asyncio.run(K.retry_async(2, wait=nothing)(call)()) == "done"


def test_breaker_stamps_the_start_of_a_call():
    now = [5.0]

    def slow():
        now[0] = 50.0
        raise OSError

    b = K.CircuitBreaker(1, 10.0, clock=lambda: now[0])
    with pytest.raises(OSError):
        b.call(slow)
    assert b.since == 5.0 and b.call(failing(0)) == "done"


def test_breaker_and_limiter():
    now = [0.0]
    b = K.CircuitBreaker(2, 10.0, clock=lambda: now[0])
    for _ in range(2):
        with pytest.raises(OSError):
            b.call(failing(1))
    with pytest.raises(K.BreakerOpen):
        b.call(failing(0))
    now[0] = 9.99
    with pytest.raises(K.BreakerOpen):
        b.call(failing(0))
    now[0] = 10.0  # at the border a call goes through
    assert b.call(failing(0)) == "done" and (b.state, b.count) == ("closed", 0)
    waits = []
    r = K.RateLimiter(2.0, clock=lambda: now[0], wait=waits.append)
    r.acquire()
    now[0] += 0.5
    r.acquire()
    assert waits == [1.5]


def test_safe_call_and_logger(tmp_path):
    assert K.safe_call(failing(1), default=7) == 7 and K.safe_call(failing(0)) == "done"
    log = K.logger("notice_engine_test", str(tmp_path))
    assert len(K.logger("notice_engine_test").handlers) == len(log.handlers) == 2 and list(tmp_path.iterdir())


def test_pages_as_a_source(spark, tmp_path):
    for k in (1, 2):
        (tmp_path / f"{k}.html").write_text(fixtures.LIST_PAGES[k], encoding="utf-8")
    assert page_list("1-3,9") == [1, 2, 3, 9]
    spark.dataSource.register(NoticePages)
    pages = spark.read.format("notice_pages").option("url", f"file://{tmp_path}/{{page}}.html").option("pages", "1-3").option("delay", "0").load()
    rows = {r["page_number"]: r["status"] for r in pages.collect()}
    assert rows == {1: "ok", 2: "ok", 3: "failed"} and pages.rdd.getNumPartitions() == 3
    assert N.list_rows(pages.where("status = 'ok'").select("page_number", "html")).count() == 3


def test_breaker_replays_many_keys_in_a_batch(spark):
    from pyspark.sql import functions as F

    from notice_engine.operators import crawl_log as C

    calls = spark.range(3000).select((F.col("id") % 1000).alias("k"), (F.col("id") / 1000).cast("int").cast("double").alias("ts"), F.lit(False).alias("ok"))
    out = C.breaker(calls, ["k"], failures=2, rest_seconds=10.0)
    assert out.groupBy("state", "allowed").count().collect() and {(r["ts"], r["state"]): r["n"] for r in out.groupBy("ts", "state").agg(F.count("*").alias("n")).collect()} == {(0.0, "closed"): 1000, (1.0, "closed"): 1000, (2.0, "open"): 1000}
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().executedPlan().toString()

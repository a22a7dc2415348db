"""Questions about sequences of pages. Control flow of a crawl becomes windows over its log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notice_engine.session import dealt

EMPTY_RUN = 3


def every_page(pages: DataFrame, by: list[str], page: str, first: int, last: int) -> DataFrame:
    """A row for each page from ``first`` to ``last`` and key; pages without a row have nulls."""
    keys = pages.select(*by).distinct() if by else pages.sparkSession.range(1).select()
    grid = keys.select(*by, F.explode(F.sequence(F.lit(first), F.lit(last))).alias(page))
    return grid.join(pages, [*by, page], "left").select(*pages.columns)


def stop_rule(pages: DataFrame, by: list[str], page: str = "page_number", items: str = "item_count", run: int = EMPTY_RUN, first: int | None = None, last: int | None = None) -> DataFrame:
    """Pages up to and with the last of the first ``run`` consecutive empty (0) or failed (null) ones.

    A page without a row is a failed page: pages run from ``first`` to ``last``, by default the smallest and largest that there are.
    """
    if first is None or last is None:
        ends = pages.agg(F.min(page), F.max(page)).first()
        if ends[0] is None:
            return pages
        first, last = int(ends[0]) if first is None else first, int(ends[1]) if last is None else last
    pages = every_page(pages, by, page, first, last)
    order = Window.partitionBy(*by).orderBy(page)
    empty = (F.coalesce(F.col(items), F.lit(0)) == 0).cast("int")
    streak = F.sum(empty).over(order.rowsBetween(-(run - 1), 0))
    stops = pages.withColumn("_streak", streak).where(F.col("_streak") == run).groupBy(*by).agg(F.min(page).alias("_stop"))
    kept = pages.join(stops, by, "left") if by else pages.join(F.broadcast(stops))
    return kept.where(F.col("_stop").isNull() | (F.col(page) <= F.col("_stop"))).select(*pages.columns)


def page_window(pages: DataFrame, start: int, n: int | None, page: str = "page_number") -> DataFrame:
    """``n`` pages from ``start``; 0 or None is without limit."""
    out = pages.where(F.col(page) >= start)
    return out.where(F.col(page) < start + n) if n else out


def specific_pages(pages: DataFrame, wanted: list[int], page: str = "page_number", items: str = "item_count") -> DataFrame:
    """The given pages in the given order, repeats kept; ``failed`` where a page is missing or has no count."""
    spark = pages.sparkSession
    ask = spark.createDataFrame([(k, p) for k, p in enumerate(wanted)], "request int, wanted int")
    joined = F.broadcast(ask).join(pages, F.col("wanted") == F.col(page), "left")
    return joined.withColumn("failed", F.col(items).isNull()).orderBy("request")


def page_range(wanted: list[int]) -> str:
    return f"{min(wanted)}-{max(wanted)}"


def outcome_of_attempts(attempts: DataFrame, by: list[str], most: int = 3) -> DataFrame:
    """(by, attempt, ok, ...): the earliest success among the first ``most`` attempts, else the last failure."""
    order = Window.partitionBy(*by).orderBy(F.col("ok").desc(), F.when(F.col("ok"), F.col("attempt")).otherwise(-F.col("attempt")))
    return attempts.where(F.col("attempt") <= most).withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def last_page(pages: DataFrame, start: int, most: int, step: int = 10, page: str = "page_number", has: str = "has_data") -> DataFrame:
    """One row, last_page: jumps of ``step`` while there is data, then page by page to the first gap. ``start`` if that page is empty."""
    spark = pages.sparkSession
    data = pages.where(has).select(F.col(page).cast("long").alias("p")).distinct()
    probes = spark.range(start, max(start, most) + 1, step).withColumnRenamed("id", "p")
    gap = probes.join(data, "p", "left_anti").agg(F.min("p")).first()[0]
    top = start + (max(start, most) - start) // step * step
    # the last probe that held data, from which the linear stretch begins
    base = top if gap is None else max(gap - step, start)
    # the first page from there on whose successor has no data
    ends = data.where((F.col("p") >= base) & (F.col("p") <= most)).join(data.select((F.col("p") - 1).alias("p")).where(F.col("p") < most), "p", "left_anti")
    end = ends.agg(F.min("p").alias("m"))
    held = data.where(F.col("p") == base).agg(F.count("*").alias("n"))
    return end.withColumn("n", F.lit(held.first()[0])).select(F.when(F.col("n") > 0, F.coalesce("m", F.lit(start))).otherwise(F.lit(start)).cast("int").alias("last_page"))


def sample_prefix(pages: DataFrame, by: list[str], k: int, page: str = "page_number", items: str = "item_count") -> DataFrame:
    """The first ``k`` pages up to the first empty one (kept) or failed one (left out)."""
    order = Window.partitionBy(*by).orderBy(page)
    n = F.row_number().over(order)
    bad = F.max((F.coalesce(F.col(items), F.lit(0)) == 0).cast("int"))
    before = F.coalesce(bad.over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return pages.withColumns({"_n": n, "_before": before}).where((F.col("_n") <= k) & (F.col("_before") == 0) & F.col(items).isNotNull()).drop("_n", "_before")


def rate_limited(calls: DataFrame, by: list[str], interval: Column, at: str = "ts") -> DataFrame:
    """(by, ts in seconds) -> start, the earliest time each call may go out, ``interval`` seconds after the one before.

    start_k = max over j <= k of (ts_j + (k - j) * interval), a running maximum.
    """
    order = Window.partitionBy(*by).orderBy(at)
    shift = (F.row_number().over(order) - 1) * interval
    ready = calls.withColumn("_shift", shift).withColumn("_ready", F.col(at) - F.col("_shift"))
    return ready.withColumn("start", F.max("_ready").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_shift")).drop("_shift", "_ready")


def breaker(events: DataFrame, by: list[str], failures: int = 5, rest_seconds: float = 60.0) -> DataFrame:
    """(by, ts in seconds, ok) -> state before each call (closed, open, half_open) and whether it was let through.

    A success while closed leaves the count as it is; a success while half open closes
    and clears it. State runs from call to call: calls of a key lie together in order
    and are replayed as they pass, many keys in one batch; no key is held whole.
    """
    import pyarrow as pa

    out = T.StructType(list(events.schema.fields)).add("state", "string").add("allowed", "boolean")
    nan = float("nan")

    def replay(batches):
        before, state, count, since = None, "closed", 0, 0.0
        for batch in batches:
            states, let = [], []
            keys = zip(*[batch.column(c).to_pylist() for c in by], strict=True) if by else [()] * batch.num_rows
            for key, ts, ok in zip(keys, batch.column("ts").to_pylist(), batch.column("ok").to_pylist(), strict=True):
                if key != before:
                    key = tuple(["NaN" if k != k else k for k in key])  # NaN is one key
                    if key != before:
                        before, state, count, since = key, "closed", 0, 0.0
                ts = nan if ts is None else ts
                if state == "open" and ts - since >= rest_seconds:
                    state = "half_open"
                states.append(state)
                let.append(state != "open")
                if state == "open":
                    continue
                if ok:
                    if state == "half_open":
                        state, count = "closed", 0
                else:
                    count += 1
                    since = ts
                    if count >= failures:
                        state = "open"
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(states, pa.string()), pa.array(let, pa.bool_())], names=out.names)

    together = dealt(events, *by) if by else events.repartition(1)
    return together.sortWithinPartitions(*by, F.col("ts").asc_nulls_last()).mapInArrow(replay, out)


def retry_delays(attempts: int, delay: float, factor: float = 1.5) -> list[float]:
    """Waits between the attempts of a call that keeps failing."""
    return [delay * factor**k for k in range(attempts)]

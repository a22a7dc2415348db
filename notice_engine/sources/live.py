"""Pages fetched while they are read: a Python data source with one partition per page.

    spark.dataSource.register(NoticePages)
    spark.read.format("notice_pages").option("url", "https://host/list?page={page}").option("pages", "1-40").load()

Each row is (page_number, html, fetched_at, status): ``ok``, or ``failed`` after all
attempts. A lost executor costs its pages, which are fetched again.
"""

from __future__ import annotations

import time
import urllib.request
from datetime import datetime, timezone

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def page_list(text: str) -> list[int]:
    """``1-4,9`` -> [1, 2, 3, 4, 9]."""
    out: list[int] = []
    for part in text.split(","):
        a, _, b = part.strip().partition("-")
        out += range(int(a), int(b or a) + 1)
    return out


class Page(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.url, self.pages = options["url"], page_list(options.get("pages", "1"))
        self.attempts, self.delay, self.timeout = int(options.get("attempts", 3)), float(options.get("delay", 5)), float(options.get("timeout", 30))

    def partitions(self):
        return [Page(p) for p in self.pages]

    def read(self, partition):
        html = None
        for attempt in range(self.attempts):
            try:
                with urllib.request.urlopen(self.url.format(page=partition.value), timeout=self.timeout) as reply:
                    html = reply.read().decode("utf-8", "replace")
                break
            except OSError:
                if attempt + 1 < self.attempts:
                    time.sleep(self.delay)
        yield partition.value, html, datetime.now(timezone.utc).replace(tzinfo=None), "failed" if html is None else "ok"


class NoticePages(DataSource):
    @classmethod
    def name(cls):
        return "notice_pages"

    def schema(self):
        return "page_number int, html string, fetched_at timestamp_ntz, status string"

    def reader(self, schema):
        return _Reader(self.options)

"""Writers of crawled notices: CSV, JSON, appends and the text summary."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notice_engine.operators import analytics as A

# Headings and widths of the summary's tables.
FIELD_TABLE = (("Field", 25), ("Total", 8), ("Non-Empty", 12), ("Fill Rate", 10))
#: Array files up to this size are written anew by the driver.
MOST_ARRAY_BYTES = 64_000_000
GROUP_TABLE = (("Jurisdiction", 30), ("Count", 8), ("Percentage", 10))


def flattened(rows: DataFrame) -> DataFrame:
    """Nested columns as JSON text, null fields kept, non-ASCII as it is."""
    nested = ("struct", "array", "map")
    return rows.select(*[F.to_json(c, {"ignoreNullFields": "false"}).alias(c) if kind.startswith(nested) else F.col(c) for c, kind in rows.dtypes])


def for_csv(rows: DataFrame) -> DataFrame:
    """Columns in order of name, nested ones flattened, missing values empty."""
    flat = flattened(rows)
    return flat.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in sorted(flat.columns)])


def base_name(prefix: str, now: datetime, suffix: str = "") -> str:
    return f"{prefix}_{now:%Y%m%d_%H%M%S}" + (f"_{suffix}" if suffix else "")


def save(rows: DataFrame, folder: str, prefix: str, kind: str = "both", now: datetime | None = None, suffix: str = "") -> dict[str, str]:
    """Write CSV, JSON lines or both, and the summary; nothing at all for no rows. Returns the paths by kind."""
    if rows.isEmpty():
        return {}
    now = now or datetime.now()
    base = f"{folder.rstrip('/')}/{base_name(prefix, now, suffix)}"
    out = {}
    if kind in ("csv", "both"):
        for_csv(rows).write.option("header", True).option("escape", '"').csv(out.setdefault("csv", f"{base}.csv"))
    if kind in ("json", "both"):
        rows.write.option("ignoreNullFields", "false").json(out.setdefault("json", f"{base}.json"))
    report(rows, now).coalesce(1).write.text(out.setdefault("summary", f"{base}_summary.txt"))
    return out


def pretty_json(rows: DataFrame) -> str:
    """One array, two spaces deep, for small results that a person reads."""
    return json.dumps([r.asDict(recursive=True) for r in rows.collect()], ensure_ascii=False, indent=2, default=str)


def bom_csv(rows: DataFrame) -> str:
    """The exact text of a small CSV file, with its byte order mark."""
    import csv
    import io

    out = io.StringIO()
    out.write("﻿")
    table = for_csv(rows)
    writer = csv.writer(out)
    writer.writerow(table.columns)
    writer.writerows([list(r) for r in table.collect()])
    return out.getvalue()


def appended_columns(new: DataFrame, header: list[str]) -> DataFrame:
    """``new`` with exactly the columns that are there: unknown ones dropped, missing ones empty."""
    return new.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in new.columns else F.lit("").alias(c) for c in header])


def extended_array(new: DataFrame, path: str) -> None:
    """Add rows to a file that holds one JSON array; another value becomes its first item. For files and rows that a driver can hold."""
    spark = new.sparkSession
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.getFileStatus(at).getLen() > MOST_ARRAY_BYTES:
        raise ValueError(f"{path} is too large to be written anew; write JSON lines")
    old = json.loads(spark.read.text(path, wholetext=True).first()["value"])
    added = json.loads(pretty_json(new))
    text = json.dumps((old if isinstance(old, list) else [old]) + added, ensure_ascii=False, indent=2)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    out = files.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(at, False)
    files.rename(beside, at)


def append(new: DataFrame, path: str) -> bool:
    """Add rows to a file that is there, by its kind; False for a missing file or another kind."""
    spark = new.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(at):
        return False
    if path.endswith(".csv"):
        header = spark.read.option("header", True).csv(path).columns
        appended_columns(flattened(new), header).write.mode("append").option("header", True).option("escape", '"').csv(path)
        return True
    if path.endswith(".json") and files.getFileStatus(at).isFile():
        extended_array(new, path)
        return True
    if path.endswith(".json"):
        new.write.mode("append").option("ignoreNullFields", "false").json(path)
        return True
    return False


def save_attachment_summary(summary: DataFrame, folder: str, now: datetime | None = None) -> str:
    """The one-row summary of downloads as JSON."""
    path = f"{folder.rstrip('/')}/attachment_summary_{now or datetime.now():%Y%m%d_%H%M%S}.json"
    summary.coalesce(1).write.option("ignoreNullFields", "false").json(path)
    return path


def report(rows: DataFrame, now: datetime) -> DataFrame:
    """Lines of the crawl summary. All figures are aggregates; only as many rows as fields and groups are formatted."""
    page = F.col("page_number") if "page_number" in rows.columns else F.lit(0)
    total = A.counts(rows, page).first()
    head = {"Generated": f"{now:%Y-%m-%d %H:%M:%S}", "Total Items": total["total_items"], "Pages Crawled": total["pages_crawled"], "Average Items per Page": f"{total['items_per_page']:.2f}"}
    lines = ["Crawl Summary", *(f"{k}: {v}" for k, v in head.items())]
    lines += _listed("Field Statistics:", FIELD_TABLE, A.field_profile(rows).select("field", "total", "non_empty", "fill_rate").toLocalIterator())
    if "jurisdiction" in rows.columns:
        share = A.group_share(rows, F.col("jurisdiction"), _order(rows)).select("jurisdiction", "n", "percentage")
        lines += _listed("Jurisdiction Distribution:", GROUP_TABLE, share.toLocalIterator())
    return rows.sparkSession.createDataFrame([("\n".join(lines),)], "value string")


def _listed(title: str, columns: tuple[tuple[str, int], ...], values) -> list[str]:
    """A titled table; the last column is a share in percent."""
    line = lambda cells: " ".join(str(c).ljust(w) for c, (_, w) in zip(cells, columns, strict=True))
    body = [line([*row[:-1], f"{row[-1]:.1f}%"]) for row in values]
    return ["", title, line([n for n, _ in columns]), "-" * sum(w + 1 for _, w in columns), *body]


def _order(rows: DataFrame) -> Column:
    keys = [c for c in ("page_number", "row_number") if c in rows.columns]
    return F.struct(*keys) if keys else F.lit(0)

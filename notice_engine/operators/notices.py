"""Notices from captured pages: list rows, details, attachment links, and their merge."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from notice_engine.functions import html as H
from notice_engine.functions import text as X
from notice_engine.schemas import LINK, NOTICE
from notice_engine.session import ship

FIELDS = ("sequence_number", "jurisdiction", "bankruptcy_trustee", "notice_title", "view_count")
_ROWS = f"array<struct<row_number:int,cells:array<string>,links:array<{LINK}>>>"
_DETAIL = "struct<text:string,content:string,pairs:array<struct<key:string,value:string>>,links:array<struct<tag:string,href:string,onclick:string,stripped:string,shown:string>>>"


def _udf(f, kind: str):
    return F.udf(f, T._parse_datatype_string(kind), useArrow=True)


def stamp(now: datetime | None) -> Column:
    """When rows are extracted, as ISO text; ``now`` fixes the clock."""
    return F.lit((now or datetime.now()).isoformat())


def list_rows(pages: DataFrame, now: datetime | None = None) -> DataFrame:
    """(page_number, html) -> one row per notice in the list table, with ``extraction_date``."""
    ship(pages.sparkSession)
    rows = pages.select(F.col("page_number").cast("int").alias("page_number"), F.inline(_udf(H.list_rows, _ROWS)("html")))
    more = F.when(F.size("cells") > 5, F.map_from_arrays(F.transform(F.sequence(F.lit(5), F.size("cells") - 1), lambda i: F.concat(F.lit("additional_field_"), i.cast("string"))), F.transform(F.expr("slice(cells, 6, size(cells))"), X.clean_text)))
    fields = [X.clean_text(F.col("cells")[k]).alias(n) for k, n in enumerate(FIELDS)]
    rows = rows.select("page_number", "row_number", *fields, F.coalesce(more, F.expr("cast(map() as map<string,string>)")).alias("additional_fields"), F.when(F.size("links") > 0, F.col("links")).alias("links"))
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in T._parse_datatype_string(NOTICE).fields], stamp(now).alias("extraction_date"))


def page_info(pages: DataFrame) -> DataFrame:
    """(page_number, html) -> current_page, total_pages (always null), has_next, has_previous."""
    ship(pages.sparkSession)
    info = _udf(H.page_info, "struct<current_page:int,has_next:boolean,has_previous:boolean>")("html")
    return pages.select("page_number", info.alias("i")).select("page_number", "i.current_page", F.lit(None).cast("int").alias("total_pages"), "i.has_next", "i.has_previous")


def has_data(pages: DataFrame) -> DataFrame:
    ship(pages.sparkSession)
    return pages.select("page_number", _udf(H.has_data, "boolean")("html").alias("has_data"))


def last_wins(pairs: Column) -> Column:
    """array<struct<key,value>> -> map; of equal keys the last value stays."""
    numbered = F.array_sort(F.transform(pairs, lambda x, i: F.struct(x["key"].alias("k"), i.alias("i"), x["value"].alias("v"))))
    n = F.size(numbered)
    last = F.filter(numbered, lambda x, i: (i == n - 1) | (F.get(numbered, i + 1)["k"] != x["k"]))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(x["k"], x["v"])))


_EMPTY = ("file_id", "display_name", "link_text", "href", "file_extension", "filename", "onclick")


def _link(kind: str, **values: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), *[values.get(n, F.lit(None).cast("string")).alias(n) for n in _EMPTY])


_CALL = r"(?U)download\s*\(\s*['\"]([^'\"]+)['\"]?\s*,\s*['\"]([^'\"]+)['\"]?\s*\)"


def _with_extension(anchors: Column, extension: str) -> Column:
    hit = F.filter(anchors, lambda x: F.contains(F.lower(x["href"]), F.lit(extension)))
    return F.transform(hit, lambda x: _link("direct_link", href=x["href"], link_text=x["stripped"], file_extension=F.lit(extension)))


def links_static(links: Column, extensions: tuple[str, ...] = X.EXTENSIONS) -> Column:
    """Attachment links of a saved page: script calls, then links by extension (a link once for each that it contains), then click handlers. Duplicates stay."""
    anchors = F.filter(links, lambda x: (x["tag"] == "a") & (F.coalesce(x["href"], F.lit("")) != ""))
    calls = F.transform(
        F.filter(anchors, lambda x: F.contains(x["href"], F.lit("download(")) & x["href"].rlike(_CALL)),
        lambda x: _link("javascript_download", file_id=F.regexp_extract(x["href"], _CALL, 1), display_name=F.regexp_extract(x["href"], _CALL, 2), link_text=x["stripped"], href=x["href"]),
    )
    direct = F.flatten(F.array(*[_with_extension(anchors, e) for e in extensions]))
    clicks = F.transform(F.filter(links, lambda x: F.contains(F.lower(F.coalesce(x["onclick"], F.lit(""))), F.lit("download"))), lambda x: _link("onclick_download", onclick=x["onclick"], link_text=x["stripped"]))
    return F.concat(calls, direct, clicks)


def links_live(links: Column) -> Column:
    """Attachment links as a browser finds them: case matters, a direct link occurs once, names are percent-decoded and file names taken from the path."""
    anchors = F.filter(links, lambda x: (x["tag"] == "a") & (F.coalesce(x["href"], F.lit("")) != ""))
    calls = F.transform(
        F.filter(anchors, lambda x: F.contains(x["href"], F.lit("javascript:download")) & x["href"].rlike(_CALL)),
        lambda x: _link("javascript_download", file_id=F.regexp_extract(x["href"], _CALL, 1), display_name=X.unquote(F.regexp_extract(x["href"], _CALL, 2)), link_text=x["shown"], href=x["href"]),
    )
    some = lambda h: F.exists(F.array(*[F.contains(h, F.lit(e)) for e in X.EXTENSIONS]), lambda y: y)
    path = lambda h: F.regexp_replace(F.regexp_replace(h, r"(?s)[?#;].*\z", ""), r"\A(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/]*)?", "")
    direct = F.transform(F.filter(anchors, lambda x: some(x["href"])), lambda x: _link("direct_link", href=x["href"], link_text=x["shown"], filename=X.basename(path(x["href"]))))
    clicks = F.transform(F.filter(links, lambda x: F.contains(F.coalesce(x["onclick"], F.lit("")), F.lit("download"))), lambda x: _link("onclick_download", onclick=x["onclick"], link_text=x["shown"]))
    return F.concat(calls, direct, clicks)


def _parsed(pages: DataFrame, read, kind: str, name: str) -> DataFrame:
    """All columns but html, and what ``read`` makes of it; an Arrow batch at a time."""
    ship(pages.sparkSession)
    rest = [c for c in pages.columns if c != "html"]
    schema = T.StructType([*[pages.schema[c] for c in rest], T.StructField(name, T._parse_datatype_string(kind))])
    made = to_arrow_type(schema[name].dataType)

    def run(batches):
        for batch in batches:
            out = pa.array([read(page.as_py()) for page in batch.column(len(rest))], made)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], out], names=[*rest, name])

    return pages.select(*rest, "html").mapInArrow(run, schema)


_LINK_NAMES = ("tag", "href", "onclick", "stripped", "shown")


def page_links(pages: DataFrame) -> DataFrame:
    """(html, other columns) -> other columns and ``links``, all link elements of the page; nothing else of it is computed."""
    kind = "array<struct<tag:string,href:string,onclick:string,stripped:string,shown:string>>"
    return _parsed(pages, lambda html: [dict(zip(_LINK_NAMES, x, strict=True)) for x in H.links(H.parse(html))], kind, "links")


def details(pages: DataFrame, live: bool = False, now: datetime | None = None) -> DataFrame:
    """(sequence_number, html, other columns) -> detail records, with ``extraction_date``. A page that cannot be parsed has ``error`` instead. A column ``detail_url`` stays."""

    def read(html):
        try:
            text, content, pairs, links = H.detail(html)
        except Exception as problem:
            return {"error": str(problem), "d": None}
        return {"error": None, "d": {"text": text, "content": content, "pairs": [{"key": k, "value": v} for k, v in pairs], "links": [dict(zip(_LINK_NAMES, x, strict=True)) for x in links]}}

    parsed = _parsed(pages, read, f"struct<error:string,d:{_DETAIL}>", "_page")
    d, text = F.col("_page.d"), F.coalesce(F.col("_page.d.text"), F.lit(""))
    return parsed.select(
        *[c for c in pages.columns if c != "html"],
        X.clean_text(d["content"]).alias("notice_content"),
        X.notice_date(text).alias("notice_date"),
        X.jurisdiction_line(text).alias("jurisdiction_full"),
        X.case_number(text).alias("case_details"),
        (links_live if live else links_static)(d["links"]).alias("attachment_links"),
        X.contact(text).alias("contact_info"),
        X.deadline(text).alias("deadline_info"),
        last_wins(d["pairs"]).alias("additional_info"),
        F.col("_page.error").alias("error"),
        stamp(now).alias("extraction_date"),
    )


def attachment_rows(found: DataFrame) -> DataFrame:
    """One row per attachment link, with its place and the name it is stored under."""
    rows = found.select("sequence_number", F.posexplode("attachment_links").alias("position", "link"))
    name = F.coalesce(F.col("link.display_name"), F.col("link.filename"), X.basename(F.col("link.href")), F.col("link.link_text"))
    return rows.select("sequence_number", "position", "link.*", X.planned_name(F.col("position") + 1, name, F.col("link.file_id")).alias("planned_name"))


def merged(notices: DataFrame, found: DataFrame, downloads: DataFrame | None = None) -> DataFrame:
    """Each notice with its detail; where both have a column the detail wins. Without a detail the notice stays and is flagged.

    ``downloads``: (sequence_number, attachments array, download_errors array, notice_dir).
    """
    shared = [c for c in found.columns if c in notices.columns and c != "sequence_number"]
    right = found.select(*[F.col(c).alias(f"_d_{c}") if c in shared or c == "sequence_number" else F.col(c) for c in found.columns])
    out = notices.join(right, notices["sequence_number"] == right["_d_sequence_number"], "left")
    for c in shared:
        out = out.withColumn(c, F.coalesce(F.col(f"_d_{c}"), F.col(c)))
    out = out.withColumn("detail_processing_failed", F.col("_d_sequence_number").isNull()).drop("_d_sequence_number", *[f"_d_{c}" for c in shared])
    if downloads is not None:
        extra = downloads.select(F.col("sequence_number").alias("_s"), F.size("attachments").alias("attachment_count"), F.col("download_errors").alias("attachment_download_errors"), F.col("notice_dir").alias("attachments_dir"))
        out = out.join(extra, out["sequence_number"] == extra["_s"], "left").drop("_s").withColumn("attachment_count", F.coalesce("attachment_count", F.lit(0)))
    return out


def detail_targets(hrefs: DataFrame, captured: DataFrame) -> DataFrame:
    """(href) with the captured page it opens: the same link, else the same ``seq_id=``, else a link that contains the id.

    The first two are equi-joins; only links they leave over are looked up by substring, by the ids found inside captured links.
    """
    wanted = hrefs.withColumn("wanted_id", X.seq_id(F.col("href")))
    pages = captured.select(F.col("href").alias("page_href"), "html", X.seq_id(F.col("href")).alias("page_id"))
    exact = wanted.join(pages, wanted["href"] == pages["page_href"])
    rest = wanted.join(exact.select("href").distinct(), "href", "left_anti")
    by_id = rest.join(pages, rest["wanted_id"] == pages["page_id"])
    rest = rest.join(by_id.select("href").distinct(), "href", "left_anti").where("wanted_id is not null and wanted_id <> ''")
    numbers = pages.select("page_href", "html", "page_id", F.explode(F.array_distinct(F.regexp_extract_all("page_href", F.lit(r"(\w+)"), 1))).alias("part"))
    inside = rest.join(numbers, rest["wanted_id"] == numbers["part"])
    columns = ["href", "wanted_id", "page_href", "html"]
    found = exact.select(*columns, F.lit(0).alias("rule")).union(by_id.select(*columns, F.lit(1))).union(inside.select(*columns, F.lit(2)))
    return found.groupBy("href").agg(F.min(F.struct("rule", "page_href", "html")).alias("m")).select("href", "m.page_href", "m.html")

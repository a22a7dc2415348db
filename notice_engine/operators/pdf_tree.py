"""Extractor JSON shredded into documents, text, tables and images.

Each document is read and walked in the order of its tree, once, where it lies
(:mod:`notice_engine.functions.tree`); no rows are moved or written for that. A node is
known by its path, the places of its ancestors and its own among their siblings; paths
in order give the order of the tree. Tables and images are leaves: nothing inside them
becomes an element. Positions of tables and images count also those that give no
output. Cells given as rows (row, column, order, text) become grids by :func:`matrices`.

A document whose JSON cannot be parsed, or that holds something of another kind than
its place needs (a number of 32 bits, a list, an object), has an error and no elements.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from notice_engine.functions import tree
from notice_engine.functions.tree import LEAVES, METADATA, TEXT_TYPES  # noqa: F401
from notice_engine.schemas import BBOX
from notice_engine.session import ship

ELEMENT = (
    f"struct<kind:string,ord:int,path:array<int>,page_number:int,bbox:{BBOX},text:string,element_type:string,font:string,font_size:double,"
    "heading_level:int,position:int,image_path:string,row_count:int,col_count:int,data:array<array<string>>>"
)
DOCUMENT = f"struct<file_name:string,page_count:int,metadata:map<string,string>,elements:array<{ELEMENT}>,error:string>"
#: Fixed value: characters of JSON that are walked before their documents are handed on.
PIECE = 16_000_000


def _count(node: str, key: str) -> Column:
    """A whole number; null for none and for 0."""
    return F.nullif(F.try_variant_get(node, f'$["{key}"]', "bigint"), F.lit(0)).cast("int")


def first_number(node: Column | str, keys: tuple[str, ...], default: int) -> Column:
    """The whole number of the first key that has one other than 0."""
    return F.coalesce(*[_count(node, k) for k in keys], F.lit(default))


def _list_of(lists: list, kind: pa.DataType) -> tuple[pa.Array, list]:
    """Offsets of lists, null where there is none, and what is in them."""
    ends, flat = [0], []
    for x in lists:
        if x:
            flat += x
        ends.append(len(flat))
    return pa.array([None if x is None else at for x, at in zip(lists, ends, strict=False)] + ends[-1:], kind), flat


def _shredded(texts: list[str | None], kind: pa.StructType) -> pa.StructArray:
    """``doc`` of documents; null for null."""
    names, pages, metadata, elements, errors = zip(*map(tree.document, texts), strict=True)
    listed, item = kind.field("elements").type, kind.field("elements").type.value_type
    offsets, flat = _list_of(elements, pa.int32())
    columns = list(zip(*flat, strict=True)) if flat else [()] * 18
    box = item.field("bbox").type
    corners = pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in columns[4:8]], fields=list(box))
    parts = [corners if f.name == "bbox" else pa.array(c, f.type) for f, c in zip(item, [*columns[:4], None, *columns[8:]], strict=True)]
    made = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(parts, fields=list(item)), type=listed)
    own = [pa.array(names, pa.string()), pa.array(pages, pa.int32()), pa.array(metadata, kind.field("metadata").type), made, pa.array(errors, pa.string())]
    return pa.StructArray.from_arrays(own, fields=list(kind), mask=pa.array([x is None for x in texts]))


def documents(source: DataFrame) -> DataFrame:
    """(json, other columns) -> other columns and ``doc``; a document that cannot be read has ``doc.error`` and nothing else. Null json gives a null doc."""
    ship(source.sparkSession)
    rest = [c for c in source.columns if c != "json"]
    schema = T.StructType([*[source.schema[c] for c in rest], T.StructField("doc", T._parse_datatype_string(DOCUMENT))])
    kind, k = to_arrow_type(schema["doc"].dataType), len(rest)

    def run(batches):
        for batch in batches:
            texts = batch.column(k).to_pylist()
            start = 0
            while start < len(texts):
                stop, size = start, 0
                while stop < len(texts) and size < PIECE:
                    size += len(texts[stop] or "")
                    stop += 1
                doc = _shredded(texts[start:stop], kind)
                yield pa.RecordBatch.from_arrays([*[c.slice(start, stop - start) for c in batch.columns[:k]], doc], names=[*rest, "doc"])
                start = stop

    return source.select(*[F.col(f"`{c}`") for c in rest], F.make_valid_utf8("json")).mapInArrow(run, schema)


def headers(docs: DataFrame) -> DataFrame:
    rest = [c for c in docs.columns if c != "doc"]
    return docs.select(*rest, "doc.file_name", "doc.page_count", "doc.metadata", "doc.error")


def _elements(docs: DataFrame, kind: str) -> DataFrame:
    rest = [c for c in docs.columns if c != "doc"]
    return docs.select(*rest, F.explode(F.filter("doc.elements", lambda e: e["kind"] == kind)).alias("e"))


def texts(docs: DataFrame) -> DataFrame:
    rest = [c for c in docs.columns if c != "doc"]
    return _elements(docs, "text").select(*rest, *[f"e.{c}" for c in ("ord", "path", "page_number", "element_type", "text", "bbox", "font", "font_size", "heading_level")])


def tables(docs: DataFrame) -> DataFrame:
    rest = [c for c in docs.columns if c != "doc"]
    return _elements(docs, "table").select(*rest, F.col("e.position").alias("table_index"), *[f"e.{c}" for c in ("page_number", "row_count", "col_count", "data", "bbox")])


def images(docs: DataFrame) -> DataFrame:
    rest = [c for c in docs.columns if c != "doc"]
    return _elements(docs, "image").select(*rest, F.col("e.position").alias("image_index"), *[f"e.{c}" for c in ("page_number", "image_path", "bbox")])


def headings(rows: DataFrame) -> DataFrame:
    return rows.where("element_type = 'heading'")


def paragraphs(rows: DataFrame) -> DataFrame:
    return rows.where("element_type = 'paragraph'")


def reading_order(rows: DataFrame, by: list[str], page: Column, top: Column, left: Column, order: Column, text: Column) -> DataFrame:
    """Texts of each document by page, then from the top, then from the left; empty ones left out, joined by line ends."""
    item = F.struct(page.alias("p"), (-top).alias("t"), left.alias("l"), order.alias("o"), text.alias("s"))
    kept = F.collect_list(F.when(F.coalesce(text, F.lit("")) != "", item))
    return rows.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(kept), lambda x: x["s"]), "\n").alias("full_text"))


def full_text(docs: DataFrame) -> DataFrame:
    """The reading-order text of shredded documents, one row each, also for those without text."""
    rest = [c for c in docs.columns if c != "doc"]
    kept = F.filter("doc.elements", lambda e: (e["kind"] == "text") & (e["text"] != ""))
    keyed = F.transform(kept, lambda e: F.struct(e["page_number"].alias("p"), (-e["bbox"]["y1"]).alias("t"), e["bbox"]["x0"].alias("l"), e["ord"].alias("o"), e["text"].alias("s")))
    return docs.select(*rest, F.array_join(F.transform(F.array_sort(keyed), lambda x: x["s"]), "\n").alias("full_text"))


def ordinals(rows: DataFrame, by: list[str], order: list[str], name: str = "position") -> DataFrame:
    """0-based places in pre-order; compute them before rows are dropped, so that gaps stay."""
    return rows.withColumn(name, (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).cast("int"))


def matrices(cells: DataFrame, by: list[str], rows: Column | None = None, columns: Column | None = None) -> DataFrame:
    """(by, r, c, ord, text), 1-based -> row_count, col_count and data; later cells overwrite, cells outside are dropped, gaps are empty.

    Counts default to the largest row and column number.
    """
    last = cells.groupBy(*by, "r", "c").agg(F.max_by("text", "ord").alias("text"))
    size = last.groupBy(*by).agg(
        (F.max(rows) if rows is not None else F.max("r")).cast("int").alias("row_count"),
        (F.max(columns) if columns is not None else F.max("c")).cast("int").alias("col_count"),
        F.map_from_entries(F.collect_list(F.struct(F.struct(F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c")).alias("k"), F.col("text").alias("v")))).alias("m"),
    )
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.expr("cast(array() as array<int>)"))
    cell = lambda r, c: F.coalesce(F.try_element_at("m", F.struct(r.alias("r"), c.alias("c"))), F.lit(""))
    grid = F.transform(upto(F.col("row_count")), lambda r: F.transform(upto(F.col("col_count")), lambda c: cell(r, c)))
    return size.select(*by, "row_count", "col_count", grid.alias("data"))

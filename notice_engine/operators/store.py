"""The document store: four Parquet tables, replaced snapshot by snapshot.

Operations are functions from tables to tables; :class:`SnapshotStore` keeps their
results, each as a new version that becomes current when it is complete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notice_engine.schemas import COLLATION, STORE
from notice_engine.session import written

CHILDREN = ("pdf_text_content", "pdf_tables", "pdf_images")


def same_text(c: Column) -> Column:
    """A string as the store compares it."""
    return F.collate(c, COLLATION)


def numbered(rows: DataFrame, order: list[str], start: Column, name: str = "id") -> DataFrame:
    """Consecutive numbers from ``start`` + 1 in the given order, without sorting everything in one task.

    Rows are range-partitioned by the order; a partition's first number is the sum of
    the sizes of those before it, a table with one row per partition.
    """
    ranged = written(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.join(offsets, "_part").withColumn(name, start + F.col("_before") + place).drop("_part", "_before")


def upsert_documents(existing: DataFrame, incoming: DataFrame, now: Column | None = None) -> DataFrame:
    """New table of documents. ``incoming`` has notice_id, file_path, file_name, file_size, page_count and ord, the order of arrival.

    The key is (notice_id, file_name) as the store compares strings. A document that
    is there keeps id, spelling and created_at and takes the latest other values; new
    ones are numbered after the largest id, in order of arrival.
    """
    now = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    stamp = F.date_trunc("second", (now + F.expr("INTERVAL 500000 MICROSECOND"))).cast("timestamp_ntz")  # kept to the second, rounded
    key = [same_text(F.col("notice_id")).alias("_k1"), same_text(F.col("file_name")).alias("_k2")]
    latest = incoming.select("*", *key).groupBy("_k1", "_k2").agg(
        F.min("ord").alias("first_ord"),
        F.min_by(F.struct("notice_id", "file_name"), "ord").alias("spelled"),
        F.max_by(F.struct("file_path", "file_size", "page_count"), "ord").alias("new"),
    )
    old = existing.select(*key, F.struct(*existing.columns).alias("old"))
    both = written(old.join(latest, ["_k1", "_k2"], "full_outer").select("old", "first_ord", "spelled", "new"), "upsert")
    kept = both.where("old is not null").select(
        *[
            F.when(F.col("new").isNull(), F.col(f"old.{c}")).otherwise(v).alias(c)
            for c, v in (
                ("id", F.col("old.id")), ("notice_id", F.col("old.notice_id")), ("file_path", F.col("new.file_path")), ("file_name", F.col("old.file_name")),
                ("file_size", F.col("new.file_size")), ("page_count", F.col("new.page_count")), ("processed_at", stamp), ("created_at", F.col("old.created_at")), ("updated_at", stamp),
            )
        ]
    )
    top = existing.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint")).first()[0]
    fresh = numbered(both.where("old is null"), ["first_ord"], F.lit(top).cast("bigint"))
    added = fresh.select("id", "spelled.notice_id", "new.file_path", "spelled.file_name", "new.file_size", "new.page_count", stamp.alias("processed_at"), stamp.alias("created_at"), stamp.alias("updated_at"))
    return kept.unionByName(added)


def delete_documents(tables: dict[str, DataFrame], ids: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """The four tables without the documents in ``ids`` (id) and their children; and the ids that were there."""
    ids = ids.select("id").distinct()
    hit = tables["pdf_documents"].select("id").join(ids, "id", "left_semi")
    out = {"pdf_documents": tables["pdf_documents"].join(ids, "id", "left_anti")}
    for name in CHILDREN:
        out[name] = tables[name].join(ids.withColumnRenamed("id", "document_id"), "document_id", "left_anti").select(*tables[name].columns)
    return out, hit


def table_payload(data: Column) -> Column:
    """A matrix as the store keeps it; counts are those of the matrix."""
    first = F.try_element_at(data, F.lit(1))
    return F.struct(data.alias("rows"), F.size(data).alias("row_count"), F.coalesce(F.when(first.isNotNull(), F.size(first)), F.lit(0)).alias("col_count"))


class SnapshotStore:
    """Tables under a folder, each version in a folder of its own; a version counts when it is complete."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _versions(self, name: str) -> list[int]:
        at = self._path(name)
        if not self._files.exists(at):
            return []
        found = [s.getPath().getName() for s in self._files.listStatus(at)]
        return sorted(int(v[2:]) for v in found if v.startswith("v=") and self._files.exists(self._path(name, v, "_SUCCESS")))

    def read(self, name: str) -> DataFrame:
        schema = T._parse_datatype_string(STORE[name])
        versions = self._versions(name)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/v={versions[-1]}") if versions else self.spark.createDataFrame([], schema)

    def replace(self, name: str, rows: DataFrame) -> None:
        versions = self._versions(name)
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/v={versions[-1] + 1 if versions else 1}")

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in STORE}

    def append(self, name: str, rows: DataFrame, order: list[str]) -> int:
        """Children are added as they are, numbered after the largest id."""
        old = self.read(name)
        top = old.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint")).first()[0]
        new = numbered(rows, order, F.lit(top).cast("bigint"))
        new = written(new.select(*[F.col(c).cast(old.schema[c].dataType) for c in old.columns]), "append")
        self.replace(name, old.unionByName(new))
        return new.count()

    def upsert(self, incoming: DataFrame, now: Column | None = None) -> None:
        self.replace("pdf_documents", upsert_documents(self.read("pdf_documents"), incoming, now))

    def delete(self, ids: DataFrame) -> int:
        tables, hit = delete_documents(self.tables(), ids)
        n = hit.count()
        if n:
            for name in ("pdf_text_content", "pdf_tables", "pdf_images", "pdf_documents"):
                self.replace(name, tables[name])
        return n

    def save(self, docs: DataFrame, replace_children: bool = False, now: Column | None = None) -> DataFrame:
        """Shredded documents (notice_id, source_path, file_size, ord, doc) are stored; returns document_id with the numbers of rows added.

        A document without notice_id is an error. Storing a document again adds its
        children again, unless ``replace_children``.
        """
        from notice_engine.operators import pdf_tree as P

        docs = written(docs.where("doc.error is null"), "save")
        if not docs.where("notice_id is null").isEmpty():
            raise ValueError("a document has no notice_id")
        stamp = F.date_trunc("second", F.current_timestamp() if now is None else now).cast("timestamp_ntz")
        self.upsert(docs.select("notice_id", F.col("source_path").alias("file_path"), F.col("doc.file_name").alias("file_name"), F.coalesce("file_size", F.lit(0)).cast("bigint").alias("file_size"), F.col("doc.page_count").alias("page_count"), "ord"), now)
        parents = self.read("pdf_documents").select(F.col("id").alias("document_id"), same_text(F.col("notice_id")).alias("_k1"), same_text(F.col("file_name")).alias("_k2"))
        own = docs.select("ord", "doc", same_text(F.col("notice_id")).alias("_k1"), same_text(F.col("doc.file_name")).alias("_k2")).join(parents, ["_k1", "_k2"]).select("document_id", "ord", "doc")
        own = written(own, "save-own")
        if replace_children:
            keys = own.select("document_id").distinct()
            for name in CHILDREN:
                self.replace(name, self.read(name).join(keys, "document_id", "left_anti").select(*self.read(name).columns))
        box = [F.col(f"bbox.{c}").alias(f"bbox_{c}") for c in ("x0", "y0", "x1", "y1")]
        texts = own.select("document_id", F.col("ord").alias("doc_ord"), F.explode(F.filter("doc.elements", lambda e: e["kind"] == "text")).alias("e"))
        rows = {
            "pdf_text_content": texts.select("document_id", "doc_ord", F.col("e.ord").alias("place"), F.col("e.page_number").alias("page_number"), F.col("e.text").alias("text_content"), *[F.col(f"e.bbox.{c}").alias(f"bbox_{c}") for c in ("x0", "y0", "x1", "y1")], F.col("e.font_size").alias("font_size"), F.col("e.font").alias("font_name"), stamp.alias("created_at")),
            "pdf_tables": P.tables(own).select("document_id", F.col("ord").alias("doc_ord"), F.col("table_index").alias("place"), "page_number", "table_index", table_payload(F.col("data")).alias("table_data"), table_payload(F.col("data"))["row_count"].alias("row_count"), table_payload(F.col("data"))["col_count"].alias("col_count"), *box, stamp.alias("created_at")),
            "pdf_images": P.images(own).select("document_id", F.col("ord").alias("doc_ord"), F.col("image_index").alias("place"), "page_number", "image_index", F.coalesce("image_path", F.lit("")).alias("image_path"), F.lit(0).alias("width"), F.lit(0).alias("height"), F.lit("").alias("format"), F.lit(0).cast("bigint").alias("file_size"), *box, stamp.alias("created_at")),
        }
        for name, new in rows.items():
            self.append(name, new, ["doc_ord", "place"])
        count = lambda name: rows[name].groupBy("document_id").agg(F.count("*").alias(name))
        out = own.select("document_id").distinct()
        for name in CHILDREN:
            out = out.join(count(name), "document_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
        return out


def point_lookup(documents: DataFrame, notice_id: str, file_name: str) -> DataFrame:
    """The document of a key, compared as the store compares strings: one row or none."""
    at = (same_text(F.col("notice_id")) == same_text(F.lit(notice_id))) & (same_text(F.col("file_name")) == same_text(F.lit(file_name)))
    return documents.where(at).orderBy("id").limit(1)

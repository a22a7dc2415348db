"""Captured inputs: pages, file listings and extractor output, and how conversions went."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notice_engine.functions import text as X
from notice_engine.operators import pdf_tree as P

#: Fixed value: folders of a notice's downloads.
FOLDER = r"\Anotice_(\d+)(?:_.*)?\z"


def captured_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_number, html, fetched_at, status), one row per capture."""
    return spark.read.parquet(path)


def discovered(listing: DataFrame) -> DataFrame:
    """(path, length) -> notice_id, source_path, length of ``*.pdf`` files directly in ``notice_<digits>[_title]`` folders.

    Order is that of the folder name, then the file name. ``idx`` counts within a notice.
    """
    path = F.regexp_replace("path", r"\Afile:/+", "/")
    parts = listing.select(path.alias("source_path"), "length", X.basename(path).alias("file"), F.regexp_extract(path, r"([^/]*)/[^/]*\z", 1).alias("folder"))
    found = parts.where(F.col("file").endswith(".pdf") & F.col("folder").rlike(FOLDER)).withColumn("notice_id", F.regexp_extract("folder", FOLDER, 1))
    return P.ordinals(found, ["notice_id"], ["folder", "file"], "idx").select("notice_id", "source_path", "length", "idx", "folder", "file").orderBy("folder", "file")


def pdf_listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of the files one folder below ``root``; contents are not read. A missing root is an empty listing."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(root)
    empty = spark.createDataFrame([], "path string, length bigint")
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(at) or not (files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/notice_*/*.pdf")) or []):
        return empty
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(f"{root}/notice_*/*.pdf").select("path", "length")


def staged_name(idx=None, notice=None, name=None):
    """``notice_{id}__{idx:04d}__{name}``."""
    number = F.when(idx < 10_000, F.lpad(idx.cast("string"), 4, "0")).otherwise(idx.cast("string"))
    return F.concat(F.lit("notice_"), notice, F.lit("__"), number, F.lit("__"), name)


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """(source_path, stem, json), one row per file."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("json"))
    return raw.withColumn("stem", F.regexp_replace(X.basename(F.col("source_path")), r"\.json\z", ""))


def conversion_outcome(staged: DataFrame, outputs: DataFrame) -> DataFrame:
    """(stem, notice_id, source_path, ...) with its shredded output: status ``ok``, or ``failed`` if there is none or it cannot be read.

    An output of an earlier run counts: the folder is not cleared in between.
    """
    docs = P.documents(outputs.select("stem", "json"))
    joined = staged.join(docs, "stem", "left")
    ok = F.col("doc").isNotNull() & F.col("doc.error").isNull()
    return joined.withColumn("status", F.when(ok, "ok").otherwise("failed")).withColumn("failure", F.when(F.col("doc").isNull(), "no output").otherwise(F.col("doc.error")))


def convert(staged: list[tuple[str, str]], converter: Callable[[list[str]], None]) -> None:
    """The hook for an external converter: one call for the whole batch, none for an empty one."""
    if staged:
        converter([path for _, path in staged])


def split_statements(ddl: str) -> list[str]:
    """Statements of a script, cut at ``;`` before a line end; blank ones and lone comment lines are dropped."""
    import re

    parts = (p.strip().rstrip(";").strip() for p in re.split(r";\s*\n", ddl))
    return [p for p in parts if p and not (p.startswith("--") and "\n" not in p)]


def initialise(spark: SparkSession, ddl: str) -> int:
    """Run a script's statements; the number run."""
    statements = split_statements(ddl)
    for s in statements:
        spark.sql(s)
    return len(statements)


def jdbc(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """A table of an external database, where its driver is on the class path."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()


def probe(spark: SparkSession, url: str, query: str = "SELECT 1 AS one", **options: str) -> bool:
    """Whether an external database answers; errors of the connection surface."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load().first() is not None

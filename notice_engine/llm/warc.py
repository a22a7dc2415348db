"""WARC files and a Merkle fixity audit of two replicas.

Pages are written as WARC/1.1 ``resource`` records into files of bounded size in the
shared folder, plain or as gzip, and read back from the bytes of those files, record by
record by their Content-Length. Offsets are those in the plain file. Each replica has two trees over its files: one of the records' digests
and one of their offset ranges, both in order of offset. Leaves are hashed in groups of
``FAN`` into nodes, level by level, up to one root for each file, and the roots of files
in the same way up to one root for the replica. The audit compares roots and descends
only where they differ: the children of matching nodes are never joined. A record of
another length thus shifts the offsets of those behind it without drawing the descent
of the content tree with it.

At the bottom, the records of differing leaves are matched within their file by id and
digest, then by id alone. That tells records whose bytes differ (``bytes``) from those
that one replica lacks (``missing``, ``extra``). Records that are whole but at another
offset have ``moved``; they are looked for in files whose offset roots differ.

Defined cases: null url and null html are empty; a null page_id is written as an empty
id; repeated rows are records of their own; records are ordered within a file by
page_id, url and digest; a file that cannot be read on from some place ends in one
record without id, up to its end, also where its gzip stream breaks; a file without records in one replica differs as a
whole; empty tables agree and give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from notice_engine.llm.lean import lean_batches
from notice_engine.session import scratch, ship, table, written

FAN = 16
#: Bytes of a file, on average.
FILE_BYTES = 4_000_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_END = "\r\n\r\n"


def record_text(page_id: Column, url: Column, html: Column) -> Column:
    """One record without its last two line ends: header lines, an empty line, the block. The date is fixed: a record depends on its page only."""
    block = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Date: 2000-01-01T00:00:00Z\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", " "),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(_END),
        block,
    )


def placed(pages: DataFrame) -> DataFrame:
    """page_id, url, html and where each record goes: ``file`` and ``place``, its order within. Rows of one id are dealt by their content too."""
    total = pages.agg(F.coalesce(F.sum(F.octet_length("html") + 300), F.lit(0))).first()[0]
    files = max(1, -(-total // FILE_BYTES))
    digest = F.md5(F.coalesce("html", F.lit("")))
    file = F.pmod(F.xxhash64(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")), digest), F.lit(files)).cast("int")
    return pages.select("page_id", "url", "html", file.alias("file"), F.struct("page_id", "url", digest.alias("digest")).alias("place"))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries within remove their shuffle files when they end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def write_files(rows: DataFrame, label: str, codec: str = "none") -> str:
    """Write rows of :func:`placed` as WARC files, one for each ``file``, plain or by ``codec`` gzip; the folder they are in."""
    folder = scratch(rows.sparkSession, f"warc-{label}")
    records = rows.select("file", "place", record_text(F.col("page_id"), F.col("url"), F.col("html")).alias("value"))
    dealt = records.repartition("file").sortWithinPartitions("file", "place").select("file", "value")
    dealt.write.partitionBy("file").option("lineSep", _END).option("compression", codec).option("zlib.compress.level", "BEST_SPEED").text(folder)
    return folder


_HEAD = re.compile(rb"WARC/1\.1\r\n((?:[^\r\n]+\r\n)+)\r\n")
_ID = re.compile(rb"(?:\A|\n)WARC-Record-ID: <urn:page:([^>\r\n]*)>\r")
_LENGTH = re.compile(rb"(?:\A|\n)Content-Length: (\d+)\r")


def records_in(content: bytes) -> Iterator[tuple[str | None, int, int, str]]:
    """(id, start, size, sha256) of each record of a file."""
    at, end = 0, _END.encode()
    while at < len(content):
        head = _HEAD.match(content, at)
        name, length = (_ID.search(head[1]), _LENGTH.search(head[1])) if head else (None, None)
        stop = head.end() + int(length[1]) + len(end) if name and length else len(content)
        if not (name and length) or stop > len(content) or content[stop - len(end) : stop] != end:
            yield None, at, len(content) - at, hashlib.sha256(content[at:]).hexdigest()
            return
        yield name[1].decode(), at, stop - at, hashlib.sha256(content[at:stop]).hexdigest()
        at = stop


def plain(stored: bytes) -> bytes:
    """The content of a file that may be gzip; from where its stream breaks, the stored bytes."""
    parts = []
    while stored[:2] == b"\x1f\x8b":
        stream, at = zlib.decompressobj(31), 0
        try:
            for at in range(0, len(stored), 1 << 12):
                parts.append(stream.decompress(stored[at : at + (1 << 12)]))
                if stream.eof:
                    break
        except zlib.error:
            return b"".join([*parts, stored[at:]])
        if not stream.eof:
            return b"".join([*parts, b"\0"])
        stored = stored[min(at + (1 << 12), len(stored)) - len(stream.unused_data) :]  # a next member
    return b"".join([*parts, stored])


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """file, seq, id, start, size and sha256 of each record of the WARC files in a folder."""
    ship(spark)

    @lean_batches
    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = list(records_in(plain(content.as_py())))
                columns = list(zip(*found, strict=True)) or [()] * 4
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(found), pa.int32()), pa.array(range(len(found)), pa.int64()), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=["file", "seq", "id", "start", "size", "sha256"])

    schema = "file int, seq long, id string, start long, size long, sha256 string"
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{folder}/file=*/*.txt*")
    if not (pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []):
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt*").load(folder)
    number = F.regexp_extract("path", r"/file=(\d+)/", 1).cast("int")
    return files.select(number.alias("file"), "content").mapInArrow(run, schema)


def levels(leaves: DataFrame, depth_in_file: int, depth_of_files: int) -> list[DataFrame]:
    """(file, at, hash) of leaves -> nodes from the leaves up; above the files' roots, file is -1."""
    nodes = [written(leaves, "warc-leaves")]

    def up(below: DataFrame) -> DataFrame:
        grouped = below.groupBy("file", F.floor(F.col("at") / FAN).cast("long").alias("up")).agg(F.sort_array(F.collect_list(F.struct("at", "hash"))).alias("c"))
        text = F.concat_ws(",", F.transform("c", lambda x: F.concat_ws(":", x["at"], x["hash"])))
        return written(grouped.select("file", F.col("up").alias("at"), F.sha2(F.concat_ws(":", F.lit("node"), text), 256).alias("hash")), "warc-nodes")

    for _ in range(depth_in_file):
        nodes.append(up(nodes[-1]))
    nodes.append(nodes[-1].select(F.lit(-1).alias("file"), F.col("file").cast("long").alias("at"), "hash"))
    for _ in range(depth_of_files):
        nodes.append(up(nodes[-1]))
    return nodes


def _depth(n: int) -> int:
    d = 0
    while FAN**d < n:
        d += 1
    return d


def differing(left: list[DataFrame], right: list[DataFrame], in_file: int, down_to: int) -> tuple[DataFrame, int]:
    """(file, at) of the nodes of level ``down_to`` that differ, and how many nodes were compared on the way from the root."""
    compared, open_ = 0, None
    for k in range(len(left) - 1, down_to - 1, -1):
        if open_ is not None and k == in_file:  # the roots of files: from above nodes of file -1, from below the top of each file
            open_ = open_.select(F.col("at").cast("int").alias("file"), F.lit(0).cast("long").alias("at"))
            continue
        x, y = left[k], right[k]
        if open_ is not None:
            up = F.floor(F.col("at") / FAN).cast("long")
            keys = open_.select(F.col("file").alias("_f"), F.col("at").alias("_a"))
            x, y = (s.join(keys, (s["file"] == F.col("_f")) & (up == F.col("_a")), "left_semi") for s in (x, y))
        both = written(x.withColumnRenamed("hash", "ha").join(y.withColumnRenamed("hash", "hb"), ["file", "at"], "full_outer"), "warc-compared")
        compared += both.count()
        open_ = both.where(~F.col("ha").eqNullSafe(F.col("hb"))).select("file", "at")
        if open_.isEmpty():
            return left[0].select("file", "at").limit(0), compared
    return open_, compared


def audit(left: DataFrame, right: DataFrame) -> tuple[DataFrame, int]:
    """(file, seq, id, start, size, sha256, finding) of records that differ, ``extra`` ones by their place on the right; and how many nodes were compared.

    ``left`` and ``right`` are what :func:`read_files` gives for two replicas of one layout.
    """
    size = left.select("file", "seq").union(right.select("file", "seq")).agg(F.coalesce(F.max("seq") + 1, F.lit(1)), F.coalesce(F.max("file") + 1, F.lit(1))).first()
    in_file, of_files = max(1, _depth(size[0])), max(1, _depth(size[1]))
    content = [levels(s.select("file", F.col("seq").alias("at"), F.sha2(F.concat_ws(":", F.lit("leaf"), "sha256"), 256).alias("hash")), in_file, of_files) for s in (left, right)]
    ranges = [levels(s.select("file", F.col("seq").alias("at"), F.sha2(F.concat_ws(":", F.lit("range"), "start", "size"), 256).alias("hash")), in_file, of_files) for s in (left, right)]
    leaves, compared = differing(*content, in_file, 0)
    files, more = differing(*ranges, in_file, in_file + 1)
    # records of differing leaves: same id and digest, else same id, each the first with the first and so on
    leaves = leaves.select("file", F.col("at").alias("seq"))
    sides = [s.join(leaves, ["file", "seq"], "left_semi").withColumn("id", F.coalesce("id", F.lit("?"))) for s in (left, right)]
    nth = lambda s, keys: s.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("seq")))
    whole = ["file", "id", "sha256"]
    a, b = (written(nth(s, whole), "warc-side") for s in sides)
    rest = [nth(x.join(y, [*whole, "nth"], "left_anti").drop("nth"), ["file", "id"]) for x, y in ((a, b), (b, a))]
    keys = ["file", "id", "nth"]
    found = rest[0].join(rest[1].select(*keys, F.lit(True).alias("there")), keys, "left").withColumn("finding", F.when(F.col("there"), "bytes").otherwise("missing")).drop("there")
    found = found.unionByName(rest[1].join(rest[0], keys, "left_anti").withColumn("finding", F.lit("extra"))).drop("nth")
    found = written(found, "warc-found")
    # whole records at another offset, in files whose offsets differ
    files = files.select(F.col("at").cast("int").alias("file"))
    a, b = (nth(s.join(files, "file", "left_semi"), whole) for s in (left, right))
    moved = a.join(b.select(*whole, "nth", F.col("start").alias("there")), [*whole, "nth"]).where("start <> there").drop("there", "nth").withColumn("finding", F.lit("moved"))
    names = ["file", "seq", "id", "start", "size", "sha256", "finding"]
    return found.select(*names).unionByName(moved.select(*names)), compared + more


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of :func:`placed` for a replica to audit. By crc32 of the id: every 97th page has one character changed, every 101st has lost its last third, every 103rd is lost, and every 107th has a second record."""
    mark = F.crc32(F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary"))
    n = F.length("html")
    middle = F.expr("cast(floor(length(html) / 2) as int)")
    other = F.when(F.substr("html", middle + 1, F.lit(1)) == "X", "Y").otherwise("X")
    flipped = F.concat(F.substr("html", F.lit(1), middle), other, F.substr("html", middle + 2))
    html = F.when((mark % 97 == 5) & (n > 0), flipped).when((mark % 101 == 7) & (n > 0), F.expr("substring(html, 1, length(html) - cast(ceil(length(html) / 3) as int))")).otherwise(F.col("html"))
    out = rows.withColumn("html", html).where(mark % 103 != 9)
    return out.unionByName(out.where(mark % 107 == 11).withColumn("html", F.lit("<p>added")))


def fixity(pages: DataFrame, damage=damaged) -> DataFrame:
    """Every record of ``pages`` in the first replica with what the audit found in a second one: ok, bytes, moved or missing; and ``extra`` records of the second. ``damage`` makes the second's rows from the first's.

    ``pages`` is computed for each replica and must be the same then. Both replicas are gzip.
    """
    spark = pages.sparkSession
    rows = placed(pages)
    with shuffles_removed(spark):
        left, right = (written(read_files(spark, write_files(s, label, "gzip")), f"warc-{label}") for s, label in ((rows, "a"), (damage(rows), "b")))
        found, _ = audit(left, right)
        found = written(found, "warc-findings")
    kind = pages.schema["page_id"].dataType
    own = left.join(found.where("finding <> 'extra'").select("file", "seq", "finding"), ["file", "seq"], "left").withColumn("finding", F.coalesce("finding", F.lit("ok")))
    every = own.unionByName(found.where("finding = 'extra'").select(*own.columns))
    return every.select(F.nullif("id", F.lit("")).cast(kind).alias("page_id"), F.col("file").cast("long").alias("file"), "seq", F.col("start").alias("record_start"), F.col("size").alias("record_size"), "sha256", "finding")


def op9_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixity(table(spark, sf_dir, "pages").select("page_id", "url", "html"))

"""What every job needs from its session: shipped code, a shared folder, tables by name."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_SCRATCH: list[tuple[SparkSession, str]] = []


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{os.path.basename(top)}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a plain local session may go without the setting; it gets a folder of its own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="notice-shared-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder's name in the shared folder. It is removed by :func:`clear`, or when this process ends."""
    path = f"{shared_folder(spark)}/notice-{label}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark, path))
    return path


def clear() -> None:
    """Remove the folders of :func:`written` tables. Results that are still to be computed from them are lost."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _clear_at_exit() -> None:
    if SparkSession.getActiveSession() is not None:  # else the session is gone, and with it the way to the folder
        clear()


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder as Parquet and read it again."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys) -> DataFrame:
    """Rows dealt to as many tasks as a shuffle has, or cores. Spark reads a small file in one task, and joins small parts of a shuffle again, however much work its rows are."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

"""Small helpers that every operator shares: table access, lineage cuts, column hygiene."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space in the wide sense: ASCII, no-break, Unicode separators, zero-width.
BLANK = r"[\s\p{Z}\x{200B}\x{FEFF}]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share. Only a local session may do without one; a cluster must name it."""
    sc = spark.sparkContext
    given = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not given:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        given = "file://" + tempfile.mkdtemp(prefix="demesne-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(given)
    return given


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared checkpoint folder and read it again.

    The lineage ends there: a lost executor costs no recomputation of what came before. Unlike an RDD
    checkpoint the table is compressed and computed once. The session's tables go when it ends.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    folder = f"{base.rstrip('/')}/demesne-{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        atexit.register(_remove, spark, folder)
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove the tables written so far; results that still read from them must have been written or collected."""
    _remove(spark, f"{checkpoint_dir(spark).rstrip('/')}/demesne-{spark.sparkContext.applicationId}")


_FOLDERS: set[str] = set()


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session may have ended before; the folder is then the cluster's to clean
        return


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, unless they have it on their path already."""
    root, app = Path(__file__).resolve().parent.parent, spark.sparkContext.applicationId
    if app in _SHIPPED or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    archive = Path(tempfile.mkdtemp(prefix="demesne-"), "demesne.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in (root / "demesne").rglob("*.py"):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def strip(c: Column | str) -> Column:
    """c without white space at either end; NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def micros(c: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp with or without zone."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def env_path(variable: str, default: str) -> str:
    return os.environ.get(variable, default)

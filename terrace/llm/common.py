"""Helpers that several operators share: text rules, the shared folder, written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the contracts: white space, and word characters after A-Z became a-z.
SPACE = r"\x20\x09-\x0D"
NO_SPACE = r"[^\x20\x09-\x0D]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; null stays null."""
    return F.translate(text, UPPER, LOWER)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares, as ``spark.checkpoint.dir`` names it.

    A local session without one gets a temporary folder; a cluster without one is
    an error, because its executors share no local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="terrace-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a new directory of the shared folder and read it back.

    Cuts the lineage: what follows survives lost executors without a recomputation,
    reads generated ids as they were first written, and is planned by real file
    sizes. The directory goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def hash01(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns' text alone, the same in every SQL engine with md5."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))

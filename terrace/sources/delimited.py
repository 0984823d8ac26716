"""Landing of delimited extracts as all-text tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import moment
from .records import read_records
from .registry import SOURCES, SourceTable
from .tables import save_overwrite, source


def string_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_delimited(
    spark: SparkSession,
    path: str,
    columns: Iterable[str],
    sep: str = "\t",
    multiline: bool = False,
) -> DataFrame:
    """Headerless text file with a fixed column order; empty fields are NULL."""
    return (
        spark.read.options(
            header=False, sep=sep, encoding="UTF-8", nullValue="", multiLine=multiline, escape='"'
        )
        .schema(string_schema(columns))
        .csv(path)
    )


def with_loaded_at(df: DataFrame, as_of) -> DataFrame:
    """Stamp the load time; the source's own ModifiedDate stays as it came."""
    return df.withColumn("LoadedAt", moment(as_of).cast("string"))


def ingest(spark: SparkSession, table: str | SourceTable, path: str, as_of, split: bool = False) -> DataFrame:
    """The landed form of one extract; with ``split``, many tasks read a multi-line file, after a first job over it."""
    spec = SOURCES[table] if isinstance(table, str) else table
    if split and spec.multiline:
        return with_loaded_at(read_records(spark, path, spec.columns, spec.separator), as_of)
    return with_loaded_at(read_delimited(spark, path, spec.columns, spec.separator, spec.multiline), as_of)


def landing_file(landing: str, table: str) -> str:
    return f"{landing.rstrip('/')}/{table}.csv"


def missing_inputs(spark: SparkSession, landing: str, tables: Iterable[str] = SOURCES) -> list[str]:
    """Tables without a file (or directory of part files) under ``landing``."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    absent = []
    for table in tables:
        path = jvm.org.apache.hadoop.fs.Path(landing_file(landing, table))
        if not path.getFileSystem(conf).exists(path):
            absent.append(table)
    return sorted(absent)


def ingest_all(
    spark: SparkSession, landing: str, as_of, tables: Iterable[str] = SOURCES, split: bool = False
) -> dict[str, DataFrame]:
    """Every landed table, or one error that names all missing files."""
    tables = list(tables)
    absent = missing_inputs(spark, landing, tables)
    if absent:
        raise FileNotFoundError(
            f"{len(absent)} of {len(tables)} source files missing under {landing}: {', '.join(absent)}"
        )
    return {t: ingest(spark, t, landing_file(landing, t), as_of, split) for t in tables}


def land(
    spark: SparkSession, landing: str, base: str, as_of, tables: Iterable[str] = SOURCES
) -> dict[str, DataFrame]:
    """Land every source once as a stored all-text table under ``base``; later readers scan those, not the text."""
    landed = ingest_all(spark, landing, as_of, tables, split=True)
    for name, df in landed.items():
        save_overwrite(df, f"{base}/{name}")
    return {name: source(spark, f"{base}/{name}") for name in landed}

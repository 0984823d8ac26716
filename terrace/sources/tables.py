"""Table scans and sinks.

A run that reads a table and replaces it writes a new version directory and
readers take the newest finished one. Spark's own job commit decides what is
finished (the ``_SUCCESS`` marker), so a lost executor or a failed run leaves
the previous version in place.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import merge_upsert, require_unique

VERSION_PREFIX = "version="


def is_path(name: str) -> bool:
    return "/" in name


def source(spark: SparkSession, name: str) -> DataFrame:
    """A table by catalog name, or Parquet files by path."""
    return spark.read.parquet(name) if is_path(name) else spark.table(name)


def save_overwrite(df: DataFrame, name: str) -> None:
    writer = df.write.mode("overwrite")
    if is_path(name):
        writer.parquet(name)
    else:
        writer.saveAsTable(name)


def append(df: DataFrame, name: str) -> None:
    writer = df.write.mode("append")
    if is_path(name):
        writer.parquet(name)
    else:
        writer.saveAsTable(name)


def materialize(df: DataFrame, name: str, mode: str) -> DataFrame:
    """``view`` keeps the plan lazy under a name; ``table`` writes it and reads it back."""
    if mode == "view":
        df.createOrReplaceTempView(name)
        return df
    if mode == "table":
        save_overwrite(df, name)
        return source(df.sparkSession, name)
    raise ValueError(f"unknown materialisation {mode!r}")


def _finished_versions(spark: SparkSession, base: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    done = []
    for status in fs.listStatus(root):
        path = status.getPath()
        if path.getName().startswith(VERSION_PREFIX):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
                done.append(int(path.getName()[len(VERSION_PREFIX):]))
    return sorted(done)


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    """The newest finished version, or None before the first run."""
    done = _finished_versions(spark, base)
    return spark.read.parquet(f"{base}/{VERSION_PREFIX}{done[-1]}") if done else None


def write_version(df: DataFrame, base: str) -> DataFrame:
    """Write the next version and return it as read back."""
    spark = df.sparkSession
    done = _finished_versions(spark, base)
    target = f"{base}/{VERSION_PREFIX}{(done[-1] if done else 0) + 1}"
    df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


RUN_PREFIX = "run="
# Holds a run's columns and types; readers of data skip names that begin so.
SHAPE = "_shape"
# Holds one row per partition the run replaced: the smallest and largest of some columns in it.
MARKS = "_marks"
# Begins the name of an empty directory for each partition that the run gave up: its rows are in others of the run.
GIVEN_UP = "_given_up."


def _finished_partitions(spark: SparkSession, base: str) -> tuple[dict[str, str], list[str], int]:
    """Newest finished directory per partition, finished runs (oldest first), and the last run number."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(conf)
    newest: dict[str, str] = {}
    finished: list[str] = []
    if not fs.exists(root):
        return newest, finished, 0
    runs = sorted(
        int(s.getPath().getName()[len(RUN_PREFIX):])
        for s in fs.listStatus(root)
        if s.getPath().getName().startswith(RUN_PREFIX)
    )
    for number in runs:
        folder = f"{base}/{RUN_PREFIX}{number}"
        if not fs.exists(jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
            continue
        finished.append(folder)
        for status in fs.listStatus(jvm.org.apache.hadoop.fs.Path(folder)):
            name = status.getPath().getName()
            if name.startswith(GIVEN_UP):
                newest.pop(name[len(GIVEN_UP):], None)
            elif status.isDirectory() and "=" in name:
                newest[name] = f"{folder}/{name}"
    return newest, finished, runs[-1] if runs else 0


def read_partitions(spark: SparkSession, base: str) -> DataFrame | None:
    """A table of ``merge_partitions``: each partition from the newest finished run that holds it.

    The newest run's columns, kept as a file without rows, are the table's;
    partitions of older runs read the columns they lack as NULL. A table whose
    runs hold no rows is empty, not missing.
    """
    newest, finished, _ = _finished_partitions(spark, base)
    if not finished:
        return None
    schema = spark.read.parquet(f"{finished[-1]}/{SHAPE}").schema
    if not newest:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", base)
    return reader.parquet(*newest.values()).drop(RUN_PREFIX.rstrip("="))


def holds_partitions(spark: SparkSession, base: str) -> bool:
    """Whether any finished run wrote a partition; a first load of nothing did not."""
    return bool(_finished_partitions(spark, base)[0])


def _marked(df: DataFrame, partition: str, columns: Sequence[str]) -> DataFrame:
    bounds = [f(c).alias(f"{c}_{end}") for c in columns for f, end in ((F.min, "min"), (F.max, "max"))]
    return df.groupBy(partition).agg(*bounds)


def read_marks(spark: SparkSession, base: str, partition: str, columns: Sequence[str]) -> DataFrame | None:
    """``<column>_min`` and ``<column>_max`` of each partition, as its newest finished run left them; None before the first run.

    A run keeps the marks of the partitions it replaced, so this reads one small row
    per partition and run. Only partitions whose run kept no such marks are scanned.
    """
    newest, finished, _ = _finished_partitions(spark, base)
    if not finished:
        return None
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    names = [f"{c}_{end}" for c in columns for end in ("min", "max")]
    parts, ended = [], set()
    for folder in finished:
        root = jvm.org.apache.hadoop.fs.Path(folder)
        held = (s.getPath().getName() for s in root.getFileSystem(conf).listStatus(root))
        ended |= {n[len(GIVEN_UP):] for n in held if n.startswith(GIVEN_UP)}
        number = int(folder.rsplit(RUN_PREFIX, 1)[1])
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{MARKS}/_SUCCESS")
        kept = spark.read.parquet(f"{folder}/{MARKS}") if path.getFileSystem(conf).exists(path) else None
        if kept is None or not set(names) <= set(kept.columns):
            owned = [p for p in newest.values() if p.startswith(f"{folder}/")]
            if not owned:
                continue
            schema = spark.read.parquet(f"{folder}/{SHAPE}").schema
            kept = _marked(spark.read.schema(schema).option("basePath", folder).parquet(*owned), partition, columns)
        parts.append(kept.select(partition, F.lit(number).alias("_run"), F.struct(*names).alias("_marks")))
    if not parts:
        return None
    every = reduce(DataFrame.unionByName, parts).groupBy(partition).agg(F.max_by("_marks", "_run").alias("_marks"))
    past = [int(name.partition("=")[2]) for name in ended - newest.keys()]
    return (every.filter(~F.col(partition).isin(past)) if past else every).select(partition, "_marks.*")


def write_partitions(
    df: DataFrame, base: str, partition: str, values: Sequence[int], marks: Sequence[str] = (), given_up: Sequence[int] = ()
) -> DataFrame:
    """Replace the partitions ``values`` by the rows ``df`` has for them and end those ``given_up``; the others stay.

    Each run writes to a directory of its own, which readers take up when Spark
    has committed it: a run that loses executors or fails leaves the table as
    it was. A replaced partition without rows is an empty directory of the run.
    The bounds of the columns ``marks`` are kept with the run (see ``read_marks``),
    computed from what it wrote; a run that ends before that is read as one without.
    """
    spark = df.sparkSession
    _, _, last = _finished_partitions(spark, base)
    folder = f"{base}/{RUN_PREFIX}{last + 1}"
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for value in values:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{partition}={value}")
        path.getFileSystem(conf).mkdirs(path)
    for value in given_up:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{GIVEN_UP}{partition}={value}")
        path.getFileSystem(conf).mkdirs(path)
    df.limit(0).write.parquet(f"{folder}/{SHAPE}")
    # Rebalancing keeps one partition in few files and splits one that is large.
    balanced = df.filter(F.col(partition).isin(list(values))).hint("rebalance", F.col(partition))
    balanced.write.mode("append").partitionBy(partition).parquet(folder)
    if marks:
        kind = df.schema[partition].dataType.simpleString()
        replaced = spark.createDataFrame([(v,) for v in values], f"`{partition}` {kind}")
        written = spark.read.schema(df.schema).option("basePath", folder)
        written = written.parquet(*[f"{folder}/{partition}={v}" for v in values]) if values else df.limit(0)
        found = _marked(written, partition, marks)
        replaced.join(found, partition, "left").coalesce(1).write.parquet(f"{folder}/{MARKS}")
    return read_partitions(spark, base)


def merge_partitions(
    updates: DataFrame,
    base: str,
    keys: Sequence[str],
    partition: str,
    rows_move: bool = False,
    marks: Sequence[str] = (),
    check_unique: bool = True,
) -> DataFrame:
    """Keyed merge into a partitioned table that rewrites only the partitions it touches.

    ``partition`` is an integer, never NULL. Where it follows from the key, the batch's
    own partitions are the touched ones and no other is read. Otherwise pass
    ``rows_move``: the partitions that now hold one of the batch's keys are rewritten
    too, which scans the key columns of the whole table. A batch with a repeated key is
    an error. ``updates`` is read several times: pass a stored table.
    """
    if check_unique:
        require_unique(updates, keys)
    target = read_partitions(updates.sparkSession, base)
    touched = updates.select(partition)
    if target is not None and rows_move:
        touched = touched.union(target.join(updates.select(*keys), list(keys), "left_semi").select(partition))
    # One small value per touched partition; the merge below reads no others.
    values = sorted(r[0] for r in touched.distinct().collect())
    if target is None:
        return write_partitions(updates, base, partition, values, marks)  # also without rows: the table's columns
    if not values:
        return target
    merged = merge_upsert(target.filter(F.col(partition).isin(values)), updates, keys, check_unique=False)
    return write_partitions(merged, base, partition, values, marks)


def compact_partitions(
    spark: SparkSession, base: str, partition: str, values: Sequence[int], fan: int = 8, unit: int = 128 << 20
) -> list[int]:
    """Merge neighbours among the partitions ``values`` into ranges, named by their largest value; returns what was given up.

    A partition's tier is the logarithm, to base ``fan``, of its size in units of
    ``unit`` bytes, and at least that of every later one. Where ``fan`` or more share a
    tier, the lowest such tier becomes one partition. So fewer than ``fan`` a tier
    remain, and a row beyond the first unit is rewritten about once a tier. Only
    for partitions whose rows change no more; no value without rows of its own is read by
    name afterwards. The merge is a run like any other: until it is committed readers see
    the partitions as they were.
    """
    newest, _, _ = _finished_partitions(spark, base)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    wanted = set(values)
    names = {int(n.partition("=")[2]): path for n, path in newest.items() if n.startswith(f"{partition}=")}
    tiers: dict[int, list[int]] = {}
    tier = 0
    for value in sorted(wanted & names.keys(), reverse=True):
        path = jvm.org.apache.hadoop.fs.Path(names[value])
        size, own = path.getFileSystem(conf).getContentSummary(path).getLength() // unit, 0
        while size >= fan ** (own + 1):
            own += 1
        tier = max(tier, own)
        tiers.setdefault(tier, []).append(value)
    full = [group for _, group in sorted(tiers.items()) if len(group) >= fan]
    if not full:
        return []
    last, *others = full[0]
    rows = read_partitions(spark, base).filter(F.col(partition).isin(full[0]))
    write_partitions(rows.withColumn(partition, F.lit(last).cast(rows.schema[partition].dataType)), base, partition, [last], given_up=others)
    return sorted(others)


def partition_values(spark: SparkSession, base: str, partition: str) -> list[int]:
    """The values of the partitions that readers see now."""
    newest, _, _ = _finished_partitions(spark, base)
    return sorted(int(n.partition("=")[2]) for n in newest if n.startswith(f"{partition}="))


def retire_runs(spark: SparkSession, base: str, states: int = 2) -> list[str]:
    """Delete the finished runs that none of the last ``states`` states of the table reads; returns their folders.

    A state is what readers saw after one finished run. With two, a reader that opened
    the table before the newest run still finds all its files. Unfinished runs stay.
    """
    _, finished, _ = _finished_partitions(spark, base)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    held: dict[str, str] = {}
    holders: dict[str, list[str]] = {}
    ends: dict[str, list[str]] = {}
    needed: set[str] = set(finished[-states:])
    for place, folder in enumerate(finished):
        path = jvm.org.apache.hadoop.fs.Path(folder)
        for status in path.getFileSystem(conf).listStatus(path):
            name = status.getPath().getName()
            if name.startswith(GIVEN_UP):
                held.pop(name[len(GIVEN_UP):], None)
                ends.setdefault(name[len(GIVEN_UP):], []).append(folder)
            elif status.isDirectory() and "=" in name:
                held[name] = folder
                holders.setdefault(name, []).append(folder)
        if place >= len(finished) - states:
            needed |= set(held.values())
    # A run that gave up a partition stays as long as an older one that stays still holds it.
    age = {folder: place for place, folder in enumerate(finished)}
    for folder in finished:
        ended = [h for name, enders in ends.items() if folder in enders for h in holders.get(name, [])]
        if any(h in needed and age[h] < age[folder] for h in ended):
            needed.add(folder)
    gone = [folder for folder in finished if folder not in needed]
    for folder in gone:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    return gone


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as ``spark.checkpoint.dir`` names it.

    Only a local session may leave it unset; it then gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
        folder = tempfile.mkdtemp(prefix="terrace-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder, removed when the application ends."""
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleanup_lock, _cleanups = threading.Lock(), [0, None]


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries begun inside delete their shuffle files as they end, not whenever the driver's memory is collected next."""
    with _cleanup_lock:
        if not _cleanups[0]:
            _cleanups[1] = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _cleanups[0] += 1
    try:
        yield
    finally:
        with _cleanup_lock:
            _cleanups[0] -= 1
            if not _cleanups[0]:
                if _cleanups[1] is None:
                    spark.conf.unset(CLEANUP)
                else:
                    spark.conf.set(CLEANUP, _cleanups[1])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a directory of its own under the shared folder and read it back.

    This cuts the lineage, and the file sizes tell Catalyst how large the table
    really is: a small dimension is then broadcast from the start and the other
    side of its join is never shuffled, a large one is not. Hashed keys, which the default
    codec leaves as they are, take about half the space, and what was shuffled for the
    table does not stay beside it.
    """
    path = new_folder(df.sparkSession, name)
    with shuffles_deleted(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_all(frames: Mapping[str, DataFrame], threads: int = 4) -> dict[str, DataFrame]:
    """``stored`` for independent tables, a few writes at a time so that small jobs overlap."""
    with ThreadPoolExecutor(threads) as pool:
        written = pool.map(lambda item: stored(item[1], item[0]), frames.items())
        return dict(zip(frames, written))

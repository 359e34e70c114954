"""Helpers shared by the training-data operators: tables, scratch space and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import accumulate
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

#: White space that ends a word: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes, and rows, of a batch that goes to Python: texts are long, and two tasks share an executor's memory.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    A folder of this machine is made only where the setting is missing and the session is local, as in tests.
    """
    small_batches(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_RECORD: list[list[str]] = []


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Within it, paths gets the folders of all tables that materialize writes."""
    _RECORD.append(paths)
    try:
        yield
    finally:
        _RECORD.pop()


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders below the shared one, those that are there."""
    jvm = spark.sparkContext._jvm
    for folder in paths:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared scratch folder and read again: this ends its lineage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    for paths in _RECORD:
        paths.append(path)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Deletes the files of a materialized table that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_table(spark: SparkSession, columns: dict[str, pa.Array]) -> DataFrame:
    """Columns of the driver as a table, by Arrow: rows of tuples would be copied by Python workers of a kind of their own."""
    return spark.createDataFrame(pa.table(columns))


def whole_row(df: DataFrame) -> Column:
    """All columns of df, whatever their names, as one struct `row`."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias("row")


def in_order(docs: DataFrame, key: str) -> DataFrame:
    """docs by key, nulls last; rows of one key are parted by the hash of text, and equal ones by chance."""
    order = [F.col(key).asc_nulls_last(), F.xxhash64("text"), F.col("_tie")]
    tied = docs.withColumn("_tie", F.monotonically_increasing_id())
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, docs.rdd.getNumPartitions())
    return tied.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_tie")


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """rows, written to the shared scratch folder, with key: 0, 1, 2, ... in the order of their partitions.

    A row keeps its number however often the result is read. The driver sees one count for each partition.
    """
    made = materialize(rows.withColumn("_n", F.monotonically_increasing_id()), name)
    counts = made.groupBy(F.shiftright("_n", 33).alias("_part")).count().collect()
    counts.sort()
    n = [r["count"] for r in counts]
    offsets = {"_part": pa.array([r["_part"] for r in counts], pa.int64()), "_first": pa.array(accumulate(n[:-1], initial=0) if n else [], pa.int64())}
    starts = F.broadcast(small_table(made.sparkSession, offsets).coalesce(1))
    keyed = made.withColumn("_part", F.shiftright("_n", 33)).join(starts, "_part")
    return keyed.withColumn("key", F.col("_first") + F.col("_n").bitwiseAND(F.lit((1 << 33) - 1))).drop("_n", "_part", "_first")


def with_end(batches: Iterable[T]) -> Iterator[T | None]:
    """batches, and None behind the last."""
    yield from batches
    yield None


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components of an edge table (a, b): one row (node, component) for each node that an edge names.

    component is the smallest node that can be reached. Each round maps every node to the smallest label around it
    (large star) and points labels at their own labels (small star); rounds end when no label changes. All work is
    joins and min-aggregates, so that a hub with very many edges never meets in one task. Edges with a null end and
    loops are ignored, repeated edges count once.
    """
    edges = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    stars = materialize(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "cc")
    for _ in range(max_rounds):
        # large star: every neighbour above a node is tied to the smallest node around it
        both = stars.unionByName(stars.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.where("v <> u").distinct()
        # small star: a node's smaller neighbours, and itself, are tied to the smallest of them
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u")
        small = small.unionByName(low.select("v", F.col("m").alias("u"))).distinct()
        new = materialize(small, "cc")
        # a star forest: nothing that is a centre is also a leaf, and each leaf has one centre
        leaves = new.select("v")
        settled = new.join(leaves.withColumnRenamed("v", "u").distinct(), "u", "left_semi").isEmpty()
        settled = settled and new.groupBy("v").count().where("count > 1").isEmpty()
        forget(stars)
        stars = new
        if settled:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return stars.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
        stars.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    )

"""Session helpers: the shared working folder and the UTC pin."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pin_utc(spark: SparkSession) -> SparkSession:
    """Dates in named zones are computed from UTC wall clocks, so the session must be in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="fxtape-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def published(df: DataFrame, label: str, *partition: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For relations several later steps read: it cuts lineage, survives lost executors and gives
    Catalyst the true size.
    """
    path = new_folder(df.sparkSession, label)
    df.write.mode("errorifexists").partitionBy(*partition).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def wide_maps(spark: SparkSession) -> Iterator[None]:
    """Aggregations that run inside hold 1,048,576 groups of a task in their generated map, not 65,536.

    Groups beyond are looked up in a general map, which takes several times as long a row. The results
    are the same, and the map's memory is the task's as before.
    """
    name = "spark.sql.codegen.aggregate.fastHashMap.capacityBit"
    before = spark.conf.get(name)
    spark.conf.set(name, "20")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def evaluated(df: DataFrame) -> DataFrame:
    """The same rows and columns, with computed columns computed once.

    Catalyst pushes a filter on a computed column below the projection by repeating the column's
    expression there. For a long validation expression that means parsing the message again for
    every field it mentions. Unpacking a one-element array is a step filters do not cross.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def positioned(ordered: DataFrame) -> DataFrame:
    """The rows of a sorted relation with their place in it, from 0.

    The relation is stored as it is sorted, a file per range. Its rows are numbered within their range
    and shifted by the sizes of the ranges before, of which one number each reaches the driver.
    """
    numbered = published(
        ordered.withColumn("_row", F.monotonically_increasing_id()), "ordered"
    )
    part = F.shiftright("_row", 33)
    sizes = sorted(numbered.groupBy(part.alias("part")).count().collect())
    starts, total = {}, 0
    for number, size in sizes:
        starts[number], total = total, total + size
    if not starts:
        return numbered.withColumn("position", F.col("_row")).drop("_row")
    first = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair])
    place = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + first[part]
    return numbered.withColumn("position", place).drop("_row")

"""Versions of a stored table behind a log, and small files every executor's store can hold.

A version is a folder that nobody reads until an entry of the log names it. Entries are numbered and
created only if the number is free, so of two writers that start from the same version one is refused.
Readers list the names of the log and open its last entry: no scan of older versions, and no folder a
reader has opened is written again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "_log"


class RefusedWrite(ValueError):
    """The sink would lose or contradict what is there."""


def _place(spark: SparkSession, path: str):
    """The store of a path, and the path as that store knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly below a folder, sorted; none where it does not exist."""
    store, where = _place(spark, folder)
    return sorted(s.getPath().getName() for s in store.listStatus(where)) if store.exists(where) else []


def write_small(spark: SparkSession, path: str, value: dict, replace: bool = False) -> None:
    """One JSON object as a file; unless ``replace``, the file must not exist yet."""
    store, where = _place(spark, path)
    try:
        out = store.create(where, replace)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            raise RefusedWrite(f"{path} exists") from error
        raise
    try:
        out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        out.close()


def read_small(spark: SparkSession, path: str) -> dict | None:
    """The JSON object of a small file; None if it is absent or was not written to its end."""
    store, where = _place(spark, path)
    if not store.exists(where):
        return None
    source = store.open(where)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def remove(spark: SparkSession, path: str) -> None:
    store, where = _place(spark, path)
    store.delete(where, True)


def move_in_order(spark: SparkSession, source: str, target: str, parts: list[str]) -> None:
    """Move files into a folder one after the other, each with a later modification time than the last.

    A folder that is there already is refused.
    """
    store, goal = _place(spark, target)
    if store.exists(goal):
        raise RefusedWrite(f"{target} exists")
    store.mkdirs(goal)
    path = spark._jvm.org.apache.hadoop.fs.Path
    start = spark._jvm.java.lang.System.currentTimeMillis() - 1000 * len(parts)
    for number, part in enumerate(parts):
        if not store.rename(path(f"{source}/{part}"), path(f"{target}/{part}")):
            raise OSError(f"{part} could not be moved to {target}")
        store.setTimes(path(f"{target}/{part}"), start + 1000 * number, -1)


def observed_write(df: DataFrame, path: str, mode: str = "errorifexists", *partition: str) -> int:
    """Write Parquet and return the number of rows, counted by the write itself."""
    observed = Observation("write")
    writer = df.observe(observed, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    writer.partitionBy(*partition).parquet(path)
    return observed.get["rows"]


@dataclass(frozen=True)
class Version:
    """``number`` is its place in the log, ``name`` the caller's (a run id), ``folder`` its files."""

    number: int
    name: str
    folder: str
    rows: int


def _entries(spark: SparkSession, root: str) -> list[str]:
    return [name for name in names(spark, f"{root}/{LOG}") if name.endswith(".json")]


def newest(spark: SparkSession, root: str) -> Version | None:
    """The last version that was published, None before the first one."""
    for entry in reversed(_entries(spark, root)):
        told = read_small(spark, f"{root}/{LOG}/{entry}")
        if told is not None:
            return Version(**told)
    return None


def stage(df: DataFrame, root: str, name: str, expected: int | None = None, *partition: str) -> Version:
    """Write the files of a version that is not published yet.

    It takes the place after the newest one in the log as of now; a wrong number of rows is refused.
    """
    spark = df.sparkSession
    taken = _entries(spark, root)
    number = int(taken[-1].removesuffix(".json")) + 1 if taken else 1
    folder = f"{name}-{uuid.uuid4().hex}"
    rows = observed_write(df, f"{root}/{folder}", "errorifexists", *partition)
    if expected is not None and rows != expected:
        raise RefusedWrite(f"{root}: {rows} rows stored, {expected} expected")
    return Version(number, name, folder, rows)


def read(spark: SparkSession, root: str, version: Version, schema: T.StructType | None = None) -> DataFrame:
    """The rows of one version, published or staged."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root}/{version.folder}")


def publish(spark: SparkSession, root: str, version: Version) -> None:
    """Make a staged version the newest one.

    Refused if another writer has published since it was staged, and if the newest version has a later
    name, as names sort in the order of their runs.
    """
    before = newest(spark, root)
    if before is not None and before.name > version.name:
        raise RefusedWrite(f"{root}: {before.name} is newer than {version.name}")
    entry = f"{root}/{LOG}/{version.number:012d}.json"
    if before is not None and before.number >= version.number:
        raise RefusedWrite(f"{root}: another version was published since {version.name} was staged")
    write_small(spark, entry, asdict(version))


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """End all versions but the ``keep`` newest, and staged folders older than these that nobody published.

    Returns the names of the folders that went. A reader that opened an ended version loses its files,
    so ``keep`` covers the longest read.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    told = {entry: read_small(spark, f"{root}/{LOG}/{entry}") for entry in _entries(spark, root)}
    good = [(entry, value) for entry, value in told.items() if value is not None]
    kept = {value["folder"] for _, value in good[-keep:]}
    oldest = min((value["name"] for _, value in good[-keep:]), default="")
    gone = []
    for name in names(spark, root):
        if name != LOG and name not in kept and name.rsplit("-", 1)[0] < oldest:
            remove(spark, f"{root}/{name}")
            gone.append(name)
    for entry, value in good[:-keep]:
        if value["folder"] in gone or value["folder"] not in names(spark, root):
            remove(spark, f"{root}/{LOG}/{entry}")
    return gone

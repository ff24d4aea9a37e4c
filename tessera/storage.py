"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import gc
import re
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

#: What stored() has written in each scratch() block that is open, the innermost last.
_scratch: list[list[DataFrame]] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder of this machine, for local sessions only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, what: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/tessera/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str, codec: str = "none") -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends here, and a lost executor costs only its tasks.

    Without a codec no memory outside the heap goes to compressors; texts are worth "zstd".
    """
    spark = df.sparkSession
    path = fresh_path(spark, what)
    df.write.option("compression", codec).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    if _scratch:
        _scratch[-1].append(table)
    return table


class Log:
    """A table in the shared folder that grows by rows appended in rounds; however many, it is read as one table."""

    def __init__(self, spark: SparkSession, what: str, schema: str):
        self.spark, self.schema, self.path, self.rounds = spark, schema, fresh_path(spark, what), 0

    def append(self, df: DataFrame) -> DataFrame:
        """Write a round; gives the table of its rows."""
        self.rounds += 1
        path = f"{self.path}/round={self.rounds}"
        df.write.option("compression", "none").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self) -> DataFrame:
        """All rounds' rows."""
        out = self.spark.read.schema(self.schema).parquet(self.path).drop("round")
        out._stored_at = self.path
        if _scratch:
            _scratch[-1].append(out)
        return out


@contextlib.contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A block whose stored() tables are deleted at its end, also if it fails.

    It gives keep(table): that table outlives the block, and belongs to the block around
    it, if there is one.  Whatever else is used later must not read the block's tables.
    """
    mine: list[DataFrame] = []
    kept: list[DataFrame] = []
    _scratch.append(mine)

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table)
        return table

    try:
        yield keep
    finally:
        _scratch.pop()
        over = {getattr(t, "_stored_at", None) for t in kept}
        release(*[t for t in mine if t._stored_at not in over])
        if _scratch:
            _scratch[-1].extend(t for t in mine if t._stored_at in over)


def _place(spark: SparkSession, path: str):
    """A path, and the file system that it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, a folder's files or a pattern's, by name; hidden ones aren't data."""
    place, system = _place(spark, path)
    out = []
    for found in system.globStatus(place) or []:
        for status in system.listStatus(found.getPath()) if found.isDirectory() else [found]:
            if not status.isDirectory() and status.getPath().getName()[:1] not in "._":
                out.append((re.sub("^file:/+", "/", status.getPath().toString()), status.getLen()))
    if not out and not system.exists(place):
        raise FileNotFoundError(path)
    return sorted(out)


def listed_below(spark: SparkSession, folder: str) -> list[tuple[str, str, int]]:
    """(path, path in the folder, bytes) of all files below a folder, but for those in or of hidden names."""
    place, system = _place(spark, folder)
    if not system.exists(place):
        return []
    top, out = system.makeQualified(place).toString().rstrip("/") + "/", []
    found = system.listFiles(place, True)
    while found.hasNext():
        status = found.next()
        path = status.getPath().toString()
        rest = path[len(top) :]
        if not any(part[:1] in "._" for part in rest.split("/")):
            out.append((path, rest, status.getLen()))
    return out


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder on any file system that Spark reaches."""
    place, system = _place(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder."""
    place, system = _place(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Give a file or folder another name on the same file system."""
    place, system = _place(spark, path)
    if not system.rename(place, _place(spark, to)[0]):
        raise OSError(f"can't move {path} to {to}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text as one file; there must be none yet."""
    place, system = _place(spark, path)
    out = system.create(place, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def release(*tables: DataFrame) -> None:
    """Delete stored() tables that nothing reads any more."""
    for table in tables:
        path = getattr(table, "_stored_at", None)
        if path:
            delete(table.sparkSession, path)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are done.

    It does so once the driver's garbage is collected: first Python's, which lets go of the
    JVM's, then, a moment later, the JVM's.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)

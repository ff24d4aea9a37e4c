"""Publishing a folder on any store: what is published is what its manifest names, and the manifest is written last.

A rename is one step on a local disk or HDFS, but not on an object store, where a folder that
is half there looks like one that is whole.  Here a folder without a manifest, or with one
that is cut off, can't be read, whatever else is in it; each file is named with its size, its
lines and a digest of them.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.storage import exists, listed_below, move, write_text

MANIFEST = "_manifest.json"
#: Stores on which a folder gets another name in one step.
RENAMES = ("file", "hdfs", "viewfs", "webhdfs")


def _plain(path: str) -> str:
    """A path without its store."""
    return re.sub("^[A-Za-z0-9.+-]+:/*", "/", unquote(path))


def digests(spark: SparkSession, folder: str) -> list[dict]:
    """(path, bytes, lines, digest) of all text files below a folder, by their paths in it; sums of line hashes, so that large files needn't be read in one piece."""
    files = listed_below(spark, folder)
    lines = spark.read.option("recursiveFileLookup", "true").text(folder) if files else spark.createDataFrame([], "value string")
    place = F.col("_metadata.file_path") if files else F.lit("")
    told = lines.groupBy(place.alias("path")).agg(F.count(F.lit(1)).alias("lines"), F.sum(F.xxhash64("value").cast("decimal(38,0)")).alias("digest"))
    # a row for each file, as the listing has
    known = {_plain(r["path"]): (r["lines"], str(r["digest"])) for r in told.collect()}
    out = []
    for path, rest, size in files:
        count, digest = known.get(_plain(path), (0, "0"))
        out.append({"path": rest, "bytes": size, "lines": count, "digest": digest})
    return sorted(out, key=lambda f: f["path"])


def _seal(body: dict) -> str:
    return hashlib.sha256(json.dumps(body, sort_keys=True).encode()).hexdigest()


def commit(spark: SparkSession, target: str, base: str = "") -> None:
    """Publish what is in target (or in its folder base): write its manifest, sealed by its own digest."""
    body = {"base": base, "files": digests(spark, f"{target}/{base}".rstrip("/"))}
    write_text(spark, f"{target}/{MANIFEST}", json.dumps(body | {"seal": _seal(body)}, indent=1) + "\n")


class Published:
    """A published folder; a FileNotFoundError where there is no whole manifest."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")
        path = f"{self.target}/{MANIFEST}"
        if not exists(spark, path):
            raise FileNotFoundError(f"{target} isn't published: it has no manifest")
        # as lines: a text scan skips files that begin with an underscore, unless they are named
        stream = spark._jvm.org.apache.hadoop.fs.Path(path)
        data = stream.getFileSystem(spark._jsc.hadoopConfiguration()).open(stream)
        try:
            text = bytes(data.readAllBytes()).decode()
        finally:
            data.close()
        try:
            body = json.loads(text)
            seal = body.pop("seal")
        except (ValueError, KeyError, AttributeError):
            raise FileNotFoundError(f"{target} isn't published: its manifest is cut off") from None
        if seal != _seal(body):
            raise FileNotFoundError(f"{target} isn't published: its manifest isn't whole")
        self.files, self.folder = body["files"], f"{self.target}/{body['base']}".rstrip("/")

    def paths(self, name: str) -> list[str]:
        """The files of one table, or the one file of that name."""
        return [f"{self.folder}/{f['path']}" for f in self.files if f["path"] == name or f["path"].startswith(f"{name}/")]

    def read_json(self, name: str, schema) -> DataFrame | None:
        """A JSON Lines table of named files alone; None where it isn't named."""
        paths = self.paths(name)
        return self.spark.read.schema(schema).json(paths) if paths else None

    def faults(self) -> list[str]:
        """Files that are no longer as they were published, are gone, or have come up since."""
        now, then = ({f["path"]: f for f in files} for files in (digests(self.spark, self.folder), self.files))
        now.pop(MANIFEST, None)
        return sorted(p for p in now.keys() | then.keys() if now.get(p) != then.get(p))


class Staged:
    """A run's folder while it is written, on any store: it counts only once all is well and its manifest is there.

    Where a rename is one step, the folder has another name until then, which that of a
    failed run keeps; elsewhere it is a folder of its own in the target.
    """

    def __init__(self, spark: SparkSession, target: str, rename: bool | None = None):
        self.spark, self.target = spark, target.rstrip("/")
        scheme = spark._jvm.org.apache.hadoop.fs.Path(self.target).getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
        self.rename = scheme in RENAMES if rename is None else rename
        self._free("is there already")
        parent, _, name = self.target.rpartition("/")
        one = uuid.uuid4().hex
        self.base = "" if self.rename else f"run-{one}"
        self.work = f"{parent}{'/' if parent or self.target.startswith('/') else ''}.{name}.incomplete.{one}" if self.rename else f"{self.target}/{self.base}"

    def _free(self, why: str) -> None:
        # what a failed run left in an object store has no manifest and is in nobody's way
        if exists(self.spark, self.target if self.rename else f"{self.target}/{MANIFEST}"):
            raise FileExistsError(f"{self.target} {why}")

    def __enter__(self) -> str:
        return self.work

    def __exit__(self, kind, value, trace) -> None:
        if kind is None:
            self._free(f"came up meanwhile; the results are in {self.work}")
            if self.rename:
                move(self.spark, self.work, self.target)
            commit(self.spark, self.target, self.base)

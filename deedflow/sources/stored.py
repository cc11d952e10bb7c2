"""Stored views: versioned tables that are switched in one step and refreshed by key.

A table is a folder with two parts:

- data/<id>/_bucket=<k>: the rows of one bucket of keys as Parquet, never changed once they are there
- log/<number>: a version, as JSON: its schema and the folder of each bucket

A version begins to exist when its log file does. That file is written aside and renamed to a name that must be free,
so a reader sees the last version or the next, never a part of one, and of two writers that began from one version the
slower gets a `Conflict`. Frames that readers hold go on reading their version's files, until `vacuum` removes versions
that old. A refresh writes the buckets of the keys that it is given; the other buckets stay where they are.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.joins import without


HASH = "murmur3"  # the hash that deals keys to buckets, as versions name it


class Conflict(RuntimeError):
    """Another writer has made the version that this one wanted to make."""


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share: under spark.checkpoint.dir, or, in a local session without it, a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.gettempdir()}/checkpoints"
    return os.path.join(base, uuid.uuid4().hex)


class Stored:
    """A stored table at path. key: the columns by which it is refreshed; buckets: folders that its rows are dealt to; split:
    tasks that may write one bucket at once."""

    def __init__(self, spark: SparkSession, path: str, key: tuple[str, ...], buckets: int = 32, split: int = 1):
        self.spark, self.path, self.key, self.buckets, self.split = spark, path.rstrip("/"), tuple(key), buckets, split
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- versions

    def versions(self) -> list[int]:
        log = self._hadoop.Path(f"{self.path}/log")
        names = [s.getPath().getName() for s in self._fs.listStatus(log)] if self._fs.exists(log) else []
        return sorted(int(n) for n in names if n.isdigit())

    def version(self) -> int | None:
        return max(self.versions(), default=None)

    def _manifest(self, version: int) -> dict:
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self.path}/log/{version:020d}", wholetext=True).collect()))

    def _commit(self, version: int, manifest: dict) -> int:
        aside = self._hadoop.Path(f"{self.path}/log/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        to = self._hadoop.Path(f"{self.path}/log/{version:020d}")
        context = self._hadoop.FileContext.getFileContext(to.toUri(), self.spark._jsc.hadoopConfiguration())
        rename = getattr(self._hadoop, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        try:
            context.rename(context.makeQualified(aside), context.makeQualified(to), how)
        except Exception as e:
            self._fs.delete(aside, False)
            if self._fs.exists(to):
                raise Conflict(f"version {version} of {self.path} exists") from e
            raise
        return version

    # --- rows

    def _bucket(self) -> Column:
        # The hash by which rows are dealt to tasks: a task of dealt() rows has one bucket.
        return F.pmod(F.hash(*self.key), F.lit(self.buckets)).cast("int")

    def dealt(self, rows: DataFrame) -> DataFrame:
        """rows, shuffled as they are stored. What comes after it by key isn't shuffled again, nor is the result when it is
        stored with dealt=True."""
        return rows.repartition(self.buckets * self.split, *self.key)

    def _put(self, rows: DataFrame, dealt: bool = False, more: DataFrame | None = None) -> dict[int, str]:
        """Writes rows, and more; the folder of each bucket that has any. dealt: rows are as dealt() gave them."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        for part, there in ((rows, dealt), (more, False)):
            if part is not None:
                (part if there else self.dealt(part)).withColumn("_bucket", self._bucket()).write.mode("append").partitionBy("_bucket").parquet(folder)
        there = self._fs.listStatus(self._hadoop.Path(folder))
        names = [s.getPath().getName() for s in there if s.isDirectory()]
        return {int(n.split("=")[1]): f"{folder.removeprefix(self.path)[1:]}/{n}" for n in names if n.startswith("_bucket=")}

    @contextmanager
    def kept(self, df: DataFrame) -> Iterator[DataFrame]:
        """df, worked out once and read from a folder beside the table while the block runs."""
        path = f"{self.path}/work/{uuid.uuid4().hex}"
        df.write.parquet(path)
        try:
            yield self.spark.read.schema(df.schema).parquet(path)
        finally:
            self._fs.delete(self._hadoop.Path(path), True)

    def _rows(self, schema: StructType, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default. The frame stays with that version."""
        version = self.version() if version is None else version
        if version is None:
            raise FileNotFoundError(f"{self.path} has no version")
        m = self._manifest(version)
        return self._rows(StructType.fromJson(m["schema"]), list(m["folders"].values()))

    def write(self, rows: DataFrame, dealt: bool = False) -> int:
        """A version of just these rows. dealt: they are as dealt() gave them, or made of that without another shuffle."""
        version = self.version()
        return self._commit(0 if version is None else version + 1, {"schema": rows.schema.jsonValue(), "hash": HASH, "folders": self._put(rows, dealt)})

    def replace(self, keys: DataFrame, rows: DataFrame, dealt: bool = False) -> int:
        """A version in which `rows` are the rows of `keys`, and other keys keep theirs. rows have no other keys. dealt: see write."""
        version = self.version()
        if version is None:
            raise FileNotFoundError(f"{self.path} has no version")
        m = self._manifest(version)
        schema = StructType.fromJson(m["schema"])
        keys = keys.select(*self.key).distinct()
        touched = {r[0] for r in keys.select(self._bucket()).distinct().collect()}
        if not touched:
            return version
        if m.get("hash") != HASH:  # dealt by another hash: all buckets are written anew
            touched = {int(b) for b in m["folders"]} | touched
        old = self._rows(schema, [f for b, f in m["folders"].items() if int(b) in touched])
        kept = without(old, keys, list(self.key))
        put = self._put(rows.select(*schema.names), dealt, kept)
        folders = {int(b): f for b, f in m["folders"].items() if int(b) not in touched} | put
        return self._commit(version + 1, {"schema": m["schema"], "hash": HASH, "folders": folders})

    def vacuum(self, keep: int = 2) -> int:
        """Removes all versions but the last `keep`, and the data that only they have; the number of folders removed. Data of a
        refresh that runs meanwhile isn't in any version yet: vacuum when none runs."""
        every = self.versions()
        stay = {f for v in every[-keep:] for f in self._manifest(v)["folders"].values()}
        for v in every[:-keep]:
            self._fs.delete(self._hadoop.Path(f"{self.path}/log/{v:020d}"), False)
        gone = 0
        data = self._hadoop.Path(f"{self.path}/data")
        for batch in self._fs.listStatus(data) if self._fs.exists(data) else []:
            for bucket in self._fs.listStatus(batch.getPath()):
                name = f"data/{batch.getPath().getName()}/{bucket.getPath().getName()}"
                if bucket.isDirectory() and name not in stay:
                    self._fs.delete(bucket.getPath(), True)
                    gone += 1
            if not any(s.isDirectory() for s in self._fs.listStatus(batch.getPath())):
                self._fs.delete(batch.getPath(), True)
        return gone

"""Snapshots of a warehouse folder: all relations change together, or none does.

A relation is a list of Parquet folders, each written once and never changed.
A snapshot is one small JSON file, ``snapshots/<number>.json``, that names the
folders of every relation (and a few properties of the build).  A batch writes
its folders first and its snapshot last; the number of the next snapshot can be
taken once, so of two writers that started from the same snapshot the second
loses (``Conflict``) and readers always see one whole state.  Older snapshots
stay readable until ``vacuum``.

Folders hold ``rows`` or ``deletes``.  Every file of a keyed relation carries the
number of its snapshot (``SEQ``); a delete takes out the rows of its key that
were written before it (merge on read), so replacing a few rows writes a few
rows.   Compaction is a batch like others: it
reads a relation and names one new folder in its place.

Folder and snapshot names are relative to the warehouse folder, which lies on a
file system that all executors share.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmart.functions.keys import packed_key, unpacked_key
from starmart.session import PARQUET
from starmart.sources.tables import HEX_KEYS

SEQ = "__seq"
_SEQ_OF_DELETE, _KEY_OF_DELETE = "__deleted_at", "__deleted_key"


class Conflict(RuntimeError):
    """Another writer has made a snapshot since this one's base."""


@dataclass(frozen=True)
class Folder:
    path: str
    kind: str = "rows"                       # or "deletes"
    months: tuple[int, ...] | None = None    # months it holds, if it is partitioned by month
    seq: int | None = None                   # number of the snapshot its rows came with, of a keyed relation


@dataclass(frozen=True)
class Snapshot:
    number: int = 0
    relations: dict[str, tuple[Folder, ...]] = field(default_factory=dict)
    properties: dict = field(default_factory=dict)

    def __contains__(self, name: str) -> bool:
        return bool(self.relations.get(name))


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------ files
    def _hadoop(self):
        return self.spark._jvm.org.apache.hadoop.fs

    def _path(self, relative: str):
        return self._hadoop().Path(f"{self.root}/{relative}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, relative: str) -> list[str]:
        fs, path = self._fs(), self._path(relative)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def numbers(self) -> list[int]:
        """Numbers of the snapshots there are, oldest first."""
        return sorted(int(n[:-5]) for n in self._names("snapshots") if n.endswith(".json") and n[:-5].isdigit())

    # ------------------------------------------------------------ snapshots
    def load(self, number: int | None = None) -> Snapshot:
        """The newest snapshot (an empty one if there is none), or an older one."""
        if number is None:
            there = self.numbers()
            if not there:
                return Snapshot()
            number = there[-1]
        text = self.spark.read.text(f"{self.root}/snapshots/{number}.json", wholetext=True).first()[0]
        stored = json.loads(text)
        relations = {name: tuple(Folder(f["path"], f["kind"], None if f["months"] is None else tuple(f["months"]), f["seq"])
                           for f in folders)
                     for name, folders in stored["relations"].items()}
        return Snapshot(stored["number"], relations, stored["properties"])

    def commit(self, base: Snapshot, relations: dict[str, Sequence[Folder]], properties: dict | None = None) -> Snapshot:
        """The next snapshot: ``base`` with ``relations`` replaced.  Raises Conflict if ``base`` is no longer the newest."""
        new = Snapshot(base.number + 1, {**base.relations, **{k: tuple(v) for k, v in relations.items()}},
                       {**base.properties, **(properties or {})})
        text = json.dumps({"number": new.number, "properties": new.properties, "relations": {
            name: [{"path": f.path, "kind": f.kind, "months": f.months, "seq": f.seq} for f in folders] for name, folders in new.relations.items()}})
        fs, draft = self._fs(), self._path(f"snapshots/_{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        context = self._hadoop().FileContext.getFileContext(self._path("").toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop(), "Options$Rename"), 0)
        try:  # refuses a target that is there
            context.rename(draft, self._path(f"snapshots/{new.number}.json"), none)
        except Py4JJavaError as failed:
            fs.delete(draft, False)
            if failed.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            raise Conflict(f"snapshot {new.number} of {self.root} was made by another writer") from failed
        return new

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove snapshots older than the newest ``keep`` and the folders no kept snapshot names; returns what went.

        Folders of a batch that is still being written are named by no snapshot either: run it when no writer is."""
        numbers = self.numbers()
        kept = {"/".join(f.path.split("/")[:3]) for n in numbers[-keep:] for folders in self.load(n).relations.values() for f in folders}
        gone = [f"snapshots/{n}.json" for n in numbers[:-keep]]
        gone += [f"snapshots/{n}" for n in self._names("snapshots") if n.startswith("_")]
        for name in self._names("data"):
            gone += [p for p in (f"data/{name}/{x}" for x in self._names(f"data/{name}")) if p not in kept]
        fs = self._fs()
        for p in gone:
            fs.delete(self._path(p), True)
        return gone

    # ------------------------------------------------------------ rows
    @staticmethod
    def fresh(name: str) -> str:
        """A new folder of a relation."""
        return f"data/{name}/batch={uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, seq: int | None = None, kind: str = "rows", month: str | None = None,
              sort: Sequence[str] = (), laid: bool = False, finish: Callable[[DataFrame], DataFrame] | None = None) -> Folder:
        """Write a folder of relation ``name`` (no snapshot names it yet); ``month``: the column to partition it by, ``sort``: the order in files.
        ``laid``: the rows of a month already lie in few partitions and are not dealt again; ``finish``: makes the rows to write
        from those dealt by month, so that narrower ones are dealt and sorted."""
        path = self.fresh(name)
        if month is not None and not laid:  # hex keys are dealt as bytes
            hashed = [c for c in HEX_KEYS if c in df.columns and finish is None]
            df = df.withColumns({c: packed_key(c) for c in hashed}).hint("rebalance", month).sortWithinPartitions(month, *sort)
            df = df.withColumns({c: unpacked_key(c) for c in hashed})
        if finish is not None:
            df = finish(df)
        if seq is not None:
            df = df.withColumn(SEQ, F.lit(seq))
        if month is None:
            df.write.options(**PARQUET).parquet(f"{self.root}/{path}")
            return Folder(path, kind, None, seq)
        df.write.options(**PARQUET).partitionBy(month).parquet(f"{self.root}/{path}")
        months = sorted(int(n.split("=")[1]) for n in self._names(path) if n.startswith(f"{month}="))
        return Folder(path, kind, tuple(months), seq)

    def read(self, snapshot: Snapshot, name: str, schema: StructType | str, key: str | None = None,
             months: Sequence[int] | None = None, month: str | None = None) -> DataFrame:
        """Rows of a relation: ``key``, if given, is the column its deletes go by; ``months``: only these (their folders alone
        are read)."""
        if isinstance(schema, str):
            schema = StructType.fromDDL(schema)
        folders = [f for f in snapshot.relations.get(name, ())
                   if months is None or f.months is None or set(f.months) & set(months)]

        def part(kind: str, columns: StructType) -> DataFrame | None:
            paths = [f.path for f in folders if f.kind == kind]
            if not paths:
                return None
            parents = sorted({p.split("/")[1] for p in paths})              # folders of another relation may hold rows of this one
            df = reduce(DataFrame.unionAll, [
                self.spark.read.schema(columns).option("basePath", f"{self.root}/data/{parent}").parquet(
                    *[f"{self.root}/{p}" for p in paths if p.split("/")[1] == parent]).select(*columns.names) for parent in parents])
            return df.where(F.col(month).isin(list(months))) if months is not None and month in columns.names else df

        full = StructType.fromDDL(f"{SEQ} int")
        rows = part("rows", StructType(schema.fields + full.fields) if key else schema)
        if rows is None:
            return self.spark.createDataFrame([], schema)
        if key is None:
            return rows
        gone = part("deletes", StructType([schema[key], *([schema[month]] if month else []), *full.fields]))
        if gone is not None:
            # keys are hashes: as bytes they meet in half the room
            last = gone.groupBy(packed_key(key).alias(_KEY_OF_DELETE)).agg(F.max(SEQ).alias(_SEQ_OF_DELETE))
            rows = rows.withColumn(key, packed_key(key))
            rows = rows.join(last, (rows[key] == last[_KEY_OF_DELETE]) & (rows[SEQ] < last[_SEQ_OF_DELETE]), "left_anti")
            rows = rows.withColumn(key, unpacked_key(key))
        return rows.drop(SEQ)

    def deleted(self, snapshot: Snapshot, name: str, key: str) -> DataFrame:
        """(key, at): the last delete of each key, by the number of its snapshot."""
        schema = StructType.fromDDL(f"`{key}` string, {SEQ} int")
        paths = [f"{self.root}/{f.path}" for f in snapshot.relations.get(name, ()) if f.kind == "deletes"]
        if not paths:
            return self.spark.createDataFrame([], "key string, at int")
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/data/{name}").parquet(*paths)
        return rows.groupBy(F.col(key).alias("key")).agg(F.max(SEQ).alias("at"))

    def holds(self, path: str) -> bool:
        return self._fs().exists(self._path(path))

    def bytes_of(self, folder: Folder) -> int:
        return self._fs().getContentSummary(self._path(folder.path)).getLength()

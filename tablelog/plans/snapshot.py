"""Snapshots: the state of a table at a version, rebuilt from its log.

A small log (its files hold at most DRIVER_BYTES) is replayed where it was read; a larger one as DataFrames, last action of a
path first. Both give the same state: last action wins, also within one commit.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.errors import ActionNotFound
from tablelog.functions import properties
from tablelog.plans.actions import ACTION_SCHEMA, Action, AddFile, Metadata, Protocol, RemoveFile, SetTransaction, check_readable, from_body, parse_line
from tablelog.plans.segment import Segment, version_of
from tablelog.sources.store import FileStatus, LogStore, canonical, decoded, is_absolute, local, relative_to

DRIVER_BYTES = 16 << 20
#: Files of an inventory: what scans and listings work on.
FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("partitionValues", T.MapType(T.StringType(), T.StringType())),
        T.StructField("size", T.LongType()),
        T.StructField("modificationTime", T.LongType()),
        T.StructField("stats", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)


def file_rows(spark: SparkSession, files: Iterable[AddFile]) -> DataFrame:
    """Files as rows of FILE_SCHEMA, handed over as Arrow: a local relation, no job to read it."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    target, files = to_arrow_schema(FILE_SCHEMA), list(files)
    values = [[a.path for a in files], [list((a.partitionValues or {}).items()) for a in files], [a.size for a in files], [a.modificationTime for a in files], [a.stats for a in files], [None if a.tags is None else list(a.tags.items()) for a in files]]
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(values, target, strict=True)], schema=target), FILE_SCHEMA)


def path_key(path: str, root: str) -> str:
    """One name for all spellings of a data file's path."""
    return relative_to(root, canonical(path)) if is_absolute(path) else path


def local_checkpoint(files: Iterable[FileStatus], store: LogStore | None = None) -> Iterator[Action]:
    """The actions of checkpoint files, read here without a job; store.open() or the local disk gives the bytes."""
    import pyarrow.parquet as pq

    for f in files:
        for r in pq.read_table(store.open(f.path) if hasattr(store, "open") else f.path).to_pylist():
            for key in ("metaData", "protocol", "txn", "add", "remove"):
                if r.get(key) is not None:
                    body = {k: _mapped(k, v) for k, v in r[key].items()}
                    yield from_body(key, body)


_MAPS = ("partitionValues", "tags", "configuration", "options")


def _mapped(name: str, value: object) -> object:
    """Arrow gives maps as lists of pairs."""
    if isinstance(value, dict):
        return {k: _mapped(k, v) for k, v in value.items()}
    return dict(value) if name in _MAPS and value is not None else value


class Replay:
    """State by replaying actions in order on the driver."""

    def __init__(self, root: str) -> None:
        self.root = root
        self.protocol: Protocol | None = None
        self.metadata: Metadata | None = None
        self.files: dict[str, AddFile] = {}
        self.removed: dict[str, RemoveFile] = {}
        self.transactions: dict[str, SetTransaction] = {}

    def add(self, action: Action | None) -> None:
        if isinstance(action, AddFile):
            key = path_key(action.path, self.root)
            self.files[key] = action.same(path=key, dataChange=False)
            self.removed.pop(key, None)
        elif isinstance(action, RemoveFile):
            key = path_key(action.path, self.root)
            self.files.pop(key, None)
            self.removed[key] = action
        elif isinstance(action, Metadata):
            self.metadata = action
        elif isinstance(action, Protocol):
            self.protocol = action
        elif isinstance(action, SetTransaction):
            self.transactions[action.appId] = action


class Snapshot:
    """A table at one version. Version -1 is a table that isn't there yet: no files, no metadata."""

    def __init__(self, spark: SparkSession, store: LogStore, root: str, segment: Segment, clock: Callable[[], int], before: Snapshot | None = None) -> None:
        self.spark, self.store, self.root, self.segment, self.clock = spark, store, root, segment, clock
        self.version, self.timestamp = segment.version, segment.timestamp
        self._before = before if before is not None and 0 <= before.version <= segment.version and before.version >= segment.checkpoint_version else None
        if self.version >= 0:
            check_readable(self.protocol)

    # -- reading the log

    @cached_property
    def small(self) -> bool:
        return sum(f.size for f in (*self.segment.checkpoint, *self.segment.commits)) <= DRIVER_BYTES

    def _commit_actions(self, commits: Iterable) -> Iterator[tuple[int, Action]]:
        for f in commits:
            for line in self.store.read(f.path):
                if (a := parse_line(line)) is not None:
                    yield version_of(f), a

    def _checkpoint(self) -> DataFrame:
        have = self.spark.read.parquet(*(f.path for f in self.segment.checkpoint))
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have.columns and f.name != "commitInfo" else F.lit(None).cast(f.dataType).alias(f.name) for f in _without_unread(have).fields]
        return have.select(*columns)

    @cached_property
    def replay(self) -> Replay:
        out = Replay(self.root)
        for a in self._checkpoint_actions():
            out.add(a)
        for _, a in self._commit_actions(self.segment.commits):
            out.add(a)
        return out

    def _checkpoint_actions(self) -> Iterator[Action]:
        """Of a small checkpoint (DRIVER_BYTES at most), in one read: no job if its files lie on a local disk."""
        if all(f.path.startswith("/") for f in self.segment.checkpoint):
            yield from local_checkpoint(self.segment.checkpoint)
            return
        for r in self._checkpoint().collect():
            for key in ("metaData", "protocol", "txn", "add", "remove"):
                if key in r and r[key] is not None:
                    yield from_body(key, r[key].asDict(recursive=True))

    @cached_property
    def actions(self) -> DataFrame:
        """All actions of the segment as rows, with _version and _position (the line's offset order within a file)."""
        parts = []
        if self.segment.checkpoint:
            parts.append(self._checkpoint().select(*_read_columns(), F.lit(self.segment.checkpoint_version).cast("long").alias("_version"), F.lit(0).cast("long").alias("_position")))
        if self.segment.commits:
            lines = self.spark.read.schema(ACTION_SCHEMA).json([f.path for f in self.segment.commits])
            version = F.substring(F.col("_metadata.file_name"), 1, 20).cast("long")
            # a file's lines stay in order within a split; splits of a file follow its blocks
            place = F.col("_metadata.file_block_start") * F.lit(1 << 20) + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33))
            parts.append(lines.select(*_read_columns(), version.alias("_version"), place.alias("_position")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    # -- state

    @cached_property
    def _told(self) -> tuple[Protocol | None, Metadata | None]:
        """Newest first, stopping when both are known; what an older snapshot knows is reused."""
        protocol = metadata = None
        seen = self._before.version if self._before else -1
        for f in reversed(self.segment.commits):
            if self._before and version_of(f) <= seen:
                break
            for line in reversed(self.store.read(f.path)):
                if '"protocol"' in line or '"metaData"' in line:
                    a = parse_line(line)
                    protocol = protocol or (a if isinstance(a, Protocol) else None)
                    metadata = metadata or (a if isinstance(a, Metadata) else None)
            if protocol and metadata:
                return protocol, metadata
        if self._before:
            return protocol or self._before.protocol, metadata or self._before.metadata
        if self.segment.checkpoint and self.small:
            return protocol or self.replay.protocol, metadata or self.replay.metadata
        if self.segment.checkpoint:
            rows = self._checkpoint().select("protocol", "metaData").where("protocol is not null or metaData is not null").collect()
            for r in rows:
                protocol = protocol or (from_body("protocol", r.protocol.asDict()) if r.protocol else None)
                metadata = metadata or (from_body("metaData", r.metaData.asDict(recursive=True)) if r.metaData else None)
        return protocol, metadata

    @property
    def protocol(self) -> Protocol:
        if self.version < 0:
            return Protocol()
        if self._told[0] is None:
            raise ActionNotFound(f"no protocol in version {self.version}")
        return self._told[0]

    @property
    def metadata(self) -> Metadata:
        if self.version < 0:
            return Metadata()
        if self._told[1] is None:
            raise ActionNotFound(f"no metadata in version {self.version}")
        return self._told[1]

    @property
    def schema(self) -> T.StructType:
        return self.metadata.schema

    @cached_property
    def inventory(self) -> DataFrame:
        """The active files as rows of FILE_SCHEMA."""
        if self.version < 0:
            return self.spark.createDataFrame([], FILE_SCHEMA)
        if self.small:
            return file_rows(self.spark, self.replay.files.values())
        return self._latest().where("add is not null").select("path", *(f"add.{c}" for c in FILE_SCHEMA.fieldNames()[1:]))

    def _latest(self) -> DataFrame:
        """The last add or remove of each path: aggregated before the shuffle, no sort of a path's history."""
        rows = self.actions.where("add is not null or remove is not null").select(_key_column(F.coalesce("add.path", "remove.path"), self.root).alias("path"), "add", "remove", F.struct("_version", "_position").alias("_at"))
        last = rows.groupBy("path").agg(F.max_by(F.struct("add", "remove"), "_at").alias("last"))
        return last.select("path", "last.add", "last.remove")

    def files(self) -> list[AddFile]:
        """The active files. For tables with very many of them use inventory."""
        if self.version < 0:
            return []
        if self.small:
            return list(self.replay.files.values())
        return [AddFile(r.path, r.partitionValues or {}, r["size"], r.modificationTime, False, r.stats, r.tags) for r in self.inventory.toLocalIterator()]

    def removed(self) -> DataFrame:
        """Tombstones that are kept: deleted after now less the retention of deleted files."""
        since = self.clock() - properties.value(self.metadata.configuration, "delta.deletedFileRetentionDuration")
        schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("deletionTimestamp", T.LongType())])
        if self.version < 0:
            return self.spark.createDataFrame([], schema)
        if self.small:
            return self.spark.createDataFrame([(k, r.deleted_at) for k, r in self.replay.removed.items() if r.deleted_at > since], schema)
        return self._latest().where("remove is not null").select("path", F.coalesce("remove.deletionTimestamp", F.lit(0)).alias("deletionTimestamp")).where(F.col("deletionTimestamp") > since)

    def removed_actions(self) -> list[RemoveFile]:
        since = self.clock() - properties.value(self.metadata.configuration, "delta.deletedFileRetentionDuration")
        return [r for r in self.replay.removed.values() if r.deleted_at > since]

    @cached_property
    def transactions(self) -> dict[str, int]:
        """appId -> latest version."""
        if self.version < 0:
            return {}
        if self.small:
            return {k: t.version for k, t in self.replay.transactions.items()}
        return {r.appId: r.version for r in self.actions.where("txn is not null").groupBy("txn.appId").agg(F.max_by("txn.version", F.struct("_version", "_position")).alias("version")).collect()}

    def facts(self) -> DataFrame:
        """One row: size_in_bytes, num_files, num_removes, num_transactions."""
        removed = self.removed().agg(F.count("*").alias("num_removes"))
        return self.inventory.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size_in_bytes"), F.count("*").alias("num_files")).crossJoin(F.broadcast(removed)).withColumn("num_transactions", F.lit(len(self.transactions)).cast("long"))  # two single rows

    def data_path(self, path: str) -> str:
        """Where a logged file lies: decoded once, below the root unless absolute."""
        return local(decoded(path)) if path.startswith("file:") else decoded(path) if is_absolute(path) else f"{self.root}/{decoded(path)}"


def _without_unread(have: DataFrame) -> T.StructType:
    """The action columns that a checkpoint has, each with the fields of ours that it has."""
    out = []
    for f in ACTION_SCHEMA.fields:
        if f.name in have.columns and f.name != "commitInfo":
            there = have.schema[f.name].dataType
            out.append(T.StructField(f.name, there))
    return T.StructType(out)


def _read_columns() -> list:
    return [F.col(k) for k in ("add", "remove", "metaData", "txn", "protocol")]


def _key_column(path, root: str):
    base = canonical(root.rstrip("/")) + "/"
    one = F.when(path.rlike("^file:"), F.concat(F.lit("file:/"), F.regexp_replace(path, "^file:/*", ""))).when(path.startswith("/"), F.concat(F.lit("file:"), path)).otherwise(path)
    return F.when(one.startswith(base), F.substring(one, len(base) + 1, 1 << 30)).otherwise(one)


def now_ms() -> int:
    return int(time.time() * 1000)


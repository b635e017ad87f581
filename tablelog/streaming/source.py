"""Streaming source: a snapshot first, then what each version adds; or changes only.

Offsets are {"version", "index", "initial"}: initial offsets point into the list of a snapshot's files, later ones name the last
version that was read. Spark's offset log is the only state. Files are read where the tasks run, as Arrow batches.

maxFilesPerTrigger bounds a batch of the snapshot, maxVersionsPerTrigger one of changes, the first batch as well; 0 is no bound.
Spark doesn't tell a Python source where a run starts when it asks how far its first batch shall go, so a bound needs
progressLocation, the folder of the query's checkpoint. A run by availableNow asks such a source once, so it takes one
batch; drain() of the sink runs again until nothing is left.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tablelog.errors import DataLoss, StoreError, StreamError
from tablelog.functions.options import source_options
from tablelog.plans import segment
from tablelog.plans.actions import Action, AddFile, Metadata, Protocol, RemoveFile, parse_line
from tablelog.plans.snapshot import Replay, local_checkpoint, path_key
from tablelog.shipping import ship
from tablelog.sources.scan import decode
from tablelog.sources.store import FileStatus, LocalStore, LogStore, decoded, is_absolute, lines_of, local

NAME = "tablelog"
#: Bytes of a file that one task reads; a larger file is dealt out by row groups.
PART_BYTES = 128 << 20


class FilePart(InputPartition):
    """A data file or a share of its row groups: its place, the values of its partition, which of how many shares."""

    def __init__(self, path: str, values: dict[str, str | None], share: int = 0, shares: int = 1) -> None:
        self.path, self.values, self.share, self.shares = path, values, share, shares


def parts_of(log: _Log, added: Iterable[AddFile]) -> list[FilePart]:
    """One part a file, or several of a large one."""
    out = []
    for a in added:
        shares = max(1, -(-a.size // PART_BYTES))
        out += [FilePart(log.place(path_key(a.path, log.root)), a.partitionValues, k, shares) for k in range(shares)]
    return out


def added_files(actions: list[Action], ignore_changes: bool, ignore_deletes: bool, pinned: T.StructType | None = None, strict: bool = False, partition_columns: tuple[str, ...] = (), version: int = -1) -> list[AddFile]:
    """What a version brings a stream: its added files with new data.

    Removed data is an error: with added files unless changes are ignored, alone unless deletes are (ignoring changes ignores
    deletes too). A protocol or metadata action is an error if strict; otherwise only one that changes the schema or the
    partitioning that the stream was started with.
    """
    added = [a for a in actions if isinstance(a, AddFile) and a.dataChange]
    removed = [a for a in actions if isinstance(a, RemoveFile) and a.dataChange]
    for a in actions:
        if isinstance(a, (Metadata, Protocol)):
            if strict:
                raise StreamError(f"version {version} has an action that a stream can't carry: {a.key}")
            if isinstance(a, Metadata) and pinned is not None and (a.schema != pinned or tuple(a.partitionColumns) != tuple(partition_columns)):
                raise StreamError(f"version {version} changes the table's schema or partitioning; start the stream anew")
    if removed and added and not ignore_changes:
        raise StreamError(f"version {version} changes data; option ignoreChanges would pass over what it removes")
    if removed and not added and not (ignore_deletes or ignore_changes):
        raise StreamError(f"version {version} removes data; option ignoreDeletes would pass over it")
    return added


class _Log:
    """A table's log without a Spark session: what the source's Python process needs."""

    def __init__(self, path: str) -> None:
        self.root = local(path.rstrip("/"))
        self.log, self.store = f"{self.root}/_delta_log", _store(path)

    def latest(self) -> int:
        return segment.build(self.store, self.log).version

    def replay(self, version: int | None = None) -> tuple[int, Replay]:
        s = segment.build(self.store, self.log, version)
        out = Replay(self.root)
        for a in local_checkpoint(s.checkpoint, self.store):
            out.add(a)
        for f in s.commits:
            for line in self.store.read(f.path):
                out.add(parse_line(line))
        return s.version, out

    def actions(self, version: int) -> list[Action]:
        return [a for line in self.store.read(f"{self.log}/{segment.commit_name(version)}") if (a := parse_line(line)) is not None]

    def place(self, path: str) -> str:
        if path.startswith("file:"):
            return local(decoded(path))
        return decoded(path) if is_absolute(path) else f"{self.root}/{decoded(path)}"

    def version_from(self, ms: int) -> int:
        return segment.from_timestamp(segment.commits_from(self.store, self.log), ms)

    def version_at(self, ms: int) -> int:
        return segment.at_timestamp(segment.commits_from(self.store, self.log), ms)


class ArrowStore(LogStore):
    """Reads a log where there is no JVM: any file system that Arrow has (s3, gs, hdfs), by URI. It can't write."""

    def __init__(self, uri: str) -> None:
        from pyarrow import fs

        self.fs, at = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
        self.base = uri.split("://", 1)[0] + "://"
        self.offset = at  # the root without its scheme, as this file system names it

    def plain(self, path: str) -> str:
        return path.split("://", 1)[1] if "://" in path else path

    def list_from(self, path: str) -> list[FileStatus]:
        from pyarrow import fs

        folder, first = path.rsplit("/", 1)
        found = self.fs.get_file_info(fs.FileSelector(self.plain(folder)))
        named = [(f, f.path.rsplit("/", 1)[1]) for f in found if f.type == fs.FileType.File]
        return sorted(FileStatus(f"{folder}/{n}", f.size, f.mtime_ns // 1_000_000) for f, n in named if n >= first)

    def open(self, path: str):
        return self.fs.open_input_file(self.plain(path))

    def read(self, path: str) -> list[str]:
        with self.fs.open_input_stream(self.plain(path)) as f:
            return lines_of(f.read().decode())

    def exists(self, path: str) -> bool:
        from pyarrow import fs

        return self.fs.get_file_info(self.plain(path)).type != fs.FileType.NotFound

    def _refuse(self, *_: object, **__: object):
        raise StoreError("the source's process only reads")

    write = delete = rename = make_folder = walk = _refuse


def _store(path: str) -> LogStore:
    if path.startswith("/") or path.startswith("file:"):
        return LocalStore()
    try:
        return ArrowStore(path)
    except Exception as e:
        raise StreamError(f"the Python source reads local and mounted paths and what Arrow's file systems reach, not {path} ({e}); use Table and foreachBatch there") from e


def read_part(part: FilePart, schema: T.StructType, partition_columns: tuple[str, ...]) -> Iterator:
    """A file's Arrow batches under a schema: columns it lacks are null, partition columns come from the log."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)
    f = pq.ParquetFile(part.path if part.path.startswith("/") else _store(part.path).open(part.path))
    there = {n: n for n in f.schema_arrow.names}
    groups = [g for g in range(f.num_row_groups) if g % part.shares == part.share]
    wanted = [n for n in target.names if n in there and n not in partition_columns]
    if not wanted:  # partition columns alone: the footer has the number of rows
        batches = (_blank(n) for g in groups for n in _pieces(f.metadata.row_group(g).num_rows))
    else:
        batches = f.iter_batches(row_groups=groups, columns=wanted)
    for batch in batches:
        columns = []
        for field, kind in zip(target, schema.fields, strict=True):
            if field.name in partition_columns:
                raw = part.values.get(field.name)
                value = None if raw is None else decode(raw, kind.dataType)
                columns.append(pa.array([value] * batch.num_rows, field.type))
            elif field.name in batch.schema.names:
                columns.append(batch.column(field.name).cast(field.type))
            else:
                columns.append(pa.nulls(batch.num_rows, field.type))
        yield pa.RecordBatch.from_arrays(columns, schema=target)


def _pieces(rows: int, most: int = 1 << 16) -> Iterator[int]:
    while rows > 0:
        yield min(rows, most)
        rows -= most


def _blank(rows: int):
    """A batch of so many rows without a column to speak of."""
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.nulls(rows)], names=["\0"])


class TableStreamReader(DataSourceStreamReader):
    def __init__(self, path: str, schema: T.StructType, partition_columns: tuple[str, ...], options: dict) -> None:
        self.path, self.schema, self.partition_columns, self.options = path, schema, partition_columns, options

    def initialOffset(self) -> dict:
        """The same answer however often it is asked: Spark asks for the first batch's end before its start."""
        if getattr(self, "_initial", None) is None:
            log, o = _Log(self.path), self.options
            if "startingVersion" in o:
                v = log.latest() if o["startingVersion"] == "latest" else o["startingVersion"]
                self._initial = {"version": v - 1, "index": 0, "initial": False}
            elif "startingTimestamp" in o:
                self._initial = {"version": log.version_from(o["startingTimestamp"]) - 1, "index": 0, "initial": False}
            else:
                self._initial = {"version": log.latest(), "index": 0, "initial": True}
        return self._initial

    def _known_start(self) -> dict | None:
        """Where the next batch begins: the end of this run's last one, or of the last one in the query's checkpoint, or the
        start of all. None (no bounds then) before a run's first batch if progressLocation doesn't name the checkpoint."""
        if getattr(self, "_start", None) is None and (at := self.options.get("progressLocation")):
            self._start = last_offset(at) or self.initialOffset()
        return getattr(self, "_start", None)

    def latestOffset(self) -> dict:
        """The end of the next batch: so many files of the snapshot at most, then so many versions."""
        o, start = self.options, self._known_start()
        if start is not None and start["initial"]:
            most = o["maxFilesPerTrigger"]
            if most and start["index"] + most < len(self._snapshot_files(start["version"])):
                return start | {"index": start["index"] + most}
            return {"version": start["version"], "index": 0, "initial": False}
        latest = self._latest()
        most = o["maxVersionsPerTrigger"]
        if start is None:
            return {"version": latest, "index": 0, "initial": False}
        return {"version": max(start["version"], min(latest, start["version"] + most) if most else latest), "index": 0, "initial": False}

    def _latest(self) -> int:
        """The latest version; the log is listed again updateCheckIntervalMillis after the last time, the second time after
        updateCheckDelayMillis."""
        now = time.monotonic()
        if getattr(self, "_listed", None) is None or now >= self._again:
            first = getattr(self, "_listed", None) is None
            self._listed = _Log(self.path).latest()
            self._again = time.monotonic() + self.options["updateCheckDelayMillis" if first else "updateCheckIntervalMillis"] / 1000
        return self._listed

    def _snapshot_files(self, version: int) -> list[AddFile]:
        """The snapshot's files in the order that index counts."""
        if getattr(self, "_listing", (None,))[0] != version:
            _, state = _Log(self.path).replay(version)
            self._listing = (version, sorted(state.files.values(), key=lambda a: a.path))
        return self._listing[1]

    def partitions(self, start: dict, end: dict) -> list[FilePart]:
        log, o = _Log(self.path), self.options
        out = []
        if start["initial"]:
            files = self._snapshot_files(start["version"])
            out += parts_of(log, files[start["index"] : end["index"] if end["initial"] else None])
        if not end["initial"]:
            for v in range(start["version"] + 1, end["version"] + 1):
                try:
                    actions = log.actions(v)
                except FileNotFoundError:
                    raise DataLoss(f"version {v} is gone from the log") from None
                out += parts_of(log, added_files(actions, o["ignoreChanges"], o["ignoreDeletes"], None if v == 0 else self._whole(log), o.get("strictActions", False), self.partition_columns, v))
        self._start = end
        return out

    def _whole(self, log: _Log) -> T.StructType:
        """The schema that the stream was started with, whatever columns it selects."""
        return T.StructType.fromJson(json.loads(self.options["_pinned"]))

    def read(self, partition: FilePart) -> Iterator:
        return read_part(partition, self.schema, self.partition_columns)

    def commit(self, end: dict) -> None:
        pass


class TableBatchReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, partition_columns: tuple[str, ...], version: int) -> None:
        self.path, self.schema, self.partition_columns, self.version = path, schema, partition_columns, version
        self.tests: list = []

    def pushFilters(self, filters: list) -> Iterator:
        """Comparisons on partition columns pick files; Spark applies all filters to the rows as well."""
        from pyspark.sql import datasource as D

        for f in filters:
            if isinstance(f, (D.EqualTo, D.In, D.GreaterThan, D.GreaterThanOrEqual, D.LessThan, D.LessThanOrEqual, D.IsNull, D.IsNotNull)) and len(f.attribute) == 1 and f.attribute[0] in self.partition_columns:
                self.tests.append(f)
            yield f

    def _keeps(self, values: dict[str, str | None]) -> bool:
        from pyspark.sql import datasource as D

        for f in self.tests:
            raw = values.get(f.attribute[0])
            v = None if raw is None else decode(raw, self.schema[f.attribute[0]].dataType)
            if isinstance(f, D.IsNull):
                ok = v is None
            elif v is None:
                ok = False
            elif isinstance(f, D.IsNotNull):
                ok = True
            elif isinstance(f, D.In):
                ok = v in f.value
            else:
                ok = {D.EqualTo: v == f.value, D.GreaterThan: v > f.value, D.GreaterThanOrEqual: v >= f.value, D.LessThan: v < f.value, D.LessThanOrEqual: v <= f.value}[type(f)]
            if not ok:
                return False
        return True

    def partitions(self) -> list[FilePart]:
        log = _Log(self.path)
        _, state = log.replay(self.version)
        return parts_of(log, (a for a in state.files.values() if self._keeps(a.partitionValues)))

    def read(self, partition: FilePart) -> Iterator:
        return read_part(partition, self.schema, self.partition_columns)


class TableSource(DataSource):
    """spark.read and spark.readStream .format("tablelog"), after register(spark). The schema is that of the version which is
    resolved when the source is made."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def _told(self, streaming: bool) -> tuple[str, int, Metadata, dict]:
        given = dict(self.options)
        path = next((v for k, v in given.items() if k.lower() == "path"), None)
        if path is None:
            raise StreamError("a path is needed")
        o = source_options(given, streaming)
        log = _Log(path)
        at = o.get("versionAsOf")
        if "timestampAsOf" in o:
            at = log.version_at(o["timestampAsOf"])
        version, state = log.replay(at)
        if version < 0 or state.metadata is None:
            raise StreamError(f"no table at {path}")
        return path, version, state.metadata, o

    def _streams(self) -> bool:
        names = {k.lower() for k in self.options}
        return bool(names & {n.lower() for n in ("startingVersion", "startingTimestamp", "ignoreDeletes", "ignoreChanges", "maxVersionsPerTrigger", "maxFilesPerTrigger", "progressLocation", "updateCheckIntervalMillis", "updateCheckDelayMillis", "strictActions")})

    def schema(self) -> T.StructType:
        _, _, meta, o = self._told(self._streams())
        return _selected(meta.schema, o.get("columns"))

    def reader(self, schema: T.StructType) -> TableBatchReader:
        path, version, meta, _ = self._told(False)
        return TableBatchReader(path, schema, meta.partitionColumns, version)

    def streamReader(self, schema: T.StructType) -> TableStreamReader:
        path, _, meta, o = self._told(True)
        return TableStreamReader(path, schema, meta.partitionColumns, o | {"_pinned": meta.schemaString})


def _selected(schema: T.StructType, columns: list[str] | None) -> T.StructType:
    unknown = [c for c in columns or () if c not in schema.fieldNames()]
    if unknown:
        raise StreamError(f"no columns {unknown} in {schema.fieldNames()}")
    out = T.StructType([schema[c] for c in columns]) if columns else schema
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in out.fields])


def last_offset(checkpoint: str) -> dict | None:
    """The end of the last batch that a query planned, by the offset log in its checkpoint folder; None if it has none."""
    store, folder = _store(checkpoint), f"{local(checkpoint.rstrip('/'))}/offsets"
    try:
        found = [f for f in store.list_from(f"{folder}/") if f.name.isdigit()]
    except FileNotFoundError:
        return None
    for line in reversed(store.read(max(found, key=lambda f: int(f.name)).path) if found else []):
        try:
            o = json.loads(line)
        except ValueError:
            continue
        if isinstance(o, dict) and set(o) == {"version", "index", "initial"}:
            return o
    return None


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TableSource)


def read_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """A stream of a table's rows. All option problems are told at once."""
    source_options(options, True)
    register(spark)
    reader = spark.readStream.format(NAME)
    for k, v in options.items():
        reader = reader.option(k, ",".join(v) if isinstance(v, list) else str(v))
    return reader.load(path)

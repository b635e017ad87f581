"""The actions of a log, as small records, as JSON lines and as a Spark schema."""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import dataclass, field, fields, replace
from functools import cached_property
from typing import Any, ClassVar

from pyspark.sql import types as T

from tablelog.errors import ProtocolError

READER_VERSION, WRITER_VERSION = 1, 2
_S, _L, _B, _I = T.StringType(), T.LongType(), T.BooleanType(), T.IntegerType()
_MAP = T.MapType(_S, _S)


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


#: One row a log line; exactly one of the structs is set.
ACTION_SCHEMA = _struct(
    add=_struct(path=_S, partitionValues=_MAP, size=_L, modificationTime=_L, dataChange=_B, stats=_S, tags=_MAP),
    remove=_struct(path=_S, deletionTimestamp=_L, dataChange=_B, extendedFileMetadata=_B, partitionValues=_MAP, size=_L, tags=_MAP),
    metaData=_struct(id=_S, name=_S, description=_S, format=_struct(provider=_S, options=_MAP), schemaString=_S, partitionColumns=T.ArrayType(_S), configuration=_MAP, createdTime=_L),
    txn=_struct(appId=_S, version=_L, lastUpdated=_L),
    protocol=_struct(minReaderVersion=_I, minWriterVersion=_I),
    cdc=_struct(path=_S, partitionValues=_MAP, size=_L, tags=_MAP),
    commitInfo=_S,
)
#: Which wins if a line sets several.
PRECEDENCE = ("add", "remove", "metaData", "txn", "protocol", "cdc", "commitInfo")


@dataclass(frozen=True)
class Action:
    key: ClassVar[str] = ""

    def body(self) -> dict[str, Any]:
        out = {f.name: getattr(self, f.name) for f in fields(self)}
        return {k: v for k, v in out.items() if v is not None or k == "partitionValues"}

    def json(self) -> str:
        return json.dumps({self.key: self.body()}, separators=(",", ":"), ensure_ascii=False)


@dataclass(frozen=True)
class Protocol(Action):
    key: ClassVar[str] = "protocol"
    minReaderVersion: int = READER_VERSION
    minWriterVersion: int = WRITER_VERSION


@dataclass(frozen=True)
class Metadata(Action):
    key: ClassVar[str] = "metaData"
    id: str = field(default_factory=lambda: str(uuid.uuid4()))
    name: str | None = None
    description: str | None = None
    format: dict = field(default_factory=lambda: {"provider": "parquet", "options": {}})
    schemaString: str | None = None
    partitionColumns: tuple[str, ...] = ()
    configuration: dict[str, str] = field(default_factory=dict)
    createdTime: int | None = field(default_factory=lambda: int(time.time() * 1000))

    def body(self) -> dict[str, Any]:
        return super().body() | {"partitionColumns": list(self.partitionColumns)}

    @classmethod
    def of(cls, schema: T.StructType, partition_columns: tuple[str, ...] | list[str] = (), **more: Any) -> Metadata:
        return cls(schemaString=schema.json(), partitionColumns=tuple(partition_columns), **more)

    @cached_property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schemaString)) if self.schemaString else T.StructType([])

    @property
    def partition_schema(self) -> T.StructType:
        return T.StructType([self.schema[c] for c in self.partitionColumns])

    @property
    def data_schema(self) -> T.StructType:
        return T.StructType([f for f in self.schema.fields if f.name not in self.partitionColumns])


@dataclass(frozen=True)
class AddFile(Action):
    key: ClassVar[str] = "add"
    path: str = ""
    partitionValues: dict[str, str | None] = field(default_factory=dict)
    size: int = 0
    modificationTime: int = 0
    dataChange: bool = True
    stats: str | None = None
    tags: dict[str, str] | None = None

    def remove(self, at: int | None = None, data_change: bool = True) -> RemoveFile:
        return RemoveFile(self.path, int(time.time() * 1000) if at is None else at, data_change, True, self.partitionValues, self.size, self.tags)

    def same(self, **changes: Any) -> AddFile:
        return replace(self, **changes)


@dataclass(frozen=True)
class RemoveFile(Action):
    key: ClassVar[str] = "remove"
    path: str = ""
    deletionTimestamp: int | None = None
    dataChange: bool = True
    extendedFileMetadata: bool = False
    partitionValues: dict[str, str | None] | None = None
    size: int | None = None
    tags: dict[str, str] | None = None

    @property
    def deleted_at(self) -> int:
        return self.deletionTimestamp or 0


@dataclass(frozen=True)
class AddCDCFile(Action):
    key: ClassVar[str] = "cdc"
    path: str = ""
    partitionValues: dict[str, str | None] = field(default_factory=dict)
    size: int = 0
    tags: dict[str, str] | None = None
    dataChange: ClassVar[bool] = False


@dataclass(frozen=True)
class SetTransaction(Action):
    key: ClassVar[str] = "txn"
    appId: str = ""
    version: int = 0
    lastUpdated: int | None = None


@dataclass(frozen=True)
class CommitInfo(Action):
    key: ClassVar[str] = "commitInfo"
    version: int | None = None
    timestamp: int | None = None
    userId: str | None = None
    userName: str | None = None
    operation: str | None = None
    operationParameters: dict[str, Any] | None = None
    job: dict | None = None
    notebook: dict | None = None
    clusterId: str | None = None
    readVersion: int | None = None
    isolationLevel: str | None = None
    isBlindAppend: bool | None = None
    operationMetrics: dict[str, str] | None = None
    userMetadata: str | None = None
    engineInfo: str | None = None


KINDS: dict[str, type[Action]] = {c.key: c for c in (AddFile, RemoveFile, Metadata, SetTransaction, Protocol, AddCDCFile, CommitInfo)}


def from_body(key: str, body: dict[str, Any]) -> Action:
    """A record of known fields; unknown ones are ignored. stats may be a string or an object."""
    kind = KINDS[key]
    known = {f.name for f in fields(kind)}
    values = {k: v for k, v in body.items() if k in known and v is not None}
    if "stats" in values and not isinstance(values["stats"], str):
        values["stats"] = json.dumps(values["stats"], separators=(",", ":"))
    if "partitionColumns" in values:
        values["partitionColumns"] = tuple(values["partitionColumns"])
    if key == "metaData":
        values.setdefault("createdTime", None)
        values.setdefault("id", "")
        values = {k: v for k, v in values.items() if k != "createdTime" or v is not None} | ({} if values.get("createdTime") is not None else {"createdTime": None})
    return kind(**values)


def parse_line(line: str) -> Action | None:
    """The action of a log line; None if it holds none that is known."""
    if not line.strip():
        return None
    value = json.loads(line)
    for key in PRECEDENCE:
        if value.get(key) is not None:
            return from_body(key, value[key])
    return None


def check_readable(p: Protocol) -> None:
    if p.minReaderVersion > READER_VERSION:
        raise ProtocolError(f"the table needs readers of version {p.minReaderVersion}; this one is {READER_VERSION}")


def check_writable(p: Protocol) -> None:
    if p.minWriterVersion > WRITER_VERSION:
        raise ProtocolError(f"the table needs writers of version {p.minWriterVersion}; this one is {WRITER_VERSION}")


def check_properties_against(metadata: Metadata) -> None:
    """Protocol versions are set by the protocol action, never by properties."""
    for k in metadata.configuration:
        if re.fullmatch(r"delta\.min(Reader|Writer)Version", k):
            raise AssertionError(f"{k} is not a table property")

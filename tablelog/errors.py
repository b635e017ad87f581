"""The error surface."""


class TableError(Exception):
    """Base of all errors of this package."""


class LogError(TableError):
    """The log can't be read: gaps, missing parts, missing actions."""


class VersionsNotContiguous(LogError): ...


class ActionNotFound(LogError): ...


class EmptyDirectory(LogError): ...


class LogFileNotFound(LogError): ...


class MissingPartFiles(LogError): ...


class NoHistory(LogError): ...


class NoReproducibleHistory(LogError): ...


class DataLoss(LogError): ...


class TimeTravelError(TableError): ...


class VersionNotFound(TimeTravelError):
    def __init__(self, version: int, earliest: int, latest: int) -> None:
        super().__init__(f"version {version} can't be read; the versions that can are [{earliest}, {latest}]")
        self.version, self.earliest, self.latest = version, earliest, latest


class TimestampTooEarly(TimeTravelError): ...


class TimestampTooLate(TimeTravelError): ...


class NullInPrimitive(TableError): ...


class NullInRequiredField(TableError): ...


class FieldTypeMismatch(TableError): ...


class SchemaError(TableError): ...


class MetadataAbsent(TableError): ...


class PartitioningMismatch(TableError): ...


class AppendOnlyViolation(TableError): ...


class InvalidColumnName(SchemaError): ...


class NestedNotNull(SchemaError): ...


class SchemaChanged(SchemaError): ...


class PartitionColumnsNotFound(SchemaError): ...


class NoDataColumn(SchemaError): ...


class UnknownProperty(TableError): ...


class ReservedProperty(TableError): ...


class ProtocolError(TableError): ...


class CheckpointError(TableError): ...


class StoreError(TableError): ...


class StoreConfigConflict(StoreError): ...


class AlreadyExists(StoreError, FileExistsError): ...


class IllegalExpression(TableError, ValueError): ...


class ConcurrentModification(TableError): ...


class ProtocolChanged(ConcurrentModification): ...


class MetadataChanged(ConcurrentModification): ...


class ConcurrentAppend(ConcurrentModification): ...


class ConcurrentDeleteRead(ConcurrentModification): ...


class ConcurrentDeleteDelete(ConcurrentModification): ...


class ConcurrentTransaction(ConcurrentModification): ...


class CommitRetriesExceeded(TableError): ...


class OptionError(TableError, ValueError):
    """All option problems at once."""

    def __init__(self, problems: list[str]) -> None:
        super().__init__("; ".join(problems))
        self.problems = problems


class StreamError(TableError): ...


class CatalogError(TableError): ...


class ReadOnlyTable(TableError): ...

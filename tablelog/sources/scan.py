"""Scans: pruned inventories turned into Parquet reads."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.errors import FieldTypeMismatch, NullInPrimitive, NullInRequiredField, PartitioningMismatch, SchemaError
from tablelog.plans import expr
from tablelog.plans.actions import AddFile
from tablelog.plans.snapshot import Snapshot, file_rows

#: Bytes of an inventory (its paths and values) that one broadcast may hold; a larger one goes in several, each to its own files.
BROADCAST_BYTES = 32 << 20
#: Types that statistics rule files out by.
SKIPPABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType, T.DateType, T.TimestampType)


def partition_column(name: str, kind: T.DataType) -> Column:
    """A partition value of an inventory row in its own type."""
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        raise FieldTypeMismatch(f"partition column {name} can't be of type {kind.simpleString()}")
    raw = F.col("partitionValues")[name]
    if isinstance(kind, T.BinaryType):
        return raw.cast("binary")
    if isinstance(kind, T.StringType):
        return raw
    return F.when(raw != "", raw).cast(kind)


class PartitionRecord:
    """Typed access to the values of one file's partition."""

    def __init__(self, values: dict[str, str | None], schema: T.StructType) -> None:
        if set(values) != set(schema.fieldNames()):
            raise PartitioningMismatch(f"partition values {sorted(values)} are not those of {schema.fieldNames()}")
        self.values, self.schema = values, schema

    def is_null(self, name: str) -> bool:
        return self.values[self.schema[name].name] is None

    def get(self, name: str, kind: type[T.DataType] | None = None):
        f = self.schema[name]
        if kind is not None and not isinstance(f.dataType, kind):
            raise FieldTypeMismatch(f"{name} is {f.dataType.simpleString()}, not {kind.typeName()}")
        raw = self.values[name]
        if raw is None:
            if not f.nullable:
                raise NullInRequiredField(f"null in required partition column {name}")
            if kind is not None and isinstance(f.dataType, (T.NumericType, T.BooleanType)) and not isinstance(f.dataType, T.DecimalType):
                raise NullInPrimitive(f"null in partition column {name} of type {f.dataType.simpleString()}")
            return None
        return decode(raw, f.dataType)

    def __getitem__(self, name: str):
        f = next(x for x in self.schema.fields if x.name.lower() == name.lower())
        raw = self.values[f.name]
        return None if raw is None else decode(raw, f.dataType)


def decode(raw: str, kind: T.DataType):
    if isinstance(kind, T.StringType):
        return raw
    if isinstance(kind, T.BooleanType):
        return raw.lower() == "true"
    if isinstance(kind, T.IntegralType):
        return int(raw)
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return float(raw)
    if isinstance(kind, T.DecimalType):
        return Decimal(raw)
    if isinstance(kind, T.BinaryType):
        return raw.encode()
    if isinstance(kind, T.DateType):
        return dt.date.fromisoformat(raw)
    if isinstance(kind, T.TimestampType):
        return dt.datetime.fromisoformat(raw)
    raise FieldTypeMismatch(f"no partition values of type {kind.simpleString()}")


def row_value(row, schema: T.StructType, name: str, kind: type[T.DataType]):
    """A row's field by type: a wrong type, or a null in a primitive or required field, is an error."""
    f = schema[name]
    if not isinstance(f.dataType, kind):
        raise FieldTypeMismatch(f"{name} is {f.dataType.simpleString()}, not {kind.typeName()}")
    value = row[name]
    if value is None:
        if not f.nullable:
            raise NullInRequiredField(f"null in required column {name}")
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and not isinstance(f.dataType, T.DecimalType):
            raise NullInPrimitive(f"null in column {name} of type {f.dataType.simpleString()}")
    return value


class Scan:
    """A snapshot's files under a predicate. pushed prunes; residual is for the reader of the rows (rows() applies both)."""

    def __init__(self, snapshot: Snapshot, predicate: expr.Expression | None = None, partition_filter: Callable[[Callable[[str], Column]], Column] | None = None, stats_filter: Callable[[Column, Column], Column] | None = None, skip: bool = True) -> None:
        self.snapshot, self.predicate = snapshot, predicate
        self.pushed, self.residual = expr.split(predicate, snapshot.metadata.partitionColumns)
        self.partition_filter, self.stats_filter, self.skip = partition_filter, stats_filter, skip

    def _named(self, name: str) -> T.StructField:
        found = [f for f in self.snapshot.schema.fields if f.name.lower() == name.lower()]
        if not found:
            raise SchemaError(f"no column {name} in {self.snapshot.schema.fieldNames()}")
        return found[0]

    def _partition(self, name: str) -> Column:
        f = self._named(name)
        return partition_column(f.name, f.dataType)

    @cached_property
    def matching(self) -> DataFrame:
        """The inventory under the pushed part: each distinct partition is looked at once, then files are picked. Files that the
        driver holds anyway are picked there."""
        columns = self.snapshot.metadata.partitionColumns
        here = self.snapshot.small and self.pushed is not None and bool(columns)
        files = file_rows(self.snapshot.spark, self._picked()) if here else self.snapshot.inventory
        tests = []
        if self.pushed is not None and not here:
            tests.append(self.pushed.column(self._partition, strict=True))
        if self.partition_filter is not None:
            tests.append(self.partition_filter(self._partition))
        if tests and columns and not self.snapshot.small:
            key = F.to_json("partitionValues")
            kept = files.select("partitionValues", key.alias("_p")).dropDuplicates(["_p"])
            for t in tests:
                kept = kept.where(t)
            files = files.withColumn("_p", key).join(kept.select("_p"), "_p", "left_semi").drop("_p")
        else:
            for t in tests:
                files = files.where(t)
        if self.skip:
            files = self._skipped(files)
        return files

    def _picked(self) -> list[AddFile]:
        """Files whose partition passes; a partition's answer is kept for all its files. Null counts as no."""
        schema, seen, out = self.snapshot.metadata.partition_schema, {}, []
        for f in self.snapshot.files():
            key = tuple(f.partitionValues.get(c) for c in schema.fieldNames())
            if key not in seen:
                seen[key] = self.pushed.eval(PartitionRecord(f.partitionValues, schema)) is True
            if seen[key]:
                out.append(f)
        return out

    def _skipped(self, files: DataFrame) -> DataFrame:
        """Without files whose statistics rule the residual (or the given filter) out; files without statistics stay."""
        schema = self.snapshot.metadata.data_schema
        plain = [f for f in schema.fields if isinstance(f.dataType, SKIPPABLE)]
        at = {f.name.lower(): f for f in plain}
        tests = [b for b in expr.bounds(self.residual) if b[0].lower() in at]
        if not tests and self.stats_filter is None:
            return files
        used = plain if self.stats_filter is not None else [at[n] for n in sorted({b[0].lower() for b in tests})]
        values = T.StructType([T.StructField(f.name, f.dataType) for f in used])
        counts = T.StructType([T.StructField(f.name, T.LongType()) for f in used])
        stats = T.StructType([T.StructField("numRecords", T.LongType()), T.StructField("minValues", values), T.StructField("maxValues", values), T.StructField("nullCount", counts)])
        s = F.from_json("stats", stats)
        low, high, nulls = s["minValues"], s["maxValues"], s["nullCount"]
        for name, op, value in tests:
            f = at[name.lower()]
            a, b = low[f.name], high[f.name]
            if isinstance(f.dataType, T.StringType):  # long strings are cut: the upper bound may be short of the truth
                b = F.concat(b, F.lit("\U0010ffff"))
            if isinstance(f.dataType, T.TimestampType):  # kept to the millisecond
                b = b + F.expr("interval 1 millisecond")
            v = F.lit(value).cast(f.dataType) if value is not None else None
            if isinstance(f.dataType, (T.FloatType, T.DoubleType)) and op in (">", ">=", "="):
                ok = F.lit(True) if op != "=" else a <= v  # NaN counts as largest but is in no statistics
            elif op == "null":
                ok = nulls[f.name] > 0
            elif op == "not null":
                ok = nulls[f.name] < s["numRecords"]
            else:
                ok = {"=": lambda: (a <= v) & (b >= v), "<": lambda: a < v, "<=": lambda: a <= v, ">": lambda: b > v, ">=": lambda: b >= v}[op]()
                ok = F.when(nulls[f.name] == s["numRecords"], F.lit(False)).otherwise(ok)  # all null: nothing compares
            files = files.where(F.coalesce(ok, F.lit(True)))
        if self.stats_filter is not None:
            files = files.where(F.coalesce(self.stats_filter(low, high), F.lit(True)))
        return files

    def files(self) -> list[AddFile]:
        """The matching files."""
        if self.snapshot.small and self.partition_filter is None and self.stats_filter is None and (not self.skip or not expr.bounds(self.residual)):
            return self.snapshot.files() if self.pushed is None else self._picked()
        return [AddFile(r.path, r.partitionValues or {}, r["size"], r.modificationTime, False, r.stats, r.tags) for r in self.matching.toLocalIterator()]

    def rows(self, columns: list[str] | None = None, strict: bool = True) -> DataFrame:
        """The rows of the matching files under the whole predicate."""
        out = read_files(self.snapshot, self.matching)
        for c in expr.conjuncts(self.predicate):  # one filter each: a null drops the row as a false would, and Parquet gets to see it
            out = out.where(c.column(lambda n: F.col(f"`{self._named(n).name}`"), strict))
        return project(out, columns)


def project(df: DataFrame, columns: list[str] | None) -> DataFrame:
    """Columns in the order asked for; an empty list, blanks and unknown names are errors."""
    if columns is None:
        return df
    if not columns or any(not isinstance(c, str) or not c.strip() for c in columns):
        raise SchemaError("a column list can't be empty or hold blanks")
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise SchemaError(f"no columns {unknown} in {df.columns}")
    return df.select(*(F.col(f"`{c}`") for c in columns))


# Characters that partition folders escape.
_ESCAPED = set(chr(c) for c in range(1, 32)) | set("\"#%'*/:=?\\\x7f{[]^")


def folder_name(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in text)


def partition_folder(values: dict[str, str | None], columns: tuple[str, ...] | list[str]) -> str:
    """p=v folders as Spark's writer names them (not yet percent-encoded for the log)."""
    return "/".join(f"{folder_name(c)}={'__HIVE_DEFAULT_PARTITION__' if values[c] is None else folder_name(values[c])}" for c in columns)


def parquet_files(spark: SparkSession, schema: T.StructType, paths: list[str], base: str | None = None) -> DataFrame:
    """The rows of Parquet files by their exact paths. Names with glob characters are read apart, unglobbed: given together,
    Spark would read the other files twice."""
    reader = spark.read.schema(schema)
    reader = reader.option("basePath", base) if base else reader
    odd = [p for p in paths if any(c in p for c in "{}[]*?\\")]
    plain = [p for p in paths if p not in set(odd)]
    parts = ([reader.parquet(*plain)] if plain else []) + ([reader.option("__globPaths__", "false").parquet(*odd)] if odd else [])
    return parts[0].select("*", "_metadata") if len(parts) == 1 else parts[0].select("*", "_metadata").unionAll(parts[1].select("*", "_metadata"))


def read_files(snapshot: Snapshot, inventory: DataFrame) -> DataFrame:
    """Rows of an inventory's files in the table's column order, partition values from the log.

    Files laid out in p=v folders that say what the log says are read by Spark as partitions, so its own pruning applies
    once more. Otherwise values are joined on by file, broadcast in pieces.
    """
    meta, spark = snapshot.metadata, snapshot.spark
    columns = meta.partitionColumns
    listed = inventory.select("path", "partitionValues").collect() if columns else inventory.select("path").collect()
    if not listed:
        return spark.createDataFrame([], _nullable(meta.schema))
    physical = {f.metadata.get("delta.columnMapping.physicalName", f.name): f.name for f in meta.schema.fields}
    logical = {v: k for k, v in physical.items()}
    data_schema = T.StructType([T.StructField(logical[f.name], f.dataType, True) for f in meta.data_schema.fields])
    paths = [snapshot.data_path(r.path) for r in listed]
    if not columns:
        rows = parquet_files(spark, data_schema, paths)
        return rows.select(*(F.col(f"`{logical[f.name]}`").alias(f.name) for f in meta.schema.fields))
    stored = [logical[c] for c in columns]
    values = [{c: (r.partitionValues or {}).get(s, (r.partitionValues or {}).get(c)) for c, s in zip(columns, stored, strict=True)} for r in listed]
    root = snapshot.root.rstrip("/")
    plain = all(not any(isinstance(meta.schema[c].dataType, k) for k in (T.BinaryType, T.TimestampType)) for c in columns) and stored == list(columns)
    if plain and all("" not in v.values() and p.startswith(f"{root}/") and p[len(root) + 1 :].rsplit("/", 1)[0] == partition_folder(v, columns) for p, v in zip(paths, values, strict=True)):
        whole = T.StructType([*data_schema.fields, *(T.StructField(c, meta.schema[c].dataType) for c in columns)])
        rows = parquet_files(spark, whole, paths, root)
        return rows.select(*(F.col(f"`{logical[f.name]}`").alias(f.name) for f in meta.schema.fields))
    return _with_values(snapshot, data_schema, paths, [[v[c] for c in columns] for v in values], {c: meta.schema[c].dataType for c in columns}, {f.name: logical[f.name] for f in meta.schema.fields})


def _with_values(snapshot: Snapshot, data_schema: T.StructType, paths: list[str], values: list[list[str | None]], kinds: dict[str, T.DataType], columns: dict[str, str]) -> DataFrame:
    """Rows of files with each file's values (kinds names them) joined on, as columns (name -> stored name). The list goes in
    pieces of at most BROADCAST_BYTES, each broadcast to a read of its own files: no row is shuffled."""
    spark, out, at = snapshot.spark, None, 0
    while at < len(paths):
        end, size = at, 0
        while end < len(paths) and (end == at or size <= BROADCAST_BYTES):
            size += len(paths[end]) + 16 + sum(len(x or "") for x in values[end])
            end += 1
        named = spark.createDataFrame([(p if "://" in p else f"file:{p}", v) for p, v in zip(paths[at:end], values[at:end], strict=True)], "_file string, _values array<string>")
        rows = parquet_files(spark, data_schema, list(dict.fromkeys(paths[at:end]))).withColumn("_file", F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))
        joined = rows.join(F.broadcast(named), "_file", "left")

        def value(k: int, kind: T.DataType) -> Column:
            raw = F.col("_values")[k]
            return raw if isinstance(kind, T.StringType) else F.when(raw != "", raw).cast(kind)

        given = {c: value(k, kind) for k, (c, kind) in enumerate(kinds.items())}
        piece = joined.select(*((given[c] if c in given else F.col(f"`{stored}`")).alias(c) for c, stored in columns.items()))
        out, at = piece if out is None else out.unionAll(piece), end
    return out


def read_tagged(snapshot: Snapshot, added: list[tuple[AddFile, int]], tag: str) -> DataFrame:
    """Rows of files, each with the tag (a long) of its file: one read for all tags. A file given twice brings its rows twice."""
    meta = snapshot.metadata
    logical = {f.name: f.metadata.get("delta.columnMapping.physicalName", f.name) for f in meta.schema.fields}
    data_schema = T.StructType([T.StructField(logical[f.name], f.dataType, True) for f in meta.data_schema.fields])
    if not added:
        return snapshot.spark.createDataFrame([], T.StructType([*_nullable(meta.schema).fields, T.StructField(tag, T.LongType())]))
    columns = list(meta.partitionColumns)
    values = [[*((a.partitionValues or {}).get(logical[c], (a.partitionValues or {}).get(c)) for c in columns), str(v)] for a, v in added]
    kinds = {c: meta.schema[c].dataType for c in columns} | {tag: T.LongType()}
    return _with_values(snapshot, data_schema, [snapshot.data_path(a.path) for a, _ in added], values, kinds, {f.name: logical[f.name] for f in meta.schema.fields} | {tag: tag})


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def row_count(inventory: DataFrame) -> int | None:
    """Rows by statistics alone; None if any file lacks them."""
    r = inventory.agg(F.count("*").alias("n"), F.sum(F.from_json("stats", "numRecords long").numRecords).alias("rows"), F.count(F.from_json("stats", "numRecords long").numRecords).alias("known")).first()
    return (r.rows or 0) if r.n == r.known else None


def stats_json(record: dict) -> str:
    return json.dumps(record, separators=(",", ":"), default=str)

"""Writes: append, overwrite, delete by partition, rewrite, convert."""

from __future__ import annotations

import json
import math
import re
import time
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.errors import PartitioningMismatch, SchemaError, TableError
from tablelog.functions.schema_rules import write_compatible
from tablelog.plans import expr
from tablelog.plans.actions import Action, AddFile, Metadata, SetTransaction
from tablelog.sources.scan import SKIPPABLE
from tablelog.sources.store import FileStatus, encoded, local
from tablelog.sources.table import Table

#: Leading data columns that statistics are kept of, characters of a string in them.
STATS_COLUMNS, STATS_CHARS = 32, 32
#: Files that the driver moves, or whose footers it reads, at a time.
MOVERS = 16


def table_types(df: DataFrame) -> DataFrame:
    """Timestamps without a zone become timestamps (the table format has no other); read in the session's zone."""
    kinds = [(f.name, f.dataType) for f in df.schema.fields]
    if not any(isinstance(k, T.TimestampNTZType) for _, k in kinds):
        return df
    return df.select(*(F.col(f"`{n}`").cast("timestamp").alias(n) if isinstance(k, T.TimestampNTZType) else F.col(f"`{n}`") for n, k in kinds))


def nullable(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True, f.metadata) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType), True)
    return kind


def write_files(table: Table, df: DataFrame, partition_columns: Iterable[str], data_change: bool = True, stats: bool = True, options: dict[str, str] | None = None) -> list[AddFile]:
    """Write df as Parquet below the table and return the files. Spark's writer lays them out in a folder of their own; then
    each moves to its partition's folder. Nothing is visible before a commit names it."""
    columns, spark = list(partition_columns), df.sparkSession
    # readers of folders don't look below a name with a leading underscore
    own = f"{table.root}/_staging/{uuid.uuid4().hex}"
    for c in columns:  # an empty string reads back as null from a folder: the log says null as well
        if isinstance(df.schema[c].dataType, T.StringType):
            df = df.withColumn(c, F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")))
    writer = df.write.option("compression", "snappy").options(**(options or {}))
    (writer.partitionBy(*columns) if columns else writer).parquet(own)
    # walk() may name paths by URI or not: what follows the own folder is the same
    found = [(f.path.split(own.rsplit("/", 1)[1] + "/", 1)[1], f) for f in table.store.walk(own) if f.name.startswith("part-")]
    facts = _facts(spark, own, df.schema, columns, found) if stats and found else {}

    def put(path: str, f: FileStatus) -> AddFile | None:
        values = {}
        for piece in path.split("/")[:-1]:
            k, v = piece.split("=", 1)
            values[unfold(k)] = None if v == "__HIVE_DEFAULT_PARTITION__" else unfold(v)
        known = facts.get(path)
        if known is not None and known["numRecords"] == 0:
            return None  # it goes with its folder
        table.store.rename(f"{own}/{path}", f"{table.root}/{path}")
        return AddFile(encoded(path), {c: values.get(c) for c in columns}, f.size, int(time.time() * 1000), data_change, stats_text(known) if known is not None else None)

    with ThreadPoolExecutor(MOVERS) as pool:  # a rename may be a copy in an object store
        out = [a for a in pool.map(lambda x: put(*x), found) if a is not None]
    drop_folder(spark, own)
    return out


def _facts(spark: SparkSession, own: str, schema: T.StructType, columns: list[str], found: list[tuple[str, FileStatus]]) -> dict[str, dict]:
    """Statistics by path: from the footers where the driver can read the files, but for columns whose footers have none
    (timestamps of 96 bits) by an aggregation over those columns alone; elsewhere by an aggregation."""
    folder = own.rsplit("/", 1)[1]
    plain = _counted(schema, columns)
    if not local(own).startswith("/"):
        return file_stats(spark.read.parquet(own), columns, folder)
    with ThreadPoolExecutor(MOVERS) as pool:
        out = dict(zip((p for p, _ in found), pool.map(lambda x: footer_stats(local(x[1].path), plain), found), strict=True))
    missing = [f.name for f in plain if isinstance(f.dataType, T.TimestampType)]
    if missing:
        more = file_stats(spark.read.parquet(own).select(*(F.col(f"`{c}`") for c in missing), "_metadata"), columns, folder)
        for path, facts in more.items():
            for k in ("minValues", "maxValues", "nullCount"):
                out[path][k] |= facts[k]
    return out


def _counted(schema: T.StructType, partition_columns: list[str]) -> list[T.StructField]:
    """The leading columns that statistics are kept of."""
    return [f for f in schema.fields if f.name not in partition_columns and isinstance(f.dataType, SKIPPABLE)][:STATS_COLUMNS]


def footer_stats(path: str, plain: list[T.StructField]) -> dict:
    """numRecords, minValues, maxValues, nullCount of a Parquet file by its footer. A column without bounds in any row group that
    has values gets none."""
    import pyarrow.parquet as pq

    meta = pq.read_metadata(path)
    out: dict = {"numRecords": meta.num_rows, "minValues": {}, "maxValues": {}, "nullCount": {}}
    at = {meta.schema.column(k).path: k for k in range(meta.num_columns)}
    for f in plain:
        if f.name not in at:
            continue
        low, high, nulls, whole = [], [], 0, True
        for g in range(meta.num_row_groups):
            c = meta.row_group(g).column(at[f.name])
            s = c.statistics
            if s is None or not s.has_null_count:
                nulls, whole = None, False
                break
            nulls += s.null_count
            bounds = None if isinstance(f.dataType, T.TimestampType) or not s.has_min_max else (s.min, s.max)
            if bounds is not None and any(isinstance(x, float) and math.isnan(x) for x in bounds):
                whole = False
            elif bounds is not None:
                low.append(bounds[0])
                high.append(bounds[1])
            elif s.null_count < meta.row_group(g).num_rows:
                whole = False
        if nulls is not None:
            out["nullCount"][f.name] = nulls
        if whole and low:
            out["minValues"][f.name], out["maxValues"][f.name] = _said(min(low), f.dataType), _said(max(high), f.dataType)
    return out


def _said(value: object, kind: T.DataType) -> object:
    """A bound as the log writes it: strings cut, decimals and dates as JSON has them."""
    if isinstance(kind, T.StringType):
        return (value.decode() if isinstance(value, bytes) else str(value))[:STATS_CHARS]
    return value.isoformat() if isinstance(kind, T.DateType) else value


def stats_text(facts: dict) -> str:
    """Statistics as JSON; decimals keep all their digits, as numbers."""
    mark = uuid.uuid4().hex
    text = json.dumps(facts, separators=(",", ":"), default=lambda x: f"{mark}{x:f}" if isinstance(x, Decimal) else str(x))
    return re.sub(f'"{mark}([^"]*)"', r"\1", text)


def unfold(text: str) -> str:
    """A partition folder's piece without its escapes."""
    return re.sub(r"%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), text)


def drop_folder(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def file_stats(rows: DataFrame, partition_columns: list[str], folder: str) -> dict[str, dict]:
    """path below the folder -> numRecords, minValues, maxValues, nullCount of the leading columns: one aggregation by file."""
    plain = _counted(rows.schema, partition_columns)
    aggregates = [F.count("*").alias("n")]
    for k, f in enumerate(plain):
        c = F.col(f"`{f.name}`")
        fine = F.when(~F.isnan(c), c) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else c
        text = F.substring(fine, 1, STATS_CHARS) if isinstance(f.dataType, T.StringType) else fine
        aggregates += [F.min(text).alias(f"a{k}"), F.max(text).alias(f"b{k}"), F.count(F.when(c.isNull(), 1)).alias(f"c{k}")]
    place = F.substring_index(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), f"{folder}/", -1)
    grouped = rows.groupBy(place.alias("_file")).agg(*aggregates)
    fields = lambda p: F.struct(*(F.col(f"{p}{k}").alias(f.name) for k, f in enumerate(plain))) if plain else F.struct(F.lit(None).alias("none"))
    said = grouped.select("_file", F.to_json(F.struct(F.col("n").alias("numRecords"), fields("a").alias("minValues"), fields("b").alias("maxValues"), fields("c").alias("nullCount"))).alias("stats"))
    return {r["_file"]: {"numRecords": 0, "minValues": {}, "maxValues": {}, "nullCount": {}} | json.loads(r.stats, parse_float=Decimal) for r in said.collect()}


def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df's columns by name in the table's order; missing ones null, other types cast where they are given by position."""
    there = {c.lower(): c for c in df.columns}
    return df.select(*((F.col(f"`{there[f.name.lower()]}`") if f.name.lower() in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))


def prepare(txn, df: DataFrame, partition_columns: Iterable[str] | None, merge_schema: bool, configuration: dict[str, str] | None = None) -> DataFrame:
    """df in the table's schema. A new table takes df's; a differing schema is refused unless it may be merged."""
    df = table_types(df)
    schema = nullable(df.schema)
    if txn.read_version < 0:
        txn.update_metadata(Metadata.of(schema, tuple(partition_columns or ()), configuration=dict(configuration or {})))
        return df
    meta = txn.snapshot.metadata
    if partition_columns is not None and list(partition_columns) != list(meta.partitionColumns):
        raise PartitioningMismatch(f"the table is partitioned by {list(meta.partitionColumns)}, not {list(partition_columns)}")
    if {f.name: f.dataType for f in schema.fields} != {f.name: f.dataType for f in nullable(meta.schema).fields}:
        if not merge_schema:
            raise SchemaError(f"the rows have schema {schema.simpleString()}, the table {meta.schema.simpleString()}; merge_schema would add columns")
        known = {f.name.lower() for f in meta.schema.fields}
        merged = T.StructType([*meta.schema.fields, *(f for f in schema.fields if f.name.lower() not in known)])
        ours = {f.name.lower(): f.dataType for f in schema.fields}
        if not write_compatible(meta.schema, merged) or any(f.name.lower() in ours and ours[f.name.lower()] != nullable(f.dataType) for f in meta.schema.fields):
            raise SchemaError(f"{schema.simpleString()} can't be merged into {meta.schema.simpleString()}")
        txn.update_metadata(replace(meta, schemaString=merged.json()))
        return _aligned(df, merged)
    return _aligned(df, meta.schema)


def _metrics(added: list[AddFile], removed: int = 0) -> dict[str, str]:
    counts = [json.loads(a.stats)["numRecords"] for a in added if a.stats]
    return {"numAddedFiles": str(len(added)), "numRemovedFiles": str(removed), "numOutputRows": str(sum(counts)), "numOutputBytes": str(sum(a.size for a in added))}


def append(table: Table, df: DataFrame, partition_by: Iterable[str] | None = None, merge_schema: bool = False, static_partition: dict[str, object] | None = None, stats: bool = True, extra: Iterable[Action] = (), operation: str = "WRITE", configuration: dict[str, str] | None = None) -> int:
    """Add rows; returns the version. static_partition gives every row the same partition values."""
    for k, v in (static_partition or {}).items():
        df = df.withColumn(k, F.lit(v))
    txn = table.start()
    df = prepare(txn, df, partition_by, merge_schema, configuration)
    added = write_files(table, df, txn.metadata.partitionColumns, stats=stats)
    return txn.commit([*extra, *added], operation, {"mode": "Append", "partitionBy": json.dumps(list(txn.metadata.partitionColumns))}, metrics=_metrics(added))


def overwrite(table: Table, df: DataFrame, partition_by: Iterable[str] | None = None, schema_may_change: bool = False) -> int:
    """Replace all rows."""
    txn = table.start()
    if txn.read_version >= 0 and schema_may_change:
        df = table_types(df)
        txn.update_metadata(replace(txn.snapshot.metadata, schemaString=nullable(df.schema).json(), partitionColumns=tuple(partition_by or ())))
    else:
        df = prepare(txn, df, partition_by, False)
    txn.read_whole_table()
    gone = [f.remove(table.clock()) for f in txn.snapshot.files()]
    added = write_files(table, df, txn.metadata.partitionColumns)
    return txn.commit([*gone, *added], "WRITE", {"mode": "Overwrite"}, metrics=_metrics(added, len(gone)))


def delete_partition(table: Table, predicate: expr.Expression) -> int:
    """Remove the files of all partitions that match; the predicate may name partition columns only."""
    txn = table.start()
    scan = txn.mark_files_as_read(predicate)
    if scan.residual is not None:
        raise TableError("only conditions on partition columns can delete whole files")
    gone = [f.remove(table.clock()) for f in scan.files()]
    return txn.commit(gone, "DELETE", {"predicate": json.dumps([str(predicate)])}, metrics=_metrics([], len(gone)))


def rewrite(table: Table, n_files: int) -> int:
    """The same rows in other files; readers of changes see nothing."""
    txn = table.start()
    txn.read_whole_table()
    gone = [f.remove(table.clock(), data_change=False) for f in txn.snapshot.files()]
    added = write_files(table, table.to_df(txn.snapshot).repartition(n_files), txn.metadata.partitionColumns, data_change=False)
    return txn.commit([*gone, *added], "OPTIMIZE", {}, metrics=_metrics(added, len(gone)))


def convert_parquet(spark: SparkSession, path: str, schema: T.StructType, target: str | None = None) -> int:
    """Make a table of the Parquet files that lie in a folder (not below it), in place; another target refers to them by
    whole path. Unpartitioned, with the schema given."""
    source = local(path.rstrip("/"))
    table = Table.for_path(spark, target or path)
    if table.exists():
        raise TableError(f"there is a table at {table.root}")
    files = [f for f in table.store.walk(source, recursive=False) if f.name.endswith(".parquet") and not f.name.startswith(("_", "."))]
    base = "" if table.root == source else f"file:{source}/" if source.startswith("/") else f"{source}/"
    added = [AddFile(encoded(base + f.name), {}, f.size, f.modified, True) for f in files]
    txn = table.start()
    txn.update_metadata(Metadata.of(schema))
    return txn.commit(added, "CONVERT", {"numFiles": len(files), "partitionedBy": "[]"})


def transform(df: DataFrame, *steps) -> DataFrame:
    """df through functions of a DataFrame, in order."""
    for f in steps:
        df = df.transform(f)
    return df


def append_once(table: Table, df: DataFrame, app_id: str, version: int, **more) -> int | None:
    """append() with a transaction marker; None, and nothing written, if app_id has committed version or a later one."""
    if table.update().transactions.get(app_id, -1) >= version:
        return None
    return append(table, df, extra=[SetTransaction(app_id, version, table.clock())], operation="STREAMING UPDATE", **more)


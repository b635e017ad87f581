"""Parallel JDBC reads and imports.

    python -m tablelog.sources.jdbc --jdbc-url URL --source TABLE --destination PATH --split-by COLUMN [--chunks 10]
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNKS = 10


def read_in_chunks(spark: SparkSession, url: str, source: str, split_by: str, chunks: int = CHUNKS, properties: dict[str, str] | None = None) -> DataFrame:
    """A table read in ranges of an integer column between its bounds; an empty table's bounds count as 0."""
    options = {"url": url, **(properties or {})}
    query = f"(select min({split_by}) as low, max({split_by}) as high from {source}) bounds"
    r = spark.read.format("jdbc").options(**options, dbtable=query).load().first()
    low, high = (0 if v is None else int(v) for v in (r[0], r[1]))
    return spark.read.format("jdbc").options(**options, dbtable=source, partitionColumn=split_by, lowerBound=str(low), upperBound=str(high + 1), numPartitions=str(chunks)).load()


def import_table(spark: SparkSession, url: str, source: str, destination: str, split_by: str, chunks: int = CHUNKS, transforms: Iterable[Callable[[DataFrame], DataFrame]] = (), properties: dict[str, str] | None = None) -> int:
    """Read, transform, and overwrite the destination with its own columns; a new destination takes all columns."""
    from tablelog.operators.write import overwrite, transform
    from tablelog.sources.table import Table

    table = Table.for_path(spark, destination)
    df = transform(read_in_chunks(spark, url, source, split_by, chunks, properties), *transforms)
    if table.exists():
        there = {c.lower(): c for c in df.columns}
        df = df.select(*(F.col(f"`{there[f.name.lower()]}`").cast(f.dataType).alias(f.name) for f in table.snapshot().schema.fields))
    else:
        df = df.toDF(*(c.lower() for c in df.columns))
    return overwrite(table, df)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Import a JDBC table.")
    p.add_argument("--jdbc-url", "--jdbcUrl", required=True)
    p.add_argument("--source", required=True)
    p.add_argument("--destination", required=True)
    p.add_argument("--split-by", "--splitBy", required=True)
    p.add_argument("--chunks", type=int, default=CHUNKS)
    return p


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    return import_table(spark, a.jdbc_url, a.source, a.destination, a.split_by, a.chunks)


if __name__ == "__main__":
    main()

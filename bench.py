"""Benchmark: headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Tables are built once, untimed. Each query then runs once to warm up and RUNS times timed; its median counts. Log benchmarks time
cold handles, so nothing of an earlier run is reused.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
QUERIES = ("scan_full", "scan_projection", "prune_eq", "pushed_plus_residual", "multi_partition", "stats_skip_range", "time_travel_version", "changes_since", "state_file_stats", "metadata_count", "join_agg", "window_topk", "rollup", "data_source_read")


def timed(f: Callable[[], object], runs: int = RUNS) -> float:
    f()
    out = []
    for _ in range(runs):
        t = time.perf_counter()
        f()
        out.append(time.perf_counter() - t)
    return round(statistics.median(out), 4)


def main() -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench").config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from tablelog import queries as Q
    from tablelog.operators import checkpoint, write
    from tablelog.plans import expr as E
    from tablelog.plans.actions import AddFile, Metadata, Protocol
    from tablelog.sources.table import Table
    from tablelog.streaming.sink import write_stream
    from tablelog.streaming.source import read_stream

    run = lambda df: df.write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in QUERIES:
        times[name] = timed(lambda f=Q.QUERIES[name]: run(f(spark, SF_DIR)))
    by_date = Q._by_date(spark, SF_DIR)
    times["scan_count"] = timed(lambda: by_date.to_df().agg(F.count("l_orderkey"), F.sum("l_linenumber")).collect())
    own = tempfile.mkdtemp(prefix="tablelog-bench-")
    try:
        meta = Metadata.of(T.StructType([T.StructField("id", T.LongType())]))
        for n in (10, 100, 1000):
            root = f"{own}/log{n}"
            for v in range(n):
                actions = [*((Protocol(), meta) if v == 0 else ()), AddFile(f"f{v}", {}, 1, 1, stats='{"numRecords":1}')]
                path = f"{root}/_delta_log/{v:020d}.json"
                os.makedirs(os.path.dirname(path), exist_ok=True)
                Path(path).write_text("".join(a.json() + "\n" for a in actions))
            times[f"snapshot_{n}_commits"] = timed(lambda root=root: len(Table.for_path(spark, root).update().files()))
            checkpoint.checkpoint(Table.for_path(spark, root))
            times[f"snapshot_{n}_checkpoint"] = timed(lambda root=root: len(Table.for_path(spark, root).update().files()))
        # 10,000 files in 2 x 3 x 2 x 5 partitions, a condition on all four columns
        columns = [f"col{k}" for k in range(1, 5)]
        schema = T.StructType([*(T.StructField(c, T.StringType()) for c in columns), T.StructField("col5", T.IntegerType())])
        wide = Table.for_path(spark, f"{own}/wide")
        adds = [AddFile(f"f{k}", {c: str(k % m) for c, m in zip(columns, (2, 3, 2, 5), strict=True)}, 1, 1) for k in range(10_000)]
        wide.start().commit([Metadata.of(schema, columns), *adds], "WRITE")
        p = None
        for c in columns:
            e = E.EqualTo(E.Column(c, T.StringType()), E.Literal.of("1"))
            p = e if p is None else E.And(p, e)
        wide.update().inventory.count()
        times["filter_10000_files"] = timed(lambda: len(wide.scan(p).files()))
        lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
        for n in (1, 10, 100):
            k = iter(range(10_000))
            times[f"append_{n}_files"] = timed(lambda n=n, k=k: write.append(Table.for_path(spark, f"{own}/append{n}-{next(k)}"), lines.repartition(n)), 2)
        stream = Table.for_path(spark, f"{own}/stream")
        for v in range(50):
            write.append(stream, spark.range(v * 1000, v * 1000 + 1000).coalesce(1))
        k = iter(range(10_000))

        def catch_up() -> None:
            i = next(k)
            write_stream(read_stream(spark, stream.root, startingVersion=0), f"{own}/copy{i}", "bench", f"{own}/ck{i}").awaitTermination()

        times["stream_50_versions"] = timed(catch_up, 2)
    finally:
        shutil.rmtree(own, ignore_errors=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total of median query times", "value": total, "unit": "sec", "queries": times, "sf": Path(SF_DIR).name.removeprefix("sf"), "cpus": int(CPUS)}))
    spark.stop()


if __name__ == "__main__":
    main()

"""More registered queries: streams, checkpoints, catalog statements, and the rules of commits, each over whole source tables.

A query of rules tries each case on a table built from a source table and returns what happened; its SQL says what must happen."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog import errors
from tablelog.operators import write
from tablelog.operators.catalog import Catalog
from tablelog.plans import expr as E
from tablelog.plans import snapshot as snapshots
from tablelog.plans.actions import AddFile, CommitInfo, Metadata, Protocol, RemoveFile, SetTransaction
from tablelog.queries import _lines, _orders, _plain, _versions, made, query, source
from tablelog.sources.table import Table, discover_tables

_S, _I = T.StringType(), T.IntegerType()


def _outcome(f: Callable[[], object]) -> str:
    """'ok', or the name of the error."""
    try:
        f()
    except (errors.TableError, AssertionError, ValueError) as e:
        return type(e).__name__
    return "ok"


def _outcomes(spark: SparkSession, cases: Iterable[tuple[str, Callable[[], object]]]) -> DataFrame:
    return spark.createDataFrame([(name, _outcome(f)) for name, f in cases], "rule string, outcome string")


def _values(*cases: tuple[str, str]) -> str:
    return "select * from (values " + ", ".join(f"('{a}', '{b}')" for a, b in cases) + ") t(rule, outcome)"


# -- texts, replays, checkpoints


@query("select n_nationkey, 'a' || case n_regionkey when 0 then chr(133) when 1 then chr(8232) when 2 then chr(8233) when 3 then chr(13) else chr(10) end || 'b' as p from nation")
def odd_partition_text(spark, d):
    """Partition values that hold characters which other readers take for line ends."""

    def build(t: Table) -> None:
        n = source(spark, d, "nation")
        odd = F.element_at(F.array(*(F.lit(x) for x in ("\u0085", " ", " ", "\r", "\n"))), F.col("n_regionkey") + 1)
        rows = n.select("n_nationkey", F.concat(F.lit("a"), odd, F.lit("b")).alias("p"))
        write.append(t, rows.where("n_nationkey % 2 = 0"), partition_by=["p"])
        write.append(Table.for_path(spark, t.root), rows.where("n_nationkey % 2 = 1"))

    return Table.for_path(spark, made(spark, d, "odd_text", build).root).to_df()


def _history_table(spark: SparkSession, d: str) -> Table:
    """Parts in batches by size, each batch replacing the one before; a marker a commit."""

    def build(t: Table) -> None:
        p = source(spark, d, "part").select("p_partkey", "p_name", "p_size")
        before: list[AddFile] = []
        for k in range(12):
            txn = t.start()
            rows = write.prepare(txn, p.where(F.col("p_size") % 12 == k), None, False)
            added = write.write_files(t, rows, [])
            gone = [f.remove(t.clock()) for f in before] if k % 3 == 2 else []
            txn.commit([SetTransaction(f"batch{k % 2}", k), *gone, *added], "WRITE")
            before = [] if k % 3 == 2 else added

    return made(spark, d, "replaced", build)


_LEFT = "p_size % 12 % 3 <> 1"


@query(f"select p_partkey, p_name, p_size from part where {_LEFT}")
def replay_as_dataframe(spark, d):
    """State rebuilt by DataFrames, as for logs beyond the driver's memory."""
    t, kept = _history_table(spark, d), snapshots.DRIVER_BYTES
    snapshots.DRIVER_BYTES = 0
    try:
        s = Table.for_path(spark, t.root).update()
        return s.spark.createDataFrame([], s.schema).unionAll(Table.for_path(spark, t.root).to_df(s))
    finally:
        snapshots.DRIVER_BYTES = kept


@query("select count(*)::bigint as rows, 'batch0' as app, 10::bigint as last_0, 11::bigint as last_1, 4::bigint as num_removes, 2::bigint as num_transactions, 8::bigint as num_versions_live from part where " + _LEFT)
def state_facts(spark, d):
    """Totals of the state: rows by statistics, files, tombstones, markers."""
    s = _history_table(spark, d).update()
    f = s.facts().first()
    rows = s.inventory.agg(F.coalesce(F.sum(F.from_json("stats", "numRecords long").numRecords), F.lit(0)).alias("rows"))
    made_in = s.inventory.select("modificationTime", "path").count()
    assert f.num_files == made_in and f.size_in_bytes == s.inventory.agg(F.sum("size")).first()[0]
    live = len({v.version for v in _history_table(spark, d).changes(0) for a in v.iterate() if isinstance(a, AddFile) and a.path in {x.path for x in s.files()}})
    removed = len({v.version - 1 for v in _history_table(spark, d).changes(0) if any(isinstance(a, RemoveFile) for a in v.iterate())})
    return rows.select(F.col("rows").cast("long"), F.lit("batch0").alias("app"), F.lit(s.transactions["batch0"]).cast("long").alias("last_0"), F.lit(s.transactions["batch1"]).cast("long").alias("last_1"), F.lit(removed).cast("long").alias("num_removes"), F.lit(f.num_transactions).cast("long").alias("num_transactions"), F.lit(live).cast("long").alias("num_versions_live"))


@query("select c_custkey, c_name from customer where c_custkey % 40 <> 7")
def multi_part_checkpoint(spark, d):
    """A checkpoint in several parts; the commits before it are gone."""
    from tablelog.operators import checkpoint as c

    def build(t: Table) -> None:
        rows = source(spark, d, "customer").select("c_custkey", "c_name", (F.col("c_custkey") % 40).cast("int").alias("k"))
        write.append(t, rows, partition_by=["k"])
        write.delete_partition(t, E.EqualTo(E.Column("k", _I), E.Literal.of(7)))
        most, c.PART_ACTIONS = c.PART_ACTIONS, 10
        try:
            c.checkpoint(t)
        finally:
            c.PART_ACTIONS = most
        for v in (0, 1):
            t.store.delete(f"{t.log}/{v:020d}.json")

    t = Table.for_path(spark, made(spark, d, "parts", build).root)
    assert len(t.update().segment.checkpoint) > 1
    return t.to_df(columns=["c_custkey", "c_name"])


@query("select r_regionkey, r_name from region")
def corrupt_pointer(spark, d):
    """The pointer to the last checkpoint is nonsense: the listing finds it."""
    from tablelog.operators.checkpoint import checkpoint
    from tablelog.plans import segment

    def build(t: Table) -> None:
        write.append(t, source(spark, d, "region"))
        checkpoint(t)
        t.store.write(f"{t.log}/{segment.POINTER}", ["{nonsense"], overwrite=True)

    root, wait = made(spark, d, "pointer", build).root, segment.WAIT_S
    segment.WAIT_S = 0
    try:
        t = Table.for_path(spark, root)
        assert t.update().segment.checkpoint_version == 0
        return t.to_df()
    finally:
        segment.WAIT_S = wait


@query("select 3::bigint as first_version, count(*)::bigint as num_rows from supplier")
def log_retention(spark, d):
    """Expired log files go at a checkpoint; what the rest needs stays, and earlier versions can't be read."""
    import os

    from tablelog.operators.checkpoint import checkpoint
    from tablelog.plans import segment
    from tablelog.sources.store import local

    day, t0 = 86_400_000, 1_600_000_000_000

    def build(t: Table) -> None:
        for k in range(5):
            write.append(t, source(spark, d, "supplier").where(F.col("s_suppkey") % 5 == k))
            os.utime(local(f"{t.log}/{k:020d}.json"), ((t0 + k * day) / 1000,) * 2)
        late = Table.for_path(spark, t.root, clock=lambda: t0 + 33 * day)
        checkpoint(late, late.version_as_of(3))
        checkpoint(late)

    t = made(spark, d, "retention", build)
    first = segment.earliest_reproducible(t.store, t.log)
    assert _outcome(lambda: t.version_as_of(0)) == "VersionNotFound"
    return Table.for_path(spark, t.root).to_df().agg(F.count("*").alias("num_rows")).select(F.lit(first).cast("long").alias("first_version"), "num_rows")


# -- time and changes


@query("select range::bigint as version, range::bigint as before_or_at, range::bigint as at_or_after, greatest(range - 1, 0)::bigint as just_before from range(4)")
def versions_by_time(spark, d):
    """Each version's own time leads back to it; a millisecond less to the one before."""
    from tablelog.plans.segment import commits_from

    t = _versions(spark, d)
    rows = [(c.version, t.version_before_or_at(c.timestamp), t.version_at_or_after(c.timestamp), t.version_before_or_at(c.timestamp - 1) if c.version else 0) for c in commits_from(t.store, t.log)]
    return spark.createDataFrame(rows, "version long, before_or_at long, at_or_after long, just_before long")


@query("select c_custkey % 4 as version, 'WRITE' as operation, 'Serializable' as isolation, count(*)::bigint as rows_written from customer group by 1")
def commit_infos(spark, d):
    """Operation, isolation and the rows that the writer counted, by commit."""
    t = _versions(spark, d)
    info = [(v, t.commit_info(v)) for v in range(4)]
    return spark.createDataFrame([(v, i.operation, i.isolationLevel, int(i.operationMetrics["numOutputRows"])) for v, i in info], "version long, operation string, isolation string, rows_written long")


@query("select c_custkey, c_name from customer where c_custkey % 4 in (1, 2)")
def changes_between(spark, d):
    return _versions(spark, d).changed_rows(1, 2).select("c_custkey", "c_name")


# -- streams


@query("select c_custkey, c_custkey % 4 as batch, c_name from customer")
def stream_bounded_batches(spark, d):
    """One version a batch, from the first batch on."""
    from tablelog.streaming.sink import drain
    from tablelog.streaming.source import read_stream

    def build(t: Table) -> None:
        ck = f"{t.root}-checkpoint"
        stream = read_stream(spark, _versions(spark, d).root, startingVersion=0, maxVersionsPerTrigger=1, progressLocation=ck)
        drain(stream.select("c_custkey", "c_name"), t.root, "bounded", ck)

    return made(spark, d, "bounded", build).changed_rows(0).select("c_custkey", F.col("_commit_version").alias("batch"), "c_name")


@query("select count(*)::bigint as num_rows, 4::bigint as num_batches from customer")
def stream_snapshot_in_parts(spark, d):
    """A snapshot of eight files, two a batch."""
    from tablelog.streaming.sink import drain
    from tablelog.streaming.source import read_stream

    def build(t: Table) -> None:
        origin, ck = Table.for_path(spark, f"{t.root}-origin"), f"{t.root}-checkpoint"
        write.append(origin, source(spark, d, "customer").select("c_custkey", "c_name").repartitionByRange(8, "c_custkey"))
        drain(read_stream(spark, origin.root, maxFilesPerTrigger=2, progressLocation=ck), t.root, "parts", ck)

    t = made(spark, d, "in_parts", build)
    return t.to_df().agg(F.count("*").alias("num_rows")).withColumn("num_batches", F.lit(t.update().version + 1).cast("long"))


@query("select c_custkey, c_name from customer where c_custkey % 4 >= 2")
def stream_changes_only(spark, d):
    from tablelog.streaming.sink import write_stream
    from tablelog.streaming.source import read_stream

    def build(t: Table) -> None:
        stream = read_stream(spark, _versions(spark, d).root, startingVersion=2, columns=["c_custkey", "c_name"])
        write_stream(stream, t.root, "changes", f"{t.root}-checkpoint").awaitTermination()

    return made(spark, d, "changes_only", build).to_df()


@query("select time_bucket(interval 1 hour, ts) as start, event_type, count(*)::bigint as n from events group by all")
def stream_windows(spark, d):
    """Tumbling windows behind a watermark over a stream of a table's rows."""
    from tablelog.streaming.source import read_stream

    def build(t: Table) -> None:
        e, origin = source(spark, d, "events").select("ts", "event_type"), Table.for_path(spark, f"{t.root}-origin")
        write.append(origin, e)
        stream = read_stream(spark, origin.root).withWatermark("ts", "1 hour")
        counts = stream.groupBy(F.window("ts", "1 hour").start.alias("start"), "event_type").count().withColumnRenamed("count", "n")
        put = lambda batch, _: write.overwrite(Table.for_path(batch.sparkSession, t.root), batch)
        counts.writeStream.outputMode("complete").option("checkpointLocation", f"{t.root}-checkpoint").foreachBatch(put).trigger(availableNow=True).start().awaitTermination()

    return _plain(made(spark, d, "windows", build).to_df())


_FILTER_CASES = [(mix, c, x) for mix in ("add", "remove", "both", "silent") for c in (False, True) for x in (False, True)]


@query(
    _values(*((f"{mix} {c} {x}", "StreamError" if mix == "both" and not c or mix == "remove" and not (c or x) else "ok") for mix, c, x in _FILTER_CASES), ("metadata same", "ok"), ("metadata other", "StreamError"), ("metadata strict", "StreamError"))
)
def stream_action_rules(spark, d):
    """What a stream of changes takes, by kind of commit, ignoreChanges and ignoreDeletes."""
    from tablelog.streaming.source import added_files

    f = _versions(spark, d).update().files()[0].same(dataChange=True)
    quiet = f.same(dataChange=False)
    kinds = {"add": [f], "remove": [f.remove()], "both": [f, f.remove()], "silent": [quiet, quiet.remove(data_change=False)]}
    meta = _versions(spark, d).update().metadata
    cases = [(f"{mix} {c} {x}", lambda mix=mix, c=c, x=x: added_files(kinds[mix], c, x)) for mix, c, x in _FILTER_CASES]
    cases += [("metadata same", lambda: added_files([meta], False, False, meta.schema)), ("metadata other", lambda: added_files([meta], False, False, T.StructType([]))), ("metadata strict", lambda: added_files([meta], False, False, meta.schema, strict=True))]
    return _outcomes(spark, cases)


# -- rules of commits


def _fresh(spark: SparkSession, d: str, name: str, partitioned: bool = False) -> Table:
    """A new table of the regions, by name of the region or not partitioned."""
    from tablelog.queries import _folder

    t = Table.for_path(spark, f"{_folder(spark)}/{name}")
    write.append(t, source(spark, d, "region"), partition_by=["r_name"] if partitioned else None)
    return t


@query(
    _values(
        ("first commit without metadata", "MetadataAbsent"), ("metadata twice", "AssertionError"), ("commit info given", "AssertionError"), ("partition values missing", "PartitioningMismatch"), ("committed twice", "AssertionError"),
        ("other protocol", "ProtocolError"), ("append only, rows removed", "AppendOnlyViolation"), ("append only, files rewritten", "ok"), ("unknown property", "UnknownProperty"), ("reserved property", "ReservedProperty"), ("own property", "ok"),
        ("column dropped", "SchemaChanged"), ("column dropped, table emptied", "ok"), ("column added", "ok"), ("name with a blank", "InvalidColumnName"), ("names differ by case", "SchemaError"), ("unknown partition column", "PartitionColumnsNotFound"),
        ("all columns partition", "NoDataColumn"), ("not null in an array", "NestedNotNull"), ("newer reader needed", "ProtocolError"), ("newer writer needed", "ProtocolError"),
    )
)
def commit_rules(spark, d):
    """What a transaction refuses."""
    from tablelog.functions import schema_rules as R

    region = Table.for_path(spark, _fresh(spark, d, "rules").root)
    schema, file = region.update().schema, region.update().files()[0]
    plain = lambda name: _fresh(spark, d, name)
    empty = lambda name: Table.for_path(spark, plain(name).root + "-none")
    wider = Metadata.of(T.StructType([*schema.fields, T.StructField("more", _I)]))
    narrower = Metadata.of(T.StructType(schema.fields[:1]))

    def twice() -> None:
        txn = plain("twice").start()
        txn.commit([SetTransaction("a", 1)], "WRITE")
        txn.commit([SetTransaction("a", 2)], "WRITE")

    def kept(action: RemoveFile) -> None:
        t = plain("append_only")
        t.start().commit([Metadata.of(schema, configuration={"delta.appendOnly": "true"})], "SET")
        t.start().commit([action], "DELETE")

    def emptied() -> None:
        t = plain("emptied")
        t.start().commit([narrower, *(f.remove(t.clock()) for f in t.update().files())], "OVERWRITE")

    def newer(p: Protocol) -> None:
        t = plain("newer")
        t.store.write(f"{t.log}/{1:020d}.json", [p.json()])
        Table.for_path(spark, t.root).start()

    prop = lambda k: lambda: plain("prop").start().update_metadata(Metadata.of(schema, configuration={k: "1"}))
    return _outcomes(
        spark,
        [
            ("first commit without metadata", lambda: empty("a").start().commit([file], "WRITE")),
            ("metadata twice", lambda: empty("b").start().commit([wider, narrower], "WRITE")),
            ("commit info given", lambda: plain("c").start().commit([CommitInfo()], "WRITE")),
            ("partition values missing", lambda: _fresh(spark, d, "e", True).start().commit([AddFile("x", {}, 1, 1)], "WRITE")),
            ("committed twice", twice),
            ("other protocol", lambda: plain("f").start().commit([Protocol(2, 5)], "UPGRADE")),
            ("append only, rows removed", lambda: kept(RemoveFile("x", 1))),
            ("append only, files rewritten", lambda: kept(RemoveFile("x", 1, dataChange=False))),
            ("unknown property", prop("delta.unheardOf")),
            ("reserved property", prop("delta.constraints.c")),
            ("own property", prop("my.key")),
            ("column dropped", lambda: plain("g").start().commit([narrower], "ALTER")),
            ("column dropped, table emptied", emptied),
            ("column added", lambda: plain("h").start().commit([wider], "ALTER")),
            ("name with a blank", lambda: plain("i").start().update_metadata(Metadata.of(T.StructType([T.StructField("a b", _I)])))),
            ("names differ by case", lambda: plain("j").start().update_metadata(Metadata.of(T.StructType([T.StructField("a", _I), T.StructField("A", _I)])))),
            ("unknown partition column", lambda: R.check_partition_columns(schema, ["nope"])),
            ("all columns partition", lambda: R.check_partition_columns(schema, schema.fieldNames())),
            ("not null in an array", lambda: R.check_not_null(T.StructType([T.StructField("a", T.ArrayType(T.StructType([T.StructField("n", _I, False)])))]))),
            ("newer reader needed", lambda: newer(Protocol(99, 2))),
            ("newer writer needed", lambda: newer(Protocol(1, 99))),
        ],
    )


@query(
    _values(
        ("append, append", "ok"), ("other app", "ok"), ("same app", "ConcurrentTransaction"), ("metadata", "MetadataChanged"), ("protocol, protocol", "ProtocolChanged"), ("add beside what was read", "ok"), ("add to what was read", "ConcurrentAppend"),
        ("remove what was read", "ConcurrentDeleteRead"), ("remove beside what was read", "ok"), ("remove, remove", "ConcurrentDeleteDelete"), ("whole table read, add", "ConcurrentAppend"), ("whole table read, remove", "ConcurrentDeleteRead"), ("rewrite, add to what was read", "ok"),
    )
)
def conflict_rules(spark, d):
    """Two transactions from one version, the other one first: what the later one may still do."""
    asia = E.EqualTo(E.Column("r_name", _S), E.Literal.of("ASIA"))
    new = lambda region: AddFile(f"r_name={region}/new", {"r_name": region}, 1, 1)

    def race(reads: Callable, winner: Callable, own: Callable) -> Callable[[], object]:
        def run() -> None:
            t = _fresh(spark, d, "race", True)
            files = {f.partitionValues["r_name"]: f for f in t.update().files()}
            late = t.start()
            reads(late)
            Table.for_path(spark, t.root).start().commit(winner(files, t), "FIRST")
            late.commit(own(files), "LATE")

        return run

    nothing = lambda _: None
    some = lambda x: x.mark_files_as_read(asia)
    whole = lambda x: x.read_whole_table()
    add = lambda region: lambda *_: [new(region)]
    remove = lambda region: lambda files, *_: [files[region].remove(1)]
    mark = lambda *_: [SetTransaction("other", 3)]
    return _outcomes(
        spark,
        [
            ("append, append", race(nothing, add("ASIA"), lambda _: [AddFile("r_name=ASIA/also", {"r_name": "ASIA"}, 1, 1)])),
            ("other app", race(lambda x: x.txn_version("own"), mark, add("ASIA"))),
            ("same app", race(lambda x: x.txn_version("other"), mark, add("ASIA"))),
            ("metadata", race(nothing, lambda _, t: [t.update().metadata], add("ASIA"))),
            ("protocol, protocol", race(nothing, lambda *_: [Protocol()], lambda _: [Protocol()])),
            ("add beside what was read", race(some, add("EUROPE"), add("ASIA"))),
            ("add to what was read", race(some, add("ASIA"), add("EUROPE"))),
            ("remove what was read", race(some, remove("ASIA"), add("EUROPE"))),
            ("remove beside what was read", race(some, remove("EUROPE"), add("ASIA"))),
            ("remove, remove", race(nothing, remove("ASIA"), remove("ASIA"))),
            ("whole table read, add", race(whole, add("ASIA"), add("EUROPE"))),
            ("whole table read, remove", race(whole, remove("ASIA"), add("EUROPE"))),
            ("rewrite, add to what was read", race(some, add("ASIA"), lambda files: [files["ASIA"].remove(1, data_change=False), new("ASIA").same(path="r_name=ASIA/packed", dataChange=False)])),
        ],
    )


@query(
    _values(
        ("compared types differ", "IllegalExpression"), ("compared types agree", "ok"), ("unknown column", "SchemaError"), ("blank column list", "SchemaError"), ("option of a stream", "OptionError"), ("two starts", "OptionError"), ("bound without progress", "OptionError"),
        ("version too late", "VersionNotFound"), ("time too late", "TimestampTooLate"), ("time too early", "TimestampTooEarly"), ("negative start", "ValueError"), ("rows removed by a data condition", "TableError"), ("two stores", "StoreConfigConflict"), ("interval in months", "ValueError"),
    )
)
def read_rules(spark, d):
    """What readers refuse."""
    from tablelog.functions.intervals import interval_ms
    from tablelog.functions.options import source_options
    from tablelog.sources.store import store_for

    t = _versions(spark, d)

    def stores() -> None:
        keys = {"spark.delta.logStore.class": "tablelog.sources.store:LocalStore", "delta.logStore.class": "tablelog.sources.store:HadoopStore"}
        try:
            for k, v in keys.items():
                spark.conf.set(k, v)
            store_for(spark, "/a")
        finally:
            for k in keys:
                spark.conf.unset(k)

    return _outcomes(
        spark,
        [
            ("compared types differ", lambda: E.EqualTo(E.Column("c_name", _S), E.Literal.of(1))),
            ("compared types agree", lambda: E.EqualTo(E.Column("c_name", _S), E.Literal.of("x"))),
            ("unknown column", lambda: t.to_df(columns=["nope"])),
            ("blank column list", lambda: t.to_df(columns=[" "])),
            ("option of a stream", lambda: source_options({"startingVersion": "0"}, False)),
            ("two starts", lambda: source_options({"startingVersion": "0", "startingTimestamp": "2020-01-01"}, True)),
            ("bound without progress", lambda: source_options({"maxVersionsPerTrigger": "1"}, True)),
            ("version too late", lambda: t.version_as_of(4)),
            ("time too late", lambda: t.timestamp_as_of(1 << 50)),
            ("time too early", lambda: t.timestamp_as_of(1)),
            ("negative start", lambda: next(t.changes(-1))),
            ("rows removed by a data condition", lambda: write.delete_partition(t, E.EqualTo(E.Column("c_name", _S), E.Literal.of("x")))),
            ("two stores", stores),
            ("interval in months", lambda: interval_ms("interval 1 month")),
        ],
    )


# -- catalog


@query("select c_mktsegment, count(*)::bigint as n, max(c_acctbal) as most from customer where c_acctbal > 0 group by 1 union all select 'none', 0, -1.5")
def sql_statements(spark, d):
    """CREATE TABLE AS, INSERT INTO, ALTER TABLE and a query, all as SQL."""

    def build(t: Table) -> None:
        c = Catalog(spark)
        source(spark, d, "customer").createOrReplaceTempView("tl_source_customers")
        c.sql(f"create table tl_segments using delta location '{t.root}' as select c_mktsegment, count(*) as n, max(c_acctbal) as most from tl_source_customers where c_acctbal > 0 group by c_mktsegment")
        c.sql("insert into tl_segments values ('none', 0, -1.5)")
        c.sql("alter table tl_segments set tblproperties ('delta.appendOnly' = 'true')")
        assert c.describe("tl_segments")["properties"] == {"delta.appendOnly": "true"}

    t = made(spark, d, "statements", build)
    c = Catalog(spark)
    c.create_table("tl_segments2", t.root, t.update().schema, properties={"delta.appendOnly": "true"})
    return c.sql("select c_mktsegment, n, most from tl_segments2")


@query(
    _values(
        ("name taken", "CatalogError"), ("name taken, if not exists", "ok"), ("log has another schema", "SchemaError"), ("log has other partitions", "PartitioningMismatch"), ("property differs", "CatalogError"), ("property added", "ok"), ("job option as property", "OptionError"),
        ("computed column", "SchemaError"), ("columns altered", "CatalogError"), ("partitions listed", "CatalogError"), ("view written to", "ReadOnlyTable"), ("view not external", "CatalogError"), ("view with partitions", "CatalogError"), ("view with other columns", "SchemaError"),
        ("hints when writing", "OptionError"), ("unknown name dropped", "CatalogError"), ("unknown name dropped, if exists", "ok"), ("renamed to a taken name", "CatalogError"),
    )
)
def catalog_rules(spark, d):
    """What the catalog refuses."""
    t = _fresh(spark, d, "catalog", True)
    c, s = Catalog(spark), "r_regionkey int, r_name string"
    c.create_table("tl_r", t.root, s, ["r_name"], {"my.key": "1"})
    c.create_external_view("tl_v", t.root, s)
    rows = source(spark, d, "region")
    return _outcomes(
        spark,
        [
            ("name taken", lambda: c.create_table("tl_r", t.root, s, ["r_name"])),
            ("name taken, if not exists", lambda: c.create_table("tl_r", t.root, s, ["r_name"], if_not_exists=True)),
            ("log has another schema", lambda: c.create_table("tl_1", t.root, "r_regionkey long, r_name string", ["r_name"])),
            ("log has other partitions", lambda: c.create_table("tl_2", t.root, s)),
            ("property differs", lambda: c.create_table("tl_3", t.root, s, ["r_name"], {"my.key": "2"})),
            ("property added", lambda: c.create_table("tl_4", t.root, s, ["r_name"], {"more": "2"})),
            ("job option as property", lambda: c.create_table("tl_5", t.root, s, ["r_name"], {"versionAsOf": "1"})),
            ("computed column", lambda: c.create_table("tl_6", t.root, s, ["r_name"], computed=["x"])),
            ("columns altered", lambda: c.alter_columns("tl_r")),
            ("partitions listed", lambda: c.partitions("tl_r")),
            ("view written to", lambda: c.insert("tl_v", rows)),
            ("view not external", lambda: c.create_external_view("tl_7", t.root, s, external=False)),
            ("view with partitions", lambda: c.create_external_view("tl_8", t.root, s, partitioned_by=["r_name"])),
            ("view with other columns", lambda: c.create_external_view("tl_9", t.root, "r_regionkey int")),
            ("hints when writing", lambda: c.insert("tl_r", rows, versionAsOf=1)),
            ("unknown name dropped", lambda: c.drop_table("tl_none")),
            ("unknown name dropped, if exists", lambda: c.drop_table("tl_none", if_exists=True)),
            ("renamed to a taken name", lambda: c.rename("tl_r", "tl_v")),
        ],
    )


@query("select 'db' || (n_regionkey % 2) as database, 't' || n_regionkey as name, count(*)::bigint as n from nation group by n_regionkey")
def discovered_tables(spark, d):
    """Tables found below a folder, each with its rows."""

    def build(t: Table) -> None:
        write.append(t, source(spark, d, "region"))
        for k in range(5):
            write.append(Table.for_path(spark, f"{t.root}-db/db{k % 2}/t{k}"), source(spark, d, "nation").where(F.col("n_regionkey") == k))

    root = f"{made(spark, d, 'lakes', build).root}-db"
    found = discover_tables(spark, root).collect()
    return spark.createDataFrame([(r.database, r.name, Table.for_path(spark, r.path).count()) for r in found], "database string, name string, n long")


# -- joins and sets over tables


@query("select l_returnflag, l_linestatus, count(*)::bigint as n from lineitem group by cube (l_returnflag, l_linestatus)")
def cube(spark, d):
    return _lines(spark, d).to_df().cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("select l_returnflag, l_linestatus, count(*)::bigint as n from lineitem group by grouping sets ((l_returnflag), (l_linestatus), ())")
def grouping_sets(spark, d):
    a, b = F.col("l_returnflag"), F.col("l_linestatus")
    return _lines(spark, d).to_df().groupingSets([[a], [b], []], a, b).agg(F.count("*").alias("n"))


@query("select o_custkey from orders where o_orderstatus = 'F' union select c_custkey from customer except select o_custkey from orders where o_orderstatus = 'P'")
def union_except(spark, d):
    rows = lambda s: _orders(spark, d).scan(E.EqualTo(E.Column("o_orderstatus", _S), E.Literal.of(s))).rows(["o_custkey"])
    return rows("F").union(_versions(spark, d).to_df(columns=["c_custkey"])).distinct().exceptAll(rows("P").distinct())


@query("select o_orderkey, o_custkey, o_orderdate, p_orderkey from (select o_orderkey, o_custkey, o_orderdate, lag(o_orderkey) over w as p_orderkey from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey))")
def asof_previous(spark, d):
    """Each order with the customer's last one before it: one window, no join of all pairs."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return _plain(_orders(spark, d).to_df().select("o_orderkey", "o_custkey", "o_orderdate", F.lag("o_orderkey").over(w).alias("p_orderkey")))


@query("select p_partkey, count(*)::bigint as n from part join lineitem on l_partkey = p_partkey and l_quantity between p_size - 5 and p_size + 5 group by 1")
def range_join(spark, d):
    """A join by key and range; the range is a residual of the equi-join."""
    x, p = _lines(spark, d).to_df(columns=["l_partkey", "l_quantity"]), source(spark, d, "part")
    return x.join(p, (x.l_partkey == p.p_partkey) & x.l_quantity.between(p.p_size - 5, p.p_size + 5)).groupBy("p_partkey").agg(F.count("*").alias("n"))


@query("select l_returnflag, count(*)::bigint as n from lineitem group by 1")
def partition_counts_by_log(spark, d):
    """Rows by partition from the log alone: no data file is read."""
    rows = F.from_json("stats", "numRecords long").numRecords
    return _lines(spark, d).update().inventory.groupBy(F.col("partitionValues")["l_returnflag"].alias("l_returnflag")).agg(F.sum(rows).alias("n"))


@query("select o_orderstatus, count(*)::bigint as n from orders where o_orderstatus <> 'P' group by 1")
def pruned_listing(spark, d):
    """Files of a partition condition with their rows, listed without reading them."""
    files = _orders(spark, d).scan(E.Not(E.EqualTo(E.Column("o_orderstatus", _S), E.Literal.of("P")))).files()
    rows = [(f.partitionValues["o_orderstatus"], json.loads(f.stats)["numRecords"]) for f in files]
    return spark.createDataFrame(rows, "o_orderstatus string, n long").groupBy("o_orderstatus").agg(F.sum("n").alias("n"))

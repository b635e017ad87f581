"""Scans, writes, types, catalog, options, streaming."""

import datetime as dt
import os
import shutil
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import pyspark
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog import errors, queries
from tablelog.functions import options
from tablelog.functions.intervals import interval_ms, shift_zone, timestamp_ms
from tablelog.functions.schema_rules import check_external, write_compatible
from tablelog.operators import write
from tablelog.operators.catalog import Catalog
from tablelog.plans import expr as E
from tablelog.plans.actions import AddFile, Metadata, Protocol, RemoveFile
from tablelog.sources import jdbc
from tablelog.sources.jdbc import parser
from tablelog.sources.table import Table, read_table
from tablelog.streaming import sink, source
from tests.conftest import DATA

INT = T.IntegerType()


def rows(df, *by):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def visits(spark, path):
    """Six rows by month and port."""
    t = Table.for_path(spark, path)
    d = spark.createDataFrame([("oslo", "2021-03", "Vega", 12), ("oslo", "2021-09", "Lyra", 30), ("oslo", "2021-09", "Mira", 4), ("kobe", "2021-03", "Nova", 6), ("lima", "2021-01", "Alya", 17), ("bari", "2021-12", "Atria", 9)], "port string, month string, ship string, days int")
    write.append(t, d, partition_by=["month", "port"])
    return t


PORT, MONTH, DAYS = (E.Column(n, k) for n, k in (("port", T.StringType()), ("month", T.StringType()), ("days", INT)))
OSLO = E.EqualTo(PORT, E.Literal.of("oslo"))


def test_pruned_files_are_not_touched(spark, visits):
    for f in visits.update().files():
        if f.partitionValues["port"] != "oslo":
            os.unlink(f"{visits.root}/{f.path}")
    scan = visits.scan(E.And(OSLO, E.EqualTo(MONTH, E.Literal.of("2021-03"))))
    assert scan.residual is None and rows(scan.rows()) == [("oslo", "2021-03", "Vega", 12)]
    assert all("port=oslo" in f for f in scan.rows().inputFiles())
    assert rows(visits.scan(E.EqualTo(E.Column("PORT", T.StringType()), E.Literal.of("oslo"))).rows(["ship"])) == [("Lyra",), ("Mira",), ("Vega",)]


def test_projection(visits):
    assert visits.to_df(columns=["days", "port"]).columns == ["days", "port"]
    for bad in ([], [" "], ["nope"]):
        with pytest.raises(errors.SchemaError):
            visits.to_df(columns=bad)
    plan = visits.to_df(columns=["days"])._jdf.queryExecution().executedPlan().toString()
    assert "ship" not in plan.split("ReadSchema")[1]


def test_filters_reach_the_files(visits):
    found = visits.scan(E.And(OSLO, E.GreaterThan(DAYS, E.Literal.of(11)))).rows(["ship"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(days,11)" in plan and "PartitionFilters" in plan and rows(found) == [("Lyra",), ("Vega",)]
    assert plan.split("ReadSchema")[1].split("\n")[0].count(":") <= 4  # ship and days


def test_values_never_shuffle_rows(spark, visits, monkeypatch):
    """Values that don't come from folders are broadcast in pieces, however small a piece must be."""
    from tablelog.sources import scan

    u = Table.for_path(spark, visits.root + "2")
    u.start().commit([Metadata.of(visits.update().schema, ["month", "port"]), *(f.same(path=f"file:{visits.root}/{f.path}", dataChange=True) for f in visits.update().files())], "CLONE")
    monkeypatch.setattr(scan, "BROADCAST_BYTES", 0)
    df = u.to_df()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert rows(df) == rows(visits.to_df()) and plan.count("BroadcastHashJoin") >= 5 and "hashpartitioning" not in plan
    assert rows(u.changed_rows(0)) == [(*r, 0) for r in rows(visits.to_df())]


def test_footers_say_what_rows_say(spark, path):
    """Statistics by footer against an aggregation over the rows."""
    import json

    t = Table.for_path(spark, path)
    d = spark.createDataFrame(
        [(k, float(k) if k % 5 else None, "é" * k, Decimal(k) / 7, dt.date(2020, 1, 1 + k), dt.datetime(2020, 1, 1, k), None, k % 2 == 0) for k in range(20)], "a long, b double, c string, m decimal(30,9), d date, z timestamp, n int, f boolean"
    ).repartition(3)
    write.append(t, d)
    for f in t.update().files():
        facts = write.file_stats(spark.read.parquet(f"{t.root}/{f.path}"), [], path.rsplit("/", 1)[1])
        told, want = json.loads(f.stats, parse_float=Decimal), next(iter(facts.values()))
        assert {k: told[k] for k in ("numRecords", "nullCount")} == {k: want[k] for k in ("numRecords", "nullCount")}
        assert told["minValues"] == want["minValues"] and told["maxValues"] == want["maxValues"]
    nan = Table.for_path(spark, path + "2")
    write.append(nan, spark.createDataFrame([(float("nan"),), (1.0,)], "x double").coalesce(1))
    assert json.loads(nan.update().files()[0].stats)["minValues"] == {} and nan.scan(E.EqualTo(E.Column("x", T.DoubleType()), E.Literal.of(1.0))).rows().count() == 1


def test_special_partition_values(spark, path):
    t = Table.for_path(spark, path)
    d = spark.createDataFrame([(1, "a+ =%b"), (2, None), (3, "x/y"), (4, "é{*}?"), (5, "bar+%21"), (6, "")], "id int, p string")
    write.append(t, d, partition_by=["p"])
    assert rows(t.to_df()) == [(1, "a+ =%b"), (2, None), (3, "x/y"), (4, "é{*}?"), (5, "bar+%21"), (6, None)]
    assert rows(t.scan(E.EqualTo(E.Column("p", T.StringType()), E.Literal.of("x/y"))).rows()) == [(3, "x/y")]
    assert rows(t.scan(E.IsNull(E.Column("p", T.StringType()))).rows()) == [(2, None), (6, None)]
    # elsewhere, the same files by whole path: values come from the log alone
    u = Table.for_path(spark, path + "2")
    u.start().commit([Metadata.of(t.update().schema, ["p"]), *(f.same(path=f"file:{path}/{f.path}") for f in t.update().files())], "CLONE")
    assert rows(u.to_df()) == rows(t.to_df())


def test_partition_types(spark, path):
    t = Table.for_path(spark, path)
    kinds = "i int, l long, y tinyint, s smallint, b boolean, f float, d double, t string, m decimal(3,1), a date, z timestamp, v string"
    value = (1, 2, 3, 4, True, 1.5, 2.5, "null", Decimal("1.5"), dt.date(2020, 1, 1), dt.datetime(2020, 1, 1, 8, 9, 10), "x")
    write.append(t, spark.createDataFrame([value, (*[None] * 11, "y")], kinds), partition_by=[c.split()[0] for c in kinds.split(", ")][:-1])
    assert rows(t.to_df()) == sorted([value, (*[None] * 11, "y")], key=str)


def test_nested_types(spark, path):
    t = Table.for_path(spark, path)
    schema = "a array<array<int>>, m map<string,decimal(3,0)>, s struct<x:string,y:struct<z:bigint>>, bin binary, n array<string>"
    d = spark.createDataFrame([([[1], [2, None]], {"k": Decimal(1)}, ("q", (7,)), bytearray(b"\x00"), [None, None])], schema)
    write.append(t, d)
    assert t.to_df().select("s.y.z", "m", "a", "n").first() == (7, {"k": Decimal(1)}, [[1], [2, None]], [None, None])
    assert t.count() == 1


def test_empty_files_and_counts(spark, path):
    t = Table.for_path(spark, path)
    for k in range(4):
        write.append(t, spark.range(k, k + k % 2))
    assert rows(t.to_df()) == [(1,), (3,)] and t.count() == 2
    t.start().commit([AddFile("x", {}, 1, 1)], "WRITE")
    from tablelog.sources.scan import row_count

    assert row_count(t.update().inventory) is None


def test_skipping(spark, path):
    t = Table.for_path(spark, path)
    for k in range(4):
        write.append(t, spark.createDataFrame([(k * 10 + i, "x" * 40 + str(k), None if k == 3 else float(i)) for i in range(10)], "n int, s string, f double").coalesce(1))
    n, s, f = E.Column("n", INT), E.Column("s", T.StringType()), E.Column("f", T.DoubleType())
    for p, want in ((E.EqualTo(n, E.Literal.of(15)), 1), (E.GreaterThan(n, E.Literal.of(19)), 2), (E.LessThanOrEqual(E.Literal.of(30), n), 1), (E.In(n, [E.Literal.of(1), E.Literal.of(12)]), 2), (E.EqualTo(s, E.Literal.of("x" * 40 + "2")), 4), (E.IsNull(f), 1), (E.IsNotNull(f), 3), (E.LessThan(f, E.Literal.of(-1.0)), 0)):
        scan = t.scan(p)
        assert len(scan.files()) == want, p
        assert scan.rows().count() == t.to_df().where(p.column()).count()
    assert read_table(spark, path, stats_filter=lambda a, b: a.n >= 30).count() == 10


def test_cached_filter_over_many_files(spark, path, monkeypatch):
    from tablelog.plans import snapshot

    t = Table.for_path(spark, path)
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("v", INT)])
    t.start().commit([Metadata.of(schema, ["a"]), *(AddFile(f"f{k}", {"a": str(k % 3)}, 1, 1) for k in range(300))], "WRITE")
    p = E.EqualTo(E.Column("a", T.StringType()), E.Literal.of("1"))
    first = {f.path for f in t.scan(p).files()}
    monkeypatch.setattr(snapshot, "DRIVER_BYTES", 0)
    assert {f.path for f in Table.for_path(spark, path).scan(p).files()} == first and len(first) == 100


def test_writes(spark, path):
    t = Table.for_path(spark, path)
    d = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    write.append(t, d, partition_by=["p"])
    with pytest.raises(errors.PartitioningMismatch):
        write.append(t, d, partition_by=["id"])
    with pytest.raises(errors.SchemaError):
        write.append(t, d.withColumn("z", F.lit(1)))
    write.append(t, d.withColumn("z", F.lit(1)), merge_schema=True)
    with pytest.raises(errors.SchemaError):
        write.append(t, d.withColumn("id", F.lit("x")), merge_schema=True)
    assert rows(t.to_df()) == [(1, "a", 1), (1, "a", None), (2, "b", 1), (2, "b", None)]
    with pytest.raises(errors.TableError):
        write.delete_partition(t, E.EqualTo(E.Column("id", INT), E.Literal.of(1)))
    write.delete_partition(t, E.EqualTo(E.Column("p", T.StringType()), E.Literal.of("a")))
    assert t.count() == 2
    v = write.rewrite(t, 1)
    assert t.count() == 2 and not any(a.dataChange for x in t.changes(v) for a in x.actions if isinstance(a, (AddFile, RemoveFile)))
    write.overwrite(t, d.withColumn("z", F.lit(5)).limit(1))
    assert t.count() == 1 and t.to_df(t.version_as_of(1)).count() == 4
    assert os.listdir(f"{path}/_staging") == []


def test_convert(spark, tmp_path):
    p = str(tmp_path / "sales")
    spark.range(30).repartition(3).write.parquet(p)
    os.makedirs(f"{p}/below")
    write.convert_parquet(spark, p, T.StructType([T.StructField("id", T.LongType())]))
    assert Table.for_path(spark, p).to_df().count() == 30
    with pytest.raises(errors.TableError):
        write.convert_parquet(spark, p, T.StructType([]))
    other = str(tmp_path / "other")
    write.convert_parquet(spark, p, T.StructType([T.StructField("id", T.LongType())]), other)
    assert Table.for_path(spark, other).to_df().count() == 30


def test_column_mapping(spark, path):
    spark.range(3).withColumnRenamed("id", "col-1").write.parquet(path)
    schema = T.StructType([T.StructField("id", T.LongType(), True, {"delta.columnMapping.physicalName": "col-1"})])
    write.convert_parquet(spark, path, schema)
    assert rows(Table.for_path(spark, path).to_df()) == [(0,), (1,), (2,)] and Table.for_path(spark, path).to_df().columns == ["id"]


def test_catalog(spark, tmp_path):
    c = Catalog(spark, str(tmp_path / "registry.json"))
    a = str(tmp_path / "a")
    c.create_table("t", a, "id int, p string", ["p"], {"any": "1"})
    with pytest.raises(errors.CatalogError):
        c.create_table("t", a, "id int")
    c.create_table("t", a, "id int", if_not_exists=True)
    with pytest.raises(errors.SchemaError):
        c.create_table("u", a, "id long, p string", ["p"])
    with pytest.raises(errors.PartitioningMismatch):
        c.create_table("u", a, "id int, p string")
    with pytest.raises(errors.CatalogError):
        c.create_table("u", a, "id int, p string", ["p"], {"any": "2"})
    c.create_table("u", a, "id int, p string", ["p"], {"more": "2"})
    assert c.describe("t")["properties"] == {"any": "1", "more": "2"}
    for bad in ({"versionAsOf": "1"}, {"spark.x": "1"}, {"delta.logStore.class": "x"}, {"parquet.y": "1"}):
        with pytest.raises(errors.OptionError):
            c.create_table("w", str(tmp_path / "w"), "id int", properties=bad)
    c.insert("t", spark.createDataFrame([(1,)], "x int"), static_partition={"p": "v"})
    c.insert("t", spark.createDataFrame([(2,)], "x int"), columns=["id"])
    assert rows(c.read("t")) == [(1, "v"), (2, None)] and c.sql("select max(id) as m from t").first().m == 2
    assert c.read("t", versionAsOf=1).count() == 0
    with pytest.raises(errors.OptionError):
        c.insert("t", spark.range(1), versionAsOf=1)
    assert Catalog(spark, str(tmp_path / "registry.json")).list_tables() == c.list_tables()
    c.create_like("l", "t", str(tmp_path / "l"))
    assert c.describe("l")["partition_columns"] == ["p"]
    c.create_as_select("s", str(tmp_path / "s"), spark.range(4))
    assert c.read("s").count() == 4
    c.set_properties("s", {"delta.appendOnly": "true"})
    c.rename("s", "s2")
    with pytest.raises(errors.CatalogError):
        c.alter_columns("s2")
    with pytest.raises(errors.CatalogError):
        c.partitions("s2")
    assert c.statistics("s2")["row_count"] == -1
    c.drop_table("s2")
    assert os.path.exists(str(tmp_path / "s")) and not c.exists("s2")
    c.create_external_view("e", a, "ID int, P string")
    with pytest.raises(errors.ReadOnlyTable):
        c.insert("e", spark.range(1))
    for more in ({"external": False}, {"partitioned_by": ["p"]}):
        with pytest.raises(errors.CatalogError):
            c.create_external_view("e2", a, "id int, p string", **more)
    shutil.rmtree(f"{a}/_delta_log")
    with pytest.raises(errors.CatalogError):
        Catalog(spark, str(tmp_path / "registry.json"))._at("t").__class__ and Catalog(spark, str(tmp_path / "registry.json")).describe("t")


def test_external_schema():
    s = T._parse_datatype_string("a int, b string")
    check_external(s, T._parse_datatype_string("A int, B string"))
    for bad, said in (("a int", "missing"), ("a int, b int", "is int"), ("b string, a int", "ordered"), ("a int, b string, c int", "not in the table")):
        with pytest.raises(errors.SchemaError, match=said):
            check_external(s, T._parse_datatype_string(bad))


def test_write_compatible():
    old = T._parse_datatype_string("a int, s struct<x:int>, l array<int>, m map<string,int>")
    for new, fine in (("a int, s struct<x:int>, l array<int>, m map<string,int>, n int", True), ("a int, s struct<x:int,y:int>, l array<int>, m map<string,int>", True), ("a long, s struct<x:int>, l array<int>, m map<string,int>", False), ("A int, s struct<x:int>, l array<int>, m map<string,int>", False), ("a int", False)):
        assert write_compatible(old, T._parse_datatype_string(new)) is fine
    assert not write_compatible(T.StructType([T.StructField("a", INT)]), T.StructType([T.StructField("a", INT, False)]))
    assert not write_compatible(T.StructType([]), T.StructType([T.StructField("a", INT, False)]))


def test_intervals_and_times(spark):
    assert [interval_ms(x) for x in ("interval 1 week", "interval 30 days", "2 hours 3 minutes", "interval 1.5 seconds", "interval 7 milliseconds")] == [604_800_000, 2_592_000_000, 7_380_000, 1500, 7]
    for bad in ("interval 1 month", "interval 2 years", "interval 1.5 days", "", "week"):
        with pytest.raises(ValueError):
            interval_ms(bad)
    assert timestamp_ms("1970-01-02") == 86_400_000 and timestamp_ms("1970-01-01 00:00:01.5") == 1500 and timestamp_ms("1970-01-01T00:00:01Z") == 1000
    with pytest.raises(ValueError):
        timestamp_ms("01/02/1970")
    d = spark.createDataFrame([(dt.datetime(2020, 1, 1),)], "t timestamp")
    assert d.select(shift_zone(F.col("t"), "-5:30").alias("t")).first().t == dt.datetime(2019, 12, 31, 18, 30)


def test_options():
    assert options.source_options({"STARTINGVERSION": "Latest"}, True)["startingVersion"] == "latest"
    assert options.source_options({"ignoreChanges": "true"}, True)["ignoreDeletes"] is True
    with pytest.raises(errors.OptionError) as e:
        options.source_options({"versionAsOf": "1", "startingVersion": "1", "startingTimestamp": "2020-01-01", "nope": "1", "parquetBatchSize": "x"}, True)
    assert len(e.value.problems) == 4
    with pytest.raises(errors.OptionError):
        options.source_options({"versionAsOf": 1, "timestampAsOf": "2020-01-01"}, False)
    with pytest.raises(errors.OptionError):
        options.query_hints({"mode": "other"}, True)
    a = parser().parse_args("--jdbcUrl u --source s --destination d --splitBy id".split())
    assert (a.chunks, a.split_by) == (10, "id")


@pytest.mark.parametrize("changes", [False, True])
@pytest.mark.parametrize("deletes", [False, True])
@pytest.mark.parametrize("mix", ["add", "remove", "both", "silent"])
def test_action_filter(changes, deletes, mix):
    a, r = AddFile("a"), RemoveFile("b")
    given = {"add": [a], "remove": [r], "both": [a, r], "silent": [AddFile("a", dataChange=False), RemoveFile("b", dataChange=False)]}[mix]
    fails = mix == "both" and not changes or mix == "remove" and not (changes or deletes)
    if fails:
        with pytest.raises(errors.StreamError):
            source.added_files(given, changes, deletes)
    else:
        assert source.added_files(given, changes, deletes) == ([a] if mix in ("add", "both") else [])


def test_action_filter_and_metadata():
    m = Metadata.of(T.StructType([T.StructField("a", INT)]))
    assert source.added_files([m, Protocol(), AddFile("a")], False, False, m.schema) == [AddFile("a")]
    with pytest.raises(errors.StreamError):
        source.added_files([m], False, False, m.schema, strict=True)
    with pytest.raises(errors.StreamError):
        source.added_files([m], False, False, T.StructType([]))


def drain(spark, path, out, ck, **o):
    sink.write_stream(source.read_stream(spark, path, **o), out, "copy", ck).awaitTermination()
    return rows(Table.for_path(spark, out).to_df())


def test_stream_restart(spark, path, tmp_path):
    t, out, ck = Table.for_path(spark, path), str(tmp_path / "out"), str(tmp_path / "ck")
    write.append(t, spark.range(0, 5))
    write.append(t, spark.range(5, 10))
    assert len(drain(spark, path, out, ck)) == 10
    versions = Table.for_path(spark, out).update().version
    assert len(drain(spark, path, out, ck)) == 10 and Table.for_path(spark, out).update().version == versions
    write.append(t, spark.range(10, 12))
    assert len(drain(spark, path, out, ck)) == 12
    o = Table.for_path(spark, out)
    assert o.update().transactions.keys() == {"copy"}
    assert write.append_once(o, spark.range(3), "copy", 0) is None and o.count() == 12


def test_stream_from_version(spark, path, tmp_path):
    t = Table.for_path(spark, path)
    for k in range(3):
        write.append(t, spark.range(k * 10, k * 10 + 2))
    assert drain(spark, path, str(tmp_path / "o1"), str(tmp_path / "c1"), startingVersion=1) == [(10,), (11,), (20,), (21,)]
    os.utime(f"{t.log}/{0:020d}.json", (1000, 1000))
    os.utime(f"{t.log}/{1:020d}.json", (2000, 2000))
    assert drain(spark, path, str(tmp_path / "o2"), str(tmp_path / "c2"), startingTimestamp="1970-01-01T00:16:41") == [(10,), (11,), (20,), (21,)]


def test_stream_refuses_changes(spark, path, tmp_path):
    t = Table.for_path(spark, path)
    write.append(t, spark.range(3))
    write.overwrite(t, spark.range(2))
    with pytest.raises(Exception, match="ignoreChanges"):
        drain(spark, path, str(tmp_path / "o"), str(tmp_path / "c"), startingVersion=0)


def test_large_files_are_dealt_out(spark, path):
    write.append(Table.for_path(spark, path), spark.range(50_000).coalesce(1), stats=False)
    file = Table.for_path(spark, path).update().files()[0]
    log = source._Log(path)
    parts = source.parts_of(log, [file.same(size=3 * source.PART_BYTES - 1), file])
    assert [(p.share, p.shares) for p in parts] == [(0, 3), (1, 3), (2, 3), (0, 1)]
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert sum(b.num_rows for p in parts[:3] for b in source.read_part(p, schema, ())) == 50_000


def test_bounded_batches(spark, path, tmp_path):
    t = Table.for_path(spark, path)
    for k in range(3):
        write.append(t, spark.range(k * 10, k * 10 + 2).repartition(2))
    o, ck = Table.for_path(spark, str(tmp_path / "o")), str(tmp_path / "ck")
    stream = lambda **more: source.read_stream(spark, path, progressLocation=ck, **more)
    assert sink.drain(stream(startingVersion=0, maxVersionsPerTrigger=1), o.root, "a", ck) == 3
    assert [sum(1 for a in v.actions if isinstance(a, AddFile)) for v in o.changes(0)] == [2, 2, 2] and o.count() == 6
    write.append(t, spark.range(2))
    write.append(t, spark.range(2))
    sink.write_stream(stream(startingVersion=0, maxVersionsPerTrigger=1), o.root, "a", ck).awaitTermination()  # a restart: one batch
    assert o.count() == 8
    p, ck = Table.for_path(spark, str(tmp_path / "p")), str(tmp_path / "ck2")
    assert sink.drain(stream(maxFilesPerTrigger=4), p.root, "b", ck) == -(-len(t.update().files()) // 4) and p.count() == 10
    with pytest.raises(errors.OptionError, match="progressLocation"):
        source.read_stream(spark, path, maxFilesPerTrigger=4)


def test_partition_columns_alone(spark, visits):
    source.register(spark)
    df = spark.read.format("tablelog").option("columns", "port").load(visits.root)
    assert rows(df) == sorted([("oslo",)] * 3 + [("kobe",), ("lima",), ("bari",)])


def test_data_source(spark, visits):
    source.register(spark)
    df = spark.read.format("tablelog").load(visits.root).where("port = 'oslo' and days > 12")
    assert rows(df.select("ship")) == [("Lyra",)]
    assert spark.read.format("tablelog").option("versionAsOf", 0).option("columns", "days").load(visits.root).columns == ["days"]
    with pytest.raises(Exception, match="doesn't go with"):
        spark.read.format("tablelog").option("versionAsOf", 0).option("startingVersion", 0).load(visits.root)


ODD = [(1, None, 1.5), (2, "", -0.1), (3, "  a ", 1e300), (4, 'x","y\\', None), (5, "two\nlines", 0.0), (6, "ß✓", 2.0), (7, '"', 3.0)]


def test_derby_keeps_odd_values(spark):
    """Rows reach the database as they are, and several readers share it."""
    df = spark.createDataFrame(ODD, "id long, name string, w double").repartition(3)
    back = jdbc.read_in_chunks(spark, queries._derby(spark, df, "odd"), "odd", "id", 3, queries._DERBY)
    assert back.rdd.getNumPartitions() == 3
    assert sorted(tuple(r) for r in back.collect()) == ODD


def test_jdbc_chunks_on_a_cluster(tmp_path):
    """Executors are JVMs of their own: all of them read the driver's database."""
    home = tmp_path / "home"
    (home / "work").mkdir(parents=True)
    for p in Path(pyspark.__file__).parent.iterdir():
        if p.name != "work":
            (home / p.name).symlink_to(p)
    code = f"""
from pyspark.sql import SparkSession
from tablelog.queries import QUERIES
s = SparkSession.builder.master("local-cluster[2,1,600]").config("spark.executor.memory", "500m").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
print("rows", sorted(r.s_suppkey for r in QUERIES["jdbc_chunks"](s, {DATA!r}).collect()) == sorted(r.s_suppkey for r in s.read.parquet({DATA!r} + "/supplier.parquet").collect()))
"""
    env = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK_", "PYSPARK_"))} | {"SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_PYTHON": sys.executable}
    told = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=180)
    assert "rows True" in told.stdout, told.stderr[-3000:]

"""The registered queries over tables: each builds a table from the source Parquet in the shared folder and reads it back, and has
the SQL that gives the same rows from the source."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelog.operators import write
from tablelog.operators.catalog import Catalog
from tablelog.plans import expr as E
from tablelog.plans.actions import SetTransaction
from tablelog.sources.store import local
from tablelog.sources.table import Table, read_table

Query = Callable[[SparkSession, str], DataFrame]
_made: dict[tuple, Table] = {}
_S, _D, _TS = T.StringType(), T.DoubleType(), T.TimestampType()


def _folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, or a local one where that is unset; it goes when the program ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    own = f"{shared.rstrip('/')}/tables-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="tablelog-tables-")
    atexit.register(_remove, spark, own, os.getpid())
    return own


def _remove(spark: SparkSession, path: str, pid: int) -> None:
    if os.getpid() != pid:
        return
    if local(path).startswith("/"):
        shutil.rmtree(local(path), ignore_errors=True)
        return
    try:
        write.drop_folder(spark, path)
    except Exception:  # noqa: BLE001  the JVM may be gone at exit
        return


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def made(spark: SparkSession, sf_dir: str, name: str, build: Callable[[Table], object]) -> Table:
    """The table of a name and a data folder, built once a session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made or not _made[key].exists():
        table = Table.for_path(spark, f"{_folder(spark)}/{name}")
        build(table)
        _made[key] = table
    return _made[key]


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps as the source has them, without a zone."""
    return df.select(*(F.col(n).cast("timestamp_ntz").alias(n) if k == "timestamp" else F.col(n) for n, k in df.dtypes))


def _orders(spark: SparkSession, d: str) -> Table:
    """Orders by status, in two commits."""

    def build(t: Table) -> None:
        o = source(spark, d, "orders")
        write.append(t, o.where("o_orderkey % 2 = 0"), partition_by=["o_orderstatus"])
        write.append(t, o.where("o_orderkey % 2 <> 0"))

    return made(spark, d, "orders", build)


def _priority(spark: SparkSession, d: str) -> Table:
    """Orders by priority, which is null for one of them."""

    def build(t: Table) -> None:
        o = source(spark, d, "orders").withColumn("prio", F.when(~F.col("o_orderpriority").startswith("5"), F.col("o_orderpriority")))
        write.append(t, o.select("o_orderkey", "o_totalprice", "prio"), partition_by=["prio"])

    return made(spark, d, "priority", build)


def _years(spark: SparkSession, d: str) -> Table:
    def build(t: Table) -> None:
        write.append(t, source(spark, d, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year")), partition_by=["year"])

    return made(spark, d, "years", build)


def _lines(spark: SparkSession, d: str) -> Table:
    """Lines by two columns, in two commits."""

    def build(t: Table) -> None:
        x = source(spark, d, "lineitem")
        write.append(t, x.where("l_orderkey % 2 = 0"), partition_by=["l_returnflag", "l_linestatus"])
        write.append(t, x.where("l_orderkey % 2 <> 0"))

    return made(spark, d, "lines", build)


def _by_date(spark: SparkSession, d: str) -> Table:
    def build(t: Table) -> None:
        write.append(t, source(spark, d, "lineitem").repartitionByRange(16, "l_shipdate").sortWithinPartitions("l_shipdate"))

    return made(spark, d, "by_date", build)


def _versions(spark: SparkSession, d: str) -> Table:
    """Customers in four commits by key."""

    def build(t: Table) -> None:
        for k in range(4):
            write.append(t, source(spark, d, "customer").where(F.col("c_custkey") % 4 == k))

    return made(spark, d, "versions", build)


QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@query(f"select {ORDERS} from orders")
def scan_full(spark, d):
    return _plain(_orders(spark, d).to_df())


@query("select o_orderdate, o_orderkey, o_orderkey as again, o_orderstatus from orders")
def scan_projection(spark, d):
    return _plain(_orders(spark, d).to_df(columns=["o_orderdate", "o_orderkey", "o_orderstatus"])).select("o_orderdate", "o_orderkey", F.col("o_orderkey").alias("again"), "o_orderstatus")


def _compared(name: str, kind: type[E.Expression], sql: str) -> None:
    def f(spark, d):
        return _years(spark, d).scan(kind(E.Column("year", T.IntegerType()), E.Literal.of(1998))).rows()

    f.__name__ = name
    query(f"select o_orderkey, o_totalprice, year(o_orderdate)::int as year from orders where year(o_orderdate) {sql} 1998")(f)


for _name, _kind, _sql in (("prune_eq", E.EqualTo, "="), ("prune_lt", E.LessThan, "<"), ("prune_lte", E.LessThanOrEqual, "<="), ("prune_gt", E.GreaterThan, ">"), ("prune_gte", E.GreaterThanOrEqual, ">=")):
    _compared(_name, _kind, _sql)


@query("select o_orderkey, o_totalprice, year(o_orderdate)::int as year from orders where year(o_orderdate) <> 1998")
def prune_neq(spark, d):
    return _years(spark, d).scan(E.Not(E.EqualTo(E.Column("year", T.IntegerType()), E.Literal.of(1998)))).rows()


_PRIO = "select o_orderkey, o_totalprice, prio from (select *, case when o_orderpriority not like '5%' then o_orderpriority end as prio from orders) where "


@query(_PRIO + "prio in ('1-URGENT', '3-MEDIUM')")
def prune_in(spark, d):
    return _priority(spark, d).scan(E.In(E.Column("prio", _S), [E.Literal.of("1-URGENT"), E.Literal.of("3-MEDIUM")])).rows()


@query(_PRIO + "prio like '1%'")
def prune_like(spark, d):
    return read_table(spark, _priority(spark, d).root, partition_filter=lambda c: c("prio").like("1%"))


@query(_PRIO + "prio is not distinct from null")
def prune_null_safe_eq(spark, d):
    return read_table(spark, _priority(spark, d).root, partition_filter=lambda c: c("prio").eqNullSafe(F.lit(None)))


@query(_PRIO + "prio is null")
def prune_is_null(spark, d):
    return _priority(spark, d).scan(E.IsNull(E.Column("prio", _S))).rows()


@query(_PRIO + "prio is not null")
def prune_is_not_null(spark, d):
    return _priority(spark, d).scan(E.IsNotNull(E.Column("prio", _S))).rows()


@query(_PRIO + "prio is not null and (prio = '1-URGENT' or not (o_totalprice < 100000))")
def filter_and_or_not_strict(spark, d):
    p = E.Or(E.EqualTo(E.Column("prio", _S), E.Literal.of("1-URGENT")), E.Not(E.LessThan(E.Column("o_totalprice", _D), E.Literal.of(100000.0))))
    return _priority(spark, d).scan(p).rows(strict=True)


@query("select l_linestatus, cast(round(sum(l_extendedprice * (1 - l_discount)), 2) as decimal(20, 2)) as revenue from lineitem where l_returnflag = 'R' and l_quantity > 25 group by 1")
def pushed_plus_residual(spark, d):
    p = E.And(E.EqualTo(E.Column("l_returnflag", _S), E.Literal.of("R")), E.GreaterThan(E.Column("l_quantity", _D), E.Literal.of(25.0)))
    return _lines(spark, d).scan(p).rows().groupBy("l_linestatus").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).cast("decimal(20,2)").alias("revenue"))


@query("select l_returnflag, l_linestatus, count(*) as n, sum(l_linenumber)::bigint as lines from lineitem where l_returnflag <> 'N' group by all")
def multi_partition(spark, d):
    p = E.Not(E.EqualTo(E.Column("l_returnflag", _S), E.Literal.of("N")))
    return _lines(spark, d).scan(p).rows().groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("lines"))


@query("select l_orderkey, l_linenumber, l_shipdate from lineitem where l_shipdate >= timestamp '1997-03-01' and l_shipdate < timestamp '1997-04-01'")
def stats_skip_range(spark, d):
    import datetime as dt

    at = E.Column("l_shipdate", _TS)
    utc = dt.timezone.utc
    p = E.And(E.GreaterThanOrEqual(at, E.Literal.of(dt.datetime(1997, 3, 1, tzinfo=utc))), E.LessThan(at, E.Literal.of(dt.datetime(1997, 4, 1, tzinfo=utc))))
    return _plain(_by_date(spark, d).scan(p).rows(["l_orderkey", "l_linenumber", "l_shipdate"]))


@query("select l_orderkey, l_linenumber from lineitem where l_orderkey between 100 and 200")
def stats_skip_function(spark, d):
    low, high = 100, 200
    rows = read_table(spark, _by_date(spark, d).root, stats_filter=lambda a, b: (a.l_orderkey <= high) & (b.l_orderkey >= low))
    return rows.where(F.col("l_orderkey").between(low, high)).select("l_orderkey", "l_linenumber")


_CUSTOMERS = "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer where c_custkey % 4 "


@query(_CUSTOMERS + "<= 1")
def time_travel_version(spark, d):
    t = _versions(spark, d)
    return t.to_df(t.version_as_of(1))


@query(_CUSTOMERS + "<= 2")
def time_travel_timestamp(spark, d):
    from tablelog.plans.segment import commits_from

    t = _versions(spark, d)
    return t.to_df(t.timestamp_as_of(commits_from(t.store, t.log)[2].timestamp))


@query(_CUSTOMERS + "<= 2")
def time_travel_relative(spark, d):
    return read_table(spark, _versions(spark, d).root, version=-1)


@query("select *, c_custkey % 4 as _commit_version from (" + _CUSTOMERS + ">= 2)")
def changes_since(spark, d):
    return _versions(spark, d).changed_rows(2)


@query("select p_partkey, p_name from part where p_size > 25")
def overwrite_latest(spark, d):
    def build(t: Table) -> None:
        p = source(spark, d, "part").select("p_partkey", "p_name", "p_size")
        write.append(t, p)
        write.overwrite(t, p.where("p_size > 25"))

    return made(spark, d, "overwritten", build).to_df(columns=["p_partkey", "p_name"])


@query("select o_orderkey, o_orderstatus from orders where o_orderstatus <> 'P'")
def delete_partition(spark, d):
    def build(t: Table) -> None:
        write.append(t, source(spark, d, "orders").select("o_orderkey", "o_orderstatus"), partition_by=["o_orderstatus"])
        write.delete_partition(t, E.EqualTo(E.Column("o_orderstatus", _S), E.Literal.of("P")))

    return made(spark, d, "deleted", build).to_df()


@query("select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def repartitioned_nochange(spark, d):
    def build(t: Table) -> None:
        write.append(t, source(spark, d, "supplier").repartition(4))
        write.rewrite(t, 1)

    return made(spark, d, "rewritten", build).to_df()


@query("select n_nationkey, n_name, n_regionkey from nation")
def checkpoint_tail(spark, d):
    def build(t: Table) -> None:
        for k in range(25):
            write.append(t, source(spark, d, "nation").where(F.col("n_nationkey") == k))

    t = made(spark, d, "many_commits", build)
    assert t.update().segment.checkpoint_version == 20
    return t.to_df()


@query("select s_suppkey, s_name, case when s_suppkey % 2 = 1 then s_nationkey end as s_nationkey from supplier")
def schema_evolution_added_column(spark, d):
    def build(t: Table) -> None:
        s = source(spark, d, "supplier")
        write.append(t, s.where("s_suppkey % 2 = 0").select("s_suppkey", "s_name"))
        write.append(t, s.where("s_suppkey % 2 = 1").select("s_suppkey", "s_name", "s_nationkey"), merge_schema=True)

    return made(spark, d, "evolved", build).to_df()


@query("select o_orderstatus, count(*) as num_records from orders group by 1")
def state_file_stats(spark, d):
    rows = F.from_json("stats", "numRecords long").numRecords
    return _orders(spark, d).update().inventory.groupBy(F.col("partitionValues")["o_orderstatus"].alias("o_orderstatus")).agg(F.sum(rows).alias("num_records"))


@query("select count(*) as num_rows from lineitem")
def metadata_count(spark, d):
    return _by_date(spark, d).update().inventory.agg(F.sum(F.from_json("stats", "numRecords long").numRecords).alias("num_rows"))


@query("select 'app' || r_regionkey as app_id, (r_regionkey + 10)::bigint as version from region")
def txn_latest(spark, d):
    def build(t: Table) -> None:
        regions = source(spark, d, "region")
        write.append(t, regions)
        for k in (1, 10):
            txn = t.start()
            txn.commit([SetTransaction(f"app{r.r_regionkey}", r.r_regionkey + k) for r in regions.collect()], "STREAMING UPDATE")

    t = made(spark, d, "transactions", build)
    return spark.createDataFrame(sorted(t.update().transactions.items()), "app_id string, version long")


@query("select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part")
def convert_parquet(spark, d):
    def build(t: Table) -> None:
        p = source(spark, d, "part")
        p.repartition(3).write.parquet(t.root)
        write.convert_parquet(spark, t.root, write.nullable(p.schema))

    return made(spark, d, "converted", build).to_df()


_DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _derby(spark: SparkSession, df: DataFrame, name: str) -> str:
    """The URL of a Derby database with df as a table, in a jar in the shared folder. A jar is read-only, so the driver and
    all executors may open it at once; a database in memory or in a folder is of one JVM."""
    shared = local(_folder(spark))
    if not shared.startswith("/"):
        raise RuntimeError(f"Derby opens databases in mounted folders only, not in {shared}")
    df = df.toDF(*(c.upper() for c in df.columns))
    own = tempfile.mkdtemp(prefix="tablelog-derby-")
    try:
        url = f"jdbc:derby:{own}/db"
        # without rows there are no tasks, so only the driver opens it; the rows follow as files
        df.where(F.lit(False)).write.format("jdbc").options(url=f"{url};create=true", dbtable=name, **_DERBY).save()
        # every value in quotes, for Derby drops blanks outside them; null is nothing
        fields = (F.coalesce(F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")) for c in df.columns)
        df.select(F.concat_ws(",", *fields)).write.text(f"file://{shared}/rows")
        jvm = spark.sparkContext._jvm
        derby = jvm.org.apache.derby.iapi.jdbc.AutoloadedDriver()
        to = derby.connect(url, jvm.java.util.Properties())
        for f in sorted(Path(shared, "rows").glob("part-*.txt")):
            to.createStatement().execute(f"call SYSCS_UTIL.SYSCS_IMPORT_TABLE(null, '{name.upper()}', '{f}', ',', '\"', 'UTF-8', 0)")
        to.close()
        try:
            derby.connect(f"{url};shutdown=true", jvm.java.util.Properties())
        except Py4JJavaError as e:  # the sign of a clean shutdown
            if e.java_exception.getSQLState() != "08006":
                raise
        with zipfile.ZipFile(f"{shared}/db.jar", "w", allowZip64=True) as jar:
            for f in sorted(Path(own, "db").rglob("*")):
                jar.write(f, f.relative_to(own))
        shutil.rmtree(f"{shared}/rows")
    finally:
        shutil.rmtree(own, ignore_errors=True)
    return f"jdbc:derby:jar:({shared}/db.jar)db"


@query("select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def jdbc_chunks(spark, d):
    from tablelog.sources.jdbc import import_table

    def build(t: Table) -> None:
        import_table(spark, _derby(spark, source(spark, d, "supplier"), "supplier"), "supplier", t.root, "s_suppkey", 4, properties=_DERBY)

    return made(spark, d, "imported", build).to_df()


@query("select n_nationkey, upper(n_name) || '!' as n_name from nation")
def transform_chain(spark, d):
    def build(t: Table) -> None:
        steps = (lambda x: x.withColumn("n_name", F.upper("n_name")), lambda x: x.withColumn("n_name", F.concat("n_name", F.lit("!"))))
        write.append(t, write.transform(source(spark, d, "nation").select("n_nationkey", "n_name"), *steps))

    return made(spark, d, "transformed", build).to_df()


@query("select o_orderkey, o_orderdate + interval 2 hour as o_orderdate from orders")
def tz_offset(spark, d):
    return _plain(read_table(spark, _orders(spark, d).root, columns=["o_orderkey", "o_orderdate"], zone_offset="+02:00"))


@query("select r_regionkey, r_name, 'x y=1' as batch from region")
def static_partition_insert(spark, d):
    def build(t: Table) -> None:
        c = Catalog(spark)
        c.create_table("regions", t.root, "r_regionkey int, r_name string, batch string", ["batch"])
        c.insert("regions", source(spark, d, "region"), static_partition={"batch": "x y=1"})

    return made(spark, d, "static", build).to_df()


@query("select event_id, user_id, event_type from events")
def stream_append_once(spark, d):
    from tablelog.streaming.sink import write_stream

    def build(t: Table) -> None:
        e = source(spark, d, "events").select("event_id", "user_id", "event_type")
        e.repartition(4).write.parquet(f"{t.root}-in")
        for _ in range(2):  # the second run finds nothing to do
            stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(f"{t.root}-in")
            write_stream(stream, t.root, "events", f"{t.root}-checkpoint", partition_by=["event_type"]).awaitTermination()

    return made(spark, d, "streamed", build).to_df()


@query("select c_custkey, c_name from customer")
def stream_source_changes(spark, d):
    from tablelog.streaming.sink import write_stream
    from tablelog.streaming.source import read_stream

    def build(t: Table) -> None:
        c, origin = source(spark, d, "customer").select("c_custkey", "c_name"), Table.for_path(spark, f"{t.root}-origin")
        for k in range(3):
            write.append(origin, c.where(F.col("c_custkey") % 3 == k))
            write_stream(read_stream(spark, origin.root), t.root, "copy", f"{t.root}-checkpoint").awaitTermination()

    return made(spark, d, "copied", build).to_df()


@query("select n_name, count(*) as orders, cast(round(sum(o_totalprice), 2) as decimal(20, 2)) as total from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where o_orderstatus = 'F' group by 1")
def join_agg(spark, d):
    o = _orders(spark, d).scan(E.EqualTo(E.Column("o_orderstatus", _S), E.Literal.of("F"))).rows()
    c, n = source(spark, d, "customer"), source(spark, d, "nation")
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return joined.groupBy("n_name").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).cast("decimal(20,2)").alias("total"))


@query("select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as k from orders) where k <= 2")
def window_topk(spark, d):
    from pyspark.sql import Window

    k = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return _orders(spark, d).to_df().withColumn("k", k).where("k <= 2").select("o_custkey", "o_orderkey", "o_totalprice")


@query("select l_returnflag, l_linestatus, count(*) as n from lineitem group by rollup (l_returnflag, l_linestatus)")
def rollup(spark, d):
    return _lines(spark, d).to_df().rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("select o_custkey from orders where o_orderstatus = 'F' intersect select o_custkey from orders where o_orderstatus = 'O'")
def set_ops(spark, d):
    rows: Callable[[str], DataFrame] = lambda s: _orders(spark, d).scan(E.EqualTo(E.Column("o_orderstatus", _S), E.Literal.of(s))).rows(["o_custkey"])
    return rows("F").intersect(rows("O"))


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')")
def semi_anti(spark, d):
    o = _orders(spark, d).scan(E.EqualTo(E.Column("o_orderstatus", _S), E.Literal.of("P"))).rows(["o_custkey"])
    return _versions(spark, d).to_df(columns=["c_custkey"]).join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query("select c_mktsegment, count(*) as n from customer where c_acctbal > 0 group by 1")
def catalog_sql(spark, d):
    t = _versions(spark, d)
    c = Catalog(spark)
    c.create_table("tl_customers", t.root, t.update().schema)
    return c.sql("select c_mktsegment, count(*) as n from tl_customers where c_acctbal > 0 group by c_mktsegment")


@query("select o_orderkey, o_orderstatus from orders where o_orderstatus in ('F', 'P')")
def data_source_read(spark, d):
    from tablelog.streaming.source import NAME, register

    register(spark)
    return spark.read.format(NAME).load(_orders(spark, d).root).where(F.col("o_orderstatus").isin("F", "P")).select("o_orderkey", "o_orderstatus")


@query("select range::bigint as version, 'WRITE' as operation, true as is_blind_append from range(4)")
def history_operations(spark, d):
    return _versions(spark, d).history().select("version", "operation", "is_blind_append")


@query("select distinct o_orderstatus from orders where o_orderstatus = 'P'")
def tombstones(spark, d):
    delete_partition(spark, d)
    t = made(spark, d, "deleted", lambda _: None)
    return t.update().removed().select(F.regexp_extract("path", "o_orderstatus=([^/]+)/", 1).alias("o_orderstatus")).distinct()


@query("select c_custkey % 4 as _commit_version, count(*) as num_records from customer where c_custkey % 4 >= 1 group by 1")
def change_actions(spark, d):
    added = _versions(spark, d).change_actions(1).where("add is not null")
    return added.groupBy("_commit_version").agg(F.sum(F.from_json("add.stats", "numRecords long").numRecords).alias("num_records"))


@query("select p_partkey as part_key, p_name as name from part")
def column_mapping(spark, d):
    """Files whose columns have other names than the table's."""

    def build(t: Table) -> None:
        source(spark, d, "part").select(F.col("p_partkey").alias("col-1"), F.col("p_name").alias("col-2")).write.parquet(t.root)
        schema = T.StructType([T.StructField("part_key", T.LongType(), True, {"delta.columnMapping.physicalName": "col-1"}), T.StructField("name", _S, True, {"delta.columnMapping.physicalName": "col-2"})])
        write.convert_parquet(spark, t.root, schema)

    return made(spark, d, "mapped", build).to_df()


@query("select o_orderkey, o_orderstatus from orders where o_orderstatus = 'O' and o_totalprice > 100000")
def external_view(spark, d):
    """A read-only view with a declared schema, its names in other case."""
    t, c = _orders(spark, d), Catalog(spark)
    c.create_external_view("tl_orders", t.root, T.StructType([T.StructField(f.name.upper(), f.dataType) for f in t.update().schema.fields]))
    return c.sql("select o_orderkey, o_orderstatus from tl_orders where o_orderstatus = 'O' and o_totalprice > 100000")


@query("select n_nationkey, n_name from nation where n_regionkey <> 2")
def optimistic_commits(spark, d):
    """Two transactions from one version: the append goes through, the overwrite of what changed meanwhile is refused."""
    from tablelog.errors import ConcurrentAppend

    def build(t: Table) -> None:
        n = source(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
        write.append(t, n.where("n_regionkey < 2"))
        late = t.start()
        late.read_whole_table()
        write.append(t, n.where("n_regionkey > 2"))
        try:
            late.commit([f.remove() for f in late.snapshot.files()] + write.write_files(t, n.limit(1), []), "WRITE")
        except ConcurrentAppend:
            return
        raise AssertionError("the late overwrite went through")

    return made(spark, d, "optimistic", build).to_df(columns=["n_nationkey", "n_name"])


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return pushed_plus_residual(spark, d)



from tablelog import scenarios as _scenarios  # noqa: E402,F401  registers the other queries

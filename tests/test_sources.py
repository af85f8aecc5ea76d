"""Readers, sinks, layouts, functions."""

from concurrent.futures import ThreadPoolExecutor
import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimsmith import functions as fn
from dimsmith.session import fresh_path, release, settle, shared_dir, sized_for
from dimsmith.sources import layout, paths, readers, series, sinks
from tests.conftest import tuples


def test_jdbc_options_for_a_parallel_scan():
    options = readers.jdbc_options("jdbc:x", "public.rental", properties={"user": "u"}, split_on="rental_id", lower=1, upper=100, splits=8)
    assert options["dbtable"] == "public.rental" and options["numPartitions"] == "8" and options["user"] == "u"
    assert readers.jdbc_options("jdbc:x", query="select 1")["query"] == "select 1"


@pytest.mark.parametrize(
    "kwargs",
    [{}, {"table": "t", "query": "q"}, {"table": "t", "split_on": "k"}, {"query": "q", "split_on": "k", "lower": 1, "upper": 2, "splits": 2}],
)
def test_jdbc_options_refuse_what_cannot_work(kwargs):
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", **kwargs)


def test_jdbc_write_options():
    options = sinks.jdbc_write_options("jdbc:x", "dim", truncate=True)
    assert options == {"url": "jdbc:x", "dbtable": "dim", "batchsize": "1000", "truncate": "true"}


def test_dump_reader(spark, tmp_path):
    path = tmp_path / "staff.dat"
    path.write_text('1\tTom "T"\t2004-03-02 10:20:30.25\tt\t{Trailers,"Deleted Scenes"}\t$2.99\n2\t\\N\t\\N\tf\t{}\t\\N\n\\.\n\n\n')
    schema = T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField("name", T.StringType()),
            T.StructField("at", T.TimestampNTZType()),
            T.StructField("active", T.BooleanType()),
            T.StructField("features", T.ArrayType(T.StringType())),
            T.StructField("amount", T.StringType()),
        ]
    )
    rows = readers.read_dump(spark, str(path), schema)
    assert tuples(rows) == [
        (1, 'Tom "T"', datetime.datetime(2004, 3, 2, 10, 20, 30, 250000), True, ["Trailers", "Deleted Scenes"], "$2.99"),
        (2, None, None, False, [], None),
    ]


def test_csv_readers(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("id,name\n1,a\n2,b\n")
    assert readers.read_csv(spark, str(path)).dtypes == [("id", "string"), ("name", "string")]
    assert readers.read_csv(spark, str(path), "id long, name string").dtypes[0] == ("id", "bigint")
    assert readers.read_csv_inferred(spark, str(path)).dtypes[0] == ("id", "int")


def test_in_memory(spark):
    assert readers.in_memory(spark, [(1, "a")], ["k", "v"]).columns == ["k", "v"]
    assert readers.in_memory(spark, [(1, "a")], "k int, v string").dtypes[0] == ("k", "int")


def test_series(spark):
    assert series.numbers(spark, 3, 6).count() == 4
    assert tuples(series.days(spark, "2000-02-28", 3)) == [(datetime.date(2000, 2, 28),), (datetime.date(2000, 2, 29),), (datetime.date(2000, 3, 1),)]
    empty = spark.createDataFrame([], "d date")
    assert series.days_spanned(empty, "d").count() == 0


def test_text_output(spark):
    path = fresh_path(spark, "text")
    sinks.write_text(spark.createDataFrame([(1, "  a b "), (2, None)], "k int, v string"), path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["1\ta b", "2\t"]


def test_versioned_table(spark):
    table = sinks.VersionedTable(spark, fresh_path(spark, "versions"))
    with pytest.raises(FileNotFoundError):
        table.read()
    df = spark.createDataFrame([(1,)], "k int")
    for _ in range(3):
        table.write(df if table.current() is None else table.read().select((F.col("k") + 1).alias("k")))
    assert tuples(table.read()) == [(3,)] and tuples(table.read(1)) == [(1,)]
    with pytest.raises(FileExistsError):
        table.write(df, version=2)
    assert table.prune(keep=2) == [1] and table.versions() == [2, 3]
    # A write that died leaves a folder without a marker; readers do not see it and it can be redone.
    broken = f"{table.path}/version=4"
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(broken)
    assert table.current() == 3
    assert table.write(df) == 4


def test_staging_is_idempotent(spark):
    staging = sinks.StagingTable(spark, fresh_path(spark, "staging"))
    df = spark.createDataFrame([(1,), (2,)], "k int")
    for stamp in ("2024-01-01 10:00:00", "2024-01-02 10:00:00", "2024-01-02 10:00:00"):
        staging.load(df, stamp)
    assert tuples(staging.read().groupBy("load_date").count()) == [("2024-01-01 10:00:00", 2), ("2024-01-02 10:00:00", 2)]


def test_change_set(spark):
    base = spark.createDataFrame([(5, "Iris", "Falk"), (6, "Ben", "Kraus")], "id int, first string, last string")
    updates = spark.createDataFrame([(5, "Falk-Roth")], "id int, last string")
    inserts = spark.createDataFrame([(600, "Otto", "M")], "id int, first string, last string")
    assert tuples(sinks.change_set(base, "id", updates, inserts)) == [(5, "Iris", "Falk-Roth"), (6, "Ben", "Kraus"), (600, "Otto", "M")]


def test_partition_pruning_reaches_the_scan(spark):
    path = fresh_path(spark, "pruned")
    df = spark.range(100).select("id", F.date_add(F.lit("1999-01-01").cast("date"), (F.col("id") * 10).cast("int")).alias("d"))
    layout.write_by_year(df, path, "d", years=[1999, 2000])
    scan = layout.read_partition(spark, path, "part_year", "2000")
    assert "PartitionFilters: [isnotnull(part_year" in scan._jdf.queryExecution().executedPlan().toString()
    assert scan.count() == df.filter("year(d) = 2000").count()
    assert {r.part_year for r in layout.read_all(spark, path, "part_year").collect()} == {"1999", "2000", "other"}


def test_bucketed_join_needs_no_shuffle(spark):
    for name in ("left_side", "right_side"):
        layout.write_bucketed_table(spark.range(1000).withColumn(name, F.lit(1)), name, "id", 4)
    joined = spark.table("left_side").hint("merge").join(spark.table("right_side"), "id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 1000


def test_money_and_names(spark):
    df = spark.createDataFrame([("$3.99", "mARTA"), ("free", "x"), (None, None)], "m string, n string")
    got = df.select(fn.money("m"), fn.name_case("n")).collect()
    assert [tuple(r) for r in got] == [(Decimal("3.99"), "Marta"), (None, "X"), (None, None)]


def test_overdue_days(spark):
    day = datetime.date.fromisoformat
    df = spark.createDataFrame([(day("2020-01-01"), day("2020-01-09"), 3), (day("2020-01-01"), day("2020-01-02"), 3), (day("2020-01-01"), None, 3)], "a date, b date, n int")
    assert [r[0] for r in df.select(fn.overdue_days("a", "b", "n")).collect()] == [5, 0, 0]


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def test_sized_for():
    assert sized_for(100 * 1024**4, 4000)["spark.sql.shuffle.partitions"] == "819200"
    assert sized_for(1, 8)["spark.sql.shuffle.partitions"] == "8"


def test_views_by_name(spark, data_dir):
    readers.Tables(spark, data_dir).register_views(["region"])
    assert spark.table("region").count() == 5
    with pytest.raises(AttributeError):
        readers.Tables(spark, data_dir).nothing


def test_settled_copies_are_released(spark):
    release(spark)
    settled = settle(spark.range(3))
    path = settled.inputFiles()[0].rsplit("/", 1)[0]
    assert settled.count() == 3 and paths.exists(spark, path)
    assert release(spark) == 1 and not paths.exists(spark, path)


def test_amounts_and_array_literals(spark):
    amounts = spark.createDataFrame([("$1,234.50",), ("1,2",), ("-12,345,678",), ("$3.99",), ("x",), (None,)], "t string").select(fn.money("t").cast("string").alias("m"))
    assert [r.m for r in amounts.collect()] == ["1234.50", None, "-12345678.00", "3.99", None, None]
    literals = ['{"a,b",c}', "{}", '{Trailers,"Deleted Scenes"}', '{"say \\"x\\"",NULL,"NULL"}', None]
    arrays = spark.createDataFrame([(t,) for t in literals], "t string").select(fn.text_array("t").alias("a"))
    assert [r.a for r in arrays.collect()] == [["a,b", "c"], [], ["Trailers", "Deleted Scenes"], ['say "x"', None, "NULL"], None]


def test_dump_round_trip(spark):
    rows = [(1, "", b"\x00\\n"), (2, None, None), (3, "a\tb\nc\\d\\te\r", b""), (4, "\\N", b"\xff"), (5, "\\\\n", None)]
    df = spark.createDataFrame(rows, "k int, v string, b binary")
    path = fresh_path(spark, "escapes")
    sinks.write_text(df, path, null_text="\\N")
    assert sorted((r.k, r.v, None if r.b is None else bytes(r.b)) for r in readers.read_dump(spark, path, df.schema).collect()) == rows


def test_partition_values_stay_text(spark):
    path = fresh_path(spark, "codes")
    df = spark.createDataFrame([(1, "01"), (2, "02"), (3, "1"), (4, "9")], "k int, code string")
    layout.write_by_list(df, path, "code", ["01", "02", "1"])
    assert tuples(layout.read_all(spark, path, "part_value"), "k", "part_value") == [(1, "01"), (2, "02"), (3, "1"), (4, "other")]
    assert tuples(layout.read_partition(spark, path, "part_value", "01"), "k") == [(1,)]
    assert tuples(layout.read_partition(spark, path, "part_value", 1), "k") == [(3,)]


def test_one_column_dump_keeps_empty_rows(spark, tmp_path):
    rows = [("",), ("a",), (None,), ("",), ("\\",), ("\t",)]
    df = spark.createDataFrame(rows, "v string")
    sinks.write_text(df, f"{tmp_path}/one", null_text="\\N")
    assert sorted(readers.read_dump(spark, f"{tmp_path}/one", df.schema).collect(), key=repr) == sorted(df.collect(), key=repr)
    (tmp_path / "ended.dump").write_text("a\n\nb\n\\.\n\n\nc\n")
    (tmp_path / "open.dump").write_text("\nz\n")
    assert sorted(r.v for r in readers.read_dump(spark, f"{tmp_path}/*.dump", df.schema).collect()) == ["", "", "a", "b", "z"]


def test_bytes_in_a_dump(spark, tmp_path):
    (tmp_path / "bytes.dump").write_text("1\t\\101\\x42\\103x\n2\t\\303\\251\\xC3\\xA9 \\\\101 \\\\x41\n3\t\\0611\\x4Z\\n\\q\n")
    schema = spark.createDataFrame([], "k int, v string").schema
    got = {r.k: r.v for r in readers.read_dump(spark, str(tmp_path / "bytes.dump"), schema).collect()}
    assert got == {1: "ABCx", 2: "éé \\101 \\x41", 3: "11\x04Z\nq"}


def test_load_times_stay_text(spark, tmp_path):
    staging = sinks.StagingTable(spark, f"{tmp_path}/staged")
    for load in ("2024-01-01 00:00:00", "2024-01-01 00:00:00.0", "007"):
        staging.load(spark.range(1), load)
    assert sorted(r.load_date for r in staging.read().collect()) == ["007", "2024-01-01 00:00:00", "2024-01-01 00:00:00.0"]


def test_two_writers_lose_no_row(spark, tmp_path):
    table = sinks.VersionedTable(spark, f"{tmp_path}/shared")
    table.write(spark.range(1))

    def add(number):
        other = sinks.VersionedTable(spark, table.path)
        return other.update(lambda now: now.unionByName(spark.range(number, number + 1)))

    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(add, range(1, 7)))
    assert len(set(versions)) == 6
    assert sorted(r.id for r in table.read().collect()) == list(range(7))


def test_a_claim_of_a_dead_writer_is_passed_over(spark, tmp_path):
    table = sinks.VersionedTable(spark, f"{tmp_path}/claimed")
    assert table._claim(1) and not table._claim(1)
    assert table.update(lambda now: spark.range(3), patience=0.5) == 2
    assert table.write(spark.range(4)) == 3 and table.read().count() == 4

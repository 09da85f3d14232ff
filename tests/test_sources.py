"""Scans, JDBC options, and the DB-API source over a driver that reads the given files."""

from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.sources import dbapi, dialects, jdbc, scans, splits
from tidemark.sources.dbapi import DbApiSource, range_conditions
from tidemark.sources.scans import FrameSource, ParquetSource, TableSpec

SF = "/root/testdata/sf0.001"
SPEC = TableSpec.of("orders", "o_orderkey", cdc_column="o_orderdate")
TYPES = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz"


@pytest.fixture(scope="module")
def driver(spark):
    files = {"orders": f"read_parquet('{SF}/orders.parquet')"}
    return DbApiSource(spark, "duckdb:connect", tables=files, types={"orders": TYPES})


@pytest.fixture(scope="module")
def parquet(spark):
    return ParquetSource(spark, SF)


def test_incremental_is_strict_and_pushed(spark, parquet):
    df = parquet.read(SPEC)
    top = df.agg(F.max("o_orderdate")).first()[0]
    newer = scans.scan_incremental(parquet, SPEC, top)
    assert newer.count() == 0
    assert scans.scan_incremental(parquet, SPEC, None).count() == df.count()
    assert scans.scan_incremental(parquet, SPEC, top, lookback="1 second").count() > 0
    plan = newer._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in plan


def test_no_watermark_column(spark, parquet):
    df = parquet.read(SPEC)
    assert scans.source_max_watermark(df, None).first()[0] is None
    assert scans.newer_than(df, None, "2020-01-01").count() == df.count()


def test_auto_scan_by_size(spark, parquet):
    rows, count = scans.scan_auto(parquet, SPEC, threshold=10)
    assert rows.count() == count == parquet.read(SPEC).count()


def test_paged_with_repeated_and_null_keys(spark):
    """A third of the rows share one key; pages stay full and in key order."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 != 1, F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    paged = scans.scan_paged(df, ["k"], 250)
    sizes = {r["page"]: r["n"] for r in paged.groupBy("page").agg(F.count("*").alias("n")).collect()}
    assert sizes == {i: 250 for i in range(12)}
    assert paged.select("k", "v").exceptAll(df).isEmpty()
    edges = paged.groupBy("page").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("page").collect()
    known = [e for e in edges if e["lo"] is not None]
    assert all(a["hi"] <= b["lo"] for a, b in zip(known, known[1:]))


def test_ranges_are_disjoint_and_complete(spark):
    df = spark.range(-50, 500).selectExpr("CASE WHEN id <> 7 THEN id END AS k")
    counts = [df.filter(r).count() for r in scans.range_filters("k", 0, 400, 4)]
    assert counts == [150, 100, 100, 200]
    source = scans.FrameSource({"t": df})
    for parts in (1, 3, 4):
        read = source.read_ranges(scans.TableSpec.of("t", "k", num_partitions=parts), 0, 400)
        assert sorted(map(str, read.collect())) == sorted(map(str, df.collect()))


def test_range_conditions():
    assert range_conditions("k", 0, 100, 1, "?") == [("", [])]
    got = range_conditions("k", 0, 100, 4, "?")
    assert got[0] == ("(k < ? OR k IS NULL)", [25])
    assert got[1] == ("(k >= ? AND k < ?)", [25, 50])
    assert got[-1] == ("k >= ?", [75])


def test_dialects():
    assert dialects.dialect_of("psycopg2").jdbc_url("h", 5432, "d") == "jdbc:postgresql://h:5432/d?sslmode=require"
    assert dialects.dialect_of("mssql").quoted("a]b", "c") == "[a]]b].[c]"
    assert dialects.dialect_of("pymysql").quoted("a`b") == "`a``b`"
    with pytest.raises(ValueError, match="unknown driver 'oracledb'"):
        dialects.dialect_of("oracledb")


def test_jdbc_options():
    spec = TableSpec.of("orders", "id, line", num_partitions=8, fetch_size=10)
    postgres = dialects.dialect_of("psycopg2")
    options = jdbc.read_options(postgres, "jdbc:x", "public", spec)
    assert options["dbtable"] == '"public"."orders"' and options["fetchsize"] == "10"
    ranges = jdbc.range_options(spec, 5, 90)
    assert ranges == {"partitionColumn": "id", "lowerBound": "5", "upperBound": "90", "numPartitions": "8"}
    with pytest.raises(ValueError):
        jdbc.range_options(TableSpec.of("t"), 0, 1)


def test_jdbc_probe():
    postgres = dialects.dialect_of("psycopg2")
    assert jdbc.probe_query(postgres, '"a"."b"', "id") == (
        'SELECT COUNT(*) AS cnt, MIN("id") AS lo, MAX("id") AS hi FROM "a"."b"'
    )


def test_jdbc_span_predicates():
    postgres = dialects.dialect_of("psycopg2")
    one = ((1,), (1,))
    assert jdbc.span_predicates(postgres, ["id"], [one, ((5,), (9,)), ((12,), (12,))], [False], 2) == [
        '("id" = 1) OR ("id" = 12)',
        '((("id" >= 5)) AND (("id" <= 9)))',
    ]
    pair = (("it's", 1), ("it's", 1))
    assert jdbc.span_predicates(postgres, ["a", "b"], [pair], [True, False], 4) == ["(\"a\" = 'it''s' AND \"b\" = 1)"]
    text = jdbc.span_predicates(postgres, ["a"], [(("a",), ("b",))], [True], 4)[0]
    assert text == '(((CAST("a" AS text) COLLATE "C" >= \'a\')) AND ((CAST("a" AS text) COLLATE "C" <= \'b\')))'
    sql_server, mysql = dialects.dialect_of("mssql"), dialects.dialect_of("mysql")
    for dialect, literal in ((postgres, "'\\x00ff'::bytea"), (sql_server, "0x00ff"), (mysql, "x'00ff'")):
        assert literal in jdbc.span_predicates(dialect, ["k"], [((b"\x00\xff",), (b"\x00\xff",))], [False], 1)[0]
    assert mysql.literal("a\\'b") == "'a\\\\''b'" and sql_server.literal(True) == "1"


@pytest.mark.parametrize(
    "kind, value",
    [
        ("bigint", "id * 37 % 5003"),
        ("string", "concat('k', id * 37 % 5003)"),
        ("binary", "CAST(concat('k', id * 37 % 5003) AS BINARY)"),
        ("date", "date_add(DATE '2000-01-01', CAST(id * 37 % 5003 AS INT))"),
    ],
)
@pytest.mark.parametrize("wanted", [7, 900])
def test_spans_hold_the_wanted_keys_and_skip_most_others(spark, kind, value, wanted):
    """The same way for few and many keys of any type; checked by a database reading the conditions."""
    import duckdb

    keys = spark.range(wanted).select(F.expr(value).alias("k"))
    spans = splits.key_spans(keys, ["k"], 64)
    assert len(spans) <= 64 and all(len(s) == 2 for s in spans)
    params = []
    text = " OR ".join(
        t for low, high in spans for t, p in [splits.span_condition(["k"], ["k"], low, high, lambda v: ("?", [v]))] if params.extend(p) is None
    )
    connection = duckdb.connect()
    duck = {"bigint": "BIGINT", "string": "VARCHAR", "binary": "BLOB", "date": "DATE"}[kind]
    connection.execute(f"CREATE TABLE t (k {duck})")
    rows = [[bytes(r[0]) if kind == "binary" else r[0]] for r in spark.range(5003).select(F.expr(value)).collect()]
    connection.executemany("INSERT INTO t VALUES (?)", rows[:3000])
    params = [bytes(p) if kind == "binary" else p for p in params]
    got = {r[0] for r in connection.execute(f"SELECT k FROM t WHERE {text}", params).fetchall()}
    want = {bytes(r[0]) if kind == "binary" else r[0] for r in keys.collect()}
    assert want <= got
    if wanted == 7:
        assert got == want


def test_composite_spans(spark):
    import duckdb

    keys = spark.range(300).selectExpr("id % 7 AS a", "concat('b', id) AS b")
    spans = splits.key_spans(keys, ["a", "b"], 16)
    connection = duckdb.connect()
    connection.execute("CREATE TABLE t AS SELECT i % 7 AS a, 'b' || i AS b FROM range(900) r(i)")
    found = set()
    for low, high in spans:
        text, params = splits.span_condition(["a", "b"], ["a", "b"], low, high, lambda v: ("?", [v]))
        found |= set(connection.execute(f"SELECT a, b FROM t WHERE {text}", params).fetchall())
    assert {tuple(r) for r in keys.collect()} <= found and len(found) < 900


# --- parts of equal size --------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 2, 5, 16])
@pytest.mark.parametrize(
    "columns, types, rows",
    [
        (["k"], "k BIGINT", "i * i * i"),  # values lie ever further apart
        (["k"], "k VARCHAR", "'key ' || (i * 7919 % 1000)"),
        (["k"], "k UUID", "md5(i::VARCHAR)::UUID"),
        (["k"], "k DATE", "DATE '2020-01-01' + i::INT"),
        (["k"], "k TIMESTAMP", "TIMESTAMP '2020-01-01' + INTERVAL (i * i) SECOND"),
        (["k"], "k DECIMAL(20,4)", "i * 1.25"),
        (["a", "b"], "a INT, b VARCHAR", "CASE WHEN i % 3 = 0 THEN 1 ELSE i % 50 END, 'v' || i"),
        (["k"], "k BIGINT", "CASE WHEN i % 50 = 0 THEN NULL ELSE i END"),
    ],
)
def test_parts_are_disjoint_complete_and_even(parts, columns, types, rows):
    import duckdb

    connection = duckdb.connect()
    connection.execute(f"CREATE TABLE t ({types})")
    connection.execute(f"INSERT INTO t SELECT {rows} FROM range(1000) r(i)")
    sql = splits.ends_sql(columns, "t", 1000, parts)
    ends = connection.execute(sql).fetchall() if sql else []
    sizes = []
    for text, values in splits.conditions(columns, ends, lambda v: ("?", [v])):
        where = f" WHERE {text}" if text else ""
        sizes.append(connection.execute(f"SELECT count(*) FROM t{where}", values).fetchone()[0])
    assert sum(sizes) == 1000 and len(sizes) <= parts
    assert max(sizes) <= 2 * 1000 / parts


def test_ends_are_taken_once_and_counted_from_the_rows():
    assert splits.ends_sql(["k"], "t", 0, 4) is None and splits.ends_sql(["k"], "t", 100, 1) is None
    assert "row_no IN (25, 50, 75)" in splits.ends_sql(["k"], "t", 100, 4)
    assert len(splits.conditions(["k"], [(5,), (5,), (9,)], lambda v: ("?", [v]))) == 3
    assert [splits.parts_for(n, 4) for n in (0, 10**6, 10**7, 10**12)] == [4, 4, 40, 512]


@pytest.mark.parametrize(
    "kind, lower, upper",
    [
        ("DATE", date(2020, 1, 1), date(2020, 1, 3)),
        ("DATE", date(2020, 1, 1), date(2022, 1, 1)),
        ("TIMESTAMP_NTZ", datetime(2020, 1, 1), datetime(2021, 6, 1)),
        ("DECIMAL(10,2)", Decimal("0.50"), Decimal("900.25")),
    ],
)
def test_ranges_of_other_types(spark, kind, lower, upper):
    value = "id + 0.5" if kind.startswith("DEC") else "date_add(DATE '2019-12-01', CAST(id AS INT))"
    df = spark.range(900).selectExpr(f"CAST(CASE WHEN id <> 5 THEN {value} END AS {kind}) AS k")
    counts = [df.filter(r).count() for r in scans.range_filters("k", lower, upper, 4)]
    assert sum(counts) == 900 and len(counts) == 4


# --- DB-API ---------------------------------------------------------------------------


def test_dbapi_reads_like_parquet(driver, parquet):
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    want = parquet.read(SPEC).select(*columns)
    got = driver.read(SPEC)
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()


def test_dbapi_ranges(driver, parquet):
    spec = TableSpec.of("orders", "o_orderkey", num_partitions=4, fetch_size=100)
    ranged = driver.read_ranges(spec, 100, 1000)
    assert ranged.rdd.getNumPartitions() == 4
    assert ranged.count() == parquet.read(SPEC).count()  # bounds drop nothing


def test_dbapi_auto_scan(driver, parquet):
    spec = TableSpec.of("orders", "o_orderkey", cdc_column="o_orderdate", num_partitions=3)
    rows, count = scans.scan_auto(driver, spec, threshold=10)
    assert (rows.rdd.getNumPartitions(), count) == (3, parquet.read(SPEC).count())
    by_date = TableSpec.of("orders", "o_orderkey", partition_column="o_orderdate")
    assert scans.scan_auto(driver, by_date, threshold=10)[0].count() == count
    assert scans.scan_auto(driver, spec)[0].rdd.getNumPartitions() == 1


def test_auto_scan_of_a_text_key(spark):
    df = spark.range(100).selectExpr("concat('k', id) AS k")
    rows, count = scans.scan_auto(FrameSource({"t": df}), TableSpec.of("t", "k"), threshold=10)
    assert rows.count() == count == 100


def test_dbapi_pushes_the_watermark(driver, parquet):
    mark = "1999-01-01 00:00:00"
    got = scans.scan_incremental(driver, SPEC, mark)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("RuntimeFilters", "")
    assert got.count() == scans.scan_incremental(parquet, SPEC, mark).count()


def test_dbapi_key_lookup(spark, driver, parquet):
    keys = spark.range(0, 1200).selectExpr("id * 2 AS o_orderkey")
    got = driver.read_keys(SPEC, keys)
    want = parquet.read_keys(SPEC, keys)
    assert got.count() == want.count() > 500


def test_dbapi_composite_key_lookup(spark, driver, parquet):
    spec = TableSpec.of("orders", "o_orderkey, o_custkey")
    keys = parquet.read(SPEC).select("o_orderkey", "o_custkey").filter("o_orderkey < 40")
    assert driver.read_keys(spec, keys).count() == keys.count()


def test_dbapi_columns_from_the_catalog(spark, monkeypatch):
    monkeypatch.syspath_prepend(str(Path(__file__).parent))
    source = DbApiSource(spark, "catalog_driver:connect")
    spec = TableSpec.of("orders", "id")
    assert [n for n, _ in source.columns(spec)] == ["id", "total", "note", "updated_at"]
    assert source.spark_schema(spec) == (
        "`id` int, `total` decimal(38,10), `note` string, `updated_at` timestamp_ntz"
    )
    with pytest.raises(LookupError, match="public.nothing"):
        source.columns(TableSpec.of("nothing"))


def test_one_catalog_read_for_many_tables(spark, monkeypatch):
    monkeypatch.syspath_prepend(str(Path(__file__).parent))
    import catalog_driver

    source = DbApiSource(spark, "catalog_driver:connect")
    catalog_driver.ASKED.clear()
    specs = [TableSpec.of(n, "id") for n in ("orders", "people", "gone")]
    found = scans.columns_by_table(source, specs)
    assert len(catalog_driver.ASKED) == 1
    assert found["people"] == [("id", "uuid"), ("born", "date")] and len(found["orders"]) == 4
    assert isinstance(found["gone"], LookupError)
    assert source.spark_schema(specs[1]) == "`id` string, `born` date"
    own = scans.columns_by_table(FrameSource({"people": spark.range(1)}), specs)
    assert own["people"] == [("id", "bigint")] and isinstance(own["orders"], LookupError)


@pytest.mark.parametrize(
    "driver, quotes, schema, name",
    [
        ("psycopg2:connect", '""', "public", '"public"."t"'),
        ("pymssql:connect", "[]", "dbo", "[dbo].[t]"),
        ("pymysql:connect", "``", None, "`t`"),
        ("duckdb:connect", '""', "public", '"public"."t"'),
    ],
)
def test_dbapi_dialects(spark, driver, quotes, schema, name):
    source = DbApiSource(spark, driver)
    assert (source.quotes, source.schema, source._from(TableSpec.of("t"))) == (quotes, schema, name)
    assert DbApiSource(spark, driver, schema="own", quotes='""').schema == "own"


def test_dbapi_values_of_other_types(spark, tmp_path):
    """uuid, json, time, interval, bit and high-scale numbers, through Spark."""
    import duckdb

    path = tmp_path / "odd.parquet"
    duckdb.connect().execute(
        "COPY (SELECT 1 AS id, '0b6f3a52-7f39-4c1c-9a4c-0123456789ab'::UUID AS u, "
        "TIME '01:02:03' AS t, 1.5::DOUBLE AS d, true AS b, 'ab'::BLOB AS x) TO '" + str(path) + "' (FORMAT parquet)"
    )
    types = "id int, u string, t string, d decimal(38,10), b boolean, x binary"
    source = DbApiSource(spark, "duckdb:connect", tables={"odd": f"read_parquet('{path}')"}, types={"odd": types})
    row = source.read(TableSpec.of("odd", "id")).first()
    assert (row["u"], row["t"]) == ("0b6f3a52-7f39-4c1c-9a4c-0123456789ab", "01:02:03")
    assert (row["d"], row["b"], bytes(row["x"])) == (Decimal("1.5"), True, b"ab")
    assert dbapi._converted([{"a": [1]}, [1, 2], None, "x"], pa.string()) == ['{"a": [1]}', "[1, 2]", None, "x"]
    assert dbapi._converted([b"\x01", b"\x00", None, 1], pa.bool_()) == [True, False, None, True]


def test_missing_frame():
    with pytest.raises(LookupError):
        FrameSource({}).read(SPEC)


def test_work_folder_on_a_cluster_must_be_named(spark, monkeypatch):
    assert scans.work_folder(spark) == spark.conf.get("spark.checkpoint.dir")

    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scans.work_folder(Session())

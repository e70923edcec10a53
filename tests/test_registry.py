import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import registry
from tablewright import normalize, scan_csv, write_csv
from tablewright.operators import profile as pf
from tablewright.sources.files import scratch_path


def plan(df, part="executedPlan"):
    return getattr(df._jdf.queryExecution(), part)().toString()


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("given") / "orders.parquet")
    spark.range(200).selectExpr(
        "id AS o_orderkey", "id / 7 AS o_totalprice", "CAST(id AS STRING) AS o_note",
        "CASE WHEN id > 50 THEN 'x' ELSE 'y' END AS o_status", "'2024-01-05' AS o_date",
    ).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_contract():
    queries, sql = registry.QUERIES, registry.ORACLES
    assert set(queries) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())
    assert set(sql) == set(queries)
    prefixes = {re.match(r"[a-z]\d+", n).group() for n in queries}
    items = {f"s{i}" for i in (1, 2, 3, 4, 5, 6, 7, 8, 10, 11, 12)} | {f"n{i}" for i in range(1, 16)}
    items |= {f"r{i}" for i in range(1, 9)} | {f"q{i}" for i in range(1, 16)} | {"p1", "p2"}
    assert prefixes == items


def test_the_profile_reads_only_columns_in_question(orders, monkeypatch):
    asked = []
    real = pf.gather
    monkeypatch.setattr(pf, "gather", lambda df, wanted: asked.append(list(wanted)) or real(df, wanted))
    done = normalize(orders, order_by=["o_orderkey"])
    # only the double column: texts, integers and dates without offsets need no pass over the table
    assert asked == [["c1"]]
    assert done.data.columns == orders.columns
    pruned = plan(done.data.select("o_totalprice"))
    assert "ReadSchema: struct<o_totalprice:double>" in pruned


def test_filters_reach_the_scan(orders):
    found = orders.filter((F.col("o_status") == "x") & (F.col("o_totalprice") > 3)).select("o_orderkey")
    assert re.search(r"PushedFilters: \[.*EqualTo\(o_status,x\).*GreaterThan\(o_totalprice,3.0\)", plan(found))


def test_first_values_open_one_file(spark, orders):
    head = pf.first_file(orders)
    assert head.select("_metadata.file_path").distinct().count() == 1
    assert "file_path" in plan(head) and 0 < head.count() < orders.count()
    assert pf.first_file(spark.range(3)) is None


def test_a_head_without_values_falls_back_to_the_table(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "p0.csv").write_text("k,,d_date\n" + "".join(f"{i},,\n" for i in range(5)))
    (folder / "p1.csv").write_text("k,,d_date\n5,12 Oak Street,01/06/2024\n6,x,2024-01-05\n")
    done = normalize(scan_csv(spark, str(folder)), untyped=True)
    assert done.columns == ["k", "address_2", "d_date"]
    assert [tuple(r) for r in done.data.filter("k > 4").orderBy("k").collect()] == [
        (5, "12 Oak Street", "2024-01-06"), (6, "x", None)]


@pytest.mark.parametrize("early_bytes", [0, 32 << 20])
def test_text_after_the_first_thousand_rows_still_counts(spark, tmp_path, monkeypatch, early_bytes):
    monkeypatch.setattr(pf, "EARLY_BYTES", early_bytes)
    path = tmp_path / "late.csv"
    path.write_text("a,b,c\n" + "".join(f"{i},{i}.5,True\n" for i in range(3000)) + "x,y,1\n")
    done = normalize(scan_csv(spark, str(path)), untyped=True)
    assert [t for _, t in done.data.dtypes] == ["string"] * 3
    path.write_text("a,b\n" + "".join(f"{i},{i}.5\n" for i in range(3000)) + "0.5,7\n")
    done = normalize(scan_csv(spark, str(path)), untyped=True)
    assert [t for _, t in done.data.dtypes] == ["double"] * 2


def test_headers_that_differ_in_case_only(spark, tmp_path):
    path = tmp_path / "case.csv"
    path.write_text("A,a,A\n1,2,x\n")
    done = normalize(scan_csv(spark, str(path)), untyped=True)
    assert done.columns == ["A", "a_2", "A_1"]
    assert [tuple(r) for r in done.data.collect()] == [(1, 2, "x")]


def test_one_value_holding_a_third_of_the_rows(spark, tmp_path):
    df = spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS k", "id AS n", "id / 4 AS v"
    ).repartition(6)
    out = str(tmp_path / "skew.csv")
    write_csv(df, out)
    back = normalize(scan_csv(spark, out), untyped=True)
    assert back.data.filter("k = 'hot'").count() == 3000
    assert back.data.agg(F.sum("n"), F.sum("v")).first() == df.agg(F.sum("n"), F.sum("v")).first()


def test_scratch_is_shared_or_refused(spark):
    assert scratch_path(spark, "x", ".csv").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_unnamed_columns_are_looked_at_in_one_scan(orders):
    together = pf._first_together(orders, orders.columns, ["o_orderkey"], 10)
    assert plan(together).count("FileScan") == 1
    apart = pf._first_of_each(orders, orders.columns, ["o_orderkey"], 10)
    assert sorted(map(tuple, together.collect())) == sorted(map(tuple, apart.collect()))


def test_known_counts_are_not_counted_again(orders):
    from tablewright import column_catalog

    tables = {"a": orders, "b": orders.limit(7)}
    assert plan(column_catalog(tables, known_rows={"a": 200, "b": 7})).count("FileScan") == 0
    assert {r.num_rows for r in column_catalog(tables, known_rows={"a": 200}).collect()} == {200, 7}

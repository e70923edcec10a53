from datetime import datetime

import pytest
from rows import values

from tablewright import normalize
from tablewright.functions import names
from tablewright.functions.dates import guess_layout


def column(spark, cells, kind="string", name="a", **options):
    rows = [(i, c) for i, c in enumerate(cells)]
    df = spark.createDataFrame(rows, f"k long, `{name}` {kind}").repartition(4)
    done = normalize(df, order_by=["k"], **options)
    return [r[1] for r in done.data.orderBy("k").collect()], done.data.dtypes[1]


def test_header_cleanup():
    given = ["a b", "a_b", "a.b", " x-y ", "l\nm", "a  b\t"]
    assert [names.identifier(names.clean_header(g)) for g in given] == ["a_b", "a_b", "a_b", "x_y", "l_m", "a_b"]
    assert names.distinct_names(["a_b", "a_b", "a_b"]) == ["a_b", "a_b_1", "a_b_2"]
    assert names.distinct_names(["A", "a", "a_1"]) == ["A", "a_2", "a_1"]
    assert all(names.lacks_name(n) for n in ["", "nan", "Unnamed: 3", "COLUMN_1"])
    assert not names.lacks_name("name")


def test_text_cleaning(spark):
    cells, kind = column(spark, ["x\r\ny\tz\x00w", "", "  ", "\r\x00\n", None, "\r\t"])
    assert cells == ["x y zw", None, "  ", " ", None, "  "]
    assert kind == ("a", "string")


@pytest.mark.parametrize(
    "cells, expected",
    [
        (["2024-01-05", "01/06/2024", "Jan 7 2024", None], ["2024-01-05", None, None, None]),
        (["01/06/2024", "13/06/2024", "2024-01-05"], ["2024-01-06", None, None]),
        (["13/06/2024", "01/06/2024"], ["2024-06-13", "2024-06-01"]),
        (["2024-01-05 23:59:59", "2024-01-06", "2024-01-07T01:02:03"], ["2024-01-05", None, None]),
        (["2024-01-05", "2024-01-06 10:00:00", "2024-1-7"], ["2024-01-05", None, "2024-01-07"]),
        (["junk", "2024-01-05", "01/06/2024", "Jan 7 2024", "13/06/2024"],
         [None, "2024-01-05", "2024-01-06", "2024-01-07", "2024-06-13"]),
        (["2024-01-05T23:00:00Z", "2024-01-06T01:00:00+02:00"],
         ["2024-01-05T23:00:00Z", "2024-01-06T01:00:00+02:00"]),
        (["2024-01-05T23:00:00+02:00", "2024-01-06T23:30:00+02:00", "x"], ["2024-01-05", "2024-01-06", None]),
        (["2024-01-05T10:00:00Z", "2024-01-05T10:00:00+00:00", "2024-01-05T10:00:00", "2024-01-05T10:00:00.5Z"],
         ["2024-01-05", "2024-01-05", None, None]),
        (["2024-01-05", "9999-12-31", "1500-01-01", "1677-09-21", "1677-09-22", "2262-04-11", "2262-04-12"],
         ["2024-01-05", None, None, None, "1677-09-22", "2262-04-11", None]),
        (["20240105", "20240106", "2024-01-05"], ["2024-01-05", "2024-01-06", None]),
        (["2024-01-05 10:00:00", "2024-01-05 10:00", "2024-01-05", "2024-01-05 10:00:00.5", "2024-1-5 1:2:3"],
         ["2024-01-05", None, None, None, "2024-01-05"]),
        ([None, None], [None, None]),
    ],
)
def test_dates_by_name(spark, cells, expected):
    assert column(spark, cells, name="d_date")[0] == expected


@pytest.mark.parametrize(
    "value",
    ["2024-01-05", "2024/1/5", "01/06/2024", "13-06-2024", "13.06.2024", "Jan 7 2024", "Jan 7, 2024",
     "January 7, 2024", "7 Jan 2024", "07-Jan-2024", "7 January 2024", "2024-01-05 10:00",
     "2024-01-05 10:00:00.123456", "2024-01-05T10:00:00.123Z", "2024-01-05 10:00:00+0200",
     "01/06/2024 10:30:15 AM", "2024-01-05 10", "2024-01", "2024-Jan-07"],
)
def test_a_layout_reads_its_own_value(spark, value):
    assert guess_layout(value) is not None
    assert column(spark, [value], name="time")[0][0].startswith("2024-")


def test_numbers_in_date_columns(spark):
    assert column(spark, [20240105, None], "long", "d_date")[0] == [20240105, 0]
    assert column(spark, [20240105, 1704412800], "long", "d_date", compat=True)[0] == ["1970-01-01", "1970-01-01"]
    assert column(spark, [1704412800000000000, None, -1], "long", "d_date", compat=True)[0] == [
        "2024-01-05", None, "1969-12-31"]
    assert column(spark, [1.5e18, None, float("inf")], "double", "d_date", compat=True)[0] == ["2017-07-14", None, None]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_timestamps(spark, kind):
    cells, _ = column(
        spark,
        [datetime(2024, 1, 5), datetime(2024, 1, 6, 10), None, datetime(2024, 1, 7, 0, 0, 0, 500000),
         datetime(2024, 1, 7, 1, 2, 3, 4)],
        kind,
    )
    assert cells == ["2024-01-05", "2024-01-06 10:00:00", None, "2024-01-07", "2024-01-07 01:02:03"]


def test_booleans(spark):
    assert column(spark, [True, None, False], "boolean")[0] == ["True", None, "False"]
    assert column(spark, ["true", None, "FALSE"], untyped=True)[0] == ["True", None, "False"]


@pytest.mark.parametrize(
    "cells, kind, options, expected, expected_kind",
    [
        ([1.0, None, 3.0], "double", {}, [1, 0, 3], "bigint"),
        ([1.0, 2.5, None, float("nan")], "double", {}, [1.0, 2.5, 0.0, 0.0], "double"),
        ([None, None], "double", {}, [0, 0], "bigint"),
        ([1.0, float("inf")], "double", {}, [1.0, float("inf")], "double"),
        ([1.0, 1e30], "double", {}, [1.0, 1e30], "double"),
        ([1, None], "int", {}, [1, 0], "bigint"),
        ([1.0, 2.0], "float", {}, [1, 2], "bigint"),
        (["1", None, "3"], "string", {"untyped": True}, [1, 0, 3], "bigint"),
        ([None, None], "string", {"untyped": True}, [0, 0], "bigint"),
        ([None, None], "string", {}, [None, None], "string"),
        (["01234", "2"], "string", {"untyped": True}, [1234, 2], "bigint"),
        (["01234", "2"], "string", {"untyped": True, "keep_text": ["a"]}, ["01234", "2"], "string"),
        (["1", "x", "2.0", "True"], "string", {"untyped": True}, ["1", "x", "2.0", "True"], "string"),
    ],
)
def test_numbers(spark, cells, kind, options, expected, expected_kind):
    got, (_, got_kind) = column(spark, cells, kind, **options)
    assert got == expected and got_kind == expected_kind


def test_decimals_follow_the_number_rule(spark):
    df = spark.sql("SELECT CAST(1.50 AS DECIMAL(10,2)) a, CAST(2.00 AS DECIMAL(10,2)) b, CAST(NULL AS DECIMAL(10,0)) c")
    assert normalize(df).data.dtypes == [("a", "double"), ("b", "bigint"), ("c", "bigint")]


@pytest.mark.parametrize(
    "cells, kind, name",
    [
        (["https://x.org/a"], "string", "url_1"),
        ([5000, 7000], "long", "amount_1"),
        ([1000, 1001], "long", "amount_1"),
        ([999, 1001], "long", "value_1"),
        ([1, 2], "long", "value_1"),
        (["12 Oak Street"], "string", "address_1"),
        ([None], "string", "column_1"),
        (["grand hotel"], "string", "phone_1"),
        (["a note"], "string", "description_1"),
        (["first name"], "string", "name_1"),
        (["2024-01-05"], "string", "date_1"),
        (["2024-01-05 and much more"], "string", "field_1"),
        (["abc"], "string", "field_1"),
        ([datetime(2024, 1, 5)], "timestamp", "date_1"),
        ([datetime(2024, 1, 5), datetime(2024, 1, 6, 10)], "timestamp", "field_1"),
    ],
)
def test_names_for_unnamed_columns(spark, cells, kind, name):
    rows = [(c, i) for i, c in enumerate(cells)]
    df = spark.createDataFrame(rows, f"`Unnamed: 0` {kind}, k long")
    assert normalize(df, order_by=["k"]).columns == [name, "k"]


def test_only_the_first_ten_values_name_a_column(spark):
    rows = [(i, None if i < 50 else "plain" if i < 60 else "a street") for i in range(100)]
    df = spark.createDataFrame(rows, "k long, `nan` string").repartition(5)
    assert normalize(df, order_by=["k"]).columns == ["k", "field_2"]


def test_sheet_tables_lose_empty_rows_and_columns(spark):
    df = spark.createDataFrame(
        [(None, None, None), (1.0, None, "x"), (float("nan"), None, None)], "a double, b string, `Unnamed: 2` string"
    )
    done = normalize(df, drop_empty=True)
    assert done.rows == 1 and done.columns == ["a", "field_2"]
    assert values(done.data) == [(1, "x")]
    assert normalize(df.limit(0), drop_empty=True).is_empty


def test_normalizing_twice_changes_nothing(spark):
    df = spark.createDataFrame(
        [(1.5, "a\tb", "2024-01-05", True, 3), (None, "", None, None, None)],
        "n double, t string, `the date` string, b boolean, i int",
    )
    once = normalize(df).data
    assert values(normalize(once).data) == values(once)


def test_report(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "`a b` long, c string")
    assert values(normalize(df).report("t")) == [("t", 2, 2, ["a_b", "c"])]


def test_plans_have_no_python_and_read_only_what_they_need(spark, tmp_path):
    path = str(tmp_path / "p.parquet")
    spark.range(100).selectExpr(
        "id", "id / 3 AS f", "CAST(id AS STRING) AS t", "CAST(id AS STRING) AS d_date"
    ).write.parquet(path)
    plan = normalize(spark.read.parquet(path)).data._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


LISTED = [
    "2024", "Jan 2024", "1/2024", "05/Jan/2024", "5-Jan-24", "20240105T101112", "20240105 101112", "2024-01-05 10:00:00 UTC",
    "2024-01-05 10:00:00+02", "Fri, 05 Jan 2024", "Friday, January 5, 2024", "january 2024", "2024-01-05T10:00:00 GMT",
]


@pytest.mark.parametrize("first", [True, False])
def test_dates_read_as_pandas_reads_them(spark, first):
    """Each text as the first value of its column, and behind one that is no date."""
    pandas = pytest.importorskip("pandas")
    for part in (LISTED[:5], LISTED[5:10], LISTED[10:]):
        rows = [tuple(part)] if first else [("junk",) * len(part), tuple(part)]
        df = spark.createDataFrame(rows, ", ".join(f"d{i}_date string" for i in range(len(part))))
        got = normalize(df).data.collect()[-1]
        for text, value in zip(part, got):
            assert value == pandas.Timestamp(text).strftime("%Y-%m-%d"), (text, value)

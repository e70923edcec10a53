import json
from datetime import date

from rows import values
from pyspark.sql import functions as F

from tablewright import answer, digest
from tablewright.functions.text import safe_number
from tablewright.operators import questions as q


def people(spark):
    return spark.createDataFrame(
        [("x", 1, 2.5), ("y", 2, 1.0), ("x", 3, 4.0), ("z", 4, 1.0), ("y", 5, 9.0)], "g string, k long, v double"
    )


def test_shapes(spark):
    df = people(spark)
    assert values(q.top_groups(df, "g", 2)) == [("x", 2), ("y", 2)]
    assert sorted(values(q.count_by(df, "g", "n"))) == [("x", 2), ("y", 2), ("z", 1)]
    assert sorted(values(q.average_by(df, "g", "v", "a"))) == [("x", 3.25), ("y", 5.0), ("z", 1.0)]
    assert sorted(values(q.sum_by(df, "g", "v", "s"))) == [("x", 6.5), ("y", 10.0), ("z", 1.0)]
    assert values(q.highest_groups(df, "g", "v", 2, "m")) == [("y", 9.0), ("x", 4.0)]
    assert values(q.top_rows(df, "v", "k", 2)) == [("y", 5, 9.0), ("x", 3, 4.0)]
    assert values(q.first_rows(df, "k", 1)) == [("x", 1, 2.5)]
    assert values(q.filtered_average(df, F.col("g") == "x", "v", "a")) == [(3.25,)]


def test_safe_number(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "s string")
    assert values(df.select(safe_number(F.col("s")))) == [(1.5,), (None,), (None,)]


def test_cap_follows_the_text(spark):
    df = spark.range(20)
    for own in ("", " -- limit 5", " /* limit 5 */"):
        assert q.capped(df, f"SELECT * FROM range(20){own}", 5).count() == 5
    assert q.capped(df, "SELECT * FROM range(20) WHERE 'x limit 5' <> '' ", 5).count() == 5
    assert q.capped(df, "SELECT * FROM (SELECT * FROM range(20) LIMIT 12)", 5).count() == 5
    assert q.capped(df, "WITH t AS (SELECT * FROM range(20) LIMIT 3) SELECT * FROM t", 5).count() == 5
    for own in ("LIMIT 12", "\nlimit 12 ;", "ORDER BY id LIMIT 3 + 4", "LIMIT 5 OFFSET 2", "LIMIT 4 -- all"):
        assert q.capped(df, f"SELECT * FROM range(20) {own}", 5).count() == 20
    assert q.capped(df, "WITH t AS (SELECT * FROM range(20)) SELECT * FROM t ORDER BY id LIMIT 4", 5).count() == 20


def test_digest_layout(spark):
    rows = [(1, "a\"b\n", 1.5, None, date(2024, 1, 5), True)]
    df = spark.createDataFrame(rows, "i long, t string, d double, n string, w date, b boolean")
    plain = [dict(zip(df.columns, r)) for r in rows]
    assert digest(df).first().digest == json.dumps(plain, indent=2, default=str)
    few = spark.range(5).orderBy("id")
    assert digest(few).first().digest == json.dumps([{"id": i} for i in range(5)], indent=2)
    many = spark.range(700).orderBy(F.desc("id"))
    first = json.dumps([{"id": 699 - i} for i in range(5)], indent=2)
    assert values(digest(many)) == [(700, f"First 5 rows:\n{first}\n\nTotal rows: 700")]
    assert values(digest(spark.range(0))) == [(0, "No results found.")]


def test_answers(spark):
    tables = {"people": people(spark)}
    done = answer(spark, "SELECT g, count(*) AS n FROM people GROUP BY g ORDER BY g", tables=tables)
    assert done.success and done.row_count == 3 and done.data[0] == {"g": "x", "n": 2}
    assert done.digest.startswith("[")
    big = answer(spark, "rows?", to_sql=lambda text: "SELECT id FROM range(5000)")
    assert big.row_count == 5000 and len(big.data) == 100 and "Total rows: 5000" in big.digest
    own = answer(spark, "SELECT id FROM range(5000) LIMIT 2000")
    assert own.row_count == 2000
    cut = answer(spark, "SELECT id FROM range(5000)", cap=7)
    assert cut.row_count == 5000 and len(cut.data) == 7
    # names hold for one question, and do not replace a view of the session
    spark.range(3).createOrReplaceTempView("people")
    assert answer(spark, "SELECT count(*) AS n FROM people", tables=tables).data == [{"n": people(spark).count()}]
    assert spark.table("people").count() == 3
    spark.catalog.dropTempView("people")
    assert not answer(spark, "SELECT * FROM people").success
    assert answer(spark, "q", to_sql=lambda text: "SELECT 1", mode="sql").sql == "SELECT 1"
    assert not answer(spark, "").success
    assert answer(spark, "q", to_sql=lambda text: None).error == "No SQL came back for the question."
    bad = answer(spark, "SELECT nothing FROM nowhere")
    assert "The query did not run" in bad.error and bad.sql == "SELECT nothing FROM nowhere"
    assert "The query did not run" in answer(spark, "SELECT CAST('x' AS INT)").error


def test_an_answer_runs_its_statement_once(spark):
    """Short results are counted from what the preview has read; the digest is the one of `digest`."""
    read = spark.sparkContext.accumulator(0)
    spark.udf.register("seen_row", F.udf(lambda x: read.add(1) or x, "long").asNondeterministic())
    for n, passes in ((0, 1), (4, 1), (90, 1)):
        before = read.value
        done = answer(spark, f"SELECT seen_row(id) AS id, 1.5 AS v FROM range(0, {n}, 1, 1)")
        assert (done.row_count, len(done.data), read.value - before) == (n, n, passes * n)
        assert done.digest == digest(spark.sql(f"SELECT id, 1.5 AS v FROM range(0, {n}, 1, 1)")).first().digest
        assert all(set(r) == {"id", "v"} for r in done.data)

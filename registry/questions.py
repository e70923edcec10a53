"""Q1-Q13, Q15: questions over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query
from registry.tables import NORMAL, given
from tablewright import answer, digest, normalize
from tablewright.functions.text import safe_number
from tablewright.operators import questions as q

PRICING_SQL = """
    SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS line_count,
           round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_quantity), 4) AS avg_quantity
    FROM lineitem GROUP BY l_returnflag, l_linestatus
"""


def cents(column: str) -> Column:
    """Money as an exact decimal, so that sums do not depend on the order of the rows."""
    return F.col(column).cast("decimal(18,2)")


@query(PRICING_SQL)
def q1_sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same SQL text as a question."""
    done = answer(spark, PRICING_SQL, tables={"lineitem": given(spark, sf_dir, "lineitem")})
    return spark.createDataFrame(
        done.data, "l_returnflag string, l_linestatus string, line_count long, revenue double, avg_quantity double")


ORDERED_SQL = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice, o_orderkey"


@query(f"{ORDERED_SQL} LIMIT 1000")
def q2_default_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text without a limit is cut at a thousand rows, if that is asked for."""
    given(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return q.capped(spark.sql(ORDERED_SQL), ORDERED_SQL, 1000)


@query(f"SELECT *, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS row_count FROM ({ORDERED_SQL} LIMIT 100)")
def q2_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred rows beside the count of all."""
    done = answer(spark, ORDERED_SQL, tables={"orders": given(spark, sf_dir, "orders")}, cap=1000)
    rows = [r | {"row_count": done.row_count} for r in done.data]
    return spark.createDataFrame(rows, "o_orderkey long, o_totalprice double, row_count long")


@query("""
    SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE)
           AS number
    FROM events
""")
def q3_safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    return given(spark, sf_dir, "events").select("event_id", safe_number(text).alias("number"))


@query("SELECT p_brand, count(*) AS parts FROM part GROUP BY p_brand ORDER BY parts DESC, p_brand LIMIT 5")
def q4_top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.top_groups(given(spark, sf_dir, "part"), "p_brand", 5, "parts")


FLAGSHIP_SQL = "SELECT c_mktsegment, round(avg(c_acctbal), 4) AS avg_balance FROM customer GROUP BY c_mktsegment"


@query(FLAGSHIP_SQL)
def q5_average_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalize the customers, then average their balance by market segment."""
    customers = normalize(given(spark, sf_dir, "customer")).data
    return q.average_by(customers, "c_mktsegment", "c_acctbal", "average").select(
        "c_mktsegment", F.round("average", 4).alias("avg_balance")
    )


@query("""
    SELECT l_partkey, max(l_extendedprice) AS highest FROM lineitem GROUP BY l_partkey
    ORDER BY highest DESC, l_partkey LIMIT 10
""")
def q6_highest_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.highest_groups(given(spark, sf_dir, "lineitem"), "l_partkey", "l_extendedprice", 10, "highest")


@query("SELECT l_suppkey, count(*) AS lines FROM lineitem GROUP BY l_suppkey")
def q7_count_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.count_by(given(spark, sf_dir, "lineitem"), "l_suppkey", "lines")


@query("SELECT user_id, count(*) AS events FROM events GROUP BY user_id ORDER BY events DESC, user_id LIMIT 1")
def q8_largest_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.top_groups(given(spark, sf_dir, "events"), "user_id", 1, "events")


@query("""
    SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY o_custkey
""")
def q9_sum_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = q.sum_by(given(spark, sf_dir, "orders"), "o_custkey", cents("o_totalprice"), "total")
    return totals.select("o_custkey", F.col("total").cast("double").alias("total"))


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
""")
def q10_top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return q.top_rows(orders, "o_totalprice", "o_orderkey", 5)


@query("SELECT round(avg(p_retailprice), 4) AS avg_price FROM part WHERE p_size = 3")
def q11_filtered_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = given(spark, sf_dir, "part")
    return q.filtered_average(part, F.col("p_size") == 3, "p_retailprice", "price").select(
        F.round("price", 4).alias("avg_price")
    )


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 250000
""")
def q12_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 250000)
    return given(spark, sf_dir, "orders").filter(urgent).select("o_orderkey", "o_custkey", "o_totalprice")


@query(f"SELECT * FROM ({NORMAL['orders']}) ORDER BY o_orderkey LIMIT 10")
def q13_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.first_rows(normalize(given(spark, sf_dir, "orders")).data, "o_orderkey")


@query("""
    WITH top AS (
        SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn, * FROM orders
    ), shown AS (
        SELECT string_agg('  {' || chr(10) || '    "o_orderkey": ' || o_orderkey || ',' || chr(10)
                   || '    "o_orderstatus": "' || o_orderstatus || '",' || chr(10)
                   || '    "o_totalprice": ' || o_totalprice || ',' || chr(10)
                   || '    "o_orderdate": "' || strftime(o_orderdate, '%Y-%m-%d') || '"' || chr(10) || '  }',
                   ',' || chr(10) ORDER BY rn) AS rows
        FROM top WHERE rn <= 5
    )
    SELECT (SELECT count(*) FROM orders) AS row_count,
           'First 5 rows:' || chr(10) || '[' || chr(10) || rows || chr(10) || ']' || chr(10) || chr(10)
           || 'Total rows: ' || (SELECT count(*) FROM orders) AS digest
    FROM shown
""")
def q15_result_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return digest(
        orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    )

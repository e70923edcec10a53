"""The given tables, and scratch places for queries that write."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tablewright.sinks.tables import ensure_database
from tablewright.sources.files import scratch_path

# the schema of the given tables, as stated with them
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
PREFIXES = ("r_", "n_", "c_", "s_", "p_", "o_", "l_")


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bare(name: str) -> str:
    """A column name without its one-letter table prefix, so that keys have the same name in all tables."""
    return name[2:] if name.startswith(PREFIXES) else name


def bare_tables(spark: SparkSession, folder: str, names: tuple[str, ...] = tuple(COLUMNS)) -> dict[str, DataFrame]:
    tables = {n: given(spark, folder, n) for n in names}
    return {n: t.toDF(*[bare(c) for c in t.columns]) for n, t in tables.items()}


def new_database(spark: SparkSession, label: str) -> str:
    name = f"tw_{label}_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, name, scratch_path(spark, label))
    return name


def columns_of(name: str) -> list[tuple[str, str]]:
    return [tuple(c.strip().split(" ")) for c in COLUMNS[name].split(",")]


def catalog_sql(names: tuple[str, ...] = tuple(COLUMNS)) -> str:
    """CTEs `cat` (the bare column catalog) and `counted` (rows per table) for the SQL side."""
    entries = ", ".join(
        f"('{t}', {i}, {j}, '{bare(c)}', '{k}')"
        for i, t in enumerate(names, 1) for j, (c, k) in enumerate(columns_of(t), 1)
    )
    counts = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS num_rows FROM {t}" for t in names)
    return (
        f"cat(table_name, table_ord, ordinal, column_name, data_type) AS (VALUES {entries}), "
        f"counted AS ({counts})"
    )


# normalized forms of given tables, as SQL
NORMAL = {
    "region": "SELECT CAST(r_regionkey AS BIGINT) AS r_regionkey, r_name FROM region",
    "nation": "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, "
              "CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation",
    "customer": "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment "
                "FROM customer",
    "orders": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
              "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders",
    "lineitem": "SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
                "CAST(l_quantity AS BIGINT) AS l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
                "l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem",
}

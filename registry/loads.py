"""Loads into catalog tables, and the jobs built on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query
from registry.tables import NORMAL, given, new_database
from tablewright import (
    file_manifest, ingest, key_relationships, column_catalog, load_folder, load_table, normalize, normalize_and_load,
    refresh_database, with_row_counts, write_csv, write_relationships,
)
from tablewright.operators.catalog import base_tables
from tablewright.sinks.tables import report
from tablewright.sources.files import remove_path, scratch_path


def _normal(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return normalize(given(spark, sf_dir, name)).data


# a key, an amount and a text of the tables that the queries here store
SHOWN = {
    "orders": ("o_orderkey", "o_totalprice", "o_orderpriority"), "part": ("p_partkey", "p_retailprice", "p_name"),
    "customer": ("c_custkey", "c_acctbal", "c_name"), "supplier": ("s_suppkey", "s_acctbal", "s_name"),
    "nation": ("n_nationkey", "n_regionkey", "n_name"),
}


def _contents(spark: SparkSession, database: str) -> DataFrame:
    """Three columns of every row of every stored table."""
    stored = [
        t.select(F.lit(n).alias("table"), *[F.col(c).alias(x) for c, x in zip(SHOWN[n], ("key", "amount", "label"))])
        for n, t in base_tables(spark, database).items()
    ]
    return reduce(DataFrame.unionByName, stored)


@query(NORMAL["orders"])
def s6_load_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load replaces the first, though it reads the table it replaces."""
    database = new_database(spark, "s6t")
    load_table(given(spark, sf_dir, "orders"), database, "orders")
    load_table(normalize(spark.table(f"{database}.orders")).data, database, "orders")
    return spark.table(f"{database}.orders")


@query(f"{NORMAL['orders']} UNION ALL {NORMAL['orders']}")
def s6_load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = new_database(spark, "s6a")
    orders = _normal(spark, sf_dir, "orders")
    load_table(orders, database, "orders", "append")
    load_table(orders, database, "orders", "append")
    return spark.table(f"{database}.orders")


@query(f"""
    SELECT 'new' AS "table", * FROM ({NORMAL['orders']}) UNION ALL SELECT 'void', * FROM ({NORMAL['orders']})
""")
def s6_if_empty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the tables hold after loads that only empty ones accept."""
    database = new_database(spark, "s6r")
    orders = _normal(spark, sf_dir, "orders")
    load_table(orders.filter("o_totalprice < 0"), database, "void")
    for name in ("new", "void", "new"):
        load_table(orders, database, name, "empty")
    stored = [spark.table(f"{database}.{n}").select(F.lit(n).alias("table"), "*") for n in ("new", "void")]
    return stored[0].unionByName(stored[1])


@query("""
    SELECT 'new' AS "table", true AS success, count(*) AS rows FROM orders
    UNION ALL SELECT 'void', true, count(*) FROM orders
    UNION ALL SELECT 'new', false, NULL
""")
def s6_load_if_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Into a table that is absent, one without rows, and one that holds some."""
    database = new_database(spark, "s6e")
    orders = _normal(spark, sf_dir, "orders")
    load_table(orders.filter("o_totalprice < 0"), database, "void")
    done = [load_table(orders, database, n, "empty") for n in ("new", "void", "new")]
    return report(spark, done).select("table", "success", "rows")


@query("""
    SELECT 'customer' AS "table", true AS success, count(*) AS rows FROM customer
    UNION ALL SELECT 'line_items', true, count(*) FROM lineitem
    UNION ALL SELECT 'broken', false, NULL
""")
def s7_folder_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two readable tables, and one whose content is not what its extension says."""
    folder = scratch_path(spark, "s7")
    write_csv(given(spark, sf_dir, "customer"), f"{folder}/customer.csv")
    given(spark, sf_dir, "lineitem").write.parquet(f"{folder}/line-items.parquet")
    given(spark, sf_dir, "nation").select(F.col("n_name").alias("value")).write.text(f"{folder}/broken.parquet")
    return load_folder(spark, folder, new_database(spark, "s7")).select("table", "success", "rows")


@query("""
    SELECT 'customer' AS "table", c_custkey AS key, CAST(c_nationkey AS BIGINT) AS part, c_acctbal AS amount,
           c_name AS label, NULL::TIMESTAMP AS at FROM customer
    UNION ALL SELECT 'line_items', l_orderkey, l_linenumber, l_extendedprice, l_returnflag, l_shipdate FROM lineitem
""")
def s7_folder_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the tables hold after a folder was loaded."""
    folder, database = scratch_path(spark, "s7r"), new_database(spark, "s7r")
    write_csv(given(spark, sf_dir, "customer"), f"{folder}/customer.csv")
    given(spark, sf_dir, "lineitem").write.parquet(f"{folder}/line-items.parquet")
    load_folder(spark, folder, database)
    customer = spark.table(f"{database}.customer").selectExpr(
        "'customer' AS table", "c_custkey AS key", "c_nationkey AS part", "c_acctbal AS amount", "c_name AS label",
        "CAST(NULL AS TIMESTAMP_NTZ) AS at")
    return customer.unionByName(spark.table(f"{database}.line_items").selectExpr(
        "'line_items' AS table", "l_orderkey AS key", "CAST(l_linenumber AS BIGINT) AS part", "l_extendedprice AS amount",
        "l_returnflag AS label", "l_shipdate AS at"))


@query("""
    SELECT 'customer' AS from_table, 'c_nationkey' AS from_column, 'orders_of' AS to_table,
           'c_nationkey' AS to_column, 'medium' AS confidence,
           (SELECT count(*) FROM customer) AS from_rows, count(*) AS to_rows
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def s10_relationship_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata of a set, written as JSON lines and read back."""
    customer = given(spark, sf_dir, "customer")
    orders = given(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderstatus", "c_nationkey"
    )
    tables = {"customer": normalize(customer), "orders_of": normalize(orders)}
    reports = reduce(
        DataFrame.unionByName,
        [t.report(n).withColumn("path", F.lit(f"set/{n}.csv")) for n, t in tables.items()],
    )
    found = key_relationships(column_catalog({n: t.data for n, t in tables.items()}, rows=False))
    path = scratch_path(spark, "s10")
    write_relationships(reports, found, path)
    shape = (
        "sheet struct<table: string, path: string, rows: bigint, cols: int, columns: array<string>>, "
        "relationship struct<from_table: string, from_column: string, to_table: string, to_column: string, "
        "relationship_type: string, confidence: string>"
    )
    lines = spark.read.text(path).select(F.from_json("value", shape).alias("d")).select("d.*")
    rows = lines.filter("sheet IS NOT NULL").select("sheet.table", "sheet.rows")
    related = lines.filter("relationship IS NOT NULL").select("relationship.*")
    related = related.join(rows.withColumnsRenamed({"table": "from_table", "rows": "from_rows"}), "from_table")
    return related.join(rows.withColumnsRenamed({"table": "to_table", "rows": "to_rows"}), "to_table").select(
        "from_table", "from_column", "to_table", "to_column", "confidence", "from_rows", "to_rows")


@query("""
    SELECT 'orders' AS "table", o_orderkey AS key, o_totalprice AS amount, o_orderpriority AS label FROM orders
    UNION ALL SELECT 'part', p_partkey, p_retailprice, p_name FROM part
""")
def s11_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After the second refresh the tables only the first one named are gone."""
    database = new_database(spark, "s11")
    first = {n: given(spark, sf_dir, n) for n in ("customer", "orders", "supplier")}
    refresh_database(spark, first, database)
    refresh_database(spark, {n: given(spark, sf_dir, n) for n in ("orders", "part")}, database)
    return _contents(spark, database)


@query("""
    SELECT 'counts' AS "table", 3 AS total, 2 AS succeeded, 1 AS failed, NULL::BIGINT AS key, NULL::DOUBLE AS amount,
           NULL AS label
    UNION ALL SELECT 'orders', NULL, NULL, NULL, o_orderkey, o_totalprice, o_orderpriority FROM orders
    UNION ALL SELECT 'part', NULL, NULL, NULL, p_partkey, p_retailprice, p_name FROM part
""")
def p1_normalize_and_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources and a missing one: the counts, and what the database holds then."""
    database = new_database(spark, "p1")
    paths = {n: f"{sf_dir}/{n}.parquet" for n in ("orders", "gone", "part")}
    counts = normalize_and_load(spark, paths, database).withColumn("table", F.lit("counts"))
    return counts.unionByName(_contents(spark, database), allowMissingColumns=True).select(
        "table", F.col("total").cast("int").alias("total"), F.col("succeeded").cast("int").alias("succeeded"),
        F.col("failed").cast("int").alias("failed"), "key", "amount", "label",
    )


@query("""
    SELECT 'customer' AS from_table, 'custkey' AS from_column, 'orders' AS to_table, 'custkey' AS to_column,
           'MEDIUM' AS confidence, 'Common column ''custkey'' with matching type BIGINT' AS reason,
           (SELECT count(*) FROM customer) AS from_rows, (SELECT count(*) FROM orders) AS to_rows, true AS viewed
""")
def p2_ingest_and_relate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of delimited files to stored, related and joined tables."""
    folder = scratch_path(spark, "p2")
    customer = given(spark, sf_dir, "customer").selectExpr("c_custkey AS custkey", "c_name AS `name`", "c_acctbal")
    orders = given(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey AS custkey", "o_orderdate")
    write_csv(customer, f"{folder}/customer.csv")
    write_csv(orders, f"{folder}/orders.csv")
    _, done = ingest(spark, folder, new_database(spark, "p2"))
    found = with_row_counts(done.relationships, done.catalog)
    views = done.views.select("from_table", "to_table", F.col("created").alias("viewed"))
    return found.join(views, ["from_table", "to_table"], "left").select(
        "from_table", "from_column", "to_table", "to_column", "confidence", "reason", "from_rows", "to_rows", "viewed"
    )


@query("""
    SELECT 'customer' AS "table", 'changed' AS state, c_custkey AS key, c_acctbal AS amount, c_name AS label
    FROM customer WHERE c_acctbal > 0
    UNION ALL SELECT 'orders', 'changed', o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 2 = 1
    UNION ALL SELECT 'part', 'gone', NULL, NULL, NULL
    UNION ALL SELECT 'supplier', 'new', s_suppkey, s_acctbal, s_name FROM supplier
    UNION ALL SELECT 'nation', 'same', n_nationkey, n_regionkey, n_name FROM nation
""")
def p2_ingest_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the database holds after files were added, changed and removed, each table with what the second run did.

    Of `orders` one of two part files leaves, `customer` is written anew, `part` leaves whole, `supplier` comes.
    """
    folder, database = scratch_path(spark, "p2again"), new_database(spark, "p2again")
    orders, customer = given(spark, sf_dir, "orders"), given(spark, sf_dir, "customer")
    orders.filter("o_orderkey % 2 = 0").write.parquet(f"{folder}/orders.parquet")
    leaving = [r.path for r in file_manifest(spark, folder).filter("NOT hidden").collect()]
    orders.filter("o_orderkey % 2 = 1").write.mode("append").parquet(f"{folder}/orders.parquet")
    write_csv(customer, f"{folder}/customer.csv")
    for name in ("part", "nation"):
        given(spark, sf_dir, name).write.parquet(f"{folder}/{name}.parquet")
    ingest(spark, folder, database)
    for path in (*leaving, f"{folder}/part.parquet"):
        remove_path(spark, path)
    write_csv(customer.filter("c_acctbal > 0"), f"{folder}/customer.csv")
    given(spark, sf_dir, "supplier").write.parquet(f"{folder}/supplier.parquet")
    report, _ = ingest(spark, folder, database)
    return _contents(spark, database).join(report.select("table", "state"), "table", "full").select(
        "table", F.coalesce("state", F.lit("same")).alias("state"), "key", "amount", "label")


@query("""
    SELECT 'orders' AS "table", true AS success, count(*) AS rows, NULL AS refusal FROM orders
    UNION ALL SELECT '_customer.csv', false, NULL, 'hidden' UNION ALL SELECT 'void.json', false, NULL, 'empty'
""")
def s2_refused_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with a table, one under a name that Spark passes over, and one of empty files: each is reported."""
    folder = scratch_path(spark, "s2refused")
    orders = given(spark, sf_dir, "orders")
    orders.write.parquet(f"{folder}/orders.parquet")
    write_csv(given(spark, sf_dir, "customer"), f"{folder}/_customer.csv")
    orders.filter("o_orderkey < 0").write.json(f"{folder}/void.json")
    report = load_folder(spark, folder, new_database(spark, "s2refused"))
    return report.select("table", "success", "rows", F.substring_index("error", ":", 1).alias("refusal"))

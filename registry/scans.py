"""Scans and file sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query
from registry.tables import NORMAL, given
from tablewright import (
    csv_lines, file_manifest, infer_types, normalize, not_landed, scan_csv, scan_tables, write_csv,
)
from tablewright.functions.text import MISSING_TOKENS, table_name
from tablewright.plans.ingest import missing_files
from tablewright.sinks.csv_files import write_lines
from tablewright.sources.files import scratch_path

MISSING_SQL = ", ".join(f"'{t}'" for t in MISSING_TOKENS)


def _quote(name: str) -> Column:
    return F.concat(F.lit('"'), F.replace(F.col(name), F.lit('"'), F.lit('""')), F.lit('"'))


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice,
           CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate,
           CASE WHEN o_orderstatus = 'F' THEN nullif(o_orderpriority, '5-LOW') END AS o_orderpriority
    FROM orders WHERE o_orderstatus <> 'P'
""")
def s1_csv_tolerant_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders lack cells (padded), pending ones have too many (dropped), one priority is a missing token."""
    orders = given(spark, sf_dir, "orders")
    start = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus")
    priority = F.when(F.col("o_orderpriority") == "5-LOW", "N/A").otherwise(_quote("o_orderpriority"))
    full = F.concat_ws(",", start, "o_totalprice", F.col("o_orderdate").cast("date"), priority)
    line = (
        F.when(F.col("o_orderstatus") == "P", F.concat(full, F.lit(',"one, more",')))
        .when(F.col("o_orderstatus") == "O", start)
        .otherwise(full)
    )
    path = scratch_path(spark, "s1", ".csv")
    write_lines(orders.select(line.alias("value")), ",".join(orders.columns), path)
    return infer_types(scan_csv(spark, path))


@query(f"""
    SELECT doc_id, CASE WHEN text NOT IN ({MISSING_SQL}) THEN text END AS text, lang, source, n_chars FROM documents
""")
def s1_csv_quoted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, with their line breaks, quotes and commas, out to CSV and back."""
    documents = given(spark, sf_dir, "documents")
    line = F.concat_ws(",", "doc_id", _quote("text"), "lang", "source", "n_chars")
    path = scratch_path(spark, "s1text", ".csv")
    write_lines(documents.select(line.alias("value")), ",".join(documents.columns), path)
    return infer_types(scan_csv(spark, path))


@query("""
    SELECT 'customer' AS "table", count(*) AS rows, 5 AS cols,
           'c_acctbal,c_custkey,c_mktsegment,c_name,c_nationkey' AS columns FROM customer
    UNION ALL SELECT 'line_items', count(*), 4, 'l_orderkey,l_partkey,l_quantity,l_shipdate' FROM lineitem
    UNION ALL SELECT 'orders', count(*), 6,
           'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' FROM orders
""")
def s2_table_set_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with a delimited, a JSON and a Parquet table, each found by its extension."""
    folder = scratch_path(spark, "s2")
    write_csv(given(spark, sf_dir, "orders"), f"{folder}/orders.csv")
    given(spark, sf_dir, "customer").write.json(f"{folder}/customer.json")
    given(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate").write.parquet(
        f"{folder}/Line-Items.parquet"
    )
    counted = [
        t.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(n).alias("table"), "rows", F.lit(len(t.columns)).alias("cols"),
            F.lit(",".join(t.columns)).alias("columns"),
        )
        for n, t in scan_tables(spark, folder).items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query("""
    SELECT 'orders_' || lower(o_orderstatus) AS table_name, '.parquet' AS extension, true AS sized, count(*) AS rows,
           min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
    FROM orders GROUP BY o_orderstatus
""")
def s4_file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of files written from a table, joined with what each of them holds."""
    folder = scratch_path(spark, "s4")
    orders = given(spark, sf_dir, "orders")
    for status in ("F", "O", "P"):
        orders.filter(F.col("o_orderstatus") == status).write.parquet(f"{folder}/Orders-{status}.parquet")
    held = spark.read.parquet(*[f"{folder}/Orders-{s}.parquet" for s in ("F", "O", "P")])
    held = held.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))
    listed = file_manifest(spark, folder, (".parquet",)).join(held, "path")
    return listed.groupBy("table_name", "extension").agg(
        F.every(F.col("length") == F.col("bytes")).alias("sized"), F.sum("rows").alias("rows"),
        F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"))


@query("""
    SELECT concat_ws(',', o_orderkey, o_custkey, '"' || o_orderstatus || '"', o_totalprice,
                     '"' || strftime(o_orderdate, '%Y-%m-%d') || '"',
                     '"' || CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END || '"') AS value
    FROM orders
""")
def s5_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text quoted, numbers bare, a missing text as two quotes."""
    orders = given(spark, sf_dir, "orders").withColumn("o_orderpriority", F.expr("nullif(o_orderpriority, '5-LOW')"))
    return csv_lines(normalize(orders).data)


@query(NORMAL["lineitem"])
def s5_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "s5", ".csv")
    write_csv(normalize(given(spark, sf_dir, "lineitem")).data, path)
    return normalize(scan_csv(spark, path), untyped=True).data


@query(r"""
    SELECT page_id,
           translate(lower(regexp_extract(url, '([^/]+?)(?:\.[^./]+)?$', 1)), '-. ', '___') AS table_name
    FROM pages
""")
def s8_table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "pages").select("page_id", table_name(F.col("url")).alias("table_name"))


@query("""
    SELECT 'lineitem' AS table_name, count(*) AS rows, sum(l_orderkey) AS keys FROM lineitem
    UNION ALL SELECT 'part', count(*), sum(p_partkey) FROM part
    UNION ALL SELECT 'supplier', count(*), sum(s_suppkey) FROM supplier
    UNION ALL SELECT 'events', count(*), sum(event_id) FROM events
""")
def s12_not_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source tables the landing folder does not hold after two of them were ingested, and what they hold."""
    landing = scratch_path(spark, "s12")
    for name in ("customer", "orders"):
        given(spark, sf_dir, name).write.parquet(f"{landing}/{name}.parquet")
    keys = {"lineitem": "l_orderkey", "part": "p_partkey", "supplier": "s_suppkey", "events": "event_id",
            "customer": "c_custkey", "orders": "o_orderkey"}
    source = file_manifest(spark, sf_dir, (".parquet",)).filter(F.col("table_name").isin(*keys))
    missing = not_landed(source, file_manifest(spark, landing), "table_name").select("table_name").distinct()
    held = [
        given(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("rows"), F.sum(k).alias("keys")).withColumn("table_name", F.lit(n))
        for n, k in keys.items()]
    return missing.join(reduce(DataFrame.unionByName, held), "table_name")


@query("""
    SELECT 'orders' AS table_name, count(*) + 1 AS lines FROM orders
    UNION ALL SELECT 'part', count(*) + 1 FROM part
""")
def s12_content_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed under another name, landed with other rows, and not landed: the last two are missing."""
    source, landing = scratch_path(spark, "s12source"), scratch_path(spark, "s12landing")
    tables = {n: given(spark, sf_dir, n).coalesce(1) for n in ("customer", "orders", "part")}
    for name, table in tables.items():
        write_csv(table, f"{source}/{name}.csv")
    write_csv(tables["customer"], f"{landing}/clients of old.csv")
    write_csv(tables["orders"].filter("o_orderkey % 3 > 0"), f"{landing}/orders.csv")
    return missing_files(spark, source, landing, by_content=True).filter("NOT hidden").select("table_name", "lines")

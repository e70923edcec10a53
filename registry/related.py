"""Catalog, relationships, views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query
from registry.tables import bare_tables, catalog_sql, given, new_database
from tablewright import (
    analyze, column_catalog, key_relationships, load_tables, location_relationships, normalize, relationship_view,
    relationships, schema_document, typed_relationships, viewable, with_row_counts,
)
from tablewright.operators.relations import view_counts

PLACES = ("customer", "supplier", "nation", "region")
ROWS_SQL = """
    SELECT r.*, f.num_rows AS from_rows, t.num_rows AS to_rows FROM r
    JOIN counted f ON f.table_name = r.from_table JOIN counted t ON t.table_name = r.to_table
"""
KEY_SQL = """
    SELECT a.table_name AS from_table, a.column_name AS from_column, b.table_name AS to_table,
           b.column_name AS to_column, 'potential_foreign_key' AS relationship_type,
           CASE WHEN lower(a.column_name) LIKE '%id' THEN 'high' ELSE 'medium' END AS confidence
    FROM cat a JOIN cat b ON a.column_name = b.column_name AND a.table_ord < b.table_ord
    WHERE lower(a.column_name) LIKE '%id%' OR lower(a.column_name) LIKE '%key%'
       OR lower(a.column_name) LIKE '%code%' OR lower(a.column_name) LIKE '%num%'
"""
TYPED_SQL = """
    SELECT a.table_name AS from_table, lower(a.column_name) AS from_column, b.table_name AS to_table,
           lower(b.column_name) AS to_column,
           CASE WHEN lower(a.column_name) IN ('property_id', 'listing_id', 'address') THEN 'HIGH' ELSE 'MEDIUM' END
               AS confidence,
           'Common column ''' || lower(a.column_name) || ''' with matching type ' || upper(a.data_type) AS reason
    FROM cat a JOIN cat b
      ON lower(a.column_name) = lower(b.column_name) AND a.data_type = b.data_type AND a.table_ord < b.table_ord
    WHERE lower(a.column_name) NOT IN ('id', 'unknown', 'date', 'time', 'timestamp')
"""


def _places(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Given tables under the names an address book would use."""
    tables = {n: given(spark, sf_dir, n) for n in PLACES}
    return {
        "customer": tables["customer"].toDF("custkey", "Address", "nationkey", "acctbal", "segment"),
        "supplier": tables["supplier"].toDF("suppkey", "address", "zip", "balance"),
        "nation": tables["nation"].toDF("nationkey", "state", "city"),
        "region": tables["region"].toDF("regionkey", "name"),
    }


PLACE_CAT = """
    cat(table_name, table_ord, column_name, data_type, place) AS (VALUES
        ('customer', 1, 'custkey', 'bigint', 0), ('customer', 1, 'Address', 'string', 1),
        ('customer', 1, 'nationkey', 'int', 0), ('customer', 1, 'acctbal', 'double', 0),
        ('customer', 1, 'segment', 'string', 0), ('supplier', 2, 'suppkey', 'bigint', 0),
        ('supplier', 2, 'address', 'string', 1), ('supplier', 2, 'zip', 'int', 4), ('supplier', 2, 'balance', 'double', 0),
        ('nation', 3, 'nationkey', 'int', 0), ('nation', 3, 'state', 'string', 3), ('nation', 3, 'city', 'int', 2),
        ('region', 4, 'regionkey', 'int', 0), ('region', 4, 'name', 'string', 0)),
    counted AS (
        SELECT 'customer' AS table_name, count(*) AS num_rows FROM customer
        UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'nation', count(*) FROM nation
        UNION ALL SELECT 'region', count(*) FROM region)
"""
LOCATION_SQL = """
    SELECT a.table_name AS from_table, a.names AS from_column, b.table_name AS to_table, b.names AS to_column,
           'MEDIUM' AS confidence, 'Both tables have location fields - potential geographic join' AS reason
    FROM located a JOIN located b ON a.table_name <> b.table_name
    WHERE NOT EXISTS (SELECT 1 FROM typed t WHERE t.from_table = a.table_name AND t.to_table = b.table_name)
"""
LOCATED_CTE = """
    located AS (SELECT table_name, string_agg(lower(column_name), ', ' ORDER BY place) AS names
                FROM cat WHERE place > 0 GROUP BY table_name)
"""


@query(f"""
    WITH {catalog_sql()}
    SELECT table_name, table_ord, ordinal, column_name, data_type, 'No description' AS description, num_rows
    FROM cat JOIN counted USING (table_name)
""")
def r1_column_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_catalog(bare_tables(spark, sf_dir))


@query(f"WITH {catalog_sql()}, r AS ({KEY_SQL}) {ROWS_SQL}")
def r2_key_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = column_catalog(bare_tables(spark, sf_dir))
    return with_row_counts(key_relationships(catalog), catalog)


@query(f"WITH {catalog_sql()}, r AS ({TYPED_SQL}) {ROWS_SQL}")
def r3_typed_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = column_catalog(bare_tables(spark, sf_dir))
    return with_row_counts(typed_relationships(catalog), catalog)


@query(f"WITH {PLACE_CAT}, {LOCATED_CTE}, typed AS ({TYPED_SQL}), r AS ({LOCATION_SQL}) {ROWS_SQL}")
def r4_location_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = column_catalog(_places(spark, sf_dir))
    return with_row_counts(location_relationships(catalog, typed_relationships(catalog)), catalog)


ALL_SQL = f"{PLACE_CAT}, {LOCATED_CTE}, typed AS ({TYPED_SQL}), r AS (SELECT * FROM typed UNION ALL {LOCATION_SQL})"


@query(f"WITH {ALL_SQL} {ROWS_SQL}")
def r5_relationship_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = column_catalog(_places(spark, sf_dir))
    return with_row_counts(relationships(catalog), catalog)


@query(f"WITH {ALL_SQL} {ROWS_SQL} WHERE position(',' IN from_column) = 0 AND position(',' IN to_column) = 0")
def r6_viewable_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = column_catalog(_places(spark, sf_dir))
    return with_row_counts(viewable(relationships(catalog)), catalog)


@query(f"""
    WITH {ALL_SQL}, q AS ({ROWS_SQL})
    SELECT count(*) FILTER (position(',' IN from_column || to_column) = 0) AS viewable,
           count(*) FILTER (position(',' IN from_column || to_column) > 0) AS skipped FROM q
""")
def r6_view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = column_catalog(_places(spark, sf_dir))
    return view_counts(with_row_counts(relationships(catalog), catalog))


@query("""
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def r7_documents_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relationship_view(given(spark, sf_dir, "documents"), given(spark, sf_dir, "labels"), "doc_id")




def _bare_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bare_tables(spark, sf_dir, ("lineitem",))["lineitem"].select(
        "orderkey", "partkey", "suppkey", "linenumber", "quantity", "extendedprice", "returnflag",
        F.date_format("shipdate", "yyyy-MM-dd").alias("shipdate"),
    )


@query("""
    SELECT l_orderkey AS orderkey, l_partkey AS partkey, l_suppkey AS suppkey, l_linenumber AS linenumber,
           l_quantity AS quantity, l_extendedprice AS extendedprice, l_returnflag AS returnflag,
           strftime(l_shipdate, '%Y-%m-%d') AS shipdate, o_custkey AS custkey, o_orderstatus AS orderstatus,
           o_totalprice AS totalprice, strftime(o_orderdate, '%Y-%m-%d') AS orderdate,
           o_orderpriority AS orderpriority
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
""")
def r7_lines_with_orders_uncapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = bare_tables(spark, sf_dir, ("orders",))["orders"]
    orders = orders.withColumn("orderdate", F.date_format("orderdate", "yyyy-MM-dd"))
    return relationship_view(_bare_line(spark, sf_dir), orders, "orderkey", right_name="orders", limit=None)


@query("""
    SELECT n_nationkey AS nationkey, n_name AS name, n_regionkey AS regionkey, c_custkey AS custkey,
           c_name AS customer_name, c_acctbal AS acctbal, c_mktsegment AS mktsegment
    FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey
    ORDER BY n_nationkey, n_name, n_regionkey, c_custkey LIMIT 1000
""")
def r7_nations_with_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key has many rows on the right; a name both sides have gets the table's prefix."""
    tables = bare_tables(spark, sf_dir, ("nation", "customer"))
    return relationship_view(tables["nation"], tables["customer"], "nationkey", right_name="customer", limit=1000)


@query(f"WITH {catalog_sql()}, r AS ({TYPED_SQL}) {ROWS_SQL}")
def r8_analyze_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given tables stored in a database (names sort as here), its relationships with the rows of both sides."""
    database = new_database(spark, "r8")
    tables = bare_tables(spark, sf_dir)
    # the database lists its tables by name, so keep the set order in the name
    load_tables(spark, {f"t{i:02d}_{n}": t for i, (n, t) in enumerate(tables.items())}, database)
    done = analyze(spark, database, analyze_only=True)
    found = with_row_counts(done.relationships, done.catalog)
    return found.withColumn("from_table", F.substring("from_table", 5, 100)).withColumn(
        "to_table", F.substring("to_table", 5, 100)
    )


@query("""
    SELECT 'view_customer_join_nation' AS "view", c_custkey AS custkey, c_name AS "name", c_acctbal AS acctbal,
           n_name AS nation_name, CAST(n_regionkey AS BIGINT) AS regionkey, NULL::BIGINT AS orderkey,
           NULL::DOUBLE AS totalprice
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT 'view_customer_join_orders', c_custkey, c_name, c_acctbal, NULL, NULL, o_orderkey, o_totalprice
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey
""")
def r8_published_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views over normalized stored tables, read back."""
    database = new_database(spark, "r8v")
    tables = bare_tables(spark, sf_dir, ("customer", "nation", "orders"))
    tables["nation"] = tables["nation"].withColumnRenamed("name", "nation_name")
    load_tables(spark, {n: normalize(t).data for n, t in tables.items()}, database)
    views = [r.view for r in analyze(spark, database).views.filter("created").collect()]
    contents = [spark.table(v).withColumn("view", F.lit(v.rpartition(".")[2])) for v in views]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), contents)
    return every.select("view", "custkey", "name", "acctbal", "nation_name", "regionkey", "orderkey", "totalprice")


@query(f"""
    WITH {catalog_sql()}, lines AS (
        SELECT table_name, max(ordinal) AS cols,
               string_agg('    - ' || column_name || ' (' || upper(data_type) || ')' || chr(10), '' ORDER BY ordinal)
                   FILTER (ordinal <= 10) AS shown
        FROM cat GROUP BY table_name)
    SELECT table_name, 'Table: lake.' || table_name || chr(10) || '  Rows: ' || format('{{:,}}', num_rows) || chr(10)
           || '  Columns:' || chr(10) || shown
           || CASE WHEN cols > 10 THEN '    ... and ' || (cols - 10) || ' more columns' || chr(10) ELSE '' END
           || chr(10) AS context
    FROM lines JOIN counted USING (table_name)
""")
def q14_schema_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_document(column_catalog(bare_tables(spark, sf_dir)), "lake", columns=10)



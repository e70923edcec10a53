"""Cleaning rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import query
from registry.tables import COLUMNS, NORMAL, columns_of, given
from tablewright import Normalized, normalize, normalize_all, normalize_sheets, scan_csv, write_sheets
from tablewright.sources.files import scratch_path


def _reports(tables: dict[str, Normalized]) -> DataFrame:
    reports = reduce(DataFrame.unionByName, [t.report(n) for n, t in tables.items()])
    return reports.withColumn("columns", F.array_join("columns", ","))


@query("""
    SELECT c_custkey AS c_custkey, c_name AS customer_name, c_nationkey::BIGINT AS nation_key,
           c_acctbal AS acct__bal, c_mktsegment AS customer_name_1
    FROM customer
""")
def n1_header_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = [" c_custkey\t", "customer  name", "nation-key", "acct\r\nbal", "customer.name"]
    return normalize(given(spark, sf_dir, "customer").toDF(*headers)).data


LABEL_SQL = """
    WITH cells AS (
        SELECT 'url' AS col, 2 AS pos, page_id AS k, url AS v, false AS num, NULL::DOUBLE AS d FROM pages
        UNION ALL SELECT 'html', 3, page_id, html, false, NULL FROM pages
        UNION ALL SELECT 'p_name', 2, p_partkey, p_name, false, NULL FROM part
        UNION ALL SELECT 'p_size', 5, p_partkey, p_size::VARCHAR, true, p_size FROM part
        UNION ALL SELECT 'o_totalprice', 4, o_orderkey, o_totalprice::VARCHAR, true, o_totalprice FROM orders
        UNION ALL SELECT 'o_orderpriority', 6, o_orderkey, o_orderpriority, false, NULL FROM orders
        UNION ALL SELECT 'text', 2, doc_id, text, false, NULL FROM documents
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY col ORDER BY k) AS rn FROM cells WHERE v IS NOT NULL
    ), facts AS (
        SELECT col, min(pos) AS pos, count(*) AS filled, bool_or(num) AS num, median(d) AS med,
               lower(string_agg(v, ' ' ORDER BY k) FILTER (rn <= 10)) AS s, min(v) FILTER (rn = 1) AS f
        FROM ranked GROUP BY col
    )
    SELECT col AS "column", CASE
        WHEN s LIKE '%street%' OR s LIKE '%avenue%' OR s LIKE '%road%' OR s LIKE '%drive%' OR s LIKE '%lane%'
             OR s LIKE '%boulevard%' THEN 'address'
        WHEN s LIKE '%zip%' OR s LIKE '%postal%' THEN 'zipcode'
        WHEN s LIKE '%city%' OR s LIKE '%town%' THEN 'city'
        WHEN s LIKE '%state%' OR s LIKE '%province%' THEN 'state'
        WHEN s LIKE '%phone%' OR s LIKE '%tel%' OR s LIKE '%mobile%' THEN 'phone'
        WHEN s LIKE '%email%' OR s LIKE '%@%' THEN 'email'
        WHEN s LIKE '%http%' OR s LIKE '%www%' OR s LIKE '%.com%' OR s LIKE '%.org%' THEN 'url'
        WHEN num AND med > 1000 THEN 'amount'
        WHEN num THEN 'value'
        WHEN s LIKE '%description%' OR s LIKE '%detail%' OR s LIKE '%note%' OR s LIKE '%comment%' THEN 'description'
        WHEN s LIKE '%name%' OR s LIKE '%title%' THEN 'name'
        WHEN s LIKE '%id%' OR s LIKE '%code%' THEN 'id'
        WHEN (s LIKE '%date%' OR s LIKE '%/%' OR s LIKE '%-%') AND length(f) <= 12 THEN 'date'
        ELSE 'field' END        || '_' || pos AS name, filled
    FROM facts
"""
LABEL_SQL = f"SELECT *  REPLACE (CASE WHEN name LIKE 'date%' THEN 0 ELSE filled END AS filled) FROM ({LABEL_SQL})"


@query(LABEL_SQL)
def n2_column_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name each of these columns gets if it has none, and how many of its values survive.

    Order priorities look like dates at first sight, so they end as dates that cannot be read.
    """
    picked = {
        "pages": ("page_id", ["url", "html"]),
        "part": ("p_partkey", ["p_name", "p_size"]),
        "orders": ("o_orderkey", ["o_totalprice", "o_orderpriority"]),
        "documents": ("doc_id", ["text"]),
    }
    parts = []
    for table, (key, columns) in picked.items():
        given_names = [c for c, _ in columns_of(table)]
        blank = given(spark, sf_dir, table).toDF(*[f"Unnamed: {c}" if c in columns else c for c in given_names])
        done = normalize(blank, order_by=[key])
        named = dict(zip(given_names, done.columns))
        filled = done.data.agg(*[F.count(named[c]).alias(c) for c in columns]).unpivot([], columns, "column", "filled")
        label = F.create_map(*[F.lit(x) for c in columns for x in (c, named[c])])
        parts.append(filled.select("column", label[F.col("column")].alias("name"), "filled"))
    return reduce(DataFrame.unionByName, parts)


@query("""
    SELECT o_orderkey, o_custkey AS value_2, o_orderstatus AS field_3, o_totalprice AS amount_4,
           strftime(o_orderdate, '%Y-%m-%d') AS date_5, o_orderpriority
    FROM orders
""")
def n2_unnamed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = ["o_orderkey", "Unnamed: 1", "", "nan", "column_4", "o_orderpriority"]
    return normalize(given(spark, sf_dir, "orders").toDF(*headers), order_by=["o_orderkey"]).data


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
           o_orderpriority
    FROM orders WHERE o_orderstatus <> 'P'
""")
def n3_drop_empty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending orders have every cell emptied, so they vanish."""
    orders = given(spark, sf_dir, "orders")
    pending = F.col("o_orderstatus") == "P"
    return normalize(orders.select(*[F.when(~pending, F.col(c)).alias(c) for c in orders.columns]), drop_empty=True).data


@query("""
    SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_mktsegment, c_acctbal AS amount_5 FROM customer
""")
def n4_drop_empty_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns without any value go first, so the unnamed one counts as the fifth."""
    customer = given(spark, sf_dir, "customer")
    wide = customer.select(
        "c_custkey", F.lit(None).cast("string").alias("blank"), "c_name", "c_nationkey", "c_mktsegment",
        F.lit(float("nan")).alias("void"), F.col("c_acctbal").alias("Unnamed: 6"),
    )
    return normalize(wide, order_by=["c_custkey"], drop_empty=True).data


@query("""
    SELECT event_id, replace(strftime(ts, '%Y-%m-%d %H:%M:%S'), ' 00:00:00', '') AS ts,
           strftime(date_trunc('day', ts), '%Y-%m-%d') AS day_start
    FROM events
""")
def n5_datetime_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given(spark, sf_dir, "events")
    return normalize(events.select("event_id", "ts", F.date_trunc("day", "ts").alias("day_start"))).data


@query("""
    SELECT o_orderkey,
           CASE WHEN o_totalprice <= 400000 THEN strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate
    FROM orders
""")
def n6_dates_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as text; dear orders carry another layout than the first order, which reads as missing."""
    other = F.date_format("o_orderdate", "dd/MM/yyyy")
    day = F.when(F.col("o_totalprice") > 400000, other).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    orders = given(spark, sf_dir, "orders").select("o_orderkey", day.alias("o_orderdate"))
    return normalize(orders, order_by=["o_orderkey"]).data


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber,
           strftime(l_shipdate, '%Y-%m-%d') AS us_date, strftime(l_shipdate, '%Y-%m-%d') AS word_date,
           strftime(l_shipdate, '%Y-%m-%d') AS iso_time, strftime(l_shipdate, '%Y-%m-%d') AS zoned_time
    FROM lineitem
""")
def n6_date_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship = F.col("l_shipdate")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    items = given(spark, sf_dir, "lineitem").select(
        *keys, F.date_format(ship, "M/d/yyyy").alias("us_date"), F.date_format(ship, "MMM d, yyyy").alias("word_date"),
        F.date_format(ship, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("iso_time"),
        F.date_format(ship, "yyyy-MM-dd HH:mm:ss'+02:00'").alias("zoned_time"),
    )
    return normalize(items, order_by=keys).data


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN event_type = 'error' THEN 'Z' ELSE '+02:00' END
           AS seen_time
    FROM events
""")
def n6_mixed_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column with several UTC offsets is left as it is."""
    zone = F.when(F.col("event_type") == "error", "Z").otherwise("+02:00")
    seen = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), zone)
    return normalize(given(spark, sf_dir, "events").select("event_id", seen.alias("seen_time")), ["event_id"]).data


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS event_time, user_id AS lifetime FROM events
""")
def n6_numbers_as_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`compat`: numbers under a date name count nanoseconds. Without it they stay numbers."""
    events = given(spark, sf_dir, "events")
    nanoseconds = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) * 1000")
    dated = normalize(events.select("event_id", nanoseconds.alias("event_time")), compat=True).data
    plain = normalize(events.select("event_id", F.col("user_id").alias("lifetime"))).data
    return dated.join(plain, "event_id")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_totalprice > 100000 THEN 'True' ELSE 'False' END
           AS is_large
    FROM orders
""")
def n7_booleans(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") > 100000)
    return normalize(given(spark, sf_dir, "orders").select("o_orderkey", large.alias("is_large"))).data


KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, l_quantity::BIGINT AS l_quantity,
           l_discount, l_extendedprice AS price
    FROM lineitem
""")
def n8_numeric_narrowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole doubles become integers, doubles and decimals with fractions stay doubles."""
    price = F.col("l_extendedprice").cast("decimal(18,2)").alias("price")
    return normalize(given(spark, sf_dir, "lineitem").select(*KEYS, "l_quantity", "l_discount", price)).data


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber,
           CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity::BIGINT END AS l_quantity,
           CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_discount END AS l_discount,
           CASE WHEN l_linestatus = 'O' THEN 0.0 ELSE l_tax END AS l_tax, 0::BIGINT AS nothing
    FROM lineitem
""")
def n9_numeric_null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = F.col("l_returnflag") != "R"
    items = given(spark, sf_dir, "lineitem").select(
        *KEYS, F.when(kept, F.col("l_quantity")).alias("l_quantity"),
        F.when(kept, F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_linestatus") == "O", float("nan")).otherwise(F.col("l_tax")).alias("l_tax"),
        F.lit(None).cast("double").alias("nothing"),
    )
    return normalize(items).data


@query(r"""
    SELECT doc_id,
           replace(replace(replace(replace(text || chr(13) || chr(10) || lang || chr(9) || source || chr(13),
               chr(13) || chr(10), ' '), chr(10), ' '), chr(13), ' '), chr(9), ' ') AS text
    FROM documents
""")
def n10_text_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line breaks, tabs and NUL characters added around whole texts that hold line breaks of their own."""
    text = F.concat("text", F.lit("\r\n"), "lang", F.lit("\t\x00"), "source", F.lit("\r"))
    return normalize(given(spark, sf_dir, "documents").select("doc_id", text.alias("text"))).data


@query("""
    SELECT doc_id, CASE WHEN lang = 'fr' THEN NULL ELSE replace(text, chr(10), ' ') END AS text,
           CASE WHEN lang = 'de' THEN '  ' ELSE source END AS source
    FROM documents
""")
def n11_empty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("lang") == "fr", "\x00").otherwise(F.col("text"))
    source = F.when(F.col("lang") == "de", "  ").otherwise(F.col("source"))
    documents = given(spark, sf_dir, "documents")
    return normalize(documents.select("doc_id", text.alias("text"), source.alias("source"))).data


@query(NORMAL["lineitem"])
def n12_normalize_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(given(spark, sf_dir, "lineitem")).data


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props FROM events
""")
def n12_normalize_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(given(spark, sf_dir, "events")).data


SHEETS_SQL = """
    SELECT 'book_Open_Orders' AS "table", count(*) AS rows, 3 AS cols, 'o_orderkey,o_custkey,o_totalprice' AS columns
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT 'book_Parts_All', count(*), 6, 'p_partkey,p_name,p_brand,p_type,p_size,p_retailprice' FROM part
"""


def _sheets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders, items = given(spark, sf_dir, "orders"), given(spark, sf_dir, "lineitem")
    open_order = F.col("o_orderstatus") != "P"
    picked = [F.when(open_order, F.col(c)).alias(c) for c in ("o_orderkey", "o_custkey", "o_totalprice")]
    return {
        "Open Orders": orders.select(*picked, F.lit(None).cast("string").alias("remark")),
        "Returned Later": items.filter("l_quantity < 0"),
        "Erased": items.select(*[F.lit(None).cast("double").alias(c) for c in ("l_tax", "l_discount")]),
        "Parts/All": given(spark, sf_dir, "part"),
    }


@query(SHEETS_SQL)
def s3_sheet_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A set of sheets: one without rows, one with only empty rows, two that stay."""
    return _reports(normalize_sheets(_sheets(spark, sf_dir), "book").tables)


@query("""
    SELECT 'book_Parts_All' AS "table", p_partkey AS key, p_retailprice AS amount, p_name AS label FROM part
    UNION ALL SELECT 'book_Open_Orders', o_orderkey, o_totalprice, NULL FROM orders WHERE o_orderstatus <> 'P'
""")
def s3_written_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sheets that stay, written as delimited files and read back."""
    folder = scratch_path(spark, "s3")
    done = write_sheets(_sheets(spark, sf_dir), folder, "book")
    shown = {"book_Parts_All": ("p_partkey", "p_retailprice", "p_name"), "book_Open_Orders": ("o_orderkey", "o_totalprice", None)}
    read = [
        normalize(scan_csv(spark, f"{folder}/{n}.csv"), untyped=True).data.select(
            F.lit(n).alias("table"), F.col(shown[n][0]).alias("key"), F.col(shown[n][1]).alias("amount"),
            (F.col(shown[n][2]) if shown[n][2] else F.lit(None).cast("string")).alias("label"))
        for n in done.tables
    ]
    return reduce(DataFrame.unionByName, read)


@query("""
    SELECT 'book_Parts_All' AS "table", 'p_partkey' AS first_column, count(*) AS rows FROM part
    UNION ALL SELECT 'book_Open_Orders', 'o_orderkey', count(*) FROM orders WHERE o_orderstatus <> 'P'
""")
def n13_skip_empty_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = normalize_sheets(_sheets(spark, sf_dir), "book").tables
    counted = [
        t.data.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(n).alias("table"), F.lit(t.columns[0]).alias("first_column"), "rows")
        for n, t in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


REPORT_SQL = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", count(*) AS rows, {len(columns_of(t))} AS cols,
        '{",".join(c for c, _ in columns_of(t))}' AS columns FROM {t}""" for t in COLUMNS
)


@query(REPORT_SQL)
def n14_normalization_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {n: given(spark, sf_dir, n) for n in COLUMNS}
    return _reports(normalize_all(spark, tables, {n: [t.columns[0]] for n, t in tables.items()}).tables)


@query("""
    SELECT 'orders' AS "table", true AS ok, count(*) AS rows FROM orders
    UNION ALL SELECT 'part', true, count(*) FROM part
    UNION ALL SELECT 'gone', false, NULL
""")
def n15_batch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table of three has no source; the others are normalized all the same."""
    paths = {n: f"{sf_dir}/{n}.parquet" for n in ("orders", "gone", "part")}
    done = normalize_all(spark, paths)
    rows = reduce(DataFrame.unionByName, [t.report(n).select("table", "rows") for n, t in done.tables.items()])
    return done.status.join(rows, "table", "left").select("table", "ok", "rows")

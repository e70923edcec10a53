"""Relationships between tables, from the columns their catalog entries share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the name rules.
KEY_WORDS = ("id", "key", "code", "num")  # `_id`, `_key`, `_code` and `number` contain one of these
GENERIC_NAMES = ("id", "unknown", "date", "time", "timestamp")
STRONG_NAMES = ("property_id", "listing_id", "address")
LOCATION_NAMES = ("address", "city", "state", "zip", "zipcode", "postal_code")
VIEWABLE_CONFIDENCE = ("HIGH", "MEDIUM")
LOCATION_REASON = "Both tables have location fields - potential geographic join"

def key_groups(catalog: DataFrame) -> DataFrame:
    """`(column_name, tables)`: the tables that share a name (case counts) that looks like a key, in set order.

    One row per name, so that it grows with the catalog, however many tables share a name.
    """
    columns = catalog.filter(F.lower("column_name").rlike("|".join(KEY_WORDS)))
    return _groups(columns, "column_name")


def typed_groups(catalog: DataFrame) -> DataFrame:
    """`(name, data_type, tables)`: the same for names (case ignored) with equal types, without generic names."""
    name = F.lower("column_name")
    columns = catalog.withColumn("name", name).filter(~name.isin(*GENERIC_NAMES))
    return _groups(columns, "name", "data_type")


def _groups(columns: DataFrame, *keys: str) -> DataFrame:
    tables = F.array_sort(F.collect_list(F.struct("table_ord", "table_name")))
    return columns.groupBy(*keys).agg(tables.alias("tables")).filter(F.size("tables") > 1)


def _pairs(groups: DataFrame, tables: Iterable[str] | None) -> DataFrame:
    """Each group as pairs (a, b) of its tables, the earlier first; with `tables`, those that hold one of them."""
    keys = [c for c in groups.columns if c != "tables"]
    firsts = groups.select(*keys, "tables", F.posexplode("tables").alias("at", "a"))
    both = firsts.select(*keys, "a", F.explode(F.slice("tables", F.col("at") + 2, F.size("tables"))).alias("b"))
    if tables is None:
        return both
    wanted = list(tables)
    return both.filter(F.col("a.table_name").isin(wanted) | F.col("b.table_name").isin(wanted))


def key_relationships(catalog: DataFrame, tables: Iterable[str] | None = None) -> DataFrame:
    """The pairs of key_groups, earlier table of the set to later table; of all tables, or of those named."""
    pairs = _pairs(key_groups(catalog), tables)
    name = F.col("column_name")
    return pairs.select(
        F.col("a.table_name").alias("from_table"),
        name.alias("from_column"),
        F.col("b.table_name").alias("to_table"),
        name.alias("to_column"),
        F.lit("potential_foreign_key").alias("relationship_type"),
        F.when(F.endswith(F.lower(name), F.lit("id")), "high").otherwise("medium").alias("confidence"),
    )


def typed_relationships(catalog: DataFrame, tables: Iterable[str] | None = None) -> DataFrame:
    """The pairs of typed_groups, earlier table of the set to later table; of all tables, or of those named."""
    pairs = _pairs(typed_groups(catalog), tables)
    name = F.col("name")
    return pairs.select(
        F.col("a.table_name").alias("from_table"),
        name.alias("from_column"),
        F.col("b.table_name").alias("to_table"),
        name.alias("to_column"),
        F.when(name.isin(*STRONG_NAMES), "HIGH").otherwise("MEDIUM").alias("confidence"),
        F.concat(
            F.lit("Common column '"), name, F.lit("' with matching type "), F.upper("data_type")
        ).alias("reason"),
    )


def located_tables(catalog: DataFrame) -> DataFrame:
    """`(table_name, names)`: the location columns of each table that has some."""
    rank = F.array_position(F.array(*[F.lit(n) for n in LOCATION_NAMES]), F.col("name"))
    return (
        catalog.select("table_name", F.lower("column_name").alias("name"))
        .filter(F.col("name").isin(*LOCATION_NAMES))
        .groupBy("table_name")
        .agg(F.array_sort(F.collect_set(F.struct(rank.alias("rank"), "name"))).alias("found"))
        .select("table_name", F.array_join(F.transform("found", lambda s: s["name"]), ", ").alias("names"))
    )


def location_relationships(
    catalog: DataFrame, related: DataFrame, tables: Iterable[str] | None = None
) -> DataFrame:
    """Ordered pairs of tables with location columns that `related` does not hold in that direction.

    Every located table relates to every other: the rows are their pairs, made from one list of them (metadata). Name
    the `tables` in question to get theirs alone.
    """
    group = located_tables(catalog).agg(F.collect_list(F.struct(F.lit(0).alias("table_ord"), "table_name", "names")).alias("tables"))
    one_way = _pairs(group, tables)
    pairs = one_way.unionByName(one_way.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.select(
        F.col("a.table_name").alias("from_table"),
        F.col("a.names").alias("from_column"),
        F.col("b.table_name").alias("to_table"),
        F.col("b.names").alias("to_column"),
        F.lit("MEDIUM").alias("confidence"),
        F.lit(LOCATION_REASON).alias("reason"),
    ).join(related.select("from_table", "to_table").distinct(), ["from_table", "to_table"], "left_anti").select(
        "from_table", "from_column", "to_table", "to_column", "confidence", "reason"
    )


def relationships(catalog: DataFrame) -> DataFrame:
    typed = typed_relationships(catalog)
    return typed.unionByName(location_relationships(catalog, typed))


def _can_view() -> Column:
    several = F.contains("from_column", F.lit(",")) | F.contains("to_column", F.lit(","))
    return ~several & F.col("confidence").isin(*VIEWABLE_CONFIDENCE)


def viewable(found: DataFrame) -> DataFrame:
    """Relationships on one column a side, with enough confidence for a view."""
    return found.filter(_can_view())


def view_counts(found: DataFrame) -> DataFrame:
    return found.agg(F.count_if(_can_view()).alias("viewable"), F.count_if(~_can_view()).alias("skipped"))


def with_row_counts(found: DataFrame, catalog: DataFrame) -> DataFrame:
    """Relationships with the number of rows on either side."""
    rows = catalog.select("table_name", "num_rows").distinct()
    start = rows.select(F.col("table_name").alias("from_table"), F.col("num_rows").alias("from_rows"))
    end = rows.select(F.col("table_name").alias("to_table"), F.col("num_rows").alias("to_rows"))
    return found.join(start, "from_table").join(end, "to_table").select(*found.columns, "from_rows", "to_rows")

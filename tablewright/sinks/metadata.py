"""Relationship metadata as JSON: one line per sheet and per relationship, or all of it as one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sheet() -> Column:
    return F.struct("table", "path", "rows", "cols", "columns")


def _relationship() -> Column:
    return F.struct("from_table", "from_column", "to_table", "to_column", "relationship_type", "confidence")


def relationship_lines(reports: DataFrame, found: DataFrame) -> DataFrame:
    """`{"sheet": {...}}` and `{"relationship": {...}}`, one line each.

    `reports` is `(table, path, rows, cols, columns)`.
    """
    sheets = reports.select(F.to_json(F.struct(_sheet().alias("sheet"))).alias("value"))
    return sheets.unionByName(found.select(F.to_json(F.struct(_relationship().alias("relationship"))).alias("value")))


def relationship_document(reports: DataFrame, found: DataFrame) -> DataFrame:
    """One row with all of it as `{sheets: {...}, relationships: [...]}`; no row when nothing is related."""
    parts = reports.select(_sheet().alias("sheet")).unionByName(
        found.select(_relationship().alias("relationship")), allowMissingColumns=True)
    sheets = F.transform(F.array_sort(F.collect_list("sheet")), lambda s: F.struct(
        s["table"].alias("key"), F.struct(*[s[c].alias(c) for c in ("path", "rows", "cols", "columns")]).alias("value")))
    both = parts.agg(
        F.map_from_entries(sheets).alias("sheets"), F.array_sort(F.collect_list("relationship")).alias("relationships"))
    return both.filter(F.size("relationships") > 0).select(F.to_json(F.struct("sheets", "relationships")).alias("value"))


def document_pieces(reports: DataFrame, found: DataFrame) -> DataFrame:
    """section, place and value: the lines that, by section and place, are the document of `relationship_document`.

    Each entry is a line of its own; all but the first of a section begin with a comma.
    """
    def entries(rows: DataFrame, section: int, place: Column, text: Column) -> DataFrame:
        rows = rows.select(place.alias("place"), text.alias("text"))
        first = F.broadcast(rows.agg(F.min("place").alias("first")))
        mark = F.when(F.col("place") > F.col("first"), ",").otherwise("")
        # one row beside all
        return rows.join(first).select(F.lit(section).alias("section"), "place", F.concat(mark, "text").alias("value"))

    spark = reports.sparkSession
    key = F.regexp_extract(F.to_json(F.struct(F.col("table").alias("k"))), r'(?s)^\{"k":(.*)\}$', 1)
    own = F.to_json(F.struct("path", "rows", "cols", "columns"))
    related = F.to_json(_relationship())
    frame = spark.createDataFrame(
        [(0, "", '{"sheets":{'), (2, "", '},"relationships":['), (4, "", "]}")], "section int, place string, value string")
    return frame.unionByName(entries(reports, 1, F.col("table"), F.concat(key, F.lit(":"), own))).unionByName(
        entries(found, 3, related, related))


def write_document(reports: DataFrame, found: DataFrame, path: str, parts: int | None = None) -> bool:
    """Write the one document as part files that follow each other: put together by name, they are one JSON text.

    Tasks hold a range of its lines each. Nothing is written when nothing is related.
    """
    if found.isEmpty():
        return False
    pieces = document_pieces(reports, found)
    parts = parts or reports.sparkSession.sparkContext.defaultParallelism
    ordered = pieces.repartitionByRange(parts, "section", "place").sortWithinPartitions("section", "place")
    ordered.select("value").write.mode("overwrite").text(path)
    return True


def write_relationships(reports: DataFrame, found: DataFrame, path: str) -> bool:
    """Write the lines; nothing is written when nothing is related."""
    if found.isEmpty():
        return False
    relationship_lines(reports, found).write.mode("overwrite").text(path)
    return True

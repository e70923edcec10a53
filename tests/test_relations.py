import itertools
import random

import pytest
from rows import values

from tablewright import (
    analyze, column_catalog, create_views, database_catalog, key_relationships, load_table, location_relationships,
    relationship_view, relationships, schema_document, typed_relationships, viewable, with_row_counts,
)
from tablewright.operators.catalog import schema_context
from tablewright.operators.relations import typed_groups, KEY_WORDS, LOCATION_NAMES, view_counts


def table(spark, schema, rows=()):
    return spark.createDataFrame(list(rows), schema)


def test_location_fixture(spark):
    tables = {
        "t1": table(spark, "address string, city string", [("a", "b")]),
        "t2": table(spark, "city string, zip string"),
        "t3": table(spark, "id long"),
    }
    catalog = column_catalog(tables)
    found = relationships(catalog)
    assert sorted(values(found)) == [
        ("t1", "city", "t2", "city", "MEDIUM", "Common column 'city' with matching type STRING"),
        ("t2", "city, zip", "t1", "address, city", "MEDIUM",
         "Both tables have location fields - potential geographic join"),
    ]
    assert [r.from_table for r in viewable(found).collect()] == ["t1"]
    assert values(view_counts(found)) == [(1, 1)]
    assert sorted(values(with_row_counts(found, catalog).select("from_table", "from_rows", "to_rows"))) == [
        ("t1", 1, 0), ("t2", 0, 1)]


def test_typed_rules(spark):
    tables = {
        "a": table(spark, "id long, Address string, k long, v long, date string"),
        "b": table(spark, "ID long, address string, k long, v string, date string"),
    }
    found = typed_relationships(column_catalog(tables, rows=False))
    assert sorted(values(found.select("from_column", "confidence"))) == [("address", "HIGH"), ("k", "MEDIUM")]


def test_key_rules(spark):
    tables = {
        "z": table(spark, "user_id long, Code string, total long, unit_number long, paid string"),
        "a": table(spark, "user_id string, code string, total long, unit_number long, paid string"),
    }
    found = key_relationships(column_catalog(tables, rows=False))
    assert sorted(values(found)) == [
        ("z", "paid", "a", "paid", "potential_foreign_key", "high"),
        ("z", "unit_number", "a", "unit_number", "potential_foreign_key", "medium"),
        ("z", "user_id", "a", "user_id", "potential_foreign_key", "high"),
    ]


def test_against_brute_force(spark):
    pick = random.Random(7)
    pool = ["id", "user_id", "code", "key", "city", "zip", "address", "state", "note", "num", "time", "v"]
    spec = {f"t{i:02d}": {c: pick.choice(["long", "string"]) for c in pick.sample(pool, 5)} for i in range(20)}
    tables = {n: table(spark, ", ".join(f"{c} {t}" for c, t in cols.items())) for n, cols in spec.items()}
    catalog = column_catalog(tables, rows=False)
    names = {"long": "bigint", "string": "string"}
    key, typed = [], []
    for a, b in itertools.combinations(spec, 2):
        for c in set(spec[a]) & set(spec[b]):
            if any(w in c for w in KEY_WORDS):
                key.append((a, c, b))
            if c not in ("id", "time") and spec[a][c] == spec[b][c]:
                typed.append((a, c, b, names[spec[a][c]].upper()))
    directed = {(a, b) for a, _, b, _ in typed}
    located = {n: ", ".join(c for c in LOCATION_NAMES if c in cols) for n, cols in spec.items()}
    place = [
        (a, located[a], b, located[b]) for a, b in itertools.permutations(spec, 2)
        if located[a] and located[b] and (a, b) not in directed
    ]
    got = values(key_relationships(catalog).select("from_table", "from_column", "to_table"))
    assert sorted(got) == sorted(key)
    found = typed_relationships(catalog)
    got = [(r.from_table, r.from_column, r.to_table, r.reason.rpartition(" ")[2]) for r in found.collect()]
    assert sorted(got) == sorted(typed)
    got = values(location_relationships(catalog, found).select("from_table", "from_column", "to_table", "to_column"))
    assert sorted(got) == sorted(place)
    named = values(location_relationships(catalog, found, ["t03"]).select("from_table", "from_column", "to_table", "to_column"))
    assert sorted(named) == sorted(r for r in place if "t03" in (r[0], r[2]))
    assert typed_groups(catalog).agg({"tables": "count"}).first()[0] <= catalog.count()
    plan = relationships(catalog)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("limit", [1, 7, 50, 1000, None])
def test_view_rows_equal_the_plain_join(spark, limit):
    pick = random.Random(3)
    # one key holds a third of the rows on both sides
    left = [(pick.choice([1, 1, 1, 2, 3, 4, 5, 6, 7]), i % 5, f"l{i}") for i in range(60)]
    right = [(pick.choice([1, 1, 1, 2, 3, 4, 9]), i, f"r{i}") for i in range(50)]
    a = table(spark, "k long, n long, s string", left)
    b = table(spark, "k long, m long, s string", right)
    got = relationship_view(a, b, "k", right_name="b", limit=limit)
    assert got.columns == ["k", "n", "s", "m", "b_s"]
    full = [(*x, y[1], y[2]) for x in left for y in right if x[0] == y[0]]
    full += [(*x, None, None) for x in left if not any(x[0] == y[0] for y in right)]
    full.sort(key=lambda r: tuple((c is not None, c) for c in r))
    assert sorted(values(got), key=str) == sorted(full if limit is None else full[:limit], key=str)


def test_capped_view_cuts_both_sides_before_the_join(spark):
    a = spark.range(5000).selectExpr("id % 10 AS k", "id AS n")
    b = spark.range(5000).selectExpr("id % 10 AS k", "id AS m")
    plan = relationship_view(a, b, "k", limit=1000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "TakeOrderedAndProject" in plan


def test_views_in_a_database(spark, database):
    load_table(table(spark, "doc_id long, city string", [(1, "x"), (2, "y")]), database, "docs")
    load_table(table(spark, "doc_id long, City string", [(1, "z")]), database, "labels")
    load_table(table(spark, "zip long", [(5,)]), database, "other")
    done = analyze(spark, database)
    report = {r.view: r for r in done.views.collect()}
    assert report[f"{database}.view_docs_join_labels"].on_column == "city"
    assert spark.table(f"{database}.view_docs_join_labels").columns == ["doc_id", "city", "labels_doc_id"]
    # one location column a side, but a number against a text: reported, not published
    assert not report[f"{database}.view_docs_join_other"].created
    assert "do not compare" in report[f"{database}.view_docs_join_other"].error
    found = done.relationships
    more = create_views(spark, database, found, every_column=True)
    assert f"{database}.view_docs_join_labels_on_doc_id" in [r.view for r in more.collect()]
    view = spark.table(f"{database}.view_docs_join_labels_on_doc_id")
    assert sorted(values(view)) == [(1, "x", "z"), (2, "y", None)]
    # views are no tables: a second run finds the same
    again = analyze(spark, database, analyze_only=True)
    assert again.views is None
    assert sorted(values(again.relationships)) == sorted(values(done.relationships))
    assert sorted(values(database_catalog(spark, database).select("table_name", "num_rows").distinct())) == [
        ("docs", 2), ("labels", 1), ("other", 1)]


def test_schema_document(spark):
    wide = table(spark, ", ".join(f"c{i} long" for i in range(12)), [tuple(range(12))] * 1234)
    catalog = column_catalog({"w": wide, "n": table(spark, "a string")})
    assert "    - c11 (BIGINT)\n\n" in schema_context(catalog, "db")
    text = schema_context(catalog, "db", columns=10)
    assert text.startswith("Available tables:\n\nTable: db.n\n  Rows: 0\n  Columns:\n    - a (STRING)\n\nTable: db.w\n")
    assert "  Rows: 1,234\n" in text and "    - c9 (BIGINT)\n    ... and 2 more columns\n\n" in text
    assert "c10" not in text
    assert schema_document(catalog).count() == 2

import json
import threading

import pytest
from rows import values
from pyspark.sql import functions as F

from tablewright import (
    database_catalog, file_manifest, ingest, key_relationships, column_catalog, load_folder, load_table, load_tables,
    normalize_all,
    normalize_and_load, normalize_sheets, read_table, refresh_database, relationship_document, scan_csv, scan_tables,
    write_csv, write_relationships, write_sheets,
)
from tablewright.functions.text import path_extension, path_stem, table_name
from tablewright.operators.catalog import base_tables
from tablewright.plans.ingest import missing_files, snapshot_diff, table_changes
from tablewright.sinks import tables as sink
from tablewright.sinks.tables import drop_table, load_counts
from tablewright.sources import files
from tablewright.sources.files import folder_names


def stored(spark, database):
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary and t.tableType != "VIEW")


def test_names_from_paths(spark):
    paths = ["file:/x/My-Data set.v2.csv", "/a/b/Orders.PARQUET", "/a/.hidden", "plain"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(
        path_stem(F.col("p")), path_extension(F.col("p")), table_name(F.col("p")))
    assert values(df) == [
        ("My-Data set.v2", ".csv", "my_data_set_v2"), ("Orders", ".parquet", "orders"), (".hidden", "", "_hidden"),
        ("plain", "", "plain")]


def test_dispositions(spark, database):
    one, two = spark.range(3), spark.range(3, 5)
    assert load_table(one, database, "t") == ("t", True, 3, None)
    assert load_table(two, database, "t", "append") == ("t", True, 5, None)
    assert not load_table(two, database, "t", "empty").success
    assert load_table(two, database, "t") == ("t", True, 2, None)
    assert load_table(one.limit(0), database, "e") == ("e", True, 0, None)
    assert load_table(one, database, "e", "empty") == ("e", True, 3, None)
    assert load_table(one, database, "new", "empty") == ("new", True, 3, None)
    assert not load_table(one, database, "t", "other").success


def test_a_table_may_replace_itself(spark, database):
    load_table(spark.range(10), database, "t")
    assert load_table(spark.table(f"{database}.t").filter("id > 6"), database, "t") == ("t", True, 3, None)


def test_a_failed_load_keeps_the_old_rows(spark, database):
    load_table(spark.range(10), database, "t")
    bad = spark.range(10).select(F.raise_error(F.lit("boom")).cast("string").alias("id"))
    failed = load_table(bad, database, "t")
    assert not failed.success and "boom" in failed.error
    assert spark.table(f"{database}.t").count() == 10
    assert stored(spark, database) == ["t"]
    assert load_table(spark.range(2), database, "t").rows == 2


def test_report_goes_on_after_a_failure(spark, database):
    bad = spark.range(10).select(F.raise_error(F.lit("boom")).cast("string").alias("id"))
    report = load_tables(spark, {"a": spark.range(1), "b": bad, "c": spark.range(2)}, database)
    assert values(report.select("table", "success", "rows")) == [("a", True, 1), ("b", False, None), ("c", True, 2)]
    assert values(load_counts(report)) == [(3, 2, 1)]


def folder(tmp_path):
    root = tmp_path / "landing"
    (root / "deep").mkdir(parents=True)
    (root / "b-orders.csv").write_text('id,Unnamed: 1,when_date\n1,12 Oak Street,2024-01-05\n2,,x\n')
    (root / "a items.csv").write_text("id,price\n1,2.5\n3,\n")
    (root / "notes.txt").write_text("skip me")
    (root / "deep" / "c.csv").write_text("id,n\n7,1\n")
    (root / "parts.csv").mkdir()
    (root / "parts.csv" / "p0.csv").write_text("id,n\n1,1\n")
    (root / "parts.csv" / "p1.csv").write_text("id,n\n2,\n")
    return str(root)


def test_manifest_and_table_sets(spark, tmp_path):
    root = folder(tmp_path)
    (tmp_path / "landing" / "ev.json").write_text('{"id": 4, "t": "x"}\n')
    spark.range(3).write.parquet(root + "/nums.parquet")
    listed = {r["name"]: r for r in file_manifest(spark, root).filter("extension != '.parquet'").collect()}
    assert listed["b-orders.csv"].table_name == "b_orders" and listed["notes.txt"].extension == ".txt"
    assert listed["p0.csv"].entry == "parts.csv" and listed["c.csv"].entry == "deep/c.csv"
    assert listed["p0.csv"].length == 9 and listed["p0.csv"].size_mb == 0.0
    assert file_manifest(spark, root, (".csv",)).count() == 5
    assert list(scan_tables(spark, root)) == ["a_items", "b_orders", "ev", "nums", "parts"]
    assert list(scan_tables(spark, root, recursive=True)) == ["a_items", "b_orders", "c", "ev", "nums", "parts"]
    tables = scan_tables(spark, root)
    assert tables["parts"].count() == 2 and tables["nums"].count() == 3 and tables["ev"].count() == 1
    with pytest.raises(ValueError, match="Unsupported file type"):
        read_table(spark, root + "/notes.txt")


def test_folder_load(spark, database, tmp_path):
    report = load_folder(spark, folder(tmp_path), database)
    assert values(report.select("table", "success", "rows")) == [
        ("a_items", True, 2), ("b_orders", True, 2), ("parts", True, 2)]
    with pytest.raises(ValueError, match="Folder not found"):
        load_folder(spark, str(tmp_path / "none"), database)
    (tmp_path / "void").mkdir()
    with pytest.raises(ValueError, match="No tables found"):
        load_folder(spark, str(tmp_path / "void"), database)


def test_refresh_drops_stale_tables(spark, database):
    refresh_database(spark, {"a": spark.range(1), "b": spark.range(2)}, database)
    refresh_database(spark, {"b": spark.range(3), "c": spark.range(4)}, database)
    assert stored(spark, database) == ["b", "c"]
    assert spark.table(f"{database}.b").count() == 3


def test_skip_what_has_landed(spark, tmp_path):
    root = folder(tmp_path)
    landed = tmp_path / "landed"
    assert missing_files(spark, root, str(landed)).count() == 6
    landed.mkdir()
    (landed / "a items.csv").write_text("id\n")
    assert "a items.csv" not in [r["name"] for r in missing_files(spark, root, str(landed)).collect()]


def test_sheets(spark, tmp_path):
    sheets = {
        "My Sheet": spark.createDataFrame([(1, "x", None), (None, None, None)], "order_id long, t string, n string"),
        "Void/1": spark.createDataFrame([(None,)], "a string"),
        "Other": spark.createDataFrame([(1, 2.0)], "order_id long, v double"),
    }
    done = normalize_sheets(sheets, "book")
    assert {n: (t.rows, t.columns) for n, t in done.tables.items()} == {
        "book_My_Sheet": (1, ["order_id", "t"]), "book_Other": (1, ["order_id", "v"])}
    assert values(done.relationships) == [
        ("book_My_Sheet", "order_id", "book_Other", "order_id", "potential_foreign_key", "high")]
    reports = None
    for name, t in done.tables.items():
        row = t.report(name).withColumn("path", F.lit(f"/x/{name}.csv"))
        reports = row if reports is None else reports.unionByName(row)
    text = json.loads(relationship_document(reports, done.relationships).first().value)
    assert text["sheets"]["book_Other"] == {
        "path": "/x/book_Other.csv", "rows": 1, "cols": 2, "columns": ["order_id", "v"]}
    assert text["relationships"][0]["to_table"] == "book_Other"
    out = str(tmp_path / "rel.json")
    assert write_relationships(reports, done.relationships, out)
    lines = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert [x["relationship"] for x in lines if "relationship" in x] == text["relationships"]
    assert {x["sheet"].pop("table"): x["sheet"] for x in lines if "sheet" in x} == text["sheets"]
    assert sorted(r.state for r in done.status.collect()).count("kept") == 2
    written = write_sheets(sheets, str(tmp_path / "set"), "book")
    assert values(scan_csv(spark, str(tmp_path / "set" / "book_Other.csv"))) == [("1", "2")]
    assert spark.read.text(str(tmp_path / "set" / "book_relationships.json")).count() == 3 and len(written.tables) == 2
    none = done.relationships.limit(0)
    assert not write_relationships(reports, none, str(tmp_path / "none.json"))
    assert normalize_sheets({"v": sheets["Void/1"]}).relationships is None


def test_normalize_all_records_failures(spark, tmp_path):
    root = folder(tmp_path)
    done = normalize_all(spark, {"a": root + "/b-orders.csv", "b": root + "/none.csv", "c": root + "/notes.txt"})
    assert values(done.status.select("table", "ok")) == [("a", True), ("b", False), ("c", False)]
    assert done.tables["a"].columns == ["id", "address_2", "when_date"]
    assert values(done.tables["a"].data) == [(1, "12 Oak Street", "2024-01-05"), (2, None, None)]


def test_normalize_and_load(spark, database, tmp_path):
    root = folder(tmp_path)
    load_table(spark.range(1), database, "stale")
    load_table(spark.range(1), database, "bad")
    counts = normalize_and_load(spark, {"items": root + "/a items.csv", "bad": root + "/none.csv"}, database)
    assert values(counts) == [(2, 1, 1)]
    assert stored(spark, database) == ["bad", "items"]
    assert sorted(values(spark.table(f"{database}.items"))) == [(1, 2.5), (3, 0.0)]


def test_ingest(spark, database, tmp_path):
    report, done = ingest(spark, folder(tmp_path), database)
    assert report.filter("success").count() == 3
    # `id` is too generic to relate tables by type; `n` and the rest are unique
    assert done.relationships.count() == 0 and done.views.count() == 0
    tables = {n: spark.table(f"{database}.{n}") for n in stored(spark, database)}
    assert key_relationships(column_catalog(tables, rows=False)).count() == 3


def test_a_failed_swap_leaves_the_old_rows(spark, database, monkeypatch):
    """The swap by two renames, for a table whose columns change."""
    load_table(spark.range(3), database, "x")
    spark.sql(f"COMMENT ON TABLE {database}.x IS 'what''s here'")
    spark.sql(f"ALTER TABLE {database}.x SET TBLPROPERTIES ('team' = 'a''b')")
    assert load_table(spark.range(5).withColumn("more", F.lit(1)), database, "x").rows == 5
    assert spark.catalog.getTable(f"{database}.x").description == "what's here"
    assert spark.sql(f"SHOW TBLPROPERTIES {database}.x ('team')").first().value == "a'b"
    real, calls = sink._rename, []

    def broken(session, old, new):
        calls.append(new)
        if len(calls) == 2:
            raise ValueError("no rename")
        real(session, old, new)

    monkeypatch.setattr(sink, "_rename", broken)
    done = load_table(spark.range(9), database, "x")
    assert not done.success and spark.table(f"{database}.x").count() == 5
    assert [t.name for t in spark.catalog.listTables(database)] == ["x"]


def test_an_interrupted_swap_is_finished_by_the_next_load(spark, database):
    load_table(spark.range(3), database, "x")
    spark.sql(f"ALTER TABLE {database}.x RENAME TO {database}.x__replaced")
    assert base_tables(spark, database) == {}
    assert load_table(spark.range(2), database, "x", "append").rows == 5


def test_record_caps_do_not_lose_rows(spark, tmp_path):
    old = spark.conf.get("spark.sql.files.maxRecordsPerFile")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 10)
    try:
        write_csv(spark.range(100).coalesce(2), str(tmp_path / "c.csv"))
    finally:
        spark.conf.set("spark.sql.files.maxRecordsPerFile", old)
    assert scan_csv(spark, str(tmp_path / "c.csv")).count() == 100


def test_a_second_ingest_loads_what_is_new(spark, database, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("a_id,v\n1,2\n")
    (folder / "b.csv").write_text("a_id,w\n1,x\n")
    first, done = ingest(spark, str(folder), database)
    assert sorted(r.table for r in first.collect()) == ["a", "b"] and done.views.count() == 1
    again, _ = ingest(spark, str(folder), database)
    assert again.count() == 0 and stored(spark, database) == ["a", "b", "files__landed"]
    (folder / "b.csv").write_text("a_id,w\n1,x\n2,yy\n")
    (folder / "c.csv").write_text("k\n1\n")
    more, _ = ingest(spark, str(folder), database)
    assert sorted((r.table, r.rows) for r in more.collect()) == [("b", 2), ("c", 1)]


def test_readers_find_old_or_new_rows_during_loads(spark, database):
    """Loads that change neither columns nor kind are one catalog call; versions that nobody needs are deleted."""
    load_table(spark.range(1000), database, "x")
    spark.sql(f"ALTER TABLE {database}.x SET TBLPROPERTIES ('team' = 'a')")
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(spark.table(f"{database}.x").count())
            except Exception as problem:  # whatever a reader meets is a failure of the swap
                seen.append(str(problem))

    reader = threading.Thread(target=read)
    reader.start()
    done = [load_table(spark.range(n * 1000), database, "x").rows for n in (2, 3, 4, 5)]
    stop.set()
    reader.join()
    assert done == [2000, 3000, 4000, 5000] and len(seen) > 3
    assert set(seen) <= {1000, 2000, 3000, 4000, 5000} and seen == sorted(seen)
    assert spark.sql(f"SHOW TBLPROPERTIES {database}.x ('team')").first().value == "a"
    root = spark.catalog.getDatabase(database).locationUri
    assert sum(n.startswith("x") for n in folder_names(spark, root)) == 2
    drop_table(spark, database, "x")
    assert folder_names(spark, root) == [] and not spark.catalog.tableExists(f"{database}.x")
    assert load_table(spark.range(2), database, "x").rows == 2


def test_a_failed_pointer_leaves_the_old_rows(spark, database, monkeypatch):
    load_table(spark.range(3), database, "x")

    def broken(*_):
        raise ValueError("no catalog")

    monkeypatch.setattr(sink, "_set_location", broken)
    assert not load_table(spark.range(9), database, "x").success
    assert spark.table(f"{database}.x").count() == 3
    assert len(folder_names(spark, spark.catalog.getDatabase(database).locationUri)) == 1


def test_tables_of_other_kinds_are_replaced_by_renames(spark, database, tmp_path):
    spark.range(4).write.option("path", str(tmp_path / "own")).saveAsTable(f"{database}.outside")
    spark.range(4).write.format("json").saveAsTable(f"{database}.lines")
    for name in ("outside", "lines"):
        assert load_table(spark.range(6), database, name).rows == 6
        assert spark.table(f"{database}.{name}").count() == 6
    assert spark.read.parquet(str(tmp_path / "own")).count() == 4


def test_loads_count_on_the_way(spark, database):
    """No second pass over the rows: the source is read once."""
    read = spark.sparkContext.accumulator(0)
    tick = F.udf(lambda x: read.add(1) or x, "long").asNondeterministic()
    rows = spark.range(50).select(tick("id").alias("id"))
    assert load_table(rows, database, "x").rows == 50 and load_table(rows, database, "x").rows == 50
    assert load_table(rows.filter("id > 100"), database, "e") == ("e", True, 0, None)
    assert load_table(rows, database, "e", "empty").rows == 50 and read.value == 200


def test_hidden_and_empty_files(spark, database, tmp_path):
    root = tmp_path / "in"
    (root / "deep" / "_x").mkdir(parents=True)
    (root / "parts.csv").mkdir()
    for name, text in {"a.csv": "k\n1\n", "_x.csv": "k\n1\n", ".y.csv": "k\n", "void.csv": "", "deep/_x/z.csv": "k\n",
                       "parts.csv/p0.csv": "k\n1\n", "parts.csv/_SUCCESS": "", "parts.csv/.p0.csv.crc": "x"}.items():
        (root / name).write_text(text)
    listed = {r.path.partition("/in/")[2]: (r.length, r.hidden) for r in file_manifest(spark, str(root)).collect()}
    assert listed == {
        "a.csv": (4, False), "_x.csv": (4, True), ".y.csv": (2, True), "void.csv": (0, False), "deep/_x/z.csv": (2, True),
        "parts.csv/p0.csv": (4, False), "parts.csv/_SUCCESS": (0, True), "parts.csv/.p0.csv.crc": (1, True)}
    shallow = {r.path.partition("/in/")[2] for r in file_manifest(spark, str(root), recursive=False).collect()}
    assert shallow == set(listed) - {"deep/_x/z.csv"}
    with pytest.warns(UserWarning, match="_x.csv"):
        assert list(scan_tables(spark, str(root))) == ["a", "parts"]
    report = {r.table: r.error for r in load_folder(spark, str(root), database).collect()}
    assert set(report) == {"a", "parts", "_x.csv", ".y.csv", "void.csv"}
    assert report["a"] is None and report["_x.csv"].startswith("hidden") and report["void.csv"].startswith("empty")


def test_folders_are_listed_round_by_round(spark, tmp_path, monkeypatch):
    """Tasks that may list two entries each: what is left goes to the next round, and nothing is lost."""
    monkeypatch.setattr(files, "FOLLOWED", 2)
    want = set()
    for i in range(4):
        for j in range(3):
            deep = tmp_path / f"f {i}" / f"g%{j}"
            deep.mkdir(parents=True)
            (deep / f"{i}-{j}.csv").write_text("k\n")
            want.add(f"f {i}/g%{j}/{i}-{j}.csv")
    assert {r.inner for r in files.list_files(spark, str(tmp_path)).collect()} == want


def test_stores_without_an_arrow_driver_are_listed_by_spark(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "_readable_by_arrow", lambda root: False)
    root = folder(tmp_path)
    assert file_manifest(spark, root, (".csv",)).count() == 5
    assert list(scan_tables(spark, root)) == ["a_items", "b_orders", "parts"]


def test_stored_tables_are_counted_by_one_scan(spark, database):
    """Fourteen tables, empty, partitioned and reloaded ones among them: one relation in the plan."""
    from tablewright.operators.catalog import stored_rows

    for i in range(11):
        load_table(spark.range(i), database, f"t{i}")
    load_table(spark.range(70), database, "t7")
    spark.range(50).selectExpr("id", "id % 3 AS k", "'a b+%' AS s").write.partitionBy("k", "s").saveAsTable(f"{database}.parts")
    spark.range(4).write.format("json").saveAsTable(f"{database}.lines")
    want = {f"t{i}": i for i in range(11)} | {"t7": 70, "parts": 50}
    counted = stored_rows(spark, database)
    assert dict(values(counted)) == want
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    catalog = {r.table_name: r.num_rows for r in database_catalog(spark, database, {"t3": 33}).collect()}
    assert catalog == want | {"lines": 4, "t3": 33}


def test_stored_tables_are_counted_without_an_expression_a_row(spark, database):
    """Folders are found from the counted files: below the count by file, no text is matched, filters included."""
    from tablewright.operators.catalog import stored_rows

    for i in range(3):
        load_table(spark.range(i), database, f"t{i}")
    counted = stored_rows(spark, database)
    above, _, count = counted._jdf.queryExecution().optimizedPlan().toString().rpartition("Aggregate")
    keys, below = count.partition("]")[0], count.partition("\n")[2]
    assert "Relation" in below and not any(f in keys + below for f in ("regexp_replace", "UrlCodec"))
    assert above.count("Aggregate") == 1 and dict(values(counted)) == {"t0": 0, "t1": 1, "t2": 2}


def test_content_decides_what_has_landed(spark, tmp_path):
    for place, name, text in (("a", "x.csv", "k\n1\n2\n"), ("a", "y.csv", "k\n3\n"), ("a", "z.csv", "k\n4\n"), ("a", "e.csv", ""),
                              ("b", "copy of x.csv", "k\n2\n1\n"), ("b", "y.csv", "k\n5\n"), ("b", "also empty.csv", "")):
        (tmp_path / place).mkdir(exist_ok=True)
        (tmp_path / place / name).write_text(text)
    missing = missing_files(spark, str(tmp_path / "a"), str(tmp_path / "b"), by_content=True)
    assert sorted(r["name"] for r in missing.collect()) == ["y.csv", "z.csv"]


def test_ingest_follows_deletions(spark, database, tmp_path):
    """Part files, tables and views that left the folder leave the database; what fails is tried again."""
    root = tmp_path / "in"
    (root / "orders.csv").mkdir(parents=True)
    (root / "orders.csv" / "p0.csv").write_text("cust_no,v\n1,2\n")
    (root / "orders.csv" / "p1.csv").write_text("cust_no,v\n2,2\n3,3\n")
    (root / "cust.csv").write_text("cust_no,w\n1,x\n")
    (root / "same.csv").write_text("z\n1\n")
    (root / "bad.parquet").write_text("not parquet")
    states = lambda report: {r.table: r.state for r in report.collect()}
    first, done = ingest(spark, str(root), database)
    assert states(first) == dict.fromkeys(("orders", "cust", "same", "bad"), "new") and done.views.count() == 1
    assert spark.table(f"{database}.view_cust_join_orders").count() == 1
    (root / "orders.csv" / "p1.csv").unlink()
    (root / "cust.csv").unlink()
    second, done = ingest(spark, str(root), database)
    assert states(second) == {"orders": "changed", "cust": "gone", "bad": "changed"}
    assert values(spark.table(f"{database}.orders")) == [(1, 2)] and spark.table(f"{database}.same").count() == 1
    assert sorted(t.name for t in spark.catalog.listTables(database)) == ["files__landed", "orders", "same"]
    (root / "bad.parquet").unlink()
    assert states(ingest(spark, str(root), database)[0]) == {"bad": "gone"}
    assert states(ingest(spark, str(root), database)[0]) == {}


def test_snapshot_diff(spark):
    schema = "table string, path string, length long, modified long"
    now = [("a", "a/1", 1, 1), ("a", "a/2", 2, 2), ("b", "b", 1, 1), ("d", "d", 1, 1), ("e", "e", 9, 1), ("g2", "g", 1, 1)]
    then = [("a", "a/1", 1, 1), ("a", "a/2", 2, 1), ("b", "b", 1, 1), ("c", "c", 1, 1), ("e", "e", None, 1), ("g", "g", 1, 1)]
    now, then = spark.createDataFrame(now, schema), spark.createDataFrame(then, schema)
    assert sorted(values(snapshot_diff(now, then))) == [
        ("a", "a/1", "same"), ("a", "a/2", "changed"), ("b", "b", "same"), ("c", "c", "gone"), ("d", "d", "new"),
        ("e", "e", "changed"), ("g2", "g", "changed")]
    assert sorted(values(table_changes(now, then))) == [
        ("a", "changed"), ("b", "same"), ("c", "gone"), ("d", "new"), ("e", "changed"), ("g", "gone"), ("g2", "new")]
    assert table_changes(now.limit(0), then.limit(0)).count() == 0


def test_one_document_of_many_parts(spark, tmp_path):
    """Part files, put together by name, are the document that one task would have made."""
    from tablewright.sinks.metadata import write_document

    reports = spark.createDataFrame(
        [(f't "{i:03}"\n', f"/x/{i}.csv", i, 1, ["a", 'b"']) for i in range(300)],
        "table string, path string, rows long, cols int, columns array<string>")
    found = spark.createDataFrame(
        [(f"t{i}", "id", f"t{i + 1}", "id", "potential_foreign_key", "high") for i in range(500)] * 2,
        "from_table string, from_column string, to_table string, to_column string, relationship_type string, confidence string")
    assert write_document(reports, found.distinct(), str(tmp_path / "doc"), 8)
    parts = sorted((tmp_path / "doc").glob("part-*"))
    assert len(parts) == 8 and max(p.stat().st_size for p in parts) < 0.5 * sum(p.stat().st_size for p in parts)
    written = json.loads("".join(p.read_text() for p in parts))
    assert written == json.loads(relationship_document(reports, found.distinct()).first().value)
    assert not write_document(reports, found.limit(0), str(tmp_path / "none"))


def test_scratch_can_be_cleared(spark):
    kept = files.stored(spark.range(5), "kept")
    path = kept.inputFiles()[0].rpartition("/")[0]
    assert files.path_exists(spark, path)
    files.clear_scratch(spark)
    assert not files.path_exists(spark, path)

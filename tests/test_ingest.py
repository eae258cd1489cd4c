import datetime

import pytest
from pyspark.sql import functions as F

from fieldmart.operators import clean, marts
from fieldmart.sources import ingest, publish

DAY = datetime.date(2026, 3, 1)


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_scan_is_all_text_with_blanks(spark, tmp_path):
    path = write(tmp_path, "a.csv", "id,name,age\n1,Alice,30\n2,,25\n")
    df = ingest.scan_text_table(spark, path)
    assert {t for _, t in df.dtypes} == {"string"}
    assert sorted(tuple(r) for r in df.collect()) == [("1", "Alice", "30"), ("2", "", "25")]


def test_manifest_provenance_and_ledger(spark, tmp_path):
    write(tmp_path, "in/a/x.CSV", "id\n1\n")
    write(tmp_path, "in/b/y.csv", "id\n2\n")
    write(tmp_path, "in/b/z.txt", "no")
    manifest = ingest.file_manifest(spark, str(tmp_path / "in"))
    assert manifest.count() == 2
    good, failures = ingest.read_many_isolated(spark, [str(tmp_path / "in/a/x.CSV"), str(tmp_path / "in/b/y.csv")], ["id"])
    assert failures.count() == 0
    places = spark.createDataFrame([(f"file:{tmp_path}/in/a", "kenya", "one"), (f"file:{tmp_path}/in", "uganda", "two"), (f"file://{tmp_path}/in/a", "kenya", "one"), (f"file://{tmp_path}/in", "uganda", "two")], "prefix string, country string, community string")
    rows = ingest.add_provenance(good, places, "run", datetime.datetime(2026, 3, 1)).collect()
    assert sorted((r.id, r.country, r.file_name) for r in rows) == [("1", "kenya", "x.CSV"), ("2", "uganda", "y.csv")]
    ledger = manifest.selectExpr("file_path", "last_modified", "true as loaded")
    assert ingest.incremental_new_files(manifest, ledger).count() == 0
    assert ingest.incremental_new_files(manifest, None).count() == 2
    ingest.append_once(good, ledger.withColumn("extracted_at", F.current_timestamp()), str(tmp_path / "t"), str(tmp_path / "l"), "r1")
    assert ingest.committed(spark, str(tmp_path / "t"), str(tmp_path / "l")).count() == 2


def test_provenance_keeps_every_row(spark):
    """Equal rows of one file stay several; a file that no place fits keeps its rows too."""
    df = spark.createDataFrame([("/in/a/x.csv", "1")] * 2 + [("/in/b/y.csv", "1"), ("/out/z.csv", "1")], "file_path string, id string")
    places = spark.createDataFrame([("/in/", "kenya", "one"), ("/in/a/", "uganda", "two"), ("/in/a/", "uganda", "three")], "prefix string, country string, community string")
    rows = ingest.add_provenance(df, places, "run", datetime.datetime(2026, 3, 1)).collect()
    assert sorted((r.file_path, r.country or "", r.community or "") for r in rows) == [("/in/a/x.csv", "uganda", "two")] * 2 + [("/in/b/y.csv", "kenya", "one"), ("/out/z.csv", "", "")]
    assert {(r.run_uuid, r._source_db == r.file_path) for r in rows} == {("run", True)}


def test_marts_are_built_in_order(spark, tmp_path):
    silver = spark.createDataFrame([("a", "S1", "1", "2", "t", "1"), (None, "S2", "0", "2", "t", "1")], "uniqueid string, subjid string, consent string, countrycode string, tabletnum string, mobile_number string").selectExpr("*", "'x' as screening_id")
    folder = str(tmp_path / "gold")
    assert len(publish.build_marts(marts.all_marts(silver), folder)) == 3
    assert [publish.current(spark, folder, name).count() for name in ("baseline", "enrollment", "qc_checks")] == [1, 1, 1]
    with pytest.raises(ValueError):
        publish.build_marts({"no name": silver}, folder)


def test_marts_derive_silver_once(spark, monkeypatch):
    """Three marts are written, but every landed row is read once."""
    from fieldmart.plans import written

    rows = written.demo.landed(spark, "/root/testdata/sf0.001")
    seen, n = spark.sparkContext.accumulator(0), rows.count()

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(written.demo, "landed", lambda *_: rows.mapInArrow(counted, rows.schema))
    assert written.QUERIES["marts_with_audit"](spark, "/root/testdata/sf0.001").count() == 3
    assert seen.value == n


def test_run_audit_appends(spark, tmp_path):
    folder, at = str(tmp_path / "audit"), datetime.datetime(2026, 3, 1, 12)
    publish.run_audit(spark, "r1", "silver", 7, at, folder)
    publish.run_audit(spark, "r2", "silver", 9, at, folder)
    assert sorted(tuple(r) for r in spark.read.parquet(folder).collect()) == [("r1", "silver", 7, at), ("r2", "silver", 9, at)]


def test_bad_file_is_isolated(spark, tmp_path):
    good = write(tmp_path, "g.csv", "id,name\n1,a\n")
    bad = write(tmp_path, "b.csv", "id,name\n1,a,too,many\n")
    rows, failures = ingest.read_many_isolated(spark, [good, bad], ["id", "name"])
    assert [r.id for r in rows.collect()] == ["1"]
    assert [r.file_path for r in failures.collect()] == [bad]


def test_a_file_loads_or_fails_as_a_whole(spark, tmp_path):
    mixed = write(tmp_path, "m.csv", "id,name\n1,a\n2,b,too,many\n")
    bare = write(tmp_path, "h.csv", "id,name\n")
    rows, failures = ingest.read_many_isolated(spark, [mixed, bare], ["id", "name"])
    assert rows.count() == 0
    assert [r.file_path for r in failures.collect()] == [mixed]


def test_latest_snapshot(spark):
    paths = ["/r/Tablet221_2026_02_01-10_00_00/p.mdb", "/r/Tablet221_2026_04_01-10_00_00/p.mdb", "/r/Tablet221_2026_05_01-10_00_00/DataBackup/p.mdb", "/r/Tablet111_2026_04_01-10_00_00/p.mdb", "/r/p.mdb"]
    df = spark.createDataFrame([(p,) for p in paths], "file_path string")
    assert [r.file_path for r in ingest.latest_snapshot_per_device(df, ["tablet111"]).collect()] == [paths[1]]
    assert [r.file_path for r in ingest.latest_snapshot_per_device(df.filter("file_path = '/r/p.mdb'")).collect()] == ["/r/p.mdb"]
    assert ingest.latest_snapshot_per_device(df, suffixes=["/P.MDB"]).count() == 0


def test_latest_archive(spark):
    names = ["Tablet221_2026_02_01-10_00_00.7z", "Tablet221_2026_04_01-10_00_00.7z", "README.txt", "some_other_file.7z"]
    df = spark.createDataFrame([(n,) for n in names], "archive string")
    assert [(r.device, r.archive) for r in ingest.latest_archive_per_device(df).collect()] == [("Tablet221", names[1])]


def test_dedup_is_idempotent(spark):
    df = spark.createDataFrame([(1, "a", "2", "s", "kenya", None), (2, "a", "2", "t", "kenya", None), (3, None, "2", "s", "kenya", None), (4, None, "2", "s", "kenya", None), (5, "b", "1", "s", "kenya", None)], "row_id long, uniqueid string, countrycode string, _source_db string, country string, extracted_at timestamp")
    once = clean.dedup_latest(df)
    assert sorted(r.row_id for r in once.collect()) == [2, 3, 4, 5]
    assert sorted(r.row_id for r in clean.dedup_latest(once).collect()) == [2, 3, 4, 5]
    assert sorted(r.row_id for r in clean.silver(df).collect()) == [2, 3, 4]
    assert clean.dedup_exact(df.drop("row_id")).count() == 3


def test_publish_and_snapshots(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    gold, prod, store = (str(tmp_path / x) for x in ("gold", "prod", "store"))
    publish.overwrite_table(df, gold, "baseline")
    publish.overwrite_table(df.filter("id = 1"), gold, "baseline")
    assert publish.current(spark, gold, "baseline").count() == 1
    publish.publish_tables(spark, ["baseline"], gold, prod)
    assert publish.current(spark, prod, "baseline").count() == 1
    for bad in ("d_participant; DROP TABLE x", "bad-name!"):
        with pytest.raises(ValueError):
            publish.publish_tables(spark, [bad], gold, prod)
    assert publish.snapshot_append(df.filter("id = 1"), store, DAY) == "new"
    assert publish.snapshot_append(df, store, DAY) == "redo"
    assert publish.snapshot_append(df, store, DAY) == "skip"
    assert spark.read.parquet(store).count() == 2


def test_csv_guard(spark, tmp_path):
    df = spark.createDataFrame([("=1",), ("ok",), ("-x",)], "t string")
    assert sorted(r.t for r in publish.csv_safe(df).collect()) == ["'-x", "'=1", "ok"]
    assert publish.report_exports({"weekly": df}, str(tmp_path))["weekly"].endswith("weekly")


def test_schema_drift(spark):
    types = spark.createDataFrame([("a", "x", "int64"), ("a", "y", "object"), ("b", "x", "float64"), ("c", "x", "int64"), ("c", "y", "int64")], "file string, column string, dtype string")
    assert [tuple(r) for r in ingest.schema_missing_columns(types).collect()] == [("b", 1, "y")]
    assert [tuple(r) for r in ingest.schema_type_conflicts(types).collect()] == [("y", "int64, object")]


def test_templates(spark):
    sheet = spark.createDataFrame([(" Arm ", "Hi   there", "On [date here]"), (" ", "x", "y"), ("B", None, "z")], "arm string, week_8 string, week_11 string")
    got = sorted(tuple(r) for r in ingest.templates_long(sheet, "English").collect())
    assert got == [("Arm", "English", 8, "Hi there", False), ("Arm", "English", 11, "On [date here]", True), ("B", "English", 11, "z", False)]


def test_new_files_by_ledger_rows_of_other_events(spark, tmp_path):
    """Two events of a device in one second have one path: the later's ledger row, a step older, is the earlier file's."""
    import duckdb

    from fieldmart.plans import registry

    at = datetime.datetime(2024, 1, 1, 10, 0, 0)
    events = spark.createDataFrame([(20, at, 5), (21, at, 5), (24, at, 6)], "event_id long, ts timestamp_ntz, user_id long")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    found = {r.last_modified for r in registry.QUERIES["incremental_new_files"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    stated = {r[1] for r in con.execute(registry.ORACLE_SQL["incremental_new_files"]).fetchall()}
    assert found == stated == {21}

"""Versions, publishing and ordered exports."""

import csv
import threading

import pytest

from fieldmart.operators import ordering
from fieldmart.sources import publish


@pytest.fixture
def database(spark, tmp_path):
    name = f"prod_{tmp_path.name.replace('-', '_').lower()}"
    spark.sql(f"CREATE DATABASE {name} LOCATION 'file:{tmp_path}/prod'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def versions(spark, database):
    return [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect() if "__v" in r.tableName]


def test_views_over_a_published_name_stay_and_show_new_rows(spark, database):
    publish.publish_catalog({"baseline": spark.range(3), "other": spark.range(1)}, database)
    spark.sql(f"CREATE VIEW {database}.big AS SELECT id FROM {database}.baseline WHERE id > 0")
    assert spark.table(f"{database}.big").count() == 2
    publish.publish_catalog({"baseline": spark.range(10)}, database)
    assert spark.table(f"{database}.big").count() == 9 and spark.table(f"{database}.other").count() == 1
    assert len(versions(spark, database)) == 2


def test_a_failure_leaves_the_old_state(spark, database):
    publish.publish_catalog({"a": spark.range(1), "b": spark.range(1)}, database)
    broken = spark.range(2).selectExpr("id", "raise_error('no') as x")
    with pytest.raises(Exception, match="no"):
        publish.publish_catalog({"a": spark.range(5), "b": broken}, database)
    assert spark.table(f"{database}.a").count() == 1
    for bad in ("d_participant; DROP TABLE x", "bad-name!"):
        with pytest.raises(ValueError):
            publish.publish_catalog({"a": spark.range(5), bad: spark.range(1)}, database)
    spark.range(1).write.saveAsTable(f"{database}.own")
    with pytest.raises(ValueError):
        publish.publish_catalog({"own": spark.range(5)}, database)
    assert spark.table(f"{database}.a").count() == 1
    publish.publish_catalog({"a": spark.range(7)}, database)
    assert spark.table(f"{database}.a").count() == 7 and len([v for v in versions(spark, database) if v.startswith("a__")]) == 1


def test_publishers_at_once_show_one_of_them(spark, database):
    errors = []

    def run(n):
        try:
            publish.publish_catalog({"t": spark.range(n)}, database)
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=run, args=(n,)) for n in (10, 20)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and spark.table(f"{database}.t").count() in (10, 20)


def test_overwrites_take_numbers_and_drop_old_versions(spark, tmp_path):
    folder = str(tmp_path / "gold")
    threads = [threading.Thread(target=publish.overwrite_table, args=(spark.range(n), folder, "t")) for n in (1, 2, 3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len({n for n, _ in publish._versions(spark, folder, "t")}) == len(publish._versions(spark, folder, "t"))
    publish.overwrite_table(spark.range(9), folder, "t")
    assert publish.current(spark, folder, "t").count() == 9
    assert len(publish._versions(spark, folder, "t")) == 2
    with pytest.raises(ValueError):
        publish.current(spark, folder, "none")


def test_places_run_through_all_partitions(spark):
    rows = [(i * 7919 % 1000, None if i % 9 == 0 else i % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = ordering.placed(df, ["b", "-a"]).orderBy("place").collect()
    assert [r.place for r in got] == list(range(1, 3001))
    assert [(r.b, r.a) for r in got] == sorted(((b, a) for a, b in rows), key=lambda x: (x[0] is None, x[0] or 0, -x[1]))
    assert ordering.placed(df.limit(0), ["a"]).count() == 0


def test_exported_files_in_the_order_of_their_names_are_sorted(spark, tmp_path):
    rows = [(str(i * 7919 % 40), i % 3, i * 31 % 5000, f"=s{i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "site_code string, week int, sent_at_local int, t string").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    place = publish.report_exports({"delivery_linelist": df}, str(tmp_path))["delivery_linelist"]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "delivery_linelist").glob("part-*.csv"))
    got = [(r["site_code"], int(r["week"]), int(r["sent_at_local"]), r["t"]) for f in files for r in csv.DictReader(f.open())]
    assert len(files) > 1 and got == sorted((a, b, c, f"'{t}") for a, b, c, t in rows) and place.endswith("delivery_linelist")


def test_id_parts_are_bounded_and_complete(spark):
    rows = [("a" if i % 3 else None, f"s{i:05d}", i) for i in range(2500)] * 2 + [("b", None, 1)]
    parts = ordering.id_parts(spark.createDataFrame(rows, "site string, id string, place int"), ["site"], "id", 100).collect()
    assert max(len(p.ids) for p in parts) == 100 and not [p for p in parts if p.site == "b"]
    for site in ("a", None):
        own = sorted((p for p in parts if p.site == site), key=lambda p: p.part)
        assert [i for p in own for i in p.ids] == sorted({i for s, i, _ in rows if s == site and i}) and [p.part for p in own] == list(range(len(own)))

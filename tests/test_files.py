"""Landing of files: one read each, whole or not at all, types, ledgers and streams."""

import datetime

import pyarrow as pa
import pytest

from fieldmart.session import folders
from fieldmart.sources import files, ingest

AT = datetime.datetime(2026, 3, 1)


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


@pytest.fixture
def drifted(tmp_path):
    """Files of three form versions, and five that don't load."""
    made = {
        "t1/a.csv": "id,name,age,dob\n1,Ann,30,x\n2,\"B, b\",,y\n",
        "t2/a.csv": "id,name,age\n3,Cy,41\n",
        "t3/a.CSV": "id,name,age,dob\n4,\"two\nlines\",old,z\n",
        "t4/a.csv": "id,name,age,dob\n",
        "t5/a.csv": "id,name\n1,a\n2,b,too,many\n",
        "t6/a.csv": "id,name\n1\n",
        "t7/a.csv": b"id,name\n1,\xff\xfe\n",
        "t8/a.csv": "",
        "t9/a.csv": "id,id\n1,2\n",
        "t9/notes.txt": "none of these",
    }
    for name, text in made.items():
        write(tmp_path / "in", name, text)
    return str(tmp_path / "in")


def test_each_file_is_opened_once_and_fails_alone(spark, drifted):
    opened = spark.sparkContext.accumulator(0)
    landing = files.land(spark, drifted, opened=opened)
    rows = landing.table()
    for _ in range(2):
        assert sorted((r.id, r.name, r.age, r.dob) for r in rows.collect()) == [("1", "Ann", "30", "x"), ("2", "B, b", "", "y"), ("3", "Cy", "41", None), ("4", "two\nlines", "old", "z")]
        assert sorted(r.label for r in landing.failures().collect()) == ["t5", "t6", "t7", "t8", "t9"]
        assert {r.label: r.n_rows for r in landing.loaded().collect()} == {"t1": 2, "t2": 1, "t3": 1, "t4": 0}
    assert opened.value == 8  # all but the empty one


def test_schema_checks_from_files(spark, drifted):
    types = files.land(spark, drifted).column_types()
    got = {(r.file, r.column): r.dtype for r in types.collect()}
    assert got[("t1", "age")] == "float64" and got[("t2", "age")] == "int64" and got[("t3", "age")] == "object" and got[("t4", "age")] == "float64"
    assert [tuple(r) for r in ingest.schema_missing_columns(types).collect()] == [("t2", 3, "dob")]
    assert sorted(tuple(r) for r in ingest.schema_type_conflicts(types).collect()) == [("age", "float64, int64, object"), ("dob", "float64, object"), ("name", "float64, object")]


@pytest.mark.parametrize(("values", "kind"), [(["1", "-2"], "int64"), (["1", ""], "float64"), (["1.5", "2"], "float64"), (["1e3"], "float64"), ([""], "float64"), ([], "float64"), (["True", "false"], "bool"), (["True", ""], "object"), (["1", "x"], "object"), (["nan"], "object")])
def test_inferred_types(values, kind):
    assert files.inferred(pa.array(values, pa.string())) == kind


def test_no_file_at_all(spark, tmp_path):
    write(tmp_path / "in", "x/readme.txt", "no")
    landing = files.land(spark, str(tmp_path / "in"))
    assert landing.rows.count() == 0 and landing.files.count() == 0 and landing.table(["id"]).count() == 0


def places(spark, tmp_path):
    return spark.createDataFrame([(f"file:{tmp_path}/in", "kenya", "one")], "prefix string, country string, community string")


def load(spark, tmp_path, run):
    return ingest.load_new_files(spark, str(tmp_path / "in"), places(spark, tmp_path), str(tmp_path / "t"), str(tmp_path / "l"), run, AT)


def shown(spark, tmp_path):
    return sorted((r.id, r.country) for r in ingest.committed(spark, str(tmp_path / "t"), str(tmp_path / "l")).collect())


def test_a_run_that_dies_between_data_and_ledger_adds_nothing(spark, tmp_path, monkeypatch):
    write(tmp_path / "in", "a/x.csv", "id\n1\n1\n")
    load(spark, tmp_path, "r1")
    write(tmp_path / "in", "b/y.csv", "id,late\n2,x\n")
    once = ingest.append_once

    def dies(rows, entries, table, ledger, run_id):
        rows.withColumn("run_uuid", ingest.F.lit(run_id)).write.mode("overwrite").parquet(f"{table}/{run_id}")
        raise OSError("lost")

    monkeypatch.setattr(ingest, "append_once", dies)
    for _ in range(2):
        with pytest.raises(OSError):
            load(spark, tmp_path, "r2")
    assert shown(spark, tmp_path) == [("1", "kenya")] * 2
    monkeypatch.setattr(ingest, "append_once", once)
    for run in ("r3", "r3", "r4", "r4"):
        load(spark, tmp_path, run)
        assert shown(spark, tmp_path) == [("1", "kenya")] * 2 + [("2", "kenya")]
    assert ingest.remove_uncommitted(spark, str(tmp_path / "t"), str(tmp_path / "l"), datetime.timedelta(hours=1)) == []
    assert ingest.remove_uncommitted(spark, str(tmp_path / "t"), str(tmp_path / "l"), datetime.timedelta(0)) == ["r2", "r4"]  # r4 found nothing to load
    assert sorted(n for n, _ in folders(spark, str(tmp_path / "t"))) == ["r1", "r3"]
    assert len(shown(spark, tmp_path)) == 3
    with pytest.raises(ValueError):
        load(spark, tmp_path, "../r")


def test_two_runs_that_load_the_same_file_count_once(spark, tmp_path):
    write(tmp_path / "in", "a/x.csv", "id\n1\n")
    landing = files.land(spark, str(tmp_path / "in"))
    for run, at in (("late", AT + datetime.timedelta(hours=1)), ("early", AT)):
        ingest._commit(landing, places(spark, tmp_path), str(tmp_path / "t"), str(tmp_path / "l"), run, at)
    rows = ingest.committed(spark, str(tmp_path / "t"), str(tmp_path / "l")).collect()
    assert [(r.id, r.run_uuid) for r in rows] == [("1", "early")]


def test_stream_loads_each_file_once(spark, tmp_path):
    write(tmp_path / "in", "a/x.csv", "id\n1\n")
    run = lambda: ingest.load_stream(spark, str(tmp_path / "in"), places(spark, tmp_path), str(tmp_path / "t"), str(tmp_path / "l"), str(tmp_path / "c"))
    run()
    run()
    assert shown(spark, tmp_path) == [("1", "kenya")]
    write(tmp_path / "in", "b/y.csv", "id\n2\n")
    write(tmp_path / "in", "b/bad.csv", "id\n1,2\n")
    run()
    assert shown(spark, tmp_path) == [("1", "kenya"), ("2", "kenya")]


def test_template_folder(spark, tmp_path):
    write(tmp_path / "in", "English.csv", "Arm,Wk 8 SMS,Wk 11 SMS\nA,Hi   there,On [date here]\n ,x,y\n")
    write(tmp_path / "in", "Luganda.csv", "Arm name,8,11\nB,,z\n")
    got = sorted(tuple(r) for r in ingest.templates_long(files.template_sheets(spark, str(tmp_path / "in"))).collect())
    assert got == [("A", "English", 8, "Hi there", False), ("A", "English", 11, "On [date here]", True), ("B", "Luganda", 11, "z", False)]


def test_rows_of_a_file_are_never_held_together():
    """Arrow's memory at its peak stays the same for a file of ten times the rows."""
    import subprocess
    import sys
    from pathlib import Path

    code = """
import sys
import pyarrow as pa
from fieldmart.sources import files
text = ("id,name\\n" + "".join(f"{i},some name of a row\\n" for i in range(int(sys.argv[1])))).encode()
fields = [("file_path", pa.string()), ("last_modified", pa.timestamp("us", "UTC")), ("error", pa.string()), ("n_rows", pa.int64()), ("columns", pa.list_(pa.struct([("column", pa.string()), ("dtype", pa.string())]))), ("line", pa.int64()), ("cells", pa.map_(pa.string(), pa.string()))]
rows = sum(b.num_rows for b in files._batches("p", pa.scalar(None, fields[1][1]), text, pa.schema(fields)))
print(rows, pa.default_memory_pool().max_memory())
"""
    run = lambda n: [int(x) for x in subprocess.run([sys.executable, "-c", code, str(n)], cwd=Path(__file__).parents[1], capture_output=True, text=True, check=True).stdout.split()]
    (few, least), (many, most) = run(100_000), run(1_000_000)
    assert (few, many) == (100_001, 1_000_001)
    assert most < 2 * least

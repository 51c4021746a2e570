from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from leaguelake.sinks import changes
from leaguelake.sinks.changes import ChangeExport, applied_all

SCHEMA = "game_id long, note string, score double, rest int"


def table(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in rows.items()], SCHEMA)


def docs(frame):
    found = [(r.id, r.doc) for r in frame.collect()]
    assert len({i for i, _ in found}) == len(found)
    return {i: json.loads(d) for i, d in found}


def plain(rows):
    out = {}
    for i, (note, score, rest) in rows.items():
        one = {"game_id": i, "note": note, "score": score, "rest": rest}
        out[str(i)] = {k: v for k, v in one.items() if v is not None or k == "rest"}
    return out


FIRST = {i: (f"n{i}\n}}}}\n\"é", i / 2, i % 3 or None) for i in range(200)}
SECOND = {i: r for i, r in FIRST.items() if i % 10} | {7: ("n7", None, None), 8: (None, None, 1), 500: ("new", 1.0, 1)}


@pytest.fixture
def export(tmp_path):
    return ChangeExport(str(tmp_path / "x"), 'in"dex', ("game_id",), ("rest",), 8)


def test_lines_turn_the_old_export_into_the_new_one(spark, export):
    for number, rows in ((3, FIRST), (5, SECOND), (5, SECOND), (9, {}), (10, FIRST)):
        export.write(table(spark, rows) if rows else table(spark, FIRST).limit(0), number)
        done = [n for n in (3, 5, 9, 10) if n <= number]
        assert docs(applied_all(spark, export, done)) == plain(rows)
    assert export.read(spark, 3).count() == 200
    second = {r.id: r.doc for r in export.read(spark, 5).collect()}
    assert {i for i, d in second.items() if d is None} == {str(i) for i in range(0, 200, 10)}
    assert {i for i, d in second.items() if d is not None} == {"7", "8", "500"}
    lines = [r.value for r in spark.read.text(export._lines("index", 5)).collect()]
    assert sorted(json.loads(x)["index"]["_id"] for x in lines if '"_index"' in x) == ["500", "7", "8"]


def test_equal_tables_give_no_lines(spark, export):
    export.write(table(spark, FIRST), 1)
    export.write(table(spark, FIRST).repartition(5), 2)
    assert export.read(spark, 2).isEmpty()
    export.write(table(spark, SECOND), 3)
    assert docs(applied_all(spark, export, [1, 2, 3])) == plain(SECOND)


def test_an_export_that_stopped_before_its_hashes_is_repeated(spark, export, monkeypatch):
    export.write(table(spark, FIRST), 1)
    from leaguelake.sinks.parts import PartTable

    with monkeypatch.context() as m:
        m.setattr(PartTable, "replace", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            export.write(table(spark, SECOND), 2)
    export.write(table(spark, SECOND | {9: ("later", 0.0, 0)}), 2)
    assert docs(applied_all(spark, export, [1, 2])) == plain(SECOND | {9: ("later", 0.0, 0)})


def test_ids_must_be_there_and_unique(spark, export):
    rows = table(spark, FIRST)
    for bad in (rows.unionByName(rows.where("game_id = 3")), rows.withColumn("game_id", F.nullif("game_id", F.lit(4)))):
        with pytest.raises(ValueError):
            export.write(bad, 1)
    export.write(rows, 1)
    assert docs(applied_all(spark, export, [1])) == plain(FIRST)


def test_ids_of_several_columns_and_awkward_texts(spark, tmp_path):
    export = ChangeExport(str(tmp_path / "x"), "m", ("a", "b"), buckets=4)
    rows = [("x", "y,z"), ("x,y", "z"), ('"', "}}\n"), (None, "q"), ("é\n", None), ("{\"index\":{", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    export.write(df, 1)
    got = docs(applied_all(spark, export, [1]))
    assert {tuple(json.loads(i)) for i in got} == set(rows)
    for i, d in got.items():
        assert (d.get("a"), d.get("b")) == tuple(json.loads(i))
    export.write(df.where("a is not null"), 2)
    assert {tuple(json.loads(i)) for i in docs(applied_all(spark, export, [1, 2]))} == {r for r in rows if r[0] is not None}


def test_large_changes_are_joined_without_sorting_documents(spark, export, monkeypatch):
    monkeypatch.setattr(changes, "BROADCAST_IDS", 0)
    export.write(table(spark, FIRST), 1)
    export.write(table(spark, SECOND), 2)
    held = applied_all(spark, export, [1, 2])
    assert docs(held) == plain(SECOND)
    text = held._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text
    files = [f for kind in ("index", "delete") for f in spark.read.text(export._lines(kind, 1)).inputFiles()]
    assert files and all(f.endswith(".gz") for f in files)

"""Stored dimensions: what a batch writes, replays, compaction, key reads."""

import os

import pytest
from pyspark.sql import types as T

from cartwheel.sinks import dimstore

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "name", "city")])


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files)


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def store(spark, tmp):
    path = f"{tmp}/dim"
    dimstore.create(spark, path, SCHEMA, "id", " SALT = 3", buckets=4)
    return path


def change(spark, data, ddl="id string, name string, city string, v int"):
    return spark.createDataFrame(data, ddl)


def test_a_batch_writes_its_own_rows(spark, store):
    many = [(f"k{k}", f"name {k} " + "x" * 50, "c", 0) for k in range(20_000)]
    assert dimstore.upsert(spark, store, change(spark, many), 0, "v")
    table = size(f"{store}/base")
    folders = {k: set(os.listdir(f"{store}/{k}")) for k in ("base", "delta", "manifest") if os.path.exists(f"{store}/{k}")}
    before = size(store)
    # no rows: nothing is written
    assert not dimstore.upsert(spark, store, change(spark, many).filter("false"), 1, "v")
    assert size(store) == before and all(set(os.listdir(f"{store}/{k}")) == v for k, v in folders.items())
    # few rows: few bytes, and the base is the same
    assert dimstore.upsert(spark, store, change(spark, [("k7", "new", None, 1), ("z", "more", "d", 1)]), 2, "v")
    assert size(store) - before < table / 20 and set(os.listdir(f"{store}/base")) == folders["base"]
    got = {r.id: (r.name, r.city) for r in dimstore.read(spark, store).collect()}
    assert len(got) == 20_001 and got["k7"] == ("new", None) and got["z"] == ("more", "d") and got["k8"][1] == "c"


def test_replay_order_and_nulls(spark, store):
    one = change(spark, [("1", "a", "x", 1), ("1", "b", None, 2), ("2", "c", "y", 1), (None, "q", "q", 1)])
    for _ in range(2):
        dimstore.upsert(spark, store, one, 0, "v")
    assert rows(dimstore.read(spark, store)) == [("1", "b", None), ("2", "c", "y")]
    dimstore.upsert(spark, store, change(spark, [("2", "z", "z", 9)]), 5, "v")
    dimstore.upsert(spark, store, change(spark, [("3", "w", "w", 9)]), 5, "v")  # the newest batch again, with other rows
    assert rows(dimstore.read(spark, store)) == [("1", "b", None), ("2", "c", "y"), ("3", "w", "w")]
    assert not dimstore.upsert(spark, store, one, 0, "v")  # applied long ago
    assert rows(dimstore.read(spark, store, before=5)) == [("1", "b", None), ("2", "c", "y")]
    dimstore.upsert(spark, store, change(spark, [("2", "z", "z", 9)]).filter("false"), 5, "v")  # and without any
    assert rows(dimstore.read(spark, store)) == [("1", "b", None), ("2", "c", "y")]
    assert dimstore.properties(spark, store) == ("id", " SALT = 3")


def test_columns_that_a_change_does_not_set_stay(spark, store, monkeypatch):
    monkeypatch.setattr(dimstore, "SHARE", 100.0)
    dimstore.upsert(spark, store, change(spark, [("1", "a", "x", 1), ("2", "b", "y", 1)]), 0, "v")
    dimstore.upsert(spark, store, change(spark, [("1", "n", 1), ("3", "m", 1)], "id string, name string, v int"), 1, "v")
    dimstore.upsert(spark, store, change(spark, [("1", "w", 1)], "id string, city string, v int"), 2, "v")
    assert rows(dimstore.read(spark, store)) == [("1", "n", "w"), ("2", "b", "y"), ("3", "m", None)]
    mixed = spark.createDataFrame([("2", "p", None, ["id", "name"], 1), ("2", None, "q", ["id", "city"], 2), ("1", None, None, ["id", "city"], 1)],
                                  "id string, name string, city string, s array<string>, v int")
    dimstore.upsert(spark, store, mixed, 3, "v", "s")
    assert rows(dimstore.read(spark, store)) == [("1", "n", None), ("2", "p", "q"), ("3", "m", None)]


def test_full_buckets_are_rewritten_and_old_folders_go(spark, store, monkeypatch):
    monkeypatch.setattr(dimstore, "KEEP", 2)
    want = {}
    for batch in range(12):
        data = [(f"k{k}", f"b{batch}", "c", batch) for k in range(batch, 40, 3)]
        want |= {r[0]: r[1] for r in data}
        dimstore.upsert(spark, store, change(spark, data), batch, "v")
        if batch > 1:  # a key of one bucket only
            dimstore.upsert(spark, store, change(spark, [("k0", f"only{batch}", "c", 99)]), batch, "v")
            want = {r.id: r.name for r in dimstore.read(spark, store).collect()}
            assert want["k0"] == f"only{batch}"
    assert len(os.listdir(f"{store}/manifest")) <= 2 * 2  # with checksum files
    assert len(os.listdir(f"{store}/base")) + len(os.listdir(f"{store}/delta")) < 14
    before = rows(dimstore.read(spark, store))
    dimstore.rebucket(spark, store, 3)
    assert rows(dimstore.read(spark, store)) == before and len(before) == len(want)


def test_a_failed_batch_changes_nothing(spark, store, monkeypatch):
    dimstore.upsert(spark, store, change(spark, [("1", "a", "x", 1)]), 0, "v")
    with monkeypatch.context() as m:
        m.setattr(dimstore._Files, "put", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            dimstore.upsert(spark, store, change(spark, [("1", "b", "x", 1)]), 1, "v")
    assert rows(dimstore.read(spark, store)) == [("1", "a", "x")]
    dimstore.upsert(spark, store, change(spark, [("1", "b", "x", 1)]), 1, "v")
    assert rows(dimstore.read(spark, store)) == [("1", "b", "x")]


def test_a_second_writer_fails(spark, store):
    files = dimstore._Files(spark, store)
    with pytest.raises(RuntimeError):
        files.put("manifest/000000000000.json", "{}")
    assert dimstore.exists(spark, store) and not dimstore.exists(spark, f"{store}/nowhere")


def test_one_key_is_read_from_one_bucket(spark, store):
    dimstore.upsert(spark, store, change(spark, [(f"k{k}", f"n{k}", "c", 0) for k in range(1000)]), 0, "v")
    dimstore.upsert(spark, store, change(spark, [("k5", "late", "c", 1)]), 1, "v")
    for key, want in (("k5", [("k5", "late", "c")]), ("k6", [("k6", "n6", "c")]), ("none", [])):
        df = dimstore.read_key(spark, store, key)
        assert rows(df) == want
        files = df.inputFiles()
        assert len({f.split("bucket=")[1].split("/")[0] for f in files}) <= 1 and len(files) <= 2
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert f"EqualTo(id,{key})" in plan
    joined = dimstore.read(spark, store).filter("id = 'k5'")
    assert rows(joined) == rows(dimstore.read_key(spark, store, "k5"))


def test_reading_does_not_shuffle_the_base(spark, store):
    dimstore.upsert(spark, store, change(spark, [(f"k{k}", f"n{k}", "c" * 50, 0) for k in range(20_000)]), 0, "v")
    dimstore.upsert(spark, store, change(spark, [("k5", "late", "c", 1)]), 1, "v")
    df = dimstore.read(spark, store)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final

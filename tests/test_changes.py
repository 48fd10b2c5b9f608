"""Rules and snapshots as streams of changes: replays with overlap, repeats and rules that change in between."""

import os

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import cdc, routing
from cartwheel.streaming import jobs

CHANGE = "database string, tableName string, before map<string,string>, after map<string,string>, type string, key long, version long"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def stream(spark, path, batches, schema=CHANGE):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        newest = max((os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")), key=os.path.getctime)
        os.utime(newest, (1_700_000_000 + k, 1_700_000_000 + k))  # the order they are read in
    return jobs.parquet_stream(spark, path, spark.read.parquet(path).schema, max_files_per_trigger=1)


def ran(job, *args, tmp, name, **kw):
    q = job(*args, name=name, trigger={"availableNow": True}, checkpoint=f"{tmp}/ck_{name}", **kw)
    q.awaitTermination()


def rule(table, kind, sink_type, sink, columns, version, change="insert"):
    row = {"sourceTable": table, "operateType": kind, "sinkType": sink_type, "sinkTable": sink, "sinkColumns": columns, "sinkPk": "id"}
    return ("cfg", "table_process", row if change == "delete" else {}, {} if change == "delete" else row, change, 0, version)


def row(table, key, version, kind="insert", **more):
    return ("db", table, {}, {"id": str(key), **more}, kind, key, version)


RULES = [rule("t", "insert", "kafka", "first", "id,a", 0), rule("u", "insert", "kafka", "only_u", "id", 0),
         rule("t", "insert", "kafka", "second", "id,b", 50, "update"), rule("t", "insert", "kafka", "second", "id,b", 80, "delete"),
         rule("t", "insert", "kafka", "third", "id", 90)]
ROWS = [row("t", k, k, a="x", b="y") for k in (10, 49, 50, 79, 80, 89, 90, 99)] + [row("u", 7, 60), row("u", 8, 61, "delete"), row("w", 9, 62)]


def test_rule_history(spark):
    history = routing.rule_history(spark.createDataFrame(RULES + RULES[:2], CHANGE))
    assert sorted((r.sourceTable, r.sinkTable, r.valid_from, r.valid_to or -1) for r in history.collect()) == [
        ("t", "first", 0, 50), ("t", "second", 50, 80), ("t", "third", 90, -1), ("u", "only_u", 0, -1)]
    assert {r.sinkTable for r in routing.current_rules(history).collect()} == {"third", "only_u"}


def test_each_change_is_routed_by_the_rule_of_its_time(spark):
    changes, history = spark.createDataFrame(ROWS, CHANGE), routing.rule_history(spark.createDataFrame(RULES, CHANGE))
    got = sorted((r.sinkTable, r.version, tuple(sorted(r.after))) for r in routing.route_fact(changes, history, "version").collect())
    assert got == [("first", 10, ("a", "id")), ("first", 49, ("a", "id")), ("only_u", 60, ("id",)), ("second", 50, ("b", "id")),
                   ("second", 79, ("b", "id")), ("third", 90, ("id",)), ("third", 99, ("id",))]
    assert sorted(r.version for r in routing.unmatched(changes, history, "version").collect()) == [62, 80, 89]


def test_routing_with_rules_as_a_stream(spark, tmp):
    """A rule changes between two changes of one table, and a deleted rule stops routing; a restart knows the rules."""
    rules = [[RULES[0], RULES[1]], [RULES[2], RULES[3]], [RULES[4]]]
    rows = [ROWS[:2], ROWS[2:6] + ROWS[8:], ROWS[6:8]]
    out, where = f"{tmp}/out", f"{tmp}/rules"
    c, r = stream(spark, f"{tmp}/c", rows[:2]), stream(spark, f"{tmp}/r", rules[:2])
    ran(jobs.routing_as_of_job, c, r, out, where, tmp=tmp, name="asof")
    c, r = stream(spark, f"{tmp}/c", rows[2:]), stream(spark, f"{tmp}/r", rules[2:])
    ran(jobs.routing_as_of_job, c, r, out, where, tmp=tmp, name="asof")
    got = sorted((r.topic, r.value) for r in spark.read.json(f"{out}/facts").collect())
    history = routing.rule_history(spark.createDataFrame(RULES, CHANGE))
    from cartwheel.sinks.writers import as_topic_records
    want = as_topic_records(routing.route_fact(spark.createDataFrame(ROWS, CHANGE), history, "version").select("sinkTable", "after"))
    assert got == sorted((r.topic, r.value) for r in want.collect()) and len(got) == 7
    assert sorted(r.version for r in spark.read.json(f"{out}/unmatched").collect()) == [62, 80, 89]


def test_snapshot_then_changes_on_a_stream(spark, tmp):
    """Changes that the snapshot holds already, or that come twice, are dropped; the state is that of all changes."""
    changes = []
    for k in range(6):
        changes.append(row("t", k, 10 * k, "insert", v="new"))
        if k % 2 == 0:
            changes.append(("db", "t", {"id": str(k)}, {"id": str(k), "v": f"up{k}"}, "update", k, 10 * k + 70))
        if k % 3 == 0:
            changes.append(("db", "t", {"id": str(k)}, {}, "delete", k, 10 * k + 80))
    every = spark.createDataFrame(changes, CHANGE)
    want = sorted(map(tuple, cdc.typed_after(cdc.current_state(every, "id", "version"), {"id": "int", "v": "string"}).collect()))
    # the snapshot was read key by key while changes went on: rows go up to different versions
    until = {0: 0, 1: 10, 2: 90, 3: 30, 4: 40}
    held = spark.createDataFrame([c for c in changes if c[5] in until and c[6] <= until[c[5]]], CHANGE)
    snap = cdc.typed_after(cdc.current_state(held, "id", "version"), {"id": "long", "v": "string"})
    snap = snap.join(spark.createDataFrame(list(until.items()), "id long, as_of long"), "id")
    late = sorted((c for c in changes if c[6] >= 10), key=lambda c: c[6])  # overlaps the snapshot
    late = late[:4] + late[2:]                                              # and repeats
    files = [late[:3], late[3:6], late[6:]]
    out = f"{tmp}/out"
    other = [("db", "other", {}, {"id": "1"}, "insert", 1, 5)]
    ran(jobs.snapshot_then_changes_job, snap, stream(spark, f"{tmp}/in", files[:2]), "db", "t", "id", "as_of", out, tmp=tmp, name="snap")
    # a restart takes neither the snapshot nor any change again, whatever the table holds by then
    later = snap.withColumn("v", F.lit("moved on"))
    ran(jobs.snapshot_then_changes_job, later, stream(spark, f"{tmp}/in", [files[2] + other]), "db", "t", "id", "as_of", out, tmp=tmp, name="snap")
    got = spark.read.parquet(out).drop("batch_id")
    assert sorted(map(tuple, cdc.typed_after(cdc.current_state(got, "id", "version"), {"id": "int", "v": "string"}).collect())) == want and want
    versions = [(r.key, r.version) for r in got.filter("type <> 'read'").collect()]
    assert len(versions) == len(set(versions)) and all(v > until.get(k, -1) for k, v in versions)
    assert got.filter("type = 'read'").count() == snap.count() and got.filter("tableName = 'other'").count() == 0

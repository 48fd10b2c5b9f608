"""A job that fails between writing a batch and committing it goes on from its checkpoint, with nothing lost or doubled."""

import os

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import routing, stats
from cartwheel.sinks import dimstore, writers
from cartwheel.streaming import jobs

from fixtures import page_df


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


class Lost(Exception):
    pass


@pytest.fixture
def restarting(monkeypatch, tmp):
    """Runs a job until it fails right behind the writing of batch ``fail``, then starts it again with its checkpoint."""
    real = jobs.run

    def go(job, *args, name, fail, **kw):
        lost, written = [], []

        def run(df, write, *a, **k):
            def once(batch, batch_id):
                write(batch, batch_id)
                written.append(batch_id)
                if batch_id == fail and not lost:
                    lost.append(batch_id)
                    raise Lost(f"executor lost behind batch {batch_id}")
            return real(df, once, *a, **k)

        monkeypatch.setattr(jobs, "run", run)
        for _ in range(2):
            q = job(*args, name=name, trigger={"availableNow": True}, checkpoint=os.path.join(tmp, f"ck_{name}"), **kw)
            try:
                q.awaitTermination()
            except Exception as e:
                assert "executor lost" in str(e)
        monkeypatch.setattr(jobs, "run", real)
        assert lost == [fail] and written.count(fail) == 2 and max(written) > fail, written
    return go


def files(spark, path, frames):
    """One file per frame, read one per trigger in this order."""
    for k, df in enumerate(frames):
        df.coalesce(1).write.mode("append").parquet(path)
        newest = max((os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")), key=os.path.getctime)
        os.utime(newest, (1_700_000_000 + k, 1_700_000_000 + k))
    return jobs.parquet_stream(spark, path, frames[0].schema, max_files_per_trigger=1)


def tuples(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_routing(spark, tmp, restarting):
    cols = ", ".join(f"{c} string" for c in routing.CONFIG_COLUMNS)
    rules = spark.createDataFrame([("o", "insert", "kafka", "facts_o", "id", "id", None), ("t", "update", "hbase", "dim_t", "id,name", "id", None),
                                   ("t", "insert", "hbase", "dim_t", "id,city", "id", None)], cols)
    schema = "tableName string, type string, after map<string,string>, version int"
    batches = [spark.createDataFrame([("o", "insert", {"id": str(k)}, 0), ("t", "update", {"id": "5", "name": f"n{k}"}, k),
                                      ("t", "insert", {"id": str(k), "city": f"c{k}"}, k), ("q", "insert", {"id": "9"}, 0)], schema) for k in range(4)]
    restarting(jobs.routing_job, files(spark, f"{tmp}/in", batches), lambda: rules, f"{tmp}/out", f"{tmp}/dims", name="route", fail=1)
    facts = spark.read.json(f"{tmp}/out/facts")
    assert sorted(r.value for r in facts.collect()) == sorted(f'{{"after":{{"id":"{k}"}}}}' for k in range(4))
    assert spark.read.json(f"{tmp}/out/unmatched").count() == 4
    got = sorted((r.id, r.name, r.city) for r in writers.read_dim(spark, f"{tmp}/dims/dim_t").collect())
    assert got == [("0", None, "c0"), ("1", None, "c1"), ("2", None, "c2"), ("3", None, "c3"), ("5", "n3", None)]


def test_order_wide(spark, tmp, restarting):
    from test_streaming import _shop
    from cartwheel.operators import wide
    orders, details, _, dims = _shop(spark)
    as_of = F.lit(1_704_074_400_000)
    cut = lambda df, n: [df.filter(F.substring("create_time", 15, 2).cast("int") % 6 == k) for k in range(n)]
    s = [files(spark, f"{tmp}/{n}", cut(df, 6)) for n, df in (("o", orders), ("d", details))]
    restarting(jobs.order_wide_job, *s, lambda: dims, as_of, f"{tmp}/out", name="ow", fail=2)
    want = wide.order_wide(orders, details, dims, -5000, 5000, as_of)
    assert tuples(spark.read.parquet(f"{tmp}/out").select(*wide.ORDER_WIDE_COLUMNS)) == tuples(want.select(*wide.ORDER_WIDE_COLUMNS))


def test_log_split(spark, tmp, restarting):
    src = f"{tmp}/raw"
    os.makedirs(src)
    for k in range(4):
        with open(f"{src}/{k}.log", "w") as f:
            f.write('{"common":{"mid":"%d","is_new":"1"},"page":{"page_id":"h"},"displays":[{"item":"7"},{"item":"8"}],"ts":%d}\nbad{\n' % (k % 2, k))
        os.utime(f"{src}/{k}.log", (1_700_000_000 + k, 1_700_000_000 + k))
    restarting(jobs.log_split_job, jobs.text_stream(spark, src, 1), f"{tmp}/out", name="split", fail=1)
    assert {k: spark.read.json(f"{tmp}/out/{k}").count() for k in ("dirty", "page", "display")} == {"dirty": 4, "page": 4, "display": 8}
    # the state of the failed batch was not kept either: the first flag of each device, once
    assert sorted((r.common.mid, r.ts, r.common.is_new) for r in spark.read.json(f"{tmp}/out/page").collect()) == [
        ("0", 0, "1"), ("0", 2, "0"), ("1", 1, "1"), ("1", 3, "0")]


def test_bounce(spark, tmp, restarting):
    from cartwheel.operators import visits
    rows = [("a", 1_000_000, None), ("a", 1_003_000, None), ("b", 1_020_000, None), ("a", 1_040_000, "x"), ("z", 1_090_000, "x"), ("z", 1_200_000, "x")]
    page = page_df(spark, rows)
    s = jobs.with_event_time(files(spark, f"{tmp}/in", [page.filter(F.col("seq") == k) for k in range(len(rows))]))
    restarting(lambda *a, **k: jobs.run(jobs.state.user_jump_stream(s, 10_000), jobs._to_folder(f"{tmp}/out"), **k), name="uj", fail=2)
    got = spark.read.parquet(f"{tmp}/out").select("mid", "ts", "kind")
    assert tuples(got) == tuples(visits.user_jump(page, 10_000).select("mid", "ts", "kind")) and got.count() == 3


def test_daily_totals(spark, tmp, restarting):
    """A late row changes one bucket; a batch that runs again counts once."""
    ddl = "stt string, order_amount decimal(18,2)"
    from decimal import Decimal as D
    batches = [[("2024-01-01 00:00:00", D("1.50")), ("2024-01-02 00:00:00", D("2"))], [("2024-01-02 10:00:00", D("3")), ("2024-01-03 00:00:00", D("4"))],
               [("2024-01-01 23:00:00", D("0.25"))], [("2024-01-03 01:00:00", None)]]
    frames = [spark.createDataFrame(b, ddl) for b in batches]
    path = f"{tmp}/gmv"
    restarting(jobs.daily_gmv_job, files(spark, f"{tmp}/in", frames), path, name="gmv", fail=1)
    every = spark.createDataFrame([r for b in batches for r in b], ddl)
    assert tuples(dimstore.read(spark, path)) == tuples(stats.gmv_by_day(every))
    assert [jobs.daily_gmv(spark, path, d).first().gmv for d in (20240101, 20240102, 20240105)] == [D("1.75"), D("5"), None]
    before = {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    jobs.add_daily_gmv(spark, path, stats.gmv_by_day(spark.createDataFrame([("2024-01-02 05:00:00", D("9"))], ddl)), 9)
    new = {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")} - before
    assert len({f.split("bucket=")[1].split("/")[0] for f in new}) == 1
    assert jobs.daily_gmv(spark, path, 20240102).first().gmv == D("14")


def test_topics(spark, tmp, restarting):
    """K1: the records that the topic job hands to the sink, a batch of them twice."""
    sent = []
    rows = [spark.createDataFrame([("t1", k, f"v{k}"), ("t2", k, None)], "sinkTable string, id int, v string") for k in range(3)]
    restarting(jobs.topic_job, files(spark, f"{tmp}/in", rows), "host:9092", name="topics", fail=1,
               write=lambda df, servers, topic: sent.append((servers, sorted(map(tuple, writers.as_topic_records(df, topic).collect())))))
    batch = lambda k: ("host:9092", [("t1", f'{{"id":{k},"v":"v{k}"}}'), ("t2", f'{{"id":{k}}}')])
    assert sent == [batch(0), batch(1), batch(1), batch(2)]

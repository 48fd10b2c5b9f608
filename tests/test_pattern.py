"""Patterns of any number of steps, in batch, on streams and by brute force."""

import os
import random

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import visits
from cartwheel.streaming import jobs, pattern, state

from fixtures import BOUNCE_ANSWER, BOUNCE_FLUSH, BOUNCE_ROWS, page_df

SCHEMA = "mid string, ts long, seq long, page string, amount int, _et timestamp"
STEPS = ["view", "cart", "pay"]


def events(seed, n=300, devices="abc"):
    rng = random.Random(seed)
    rows, t = [], 1_000_000
    for seq in range(n):
        t += rng.choice([0, 400, 900, 3000, 12_000])
        rows.append((rng.choice(devices) if rng.random() < 0.95 else None, t, seq, rng.choice(["view", "cart", "pay", "view", "cart", None]),
                     None if rng.random() < 0.5 else 2 ** 31 - 1 - seq))
    return rows


def brute(rows, steps, within):
    out = []
    for mid in {r[0] for r in rows} - {None}:
        own = sorted((r for r in rows if r[0] == mid), key=lambda r: r[1:3])
        for i, first in enumerate(own):
            if first[3] != steps[0]:
                continue
            kind, k = "match", 1
            while k < len(steps):
                if i + k >= len(own) or own[i + k][1] - first[1] >= within:
                    kind = "timeout"
                    break
                if own[i + k][3] != steps[k]:
                    kind = None
                    break
                k += 1
            if kind:
                out.append((*first, kind, k, own[i + k - 1][1]))
    return sorted(out, key=str)


def conditions(steps):
    return [F.col("page") == s for s in steps]


def frame(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], SCHEMA).drop("_et")


@pytest.mark.parametrize("steps", [STEPS, STEPS[:2], ["view"], ["view", "view", "cart", "pay"]])
def test_batch_pattern_matches_brute_force(spark, steps):
    rows = events(len(steps))
    want = brute(rows, steps, 5_000)
    assert sorted(map(tuple, visits.pattern(frame(spark, rows), conditions(steps), 5_000).collect()), key=str) == want and want


def test_two_steps_are_the_bounce(spark):
    page = page_df(spark, BOUNCE_ROWS)
    entry = F.col("last_page_id").isNull()
    got = {(r.mid, r.ts, r.kind) for r in visits.pattern(page, [entry, entry], 10_000).collect()}
    assert got == {(r.mid, r.ts, r.kind) for r in visits.user_jump(page, 10_000).collect()} == BOUNCE_ANSWER


def replay(spark, tmp, rows, files, delay):
    """The rows out of order by less than ``delay``, one file per trigger, then rows that let the time pass."""
    rng = random.Random(7)
    rows = sorted(rows, key=lambda r: r[1] + rng.random() * delay)
    last = max(r[1] for r in rows)
    rows = rows + [("zz", last + 100_000, 10_001, None, None), ("zz", last + 200_000, 10_002, None, None)]
    path = os.path.join(tmp, "in")
    size = -(-(len(rows) - 2) // files)
    parts = [rows[i:i + size] for i in range(0, len(rows) - 2, size)] + [[rows[-1]], [rows[-2]]]
    for k, part in enumerate(parts):
        spark.createDataFrame([(*r, None) for r in part], SCHEMA).drop("_et").coalesce(1).write.mode("append").parquet(path)
        for name in os.listdir(path):
            full = os.path.join(path, name)
            if os.path.getmtime(full) > 1_800_000_000 or os.path.getmtime(full) < 1_000_000_000:
                continue
        newest = max((os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")), key=os.path.getctime)
        os.utime(newest, (1_700_000_000 + k, 1_700_000_000 + k))  # the order they are read in
    schema = spark.read.parquet(path).schema
    return jobs.with_event_time(jobs.parquet_stream(spark, path, schema, max_files_per_trigger=1), delay=f"{delay} milliseconds")


def test_stream_equals_batch_out_of_order(spark, tmp):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        rows = events(11, 120)
        s = replay(spark, tmp, rows, 6, 20_000)
        jobs.to_memory(pattern.pattern_stream(s, conditions(STEPS), 5_000), "pattern_out", os.path.join(tmp, "ck"))
        got = sorted((tuple(r) for r in spark.table("pattern_out").collect()), key=str)
        assert got == brute(rows, STEPS, 5_000) and {g[5] for g in got} == {"match", "timeout"}
        assert spark.table("pattern_out").columns == visits.pattern(frame(spark, rows), conditions(STEPS), 5_000).columns
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_decisions_do_not_depend_on_when_they_are_made():
    """However the watermark moves, each first row is decided once, and as with all rows at hand."""
    rng = random.Random(5)
    for _ in range(300):
        rows, t = [], 0
        for k in range(rng.randrange(1, 14)):
            t += rng.choice([0, 1, 2, 5])
            rows.append((t, k, "".join(rng.choice("01") for _ in range(3)), k))
        whole = [(rows[i][3], kind, m, last) for i, kind, m, last in pattern.decide(rows, 10**6, 4, 3)[0]]
        buffer, waiting, got, mark = [], list(rows), [], -1
        while waiting or buffer:
            mark += rng.randrange(1, 4)
            late = rng.randrange(0, 5)  # rows come before the watermark reaches them, in any order
            new = [r for r in waiting if r[0] <= mark + late]
            waiting = [r for r in waiting if r[0] > mark + late]
            buffer = sorted(buffer + new)
            out, done, due = pattern.decide(buffer, mark, 4, 3)
            got += [(buffer[i][3], kind, m, last) for i, kind, m, last in out]
            buffer = buffer[done:]
            assert (due is None) == (not buffer) and (due is None or due > mark)
        assert got == whole


def test_bounce_is_an_instance(spark, tmp):
    rows = sorted([(m, t + 1_000_000, lp) for m, t, lp in BOUNCE_ROWS + BOUNCE_FLUSH], key=lambda r: r[1])
    page_df(spark, rows).coalesce(1).write.parquet(f"{tmp}/p")
    page_df(spark, [("z", 1_300_000, "x")]).coalesce(1).write.mode("append").parquet(f"{tmp}/p")
    s = jobs.with_event_time(jobs.parquet_stream(spark, f"{tmp}/p", page_df(spark, rows).schema, 1))
    out = state.user_jump_stream(s, 10_000)
    assert out.columns == visits.user_jump(page_df(spark, rows), 10_000).columns
    assert "TransformWithState" in out._jdf.queryExecution().analyzed().toString()

"""Per-device sequence operators, batch form: unique visit (T2) and bounce.

None gathers a device's rows into one task.  The order of rows is packed into
one number, so that first rows are found by hash aggregates, which combine
before the shuffle, and joined back.  Bounce needs the *next* row of the same
device; that row matters only when it is less than ``within`` later, so rows
are ordered inside (device, ``within``-wide time bucket) partitions and the
last row of a bucket looks up the first row of the following bucket by an
equi-join.  A hot device is thereby spread over its time buckets.  Rows without
a device belong to no sequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.timefmt import ms_to_day

# Fixed value: a row number in one order key is below this.
SEQ_RANGE = 10 ** 18


def order_key(ts: str, seq: str) -> Column:
    """(``ts``, ``seq``) as one decimal that sorts the same way.

    ``seq`` is a row number from 0 to SEQ_RANGE - 1.  A decimal fits a hash
    aggregate's buffer; a struct would make Spark sort all rows by key."""
    return (F.col(ts).cast("decimal(19,0)") * F.lit(SEQ_RANGE).cast("decimal(19,0)")
            + F.col(seq).cast("decimal(19,0)")).cast("decimal(38,0)")


def is_entry(last_page_id: str = "last_page_id", empty_counts: bool = True):
    """Entry page: no previous page (``''`` too when ``empty_counts``; Q13)."""
    c = F.col(last_page_id)
    return (c.isNull() | (c == "")) if empty_counts else c.isNull()


def unique_visit(page: DataFrame, key: str = "mid", ts: str = "ts", seq: str = "seq",
                 tz: str = "UTC") -> DataFrame:
    """T2 default: the first entry page per (device, day)."""
    e = page.filter(is_entry() & F.col(key).isNotNull()).withColumn("_day", ms_to_day(ts, tz))
    first = e.groupBy(key, "_day").agg(F.min(order_key(ts, seq)).alias("_first"))
    return e.join(first, [key, "_day"]).filter(order_key(ts, seq) == F.col("_first")).select(*page.columns)


def visit_flags(page: DataFrame, within_ms: int, key: str = "mid", ts: str = "ts", seq: str = "seq",
                flag: str = "is_new", tz: str = "UTC") -> DataFrame:
    """T1, T2 and T3 as columns of the same page rows: ``flag`` repaired, ``uv``
    (first entry of its device and day) and ``uj`` (bounce).

    One aggregate per (device, day) gives both first rows; the first flagged
    row of a device is the least of its days.  A row without a device is a key
    of its own, so such rows spread, keep their flag and get no marks."""
    at, entry = order_key(ts, seq), F.col("last_page_id").isNull()
    keyed = page.withColumn("_key", F.coalesce(F.concat(F.lit("d"), F.col(key)), F.concat(F.lit("-"), F.col(seq).cast("string"))))
    keyed = keyed.withColumn("_day", ms_to_day(ts, tz))
    days = keyed.groupBy("_key", "_day").agg(F.min(F.when(F.col(flag) == "1", at)).alias("_new"),
                                             F.min(F.when(is_entry(), at)).alias("_uv"))
    firsts = days.select("_key", "_day", "_uv", F.min("_new").over(Window.partitionBy("_key")).alias("_first"))
    j = jump_kind(keyed, entry, entry, within_ms, "_key", ts, seq).join(firsts, ["_key", "_day"], "left")
    real = F.col(key).isNotNull()
    return j.select(
        *[F.when((F.col(flag) == "1") & (at != F.col("_first")), F.lit("0")).otherwise(F.col(flag)).alias(flag) if c == flag else F.col(c)
          for c in page.columns],
        F.coalesce(real & is_entry() & (at == F.col("_uv")), F.lit(False)).alias("uv"),
        (real & F.col("kind").isNotNull()).alias("uj"))


def unique_visit_strict(page: DataFrame, key: str = "mid", ts: str = "ts", seq: str = "seq",
                        tz: str = "UTC", bucket_rows: int = 1 << 20) -> DataFrame:
    """T2 as the reference's state machine: keep an entry page when the
    previous entry page of the device, in arrival order ``seq``, fell on
    another day (Q20: interleaved days are emitted again).

    Arrival order is cut into ``bucket_rows``-wide ``seq`` buckets.  Inside a
    (device, bucket) partition ``lag`` finds the previous entry; the first
    entry of a bucket takes the last day of the device's previous non-empty
    bucket, found over one summary row per bucket.
    """
    cols = page.columns
    e = (page.filter(is_entry() & F.col(key).isNotNull())
             .withColumn("_day", ms_to_day(ts, tz))
             .withColumn("_b", F.floor(F.col(seq) / F.lit(bucket_rows))))
    w = Window.partitionBy(key, "_b").orderBy(seq)
    e = e.withColumn("_prev", F.lag("_day").over(w))
    summ = e.groupBy(key, "_b").agg(F.max_by("_day", seq).alias("_last"))
    summ = summ.withColumn("_prev_bucket", F.lag("_last").over(Window.partitionBy(key).orderBy("_b")))
    j = e.join(summ.select(key, "_b", "_prev_bucket"), [key, "_b"], "left")
    prev = F.coalesce(F.col("_prev"), F.col("_prev_bucket"))
    return j.filter(prev.isNull() | (prev != F.col("_day"))).select(*cols)


def jump_kind(df: DataFrame, first: Column, following: Column, within_ms: int, key: str, ts: str, seq: str) -> DataFrame:
    """All rows with ``kind``: see ``followed_by``; NULL where nothing is emitted.

    The next row of a key is found in its (key, ``within_ms``-wide bucket), or
    is the first row of the following bucket, which one packed number carries:
    its order key and whether it satisfies ``following``."""
    d = (df.withColumn("_b", F.floor(F.col(ts) / F.lit(within_ms))).withColumn("_is_first", first)
           .withColumn("_follow", F.coalesce(following, F.lit(False))))
    w = Window.partitionBy(key, "_b").orderBy(ts, seq)
    d = d.withColumn("_next_ts", F.lead(ts).over(w)).withColumn("_next_follow", F.lead("_follow").over(w))
    packed = (order_key(ts, seq) * 2 + F.col("_follow").cast("int")).cast("decimal(38,0)")
    head = d.groupBy(key, "_b").agg(F.min(packed).alias("_head")).withColumn("_b", F.col("_b") - 1)
    j = d.join(head, [key, "_b"], "left")
    bucket_ts = F.floor(F.col("_head") / F.lit(2 * SEQ_RANGE).cast("decimal(20,0)")).cast("bigint")
    inside = F.col("_next_ts").isNotNull()
    next_ts = F.when(inside, F.col("_next_ts")).otherwise(bucket_ts)
    follow = F.when(inside, F.col("_next_follow")).otherwise(F.col("_head") % 2 == 1)
    soon = F.coalesce(next_ts - F.col(ts) < within_ms, F.lit(False))
    kind = F.when(F.col("_is_first") & ~soon, "timeout").when(F.col("_is_first") & follow, "match")
    return j.withColumn("kind", kind).drop("_b", "_is_first", "_follow", "_next_ts", "_next_follow", "_head")


def followed_by(df: DataFrame, first, following, within_ms: int, key: str = "mid", ts: str = "ts",
                seq: str = "seq") -> DataFrame:
    """``begin(first).next(following).within(within_ms)`` per key, batch form.

    ``first``/``following`` are boolean Columns over a row.  For each row that
    satisfies ``first``, look at the key's next row (strict contiguity):
    ``kind = 'match'`` when it comes less than ``within_ms`` later and
    satisfies ``following``; ``'timeout'`` when no row comes within
    ``within_ms`` (a gap of exactly ``within_ms`` times out, Q21); no output
    when the next row breaks the pattern.  Returns the first rows + ``kind``.
    """
    keyed = df.filter(F.col(key).isNotNull())
    return (jump_kind(keyed, first, following, within_ms, key, ts, seq)
            .filter(F.col("kind").isNotNull()).select(*df.columns, "kind"))


PATTERN_COLUMNS = T.StructType([T.StructField("kind", T.StringType()), T.StructField("matched", T.IntegerType()),
                                T.StructField("last_ts", T.LongType())])


def pattern(df: DataFrame, steps: list[Column], within_ms: int, key: str = "mid", ts: str = "ts", seq: str = "seq") -> DataFrame:
    """X8 with any number of steps: ``begin(a).next(b).next(c)....within(within_ms)`` per key, batch form.

    For each row that meets the first condition (a boolean Column over a row),
    the key's next rows have to meet the others one by one, each less than
    ``within_ms`` after the first.  ``kind`` is ``'match'``, or ``'timeout'``
    where the time ran out while all rows so far fit; a row that breaks the
    pattern gives nothing.  ``matched`` counts the conditions met and
    ``last_ts`` is the time of the last row that met one.  Rows without a key
    belong to no sequence.

    Rows are ordered in (key, ``within_ms``-wide bucket) partitions; each row
    also follows, by its time and conditions alone, in the bucket before its
    own, so a hot key is spread over its buckets."""
    n = len(steps)
    d = df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).alias("_key"), F.col(ts).alias("_ts"), F.col(seq).alias("_seq"), F.floor(F.col(ts) / F.lit(within_ms)).alias("_b"),
        F.array(*[F.coalesce(s, F.lit(False)) for s in steps]).alias("_met"), F.struct(*df.columns).alias("_row"))
    here = F.struct(F.col("_b").alias("at"), F.when(F.col("_met")[0], F.col("_row")).alias("row"))
    before = F.struct((F.col("_b") - 1).alias("at"), F.when(F.lit(False), F.col("_row")).alias("row"))
    d = d.select("_key", "_ts", "_seq", "_met", F.explode(F.array(here, before)).alias("_p")).select("_key", "_ts", "_seq", "_met", "_p.*")
    w = Window.partitionBy("_key", "at").orderBy("_ts", "_seq")
    ahead = d.select("row", F.col("_ts").alias("_t0"), *[F.lead(F.struct("_ts", "_met"), k).over(w).alias(f"_n{k}") for k in range(1, n)])

    def outcome(kind: str, matched: int):
        last = F.col("_t0") if matched == 1 else F.col(f"_n{matched - 1}")["_ts"]
        return F.struct(F.lit(kind).alias("kind"), F.lit(matched).alias("matched"), last.alias("last_ts"))

    result = outcome("match", n)
    for k in range(n - 1, 0, -1):
        row = F.col(f"_n{k}")
        result = (F.when(row.isNull() | (row["_ts"] - F.col("_t0") >= within_ms), outcome("timeout", k))
                  .when(row["_met"][k], result))
    return ahead.filter(F.col("row").isNotNull()).withColumn("_o", result).filter(F.col("_o").isNotNull()).select("row.*", "_o.*")


def user_jump(page: DataFrame, within_ms: int, key: str = "mid", ts: str = "ts", seq: str = "seq") -> DataFrame:
    """T3 bounce, batch form, with a ``kind`` column (U3 union of both outputs):
    an entry page (``last_page_id`` NULL) directly followed by another entry
    page within ``within_ms`` is a ``match``; with no row in that interval it
    is a ``timeout``."""
    entry = F.col("last_page_id").isNull()
    return followed_by(page, entry, entry, within_ms, key, ts, seq)

"""Click-log intake: dirty split, new-visitor repair, start/page/display split.

One parsed frame feeds every output (P2, P12-P14, T1, T6).  In batch the
outputs are lazy filters of that frame; a job that writes several of them
persists it once (``sinks.writers.write_log_split``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsonfmt import LOG_SCHEMA, set_field, typed_field, wrapped_line, wrapped_object
from .visits import order_key


def _parsed_once(raw: DataFrame, value: str, keep) -> DataFrame:
    """Rows with ``_p``, the line's object as a map of JSON texts or NULL.

    A filter on a projected ``from_json`` result is pushed below the
    projection by the optimizer, which then evaluates the parse once per
    use.  A one-element ``explode`` is a barrier filters are not pushed
    through, so each line is parsed once.
    """
    lines = raw.select(*keep, F.explode(F.array(wrapped_line(value))).alias("_a"))
    return lines.withColumn("_p", wrapped_object(F.col("_a"))).drop("_a")


def dirty_lines(raw: DataFrame, value: str = "value") -> DataFrame:
    """Lines that are not one JSON object (K8 dead letters)."""
    return _parsed_once(raw, value, raw.columns).filter(F.col("_p").isNull()).drop("_p")


def split_lines(raw: DataFrame, value: str = "value") -> DataFrame:
    """All lines with ``_p``: NULL for dirty ones, for jobs that write both kinds."""
    return _parsed_once(raw, value, raw.columns)


def typed_lines(split: DataFrame, keep=("seq",)) -> DataFrame:
    """Good lines of ``split_lines`` as ``common/page/start/displays/ts`` (+ kept columns)."""
    keep = [c for c in keep if c in split.columns]
    return split.filter(F.col("_p").isNotNull()).select(
        *keep, *[typed_field(F.col("_p")[f.name], f.dataType).alias(f.name) for f in LOG_SCHEMA.fields])


def parse_lines(raw: DataFrame, value: str = "value", keep=("seq",)) -> DataFrame:
    """Good lines parsed to ``common/page/start/displays/ts`` (+ kept columns)."""
    return typed_lines(_parsed_once(raw, value, [c for c in keep if c in raw.columns]), keep)


def repair_new_visitor(df: DataFrame, key: str, flag: str, ts: str, seq: str) -> DataFrame:
    """T1, batch form: per key only the first ``flag = '1'`` row keeps ``'1'``.

    Only flagged rows can change, and they are few: they alone are shuffled.
    The first one per key is found by a hash aggregate over one packed order
    key (combined before the shuffle) and joined back; rows are never gathered
    per key, and AQE can split the rows of a hot key in the join.  All other
    rows, those without a key included, pass as they are.
    """
    flagged = F.coalesce((F.col(flag) == "1") & F.col(key).isNotNull(), F.lit(False))
    return _only_first(df.filter(flagged), key, flag, ts, seq).unionByName(df.filter(~flagged))


def _only_first(rows: DataFrame, key: str, flag: str, ts: str, seq: str) -> DataFrame:
    """``rows`` with the flag '1' on the first flagged one per key alone."""
    at, set_ = order_key(ts, seq), F.col(flag) == "1"
    firsts = rows.filter(set_).groupBy(F.col(key).alias("_of")).agg(F.min(at).alias("_first"))
    fixed = F.when(set_ & (at != F.col("_first")), F.lit("0")).otherwise(F.col(flag))
    return rows.join(firsts, F.col(key) == F.col("_of"), "left").withColumn(flag, fixed).select(*rows.columns)


def repair_parsed(parsed: DataFrame, seq: str = "seq") -> DataFrame:
    """T1 on parsed log lines: rewrites ``common['is_new']``.

    All given lines meet the join, so that they are parsed twice and not three times; ``repaired_lines`` gives it
    those that can be flagged."""
    flat = (parsed.withColumn("_mid", F.col("common")["mid"])
                  .withColumn("_is_new", F.col("common")["is_new"]))
    fixed = _only_first(flat, "_mid", "_is_new", "ts", seq)
    return (fixed.withColumn("common", F.when(F.col("_is_new").isNotNull(),
                                              set_field("common", "is_new", F.col("_is_new")))
                                        .otherwise(F.col("common")))
                 .drop("_mid", "_is_new"))


def maybe_flagged(value: str = "value"):
    """Whether a line's text can hold ``is_new`` with the value 1: lines that cannot need no repair.

    Names and values are literal in JSON unless there is an escape."""
    return F.coalesce(F.col(value).rlike("""["']is_new["']\\s*:\\s*["']?1""") | F.col(value).contains("\\"), F.lit(False))


def repaired_lines(raw: DataFrame, value: str = "value", keep=("seq",)) -> DataFrame:
    """T1 on raw lines: ``parse_lines`` with ``common['is_new']`` repaired.

    Lines that cannot be flagged are parsed once and meet no join."""
    maybe = maybe_flagged(value)
    return repair_parsed(parse_lines(raw.filter(maybe), value, keep)).unionByName(parse_lines(raw.filter(~maybe), value, keep))


def start_log(parsed: DataFrame) -> DataFrame:
    """Lines with a ``start`` object."""
    return parsed.filter(F.col("start").isNotNull())


def page_lines(parsed: DataFrame) -> DataFrame:
    """Lines without ``start``: the page log."""
    return parsed.filter(F.col("start").isNull())


def display_log(parsed: DataFrame, with_ts: bool = True) -> DataFrame:
    """One row per display of a page line, plus ``page_id`` (and ``ts``).

    A page line without ``page`` yields ``page_id`` NULL instead of failing (Q16).
    """
    p = page_lines(parsed).select(
        *(["ts"] if with_ts else []),
        F.col("page")["page_id"].alias("page_id"),
        F.explode("displays").alias("d"))
    return p.select(F.col("d").alias("display"), "page_id", *(["ts"] if with_ts else []))


def flatten_page(parsed: DataFrame, seq: str = "seq") -> DataFrame:
    """Parsed page lines -> flat typed page frame used by visits and stats."""
    c, p = F.col("common"), F.col("page")
    return page_lines(parsed).select(
        c["mid"].alias("mid"), c["ar"].alias("ar"), c["ch"].alias("ch"), c["vc"].alias("vc"),
        c["is_new"].alias("is_new"), p["page_id"].alias("page_id"),
        p["last_page_id"].alias("last_page_id"), p["item"].alias("item"),
        p["item_type"].alias("item_type"), p["during_time"].cast("bigint").alias("during_time"),
        F.col("ts"), F.col(seq).alias("seq"))

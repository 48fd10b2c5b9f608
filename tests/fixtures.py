"""Small hand-made inputs with hand-computed answers (FIXTURES.md section 2)."""

from cartwheel.streaming.state import PAGE_SCHEMA


def page_rows(rows):
    """rows: (mid, ts, last_page_id[, is_new]) -> full page tuples."""
    out = []
    for seq, r in enumerate(rows):
        mid, ts, last = r[0], r[1], r[2]
        is_new = r[3] if len(r) > 3 else "0"
        out.append((mid, "0", "0", "0", is_new, "p", last, "1", "sku_id", 1000, ts, seq))
    return out


def page_df(spark, rows):
    return spark.createDataFrame(page_rows(rows), PAGE_SCHEMA)


# Bounce within 10 s; devices a-d, z = flush rows.
BOUNCE_ROWS = [
    ("a", 0, None), ("a", 3000, None), ("a", 5000, "x"),
    ("b", 1000, None), ("b", 2000, "home"),
    ("c", 0, None), ("c", 10000, None),
    ("d", 15000, "x"),
]
BOUNCE_FLUSH = [("z", 60000, "x"), ("z", 90000, "x")]
BOUNCE_ANSWER = {("a", 0, "match"), ("c", 0, "timeout"), ("c", 10000, "timeout")}

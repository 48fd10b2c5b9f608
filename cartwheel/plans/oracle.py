"""DuckDB SQL for every key of ``cartwheel.plans.catalog``.

Written independently of the Spark plans: the inputs are derived from the
driver tables by the same rules (FIXTURES.md section 3), and the operators use
plain SQL, window functions included, where the Spark side uses aggregates
and joins.  Each query is one SQL string with the CTEs it needs.
"""

from __future__ import annotations

FMT = "'%Y-%m-%d %H:%M:%S'"
DAY_MS = 86_400_000
TZ8_MS = 8 * 3_600_000          # commerce text times are written at +08:00
OD_MS = 30 * DAY_MS             # order/detail interval (scaled +-5 s)
PAY_LO_MS, PAY_HI_MS = 15 * DAY_MS, 5 * DAY_MS
JUMP_MS = 6 * 3_600_000
VISIT_WIN_MS, STATS_WIN_MS, TUMBLE_WIN_MS = DAY_MS, 10_000, 3_600_000


def _fmt_ms(expr: str) -> str:
    return f"strftime(make_timestamp(({expr}) * 1000), {FMT})"


def _win(ts: str, size_ms: int) -> str:
    start = f"(({ts}) // {size_ms}) * {size_ms}"
    return f"{_fmt_ms(start)} AS stt, {_fmt_ms(start + f' + {size_ms}')} AS edt"


def _text_ms8(col: str) -> str:
    return f"(epoch_ms(strptime({col}, {FMT})) - {TZ8_MS})"


CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTE[name] = (deps, sql)


cte("page_log", (), """
SELECT CAST(user_id AS VARCHAR) AS mid, CAST(user_id % 7 AS VARCHAR) AS ar,
       CAST(user_id % 5 AS VARCHAR) AS ch, CAST(user_id % 3 AS VARCHAR) AS vc,
       CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new,
       event_type AS page_id,
       CASE WHEN event_type IN ('signup', 'view') THEN NULL WHEN event_type = 'error' THEN ''
            ELSE event_type END AS last_page_id,
       json_extract_string(props, '$.k') AS item,
       CASE WHEN event_type = 'error' THEN 'keyword' ELSE 'sku_id' END AS item_type,
       CAST(round(value * 1000) AS BIGINT) AS during_time, epoch_us(ts) // 1000 AS ts, event_id AS seq
FROM events""")

# T1 by window: the first is_new='1' row per device keeps it.
cte("page_repaired", ("page_log",), """
SELECT mid, ar, ch, vc,
       CASE WHEN is_new = '1' AND row_number() OVER (PARTITION BY mid, is_new ORDER BY ts, seq) > 1
            THEN '0' ELSE is_new END AS is_new,
       page_id, last_page_id, item, item_type, during_time, ts, seq
FROM page_log""")

# Raw JSON lines, every 50th with a broken tail; then parsed back.
cte("raw_log", ("page_log",), """
SELECT seq, CASE WHEN seq % 50 = 0 THEN line || '{"cut' ELSE line END AS value
FROM (SELECT seq, CAST(CASE WHEN page_id = 'signup' THEN
        json_object('common', json_object('ar', ar, 'ch', ch, 'is_new', is_new, 'mid', mid, 'vc', vc),
                    'start', json_object('entry', 'icon', 'loading_time', CAST(during_time AS VARCHAR)), 'ts', ts)
      WHEN page_id = 'view' THEN
        json_object('common', json_object('ar', ar, 'ch', ch, 'is_new', is_new, 'mid', mid, 'vc', vc),
                    'page', json_object('page_id', page_id, 'last_page_id', last_page_id, 'item', item,
                                        'item_type', item_type, 'during_time', CAST(during_time AS VARCHAR)),
                    'displays', json_array(json_object('item', item, 'item_type', 'sku_id', 'order', '1'),
                                           json_object('item', mid, 'item_type', 'activity_id', 'order', '2')),
                    'ts', ts)
      ELSE json_object('common', json_object('ar', ar, 'ch', ch, 'is_new', is_new, 'mid', mid, 'vc', vc),
                    'page', json_object('page_id', page_id, 'last_page_id', last_page_id, 'item', item,
                                        'item_type', item_type, 'during_time', CAST(during_time AS VARCHAR)),
                    'ts', ts) END AS VARCHAR) AS line FROM page_log)""")

cte("parsed", ("raw_log",), """
SELECT seq, json_extract_string(value, '$.common.mid') AS mid, json_extract_string(value, '$.common.ar') AS ar,
       json_extract_string(value, '$.common.ch') AS ch, json_extract_string(value, '$.common.vc') AS vc,
       json_extract_string(value, '$.common.is_new') AS is_new0,
       json_extract_string(value, '$.page.page_id') AS page_id,
       json_extract_string(value, '$.page.last_page_id') AS last_page_id,
       json_extract_string(value, '$.page.item') AS item, json_extract_string(value, '$.page.item_type') AS item_type,
       CAST(json_extract_string(value, '$.page.during_time') AS BIGINT) AS during_time,
       json_extract_string(value, '$.start.entry') AS entry,
       CAST(json_extract_string(value, '$.start.loading_time') AS BIGINT) AS loading_time,
       json_extract(value, '$.start') IS NOT NULL AS is_start,
       CAST(json_extract_string(value, '$.ts') AS BIGINT) AS ts
FROM raw_log WHERE json_valid(value) AND starts_with(value, '{')""")

cte("parsed_repaired", ("parsed",), """
SELECT *, CASE WHEN is_new0 = '1' AND row_number() OVER (PARTITION BY mid, is_new0 ORDER BY ts, seq) > 1
               THEN '0' ELSE is_new0 END AS is_new
FROM parsed""")

cte("display_log", ("parsed_repaired",), """
SELECT item, 'sku_id' AS item_type, '1' AS display_order, page_id, ts FROM parsed_repaired
WHERE NOT is_start AND page_id = 'view'
UNION ALL
SELECT mid AS item, 'activity_id' AS item_type, '2' AS display_order, page_id, ts FROM parsed_repaired
WHERE NOT is_start AND page_id = 'view'""")

cte("uv", ("page_repaired",), f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, strftime(make_timestamp(ts * 1000), '%Y-%m-%d')
                               ORDER BY ts, seq) AS rn
  FROM page_repaired WHERE last_page_id IS NULL OR last_page_id = '') WHERE rn = 1""")

cte("uj", ("page_repaired",), f"""
SELECT * EXCLUDE (nts, nentry) FROM (
  SELECT *, lead(ts) OVER w AS nts, lead(last_page_id IS NULL) OVER w AS nentry
  FROM page_repaired WINDOW w AS (PARTITION BY mid ORDER BY ts, seq))
WHERE last_page_id IS NULL AND (nts IS NULL OR nts - ts >= {JUMP_MS} OR nentry)""")

cte("visitor_rows", ("page_repaired", "uv", "uj"), """
SELECT vc, ch, ar, is_new, 1::BIGINT AS uv_ct, 0::BIGINT AS pv_ct, 0::BIGINT AS sv_ct, 0::BIGINT AS uj_ct,
       0::BIGINT AS dur_sum, ts FROM uv
UNION ALL
SELECT vc, ch, ar, is_new, 0, 0, 0, 1, 0, ts FROM uj
UNION ALL
SELECT vc, ch, ar, is_new, 0, 1, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END, 0,
       coalesce(during_time, 0), ts FROM page_repaired""")

cte("order_info", (), f"""
SELECT o.o_orderkey AS id, CAST(c.c_nationkey AS BIGINT) AS province_id, o.o_orderstatus AS order_status,
       o.o_custkey AS user_id, CAST(o.o_totalprice AS DECIMAL(16,2)) AS total_amount,
       CAST(0 AS DECIMAL(16,2)) AS activity_reduce_amount, CAST(0 AS DECIMAL(16,2)) AS coupon_reduce_amount,
       CAST(o.o_totalprice AS DECIMAL(16,2)) AS original_total_amount, CAST(0 AS DECIMAL(16,2)) AS feight_fee,
       CAST(NULL AS VARCHAR) AS expire_time, strftime(o.o_orderdate, {FMT}) AS create_time,
       CAST(NULL AS VARCHAR) AS operate_time
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")

cte("order_detail", (), f"""
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
       CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price, CAST(trunc(l_quantity) AS BIGINT) AS sku_num,
       'sku-' || CAST(l_partkey AS VARCHAR) AS sku_name, strftime(l_shipdate, {FMT}) AS create_time,
       CAST(l_extendedprice AS DECIMAL(16,2)) AS split_total_amount,
       CAST(0 AS DECIMAL(16,2)) AS split_activity_amount, CAST(0 AS DECIMAL(16,2)) AS split_coupon_amount
FROM lineitem""")

cte("payment_info", (), f"""
SELECT o_orderkey AS id, o_orderkey AS order_id, o_custkey AS user_id,
       CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount, 'order ' || CAST(o_orderkey AS VARCHAR) AS subject,
       CAST(1101 + o_orderkey % 3 AS VARCHAR) AS payment_type,
       strftime(o_orderdate + to_days(CAST(o_orderkey % 40 AS INTEGER)), {FMT}) AS create_time,
       CAST(NULL AS VARCHAR) AS callback_time
FROM orders WHERE o_orderstatus = 'F'""")

cte("dim_user", (), """
SELECT CAST(c_custkey AS VARCHAR) AS ID, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS GENDER,
       strftime(DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER), '%Y-%m-%d') AS BIRTHDAY
FROM customer""")

cte("dim_province", (), """
SELECT CAST(n.n_nationkey AS VARCHAR) AS ID, n.n_name AS NAME, 'A' || CAST(n.n_regionkey AS VARCHAR) AS AREA_CODE,
       'CN-' || CAST(n.n_nationkey AS VARCHAR) AS ISO_CODE,
       r.r_name || '-' || CAST(n.n_nationkey AS VARCHAR) AS ISO_3166_2
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("dim_c3", (), """
SELECT DISTINCT CAST(CAST('0x' || substr(md5(p_type), 1, 12) AS BIGINT) AS VARCHAR) AS ID, p_type AS NAME FROM part""")

cte("dim_sku", ("dim_c3",), """
SELECT CAST(p.p_partkey AS VARCHAR) AS ID, p.p_name AS SKU_NAME,
       CAST(CAST(p.p_retailprice AS DECIMAL(16,2)) AS VARCHAR) AS PRICE, CAST(p.p_size AS VARCHAR) AS SPU_ID,
       regexp_extract(p.p_brand, '#(\\d+)', 1) AS TM_ID, c.ID AS CATEGORY3_ID
FROM part p LEFT JOIN dim_c3 c ON p.p_type = c.NAME""")

cte("dim_spu", (), """
SELECT DISTINCT CAST(p_size AS VARCHAR) AS ID, 'spu-' || CAST(p_size AS VARCHAR) AS SPU_NAME FROM part""")

cte("dim_tm", (), """
SELECT DISTINCT regexp_extract(p_brand, '#(\\d+)', 1) AS ID, p_brand AS TM_NAME FROM part""")

cte("joined", ("order_info", "order_detail"), f"""
SELECT d.id AS detail_id, o.id AS order_id, d.sku_id, d.order_price, d.sku_num, d.sku_name, o.province_id,
       o.order_status, o.user_id, o.total_amount, o.activity_reduce_amount, o.coupon_reduce_amount,
       o.original_total_amount, o.feight_fee, CAST(NULL AS DECIMAL(16,2)) AS split_feight_fee,
       d.split_activity_amount, d.split_coupon_amount, d.split_total_amount, o.expire_time, o.create_time,
       o.operate_time, split_part(o.create_time, ' ', 1) AS create_date,
       split_part(split_part(o.create_time, ' ', 2), ':', 1) AS create_hour
FROM order_info o JOIN order_detail d ON o.id = d.order_id
 AND {_text_ms8('d.create_time')} BETWEEN {_text_ms8('o.create_time')} - {OD_MS} AND {_text_ms8('o.create_time')} + {OD_MS}""")

cte("order_wide", ("joined", "dim_user", "dim_province", "dim_sku", "dim_spu", "dim_tm", "dim_c3"), """
SELECT j.detail_id, j.order_id, j.sku_id, j.order_price, j.sku_num, s.SKU_NAME AS sku_name, j.province_id,
       j.order_status, j.user_id, j.total_amount, j.activity_reduce_amount, j.coupon_reduce_amount,
       j.original_total_amount, j.feight_fee, j.split_feight_fee, j.split_activity_amount,
       j.split_coupon_amount, j.split_total_amount, j.expire_time, j.create_time, j.operate_time,
       j.create_date, j.create_hour, p.NAME AS province_name, p.AREA_CODE AS province_area_code,
       p.ISO_CODE AS province_iso_code, p.ISO_3166_2 AS province_3166_2_code,
       CAST(floor((epoch_ms(TIMESTAMP '2024-01-01 00:00:00') - epoch_ms(strptime(u.BIRTHDAY, '%Y-%m-%d')))
                  / 31536000000) AS INTEGER) AS user_age,
       u.GENDER AS user_gender, CAST(s.SPU_ID AS BIGINT) AS spu_id, CAST(s.TM_ID AS BIGINT) AS tm_id,
       CAST(s.CATEGORY3_ID AS BIGINT) AS category3_id, sp.SPU_NAME AS spu_name, t.TM_NAME AS tm_name,
       c.NAME AS category3_name
FROM joined j
LEFT JOIN dim_user u ON CAST(j.user_id AS VARCHAR) = u.ID
LEFT JOIN dim_province p ON CAST(j.province_id AS VARCHAR) = p.ID
LEFT JOIN dim_sku s ON CAST(j.sku_id AS VARCHAR) = s.ID
LEFT JOIN dim_spu sp ON s.SPU_ID = sp.ID
LEFT JOIN dim_tm t ON s.TM_ID = t.ID
LEFT JOIN dim_c3 c ON s.CATEGORY3_ID = c.ID""")

PAYMENT_SELECT = """
SELECT p.id AS payment_id, p.subject, p.payment_type, p.create_time AS payment_create_time, p.callback_time,
       w.detail_id, p.order_id, w.sku_id, w.order_price, w.sku_num, w.sku_name, w.province_id, w.order_status,
       p.user_id, p.total_amount, w.activity_reduce_amount, w.coupon_reduce_amount, w.original_total_amount,
       w.feight_fee, w.split_feight_fee, w.split_activity_amount, w.split_coupon_amount, w.split_total_amount,
       w.create_time AS order_create_time, w.province_name, w.province_area_code, w.province_iso_code,
       w.province_3166_2_code, w.user_age, w.user_gender, w.spu_id, w.tm_id, w.category3_id, w.spu_name,
       w.tm_name, w.category3_name"""

cte("payment_wide", ("payment_info", "order_wide"), PAYMENT_SELECT + f"""
FROM payment_info p JOIN order_wide w ON p.order_id = w.order_id
 AND {_text_ms8('w.create_time')} BETWEEN {_text_ms8('p.create_time')} - {PAY_LO_MS} AND {_text_ms8('p.create_time')} + {PAY_HI_MS}""")

FEED_COLS = ["sku_id", "display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct",
             "good_comment_ct", "order_amount", "payment_amount", "refund_amount", "order_id", "paid_order_id",
             "refund_order_id", "ts"]


def _feed(src: str, sku: str, ts: str, where: str = "", **m) -> str:
    vals = []
    for c in FEED_COLS[1:-1]:
        if c in ("order_amount", "payment_amount", "refund_amount"):
            vals.append(f"CAST({m.get(c, '0')} AS DECIMAL(16,2)) AS {c}")
        else:
            vals.append(f"CAST({m.get(c, 'NULL' if c.endswith('order_id') else '0')} AS BIGINT) AS {c}")
    return f"SELECT CAST({sku} AS BIGINT) AS sku_id, {', '.join(vals)}, {ts} AS ts FROM {src} {where}"


cte("feeds", ("page_log", "display_log", "order_wide", "payment_wide"), "\nUNION ALL\n".join([
    _feed("page_log", "item", "ts", "WHERE item_type = 'sku_id' AND page_id = 'click'", click_ct="1"),
    _feed("display_log", "item", "ts", "WHERE item_type = 'sku_id'", display_ct="1"),
    _feed("events", "json_extract_string(props, '$.k')", _text_ms8(f"strftime(ts, {FMT})"),
          "WHERE event_type = 'view'", favor_ct="1"),
    _feed("events", "json_extract_string(props, '$.k')", _text_ms8(f"strftime(ts, {FMT})"),
          "WHERE event_type = 'click'", cart_ct="1"),
    _feed("order_wide", "sku_id", _text_ms8("create_time"), order_sku_num="sku_num",
          order_amount="split_total_amount", order_id="order_id"),
    _feed("payment_wide", "sku_id", _text_ms8("payment_create_time"), payment_amount="split_total_amount",
          paid_order_id="order_id"),
    _feed("lineitem", "l_partkey", _text_ms8(f"strftime(l_shipdate, {FMT})"), "WHERE l_returnflag = 'R'",
          refund_amount="l_extendedprice", refund_order_id="l_orderkey"),
    _feed("labels", "doc_id", _text_ms8(f"strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id), {FMT})"),
          comment_ct="1", good_comment_ct="CASE WHEN quality = 1 THEN 1 ELSE 0 END"),
]))

PRODUCT_AGG = f"""
SELECT {_win('ts', STATS_WIN_MS)}, sku_id,
       CAST(sum(display_ct) AS BIGINT) AS display_ct, CAST(sum(click_ct) AS BIGINT) AS click_ct,
       CAST(sum(favor_ct) AS BIGINT) AS favor_ct, CAST(sum(cart_ct) AS BIGINT) AS cart_ct,
       CAST(sum(order_sku_num) AS BIGINT) AS order_sku_num, CAST(sum(comment_ct) AS BIGINT) AS comment_ct,
       CAST(sum(good_comment_ct) AS BIGINT) AS good_comment_ct,
       CAST(sum(order_amount) AS DECIMAL(18,2)) AS order_amount,
       CAST(sum(payment_amount) AS DECIMAL(18,2)) AS payment_amount,
       CAST(sum(refund_amount) AS DECIMAL(18,2)) AS refund_amount,
       count(DISTINCT order_id) AS order_ct, count(DISTINCT paid_order_id) AS paid_order_ct,
       count(DISTINCT refund_order_id) AS refund_order_ct, min(ts) AS ts
FROM feeds GROUP BY ALL"""

cte("product_stats", ("feeds",), PRODUCT_AGG)

cte("keyword_words", (), """
SELECT strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id), '%Y-%m-%d %H:%M:%S') AS rt, lower(w) AS word,
       epoch_ms(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id)) AS rt_ms
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[\\p{L}\\p{N}]+')) AS w FROM documents)""")

# Dictionary words at every position of every text, word length by word length.
cte("dictionary", (), """
SELECT DISTINCT lower(w) AS word FROM (SELECT unnest(regexp_extract_all(text, '[\\p{L}\\p{N}]+')) AS w FROM benchmark) WHERE len(lower(w)) >= 4""")
cte("dictionary_hits", ("dictionary",), """
SELECT doc_id, pos, len(word) AS size, word
FROM (SELECT doc_id, CAST(n * 1000 + i AS INTEGER) AS pos,
             unnest(list_transform(list_filter(sizes, lambda z: i + z - 1 <= len(piece)), lambda z: substr(piece, i, z))) AS found
      FROM (SELECT doc_id, n, piece, sizes, unnest(range(1, least(len(piece), 1000) + 1)) AS i
            FROM (SELECT doc_id, n, sizes, substr(lower(text), n * 1000 + 1, 999 + most) AS piece
                  FROM (SELECT doc_id, text, unnest(range(0, (len(text) + 999) // 1000)) AS n FROM documents)
                  CROSS JOIN (SELECT max(len(word)) AS most, list(DISTINCT len(word)) AS sizes FROM dictionary))))
JOIN dictionary ON word = found""")

ORDER_MAP = """'create_time=' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ',id=' || CAST(o_orderkey AS VARCHAR)
       || ',order_status=' || {status} || ',total_amount=' || CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR)
       || ',user_id=' || CAST(o_custkey AS VARCHAR)"""
cte("changes", (), f"""
SELECT 'shop' AS database, 'order_info' AS tableName, 'insert' AS type, '' AS before_text,
       {ORDER_MAP.format(status='o_orderstatus')} AS after_text, o_orderkey AS key, 0 AS version FROM orders
UNION ALL
SELECT 'shop', 'order_info', 'update', {ORDER_MAP.format(status='o_orderstatus')},
       {ORDER_MAP.format(status="'U'")}, o_orderkey, 1 FROM orders WHERE o_orderkey % 3 = 0
UNION ALL
SELECT 'shop', 'order_info', 'delete',
       {ORDER_MAP.format(status="CASE WHEN o_orderkey % 3 = 0 THEN 'U' ELSE o_orderstatus END")}, '',
       o_orderkey, 2 FROM orders WHERE o_orderkey % 10 = 0
UNION ALL
SELECT 'shop', 'order_detail', 'read', '',
       'order_id=' || CAST(l_orderkey AS VARCHAR) || ',sku_id=' || CAST(l_partkey AS VARCHAR)
       || ',sku_num=' || CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR), l_orderkey, 0 FROM lineitem""")

cte("config", (), """
SELECT * FROM (VALUES
  ('order_info', 'insert', 'kafka', 'dwd_order_info', 'id'),
  ('order_info', 'update', 'hbase', 'dim_order_status', 'id'),
  ('base_trademark', 'update', 'hbase', 'dim_base_trademark', 'id')
) AS t(sourceTable, operateType, sinkType, sinkTable, pk)""")

cte("routed", ("changes", "config"), """
SELECT c.tableName, c.type, g.sinkType, g.sinkTable, g.pk,
       CASE WHEN g.sinkTable = 'dim_order_status'
            THEN regexp_extract(c.after_text, '(id=[^,]*)', 1) || ',' || regexp_extract(c.after_text, '(order_status=[^,]*)', 1)
            ELSE c.after_text END AS after_text, c.key, c.version
FROM changes c JOIN config g ON c.tableName = g.sourceTable AND c.type = g.operateType
WHERE c.type IS DISTINCT FROM 'delete'""")

cte("status_dim", ("routed",), """
SELECT CAST(o.o_orderkey AS VARCHAR) AS id, coalesce(u.order_status, o.o_orderstatus) AS order_status
FROM orders o LEFT JOIN (
  SELECT CAST(key AS VARCHAR) AS id, arg_max(regexp_extract(after_text, 'order_status=([^,]*)', 1), version) AS order_status
  FROM routed WHERE sinkType = 'hbase' GROUP BY 1) u ON CAST(o.o_orderkey AS VARCHAR) = u.id""")


def _with(deps: tuple[str, ...], body: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTE[n][0]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][1]})" for n in order) + "\n" + body.strip()


PAGE_COLS = "mid, ar, ch, vc, is_new, page_id, last_page_id, item, item_type, during_time, ts, seq"
ORDER_WIDE_SELECT = "SELECT * FROM order_wide"

SQL: dict[str, str] = {
    "log_dirty": _with(("raw_log",), """
        SELECT seq, value FROM raw_log WHERE NOT (json_valid(value) AND starts_with(value, '{'))"""),
    "log_page": _with(("parsed_repaired",), f"""
        SELECT {PAGE_COLS} FROM parsed_repaired WHERE NOT is_start"""),
    "log_start": _with(("parsed_repaired",), """
        SELECT mid, is_new, entry, loading_time, ts, seq FROM parsed_repaired WHERE is_start"""),
    "log_display": _with(("display_log",), "SELECT item, item_type, display_order, page_id, ts FROM display_log"),
    "log_display_no_ts": _with(("display_log",), "SELECT item, item_type, display_order, page_id FROM display_log"),
    "to_json_rows": _with(("display_log",), """
        SELECT CAST(to_json({'item': item, 'item_type': item_type, 'page_id': page_id, 'ts': ts}) AS VARCHAR) AS json
        FROM display_log"""),
    "new_visitor_repair": _with(("page_repaired",), f"SELECT {PAGE_COLS} FROM page_repaired"),
    "unique_visit": _with(("page_log",), f"""
        SELECT {PAGE_COLS} FROM (
          SELECT *, row_number() OVER (PARTITION BY mid, strftime(make_timestamp(ts * 1000), '%Y-%m-%d')
                                       ORDER BY ts, seq) AS rn
          FROM page_log WHERE last_page_id IS NULL OR last_page_id = '') WHERE rn = 1"""),
    "unique_visit_strict": _with(("page_log",), f"""
        SELECT {PAGE_COLS} FROM (
          SELECT *, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS day,
                 lag(strftime(make_timestamp(ts * 1000), '%Y-%m-%d')) OVER (PARTITION BY mid ORDER BY seq) AS prev
          FROM page_log WHERE last_page_id IS NULL OR last_page_id = '')
        WHERE prev IS NULL OR prev <> day"""),
    "tumble_counts": _with(("page_log",), f"""
        SELECT {_win('ts', TUMBLE_WIN_MS)}, page_id, count(*) AS ct, min(ts) AS ts FROM page_log GROUP BY ALL"""),
    "visitor_union": _with(("visitor_rows",), "SELECT * FROM visitor_rows"),
    "visitor_stats": _with(("visitor_rows",), f"""
        SELECT {_win('ts', VISIT_WIN_MS)}, vc, ch, ar, is_new,
               CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
               CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct,
               CAST(sum(dur_sum) AS BIGINT) AS dur_sum, min(ts) AS ts
        FROM visitor_rows GROUP BY ALL"""),
    "order_time_parts": _with(("order_info",), f"""
        SELECT *, split_part(create_time, ' ', 1) AS create_date,
               split_part(split_part(create_time, ' ', 2), ':', 1) AS create_hour,
               {_text_ms8('create_time')} AS create_ts FROM order_info"""),
    "order_interval_join": _with(("joined",), """
        SELECT detail_id, order_id, sku_id, sku_num, order_status, user_id, province_id, split_total_amount,
               total_amount, create_time, create_date, create_hour FROM joined"""),
    "lookup_user_age": _with(("order_wide",), "SELECT detail_id, order_id, user_id, user_gender, user_age FROM order_wide"),
    "lookup_province": _with(("order_wide",), """
        SELECT detail_id, order_id, province_id, province_name, province_area_code, province_iso_code,
               province_3166_2_code FROM order_wide"""),
    "lookup_sku": _with(("order_wide",), """
        SELECT detail_id, order_id, sku_id, sku_name, spu_id, tm_id, category3_id FROM order_wide"""),
    "lookup_snowflake": _with(("order_wide",), """
        SELECT detail_id, order_id, sku_id, spu_id, spu_name, tm_id, tm_name, category3_id, category3_name
        FROM order_wide"""),
    "order_wide": _with(("order_wide",), ORDER_WIDE_SELECT),
    "payment_interval_join": _with(("payment_info", "joined"), f"""
        SELECT p.id AS payment_id, p.order_id, j.detail_id, p.create_time AS payment_create_time,
               j.create_time AS order_create_time, p.total_amount, j.split_total_amount
        FROM payment_info p JOIN joined j ON p.order_id = j.order_id
         AND {_text_ms8('j.create_time')} BETWEEN {_text_ms8('p.create_time')} - {PAY_LO_MS}
                                              AND {_text_ms8('p.create_time')} + {PAY_HI_MS}"""),
    "payment_wide": _with(("payment_wide",), "SELECT * FROM payment_wide"),
    "order_wide_merge": _with(("order_info", "order_detail"), """
        SELECT d.id AS detail_id, coalesce(o.id, d.order_id) AS order_id, d.sku_id, d.order_price, d.sku_num,
               d.sku_name, o.province_id, o.order_status, o.user_id, o.total_amount, o.activity_reduce_amount,
               o.coupon_reduce_amount, o.original_total_amount, o.feight_fee,
               CAST(NULL AS DECIMAL(16,2)) AS split_feight_fee, d.split_activity_amount, d.split_coupon_amount,
               d.split_total_amount, o.expire_time, o.create_time, o.operate_time,
               split_part(o.create_time, ' ', 1) AS create_date,
               split_part(split_part(o.create_time, ' ', 2), ':', 1) AS create_hour,
               CAST(NULL AS VARCHAR) AS province_name, CAST(NULL AS VARCHAR) AS province_area_code,
               CAST(NULL AS VARCHAR) AS province_iso_code, CAST(NULL AS VARCHAR) AS province_3166_2_code,
               CAST(NULL AS INTEGER) AS user_age, CAST(NULL AS VARCHAR) AS user_gender,
               CAST(NULL AS BIGINT) AS spu_id, CAST(NULL AS BIGINT) AS tm_id, CAST(NULL AS BIGINT) AS category3_id,
               CAST(NULL AS VARCHAR) AS spu_name, CAST(NULL AS VARCHAR) AS tm_name,
               CAST(NULL AS VARCHAR) AS category3_name
        FROM order_info o FULL OUTER JOIN order_detail d ON o.id = d.order_id"""),
    "province_rows": _with(("order_wide",), """
        SELECT province_id, province_name, province_area_code, province_iso_code, province_3166_2_code,
               split_total_amount AS order_amount, CAST(1 AS BIGINT) AS order_count, order_id, create_time
        FROM order_wide"""),
    "province_stats": _with(("order_wide",), f"""
        SELECT {_win(f"epoch_ms(strptime(create_time, {FMT}))", STATS_WIN_MS)}, province_id, province_name,
               province_area_code, province_iso_code, province_3166_2_code,
               CAST(sum(split_total_amount) AS DECIMAL(18,2)) AS order_amount,
               count(DISTINCT order_id) AS order_count, min(epoch_ms(strptime(create_time, {FMT}))) AS ts
        FROM order_wide GROUP BY ALL"""),
    "product_clicks": _with(("page_log",), """
        SELECT CAST(item AS BIGINT) AS sku_id, CAST(1 AS BIGINT) AS click_ct, ts FROM page_log
        WHERE item_type = 'sku_id' AND page_id = 'click'"""),
    "product_displays": _with(("display_log",), """
        SELECT CAST(item AS BIGINT) AS sku_id, CAST(1 AS BIGINT) AS display_ct, ts FROM display_log
        WHERE item_type = 'sku_id'"""),
    "comment_counts": _with((), f"""
        SELECT doc_id AS sku_id, CAST(1 AS BIGINT) AS comment_ct,
               CAST(CASE WHEN quality = 1 THEN 1 ELSE 0 END AS BIGINT) AS good_comment_ct,
               {_text_ms8(f"strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id), {FMT})")} AS ts
        FROM labels"""),
    "product_union": _with(("feeds",), "SELECT * FROM feeds"),
    "product_stats": _with(("product_stats",), "SELECT * FROM product_stats"),
    "product_stats_dims": _with(("product_stats", "dim_sku", "dim_spu", "dim_tm", "dim_c3"), """
        SELECT s.stt, s.edt, s.sku_id, k.SKU_NAME AS sku_name, CAST(k.PRICE AS DECIMAL(16,2)) AS sku_price,
               CAST(k.SPU_ID AS BIGINT) AS spu_id, sp.SPU_NAME AS spu_name, CAST(k.TM_ID AS BIGINT) AS tm_id,
               t.TM_NAME AS tm_name, CAST(k.CATEGORY3_ID AS BIGINT) AS category3_id, c.NAME AS category3_name,
               s.display_ct, s.click_ct, s.favor_ct, s.cart_ct, s.order_sku_num, s.order_amount, s.order_ct,
               s.payment_amount, s.paid_order_ct, s.refund_order_ct, s.refund_amount, s.comment_ct,
               s.good_comment_ct, s.ts
        FROM product_stats s LEFT JOIN dim_sku k ON CAST(s.sku_id AS VARCHAR) = k.ID
        LEFT JOIN dim_spu sp ON k.SPU_ID = sp.ID LEFT JOIN dim_c3 c ON k.CATEGORY3_ID = c.ID
        LEFT JOIN dim_tm t ON k.TM_ID = t.ID"""),
    "gmv_by_day": _with(("product_stats",), """
        SELECT CAST(replace(substr(stt, 1, 10), '-', '') AS INTEGER) AS day,
               CAST(sum(order_amount) AS DECIMAL(18,2)) AS gmv FROM product_stats GROUP BY 1"""),
    "gmv_daily": _with(("product_stats",), """
        SELECT CAST(replace(substr(stt, 1, 10), '-', '') AS INTEGER) AS day,
               CAST(sum(order_amount) AS DECIMAL(18,2)) AS gmv FROM product_stats GROUP BY 1"""),
    "gmv_day": _with(("product_stats",), """
        SELECT CAST(sum(order_amount) AS DECIMAL(18,2)) AS gmv FROM product_stats
        WHERE stt >= '1995-03-15' AND stt < '1995-03-16'"""),
    "keyword_filter": _with(("parsed_repaired",), f"""
        SELECT item AS full_word, {_fmt_ms('ts')} AS rt FROM parsed_repaired
        WHERE NOT is_start AND item_type = 'keyword' AND item IS NOT NULL"""),
    "keyword_explode": _with(("keyword_words",), "SELECT rt, word FROM keyword_words"),
    "keyword_stats": _with(("keyword_words",), f"""
        SELECT word AS keyword, count(*) AS ct, 'search' AS source, {_win('rt_ms', STATS_WIN_MS)},
               min(rt_ms) AS ts FROM keyword_words GROUP BY word, stt, edt"""),
    "keyword_dictionary": _with(("dictionary_hits",), """
        SELECT word, count(*) AS ct, count(DISTINCT doc_id) AS texts FROM dictionary_hits GROUP BY word"""),
    "keyword_dictionary_longest": _with(("dictionary_hits",), """
        SELECT word, count(*) AS ct, count(DISTINCT doc_id) AS texts
        FROM (SELECT *, max(pos + size) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
              FROM (SELECT doc_id, pos, max(size) AS size, max_by(word, size) AS word FROM dictionary_hits GROUP BY doc_id, pos))
        WHERE reach IS NULL OR reach < pos + size GROUP BY word"""),
    "cdc_normalize": _with(("changes",), "SELECT * FROM changes"),
    "filter_not_delete": _with(("changes",), "SELECT * FROM changes WHERE type IS DISTINCT FROM 'delete'"),
    "cdc_current_state": _with((), """
        SELECT o_orderkey AS id, o_custkey AS user_id,
               CASE WHEN o_orderkey % 3 = 0 THEN 'U' ELSE o_orderstatus END AS order_status,
               CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time
        FROM orders WHERE o_orderkey % 10 <> 0"""),
    "route_fact": _with(("routed",), "SELECT * FROM routed WHERE sinkType = 'kafka'"),
    "route_dim": _with(("routed",), "SELECT * FROM routed WHERE sinkType = 'hbase'"),
    "route_prune_columns": _with(("routed",), "SELECT * FROM routed"),
    "route_as_of": _with(("changes",), """
        SELECT c.tableName, c.type, g.sinkType, g.sinkTable, 'id' AS pk,
               array_to_string(list_transform(string_split(g.cols, ','), lambda f: f || '=' || regexp_extract(c.after_text, '(^|,)' || f || '=([^,]*)', 2)), ',')
                 AS after_text, c.key, c.version
        FROM changes c JOIN (VALUES
          ('insert', 'kafka', 'dwd_order_info', 'id,user_id', 0, 1000), ('insert', 'kafka', 'dwd_order_paid', 'id,order_status,total_amount', 1000, 2500),
          ('insert', 'kafka', 'dwd_order_info', 'id,user_id', 4000, NULL), ('update', 'hbase', 'dim_order_status', 'id,order_status', 0, 3000))
          AS g(kind, sinkType, sinkTable, cols, since, until)
          ON c.tableName = 'order_info' AND c.type = g.kind AND c.key >= g.since AND (g.until IS NULL OR c.key < g.until)"""),
    "route_unmatched": _with(("changes", "config"), """
        SELECT c.* FROM changes c WHERE c.type IS DISTINCT FROM 'delete' AND NOT EXISTS (
          SELECT 1 FROM config g WHERE g.sourceTable = c.tableName AND g.operateType = c.type)"""),
    "dim_upsert": _with(("status_dim",), "SELECT id, order_status FROM status_dim"),
    "dim_store": _with(("status_dim",), "SELECT id, order_status FROM status_dim"),
    "dim_key_read": _with(("status_dim",), """
        SELECT id, order_status FROM status_dim WHERE id = (SELECT max(id) FROM status_dim)"""),
    "dim_latest_version": _with(("status_dim",), """
        SELECT l.l_orderkey * 10 + l.l_linenumber AS detail_id, l.l_orderkey AS order_id, l.l_partkey AS sku_id,
               s.order_status FROM lineitem l LEFT JOIN status_dim s ON CAST(l.l_orderkey AS VARCHAR) = s.id"""),
    "dim_point_lookup": _with(("order_info", "dim_user"), """
        SELECT o.id, o.user_id, u.GENDER AS gender, u.BIRTHDAY AS birthday
        FROM order_info o JOIN dim_user u ON CAST(o.user_id AS VARCHAR) = u.ID"""),
    "rename_snake_to_camel": _with(("order_info",), """
        SELECT id, province_id AS provinceId, order_status AS orderStatus, user_id AS userId,
               total_amount AS totalAmount, activity_reduce_amount AS activityReduceAmount,
               coupon_reduce_amount AS couponReduceAmount, original_total_amount AS originalTotalAmount,
               feight_fee AS feightFee, expire_time AS expireTime, create_time AS createTime,
               operate_time AS operateTime FROM order_info"""),
    "decode_codes": """
        SELECT o_orderkey AS order_id, CAST(1001 + o_orderkey % 6 AS VARCHAR) AS order_status,
               CASE o_orderkey % 6 WHEN 0 THEN 'unpaid' WHEN 1 THEN 'paid' WHEN 2 THEN 'cancelled' WHEN 3 THEN 'finished'
                    WHEN 4 THEN 'refunding' ELSE 'refunded' END AS order_status_name,
               CAST(1101 + o_orderkey % 4 AS VARCHAR) AS payment_type,
               CASE o_orderkey % 4 WHEN 0 THEN 'alipay' WHEN 1 THEN 'wechat' WHEN 2 THEN 'unionpay' END AS payment_type_name
        FROM orders""",
}
SQL["pattern_funnel"] = _with(("page_log",), f"""
    SELECT mid, ts, seq, kind, matched, CASE matched WHEN 1 THEN ts WHEN 2 THEN t1 ELSE t2 END AS last_ts FROM (
      SELECT *, CASE WHEN t1 IS NULL OR t1 - ts >= {JUMP_MS} THEN 'timeout' WHEN p1 <> 'click' THEN NULL
                     WHEN t2 IS NULL OR t2 - ts >= {JUMP_MS} THEN 'timeout' WHEN p2 = 'purchase' THEN 'match' END AS kind,
                CASE WHEN t1 IS NULL OR t1 - ts >= {JUMP_MS} THEN 1 WHEN t2 IS NULL OR t2 - ts >= {JUMP_MS} THEN 2 ELSE 3 END AS matched
      FROM (SELECT *, lead(ts) OVER w AS t1, lead(page_id) OVER w AS p1, lead(ts, 2) OVER w AS t2, lead(page_id, 2) OVER w AS p2
            FROM page_log WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)))
    WHERE page_id = 'view' AND kind IS NOT NULL""")
SQL["user_jump"] = _with(("page_log",), f"""
    SELECT {PAGE_COLS}, kind FROM (
      SELECT *, CASE WHEN nts IS NULL OR nts - ts >= {JUMP_MS} THEN 'timeout' WHEN nentry THEN 'match' END AS kind
      FROM (SELECT *, lead(ts) OVER w AS nts, lead(last_page_id IS NULL) OVER w AS nentry
            FROM page_log WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)))
    WHERE last_page_id IS NULL AND kind IS NOT NULL""")
SQL["user_jump_match"] = f"SELECT {PAGE_COLS} FROM ({SQL['user_jump']}) WHERE kind = 'match'"
SQL["user_jump_timeout"] = f"SELECT {PAGE_COLS} FROM ({SQL['user_jump']}) WHERE kind = 'timeout'"


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

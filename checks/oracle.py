"""The registered queries in plain SQL over the sample tables.

The statements follow the definition of each result (joins of whole tables, sub-selects per measure), not the shape of
the Spark plans.
"""

from __future__ import annotations

HOURS = "to_hours(o_orderkey % 24)"
BATCH = "TIMESTAMP '2001-01-01 00:00:00'"
EVENT_BATCH = "TIMESTAMP '2024-01-20 00:00:00'"

# -- sample tables as source tables ----------------------------------------------------------------------------------

TRX = f"""
heads AS (SELECT o_custkey AS cust, min(o_orderkey) AS head FROM orders GROUP BY o_custkey),
trx AS (
  SELECT o_orderkey AS id, CAST(n_regionkey AS BIGINT) AS merchant_id, CAST(c_nationkey AS BIGINT) AS outlet_id,
    o_orderdate + {HOURS} AS sold_at,
    o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER)) AS updated_at,
    CASE WHEN o_orderkey % 17 <> 0 THEN o_orderdate + {HOURS} END AS paid_at,
    CASE WHEN o_orderstatus IN ('F', 'O') THEN '1' WHEN o_orderkey % 2 = 0 THEN '4' ELSE '9' END AS status,
    CASE o_orderkey % 10 WHEN 0 THEN '1' WHEN 9 THEN '9' ELSE '5' END AS purpose,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS order_type,
    CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 2 THEN '{{"tax_base_type": 0}}' WHEN 3 THEN '{{"tax_base_type": 2}}'
      WHEN 4 THEN '{{bad' WHEN 5 THEN '{{}}' END AS type_detail,
    CAST(o_totalprice AS DECIMAL(12,2)) AS total,
    CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) ELSE 0 END AS refund,
    CASE WHEN o_orderkey % 11 = 0 THEN 'cancel' WHEN o_orderkey % 2 <> 0 THEN '' END AS refund_reason,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.11 AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS tax_nominal,
    CAST(o_orderkey % 1000 AS DECIMAL(12,2)) AS cash_change,
    CASE WHEN o_orderkey = head OR o_orderkey % 13 = 1 THEN 1 WHEN o_orderkey % 5 <> 0 THEN 0 END AS split_flag,
    CASE WHEN o_orderkey = head THEN 1 WHEN o_orderkey % 13 = 1 THEN 2 ELSE 0 END AS payment_no,
    CASE WHEN o_orderkey % 101 <> 50 THEN 'N' || o_orderkey END AS receipt_no,
    CASE WHEN o_orderkey <> head AND o_orderkey % 13 = 1 THEN 'N' || head END AS parent_receipt_no,
    CASE WHEN o_orderkey % 19 <> 0 THEN o_orderkey % 31 END AS cashier_id,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 37 END AS auth_id,
    CASE WHEN o_orderkey % 4 <> 0 THEN 'note ' || o_orderkey END AS note,
    CASE WHEN o_orderkey % 23 <> 0 THEN o_orderkey % 9 END AS item_count
  FROM orders JOIN heads ON o_custkey = cust JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
)"""

# Before the batch: later changes are absent (odd ids) or had another day, type and status (even ids).
OLD_TRX = f"""
old_trx AS (
  SELECT * FROM trx WHERE updated_at < {BATCH}
  UNION ALL
  SELECT * REPLACE (sold_at - INTERVAL 40 DAY AS sold_at, CASE WHEN id % 3 = 0 THEN 1 ELSE order_type END AS order_type,
    '1' AS status)
  FROM trx WHERE updated_at >= {BATCH} AND id % 2 = 0
)"""

LINES = """
lines AS (
  SELECT l_orderkey AS transaction_id, l_linenumber AS line, CAST(l_quantity AS DECIMAL(12,2)) AS quantity,
    CAST(p_retailprice AS DECIMAL(12,2)) AS unit_cost, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
    CAST(l_discount AS DECIMAL(4,2)) AS discount, CAST(l_tax AS DECIMAL(4,2)) AS tax, l_returnflag, l_linestatus,
    p_type, p_size
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
),
payment AS (SELECT transaction_id, line AS method, price * (1 - discount) AS value, price * tax AS mdr
            FROM lines WHERE line <= 2)"""

RES = """
res AS (
  SELECT event_id AS id, user_id % 10 AS merchant_id, user_id % 3 AS outlet_id, user_id AS customer_id,
    CASE event_type WHEN 'purchase' THEN 700 WHEN 'signup' THEN 9 WHEN 'error' THEN 15 ELSE 100 END AS status,
    ts AS updated_at, CAST(ts AS DATE) AS reserved_on, CAST(event_id % 3 AS INTEGER) AS type
  FROM events
),
svc AS (
  SELECT event_id AS id, event_id AS reservation_id, event_id % 40 AS product_id, CAST(ts AS DATE) AS service_date,
    ts AS start_at, ts + to_minutes(CAST(floor(value) AS BIGINT)) AS end_at, user_id % 20 AS employee_id,
    CAST(value AS DECIMAL(12,2)) AS price, CASE WHEN event_id % 4 <> 0 THEN 1 ELSE 0 END AS is_parent
  FROM events
)"""

OLD_RES = f"""
old_res AS (
  SELECT * FROM res WHERE updated_at < {EVENT_BATCH}
  UNION ALL
  SELECT * REPLACE (CAST(reserved_on - INTERVAL 3 DAY AS DATE) AS reserved_on, (outlet_id + 1) % 3 AS outlet_id,
    CASE WHEN status = 100 THEN 700 ELSE status END AS status)
  FROM res WHERE updated_at >= {EVENT_BATCH} AND id % 2 = 0
)"""

IS_SALE = "t.status IN ('1', '4', '9') AND t.purpose IN ('5', '9') AND t.sold_at > TIMESTAMP '1970-01-01 00:00:00'"
OWN_BILL = "((t.split_flag = 1 AND t.payment_no <= 1) OR t.split_flag <> 1 OR t.split_flag IS NULL)"
IS_REFUND = "(t.refund > 0 OR coalesce(t.refund_reason, '') <> '')"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def doubles(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


# -- sales -----------------------------------------------------------------------------------------------------------

def sales_raw(trx: str, name: str = "raw") -> str:
    return f"""
{name} AS (
  SELECT t.id AS id_transaction, t.merchant_id, t.outlet_id, {IS_REFUND} AS is_refund, t.sold_at AS datetime,
    CAST(t.sold_at AS DATE) AS date, t.total AS sales_value, coalesce(m.payment_value, 0) AS payment_value,
    coalesce(d.gross_sales, 0) AS gross_sales, t.refund, coalesce(t.order_type, 99) AS order_type,
    coalesce(d.product, 0) AS product, coalesce(d.hpp_product, 0) AS hpp_product,
    coalesce(a.hpp_addon, 0) AS hpp_addon, coalesce(m.mdr, 0) AS mdr, coalesce(c.commission, 0) AS commission,
    CAST(CASE WHEN (t.split_flag = 1 AND t.parent_receipt_no IS NOT NULL) OR {IS_REFUND} THEN 0 ELSE 1 END AS BIGINT)
      AS count_transaction
  FROM {trx} t
  LEFT JOIN (SELECT t.id, sum(p.mdr) AS mdr,
               sum(CASE WHEN p.method = 1 THEN p.value - t.cash_change ELSE p.value END) AS payment_value
             FROM {trx} t JOIN payment p ON p.transaction_id = t.id GROUP BY t.id) m ON m.id = t.id
  LEFT JOIN (SELECT transaction_id AS id, sum(quantity) AS product, sum(quantity * unit_cost) AS hpp_product,
               sum(price) AS gross_sales FROM lines GROUP BY 1) d ON d.id = t.id
  LEFT JOIN (SELECT transaction_id AS id, sum(p_size * unit_cost * CAST(0.01 AS DECIMAL(3,2))) AS hpp_addon
             FROM lines WHERE p_type = 'PROMO' GROUP BY 1) a ON a.id = t.id
  LEFT JOIN (SELECT t.id, sum(l.price * l.discount) AS commission
             FROM {trx} t JOIN lines l ON l.transaction_id = t.id
             WHERE l.l_returnflag = 'A' AND {OWN_BILL} AND t.paid_at IS NOT NULL GROUP BY t.id) c ON c.id = t.id
  WHERE {IS_SALE} AND t.status = '1'
)"""


SALES_RAW_OUT = ("id_transaction, merchant_id, outlet_id, is_refund, datetime, date, order_type, count_transaction, "
                 + doubles("sales_value", "payment_value", "gross_sales", "refund", "product", "hpp_product", "hpp_addon",
                           "mdr", "commission"))
MONEY = ("sales_value", "payment_value", "gross_value", "gross_sales", "product_qty", "refund", "commission")
WHEN = {
    "hourly": ("date", "hour"), "daily": ("date",), "monthly": ("year", "month"), "yearly": ("year",),
}
WHEN_SQL = {
    "date": "date", "hour": "CAST(hour(datetime) AS INTEGER) AS hour", "year": "CAST(year(date) AS INTEGER) AS year",
    "month": "CAST(month(date) AS INTEGER) AS month",
}
BURDEN = "mdr + hpp_product + hpp_addon + commission"


def sales_level(level: str, raw: str = "raw", name: str | None = None) -> str:
    """Any level straight from the raw rows; ``name`` makes it a common table expression."""
    dims = ["merchant_id", "outlet_id", "order_type", *(WHEN_SQL[w] for w in WHEN[level])]
    select = f"""
  SELECT {", ".join(dims)},
    sum(CASE WHEN is_refund THEN 0 ELSE sales_value END) AS sales_value,
    sum(CASE WHEN is_refund THEN 0 ELSE payment_value END) AS payment_value,
    sum(CASE WHEN is_refund THEN sales_value + {BURDEN} ELSE sales_value - ({BURDEN}) END) AS gross_value,
    sum(CASE WHEN is_refund THEN 0 ELSE gross_sales END) AS gross_sales,
    sum(CASE WHEN is_refund THEN 0 ELSE product END) AS product_qty,
    CAST(sum(count_transaction) AS BIGINT) AS transaction,
    sum(CASE WHEN is_refund THEN refund ELSE 0 END) AS refund,
    sum(CASE WHEN is_refund THEN 0 ELSE commission END) - sum(CASE WHEN is_refund THEN commission ELSE 0 END)
      AS commission
  FROM {raw} GROUP BY {", ".join(str(i + 1) for i in range(len(dims)))}"""
    return select if name is None else f"\n{name} AS ({select})"


def sales_out(level: str) -> str:
    return f"merchant_id, outlet_id, order_type, {', '.join(WHEN[level])}, transaction, {doubles(*MONEY)}"


def sales_full(level: str, trx: str = "trx", *more: str) -> str:
    return (with_(TRX, *more, LINES, sales_raw(trx), sales_level(level, name="lvl"))
            + f"SELECT {sales_out(level)} FROM lvl")


def sales_mixed(level: str, current: str) -> str:
    """Rows of the current source where ``current`` holds, of the stored one elsewhere."""
    return (with_(TRX, OLD_TRX, LINES, sales_raw("trx"), sales_raw("old_trx", "old_raw"),
                  sales_level(level, name="lvl"), sales_level(level, "old_raw", name="old_lvl"))
            + f"SELECT {sales_out(level)} FROM lvl WHERE {current}\nUNION ALL\n"
            + f"SELECT {sales_out(level)} FROM old_lvl WHERE NOT ({current})")


def published_or_over(level: str, out: str, dims: tuple[str, ...], over: str) -> str:
    """Current rows of the periods that are over, and of the keys that the stored mart had published before."""
    same = " AND ".join(f"o.{k} = n.{k}" for k in (*dims, *WHEN[level]))
    return f"SELECT {out} FROM lvl n WHERE {over} OR EXISTS (SELECT 1 FROM old_lvl o WHERE {same})"


def sales_kept_right(level: str, over: str) -> str:
    return (with_(TRX, OLD_TRX, LINES, sales_raw("trx"), sales_raw("old_trx", "old_raw"),
                  sales_level(level, name="lvl"), sales_level(level, "old_raw", name="old_lvl"))
            + published_or_over(level, sales_out(level), ("merchant_id", "outlet_id", "order_type"), over))


# -- net variant -----------------------------------------------------------------------------------------------------

# Parts: payments per part, then parts per bill; a bill's change is taken off once for each of its cash payments.
CHILDREN = f"""
part_paid AS (
  SELECT transaction_id, sum(mdr) AS mdr, sum(value) FILTER (method <> 1) AS other, sum(value) FILTER (method = 1) AS cash,
    count(value) FILTER (method = 1) AS cash_rows
  FROM payment GROUP BY transaction_id),
bills AS (
  SELECT part.merchant_id, part.outlet_id, part.parent_receipt_no AS receipt_no, sum(part.total) AS total, sum(paid.mdr) AS mdr,
    sum(paid.other) AS other, sum(paid.cash) AS cash, sum(paid.cash_rows) AS cash_rows
  FROM trx part LEFT JOIN part_paid paid ON paid.transaction_id = part.id
  WHERE part.parent_receipt_no IS NOT NULL GROUP BY ALL),
children AS (
  SELECT head.id, bills.total, coalesce(bills.mdr, 0) AS mdr,
    coalesce(bills.other, 0) + coalesce(bills.cash - bills.cash_rows * head.cash_change, 0) AS payment_value
  FROM trx head JOIN bills USING (merchant_id, outlet_id, receipt_no)
  WHERE {IS_SALE.replace("t.", "head.")} AND head.status = '1' AND head.split_flag = 1 AND head.payment_no <= 1
)"""

NET_RAW = f"""
net AS (
  SELECT r.* EXCLUDE (count_transaction) REPLACE (r.sales_value + coalesce(c.total, 0) AS sales_value,
    r.mdr + coalesce(c.mdr, 0) AS mdr)
  FROM raw r JOIN trx t ON t.id = r.id_transaction LEFT JOIN children c ON c.id = r.id_transaction WHERE {OWN_BILL}
)"""


def net_level(level: str) -> str:
    keys = ["merchant_id", "outlet_id", "order_type", *WHEN[level]]
    dims = ", ".join(["merchant_id", "outlet_id", "order_type", *(WHEN_SQL[w] for w in WHEN[level])])
    by = ", ".join(str(i + 1) for i in range(len(keys)))
    on = " AND ".join(f"s.{k} = r.{k}" for k in keys)
    return f"""
sold AS (SELECT {dims}, sum(sales_value) AS sales_value, sum(payment_value) AS payment_value,
    sum(gross_sales) AS gross_sales, count(id_transaction) AS transaction, sum(product) AS product_qty,
    sum(commission) AS commission, sum(mdr) AS mdr, sum(hpp_product) AS hpp_product, sum(hpp_addon) AS hpp_addon
  FROM net WHERE NOT is_refund GROUP BY {by}),
refunded AS (SELECT {dims}, sum(refund) AS refund, sum(commission) AS commission FROM net WHERE is_refund GROUP BY {by}),
lvl AS (
  SELECT {", ".join("s." + k for k in keys)}, s.sales_value, s.payment_value,
    s.sales_value - s.hpp_product - s.hpp_addon - coalesce(r.refund, 0) - s.mdr
      - (s.commission - coalesce(r.commission, 0)) AS gross_value,
    s.gross_sales, s.product_qty, s.transaction, coalesce(r.refund, 0) AS refund,
    s.commission - coalesce(r.commission, 0) AS commission
  FROM sold s LEFT JOIN refunded r ON {on}
  UNION ALL
  SELECT {", ".join("r." + k for k in keys)}, 0, 0, -r.refund + r.commission, 0, 0, 0, r.refund, -r.commission
  FROM refunded r WHERE NOT EXISTS (SELECT 1 FROM sold s WHERE {on})
)"""


def net_sum(level: str) -> str:
    keys = ["merchant_id", "outlet_id", "order_type", *WHEN[level]]
    dims = ", ".join(["merchant_id", "outlet_id", "order_type", *(WHEN_SQL[w] for w in WHEN[level])])
    sums = ", ".join(f"sum({m}) AS {m}" for m in MONEY)
    return f"""
summed AS (SELECT {dims}, {sums}, CAST(sum(transaction) AS BIGINT) AS transaction FROM lvl
  GROUP BY {", ".join(str(i + 1) for i in range(len(keys)))})"""


NET = (TRX, LINES, sales_raw("trx"), CHILDREN, NET_RAW)


# -- tax -------------------------------------------------------------------------------------------------------------

# How often a line counts: first lines with status F have two extensions.
EXTENDED = "CASE WHEN l.l_linestatus = 'F' AND l.line = 1 THEN 2 ELSE 1 END"


def tax_raw(trx: str, name: str = "tax") -> str:
    return f"""
{name} AS (
  SELECT t.id AS id_transaction, any_value(t.merchant_id) AS merchant_id, any_value(t.outlet_id) AS outlet_id,
    any_value(t.sold_at) AS datetime, CAST(any_value(t.sold_at) AS DATE) AS date, any_value(t.receipt_no) AS no_nota,
    any_value(t.total) AS transaction_value,
    any_value(CASE WHEN t.type_detail <> '' AND json_valid(t.type_detail) THEN
      coalesce(nullif(CAST(CASE WHEN json_valid(t.type_detail) THEN json_extract_string(t.type_detail, '$.tax_base_type')
        END AS INTEGER), 0), 1) ELSE 1 END) AS base_type,
    CASE WHEN bool_or(coalesce(l.l_linestatus = 'F', FALSE)) THEN sum(l.price * (l.tax + 0.01) * {EXTENDED})
      ELSE any_value(t.tax_nominal) END AS tax_value,
    coalesce(sum(l.price * l.tax * {EXTENDED}), 0) AS tax_product
  FROM {trx} t LEFT JOIN lines l ON l.transaction_id = t.id
  WHERE {IS_SALE} AND t.status = '1' AND t.refund = 0 AND t.receipt_no IS NOT NULL
  GROUP BY t.id
)"""


def tax_level(level: str, raw: str = "tax", name: str = "lvl") -> str:
    dims = ["merchant_id", "outlet_id", "base_type", *(WHEN_SQL[w] for w in WHEN[level])]
    return f"""
{name} AS (SELECT {", ".join(dims)}, sum(transaction_value) AS transaction_value, sum(tax_value) AS tax_value,
  sum(tax_product) AS tax_product FROM {raw} GROUP BY {", ".join(str(i + 1) for i in range(len(dims)))})"""


def tax_out(level: str) -> str:
    return (f"merchant_id, outlet_id, base_type, {', '.join(WHEN[level])}, "
            + doubles("transaction_value", "tax_value", "tax_product"))


def tax_full(level: str, trx: str = "trx", *more: str) -> str:
    return with_(TRX, *more, LINES, tax_raw(trx), tax_level(level)) + f"SELECT {tax_out(level)} FROM lvl"


def tax_mixed(level: str, current: str) -> str:
    return (with_(TRX, OLD_TRX, LINES, tax_raw("trx"), tax_raw("old_trx", "old_tax"), tax_level(level),
                  tax_level(level, "old_tax", "old_lvl"))
            + f"SELECT {tax_out(level)} FROM lvl WHERE {current}\nUNION ALL\n"
            + f"SELECT {tax_out(level)} FROM old_lvl WHERE NOT ({current})")


def tax_kept_right(level: str, over: str) -> str:
    return (with_(TRX, OLD_TRX, LINES, tax_raw("trx"), tax_raw("old_trx", "old_tax"), tax_level(level),
                  tax_level(level, "old_tax", "old_lvl"))
            + published_or_over(level, tax_out(level), ("merchant_id", "outlet_id", "base_type"), over))


# -- compliment, utilization, reservations ---------------------------------------------------------------------------

COMPLIMENT = with_(TRX, LINES) + f"""
SELECT md5(CAST(t.id AS VARCHAR)) AS no, t.id AS transaction_id, t.merchant_id, t.outlet_id, t.receipt_no AS no_nota,
  t.sold_at AS datetime, CAST(t.sold_at AS DATE) AS date, t.cashier_id, coalesce(t.item_count, 0) AS product_qty,
  t.auth_id, CAST(p.value AS DOUBLE) AS value, t.note
FROM trx t JOIN (SELECT transaction_id, min(price * discount) AS value FROM lines WHERE line = 4 GROUP BY 1) p
  ON p.transaction_id = t.id
WHERE t.status = '1' AND t.purpose = '5' AND t.auth_id IS NOT NULL AND t.cashier_id IS NOT NULL
  AND t.sold_at > TIMESTAMP '1970-01-01 00:00:00'"""

SECONDS = "(hour({0}) * 3600 + minute({0}) * 60 + second({0}))"


def util(res: str = "res") -> str:
    start, end = SECONDS.format("s.start_at"), SECONDS.format("s.end_at")
    return f"""
util AS (
  SELECT s.id AS id_reservation_detail, r.id AS id_reservation, r.merchant_id, r.outlet_id, r.customer_id,
    s.employee_id, s.product_id, s.service_date AS date, strftime(s.start_at, '%H:%M:%S') AS start_time,
    strftime(s.end_at, '%H:%M:%S') AS end_time,
    CAST(floor(abs({end} - {start}) / 60.0 + 0.5) AS INTEGER) AS duration, s.price
  FROM {res} r JOIN svc s ON s.reservation_id = r.id WHERE s.is_parent = 1 AND r.status IN (700, 9)
)"""


UTIL_DAILY = """
SELECT md5(merchant_id || '|' || outlet_id || '|' || employee_id || '|' || date) AS no, merchant_id, outlet_id,
  employee_id, date, CAST(sum(duration) AS BIGINT) AS duration, CAST(sum(price) AS DOUBLE) AS price
FROM util GROUP BY merchant_id, outlet_id, employee_id, date"""


SUMMARY = """
summary AS (
  SELECT md5(CAST(id AS VARCHAR)) AS no, id AS id_reservation, merchant_id, outlet_id, reserved_on AS date,
    CAST(CASE status WHEN 700 THEN 1 WHEN 15 THEN 3 ELSE 2 END AS INTEGER) AS status, type
  FROM res WHERE status NOT IN (9)
)"""
SUMMARY_DAILY = with_(RES, SUMMARY) + """
SELECT md5(merchant_id || '|' || outlet_id || '|' || date || '|' || status || '|' || type) AS no, merchant_id, outlet_id,
  date, status, type, count(status) AS total
FROM summary GROUP BY merchant_id, outlet_id, date, status, type"""

# -- recovery, keys, progress ----------------------------------------------------------------------------------------

RANGE = "sold_at BETWEEN TIMESTAMP '1997-03-01 00:00:00' AND TIMESTAMP '1997-05-31 23:59:59'"
STEER = """id AS id_transaction, merchant_id, outlet_id, coalesce(order_type, 99) AS order_type,
  CAST(sold_at AS DATE) AS date, CAST(hour(sold_at) AS INTEGER) AS hour, CAST(month(sold_at) AS INTEGER) AS month,
  CAST(year(sold_at) AS INTEGER) AS year, updated_at"""
BATCH_ROWS = f"""
batch AS (SELECT {STEER}, status FROM trx t
  WHERE {IS_SALE} AND updated_at BETWEEN {BATCH} AND TIMESTAMP '2001-12-31 00:00:00')"""
LATE_ROWS = f"""
late AS (SELECT {STEER} FROM trx t
  WHERE {IS_SALE} AND status = '1' AND updated_at BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2001-12-31')"""
KEYS = "merchant_id, outlet_id, order_type"
OLD_IDS = f"id_transaction IN (SELECT id FROM trx WHERE updated_at >= {BATCH})"

RUN_LOG = """
log AS (SELECT event_id AS id, date_trunc('hour', ts) AS ts_end, event_type <> 'error' AS done_monthly,
  event_type <> 'signup' AS done_yearly FROM events),
last AS (SELECT * FROM log ORDER BY id DESC LIMIT 1),
runs AS (SELECT count(ts_end) AS runs FROM log WHERE ts_end = (SELECT ts_end FROM last))"""

FEED = """
feed AS (SELECT event_id AS id, user_id, event_type, event_type = 'error' AS deleted,
  CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS "offset" FROM events)"""

DROPPED = f"NOT (updated_at >= {BATCH} AND id % 9 = 4)"
LIVING = f"\nliving AS (SELECT * FROM trx WHERE {DROPPED})"


def windows_in_minutes(minutes: int) -> str:
    return f"""SELECT l.ts_end AS window_start, l.ts_end + to_minutes(r.runs * {minutes}) AS window_end, r.runs,
  l.done_monthly, l.done_yearly, CAST({minutes} AS INTEGER) AS minutes FROM last l, runs r"""


# Runs of 100 days, each from the last change that the one before has seen (less five seconds) on.
BEFORE_RUNS = f"\nearly AS (SELECT * FROM trx WHERE updated_at < {BATCH})"
RUNS = f"""
first_run AS (SELECT min(updated_at) AS a, max(updated_at) AS b, count(*) AS n FROM trx
  WHERE updated_at BETWEEN {BATCH} - INTERVAL 5 SECOND AND {BATCH} + INTERVAL 100 DAY),
second_run AS (SELECT min(t.updated_at) AS a, max(t.updated_at) AS b, count(*) AS n FROM trx t, first_run r
  WHERE t.updated_at BETWEEN r.b - INTERVAL 5 SECOND AND r.b + INTERVAL 100 DAY)"""


def logged(number: int, run: str) -> str:
    return f"""SELECT CAST({number} AS BIGINT) AS id, a AS ts_current, b AS ts_end, n AS num_row,
  date_trunc('month', a) = date_trunc('month', b) AS done_monthly, year(a) = year(b) AS done_yearly FROM {run}"""


ORACLE: dict[str, str] = {
    "changed_transactions": with_(TRX, BATCH_ROWS) + "SELECT *, status = '1' AS is_active FROM batch",
    "scoped_transactions": with_(TRX) + f"""SELECT {STEER} FROM trx t WHERE {IS_SALE} AND {RANGE}
      AND (merchant_id IN (1, 3) OR (merchant_id = 2 AND outlet_id = 7))""",
    "product_summary": with_(LINES) + f"""SELECT transaction_id, {doubles("product", "hpp_product", "gross_sales")} FROM (
      SELECT transaction_id, sum(quantity) AS product, sum(quantity * unit_cost) AS hpp_product,
        sum(price) AS gross_sales FROM lines GROUP BY 1)""",
    "addon_costs": with_(LINES) + """SELECT transaction_id,
      CAST(sum(p_size * unit_cost * CAST(0.01 AS DECIMAL(3,2))) AS DOUBLE) AS hpp_addon
      FROM lines WHERE p_type = 'PROMO' GROUP BY 1""",
    "commission_summary": with_(TRX, LINES) + f"""SELECT t.id AS transaction_id,
      CAST(sum(l.price * l.discount) AS DOUBLE) AS commission FROM trx t JOIN lines l ON l.transaction_id = t.id
      WHERE {IS_SALE} AND t.status = '1' AND l.l_returnflag = 'A' AND {OWN_BILL} AND t.paid_at IS NOT NULL GROUP BY 1""",
    "payment_summary": with_(TRX, LINES) + """SELECT t.id AS transaction_id, CAST(sum(p.mdr) AS DOUBLE) AS mdr,
      CAST(sum(CASE WHEN p.method = 1 THEN p.value - t.cash_change ELSE p.value END) AS DOUBLE) AS payment_value
      FROM trx t JOIN payment p ON p.transaction_id = t.id GROUP BY 1""",

    "sales_raw": with_(TRX, LINES, sales_raw("trx")) + f"SELECT {SALES_RAW_OUT} FROM raw",
    "sales_hourly": sales_full("hourly"), "sales_daily": sales_full("daily"),
    "sales_monthly": sales_full("monthly"), "sales_yearly": sales_full("yearly"),
    "tax_raw": with_(TRX, LINES, tax_raw("trx")) + "SELECT * REPLACE (" + doubles(
        "transaction_value", "tax_value", "tax_product") + ") FROM tax",
    "tax_daily": tax_full("daily"), "tax_monthly": tax_full("monthly"), "tax_yearly": tax_full("yearly"),
    "compliment_raw": COMPLIMENT,
    "utilization_raw": with_(RES, util()) + "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM util",
    "utilization_daily": with_(RES, util()) + UTIL_DAILY,
    "reservation_summary_raw": with_(RES, SUMMARY) + "SELECT * FROM summary",
    "reservation_summary_daily": SUMMARY_DAILY,

    "split_bill_children": with_(TRX, LINES, CHILDREN) + "SELECT id AS id_transaction, " + doubles(
        "total", "mdr", "payment_value") + " FROM children",
    "sales_net_raw": with_(*NET) + "SELECT " + SALES_RAW_OUT.replace("count_transaction, ", "") + " FROM net",
    "sales_net_hourly": with_(*NET, net_level("hourly")) + f"SELECT {sales_out('hourly')} FROM lvl",
    "sales_net_daily": with_(*NET, net_level("daily")) + f"SELECT {sales_out('daily')} FROM lvl",
    "sales_net_monthly": with_(*NET, net_level("daily"), net_sum("monthly")) + f"SELECT {sales_out('monthly')} FROM summed",
    "sales_net_yearly": with_(*NET, net_level("daily"), net_sum("yearly")) + f"SELECT {sales_out('yearly')} FROM summed",
    "refund_only_keys_daily": with_(*NET) + f"""SELECT {KEYS}, date FROM net GROUP BY ALL HAVING bool_and(is_refund)""",
    "refund_only_keys_hourly": with_(*NET) + f"""SELECT {KEYS}, date, {WHEN_SQL["hour"]} FROM net GROUP BY ALL
      HAVING bool_and(is_refund)""",
    "grouped_measures": with_(TRX, LINES, sales_raw("trx")) + """SELECT merchant_id, order_type,
      count(id_transaction) AS transactions, CAST(sum(sales_value) AS DOUBLE) AS sales_value,
      CAST(max(refund) AS DOUBLE) AS largest_refund FROM raw GROUP BY 1, 2""",

    "batch_hourly_keys": with_(TRX, BATCH_ROWS) + f"""SELECT {KEYS}, date, hour, bool_or(status = '1') AS rebuild
      FROM batch GROUP BY ALL""",
    "batch_daily_keys": with_(TRX, BATCH_ROWS) + f"""SELECT {KEYS}, date, bool_or(status = '1') AS rebuild
      FROM batch GROUP BY ALL""",
    "late_month_keys": with_(TRX, LATE_ROWS) + f"SELECT DISTINCT {KEYS}, year, month FROM late WHERE date < {BATCH}",
    "late_year_keys": with_(TRX, LATE_ROWS) + f"SELECT DISTINCT {KEYS}, year FROM late WHERE year < 2001",
    "previous_daily_keys": with_(TRX, OLD_TRX, LINES, sales_raw("old_trx", "old_raw")) + f"""
      SELECT DISTINCT {KEYS}, date FROM old_raw WHERE {OLD_IDS}""",
    "previous_hourly_keys": with_(TRX, OLD_TRX, LINES, sales_raw("old_trx", "old_raw")) + f"""
      SELECT DISTINCT {KEYS}, date, {WHEN_SQL["hour"]} FROM old_raw WHERE {OLD_IDS}""",
    "previous_utilization_keys": with_(RES, OLD_RES, util("old_res")) + f"""
      SELECT DISTINCT merchant_id, outlet_id, employee_id, date FROM util
      WHERE id_reservation IN (SELECT id FROM res WHERE updated_at >= {EVENT_BATCH})""",
    "affected_daily_keys": with_(TRX, OLD_TRX, LINES, sales_raw("trx"), sales_raw("old_trx", "old_raw")) + f"""
      SELECT {KEYS}, date FROM old_raw WHERE {OLD_IDS} UNION SELECT {KEYS}, date FROM raw WHERE {OLD_IDS}""",

    "sales_raw_after_batch": with_(TRX, LINES, sales_raw("trx")) + f"SELECT {SALES_RAW_OUT} FROM raw",
    "sales_hourly_after_batch": sales_full("hourly"),
    "sales_daily_after_batch": sales_full("daily"),
    "sales_monthly_after_batch": sales_kept_right("monthly", "year < 2001"),
    "sales_yearly_after_batch": sales_kept_right("yearly", "year < 2001"),
    "sales_net_daily_after_batch": with_(*NET, net_level("daily")) + f"SELECT {sales_out('daily')} FROM lvl",
    "tax_daily_after_batch": tax_full("daily"),
    "tax_monthly_after_batch": tax_kept_right("monthly", "year < 2001"),
    "compliment_raw_after_batch": COMPLIMENT,
    "utilization_daily_after_batch": with_(RES, util()) + UTIL_DAILY,
    "reservation_summary_daily_after_batch": SUMMARY_DAILY,
    "upserted_daily": with_(TRX, OLD_TRX, LINES, sales_raw("trx"), sales_raw("old_trx", "old_raw"),
                            sales_level("daily", name="lvl"), sales_level("daily", "old_raw", name="old_lvl")) + f"""
      SELECT {sales_out("daily")} FROM lvl UNION ALL SELECT {sales_out("daily")} FROM old_lvl o
      WHERE NOT EXISTS (SELECT 1 FROM lvl n WHERE n.merchant_id = o.merchant_id AND n.outlet_id = o.outlet_id
        AND n.order_type = o.order_type AND n.date = o.date)""",

    "sales_month_closed": sales_mixed("monthly", "year = 2001 AND month = 2"),
    "sales_year_closed": sales_mixed("yearly", "year = 2001"),
    "tax_month_closed": tax_mixed("monthly", "year = 2001 AND month = 2"),
    "tax_year_closed": tax_mixed("yearly", "year = 2001"),
    "sales_hourly_recovered": sales_full("hourly"), "sales_daily_recovered": sales_full("daily"),
    "sales_monthly_recovered": sales_full("monthly"), "sales_yearly_recovered": sales_full("yearly"),
    "tax_daily_recovered": tax_full("daily"), "tax_yearly_recovered": tax_full("yearly"),
    "sales_daily_cleared": sales_full(
        "daily", "kept", f"\nkept AS (SELECT * FROM trx WHERE NOT ({RANGE} AND merchant_id = 2 AND outlet_id = 7))"),
    "sales_monthly_cleared": sales_full(
        "monthly", "kept", f"\nkept AS (SELECT * FROM trx WHERE NOT ({RANGE} AND merchant_id = 2))"),
    "utilization_range_deleted": with_(RES, util()) + UTIL_DAILY.replace(
        "FROM util", "FROM util WHERE NOT (date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' AND merchant_id = 2)"),
    "utilization_recovered": with_(RES, util()) + UTIL_DAILY,
    "sales_yearly_recovered_after_moves": sales_full("yearly"), "tax_monthly_recovered_after_moves": tax_full("monthly"),
    "sales_net_daily_recovered_after_moves": with_(*NET, net_level("daily")) + f"SELECT {sales_out('daily')} FROM lvl",
    "utilization_daily_recovered_after_moves": with_(RES, util()) + UTIL_DAILY,
    "reservation_summary_daily_recovered_after_moves": SUMMARY_DAILY,
    "sales_daily_after_late_ids": sales_full("daily"),
    "tax_daily_sequence_resumed": tax_full("daily"),
    "cdc_resumed": with_(FEED) + """SELECT partition, "offset", CAST(1 AS BIGINT) AS times FROM feed""",
    "transactions_in_slices": with_(TRX) + "SELECT id, id * id * id AS key, CAST(1 AS BIGINT) AS times FROM trx",
    "run_log_of_a_sequence": with_(TRX, BEFORE_RUNS, LINES, tax_raw("early"), RUNS) + f"""
      SELECT CAST(1 AS BIGINT) AS id, {BATCH} - INTERVAL 1 MINUTE AS ts_current, {BATCH} AS ts_end, count(*) AS num_row,
        true AS done_monthly, true AS done_yearly FROM tax
      UNION ALL {logged(2, "first_run")} UNION ALL {logged(3, "second_run")}""",
    "covered_months": with_(TRX) + """SELECT outlet_id, CAST(m AS DATE) AS month_start, CAST(year(m) AS INTEGER) AS year,
      CAST(month(m) AS INTEGER) AS month
      FROM (SELECT outlet_id, unnest(generate_series(date_trunc('month', min(sold_at)), date_trunc('month', max(sold_at)),
        INTERVAL 1 MONTH)) AS m FROM trx GROUP BY outlet_id)""",
    "account_lookup": """WITH account AS (SELECT c_name AS email, c_custkey AS id,
        CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey - c_custkey % 3 END AS parent_id FROM customer)
      SELECT email, CASE parent_id WHEN 0 THEN id ELSE parent_id END AS merchant_id FROM account""",

    "next_sequence_window": with_(RUN_LOG) + "\nUNION ALL\n".join(windows_in_minutes(m) for m in (1, 5, 45, 120)),
    "next_period_window": """WITH last AS (SELECT max(date_trunc('hour', ts)) AS ts_end FROM events)
      SELECT ts_end AS window_start, least(ts_end + INTERVAL 600 MINUTE, TIMESTAMP '2024-01-31 01:00:00') AS window_end
      FROM last UNION ALL
      SELECT ts_end, least(ts_end + INTERVAL 600 MINUTE, TIMESTAMP '2024-03-01 00:00:00') FROM last""",
    "overlapping_windows": """SELECT event_id AS id, date_trunc('hour', ts) + INTERVAL 5 MINUTE AS window_end,
      date_trunc('hour', ts) - CASE WHEN date_trunc('hour', ts) + INTERVAL 5 MINUTE < TIMESTAMP '2024-01-16 12:03:00'
        THEN INTERVAL 5 SECOND ELSE INTERVAL 300 SECOND END AS window_start FROM events""",
    "batch_watermark": with_(TRX, BATCH_ROWS) + """SELECT min(updated_at) AS ts_current, max(updated_at) AS ts_end,
      count(*) AS num_row FROM batch""",
    "empty_batch_watermark": with_(TRX) + """SELECT TIMESTAMP '2023-01-01' AS ts_current, TIMESTAMP '2023-01-02' AS ts_end,
      count(*) AS num_row FROM trx WHERE updated_at BETWEEN TIMESTAMP '2023-01-01' AND TIMESTAMP '2023-01-02'
      UNION ALL SELECT TIMESTAMP '2023-01-01', TIMESTAMP '2023-01-01', count(*)
      FROM trx WHERE updated_at BETWEEN TIMESTAMP '2023-01-01' AND TIMESTAMP '2023-01-02'""",
    "period_closing": with_(TRX) + """
      SELECT id, b AS ts_current, e AS ts_end,
        CASE WHEN id % 2 <> 0 THEN CAST(date_trunc('month', b) - INTERVAL 1 MONTH AS DATE) END AS close_month,
        CASE WHEN id % 3 <> 0 THEN CAST(year(b) - 1 AS INTEGER) END AS close_year,
        NOT (year(e) > year(b) OR (year(e) = year(b) AND month(e) > month(b))) AS done_monthly,
        NOT (year(e) > year(b)) AS done_yearly
      FROM (SELECT id, sold_at AS b, updated_at + to_days(CAST(id % 40 AS INTEGER)) AS e FROM trx)""",
    "calendar_functions": with_(TRX) + """SELECT id,
      strftime(sold_at, '%Y-%m-%d ') || hour(sold_at) || ':' || minute(sold_at) || ':' || second(sold_at) || ' +07:00'
        AS stamp,
      CAST(year(sold_at) AS INTEGER) AS year, CAST(month(sold_at) AS INTEGER) AS month, CAST(sold_at AS DATE) AS date,
      CAST(hour(sold_at) AS INTEGER) AS hour, CAST(date_trunc('month', sold_at) AS DATE) AS first_day,
      last_day(sold_at) AS last_day, CAST(date_trunc('month', sold_at) - INTERVAL 1 MONTH AS DATE) AS month_before,
      sold_at - INTERVAL 7 HOUR AS utc, sold_at + INTERVAL 7 HOUR AS local FROM trx""",

    "cdc_decode": with_(FEED) + 'SELECT partition, "offset", id, deleted FROM feed WHERE id % 50 <> 49',
    "cdc_decode_with_keys": with_(FEED) + """SELECT partition, "offset", CAST(id AS VARCHAR) AS id,
      CAST(user_id AS VARCHAR) AS user_id, event_type, deleted FROM feed WHERE id % 50 <> 49""",
    "cdc_latest": with_(FEED) + """SELECT user_id AS id, arg_max(deleted, id) AS deleted FROM feed WHERE id % 50 <> 49
      GROUP BY 1""",
    "cdc_offsets": with_(FEED) + 'SELECT partition, max("offset") AS "offset" FROM feed GROUP BY 1',

    "sales_daily_published": with_(TRX, LINES, sales_raw("trx"), sales_level("daily", name="lvl")) + """
      SELECT merchant_id AS m_user_id_user, outlet_id AS m_cabang_id_cabang, """ + ", ".join(
        f"{c} AS mart_sales_dashboard_daily_{c}" for c in ("order_type", "date", "transaction")) + ", " + ", ".join(
        f"CAST({c} AS DOUBLE) AS mart_sales_dashboard_daily_{c}" for c in MONEY) + " FROM lvl",
    "reservation_summary_stored": SUMMARY_DAILY,
    "tax_daily_streamed": tax_full("daily", "living", LIVING),
    "sales_hourly_streamed": sales_full("hourly", "living", LIVING),
}

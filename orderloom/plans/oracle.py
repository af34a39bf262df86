"""SQL texts shared by the oracle queries (DuckDB dialect), one CTE per stage."""

from __future__ import annotations

STRIP = r"regexp_replace(regexp_replace({0}, '^\s+', ''), '\s+$', '')"

_RAW = """
SELECT concat(l_orderkey, '-', l_linenumber) AS event_id,
       l_shipdate AS event_time,
       concat('ORD-', l_orderkey) AS order_id,
       concat('CUST-', o_custkey) AS customer_customer_id,
       CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN concat(' ', lower(n_name)) ELSE n_name END AS customer_country,
       CASE l_linestatus WHEN 'O' THEN ' Mobile ' ELSE 'DESKTOP' END AS order_device,
       CASE WHEN (l_orderkey * 7 + l_partkey) % 33 = 0 THEN NULL ELSE o_orderpriority END AS order_channel,
       c_mktsegment AS order_main_category,
       CAST(l_quantity AS BIGINT) AS order_n_items,
       l_extendedprice AS order_basket_value,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DOUBLE) AS order_shipping_fee,
       CASE WHEN (l_orderkey + l_suppkey) % 50 = 0 THEN NULL ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DOUBLE) END AS order_discount,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) + CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) - CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
            + CASE WHEN (l_orderkey + l_partkey) % 29 = 0 THEN CAST(1 AS DECIMAL(12,2)) ELSE CAST(0 AS DECIMAL(12,2)) END AS DOUBLE) AS order_order_total,
       l_returnflag = 'R' AS order_is_returned,
       l_partkey AS tie1, l_suppkey AS tie2
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

_NORM = f"""
SELECT {STRIP.format('event_id')} AS event_id, event_time, {STRIP.format('order_id')} AS order_id,
       {STRIP.format('customer_customer_id')} AS customer_customer_id,
       upper({STRIP.format('customer_country')}) AS customer_country,
       lower({STRIP.format('order_device')}) AS order_device,
       lower({STRIP.format('order_channel')}) AS order_channel,
       lower({STRIP.format('order_main_category')}) AS order_main_category,
       order_n_items, order_basket_value, order_shipping_fee, order_discount, order_order_total,
       order_is_returned, tie1, tie2
FROM raw"""



def quantile(x: str, p: float) -> str:
    """Linear interpolation between order statistics, from the nearer end (as an aggregate)."""
    values = f"list_sort(list(CAST({x} AS DOUBLE)) FILTER (WHERE {x} IS NOT NULL))"
    at = f"((count({x}) - 1) * {p}e0)"
    low = f"{values}[CAST(floor({at}) AS BIGINT) + 1]"
    high = f"{values}[CAST(ceil({at}) AS BIGINT) + 1]"
    part = f"({at} - floor({at}))"
    return (
        f"CASE WHEN {part} >= 0.5e0 THEN {high} - ({high} - {low}) * (1 - {part}) "
        f"ELSE {low} + ({high} - {low}) * {part} END"
    )


def median(x: str) -> str:
    """Mean of the middle two values (as an aggregate)."""
    values = f"list_sort(list(CAST({x} AS DOUBLE)) FILTER (WHERE {x} IS NOT NULL))"
    return f"({values}[(count({x}) + 1) // 2] + {values}[(count({x}) + 2) // 2]) / 2"


_RANKED = "row_number() OVER (PARTITION BY event_id ORDER BY event_time DESC NULLS LAST, tie1, tie2) = 1"

_MODE = "(SELECT {0} FROM dedup WHERE {0} IS NOT NULL GROUP BY {0} ORDER BY count(*) DESC, {0} LIMIT 1)"

_CLEAN = f"""
SELECT event_id, event_time, order_id, customer_customer_id,
       coalesce(customer_country, 'UN') AS customer_country,
       coalesce(order_device, {_MODE.format('order_device')}) AS order_device,
       coalesce(order_channel, {_MODE.format('order_channel')}) AS order_channel,
       coalesce(order_main_category, {_MODE.format('order_main_category')}) AS order_main_category,
       coalesce(order_n_items, CAST(round_even((SELECT {median('order_n_items')} FROM dedup), 0) AS BIGINT)) AS order_n_items,
       coalesce(order_basket_value, (SELECT {median('order_basket_value')} FROM dedup)) AS order_basket_value,
       coalesce(order_shipping_fee, 0e0) AS order_shipping_fee,
       coalesce(order_discount, 0e0) AS order_discount,
       order_order_total, order_is_returned,
       CAST(year(event_time) AS INTEGER) AS event_year, CAST(month(event_time) AS INTEGER) AS event_month,
       CAST(day(event_time) AS INTEGER) AS event_day, CAST(hour(event_time) AS INTEGER) AS event_hour,
       CASE WHEN coalesce(order_n_items, 1) > 0 THEN order_basket_value / order_n_items END AS price_average_per_item
FROM dedup"""

_ISO = "strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ')"
_ID = "concat(l_orderkey, '-', l_linenumber)"
_HEAD = f"""concat('"event_id": "', {_ID}, '", ',
  CASE WHEN l_partkey % 11 = 0 THEN concat('"event_time": ', epoch_ms(l_shipdate))
       WHEN l_partkey % 13 = 0 THEN '"event_time": "zzz"'
       WHEN l_partkey % 17 = 0 THEN '"event_time": null'
       ELSE concat('"event_time": "', {_ISO}, '"') END,
  ', "customer_customer_id": "CUST-', o_custkey, '"')"""
_PRICE = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)"
_REST = f"""concat('"customer_country": "', n_name, '", "order_device": "',
  CASE l_linestatus WHEN 'O' THEN ' Mobile ' ELSE 'DESKTOP' END,
  '", "order_main_category": "', c_mktsegment, '", "order_n_items": ',
  CASE WHEN l_partkey % 19 = 0 THEN '"many"' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END,
  ', "order_basket_value": ', {_PRICE}, ', "order_order_total": ', {_PRICE}, ', "order_is_returned": ',
  CASE WHEN l_returnflag = 'R' THEN 'true' ELSE 'false' END)"""

_MESSAGES = f"""
SELECT CASE WHEN l_partkey % 97 = 0 THEN '  '
            WHEN l_partkey % 89 = 0 THEN concat('{{"event_id": "', {_ID})
            WHEN l_partkey % 83 = 0 THEN concat('[', l_orderkey, ']')
            WHEN l_partkey % 79 = 0 THEN concat('{{"event_id": ', l_orderkey, '}}')
            WHEN l_partkey % 73 = 0 THEN concat('{{', {_HEAD}, '}}')
            WHEN l_partkey % 71 = 0 THEN concat('{{', {_HEAD}, ', "order_id": null}}')
            ELSE concat(' {{', {_HEAD}, ', "order_id": "ORD-', l_orderkey, '", ', {_REST}, '}}') END AS value,
       o_orderdate AS broker_time,
       concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS position
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

_INSPECTED = f"""
SELECT *, CASE WHEN length(line) > 0 AND json_valid(line) THEN line END AS doc FROM (
  SELECT *, {STRIP.format('value')} AS line FROM messages)"""


def _absent(k: str) -> str:
    return f"CASE WHEN json_extract_string(doc, '$.{k}') IS NULL THEN '{k}' END"


_REASONED = f"""
SELECT *, CASE WHEN length(line) = 0 THEN 'blank line' WHEN doc IS NULL THEN 'invalid JSON'
               WHEN NOT is_object THEN 'not an object'
               WHEN missing <> '' THEN concat('missing ', missing) END AS reason FROM (
  SELECT *, coalesce(json_type(doc) = 'OBJECT', false) AS is_object,
    CASE WHEN json_type(doc) = 'OBJECT' THEN
      concat_ws(',', {_absent('customer_customer_id')}, {_absent('event_id')}, {_absent('order_id')}) END AS missing
  FROM inspected)"""


def _x(name: str, dtype: str = "VARCHAR") -> str:
    return f"TRY_CAST(json_extract_string(doc, '$.{name}') AS {dtype})"


_NORMALIZED = f"""
SELECT *, CAST(year(event_time) AS INTEGER) AS event_year, CAST(month(event_time) AS INTEGER) AS event_month,
       CAST(day(event_time) AS INTEGER) AS event_day, CAST(hour(event_time) AS INTEGER) AS event_hour,
       order_order_total / greatest(order_n_items, 1) AS price_average_per_item FROM (
  SELECT {STRIP.format(_x('event_id'))} AS event_id,
       coalesce(TRY_CAST(json_extract_string(doc, '$.event_time') AS TIMESTAMP),
                make_timestamp(TRY_CAST(json_extract_string(doc, '$.event_time') AS BIGINT) * 1000), broker_time) AS event_time,
       {STRIP.format(_x('order_id'))} AS order_id, {STRIP.format(_x('customer_customer_id'))} AS customer_customer_id,
       coalesce(upper({STRIP.format(_x('customer_country'))}), 'unknown') AS customer_country,
       coalesce(lower({STRIP.format(_x('order_device'))}), 'unknown') AS order_device,
       coalesce(lower({STRIP.format(_x('order_channel'))}), 'unknown') AS order_channel,
       coalesce(lower({STRIP.format(_x('order_main_category'))}), 'unknown') AS order_main_category,
       coalesce(CAST({_x('order_n_items', 'DOUBLE')} AS BIGINT), 0) AS order_n_items,
       coalesce({_x('order_basket_value', 'DOUBLE')}, 0e0) AS order_basket_value,
       coalesce({_x('order_shipping_fee', 'DOUBLE')}, 0e0) AS order_shipping_fee,
       coalesce({_x('order_discount', 'DOUBLE')}, 0e0) AS order_discount,
       coalesce({_x('order_order_total', 'DOUBLE')}, 0e0) AS order_order_total,
       coalesce({_x('order_is_returned', 'BOOLEAN')}, false) AS order_is_returned,
       position, value, broker_time
  FROM reasoned WHERE reason IS NULL)"""

_RUNS = """
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp", event_type AS project_name,
       concat('run-', user_id, '-', event_type) AS run_id,
       CAST(CAST(value AS DECIMAL(18,6)) AS DOUBLE) AS duration,
       CAST(CAST(value AS DECIMAL(18,6)) * 0.000006::DECIMAL(9,6) AS DOUBLE) AS emissions,
       CAST(CAST(value AS DECIMAL(18,6)) * 0.000023::DECIMAL(9,6) AS DOUBLE) AS energy_consumed,
       event_id AS line_no
FROM events"""

# Through text both ways, because direct casts between double and a wide decimal
# are not correctly rounded.
EXACT = "CAST(CAST(sum(CAST(CAST({0} AS VARCHAR) AS DECIMAL(38,20))) AS VARCHAR) AS DOUBLE)"

_FIRST = "QUALIFY row_number() OVER (PARTITION BY {0} ORDER BY event_time DESC NULLS LAST, event_id) = 1"

_ORDER_COLUMNS = (
    "order_id, customer_customer_id, order_device, order_channel, order_main_category, order_n_items, "
    "order_basket_value, order_shipping_fee, order_discount, order_order_total, order_is_returned, price_average_per_item"
)
_EVENT_COLUMNS = "event_id, event_time, event_year, event_month, event_day, event_hour, order_id, customer_customer_id"

# Rule score on the benchmark's own category, device and channel values.
RULE_SCORE = (
    "0.18e0 + CASE WHEN order_main_category = 'furniture' THEN 0.15e0 ELSE 0e0 END"
    " + CASE WHEN order_device = 'mobile' THEN 0.03e0 ELSE 0e0 END"
    " + CASE WHEN order_order_total < 30 THEN 0.08e0 ELSE 0e0 END"
    " - CASE WHEN order_channel = '5-low' THEN 0.02e0 ELSE 0e0 END"
)

HASH = "CAST(concat('0x', substr(md5(concat(event_id, ':42')), 1, 13)) AS BIGINT) / 4503599627370496e0"

CTES = {
    "raw": ((), _RAW),
    "norm": (("raw",), _NORM),
    "dedup": (("norm",), f"SELECT * FROM norm QUALIFY {_RANKED}"),
    "clean": (("dedup",), _CLEAN),
    "customers": (("clean",), f"SELECT customer_customer_id, customer_country FROM clean {_FIRST.format('customer_customer_id')}"),
    "star_o": (("clean",), f"SELECT {_ORDER_COLUMNS} FROM clean {_FIRST.format('order_id')}"),
    "star_e": (("clean",), f"SELECT {_EVENT_COLUMNS} FROM clean"),
    # The two halves of the log by device, as a stored set and an incoming batch.
    "half": (("norm",), f"SELECT * FROM norm QUALIFY row_number() OVER (PARTITION BY event_id, order_device ORDER BY event_time DESC NULLS LAST, tie1, tie2) = 1"),
    "stored": (("half",), "SELECT * FROM half WHERE order_device = 'desktop'"),
    "incoming": (("half",), "SELECT * FROM half WHERE order_device = 'mobile'"),
    "scored": (
        ("clean",),
        f"""SELECT event_id, order_id, customer_customer_id, CAST(order_is_returned AS INTEGER) AS label,
            {RULE_SCORE} AS score, order_basket_value / (order_basket_value + 50000e0) AS smooth FROM clean""",
    ),
    "messages": ((), _MESSAGES),
    "inspected": (("messages",), _INSPECTED),
    "reasoned": (("inspected",), _REASONED),
    "normalized": (("reasoned",), _NORMALIZED),
    "runs": ((), _RUNS),
    "runs_once": (("runs",), "SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY line_no DESC) = 1"),
    "eco": (
        ("runs_once",),
        f"""SELECT *, emissions * 1000e0 AS emissions_g, duration / 60e0 AS duration_min FROM (
            SELECT project_name, {EXACT.format('emissions')} AS emissions, {EXACT.format('energy_consumed')} AS energy_consumed,
                   {EXACT.format('duration')} AS duration FROM runs_once GROUP BY project_name)""",
    ),
    "train": (("clean",), f"SELECT * FROM clean WHERE {HASH} >= 0.2e0"),
    "strata": (
        ("clean",),
        f"""SELECT *, row_number() OVER (PARTITION BY order_is_returned ORDER BY {HASH})
              <= round_even(count(*) OVER (PARTITION BY order_is_returned) * 0.2e0, 0) AS is_test FROM clean""",
    ),
    "train_strata": (("strata",), "SELECT * EXCLUDE (is_test) FROM strata WHERE NOT is_test"),
    "test_strata": (("strata",), "SELECT * EXCLUDE (is_test) FROM strata WHERE is_test"),
}


def sql(stages: str, body: str) -> str:
    """``body`` preceded by the named stages and whatever they build on."""
    wanted: list[str] = []

    def visit(name: str) -> None:
        for parent in CTES[name][0]:
            visit(parent)
        if name not in wanted:
            wanted.append(name)

    for stage in stages.split():
        visit(stage)
    # A stage that several others read is computed once.
    heads = [f"{name} AS MATERIALIZED ({CTES[name][1]})" for name in wanted]
    return f"WITH {', '.join(heads)}\n{body}" if heads else body


def unpivoted(columns, body: str) -> str:
    """UNION ALL of ``body`` with ``{c}`` replaced by each column."""
    return "\nUNION ALL\n".join(body.replace("{c}", c) for c in columns)

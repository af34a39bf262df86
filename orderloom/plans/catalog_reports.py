"""Queries: profiling reports and business questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.operators import eco, profile, ranks, relational
from orderloom.plans import frames, oracle
from orderloom.plans.registry import query
from orderloom.sources import tables

DIGITS = 6


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Round averages and deviations, whose last digits depend on summation order."""
    return df.withColumns({c: F.round(F.col(c), DIGITS) for c in columns})


_NUMERIC = list(schemas.NUMERIC_COLUMNS)
_EVENT_COLUMNS = [f.name for f in schemas.EVENT.fields]
_ALL = ", ".join(_EVENT_COLUMNS)

# ---- counts ----------------------------------------------------------------

_COUNTED = tables.TABLES


@query(
    "table_counts",
    "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNTED),
)
def table_counts(spark, sf):
    return profile.table_counts({t: tables.table(spark, sf, t) for t in _COUNTED})


_PROFILED = {
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
               "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "part": {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int",
             "p_retailprice": "double"},
    "lineitem": {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
                 "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
                 "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"},
    "events": {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
               "value": "double", "props": "string"},
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "benchmark": {"item_id": "bigint", "text": "string"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"},
}


@query(
    "table_profile",
    "\nUNION ALL\n".join(
        f"""SELECT '{t}' AS table_name, CAST({i} AS INTEGER) AS position, '{c}' AS "column", '{d}' AS data_type,
                   count({c}) AS non_null, count(*) AS row_count FROM {t}"""
        for t, columns in _PROFILED.items()
        for i, (c, d) in enumerate(columns.items())
    ),
)
def table_profile(spark, sf):
    return profile.table_profile({t: tables.table(spark, sf, t).select(*c) for t, c in _PROFILED.items()})


@query(
    "na_report",
    oracle.sql(
        "dedup",
        oracle.unpivoted(
            _EVENT_COLUMNS,
            """SELECT '{c}' AS "column", count(*) - count({c}) AS na_count,
                      CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100e0 AS na_pct FROM dedup""",
        ),
    ),
)
def na_report(spark, sf):
    return profile.na_report(frames.dedup_table(spark, sf).select(*_EVENT_COLUMNS))


@query(
    "na_any",
    oracle.sql(
        "dedup",
        """SELECT concat_ws(',', CASE WHEN count(customer_country) < count(*) THEN 'customer_country' END,
                    CASE WHEN count(order_channel) < count(*) THEN 'order_channel' END,
                    CASE WHEN count(order_discount) < count(*) THEN 'order_discount' END) AS columns_with_na,
                  count(CASE WHEN customer_country IS NULL OR order_channel IS NULL OR order_discount IS NULL THEN 1 END) AS rows_with_na
           FROM dedup""",
    ),
)
def na_any(spark, sf):
    return profile.na_any(frames.dedup_table(spark, sf))


_DISTINCT = ["event_id", "order_id", "customer_customer_id", *schemas.CATEGORY_COLUMNS]


@query(
    "distinct_profile",
    oracle.sql(
        "norm",
        oracle.unpivoted(
            _DISTINCT,
            """SELECT '{c}' AS "column", count(DISTINCT {c}) + CAST(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_distinct_with_null,
                      count(DISTINCT {c}) AS n_distinct, count(*) - count({c}) AS n_null FROM norm""",
        ),
    ),
)
def distinct_profile(spark, sf):
    return profile.distinct_profile(frames.norm(spark, sf), _DISTINCT)


def _value_counts(key: str, column: str, top: int | None) -> None:
    limit = f" ORDER BY n DESC, value ASC NULLS LAST LIMIT {top}" if top else ""

    @query(key, oracle.sql("dedup", f"SELECT {column} AS value, count(*) AS n FROM dedup GROUP BY {column}{limit}"))
    def run(spark, sf):
        return profile.value_counts(frames.dedup_table(spark, sf), column, top)


# The exploration shows the 20 most frequent values.
_value_counts("value_counts_channel", "order_channel", 20)
_value_counts("value_counts_country", "customer_country", 20)
_value_counts("value_counts_device", "order_device", 20)
_value_counts("value_counts_category", "order_main_category", 20)
_value_counts("n_items_freq", "order_n_items", None)


@query("hour_counts", "SELECT CAST(hour(ts) AS INTEGER) AS value, count(*) AS n FROM events GROUP BY 1")
def hour_counts(spark, sf):
    rows = tables.table(spark, sf, "events").select(F.hour("ts").cast("int").alias("event_hour"))
    return profile.value_counts(rows, "event_hour", by_value=True)


@query(
    "mode_cols",
    oracle.sql(
        "dedup",
        oracle.unpivoted(
            schemas.CATEGORY_COLUMNS,
            """SELECT * FROM (SELECT '{c}' AS "column", {c} AS top, count(*) AS freq FROM dedup WHERE {c} IS NOT NULL
               GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)""",
        ),
    ),
)
def mode_cols(spark, sf):
    return ranks.modes(frames.dedup_table(spark, sf), schemas.CATEGORY_COLUMNS)


_MEDIANS = ["order_n_items", *schemas.MONEY_COLUMNS]


@query(
    "median_cols",
    oracle.sql("dedup", f"SELECT {', '.join(f'{oracle.median(c)} AS {c}' for c in _MEDIANS)} FROM dedup"),
)
def median_cols(spark, sf):
    return ranks.medians_row(frames.dedup_table(spark, sf), _MEDIANS)


@query(
    "describe_numeric",
    oracle.sql(
        "clean",
        oracle.unpivoted(
            _NUMERIC,
            f"""SELECT '{{c}}' AS "column", count({{c}}) AS n_values, round(avg({{c}}), {DIGITS}) AS mean,
                   round(stddev_samp({{c}}), {DIGITS}) AS std, CAST(min({{c}}) AS DOUBLE) AS min_value,
                   CAST(max({{c}}) AS DOUBLE) AS max_value, {oracle.quantile('{c}', 0.25)} AS q25,
                   {oracle.quantile('{c}', 0.5)} AS q50, {oracle.quantile('{c}', 0.75)} AS q75 FROM clean""",
        ),
    ),
)
def describe_numeric(spark, sf):
    return rounded(profile.describe_numeric(frames.clean_table(spark, sf), _NUMERIC), "mean", "std")


_TEXT = [*schemas.ID_COLUMNS, *schemas.CATEGORY_COLUMNS, "order_is_returned"]


@query(
    "describe_categorical",
    oracle.sql(
        "clean",
        oracle.unpivoted(
            _TEXT,
            """SELECT * FROM (SELECT '{c}' AS "column", CAST(sum(count(*)) OVER () AS BIGINT) AS n_values,
                 count(*) OVER () AS n_unique, CAST({c} AS VARCHAR) AS top, count(*) AS freq
               FROM clean WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1)""",
        ),
    ),
)
def describe_categorical(spark, sf):
    return profile.describe_categorical(frames.clean_table(spark, sf), _TEXT)


@query(
    "iqr_bounds",
    oracle.sql(
        "clean",
        oracle.unpivoted(
            _NUMERIC,
            f"""SELECT "column", q1, q3, q3 - q1 AS iqr FROM (SELECT '{{c}}' AS "column", {oracle.quantile('{c}', 0.25)} AS q1,
               {oracle.quantile('{c}', 0.75)} AS q3 FROM clean)""",
        ),
    ),
)
def iqr_bounds(spark, sf):
    return profile.iqr_bounds(frames.clean_table(spark, sf), _NUMERIC)


@query(
    "dup_counts",
    oracle.sql(
        "norm",
        f"""SELECT CAST((SELECT count(*) FROM norm) - (SELECT count(*) FROM (SELECT DISTINCT {_ALL} FROM norm)) AS BIGINT) AS exact_duplicates,
                  CAST((SELECT count(*) FROM (SELECT DISTINCT {_ALL} FROM norm)) - (SELECT count(DISTINCT event_id) FROM norm) AS BIGINT) AS key_duplicates""",
    ),
)
def dup_counts(spark, sf):
    return profile.duplicate_counts(frames.norm(spark, sf).select(*_EVENT_COLUMNS), "event_id")


_CHECKS = [*[(f"{c}_negative", f"{c} < 0") for c in ("order_n_items", *schemas.MONEY_COLUMNS)], ("event_time_missing", "event_time IS NULL")]


@query(
    "quality_checks",
    oracle.sql(
        "dedup",
        "\nUNION ALL\n".join(
            f"SELECT '{n}' AS check_name, count(CASE WHEN {c} THEN 1 END) AS n FROM dedup" for n, c in _CHECKS
        ),
    ),
)
def quality_checks(spark, sf):
    return profile.quality_checks(
        frames.dedup_table(spark, sf), ["order_n_items", *schemas.MONEY_COLUMNS], ["event_time"]
    )


@query(
    "key_unique",
    oracle.sql(
        "norm",
        "SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_keys, count(*) = count(DISTINCT event_id) AS is_unique FROM norm",
    ),
)
def key_unique(spark, sf):
    return profile.key_unique(frames.norm(spark, sf), "event_id")


_DELTA = "order_order_total - (order_basket_value + order_shipping_fee - order_discount)"


@query(
    "total_check_counts",
    oracle.sql(
        "clean",
        f"""SELECT count(*) - count(order_order_total) AS missing_totals,
                   count(CASE WHEN abs({_DELTA}) > 0.01e0 THEN 1 END) AS inconsistent_totals FROM clean""",
    ),
)
def total_check_counts(spark, sf):
    return profile.total_check_counts(frames.clean_table(spark, sf))


@query(
    "upsert_counters",
    oracle.sql(
        "clean",
        """SELECT count(DISTINCT customer_customer_id) AS customers_upserted, count(DISTINCT order_id) AS orders_upserted,
                  count(DISTINCT event_id) AS events_upserted FROM clean""",
    ),
)
def upsert_counters(spark, sf):
    return relational.handled_keys(frames.clean_table(spark, sf))


# ---- distributions ---------------------------------------------------------


@query(
    "corr_matrix",
    oracle.sql(
        "clean",
        "\nUNION ALL\n".join(
            f"""SELECT '{a}' AS x, '{b}' AS y, CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0
                THEN round(corr({a}, {b}), {DIGITS}) END AS r FROM clean"""
            for a in _NUMERIC
            for b in _NUMERIC
        ),
    ),
)
def corr_matrix(spark, sf):
    return rounded(profile.correlation_matrix(frames.clean_table(spark, sf), _NUMERIC), "r")


def _histogram(key: str, column: str) -> None:
    @query(
        key,
        oracle.sql(
            "clean",
            f"""SELECT CAST(bin AS INTEGER) AS bin, low + (high - low) / 30 * bin AS bin_low, low + (high - low) / 30 * (bin + 1) AS bin_high,
                  coalesce(n, 0) AS n
                FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(30)), (SELECT min({column}) AS low, max({column}) AS high FROM clean)
                LEFT JOIN (SELECT CAST(least(floor(({column} - lo) / (hi - lo) * 30), 29) AS INTEGER) AS b, count(*) AS n
                           FROM clean, (SELECT min({column}) AS lo, max({column}) AS hi FROM clean) GROUP BY 1) ON bin = b""",
        ),
    )
    def run(spark, sf):
        return profile.histogram(frames.clean_table(spark, sf), column, 30)


_histogram("hist_total", "order_order_total")
_histogram("hist_price", "price_average_per_item")


@query(
    "boxplot_total",
    oracle.sql(
        "clean",
        f"""SELECT any_value(q25) AS q25, any_value(q50) AS q50, any_value(q75) AS q75,
                  min(CASE WHEN x BETWEEN q25 - (q75 - q25) * 1.5e0 AND q75 + (q75 - q25) * 1.5e0 THEN x END) AS whisker_low,
                  max(CASE WHEN x BETWEEN q25 - (q75 - q25) * 1.5e0 AND q75 + (q75 - q25) * 1.5e0 THEN x END) AS whisker_high,
                  count(CASE WHEN NOT (x BETWEEN q25 - (q75 - q25) * 1.5e0 AND q75 + (q75 - q25) * 1.5e0) THEN 1 END) AS n_outliers
           FROM (SELECT order_order_total AS x FROM clean), (SELECT {oracle.quantile('order_order_total', 0.25)} AS q25,
                  {oracle.quantile('order_order_total', 0.5)} AS q50, {oracle.quantile('order_order_total', 0.75)} AS q75 FROM clean)""",
    ),
)
def boxplot_total(spark, sf):
    return profile.boxplot(frames.clean_table(spark, sf), "order_order_total")


def _relation(key: str, y: str) -> None:
    @query(
        key,
        oracle.sql(
            "clean",
            f"""SELECT order_n_items, count(*) AS n, round(avg({y}), {DIGITS}) AS mean, min({y}) AS min_value, max({y}) AS max_value,
                       {oracle.quantile(y, 0.25)} AS q25, {oracle.quantile(y, 0.5)} AS q50, {oracle.quantile(y, 0.75)} AS q75
                FROM clean GROUP BY order_n_items""",
        ),
    )
    def run(spark, sf):
        return rounded(profile.relation(frames.clean_table(spark, sf), "order_n_items", y), "mean")


_relation("relation_items_basket", "order_basket_value")
_relation("relation_items_price", "price_average_per_item")


@query(
    "class_balance",
    oracle.sql(
        "clean",
        """SELECT CAST(sum(CAST(order_is_returned AS INTEGER)) AS DOUBLE) / count(*) AS positive_rate,
                  count(CASE WHEN order_is_returned THEN 1 END) AS n_positive,
                  count(CASE WHEN NOT order_is_returned THEN 1 END) AS n_negative FROM clean""",
    ),
)
def class_balance(spark, sf):
    return profile.class_balance(frames.clean_table(spark, sf), "order_is_returned")


@query(
    "target_summary",
    oracle.sql(
        "clean",
        f"""SELECT round(avg(order_basket_value), {DIGITS}) AS mean, round(stddev_samp(order_basket_value), {DIGITS}) AS std,
                   min(order_basket_value) AS min_value, max(order_basket_value) AS max_value FROM clean""",
    ),
)
def target_summary(spark, sf):
    return rounded(profile.target_summary(frames.clean_table(spark, sf), "order_basket_value"), "mean", "std")


# ---- business --------------------------------------------------------------

_RATE = "CAST(sum(CAST(order_is_returned AS INTEGER)) AS DOUBLE) / count(*)"


@query("return_rate", oracle.sql("clean", f"SELECT {_RATE} AS return_rate, count(*) AS n FROM clean"))
def return_rate(spark, sf):
    return profile.return_rate(frames.clean_table(spark, sf))


def _rate_by(key: str, column: str) -> None:
    @query(
        key,
        oracle.sql("clean", f"SELECT {column}, {_RATE} AS return_rate, count(*) AS n FROM clean GROUP BY {column}"),
    )
    def run(spark, sf):
        return profile.return_rate_by(frames.clean_table(spark, sf), column)


_rate_by("return_rate_by_category", "order_main_category")
_rate_by("return_rate_by_channel", "order_channel")


@query(
    "revenue_by_category",
    oracle.sql(
        "clean",
        """SELECT order_main_category, CAST(sum(CAST(order_order_total AS DECIMAL(20,4))) AS DOUBLE) AS revenue
           FROM clean GROUP BY order_main_category""",
    ),
)
def revenue_by_category(spark, sf):
    return profile.revenue_by(frames.clean_table(spark, sf), "order_main_category")


_CALENDAR = """SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM days"""


@query(
    "daily_events",
    f"""WITH days AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
        SELECT c.day, coalesce(n, 0) AS n_events FROM ({_CALENDAR}) c LEFT JOIN days d ON c.day = d.day""",
)
def daily_events(spark, sf):
    return profile.daily_events(tables.table(spark, sf, "events"), "ts")


@query(
    "daily_revenue",
    oracle.sql(
        "clean",
        f""", days AS (SELECT CAST(event_time AS DATE) AS day, CAST(sum(CAST(order_order_total AS DECIMAL(20,4))) AS DOUBLE) AS r
             FROM clean GROUP BY 1)
            SELECT c.day, coalesce(r, 0e0) AS revenue FROM ({_CALENDAR}) c LEFT JOIN days d ON c.day = d.day""",
    ),
)
def daily_revenue(spark, sf):
    return profile.daily_revenue(frames.clean_table(spark, sf))


# ---- energy log ------------------------------------------------------------


@query("eco_load", oracle.sql("runs_once", "SELECT run_id, project_name, duration, emissions, energy_consumed, line_no FROM runs_once"))
def eco_load(spark, sf):
    return frames.runs_once(spark, sf).drop("timestamp")


@query(
    "eco_normalize",
    oracle.sql("runs", """SELECT run_id, project_name, "timestamp", duration, emissions, energy_consumed, line_no FROM runs"""),
)
def eco_normalize(spark, sf):
    """Old header names, mapped back to current ones."""
    old = {v: k for k, v in eco.COLUMN_ALIASES.items()}
    return eco.normalize_columns(tables.run_log(spark, sf).withColumnsRenamed(old))


@query("eco_summary", oracle.sql("eco", "SELECT * FROM eco"))
def eco_summary(spark, sf):
    return frames.eco_summary(spark, sf)


@query(
    "eco_totals",
    oracle.sql(
        "eco",
        "SELECT "
        + ", ".join(
            f"{oracle.EXACT.format(c)} AS total_{c}"
            for c in ("emissions", "emissions_g", "energy_consumed", "duration")
        )
        + " FROM eco",
    ),
)
def eco_totals(spark, sf):
    return eco.totals(frames.eco_summary(spark, sf))


@query(
    "eco_share",
    oracle.sql(
        "eco",
        f"""SELECT project_name, emissions * 100e0 / (SELECT {oracle.EXACT.format('emissions')} FROM eco) AS share_pct FROM eco""",
    ),
)
def eco_share(spark, sf):
    return eco.shares(frames.eco_summary(spark, sf)).select("project_name", "share_pct")


@query(
    "eco_costs",
    oracle.sql(
        "eco",
        """SELECT project_name, energy_consumed / (duration / 3600e0) AS mean_power_kw, emissions / energy_consumed AS carbon_intensity,
                  energy_consumed * 0.25e0 AS energy_cost, duration / 3600e0 * 0.1e0 AS vm_cost,
                  emissions / 1000e0 * 80e0 AS carbon_cost, energy_consumed * 0.475e0 AS factor_emissions FROM eco""",
    ),
)
def eco_costs(spark, sf):
    priced = eco.costs(frames.eco_summary(spark, sf), kwh_price=0.25, vm_hour_price=0.1, carbon_tonne_price=80.0)
    return priced.select(
        "project_name", "mean_power_kw", "carbon_intensity", "energy_cost", "vm_cost", "carbon_cost", "factor_emissions"
    )

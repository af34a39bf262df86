"""Queries: sources, projections, cleaning, scalar functions, deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.functions import orders, temporal, text
from orderloom.functions import messages as jsonf
from orderloom.operators import clean as cleaning
from orderloom.operators import dedup, messages, profile, project
from orderloom.plans import frames, oracle
from orderloom.plans.registry import query
from orderloom.sources import tables

_EVENT = ", ".join(f.name for f in schemas.EVENT.fields)
_CLEAN = ", ".join(f.name for f in schemas.CLEAN.fields)

# ---- sources ---------------------------------------------------------------


@query(
    "src_jsonl",
    oracle.sql("raw", f"SELECT {_EVENT} FROM raw"),
)
def src_jsonl(spark, sf):
    """Nested JSON lines parsed with the declared schema, flattened and typed."""
    lines = tables.nested_events(spark, sf).select(F.to_json(F.struct("*")).alias("value"))
    parsed = lines.select(F.from_json("value", schemas.RAW).alias("e")).select("e.*")
    typed = cleaning.typed(cleaning.flatten(parsed))
    return typed.withColumn("event_time", F.col("event_time").cast("timestamp_ntz")).select(
        *[f.name for f in schemas.EVENT.fields]
    )


@query(
    "src_json_tolerant",
    oracle.sql(
        "inspected",
        """SELECT count(CASE WHEN doc IS NOT NULL THEN 1 END) AS sent,
                  count(CASE WHEN length(line) = 0 THEN 1 END) AS skipped_empty,
                  count(CASE WHEN length(line) > 0 AND doc IS NULL THEN 1 END) AS skipped_invalid_json
           FROM inspected""",
    ),
)
def src_json_tolerant(spark, sf):
    return messages.line_counts(frames.message_table(spark, sf))


@query(
    "props_json_tolerant",
    """SELECT count(*) AS sent, CAST(0 AS BIGINT) AS skipped_empty, CAST(0 AS BIGINT) AS skipped_invalid_json
       FROM events WHERE json_valid(props)""",
)
def props_json_tolerant(spark, sf):
    return messages.line_counts(tables.table(spark, sf, "events"), "props")


@query("sql_table_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def sql_table_scan(spark, sf):
    tables.table(spark, sf, "orders").createOrReplaceTempView("orderloom_orders")
    return spark.sql(
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orderloom_orders ORDER BY o_orderkey LIMIT 20"
    )


@query(
    "publish_payload",
    oracle.sql(
        "inspected",
        """SELECT CASE WHEN json_type(doc, '$.event_id') = 'VARCHAR'
                        AND trim(json_extract_string(doc, '$.event_id')) <> ''
                       THEN json_extract_string(doc, '$.event_id') END AS key, line AS value
           FROM inspected WHERE doc IS NOT NULL""",
    ),
)
def publish_payload(spark, sf):
    return messages.payload(frames.message_table(spark, sf))


# ---- projections -----------------------------------------------------------


@query(
    "flatten",
    oracle.sql(
        "raw",
        """SELECT event_id, strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') AS event_time, order_id,
                  customer_customer_id, customer_country, order_device, order_channel, order_main_category,
                  order_n_items, order_basket_value, order_shipping_fee, order_discount, order_order_total,
                  CAST(order_is_returned AS BIGINT) AS order_is_returned FROM raw""",
    ),
)
def flatten(spark, sf):
    return cleaning.flatten(tables.nested_events(spark, sf))


@query(
    "typed_clean",
    oracle.sql("raw", f"SELECT {_EVENT} FROM raw"),
)
def typed_clean(spark, sf):
    """Every column arrives as text and is cast with bad values to NULL."""
    e = tables.nested_events(spark, sf)
    flat = cleaning.flatten(e)
    as_text = flat.select(*[F.col(c).cast("string").alias(c) for c in flat.columns])
    typed = cleaning.typed(as_text)
    return typed.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query(
    "ml_project",
    oracle.sql(
        "clean",
        f"SELECT {', '.join(f.name for f in schemas.CLEAN.fields if f.name not in (*schemas.ID_COLUMNS, 'event_time'))} FROM clean",
    ),
)
def ml_project(spark, sf):
    return project.drop_identifiers(frames.clean_table(spark, sf))


_STORED_PART = ["event_id", "event_time", "order_device", "order_discount"]
_INCOMING_PART = ["event_id", "order_id", "order_device", "order_channel"]


@query(
    "align_union",
    oracle.sql(
        "stored incoming",
        """SELECT event_id, event_time, order_device, order_discount, NULL AS order_id, NULL AS order_channel FROM stored
           UNION ALL
           SELECT event_id, NULL, order_device, NULL, order_id, order_channel FROM incoming""",
    ),
)
def align_union(spark, sf):
    return project.align_union(
        frames.stored(spark, sf).select(*_STORED_PART), frames.incoming(spark, sf).select(*_INCOMING_PART)
    )


@query(
    "cols_by_type",
    oracle.sql(
        "clean",
        f"SELECT {', '.join(schemas.NUMERIC_COLUMNS)} FROM clean",
    ),
)
def cols_by_type(spark, sf):
    return project.select_types(frames.clean_table(spark, sf), "number")


@query(
    "feature_align",
    oracle.sql(
        "clean",
        """SELECT event_id, order_discount, order_n_items, CAST(0 AS DOUBLE) AS order_channel_seo,
                  order_basket_value, CAST(0 AS DOUBLE) AS customer_country_IT FROM clean""",
    ),
)
def feature_align(spark, sf):
    wanted = ["order_discount", "order_n_items", "order_channel_seo", "order_basket_value", "customer_country_IT"]
    return project.align_features(frames.clean_table(spark, sf), wanted, keep=["event_id"])


@query("message_normalize", oracle.sql("normalized", f"SELECT position, {_CLEAN} FROM normalized"))
def message_normalize(spark, sf):
    rows = frames.normalized(spark, sf)
    return rows.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query(
    "model_features",
    oracle.sql("normalized", f"SELECT position, {', '.join(schemas.MODEL_FEATURES)} FROM normalized"),
)
def model_features(spark, sf):
    return project.model_features(frames.normalized(spark, sf), keep=["position"])


@query(
    "schema_evolve",
    oracle.sql(
        "clean",
        """SELECT event_id, event_time, order_id, customer_customer_id, customer_country AS country, order_device,
                  order_channel, order_main_category, CAST(order_n_items AS DOUBLE) AS order_n_items, order_basket_value,
                  order_shipping_fee, order_discount, order_order_total, order_is_returned, event_year, event_month,
                  event_day, price_average_per_item, CAST(NULL AS VARCHAR) AS note, 'web' AS origin FROM clean""",
    ),
)
def schema_evolve(spark, sf):
    return project.evolve(
        frames.clean_table(spark, sf),
        add={"note": F.lit(None).cast("string"), "origin": F.lit("web")},
        retype={"order_n_items": "double"},
        rename={"customer_country": "country"},
        drop=["event_hour"],
    )


_TYPE_NAMES = {"string": "string", "timestamp": "timestamp_ntz", "bigint": "bigint", "double": "double", "boolean": "boolean", "int": "int"}


@query(
    "dtype_report",
    oracle.sql(
        "dedup",
        "\nUNION ALL\n".join(
            f"""SELECT CAST({i} AS INTEGER) AS position, '{f.name}' AS "column",
                       '{_TYPE_NAMES[f.dataType.simpleString()]}' AS data_type, count({f.name}) AS non_null FROM dedup"""
            for i, f in enumerate(schemas.EVENT.fields)
        ),
    ),
)
def dtype_report(spark, sf):
    return project.column_report(frames.flat(frames.dedup(spark, sf)).select(*[f.name for f in schemas.EVENT.fields]))


# ---- scalar functions ------------------------------------------------------


@query("text_normalize", oracle.sql("norm", f"SELECT {_EVENT} FROM norm"))
def text_normalize(spark, sf):
    return frames.flat(cleaning.normalize_text(frames.raw(spark, sf)))


@query(
    "parse_time",
    """SELECT position, try_cast(txt AS TIMESTAMP) AS parsed FROM (
         SELECT concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS position,
                CASE WHEN l_partkey % 10 = 0 THEN concat('bad-', l_partkey) WHEN l_partkey % 10 = 1 THEN NULL
                     ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000123Z') END AS txt FROM lineitem)""",
)
def parse_time(spark, sf):
    line = tables.table(spark, sf, "lineitem")
    kind = F.col("l_partkey") % 10
    written = (
        F.when(kind == 0, F.concat(F.lit("bad-"), F.col("l_partkey")))
        .when(kind == 1, F.lit(None))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'.000123Z'"))
    )
    return line.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("position"),
        temporal.parse_time(written).cast("timestamp_ntz").alias("parsed"),
    )


@query(
    "time_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS event_year, CAST(month(ts) AS INTEGER) AS event_month,
              CAST(day(ts) AS INTEGER) AS event_day, CAST(hour(ts) AS INTEGER) AS event_hour FROM events""",
)
def time_parts(spark, sf):
    parts = temporal.time_parts(F.col("ts"))
    return tables.table(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in parts.items()])


@query(
    "price_per_item",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CASE WHEN CAST(l_quantity AS BIGINT) - 25 > 0 THEN l_extendedprice / (CAST(l_quantity AS BIGINT) - 25) END AS price
       FROM lineitem""",
)
def price_per_item(spark, sf):
    n = F.col("l_quantity").cast("bigint") - 25
    return tables.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        orders.price_per_item(F.col("l_extendedprice"), n).alias("price"),
    )


@query(
    "price_per_item_stream",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              l_extendedprice / greatest(coalesce(CASE WHEN l_partkey % 5 > 0 THEN CAST(l_quantity AS BIGINT) - 25 END, 0), 1) AS price
       FROM lineitem""",
)
def price_per_item_stream(spark, sf):
    n = F.when(F.col("l_partkey") % 5 > 0, F.col("l_quantity").cast("bigint") - 25)
    return tables.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        orders.price_per_item_stream(F.col("l_extendedprice"), n).alias("price"),
    )


@query("impute_clean", oracle.sql("clean", f"SELECT {_CLEAN} FROM clean"))
def impute_clean(spark, sf):
    return frames.clean(spark, sf)


_TOTAL = "order_basket_value + order_shipping_fee - order_discount"


@query(
    "total_consistency",
    oracle.sql(
        "clean",
        f"""SELECT event_id, {_TOTAL} AS order_total_expected, order_order_total - ({_TOTAL}) AS order_total_delta,
                   abs(order_order_total - ({_TOTAL})) > 0.01e0 AS order_total_inconsistent FROM clean""",
    ),
)
def total_consistency(spark, sf):
    return profile.total_consistency(frames.clean_table(spark, sf)).select(
        "event_id", "order_total_expected", "order_total_delta", "order_total_inconsistent"
    )


@query(
    "inconsistent_totals",
    oracle.sql(
        "clean",
        f"""SELECT event_id, order_order_total, {_TOTAL} AS order_total_expected FROM clean
            WHERE abs(order_order_total - ({_TOTAL})) > 0.01e0""",
    ),
)
def inconsistent_totals(spark, sf):
    return profile.inconsistent_totals(frames.clean_table(spark, sf)).select(
        "event_id", "order_order_total", "order_total_expected"
    )


@query(
    "total_repair",
    oracle.sql(
        "clean",
        f"""SELECT event_id, coalesce(CASE WHEN order_channel <> '5-low' THEN order_order_total END, {_TOTAL}) AS order_order_total
            FROM clean""",
    ),
)
def total_repair(spark, sf):
    """Totals of one channel are blanked first, so there is something to repair."""
    blanked = frames.clean_table(spark, sf).withColumn(
        "order_order_total", F.when(F.col("order_channel") != "5-low", F.col("order_order_total"))
    )
    return profile.total_repair(blanked).select("event_id", "order_order_total")


@query(
    "to_numeric",
    """SELECT doc_key, TRY_CAST(txt AS DOUBLE) AS n FROM (
         SELECT event_id AS doc_key, CASE WHEN event_type = 'click' THEN concat('x', value) ELSE CAST(user_id AS VARCHAR) END AS txt FROM events)""",
)
def to_numeric(spark, sf):
    written = F.when(F.col("event_type") == "click", F.concat(F.lit("x"), F.col("value"))).otherwise(
        F.col("user_id").cast("string")
    )
    rows = tables.table(spark, sf, "events").select(F.col("event_id").alias("doc_key"), written.alias("n"))
    return cleaning.to_numeric(rows, ["n"])


@query(
    "nan_to_null",
    "SELECT event_id, CASE WHEN event_type <> 'click' THEN value END AS value FROM events",
)
def nan_to_null(spark, sf):
    rows = tables.table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "click", F.lit(float("nan"))).otherwise(F.col("value")).alias("value")
    )
    return cleaning.nan_to_null(rows)


@query(
    "json_key",
    oracle.sql(
        "inspected",
        """SELECT position, CASE WHEN json_type(doc, '$.event_id') = 'VARCHAR'
                                  AND trim(json_extract_string(doc, '$.event_id')) <> ''
                             THEN json_extract_string(doc, '$.event_id') END AS key
           FROM inspected""",
    ),
)
def json_key(spark, sf):
    doc = jsonf.document(text.strip(F.col("value")))
    rows = frames.message_table(spark, sf).select("position", F.explode(F.array(doc)).alias("doc"))
    return rows.select("position", jsonf.text_key(F.col("doc"), "event_id").alias("key"))


@query("event_time_fallback", oracle.sql("normalized", "SELECT position, event_time FROM normalized"))
def event_time_fallback(spark, sf):
    return frames.normalized(spark, sf).select(
        "position", F.col("event_time").cast("timestamp_ntz").alias("event_time")
    )


_D = "CAST({0} AS DECIMAL(14,4))"


@query(
    "order_rules",
    oracle.sql(
        "clean",
        f"""SELECT event_id, CASE WHEN order_basket_value > 80 THEN 0e0 ELSE order_shipping_fee END AS shipping,
              CAST(CAST(round(greatest({_D.format('order_basket_value')} + {_D.format('order_shipping_fee')}
                   - {_D.format('order_discount')}, CAST(1 AS DECIMAL(14,4))), 2) AS DECIMAL(18,2)) AS DOUBLE) AS total
            FROM clean""",
    ),
)
def order_rules(spark, sf):
    basket, fee, discount = F.col("order_basket_value"), F.col("order_shipping_fee"), F.col("order_discount")
    return frames.clean_table(spark, sf).select(
        "event_id",
        orders.shipping_rule(basket, fee).alias("shipping"),
        orders.total_rule(basket, fee, discount).alias("total"),
    )


@query("rule_return_score", oracle.sql("scored", "SELECT event_id, score FROM scored"))
def rule_return_score(spark, sf):
    return frames.scored(spark, sf).select("event_id", "score")


@query(
    "format_ids",
    """SELECT c_custkey, concat('CUST-', CASE WHEN c_custkey < 10000 THEN lpad(CAST(c_custkey AS VARCHAR), 4, '0')
              ELSE CAST(c_custkey AS VARCHAR) END) AS customer_id FROM customer""",
)
def format_ids(spark, sf):
    return tables.table(spark, sf, "customer").select(
        "c_custkey", text.padded_id("CUST", 4, F.col("c_custkey")).alias("customer_id")
    )


# ---- rows in and out -------------------------------------------------------


@query(
    "dropna_rows",
    oracle.sql(
        "dedup",
        f"SELECT {_EVENT} FROM dedup WHERE customer_country IS NOT NULL AND order_channel IS NOT NULL AND order_discount IS NOT NULL",
    ),
)
def dropna_rows(spark, sf):
    return cleaning.drop_missing(frames.flat(frames.dedup(spark, sf)))


@query(
    "required_keys",
    oracle.sql("reasoned", "SELECT position, reason, coalesce(missing, '') AS missing FROM reasoned WHERE reason IS NOT NULL"),
)
def required_keys(spark, sf):
    bad = frames.inspected(spark, sf).where(F.col("reason").isNotNull())
    return bad.select("position", "reason", F.coalesce("missing", F.lit("")).alias("missing"))


@query("distinct_rows", oracle.sql("norm", f"SELECT DISTINCT {_EVENT} FROM norm"))
def distinct_rows(spark, sf):
    return dedup.distinct_rows(frames.flat(frames.norm(spark, sf)))


@query("dedup_latest", oracle.sql("dedup", f"SELECT {_EVENT} FROM dedup"))
def dedup_latest(spark, sf):
    return frames.flat(frames.dedup(spark, sf))


_GAPPED = "CASE WHEN order_channel IS NULL THEN NULL ELSE event_time END"


@query(
    "dedup_keep_last",
    oracle.sql(
        "norm",
        f"""SELECT event_id, event_time, tie1, tie2 FROM (SELECT event_id, {_GAPPED} AS event_time, tie1, tie2 FROM norm)
            QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_time DESC NULLS FIRST, tie1 DESC, tie2 DESC) = 1""",
    ),
)
def dedup_keep_last(spark, sf):
    gapped = frames.norm(spark, sf).select(
        "event_id", F.when(F.col("order_channel").isNotNull(), F.col("event_time")).alias("event_time"), *tables.TIES
    )
    return dedup.keep_last_per_key(gapped, "event_id", "event_time", tables.TIES)


@query(
    "dedup_by_seq",
    oracle.sql(
        "norm",
        """SELECT event_id, order_basket_value, tie1, tie2 FROM norm
           QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY tie1 DESC, tie2 DESC, event_time DESC) = 1""",
    ),
)
def dedup_by_seq(spark, sf):
    rows = dedup.last_by_sequence(frames.norm(spark, sf), "event_id", [*tables.TIES, "event_time"])
    return rows.select("event_id", "order_basket_value", *tables.TIES)



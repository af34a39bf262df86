"""Views that give the benchmark tables the shape of order events.

``order_events`` is the raw flat log (duplicated ids, untidy text, gaps),
``messages`` the same log as broker messages (JSON text, some of it broken), and
``run_log`` the ``events`` table seen as an energy log of pipeline runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import configure

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

TIES = ("tie1", "tie2")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores on an input that comes in fewer pieces than there are cores.

    One unsplittable file would otherwise keep every step up to the first shuffle in
    one task.  An input that already has enough pieces is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log's own columns: the lines of orders.  What an order or a customer adds is looked up later (``order_facts``)."""
    lineitem = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", "l_partkey")
    return lineitem.where(F.col("l_orderkey").isNotNull())


#: An event's key and time among the columns of ``order_lines``: all lines of an event have the same order.
LINE_KEY, LINE_TIME, LINE_TIES = ("l_orderkey", "l_linenumber"), "l_shipdate", ("l_partkey", "l_suppkey")


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the lines of an order share.  The narrow side is joined first, so that the lines are dealt once, by their order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    facts = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return facts.select(*orders.columns, "c_custkey", "c_mktsegment", "n_name")


def _joined(lines: DataFrame, sf_dir: str) -> DataFrame:
    """lineitem - orders - customer - nation; which sides are broadcast is up to size statistics."""
    return lines.join(order_facts(lines.sparkSession, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(order_lines(spark, sf_dir), sf_dir)


def events_of(lines: DataFrame, sf_dir: str) -> DataFrame:
    """The flat log of (some of) the ``order_lines``."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    tax_amount = price * F.col("l_tax").cast("decimal(4,2)")
    discount_amount = price * F.col("l_discount").cast("decimal(4,2)")
    surcharge = F.when((F.col("l_orderkey") + F.col("l_partkey")) % 29 == 0, 1).otherwise(0)
    country = (
        F.when(F.col("c_custkey") % 41 == 0, F.lit(None))
        .when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" "), F.lower("n_name")))
        .otherwise(F.col("n_name"))
    )
    return _joined(lines, sf_dir).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        F.col("l_shipdate").alias("event_time"),
        F.concat(F.lit("ORD-"), F.col("l_orderkey")).alias("order_id"),
        F.concat(F.lit("CUST-"), F.col("o_custkey")).alias("customer_customer_id"),
        country.alias("customer_country"),
        F.when(F.col("l_linestatus") == "O", " Mobile ").otherwise("DESKTOP").alias("order_device"),
        F.when((F.col("l_orderkey") * 7 + F.col("l_partkey")) % 33 != 0, F.col("o_orderpriority")).alias(
            "order_channel"
        ),
        F.col("c_mktsegment").alias("order_main_category"),
        F.col("l_quantity").cast("bigint").alias("order_n_items"),
        F.col("l_extendedprice").alias("order_basket_value"),
        tax_amount.cast("double").alias("order_shipping_fee"),
        F.when((F.col("l_orderkey") + F.col("l_suppkey")) % 50 != 0, discount_amount.cast("double")).alias(
            "order_discount"
        ),
        (price + tax_amount - discount_amount + surcharge.cast("decimal(12,2)"))
        .cast("double")
        .alias("order_order_total"),
        (F.col("l_returnflag") == "R").alias("order_is_returned"),
        F.col("l_partkey").alias(TIES[0]),
        F.col("l_suppkey").alias(TIES[1]),
    )


def nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log in the nested shape of the raw JSON files."""
    e = order_events(spark, sf_dir)
    return e.select(
        "event_id",
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_time"),
        "order_id",
        F.struct(
            F.col("customer_customer_id").alias("customer_id"), F.col("customer_country").alias("country")
        ).alias("customer"),
        F.struct(
            F.col("order_device").alias("device"),
            F.col("order_channel").alias("channel"),
            F.col("order_main_category").alias("main_category"),
            F.col("order_n_items").alias("n_items"),
            F.col("order_basket_value").alias("basket_value"),
            F.col("order_shipping_fee").alias("shipping_fee"),
            F.col("order_discount").alias("discount"),
            F.col("order_order_total").alias("order_total"),
            F.col("order_is_returned").cast("bigint").alias("is_returned"),
        ).alias("order"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(value, broker_time, position)``: one broker message per line item.

    Some lines are blank, cut off, arrays, or lack / null / retype a field.
    """
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    member = lambda name, v: F.concat(F.lit(f'"{name}": '), v)
    part, key = F.col("l_partkey"), F.col("l_orderkey")
    event_id = F.concat_ws("-", "l_orderkey", "l_linenumber")
    iso = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    epoch_ms = F.unix_millis(F.col("l_shipdate").cast("timestamp")).cast("string")
    time_member = (
        F.when(part % 11 == 0, member("event_time", epoch_ms))
        .when(part % 13 == 0, member("event_time", F.lit('"zzz"')))
        .when(part % 17 == 0, member("event_time", F.lit("null")))
        .otherwise(member("event_time", quoted(iso)))
    )
    n_items = F.when(part % 19 == 0, F.lit('"many"')).otherwise(
        F.col("l_quantity").cast("bigint").cast("string")
    )
    head = F.concat_ws(
        ", ",
        member("event_id", quoted(event_id)),
        time_member,
        member("customer_customer_id", quoted(F.concat(F.lit("CUST-"), F.col("o_custkey")))),
    )
    order_member = member("order_id", quoted(F.concat(F.lit("ORD-"), key)))
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    rest = F.concat_ws(
        ", ",
        member("customer_country", quoted(F.col("n_name"))),
        member("order_device", quoted(F.when(F.col("l_linestatus") == "O", " Mobile ").otherwise("DESKTOP"))),
        member("order_main_category", quoted(F.col("c_mktsegment"))),
        member("order_n_items", n_items),
        member("order_basket_value", price),
        member("order_order_total", price),
        member("order_is_returned", F.when(F.col("l_returnflag") == "R", "true").otherwise("false")),
    )
    full = F.concat(F.lit("{"), head, F.lit(", "), order_member, F.lit(", "), rest, F.lit("}"))
    value = (
        F.when(part % 97 == 0, F.lit("  "))
        .when(part % 89 == 0, F.concat(F.lit('{"event_id": "'), event_id))
        .when(part % 83 == 0, F.concat(F.lit("["), key, F.lit("]")))
        .when(part % 79 == 0, F.concat(F.lit('{"event_id": '), key, F.lit("}")))
        .when(part % 73 == 0, F.concat(F.lit("{"), head, F.lit("}")))
        .when(part % 71 == 0, F.concat(F.lit("{"), head, F.lit(', "order_id": null}')))
        .otherwise(F.concat(F.lit(" "), full))
    )
    return _joined(order_lines(spark, sf_dir), sf_dir).select(
        value.alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("broker_time"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("position"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of pipeline phases with duration (s), emissions (kg) and energy (kWh)."""
    value = F.col("value").cast("decimal(18,6)")
    return table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.col("event_type").alias("project_name"),
        F.concat_ws("-", F.lit("run"), "user_id", "event_type").alias("run_id"),
        value.cast("double").alias("duration"),
        (value * F.lit("0.000006").cast("decimal(9,6)")).cast("double").alias("emissions"),
        (value * F.lit("0.000023").cast("decimal(9,6)")).cast("double").alias("energy_consumed"),
        F.col("event_id").alias("line_no"),
    )

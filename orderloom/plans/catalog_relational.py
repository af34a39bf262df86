"""Queries: star schema, keys, upserts, referential checks, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.operators import relational
from orderloom.plans import frames, oracle
from orderloom.plans.registry import query
from orderloom.sources import tables

_EVENT = ", ".join(f.name for f in schemas.EVENT.fields)
_CUSTOMERS = ", ".join(schemas.CUSTOMER_COLUMNS)
_ORDERS = ", ".join(schemas.ORDER_COLUMNS)
_EVENTS = ", ".join(schemas.EVENT_COLUMNS)
_PREDICTIONS = "event_id, order_id, customer_customer_id, score AS return_proba"

# ---- star ------------------------------------------------------------------


@query("star_customers", oracle.sql("customers", f"SELECT {_CUSTOMERS} FROM customers"))
def star_customers(spark, sf):
    return relational.customers(frames.clean_table(spark, sf))


@query("star_orders", oracle.sql("star_o", f"SELECT {_ORDERS} FROM star_o"))
def star_orders(spark, sf):
    return relational.orders(frames.clean_table(spark, sf))


@query("star_events", oracle.sql("star_e", f"SELECT {_EVENTS} FROM star_e"))
def star_events(spark, sf):
    return relational.events(frames.clean_table(spark, sf))


@query("star_predictions", oracle.sql("scored", f"SELECT {_PREDICTIONS} FROM scored"))
def star_predictions(spark, sf):
    return relational.predictions_for_upsert(frames.predictions(spark, sf), {}, validate=False)


@query(
    "star_wide",
    oracle.sql(
        "customers star_o star_e scored",
        f"""SELECT e.event_id, e.event_time, e.event_year, e.event_month, e.event_day, e.event_hour, {', '.join('o.' + c for c in schemas.ORDER_COLUMNS)},
                   c.customer_country, p.score AS return_proba
            FROM star_e e JOIN star_o o ON e.order_id = o.order_id
            JOIN customers c ON o.customer_customer_id = c.customer_customer_id
            LEFT JOIN scored p ON e.event_id = p.event_id AND p.label = 1""",
    ),
)
def star_wide(spark, sf):
    """Only returned events have a prediction here, so the outer side is exercised."""
    some = frames.scored(spark, sf).where("label = 1").select(*schemas.ID_COLUMNS, F.col("score").alias("return_proba"))
    return relational.star_wide(frames.star(spark, sf) | {"predictions": some})


@query(
    "one_to_many",
    """SELECT c_custkey, c_name, c_mktsegment, o_orderkey, o_orderpriority, o_totalprice
       FROM customer JOIN orders ON c_custkey = o_custkey""",
)
def one_to_many(spark, sf):
    parents = tables.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    children = tables.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority", "o_totalprice"
    )
    return relational.one_to_many(parents, children, "c_custkey", "o_orderkey")


# ---- keys and upserts ------------------------------------------------------


@query(
    "anti_new_events",
    oracle.sql("stored incoming", f"SELECT {_EVENT} FROM incoming WHERE event_id NOT IN (SELECT event_id FROM stored)"),
)
def anti_new_events(spark, sf):
    return frames.flat(relational.anti_new(frames.incoming(spark, sf), frames.stored(spark, sf), "event_id")).select(
        *[f.name for f in schemas.EVENT.fields]
    )


@query(
    "pk_upsert",
    oracle.sql(
        "stored incoming",
        f"""SELECT {_EVENT} FROM incoming UNION ALL
            SELECT {_EVENT} FROM stored WHERE event_id NOT IN (SELECT event_id FROM incoming)""",
    ),
)
def pk_upsert(spark, sf):
    return relational.pk_upsert(
        frames.flat(frames.stored(spark, sf)), frames.flat(frames.incoming(spark, sf)), "event_id"
    )


@query(
    "pk_upsert_counts",
    oracle.sql(
        "stored incoming",
        """SELECT count(CASE WHEN event_id NOT IN (SELECT event_id FROM stored) THEN 1 END) AS inserted,
                  count(CASE WHEN event_id IN (SELECT event_id FROM stored) THEN 1 END) AS updated FROM incoming""",
    ),
)
def pk_upsert_counts(spark, sf):
    return relational.upsert_counts(frames.stored(spark, sf), frames.incoming(spark, sf), "event_id")


@query(
    "snapshot_upsert",
    oracle.sql(
        "stored incoming",
        f"""SELECT {_EVENT} FROM (SELECT *, 0 AS batch FROM stored UNION ALL SELECT *, 1 AS batch FROM incoming)
            QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_time DESC NULLS LAST, batch DESC, tie1, tie2) = 1""",
    ),
)
def snapshot_upsert(spark, sf):
    merged = relational.snapshot_upsert(frames.stored(spark, sf), frames.incoming(spark, sf), ties=tables.TIES)
    return merged.select(*[f.name for f in schemas.EVENT.fields])


@query(
    "row_insert",
    oracle.sql("stored incoming", f"SELECT {_EVENT} FROM stored UNION ALL SELECT {_EVENT} FROM incoming"),
)
def row_insert(spark, sf):
    return relational.insert_rows(frames.flat(frames.stored(spark, sf)), frames.flat(frames.incoming(spark, sf)))


@query("point_lookup", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey = 1")
def point_lookup(spark, sf):
    return relational.lookup(tables.table(spark, sf, "customer"), "c_custkey", 1)


@query(
    "row_update",
    oracle.sql(
        "dedup",
        """SELECT event_id, CASE WHEN order_channel = '5-low' THEN 'none' ELSE order_channel END AS order_channel,
                  CASE WHEN order_channel = '5-low' THEN 0e0 ELSE order_discount END AS order_discount FROM dedup""",
    ),
)
def row_update(spark, sf):
    changed = relational.update_where(
        frames.dedup(spark, sf),
        F.col("order_channel") == "5-low",
        {"order_channel": F.lit("none"), "order_discount": F.lit(0.0)},
    )
    return changed.select("event_id", "order_channel", "order_discount")


@query(
    "row_delete",
    oracle.sql("dedup", "SELECT event_id, order_channel FROM dedup WHERE order_channel IS NULL OR order_channel <> '5-low'"),
)
def row_delete(spark, sf):
    kept = relational.delete_where(frames.dedup(spark, sf), F.col("order_channel") == "5-low")
    return kept.select("event_id", "order_channel")


# ---- constraints -----------------------------------------------------------

# A star built from the desktop half only: predictions about the other half dangle.
_HALF_STAR = """, e AS (SELECT DISTINCT event_id FROM stored), o AS (SELECT DISTINCT order_id FROM stored),
  c AS (SELECT DISTINCT customer_customer_id FROM stored)"""


def _half_star(spark, sf):
    half = frames.stored(spark, sf)
    return {"events": half, "orders": half, "customers": half}


@query(
    "fk_semi",
    oracle.sql(
        "stored scored",
        f"""{_HALF_STAR} SELECT {_PREDICTIONS} FROM scored WHERE event_id IN (SELECT event_id FROM e)
            AND order_id IN (SELECT order_id FROM o) AND customer_customer_id IN (SELECT customer_customer_id FROM c)""",
    ),
)
def fk_semi(spark, sf):
    return relational.valid_references(frames.predictions(spark, sf), _half_star(spark, sf))


@query(
    "fk_orphans",
    oracle.sql(
        "stored scored",
        f"""{_HALF_STAR}
            SELECT {_PREDICTIONS}, 'unknown event_id' AS reason FROM scored WHERE event_id NOT IN (SELECT event_id FROM e)
            UNION ALL SELECT {_PREDICTIONS}, 'unknown order_id' FROM scored WHERE order_id NOT IN (SELECT order_id FROM o)
            UNION ALL SELECT {_PREDICTIONS}, 'unknown customer_customer_id' FROM scored
              WHERE customer_customer_id NOT IN (SELECT customer_customer_id FROM c)""",
    ),
)
def fk_orphans(spark, sf):
    return relational.orphans(frames.predictions(spark, sf), _half_star(spark, sf))


@query(
    "not_null_violations",
    oracle.sql(
        "dedup",
        """SELECT event_id, concat_ws(',', CASE WHEN customer_country IS NULL THEN 'customer_country' END,
                  CASE WHEN order_channel IS NULL THEN 'order_channel' END,
                  CASE WHEN order_discount IS NULL THEN 'order_discount' END) AS null_columns
           FROM dedup WHERE customer_country IS NULL OR order_channel IS NULL OR order_discount IS NULL""",
    ),
)
def not_null_violations(spark, sf):
    bad = relational.not_null_violations(frames.flat(frames.dedup(spark, sf)))
    return bad.select("event_id", "null_columns")


# ---- ordering --------------------------------------------------------------


@query("sort_events", oracle.sql("dedup", "SELECT event_id, event_time, order_id FROM dedup"))
def sort_events(spark, sf):
    return relational.newest_first(frames.dedup(spark, sf).select("event_id", "event_time", "order_id"))


@query(
    "table_limit",
    oracle.sql("star_o", f"SELECT {_ORDERS} FROM star_o ORDER BY order_id LIMIT 20"),
)
def table_limit(spark, sf):
    return relational.top_rows(relational.orders(frames.clean_table(spark, sf)), [F.col("order_id")], 20)


@query(
    "topk_predictions",
    oracle.sql("scored", f"SELECT {_PREDICTIONS} FROM scored ORDER BY event_id DESC LIMIT 10"),
)
def topk_predictions(spark, sf):
    return relational.top_rows(frames.predictions(spark, sf), [F.col("event_id").desc()], 10)

"""Queries over tables that several batches were merged into, as stored in bucketed snapshots."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.operators import clean as cleaning
from orderloom.operators import messages
from orderloom.plans import frames, oracle
from orderloom.plans.registry import query
from orderloom.plans.stages import stage
from orderloom.session import materialise, shared_dir
from orderloom.sources import snapshots

_EVENT = ", ".join(f.name for f in schemas.EVENT.fields)


@query(
    "stored_upsert",
    oracle.sql(
        "stored incoming",
        f"""SELECT {_EVENT} FROM (SELECT *, 0 AS batch FROM stored UNION ALL SELECT *, 1 AS batch FROM incoming)
            QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_time DESC NULLS LAST, batch DESC) = 1""",
    ),
)
def stored_upsert(spark, sf):
    """The two halves of the log merged one after the other into the stored set, then read back."""
    root = shared_dir(spark, "stored_clean")
    for half in (frames.stored(spark, sf), frames.incoming(spark, sf)):
        merged = snapshots.upsert_clean(spark, root, frames.flat(half), buckets=16)
    return merged.select(*[f.name for f in schemas.EVENT.fields])


@stage
def _star_in_two_batches(spark, sf) -> str:
    """Root of a star that took the clean set's desktop rows first and then the others, newest rows winning."""
    root = shared_dir(spark, "stored_star")
    rows, desktop = frames.clean_table(spark, sf), F.col("order_device") == "desktop"
    for batch in (rows.where(desktop), rows.where(~desktop)):
        snapshots.ingest_star(spark, root, batch, newest_wins=True, buckets=16)
    return root


_LATER = """QUALIFY row_number() OVER (PARTITION BY {0}
    ORDER BY event_time DESC NULLS LAST, CASE order_device WHEN 'desktop' THEN 0 ELSE 1 END DESC, event_id) = 1"""


@query("star_orders_in_batches", oracle.sql("clean", f"SELECT {', '.join(schemas.ORDER_COLUMNS)} FROM clean {_LATER.format('order_id')}"))
def star_orders_in_batches(spark, sf):
    return snapshots.read(spark, _star_in_two_batches(spark, sf), "orders").select(*schemas.ORDER_COLUMNS)


@query(
    "star_customers_in_batches",
    oracle.sql("clean", f"SELECT {', '.join(schemas.CUSTOMER_COLUMNS)} FROM clean {_LATER.format('customer_customer_id')}"),
)
def star_customers_in_batches(spark, sf):
    return snapshots.read(spark, _star_in_two_batches(spark, sf), "customers").select(*schemas.CUSTOMER_COLUMNS)


_NULLABLE = ("customer_country", "order_channel", "order_discount")


@query(
    "star_quarantine",
    oracle.sql(
        "dedup",
        f"""SELECT event_id, concat_ws(',', {', '.join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in _NULLABLE)}) AS null_columns
            FROM dedup WHERE {' OR '.join(f'{c} IS NULL' for c in _NULLABLE)}""",
    ),
)
def star_quarantine(spark, sf):
    """Rows that a star ingest of the deduplicated, not imputed log sets aside."""
    root = shared_dir(spark, "quarantine")
    rows = cleaning.clean_columns(cleaning.derive(frames.dedup_table(spark, sf)))
    snapshots.ingest_star(spark, root, rows, on_null=snapshots.QUARANTINE, buckets=16)
    return snapshots.quarantined(spark, root).select("event_id", "null_columns")


@query(
    "src_json_observed",
    oracle.sql(
        "inspected",
        """SELECT count(CASE WHEN doc IS NOT NULL THEN 1 END) AS sent,
                  count(CASE WHEN length(line) = 0 THEN 1 END) AS skipped_empty,
                  count(CASE WHEN length(line) > 0 AND doc IS NULL THEN 1 END) AS skipped_invalid_json
           FROM inspected""",
    ),
)
def src_json_observed(spark, sf):
    """Line counts that come with the pass that stores the valid lines."""
    counts = Observation()
    lines = messages.observe_lines(frames.message_table(spark, sf), counts)
    materialise(lines.where((F.length("line") > 0) & F.col("valid")).select("line"), "valid_lines")
    row = counts.get
    return spark.createDataFrame([tuple(row[c] for c in messages.INTAKE_COUNTS[:3])], [f"{c}" for c in messages.INTAKE_COUNTS[:3]])

"""Current customers and orders as stored tables, kept up by a stateful stream over the accepted log.

The newest row of every key is streaming state (``max_by`` per key, RocksDB on the executors, snapshots in the checkpoint): a micro-batch reads what
was accepted since the last one, and emits the keys whose row changed.  Those are merged into bucketed snapshots, which rewrite the touched
buckets only.  A batch that is retried emits the same rows again and merges to the same tables.  State has one row a key;
nothing ranks the log again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom import schemas
from orderloom.session import DROP_SHUFFLES, settings
from orderloom.sources import files, snapshots
from orderloom.streaming import scoring

COLUMNS = {"customers": schemas.CUSTOMER_COLUMNS, "orders": schemas.ORDER_COLUMNS}
#: What makes a row of the log newer than another.
SEQUENCE = ("batch_id", "arrived", "event_id")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: State lies in RocksDB, and the shuffles of a micro-batch go when it ends.
_SETTINGS = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB} | DROP_SHUFFLES


def accepted_stream(spark: SparkSession, root: str, files_per_trigger: int | None = None) -> DataFrame:
    """New files of the accepted log."""
    schema = T.StructType([*scoring.log_schema(scoring.ACCEPTED).fields, T.StructField("batch_id", T.LongType())])
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.parquet(f"{root}/{scoring.ACCEPTED}")


def newest(log: DataFrame, table: str) -> DataFrame:
    """The row of each key that the last message set, as an aggregate that streams can keep as state."""
    key = schemas.STAR_KEYS[table]
    row = F.max_by(F.struct(*COLUMNS[table]), F.struct(*SEQUENCE))
    return log.groupBy(key).agg(row.alias("row")).select("row.*")


def start(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    drain: bool = True,
    interval: str = "30 seconds",
    buckets: int = snapshots.BUCKETS,
    files_per_trigger: int | None = None,
) -> dict[str, StreamingQuery]:
    """One query per table over the log that a ``ScoringJob`` writes under ``root``.

    ``drain`` takes what was accepted so far and stops.  The tables lie in ``root/current/<table>``.
    """
    if not files.exists(spark, f"{root}/{scoring.ACCEPTED}"):
        raise FileNotFoundError(f"{root}/{scoring.ACCEPTED}")

    def merge_into(table: str):
        def merge(rows: DataFrame, _: int) -> None:
            batch = snapshots.Batch(rows, schemas.STAR_KEYS[table])
            snapshots.upsert(rows.sparkSession, f"{root}/current/{table}", {table: batch}, buckets)

        return merge

    queries = {}
    with settings(spark, _SETTINGS):
        for table in COLUMNS:
            changed = newest(accepted_stream(spark, root, files_per_trigger), table)
            writer = changed.writeStream.outputMode("update").foreachBatch(merge_into(table))
            writer = writer.option("checkpointLocation", f"{checkpoint}/{table}").queryName(f"current {table}")
            writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=interval)
            queries[table] = writer.start()
    return queries


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A current table; empty before the first batch."""
    found = snapshots.read(spark, f"{root}/current/{table}", table)
    return scoring.read_log(spark, root, scoring.ACCEPTED).select(*COLUMNS[table]).limit(0) if found is None else found.select(*COLUMNS[table])


def tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Customers and orders as stored, with the events and predictions of the logs."""
    return scoring.star_tables(spark, root) | {name: read(spark, root, name) for name in COLUMNS}

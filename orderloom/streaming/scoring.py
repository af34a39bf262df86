"""Continuous ingestion and scoring of order messages.

Each micro-batch appends one partition ``batch_id=<n>`` to the logs under the
root folder: ``accepted`` (clean rows), ``predictions``, ``rejected`` (with a
reason) and ``intake`` (how many messages went which way).  A partition is written by overwrite, so a
batch that is retried after a failure replaces its own output: together with the
checkpoint every message takes effect exactly once.  With ``against_history`` events are compared with an
index of all earlier ids, of which a batch reads the buckets its own ids fall in.  The star
tables are views over the accepted log; ``current`` keeps them as stored tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom import schemas
from orderloom.functions import text
from orderloom.ml.models import score_returns
from orderloom.operators import dedup, messages, relational
from orderloom.session import DROP_SHUFFLES, materialise, settings, shared_dir, stage_scope
from orderloom.sources import files, id_index

ACCEPTED, PREDICTIONS, REJECTED, INTAKE, REFUSED = "accepted", "predictions", "rejected", "intake", "refused_predictions"

_REJECTED_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("value", "reason")])
_PREDICTION_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in schemas.PREDICTION_COLUMNS[:3]]
    + [T.StructField("return_proba", T.DoubleType())]
)
_LOG_SCHEMAS = {
    ACCEPTED: T.StructType([*schemas.CLEAN.fields, T.StructField("arrived", T.TimestampType())]),
    PREDICTIONS: _PREDICTION_SCHEMA,
    REJECTED: _REJECTED_SCHEMA,
    INTAKE: T.StructType([T.StructField(c, T.LongType()) for c in messages.INTAKE_COUNTS]),
    REFUSED: T.StructType([*_PREDICTION_SCHEMA.fields, T.StructField("reason", T.StringType())]),
}


def log_schema(name: str) -> T.StructType:
    return _LOG_SCHEMAS[name]


def read_log(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the logs, with its ``batch_id``; empty when nothing was written yet."""
    schema = T.StructType([*_LOG_SCHEMAS[name].fields, T.StructField("batch_id", T.LongType())])
    path = f"{root}/{name}"
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def star_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Current customers, orders, events and predictions: the last write per key wins."""
    log = read_log(spark, root, ACCEPTED)
    sequence = ["batch_id", "arrived", "event_id"]
    return {
        "customers": dedup.last_by_sequence(
            log.select(*schemas.CUSTOMER_COLUMNS, *sequence), "customer_customer_id", sequence
        ).select(*schemas.CUSTOMER_COLUMNS),
        "orders": dedup.last_by_sequence(
            log.select(*schemas.ORDER_COLUMNS, *sequence), "order_id", sequence
        ).select(*schemas.ORDER_COLUMNS),
        # Accepted events are unique by construction.
        "events": log.select(*schemas.EVENT_COLUMNS),
        "predictions": read_log(spark, root, PREDICTIONS).select(*schemas.PREDICTION_COLUMNS),
    }


#: Good messages of a batch lie in so many parts by the hash of their event, and are compared with each other about so many at a time:
#: what is shuffled at once does not grow with the batch.
PARTS, PART_ROWS = 16, 8_000_000
#: The parts are written side by side, without a sort of whole messages before.
_SIDE_BY_SIDE = {"spark.sql.maxConcurrentOutputFileWriters": str(PARTS + 1)}


@dataclass
class ScoringJob:
    """What happens to every micro-batch.

    ``arrival`` orders messages inside a batch: the first message of an event is
    kept, later copies are dropped, also across batches.
    """

    root: str
    pipeline: PipelineModel
    arrival: Iterable[str] = ("broker_time", "value")
    against_history: bool = True
    stream_price: bool = False
    id_buckets: int = id_index.BUCKETS

    @property
    def ids(self) -> id_index.IdIndex:
        return id_index.IdIndex(f"{self.root}/ids", "event_id", self.id_buckets)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bad, good = Observation(), Observation()
        # Parsed and counted in one pass that writes both sides: nothing is held in memory, whatever the size of the batch.
        seen = messages.observe_refused(messages.inspect(batch), bad)
        seen = seen.observe(good, F.count_if(F.col("reason").isNull()).alias("good"))
        keep = list(dict.fromkeys(["broker_time", "value", *self.arrival]))
        rows = messages.to_clean(seen, stream_price=self.stream_price, keep=[*keep, "reason"])
        part = F.when(F.col("reason").isNull(), id_index.bucket_of(F.col("event_id"), PARTS)).otherwise(0)
        rows = rows.withColumns({"refused": F.col("reason").isNotNull(), "part": part})
        with stage_scope(spark):
            path = shared_dir(spark, "inspected")
            with settings(spark, _SIDE_BY_SIDE):
                rows.write.option("compression", "zstd").partitionBy("refused", "part").parquet(path)
            written = spark.read.schema(rows.schema).parquet(path)
            self._write(written.where("refused").select("value", "reason"), REJECTED, batch_id)
            steps = min(PARTS, max(1, -(-good.get["good"] // PART_ROWS)))
            for step in range(steps):
                some = written.where(~F.col("refused") & (F.col("part") % steps == step))
                self._write(self._fresh(spark, some, batch_id), ACCEPTED, batch_id, "append" if step else "overwrite")
        counts = spark.createDataFrame([messages.intake_counts(bad.get, good.get)], _LOG_SCHEMAS[INTAKE])
        self._write(counts.coalesce(1), INTAKE, batch_id)
        # From here on the batch is read back from its own files.
        rows = self._partition(spark, ACCEPTED, batch_id)
        if self.against_history:
            self.ids.append(rows, batch_id)
            self.ids.compact(spark, batch_id)
        # The batch's own rows are its events, orders and customers: every reference is met.
        self._write(score_returns(self.pipeline, rows).select(*schemas.PREDICTION_COLUMNS), PREDICTIONS, batch_id)

    def _fresh(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> DataFrame:
        """Clean rows of events met for the first time."""
        first = dedup.first_per_key(rows, "event_id", [F.col(c).asc() for c in self.arrival])
        first = first.withColumnRenamed("broker_time", "arrived").select(*_LOG_SCHEMAS[ACCEPTED].names)
        if not self.against_history or batch_id == 0:
            return first
        self._index_log(spark, batch_id)
        # Earlier batches only: a retried batch must not meet its own first attempt.
        return first.join(self.ids.known(rows.select("event_id"), batch_id), "event_id", "left_anti").select(*first.columns)

    def _index_log(self, spark: SparkSession, batch_id: int) -> None:
        """An index for a log that was written without one (once)."""
        if files.exists(spark, self.ids.path) or not files.exists(spark, f"{self.root}/{ACCEPTED}"):
            return
        earlier = read_log(spark, self.root, ACCEPTED).where(F.col("batch_id") < batch_id)
        self.ids.append_range(earlier, 0, batch_id - 1)

    def _write(self, df: DataFrame, name: str, batch_id: int, mode: str = "overwrite") -> None:
        with settings(df.sparkSession, DROP_SHUFFLES):
            df.write.mode(mode).parquet(f"{self.root}/{name}/batch_id={batch_id}")

    def _partition(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame:
        return spark.read.schema(_LOG_SCHEMAS[name]).parquet(f"{self.root}/{name}/batch_id={batch_id}")


def repair_predictions(
    spark: SparkSession, root: str, pipeline: PipelineModel, tables: Mapping[str, DataFrame] | None = None
) -> dict[str, int]:
    """Score the accepted events that have no prediction, and store those whose references exist.

    A prediction is lost when the scoring of a batch fails after its events were stored.  References are checked against ``tables`` (customers,
    orders, events: the stored star; by default the views over the log).  Repaired predictions go to a batch of their own (-1, -2, ...), and
    what is refused to a log with one reason a row.  Run it again and nothing is left to do.
    """
    tables = tables or star_tables(spark, root)
    done = read_log(spark, root, PREDICTIONS)
    lost = relational.anti_new(read_log(spark, root, ACCEPTED), done, "event_id")
    lost = lost.join(read_log(spark, root, REFUSED).select("event_id"), "event_id", "left_anti")
    with stage_scope(spark):
        scored = score_returns(pipeline, lost).select(*schemas.PREDICTION_COLUMNS)
        scored = materialise(scored, "lost_predictions")
        valid = relational.valid_references(scored, tables).select(*schemas.PREDICTION_COLUMNS)
        orphans = relational.orphans(scored, tables)
        counts = {"repaired": valid.count(), "refused": orphans.select("event_id").distinct().count()}
        names = [n for log in (PREDICTIONS, REFUSED) for n in files.list_names(spark, f"{root}/{log}") if n.startswith("batch_id=")]
        number = min([0, *(int(n.removeprefix("batch_id=")) for n in names)]) - 1
        if any(counts.values()):
            orphans.write.mode("overwrite").parquet(f"{root}/{REFUSED}/batch_id={number}")
            valid.write.mode("overwrite").parquet(f"{root}/{PREDICTIONS}/batch_id={number}")
    return counts


def start(
    stream: DataFrame,
    job: ScoringJob,
    checkpoint: str,
    drain: bool = True,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Run the job on a message stream.

    ``drain`` works off what is there and stops; otherwise the query keeps running.
    Progress lives in ``checkpoint``, so a restart goes on where the last one ended.
    """
    writer = stream.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=interval)
    return writer.start()


def bounded_dedup(stream: DataFrame, delay: str, value: str = "value") -> DataFrame:
    """Drop repeated events inside a time window, with state bounded by the watermark.

    An alternative to comparing with the whole history, for streams whose copies
    arrive close together; use it with ``against_history=False``.  Messages are
    checked first: a refused one never hides a good one of the same event, and
    only equal refused ones count as repeats.  Ids are compared as they are stored.
    """
    checked = messages.inspect(stream, value)
    event = F.concat(F.lit("event "), text.strip(F.col("parsed.fields.event_id")))
    key = F.when(F.col("reason").isNull(), event).otherwise(F.concat(F.lit("refused "), F.coalesce(value, F.lit(""))))
    return (
        checked.withColumn("dedup_key", key)
        .select(*stream.columns, "dedup_key")
        .withWatermark("broker_time", delay)
        .dropDuplicatesWithinWatermark(["dedup_key"])
        .drop("dedup_key")
    )

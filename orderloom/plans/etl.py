"""The batch pipeline from raw files to clean set, star and reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from orderloom import schemas
from orderloom.operators import clean as cleaning
from orderloom.operators import profile, relational
from orderloom.session import materialise, stage_scope
from orderloom.sources import files, snapshots


def clean_batch(nested: DataFrame, ties=()) -> DataFrame:
    """Clean rows of one raw batch.

    The deduplicated rows are written once: the imputation statistics and the rows
    themselves are then read from that copy instead of repeating scan and shuffle.
    Without ``ties`` all columns decide between rows of one event and time, so the
    row kept never depends on the order of arrival.
    """
    flat = cleaning.typed(cleaning.normalize_text(cleaning.flatten(nested)))
    ties = list(ties) or [c for c in flat.columns if c not in ("event_id", "event_time")]
    deduped = materialise(cleaning.dedupe(flat, ties), "dedup")
    return cleaning.clean_columns(cleaning.derive(cleaning.impute(deduped)))


@dataclass
class EtlResult:
    clean: DataFrame
    exports: dict[str, str]
    star_counts: dict[str, int] | None
    line_counts: dict[str, int] | None = None


def run(
    spark: SparkSession,
    raw_path: str,
    root: str,
    star: bool = True,
    export: bool = True,
    tolerant: bool = False,
    on_null: str = "fail",
    report: bool = False,
) -> EtlResult:
    """Read a raw JSON file or folder, clean it, merge it into the stored set.

    ``root/clean`` and ``root/star`` hold versioned tables of which a batch rewrites the buckets it touches,
    ``root/export/<version>`` the CSV, Parquet and JSON copies of that version.  A tolerant read skips broken lines and
    counts them on the way; ``on_null`` says what happens to rows that the star cannot take, and ``report`` adds a description of the set.
    """
    if not files.exists(spark, raw_path):
        raise FileNotFoundError(raw_path)
    lines = Observation() if tolerant else None
    nested = files.read_json_tolerant(spark, raw_path, lines) if lines else files.read_raw_events(spark, raw_path)
    counts = None
    with stage_scope(spark):
        batch = materialise(clean_batch(nested), "batch")
        merged = snapshots.upsert_clean(spark, f"{root}/clean", batch)
        if star:
            # The star gets the batch; newer rows win, as if the merged set had been ingested.
            counts = snapshots.ingest_star(spark, f"{root}/star", batch, newest_wins=True, on_null=on_null)
    version = snapshots.latest(spark, f"{root}/clean")
    exports = {}
    if export:
        ordered = relational.newest_first(merged.select(*[f.name for f in schemas.CLEAN.fields]))
        exports = files.export_clean(ordered, f"{root}/export/v={version}")
    if report:
        describe(merged, f"{root}/report/v={version}")
    return EtlResult(merged, exports, counts, lines and dict(lines.get))


def describe(clean: DataFrame, root: str) -> None:
    """The numeric and categorical description of a clean set, as CSV."""
    numeric = profile.describe_numeric(clean, schemas.NUMERIC_COLUMNS)
    text = [*schemas.ID_COLUMNS, *schemas.CATEGORY_COLUMNS, "order_is_returned"]
    files.write_report(numeric, f"{root}/describe_numeric")
    files.write_report(profile.describe_categorical(clean, text), f"{root}/describe_categorical")

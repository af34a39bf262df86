"""Keys, upserts, referential checks and the star schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.functions.numeric import to_number
from orderloom.operators import dedup, project


def any_null(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


# ---- star schema -----------------------------------------------------------


def _newest(clean: DataFrame, columns: Iterable[str], key: str, ties: Iterable[str], as_of: str | None) -> DataFrame:
    """The columns of each key's newest event; ``as_of`` names a column for that event's time."""
    columns, time = list(columns), F.col("event_time")
    needed = list(dict.fromkeys([*columns, "event_time", *ties]))
    first = dedup.latest_per_key(clean.select(*needed), key, "event_time", ties)
    return first.select(*columns, *([time.alias(as_of)] if as_of else []))


def customers(clean: DataFrame, ties: Iterable[str] = ("event_id",), as_of: str | None = None) -> DataFrame:
    """One row per customer: the first met in newest-first order."""
    return _newest(clean, schemas.CUSTOMER_COLUMNS, "customer_customer_id", ties, as_of)


def orders(clean: DataFrame, ties: Iterable[str] = ("event_id",), as_of: str | None = None) -> DataFrame:
    """One row per order: the first met in newest-first order."""
    return _newest(clean, schemas.ORDER_COLUMNS, "order_id", ties, as_of)


def events(clean: DataFrame, ties: Iterable[str] = (), as_of: str | None = None) -> DataFrame:
    """One row per event."""
    return _newest(clean, schemas.EVENT_COLUMNS, "event_id", ties, as_of)


def star(clean: DataFrame, as_of: str | None = None) -> dict[str, DataFrame]:
    return {name: build(clean, as_of=as_of) for name, build in (("customers", customers), ("orders", orders), ("events", events))}


def star_wide(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Events with their order, customer and (if scored) prediction."""
    o, c, e = tables["orders"], tables["customers"], tables["events"]
    wide = e.drop("customer_customer_id").join(o, "order_id").join(c, "customer_customer_id")
    if "predictions" in tables:
        wide = wide.join(tables["predictions"].select("event_id", "return_proba"), "event_id", "left")
    return wide


def one_to_many(parents: DataFrame, children: DataFrame, key: str, child_id: str) -> DataFrame:
    """Each parent followed by its children in child-id order, one row per child.

    Rows stay flat: the sort is by (parent, child), so a parent with a huge number
    of children is spread over several sorted partitions instead of becoming one
    array in one task.
    """
    return parents.join(children, key).orderBy(key, child_id)


# ---- upserts ---------------------------------------------------------------


def anti_new(incoming: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key is not stored yet."""
    return incoming.join(stored.select(key), key, "left_anti")


def pk_upsert(
    stored: DataFrame,
    incoming: DataFrame,
    key: str,
    order_col: str | None = None,
) -> DataFrame:
    """Incoming rows replace stored rows with the same key; new keys are added.

    ``incoming`` has unique keys.  By default the incoming row always wins; with
    ``order_col`` the newer of both rows does (incoming on equal times).
    """
    if order_col is None:
        return incoming.unionByName(stored.join(incoming.select(key), key, "left_anti").select(*incoming.columns))
    both = stored.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)))
    order = [F.col(order_col).desc_nulls_last(), F.col("__new").desc()]
    return dedup.first_per_key(both, key, order).drop("__new")


def upsert_counts(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """How many incoming keys are new and how many replace a stored row."""
    known = stored.select(key).distinct().withColumn("__known", F.lit(True))
    flagged = incoming.select(key).distinct().join(known, key, "left")
    return flagged.agg(
        F.count_if(F.col("__known").isNull()).alias("inserted"),
        F.count_if(F.col("__known")).alias("updated"),
    )


def handled_keys(clean: DataFrame) -> DataFrame:
    """Distinct customers, orders and events of a batch (missing ids count as one key)."""

    def distinct(c: str) -> Column:
        return F.countDistinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))

    return clean.agg(
        distinct("customer_customer_id").alias("customers_upserted"),
        distinct("order_id").alias("orders_upserted"),
        distinct("event_id").alias("events_upserted"),
    )


def snapshot_upsert(
    stored: DataFrame | None,
    incoming: DataFrame,
    key: str = "event_id",
    order_col: str = "event_time",
    ties: Iterable[str] = (),
    sequence: Iterable[str] = (),
    within: Iterable[str] = (),
) -> DataFrame:
    """Merge a batch into the stored set and keep the newest row per key.

    Columns are aligned on the sorted union.  Without the time column the last
    row by ``sequence`` wins.  On equal times the incoming row wins.  ``within`` names columns that
    follow from the key (its bucket): the rows are dealt by them, and stay so for the write.
    """
    merged = incoming if stored is None else project.align_union(
        stored.withColumn("__batch", F.lit(0)), incoming.withColumn("__batch", F.lit(1))
    )
    if stored is None:
        merged = merged.withColumn("__batch", F.lit(1))
    project.require_columns(merged, [key], "upsert")
    within = list(within)
    if within:
        merged = merged.repartition(*within)
    keys = [*within, key]
    if order_col in merged.columns:
        order = [F.col(order_col).desc_nulls_last(), F.col("__batch").desc(), *[F.col(t).asc() for t in ties]]
        latest = dedup.first_per_key(merged, keys, order)
    else:
        latest = dedup.last_by_sequence(merged, keys, ["__batch", *sequence])
    return latest.drop("__batch")


def insert_rows(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """Plain append by column name."""
    return stored.unionByName(rows)


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE; an unknown condition leaves the row as it is."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE ... WHERE; an unknown condition keeps the row."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def lookup(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


# ---- constraints -----------------------------------------------------------

PREDICTION_REFERENCES = {
    "event_id": "events",
    "order_id": "orders",
    "customer_customer_id": "customers",
}


def valid_references(rows: DataFrame, tables: Mapping[str, DataFrame], refs: Mapping[str, str] = PREDICTION_REFERENCES) -> DataFrame:
    """Rows whose every foreign key exists (one semi join per key on the key column only)."""
    for column, name in refs.items():
        rows = rows.join(tables[name].select(column), column, "left_semi")
    return rows


def orphans(rows: DataFrame, tables: Mapping[str, DataFrame], refs: Mapping[str, str] = PREDICTION_REFERENCES) -> DataFrame:
    """Rows with a dangling foreign key, once per reason; a missing key dangles.  The rows are read once."""
    found = rows
    for column, name in refs.items():
        keys = tables[name].select(F.col(column).alias(f"__{column}")).distinct()
        found = found.join(keys, F.col(column) == F.col(f"__{column}"), "left")
    reasons = [F.when(F.col(f"__{column}").isNull(), F.lit(f"unknown {column}")) for column in refs]
    return found.select(*rows.columns, F.explode(F.array_compact(F.array(*reasons))).alias("reason"))


def not_null_violations(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows breaking NOT NULL, with the names of the offending columns."""
    columns = list(columns or df.columns)
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.where(any_null(columns)).withColumn("null_columns", F.concat_ws(",", names))


def enforce_not_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """The frame unchanged, failing the job that reads a row with a missing value."""
    columns = list(columns or df.columns)
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.raise_error(F.lit(f"NOT NULL violated: {c}")).cast(df.schema[c].dataType))
            for c in columns
        }
    )


def split_not_null(df: DataFrame, columns: Iterable[str] | None = None) -> tuple[DataFrame, Observation]:
    """Rows with ``verdict`` (``valid``, or ``quarantine`` for a missing value) and ``null_columns``, and their counts.

    The counts are of the pass that first reads the rows: nothing is scanned for them.
    """
    columns = list(columns or df.columns)
    counts = Observation()
    bad = any_null(columns)
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    seen = df.observe(counts, F.count_if(~bad).alias("valid"), F.count_if(bad).alias("quarantine"))
    return seen.withColumns({"null_columns": F.when(bad, names), "verdict": F.when(bad, "quarantine").otherwise("valid")}), counts


def predictions_for_upsert(
    rows: DataFrame, tables: Mapping[str, DataFrame], validate: bool = True, ties: Iterable[str] = ()
) -> DataFrame:
    """Numeric, referentially valid predictions, first one per event."""
    project.require_columns(rows, schemas.PREDICTION_COLUMNS, "predictions")
    rows = rows.withColumn("return_proba", to_number(F.col("return_proba").cast("string")))
    if validate:
        rows = valid_references(rows, tables)
    ties = list(ties) or ["order_id", "customer_customer_id", "return_proba"]
    first = dedup.first_per_key(rows, "event_id", [F.col(t).asc() for t in ties])
    return first.select(*schemas.PREDICTION_COLUMNS)


# ---- ordering --------------------------------------------------------------


def newest_first(df: DataFrame, time_col: str = "event_time", ties: Iterable[str] = ("event_id",)) -> DataFrame:
    """Full sort for exports, missing times last."""
    return df.orderBy(F.col(time_col).desc_nulls_last(), *[F.col(t).asc() for t in ties])


def top_rows(df: DataFrame, order: Iterable[Column], n: int) -> DataFrame:
    """ORDER BY ... LIMIT n (a per-task top-n, never a full sort)."""
    return df.orderBy(*order).limit(n)

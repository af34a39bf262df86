"""Projections and schema operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import schemas
from orderloom.operators.reshape import rows_from

TYPE_CLASSES = {
    "number": (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType, T.FloatType, T.DecimalType),
    "bool": (T.BooleanType,),
    "text": (T.StringType,),
    "time": (T.TimestampType, T.TimestampNTZType, T.DateType),
}


def columns_by_type(df: DataFrame, *classes: str) -> list[str]:
    """Names of the columns whose type falls in one of the classes."""
    wanted = tuple(t for c in classes for t in TYPE_CLASSES[c])
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


def select_types(df: DataFrame, *classes: str) -> DataFrame:
    return df.select(*columns_by_type(df, *classes))


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    """Fail before any job runs, naming the missing columns."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise KeyError(f"{what}: missing columns {missing}; available {df.columns}")
    return df


def align_union(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """UNION ALL on the sorted union of columns, gaps filled with NULL."""
    columns = sorted(set(existing.columns) | set(incoming.columns))
    return existing.unionByName(incoming, allowMissingColumns=True).select(*columns)


def align_features(df: DataFrame, features: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """Exactly ``features`` in order: absent ones are 0.0, extra ones dropped."""
    present = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in present else F.lit(0.0).alias(c) for c in features])


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; ignore the others."""
    return df.withColumnsRenamed(dict(names))


def drop_identifiers(df: DataFrame) -> DataFrame:
    """Remove ids and the time stamp before modelling."""
    return df.drop(*schemas.ID_COLUMNS, "event_time")


def model_features(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """The raw model inputs of clean rows."""
    return df.select(*keep, *schemas.MODEL_FEATURES)


def evolve(
    df: DataFrame,
    add: Mapping[str, Column] | None = None,
    retype: Mapping[str, str] | None = None,
    rename: Mapping[str, str] | None = None,
    drop: Iterable[str] = (),
) -> DataFrame:
    """ALTER TABLE as a projection: add (with default), retype, rename, drop columns."""
    out = df.withColumns(dict(add or {}))
    out = out.withColumns({c: F.col(c).try_cast(t) for c, t in (retype or {}).items()})
    return out.withColumnsRenamed(dict(rename or {})).drop(*drop)


def column_report(df: DataFrame) -> DataFrame:
    """Per column: position, type and number of non-missing values, in one pass."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    return rows_from(
        counts,
        [
            {
                "position": F.lit(i),
                "column": F.lit(f.name),
                "data_type": F.lit(f.dataType.simpleString()),
                "non_null": F.col(f.name),
            }
            for i, f in enumerate(df.schema.fields)
        ],
    )

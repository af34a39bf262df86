"""From raw nested events to the 19-column clean set."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import schemas
from orderloom.functions import numeric, orders, temporal, text
from orderloom.operators import dedup, ranks
from orderloom.operators.reshape import scalar_struct

# Fixed value: the country given to customers without one.
UNKNOWN_COUNTRY = "UN"


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Replace struct columns by ``{column}_{field}`` columns, appended at the end."""

    def leaves(prefix: str, dtype: T.StructType, name: str) -> list[Column]:
        out = []
        for field in dtype.fields:
            path, alias = f"{prefix}.`{field.name}`", f"{name}{separator}{field.name}"
            if isinstance(field.dataType, T.StructType):
                out += leaves(path, field.dataType, alias)
            else:
                out.append(F.col(path).alias(alias))
        return out

    flat = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.StructType)]
    nested = [
        leaf
        for f in df.schema.fields
        if isinstance(f.dataType, T.StructType)
        for leaf in leaves(f"`{f.name}`", f.dataType, f.name)
    ]
    return df.select(*flat, *nested)


def normalize_text(df: DataFrame) -> DataFrame:
    """Strip ids and categories; categories in lower case, countries in upper case."""
    rules = {c: text.strip for c in schemas.ID_COLUMNS}
    rules |= {c: text.strip_lower for c in schemas.LOWER_COLUMNS}
    rules["customer_country"] = text.strip_upper
    return df.withColumns({c: rule(F.col(c).cast("string")) for c, rule in rules.items() if c in df.columns})


def typed(df: DataFrame, schema: T.StructType = schemas.EVENT) -> DataFrame:
    """Cast the columns named in ``schema``; a value that does not fit becomes NULL."""
    wanted = {f.name: f.dataType for f in schema.fields}

    def cast(name: str) -> Column:
        source = df.schema[name].dataType
        target = wanted.get(name)
        if target is None or source == target:
            return F.col(name)
        if isinstance(target, T.TimestampType) and isinstance(source, T.StringType):
            return temporal.parse_time_or_epoch(F.col(name)).alias(name)
        if isinstance(target, T.TimestampType) and isinstance(source, T.TimestampNTZType):
            return F.col(name)
        return F.col(name).try_cast(target).alias(name)

    return df.select(*[cast(c) for c in df.columns])


def drop_missing(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Keep only rows without a missing value."""
    return df.na.drop(subset=list(subset) if subset else None)


_MEDIANS = ("order_n_items", "order_basket_value")


def imputation(df: DataFrame) -> dict[str, str | float | None]:
    """What fills the gaps of ``df``: modes and exact medians, one value a column."""
    return ranks.modes_row(df, schemas.LOWER_COLUMNS).first().asDict() | ranks.medians(df, _MEDIANS)


def impute(df: DataFrame, values: Mapping[str, str | float | None] | None = None) -> DataFrame:
    """Fill the gaps: fixed country, zero amounts, modes and exact medians.

    The statistics are ``values`` (see ``imputation``), or two scalar subqueries over ``df``.  Pass a frame that reads
    a written table when ``df`` is expensive (see ``plans.etl``).
    """
    if values is None:
        mode = scalar_struct(ranks.modes_row(df, schemas.LOWER_COLUMNS))
        median = scalar_struct(ranks.medians_row(df, _MEDIANS))
        found = {c: mode[c] for c in schemas.LOWER_COLUMNS} | {c: median[c] for c in _MEDIANS}
    else:
        found = {c: F.lit(values[c]).cast("double" if c in _MEDIANS else "string") for c in (*schemas.LOWER_COLUMNS, *_MEDIANS)}
    fills = {c: F.coalesce(F.col(c), found[c]) for c in schemas.LOWER_COLUMNS}
    fills["customer_country"] = F.coalesce("customer_country", F.lit(UNKNOWN_COUNTRY))
    fills |= {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("order_shipping_fee", "order_discount")}
    fills["order_n_items"] = F.coalesce(F.col("order_n_items"), F.bround(found["order_n_items"]).cast("bigint"))
    fills["order_basket_value"] = F.coalesce(F.col("order_basket_value"), found["order_basket_value"])
    return df.withColumns(fills)


def derive(df: DataFrame) -> DataFrame:
    """Add calendar parts and the unit price."""
    price = orders.price_per_item(F.col("order_basket_value"), F.col("order_n_items"))
    return df.withColumns(
        temporal.time_parts(F.col("event_time")) | {"price_average_per_item": price}
    )


def dedupe(df: DataFrame, ties: Iterable[str] = ()) -> DataFrame:
    """Newest row per event.  Exact copies fall together with their key."""
    return dedup.latest_per_key(df, "event_id", "event_time", ties)


def clean_columns(df: DataFrame) -> DataFrame:
    return df.select(*[f.name for f in schemas.CLEAN.fields])


def clean_events(flat: DataFrame, ties: Iterable[str] = ()) -> DataFrame:
    """The whole chain on flat events, as one lazy plan."""
    return clean_columns(derive(impute(dedupe(typed(normalize_text(flat)), ties))))


def to_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: numeric.to_number(F.col(c)) for c in columns})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating-point column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: numeric.nan_to_null(F.col(c)) for c in floats})

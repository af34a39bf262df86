"""Broker messages: tolerant parsing, validation and normalisation.

The same functions serve the registered queries, the batch reader of JSON lines
and the stream.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.functions import messages as m
from orderloom.functions import orders, temporal, text

# What an absent field stands for.
TEXT_DEFAULT = "unknown"
COUNT_DEFAULT = 0
AMOUNT_DEFAULT = 0.0
RETURNED_DEFAULT = False

BLANK, NOT_JSON, NOT_OBJECT = "blank line", "invalid JSON", "not an object"

#: How the messages of a batch went: as the publisher counts its lines, and how many of those sent were refused or accepted.
INTAKE_COUNTS = ("sent", "skipped_empty", "skipped_invalid_json", "refused", "good")


def _parse(lines: DataFrame, value: str) -> DataFrame:
    """Add ``line`` (stripped) and ``parsed`` {fields, valid}.

    The one-element explode keeps both parses in one place: without it later
    filters and projections would each repeat them.
    """
    fields = ", ".join(f"`{name}` string" for name in schemas.MESSAGE_FIELDS)
    parsed = F.struct(
        F.from_json("line", fields).alias("fields"), m.is_valid_json(F.col("line")).alias("valid")
    )
    stripped = lines.withColumn("line", text.strip(F.col(value)))
    return stripped.select("*", F.explode(F.array(parsed)).alias("parsed"))


def inspect(lines: DataFrame, value: str = "value", required: tuple[str, ...] = schemas.MESSAGE_REQUIRED) -> DataFrame:
    """Parse each line and say why it is refused.

    Adds ``line``, ``parsed``, ``missing`` (required keys that are absent or null,
    sorted) and ``reason`` (NULL for a good message).
    """
    rows = _parse(lines, value)
    valid = F.col("parsed.valid")
    is_object = valid & F.col("line").startswith("{")
    absent = [F.when(F.col(f"parsed.fields.{k}").isNull(), F.lit(k)) for k in sorted(required)]
    rows = rows.withColumn("missing", F.when(is_object, F.concat_ws(",", *absent)))
    reason = (
        F.when(F.coalesce(F.length("line"), F.lit(0)) == 0, F.lit(BLANK))
        .when(~valid, F.lit(NOT_JSON))
        .when(~is_object, F.lit(NOT_OBJECT))
        .when(F.col("missing") != "", F.concat(F.lit("missing "), F.col("missing")))
    )
    return rows.withColumn("reason", reason)


def line_counts(lines: DataFrame, value: str = "value") -> DataFrame:
    """Sent, blank and invalid lines, as the publisher counts them."""
    line = text.strip(F.col(value))
    blank = F.coalesce(F.length(line), F.lit(0)) == 0
    valid = m.is_valid_json(line)
    return lines.agg(
        F.count_if(~blank & valid).alias("sent"),
        F.count_if(blank).alias("skipped_empty"),
        F.count_if(~blank & ~valid).alias("skipped_invalid_json"),
    )


def observe_lines(lines: DataFrame, counts: Observation, value: str = "value") -> DataFrame:
    """The lines with ``line`` and ``valid``, counted like ``line_counts`` in the pass that first reads them.

    ``counts.get`` has the figures after that pass; it is no scan of its own.
    """
    checked = lines.withColumn("line", text.strip(F.col(value))).withColumn("valid", m.is_valid_json(F.col("line")))
    blank = F.coalesce(F.length("line"), F.lit(0)) == 0
    return checked.observe(
        counts,
        F.count_if(~blank & F.col("valid")).alias("sent"),
        F.count_if(blank).alias("skipped_empty"),
        F.count_if(~blank & ~F.col("valid")).alias("skipped_invalid_json"),
    )


def observe_refused(refused: DataFrame, counts: Observation) -> DataFrame:
    """Refused messages, counted by kind of reason in the pass that writes them."""
    reason = F.col("reason")
    return refused.observe(
        counts,
        F.count_if(reason == BLANK).alias("skipped_empty"),
        F.count_if(reason == NOT_JSON).alias("skipped_invalid_json"),
        F.count_if(~reason.isin(BLANK, NOT_JSON)).alias("refused"),
    )


def intake_counts(refused: Mapping[str, int], accepted: Mapping[str, int]) -> tuple[int, ...]:
    """``INTAKE_COUNTS`` of a batch from what its two passes observed; what is sent is refused or good."""
    good, bad = accepted["good"], refused["refused"]
    return good + bad, refused["skipped_empty"], refused["skipped_invalid_json"], bad, good


def payload(lines: DataFrame, value: str = "value", max_messages: int | None = None) -> DataFrame:
    """(key, value) rows to publish: valid lines, keyed by a textual non-blank event id."""
    good = lines.select(text.strip(F.col(value)).alias("value")).where(F.length("value") > 0)
    parsed = good.select("value", F.explode(F.array(m.document(F.col("value")))).alias("doc"))
    rows = parsed.where(F.col("doc").isNotNull()).select(m.text_key(F.col("doc"), "event_id").alias("key"), "value")
    return rows.limit(max_messages) if max_messages is not None else rows


def rejected(lines: DataFrame, value: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """Refused messages with the reason."""
    bad = inspect(lines, value).where(F.col("reason").isNotNull())
    return bad.select(*keep, value, "reason")


def _field(name: str, dtype: str) -> Column:
    return F.col(f"parsed.fields.{name}").try_cast(dtype)


def to_clean(
    accepted: DataFrame,
    broker_time: str = "broker_time",
    now: bool = True,
    stream_price: bool = True,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Inspected messages to clean rows.

    A missing, null or unreadable field takes its default.  ``stream_price`` uses
    total / max(items, 1) for the unit price; otherwise the batch formula applies,
    and the former where it has no value (no items): the price is never missing.
    """
    e: dict[str, Column] = {c: text.strip(_field(c, "string")) for c in schemas.ID_COLUMNS}
    e["event_time"] = temporal.event_time_with_fallback(_field("event_time", "string"), F.col(broker_time), now)
    e["customer_country"] = F.coalesce(text.strip_upper(_field("customer_country", "string")), F.lit(TEXT_DEFAULT))
    for c in schemas.LOWER_COLUMNS:
        e[c] = F.coalesce(text.strip_lower(_field(c, "string")), F.lit(TEXT_DEFAULT))
    e["order_n_items"] = F.coalesce(_field("order_n_items", "double").try_cast("bigint"), F.lit(COUNT_DEFAULT))
    for c in schemas.MONEY_COLUMNS:
        e[c] = F.coalesce(_field(c, "double"), F.lit(AMOUNT_DEFAULT))
    e["order_is_returned"] = F.coalesce(_field("order_is_returned", "boolean"), F.lit(RETURNED_DEFAULT))
    flat = accepted.select(*keep, *[e[f.name].alias(f.name) for f in schemas.EVENT.fields])
    items = F.col("order_n_items")
    price = orders.price_per_item_stream(F.col("order_order_total"), items)
    if not stream_price:
        price = F.coalesce(orders.price_per_item(F.col("order_basket_value"), items), price)
    timed = flat.withColumns(temporal.time_parts(F.col("event_time")) | {"price_average_per_item": price})
    return timed.select(*keep, *[f.name for f in schemas.CLEAN.fields])

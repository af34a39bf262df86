"""Files, snapshots, the batch pipeline, messages and the stream."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.operators import messages, relational
from orderloom.plans import etl
from orderloom.sources import files, snapshots
from orderloom.streaming import scoring, sources
from tests.test_ml import clean_rows


def raw_event(event_id, time, order="ORD-1", customer="CUST-1", **order_fields):
    order_values = {
        "device": " Mobile ", "channel": "SEO", "main_category": "fashion", "n_items": 2, "basket_value": 40.0,
        "shipping_fee": 5.0, "discount": None, "order_total": 45.0, "is_returned": 0, **order_fields,
    }
    return {
        "event_id": event_id, "event_time": time, "order_id": order,
        "customer": {"customer_id": customer, "country": "fr"}, "order": order_values,
    }


def write_lines(path, events):
    path.write_text("\n".join(e if isinstance(e, str) else json.dumps(e) for e in events) + "\n")
    return str(path)


FIRST = [
    raw_event("a", "2026-01-01T10:00:00Z"),
    raw_event("a", "2026-01-02T10:00:00Z", n_items=4, order_total=46.0),
    raw_event("a", "2026-01-02T10:00:00Z", n_items=4, order_total=46.0),
    raw_event("b", "2026-01-01T09:00:00Z", order="ORD-2", customer="CUST-2", channel=None, n_items=0),
    raw_event("c", "2026-01-01T08:00:00Z", order="ORD-3", channel="SEO"),
]
SECOND = [
    raw_event("a", "2025-12-31T00:00:00Z", n_items=9),
    raw_event("c", "2026-02-01T08:00:00Z", order="ORD-3", is_returned=1),
    raw_event("d", "2026-02-01T09:00:00Z", order="ORD-4", customer="CUST-1"),
]


def test_batch_pipeline_end_to_end(spark, tmp_path, as_rows):
    root = str(tmp_path / "store")
    first = etl.run(spark, write_lines(tmp_path / "one.jsonl", FIRST), root, star=False)
    got = {r["event_id"]: r for r in first.clean.collect()}
    assert sorted(got) == ["a", "b", "c"]
    assert sorted(first.clean.columns) == sorted(f.name for f in schemas.CLEAN.fields)
    a = got["a"]
    assert (a["order_device"], a["customer_country"], a["order_channel"], a["order_n_items"]) == ("mobile", "FR", "seo", 4)
    assert (a["order_discount"], a["event_day"], a["event_hour"], a["price_average_per_item"]) == (0.0, 2, 10, 10.0)
    assert got["b"]["order_channel"] == "seo" and got["b"]["price_average_per_item"] is None

    # The CSV copy reads back to the same rows, and JSON carries ISO times.
    back = files.read_clean_csv(spark, first.exports["csv"])
    assert as_rows(back) == as_rows(spark.read.parquet(first.exports["parquet"]))
    assert '"event_time":"2026-01-02T10:00:00.000Z"' in "".join(r.value for r in spark.read.text(first.exports["jsonl"]).collect())


def test_description_of_the_set(spark, tmp_path):
    result = etl.run(spark, write_lines(tmp_path / "one.jsonl", FIRST), str(tmp_path / "store"), star=False, export=False, report=True)
    numeric = spark.read.option("header", True).csv(str(tmp_path / "store/report/v=1/describe_numeric"))
    text = spark.read.option("header", True).csv(str(tmp_path / "store/report/v=1/describe_categorical"))
    assert {r["column"] for r in numeric.collect()} == set(schemas.NUMERIC_COLUMNS)
    ids = {r["column"]: r for r in text.collect()}["event_id"]
    assert int(ids["n_values"]) == int(ids["n_unique"]) == result.clean.count() == 3


def test_large_database_tables_are_read_in_parallel():
    files.require_partitioning(files.SMALL_TABLE, "orders")
    with pytest.raises(ValueError, match="partition column"):
        files.require_partitioning(files.SMALL_TABLE + 1, "orders")


def test_missing_unit_price_blocks_the_star_and_leaves_it_untouched(spark, tmp_path):
    root = str(tmp_path / "store")
    good = [e for e in FIRST if e["event_id"] != "b"]
    result = etl.run(spark, write_lines(tmp_path / "ok.jsonl", good), root, export=False)
    assert result.star_counts == {"customers_upserted": 1, "orders_upserted": 2, "events_upserted": 2}
    before = snapshots.latest(spark, f"{root}/star")
    with pytest.raises(PySparkException, match="NOT NULL violated"):
        etl.run(spark, write_lines(tmp_path / "bad.jsonl", FIRST), root, export=False)
    assert snapshots.latest(spark, f"{root}/star") == before
    assert snapshots.read(spark, f"{root}/star", "events").count() == 2


def test_second_batch_upserts_and_repeats_are_harmless(spark, tmp_path, as_rows):
    root = str(tmp_path / "store")
    good = [e for e in FIRST if e["event_id"] != "b"]
    etl.run(spark, write_lines(tmp_path / "one.jsonl", good), root, export=False)
    path = write_lines(tmp_path / "two.jsonl", SECOND)
    merged = etl.run(spark, path, root, export=False).clean
    got = {r["event_id"]: r for r in merged.collect()}
    assert sorted(got) == ["a", "c", "d"]
    assert got["a"]["order_n_items"] == 4 and got["c"]["order_is_returned"] is True
    again = etl.run(spark, path, root, export=False).clean
    assert as_rows(again) == as_rows(merged)
    star = {t: snapshots.read(spark, f"{root}/star", t) for t in ("customers", "orders", "events")}
    assert {t: d.count() for t, d in star.items()} == {"customers": 1, "orders": 3, "events": 3}
    wide = relational.star_wide(star)
    assert wide.count() == 3 and "customer_country" in wide.columns

    predictions = spark.createDataFrame(
        [("a", "ORD-1", "CUST-1", "0.25"), ("zzz", "ORD-1", "CUST-1", "0.5")],
        "event_id string, order_id string, customer_customer_id string, return_proba string",
    )
    assert snapshots.ingest_predictions(spark, f"{root}/star", predictions) == {"predictions_upserted": 1}
    assert snapshots.ingest_predictions(spark, f"{root}/star", predictions.withColumn("return_proba", F.lit("0.75"))) == {"predictions_upserted": 1}
    assert as_rows(snapshots.read_predictions(spark, f"{root}/star").select("event_id", "return_proba")) == [("a", 0.75)]


def test_csv_columns_are_matched_by_name(spark, tmp_path, as_rows):
    rows = clean_rows(spark, 5).withColumn("event_time", F.lit("2026-01-01T00:00:00.000Z"))
    rows.select(*sorted(rows.columns)).write.option("header", True).csv(str(tmp_path / "c"))
    back = files.read_clean_csv(spark, str(tmp_path / "c"))
    assert back.columns == [f.name for f in schemas.CLEAN.fields]
    assert dict(back.dtypes)["order_is_returned"] == "boolean" and dict(back.dtypes)["event_time"] == "timestamp"
    assert as_rows(back.select("event_id", "order_n_items")) == as_rows(rows.select("event_id", "order_n_items"))


def test_equal_times_do_not_depend_on_arrival(spark, as_rows):
    events = [raw_event("a", "2026-01-01T10:00:00Z", device=d) for d in ("tablet", "desktop", "mobile")]
    lines = lambda es: spark.createDataFrame([(json.dumps(e),) for e in es], "v string").select(
        F.from_json("v", schemas.RAW).alias("e")
    ).select("e.*")
    one = as_rows(etl.clean_batch(lines(events)))
    assert one == as_rows(etl.clean_batch(lines(events[::-1]).repartition(3))) and len(one) == 1


def test_missing_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        etl.run(spark, str(tmp_path / "none.jsonl"), str(tmp_path / "x"))
    assert files.read_existing_clean(spark, str(tmp_path / "p"), str(tmp_path / "c")) is None


def test_existing_clean_prefers_parquet(spark, tmp_path):
    rows = clean_rows(spark, 3)
    rows.write.option("header", True).csv(str(tmp_path / "c"))
    assert files.read_existing_clean(spark, str(tmp_path / "p"), str(tmp_path / "c")).count() == 3
    rows.limit(2).write.parquet(str(tmp_path / "p"))
    assert files.read_existing_clean(spark, str(tmp_path / "p"), str(tmp_path / "c")).count() == 2


def test_tolerant_reader_skips_broken_lines(spark, tmp_path):
    path = write_lines(tmp_path / "mixed.jsonl", ["", "   ", "bad", '{"event_id": "x"', json.dumps(FIRST[0])])
    assert files.read_json_tolerant(spark, path).count() == 1
    counts = messages.line_counts(files.read_lines(spark, path)).first()
    assert tuple(counts) == (1, 2, 2)


def test_snapshot_ignores_unfinished_versions(spark, tmp_path):
    root = str(tmp_path / "s")
    assert snapshots.latest(spark, root) is None and snapshots.read(spark, root) is None
    snapshots.write(spark, root, {"data": spark.range(3)})
    spark.range(9).write.parquet(f"{root}/v=2/data")  # a write that died before its marker
    assert snapshots.read(spark, root).count() == 3
    assert snapshots.write(spark, root, {"data": spark.range(5)}) == 3
    assert snapshots.read(spark, root).count() == 5


# ---- messages --------------------------------------------------------------

GOOD = {"event_id": "e1", "order_id": "o1", "customer_customer_id": "c1", "event_time": "2026-01-01T05:00:00Z"}


def inspected(spark, *values):
    lines = [(v if isinstance(v, str) else json.dumps(v),) for v in values]
    df = spark.createDataFrame(lines, "value string").withColumn("broker_time", F.lit("2026-03-01 00:00:00").cast("timestamp"))
    return messages.inspect(df)


@pytest.mark.parametrize(
    "value, reason",
    [
        ("", "blank line"), (" \t", "blank line"), ("bad", "invalid JSON"), ('{"event_id": "x"', "invalid JSON"),
        ('{"a": 1} tail', "invalid JSON"), ("[1]", "not an object"), ("3", "not an object"), ('"text"', "not an object"),
        ("null", "not an object"),
        ("{}", "missing customer_customer_id,event_id,order_id"),
        ({**GOOD, "order_id": None}, "missing order_id"), (GOOD, None), ({**GOOD, "order_n_items": "many"}, None),
    ],
)
def test_reasons(spark, value, reason):
    assert inspected(spark, value).first()["reason"] == reason


def test_message_defaults(spark):
    row = messages.to_clean(inspected(spark, {**GOOD, "order_n_items": "many", "order_discount": None, "order_order_total": 9})).first()
    assert (row["customer_country"], row["order_device"], row["order_n_items"], row["order_discount"]) == ("unknown", "unknown", 0, 0.0)
    assert row["order_is_returned"] is False and row["price_average_per_item"] == 9.0 and row["event_hour"] == 5
    late = messages.to_clean(inspected(spark, {**GOOD, "event_time": None, "customer_country": " fr", "order_is_returned": True})).first()
    assert (late["event_month"], late["customer_country"], late["order_is_returned"]) == (3, "FR", True)


def test_payload_keys(spark, as_rows):
    lines = [('{"event_id": "e1"}',), ('{"event_id": 5}',), ('{"event_id": "  "}',), ("[1]",), ("",), ("bad",)]
    df = spark.createDataFrame(lines, "value string")
    assert [r[0] for r in as_rows(messages.payload(df))] == [None, None, None, "e1"]
    assert messages.payload(df, max_messages=2).count() == 2


# ---- stream ----------------------------------------------------------------


@pytest.fixture(scope="module")
def pipeline(spark):
    from orderloom.ml import models

    return models.fit_return_model(clean_rows(spark))[0]


def message(event_id, **fields):
    return json.dumps({**GOOD, "event_id": event_id, "order_id": f"o-{event_id}", "order_n_items": 2, "order_basket_value": 20.0,
                       "order_order_total": 20.0, "order_device": "Mobile", "order_main_category": "fashion", **fields})


def drain(spark, root, pipeline, inbox, **options):
    job = scoring.ScoringJob(f"{root}/out", pipeline, **options)
    stream = sources.from_text_files(spark, inbox, files_per_trigger=1)
    scoring.start(stream, job, f"{root}/checkpoint").awaitTermination()


def test_stream_across_batches_and_restart(spark, tmp_path, pipeline, as_rows):
    inbox, root = tmp_path / "inbox", str(tmp_path)
    inbox.mkdir()
    write_lines(inbox / "1.jsonl", [message("a"), message("b"), "bad", '{"event_id": "z"}'])
    write_lines(inbox / "2.jsonl", [message("b", order_basket_value=99.0), message("c"), message("c")])
    drain(spark, root, pipeline, str(inbox))
    out = f"{root}/out"
    log = scoring.read_log(spark, out, scoring.ACCEPTED)
    assert [r[0] for r in as_rows(log.select("event_id"))] == ["a", "b", "c"]
    assert log.select("batch_id").distinct().count() == 2
    assert as_rows(scoring.read_log(spark, out, scoring.REJECTED).select("reason")) == [
        ("invalid JSON",), ("missing customer_customer_id,order_id",),
    ]
    tables = scoring.star_tables(spark, out)
    assert {n: t.count() for n, t in tables.items()} == {"customers": 1, "orders": 3, "events": 3, "predictions": 3}
    assert tables["predictions"].where("return_proba between 0 and 1").count() == 3

    # A restart with nothing new changes nothing; one more file is one more batch.
    drain(spark, root, pipeline, str(inbox))
    assert scoring.read_log(spark, out, scoring.ACCEPTED).count() == 3
    write_lines(inbox / "3.jsonl", [message("a"), message("d")])
    drain(spark, root, pipeline, str(inbox))
    assert [r[0] for r in as_rows(scoring.read_log(spark, out, scoring.ACCEPTED).select("event_id"))] == ["a", "b", "c", "d"]


def test_retried_batch_replaces_its_own_output(spark, tmp_path, pipeline):
    job = scoring.ScoringJob(str(tmp_path / "out"), pipeline)
    batch = spark.createDataFrame([(message("a"),), (message("b"),)], "value string").withColumn("broker_time", F.current_timestamp())
    job(batch, 0)
    job(batch, 0)
    assert scoring.read_log(spark, job.root, scoring.ACCEPTED).count() == 2
    job(batch, 1)
    assert scoring.read_log(spark, job.root, scoring.ACCEPTED).count() == 2
    assert scoring.read_log(spark, job.root, scoring.PREDICTIONS).count() == 2


def test_stream_scores_like_batch(spark, tmp_path, pipeline, as_rows):
    from orderloom.ml.models import score_returns

    lines = [message(f"e{i}", order_basket_value=10.0 * i, order_order_total=10.0 * i) for i in range(1, 9)]
    df = spark.createDataFrame([(v,) for v in lines], "value string").withColumn("broker_time", F.current_timestamp())
    job = scoring.ScoringJob(str(tmp_path / "out"), pipeline)
    job(df, 0)
    rows = messages.to_clean(messages.inspect(df), stream_price=False)
    batch = score_returns(pipeline, rows).select(*schemas.PREDICTION_COLUMNS)
    assert as_rows(batch) == as_rows(scoring.read_log(spark, job.root, scoring.PREDICTIONS).drop("batch_id"))


def test_bounded_dedup_option(spark, tmp_path, pipeline):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    write_lines(inbox / "1.jsonl", [message("a"), message("a"), message("b"), "bad", "bad2"])
    job = scoring.ScoringJob(str(tmp_path / "out"), pipeline, against_history=False)
    stream = scoring.bounded_dedup(sources.from_text_files(spark, str(inbox)), "1 hour")
    scoring.start(stream, job, str(tmp_path / "cp")).awaitTermination()
    assert scoring.read_log(spark, job.root, scoring.ACCEPTED).count() == 2
    assert scoring.read_log(spark, job.root, scoring.REJECTED).count() == 2


def test_bad_then_good_copy_keeps_the_good_one(spark, tmp_path, pipeline):
    """In both modes a refused message does not hide a later good one of its event."""
    good = message("a")
    for mode in ("history", "bounded"):
        inbox = tmp_path / mode
        inbox.mkdir()
        write_lines(inbox / "1.jsonl", ['{"event_id": "a", "order_id": null}', good, message(" a ")])
        job = scoring.ScoringJob(str(tmp_path / f"out-{mode}"), pipeline, against_history=mode == "history")
        stream = sources.from_text_files(spark, str(inbox))
        stream = scoring.bounded_dedup(stream, "1 hour") if mode == "bounded" else stream
        scoring.start(stream, job, str(tmp_path / f"cp-{mode}")).awaitTermination()
        accepted = scoring.read_log(spark, job.root, scoring.ACCEPTED).collect()
        assert [r.event_id for r in accepted] == ["a"]
        assert all(r.price_average_per_item is not None for r in accepted)
        assert scoring.read_log(spark, job.root, scoring.REJECTED).count() == 1

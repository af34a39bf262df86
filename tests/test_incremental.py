"""What a batch touches, and what it leaves alone: id index, bucketed snapshots, current tables, counters, quarantine, repairs."""

import hashlib
import pathlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.operators import messages, relational
from orderloom.plans import etl
from orderloom.sources import files, id_index, snapshots
from orderloom.streaming import current, scoring, sources
from tests.test_ml import clean_rows
from tests.test_pipeline import FIRST, drain, message, pipeline, raw_event, write_lines  # noqa: F401

# ---- id index ----------------------------------------------------------------


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "event_id string")


def names(df):
    return sorted(r[0] for r in df.collect())


def scanned(df):
    """Files that the scans of a finished query read."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), {}

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name.startswith("Scan parquet"):
            found[str(node.relation().location().rootPaths())] = node.metrics().apply("numFiles").value()
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(plan)
    return found


def test_index_reads_the_touched_buckets_only(spark, tmp_path):
    index = id_index.IdIndex(str(tmp_path / "ids"), buckets=64)
    index.append(ids(spark, [f"e{i}" for i in range(2000)]), 0)
    there = len(list(pathlib.Path(index.path).glob("segment=0_0/bucket=*")))
    assert there == 64
    found = index.known(ids(spark, ["e7", "new", None, ""]), 1)
    assert names(found) == ["e7"]
    assert "dynamicpruning" in found._jdf.queryExecution().toString().lower()
    read = scanned(found)
    assert read and all(n <= 3 for n in read.values())  # a file each of the buckets of e7, new
    # A file of an untouched bucket may be unreadable: it is not opened.
    asked = {r[0] for r in ids(spark, ["e7", "new"]).select(id_index.bucket_of(F.col("event_id"), 64)).collect()}
    other = next(b for b in range(64) if b not in asked)
    for f in pathlib.Path(index.path).glob(f"segment=0_0/bucket={other}/*.parquet"):
        f.write_bytes(b"broken")
    assert names(index.known(ids(spark, ["e7", "new"]), 1)) == ["e7"]


def test_index_sees_earlier_batches_once(spark, tmp_path):
    index = id_index.IdIndex(str(tmp_path / "ids"), buckets=4, fan_in=3)
    assert names(index.known(ids(spark, ["a"]), 0)) == []
    for batch in range(10):
        index.append(ids(spark, [f"e{batch}", f"e{batch}", None]), batch)
        index.append(ids(spark, [f"e{batch}"]), batch)  # a second attempt
        assert f"e{batch}" not in names(index.known(ids(spark, [f"e{batch}"]), batch))
        index.compact(spark, batch)
    segments = index.segments(spark, 10)
    assert [(s.first, s.last) for s in segments] == [(0, 8), (9, 9)]
    everything = ids(spark, [f"e{i}" for i in range(12)])
    assert names(index.known(everything, 10)) == [f"e{i}" for i in range(10)]
    assert index.read(spark, segments).count() == 10
    # A merge that died before its sources went: the wider segment counts, once.
    index.append(ids(spark, ["e3"]), 3)
    assert [(s.first, s.last) for s in index.segments(spark, 10)] == [(0, 8), (9, 9)]
    # An unfinished segment does not count.
    (pathlib.Path(index.path) / "segment=9_9" / "_COMPLETE").unlink()
    assert "e9" not in names(index.known(everything, 10))


def test_stream_drops_late_copies_over_many_batches(spark, tmp_path, pipeline):  # noqa: F811
    inbox, root = tmp_path / "inbox", str(tmp_path)
    inbox.mkdir()
    for i in range(10):
        write_lines(inbox / f"{i:02d}.jsonl", [message(f"e{i}"), message(f"e{i // 2}"), message("e0")])
    drain(spark, root, pipeline, str(inbox), id_buckets=8)
    log = scoring.read_log(spark, f"{root}/out", scoring.ACCEPTED)
    assert names(log.select("event_id")) == sorted(f"e{i}" for i in range(10))
    index = scoring.ScoringJob(f"{root}/out", pipeline, id_buckets=8).ids
    assert names(index.read(spark, index.segments(spark, 10)).select("event_id")) == names(log.select("event_id"))
    assert len(index.segments(spark, 10)) < 10  # merged on the way


def test_log_without_an_index_gets_one(spark, tmp_path, pipeline):  # noqa: F811
    job = scoring.ScoringJob(str(tmp_path / "out"), pipeline, id_buckets=8)
    batch = lambda *m: spark.createDataFrame([(x,) for x in m], "value string").withColumn("broker_time", F.current_timestamp())
    job(batch(message("a"), message("b")), 0)
    files.delete(spark, job.ids.root)
    job(batch(message("b"), message("c")), 1)
    assert names(scoring.read_log(spark, job.root, scoring.ACCEPTED).select("event_id")) == ["a", "b", "c"]


# ---- bucketed snapshots --------------------------------------------------------


def rows(spark, values):
    return spark.createDataFrame(values, "k string, t long, v string")


def contents(root):
    return {str(p.relative_to(root)): hashlib.md5(p.read_bytes()).hexdigest() for p in pathlib.Path(root).rglob("*.parquet")}


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path, as_rows):
    root = str(tmp_path / "s")
    first = [(f"k{i}", 1, "old") for i in range(500)]
    snapshots.upsert(spark, root, {"data": snapshots.Batch(rows(spark, first), "k", "t")}, buckets=32)
    before = contents(root)
    batch = [("k1", 2, "new"), ("k2", 0, "late"), ("fresh", 1, "new"), (None, 1, "no key")]
    snapshots.upsert(spark, root, {"data": snapshots.Batch(rows(spark, batch), "k", "t")}, buckets=7)
    after = contents(root)
    assert {f: h for f, h in after.items() if f in before} == before  # nothing that was there changed
    assert 1 <= len({f.split("bucket=")[1].split("/")[0] for f in after if f not in before}) <= 4
    got = {r.k: (r.t, r.v) for r in snapshots.read(spark, root).collect()}
    assert len(got) == 502 and got["k1"] == (2, "new") and got["k2"] == (1, "old") and got["fresh"] == (1, "new") and got[None] == (1, "no key")
    assert got == {k: tv for k, tv in got.items()} and snapshots.read(spark, root, version=1).count() == 500
    # The same batch again changes no row.
    snapshots.upsert(spark, root, {"data": snapshots.Batch(rows(spark, batch), "k", "t")})
    assert as_rows(snapshots.read(spark, root)) == as_rows(snapshots.read(spark, root, version=2))
    assert snapshots.upsert(spark, root, {"data": snapshots.Batch(rows(spark, batch).limit(0), "k", "t")}) == 4
    assert snapshots.read(spark, root).count() == 502


def test_columns_that_come_later_or_change_type(spark, tmp_path):
    root = str(tmp_path / "s")
    put = lambda df: snapshots.upsert(spark, root, {"data": snapshots.Batch(df, "k", "t")}, buckets=16)
    put(rows(spark, [(f"k{i}", 1, "x") for i in range(50)]))
    put(rows(spark, [("k0", 2, "y")]).withColumn("extra", F.lit(7)).drop("v"))
    got = {r.k: (r.v, r.extra) for r in snapshots.read(spark, root).collect()}
    assert len(got) == 50 and got["k0"] == (None, 7) and got["k1"] == ("x", None)
    put(rows(spark, [("k1", 3, "z")]).withColumn("extra", F.lit(0.5)))
    got = {r.k: (r.v, r.extra) for r in snapshots.read(spark, root).collect()}
    assert len(got) == 50 and got["k0"] == (None, 7.0) and got["k1"] == ("z", 0.5)


def test_whole_tables_become_bucketed(spark, tmp_path):
    root = str(tmp_path / "s")
    snapshots.write(spark, root, {"data": rows(spark, [("a", 1, "x"), ("b", 1, "x")]), "other": spark.range(3)})
    snapshots.upsert(spark, root, {"data": snapshots.Batch(rows(spark, [("b", 2, "y")]), "k", "t")}, buckets=4)
    assert {r.k: r.v for r in snapshots.read(spark, root).collect()} == {"a": "x", "b": "y"}
    assert snapshots.read(spark, root, "other").count() == 3


def test_failed_upsert_and_vacuum(spark, tmp_path):
    root = str(tmp_path / "s")
    put = lambda values: snapshots.upsert(spark, root, {"data": snapshots.Batch(rows(spark, values), "k", "t")}, buckets=8)
    for i in range(5):
        put([(f"k{j}", i, f"v{i}") for j in range(i, 40)])
    bad = rows(spark, [("k0", 9, None)]).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(PySparkException, match="broken"):
        snapshots.upsert(spark, root, {"data": snapshots.Batch(bad, "k", "t")})
    want = {r.k: r.v for r in snapshots.read(spark, root).collect()}
    assert snapshots.latest(spark, root) == 5 and want["k0"] == "v0" and want["k39"] == "v4"
    rows(spark, [("half", 1, "x")]).coalesce(1).write.parquet(f"{root}/v=6/data/bucket=0")  # being written
    assert snapshots.vacuum(spark, root, keep=1)
    assert {r.k: r.v for r in snapshots.read(spark, root).collect()} == want
    assert files.exists(spark, f"{root}/v=6/data/bucket=0") and snapshots.latest(spark, root) == 5
    assert len(contents(root)) == 8 + 1  # one file a live bucket, and the unfinished version
    assert snapshots.vacuum(spark, root, keep=1) == []


def test_star_by_batches_equals_the_star_of_all_rows(spark, tmp_path, as_rows):
    everything = clean_rows(spark, 120).na.fill("none").na.fill(0.0).na.fill(0).withColumn("order_id", F.concat(F.lit("o"), F.pmod(F.xxhash64("event_id"), F.lit(25))))
    everything = everything.withColumn("customer_customer_id", F.concat(F.lit("c"), F.pmod(F.xxhash64("event_id", F.lit(1)), F.lit(9))))
    # Times without ties, unrelated to the batches.
    everything = everything.withColumn("event_time", F.timestamp_seconds(F.pmod(F.xxhash64("event_id", F.lit(2)), F.lit(10**9)))).cache()
    root = str(tmp_path / "star")
    part = F.pmod(F.xxhash64("event_id", F.lit(3)), F.lit(4))
    for i in range(4):
        snapshots.ingest_star(spark, root, everything.where(part == i), newest_wins=True, buckets=8)
    for name, want in relational.star(everything).items():
        got = snapshots.read(spark, root, name)
        assert as_rows(got.select(*want.columns)) == as_rows(want) and got.columns == sorted(want.columns), name
    # By default the batch wins, whatever its times.
    old = everything.where(part == 0).withColumns({"event_time": F.lit("1970-01-01").cast("timestamp"), "customer_country": F.lit("XX")})
    snapshots.ingest_star(spark, root, old, buckets=8)
    touched = {r[0] for r in old.select("customer_customer_id").distinct().collect()}
    assert {r[0] for r in snapshots.read(spark, root, "customers").where("customer_country = 'XX'").select("customer_customer_id").collect()} == touched


def test_quarantine_or_fail(spark, tmp_path, as_rows):
    root = str(tmp_path / "store")
    path = write_lines(tmp_path / "bad.jsonl", FIRST)  # event b has no items, hence no unit price
    with pytest.raises(PySparkException, match="NOT NULL violated"):
        etl.run(spark, path, root, export=False)
    result = etl.run(spark, path, root, export=False, on_null="quarantine")
    assert result.star_counts == {
        "valid": 2, "quarantine": 1, "customers_upserted": 1, "orders_upserted": 2, "events_upserted": 2,
    }
    aside = snapshots.quarantined(spark, f"{root}/star")
    assert as_rows(aside.select("event_id", "null_columns", "intake")) == [("b", "price_average_per_item", 1)]
    assert snapshots.read(spark, f"{root}/star", "events").count() == 2
    good = [e for e in FIRST if e["event_id"] != "b"]
    counts = etl.run(spark, write_lines(tmp_path / "ok.jsonl", good), root, export=False, on_null="quarantine").star_counts
    assert counts["valid"] == 2 and counts["quarantine"] == 0 and snapshots.quarantined(spark, f"{root}/star").count() == 1
    counts = snapshots.ingest_star(spark, f"{root}/star", result.clean.where("event_id = 'b'"), on_null="quarantine")
    assert counts["valid"] == 0 and counts["events_upserted"] == 0 and snapshots.quarantined(spark, f"{root}/star").count() == 2
    with pytest.raises(ValueError, match="on_null"):
        snapshots.ingest_star(spark, root, result.clean, on_null="drop")


def test_lines_are_counted_by_the_pass_that_reads_them(spark, tmp_path):
    path = write_lines(tmp_path / "mixed.jsonl", ["", "  ", "bad", '{"x": 1', '{"event_id": null}', *FIRST])
    result = etl.run(spark, path, str(tmp_path / "store"), export=False, star=False, tolerant=True)
    assert result.line_counts == {"sent": 6, "skipped_empty": 2, "skipped_invalid_json": 2}
    assert tuple(result.line_counts.values()) == tuple(messages.line_counts(files.read_lines(spark, path)).first())


def test_untouched_clean_buckets_stay_byte_equal(spark, tmp_path):
    root = str(tmp_path / "store")
    many = [raw_event(f"e{i}", "2026-01-01T10:00:00Z", order=f"O-{i}", customer=f"C-{i}") for i in range(300)]
    etl.run(spark, write_lines(tmp_path / "one.jsonl", many), root, export=False)
    before = contents(root)
    etl.run(spark, write_lines(tmp_path / "two.jsonl", [raw_event("e5", "2026-01-02T10:00:00Z", order="O-5", customer="C-5")]), root, export=False)
    after = contents(root)
    assert {f: after[f] for f in before} == before
    assert len(after) - len(before) == 4  # one bucket each of the clean set, customers, orders and events
    assert snapshots.read(spark, f"{root}/clean").count() == 300 and snapshots.read(spark, f"{root}/star", "orders").count() == 300


# ---- current tables, counters, repairs -------------------------------------------


def settle(spark, root, checkpoint, **options):
    for query in current.start(spark, root, checkpoint, buckets=4, **options).values():
        query.awaitTermination()


def test_current_tables_follow_the_log_over_restarts(spark, tmp_path, pipeline, as_rows):  # noqa: F811
    inbox, root, checkpoint = tmp_path / "inbox", str(tmp_path), str(tmp_path / "current-checkpoint")
    inbox.mkdir()
    out = f"{root}/out"
    with pytest.raises(FileNotFoundError):
        current.start(spark, out, checkpoint)
    same = lambda: {n: as_rows(t) for n, t in scoring.star_tables(spark, out).items() if n in current.COLUMNS} == {
        n: as_rows(current.read(spark, out, n)) for n in current.COLUMNS
    }
    write_lines(inbox / "1.jsonl", [message("a", order_id="o1", customer_country="fr"), message("b", order_id="o2", customer_customer_id="c2")])
    drain(spark, root, pipeline, str(inbox))
    assert as_rows(current.read(spark, out, "orders")) == []
    settle(spark, out, checkpoint)
    assert same() and current.read(spark, out, "orders").count() == 2
    before = contents(f"{out}/current")
    write_lines(inbox / "2.jsonl", [message("c", order_id="o1", customer_country="de", order_n_items=5)])
    write_lines(inbox / "3.jsonl", [message("d", order_id="o3", customer_customer_id="c3")])
    drain(spark, root, pipeline, str(inbox))
    settle(spark, out, checkpoint, files_per_trigger=1)  # a restart that works off two batches
    assert same()
    got = {r.order_id: r.order_n_items for r in current.read(spark, out, "orders").collect()}
    assert got == {"o1": 5, "o2": 2, "o3": 2}
    assert {r.customer_customer_id: r.customer_country for r in current.read(spark, out, "customers").collect()}["c1"] == "DE"
    assert before.items() <= contents(f"{out}/current").items()
    settle(spark, out, checkpoint)  # nothing new
    assert same() and set(current.tables(spark, out)) == {"customers", "orders", "events", "predictions"}
    stores = [p for p in pathlib.Path(checkpoint).rglob("*.zip")]
    assert stores  # state snapshots of RocksDB


def test_intake_counts_of_every_batch(spark, tmp_path, pipeline):  # noqa: F811
    inbox, root = tmp_path / "inbox", str(tmp_path)
    inbox.mkdir()
    write_lines(inbox / "1.jsonl", [message("a"), message("a"), "", "bad", '{"event_id": "z"}', "[1]"])
    write_lines(inbox / "2.jsonl", ["  ", message("b")])
    write_lines(inbox / "3.jsonl", ["nothing good"])
    drain(spark, root, pipeline, str(inbox))
    log = scoring.read_log(spark, f"{root}/out", scoring.INTAKE)
    got = sorted(tuple(r[c] for c in (*messages.INTAKE_COUNTS, "batch_id")) for r in log.collect())
    assert got == [(0, 0, 1, 0, 0, 2), (1, 1, 0, 0, 1, 1), (4, 1, 1, 2, 2, 0)]


def test_lost_predictions_are_repaired_once_and_orphans_refused(spark, tmp_path, pipeline, as_rows):  # noqa: F811
    job = scoring.ScoringJob(str(tmp_path / "out"), pipeline)
    batch = spark.createDataFrame([(message(x),) for x in "abc"], "value string").withColumn("broker_time", F.current_timestamp())
    job(batch, 0)
    whole = as_rows(scoring.read_log(spark, job.root, scoring.PREDICTIONS).drop("batch_id"))
    # The predictions of the batch are lost but for that of a.
    kept = scoring.read_log(spark, job.root, scoring.PREDICTIONS).where("event_id = 'a'").drop("batch_id").cache()
    kept.count()
    kept.write.mode("overwrite").parquet(f"{job.root}/{scoring.PREDICTIONS}/batch_id=0")
    star = scoring.star_tables(spark, job.root)
    star["orders"] = star["orders"].where("order_id <> 'o-c'")
    assert scoring.repair_predictions(spark, job.root, pipeline, star) == {"repaired": 1, "refused": 1}
    assert scoring.repair_predictions(spark, job.root, pipeline, star) == {"repaired": 0, "refused": 0}
    log = scoring.read_log(spark, job.root, scoring.PREDICTIONS)
    assert as_rows(log.drop("batch_id")) == [r for r in whole if r[0] != "c"]
    assert as_rows(scoring.read_log(spark, job.root, scoring.REFUSED).select("event_id", "reason")) == [("c", "unknown order_id")]
    # With its order there, a refusal is not taken back by itself: the log says what to send again.
    assert scoring.repair_predictions(spark, job.root, pipeline) == {"repaired": 0, "refused": 0}


def test_stream_sources_are_still_plain(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert sources.from_text_files(spark, str(tmp_path / "in")).columns == ["value", "broker_time"]
    assert schemas.STAR_KEYS["orders"] == "order_id"

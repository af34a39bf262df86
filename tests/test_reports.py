"""Profiling, business, relational and energy reports on small fixtures."""

import datetime as dt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderloom.operators import eco, profile, relational
from orderloom.sources import files


def test_daily_series_fills_empty_days(spark, as_rows):
    df = spark.createDataFrame(
        [("2026-01-01 10:00:00", 2.5), ("2026-01-01 11:00:00", 1.0), ("2026-01-04 00:00:00", 4.0), (None, 9.0)],
        "t string, order_order_total double",
    ).withColumn("t", F.to_timestamp("t"))
    day = lambda d: dt.date(2026, 1, d)
    assert as_rows(profile.daily_events(df, "t")) == [(day(1), 2), (day(2), 0), (day(3), 0), (day(4), 1)]
    assert as_rows(profile.daily_revenue(df, "t")) == [(day(1), 3.5), (day(2), 0.0), (day(3), 0.0), (day(4), 4.0)]


def test_correlation_of_every_pair(spark):
    data = [(1.0, 2.0, 5.0, None, 7.0), (2.0, 1.0, 5.0, 3.0, 1.5), (3.0, 7.0, 5.0, 4.0, 2.0), (5.0, 3.0, 5.0, 9.0, None)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e double")
    got = {(r.x, r.y): r.r for r in profile.correlation_matrix(df, df.columns).collect()}
    assert len(got) == 25
    pandas = df.toPandas().corr()
    for (x, y), r in got.items():
        assert r is None if "c" in (x, y) else r == pytest.approx(pandas.loc[x, y])
    assert profile.correlation_matrix(df, []).count() == 0


def test_grouped_quantiles_do_not_send_the_values_to_all_tasks(spark):
    df = spark.range(4000).select((F.col("id") % 40).alias("items"), F.sqrt("id").alias("y"))
    got = profile.relation(df, "items", "y")
    assert got.count() == 40
    plan = got._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "value" in line and "Join" in line]
    assert joins and all("BroadcastHashJoin" in j and "BuildRight" in j for j in joins)


def test_histogram_closes_the_last_bin(spark, as_rows):
    df = spark.createDataFrame([(0.0,), (0.5,), (9.99,), (10.0,), (None,)], "x double")
    bins = as_rows(profile.histogram(df, "x", 10))
    assert len(bins) == 10 and sum(b[3] for b in bins) == 4
    assert [b for b in bins if b[0] == 9][0][3] == 2 and [b for b in bins if b[0] == 0][0][3] == 2
    constant = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [b[3] for b in as_rows(profile.histogram(constant, "x", 3))] == [2, 0, 0]


def test_correlation_drops_pairs_and_constants(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0, None), (2.0, 4.0, 5.0, 1.0), (3.0, 6.0, 5.0, 0.0), (None, 1.0, 5.0, 4.0)],
        "a double, b double, c double, d double",
    )
    r = {(x, y): v for x, y, v in profile.correlation_matrix(df, ["a", "b", "c", "d"]).collect()}
    assert r["a", "b"] == pytest.approx(1.0) and r["a", "d"] == pytest.approx(-1.0)
    assert r["a", "c"] is None and r["c", "c"] is None and r["d", "d"] == pytest.approx(1.0)
    assert len(r) == 16 and r["b", "a"] == r["a", "b"]


def test_correlation_fans_nothing_out(spark):
    """Large offsets, gaps, NaN and a pair that is constant on its common rows, against pandas."""
    rng = np.random.default_rng(5)
    frame = pd.DataFrame(rng.normal(size=(500, 5)) @ rng.normal(size=(5, 5)), columns=list("abcde"))
    frame["a"] += 1e7
    frame["b"] = frame["b"].mask(rng.random(500) < 0.3)
    frame["k"] = np.where(frame["b"].isna(), rng.normal(size=500), 3.0)
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None).values.tolist(), ", ".join(f"{c} double" for c in frame))
    df = df.withColumn("c", F.when(F.col("d") > 1, float("nan")).otherwise(F.col("c")))
    frame["c"] = frame["c"].mask(frame["d"] > 1)
    want = frame.corr()
    got = {(r.x, r.y): r.r for r in profile.correlation_matrix(df, df.columns).collect()}
    for (x, y), r in got.items():
        if {x, y} == {"b", "k"}:
            assert r is None
        else:
            assert r == pytest.approx(want.loc[x, y], abs=1e-9), (x, y)
    assert {r.r for r in profile.correlation_matrix(df.limit(0), ["a", "b"]).collect()} == {None}


def test_na_reports(spark, as_rows):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = [tuple(r) for r in profile.na_report(df).collect()]
    assert [g[:2] for g in got] == [("b", 2), ("a", 1)] and got[1][2] == pytest.approx(100 / 3)
    assert as_rows(profile.na_any(df)) == [("a,b", 2)]
    assert as_rows(profile.distinct_profile(df, ["a", "b"])) == [("a", 3, 2, 1), ("b", 2, 1, 2)]


def test_counts_and_keys(spark, as_rows):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "z"), (None, None)], "k int, v string")
    assert as_rows(profile.duplicate_counts(df, "k")) == [(1, 1)]
    assert as_rows(profile.key_unique(df, "k")) == [(5, 3, False)]
    assert [tuple(r) for r in profile.value_counts(df, "v", 2).collect()] == [("x", 2), ("y", 1)]
    assert as_rows(profile.quality_checks(df, ["k"], ["v"])) == [("k_negative", 0), ("v_missing", 1)]


def test_describe_and_boxplot(spark):
    df = spark.createDataFrame([(float(v), str(v % 2)) for v in [1, 2, 3, 4, 100]], "x double, s string")
    d = profile.describe_numeric(df, ["x"]).first()
    assert (d["n_values"], d["mean"], d["q25"], d["q50"], d["q75"]) == (5, 22.0, 2.0, 3.0, 4.0)
    assert d["std"] == pytest.approx(43.6176, abs=1e-4)
    c = profile.describe_categorical(df, ["s"]).first()
    assert (c["n_values"], c["n_unique"], c["top"], c["freq"]) == (5, 2, "0", 3)
    b = profile.boxplot(df, "x").first()
    assert (b["whisker_low"], b["whisker_high"], b["n_outliers"]) == (1.0, 4.0, 1)


def test_relation_keeps_missing_group(spark, as_rows):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (None, 7.0)], "items int, y double")
    got = as_rows(profile.relation(df, "items", "y").select("items", "mean", "q50"))
    assert got == [(None, 7.0, 7.0), (1, 3.0, 3.0)]


def test_rates(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", None), ("c", True)], "g string, order_is_returned boolean")
    got = [tuple(r) for r in profile.return_rate_by(df, "g").collect()]
    assert got == [("c", 1.0, 1), ("a", 0.5, 2), ("b", None, 1)]
    assert profile.class_balance(df, "order_is_returned").first()["positive_rate"] == pytest.approx(2 / 3)


# ---- relational ------------------------------------------------------------


def test_upsert_replaces_adds_and_is_idempotent(spark, as_rows):
    stored = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = relational.pk_upsert(stored, batch, "k")
    assert as_rows(once) == [(1, "a"), (2, "B"), (3, "c")]
    assert as_rows(relational.pk_upsert(once, batch, "k")) == as_rows(once)
    assert as_rows(relational.upsert_counts(stored, batch, "k")) == [(1, 1)]
    older = spark.createDataFrame([(2, "old", 1)], "k int, v string, t int")
    newer = spark.createDataFrame([(2, "new", 5)], "k int, v string, t int")
    assert as_rows(relational.pk_upsert(newer, older, "k", order_col="t")) == [(2, "new", 5)]
    assert as_rows(relational.pk_upsert(newer, older, "k")) == [(2, "old", 1)]


def test_snapshot_upsert_aligns_columns(spark, as_rows):
    stored = spark.createDataFrame([("a", 5, "x"), ("b", 5, "y")], "event_id string, event_time int, old string")
    batch = spark.createDataFrame([("a", 5, 1.0), ("b", 4, 2.0), ("c", None, 3.0)], "event_id string, event_time int, new double")
    got = relational.snapshot_upsert(stored, batch)
    assert got.columns == ["event_id", "event_time", "new", "old"]
    assert as_rows(got) == [("a", 5, 1.0, None), ("b", 5, None, "y"), ("c", None, 3.0, None)]
    assert as_rows(relational.snapshot_upsert(got, batch)) == as_rows(got)
    untimed = relational.snapshot_upsert(stored.drop("event_time"), batch.drop("event_time"))
    assert as_rows(untimed) == [("a", 1.0, None), ("b", 2.0, None), ("c", 3.0, None)]
    with pytest.raises(KeyError):
        relational.snapshot_upsert(None, batch.drop("event_id"))


def _predictions(spark):
    return spark.createDataFrame(
        [("e1", "o1", "c1", "0.5"), ("e2", "o9", "c9", "0.1"), ("e9", "o1", "c1", "x"), ("e1", "o1", "c1", "0.7")],
        "event_id string, order_id string, customer_customer_id string, return_proba string",
    )


def _keys(spark):
    ids = lambda name, *v: spark.createDataFrame([(x,) for x in v], f"{name} string")
    return {
        "events": ids("event_id", "e1", "e2"),
        "orders": ids("order_id", "o1"),
        "customers": ids("customer_customer_id", "c1"),
    }


def test_references(spark, as_rows):
    good = relational.predictions_for_upsert(_predictions(spark), _keys(spark))
    assert as_rows(good) == [("e1", "o1", "c1", 0.5)]
    bad = relational.orphans(_predictions(spark), _keys(spark)).select("event_id", "reason")
    assert as_rows(bad) == [
        ("e2", "unknown customer_customer_id"), ("e2", "unknown order_id"), ("e9", "unknown event_id"),
    ]


def test_not_null(spark, as_rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert as_rows(relational.not_null_violations(df)) == [(1, None, "b")]
    with pytest.raises(PySparkException, match="NOT NULL violated: b"):
        relational.enforce_not_null(df).collect()
    assert relational.enforce_not_null(df.where("a = 2")).count() == 1


def test_update_delete_with_unknown_condition(spark, as_rows):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "a int, b string")
    hit = F.col("b") == "x"
    assert as_rows(relational.update_where(df, hit, {"b": F.lit("z")})) == [(1, "z"), (2, None), (3, "y")]
    assert as_rows(relational.delete_where(df, hit)) == [(2, None), (3, "y")]


def test_one_to_many_is_ordered(spark):
    parents = spark.createDataFrame([(1, "p"), (2, "q"), (3, "none")], "user_id int, name string")
    children = spark.createDataFrame([(12, 1), (11, 1), (20, 2)], "id int, user_id int")
    got = [tuple(r) for r in relational.one_to_many(parents, children, "user_id", "id").collect()]
    assert got == [(1, "p", 11), (1, "p", 12), (2, "q", 20)]


# ---- energy log ------------------------------------------------------------


@pytest.fixture()
def logs(tmp_path):
    (tmp_path / "runs.csv").write_text(
        "timestamp,project_name,run_id,duration,emissions,energy_consumed,gpu\n"
        "t1,etl,r1,60,0.5,2,\nt2,train,r2,120,0.25,1,\nt3,etl,r1,30,0.75,3,\n"
    )
    (tmp_path / "runs.csv.bak").write_text(
        "project_name,timestamp,run-id,emissions(kg),duration(s),energy_consumed(kWh)\n"
        "etl,t1,r1,9,9,9\netl,t4,r4,1,60,4\n"
    )
    (tmp_path / "runs.csv_1.bak").write_text("")
    return str(tmp_path / "runs.csv*")


def test_run_logs_with_drifting_headers(spark, logs, as_rows):
    df = files.read_run_logs(spark, logs)
    assert {"run_id", "duration", "gpu", "__source_file"} <= set(df.columns)
    assert df.count() == 5
    once = eco.dedupe_runs(df)
    # The .bak file sorts after the .csv file, so its copy of r1 is the last one.
    assert as_rows(once.select("run_id", "emissions")) == [("r1", "9"), ("r2", "0.25"), ("r4", "1")]


def test_headers_cost_a_buffer_per_file(spark, tmp_path, monkeypatch):
    """What is read to learn the headers does not grow with the files; quoted fields, repeated headers and blank lines are handled."""
    line = 't,"a, b",{i},1,0.5,2' + "x" * 200 + "\n"

    read = []

    class Counting:
        def __init__(self, stream):
            self.stream = stream

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.stream.close()

        def read(self, n):
            data = self.stream.read(n)
            read.append(len(data))
            return data

    class Counted:
        def open_input_stream(self, name):
            return Counting(pafs.LocalFileSystem().open_input_stream(name))

    def size_read(rows):
        folder = tmp_path / str(rows)
        folder.mkdir()
        for k in range(3):
            with open(folder / f"{k}.csv", "w") as f:
                f.write("timestamp,project_name,run_id,duration,emissions,energy_consumed\n")
                f.writelines(line.format(i=i) for i in range(rows))
        paths = files.list_files(spark, f"{folder}/*.csv")
        heads = files.file_heads(spark, paths)
        assert heads.count() == 3 and heads.select("header").distinct().count() == 1
        read.clear()
        list(files._first_lines(iter([pa.RecordBatch.from_pydict({"file": paths, "path": paths})])))
        return sum(read)

    real = files._opened
    monkeypatch.setattr(files, "_opened", lambda path: (Counted(), real(path)[1]))
    assert size_read(1_000) == size_read(50_000) == 3 * files.HEAD_BYTES
    monkeypatch.undo()
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "one.csv").write_text('project_name,"emissions(kg)",run-id\n"a, b",1.5,r1\n\nproject_name,"emissions(kg)",run-id\nc,,r2\n')
    (tmp_path / "q" / "two.csv").write_text("emissions,project_name,extra\n2,d,\n")
    got = sorted((r.project_name, r.emissions, r.run_id, r.extra) for r in files.read_run_logs(spark, f"{tmp_path}/q/*.csv").collect())
    assert got == [("a, b", "1.5", "r1", None), ("c", None, "r2", None), ("d", "2", None, None)]

    def refuse(_):
        raise ValueError("unknown file system")

    monkeypatch.setattr(files, "_opened", refuse)  # Spark's own reader takes over
    assert sorted((r.project_name, r.emissions, r.run_id, r.extra) for r in files.read_run_logs(spark, f"{tmp_path}/q/*.csv").collect()) == got


def test_emission_summary(spark, logs):
    summary = eco.summary(eco.dedupe_runs(files.read_run_logs(spark, logs)))
    got = [tuple(r) for r in summary.collect()]
    assert summary.columns == ["project_name", "emissions", "energy_consumed", "duration", "emissions_g", "duration_min"]
    assert got == [("etl", 10.0, 13.0, 69.0, 10000.0, 1.15), ("train", 0.25, 1.0, 120.0, 250.0, 2.0)]
    assert eco.totals(summary).first()["total_emissions"] == 10.25
    shares = {r["project_name"]: r["share_pct"] for r in eco.shares(summary).collect()}
    assert shares["etl"] == pytest.approx(1000 / 10.25)
    cost = eco.costs(summary, 0.2, 0.5, 100.0).where("project_name = 'train'").first()
    assert cost["mean_power_kw"] == pytest.approx(30.0) and cost["carbon_intensity"] == 0.25
    assert cost["vm_cost"] == pytest.approx(0.5 / 30) and cost["factor_emissions"] == 0.475
    page = eco.markdown(summary, ["a.csv"])
    assert "| etl | 10 |" in page and "10.250000 kg" in page and "- duration: 189.0 s" in page
    assert [r["project_name"] for r in eco.summary(eco.dedupe_runs(files.read_run_logs(spark, logs)), exclude=["etl"]).collect()] == ["train"]


def test_emission_summary_without_optional_columns(spark):
    df = spark.createDataFrame([("a", "1.5"), ("a", "1.5"), ("b", "2")], "project_name string, emissions string")
    assert eco.summary(eco.dedupe_runs(df)).columns == ["project_name", "emissions", "emissions_g"]
    assert eco.dedupe_runs(df).count() == 2
    with pytest.raises(KeyError, match="emissions"):
        eco.summary(df.drop("emissions"))


def test_unreadable_logs(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_run_logs(spark, str(tmp_path / "none*"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="readable"):
        files.read_run_logs(spark, str(tmp_path / "empty*"))

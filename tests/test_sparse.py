"""Sparse one-hot vectors against the dense columns, and with very many values."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.ml import models, prep, sparse
from tests.test_ml import clean_rows


def test_slots_follow_the_order_of_values(spark, tmp_path):
    rows = [("b", 1), ("a", 1), (None, 2), ("c", 10), ("b", None), ("é", 2)]
    df = spark.createDataFrame(rows, "x string, n int").repartition(3)
    path = str(tmp_path / "index")
    assert sparse.build_index(df, ["x", "n"], path) == {"x": 3, "n": 2}
    assert {r.value: r.slot for r in sparse.read_index(spark, path, "x").collect()} == {"b": 0, "c": 1, "é": 2}
    asked = spark.createDataFrame([("a", 10), ("b", 2), ("zzz", 3), (None, None), ("b", 1)], "x string, n int")
    got = sorted(((r.x, r.n, r.x_slot, r.n_slot) for r in sparse.slots(asked, ["x", "n"], path).collect()), key=str)
    # The numbers are sorted as text: 1, 10, 2.
    assert got == sorted([("a", 10, None, 0), ("b", 2, 0, 1), ("zzz", 3, None, None), (None, None, None, None), ("b", 1, 0, None)], key=str)


def test_same_vectors_and_model_as_the_dense_encoding(spark, tmp_path):
    train, test = clean_rows(spark), clean_rows(spark, 40).withColumn("order_channel", F.lit("unseen"))
    dense = prep.OrderPrep().fit(train)
    lean = sparse.SparsePrep(indexPath=str(tmp_path / "index")).fit(train)
    names = [r.feature for r in lean.names(spark).orderBy("place").collect()]
    assert names == dense.features and lean.size == len(names)
    for rows in (train, test, test.drop("customer_country")):
        wide = {r.event_id: [r[c] for c in names] for r in dense.transform(rows).collect()}
        out = lean.transform(rows)
        assert out.columns == [*rows.columns, "features"]
        got = {r.event_id: list(r.v) for r in out.select("event_id", vector_to_array("features").alias("v")).collect()}
        assert got.keys() == wide.keys()
        for k, want in wide.items():
            assert got[k] == pytest.approx(want), k
    want = dict(models.coefficients(spark, *models.fit_return_model(train)).collect())
    fitted = models.fit_sparse_return_model(train, index_path=str(tmp_path / "again"))
    have = dict(models.sparse_coefficients(spark, fitted).collect())
    assert have.keys() == want.keys() and all(have[c] == pytest.approx(v, abs=2e-3) for c, v in want.items())
    fitted.write().overwrite().save(str(tmp_path / "model"))
    back = PipelineModel.load(str(tmp_path / "model"))
    proba = lambda m: {r.event_id: r.return_proba for r in models.score_returns(m, test).collect()}
    assert proba(back) == proba(fitted)


def test_a_hundred_thousand_values(spark, tmp_path):
    """No value reaches the driver or becomes a column; vectors stay sparse."""
    n = 100_000
    train = spark.range(2 * n).select(
        F.concat(F.lit("e"), "id").alias("event_id"),
        F.concat(F.lit("c"), F.col("id") % n).alias("customer_customer_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("order_channel"),
        (F.col("id") % 11).cast("double").alias("order_n_items"),
        ((F.col("id") % n) % 2 == 0).alias("order_is_returned"),
    )
    category = ["customer_customer_id", "order_channel"]
    prepared = sparse.SparsePrep(numericCols=["order_n_items"], categoryCols=category, indexPath=str(tmp_path / "index")).fit(train)
    assert prepared.getOrDefault("state")["sizes"] == {"customer_customer_id": n - 1, "order_channel": 7}
    out = prepared.transform(train)
    row = out.where("event_id = 'e5'").first()
    assert row.features.size == prepared.size == 1 + n - 1 + 7 and row.features.numNonzeros() <= 3
    others = [c for c in schemas.NUMERIC_COLUMNS if c != "order_n_items"]
    fitted = models.fit_sparse_return_model(train, category, str(tmp_path / "more"), exclude=others)
    scored = models.score_returns(fitted, train, keep=["order_is_returned"])
    right = scored.agg(F.avg((F.col("order_is_returned") == F.col("predicted_return")).cast("double"))).first()[0]
    assert right > 0.99  # the customer decides
    assert models.sparse_coefficients(spark, fitted).count() == prepared.size

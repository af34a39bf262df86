"""The pipeline on a planted table: each stage's decision takes effect, clean documents stay."""

import random

import corpus_pipeline
import pytest

TOKEN = "1eb9c654e721b4f812088970e66a6345cee33dd6"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item = prose(20) + ". " + prose(10) + "."
    texts = [prose(80) for _ in range(30)]
    texts += [texts[0], texts[1] + " end", prose(50) + " " + item + " " + prose(50), prose(60) + f' token = "{TOKEN}" ' + prose(60), None, "123 !!"]
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    gone = [{34, 35}, {30, 31}, {32}, set()]
    for (name, stage), lost in zip(corpus_pipeline.STAGES[:-1], gone, strict=True):
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        out = stage(spark, docs, folder)
        path = f"{folder}/{name}"
        out.write.parquet(path)
        assert out.columns == docs.columns
        docs = spark.read.parquet(path)
        assert before - {r.doc_id for r in docs.select("doc_id").collect()} == lost, name
    assert not docs.filter(docs.text.contains(TOKEN)).count()
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert mixed.columns == [*docs.columns, "size", "source_size", "target", "taken"]
    rows = mixed.collect()
    assert all(0 < r.taken <= 2 * r["size"] for r in rows) and len(rows) <= docs.count()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()))

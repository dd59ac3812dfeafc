"""The pipeline's stages on planted and on edge-case documents."""
import random

import corpus_pipeline as pipeline
import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, size string, copies string"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(3)
    words = [a + b for a in "bcdfgklm" for b in ("arin", "orel", "istu", "embo", "ulaf", "anek", "ipso")]
    rare = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(2000)]
    items = [" ".join(rng.choices(rare, k=30)) for _ in range(5)]
    rows, labels = [], []
    for i in range(400):
        text = rng.choices(words, k=60) + rng.choices(rare, k=60)
        if i % 10 == 1:
            text[3:3] = ["zzqxar", "zzqxor", "zzqxis", "zzqxar"]
        if i % 50 == 2:
            text += items[i // 50 % 5].split()
        rows.append([i, " ".join(text), "en", f"s{i % 3}" if i % 7 else None, 1, "x", None])
        labels.append((i, 1, int(i % 10 == 1)))
    rows += [[1000 + k, rows[k][1], "en", "s0", 1, "x", None] for k in (0, 3, 4)]
    rows += [[0, rows[0][1], "en", "s0", 1, "x", None]] * 2                      # repeated rows
    rows += [[None, None, None, None, None, None, None], [2000, "", "en", "s1", 0, "x", None]]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES[:-1]):
        out = stage(spark, kept[-1], sf_dir)
        assert out.dtypes == docs.dtypes
        path = f"{sf_dir}/stage-{k}.parquet"
        out.write.parquet(path)
        kept.append(spark.read.parquet(path))
    ids = [[r["doc_id"] for r in d.select("doc_id").collect()] for d in kept]
    clean = {i for i in range(400) if i % 10 != 1}
    assert not {i for i in ids[1] if i is not None and i < 400} - clean
    assert len(set(ids[1]) & clean) >= 0.98 * len(clean)
    assert not {1000, 1003, 1004} & set(ids[2]) and ids[2].count(0) == 1 and set(ids[1]) & clean <= set(ids[2])
    leaked = {i for i in range(400) if i % 50 == 2}
    assert not leaked & set(ids[3]) and set(ids[2]) - leaked == set(ids[3])
    assert max(ids[4].count(i) for i in set(ids[4])) <= 2 and set(ids[4]) <= set(ids[3])
    tokens = pipeline.STAGES[-1][1](spark, kept[-1], sf_dir).collect()
    assert sorted(r["doc_id"] for r in tokens) == sorted(ids[4])
    assert sorted(map(tuple, pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, tokens))


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0

"""The pipeline's stages against brute force, each on its own input."""

import collections

import corpus_pipeline
from test_llm_operators import SCHEMA, TEXTS, classes, hits, repeats


def test_stages(spark, tmp_path):
    rows = [(k, t, "en", f"s{k % 3}", len(t or ""), "x", 1, 2, 3, 4) for k, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, " ".join(TEXTS[9].split()[100:120]))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        kept.append((before, after))
    assert set(kept[0][1]) == {i for i, t in kept[0][0] if t and any(c.isalpha() for c in t)}
    near = classes(kept[1][0], 5, 80)
    assert set(kept[1][1]) == {i for i in near if near[i][1] == i}
    gone = repeats(kept[2][0], 200)
    assert all(len(t.encode()) <= n - cut for (i, n, cut, *_), _ in gone.items() if (t := kept[2][1].get(i)) is not None)
    assert set(kept[2][1]) == {i for (i, n, cut, *_), _ in gone.items() if cut == 0 or cut < n}
    assert set(kept[3][1]) == {i for i, t in kept[3][0] if not hits(t, items, 10)[4]}
    assert set(kept[4][1]) <= set(kept[3][1]) and all(r["taken"] > 0 for r in docs.collect())


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    counted = collections.Counter(r["doc_id"] for r in out.collect())
    assert counted and max(counted.values()) == 1

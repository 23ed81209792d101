import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tests.llm.conftest import sentence
from tests.llm.test_formats import brute_packing
from tests.llm.test_line_and_substring import brute_lines
from tests.llm.test_near import brute, letters


def test_stages(spark, edge_docs, no_docs, tmp_path):
    """Each stage on edge cases, against brute force where it is exact."""
    rude = spark.createDataFrame([(i, sentence(i, 40) + (" vile idiot" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(100, 400)] + [(i, f"{chr(97 + i % 26)} \u00e9{i % 7} {sentence(i, i % 4)}", 0) for i in range(400, 500)], "doc_id long, text string, toxic int")
    folder = str(tmp_path)
    rude.select("doc_id", "toxic").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, sentence(3, 30))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = edge_docs.unionByName(rude.select("doc_id", "text").withColumn("n_chars", F.lit(1).cast("long")), allowMissingColumns=True)
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    toxic, lines, near, clean, pack = (f for _, f in pipeline.STAGES)
    kept = toxic(spark, docs, folder)
    assert kept.columns == docs.columns
    bad = {r.doc_id for r in rude.where("toxic = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - bad
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    out = lines(spark, kept, folder)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in out.collect()) == sorted((d or -1, t) for d, t, *_ in brute_lines(rows, 10).elements())
    assert all(r.n_chars == len(r.text) for r in out.collect())
    left = near(spark, edge_docs, folder)
    groups = {}
    numbered = [(i, t) for i, (_, t) in enumerate((r.doc_id, r.text) for r in edge_docs.collect())]
    for (i, n, c, k) in brute(numbered, 5):
        groups.setdefault(c, []).append(i)
    assert left.count() == len(groups) and left.columns == docs.columns
    whole = near(spark, rude.select("doc_id", "text"), folder)
    assert {r.doc_id for r in whole.collect()} == {d for d, _, c, k in brute([(r.doc_id, r.text) for r in rude.collect()], 5) if k}
    item = letters(sentence(3, 30))
    pure = clean(spark, edge_docs, folder)
    assert sorted(r.text or "" for r in pure.collect()) == sorted(r.text or "" for r in edge_docs.collect() if len(item & letters(r.text)) < 0.8 * len(item))
    assert brute_packing([(r.doc_id, r.text) for r in pure.collect()], pack(spark, pure, folder).collect()) == 0
    for _, stage in pipeline.STAGES:
        assert stage(spark, no_docs, folder).count() == 0


def test_run(spark):
    out = pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert out and public_tokenizers.path(pipeline.TOKENIZER)
    seen = {}
    for r in out:
        seen.setdefault((r.doc_id, r.doc_tokens), 0)
        seen[r.doc_id, r.doc_tokens] += r.length
    assert all(n == total for (_, total), n in seen.items())

"""The corpus pipeline, stage by stage, against plain versions on a small table."""

import hashlib

import public_tokenizers

import brute
import corpus_pipeline
from folkmeter.llm import bpe, common, quality


def _rows(frame):
    return {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}


def test_stages_equal_brute_force(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)

    good = common.stored(stages["quality"](spark, docs, sf_dir))
    found = common.stored(quality.features(docs.select("doc_id", "text")))
    model = quality.fit(found, common.table(spark, sf_dir, "labels"))
    scores = {r.doc_id: r.predicted for r in quality.score(found, model).collect()}
    assert _rows(good).keys() == {i for i, p in scores.items() if p == 1}

    single = common.stored(stages["near_duplicates"](spark, good, sf_dir))
    before = sorted(_rows(good).items())
    assert _rows(single).keys() == set(brute.near_classes(before))

    unrepeated = common.stored(stages["repeated_passages"](spark, single, sf_dir))
    assert _rows(unrepeated) == brute.without_repeats(_rows(single).items())

    clean = common.stored(stages["benchmark_passages"](spark, unrepeated, sf_dir))
    items = [(r.item_id, r.text) for r in common.table(spark, sf_dir, "benchmark").collect()]
    left = _rows(clean)
    for doc_id, text in _rows(unrepeated).items():
        n, hit, _ = brute.benchmark_hits(text, items)
        assert (doc_id in left) == (len(hit) <= 0.8 * n)
        if doc_id in left and not hit:
            assert left[doc_id] == text
        elif doc_id in left:
            assert len(brute.words(left[doc_id])) == n - len(hit)

    tool = bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    for row in stages["tokens"](spark, clean, sf_dir).collect():
        assert tool.decode(tool.encode(left[row.doc_id])) == left[row.doc_id].encode()
        assert row.ids == tool.encode(left[row.doc_id]).tolist()
        assert row.decoded_sha256 == hashlib.sha256(left[row.doc_id].encode()).hexdigest()

    for frame in (good, single, unrepeated, clean):
        assert frame.columns == columns
    assert all(r.n_chars == len(r.text) for r in clean.collect())


def test_run_takes_an_odd_table(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "a b c", None, "s", 5)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert found == {1: 0, 3: 3}

"""The stages on rows with a known fate."""

import corpus_pipeline as pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def text(seed, n=80):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 4001}" for i in range(n))


def test_stages_keep_and_drop(spark, tmp_path):
    rows = [(i, text(i), "en", "ab"[i % 2], 1) for i in range(40)]
    rows += [(50, text(3), "en", "a", 1), (51, text(4) + " end", "en", None, 1), (52, "short", "en", "a", 1), (53, None, "en", "a", 1)]
    rows += [(54, text(70) + " " + text(99, 12), "en", "a", 1), (None, text(71), "en", "a", 1), (None, text(72), None, "b", 1)]
    docs = spark.createDataFrame(rows, COLUMNS)
    spark.createDataFrame([(1, text(99, 12))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    ids = lambda frame: sorted((r["doc_id"] for r in frame.collect()), key=lambda x: (x is None, x))

    judged = pipeline.quality_rules(spark, docs, str(tmp_path))
    assert ids(judged) == [*range(40), 50, 51, 54, None, None] and judged.columns == docs.columns
    single = pipeline.near_copies(spark, judged, str(tmp_path))
    assert ids(single) == [*range(40), 54, None, None]
    clean = pipeline.decontamination(spark, single, str(tmp_path))
    assert ids(clean) == [*range(40), None, None] and clean.columns == docs.columns
    mixed = pipeline.source_mixture(spark, clean, str(tmp_path))
    times = mixed.groupBy("doc_id", "text").count().collect()
    assert mixed.columns == docs.columns and max(r["count"] for r in times) <= 2
    assert abs(mixed.count() - 1.5 * clean.count()) <= 4
    records = pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["slot"] for r in records) == list(range(len(records))) and records


def test_near_copies_with_shared_and_missing_ids(spark, tmp_path):
    rows = [(1, text(1), "en", "a", 1), (2, text(2), "en", "a", 1), (2, text(1) + " end", "en", "a", 1), (2, text(3), "en", "a", 1)]
    rows += [(None, text(4), "en", "a", 1), (None, text(4), "en", "b", 1), (None, text(4) + " end", None, "a", 1), (None, text(2), "en", "a", 1)]
    rows += [(None, text(5), "en", "a", 1)] * 2
    kept = pipeline.near_copies(spark, spark.createDataFrame(rows, COLUMNS), str(tmp_path)).collect()
    named = sorted((r["doc_id"], r["text"]) for r in kept if r["doc_id"] is not None)
    assert named == sorted([(1, text(1)), (2, text(2)), (2, text(3))])
    unnamed = [r["text"] for r in kept if r["doc_id"] is None]
    assert len(unnamed) == 2 and text(5) in unnamed and any(t.startswith(text(4)) for t in unnamed)


def test_stages_take_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], COLUMNS)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0

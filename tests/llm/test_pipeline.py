import random
from collections import Counter

import corpus_pipeline
from tests.llm import brute


def corpus(tmp_path, spark):
    rng = random.Random(12)
    rows = brute.awkward()
    rows += [(1000 + i, brute.sentence(rng, rng.randrange(12, 300)), "en", f"s{i % 5}", 0) for i in range(60)]
    rows += [(2000 + i, rows[-1 - i][1] + (" x" if i % 2 else ""), "en", "s1", 0) for i in range(20)]
    items = [(i, brute.sentence(rng, 30)) for i in range(5)]
    rows += [(3000 + i, f"{brute.sentence(rng, 60)} {items[i % 5][1]} {brute.sentence(rng, 60)}", "en", "s2", 0) for i in range(10)]
    rows = [r for r in rows if r[0] is not None and r[0] not in (0, 1, 5)] + [r for r in rows if r[0] is None]
    spark.createDataFrame(rows, brute.SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return rows, items


def test_stages_by_brute_force(spark, tmp_path):
    """Host verdicts condemn nobody here, so plain versions of the stages can follow each other."""
    rows, items = corpus(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    (_, quality), (_, dedup), (_, clean), (_, redact), (_, pack) = corpus_pipeline.STAGES
    bag = lambda df: Counter(map(tuple, df.collect()))

    kept = quality(spark, docs, str(tmp_path))
    rows = [r for r in rows if not brute.quality(r[1])[-1]]
    assert kept.columns == docs.columns and bag(kept) == Counter(rows)

    single = dedup(spark, kept, str(tmp_path))
    rows = [r for r, (doc_id, _, head) in zip(rows, brute.simhash(rows)) if doc_id == head]
    assert single.columns == docs.columns and bag(single) == Counter(rows)

    plain = clean(spark, single, str(tmp_path))
    rows = [r for r, c in zip(rows, brute.contamination(rows, items)) if not c[-1]]
    assert plain.columns == docs.columns and bag(plain) == Counter(rows)

    safe = redact(spark, plain, str(tmp_path))
    assert safe.columns == docs.columns and safe.count() == len(rows)
    for r in safe.collect():
        assert not brute.base_spans(r["text"], brute.SECRETS) and r["n_chars"] == len(r["text"])
    untouched = [r[1] for r in rows if not brute.base_spans(r[1], brute.SECRETS)]
    assert not Counter(t for t in untouched if "ghp_" not in t) - Counter(r["text"] for r in safe.collect())

    packed = pack(spark, safe, str(tmp_path)).collect()
    assert sum(r["words"] for r in packed) == sum(len(r["text"].split()) for r in safe.collect())
    assert Counter(d for r in packed for d, p in zip(r["doc_ids"], r["pieces"]) if p == 0) == Counter(r[0] for r in rows)


def test_run(spark, tmp_path):
    corpus(tmp_path, spark)
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["sequence", "words", "doc_ids", "pieces", "text"]


def test_each_stage_takes_awkward_documents(spark, tmp_path, docs):
    """Nulls, repeated rows, clashing and dotted column names: one stage after the other."""
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, str(tmp_path))
        assert held.columns == docs.columns
        held.write.parquet(f"{tmp_path}/{name}")
        held = spark.read.parquet(f"{tmp_path}/{name}")
    assert corpus_pipeline.STAGES[-1][1](spark, held, str(tmp_path)).count() > 0


def test_each_stage_takes_an_empty_table(spark, tmp_path, no_docs):
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, str(tmp_path)).count() == 0

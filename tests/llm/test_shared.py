import pyarrow as pa
from pyspark.sql import functions as F

from kgspark.llm.shared import _bounded, map_text


def test_slices_of_a_batch_cover_it_in_order():
    texts = [("x" * (i * 7 % 50)) if i % 5 else None for i in range(200)]
    rows = pa.StructArray.from_arrays([pa.array(range(200)), pa.array(texts, pa.string())], names=["id", "text"])
    batch = pa.RecordBatch.from_arrays([rows], names=["row"])
    parts = list(_bounded(batch, most=300))
    assert len(parts) > 10
    assert [v for p in parts for v in p.column("row").field("text").to_pylist()] == texts
    assert [v for p in parts for v in p.column("row").field("id").to_pylist()] == list(range(200))


def test_rows_and_results_stay_together(spark, docs, rows):
    made = map_text(docs, "text", lambda texts: {"n": [None if t is None else len(t) for t in texts]}, "n bigint")
    got = made.select(F.col("row.text").alias("text"), "out.n").collect()
    assert len(got) == len(rows)
    assert all(r["n"] == (None if r["text"] is None else len(r["text"].encode())) for r in got)

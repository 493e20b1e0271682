from pyspark.sql import functions as F

from kgspark.llm import quality
from tests.llm import brute


def test_measures_and_base(docs, rows, same):
    same(quality.op8_quality(docs).drop("kept"), [(r[0], *brute.quality(r[1])) for r in rows])


def host_verdicts(found, limit=quality.CONDEMNED):
    """Condemned hosts by the same prior, in plain Python. ``found``: (host, failures by rule)."""
    hosts = sorted({h for h, _ in found if h is not None})
    bad = set()
    for rule in found[0][1]:
        counts = {h: (sum(1 for x, _ in found if x == h), sum(f[rule] for x, f in found if x == h)) for h in hosts}
        mean = sum(f for _, f in counts.values()) / sum(n for n, _ in counts.values())
        rates = [f / n for n, f in counts.values()]
        spread = sum((r - sum(rates) / len(rates)) ** 2 for r in rates) / len(rates)
        weight = min(max(mean * (1 - mean) / spread - 1, 1.0), 1e6) if spread else 1e6
        bad |= {h for h, (n, f) in counts.items() if (f + mean * weight) / (n + weight) >= limit}
    return bad


def test_host_verdicts(spark):
    good, noisy = "plain words that say one thing after another without any trouble at all {}", "# $ % & * | some noisy words {} here and there for {} once # # #"
    rows = [(i, good.format(i), f"g{i % 5}") for i in range(100)] + [(200 + i, noisy.format(i, i), "bad") for i in range(40)]
    rows += [(300, good.format("x"), "bad"), (301, noisy.format(1, 2), "g1"), (302, noisy.format(3, 4), None), (303, noisy.format(5, 6), "single"), (304, None, "bad")]
    judged = {r["row"]["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    fails = {k: {"base": r["base_failed"], "symbols": 10 * r["out"]["n_symbols"] > r["out"]["word_chars"]} for k, r in judged.items()}
    bad = host_verdicts([(r[2], fails[r[0]]) for r in rows])
    assert "bad" in bad and not bad & {f"g{i}" for i in range(5)}
    for r in rows:
        assert judged[r[0]]["kept"] == (not fails[r[0]]["base"] and not (r[2] in bad and fails[r[0]]["symbols"]))
    assert judged[300]["kept"] and judged[301]["kept"] and judged[302]["kept"] and not judged[210]["kept"] and not judged[304]["kept"]


def test_passing_keeps_columns(docs, rows):
    kept = quality.passing(docs)
    assert kept.columns == docs.columns
    judged = quality.op8_quality(docs)
    assert kept.count() == judged.where("kept").count() <= sum(not brute.quality(r[1])[-1] for r in rows)
    assert kept.where(F.length("text") == 0).count() == 0


def test_empty_table(no_docs):
    assert quality.op8_quality(no_docs).collect() == [] and quality.passing(no_docs).collect() == []

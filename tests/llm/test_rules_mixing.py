import hashlib
import math
import re
from collections import Counter

import pytest

from catalog_sync.llm import mixing, quality_rules, registered
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plain_features(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(grams)
    inside = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside))


def check_features(rows, texts):
    for r in rows:
        want = plain_features(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, r["doc_id"]
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_features(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
    rows = registered.op6_quality_rules(spark, f"/root/testdata/{sf}").collect()
    assert len(rows) == len(texts)
    check_features(rows, texts)
    assert all(not (r["kept"] and r["base_failed"]) for r in rows)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("n_words", F.lit("clash"))
    rows = quality_rules.with_features(docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain_features(r["text"])
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (3, None, None), (999, 1, 0)], "doc_id long, quality int, toxic int")
    for d in (odd_docs, no_docs):
        f = quality_rules.with_features(d)
        for lab in (labels, labels.limit(0)):
            out = quality_rules.apply_rules(f, quality_rules.fit_cutoffs(f, lab))
            assert out.count() == d.count() and out.filter("kept AND base_failed").count() == 0


def tail(n, r, p):
    return 1.0 if r >= n * p else min(1.0, sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(r + 1)))


def test_binomial_tail(spark):
    cases = [(n, r, p) for p in (0.01, 0.2) for n in (0, 1, 50, 2000) for r in (0, 1, 5, 17, 39) if r <= n]
    for p in (0.01, 0.2):
        frame = spark.createDataFrame([(n, r) for n, r, q in cases if q == p], "n long, r long")
        for row in frame.withColumn("t", quality_rules.binomial_tail(F.col("n"), F.col("r"), p)).collect():
            assert row["t"] == pytest.approx(tail(row["n"], row["r"], p), rel=1e-9)


def labelled(spark, n_good=3000, n_bad=400):
    rows = []
    for s in ("en", "de"):
        for i in range(n_good):
            rows.append((len(rows), s, 100, 500, 3 if i % 500 else 60, 10, 0, 0, 1))
        for _ in range(n_bad):
            rows.append((len(rows), s, 100, 500, 250, 10, 0, 0, 0))
    rows += [(len(rows) + i, "tiny", 100, 500, 3, 10, 0, 0, 1) for i in range(20)]
    cols = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, quality int"
    df = spark.createDataFrame(rows, cols).withColumn("base_failed", F.lit(False))
    return df.drop("quality"), df.select("doc_id", "quality", F.lit(0).alias("toxic"))


def test_cutoffs_are_proven(spark):
    features, labels = labelled(spark)
    cuts = {r["stratum"]: r["cutoffs"] for r in quality_rules.fit_cutoffs(features, labels).collect()}
    assert cuts["tiny"] == {}  # twenty good documents prove nothing
    level, per_rule = 0.05 / (len(quality_rules.RULES) * 3), 0.05 / len(quality_rules.RULES)
    rule = quality_rules.RULES[0]
    for s in ("en", "de"):
        certified = []
        for c in rule.cutoffs:
            r = sum(1 for i in range(3000) if (3 if i % 500 else 60) / 100 > c)
            if tail(3000, r, per_rule) > level:
                break
            certified.append(c)
        assert cuts[s] == {"symbols": next(c for c in certified if c < 2.5)}  # all later ones reject the same bad documents
    out = quality_rules.apply_rules(features, quality_rules.fit_cutoffs(features, labels)).join(labels, "doc_id")
    assert out.filter("quality = 0 AND kept").count() == 0 and out.filter("quality = 1 AND NOT kept").count() == 0
    noise = labels.withColumn("quality", F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0))  # labels that follow nothing
    out = quality_rules.apply_rules(features, quality_rules.fit_cutoffs(features, noise)).join(noise, "doc_id")
    assert out.filter("quality = 1 AND NOT kept").count() <= 0.05 * out.filter("quality = 1").count()


def test_rules_run_without_python(spark):
    plan = registered.op6_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_copies(doc_id, rate, seed=mixing.SEED):
    u = (int(hashlib.md5(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    k, pmf, at_most = 0, math.exp(-rate), math.exp(-rate)
    while at_most <= u:
        k += 1
        pmf *= rate / k
        at_most += pmf
    return k


def test_mix_draws_poisson_counts(spark, odd_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd_docs).withColumn("copy", F.lit("clash"))
    weights = spark.createDataFrame([("src0", 5.0), ("src1", 1.0), (None, 2.0), ("s0", 9.0), ("absent", 50.0), ("src2", -1.0), ("src3", None)], "source string, weight double")
    rates = mixing.repetition_rates(docs, weights, size_ratio=2.0)
    by = {r["source"]: r for r in rates.collect()}
    total = docs.count()
    assert by["src0"]["rate"] == pytest.approx(5 / 17 * 2 * total / by["src0"]["n_docs"]) and by["src2"]["rate"] == 0
    out = mixing.mix(docs, rates)
    got = Counter((r["doc_id"], r["text"], r["source"]) for r in out.collect())
    want = Counter()
    for r in docs.collect():
        want[(r["doc_id"], r["text"], r["source"])] += plain_copies(r["doc_id"], by[r["source"]]["rate"])
    assert got == +want and out.columns.count("copy") == 1
    assert all(r["copy"] <= r["n_copies"] for r in out.collect())


def test_mix_matches_the_target(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    rates = mixing.repetition_rates(docs, power=0.0)
    shares = {r["source"]: r["n"] for r in mixing.mix(docs, rates).groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    for n in shares.values():
        assert abs(n - 30_000 / 8) < 5 * math.sqrt(30_000 / 8)


def test_large_rates_and_empty(spark, no_docs):
    one = spark.createDataFrame([(i, "a") for i in range(40)] + [(100 + i, "b") for i in range(400)], "doc_id long, source string")
    weights = spark.createDataFrame([("a", 1.0)], "source string, weight double")
    rates = mixing.repetition_rates(one, weights, size_ratio=90.0)
    by = {r["doc_id"]: r["n_copies"] for r in mixing.mix(one, rates).collect()}
    assert set(by) <= set(range(40)) and abs(sum(by.values()) - 440 * 90) < 6 * math.sqrt(440 * 90)
    assert mixing.mix(no_docs, mixing.repetition_rates(no_docs)).count() == 0


def test_very_large_rates_need_no_long_table(spark, monkeypatch):
    rates = spark.createDataFrame([("a", 50_000.0), ("b", 300.0), ("c", 1.5), ("d", 0.0), (None, 2.0e6)], "source string, rate double")
    by = {r["source"]: r for r in mixing.with_distribution(rates).collect()}
    assert len(by["a"]["cdf"]) < 24 * 50_000**0.5 + 70 and len(by[None]["cdf"]) < 24 * 2.0e6**0.5 + 70 and by["c"]["first"] == 0
    for s in ("a", "b", None):
        rate, cdf, first = by[s]["rate"], by[s]["cdf"], by[s]["first"]
        for k in (0, len(cdf) // 3, len(cdf) // 2, len(cdf) - 1):
            pmf = math.exp(-rate + (first + k) * math.log(rate) - math.lgamma(first + k + 1))
            assert cdf[k] - (cdf[k - 1] if k else 0.0) == pytest.approx(pmf, rel=1e-6, abs=1e-12)
        assert cdf[-1] == pytest.approx(1.0, abs=1e-6)
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "c"), (4, "d")], "doc_id long, source string")
    got = mixing.mix(docs, rates.filter("source IS NOT NULL"))
    counts = {r["doc_id"]: (r["n"], r["d"], r["m"]) for r in got.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("copy").alias("d"), F.max("copy").alias("m")).collect()}
    assert all(n == d == m and abs(n - 50_000) < 6 * 50_000**0.5 for i, (n, d, m) in counts.items() if i < 3) and 4 not in counts
    monkeypatch.setattr(mixing, "BROADCAST_NUMBERS", 100)
    far = mixing.mix(docs, rates.filter("source IS NOT NULL"))
    assert "SortMergeJoin" in far._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, far.collect())) == sorted(map(tuple, got.collect()))


def test_mix_order_is_shuffled_and_stable(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source")
    rates = mixing.repetition_rates(docs)
    a = [r["doc_id"] for r in mixing.mix(docs, rates).collect()]
    b = [r["doc_id"] for r in mixing.mix(docs.repartition(5), rates).collect()]
    assert a == b and a != sorted(a)
    assert "Python" not in mixing.mix(docs, rates)._jdf.queryExecution().executedPlan().toString()

"""The pipeline's stages against brute force, and over odd and empty tables."""

import pytest

import corpus_pipeline as pipeline
from catalog_sync.llm import importance, mixing, packing, registered, simhash
from catalog_sync.llm.tables import Scratch
from pyspark.sql import functions as F
from tests.llm.test_rules_mixing import plain_copies, plain_features
from tests.llm.test_simhash import components, plain_fingerprint

SF = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int, toxic int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_run_equals_its_stages_by_brute_force(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = scratch.write(pipeline.rules_stage(spark, docs, SF), "good")
    texts = {r["doc_id"]: r for r in docs.collect()}
    fine = {i for i, r in texts.items() if (f := plain_features(r["text"]))[0] >= 10 and 100 * f[4] <= 20 * f[0]}
    assert good.columns == docs.columns and {r["doc_id"] for r in good.collect()} == fine  # so few labels prove no cutoff
    clean = scratch.write(pipeline.classifier_stage(spark, good, SF), "clean")
    judged = importance.resample(good, spark.read.parquet(f"{SF}/labels.parquet"), scratch)
    assert rows(clean.select("doc_id")) == rows(judged.filter("kept").select("doc_id"))
    apart = scratch.write(pipeline.near_dedup_stage(spark, clean, SF), "apart")
    ordered = clean.orderBy("doc_id").collect()
    roots = components([plain_fingerprint(r["text"], 3) for r in ordered], 2)
    assert rows(apart) == sorted((tuple(r) for i, r in enumerate(ordered) if roots[i] == i), key=str)
    mixed = scratch.write(pipeline.mixing_stage(spark, apart, SF), "mixed")
    rates = {r["source"]: r["rate"] for r in mixing.repetition_rates(apart).collect()}
    want = [tuple(r) for r in apart.collect() for _ in range(plain_copies(r["doc_id"], rates[r["source"]]))]
    assert rows(mixed) == sorted(want, key=str)
    packed = pipeline.run(spark, SF)
    n_tokens = sum(len(x) + 1 for x in packing.encoder(registered.bpe_tokenizer())([r[1] for r in want]))
    got = packed.collect()
    assert sum(r["length"] for r in got) == n_tokens and sum(r["piece"] == 0 for r in got) == len(want)
    held = {}
    for r in got:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in held.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False)) and sum(places[-1]) <= 1024


@pytest.fixture
def folder(spark, tmp_path):
    def make(docs, labels):
        docs.write.parquet(f"{tmp_path}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/labels.parquet")
        return str(tmp_path)

    return make


def test_odd_tables(spark, folder, odd_docs):
    extra = odd_docs.withColumn("kept", F.lit("x")).withColumn("copy", F.lit(1)).withColumn("simhash", F.lit("y")).withColumn("n_words", F.lit(None).cast("int"))
    path = folder(extra, spark.createDataFrame([(1, 1, 0), (None, None, None)], LABELS))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns
        stage(spark, docs, path).count()
    assert pipeline.STAGES[-1][1](spark, docs, path).filter("piece = 0").count() == docs.count()
    pipeline.run(spark, path).count()


def test_empty_tables_and_nothing_left_behind(spark, folder, no_docs):
    path = folder(no_docs, spark.createDataFrame([], LABELS))
    before = len(Scratch.live)
    assert pipeline.run(spark, path).count() == 0
    assert len(Scratch.live) == before + 1  # the result alone


def test_near_dedup_keeps_one_of_repeated_rows(spark, scratch):
    docs = spark.createDataFrame([(4, "a b c d"), (4, "a b c d"), (9, "a b c d"), (4, "other words than those before them"), (None, "q"), (None, "q")], "doc_id long, text string")
    kept = simhash.drop_near_duplicates(docs, shingle=3, max_distance=2, scratch=scratch)
    assert rows(kept) == sorted([(4, "a b c d"), (4, "other words than those before them"), (None, "q")], key=str)


def test_input_columns_keep_their_values(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mine = {"kept": F.lit("mine"), "N_words": F.lit(-5), "copy": F.col("doc_id") * 3, "simhash": F.lit("s"), "log_weight": F.lit(None).cast("int"),
            "gumbel_score": F.lit(2.5), "base_failed": F.lit("b"), "rejected_by": F.lit(1), "shuffle_key": F.lit("k"), "n_copies": F.lit(-1), "odd.name": F.lit("o")}
    clash = docs.select("*", *[v.alias(k) for k, v in mine.items()])
    for name, stage in pipeline.STAGES[:-1]:
        plain, out = stage(spark, docs, SF), stage(spark, clash, SF)
        assert out.columns == clash.columns, name
        assert rows(out.select(*docs.columns)) == rows(plain), name
        for r in out.collect():
            assert r["kept"] == "mine" and r["N_words"] == -5 and r["copy"] == 3 * r["doc_id"] and r["n_copies"] == -1 and r["odd.name"] == "o" and r["gumbel_score"] == 2.5


def test_rules_are_fitted_on_labelled_texts_alone(spark, scratch):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    from catalog_sync.llm import quality_rules

    whole = quality_rules.fit_cutoffs(scratch.write(quality_rules.with_features(docs.select("doc_id", "lang", "text")).drop("text"), "all"), labels)
    kept = quality_rules.apply_rules(quality_rules.with_features(docs), whole).filter("kept").select("doc_id")
    assert rows(pipeline.rules_stage(spark, docs, sf).select("doc_id")) == rows(kept)

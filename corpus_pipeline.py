"""A training-data pipeline of five of the operators, each stage's rows written as Parquet and read again by the next.

Quality rules, then the quality classifier, drop documents; of each group of
near-duplicates one document stays; sources are mixed to target weights;
the mix is packed into training sequences.

Defined cases, for every stage: null texts are empty (the rules reject them, having no words); a null language or source
is a stratum or source of its own; a null id is an id like others (such documents are unlabelled); rows that repeat an id with equal texts count as
copies, so near-dedup keeps one of them; without labels neither the rules' cutoffs nor the classifier reject
anything; empty tables give empty results. All but the last stage return the input's columns with their values, also those named like a column that
an operator adds (``kept``, ``n_words``, ``copy`` ...): an operator sees other names for all columns it doesn't read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_sync.llm import importance, mixing, packing, quality_rules, simhash
from catalog_sync.llm.registered import bpe_tokenizer
from catalog_sync.llm.tables import Scratch, bounded_broadcast

#: The classifier and the tokenizer can't be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


#: Labelled ids (8 bytes each) up to which they are broadcast to pick the labelled documents; more are joined by a shuffle.
MAX_BROADCAST_IDS = 1_000_000


def _apart(docs: DataFrame, *read: str) -> DataFrame:
    """``docs`` with the columns that an operator reads, and all others under names that no operator uses."""
    return docs.select(*[F.col(f"`{c}`") if c in read else F.col(f"`{c}`").alias(f"__in_{i}") for i, c in enumerate(docs.columns)])


def _back(rows: DataFrame, docs: DataFrame, *read: str) -> DataFrame:
    """The columns of ``docs`` from rows of :func:`_apart`."""
    return rows.select(*[F.col(f"`{c}`") if c in read else F.col(f"__in_{i}").alias(c) for i, c in enumerate(docs.columns)])


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` that neither the base rules nor a proven cutoff rejects; the cutoffs are fitted on the labelled ones' features alone."""
    labels, read = spark.read.parquet(f"{sf_dir}/labels.parquet"), ("doc_id", "lang", "text")
    scratch = Scratch(spark, "rules")
    labelled = bounded_broadcast(labels.select("doc_id").filter("doc_id IS NOT NULL").distinct(), MAX_BROADCAST_IDS)
    fit = docs.select(*read).join(labelled, "doc_id", "left_semi")
    features = scratch.write(quality_rules.with_features(fit).drop("text"), "features")
    cutoffs = scratch.write(quality_rules.fit_cutoffs(features, labels), "cutoffs")
    judged = quality_rules.apply_rules(quality_rules.with_features(_apart(docs, *read)), cutoffs)
    return _back(judged.filter("kept"), docs, *read)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` that importance resampling keeps."""
    labels, read = spark.read.parquet(f"{sf_dir}/labels.parquet"), ("doc_id", "text")
    judged = importance.resample(_apart(docs, *read), labels, Scratch(spark, "classifier"), keep_text=True)
    return _back(judged.filter("kept"), docs, *read)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group of ``docs``."""
    read = ("doc_id", "text")
    return _back(simhash.drop_near_duplicates(_apart(docs, *read), shingle=3, max_distance=2, scratch=Scratch(spark, "near-dedup")), docs, *read)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies of ``docs`` that the target weights ask for, shuffled."""
    read = ("doc_id", "source")
    return _back(mixing.mix(_apart(docs, *read), mixing.repetition_rates(docs)), docs, *read)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of ``docs`` with their sequences and places."""
    packed = packing.pack_documents(docs.select("doc_id", "text"), bpe_tokenizer(), Scratch(spark, "packing"), with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules_stage),
    ("quality_classifier", classifier_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``; what a stage needed is deleted when the next one's input is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        others = list(Scratch.live)
        rows = stage(spark, docs, sf_dir)
        written = Scratch(spark, "pipeline")
        docs = written.write(rows, name)
        for used in [s for s in Scratch.live if s not in others and s is not written] + ([before] if before else []):
            used.release()
        before = written
    return docs

"""Quality classifier by importance resampling over hashed n-grams.

Two generative models are counted over hashed n-grams (words and runs of
punctuation, and their bigrams): one of the target, documents labelled good, one of
all raw text. A document's log weight is the sum of the log ratios of its n-grams. Gumbel
noise, hashed from the seed and the id, is added, and the ``k`` documents with the
largest sums are kept: a weighted sample without replacement.

``k`` is not a fixed number: it is the count of documents whose weight reaches that
of all but ``lost_good`` of the held-out documents labelled good, so a filter
with these parameters keeps clean documents and loses what looks unlike them.

The target model and the holdout take at most ``max_labelled`` documents
labelled good together (those with the smallest hashes of their ids, dealt to either by
another hash); everything else covers all rows. The models are ``n_buckets`` numbers each.

Defined cases: null and empty texts have weight 0; repeated rows are judged each,
rows that tie with the k-th are all kept; a null id is hashed like the text
``null``; without good labels every document is kept; an empty table gives an
empty result; other columns are kept, those named like a result column give way.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_sync.llm.mixing import hash_uniform
from catalog_sync.llm.tables import Scratch, replace_columns
from catalog_sync.llm.tokens import text_batches

SEED = "importance-1"
N_BUCKETS = 10_000
MAX_LABELLED = 40_000
_TOKENS = re.compile(rb"[0-9a-z_\x80-\xff]+|[^0-9a-z_\x80-\xff\s]+")


class Hasher:
    """Buckets of a text's word and word-pair n-grams. Hashes of words seen are kept, up to a bound."""

    def __init__(self, n_buckets: int, most_words: int = 200_000):
        self.n_buckets, self.most_words, self.seen = np.uint64(n_buckets), most_words, {}

    def buckets(self, text: bytes) -> np.ndarray:
        import xxhash

        seen, digest = self.seen, xxhash.xxh64_intdigest
        if len(seen) > self.most_words:
            seen.clear()
        words = _TOKENS.findall(text.lower())
        for w in set(words):
            if w not in seen:
                seen[w] = digest(w)
        h = np.array([seen[w] for w in words], np.uint64)
        pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:]) * np.uint64(0xD6E8FEB86659FD93)
        return (np.concatenate([h, pairs ^ (pairs >> np.uint64(32))]) % self.n_buckets).astype(np.int64)


def _binary(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def good_labels(labels: DataFrame) -> DataFrame:
    """Ids labelled good (``quality`` 1, and not ``toxic`` where given) and never otherwise."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    good = (F.col("quality") == 1) & (toxic == 0)
    return labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.every(good).alias("good")).filter("good").select("doc_id")


def fit_ratios(docs: DataFrame, target_ids: DataFrame, *, n_buckets: int = N_BUCKETS, text: str = "text", doc_id: str = "doc_id") -> np.ndarray:
    """Log ratio of the smoothed bucket probabilities, target over raw. ``target_ids`` is bounded and broadcast,
    so one scan counts both models; tasks send sums per bucket."""
    flagged = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).join(
        F.broadcast(target_ids.select("doc_id", F.lit(True).alias("target"))), "doc_id", "left").select("text", "target")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sums = Hasher(n_buckets), np.zeros((2, n_buckets), np.int64)
        for batch in batches:
            for t, target in zip(_binary(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                n = np.bincount(hasher.buckets(t.as_py()), minlength=n_buckets)
                sums[0] += n
                if target:
                    sums[1] += n
        used = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums[0][used]), pa.array(sums[1][used])], names=["bucket", "raw", "target"])

    counts = np.ones((2, n_buckets))
    for r in flagged.mapInArrow(count, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("r"), F.sum("target").alias("t")).collect():
        counts[:, r["bucket"]] += (r["r"], r["t"])  # at most n_buckets rows
    shares = np.log(counts / counts.sum(axis=1, keepdims=True))
    return shares[1] - shares[0]


def with_log_weight(docs: DataFrame, ratios: np.ndarray, *, text: str = "text", name: str = "log_weight") -> DataFrame:
    """``docs`` with the sum of the log ratios of each whole text's n-grams; one pass, no shuffle."""
    rest = [c for c in docs.columns if c.lower() not in (text.lower(), name.lower())]
    schema = T.StructType([*[docs.schema[c] for c in rest], docs.schema[text], T.StructField(name, T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(len(ratios))
        for batch in text_batches(batches, 16 << 20):
            values = [float(ratios[hasher.buckets(t.as_py() or b"")].sum()) for t in _binary(batch.column(len(rest)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=[*rest, text, name])

    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`")).mapInArrow(score, schema)


def kth_largest(table: DataFrame, column: str, k: int, *, n_bins: int = 4_096, most_rows: int = 10_000) -> float:
    """The k-th largest value of a written table (1 <= k <= rows): histograms narrow the range until few rows are left."""
    x, rows = F.col(column), table
    while True:
        low, high, n = rows.agg(F.min(x), F.max(x), F.count(x)).first()
        if low == high:
            return low
        if n <= most_rows:
            return sorted((r[0] for r in rows.select(x).collect()), reverse=True)[k - 1]
        at = F.least(F.floor((x - low) / (high - low) * n_bins), F.lit(n_bins - 1))
        for r in rows.groupBy(at.alias("b")).count().orderBy(F.desc("b")).collect():  # at most n_bins rows
            if r["count"] >= k:
                rows = rows.filter(at == r["b"])
                break
            k -= r["count"]


def resample(docs: DataFrame, labels: DataFrame, scratch: Scratch, *, lost_good: float = 0.002, max_labelled: int = MAX_LABELLED, n_buckets: int = N_BUCKETS,
             keep_text: bool = False, text: str = "text", doc_id: str = "doc_id", seed: str = SEED) -> DataFrame:
    """One row per document: its columns (the text only if ``keep_text``) with ``log_weight, gumbel_score, kept``."""
    present = docs.select(F.col(f"`{doc_id}`").alias("doc_id")).distinct()
    good = good_labels(labels).join(present, "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id"))
    chosen = scratch.write(good.orderBy("h").limit(max_labelled).withColumn("fit", F.pmod(F.xxhash64("h"), F.lit(2)) == 0), "labelled")
    ratios = fit_ratios(docs, chosen.filter("fit"), n_buckets=n_buckets, text=text, doc_id=doc_id)
    noise = -F.log(-F.log(hash_uniform(seed, F.col(f"`{doc_id}`"))))
    weighted = replace_columns(with_log_weight(docs, ratios, text=text), {"gumbel_score": F.col("log_weight") + noise})
    scored = scratch.write(weighted.drop(text), "scored")
    held = scored.join(F.broadcast(chosen.filter("NOT fit").select(F.col("doc_id").alias("__llm_id"))), F.col(f"`{doc_id}`") == F.col("__llm_id"), "left_semi")
    cutoff = held.agg(F.percentile("log_weight", F.lit(lost_good))).first()[0]  # of a bounded number of rows
    k = scored.count() if cutoff is None else scored.filter(F.col("log_weight") >= cutoff).count()
    least = kth_largest(scored, "gumbel_score", k) if k else 0.0
    # with the texts the weights are computed once more, rather than writing or shuffling all texts
    return replace_columns(weighted if keep_text else scored, {"kept": F.col("gumbel_score") >= least})

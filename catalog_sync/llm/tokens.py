"""Tokenizer loading, and token counts from a digest cache.

The cache is a Parquet table with a row per tokenizer version and content
digest. Counting joins the documents' digests to the stored counts; only
distinct texts that are missing are encoded, and their counts are appended.
The content is normalised by taking null as empty and nothing else, as any
other change could change the ids. The tokenizer's version is the digest of its
files, libraries, their versions and pattern, so another file or library never
reads old counts.

Defined cases: null text is empty (0 tokens); repeated rows each get a row;
a null id stays null; an empty table gives an empty result and appends
nothing; other columns are kept, those named like a result column give way.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_sync.llm.tables import Scratch, once_per_process, replace_columns

#: Characters outside the planes on which both byte-level BPE libraries were compared, one by one (see the tests).
_OTHER = re.compile("[\U00030000-\U0010ffff]")
#: Longer texts always go to the file's own library, whose time does not depend on the text's form.
_LONG = 1_000_000

Encoder = Callable[[list[str]], list[np.ndarray]]


def _load(path: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [np.array(x, np.uint32) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)

    def exact(texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in own.encode_batch_fast(texts, add_special_tokens=False)]

    ranks_path = path[: -len(".json")] + ".tiktoken"
    if not os.path.exists(ranks_path):
        return exact
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    same = tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    special = [t.content for t in own.get_added_tokens_decoder().values()]

    def encode(texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        left = []
        for i, t in enumerate(texts):
            if len(t) > _LONG or not (t.isascii() or not _OTHER.search(t)) or any(s in t for s in special):
                left.append(i)
            else:
                out[i] = np.array(same.encode_ordinary(t), np.uint32)
        for i, ids in zip(left, exact([texts[i] for i in left]), strict=True):
            out[i] = ids
        return out

    return encode


def encoder(path: str) -> Encoder:
    """Texts to token ids as the file's library gives them, without begin, end or added special tokens.

    A ``.json`` file is read by ``tokenizers``, a ``.model`` by
    ``sentencepiece``. Where the same vocabulary lies beside the JSON file as
    ``.tiktoken`` ranks, texts without special strings are encoded by
    ``tiktoken``, which gives the same ids about five times faster.
    """
    return once_per_process("encoder:" + path, lambda: _load(path))


def tokenizer_version(path: str) -> str:
    """Digest of all that decides the ids: the file, its library and that one's version, and of a rank file beside it
    its content, its library's version and its pattern."""
    parts = [path]
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    facts = f"\n{library.__name__} {library.__version__}"
    ranks_path = path[: -len(".json")] + ".tiktoken"
    if path.endswith(".json") and os.path.exists(ranks_path):
        import public_tokenizers
        import tiktoken

        parts.append(ranks_path)
        facts += f"\ntiktoken {tiktoken.__version__} {public_tokenizers.PATTERN}"
    digest = hashlib.sha256()
    for part in parts:
        with open(part, "rb") as f:
            digest.update(f.read())
    digest.update(facts.encode())
    return digest.hexdigest()


def text_batches(batches: Iterator[pa.RecordBatch], most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of at most ``most_bytes`` (a longer row alone), so memory follows texts, not rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        per_row = max(1, batch.nbytes // batch.num_rows)
        step = max(1, most_bytes // per_row)
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _cached(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache_path) if _exists(spark, cache_path) else spark.createDataFrame([], CACHE_SCHEMA)
    # two runs may have appended the same digest at the same time
    return stored.filter(F.col("tokenizer") == version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def encode_misses(docs: DataFrame, tokenizer: str, cache_path: str, *, text: str = "text") -> None:
    """Append the counts of the distinct texts of ``docs`` that the cache lacks.

    Copies are dropped before their shuffle and after it, so a text is encoded
    once however often it occurs.
    """
    version = tokenizer_version(tokenizer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in text_batches(batches):
            n = [len(ids) for ids in encode(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.binary()), pa.array(n, pa.int64())], names=["digest", "n_tokens"])

    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    distinct = docs.select(content_digest(whole).alias("digest"), whole.alias("text")).dropDuplicates(["digest"])
    misses = distinct.join(_cached(docs.sparkSession, cache_path, version).select("digest"), "digest", "left_anti")
    counted = misses.mapInArrow(count, "digest binary, n_tokens long")
    counted.withColumn("tokenizer", F.lit(version)).write.mode("append").parquet(cache_path)


def token_counts(docs: DataFrame, tokenizer: str, cache_path: str, scratch: Scratch, *, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_bytes`` and ``n_tokens``; the cache gains what it lacked.

    The counts are written as a table of one row per digest before they are
    joined: straight from that table the join's rows are dealt by digest alone, so
    AQE splits the digest of a text that very many documents share.
    """
    encode_misses(docs, tokenizer, cache_path, text=text)
    counts = scratch.write(_cached(docs.sparkSession, cache_path, tokenizer_version(tokenizer)), "counts").withColumnRenamed("digest", "__llm_d").withColumnRenamed("n_tokens", "__llm_n")
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.withColumn("__llm_k", content_digest(whole)).withColumn("__llm_b", F.octet_length(whole).cast("long")).drop(text)
    joined = keyed.join(counts, F.col("__llm_k") == F.col("__llm_d"))
    return replace_columns(joined, {"n_bytes": F.col("__llm_b"), "n_tokens": F.col("__llm_n")}).drop("__llm_k", "__llm_d", "__llm_n", "__llm_b")

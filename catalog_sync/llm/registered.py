"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_sync.llm import ann, bpe, chat, clustering, importance, katz, mixing, packing, quality_rules, simhash, tokens, vector_codes, warc
from catalog_sync.llm.tables import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    near = simhash.near_duplicates(docs, shingle=3, max_distance=2, scratch=Scratch(spark, "op1"))
    return near.select("doc_id", simhash.fingerprint_hex(F.col("simhash")).alias("fingerprint"), "component_id", "n_docs", "n_links")


def bpe_tokenizer() -> str:
    """The public byte-level BPE file that the queries count and pack with."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The cache is new for each call, so the query's cost is that of encoding every distinct text.
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scratch = Scratch(spark, "op2")
    counted = tokens.token_counts(docs, bpe_tokenizer(), scratch.place("cache"), scratch)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op3_adaptive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0"), Scratch(spark, "op3"), k=10).select(
        F.col("query_id").cast("long"), "rank", "vec_id", "score")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = packing.pack_documents(docs, bpe_tokenizer(), Scratch(spark, "op4"), with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    # bigrams: trigrams need over 4.5 times the input of disk (see README), more than the check tool allows
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return katz.score(docs.select("doc_id", held_out.alias("held_out"), "text"), Scratch(spark, "op5"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    features = Scratch(spark, "op6").write(quality_rules.with_features(docs).drop("text"), "features")
    cutoffs = quality_rules.fit_cutoffs(features, _table(spark, sf_dir, "labels"))
    judged = quality_rules.apply_rules(features, cutoffs)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         F.concat_ws(",", "rejected_by").alias("rejected_by"))


def _op6_sql(alpha: float = 0.05, delta: float = 0.05) -> str:
    """The rules in SQL: windows and labels as rows, the binomial tail as a sum of its terms."""
    rules = quality_rules.RULES
    tests = ", ".join(f"('{r.name}', {i}, {c}::DOUBLE)" for r in rules for i, c in enumerate(r.cutoffs))
    ratio = lambda r: "{}::DOUBLE / nullif({}, 0)".format(*r.value.split(" / "))
    values = " UNION ALL ".join(f"SELECT doc_id, '{r.name}' AS rule, {ratio(r)} * {1 if r.above else -1} AS v, {1 if r.above else -1} AS side FROM f" for r in rules)
    per_rule = alpha / len(rules)
    return rf"""
WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
u AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS win FROM w, unnest(range(1, len(ws) - 3)) AS g(i)),
again AS (SELECT doc_id, win FROM u GROUP BY ALL HAVING count(*) > 1),
cover AS (SELECT u.doc_id, count(DISTINCT u.i + k) AS n FROM u JOIN again USING (doc_id, win), unnest(range(0, 5)) AS h(k) GROUP BY u.doc_id),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM w) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
f AS (SELECT w.doc_id, w.lang, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(cover.n, 0)::BIGINT AS n_repeat_words, n_lines
      FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN cover USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
v AS ({values}),
lab AS (SELECT doc_id, min(quality) = 1 AS good FROM labels WHERE quality IN (0, 1) AND doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = max(quality)),
held AS (SELECT b.doc_id, b.lang, lab.good FROM b JOIN lab USING (doc_id) WHERE NOT base_failed),
strata AS (SELECT lang, count(*) FILTER (good) AS n_good FROM held GROUP BY lang),
hits AS (SELECT s.lang, s.n_good, c.rule, c.i, c.cutoff, count(*) FILTER (x.good) AS r, count(*) FILTER (NOT x.good) AS bad
         FROM strata s CROSS JOIN (VALUES {tests}) AS c(rule, i, cutoff)
         LEFT JOIN (held JOIN v USING (doc_id)) AS x ON x.lang IS NOT DISTINCT FROM s.lang AND x.rule = c.rule AND x.v > c.cutoff * x.side GROUP BY ALL),
p AS (SELECT *, r < n_good * {per_rule!r} AND (SELECT sum(exp(lgamma(n_good + 1) - lgamma(k + 1) - lgamma(n_good - k + 1) + k * ln({per_rule!r}) + (n_good - k) * ln(1 - {per_rule!r})))
                FROM unnest(range(0, r + 1)) AS z(k)) <= {delta!r} / ({len(rules)} * (SELECT count(*) FROM strata)) AS ok FROM hits),
proven AS (SELECT *, bool_and(ok) OVER (PARTITION BY lang, rule ORDER BY i) AS all_ok FROM p),
cut AS (SELECT lang, rule, cutoff FROM proven WHERE all_ok AND bad > 0 QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY bad DESC, i) = 1),
gone AS (SELECT b.doc_id, list(v.rule) AS rules FROM b JOIN v USING (doc_id) JOIN cut ON cut.lang IS NOT DISTINCT FROM b.lang AND cut.rule = v.rule AND v.v > cut.cutoff * v.side GROUP BY b.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND gone.rules IS NULL AS kept,
  concat_ws(',', CASE WHEN base_failed THEN 'base' END, {", ".join(f"CASE WHEN list_contains(gone.rules, '{r.name}') THEN '{r.name}' END" for r in rules)}) AS rejected_by
FROM b LEFT JOIN gone USING (doc_id)"""


def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resample(docs, _table(spark, sf_dir, "labels"), Scratch(spark, "op7")).select("doc_id", "log_weight", "gumbel_score", "kept")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    scratch = Scratch(spark, "op9")
    folder = f"{scratch.path}/archive"
    manifest = warc.write_warc(warc.plan_records(pages), folder, scratch)
    records = scratch.write(warc.read_warc(manifest, folder).drop("payload"), "records")
    kind = dict(pages.dtypes)["page_id"]
    return warc.resolve_revisits(records).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


OP9_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""


def op8_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return mixing.mix(docs, mixing.repetition_rates(docs))


OP8_SQL = """
WITH n AS (SELECT source, count(*) AS n_docs FROM documents GROUP BY source),
t AS (SELECT sum(sqrt(n_docs)) AS raw_all, sum(n_docs) AS n_all FROM n),
r AS (SELECT source, sqrt(n_docs) / raw_all * n_all / n_docs AS rate FROM n, t),
p AS (SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS pmf FROM r, range(0, 400) AS s(k)),
c AS (SELECT source, k, sum(pmf) OVER (PARTITION BY source ORDER BY k) AS at_most FROM p),
d AS (SELECT *, (('0x' || substr(md5('mix-1:' || doc_id), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u FROM documents),
e AS (SELECT d.doc_id, d.source, (SELECT count(*) FROM c WHERE c.source = d.source AND c.at_most <= d.u) AS n_copies FROM d)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, e.n_copies, g.copy, md5('mix-1:' || d.doc_id || ':' || g.copy) AS shuffle_key
FROM documents d JOIN e USING (doc_id), unnest(range(1, e.n_copies + 1)) AS g(copy)
"""


def _chat_rows(conversations: DataFrame) -> DataFrame:
    """The table's turns with parts, and conversation -1, whose texts are control strings."""
    spark = conversations.sparkSession
    marks = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = conversations.select("conv_id", "turn", "role", "text").union(marks)
    return rows.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = chat.format_chats(_chat_rows(_table(spark, sf_dir, "conversations")))
    back = chat.parse_chats(chats)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


OP10_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1::BIGINT, 0::BIGINT, 'user', '</s>[INST] ok [/INST]'), (-1::BIGINT, 1::BIGINT, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(24 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n') || chr(1) || text, '([<\[])(\\*)(/?s>|/?INST\]|\|(im_start|im_end|endoftext|image|audio|document)\|>)', '\1\\\2\3', 'g')) - 1)::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.encode_texts(_table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, pattern).drop("text")
    return bpe.decode_ids(coded, ranks, pattern).select(
        "doc_id", "n_tokens", bpe.hex_digest(F.col("ids")).alias("ids_sha256"), bpe.hex_digest(F.col("decoded")).alias("decoded_sha256"))


def op12_shallot_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.sha2(F.concat(F.lit("2:"), F.col("id").cast("string")), 256)
    return clustering.cluster(_table(spark, sf_dir, "embeddings"), Scratch(spark, "op12"), k=40, n_rounds=5, scale=256, dim=64, order=order)


def _finite_sql(scale: int, only: str) -> str:
    """Rows numbered, with their integer components."""
    return f"""SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND {only} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


def _floor_div(total: str, n: str) -> str:
    return f"(({total} - (({total} % {n}) + {n}) % {n}) // {n})::BIGINT"


def _op12_sql(k: int = 40, n_rounds: int = 5) -> str:
    """The rounds as CTEs: all distances, the nearest by distance and number, floor means where a cluster has vectors."""
    steps = []
    for i in range(n_rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, arg_min(c, (dist, c)) AS c, min(dist) AS dist
  FROM (SELECT x.r, e.c, sum((x.x - e.x) * (x.x - e.x)) AS dist FROM x JOIN c{i} AS e USING (d) GROUP BY ALL) GROUP BY r)""")
        if i < n_rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT o.c, o.d, coalesce({_floor_div("m.s", "m.n")}, o.x) AS x
  FROM c{i} AS o LEFT JOIN (SELECT c, d, sum(x) AS s, count(*) AS n FROM x JOIN a{i} USING (r) GROUP BY ALL) AS m USING (c, d))""")
    return f"""
WITH kept AS MATERIALIZED ({_finite_sql(256, "len(embedding) = 64")}),
x AS MATERIALIZED (SELECT r, unnest(range(64)) AS d, unnest(v) AS x FROM kept),
s AS (SELECT r, row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS c FROM kept QUALIFY c < {k}),
c0 AS MATERIALIZED (SELECT c, d, x FROM x JOIN s USING (r)),
{", ".join(steps)},
h AS (SELECT c, sha256(string_agg(x::BIGINT, ',' ORDER BY d)) AS centroid_sha256 FROM c{n_rounds} GROUP BY c)
SELECT vec_id, c::INT AS cluster, dist::BIGINT AS distance, (sum(dist) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(dist) OVER ())::BIGINT AS inertia, centroid_sha256
FROM kept JOIN a{n_rounds} USING (r) JOIN h USING (c)"""


def op13_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = vector_codes.compress(_table(spark, sf_dir, "embeddings"), Scratch(spark, "op13"), n_parts=8, n_entries=16, n_rounds=6, scale=4096)
    return vector_codes.with_label_error(codes.vectors).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codes.digest()).alias("codebooks_sha256"))


def _op13_sql(n_parts: int = 8, n_entries: int = 16, n_rounds: int = 6) -> str:
    """The rounds as CTEs, every part by its position ``p``; entries ``e`` of codebook ``p`` have components by ``d``."""
    steps = []
    for i in range(n_rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, p, arg_min(e, (dist, e)) AS e, min(dist) AS dist
  FROM (SELECT x.r, x.p, b.e, sum((x.x - b.x) * (x.x - b.x)) AS dist FROM x JOIN b{i} AS b USING (p, d) GROUP BY ALL) GROUP BY r, p)""")
        if i < n_rounds:
            steps.append(f"""b{i + 1} AS MATERIALIZED (SELECT o.p, o.e, o.d, coalesce({_floor_div("m.s", "m.n")}, o.x) AS x
  FROM b{i} AS o LEFT JOIN (SELECT p, e, d, sum(x) AS s, count(*) AS n FROM x JOIN a{i} USING (r, p) GROUP BY ALL) AS m USING (p, e, d))""")
    return f"""
WITH fine AS ({_finite_sql(4096, f"len(embedding) > 0 AND len(embedding) % {n_parts} = 0")}),
kept AS MATERIALIZED (SELECT * FROM fine WHERE len(v) = (SELECT len(embedding) FROM embeddings WHERE len(embedding) > 0 AND len(embedding) % {n_parts} = 0 GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1)),
w AS (SELECT r, unnest(range(len(v))) AS i, unnest(v) AS x, len(v) // {n_parts} AS width FROM kept),
x AS MATERIALIZED (SELECT r, i // width AS p, i % width AS d, x FROM w),
s AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM kept QUALIFY e < {n_entries}),
b0 AS MATERIALIZED (SELECT p, e, d, x FROM x JOIN s USING (r)),
{", ".join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(dist)::BIGINT AS error FROM a{n_rounds} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::BIGINT, ',' ORDER BY p, e, d)) FROM b{n_rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_near_dedup, op2_token_counts, op3_adaptive_ann, op4_best_fit_packing, op5_katz_scoring, op6_quality_rules,
        op7_importance_resampling, op8_poisson_mixing, op9_warc,
        op10_chat_formatting, op11_byte_bpe, op12_shallot_kmeans, op13_orchard_codes)
}

ORACLE_SQL: dict[str, str] = {"op6_quality_rules": _op6_sql(), "op9_warc": OP9_SQL, "op8_poisson_mixing": OP8_SQL, "op10_chat_formatting": OP10_SQL,
                              "op12_shallot_kmeans": _op12_sql(), "op13_orchard_codes": _op13_sql()}

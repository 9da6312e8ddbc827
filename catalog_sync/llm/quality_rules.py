"""Quality rules with risk-controlled thresholds (DataFrame operations only).

Features of each whole text feed one-sided rules ("reject if the feature is
beyond the cutoff"). Cutoffs are not guessed: documents labelled good are the
holdout on which the false rejection rate of every cutoff is tested, per
stratum, with the exact binomial tail. Cutoffs of a rule are tested from the
most lenient to the most aggressive one and testing stops at the first that
is not proven (fixed-sequence testing), so a rule in a stratum spends its share
of the error once; the shares are Bonferroni-corrected over rules x strata.
With probability ``1 - delta`` every chosen cutoff wrongly rejects at most
``alpha / rules`` of the good documents of its stratum, hence all rules
together at most ``alpha``. Where the labels prove nothing, nothing is rejected.

Defined cases: a null text counts as empty (no words, all counts 0,
``base_failed``); a null stratum is a stratum of its own; repeated rows are
judged one by one; empty tables give empty results; labels of the same
document that contradict each other, and labels without a document, are
ignored; input columns named like a result column give way to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_sync.llm.tables import WHITE_SPACE, bounded_broadcast, let, replace_columns, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
FEATURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Reject if ``value`` is above (``above``) or below a cutoff; ``cutoffs`` go from lenient to aggressive."""

    name: str
    value: str
    above: bool
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols", "n_symbols / n_words", True, (3.0, 2.0, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1)),
    Rule("long_words", "word_chars / n_words", True, (40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0)),
    Rule("short_words", "word_chars / n_words", False, (1.0, 1.5, 2.0, 2.5, 3.0, 3.5)),
    Rule("duplicate_lines", "n_dup_lines / n_lines", True, (0.9, 0.7, 0.5, 0.3, 0.2)),
    Rule("repeated_words", "n_repeat_words / n_words", True, (0.8, 0.6, 0.4, 0.2, 0.1)),
)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of five words which occurs at least twice in the text."""

    def window(w: Column, i: Column) -> Column:
        return F.concat_ws(" ", *[F.get(w, i + j) for j in range(WINDOW)])

    def covered(at: Column) -> Column:  # at: sorted starts of repeated windows
        gaps = F.transform(F.sequence(F.lit(1), F.size(at)), lambda j: F.coalesce(F.least(F.get(at, j) - F.get(at, j - 1), F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def starts(s: Column) -> Column:  # s: windows with their starts, equal windows side by side
        def start_if_repeated(j: Column) -> Column:
            same = (F.get(s, j).getField("w") == F.get(s, j - 1).getField("w")) | (F.get(s, j).getField("w") == F.get(s, j + 1).getField("w"))
            return F.when(same, F.get(s, j).getField("i"))

        return F.sort_array(F.array_compact(F.transform(F.sequence(F.lit(0), F.size(s) - 1), start_if_repeated)))

    def of_windows(windows: Column) -> Column:
        paired = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
            let(paired, lambda s: let(starts(s), covered))
        )

    def of_words(w: Column) -> Column:
        return F.when(F.size(w) <= WINDOW, F.lit(0).cast("long")).otherwise(
            let(F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: window(w, i)), of_windows)
        )

    return of_words(words)


def text_features(text: Column) -> Column:
    """Struct of :data:`FEATURES` (long) of a whole text."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(WHITE_SPACE)) != "")
    by_words = let(words_of(whole), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    by_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return F.struct(
        by_words.alias("words"),
        by_lines.alias("lines"),
        F.length(F.translate(whole, WHITE_SPACE, "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the feature columns and ``base_failed`` (too few words or too many repeated ones)."""
    f = "__llm_features"
    scored = docs.withColumn(f, text_features(F.col(f"`{text}`")))
    at = {"n_words": "words.n_words", "n_repeat_words": "words.n_repeat_words", "n_lines": "lines.n_lines", "n_dup_lines": "lines.n_dup_lines"}
    new = {k: F.col(f"{f}.{at.get(k, k)}") for k in FEATURES}
    failed = (new["n_words"] < 10) | (100 * new["n_repeat_words"] > 20 * new["n_words"])
    return replace_columns(scored, new | {"base_failed": failed}).drop(f)


def _value(rule: Rule) -> Column:
    top, bottom = rule.value.split(" / ")
    return F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double"))


def _rejects(rule: Rule, cutoff: Column) -> Column:
    hit = _value(rule) > cutoff if rule.above else _value(rule) < cutoff
    return F.coalesce(hit, F.lit(False))


def binomial_tail(n: Column, r: Column, p: float) -> Column:
    """P(Bin(n, p) <= r), summed term by term in logarithms; 1.0 from the mean on, where nothing is proven."""
    odds = F.log(F.lit(p / (1 - p)))
    first = n.cast("double") * F.log(F.lit(1 - p))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1).cast("double") / i.cast("double")) + odds
        high = F.greatest(acc["total"], term)
        return F.struct(term.alias("term"), (high + F.log(F.exp(acc["total"] - high) + F.exp(term - high))).alias("total"))

    start = F.struct(first.alias("term"), first.alias("total"))
    steps = F.when(r > 0, F.sequence(F.lit(1).cast("long"), r.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    tail = F.aggregate(steps, start, step, lambda acc: F.exp(acc["total"]))
    return F.when(r.cast("double") >= n.cast("double") * p, F.lit(1.0)).otherwise(F.least(tail, F.lit(1.0)))


def fit_cutoffs(features: DataFrame, labels: DataFrame, *, stratum: str = "lang", alpha: float = 0.05, delta: float = 0.05,
                rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per stratum: its value and a map rule name -> proven cutoff (rules without one are missing).

    ``features`` is the output of :func:`with_features` with ``doc_id``;
    ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad). Documents that
    fail the base rule take no part, as they go anyway. Of the proven cutoffs
    of a rule the one that rejects most bad documents is taken, the most
    lenient of equals, and none if no bad document is rejected. One pass over
    the labelled rows with partial aggregation; the number of strata alone reaches the driver.
    """
    label = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id").agg(F.min("quality").alias("__llm_q"), F.max("quality").alias("__llm_q2"))
        .filter("__llm_q = __llm_q2").select("doc_id", "__llm_q")
    )
    values = [F.col(c) for c in ("doc_id", *FEATURES)]
    held = (
        features.filter(~F.col("base_failed")).select(F.col(f"`{stratum}`").alias("stratum"), *values)
        .join(label, "doc_id").select("stratum", *FEATURES, (F.col("__llm_q") == 1).alias("good"))
    )
    tests = [(k, i, c, rule) for k, rule in enumerate(rules) for i, c in enumerate(rule.cutoffs)]
    counts = held.groupBy("stratum").agg(
        F.count_if("good").alias("n_good"),
        *[F.count_if(F.col("good") & _rejects(rule, F.lit(c))).alias(f"g_{k}_{i}") for k, i, c, rule in tests],
        *[F.count_if(~F.col("good") & _rejects(rule, F.lit(c))).alias(f"b_{k}_{i}") for k, i, c, rule in tests],
    )
    per_rule = alpha / len(rules)
    level = delta / (len(rules) * max(1, counts.count()))  # Bonferroni over rules and strata

    def proven(k: int, rule: Rule) -> Column:
        tested = F.array(*[
            F.struct(F.lit(-i).alias("lenient"), F.lit(float(c)).alias("cutoff"), F.col(f"b_{k}_{i}").alias("bad"),
                     (binomial_tail(F.col("n_good"), F.col(f"g_{k}_{i}"), per_rule) <= level).alias("ok"))
            for i, c in enumerate(rule.cutoffs)
        ])

        def choose(t: Column) -> Column:
            stop = F.coalesce(F.nullif(F.array_position(F.transform(t, lambda x: x["ok"]), False), F.lit(0)) - 1, F.size(t).cast("long"))
            useful = F.filter(t, lambda x: (-x["lenient"] < stop) & (x["bad"] > 0))
            best = F.array_max(F.transform(useful, lambda x: F.struct(x["bad"], x["lenient"], x["cutoff"])))
            return F.when(F.size(useful) > 0, F.struct(F.lit(rule.name).alias("key"), best["cutoff"].alias("value")))

        return let(tested, choose)

    entries = F.array_compact(F.array(*[proven(k, rule) for k, rule in enumerate(rules)]))
    return counts.select("stratum", "n_good", F.map_from_entries(entries).alias("cutoffs"))


def apply_rules(features: DataFrame, cutoffs: DataFrame, *, stratum: str = "lang", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``features`` with ``rejected_by`` (names of the rules that reject, "base" first) and ``kept``."""
    side = bounded_broadcast(cutoffs.select(F.col("stratum").alias("__llm_s"), F.col("cutoffs").alias("__llm_c")))
    joined = features.join(side, F.col(f"`{stratum}`").eqNullSafe(F.col("__llm_s")), "left")
    named = F.array(
        F.when(F.col("base_failed"), F.lit("base")),
        *[F.when(F.coalesce(_rejects(rule, F.col("__llm_c").getItem(rule.name)), F.lit(False)), F.lit(rule.name)) for rule in rules],
    )
    why = F.array_compact(named)
    return replace_columns(joined, {"rejected_by": why, "kept": F.size(why) == 0}).drop("__llm_s", "__llm_c")



"""Quality rules whose thresholds carry a guarantee against false rejection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .words import bind, word_array

SYMBOLS = "#*$%&|<>"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Scores are parts per thousand, so histograms of them are bounded.
_SCORE_TOP = 2_000
_BADNESS_TOP = 100_000
# A reference below this many parts per thousand would make noise look bad.
_LEAST_REFERENCE = 20

BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count_chars(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def repeat_words(words: Column, window: int = 3) -> Column:
    """Words inside windows of `window` words that occur twice or more.

    Windows are sorted with their places, equal neighbours are repeats, and the
    places of repeats in order tell how many words they cover together.
    """

    def pieces(i: Column) -> Column:
        return F.concat_ws(" ", *[F.get(words, i + k) for k in range(window)])

    last = F.size(words) - window
    windows = F.when(
        last >= 0,
        F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(pieces(i).alias("k"), i.alias("p"))),
    ).otherwise(F.array().cast("array<struct<k:string,p:int>>"))

    def repeated(s: Column) -> Column:
        def is_repeat(x: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(s, i - 1)["k"] == x["k"]).otherwise(False)
            after = F.when(i < F.size(s) - 1, F.get(s, i + 1)["k"] == x["k"]).otherwise(False)
            return before | after

        return F.sort_array(F.transform(F.filter(s, is_repeat), lambda x: x["p"]))

    def covered(p: Column) -> Column:
        return F.aggregate(
            p,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("at")),
            lambda a, x: F.struct(
                (a["n"] + F.least(F.lit(window), x - a["at"])).alias("n"), x.alias("at")
            ),
            lambda a: a["n"],
        )

    return bind(F.sort_array(windows), lambda s: bind(repeated(s), covered))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    with_word = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
    return bind(with_word, lambda a: F.size(a) - F.size(F.array_distinct(a)))


def measures(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", stratum: str = "lang", whole_rows: bool = False
) -> DataFrame:
    """doc_id, stratum, the base counts, base_failed and one score per rule.

    Everything is a column expression over one row, so a row never leaves its
    task. Null text counts as empty; text without words gets score 0.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    counted = bind(
        word_array(F.col(text)),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
        ),
    )
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole_rows else []
    base = docs.select(
        *row,
        F.col(key).alias("doc_id"),
        F.col(stratum).alias("stratum"),
        F.xxhash64(whole).alias("text_hash"),
        counted.alias("c"),
        count_chars(whole, SYMBOLS).cast("long").alias("n_symbols"),
        duplicate_lines(whole).cast("long").alias("n_dup_lines"),
        count_chars(whole, _CAPITALS).alias("capitals"),
        count_chars(whole, "!").alias("bangs"),
        (count_chars(whole, "\n") + 1).alias("lines"),
    ).select("*", "c.n_words", "c.word_chars", "c.n_repeat_words").drop("c")

    def rate(part: str, of: str) -> Column:
        share = F.when(F.col(of) > 0, F.floor(F.col(part) * 1000 / F.col(of))).otherwise(0)
        return F.least(share, F.lit(_SCORE_TOP)).cast("int")

    return base.select(
        *(["row"] if whole_rows else []),
        "doc_id",
        "stratum",
        "text_hash",
        *BASE_COLUMNS,
        ((F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)).alias("base_failed"),
        rate("n_symbols", "n_words").alias("score_symbols"),
        rate("n_repeat_words", "n_words").alias("score_repeats"),
        rate("n_dup_lines", "lines").alias("score_dup_lines"),
        rate("capitals", "word_chars").alias("score_capitals"),
        rate("bangs", "n_words").alias("score_bangs"),
    )


SCORES = ("score_symbols", "score_repeats", "score_dup_lines", "score_capitals", "score_bangs")


def binomial_count(n: Column, rate: float, log_level: Column) -> Column:
    """Largest k with P(Binomial(n, rate) <= k) <= exp(log_level); -1 if none.

    With at most k false rejections among n, the exact upper confidence bound
    of the rate is at most `rate`. The sum runs in logarithms up to rate * n,
    beyond which the probability exceeds any level below one half.
    """
    odds = F.lit(rate / (1 - rate))

    def add(a: Column, k: Column) -> Column:
        term = F.when(k == 0, n * F.log(F.lit(1 - rate))).otherwise(
            a["term"] + F.log((n - k + 1) / k * odds)
        )
        total = F.when(k == 0, term).otherwise(
            F.greatest(a["total"], term) + F.log1p(F.exp(-F.abs(a["total"] - term)))
        )
        return F.struct(
            term.alias("term"), total.alias("total"), (a["k"] + (total <= log_level).cast("int")).alias("k")
        )

    start = F.struct(F.lit(0.0).alias("term"), F.lit(0.0).alias("total"), F.lit(-1).alias("k"))
    return F.aggregate(F.sequence(F.lit(0), F.floor(n * rate).cast("int")), start, add, lambda a: a["k"])


def thresholds(
    scored: DataFrame,
    labels: DataFrame,
    *,
    max_false_rejection: float,
    risk: float,
    cost: float,
) -> tuple[DataFrame, DataFrame]:
    """(references, cutoffs) per stratum, learnt from labelled documents.

    Half of the labelled texts, by text hash, propose: the reference of a rule
    is its 99th percentile over good documents, the badness of a document is
    its highest score in units of the reference, and the proposed cutoff rejects
    most bad ones at `cost` bad ones per good one. The other half decides: going
    from the most lenient cutoff to stricter ones, a cutoff stands while the
    exact binomial test at level `risk` / number of strata (Bonferroni) shows
    that less than `max_false_rejection` of good documents lie above it. The
    test depends on the cutoff by its count of false rejections alone, so the
    walk ends at a count that `binomial_count` gives. The more lenient of the
    two cutoffs is used. With probability 1 - `risk` all strata keep the limit;
    a stratum with too few labels to show it gets no cutoff.
    """
    known = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    seen = materialize(
        scored.filter(~F.col("base_failed"))
        .join(known, "doc_id")
        .select("stratum", *SCORES, "quality", (F.pmod("text_hash", F.lit(2)) == 1).alias("holdout")),
        "quality-labelled",
    )
    references = materialize(
        seen.filter((F.col("quality") == 1) & ~F.col("holdout"))
        .groupBy(F.col("stratum").alias("of"))
        .agg(*[F.greatest(F.percentile(s, 0.99), F.lit(float(_LEAST_REFERENCE))).alias(f"ref_{s}") for s in SCORES]),
        "quality-references",
    )
    histogram = materialize(
        with_badness(seen, references)
        .filter(F.col("badness").isNotNull())
        .groupBy("stratum", "holdout", "badness")
        .agg(
            F.sum((F.col("quality") == 1).cast("long")).alias("good"),
            F.sum((F.col("quality") == 0).cast("long")).alias("bad"),
        ),
        "quality-histogram",
    )
    above = Window.partitionBy("stratum", "holdout").orderBy(F.desc("badness")).rowsBetween(Window.unboundedPreceding, -1)
    tails = histogram.withColumns(
        {
            "good_above": F.coalesce(F.sum("good").over(above), F.lit(0)),
            "bad_above": F.coalesce(F.sum("bad").over(above), F.lit(0)),
        }
    )
    gain = F.col("bad_above") - F.lit(float(cost)) * F.col("good_above")
    proposed = (
        tails.filter(~F.col("holdout"))
        .groupBy("stratum")
        .agg(F.max(F.struct(gain.alias("gain"), F.col("badness").alias("cut"))).alias("best"))
        .filter(F.col("best.gain") > 0)
        .select(F.col("stratum").alias("of"), F.col("best.cut").alias("proposed"))
    )
    tested = histogram.filter("holdout").groupBy("stratum").agg(F.sum("good").alias("n"))
    strata = tested.agg(F.count(F.lit(1)).alias("strata")).scalar()
    log_level = F.log(F.lit(float(risk)) / strata)
    allowed = tested.withColumn("_level", log_level).select(
        F.col("stratum").alias("of"), "n", binomial_count(F.col("n"), max_false_rejection, F.col("_level")).alias("allowed")
    )
    certified = (
        tails.filter("holdout")
        .join(allowed, F.col("stratum").eqNullSafe(F.col("of")))
        .filter(F.col("good_above") <= F.col("allowed"))
        .groupBy("stratum", "n", "allowed")
        .agg(F.min("badness").alias("certified"))
    )
    cutoffs = certified.join(proposed, F.col("stratum").eqNullSafe(F.col("of"))).select(
        F.col("stratum").alias("at"), F.greatest("certified", "proposed").alias("cutoff"), "n", "allowed"
    )
    return references, materialize(cutoffs, "quality-cutoffs")


def with_badness(scored: DataFrame, references: DataFrame) -> DataFrame:
    worst = F.greatest(*[F.col(s) * 1000 / F.col(f"ref_{s}") for s in SCORES])
    return (
        scored.join(references, F.col("stratum").eqNullSafe(F.col("of")), "left")
        .withColumn("badness", F.least(F.floor(worst), F.lit(_BADNESS_TOP)).cast("int"))
        .drop("of", *[f"ref_{s}" for s in SCORES])
    )


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    max_false_rejection: float = 0.05,
    risk: float = 0.05,
    cost: float = 5.0,
    whole_rows: bool = False,
) -> DataFrame:
    """doc_id, stratum, base counts, base_failed, scores, badness, cutoff, kept.

    A document is rejected if a base rule fails or its badness lies above the
    cutoff of its stratum (`thresholds`). Null text counts as empty and fails
    the base rules; null strata are one stratum; repeated labels of a document
    count once, as bad if one says so; labels without document and documents
    without label are fine; without labels only the base rules reject; repeated
    rows get equal verdicts; other columns are not looked at. With `whole_rows`
    the result also holds each given row as the struct `row`, so that a filter
    needs no join.
    """
    scored = materialize(measures(docs, key=key, text=text, stratum=stratum, whole_rows=whole_rows), "quality")
    references, cutoffs = thresholds(
        scored,
        labels.select("doc_id", "quality"),
        max_false_rejection=max_false_rejection,
        risk=risk,
        cost=cost,
    )
    judged = with_badness(scored, references).join(cutoffs, F.col("stratum").eqNullSafe(F.col("at")), "left")
    bad = F.coalesce(F.col("badness") > F.col("cutoff"), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~bad).drop("at", "text_hash", "n", "allowed")

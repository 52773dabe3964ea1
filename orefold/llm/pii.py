"""Personal data: patterns with checks, and spans that weak labelers agree on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import bind

# A match never starts inside a run that its first part would have taken whole,
# except where the last match ended; so a long run is tried once, not per place.
_EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@"
    r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
_IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# A maximal run of digits is a match of the general pattern; under 12 it is dropped.
_CARD = r"[0-9](?:[\x20-]?+[0-9]){11,}+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Long tokens of letters and digits mixed: candidates, not findings.
_TOKEN = (
    r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])(?=[0-9_/+-]*+[A-Za-z])[A-Za-z0-9_/+-]{16,}+"
)
BASE_KINDS = ("email", "ip", "card", "phone")
FOUND_KIND = "secret"

# Words that announce a secret.
GAZETTEER = (
    "token", "key", "apikey", "api_key", "secret", "client_secret", "password", "passwd", "pwd",
    "auth", "authorization", "bearer", "credential", "credentials", "access_key", "private_key",
    "session", "cookie", "signature",
)

_LABELERS = 5
_WEIGHTS = 4096
_FEATURES = 7
_FILL = 128
_ROUNDS = 30

_SPAN = "array<struct<start:int,end:int,value:string>>"


def matches(text: Column, pattern: str, holds: Column) -> Column:
    """(start, end, value) of the leftmost non-overlapping matches, in characters.

    What lies between the matches, from a split by the same pattern, tells where
    they are. `holds` is a cheap condition without which there is no match.
    """

    def placed(gaps: Column, found: Column) -> Column:
        def add(a: Column, i: Column) -> Column:
            start = a["at"] + F.length(F.get(gaps, i))
            end = start + F.length(F.get(found, i))
            span = F.struct(start.alias("start"), end.alias("end"), F.get(found, i).alias("value"))
            return F.struct(end.alias("at"), F.concat(a["spans"], F.array(span)).alias("spans"))

        # Appending copies the array, so a text full of matches fills blocks.
        def fill(a: Column, block: Column) -> Column:
            own = F.aggregate(
                F.sequence(block * _FILL, F.least(block * _FILL + (_FILL - 1), F.size(found) - 1)),
                F.struct(a["at"].alias("at"), F.array().cast(_SPAN).alias("spans")),
                add,
            )
            return bind(
                own,
                lambda x: F.struct(
                    x["at"].alias("at"), F.concat(a["blocks"], F.array(x["spans"])).alias("blocks")
                ),
            )

        return F.aggregate(
            F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _FILL).cast("int")),
            F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("blocks")),
            fill,
            lambda a: F.flatten(a["blocks"]),
        )

    none = F.array().cast(_SPAN)
    all_found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    located = bind(
        all_found,
        lambda found: F.when(
            F.size(found) > 0, bind(F.split(text, pattern, -1), lambda gaps: placed(gaps, found))
        ).otherwise(none),
    )
    return F.when(holds, located).otherwise(none)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit fits."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = digit * 2
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Spans by kind: every match of the pattern that passes its check."""
    has_digit = text.rlike("[0-9]")

    def parts_fit(x: Column) -> Column:
        return F.forall(
            F.split(x["value"], r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3)
            & (F.coalesce(F.right(p, F.lit(3)).cast("int"), F.lit(0)) <= 255)
        )

    return {
        "email": matches(text, _EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(matches(text, _IP, has_digit & F.contains(text, F.lit("."))), parts_fit),
        "card": F.filter(
            matches(text, _CARD, has_digit),
            lambda x: bind(
                digits_of(x["value"]), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False)
            ),
        ),
        "phone": F.filter(
            matches(text, _PHONE, F.contains(text, F.lit("+"))), lambda x: F.length(digits_of(x["value"])).between(9, 15)
        ),
    }


def candidates(text: Column, base: Column) -> Column:
    """Mixed tokens that overlap no base span, with the text around them."""
    free = F.filter(
        matches(text, _TOKEN, text.rlike("[0-9]")),
        lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
    )
    return F.transform(
        free,
        lambda x: F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            x["value"].alias("value"),
            F.substring(text, F.greatest(x["start"] - 39, F.lit(1)), F.least(x["start"], F.lit(40))).alias("before"),
            F.substring(text, x["end"] + 1, F.lit(8)).alias("after"),
        ),
    )


def votes(c: Column) -> Column:
    """One vote per labeler: 1 private, -1 not, 0 no opinion."""
    value, before, after = c["value"], c["before"], c["after"]
    digits = F.length(digits_of(value)) / F.length(value)
    hexadecimal = value.rlike("^[0-9a-fA-F]{24,}$")
    words = F.array_remove(F.split(F.lower(before), "[^a-z_]+"), "")
    last = F.slice(F.reverse(words), 1, 2)
    assigned = before.rlike("[=:]\\s*[\"']?$")
    quoted = before.rlike("[\"'`]$") & after.rlike("^[\"'`]")
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    return F.array(
        vote(hexadecimal, value.rlike("[/-].*[/-].*[/-]")),  # pattern
        vote(F.arrays_overlap(last, F.array(*[F.lit(w) for w in GAZETTEER])), F.lit(False)),  # gazetteer
        vote(assigned, before.rlike("[a-z]{2,}[ ,]*$") & after.rlike("^[ ,.][A-Za-z]")),  # context
        vote(quoted, F.lit(False)),  # context
        vote(digits.between(0.2, 0.9) & (F.length(value) >= 20), (digits < 0.1) | value.rlike("^[A-Za-z]+[0-9]{1,3}$")),  # shape
    )


def features(c: Column) -> Column:
    """Numbers of the hashed features of a candidate."""
    value = c["value"]
    words = F.array_remove(F.split(F.lower(c["before"]), "[^\\p{L}_]+"), "")
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]+", "9"), "[a-z]+", "a"), "[A-Z]+", "A")
    parts = {
        "word": F.coalesce(F.element_at(F.concat(F.array(F.lit("")), words), -1), F.lit("")),
        "length": F.least(F.floor(F.length(value) / 8), F.lit(16)).cast("string"),
        "digits": F.floor(F.length(digits_of(value)) * 8 / F.length(value)).cast("string"),
        "hex": value.rlike("^[0-9a-fA-F]+$").cast("string"),
        "runs": F.least(F.length(shape), F.lit(12)).cast("string"),
        "left": F.substring(c["before"], -1, 1),
        "right": F.substring(c["after"], 1, 1),
    }
    return F.array(
        *[F.pmod(F.xxhash64(F.lit(name), part), F.lit(_WEIGHTS)).cast("int") for name, part in parts.items()]
    )


def reliabilities(patterns: Column) -> Column:
    """Prior and accuracy of each labeler by expectation-maximisation.

    `patterns` are (votes, n): how many candidates got these votes, at most
    3 to the number of labelers. Accuracies start above one half and carry ten
    pseudo-votes, so that a labeler is trusted by how it agrees with the others.
    """

    def maximise(s: Column, _: Column) -> Column:
        judged = F.transform(
            patterns,
            lambda p: F.struct(p["votes"].alias("votes"), p["n"].alias("n"), posterior(p["votes"], s).alias("q")),
        )

        def improved(e: Column) -> Column:
            total = F.aggregate(e, F.lit(0.0), lambda a, p: a + p["n"])
            private = F.aggregate(e, F.lit(0.0), lambda a, p: a + p["n"] * p["q"])

            def accuracy(j: Column) -> Column:
                vote = lambda p: F.get(p["votes"], j)
                right = F.aggregate(
                    e,
                    F.lit(7.0),
                    lambda a, p: a
                    + p["n"] * F.when(vote(p) == 1, p["q"]).when(vote(p) == -1, 1 - p["q"]).otherwise(0.0),
                )
                said = F.aggregate(e, F.lit(10.0), lambda a, p: a + F.when(vote(p) != 0, p["n"]).otherwise(0.0))
                return right / said

            return F.struct(
                ((private + 1) / (total + 2)).alias("prior"),
                F.transform(F.sequence(F.lit(0), F.lit(_LABELERS - 1)), accuracy).alias("accuracy"),
            )

        return bind(judged, improved)

    start = F.struct(F.lit(0.5).alias("prior"), F.array_repeat(F.lit(0.75), _LABELERS).alias("accuracy"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), start, maximise)


def posterior(vote: Column, s: Column) -> Column:
    """Probability that a candidate with these votes is private."""

    def weigh(agree: int, prior: Column) -> Column:
        def times(a: Column, j: Column) -> Column:
            right = F.get(s["accuracy"], j)
            said = F.get(vote, j)
            return a * F.when(said == agree, right).when(said == -agree, 1 - right).otherwise(1.0)

        return F.aggregate(F.sequence(F.lit(0), F.lit(_LABELERS - 1)), prior, times)

    yes, no = weigh(1, s["prior"]), weigh(-1, 1 - s["prior"])
    return yes / (yes + no)


def personal_data(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts and spans of the base kinds, and all spans, of every row.

    `found` holds (start, end, kind, value) of all spans by start and kind. Base
    spans are pattern matches that pass their checks. Further tokens are
    candidates for secrets: pattern, gazetteer, context and shape labelers vote,
    expectation-maximisation over the counts of vote patterns estimates how far
    each is to be trusted, and a naive Bayes classifier over hashed features of
    the token and its surroundings, trained on all candidates weighted by their
    posteriors, decides. Counts are merged before they move; the patterns
    (3^5 at most) and the weights (4096) are of fixed size.

    Rows stay in their tasks; positions count characters of the whole text,
    end exclusive. Null text counts as empty; without candidates there are base
    spans only; repeated rows get equal results; other columns are not looked at.
    """
    whole = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kinds = base_spans(F.col("text"))
    spans = whole.select("*", *[column.alias(f"_{kind}") for kind, column in kinds.items()])

    def labelled(kind: str, order: int) -> Column:
        return F.transform(
            F.col(f"_{kind}"),
            lambda x: F.struct(
                x["start"].alias("start"), F.lit(order).alias("order"), x["end"].alias("end"),
                F.lit(kind).alias("kind"), x["value"].alias("value"),
            ),
        )

    base = F.sort_array(F.concat(*[labelled(kind, i) for i, kind in enumerate(BASE_KINDS)]))
    rows = materialize(
        spans.withColumn("base", base).select(
            "doc_id", *[F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in BASE_KINDS], "base",
            candidates(F.col("text"), F.col("base")).alias("candidates"),
        ),
        "pii",
    )
    each = rows.select(F.explode("candidates").alias("c"))
    patterns = each.groupBy(votes(F.col("c")).alias("votes")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    trust = materialize(
        patterns.agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("patterns")).select(
            reliabilities(F.col("patterns")).alias("s")
        ),
        "pii-trust",
    )
    judged = each.withColumn("s", trust.scalar()).select(
        posterior(votes(F.col("c")), F.col("s")).alias("q"), features(F.col("c")).alias("f")
    )
    sums = (
        judged.select("q", F.explode("f").alias("f"))
        .groupBy("f")
        .agg(F.round(F.sum("q"), 6).alias("yes"), F.round(F.sum(1 - F.col("q")), 6).alias("no"))
    )
    sums = materialize(sums, "pii-feature-sums")
    # Every candidate has as many features, so the sums over them give the totals.
    totals = sums.agg(F.struct((F.sum("yes") / _FEATURES).alias("yes"), (F.sum("no") / _FEATURES).alias("no")).alias("t"))
    odds = F.log((F.col("yes") + 0.5) / (F.col("t.yes") + 1)) - F.log((F.col("no") + 0.5) / (F.col("t.no") + 1))
    known = sums.withColumn("t", totals.scalar()).select("f", odds.alias("w"), "t")
    model = materialize(
        known.agg(
            F.sort_array(F.collect_list(F.struct("f", "w"))).alias("w"),
            F.coalesce(F.any_value(F.log((F.col("t.yes") + 1) / (F.col("t.no") + 1))), F.lit(0.0)).alias("start"),
        ).select(F.struct(F.map_from_entries("w").alias("w"), "start").alias("model")),
        "pii-model",
    )

    def private(c: Column) -> Column:
        weight = lambda f: F.coalesce(F.element_at(F.col("model.w"), f), F.lit(0.0))
        return F.aggregate(features(c), F.col("model.start"), lambda a, f: a + weight(f)) > 0

    more = F.transform(
        F.filter("candidates", private),
        lambda c: F.struct(
            c["start"].alias("start"), F.lit(len(BASE_KINDS)).alias("order"), c["end"].alias("end"),
            F.lit(FOUND_KIND).alias("kind"), c["value"].alias("value"),
        ),
    )
    return rows.withColumn("model", model.scalar()).select(
        "doc_id", *[f"n_{kind}" for kind in BASE_KINDS], "base", F.sort_array(F.concat("base", more)).alias("found")
    )


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

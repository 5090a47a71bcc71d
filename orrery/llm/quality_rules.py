"""Quality rules whose cutoffs are certified on labelled documents. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from orrery.sources.storage import written

SPACE = r"\x20\x09-\x0D"
ALPHA = 0.05  # good documents that the rules together may reject, as a share of a stratum's good documents
DELTA = 0.05  # chance that this is exceeded in any stratum
SALTS = 16
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_upper"]


class Rule(NamedTuple):
    """Reject documents where `part / whole` is above a cutoff; the cutoffs to choose from are fixed beforehand."""

    name: str
    part: str
    whole: str
    cutoffs: Sequence[float]

    def value(self) -> Column:
        return F.coalesce(F.try_divide(F.col(self.part).cast("double"), F.col(self.whole).cast("double")), F.lit(0.0))


RULES = [
    Rule("symbols", "n_symbols", "word_chars", [0.02, 0.05, 0.1, 0.2, 0.4]),
    Rule("marks", "n_marks", "word_chars", [0.05, 0.1, 0.15, 0.2, 0.4]),
    Rule("upper", "n_upper", "word_chars", [0.1, 0.2, 0.4, 0.6, 0.8]),
    Rule("dup_lines", "n_dup_lines", "n_lines", [0.1, 0.2, 0.3, 0.5, 0.7]),
    Rule("repeats", "n_repeat_words", "n_words", [0.1, 0.2, 0.3, 0.4, 0.5]),
]


def measures(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns `keep` and counts of each whole text (null: empty): see `MEASURES`.

    Repeated words are found by sorting the hashes of a text's own 3-word windows, so no row leaves its task."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    left = lambda pattern: F.length(F.regexp_replace("t", pattern, "")).cast("long")
    lines = docs.select(*keep, text.alias("t")).select(
        *keep,
        "t",
        F.regexp_extract_all("t", F.lit(f"[^{SPACE}]+"), F.lit(0)).alias("ws"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("ls"),
    )
    window = lambda i: F.struct(
        F.xxhash64(F.get("ws", i), F.get("ws", i + 1), F.get("ws", i + 2)).alias("h"), i.alias("p")
    )
    sized = lines.select(
        *keep,
        F.size("ws").cast("long").alias("n_words"),
        left(f"[{SPACE}]+").alias("word_chars"),
        left("[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        F.size("ls").cast("long").alias("n_lines"),
        left(r"[^\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+").alias("n_marks"),
        left("[^A-Z]+").alias("n_upper"),
        F.when(F.size("ws") >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.size("ws") - 3), window))).alias("s"),
    )
    again = F.filter("s", lambda x, i: (x["h"] == F.get("s", i - 1)["h"]) | (x["h"] == F.get("s", i + 1)["h"]))
    found = sized.select("*", F.sort_array(F.transform(again, lambda x: x["p"])).alias("at")).drop("s")
    covered = F.aggregate(
        F.zip_with("at", F.slice("at", 2, F.greatest(F.size("at"), F.lit(1))), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3))),
        F.lit(0),
        lambda total, x: total + x,
    )
    return found.select("*", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).drop("at")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def tail(k: Column, n: Column, p: float) -> Column:
    """The chance of at most `k` hits in `n` draws at rate `p`: exact, summed from logarithms. With `k > n * p` no
    useful bound exists and 1 is returned, which keeps the sum short."""
    step = F.log(F.lit(p / (1 - p)))
    none = F.struct((n * F.log(F.lit(1 - p))).alias("term"), F.lit(0.0).alias("sum"), F.lit(0).alias("i"))
    # Terms grow up to the last one, so the sum is kept relative to the newest term.
    total = F.aggregate(
        F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(F.array().cast("array<int>")),
        none,
        lambda a, i: F.struct(
            (a["term"] + F.log((n - i + 1) / i) + step).alias("term"),
            ((a["sum"] + 1) * i / ((n - i + 1) * F.lit(p / (1 - p)))).alias("sum"),
            i.alias("i"),
        ),
        lambda a: F.exp(a["term"]) * (1 + a["sum"]),
    )
    return F.when(k > n * p, F.lit(1.0)).otherwise(total)


def certified(measured: DataFrame, labels: DataFrame, rules: Sequence[Rule] = RULES, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Every test made: `stratum, rule, cutoff, n_good, n_rejected, p_value, chosen`.

    A document is good if one of its labels says quality 1. A cutoff is safe in a stratum if the exact binomial test
    rejects "more than `alpha / len(rules)` of the good documents are above it" at level `delta / number of tests` (Bonferroni over strata, rules and
    cutoffs). The smallest safe cutoff of a rule is chosen; without one the rule rejects nothing there. So with
    probability `1 - delta` the rules together reject at most `alpha` of the good documents of every stratum."""
    good = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("__good")).where("__good = 1").select("doc_id")
    held = measured.where(~base_failed()).join(good, "doc_id", "left_semi")
    tests = [(r, c) for r in rules for c in r.cutoffs]
    counts = held.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n_good"), *[F.count(F.when(r.value() > c, 1)).alias(f"k{i}") for i, (r, c) in enumerate(tests)]
    )
    rows = [
        F.struct(F.lit(r.name).alias("rule"), F.lit(float(c)).alias("cutoff"), F.col(f"k{i}").alias("n_rejected"))
        for i, (r, c) in enumerate(tests)
    ]
    counts = written(counts, "holdout")
    level = delta / max(1, counts.count() * len(tests))
    tested = counts.select("stratum", "n_good", F.inline(F.array(*rows))).withColumn(
        "p_value", tail(F.col("n_rejected"), F.col("n_good"), alpha / len(rules))
    )
    safe = F.min(F.when(F.col("p_value") <= level, F.col("cutoff")))
    best = tested.groupBy("stratum", "rule").agg(safe.alias("best"))
    return tested.join(best, ["stratum", "rule"]).select(
        "stratum", "rule", "cutoff", "n_good", "n_rejected", "p_value", F.coalesce(F.col("cutoff") == F.col("best"), F.lit(False)).alias("chosen")
    )


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", rules: Sequence[Rule] = RULES, alpha: float = ALPHA, delta: float = DELTA
) -> DataFrame:
    """One row per row of `docs`: `doc_id, text_hash, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept`.

    `docs` has `doc_id`, `text` and the stratum column, `labels` has `doc_id` and `quality`; other columns are ignored. Null texts
    count as empty and fail; a null stratum is a stratum of its own; without labels only the base decides.
    The counts are written once and serve the holdout and the verdict. Cutoffs, one row per stratum, are joined on salted
    strata, so a stratum with most rows is no single task."""
    key = F.when(F.col(stratum).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(stratum).cast("string")))
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), key.alias("stratum")
    ).withColumn("text_hash", F.xxhash64("text"))
    measured = written(measures(named, "doc_id", "text_hash", "stratum"), "measures")
    chosen = certified(measured, labels, rules, alpha, delta).where("chosen").groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"cut_{r.name}") for r in rules]
    )
    salted = measured.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    limits = chosen.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    above = F.lit(False)
    for r in rules:
        above = above | F.coalesce(r.value() > F.col(f"cut_{r.name}"), F.lit(False))
    return salted.join(limits, ["stratum", "salt"], "left").select(
        "doc_id", "text_hash", *MEASURES[:5], base_failed().alias("base_failed"), (~base_failed() & ~above).alias("kept")
    )

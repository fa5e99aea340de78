"""Quality rules that vote or abstain, combined by how far each can be trusted.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollbook.llm.common import SPACES, stored, text_of

#: What the base rejects: fewer words, or a larger share of repeated ones (fixed values).
MIN_WORDS, MAX_REPEATED = 10, 0.20
WINDOW = 5


def measured(docs: DataFrame, *keys: str) -> DataFrame:
    """The keys and per text the counts that the rules judge by.

    Repeated windows are found by sorting a text's own window hashes, and only in
    texts that have any. Null texts have no words; all counts are then zero.
    """
    text = text_of("text")
    trimmed = F.trim(text, F.lit(SPACES))
    # Each select is a step of its own because the expressions of the next use it
    # several times, some inside of lambdas.
    rows = docs.select(
        *[F.col(k) for k in keys],
        F.when(F.length(trimmed) == 0, F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
        .alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"!")).cast("long").alias("n_shouts"),
        (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}", ""))).cast("long").alias("n_upper"),
    )
    rows = rows.select(
        *keys, "n_symbols", "n_shouts", "n_upper",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    rows = rows.select(
        "*",
        F.size(F.array_distinct("_hashes")).cast("long").alias("n_distinct"),
        F.when(
            F.col("n_words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW),
                lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)]),
            ),
        ).alias("_windows"),
    ).drop("_hashes")
    rows = rows.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))),
        ),
    ).drop("_windows")
    rows = rows.withColumn(
        "_again",
        F.sort_array(
            F.transform(
                F.filter(
                    F.transform(
                        "_sorted",
                        lambda x, j: F.struct(
                            x["i"].alias("i"),
                            (
                                F.coalesce(F.get("_sorted", j - 1)["w"] == x["w"], F.lit(False))
                                | F.coalesce(F.get("_sorted", j + 1)["w"] == x["w"], F.lit(False))
                            ).alias("twice"),
                        ),
                    ),
                    lambda x: x["twice"],
                ),
                lambda x: x["i"],
            )
        ),
    )
    # A window covers five words, or as many as there are up to the next one.
    covered = F.transform(
        "_again", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_again", k + 1) - i, F.lit(WINDOW)))
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda sum_, n: sum_ + n)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop(
        "_sorted", "_again"
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > int(100 * MAX_REPEATED) * F.col("n_words")
    )


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("int")


def rules() -> dict[str, Column]:
    """-1 against, 1 for a text, 0 no opinion; each rule knows one kind of fault."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    mean = F.col("word_chars") / words
    return {
        "repeats": _vote(F.col("n_repeat_words") > 0.20 * words, F.col("n_repeat_words") <= 0.10 * words),
        "symbols": _vote(F.col("n_symbols") > 0.10 * words, F.col("n_symbols") <= 0.02 * words),
        "shouts": _vote(F.col("n_shouts") > 0.30 * words, F.col("n_shouts") <= 0.05 * words),
        "capitals": _vote(
            (F.col("n_words") >= 20) & (F.col("n_upper") > 0.40 * chars), F.col("n_upper") <= 0.15 * chars
        ),
        "lines": _vote(
            (F.col("n_lines") >= 4) & (F.col("n_dup_lines") > 0.5 * F.col("n_lines")),
            (F.col("n_lines") >= 2) & (F.col("n_dup_lines") <= 0.1 * F.col("n_lines")),
        ),
        "word_length": _vote((mean > 20) | (mean < 2), (mean >= 3) & (mean <= 12)),
        "variety": _vote(
            (F.col("n_words") >= 50) & (F.col("n_words") <= 2000) & (F.col("n_distinct") < 0.15 * words),
            F.col("n_distinct") >= 0.30 * words,
        ),
    }


@dataclass(frozen=True)
class Trust:
    """The share of good texts, and per rule the chance that it accuses, if it votes,
    a good and a bad text. Abstaining says nothing."""

    good: float
    on_good: dict[str, float]
    on_bad: dict[str, float]

    def accuracy(self, rule: str) -> float:
        """How often the rule is right when it votes."""
        return self.good * (1 - self.on_good[rule]) + (1 - self.good) * self.on_bad[rule]

    def posterior(self) -> Column:
        """Probability that a text with the columns' votes is good."""

        def likelihood(prior: float, accused: dict[str, float]) -> Column:
            return reduce(
                lambda product, rule: product
                * F.when(F.col(rule) > 0, 1 - accused[rule]).when(F.col(rule) < 0, accused[rule]).otherwise(1.0),
                accused,
                F.lit(prior),
            )

        good, bad = likelihood(self.good, self.on_good), likelihood(1 - self.good, self.on_bad)
        return good / (good + bad)


#: Where estimation starts: the share of good texts, and a rule's chance to accuse a
#: good and a bad one. The chances count like a share BELIEF of all texts in each
#: round's sums. The rules' limits are set so that they hardly ever accuse a good text:
#: that chance may be found smaller, but not larger than it starts, as a fault that
#: only one rule knows would otherwise be taken for that rule's error.
GOOD, ACCUSES_GOOD, ACCUSES_BAD, BELIEF = 0.85, 0.001, 0.15, 0.01
#: Each rule knows one kind of fault and is content with most bad texts, so that its
#: content makes a text likelier good by no more than this factor.
CONTENT = 1.2


def estimate(patterns: DataFrame, names: list[str], rounds: int = 12) -> Trust:
    """Expectation-maximisation over distinct vote patterns (``n`` texts each).

    There are 3 ** rules patterns at most. Each round is one aggregation, which
    gives the expected votes on either kind of text; only those few sums come to
    the driver. A rule never becomes one that accuses good texts more often than
    bad ones.
    """
    trust = Trust(GOOD, dict.fromkeys(names, ACCUSES_GOOD), dict.fromkeys(names, ACCUSES_BAD))
    for _ in range(rounds):
        weighted = patterns.withColumn("_good", trust.posterior() * F.col("n"))
        sums = [F.sum("n").alias("n"), F.sum("_good").alias("good")]
        for name in names:
            for sign, vote in (("against", -1), ("for", 1)):
                here = F.col(name) == vote
                sums.append(F.sum(F.when(here, F.col("_good")).otherwise(0.0)).alias(f"good_{sign}_{name}"))
                sums.append(F.sum(F.when(here, F.col("n") - F.col("_good")).otherwise(0.0)).alias(f"bad_{sign}_{name}"))
        row = weighted.agg(*sums).first()
        if not row["n"]:
            return trust
        held, on_good, on_bad = BELIEF * row["n"], {}, {}
        for name in names:
            of = {x: (row[f"{x}_against_{name}"], row[f"{x}_for_{name}"]) for x in ("good", "bad")}
            good = (of["good"][0] + held * ACCUSES_GOOD) / (sum(of["good"]) + held)
            bad = (of["bad"][0] + held * ACCUSES_BAD) / (sum(of["bad"]) + held)
            good = min(good, ACCUSES_GOOD)
            bad = min(bad, 1 - (1 - good) / CONTENT)
            on_good[name], on_bad[name] = (good, bad) if bad > good else (ACCUSES_GOOD, ACCUSES_BAD)
        trust = Trust(min(0.99, max(0.5, row["good"] / row["n"])), on_good, on_bad)
    return trust


def judge(docs: DataFrame, *keys: str, threshold: float = 0.5) -> DataFrame:
    """The keys, all counts, the rules' votes, ``base_failed``, ``posterior`` and ``kept``.

    A text is kept if the base accepts it and the posterior probability that it is
    good, given all votes, is at least ``threshold``. Counts are stored once and
    serve both the estimate and the verdict; vote patterns are counted over all
    documents. Null, empty and very short texts fail the base; repeated rows each
    count; equal votes give equal verdicts; an empty table gives no rows.
    """
    counts = stored(measured(docs, *keys), "counts")
    votes = counts.withColumns(rules()).withColumn("base_failed", base_failed())
    names = list(rules())
    patterns = stored(votes.groupBy(*names).agg(F.count("*").alias("n")), "patterns")
    judged = votes.withColumn("posterior", estimate(patterns, names).posterior())
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))

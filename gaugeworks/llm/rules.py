"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule says when a document fails and how many characters or array elements it touches to tell. On a sample
of about SAMPLE_ROWS rows the cost of a rule is what it touches, and its selectivity the share of failures, both
among the rows that every rule chosen before lets pass. The cascade takes the rule with most failures per unit of
cost next, and stops at the first failure. The order changes the work, never the verdict; it is counted, not
timed, so it is the same in every run.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import slim, stored

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8  # words of a repeated window
SAMPLE_ROWS = 2_000  # rows on which cost and selectivity are estimated

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


class Rule(NamedTuple):
    name: str
    fails: Column
    touches: Column  # characters or elements looked at for a verdict


def _times(text: Column, sign: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(sign), F.lit("")))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, text, words, their hashes (word_hashes) and the base counts of every document.

    A missing text counts as an empty one; repeated rows are measured each for itself. Repeated windows are
    found inside the row: window hashes, sorted with their positions only where one occurs twice.
    """
    text = F.col("text")
    last = F.col("n_words") - WINDOW + 1
    window = ", ".join(f"element_at(word_hashes, i + {k})" for k in range(WINDOW))
    d = slim(docs).withColumn("words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    d = d.select(
        "doc_id",
        "text",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        sum((_times(text, s) for s in SYMBOLS), F.lit(0)).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("word_hashes"),
    )
    d = d.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    d = d.withColumn(
        "windows",
        F.when(
            last >= 1, F.expr(f"transform(sequence(1, CAST(n_words AS INT) - {WINDOW - 1}), i -> xxhash64({window}))")
        ),
    )
    d = d.withColumn(
        "ordered",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("windows")
    d = d.withColumn(
        "starts",
        F.expr("filter(ordered, (x, k) -> x.h = get(ordered, k - 1).h OR x.h = get(ordered, k + 1).h)"),
    ).drop("ordered")
    covered = F.aggregate(
        F.sort_array(F.col("starts.i")),
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("at")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["at"])).alias("n"), i.alias("at")),
        lambda a: a["n"],
    )
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("starts")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def default_rules() -> list[Rule]:
    """The rules beyond the base ones, over the columns of ``measured``."""
    n = F.col("n_words")
    letters = lambda pattern: F.length(F.regexp_replace("text", pattern, ""))
    twins = F.size(F.expr("filter(word_hashes, (h, i) -> h = get(word_hashes, i - 1))"))
    one, repeated = F.lit(2), (F.col("n_dup_lines") >= 3).cast("int")
    return [
        Rule("symbols", F.col("n_symbols") > 0.05 * F.col("word_chars"), one),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n), one),
        Rule("repeated_lines", (F.col("n_dup_lines") >= 3) & (2 * F.col("n_dup_lines") > n / 8), one + repeated),
        Rule("capitals", letters(r"[^\p{Lu}]+") > 0.4 * F.col("word_chars"), F.length("text") + 1),
        Rule(
            "few_different_words",
            (n >= 50) & (F.size(F.array_distinct("word_hashes")) < 0.1 * n),
            F.when(n >= 50, n).otherwise(0) + 1,
        ),
        Rule("same_word_again", twins > 0.25 * n, 2 * n + 1),
    ]


def cascade_order(sample: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Rules by failures per unit of cost on the measured sample, best first, each judged on the rows that the base
    rules and those before it let pass; ties, and rules nothing fails any more, go by cost, then as given.

    One job counts rows and sums costs per combination of verdicts: at most 2 ** len(rules) rows, and no more than
    the sample has.
    """
    verdicts = [F.coalesce(r.fails, F.lit(False)).alias(f"fails_{k}") for k, r in enumerate(rules)]
    costs = [F.coalesce(r.touches, F.lit(0)).cast("double").alias(f"cost_{k}") for k, r in enumerate(rules)]
    rows = sample.where(~base_failed()).select(*verdicts, *costs)
    every = range(len(rules))
    left = (
        rows.groupBy(*[f"fails_{k}" for k in every])
        .agg(F.count("*").alias("n"), *[F.sum(f"cost_{k}").alias(f"cost_{k}") for k in every])
        .collect()
    )
    order, open_ = [], list(every)
    while open_:
        failed = {k: sum(r["n"] for r in left if r[f"fails_{k}"]) for k in open_}
        cost = {k: sum(r[f"cost_{k}"] for r in left) for k in open_}
        best = min(open_, key=lambda k: (-failed[k] / max(cost[k], 1.0), cost[k], k))  # noqa: B023
        order.append(rules[best])
        open_.remove(best)
        left = [r for r in left if not r[f"fails_{best}"]]
    return order


def cascade(rules: list[Rule]) -> Column:
    """False at the first rule that fails; later rules are then not evaluated."""
    verdict = F.when(base_failed(), False)
    for rule in rules:
        verdict = verdict.when(rule.fails, False)
    return verdict.otherwise(True)


def quality_rules(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: the base counts, base_failed and kept.

    Empty and missing texts have no words, so they fail the base rule. A missing doc_id stays missing. Repeated
    rows get one row each; very long texts are measured whole. An empty table gives no rows; further columns,
    whatever their names, are left out.
    """
    rules = default_rules() if rules is None else rules
    d = measured(docs)
    if len(rules) > 1:
        rows = docs.count()
        sample = slim(docs).sample(min(1.0, sample_rows / max(rows, 1)), seed=7)
        rules = cascade_order(stored(measured(sample), "rules-sample"), rules)
    return d.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        cascade(rules).alias("kept"),
    )

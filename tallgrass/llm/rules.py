"""Quality rules: learned decision lists over text statistics, as native Spark conditions."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm.common import SPACE_CLASS, SPACES, drawn, packed, text_of
from tallgrass.llm.registry import query
from tallgrass.queries import read

SYMBOLS = "#*$%&|<>"
#: Statistics that rules may test; all are ratios, so a rule means the same for short and long texts.
FEATURES = ("mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "shout_share", "distinct_share")
WINDOW = 5


def statistics(rows: DataFrame) -> DataFrame:
    """``row`` with its text statistics; DataFrame functions only, every row on its own.

    Repeated five-word windows: windows are hashed, sorted within the text, and those equal
    to a neighbour mark their place; the words they cover are the gaps between marked places,
    five at most. That is n log n in the words of a text, without a shuffle.
    """
    text = F.col("_text")
    rows = rows.select("*", text_of().alias("_text"))
    rows = rows.select("*", F.btrim(text, F.lit(SPACES)).alias("_trimmed"), F.split(text, "\n").alias("_lines"))
    words = F.when(F.col("_trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("_trimmed", f"{SPACE_CLASS}+"))
    rows = rows.select("*", F.transform(words, lambda w: F.xxhash64(w)).alias("_words"),
                       F.filter("_lines", lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("_full"),
                       F.regexp_replace(text, f"{SPACE_CLASS}+", "").alias("_solid"))
    rows = rows.select("*", F.size("_words").alias("_n"))
    grams = F.transform(F.sequence(F.lit(0), F.col("_n") - WINDOW),
                        lambda i: F.xxhash64(*[F.get("_words", i + j) for j in range(WINDOW)]))
    rows = rows.select("*", F.when(F.col("_n") >= WINDOW, grams).otherwise(F.array().cast("array<bigint>")).alias("_grams"))
    has_twice = F.size(F.array_distinct("_grams")) < F.size("_grams")
    placed = F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    none = F.array().cast("array<struct<g:bigint,i:int>>")
    rows = rows.select("*", F.when(has_twice, placed).otherwise(none).alias("_sorted"))
    twice = F.filter("_sorted", lambda x, i: (x["g"] == F.get(F.col("_sorted"), i - 1)["g"])
                     | (x["g"] == F.get(F.col("_sorted"), i + 1)["g"]))
    rows = rows.select("*", F.sort_array(F.transform(twice, lambda x: x["i"])).alias("_places"))
    covered = F.transform("_places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_places"), i + 1) - p, F.lit(WINDOW))))
    repeated = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    solid = F.col("_solid")
    # through a generator: filters on the results must not be pushed into the steps above, which
    # would work them out again for every element
    rows = rows.select("row", F.inline(F.array(F.struct(
        F.col("_n").cast("long").alias("n_words"),
        F.length(solid).cast("long").alias("word_chars"),
        (F.length(solid) - F.length(F.translate(solid, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
        F.size("_full").alias("_n_lines"), F.size(F.array_distinct("_words")).alias("_n_distinct"),
        (F.length(solid) - F.length(F.regexp_replace(solid, "\\p{Lu}", ""))).alias("_n_upper"),
        (F.length(solid) - F.length(F.translate(solid, "!?", ""))).alias("_n_shouts"),
    ))))

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    return rows.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("mean_word"), share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "_n_lines").alias("dup_line_share"), share("n_repeat_words", "n_words").alias("repeat_share"),
        share("_n_upper", "word_chars").alias("upper_share"), share("_n_shouts", "n_words").alias("shout_share"),
        share("_n_distinct", "n_words").alias("distinct_share"),
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
    )


@dataclass
class Rule:
    """A conjunction of thresholds, ``(feature, '>=' or '<', value)``, that rejects a document."""

    tests: list = field(default_factory=list)

    def covers(self, x: np.ndarray) -> np.ndarray:
        hit = np.ones(len(x), bool)
        for f, op, value in self.tests:
            column = x[:, FEATURES.index(f)]
            hit &= column >= value if op == ">=" else column < value
        return hit

    def condition(self) -> Column:
        out = F.lit(True)
        for f, op, value in self.tests:
            out = out & (F.col(f) >= F.lit(value) if op == ">=" else F.col(f) < F.lit(value))
        return out

    def __str__(self):
        return " and ".join(f"{f} {op} {value:.4g}" for f, op, value in self.tests)


def _grow(x: np.ndarray, bad: np.ndarray, cuts: list, most: int) -> Rule:
    """Add the threshold with the largest information gain until no good document is covered."""
    rule, hit = Rule(), np.ones(len(x), bool)
    while len(rule.tests) < most and (hit & ~bad).any():
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        before, best = np.log2(p / (p + n)), (1e-9, None, None)
        for k, f in enumerate(FEATURES):
            for value in cuts[k]:
                at_least = x[:, k] >= value
                for op, side in ((">=", at_least), ("<", ~at_least)):
                    now = hit & side
                    p1, n1 = (now & bad).sum(), (now & ~bad).sum()
                    gain = p1 * (np.log2(p1 / (p1 + n1)) - before) if p1 else 0
                    if gain > best[0]:
                        best = (gain, (f, op, float(value)), now)
        if best[1] is None:
            break
        rule.tests.append(best[1])
        hit = best[2]
    return rule


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The prefix of the rule with the best (p - n) / (p + n) on the pruning rows; the shorter of equal ones."""
    def worth(r: Rule) -> float:
        hit = r.covers(x)
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((Rule(rule.tests[:k]) for k in range(1, len(rule.tests) + 1)), key=lambda r: (worth(r), -len(r.tests)))


def learn(x: np.ndarray, bad: np.ndarray, precision: float = 0.95, most_rules: int = 12, most_tests: int = 3,
          n_cuts: int = 24) -> list[Rule]:
    """Decision list by sequential covering.

    A rule grows on two thirds of the rows not yet covered, is pruned on the last third and
    joins the list if at least ``precision`` of the rows it covers are bad, on the growing and
    on the pruning rows; its rows then leave. The first rule that doesn't ends the list.
    """
    rules: list[Rule] = []
    pruning = np.arange(len(x)) % 3 == 2
    left = np.ones(len(x), bool)
    while len(rules) < most_rules and (left & bad & ~pruning).any():
        grow, prune = left & ~pruning, left & pruning
        cuts = [np.unique(np.quantile(x[grow & bad, k], np.linspace(0, 1, n_cuts))) for k in range(len(FEATURES))]
        rule = _prune(_grow(x[grow], bad[grow], cuts, most_tests), x[prune], bad[prune]) if prune.any() else _grow(
            x[grow], bad[grow], cuts, most_tests)
        if not rule.tests:
            break
        hit = rule.covers(x) & left
        seen = [hit & part for part in (~pruning, pruning)]
        if not (hit & bad).any() or any(h.any() and (h & bad).sum() < precision * h.sum() for h in seen):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit(docs: DataFrame, labels: DataFrame, sample: int = 4000, **settings) -> list[Rule]:
    """Learn rules from at most ``sample`` labelled documents (``labels``: doc_id, quality 0 or 1).

    The sample goes by digests of the ids, so it doesn't depend on the layout of the tables; its
    statistics are the same expressions that later judge all documents. A doc_id with several
    rows counts once, with its smallest text and lowest label, so never more than ``sample`` rows
    of numbers reach the driver. Rows without a label, and labels without a document, are left
    out; no labels give no rules.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    some = F.broadcast(drawn(known, "doc_id", sample, 5).select(F.col("doc_id").alias("id"), "quality"))
    texts = packed(docs.select("doc_id", "text")).select(F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))
    rows = texts.join(some, F.col("doc_id") == F.col("id")).groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    stats = statistics(packed(rows))
    got = stats.select("row.doc_id", "row.quality", *FEATURES).collect()
    got.sort(key=lambda r: tuple(r))
    x = np.array([[r[f] for f in FEATURES] for r in got], float).reshape(len(got), len(FEATURES))
    order = np.random.default_rng(0).permutation(len(got))
    return learn(x[order], np.array([r.quality == 0 for r in got], bool)[order], **settings) if got else []


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` (text) as ``row``, its statistics, ``base_failed``, ``reason`` and ``kept``.

    ``reason`` is ``base`` where the fixed rule fails, else the first rule of the list that
    covers the document, else null; documents without a reason are kept. A null text has no
    words and fails the base. Repeated rows are judged alike, an empty table gives an empty one.
    """
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for rule in rules:
        verdict = verdict.when(rule.condition(), F.lit(str(rule)))
    return statistics(packed(docs)).withColumn("reason", verdict).withColumn("kept", F.col("reason").isNull())


def good_documents(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The documents that the learned list keeps; same columns."""
    return judge(docs, fit(docs, labels, **settings)).where("kept").select("row.*")


@query("op5_quality_rules")
def op5_quality_rules(spark, sf_dir):
    """Statistics and verdict of the learned list for every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = judge(docs, fit(docs, read(spark, sf_dir, "labels")))
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "reason", "kept")

"""Quality classifier: a sparse ensemble of rules over text statistics.

Small trees are grown on the statistics of labelled texts; every path from a root
is a conjunction of thresholds, a rule. A logistic model with a lasso penalty
keeps the few rules that matter. The result is a list of weighted rules, compiled
into one column expression, so that scoring is a projection without Python.

Only the text decides a score. At most about ``MAX_LABELLED`` labelled rows are
used for the fit, chosen by a seeded draw per id. Without labelled rows, or with
one label only, the score is the share of label 1 (0.5 without labels). Null and
empty texts have statistics of 0 and get a score like all others. Equal texts get
equal scores. Extra columns are kept; a result column replaces an input column of
the same name. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.columns import WORD, draw_bits, let, word_array
from tillwright.llm.quality_rules import STOP_WORDS
from tillwright.llm.scratch import Scratch

MAX_LABELLED = 40_000
TREES, DEPTH, PENALTY, SEED = 24, 3, 0.002, 6
ACCEPT = 0.3


def held_out(key: Column) -> Column:
    """One id in five is kept out of every fit; a null id counts as the text ``null``."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    return F.crc32(F.encode(text, "UTF-8")) % 5 == 0


STATISTICS = (
    "log_words", "mean_word_length", "symbol_ratio", "shout_ratio", "exclamation_ratio",
    "bar_ratio", "digit_ratio", "distinct_ratio", "capital_ratio", "stop_ratio", "line_ratio",
    "distinct_line_ratio", "full_stop_ratio", "longest_word",
)


def statistics(text: Column) -> Column:
    """The statistics of a text as an array of doubles in the order of ``STATISTICS``."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(WORD))

    def count(pattern: str) -> Column:
        return F.regexp_count(whole, F.lit(pattern))

    def all_of(w: Column, ln: Column) -> Column:
        words, rows = F.greatest(F.size(w), F.lit(1)), F.greatest(F.size(ln), F.lit(1))
        letters = F.greatest(F.length(whole), F.lit(1))
        values = (
            F.log1p(F.size(w).cast("double")),
            F.length(F.concat_ws("", w)) / words,
            count(r"[#*$%&|<>]") / words,
            F.size(F.filter(w, lambda x: (F.length(x) > 1) & (x == F.upper(x))
                            & (x != F.lower(x)))) / words,
            count("!") / words,
            count(r"\|") / words,
            count("[0-9]") / letters,
            F.size(F.array_distinct(w)) / words,
            count(r"\p{Lu}") / letters,
            F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))) / words,
            F.size(ln) / words,
            F.size(F.array_distinct(ln)) / rows,
            count(r"\.") / words,
            F.coalesce(F.array_max(F.transform(w, lambda x: F.length(x))), F.lit(0)),
        )
        return F.array(*[v.cast("double") for v in values])

    return let(word_array(whole), lambda w: let(lines, lambda ln: all_of(w, ln)))


@dataclass(frozen=True)
class Rule:
    """All of (statistic, at most?, threshold) must hold."""

    tests: tuple[tuple[int, bool, float], ...]
    weight: float = 0.0

    def condition(self, stats: Column) -> Column:
        out = F.lit(True)
        for i, at_most, threshold in self.tests:
            value = F.get(stats, F.lit(i))
            out = out & ((value <= threshold) if at_most else (value > threshold))
        return out

    def __str__(self) -> str:
        tests = [f"{STATISTICS[i]} {'<=' if m else '>'} {t:.4g}" for i, m, t in self.tests]
        return f"{self.weight:+.3f} if {' and '.join(tests)}"


@dataclass(frozen=True)
class Ensemble:
    base: float
    rules: tuple[Rule, ...]

    def score(self, text: Column) -> Column:
        """Probability of label 1."""
        def logistic(stats: Column) -> Column:
            total = F.lit(float(self.base))
            for rule in self.rules:
                total = total + F.when(rule.condition(stats), F.lit(rule.weight)).otherwise(0.0)
            return 1 / (1 + F.exp(-total))
        return let(statistics(text), logistic)


def paths(tree: str) -> list[Rule]:
    """Every path below the root of a printed tree, as a rule."""
    out, path = [], []
    for line in tree.splitlines():
        found = re.match(r"(\s*)(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if found:
            indent, _, feature, sign, threshold = found.groups()
            path = [p for p in path if p[0] < len(indent)]
            path.append((len(indent), (int(feature), sign == "<=", float(threshold))))
            out.append(Rule(_shortest([test for _, test in path])))
    return out


def _shortest(tests: Sequence[tuple[int, bool, float]]) -> tuple[tuple[int, bool, float], ...]:
    """The same conjunction with one bound per statistic and side."""
    bounds: dict[tuple[int, bool], float] = {}
    for i, at_most, t in tests:
        old = bounds.get((i, at_most))
        bounds[i, at_most] = t if old is None else (min if at_most else max)(old, t)
    return tuple(sorted((i, m, t) for (i, m), t in bounds.items()))


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, most: int,
) -> DataFrame:
    """Statistics and label of about ``most`` labelled rows that are not held out.

    The chosen ids number about ``most`` at any size of the tables, which bounds
    what is broadcast.
    """
    usable = labels.select(F.col(f"`{key}`").alias("__id"), F.col(f"`{label}`").alias("label")).where(
        F.col("__id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("__id"))).distinct()
    share = min(1.0, most / max(usable.count(), 1))
    chosen = usable.where(
        draw_bits(F.col("__id"), F.lit("fit")) < F.lit(int(share * (1 << 52))))
    # Two columns only, under names of their own: others of ``docs`` may be called the same.
    texts = docs.select(F.col(f"`{key}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    return texts.join(F.broadcast(chosen), "__id").select(
        "__id", F.col("label").cast("double").alias("label"), statistics(F.col("__text")).alias("stats"))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id",
    text: str = "text", most: int = MAX_LABELLED,
) -> Ensemble:
    """Grow trees, take their paths, and weigh them under a lasso penalty."""
    scratch = Scratch(docs.sparkSession, "quality")
    # A fixed order of the rows makes the trees the same in every run.
    rows = scratch.write(
        training_rows(docs, labels, label, key, text, most).repartition(8, "__id")
        .sortWithinPartitions("__id", "label", "stats"), "statistics")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        scratch.close()
        share = next(iter(counts), 0.5)
        return Ensemble(math.log((share + 0.001) / (1.001 - share)), ())
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="x", numTrees=TREES, maxDepth=DEPTH, maxBins=64,
        featureSubsetStrategy="onethird", seed=SEED, cacheNodeIds=False)
    trees = forest.fit(rows.select("label", array_to_vector("stats").alias("x")))
    rules = sorted({r for t in trees.trees for r in paths(t.toDebugString)}, key=lambda r: r.tests)
    stats = F.col("stats")
    held = scratch.write(rows.select("label", F.array(
        *[r.condition(stats).cast("double") for r in rules]).alias("held")), "rules")
    lasso = LogisticRegression(
        labelCol="label", featuresCol="x", elasticNetParam=1.0, regParam=PENALTY, maxIter=100)
    model = lasso.fit(held.select("label", array_to_vector("held").alias("x")))
    scratch.close()
    return Ensemble(float(model.intercept), tuple(
        Rule(r.tests, float(w)) for r, w in zip(rules, model.coefficients.toArray()) if w != 0))


def classify(docs: DataFrame, model: Ensemble, text: str = "text") -> DataFrame:
    """``docs`` with score and predicted: one projection, no shuffle."""
    scored = docs.withColumn("score", model.score(F.col(f"`{text}`")))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def accept(docs: DataFrame, model: Ensemble, text: str = "text") -> DataFrame:
    """Rows of ``docs`` that the model does not reject, all columns as they are."""
    return docs.where(model.score(F.col(f"`{text}`")) >= ACCEPT)

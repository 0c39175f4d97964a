"""Quality by a sparse rule ensemble over statistics of a text.

Shallow trees are grown on the statistics, every path from a root becomes a conjunction of
comparisons, and a lasso logistic regression gives weights to the few rules that matter. The
ensemble is then one Spark column: no model object is needed to score a table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from argulith.llm.common import BLANKS, fold, query, spare, table
from argulith.session import stage

SAMPLE_ROWS = 20_000  # labelled rows, about, that fit the ensemble; every row is scored
TREES = 12
DEPTH = 3
LASSO = 0.002
SEED = 42
FOLDS, HELD_OUT = 3, 1

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KINDS = {
    "upper": UPPER,
    "digits": "0123456789",
    "stops": ".,;:?",
    "marks": "#$%&*+<=>@^_`~\\/",
    "bars": "|",
    "shouts": "!",
    "brackets": "()[]{}\"'",
}


def statistics(text: Column) -> dict[str, Column]:
    """The statistics of a whole text; those of a null text are those of an empty one."""
    whole = F.coalesce(text, F.lit(""))
    chars = F.length(whole)
    words = F.filter(F.split(whole, f"[{BLANKS}]+"), lambda w: w != "")
    lines = F.split(whole, "\n", -1)
    some = F.greatest(chars, F.lit(1))
    shares = {
        # translate() without replacements deletes the characters.
        name: (chars - F.length(F.translate(whole, kind, ""))) / some
        for name, kind in KINDS.items()
    }
    count = F.greatest(F.size(words), F.lit(1))
    return {
        "words": F.log1p(F.size(words)),
        "word_chars": F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.length(w)) / count,
        "long_words": F.size(F.filter(words, lambda w: F.length(w) > 14)) / count,
        "distinct_words": F.size(F.array_distinct(words)) / count,
        "line_chars": F.log1p(chars / F.size(lines)),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        **shares,
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of comparisons (statistic, below, bound): value <= bound, or value > bound."""

    parts: tuple[tuple[str, bool, float], ...]

    def column(self, names: dict[str, str]) -> Column:
        met = F.lit(True)
        for name, below, bound in self.parts:
            value = F.col(f"`{names[name]}`")
            met = met & ((value <= bound) if below else (value > bound))
        return F.when(met, 1.0).otherwise(0.0)


def tree_rules(node, names: list[str], path: tuple = ()) -> list[Rule]:
    """A rule for every node below ``node``, a node of a fitted tree in the JVM."""
    found = [Rule(path)] if path else []
    if node.subtreeDepth() == 0:
        return found
    split = node.split()
    name, bound = names[split.featureIndex()], float(split.threshold())
    left = tree_rules(node.leftChild(), names, (*path, (name, True, bound)))
    return found + left + tree_rules(node.rightChild(), names, (*path, (name, False, bound)))


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules and an intercept."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def chance(self, names: dict[str, str]) -> Column:
        """The score as one column over the statistics' columns."""
        line = F.lit(self.intercept)
        for rule, weight in self.rules:
            line = line + rule.column(names) * weight
        return 1 / (1 + F.exp(-line))

    def score(self, df: DataFrame, text: str = "text") -> DataFrame:
        """``df`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 if >= 0.5).

        Every whole text is scored; null and empty texts by the statistics of an empty text.
        Repeated rows get the same score; an empty table gives no rows. Clashing column names:
        the new ones get underscores.
        """
        taken = list(df.columns)
        names = {n: spare(f"_{n}", taken) for n in statistics(F.col(text))}
        score, predicted = spare("score", taken), spare("predicted", taken)
        measured = df.select("*", *[c.alias(names[n]) for n, c in statistics(F.col(text)).items()])
        scored = measured.select(*[F.col(f"`{c}`") for c in taken], self.chance(names).alias(score))
        return scored.withColumn(predicted, (F.col(score) >= 0.5).cast("int"))


def fit(measured: DataFrame, label: str, sample_rows: int = SAMPLE_ROWS) -> RuleEnsemble:
    """A rule ensemble from rows with the statistics' columns and a label of 0 or 1 (others are ignored).

    A random sample of about ``sample_rows`` rows at most is used. Without both classes the ensemble
    says the one class there is (1 if there are no rows).
    """
    names = list(statistics(F.lit("")))
    spark = measured.sparkSession
    known = measured.filter(F.col(label).isin(0, 1)).select(*names, F.col(label).cast("double").alias("label"))
    known = stage(known, "rated")
    rows = known.sample(min(1.0, sample_rows / max(1, known.count())), SEED)
    rows = rows.repartition(spark.sparkContext.defaultParallelism).persist()
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return RuleEnsemble((), -10.0 if 0.0 in counts else 10.0)
    assembled = VectorAssembler(inputCols=names, outputCol="statistics").transform(rows)
    # Both classes weigh the same while trees are grown, so that rare faults get rules.
    heavy = {kind: sum(counts.values()) / (2 * n) for kind, n in counts.items()}
    weighed = assembled.withColumn("weight", F.when(F.col("label") == 1, heavy[1.0]).otherwise(heavy[0.0]))
    forest = RandomForestClassifier(
        featuresCol="statistics", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED
    ).fit(weighed)
    found = [rule for tree in forest.trees for rule in tree_rules(tree._call_java("rootNode"), names)]
    rules = sorted({rule.parts: rule for rule in found}.values(), key=lambda r: repr(r.parts))
    same = {n: n for n in names}
    met = rows.select("label", *[rule.column(same).alias(f"r{i}") for i, rule in enumerate(rules)])
    inputs = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="rules").transform(met)
    held = inputs.select("rules", "label").persist()
    lasso = LogisticRegression(
        featuresCol="rules", labelCol="label", elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60
    ).fit(held)
    held.unpersist()
    rows.unpersist()
    weights = [float(w) for w in lasso.coefficients]
    return RuleEnsemble(tuple((r, w) for r, w in zip(rules, weights) if w), float(lasso.intercept))


def held_out(key: str) -> Column:
    """Rows that no label is learned from; false for a null key."""
    return F.coalesce(fold(F.col(key), FOLDS) == HELD_OUT, F.lit(False))


@query("op8_quality")
def op8_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every whole document; its statistics are computed once."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = stage(
        documents.select("doc_id", *[c.alias(n) for n, c in statistics(F.col("text")).items()]), "statistics"
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out("doc_id"))
    ensemble = fit(measured.join(labels, "doc_id"), "quality")
    score = ensemble.chance({n: n for n in statistics(F.lit(""))})
    return measured.select("doc_id", held_out("doc_id").alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )

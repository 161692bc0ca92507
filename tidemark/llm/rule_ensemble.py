"""A quality classifier of sparse rules.

Small trees are grown over statistics of labelled texts. Every path from a root to
a node is a rule: a conjunction of thresholds. A logistic regression with a lasso
penalty picks and weighs the rules, and what is left is compiled into one Spark
column expression, so scoring any number of documents is a single projection.
"""

import re
from dataclasses import dataclass
from functools import reduce
from math import log
from operator import add, and_

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.mixing import stored

Condition = tuple[str, str, float]
Rule = tuple[Condition, ...]

SPACE = r"[\x20\x09-\x0D]+"


def _share_of(pattern: str) -> Column:
    """Share of a text's characters in runs of a pattern; 0 for an empty text."""
    rest = F.length(F.regexp_replace("_text", pattern, ""))
    return 1 - F.coalesce(rest / F.nullif(F.length("_text"), F.lit(0)), F.lit(1.0))


def _per(number: Column, of: Column) -> Column:
    return F.coalesce(number / F.nullif(of, F.lit(0)), F.lit(0.0))


def statistics() -> dict[str, Column]:
    """Expressions over _text, _words and _lines, defined and finite for any text."""
    n_words, n_lines = F.size("_words"), F.size("_lines")
    return {
        "log_words": F.log1p(n_words),
        "word_length": _per(F.length("_text").cast("double"), n_words),
        "distinct_words": _per(F.size(F.array_distinct("_words")).cast("double"), n_words),
        "distinct_lines": _per(F.size(F.array_distinct("_lines")).cast("double"), n_lines),
        "words_per_line": _per(n_words.cast("double"), n_lines),
        "upper_share": _share_of(r"\p{Lu}+"),
        "digit_share": _share_of(r"\p{Nd}+"),
        "symbol_share": _share_of(r"[#*$%&|<>@\\^~{}\[\]=+_]+"),
        "exclaim_share": _share_of(r"[!?]+"),
        "stop_share": _share_of(r"[.,;:]+"),
    }


def with_statistics(docs: DataFrame) -> DataFrame:
    """The rows with the statistics of ``_text`` in place of the text."""
    others = [c for c in docs.columns if c != "_text"]
    arrays = docs.select(
        *others,
        F.coalesce("_text", F.lit("")).alias("_text"),
    ).select(
        *others,
        "_text",
        F.filter(F.split("_text", SPACE), lambda w: w != "").alias("_words"),
        F.split("_text", "\n").alias("_lines"),
    )
    return arrays.select(*others, *(c.alias(n) for n, c in statistics().items()))


def tree_rules(described: str, names: list[str]) -> set[Rule]:
    """Rules of all paths in the description that Spark gives of its trees."""
    rules: set[Rule] = set()
    path: list[tuple[str, str, float, int]] = []
    for line in described.splitlines():
        depth = len(line) - len(line.lstrip())
        found = re.match(r"\s*(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if re.match(r"\s*Tree ", line):
            path = []
        elif found:
            condition = (names[int(found[2])], found[3], float(found[4]))
            path = [c for c in path if c[3] < depth] + [(*condition, depth)]
            rules.add(tuple(sorted(c[:3] for c in path)))
    return rules


@dataclass(frozen=True)
class RuleModel:
    """An intercept and weighted rules over ``statistics``."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1 as an expression over the statistics' columns."""
        terms = [F.when(holds(rule), F.lit(w)).otherwise(F.lit(0.0)) for rule, w in self.rules]
        return 1 / (1 + F.exp(-reduce(add, terms, F.lit(self.intercept))))


def holds(rule: Rule) -> Column:
    tests = [F.col(n) <= v if sign == "<=" else F.col(n) > v for n, sign, v in rule]
    return reduce(and_, tests)


def fit_rules(
    labelled: DataFrame,
    trees: int = 16,
    depth: int = 3,
    lasso: float = 0.001,
    seed: int = 42,
) -> RuleModel:
    """Fit on rows of statistics and a ``label`` of 0 or 1.

    Rows without a label are left out. With no row, or one class only, the model is a
    constant: one half, or nearly 0 or 1.
    """
    rows = labelled.filter("label IN (0, 1)").withColumn("label", F.col("label").cast("double"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        constant = {(): 0.0, (0.0,): -5.0, (1.0,): 5.0}[tuple(counts)]
        return RuleModel(constant, ())
    share = counts[1.0] / (counts[0.0] + counts[1.0])
    names = list(statistics())
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird"
    ).fit(vectors.select("label", "features"))
    rules = sorted(tree_rules(forest.toDebugString, names))
    if not rules:
        return RuleModel(log(share / (1 - share)), ())
    columns = [holds(rule).cast("double").alias(f"r{i}") for i, rule in enumerate(rules)]
    assembler = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="rules")
    table = assembler.transform(rows.select("label", *columns)).select("label", "rules")
    fitted = LogisticRegression(
        featuresCol="rules", regParam=lasso, elasticNetParam=1.0, maxIter=100, standardization=False
    ).fit(table)
    weighted = [(r, float(w)) for r, w in zip(rules, fitted.coefficients) if w != 0.0]
    return RuleModel(float(fitted.intercept), tuple(weighted))


def held_out(doc_id: Column, folds: int) -> Column:
    """Whether the CRC-32 of the id as text is a multiple of ``folds``; false for a null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def train_quality(
    docs: DataFrame, labels: DataFrame, folds: int = 5, most_rows: int = 20_000
) -> RuleModel:
    """A model of ``labels.quality`` from rows that are not held out.

    At most about ``most_rows`` labelled documents are used, drawn by a hash of their
    ids; this bounds the fit, nothing else. Their statistics are computed once.
    """
    usable = labels.filter(~held_out(F.col("doc_id"), folds)).select(
        F.col("doc_id").alias("_id"), F.col("quality").alias("label")
    )
    steps = 1_000_000
    part = min(steps, steps * most_rows // max(1, usable.count()))
    sample = stored(usable.filter(F.pmod(F.xxhash64("_id"), F.lit(steps)) < part), "labels")
    texts = docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text"))
    rows = texts.join(sample, F.col("_doc") == F.col("_id")).select("label", "_text")
    return fit_rules(stored(with_statistics(rows), "quality-rows"))


def score_quality(
    docs: DataFrame, model: RuleModel, folds: int = 5, threshold: float = 0.3
) -> DataFrame:
    """doc_id, held_out, score and predicted of each document.

    One row for each that goes in; a null or empty text is scored by the statistics of
    an empty text.
    """
    texts = docs.select("doc_id", F.col("text").alias("_text"))
    return (
        with_statistics(texts)
        .select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), model.score().alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )

"""Mixing sources to target weights by weighted sampling without replacement.

Each document draws an exponential key, scaled by its quality weight, from a hash
of its id (Efraimidis and Spirakis). A source takes its complete epochs first and
spends the rest of its budget on documents in the order of their keys. The prefix
sums are found by two histograms over the keys, so that no task ever sorts a
source: only the cell in which a budget ends is sorted.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.words import word_count
from tidemark.session import work_dir

# Two levels of 4096 cells leave about a thousand documents to sort in 10^10.
CELLS = 4096


def letter_share(text: Column) -> Column:
    """A quality weight from 0.05 to 1: the share of characters other than digits and symbols."""
    plain = F.length(F.regexp_replace(text, r"[0-9#*$%&|<>!@\\^~{}\[\]=+_]+", ""))
    return F.greatest(F.coalesce(F.try_divide(plain, F.length(text)), F.lit(0.0)), F.lit(0.05))


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here."""
    path = work_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """The budget of each source: its share by weight of all words, at most ``most`` epochs.

    Takes one row per source (source, source_size). What a source cannot take is
    shared out again by weight: the sources in order of their limit over weight are
    cut while that ratio is below the level of those that are left.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    limit = F.lit(most) * F.col("source_size")
    ranked = (
        sizes.withColumn("source_no", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1))
        .withColumn("ratio", limit / F.col("weight"))
    )
    everything = Window.partitionBy()
    from_here = Window.orderBy("ratio", "source_no").rowsBetween(0, Window.unboundedFollowing)
    before = Window.orderBy("ratio", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    level = left / F.sum("weight").over(from_here)
    return (
        ranked.withColumn("level", level)
        .withColumn("cut", F.col("ratio") <= F.col("level"))
        .withColumn("common", F.max(F.when(~F.col("cut"), F.col("level"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("cut"), limit.cast("double")).otherwise(F.col("common") * F.col("weight")),
        )
        .withColumn(
            "epochs",
            F.when(F.col("source_size") == 0, 0)
            .otherwise(F.floor(F.col("target") / F.col("source_size")))
            .cast("long"),
        )
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        .select("source", "source_no", "source_size", "target", "epochs", "rest")
    )


def last_cell(rows: DataFrame, cell: str) -> DataFrame:
    """For each source the cell in which its budget ends, and the words before that cell.

    ``rows`` has source_no, rest, taken_before (words of earlier cells), size and the
    cell. A source whose budget outlasts its cells has none.
    """
    sums = rows.groupBy("source_no", "rest", "taken_before", cell).agg(F.sum("size").alias("_sum"))
    until = Window.partitionBy("source_no").orderBy(cell)
    ends = F.col("taken_before") + F.sum("_sum").over(until)
    return (
        sums.withColumn("_end", ends)
        .filter(F.col("_end") > F.col("rest"))
        .groupBy("source_no", "rest")
        .agg(F.min(F.struct(F.col(cell), (F.col("_end") - F.col("_sum")).alias("before"))).alias("_at"))
        .select("source_no", F.col(f"_at.{cell}").alias(cell), F.col("_at.before").alias("taken_before"))
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most_epochs: int = 3,
    quality: Column | None = None,
    seed: int = 42,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """What a mix takes of each document.

    Sources in order of code points, null last, have ``weights`` in turn and share
    as many words as there are. They are few: a row each is ranked in one task. Result: the
    columns ``keep`` and

    - size: words of the text, 0 for a null
    - source_size, target: of the document's source
    - epochs: complete passes over the source
    - sampled: whether the document is part of the fraction after these
    - taken: words taken, repeats counted

    The document in which a budget ends is taken if that brings the source nearer to
    its target. Equal keys (repeated ids) are ordered by id and size. Runs on the
    same rows agree. ``quality`` gives weights above 0 and defaults to the share of
    characters that are neither digits nor symbols; a null counts as 0.05.
    """
    quality = letter_share(F.col("text")) if quality is None else quality
    spark = docs.sparkSession
    # In (0, 1): the upper 53 bits of the hash, and half a step.
    # Rows without an id draw by their texts, or all of them would have one key.
    row = F.xxhash64(F.lit(seed), F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.col("text")))
    draw = (F.shiftrightunsigned(row, 11) + F.lit(0.5)) / 2.0**53
    weight = F.greatest(F.coalesce(quality, F.lit(0.05)), F.lit(1e-6))
    kept = [F.col(c).alias(f"_{i}") for i, c in enumerate(keep)]
    slim = docs.select(
        *kept,
        F.col("doc_id").alias("id"),
        F.col("source"),
        word_count(F.col("text")).alias("size"),
        (-F.log(draw) / weight).alias("key"),
    )
    place = (-F.expm1(-F.col("key")) * CELLS * CELLS).cast("long")
    slim = (
        slim.withColumn("cell", F.least(place, F.lit(CELLS * CELLS - 1)))
        .withColumn("cell1", (F.col("cell") / CELLS).cast("int"))
        .withColumn("cell2", (F.col("cell") % CELLS).cast("int"))
    )
    slim = stored(slim, "mix-keys")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stored(targets(sizes, weights, most_epochs), "mix-targets")

    with_plan = slim.join(
        plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    )
    first = stored(last_cell(with_plan.withColumn("taken_before", F.lit(0)), "cell1"), "mix-cells")
    inside = with_plan.join(first, ["source_no", "cell1"])
    second = stored(
        first.withColumnRenamed("taken_before", "_").join(
            last_cell(inside, "cell2"), "source_no", "left"
        ),
        "mix-cells",
    ).select("source_no", F.col("cell1").alias("end1"), F.col("cell2").alias("end2"), "taken_before")

    placed = with_plan.join(second, "source_no", "left")
    end = F.col("end1") * CELLS + F.col("end2")
    at_end = F.coalesce(F.col("cell") == end, F.lit(False))
    order = Window.partitionBy("source_no").orderBy("key", "id", "size")
    sums = F.col("taken_before") + F.sum("size").over(order) - F.col("size") / 2
    edge = placed.filter(at_end).withColumn("sampled", sums <= F.col("rest"))
    others = placed.filter(~at_end).withColumn(
        "sampled",
        F.when(F.col("end1").isNull(), F.col("rest") > 0).otherwise(F.col("cell") < end),
    )
    result = others.select(edge.columns).union(edge)
    taken = F.col("size") * (F.col("epochs") + F.col("sampled").cast("int"))
    return result.select(
        *(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)),
        "size",
        "source_size",
        "target",
        "epochs",
        "sampled",
        taken.cast("long").alias("taken"),
    )

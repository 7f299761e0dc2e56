"""Mix sources to target weights by capped water-filling.

Every source gets the share of all words that its weight gives it, but not more than
``max_epochs`` times its own words. What a clamped source cannot take is shared out to the
others by weight, until no source is above its limit. The limit can only be passed upwards as
the common level rises, so one number, the level (words for each unit of weight), is the whole
state of the filling.

A document is repeated as often as its source fits whole into its target; for the fraction
that is left, documents are taken in the order of a seeded hash until the words are nearest to
it. That needs no sort of a source: words are summed for each source and leading part of the
hash, and only the one part in which the fraction ends is sorted.

Defined results: a null text has size 0; rows with equal ids share their fate, and so do rows
without id if their texts are equal, while other rows without id are ordered by their texts; a source without
words has target 0; a null source is one source, the last; an empty table gives an empty mix.
Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakezones.llm.text import WORD, whole
from lakezones.operators.keys import surrogate_key
from lakezones.session import stage
from lakezones.specs import quoted

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"

# Leading hexadecimal digits of the hash by which words are summed: 4096 parts of each source.
PART_DIGITS = 3

# Sources up to this number are broadcast to the documents (at most about 100 bytes each).
BROADCAST_SOURCES = 100_000
SALTS = 64


def document_key(doc_id: Column, text: Column, seed: str) -> Column:
    """The place of a document in the seeded order of its source: by its id, or by its text if it has none."""
    named = F.coalesce(doc_id.cast("string"), F.concat(F.lit("null:"), F.md5(whole(text))))
    return F.md5(F.concat(F.lit(seed + ":"), named))


def measured(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Id, source, number of words and seeded key of each document; no text."""
    return docs.select(
        "doc_id",
        "source",
        F.regexp_count(whole(F.col("text")), F.lit(WORD)).cast("bigint").alias("size"),
        document_key(F.col("doc_id"), F.col("text"), seed).alias("key"),
    )


def fill_level(sources: DataFrame, max_epochs: int) -> float:
    """Words for each unit of weight when no source is above its limit any more.

    ``sources`` has one row per source. Each round is one sum over it; only the level comes to
    the driver.
    """
    limit = F.col("source_size") * max_epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, clamped = 0.0, -1
    while total:
        above = limit < F.col("weight") * F.lit(level)
        taken, weight, count = sources.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
            F.count_if(above),
        ).first()
        if count == clamped or not weight:
            break
        clamped, level = count, (total - taken) / weight
    return level


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """One row per source: its words, weight and target. Staged."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = surrogate_key(
        sums.withColumn("absent", F.col("source").isNull()), ["absent", "source"], "rank", start_key=0
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    weighted = stage(ranked.select("source", "source_size", weight.alias("weight")), "mix-sources")
    level = fill_level(weighted, max_epochs)
    target = F.least(F.col("weight") * F.lit(level), (F.col("source_size") * max_epochs).cast("double"))
    return weighted.withColumn("target", target)


def mix_plan(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """One row per source: target, whole repetitions, and the last key taken once more.

    ``sizes`` is what ``measured`` gives, staged.
    """
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = (
        source_targets(sizes, weights, max_epochs)
        .withColumn("whole", epochs.cast("bigint"))
        .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    part = F.substring("key", 1, PART_DIGITS)
    parts = sizes.groupBy("source", part.alias("part")).agg(F.sum("size").alias("words"))
    # At most 16 ** PART_DIGITS rows of a source.
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    reached = parts.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    ends = (
        _with_source(reached, targets.select("source", "need"))
        .filter((F.col("before") <= F.col("need")) & (F.col("need") < F.col("before") + F.col("words")))
        .select(F.col("source").alias("_source"), F.col("part").alias("_part"), "before", "need")
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (part == F.col("_part"))
    within = (
        sizes.join(ends, same)
        .groupBy("source", F.col("_part").alias("part"), "before", "need", "key")
        .agg(F.sum("size").alias("words"))
    )
    running = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("before") + F.sum("words").over(running) - F.col("words") / 2
    cuts = (
        within.withColumn("taken", middle <= F.col("need"))
        .groupBy("source", "part")
        .agg(F.max(F.when(F.col("taken"), F.col("key"))).alias("last"))
        .select("source", F.coalesce("last", "part").alias("cut"))
    )
    columns = ["source", "source_size", "target", "whole", "need"]
    # No cut: nothing is left to take, and no key is below the empty text.
    return _with_source(targets.select(*columns), cuts, "left").select(*columns, F.coalesce("cut", F.lit("")).alias("cut"))


def _with_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the source, null included."""
    right = right.withColumnRenamed("source", "_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def repetitions(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with source and key) and what the plan says of them, plus ``copies``.

    The plan has one row per source. It is broadcast up to a measured number of sources; beyond,
    it is repeated for each of ``SALTS`` parts of a source, so that no task gets a whole one.
    """
    # Where nothing is left to take, documents without words are not taken once more either.
    more = (F.col("need") > 0) & (F.col("key") <= F.col("cut"))
    copies = (F.col("whole") + more.cast("bigint")).alias("copies")
    if plan.count() <= BROADCAST_SOURCES:
        joined = _with_source(rows, F.broadcast(plan))
    else:
        salted = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = salted.withColumnRenamed("source", "_source")
        rows = rows.withColumn("_part", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
        on = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_part") == F.col("_salt"))
        joined = rows.join(salted, on).drop("_source", "_salt", "_part")
    return joined.select("*", copies).drop("whole", "need", "cut")


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED
) -> DataFrame:
    """For each document: size, source_size, target, taken (words the mix takes) and copies."""
    sizes = stage(measured(docs, seed), "mix-sizes")
    plan = stage(mix_plan(sizes, weights, max_epochs), "mix-plan")
    return repetitions(sizes, plan).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def mixed_documents(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED
) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``, each row as often as it is taken."""
    sizes = stage(measured(docs, seed), "mix-sizes")
    plan = stage(mix_plan(sizes, weights, max_epochs), "mix-plan")
    columns = F.struct(*[docs[quoted(name)] for name in docs.columns])
    rows = docs.select(columns.alias("row"), docs["source"], document_key(docs["doc_id"], docs["text"], seed).alias("key"))
    repeated = repetitions(rows, plan).filter("copies > 0")
    return repeated.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")

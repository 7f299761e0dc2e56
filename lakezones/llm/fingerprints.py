"""Threshold-scaled sketches: keep every shingle hash below a fixed fraction of all hashes.

The sketch of a text grows with it, so that sketches of very unequal documents compare by
containment, and the sketch of several texts together is the union of theirs. Shingles are runs
of five words. So that a short text is not left without any hash, its least one is kept where none
is below the fraction; such a hash says whether two texts are alike, but not whether one is
part of another, which is then unknown (null).

Defined results: a null or empty text has an empty sketch; two empty sketches are alike to 1,
an empty and another one to 0; an empty sketch is contained in every one; equal texts have equal
fingerprints; rows with equal ids follow each other in the order of a hash of their text; a null id
comes last; a table of one row is followed by itself; other columns of the input are not read.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakezones.llm.text import LONG_ARRAY, shingle_hashes, split_words, whole
from lakezones.session import stage

WIDTH = 5
# One of so many shingle hashes is kept.
SCALE = 4

# Bytes of text in a range of ids, and the most ranges.
RANGE_BYTES = 8 << 20
MOST_RANGES = 10_000

LEAST_LONG = -(1 << 63)


def below_fraction(hashes: Column, scale: int = SCALE) -> Column:
    """The hashes below the fixed fraction, one ``scale``-th of all."""
    limit = F.lit(LEAST_LONG + (1 << 64) // scale)
    return F.filter(hashes, lambda h: h < limit)


def sketch(words: Column, width: int = WIDTH, scale: int = SCALE) -> Column:
    """The kept shingle hashes in ascending order. ``words`` must be a column."""
    hashes = shingle_hashes(words, width)

    def kept(found: Column) -> Column:
        below = F.sort_array(F.array_distinct(below_fraction(found, scale)))
        least = F.when(F.size(found) > 0, F.array(F.array_min(found))).otherwise(F.array().cast(LONG_ARRAY))
        return F.when(F.size(below) > 0, below).otherwise(least)

    return F.get(F.transform(F.array(hashes), kept), 0)


def fingerprint(kept: Column) -> Column:
    """A sketch as text: its hashes, 16 hexadecimal digits each, in order."""
    return F.array_join(F.transform(kept, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of both texts together, as if it were made of all their shingles."""

    def kept(found: Column) -> Column:
        below = below_fraction(found, scale)
        return F.when(F.size(below) > 0, below).otherwise(F.slice(found, 1, 1))

    return F.get(F.transform(F.array(F.sort_array(F.array_union(a, b))), kept), 0)


def likeness(a: Column, b: Column) -> Column:
    """Common share of the shingles of both texts, 0 to 1."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


def containment(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Share of the first text's shingles that the second has, 0 to 1; null if the sketch of the first cannot tell."""

    def share(found: Column) -> Column:
        return F.when(F.size(found) > 0, F.size(F.array_intersect(found, b)) / F.size(found))

    known = F.get(F.transform(F.array(below_fraction(a, scale)), share), 0)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(known)


def range_number(value: Column, cuts: list[int]) -> Column:
    """How many of the descending ``cuts`` are greater than ``value``.

    Looked up in two steps, so that the work grows with the root of the number of cuts.
    """
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]

    def greater(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda cut: cut > value))

    full = greater(F.lit([group[-1] for group in groups]).cast(LONG_ARRAY))
    rest = F.get(F.array(*[F.lit(group).cast(LONG_ARRAY) for group in groups]), full)
    return F.when(full < len(groups), full * step + greater(rest)).otherwise(len(cuts))


def with_next(rows: DataFrame) -> tuple[DataFrame, Window]:
    """Rows of ``doc_id``, ``text`` and ``copy``, and the window in which ``lead`` finds the next row.

    The rows are cut into ranges of ids at quantiles, as many as their bytes ask for. An id, or the
    lack of one, that fills several quantiles is cut further by the hash of the text, which orders
    its rows. Each range is a group of its own, and the first row of a range is also put, as a copy,
    at the end of the range before it (that of the first range at the end of the last), so that the next row of
    every row that is no copy is in its group. One shuffle moves the texts, and no group grows with
    the table. Only the cuts, and the first id and hash of each range, come to the driver.
    """
    named = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole(F.col("text")).alias("text"))
    named = named.withColumn("hash", F.xxhash64("text"))
    size, total, without = named.agg(
        F.sum(F.octet_length("text")), F.count("*"), F.count_if(F.col("doc_id").isNull())
    ).first()
    count = min(max((size or 0) // RANGE_BYTES, 1), MOST_RANGES)
    # Rows without an id are a last id of their own.
    with_id = max(1, round(count * (total - without) / total)) if total else 1
    found = named.agg(F.percentile_approx("doc_id", [i / with_id for i in range(1, with_id)], 10 * with_id)).first()[0] if with_id > 1 else []
    quantiles = Counter(found or [])
    cuts = sorted(quantiles, reverse=True)
    # A range holds the rows of its greatest id, in ``often`` parts by hash, and then those of lesser ids.
    often = [0, *(quantiles[cut] if quantiles[cut] > 1 else 0 for cut in cuts)]
    greatest = [None, *cuts]
    parts = [many + 1 for many in often] + [max(1, round(count * without / total))] if total else [1, 1]
    offsets = [sum(parts[:i]) for i in range(len(parts))]
    doc_id, last = F.col("doc_id"), len(cuts) + 1
    number = F.when(doc_id.isNull(), last).otherwise(range_number(doc_id, cuts)).cast("int")

    def of_number(values: list, kind: str = "bigint") -> Column:
        return F.get(F.lit(values).cast(f"array<{kind}>"), F.col("number"))

    def part_by_hash(many: Column) -> Column:
        place = F.floor((F.col("hash") / F.lit(2.0**64) + 0.5) * many)
        return F.greatest(F.least(place, many - 1), F.lit(0))

    many = of_number([*often, parts[-1]])
    part = (
        F.when(doc_id.isNull(), part_by_hash(many))
        .when((many > 0) & (doc_id == of_number([*greatest, None])), part_by_hash(many))
        .otherwise(many)
    )
    numbered = named.withColumn("number", number).withColumn("range", (of_number(offsets) + part).cast("int"))
    # In the order of rows: a null id last, then the greatest id, then the least hash.
    place = F.struct(doc_id.isNull().alias("absent"), F.bitwise_not(doc_id).alias("id"), F.col("hash"))
    firsts = {row["range"]: row["first"] for row in numbered.groupBy("range").agg(F.min(place).alias("first")).collect()}
    present = sorted(firsts)
    earlier = {one: present[i - 1] for i, one in enumerate(present)}
    ranges = range(sum(parts))

    def of_range(values: list, kind: str = "bigint") -> Column:
        return F.get(F.lit(values).cast(f"array<{kind}>"), F.col("range"))

    first_id = of_range([~firsts[i]["id"] if i in firsts and firsts[i]["id"] is not None else None for i in ranges])
    first_hash = of_range([firsts[i]["hash"] if i in firsts else None for i in ranges])
    # Rows that repeat the first id and text are all the same; one of them is copied.
    copied = numbered.filter(doc_id.eqNullSafe(first_id) & (F.col("hash") == first_hash))
    copied = copied.groupBy("range").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("hash").alias("hash"))
    before = of_range([earlier.get(i) for i in ranges], "int")
    own = numbered.select("doc_id", "text", "hash", "range", F.lit(False).alias("copy"))
    placed = own.unionByName(copied.select("doc_id", "text", "hash", before.alias("range"), F.lit(True).alias("copy")))
    return placed, Window.partitionBy("range").orderBy("copy", F.col("doc_id").desc_nulls_last(), "hash")


def edited(text: Column, following: Column) -> Column:
    """The text with its last half (rounded down) replaced by the start of the following one."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprint_documents(docs: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are."""
    rows, again = _once(docs.select("doc_id", "text"))
    placed, order = with_next(rows)
    pairs = placed.withColumn("following", F.lead("text").over(order))
    own = _sketched(pairs, "range", "copy", "hash", width=width, scale=scale)
    compared = own.withColumn("next", F.lead("own").over(order)).filter(~F.col("copy"))
    result = _compared(compared, F.col("next"))
    if again is None:
        return result
    # All but the last of several equal rows are followed by their own text.
    repeated = _sketched(again.withColumn("following", F.col("text")), "more", width=width, scale=scale)
    copies = repeated.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "more")))
    return result.unionByName(_compared(copies, F.col("own")))


def _once(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows with each id and text once, and those that occur again (``more`` times), if there are any.

    Each task first cuts the rows of a key to one, so that very many copies are no group in one task.
    """
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole(F.col("text")).alias("text"))
    named = named.withColumn("hash", F.xxhash64("text"))
    counted = named.groupBy("doc_id", "hash").agg(F.count("*").alias("rows")).filter("rows > 1")
    often = stage(counted.select(F.col("doc_id").alias("of"), F.col("hash").alias("of_hash")), "fingerprint-repeats")
    if often.isEmpty():
        return named.drop("hash"), None
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("hash") == F.col("of_hash"))
    single = named.join(often, same, "left_anti").select("doc_id", "text")
    groups = named.join(often, same, "left_semi").groupBy("doc_id", F.sha2("text", 256).alias("digest"))
    once = stage(groups.agg(F.first("text").alias("text"), (F.count("*") - 1).alias("more")).drop("digest"), "fingerprint-once")
    return single.unionByName(once.select("doc_id", "text")), once.filter("more > 0")


def _sketched(pairs: DataFrame, *kept: str, width: int, scale: int) -> DataFrame:
    """The sketches of each text and of its edited text."""
    worded = pairs.withColumn("edited", edited(F.col("text"), F.col("following"))).withColumns(
        {"words": split_words(F.col("text")), "edited_words": split_words(F.col("edited"))}
    )
    return worded.select(
        "doc_id", *kept, F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        sketch(F.col("words"), width, scale).alias("own"),
        sketch(F.col("edited_words"), width, scale).alias("changed"),
    )


def _compared(sketched: DataFrame, following: Column) -> DataFrame:
    return sketched.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), following).alias("near_next"),
    )

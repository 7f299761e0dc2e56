"""Line-first cleaning: judge lines, remove those that fail, then judge what is left.

A text first has to pass the base rules: enough words, and not too many words in repeated
three-word windows. Its lines are then judged one by one. A line fails as navigation (menu
separators between few words), as boilerplate (a stock phrase of page frames), or by its
punctuation (symbols instead of words, or no closing mark at the end of a line that is not
part of running text). A text that loses too large a part of its words with them is rejected.

Defined results: a null or empty text has no words, fails the base rules and is rejected; lines
without a word are neither counted nor judged; rows are judged one by one, so that repeated rows
agree and an empty table stays empty; of other columns only n_chars is set anew. No limit on
the length of a text; all work on a text is linear in it but for one sort of its windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakezones.llm.text import SPACE_RUN, SPACES, WORD, indices, split_words, whole
from lakezones.specs import quoted

SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
WINDOW = 3

# Lines that lose more than this share of all words reject the text.
MAX_LOST = 50  # per cent

# A line of which more than this share of the word characters is symbols has failed.
MAX_LINE_SYMBOLS = 10  # per cent
# A line without closing mark fails when it is shorter than this.
MIN_OPEN_WORDS = 5

# Separators of menus, closing marks, and phrases of page frames in lower case.
SEPARATORS = "|»«›‹•·→"
CLOSING = ".!?…。！？:;,)]}\"'”’»"
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "accept cookies",
    "uses cookies",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "privacy policy",
    "terms of service",
    "terms of use",
    "skip to content",
    "sign in to continue",
    "subscribe to our newsletter",
)


def count_of(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are in ``characters``; most texts have none, which is found faster."""
    some = text.rlike("[" + "".join("\\" + c if c in "$|<>&#*%" else c for c in characters) + "]")
    return F.when(some, F.length(text) - F.length(F.translate(text, characters, ""))).otherwise(0)


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(whole(text), "\n", -1), lambda line: line.rlike(WORD))


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more. ``words`` must be bound, not computed."""
    hashes = F.transform(
        indices(F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    )

    def covered(starts: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda s: F.array(s, s + 1, s + 2)))))

    def starts(found: Column) -> Column:
        """Starts of the windows that have an equal neighbour in hash order."""
        placed = F.transform(found, lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
        return _let(F.sort_array(placed), beside)

    def beside(ordered: Column) -> Column:
        def equal(i: Column, j: Column) -> Column:
            return F.coalesce(F.get(ordered, i)["hash"] == F.get(ordered, j)["hash"], F.lit(False))

        twice = F.filter(indices(F.size(ordered)), lambda i: equal(i, i - 1) | equal(i, i + 1))
        return F.transform(twice, lambda i: F.get(ordered, i)["at"])

    def count(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(covered(starts(found)))

    return _let(hashes, count)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def failed_line(line: Column, phrases: Column | None = None) -> Column:
    """Whether a line fails a rule; ``phrases`` says whether its text has a stock phrase at all."""
    words = F.regexp_count(line, F.lit(WORD))

    def navigation(separators: Column) -> Column:
        return (separators >= 2) & (separators * 4 >= words)

    def symbols(found: Column) -> Column:
        return (found > 0) & (found * 100 > F.length(F.regexp_replace(line, SPACE_RUN, "")) * MAX_LINE_SYMBOLS)

    boilerplate = F.lower(line).rlike("|".join(BOILERPLATE))
    if phrases is not None:
        boilerplate = phrases & boilerplate
    last = F.substring(F.rtrim(line, F.lit(SPACES)), -1, 1)
    open_end = (F.instr(F.lit(CLOSING), last) == 0) & (words < MIN_OPEN_WORDS)
    return (
        _let(count_of(line, SEPARATORS), navigation) | boilerplate | _let(count_of(line, SYMBOLS), symbols) | open_end
    )


def has_phrase(text: Column) -> Column:
    """Whether the text has a stock phrase anywhere."""

    def any_of(lower: Column) -> Column:
        found = lower.contains(BOILERPLATE[0])
        for phrase in BOILERPLATE[1:]:
            found = found | lower.contains(phrase)
        return found

    return _let(F.lower(whole(text)), any_of)


def counts_of(text: Column) -> Column:
    """The counts of the base rules and of the line rules, as one struct.

    One expression that binds what it uses more than once: it stays linear wherever the optimizer
    moves it, as below a filter.
    """

    def counts(parts: Column) -> Column:
        words, lines, joined = parts["words"], parts["lines"], parts["joined"]
        lost = F.filter(lines, lambda line: failed_line(line, parts["phrases"]))
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(joined).cast("bigint").alias("word_chars"),
            count_of(joined, SYMBOLS).cast("bigint").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            repeated_words(words).cast("bigint").alias("n_repeat_words"),
            F.regexp_count(F.array_join(lost, "\n"), F.lit(WORD)).cast("bigint").alias("n_lost_words"),
        )

    def with_joined(parts: Column) -> Column:
        return F.struct(parts["words"], parts["lines"], parts["phrases"], F.array_join(parts["words"], "").alias("joined"))

    split = F.struct(
        split_words(text).alias("words"), lines_with_words(text).alias("lines"), has_phrase(text).alias("phrases")
    )
    return _let(_let(split, with_joined), counts)


def base_failed(counts: Column) -> Column:
    repeated = counts["n_repeat_words"] * 100 > counts["n_words"] * MAX_REPEATED
    return (counts["n_words"] < MIN_WORDS) | repeated


def passes(counts: Column) -> Column:
    return ~base_failed(counts) & (counts["n_lost_words"] * 100 <= counts["n_words"] * MAX_LOST)


def apply_quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document."""
    rows = docs.select("doc_id", counts_of(F.col("text")).alias("counts"))
    counts = F.col("counts")
    return rows.select("doc_id", "counts.*", base_failed(counts).alias("base_failed"), passes(counts).alias("kept"))


def cleaned_text(text: Column) -> Column:
    """The text without the lines that fail; empty lines stay."""

    def cleaned(phrases: Column) -> Column:
        lines = F.split(whole(text), "\n", -1)
        return F.array_join(F.filter(lines, lambda line: ~(line.rlike(WORD) & failed_line(line, phrases))), "\n")

    return _let(has_phrase(text), cleaned)


def passing_text(text: Column) -> Column:
    """The cleaned text, null where the text is rejected. One expression, as ``counts_of``."""

    def passing(counts: Column) -> Column:
        whole_text = F.when(counts["n_lost_words"] == 0, whole(text)).otherwise(cleaned_text(text))
        return F.when(passes(counts), whole_text)

    return _let(counts_of(text), passing)


def passing_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass all rules, with the cleaned text, and its length as ``n_chars`` if they have that."""
    # A generator, as the text would be judged twice if a filter were moved below its projection.
    passing = F.explode(F.filter(F.array(passing_text(F.col("row.text"))), lambda text: text.isNotNull()))
    rows = docs.select(F.struct(*[F.col(quoted(name)) for name in docs.columns]).alias("row")).select("row", passing.alias("cleaned"))
    changed = {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("bigint")}
    return rows.select(*[changed.get(name, F.col("row")[name]).alias(name) for name in docs.columns])

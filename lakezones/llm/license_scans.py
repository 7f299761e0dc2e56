"""License texts in documents: stock phrases, and an exact set-similarity join with templates.

A word is a longest run of letters, digits and characters beyond ASCII, A-Z lower-cased.

Phrases: each place where the words of a phrase stand one after another.

Templates: a text block is a paragraph, that is lines up to one without words. A paragraph of
over twice the words of the longest template is cut into blocks of that many words, each
starting half a block after the one before, so that any passage as long as a template lies
whole in one of them and a long text meets no template by the mere number of its words. A block
matches a template if it holds at least ``containment`` percent of the template's distinct words.

The join finds every such pair. Only words of the templates can be shared, so that a block
comes down to those of its words, in order of their number of blocks in the whole corpus, rarest first. A
block that shares at least ``need`` of a template's words has the first shared one among its own
first ``size - need + 1`` words and among the template's (prefix filter), has at least ``need``
words (length filter), and has enough words left behind that place in both (positional filter).
What is left is counted in full. The templates are a parameter, so that their words, which are
broadcast and whose counts come to the driver, do not grow with the corpus.

Documents are read once; what is staged has one row per document, with the few blocks that pass
the length filter and without the text.

Defined results: a null or empty text has no words, places or labels and the score 0; rows that
repeat an id or a text each get their own result; an empty table gives no rows; other columns are
not read. Whole texts are searched, of any length.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakezones.llm.text import ascii_lower, whole
from lakezones.session import stage

# Phrases and the labels they give.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# The public notices that projects put into their files, with the label of each.
TEMPLATES = (
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,"
        " and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The"
        " above copyright notice and this permission notice shall be included in all copies or substantial portions of"
        " the Software.",
    ),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See"
        " the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    (
        "gpl",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
        " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License"
        " for more details.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: Redistributions of source code must retain the above copyright notice,"
        " this list of conditions and the following disclaimer.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
        " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled"
        " binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this"
        " license, visit http://creativecommons.org/licenses/by/4.0/",
    ),
)

# Percent of a template's distinct words that a block must hold.
CONTAINMENT = 80

# The characters between words, after A-Z are lower-cased; the same for Java, Python and RE2.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
# A line without words ends a paragraph.
PARAGRAPH_END = rf"\n{BETWEEN}*\n"

Templates = Sequence[tuple[str, str]]


def template_words(text: str) -> list[str]:
    """The words of a template."""
    lower = re.sub("[A-Z]+", lambda found: found.group().lower(), text)
    return [word for word in re.split(f"{BETWEEN}+", lower) if word]


def block_width(templates: Templates) -> int:
    """The most words of a block: twice those of the longest template."""
    return 2 * max((len(template_words(text)) for _, text in templates), default=1)


def shared_at_least(words: int, containment: int) -> int:
    """The least number of shared words that is ``containment`` percent of ``words``."""
    return max(1, -(-words * containment // 100))


def _spaced(lower: Column) -> Column:
    """The words, each with one space before it and the last also behind it; one space without words."""
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), f"{BETWEEN}+", " ")


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("bigint")


def _blocks(lower: Column, vocabulary: list[str], width: int, least: int) -> Column:
    """The distinct template words of each block that has ``least`` of them."""
    step = width // 2

    def cut(words: Column) -> Column:
        pieces = F.ceil((F.size(words) - width) / F.lit(step)).cast("int")
        many = F.transform(F.sequence(F.lit(0), pieces), lambda i: F.slice(words, i * step + 1, width))
        return F.when(F.size(words) <= width, F.array(words)).otherwise(many)

    # Each step binds its array, which would be computed anew for every element otherwise.
    paragraphs = F.transform(
        F.split(lower, PARAGRAPH_END, -1), lambda text: F.split(F.regexp_replace(text, f"{BETWEEN}+", " "), " ", -1)
    )
    known = F.array(*map(F.lit, vocabulary))
    sets = F.transform(F.flatten(F.transform(paragraphs, cut)), lambda words: F.array_intersect(known, words))
    return F.filter(sets, lambda words: F.size(words) >= least)


def _scanned(
    docs: DataFrame, phrases: Mapping[str, str], vocabulary: list[str], width: int, least: int
) -> DataFrame:
    """A staged row per document: counts and places of the phrases, and the blocks to compare."""
    lower = ascii_lower(whole(F.col("text")))
    rows = docs.select("doc_id", lower.alias("lower")).withColumn("spaced", _spaced(F.col("lower")))
    spaced = F.col("spaced")
    stands = {phrase: F.contains(spaced, F.lit(f" {phrase} ")) for phrase in phrases}
    anywhere = F.lit(False)
    for found in stands.values():
        anywhere = anywhere | found

    def before(pattern: str) -> Column:
        """The number of words before the place where the pattern puts it."""
        place = rf"(?s)^({pattern}) (?:{'|'.join(map(re.escape, phrases))}) "
        return F.when(F.col("anywhere"), _spaces(F.regexp_extract(spaced, place, 1)))

    count = F.lit(0).cast("bigint")
    for phrase, found in stands.items():
        # Nothing is consumed, so that places may share words.
        places = F.regexp_count(spaced, F.lit(rf"(?= {re.escape(phrase)} )"))
        count = count + F.when(found, places).otherwise(0)
    labels = F.array_compact(F.array(*[F.when(found, F.lit(phrases[phrase])) for phrase, found in stands.items()]))
    blocks = _blocks(F.col("lower"), vocabulary, width, least) if vocabulary else F.array().cast("array<array<string>>")
    counted = rows.withColumn("anywhere", anywhere).select(
        "doc_id",
        F.when(spaced == " ", F.lit(0)).otherwise(_spaces(spaced) - 1).cast("bigint").alias("n_words"),
        count.alias("n_base"),
        before(".*?").alias("first_word"),
        before(".*").alias("last_word"),
        F.array_sort(F.array_distinct(labels)).alias("base"),
        blocks.alias("blocks"),
    )
    # The number of a row is fixed by being written.
    return stage(counted.withColumn("row_id", F.monotonically_increasing_id()), "license-blocks")


def _ordered_templates(blocks: DataFrame, sets: list[tuple[str, set[str]]], containment: int) -> tuple[list[str], list]:
    """All template words by their number of blocks, and the templates with their words in that order."""
    counts = blocks.select(F.explode("words").alias("word")).groupBy("word").count()
    # One row per word of the templates at most.
    frequency = dict(counts.collect())
    order = sorted(set().union(*(words for _, words in sets)), key=lambda word: (frequency.get(word, 0), word))
    place = {word: at for at, word in enumerate(order)}
    index = []
    for number, (label, words) in enumerate(sets):
        ordered, need = sorted(words, key=place.__getitem__), shared_at_least(len(words), containment)
        for at, word in enumerate(ordered[: len(ordered) - need + 1]):
            index.append((word, number, label, at, need, ordered))
    return order, index


def matching_blocks(blocks: DataFrame, sets: list[tuple[str, set[str]]], containment: int) -> DataFrame:
    """row_id, template, label, shared and size of every block and template that match.

    ``blocks`` has row_id and ``words``, the distinct template words of a block. A block that
    repeats in a row gives a pair for each.
    """
    spark = blocks.sparkSession
    order, index = _ordered_templates(blocks, sets, containment)
    known = F.array(*map(F.lit, order))
    least = min(shared_at_least(len(words), containment) for _, words in sets)
    ordered = blocks.select("row_id", F.array_intersect(known, "words").alias("words"))
    sized = ordered.withColumn("size", F.size("words")).filter(F.col("size") >= least)
    prefixes = sized.select(
        "row_id", "words", "size", F.posexplode(F.slice("words", 1, F.col("size") - (least - 1))).alias("place", "word")
    )
    schema = "word string, template int, label string, template_place int, need int, template_words array<string>"
    postings = spark.createDataFrame(index, schema)
    length = F.col("size") >= F.col("need")
    prefix = F.col("place") <= F.col("size") - F.col("need")
    left = F.least(F.col("size") - F.col("place"), F.size("template_words") - F.col("template_place"))
    # Each pair once, at the first word that it shares.
    first = ~F.arrays_overlap(F.slice("words", 1, F.col("place")), F.col("template_words"))
    # The postings are the words of the given templates.
    candidates = prefixes.join(F.broadcast(postings), "word").filter(length & prefix & (left >= F.col("need"))).filter(first)
    shared = candidates.withColumn("shared", F.size(F.array_intersect("words", "template_words")))
    return shared.filter(F.col("shared") >= F.col("need")).select(
        "row_id", "template", "label", "shared", F.size("template_words").alias("size")
    )


def scan_licenses(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Templates = TEMPLATES,
    containment: int = CONTAINMENT,
) -> DataFrame:
    """Per document: n_words, n_base, first_word, last_word, base_labels, labels, score, method_labels.

    ``score`` is 1 where a phrase stands, else the greatest share of a template's words that a
    matching block holds, else 0.
    """
    if not phrases:
        raise ValueError("at least one phrase is needed")
    if not 1 <= containment <= 100:
        raise ValueError("the containment is a percentage from 1 to 100")
    sets = [(label, set(template_words(text))) for label, text in templates]
    sets = [(label, words) for label, words in sets if words]
    vocabulary = sorted(set().union(*(words for _, words in sets)))
    least = min((shared_at_least(len(words), containment) for _, words in sets), default=1)
    scanned = _scanned(docs, phrases, vocabulary, block_width(templates), least)
    if sets:
        blocks = scanned.select("row_id", F.explode("blocks").alias("words"))
        matches = matching_blocks(blocks, sets, containment)
        found = matches.groupBy("row_id").agg(
            F.collect_set("label").alias("found"), F.max(F.col("shared") / F.col("size")).alias("held")
        )
        joined = scanned.join(found, "row_id", "left")
    else:
        joined = scanned.withColumns({"found": F.array().cast("array<string>"), "held": F.lit(None).cast("double")})
    method = F.array_sort(F.coalesce("found", F.array().cast("array<string>")))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", method)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("held", F.lit(0.0))).alias("score"),
        F.array_join(method, ",").alias("method_labels"),
    )

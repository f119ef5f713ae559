"""License scan: phrases at exact places, and notices found by an exact set-similarity join.

Words are ``[0-9a-z]`` and everything beyond ASCII after lower-casing A-Z. A notice of n words is looked for in every
window of n + n/2 consecutive words, whatever lines they stand on (a shorter text is one window): the window holds it
where it contains at least THRESHOLD of its distinct words, ``100 * |notice & window| >= THRESHOLD * |notice|``, all of
the words that it requires, in their order, and none of the words that mark a sibling (MARKS): siblings differ in a
word or two, which no threshold tells apart.

A window must hold the notice's anchor, one of the words it requires. Texts are laid out in steps of the longest window;
a step with an anchor in it becomes a block, with as many words to each side as a window can reach. Blocks of a text
thus hold each word at most three times, however often anchors repeat. The join finds blocks and notices, windows
of the blocks are verified.

The join: only words of notices can overlap, so blocks are reduced to them. Length filter: a block
with fewer notice words than the least overlap any notice asks for is out. Words are ordered by the number of
blocks that hold them, rarest first; a notice of n words that needs an overlap of o must meet a block in one of
its first n - o + 1 words, and the block in one of its first b - o + 1 (prefix filter). For the first shared
word at place i of the notice and j of the block the overlap is at most 1 + min(n - i, b - j)
(positional filter). What is left is verified on whole sets.

Cases: null text is empty: no words, no places, no labels, score 0; documents without an id and repeated
rows are scanned each; blocks without words are skipped; ties in the word order are broken by the word; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.support import LOWER_FROM, LOWER_TO, pick, prepare
from waymark.runtime import stage

THRESHOLD = 80
#: fixed values: phrases and their labels
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: fixed values: one-line notices and their labels
NOTICES = (
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under the Creative Commons Attribution ShareAlike 4.0 International License."),
    ("mit-notice", "Released under the MIT License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
)
#: fixed values: a notice's anchor, the words that it requires in this order, and words that mark a sibling
MARKS = {
    "gpl-2.0": ("gnu", ("gnu", "general", "2"), ("lesser", "affero")),
    "gpl-3.0": ("gnu", ("gnu", "general", "3"), ("lesser", "affero")),
    "agpl-3.0": ("affero", ("gnu", "affero", "3"), ()),
    "lgpl": ("lesser", ("gnu", "lesser"), ()),
    "apache-2.0": ("apache", ("apache", "2"), ()),
    "cc-by-4.0": ("cc", ("cc", "by", "4"), ("nc", "nd", "sa")),
    "cc-by-nc-4.0": ("cc", ("cc", "by", "nc", "4"), ("nd", "sa")),
    "cc-by-sa-4.0": ("sharealike", ("attribution", "sharealike", "4"), ("noncommercial",)),
    "mit-notice": ("license", ("mit", "license"), ()),
    "mpl-2.0": ("mozilla", ("mozilla", "2"), ()),
    "bsd": ("redistribution", ("redistribution", "source", "binary"), ()),
}
#: marks of a notice that has none: any of its words may anchor it
UNMARKED = (None, (), ())


def all_words_of(text: str) -> list[str]:
    """Words of a notice in their order, repeated ones included."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(LOWER_FROM, LOWER_TO)))


def words_of(text: str) -> list[str]:
    """Distinct words of a notice, as the scan sees them."""
    return sorted(set(all_words_of(text)))


NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def flat_words(lowered: str) -> Column:
    """All words of a lower-cased text, each between two spaces of its own: two spaces part two words."""
    inner = F.trim(F.regexp_replace(lowered, NOT_WORD, "  "))
    return F.when(inner == "", "").otherwise(F.concat(F.lit(" "), inner, F.lit(" ")))


def _needed(n: int, threshold: int) -> int:
    """Least overlap with a notice of n words."""
    return max(1, -(-threshold * n // 100))


def _n_words(column: str) -> str:
    """SQL for the words in a text whose words stand between two spaces and nothing else has spaces."""
    return f"cast((length({column}) - length(replace({column}, ' ', ''))) div 2 as long)"


def _span(text: str) -> int:
    """Words of the windows in which a notice is looked for."""
    return len(all_words_of(text)) * 3 // 2


def _anchors(text: str, anchor: str | None, threshold: int) -> list[str]:
    """Words of which every window with the notice holds one: its anchor, or any n - need + 1 of its words."""
    if anchor:
        return [anchor]
    words = words_of(text)
    return words[: len(words) - _needed(len(words), threshold) + 1]


def _in_order(required: Sequence[str]) -> str:
    """LIKE pattern of words that stand in this order in a text with each word between two spaces of its own."""
    return "% " + " % ".join(required) + " %" if required else "%"


def blocks_around(flat: str, anchors: Sequence[str], step: int, kept: Column, least: int) -> Column:
    """(held, run) of each step of ``step`` words with an anchor: ``run`` is the step and ``step`` - 1 words to each
    side, with other words than the ``kept`` ones empty, ``held`` the distinct kept words, at least ``least``."""
    none = F.array().cast("array<struct<held:array<string>,run:array<string>>>")
    if not anchors:
        return none
    wanted = F.array(*[F.lit(a) for a in anchors])

    def block(tokens: Column, at: Column) -> Column:
        from_word = F.greatest(at * step - (step - 1), F.lit(0))
        run = F.slice(tokens, from_word + 1, (at + 1) * step + (step - 1) - from_word)
        masked = F.transform(run, lambda x: F.when(F.array_contains(kept, x), x).otherwise(""))
        return F.struct(F.array_intersect(run, kept).alias("held"), masked.alias("run"))

    def of_text(tokens: Column) -> Column:
        places = F.transform(tokens, lambda x, i: F.when(F.array_contains(wanted, x), F.floor(i / step).cast("int")))
        return F.transform(F.array_distinct(F.array_compact(places)), lambda at: block(tokens, at))

    made = F.transform(F.array(F.split(F.trim(flat), "  ")), of_text)[0]
    some = F.expr(" or ".join(f"instr(flat, ' {a} ') > 0" for a in anchors))
    return F.when(some, F.filter(made, lambda x: F.size(x.held) >= least)).otherwise(none)


def phrase_places(scanned: DataFrame, phrases: Sequence[tuple[str, str]]) -> DataFrame:
    """n_words, n_base, first_word, last_word and base labels from ``flat`` (words only, spaced)."""
    count, first, last, labels = [], [], [], []
    for phrase, label in phrases:
        parts = phrase.split(" ")
        needle = " " + "  ".join(parts) + " "
        found = f"instr(flat, '{needle}') > 0"
        count.append(f"cast((length(flat) - length(replace(flat, '{needle}', ''))) div {len(needle)} as long)")
        head = _n_words(f"substring_index(flat, '{needle}', 1)")
        tail = _n_words(f"substring_index(flat, '{needle}', -1)")
        first.append(f"case when {found} then {head} end")
        last.append(f"case when {found} then {_n_words('flat')} - {tail} - {len(parts)} end")
        labels.append(f"case when {found} then '{label}' end")
    least = f"array_min(array_compact(array({', '.join(first)})))"
    most = f"array_max(array_compact(array({', '.join(last)})))"
    some = "instr(flat, ' license ') > 0 or instr(flat, ' cc ') > 0"
    if not all(" license " in f" {p} " or " cc " in f" {p} " for p, _ in phrases):
        some = "true"
    return scanned.select(
        "*",
        F.expr(_n_words("flat")).alias("n_words"),
        F.expr(f"case when {some} then {' + '.join(count)} else 0L end").alias("n_base"),
        F.expr(f"case when {some} then {least} end").alias("first_word"),
        F.expr(f"case when {some} then {most} end").alias("last_word"),
        F.expr(f"case when {some} then array_compact(array({', '.join(labels)})) else cast(array() as array<string>) end").alias("base"),
    )


def notice_join(blocks: DataFrame, notices: Sequence[tuple[str, str]], threshold: int) -> DataFrame:
    """(block, label, containment) of every block and notice that meet the threshold.

    ``blocks`` has the key ``block`` and the distinct notice words ``held`` of each block. The notices are an
    argument of the caller; their words become one small table.
    """
    spark = blocks.sparkSession
    wanted = [(label, w, n) for label, text in notices for n in [len(words_of(text))] for w in words_of(text)]
    tokens = blocks.select("block", F.explode("held").alias("word"))
    frequency = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n_blocks"))
    small = spark.createDataFrame(wanted, "label string, word string, n int")
    need = F.expr(f"greatest(1, cast(ceil(n * {threshold} / 100D) as int))")
    order = Window.partitionBy("label").orderBy(F.coalesce("n_blocks", F.lit(0)), "word")
    theirs = stage(
        small.join(frequency, "word", "left").select(
            "label", "word", "n", need.alias("need"), F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"),
            F.row_number().over(order).alias("i"),
        ),
        "licence-notices",
    )
    ranks = theirs.select("word", "n_blocks").distinct()
    # the words of a block in the global order: one array per block, no longer than the notices' vocabulary
    ordered = (
        tokens.join(ranks, "word").groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("n_blocks", "word"))).alias("held"))
        .select("block", F.size("held").alias("b"), F.expr("transform(held, x -> x.word)").alias("held"))
    )
    ours = ordered.select("block", "b", "held", F.posexplode("held").alias("j", "word"))
    prefixes = theirs.where("i <= n - need + 1").select("label", "word", "n", "need", "i")
    met = (
        ours.join(prefixes, "word")
        .where("b >= need and j + 1 <= b - need + 1")
        .where("1 + least(n - i, b - j - 1) >= need")
        .select("block", "label").distinct()
    )
    sets = theirs.groupBy("label").agg(F.collect_list("word").alias("words"), F.first("n").alias("n"))
    common = F.size(F.array_intersect("held", "words"))
    return (
        met.join(ordered, "block").join(sets, "label")
        .where(common * 100 >= F.col("n") * threshold)
        .select("block", "label", (common / F.col("n")).alias("containment"))
    )


def in_windows(
    found: DataFrame, blocks: DataFrame, notices: Sequence[tuple[str, str]], marks: Mapping[str, tuple], threshold: int
) -> DataFrame:
    """The rows of ``found`` whose block has a window that holds the notice, with the containment of the best one."""
    known = [
        (label, _span(text), words_of(text), _in_order(required), list(excluded))
        for label, text in notices
        for _, required, excluded in [marks.get(label, UNMARKED)]
    ]
    sizes = blocks.sparkSession.createDataFrame(
        known, "label string, length int, words array<string>, required string, excluded array<string>"
    )
    windows = "transform(sequence(0, greatest(0, size(run) - length)), i -> slice(run, i + 1, length))"
    common = F.expr(
        f"array_max(transform({windows}, w -> if(not arrays_overlap(w, excluded)"
        " and concat(' ', array_join(w, '  '), ' ') like required, size(array_intersect(w, words)), 0)))"
    )
    held = found.join(blocks.select("block", "run"), "block").join(sizes, "label").withColumn("common", common)
    return held.where(F.col("common") * 100 >= F.size("words") * threshold).select(
        "block", "label", (F.col("common") / F.size("words")).alias("containment")
    )


def scan(
    docs: DataFrame,
    notices: Sequence[tuple[str, str]] = NOTICES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    threshold: int = THRESHOLD,
    marks: Mapping[str, tuple[str | None, Sequence[str], Sequence[str]]] = MARKS,
) -> DataFrame:
    """Phrase places, labels and score (largest containment; a phrase in place counts as 1) per document."""
    prepare(docs.sparkSession)
    told = {w for label, _ in notices for part in marks.get(label, UNMARKED)[1:] for w in part}
    vocabulary = sorted(told | {w for _, text in notices for w in words_of(text)})
    least = min((_needed(len(words_of(text)), threshold) for _, text in notices), default=1)
    anchors = sorted({a for label, text in notices for a in _anchors(text, marks.get(label, UNMARKED)[0], threshold)})
    lowered = F.translate(F.coalesce("text", F.lit("")), LOWER_FROM, LOWER_TO)
    own = pick(docs, "doc_id", "text").select("doc_id", lowered.alias("lowered")).withColumn("flat", flat_words("lowered"))
    kept = F.array(*[F.lit(w) for w in vocabulary]).cast("array<string>")
    step = max((_span(text) for _, text in notices), default=1)
    blocks = blocks_around("flat", anchors, step, kept, least)
    scanned = stage(
        phrase_places(own, phrases).select(
            "doc_id", "n_words", "n_base", "first_word", "last_word", "base",
            blocks.alias("blocks"), F.monotonically_increasing_id().alias("row"),
        ),
        "licence-scanned",
    )
    blocks = scanned.select("row", F.posexplode("blocks").alias("at", "held")).select(
        F.struct("row", "at").alias("block"), "held.held", "held.run"
    )
    found = in_windows(notice_join(blocks, notices, threshold), blocks, notices, marks, threshold)
    of_row = found.groupBy(F.col("block.row").alias("row")).agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best")
    )
    none = F.array().cast("array<string>")
    joined = F.array_join(F.sort_array(F.array_union("base", F.coalesce("more", none))), ",")
    return scanned.join(of_row, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.sort_array(F.array_distinct("base")), ",").alias("base_labels"), joined.alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )

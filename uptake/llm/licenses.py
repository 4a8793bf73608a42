"""Licence scans: normalised text against licence templates by Dice coefficient.

Lines, a text of several lines as a whole, and runs of pieces are lower-cased, stripped of
punctuation and turned into their distinct word bigrams. Lines are cut into pieces after sentence
marks; a run joins neighbouring pieces, so a notice is found if it is wrapped over lines inside a
longer text, or stands in the middle of a long line. Two sets of sizes a and b have a Dice
coefficient of at most 2 min(a, b) / (a + b), so a template admits only sizes from
t b / (2 - t) to (2 - t) b / t for a threshold t. A template is listed under every size that it
admits: an equality join on the size finds the candidates and prunes all other templates before
any bigram is compared. A match also has one of a few bigrams of its template, as no more than
the others may be missing; a text, line or run without any of their words is left out before it
is split. Of runs that overlap, the best one is kept: each run competes at each of its pieces, and
stays if it wins at all of them, so no two runs are paired. Everything is built-in functions; only
matches are ever shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.8
MOST_NEEDLES = 256
SHORT_WORD = 4  # letters; words up to it are in too many texts to be good needles
MOST_BROADCAST_ROWS = 1 << 20  # templates by admitted size; more are joined by a shuffle
PIECE_END = r"([.!?;:])[ \t]+"
BLOCK = 64  # pieces whose runs one row makes

# Short licence notices in the wording that files carry.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["Released under CC0 1.0."],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ],
}


def templates(spark: SparkSession, texts: dict[str, list[str]] | None = None) -> DataFrame:
    rows = [(name, i, t) for name, own in (texts or TEMPLATES).items() for i, t in enumerate(own)]
    return spark.createDataFrame(rows, "license string, variant int, text string")


def words(text: Column) -> Column:
    """Runs of a-z, 0-9 and characters beyond ASCII; A-Z lower-cased."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, r"[\x00-/:-`{-\x7F]+"), lambda w: w != "")


def bigrams(own: Column) -> Column:
    """Distinct pairs of neighbouring words; a single word is one by itself."""
    n = F.size(own)
    pairs = F.zip_with(
        F.slice(own, 1, F.greatest(n - 1, F.lit(0))),
        F.slice(own, 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.array_distinct(F.when(n == 1, own).otherwise(pairs))


def _admitted(size: Column, threshold: float) -> tuple[Column, Column]:
    least = F.ceil(size * (threshold / (2 - threshold)) - 1e-9)
    return least, F.floor(size * ((2 - threshold) / threshold) + 1e-9)


def needles(known: DataFrame, threshold: float) -> list[str] | None:
    """Words of which every text that reaches the threshold has one; None if there are too many.

    A match has t b / (2 - t) or more of a template's b bigrams, so it has one of any set with
    one more than may be missing. Words are chosen greedily until they are in that many bigrams
    of every template: the word that is in most of those still needed, long words first. Only
    ASCII words are chosen, as a text is searched for them in lower case.
    """
    rows = known.select("template").limit(MOST_NEEDLES + 1).collect()
    if len(rows) > MOST_NEEDLES:
        return None
    left = [{frozenset(pair.split(" ")) for pair in r["template"]} for r in rows]
    need = [len(own) - math.ceil(len(own) * threshold / (2 - threshold) - 1e-9) + 1 for own in left]
    chosen: list[str] = []
    while any(n > 0 for n in need):
        gain: Counter[str] = Counter()
        for own, n in zip(left, need, strict=True):
            here = Counter(w for pair in own for w in pair if w.isascii()) if n > 0 else {}
            for w, count in here.items():
                gain[w] += min(count, n)
        if not gain or len(chosen) == MOST_NEEDLES:
            return None
        word = max(gain, key=lambda w: (len(w) > SHORT_WORD, gain[w], len(w), w))
        chosen.append(word)
        for i, own in enumerate(left):
            hit = {pair for pair in own if word in pair}
            left[i], need[i] = own - hit, need[i] - len(hit)
    return chosen


def _pieces(text: Column, widest: int, anchors: list[str] | None) -> Column:
    """The pieces of a text that have words: ``line``, ``begins`` and ``ends`` (that line), ``n``
    (words), ``own`` (the words; null if they are more than any run has) and ``hit``."""
    lines = F.transform(
        F.split(text, "\n", -1),
        lambda part, i: F.struct(
            (i + 1).alias("line"),
            F.filter(
                F.transform(F.split(F.regexp_replace(part, PIECE_END, "$1\u0001"), "\u0001"), words),
                lambda own: F.size(own) > 0,
            ).alias("pieces"),
        ),
    )
    known = F.array(*[F.lit(w) for w in anchors or []])
    return F.flatten(
        F.transform(
            lines,
            lambda one: F.transform(
                one["pieces"],
                lambda own, i: F.struct(
                    one["line"].alias("line"),
                    (i == 0).alias("begins"),
                    (i == F.size(one["pieces"]) - 1).alias("ends"),
                    F.size(own).alias("n"),
                    F.when(F.size(own) <= widest, own).alias("own"),
                    (F.lit(True) if anchors is None else F.arrays_overlap(own, known)).alias("hit"),
                ),
            ),
        )
    )


def _units(docs: DataFrame, id_col: str, text_col: str, widest: int, anchors: list[str] | None):
    """``row``, ``id``, ``first``, ``last`` (pieces; null for lines and whole texts), ``line``,
    ``last_line``, ``is_line`` and ``words`` of all that is compared. Each text is read once:
    lines and blocks of pieces leave one list, and blocks make the runs that start in them."""

    def may_match(text: Column) -> Column:
        if anchors is None:
            return text.isNotNull()
        lower = F.lower(text)
        return reduce(or_, [F.contains(lower, F.lit(w)) for w in anchors], F.lit(False))

    texts = docs.where(may_match(F.col(text_col))).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        _pieces(F.col(text_col), widest, anchors).alias("pieces"),
    )
    lines = F.split("text", "\n", -1)
    parts = F.concat(F.array(F.when(F.size(lines) > 1, F.col("text"))), lines)
    none = F.lit(None)
    pieces = "array<struct<line:int,begins:boolean,ends:boolean,n:int,own:array<string>,hit:boolean>>"
    block = f"struct<line:int,part:string,base:int,near:{pieces}>"
    as_lines = F.transform(
        parts, lambda part, i: F.struct(i.alias("line"), part.alias("part"), none, none).cast(block)
    )
    n_blocks = F.ceil(F.size("pieces") / BLOCK).cast("int")
    as_blocks = F.transform(
        F.when(n_blocks > 0, F.sequence(F.lit(0), n_blocks - 1)).otherwise(F.array().cast("array<int>")),
        lambda b: F.struct(
            none, none, (b * BLOCK).alias("base"),
            F.slice("pieces", b * BLOCK + 1, BLOCK + widest - 1).alias("near"),
        ).cast(block),
    )
    with_hits = F.filter(as_blocks, lambda u: F.exists(u["near"], lambda piece: piece["hit"]))
    units = texts.select("row", "id", F.explode(F.concat(as_lines, with_hits)).alias("u"))
    units = units.select("row", "id", "u.*").where(
        F.col("base").isNotNull() | may_match(F.col("part"))
    )

    # One row per line, or per piece of a block with the pieces that may follow it in a run.
    start = f"struct<first:int,near:{pieces}>"
    starts = F.transform(
        F.sequence(F.lit(1), F.least(F.size("near"), F.lit(BLOCK))),
        lambda i: F.struct(F.col("base") + i, F.slice("near", i, widest)).cast(start),
    )
    begun = F.when(F.col("base").isNull(), F.array(F.struct(none, none).cast(start)))
    begun = units.select("row", "id", "line", "part", F.explode(begun.otherwise(starts)).alias("s"))
    fitting = F.aggregate(
        "near",
        F.struct(F.lit(0).alias("words"), F.lit(0).alias("n")),
        lambda all, piece: F.struct(
            (all["words"] + piece["n"]).alias("words"),
            (all["n"] + (all["words"] + piece["n"] <= widest).cast("int")).alias("n"),
        ),
        lambda all: all["n"],
    )
    hit = F.array_position(F.transform("near", lambda piece: piece["hit"]), True).cast("int")
    begun = begun.select("row", "id", "line", "part", "s.*").select(
        "*", fitting.alias("fitting"), hit.alias("hit")
    )
    lengths = F.when(F.col("first").isNull(), F.array(F.lit(0))).when(
        (F.col("hit") > 0) & (F.col("hit") <= F.col("fitting")), F.sequence("hit", "fitting")
    )
    runs = begun.withColumn("n", F.explode(lengths)).withColumn("run", F.slice("near", 1, F.col("n")))
    is_run = F.col("first").isNotNull()
    joined = F.flatten(F.transform("run", lambda piece: piece["own"]))
    runs = runs.select(
        "row",
        "id",
        "first",
        (F.col("first") + F.col("n") - 1).alias("last"),
        F.when(is_run, F.element_at("run", 1)["line"]).otherwise(F.col("line")).alias("line"),
        F.when(is_run, F.element_at("run", -1)["line"]).otherwise(F.col("line")).alias("last_line"),
        (F.element_at("run", 1)["begins"] & F.element_at("run", -1)["ends"]).alias("whole_lines"),
        F.when(is_run, joined).otherwise(words(F.col("part"))).alias("words"),
    )
    one_line = is_run & (F.col("line") == F.col("last_line")) & F.col("whole_lines")
    return runs.withColumn("is_line", one_line).drop("whole_lines")


def _winners(matches: DataFrame, by: list[str]) -> DataFrame:
    """Matches that no better one of ``by`` overlaps: the higher coefficient is better, then
    fewer words, the earlier piece, the smaller license and variant. Lines and whole texts meet
    other templates of their own only."""
    rank = ["minus", "n_words", "first", "last", "license", "variant"]
    rest = [c for c in matches.columns if c not in (*rank, *by)]
    places = F.when(F.col("first").isNull(), F.array(-F.col("line") - 1)).otherwise(
        F.sequence("first", "last")
    )
    best = matches.withColumn("at", F.explode(places)).groupBy(*by, "at")
    best = best.agg(F.min(F.struct(*[c for c in rank if c not in by], *rest)).alias("m"))
    won = best.select(*by, "m.*")
    span = F.coalesce(F.col("last") - F.col("first") + 1, F.lit(1))
    kept = won.groupBy(*matches.columns).agg(F.count(F.lit(1)).alias("won"))
    return kept.where(F.col("won") == span).drop("won")


def license_matches(
    docs: DataFrame,
    known: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    best: bool = False,
) -> DataFrame:
    """``id``, ``line`` (from 1; 0 is the whole text), ``last_line``, ``first_piece``,
    ``last_piece``, ``license``, ``variant``, ``shared`` and ``dice`` of every line, whole text or
    run that reaches the threshold against a template.

    ``known`` has ``license``, ``variant`` and ``text``. Lines end at a line feed; pieces also
    after a sentence mark with blanks behind it, and at U+0001. Pieces without words do not
    count; a run is one or more neighbouring ones of the same text with at most one word more
    than the largest set that a template admits. Of overlapping runs the best one for the
    template stays, see ``_winners``; a run that is just one line is listed as the line only.
    Lines and whole texts have no pieces. Null and empty texts, lines and templates without words
    match nothing. A whole text is compared only if it has several lines. All templates that
    reach the threshold are listed or, with ``best``, for each line and whole text the one with
    the highest coefficient, ties to the smaller license and variant, and the runs that no better
    run of another template overlaps. Rows that repeat are matched each. Other columns are not
    looked at.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is above 0 and at most 1")
    known = known.select("license", "variant", bigrams(words(F.col("text"))).alias("template"))
    known = known.where(F.size("template") > 0)
    least, most = _admitted(F.size("template"), threshold)
    admitted = known.withColumn("size", F.explode(F.sequence(least.cast("int"), most.cast("int"))))
    rows, widest = admitted.agg(F.count(F.lit(1)), F.max("size") + 1).first()
    if rows <= MOST_BROADCAST_ROWS:
        admitted = F.broadcast(admitted)

    units = _units(docs, id_col, text_col, widest or 1, needles(known, threshold))
    own = units.select("*", F.size("words").alias("n_words"), bigrams(F.col("words")).alias("own"))
    together = F.size("own") + F.size("template")
    matches = (
        own.drop("words")
        .withColumn("size", F.size("own"))
        .join(admitted, "size")
        .withColumn("shared", F.size(F.array_intersect("own", "template")))
        .where(2 * F.col("shared") >= threshold * together)
        .withColumn("minus", -2 * F.col("shared") / together)
        .drop("size", "own", "template")
    )
    matches = _winners(matches, ["row", "license", "variant"])
    if best:
        matches = _winners(matches, ["row"])
    return matches.where(~F.col("is_line")).select(
        "id", "line", "last_line", F.col("first").alias("first_piece"),
        F.col("last").alias("last_piece"), "license", "variant", "shared",
        (-F.col("minus")).alias("dice"),
    )

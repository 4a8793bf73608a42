"""Licence matches against a plain Python Dice coefficient, and on odd rows."""

from __future__ import annotations

import re
import textwrap
from collections import Counter

from pyspark.sql import types as T

from uptake.llm.licenses import TEMPLATES, license_matches, templates

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("license", T.StringType()), T.StructField("line", T.StringType())]
)


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [x for x in re.split(r"[\x00-/:-`{-\x7f]+", lower) if x]


def bigrams(w):
    return set(w) if len(w) == 1 else {f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}


def units(text, widest):
    """(line, last line, first piece, last piece, words) of all that is compared."""
    lines = text.split("\n")
    if len(lines) > 1:
        yield 0, 0, None, None, words(text)
    for i, line in enumerate(lines, 1):
        yield i, i, None, None, words(line)
    cut = [(i, words(p)) for i, line in enumerate(lines, 1)
           for p in re.split("\x01", re.sub(r"([.!?;:])[ \t]+", "\\1\x01", line))]
    pieces = [(i, w) for i, w in cut if w]
    for first in range(len(pieces)):
        run = []
        for last in range(first, len(pieces)):
            run = run + pieces[last][1]
            if len(run) > widest:
                break
            yield pieces[first][0], pieces[last][0], first + 1, last + 1, run


def overlap(a, b):
    if a["first"] is None or b["first"] is None:
        return a["first"] == b["first"] and a["line"] == b["line"]
    return a["first"] <= b["last"] and b["first"] <= a["last"]


def brute(rows, known, threshold=0.8, best=False):
    known = [(n, v, bigrams(words(t))) for n, own in known.items() for v, t in enumerate(own)]
    known = [k for k in known if k[2]]
    widest = max((int(len(b) * (2 - threshold) / threshold + 1e-9) for *_, b in known), default=0) + 1
    out = []
    for i, text, *_ in rows:
        found = []
        for line, last_line, first, last, w in units(text, widest) if text is not None else ():
            a = bigrams(w)
            for name, variant, b in known:
                shared = len(a & b)
                if a and 2 * shared >= threshold * (len(a) + len(b)):
                    dice = 2 * shared / (len(a) + len(b))
                    own_line = words(text.split("\n")[line - 1])
                    found.append({
                        "line": line, "last_line": last_line, "first": first, "last": last,
                        "of": (name, variant), "shared": shared, "dice": dice,
                        "rank": (-dice, len(w), first or 0, last or 0, name, variant),
                        "hidden": first is not None and line == last_line and own_line == w,
                    })
        for same in (True, False)[: 2 if best else 1]:
            found = [m for m in found if not any(
                overlap(m, o) and o["rank"] < m["rank"] and (not same or o["of"] == m["of"])
                for o in found)]
        out += [(i, m["line"], m["last_line"], m["first"], m["last"], *m["of"], m["shared"], m["dice"])
                for m in found if not m["hidden"]]
    return sorted(out, key=str)


MIT = TEMPLATES["MIT"][2]
GPL = {v: TEMPLATES[v][1] for v in ("GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0")}
PROSE = "The river ran low that summer and nobody spoke of it again.\n"


def wrapped(text, width, mark=""):
    return mark + f"\n{mark}".join(textwrap.wrap(text, width))


def test_against_brute_force(spark):
    rows = [
        (1, "x\nReleased under the MIT License.\ny", "", ""), (2, None, None, None), (3, "", "", ""),
        (4, "\n\n", "", ""), (5, MIT.replace(", ", ",\n"), "", ""), (6, MIT.upper() + " Really.", "", ""),
        (None, "licensed UNDER cc by-nc 4.0", "", ""), (7, "Released under the BSD License", "", ""),
        (8, "word " * 200_000 + "\n" + "Licensed under the Apache License, Version 2.0.", "", ""),
        (9, "isc", "", ""), (9, "isc", "", ""), (10, "É licence", "", ""),
        (11, PROSE * 30 + wrapped(MIT, 40, "# ") + "\n\n" + PROSE * 30, "", ""),
        (12, "He said so. Licensed under CC BY 4.0. And left; released under the MIT License! Why?", "", ""),
        (13, (wrapped(GPL["GPL-2.0"], 30) + "\n") * 2 + wrapped(GPL["LGPL-3.0"], 60, " * "), "", ""),
        (14, MIT.replace(" ", "\n"), "", ""), (15, "a. b: isc; c\n. . .\u0001isc", "", ""),
    ]
    known = TEMPLATES | {"odd": ["ISC", "...", "é licence"]}
    docs = spark.createDataFrame(rows, SCHEMA)
    for best in (False, True):
        got = license_matches(docs, templates(spark, known), best=best)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, known, best=best)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_wrapped_notices_inside_longer_texts(spark):
    """Each header is found once, whole, under its own name, whatever surrounds it."""
    rows = [
        (name, PROSE * before + wrapped(text, width, mark) + "\n" + PROSE * 70, "", "")
        for name, text in GPL.items() for before in (0, 3, 70) for width in (35, 80)
        for mark in ("", " * ", "// ")
    ]
    docs = spark.createDataFrame(rows, SCHEMA.simpleString().replace("doc_id:bigint", "doc_id:string"))
    got = license_matches(docs, templates(spark), best=True).where("line > 0").collect()
    assert sorted((r["id"], r["license"], r["dice"]) for r in got) == sorted(
        (name, name, 1.0) for name, *_ in rows
    )
    assert all(r["last_line"] > r["line"] for r in got)


def test_notices_side_by_side(spark):
    """Neighbours in one line, and copies without a blank line between them."""
    text = "Licensed under CC BY 4.0. Released under the MIT License. Nothing else. "
    rows = [(1, text * 3, "", ""), (2, (wrapped(MIT, 50) + "\n") * 40, "", "")]
    got = license_matches(spark.createDataFrame(rows, SCHEMA), templates(spark), best=True).collect()
    found = Counter((r["id"], r["license"]) for r in got if r["line"])
    assert found == {(1, "CC-BY-4.0"): 3, (1, "MIT"): 3, (2, "MIT"): 40}


def test_many_templates_need_no_anchors(spark):
    known = {f"L{i}": [f"terms of licence number {i} apply"] for i in range(300)}
    docs = spark.createDataFrame([(1, "Terms of licence number 7 apply.", "", "")], SCHEMA)
    got = license_matches(docs, templates(spark, known), best=True).collect()
    assert [(r["license"], r["dice"]) for r in got] == [("L7", 1.0)]


def test_best_match_only(spark):
    rows = [(i, "This work is licensed under the GNU General Public License, version 3.", "", "")
            for i in (1, 1, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert license_matches(docs, templates(spark)).count() > 3
    got = license_matches(docs, templates(spark), best=True).collect()
    assert [(r["license"], r["dice"]) for r in got] == [("GPL-3.0", 1.0)] * 3


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert license_matches(empty, templates(spark)).count() == 0
    some = spark.createDataFrame([(1, "MIT", "", "")], SCHEMA)
    assert license_matches(some, templates(spark).limit(0)).count() == 0

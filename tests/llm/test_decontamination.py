"""Leaks against a plain Python version, and re-parameterised, inconsistent and odd cases."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from uptake.llm.decontamination import UNITS, leaks

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("item_id", T.StringType()), T.StructField("row", T.StringType())]
)
ITEMS = T.StructType(
    [T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("window", T.StringType())]
)
QUESTION = (
    "On Monday the farmer Anna Miller sells 12 apples and 3.5 kg of pears to the baker, who "
    "then gives 12 apples to his old friend Tom Jones. How many apples has Anna Miller left?"
)


SINGLE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
TOKEN = re.compile(f"%|[{SINGLE}]|(?:[A-Za-z0-9]|(?=[\x80-\U0010ffff])[^{SINGLE}]|(?<=[0-9])[.,](?=[0-9]))+")


def lower(c):
    low = c.lower()
    same = len(low) == 1 and len(low.encode()) == len(c.encode()) and c < "\u2000"
    return low if same else c


def tokens(text):
    """Plain, template and opening tokens with their values and whether they are single characters."""
    found, end = [], 0
    for m in TOKEN.finditer(text):
        stop = not found or re.search(r"[.!?:\n\r]", text[end : m.start()])
        found.append(("".join(map(lower, m[0])), m[0][0], bool(stop), bool(re.match(f"[{SINGLE}]", m[0]))))
        end = m.end()
    streams = [[[w, None, single] for w, *_, single in found]]
    for opening in (False, True):
        own = []
        for i, (word, head, stop, single) in enumerate(found):
            if i and found[i - 1][1] in "0123456789" and word in UNITS:
                own.append(["<unit>", word, False])
            elif head in "0123456789":
                own.append(["<number>", word, False])
            elif lower(head) != head and (opening or not stop):
                if own and own[-1][0] == "<name>":
                    own[-1][1] += " " + word
                else:
                    own.append(["<name>", word, False])
            else:
                own.append([word, None, single])
        streams.append(own)
    return streams


def windows(own, width, kind):
    for a in range(len(own) - width + 1):
        part = own[a : a + width]
        slots = [v for _, v, _ in part if v is not None]
        narrow = width < 3 or width < 8 and any(single for *_, single in part)
        if narrow and len(own) != width:
            continue
        if not kind or width - len(slots) >= (5 if width > 8 else (width + 1) // 2):
            yield a, tuple(t for t, *_ in part), slots


def longest(numbers):
    best = 0
    for n in numbers:
        length = 0
        while n + length in numbers:
            length += 1
        best = max(best, length)
    return best


def brute(docs, items, coverage=0.5):
    out = []
    split = [(doc_id, tokens(text or ""), {}) for doc_id, text, *_ in docs]
    for item_id, item, *_ in items:
        streams = tokens(item or "")
        wanted = []
        for kind, own in enumerate(streams):
            if not own or kind == 1 and not any(v for _, v, _ in own) or kind == 2 and own == streams[1]:
                continue
            width = min(8, len(own))
            mine = list(windows(own, width, kind))
            if kind and len(own) > 8 and 2 * len(mine) < len(own) - 7:
                width = min(16, len(own))
                mine = list(windows(own, width, kind))
            first = {}
            for a, w, s in mine:
                first.setdefault(w, (a, s))
            wanted.append((kind, width, {w: (n, a, s) for n, (w, (a, s)) in enumerate(first.items(), 1)}))
        for doc_id, theirs, cut in split:
            best = None
            for kind, width, mine in wanted:
                aligned = defaultdict(list)
                if (kind, width) not in cut:
                    cut[kind, width] = defaultdict(list)
                    for b, window, slots in windows(theirs[kind], width, kind):
                        cut[kind, width][window].append((b, slots))
                for window, (n, a, own) in mine.items():
                    for b, slots in cut[kind, width].get(window, ()):
                        aligned[b - a].append((n, list(zip(own, slots, strict=True))))
                hit, run = set(), 0
                for found in aligned.values():
                    readings = defaultdict(Counter)
                    for _, pairs in found:
                        for x, y in pairs:
                            readings[x][y] += 1
                    ties = [c for c in readings.values() if list(c.values()).count(max(c.values())) > 1]
                    assert not ties, "the larger hash decides, which is not done here"
                    read = {x: c.most_common(1)[0][0] for x, c in readings.items()}
                    places = {n for n, pairs in found if all(read[x] == y for x, y in pairs)}
                    hit |= places
                    run = max(run, longest(places))
                if mine and (len(hit) >= coverage * len(mine) or run + width - 1 >= 20):
                    best = max(best or (0,), (len(hit) / len(mine), kind == 0, len(hit), len(mine), run))
            if best:
                out.append((doc_id, item_id, best[3], best[2], best[0], best[1], best[4]))
    return sorted(out, key=str)


def run(spark, docs, items):
    found = leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    return sorted((tuple(r) for r in found.drop("row").collect()), key=str)


def test_parameters_may_change_but_only_consistently(spark):
    changed = QUESTION.replace("12", "47").replace("Anna Miller", "Eva").replace("Tom", "Jo")
    docs = [(1, f"x y {QUESTION} z", "", ""), (2, f"So it is\n{changed.replace('3.5 kg', '9 miles')}", "", ""),
            (4, QUESTION.upper(), "", ""), (5, "Nothing of that kind at all here.", "", "")]
    items = [(7, QUESTION, "")]
    got = run(spark, docs, items)
    assert got == brute(docs, items)
    assert {r[0]: r[5] for r in got} == {1: True, 2: False, 4: True}


CHINESE = "从前有一位老农夫住在河边的小村子里，他每天早上都去田里种菜。"
FORTY = " ".join(f"word{c}" for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMN")
DENSE = "add 2 and 3 to 4 then 5 and 6 to 7 gives 27 or 28"
RUSSIAN = "вчера утром старый мастер Иван продал сорок яблок своей соседке Марии за малую цену"
NAMED = "Bob has 3 pears. Bob eats 2 pears."


@pytest.mark.parametrize(
    "item, leaking, clean",
    [
        (CHINESE, f"参见：{CHINESE}完", "从前有一位老农夫去城里卖菜。"),
        ("天气很好", "天气很好", "今天天气很好，我们走吧"),
        (FORTY, "so " + " ".join(FORTY.split()[7:27]) + " and", " ".join(FORTY.split()[7:26])),
        (NAMED, "Ann has 7 pears. Ann eats 5 pears.", "Ann likes 7 figs. Joe eats 5 nuts."),
        (DENSE, "add 9 and 8 to 1 then 7 and 5 to 6 gives 36 or 37", "9 8 1 7 5 6 36 37 40 41 42 43 44 45"),
        (RUSSIAN, RUSSIAN.replace("Иван", "Пётр").replace("Марии", "Анне"), "старый мастер продал сорок яблок"),
        ("two words", "Two words!", "there are two words here"),
    ],
)
def test_what_is_copied_is_found(spark, item, leaking, clean):
    docs = [(1, leaking, "", ""), (2, clean, "", "")]
    got = run(spark, docs, [(7, item, "")])
    assert got == brute(docs, [(7, item)]) and [r[0] for r in got] == [1]


def test_odd_rows_equal_brute_force(spark):
    docs = [
        (None, QUESTION, "a", "b"), (1, None, None, None), (2, "", "", ""), (3, "one two three", "", ""),
        (3, "one two three", "", ""), (4, "word " * 300_000 + QUESTION, "", ""), (5, "a b", "", ""),
        (6, "Été à Ünter den 5 % of ÉTÉ", "", ""), (7, "one two THREE four, one two three!", "", ""),
        (8, "Ǆ ẞ İ ſ Ωmega Ъ Ầ ầ 𠀀𠀁 ไทย 5% 😀", "", ""), (None, "ไทย", "", ""),
    ]
    items = [(1, QUESTION, ""), (1, QUESTION, ""), (2, None, ""), (3, "", ""), (4, "a b", ""),
             (5, "One two three", ""), (None, "été à ünter den 7 %", ""), (8, "word " * 20, ""), (9, "ไทย", ""),
             (10, "ǆ ß i̇ s ωmega ъ ầ Ầ 𠀀𠀁 ไทย 6% 😀", "")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, []) == [] and run(spark, [], items) == []


@pytest.mark.parametrize("cut", [1, 0.8])
def test_given_documents_equal_brute_force(spark, sf_dir, cut):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    items = [(i, t[: int(len(t) * cut)]) for i, t in items]
    got = run(spark, [(*d, "", "") for d in docs], [(*i, "") for i in items])
    assert got == brute(docs, items) and len(got) > 2


def test_values_may_become_equal_and_conflicts_cost_their_windows(spark):
    item = (
        "on a farm the old man picks 12 apples and the young man then picks 7 pears from the tall tree "
        "by the river, while the dog that sleeps under the old cart in the yard eats 12 small bones"
    )
    equal = item.replace("12", "5").replace("7", "5")
    mixed = item.replace("12 apples", "31 apples").replace("7", "8")
    docs = [(1, equal, "", ""), (2, mixed, "", ""), (3, "a farm and a river", "", "")]
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(7, item, "")], ITEMS)
    got = {r["id"]: (r["coverage"], r["exact"]) for r in leaks(*frames).collect()}
    assert set(got) == {1, 2} and got[1] == (1.0, False)
    assert not got[2][1] and 0.5 < got[2][0] < 1

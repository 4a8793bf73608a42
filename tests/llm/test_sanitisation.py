"""Base patterns against the plain definition, disclosing words against brute force, odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from uptake.llm.queries import op10_pii
from uptake.llm.sanitisation import (
    ALPHA, CHANCE, KINDS, base_spans, disclosing_terms, entity, find_spans, generalised, sanitise,
)

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("terms", T.StringType()), T.StructField("key", T.StringType())]
)


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def plain(text):
    """The definition, word for word."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    }
    return [(k, *m.span()) for k in KINDS for m in re.finditer(rules[k][0], text) if rules[k][1](m[0])]


def test_patterns_equal_their_definition():
    rng = random.Random(1)
    for alphabet in ("ab.@-_1", "0129. ", "+012 ()-.", "4 -0", "é1@.a+ \n%"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            assert base_spans(text) == plain(text), text
    known = "a@b.co_x@y.zz 1.2.3.4.5.6.7.8 or 4539 1488 0343 6467 +1 (773) 555-3123 x@y 256.1.1.1"
    assert base_spans(known) == plain(known) and len(base_spans(known)) == 6
    for long in ("a" * 300_000 + "@", "1" * 300_000, "a.b-" * 80_000 + " x@y.z", "+" * 300_000, "1." * 200_000):
        assert len(base_spans(long)) <= len(long) // 8 + 1


def words(text):
    return [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[A-Za-z\x80-\U0010ffff]+", text)]


def brute_terms(texts, alpha=ALPHA):
    """(text, word) of the words that disclose an entity of the text."""
    together, entities, rows, seen = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(set)
    holders = defaultdict(set)
    for text in texts:
        spans = base_spans(text)
        own = {entity(kind, text[a:b]) for kind, a, b in spans}
        free = {w for x, y, w in words(text) if not any(x < b and y > a for _, a, b in spans)}
        for t in {w for *_, w in words(text)}:
            rows[t] += 1
        for e in own:
            entities[e] += 1
            holders[e].add(text)
            for t in free:
                together[e, t] += 1
                seen[e, t].add(text)
    found, different = set(), len(set(texts))
    limit = math.log(CHANCE / max(1, len(rows) * len(entities)))
    for (e, t), n in together.items():
        x, p = len(seen[e, t]), len(holders[e]) / different
        rare = x * (math.log(p) + math.log(rows[t] / x) + 1) <= limit
        if rare and n / rows[t] >= (entities[e] / len(texts)) ** (1 - 1 / alpha):
            found |= {(text, t) for text in seen[e, t]}
    return found


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{chr(97 + i)}é" for i in range(20)]
    texts = []
    for i in range(200):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 40))]
        if i % 4 == 0:
            own.insert(rng.randrange(len(own)), "gardener bob@example.com Orchid")
        if i % 50 == 0:
            own.append("orchid alone")
        if i % 7 == 0:
            own.append("rare +1 (773) 555-3123 zebra")
        texts.append(" ".join(own))
    return [f"{t} once{chr(97 + i % 26)}{chr(97 + i // 26)}" for i, t in enumerate(texts)] + texts[:9]


@pytest.mark.parametrize("alpha", [1.0, 1.2, 4.0])
def test_disclosing_words_equal_brute_force(spark, alpha):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], SCHEMA)
    terms = brute_terms(texts, alpha)
    found = {t for _, t in terms}
    assert {"gardener", "rare", "zebra"} <= found and "once" not in found
    assert ("orchid" in found) == (alpha > 1)
    assert disclosing_terms(docs, alpha=alpha).count() == len(terms)
    for r in find_spans(docs, disclosing_terms(docs, alpha=alpha)).collect():
        text, spans = texts[r["id"]], base_spans(texts[r["id"]])
        assert [(s["kind"], s["start"], s["end"]) for s in r["base"]] == spans
        want = [(a, b) for a, b, w in words(text)
                if (text, w) in terms and not any(a < y and b > x for _, x, y in spans)]
        assert [(s["start"], s["end"]) for s in r["terms"]] == want


def test_planted_names_are_found_and_nothing_else(spark):
    """Names that stand in a few texts, always with one value; every text has words of its own."""
    rng = random.Random(9)
    common = [f"c{chr(97 + i)}" for i in range(26)]
    texts, planted = [], set()
    for i in range(1500):
        own = [f"u{''.join(rng.choice('abcdefgh') for _ in range(9))}" for _ in range(10)]
        texts.append(" ".join([*own, *rng.choices(common, k=20)]))
    for n in range(12):
        name = "name" + "abcdefghijkl"[n] * 4
        for i in rng.sample(range(1500), 5):
            texts[i] += f" {name} p{n}@example.com"
            planted.add((i, name))
    docs = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], SCHEMA)
    found = set()
    for r in find_spans(docs, disclosing_terms(docs)).collect():
        found |= {(r["id"], texts[r["id"]][s["start"] : s["end"]]) for s in r["terms"]}
    assert found == planted


def test_alpha_and_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert disclosing_terms(docs).count() == 0
    with pytest.raises(ValueError):
        disclosing_terms(docs, alpha=0.5)


def test_generalised_texts(spark):
    assert generalised("call +1 (773) 555-3123 or a@b.co!", base_spans("call +1 (773) 555-3123 or a@b.co!")) == (
        "call [phone] or [email]!"
    )
    assert generalised("abcdef", [("x", 1, 4), ("y", 2, 5), ("z", 5, 6)]) == "a[x][z]"
    texts = corpus()
    rows = [(i, t, "keep", None) for i, t in enumerate(texts)] + [(None, None, "n", None), (1, "", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    clean = sanitise(docs, disclosing_terms(docs))
    assert clean.columns == docs.columns and clean.count() == len(rows)
    got = {r["doc_id"]: r["text"] for r in clean.collect() if r["terms"] == "keep"}
    assert not any(base_spans(t) or "gardener" in t and "[" in t for t in got.values())
    assert sum("[email]" in t for t in got.values()) == sum("@" in t for t in texts)
    assert all(got[i] == t for i, t in enumerate(texts) if not base_spans(t))
    assert clean.where("text IS NULL").count() == 1


def test_odd_rows(spark):
    rows = [(None, None, "", ""), (1, "", "", ""), (1, "", "", ""), (2, "é +49 (30) 123456 é", "", ""),
            (3, "x" * 400_000 + " a@b.cd", "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = find_spans(docs, disclosing_terms(docs)).collect()
    assert len(found) == 5 and sorted(len(r["base"]) for r in found) == [0, 0, 0, 1, 1]
    assert find_spans(docs.limit(0), disclosing_terms(docs.limit(0))).count() == 0


def test_query_equals_the_definition(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op10_pii(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in spans) for k in KINDS]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert r["spans"].startswith(joined)

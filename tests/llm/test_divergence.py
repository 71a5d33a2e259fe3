from collections import Counter, defaultdict
import random
import re

import pytest

from stockweave.llm import divergence


def brute_force(rows, top):
    """All rows of the audit of (lang, source, text), densely and in plain integers."""
    docs = [tuple(x or "" for x in r) for r in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, found, whole = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(lower))
        counts[lang, source].update(terms)
        whole[lang].update(terms)
        found[lang].update(set(terms))
    out = set()
    for lang, source in counts:
        kept = [t for t, n in found[lang].items() if n >= 3]

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        p = shares(counts[lang, source])
        pairs = []
        for other_lang, other in counts:
            if other_lang == lang and other != source:
                q = shares(counts[lang, other])
                pairs.append((other, sum((p[t] - q[t]) ** 2 // q[t] for t in kept)))
        q = shares(whole[lang])
        terms = [
            (t, (p[t] - q[t]) ** 2 // q[t])
            for t in kept
            if counts[lang, source][t] and p[t] > q[t]
        ]
        for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            for k, (item, value) in enumerate(items[:limit], 1):
                out.add((lang, source, part, item, value, k))
    return out


def rows_of(df):
    return {tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_a_dense_count(spark, seed):
    rng = random.Random(seed)
    words = ["Apfel", "naïve", "a", "ZZ", "über", "x1y", "don't", "日本", "e", "\x00b"]
    rows = []
    for _ in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 12)))
        rows.append((rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "é", None]), text))
    rows += [("fr", "only", None), ("xx", "a", "one two"), ("xx", "b", "!?"), *rows[:5]]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert rows_of(divergence.audit(docs, top=3)) == brute_force(rows, 3)


def test_audit_ignores_other_columns_and_takes_an_empty_table(spark):
    rows = [("en", "s", "aa bb", 1, "x"), ("en", "t", "aa", 2, "y"), ("en", "t", "aa", 3, None)]
    schema = "lang string, source string, text string, n long, term string"
    docs = spark.createDataFrame(rows, schema)
    assert rows_of(divergence.audit(docs)) == brute_force([r[:3] for r in rows], 200)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_terms_are_runs_of_letters():
    text = "A-b C3ß  x".encode()
    assert divergence.term_counts(text) == {
        b"a": 1, b"b": 1, b"c": 1, "ß".encode(): 1, " x".encode(): 1,
    }


def test_a_very_long_text_is_counted_whole(spark):
    long = "word other " * 300_000
    docs = spark.createDataFrame(
        [("en", "a", long), ("en", "b", "word"), ("en", "b", "word")],
        "lang string, source string, text string",
    )
    assert rows_of(divergence.audit(docs)) == brute_force(
        [("en", "a", long), ("en", "b", "word"), ("en", "b", "word")], 200
    )

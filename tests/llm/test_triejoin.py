import random
import re

import numpy as np
import pytest

from stockweave.llm import triejoin


def gram_sets(texts):
    out = []
    for text in texts:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        windows = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
        out.append(windows or ({tuple(words)} if words else set()))
    return out


def brute_force(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = gram_sets([t for _, t in rows])
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    least = {}
    for (doc_id, _), x in zip(rows, label, strict=True):
        if doc_id is not None:
            least[x] = min(least.get(x, doc_id), doc_id)
    return sorted(
        ((i, len(s), least.get(x)) for (i, _), s, x in zip(rows, sets, label, strict=True)),
        key=str,
    )


def result(df):
    rows = df.select("doc_id", "n_shingles", "component_id").collect()
    return sorted((tuple(r) for r in rows), key=str)


def corpus(seed, families=6, copies=9, words=70):
    """Families of near copies, around the threshold, with a passage that all families share."""
    rng = random.Random(seed)
    passage = " ".join(f"p{k}" for k in range(25))
    rows, at = [], 0
    for f in range(families):
        base = [f"f{f}w{rng.randrange(10_000)}" for _ in range(words)]
        for _ in range(copies):
            mine = list(base)
            for _ in range(rng.randrange(0, 4)):
                mine[rng.randrange(len(mine))] = f"new{rng.randrange(10**9)}"
            text = " ".join(mine)
            rows.append((at, text + ("  " + passage.upper() if rng.random() < 0.5 else "")))
            at += 1
    rng.shuffle(rows)
    return rows


EDGES = [
    (900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "One  two"), (905, "one two three"),
    (906, "a b c d e"), (907, "a b c d e"), (None, "a b c d e"), (None, "zz yy"), (906, "other text"),
    (906, "a b c d e"),
]


@pytest.mark.parametrize("limits", [(1 << 20, 2048), (150, 3)])
def test_components_equal_those_of_all_pairs(spark, limits):
    rows = corpus(5) + EDGES
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = triejoin.link_components(docs, block_grams=limits[0], block_sets=limits[1])
    assert result(found) == brute_force(rows)


def test_a_chain_across_blocks_is_one_component(spark):
    """Each text drops a word in front and gains one at the end: only neighbours link."""
    words = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(words[k * 3 : k * 3 + 60])) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = triejoin.link_components(docs, block_grams=200, block_sets=3)
    assert result(found) == brute_force(rows)


def test_extra_columns_and_an_empty_table(spark):
    rows = [(1, "a b c d e f", "x", 5), (2, "a b c d e f", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, n long")
    assert result(triejoin.link_components(docs)) == [(1, 2, 1), (2, 2, 1)]
    assert triejoin.link_components(docs.limit(0)).count() == 0


def test_a_very_long_text_and_its_near_copy(spark):
    words = [f"w{k % 70_000}x{k // 9}" for k in range(200_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:190_000])), (3, " ".join(words[:100_000]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r[2] for r in result(triejoin.link_components(docs))] == [1, 1, 3]


@pytest.mark.parametrize("seed", range(20))
def test_trie_finds_all_similar_sets(seed):
    rng = np.random.default_rng(seed)
    pool = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    sets = []
    for _ in range(25):
        base = sets[rng.integers(len(sets))] if sets and rng.random() < 0.7 else pool[:30]
        keep = base[rng.random(len(base)) < 0.95]
        more = rng.choice(pool, rng.integers(0, 4))
        made = np.unique(np.concatenate([keep, more]))
        sets.append(made if len(made) else pool[:1])
    trie = triejoin.Trie(sets)
    for q in range(len(sets)):
        wanted = np.ones(len(sets), dtype=bool)
        wanted[q] = False
        mine = set(sets[trie.order[q]].tolist())
        expected = []
        for i in range(len(sets)):
            other = set(sets[trie.order[i]].tolist())
            if i != q and 5 * len(mine & other) >= 4 * len(mine | other):
                expected.append(i)
        assert trie.walk(q, wanted).tolist() == expected

import hashlib
import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from stockweave.llm import neardup, substrings, topk
from stockweave.llm.components import components
from stockweave.llm.suffixsort import suffix_ranks, window_classes


def test_suffix_ranks_match_sorting():
    rng = np.random.default_rng(1)
    for trial in range(300):
        text = rng.integers(0, rng.integers(1, 5), rng.integers(0, 60))
        if trial % 3 == 0:
            text = np.repeat(text, rng.integers(1, 6, len(text)))  # long runs
        last = int(rng.integers(0, 5))
        text = np.append(np.where(text >= last, text + 1, text), last)
        want = np.empty(len(text), dtype=int)
        want[sorted(range(len(text)), key=lambda i: text[i:].tolist())] = np.arange(len(text))
        # a tiny bound sends the queues to disk
        assert (suffix_ranks(text, queue_bytes=64 if trial % 2 else 1 << 20) == want).all()


def test_naming_ends_with_each_substring(monkeypatch):
    """One long pair of equal substrings must not have all short ones compared again."""
    once = np.concatenate([np.tile([1, 2], 5000), np.arange(1, 1500)])
    text = np.concatenate([once, once, [0]])
    sorted_, argsort = [], np.argsort

    def counting(a, *args, **more):
        sorted_.append(len(a))
        return argsort(a, *args, **more)

    monkeypatch.setattr(np, "argsort", counting)
    ranks = suffix_ranks(text)
    assert sum(sorted_) < 40 * len(text)
    monkeypatch.undo()
    order = np.argsort(ranks)
    follows = np.append(ranks, -1)[order + 1]
    a, b = text[order[:-1]], text[order[1:]]
    assert ((a < b) | ((a == b) & (follows[:-1] < follows[1:]))).all()


def test_only_contents_that_may_share_a_window_are_sorted(docs_of, monkeypatch):
    rnd = random.Random(5)
    phrase = "".join(rnd.choices("abcdefgh ", k=45))  # shared, but shorter than a window
    passage = "".join(rnd.choices("abcdefgh ", k=150))

    def other():
        return "".join(rnd.choices("abcdefgh ", k=130))

    rows = [(k, other() + phrase + other()) for k in range(60)]
    rows += [(100 + k, other() + passage + other()) for k in range(2)]
    made, sort = [], substrings.window_classes

    def counting(raw, borders, length):
        made.append(bytes(raw))
        return sort(raw, borders, length)

    monkeypatch.setattr(substrings, "window_classes", counting)
    seen = substrings._sorted_shard(100)
    text = [t.encode() for _, t in rows[:60]]
    n = np.array([len(t) - 99 for t in text])
    zero = np.zeros(len(text), dtype=np.int64)
    columns = {"key": zero, "a": n, "b": n, "doc": zero, "tag": zero, "start": zero, "n": n}
    columns |= {"inner": np.zeros(len(text), dtype=bool), "bytes": pa.array(text, pa.binary())}
    runs = [b for b in seen(iter([pa.RecordBatch.from_pydict(columns)])) if b.num_rows]
    assert sum(b.num_rows for b in runs) == 60 and not made
    monkeypatch.undo()
    got = substrings.remove_repeats(docs_of(rows)).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == plain_removal(rows, 100)


def test_window_classes_match_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(60):
        some = [
            bytes(rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 50)).astype(np.uint8))
            for _ in range(rng.integers(1, 8))
        ]
        length = int(rng.integers(1, 14))
        borders = np.cumsum([0, *map(len, some)])
        want: dict = {}
        for k, s in enumerate(some):
            for o in range(len(s) - length + 1):
                want.setdefault(s[o : o + length], []).append(borders[k] + o)
        position, number = window_classes(np.frombuffer(b"".join(some), np.uint8), borders, length)
        got: dict = {}
        for p, c in zip(position.tolist(), number.tolist(), strict=True):
            got.setdefault(c, []).append(p)
        assert sorted(map(sorted, got.values())) == sorted(v for v in want.values() if len(v) > 1)


def plain_removal(rows, length):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_removal_matches_brute_force(docs_of):
    rnd = random.Random(4)
    passages = ["".join(rnd.choices("abcé ", k=rnd.randint(20, 90))) for _ in range(6)]
    rows = [(None, passages[0]), (0, None), (1, ""), (2, "x" * 300), (3, "ab" * 150), (4, "short")]
    rows += [(5, "abc" * 60 + "d" + "abc" * 60), (6, "x" * 31)]
    for k in range(10, 60):
        parts = [
            rnd.choice(passages) if rnd.random() < 0.5 else "".join(rnd.choices("abcé ", k=25))
            for _ in range(rnd.randint(0, 8))
        ]
        rows.append((k, "".join(parts)))
    got = substrings.remove_repeats(docs_of(rows), length=30, gram=8, shard_bytes=2000).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == plain_removal(rows, 30)


def test_removal_edges(docs_of):
    long = "".join(random.Random(1).choices("abcdefgh ", k=400))
    rows = docs_of([(1, long), (1, long), (2, "some " + long)])
    got = substrings.remove_repeats(rows, with_text=True).collect()
    assert sorted((r["doc_id"], bytes(r["kept"])) for r in got) == [
        (1, long.encode()),
        (1, long.encode()),
        (2, b"some "),
    ]
    assert substrings.remove_repeats(docs_of([])).count() == 0
    with pytest.raises(ValueError, match="8 bytes or more"):
        substrings.remove_repeats(docs_of([]), gram=4)


def test_shards_stay_small_where_many_documents_share_a_passage(docs_of, monkeypatch):
    rnd = random.Random(11)
    passage = "".join(rnd.choices("abcdefgh ", k=300))
    rows = []
    for k in range(3000):
        before, after = ("".join(rnd.choices("abcdefgh ", k=rnd.randint(90, 120))) for _ in "ab")
        rows.append((k, before + passage[: rnd.choice([300, 300, 250])] + after))
    made = substrings._sorted_shard

    def bounded(length):
        sort = made(length)

        def run(batches):
            batches = list(batches)
            held = sum(len(x) for b in batches for x in b.column("bytes").to_pylist())
            if held > 80_000:
                raise MemoryError(f"a shard of {held} bytes")
            return sort(iter(batches))

        return run

    monkeypatch.setattr(substrings, "_sorted_shard", bounded)
    got = substrings.remove_repeats(docs_of(rows), shard_bytes=20_000).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == plain_removal(rows, 100)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (200, 201)]
    edges = spark.createDataFrame(chain, "u long, v long")
    got = {r["node"]: r["label"] for r in components(edges).collect()}
    want = {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90, 200: 200, 201: 200}
    assert got == want
    assert components(edges.filter("u < 0")).count() == 0


def classes_of(rows, threshold):
    """Connected components of exact weighted similarities, by all pairs."""
    column = pa.array([t or "" for _, t in rows])
    owner, windows, counts = neardup.features(column)
    sketch = np.zeros((neardup.SKETCH_ROWS, 1 << neardup.SKETCH_BITS), dtype=np.int64)
    for row, at in zip(sketch, neardup._counters(windows), strict=True):
        np.add.at(row, at, 1)
    idf = neardup.damped_idf(sketch, len(rows))
    cuts = np.searchsorted(owner, np.arange(len(rows) + 1))
    sets = [(windows[a:b], counts[a:b]) for a, b in itertools.pairwise(cuts)]
    label = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if len(sets[i][0]) and len(sets[j][0]):
            if neardup.similarity(sets[i], sets[j], idf) >= threshold:
                label = [label[i] if x == label[j] else x for x in label]
    out: dict = {}
    for (doc, _), x in zip(rows, label, strict=True):
        out.setdefault(x, []).append(doc)
    return sorted(map(sorted, out.values()))


def test_near_duplicates_match_all_pairs(docs_of):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(12):
        base = rnd.choices(words, k=120)
        for copy in range(rnd.randint(1, 12)):
            text = list(base)
            for _ in range(rnd.randint(0, 3)):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            rows.append((len(rows), " ".join(text)))
    rows += [(900, "Four words Only here"), (901, "four words only HERE"), (902, "other four words here")]
    got = neardup.near_duplicates(docs_of(rows)).collect()
    found: dict = {}
    for r in got:
        found.setdefault(r["class_id"], []).append(r["doc_id"])
        assert r["kept"] == (r["doc_id"] == r["class_id"])
    assert sorted(map(sorted, found.values())) == classes_of(rows, neardup.THRESHOLD)
    assert all(r["class_size"] == len(found[r["class_id"]]) for r in got)


def test_groups_match_pairwise_similarities():
    rng = np.random.default_rng(6)
    idf = neardup.damped_idf(rng.integers(0, 50, (2, 1 << neardup.SKETCH_BITS)), 100)
    for _ in range(20):
        base = rng.choice(1 << 32, 60, replace=False).astype(np.uint64)
        sets = []
        for _ in range(rng.integers(2, 14)):
            some = np.unique(np.where(rng.random(60) < 0.08, rng.integers(0, 1 << 32, 60), base).astype(np.uint64))
            sets.append((some, rng.integers(1, 3, len(some)) if rng.random() < 0.3 else np.ones(len(some), int)))
        n = len(sets)
        apart = ~np.eye(n, dtype=bool)
        want = np.arange(n)
        for i, j in itertools.combinations(range(n), 2):
            if neardup.similarity(sets[i], sets[j], idf) >= 0.8:
                want[want == max(want[i], want[j])] = min(want[i], want[j])
        assert (neardup.linked_groups(sets, apart, idf, 0.8) == want).all()


def test_samples_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(3)
    shared, a, b = (rng.integers(0, 1 << 32, n, dtype=np.uint64) for n in (600, 200, 200))
    windows = np.concatenate([np.sort(np.concatenate([shared, a])), np.sort(np.concatenate([shared, b]))])
    owner = np.repeat([0, 1], 800)
    weight = np.ones(1600, dtype=np.float32)
    hashes = neardup.band_hashes(owner, windows, weight, 36, 1)
    assert abs((hashes[0] == hashes[1]).mean() - 0.6) < 0.25


def test_texts_that_share_a_doc_id_are_documents_of_their_own(docs_of):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (1, b), (2, c), (3, b), (1, a)]
    got = neardup.near_duplicates(docs_of(rows)).collect()
    assert sorted((r["doc_id"], r["class_id"], r["class_size"]) for r in got) == [
        (1, 1, 2), (1, 1, 2), (1, 1, 2), (2, 2, 1), (3, 1, 2),
    ]
    kept = neardup.representatives(docs_of(rows))
    assert sorted((r["doc_id"], r["text"][0]) for r in kept.collect()) == [
        (1, "a"), (1, "b"), (2, "c"),
    ]


def test_short_texts_have_windows_of_their_own():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 3000, (300_000, 5))
    words = np.unique(words, axis=0)
    column = pa.array([" ".join(map(str, row)) for row in words.tolist()])
    found = neardup.features(column)
    assert len(np.unique(found[1])) == len(words)
    assert len(set(neardup._content_hashes(column, neardup.WORDS, found))) == len(words)


def test_representatives_edges(docs_of):
    rows = docs_of([(1, None), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, "z")])
    got = neardup.near_duplicates(rows).collect()
    assert len(got) == 6
    assert sorted(r["class_id"] for r in got if r["class_id"]) == [1, 2, 3, 3, 3]
    kept = neardup.representatives(rows)
    assert kept.columns == rows.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [
        (0, "z"),
        (1, ""),
        (2, ""),
        (3, "a b c d e f"),
    ]
    assert neardup.near_duplicates(docs_of([])).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(-2, 3, (300, 10)) / 8
    table = vectors(spark, [(i, v.tolist(), "other") for i, v in enumerate(x)])
    whole = topk.whole_vectors(table)
    got = topk.top_k(whole, whole.filter("vec_id % 7 = 0"), 5, query_block=10, candidate_block=70)
    found = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in got.collect()}
    q = np.floor(64 * x).astype(int)
    want = {}
    for i in range(0, 300, 7):
        scores = q @ q[i]
        best = sorted((j for j in range(300) if j != i), key=lambda j: (-scores[j], j))[:5]
        want |= {(i, n + 1): (j, scores[j]) for n, j in enumerate(best)}
    assert found == want


def test_bounds_hold():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((50, 37)) * 40
    for mean, rest in topk._resolutions(x):
        above = mean @ mean.T + rest @ rest.T
        assert (above >= x @ x.T - 1e-6).all()


def plain_top_k(rows, k=20):
    """(query_id, rank, vec_id, score) with every row of `rows` (vec_id, vector) as a query."""
    out = []
    for i, (query, q) in enumerate(rows):
        found = []
        for j, (name, x) in enumerate(rows):
            if i != j and len(q) == len(x):
                score = sum(math.floor(64 * a) * math.floor(64 * b) for a, b in zip(q, x))
                found.append((-max(-(2**63), min(2**63 - 1, score)), name is None, name or 0))
        found.sort()
        out += [(query, n, None if none else name, -score)
                for n, (score, none, name) in enumerate(found[:k], 1)]
    return sorted(out, key=str)


def test_top_k_edges(spark):
    good = [
        (0, [1.0, 2.0]),
        (0, [1.0, 2.0]),
        (1, [1.0, 2.0]),
        (2, [5.0, 0.5]),
        (2, [4.0, 0.25]),
        (None, [1.0, 2.5]),
        (7, [3.0, 1.0, 1.0]),
        (8, [-0.5, 0.01]),
        (9, [2.0**41, 0.0]),
        (10, [0.0, 2.0**41]),
        (11, [-(2.0**100), 1.0]),
        ((1 << 63) - 1, [0.125, 0.125]),
    ]
    bad = [
        (12, None), (13, [1.0, None]), (14, [float("nan"), 1.0]), (15, [float("inf"), 1.0]), (16, []),
    ]
    whole = topk.whole_vectors(vectors(spark, [(i, v, "x") for i, v in good + bad]))
    for k, size in ((20, 16384), (3, 2)):
        got = topk.top_k(whole, whole, k, query_block=size, candidate_block=size)
        assert sorted(map(tuple, got.collect()), key=str) == plain_top_k(good, k)
    none = whole.filter("vec_id < 0")
    assert topk.top_k(none, none).count() == 0

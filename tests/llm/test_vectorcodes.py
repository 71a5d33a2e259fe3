import hashlib
import math

import numpy as np
import pytest

from stockweave.llm import vectorcodes


def brute_force(rows, rounds, entries):
    """(vec_id, code, error, label_error, sha) of (vec_id, vector, label) by full scans."""
    kept = [
        r for r in rows
        if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    dim = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dim]
    vectors = [[int(math.floor(x)) * 1024 if abs(x) > 2**60 else math.floor(1024 * x) for x in r[1]]
               for r in kept]
    cuts = [dim * k // 4 for k in range(5)]
    parts = [[v[cuts[p] : cuts[p + 1]] for v in vectors] for p in range(4)]
    books = [[list(x) for x in parts[p][:entries]] for p in range(4)]

    def nearest(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(4):
            codes = [nearest(x, books[p])[0] for x in parts[p]]
            for e in range(len(books[p])):
                mine = [x for x, c in zip(parts[p], codes, strict=True) if c == e]
                if mine:
                    books[p][e] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    found = [[nearest(parts[p][i], books[p]) for p in range(4)] for i in range(len(kept))]
    errors = [sum(d for _, d in f) for f in found]
    sums = {}
    for r, e in zip(kept, errors, strict=True):
        sums[r[2]] = sums.get(r[2], 0) + e
    sha = hashlib.sha256(
        ",".join(str(x) for b in books for e in b for x in e).encode()
    ).hexdigest()

    def long(x):
        return x if x < 2**63 else None

    return [
        (r[0], "".join(f"{c:02x}" for c, _ in f), long(e), long(sums[r[2]]), sha)
        for r, f, e in zip(kept, found, errors, strict=True)
    ]


SCHEMA = "vec_id long, embedding array<double>, label int"


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dim))
    x = centers[rng.integers(6, size=n)] + 0.1 * rng.normal(size=(n, dim))
    return [(int(i) * 3, [float(v) for v in x[i]], int(i) % 4) for i in rng.permutation(n)]


@pytest.mark.parametrize("entries,rounds", [(40, 4), (64, 6), (256, 2)])
def test_codes_equal_full_scans(spark, entries, rounds):
    rows = vectors(200, 12, entries)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = result(vectorcodes.code_table(df, rounds, entries))
    assert got == sorted(brute_force(rows, rounds, entries), key=str)


def test_odd_rows(spark):
    rows = vectors(30, 8, 3)
    rows += [
        (1, None, 1), (2, [1.0, None] * 4, 1), (4, [float("nan")] * 8, 1), (5, [float("inf")] * 8, 2),
        (7, [0.5] * 8, None), (7, [0.25] * 8, None), (7, [0.25] * 8, None), (None, [0.1] * 8, None),
        (8, [1.0, 2.0], 1), (9, [], 1), (1000, [2.0**41] * 8, 9), (1001, [1e25] + [0.0] * 7, 9),
        (1002, [-(2.0**41)] * 8, 9),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = result(vectorcodes.code_table(df, 3, 16))
    assert got == sorted(brute_force(rows, 3, 16), key=str)


def test_a_large_value_in_the_codebook(spark):
    rows = [(0, [2.0**50, 1.0, 1.0, -3e30], 1), *((k, [k / 7.0] * 4, 1) for k in range(1, 20))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(vectorcodes.code_table(df, 2, 4)) == sorted(brute_force(rows, 2, 4), key=str)


def test_no_rows_and_empty_vectors(spark):
    empty = spark.createDataFrame([(1, None, 1)], SCHEMA)
    assert vectorcodes.code_table(empty).count() == 0
    assert vectorcodes.code_table(empty.limit(0)).count() == 0
    none = spark.createDataFrame([(1, [], 1), (2, [], 2)], SCHEMA)
    assert [r[1:4] for r in result(vectorcodes.code_table(none))] == [("00000000", 0, 0)] * 2


def test_bounds_skip_most_distances_and_change_nothing():
    rng = np.random.default_rng(0)
    centers = rng.normal(size=(256, 8)) * 4000
    x = np.floor(np.repeat(centers, 20, axis=0) + rng.normal(size=(5120, 8)) * 60)
    book = np.floor(centers + rng.normal(size=centers.shape) * 30)
    history, state, computed = [], (None, None, None), []
    for _ in range(5):
        history.append(vectorcodes.Codebook([[int(v) for v in e] for e in book]))
        code, far, low, stamp, n = vectorcodes.assign(x, history, *state)
        full = ((x[:, None, :] - history[-1].values[None]) ** 2).sum(axis=2)
        assert (code == full.argmin(axis=1)).all() and (far == full.min(axis=1)).all()
        state = code, low, stamp
        computed.append(n)
        sums = np.zeros_like(book)
        np.add.at(sums, code, x)
        count = np.bincount(code, minlength=256)[:, None]
        book = np.where(count > 0, np.floor(sums / np.maximum(count, 1)), book)
    assert computed[-1] < computed[0] / 4


def test_net_displacement_is_no_longer_than_the_way():
    books = [vectorcodes.Codebook([[0, 0], [10, 10]])]
    books += [vectorcodes.Codebook([[k, 0], [10, 10]]) for k in (5, 1)]
    first, who, second = vectorcodes.displacements(books[2], books[0])
    assert first[0] == 1.0 and who[0] == 0 and second[0] == 0.0

"""Vector codes by product quantization in whole numbers, with bounds that skip rescans.

A vector becomes whole numbers floor(scale * x) and is cut into `PARTS` equal consecutive parts.
Each part position has a codebook, at first that part of the `ENTRIES` rows with the smallest
vec_ids. A round assigns every part to its nearest entry (squared distance, ties to the lower
index) and replaces each used entry by the floor of its parts' mean. After `rounds` rounds the
parts are assigned once more.

Which entries are looked at again is decided by bounds (Newling and Fleuret 2016). Entries are
kept in groups. For each part and group a row stores a lower bound of its distance to the group's
entries other than its own, and the round in which the bound was true. All earlier codebooks
are retained, so at a later round the bound is lowered by the greatest *net* displacement of the
group's entries since its stamp, |c_now - c_then|, which is at most the sum of their moves in
between. A group whose bound stays above the distance to the nearest entry known so far is
skipped; other groups are scanned exactly. Bounds are rounded towards a rescan, distances
are whole numbers, so results equal those of a full scan.

The state of a round (vectors, codes, bounds) is written to shared scratch space for the next
one, and removed when that is written. Per task, a round shuffles one row for each number
of the codebooks; the codebooks alone, of fixed size, come to the driver.

Rows with a null vector or a null or non-finite component are dropped. Vectors whose length
differs from that of the first row by vec_id can't be compared with its parts and are dropped too.
Repeated vec_ids are rows of their own, in the order of their vectors; null vec_ids come last.
With fewer rows than `ENTRIES` the codebooks have as many entries as there are rows; empty
vectors all get code 0 and no error. Components beyond the range of exact floating point
arithmetic are handled with Python integers; an error too large for a long is null. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.durable import remove, scratch_path

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
GROUP = 32  # entries that share a bound

_EXACT = 1 << 22  # components below it have exact products and sums in floating point
_LIMB = 1 << 40  # sums travel in digits of this base
_SLACK = 1e-6  # of a bound, against rounding


@dataclass
class Codebook:
    """The entries of one part position (entries x components), of whole numbers."""

    exact: list[list[int]]

    def __post_init__(self) -> None:
        self.small = all(abs(x) < _EXACT for entry in self.exact for x in entry)
        width = len(self.exact[0]) if self.exact else 0
        rows = self.exact if self.small else []
        self.values = np.array(rows, dtype=np.float64).reshape(len(rows), width)
        self.squares = np.einsum("ij,ij->i", self.values, self.values)


def whole_numbers(x: float, scale: int = SCALE) -> int:
    """floor(scale * x), exact for any finite x; `scale` is a power of two."""
    return math.floor(x) * scale if abs(x) >= 2.0**53 else math.floor(scale * x)


def _cuts(dim: int) -> list[int]:
    return [dim * k // PARTS for k in range(PARTS + 1)]


def displacements(now: Codebook, then: Codebook) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per group: the greatest net displacement, whose it is, and the greatest of the others."""
    moved = np.sqrt(((now.values - then.values) ** 2).sum(axis=1))
    first, who, second = [], [], []
    for at in range(0, len(moved), GROUP):
        some = moved[at : at + GROUP]
        top = int(some.argmax())
        first.append(some[top])
        who.append(at + top)
        second.append(np.delete(some, top).max(initial=0.0))
    return np.array(first), np.array(who), np.array(second)


def assign(
    x: np.ndarray,
    history: list[Codebook],
    code: np.ndarray | None,
    low: np.ndarray | None,
    stamp: np.ndarray | None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(code, squared distance, low, stamp, distances computed) of one part of many rows.

    `history` has the codebooks of all rounds, the present one last; `code`, `low` and
    `stamp` are what the last call returned, None at first.
    """
    now, t = history[-1], len(history) - 1
    n, entries = len(x), len(now.values)
    groups = -(-entries // GROUP)
    rows = np.arange(n)
    if code is None:
        code = np.zeros(n, dtype=np.int64)
        low = np.full((n, groups), -np.inf)
        stamp = np.zeros((n, groups), dtype=np.int8)
        moved = []
    else:
        code, low, stamp = code.astype(np.int64), low.astype(np.float64), stamp.copy()
        moved = [displacements(now, then) for then in history]
    mine = x - now.values[code]
    own = np.einsum("ij,ij->i", mine, mine)
    best, chosen = own.copy(), code.copy()
    x_squares = np.einsum("ij,ij->i", x, x)
    scanned: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    computed = n
    bounds = np.full((n, groups), -np.inf)
    for g in range(groups):
        if moved:
            first, who, second = (np.array([m[k][g] for m in moved]) for k in range(3))
            s = stamp[:, g]
            net = np.where(who[s] == code, second[s], first[s])
            bounds[:, g] = low[:, g] * (1 - _SLACK) - net * (1 + _SLACK) - _SLACK
        need = np.flatnonzero(~(bounds[:, g] > np.sqrt(best) * (1 + _SLACK)))
        members = now.values[g * GROUP : (g + 1) * GROUP]
        if not len(need):
            scanned.append((need, need, need, need))
            continue
        far = (
            x_squares[need, None] - 2 * (x[need] @ members.T)
            + now.squares[g * GROUP : (g + 1) * GROUP]
        )
        computed += far.size
        at = far.argmin(axis=1)
        least = far[np.arange(len(need)), at]
        far[np.arange(len(need)), at] = np.inf
        scanned.append((need, at + g * GROUP, least, far.min(axis=1)))
        better = (least < best[need]) | ((least == best[need]) & (at + g * GROUP < chosen[need]))
        best[need[better]] = least[better]
        chosen[need[better]] = at[better] + g * GROUP
    for g, (need, at, least, next_least) in enumerate(scanned):
        if len(need):
            low[need, g] = np.sqrt(np.where(chosen[need] == at, next_least, least))
            stamp[need, g] = t
    # an entry that was left counts among the others of its group from now on
    left = chosen != code
    for g in np.unique(code[left] // GROUP).tolist():
        some = left & (code // GROUP == g)
        some[scanned[g][0]] = False
        low[some, g] = np.minimum(np.maximum(bounds[some, g], 0), np.sqrt(own[some]))
        stamp[some, g] = t
    return chosen, best.astype(np.int64), low, stamp, computed


def _assign_large(x: list[list[int]], book: Codebook) -> tuple[list[int], list[int]]:
    """(codes, squared distances) by a full scan in Python integers."""
    codes, errors = [], []
    for row in x:
        far = [sum((a - b) ** 2 for a, b in zip(row, entry, strict=True)) for entry in book.exact]
        errors.append(min(far))
        codes.append(far.index(errors[-1]))
    return codes, errors


def _numbers(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows x dim) components, and which rows are within exact range as whole numbers."""
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    raw = flat.reshape(batch.num_rows, dim)
    small = (np.abs(raw) * SCALE < _EXACT - 1).all(axis=1)
    return raw, small


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


_STATE = "codes array<short>, low array<float>, stamp array<tinyint>, error long"


def _round(rows: DataFrame, history: list[list[Codebook]], dim: int) -> DataFrame:
    """The rows with codes, bounds and stamps of the round of the last codebooks."""
    cuts = _cuts(dim)
    entries = len(history[-1][0].exact)
    groups = -(-entries // GROUP)
    first = "codes" not in rows.columns
    names = ["vec_id", "label", "x", "codes", "low", "stamp", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            raw, small = _numbers(batch, dim)
            before = None
            if not first:
                before = (
                    _matrix(batch.column("codes"), PARTS),
                    _matrix(batch.column("low"), PARTS * groups).reshape(n, PARTS, groups),
                    _matrix(batch.column("stamp"), PARTS * groups).reshape(n, PARTS, groups),
                )
            codes = np.zeros((n, PARTS), dtype=np.int16)
            low = np.full((n, PARTS, groups), -np.inf)
            stamp = np.full((n, PARTS, groups), len(history) - 1, dtype=np.int8)
            error = [0] * n
            for p in range(PARTS):
                books = [books[p] for books in history]
                fast = np.flatnonzero(small) if books[-1].small else np.zeros(0, dtype=np.int64)
                slow = np.setdiff1d(np.arange(n), fast)
                if len(fast):
                    x = np.floor(raw[fast, cuts[p] : cuts[p + 1]] * SCALE)
                    # bounds of a round whose codebook was out of range are of no use
                    old = before if before and all(b.small for b in books) else None
                    args = (a[fast, p] for a in old) if old else (None, None, None)
                    made = assign(x, books if old else books[-1:], *args)
                    codes[fast, p], far, low[fast, p] = made[0], made[1], made[2]
                    stamp[fast, p] = made[3] if old else len(history) - 1
                    for i, e in zip(fast.tolist(), far.tolist(), strict=True):
                        error[i] += e
                if len(slow):
                    x = [
                        [whole_numbers(v) for v in row]
                        for row in raw[slow, cuts[p] : cuts[p + 1]].tolist()
                    ]
                    codes[slow, p], far = _assign_large(x, books[-1])
                    for i, e in zip(slow.tolist(), far, strict=True):
                        error[i] += e
            # a bound may only be rounded down
            floats = np.nextafter(low.astype(np.float32), np.float32(-np.inf))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), batch.column("label"), batch.column("x"),
                    _lists(codes, pa.int16()),
                    _lists(floats.reshape(n, -1), pa.float32()),
                    _lists(stamp.reshape(n, -1), pa.int8()),
                    pa.array([e if e < 1 << 63 else None for e in error], pa.int64()),
                ],
                names,
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    kept = ", ".join(f"{c} {kinds[c]}" for c in ("vec_id", "label", "x"))
    return rows.mapInArrow(run, f"{kept}, {_STATE}")


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))


def _means(state: DataFrame, books: list[Codebook], dim: int) -> list[Codebook]:
    """The next codebooks: floors of the means of the parts of each entry."""
    cuts = _cuts(dim)
    entries = len(books[0].exact)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((entries, dim), dtype=np.int64)
        count = np.zeros((entries, PARTS), dtype=np.int64)
        large: dict[tuple[int, int], int] = {}
        seen = False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            raw, small = _numbers(batch, dim)
            codes = _matrix(batch.column("codes"), PARTS).astype(np.int64)
            x = np.floor(raw[small] * SCALE)
            for p in range(PARTS):
                count[:, p] += np.bincount(codes[:, p], minlength=entries)
                for k in range(cuts[p], cuts[p + 1]):
                    sums = np.bincount(codes[small, p], weights=x[:, k], minlength=entries)
                    total[:, k] += sums.astype(np.int64)
            for i in np.flatnonzero(~small).tolist():
                for p in range(PARTS):
                    for k in range(cuts[p], cuts[p + 1]):
                        at = int(codes[i, p]), k
                        large[at] = large.get(at, 0) + whole_numbers(float(raw[i, k]))
        if not seen:
            return
        out: list[tuple[int, int, int, int]] = []
        for e in range(entries):
            for p in range(PARTS):
                out.append((e, -1 - p, 0, int(count[e, p])))
            for k in range(dim):
                rest = int(total[e, k]) + large.get((e, k), 0)
                sign, rest, limb = (-1 if rest < 0 else 1), abs(rest), 0
                while rest or not limb:
                    out.append((e, k, limb, sign * (rest % _LIMB)))
                    rest, limb = rest // _LIMB, limb + 1
        columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["entry", "place", "limb", "total"])

    sums = state.select("x", "codes").mapInArrow(
        add, "entry long, place long, limb long, total long"
    )
    found: dict[tuple[int, int], int] = {}
    for r in sums.groupBy("entry", "place", "limb").agg(F.sum("total").alias("total")).collect():
        at = r["entry"], r["place"]  # one sum per number of the codebooks
        found[at] = found.get(at, 0) + r["total"] * _LIMB ** r["limb"]
    made = []
    for p, book in enumerate(books):
        made.append(
            Codebook(
                [
                    [found[e, k] // found[e, -1 - p] for k in range(cuts[p], cuts[p + 1])]
                    if found.get((e, -1 - p))
                    else entry
                    for e, entry in enumerate(book.exact)
                ]
            )
        )
    return made


def usable(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(vec_id, label, x) of the rows that take part."""
    x = vectors[vector]

    def finite(c):
        c = c.cast("double")
        return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))

    return vectors.filter(x.isNotNull() & F.forall(x, finite)).select(
        vectors[vec_id].cast("long").alias("vec_id"), vectors[label].alias("label"), x.alias("x")
    )


def books_digest(books: list[Codebook]) -> str:
    """Sha256 of all entries' numbers, by part, entry and place, joined by commas."""
    text = ",".join(str(x) for book in books for entry in book.exact for x in entry)
    return hashlib.sha256(text.encode()).hexdigest()


def encode(
    vectors: DataFrame,
    rounds: int = ROUNDS,
    entries: int = ENTRIES,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, list[Codebook]]:
    """(vec_id, label, x, codes array<short>, error long) of the kept rows, and the codebooks."""
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, vector, label)
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    if not start:
        codes = rows.select(
            "*", F.array().cast("array<short>").alias("codes"), F.lit(None).cast("long").alias("error")
        )
        return codes.limit(0), []
    dim = len(start[0]["x"])
    rows = rows.filter(F.size("x") == dim)
    if any(len(r["x"]) != dim for r in start):
        start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    cuts = _cuts(dim)
    history = [
        [
            Codebook([[whole_numbers(v) for v in r["x"][cuts[p] : cuts[p + 1]]] for r in start])
            for p in range(PARTS)
        ]
    ]
    before = None
    for t in range(rounds + 1):
        path = scratch_path(spark, "codes")
        made = _round(rows, history, dim)
        made.write.option("compression", "zstd").parquet(path)
        rows = spark.read.schema(made.schema).parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
        if t < rounds:
            history.append(_means(rows, history[-1], dim))
    return rows.select("vec_id", "label", "x", "codes", "error"), history[-1]


def code_table(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of the kept rows."""
    rows, books = encode(vectors, rounds, entries)
    sums = rows.groupBy("label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error")
    )
    sums = sums.select(
        F.col("label").alias("of"), F.expr("try_cast(label_error AS BIGINT)").alias("label_error")
    )
    code = F.concat_ws(
        "", F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0"))
    )
    return rows.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id",
        code.alias("code"),
        "error",
        "label_error",
        F.lit(books_digest(books)).alias("codebooks_sha256"),
    )


def sql(rounds: int = ROUNDS, entries: int = ENTRIES) -> str:
    """The same in SQL, every round a full scan."""
    steps = [
        f"""
numbered AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS nr, vec_id, label, embedding
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), x AS (
  SELECT nr, unnest([CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding]) AS x,
         generate_subscripts(embedding, 1) - 1 AS pos, len(embedding) AS dim
  FROM numbered
), parts AS (
  SELECT nr, pos // (dim // {PARTS}) AS part, pos, x FROM x
), book0 AS (
  SELECT part, nr - 1 AS entry, pos, x AS c FROM parts WHERE nr <= {entries}
)"""
    ]
    for t in range(rounds + 1):
        steps.append(
            f"""
assigned{t} AS (
  SELECT nr, part, entry, far FROM (
    SELECT nr, p.part, entry, sum((x - c) * (x - c)) AS far,
           row_number() OVER (PARTITION BY nr, p.part ORDER BY sum((x - c) * (x - c)), entry) AS place
    FROM parts p JOIN book{t} b ON b.part = p.part AND b.pos = p.pos
    GROUP BY nr, p.part, entry
  ) WHERE place = 1
)"""
        )
        if t < rounds:
            steps.append(
                f"""
means{t} AS (
  SELECT a.part, entry, pos, sum(x) AS s, count(*) AS n
  FROM assigned{t} a JOIN parts p ON p.nr = a.nr AND p.part = a.part
  GROUP BY a.part, entry, pos
), book{t + 1} AS (
  SELECT part, entry, pos,
         CAST(CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS c
  FROM book{t} LEFT JOIN means{t} USING (part, entry, pos)
)"""
            )
    steps.append(
        f"""
errors AS (
  SELECT nr, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
         CAST(sum(far) AS BIGINT) AS error
  FROM assigned{rounds} GROUP BY nr
), digest AS (
  SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256
  FROM book{rounds}
)"""
    )
    return (
        "WITH " + ",".join(s.lstrip("\n") for s in steps) + """
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM errors JOIN numbered USING (nr), digest
"""
    )

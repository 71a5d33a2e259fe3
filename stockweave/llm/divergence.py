"""How the sources of a language differ in their terms, by exact whole-number divergences.

A term is a run of letters: A-Z (lowered), a-z and everything beyond ASCII. One
`bytes.translate` over the UTF-8 bytes of many texts lowers and blanks what separates,
`bytes.split` cuts, and a Counter per document gives its frequencies; a task adds them up by
(lang, source, term) with the number of documents, and only these sums are shuffled.

A language keeps the V terms found in at least `min_documents` of its rows. With count c of a
kept term in a group (lang, source) or in the whole language, and N the sum of these counts,
p = 1 + floor(10^9 (c + 1) / (N + V)). A group is held against another by f = floor((p - q)^2 / q):

- part `pair`: every other source of the language, f summed over all kept terms;
- part `term`: kept terms that the group has and uses more than its language does, by f against
  the language, the best `top` only.

Most counts of a group are zero, so a pair's sum is taken apart: the sum as if the second had
none of the terms, the sum as if the first had none (both from how often each count occurs),
and a correction for the terms that both have. Nothing as large as terms x sources is formed.

Null text, lang and source are ''. Every row is a document of its own, whether or not its doc_id
repeats. Groups without terms have their pairs (value 0 where the language keeps no term).
Values are descending, ties go by the item's UTF-8 bytes. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.llm.common import slices, utf8

MIN_DOCUMENTS = 3
TOP = 200
SCALE_STEPS, SCALE_STEP = 3, 1000  # 10^9, in steps that keep long division within 64 bits

KEPT_SUMS = 400_000  # (group, term) sums a task holds before it passes them on
_PAIRS = 1 << 20  # pairs of counts of one term handled at once
_DOCUMENT = 1 << 40  # one document, in a sum of occurrences and documents

_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def term_counts(raw: bytes) -> Counter[bytes]:
    """Occurrences of each term in the UTF-8 bytes of one document."""
    return Counter(raw.translate(_TABLE).split())


def _sums(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """(lang, source, term, n, documents): sums of one task; term '' says that a group exists."""

    def rows(held: dict[tuple[str, str], dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), sums in held.items():
            packed = np.fromiter(sums.values(), dtype=np.int64, count=len(sums))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(sums), pa.string()),
                    pa.array([source] * len(sums), pa.string()),
                    pa.array(list(sums), pa.binary()).cast(pa.string()),
                    pa.array(packed % _DOCUMENT),
                    pa.array(packed // _DOCUMENT),
                ],
                ["lang", "source", "term", "n", "documents"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, int]] = {}
        size = 0
        for part in slices(batches):
            data, borders = utf8(part.column("text"))
            data, borders = data.tobytes(), borders.tolist()
            groups = zip(
                part.column("lang").to_pylist(), part.column("source").to_pylist(), strict=True
            )
            for i, group in enumerate(groups):
                sums = held.setdefault(group, {b"": 0})
                before = len(sums)
                for term, n in term_counts(data[borders[i] : borders[i + 1]]).items():
                    sums[term] = sums.get(term, 0) + n + _DOCUMENT
                size += len(sums) - before
            if size > KEPT_SUMS:
                yield from rows(held)
                held, size = {}, 0
        yield from rows(held)

    narrow = docs.select(
        *(
            F.coalesce(docs[c].cast("string"), F.lit("")).alias(name)
            for c, name in ((lang, "lang"), (source, "source"), (text, "text"))
        )
    )
    return narrow.mapInArrow(
        count, "lang string, source string, term string, n long, documents long"
    )


def scaled_share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 (count + 1) / total), exact for totals below 9 * 10^15."""
    rest, share = count + F.lit(1), F.lit(0).cast("long")
    for _ in range(SCALE_STEPS):
        raised = rest * F.lit(SCALE_STEP)
        share = share * F.lit(SCALE_STEP) + F.call_function("div", raised, total)
        rest = raised % total
    return share + F.lit(1)


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _corrections(shares: DataFrame) -> DataFrame:
    """(lang, a, b, value): what the terms that both sources have add to a pair's sum.

    `shares` (lang, term, no, p, p0) has all sources of a term next to each other.
    """

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // q

    def emit(lang: str, sums: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
        a, b, value = sums
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(a), pa.string()), pa.array(a), pa.array(b), pa.array(value)],
            ["lang", "a", "b", "value"],
        )

    def add(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b, value = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((b, a))
        a, b, value = a[order], b[order], value[order]
        at = np.flatnonzero(
            np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        )
        return a[at], b[at], np.add.reduceat(value, at)

    def pair_sums(term: np.ndarray, no: np.ndarray, p: np.ndarray, p0: np.ndarray):
        """Sums over whole terms, `_PAIRS` pairs at a time; `term` numbers them, ascending."""
        start = np.searchsorted(term, term, "left")
        size = np.searchsorted(term, term, "right") - start
        done = np.concatenate([[0], np.cumsum(size)])
        at = 0
        while at < len(term):
            end = max(at + 1, int(np.searchsorted(done, done[at] + _PAIRS, "right")) - 1)
            many = size[at:end]
            i = np.repeat(np.arange(at, end), many)
            j = np.arange(len(i)) - np.repeat(done[at:end] - done[at], many) + start[i]
            i, j = i[i != j], j[i != j]
            if len(i):
                value = f(p[i], p[j]) - f(p[i], p0[j]) - f(p0[i], p[j]) + f(p0[i], p0[j])
                yield add([(no[i], no[j], value)])
            at = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        rest: pa.Table | None = None

        def take(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            names = rows.column("lang").combine_chunks().dictionary_encode()
            code = names.indices.to_numpy()
            terms = rows.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
            no, p, p0 = (rows.column(c).to_numpy() for c in ("no", "p", "p0"))
            for k, lang in enumerate(names.dictionary.to_pylist()):
                mine = np.flatnonzero(code == k)  # of one language, terms next to each other
                step = np.concatenate([[0], np.cumsum(np.diff(terms[mine]) != 0)])
                for sums in pair_sums(step, no[mine], p[mine], p0[mine]):
                    parts = held.setdefault(lang, [])
                    parts.append(sums)
                    if sum(len(part[0]) for part in parts) > 2 * _PAIRS:
                        held[lang] = [add(parts)]
                        if len(held[lang][0][0]) > _PAIRS:
                            yield emit(lang, held.pop(lang)[0])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if rest is not None:
                rows = pa.concat_tables([rest, rows])
            last = rows.slice(rows.num_rows - 1).to_pylist()[0]
            whole = rows.num_rows
            langs, terms = rows.column("lang"), rows.column("term")
            while whole and (langs[whole - 1].as_py(), terms[whole - 1].as_py()) == (
                last["lang"], last["term"],
            ):
                whole -= 1
            rest = rows.slice(whole)  # the last term may go on in the next batch
            if whole:
                yield from take(rows.slice(0, whole))
        if rest is not None:
            yield from take(rest)
        for lang, parts in held.items():
            yield emit(lang, add(parts))

    return shares.mapInArrow(run, "lang string, a int, b int, value long")


def audit(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    top: int = TOP,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """(lang, source, part, item, value, rank) of all groups of `docs`."""
    term = W.partitionBy("lang", "term")
    found = (
        _sums(docs, lang, source, text)
        .repartition("lang", "term")
        .withColumn("in_lang", F.sum("documents").over(term))
        .filter((F.col("in_lang") >= min_documents) | (F.col("term") == ""))
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"))
        .withColumn("lang_n", F.sum("n").over(term))
        .withColumn("is_first", F.row_number().over(term.orderBy("source")) == 1)
    )
    found = durable(found, "terms")
    kept = found.filter(F.col("term") != "")
    langs = kept.groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.count_if("is_first").alias("v")
    )
    totals = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count("*").alias("terms")
    )
    none = F.lit(0).cast("long")
    groups = (
        found.filter(F.col("term") == "")
        .select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .withColumns(
            {c: F.coalesce(c, none) for c in ("total", "terms", "lang_total", "v")}
        )
        .withColumn("no", F.row_number().over(W.partitionBy("lang").orderBy("source")))
        .withColumn("p0", F.when(F.col("v") > 0, scaled_share(none, F.col("total") + F.col("v"))))
    )
    groups = durable(groups, "groups")

    joined = kept.join(groups, ["lang", "source"]).withColumn(
        "p", scaled_share(F.col("n"), F.col("total") + F.col("v"))
    )
    against = joined.withColumn(
        "q", scaled_share(F.col("lang_n"), F.col("lang_total") + F.col("v"))
    )
    best = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = (
        against.filter((F.col("n") > 0) & (F.col("p") > F.col("q")))
        .select(
            "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
            _f(F.col("p"), F.col("q")).alias("value"),
        )
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
    )

    # how many terms of a group have a count, as shares; those it lacks count 0
    histogram = (
        joined.groupBy("lang", "no", "p")
        .agg(F.count("*").alias("times"))
        .unionByName(
            groups.filter(F.col("v") > 0).select(
                "lang", "no", F.col("p0").alias("p"), (F.col("v") - F.col("terms")).alias("times")
            )
        )
    )
    other = groups.select("lang", F.col("no").alias("other"), F.col("p0").alias("other_p0"))
    one_sided = (
        histogram.join(other, "lang")
        .filter(F.col("no") != F.col("other"))
        .groupBy("lang", "no", "other")
        .agg(
            F.sum(F.col("times") * _f(F.col("p"), F.col("other_p0"))).alias("as_first"),
            F.sum(F.col("times") * _f(F.col("other_p0"), F.col("p"))).alias("as_second"),
        )
    )
    side = one_sided.select(
        "lang", F.col("no").alias("a"), F.col("other").alias("b"), F.col("as_first").alias("value")
    ).unionByName(
        one_sided.select(
            "lang", F.col("other").alias("a"), F.col("no").alias("b"),
            F.col("as_second").alias("value"),
        )
    )
    shares = (
        joined.select("lang", "term", "no", "p", "p0")
        .repartition("lang", "term")
        .sortWithinPartitions("lang", "term")
    )
    sums = (
        side.unionByName(_corrections(shares)).groupBy("lang", "a", "b").agg(
            F.sum("value").alias("value")
        )
    )
    first = groups.select("lang", F.col("no").alias("a"), "source", "v", "p0")
    second = groups.select(
        "lang", F.col("no").alias("b"), F.col("source").alias("item"), F.col("p0").alias("q0")
    )
    value = F.col("value") - F.col("v") * _f(F.col("p0"), F.col("q0"))
    pairs = (
        first.join(second, "lang")
        .filter(F.col("a") != F.col("b"))
        .join(sums, ["lang", "a", "b"], "left")
        .select(
            "lang", "source", F.lit("pair").alias("part"), "item",
            F.coalesce(value, none).alias("value"),
        )
        .withColumn("rank", F.row_number().over(best))
    )
    return pairs.unionByName(terms)


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS nr, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), found AS (
  SELECT nr, lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM found
  GROUP BY lang, term HAVING count(DISTINCT nr) >= 3
), places AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM found GROUP BY lang, source, term
), filled AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, lang_n
  FROM places JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), shares AS (
  SELECT lang, source, term, n,
         1 + (CAST(1000000000 AS HUGEINT) * (n + 1))
           // (sum(n) OVER place + count(*) OVER place) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (lang_n + 1))
           // (sum(n) OVER language + count(*) OVER place) AS q
  FROM filled
  WINDOW place AS (PARTITION BY lang, source), language AS (PARTITION BY lang)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), results AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM places a JOIN places b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM results
) WHERE part = 'pair' OR rank <= 200
"""

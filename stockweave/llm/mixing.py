"""Mix sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. The tokens of the cells (words between
white space) are raked: scaled to the target share of every source, then of every language,
then of every topic, `rounds` times over. No document is repeated, so a cell gives no more than its
tokens: a cell that reaches them stays there while its group grows, and the other cells of the group
make up for it. A cell's rate is its raked weight over its tokens. Probabilities are share * rate,
at most 1, and calibrated: where targets can't be met the others are raised, so that the expected tokens stay
`share` of all; `reached` tells every group's target and what it gets. A document is kept
if the hash of its doc_id, between 0 and 1, lies below the probability of its cell.

Everything is DataFrame expressions. Rows meet their cell by a join on three keys, which Spark
broadcasts if the cells are few and splits if one cell is large.

Targets default to tempered shares, tokens ** `temper`, so that small groups gain. A target that
is given names groups and shares; groups it doesn't name get none. Nulls in source or language
are groups of their own; a null text has no tokens; cells without tokens have probability 0.
Rows repeating a doc_id fare alike, a null doc_id is hashed as empty. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockweave.durable import durable

KEYS = ("source", "lang", "topic")
SHARE = 0.5
TEMPER = 0.7
ROUNDS = 8
CALIBRATIONS = 4
NEARLY = 1 - 1e-9  # a cell at this part of its tokens has reached them
WORD = r"[^\x20\x09-\x0D]+"
DIGITS = 9

# The first condition that holds names the topic; text and n_tokens are what it may ask for.
TOPICS = (
    ("table", "5 * (length(text) - length(replace(text, '|', ''))) > n_tokens"),
    (
        "markup",
        "5 * (length(text) - length(replace(replace(replace(text, '#', ''), '$', ''), '%', '')))"
        " > n_tokens",
    ),
    ("shouting", "2 * (length(text) - length(replace(text, '!!', ''))) > n_tokens"),
    ("note", "n_tokens < 100"),
    ("article", "n_tokens < 1000"),
)
OTHER = "book"


def topic_case(topics: Sequence[tuple[str, str]] = TOPICS, other: str = OTHER) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in topics) + f" ELSE '{other}' END"


def celled(
    docs: DataFrame,
    topics: Sequence[tuple[str, str]] = TOPICS,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
) -> DataFrame:
    """(row, doc_id, source, lang, topic, n_tokens): the whole row and what the mix looks at."""
    return (
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
            docs[doc_id].alias("doc_id"),
            docs[source].cast("string").alias("source"),
            docs[lang].cast("string").alias("lang"),
            F.coalesce(docs[text], F.lit("")).alias("text"),
        )
        .withColumn("n_tokens", F.regexp_count("text", F.lit(WORD)).cast("long"))
        .withColumn("topic", F.expr(topic_case(topics)))
        .drop("text")
    )


def _targets(cells: DataFrame, key: str, given: Mapping[str, float] | None, temper: float):
    """`cells` with the target share of their group of `key` as column want_<key>."""
    name = f"want_{key}"
    if given is not None:
        whole = float(sum(given.values()))
        pairs = [F.lit(x) for k, v in given.items() for x in (k, v / whole)]
        share = F.coalesce(F.create_map(*pairs)[F.col(key)], F.lit(0.0))
        return cells.withColumn(name, share)
    groups = cells.groupBy(key).agg(F.pow(F.sum("tokens").cast("double"), temper).alias("power"))
    total = groups.agg(F.sum("power")).first()[0] or 1.0
    groups = groups.select(F.col(key).alias("group"), (F.col("power") / total).alias(name))
    return cells.join(groups, cells[key].eqNullSafe(groups["group"])).drop("group")


def raked_cells(
    documents: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    temper: float = TEMPER,
    rounds: int = ROUNDS,
    share: float | None = None,
) -> DataFrame:
    """(source, lang, topic, tokens, weight, want_<key>...) of all cells.

    Weights sum to 1. If `share` of all tokens is to be drawn, no cell's weight stands for more tokens
    than it has, and weights sum to less where the targets can't be met so.
    """
    cells = durable(
        documents.groupBy(*KEYS).agg(F.sum("n_tokens").alias("tokens")), "cells"
    )
    for key in KEYS:
        cells = _targets(cells, key, (targets or {}).get(key), temper)
    whole = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    part = F.col("tokens").cast("double") / F.lit(whole)
    most = F.lit(float("inf")) if share is None else part / F.lit(share)
    cells = durable(cells.withColumn("weight", part).withColumn("most", most), "targets")
    at_most = F.col("weight") >= F.col("most") * NEARLY
    for number in range(rounds):
        for key in KEYS:
            group, want = W.partitionBy(key), F.col(f"want_{key}")
            factor = (
                F.when(
                    (want > F.col("full") + F.col("free")) & (F.col("free") > 0),
                    (want - F.col("full")) / F.col("free"),
                )
                .when(F.col("full") + F.col("free") > 0, want / (F.col("full") + F.col("free")))
                .otherwise(0.0)
            )
            cells = (
                cells.withColumn("full", F.sum(F.when(at_most, F.col("weight")).otherwise(0.0)).over(group))
                .withColumn("free", F.sum(F.when(at_most, 0.0).otherwise(F.col("weight"))).over(group))
                .withColumn("weight", F.least("most", F.col("weight") * factor))
            )
        if number % 4 == 3:
            cells = durable(cells, "raked")  # keeps the plan short
    return cells.select(*KEYS, "tokens", "weight", *[f"want_{k}" for k in KEYS])


def reached(cells: DataFrame) -> DataFrame:
    """(key, name, wanted, expected): shares of the tokens drawn from `calibrated` cells, by group."""
    drawn = F.col("probability") * F.col("tokens")
    cells = durable(cells, "calibrated")
    total = cells.agg(F.sum(drawn)).first()[0] or 1.0
    parts = [
        cells.groupBy(F.lit(key).alias("key"), F.col(key).alias("name")).agg(
            F.first(f"want_{key}").alias("wanted"), (F.sum(drawn) / total).alias("expected")
        )
        for key in KEYS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def calibrated(cells: DataFrame, share: float = SHARE, calibrations: int = CALIBRATIONS) -> DataFrame:
    """`cells` with the probability of their documents."""
    cells = durable(cells, "weights")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    rate = F.when(F.col("tokens") > 0, F.col("weight") * float(total) / F.col("tokens")).otherwise(0.0)
    factor = share
    for _ in range(calibrations):
        expected = cells.agg(
            F.sum(F.least(F.lit(1.0), F.lit(factor) * rate) * F.col("tokens"))
        ).first()[0]
        if expected:
            factor = factor * (share * total) / expected
    return cells.withColumn(
        "probability", F.round(F.least(F.lit(1.0), F.lit(factor) * rate), DIGITS)
    )


def mix(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    share: float = SHARE,
    temper: float = TEMPER,
    rounds: int = ROUNDS,
    topics: Sequence[tuple[str, str]] = TOPICS,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
) -> DataFrame:
    """(row, doc_id, source, lang, topic, n_tokens, probability, kept) of every row of `docs`."""
    documents = celled(docs, topics, doc_id, text, source, lang)
    cells = calibrated(raked_cells(documents, targets, temper, rounds, share), share)
    cells = cells.select(*[F.col(k).alias(f"cell_{k}") for k in KEYS], "probability")
    same = [F.col(k).eqNullSafe(F.col(f"cell_{k}")) for k in KEYS]
    name = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    place = F.conv(F.substring(name, 1, 8), 16, 10).cast("double") / float(1 << 32)
    return (
        documents.join(cells, same[0] & same[1] & same[2])
        .select("row", "doc_id", *KEYS, "n_tokens", "probability")
        .withColumn("kept", place < F.col("probability"))
    )


def sample(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that the mix keeps, with all their columns."""
    return (
        mix(docs, **options)
        .filter("kept")
        .select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    )


def sql(documents: str = "documents") -> str:
    """The same with the default parameters, in DuckDB's SQL."""
    steps = [
        f"""counted AS (
  SELECT *, {topic_case()} AS topic FROM (
    SELECT doc_id, source, lang, coalesce(text, '') AS text,
           CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS n_tokens
    FROM {documents}))""",
        """cells AS (
  SELECT source, lang, topic, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM counted GROUP BY ALL)""",
    ]
    for key in KEYS:
        steps.append(
            f"""want_{key} AS (
  SELECT {key}, power / sum(power) OVER () AS share FROM (
    SELECT {key}, pow(CAST(sum(tokens) AS DOUBLE), {TEMPER}) AS power FROM cells GROUP BY {key}))"""
        )
    joins = " ".join(
        f"JOIN want_{k} ON cells.{k} IS NOT DISTINCT FROM want_{k}.{k}" for k in KEYS
    )
    wants = ", ".join(f"want_{k}.share AS want_{k}" for k in KEYS)
    steps.append(
        f"""w0 AS (
  SELECT *, weight / CAST({SHARE} AS DOUBLE) AS most FROM (
    SELECT cells.*, {wants}, CAST(tokens AS DOUBLE)
           / greatest((SELECT sum(tokens) FROM cells), 1) AS weight FROM cells {joins}))"""
    )
    nearly = f"CAST({NEARLY!r} AS DOUBLE)"
    for n in range(ROUNDS * len(KEYS)):
        key = KEYS[n % len(KEYS)]
        steps.append(
            f"""w{n + 1} AS (
  SELECT * EXCLUDE (weight, full_, free_), least(most, weight * CASE
           WHEN want_{key} > full_ + free_ AND free_ > 0 THEN (want_{key} - full_) / free_
           WHEN full_ + free_ > 0 THEN want_{key} / (full_ + free_) ELSE 0 END) AS weight
  FROM (SELECT *, sum(CASE WHEN weight >= most * {nearly} THEN weight ELSE 0 END)
                    OVER (PARTITION BY {key}) AS full_,
               sum(CASE WHEN weight >= most * {nearly} THEN 0 ELSE weight END)
                    OVER (PARTITION BY {key}) AS free_ FROM w{n}))"""
        )
    steps.append(
        f"""rated AS (
  SELECT *, CASE WHEN tokens > 0 THEN weight * total / tokens ELSE 0 END AS rate
  FROM (SELECT *, CAST(sum(tokens) OVER () AS DOUBLE) AS total FROM w{ROUNDS * len(KEYS)})),
f0 AS (SELECT CAST({SHARE} AS DOUBLE) AS factor)"""
    )
    for n in range(CALIBRATIONS):
        steps.append(
            f"""f{n + 1} AS (
  SELECT any_value(factor) * ({SHARE} * any_value(total))
         / sum(least(1.0, factor * rate) * tokens) AS factor FROM rated, f{n})"""
        )
    same = " AND ".join(f"c.{k} IS NOT DISTINCT FROM r.{k}" for k in KEYS)
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT *, place < probability AS kept FROM (
  SELECT c.doc_id, c.source, c.lang, c.topic, c.n_tokens,
         round(least(1.0, factor * rate), {DIGITS}) AS probability,
         CAST(('0x' || substr(md5(CAST(c.doc_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0
           AS place
  FROM counted c JOIN rated r ON {same}, f{CALIBRATIONS})"""
    ).replace("SELECT *, place <", "SELECT * EXCLUDE (place), place <")

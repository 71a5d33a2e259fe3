"""Run registered queries beside their SQL equivalents and compare all rows.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value if value is None else str(value)


def _bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    bag = Counter(tuple(_cell(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], bag


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides hold the same rows under the same names and types."""
    rows = con.execute(sql)
    names = [d[0] for d in rows.description]
    theirs = _bag(names, rows.fetchall())
    ours = _bag(spark_df.columns, spark_df.collect())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] != theirs[1]:
        extra, missing = ours[1] - theirs[1], theirs[1] - ours[1]
        return (
            f"{sum(ours[1].values())} rows vs {sum(theirs[1].values())}; "
            f"{sum(extra.values())} differ, e.g. ours {list(extra)[:2]} theirs {list(missing)[:2]}"
        )
    return None


def main() -> int:
    import __spark_entry__ as contract
    from stockweave.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = get_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = contract.queries(), contract.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                problem = difference(df, con, oracle[name])
                note = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                problem, note = None, f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - reported per query
            problem = note = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{bad} bad; oracle without query: {sorted(set(oracle) - set(queries))}")
    return bad


if __name__ == "__main__":
    sys.exit(main())

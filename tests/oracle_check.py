"""Compare registered queries with their DuckDB oracles: ``python tests/oracle_check.py [sf_dir] [name …]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "∅"
        if isinstance(v, float):
            return f"{v!r}"
        if isinstance(v, (list, tuple)):
            return "[" + ",".join(cell(x) for x in v) + "]"
        return f"{type(v).__name__}:{v}"

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    got = query(spark, sf_dir)
    rows = canonical(got.columns, [tuple(r) for r in got.collect()])
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    expected = canonical(names, want.fetchall())
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(set(names) ^ set(got.columns))}"
    if rows != expected:
        here, there = set(rows), set(expected)
        mine, theirs = sorted(here - there)[:2], sorted(there - here)[:2]
        return f"{len(rows)} rows against {len(expected)}; {sorted(names)}\n  spark  {mine}\n  oracle {theirs}"
    return None if rows else "no rows"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from buyerlens.session import local_session

    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    session, con, bad = local_session(), duck(directory), 0
    for query_name in chosen:
        start = time.time()
        if query_name in oracle_sql():
            problem = compare(session, con, query_name, queries()[query_name], oracle_sql()[query_name], directory)
        else:
            n = queries()[query_name](session, directory).count()
            problem = None if n else "no rows"
        bad += problem is not None
        kind = "ok" if query_name in oracle_sql() else "rows"
        print(f"{kind if problem is None else 'BAD':5}{query_name} {time.time() - start:.1f}s", problem or "", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")

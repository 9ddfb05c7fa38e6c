"""Runs registered queries next to their SQL oracles.

Command line: ``python -m tests.oracle /root/testdata/sf0.01 [key ...]``.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "array<string>": "VARCHAR[]",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(f).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{f}')")
    return con


def _key(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "", 0.0)
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return (1, float(v), math.copysign(1.0, v))
    return (2, str(v), 0.0)


def _same(a, b) -> bool:
    if _key(a) == _key(b):
        return True
    return isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and its oracle; empty when equal."""
    rel = con.sql(sql)
    problems = []
    want = dict(zip(rel.columns, [str(t) for t in rel.types], strict=True))
    have = {n: TYPES.get(t, t) for n, t in df.dtypes}
    if want != have:
        odd = {k for k in want.keys() | have.keys() if want.get(k) != have.get(k)}
        problems.append(f"schema: {[(k, have.get(k), want.get(k)) for k in sorted(odd)]}")
        if want.keys() != have.keys():
            return problems
    names = sorted(want)
    ours = sorted((tuple(row[n] for n in names) for row in df.collect()), key=lambda t: [_key(v) for v in t])
    at = [rel.columns.index(n) for n in names]
    theirs = sorted((tuple(row[i] for i in at) for row in rel.fetchall()), key=lambda t: [_key(v) for v in t])
    if len(ours) != len(theirs):
        return [*problems, f"rows: {len(ours)} against {len(theirs)}"]
    exact = close = 0
    for a, b in zip(ours, theirs, strict=True):
        if [_key(v) for v in a] == [_key(v) for v in b]:
            exact += 1
        elif all(_same(x, y) for x, y in zip(a, b, strict=True)):
            close += 1
        elif len(problems) < 4:
            problems.append("row: " + str([(n, x, y) for n, x, y in zip(names, a, b, strict=True) if not _same(x, y)]))
    if close:
        problems.append(f"only close: {close} of {len(ours)}")
    return problems


def main() -> None:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir, keys = sys.argv[1], sys.argv[2:]
    spark, con = make_session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in keys or queries:
        start = time.time()
        try:
            df = queries[key](spark, sf_dir)
            if key in oracles:
                found = compare(df, con, oracles[key])
                note = "ok" if not found else "; ".join(found)
            else:
                found, note = [], f"rows only: {len(df.collect())}"
        except Exception as e:  # noqa: BLE001
            found, note = ["error"], f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(found)
        print(f"{'--' if found else 'OK'} {key:28s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{bad} of {len(keys or queries)} differ; {len(oracles)} oracles", flush=True)


if __name__ == "__main__":
    main()

"""Compare registered queries with their SQL twins in DuckDB.

``python tests/oracle.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(con, df, sql: str) -> str | None:
    """A message on the first difference, or ``None``."""
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    want_cols, want = [d[0] for d in res.description], res.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    a, b = rows_of(got_cols, got), rows_of(want_cols, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{x} != {y}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    spark_types = {f.name: kinds.get(f.dataType.simpleString(), "?") for f in df.schema.fields}
    duck_types = {d[0]: str(d[1]) for d in res.description}
    odd = [f"{c}: {t} / {duck_types[c]}" for c, t in spark_types.items() if t != duck_types[c] and duck_types[c] != "NUMBER"]
    if odd and os.environ.get("SHOW_TYPES"):
        print("   types", odd)
    return None if a else "no rows"


def main() -> int:
    from tidemill import local_session
    from tidemill.queries import ORACLES, QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8, 8)
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problem = compare(con, df, ORACLES[name])
            else:
                n = len(df.collect())
                problem = None if n else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        bad += problem is not None
        twin = "" if name in ORACLES else " (rows only)"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name}{twin} {time.time() - start:.1f}s {problem or ''}"[:900], flush=True)
    print(f"{len(names) - bad} of {len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main())

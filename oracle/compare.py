"""Compare a Spark result with its DuckDB oracle: row count, column names,
and the multiset of rows (values compared exactly)."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if v is None:
        return "\x00"
    return str(v)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    srows = [r.asDict() for r in spark_df.collect()]
    scols = sorted(spark_df.columns)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = [dict(zip(dcols, r)) for r in res.fetchall()]
    if scols != sorted(dcols):
        return False, f"columns differ: spark-only {sorted(set(scols) - set(dcols))}, duck-only {sorted(set(dcols) - set(scols))}"
    if len(srows) != len(drows):
        return False, f"row count {len(srows)} vs {len(drows)}"
    a = sorted(tuple(norm(r[c]) for c in scols) for r in srows)
    b = sorted(tuple(norm(r[c]) for c in scols) for r in drows)
    if a != b:
        for c in scols:
            x = sorted(norm(r[c]) for r in srows)
            y = sorted(norm(r[c]) for r in drows)
            if x != y:
                return False, f"column {c}: e.g. {[(p, q) for p, q in zip(x, y) if p != q][:3]}"
        return False, "row combinations differ"
    return True, f"{len(srows)} rows"

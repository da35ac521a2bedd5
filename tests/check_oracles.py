"""Compare registered queries with their SQL: python tests/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from waymeter.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(v):
    if isinstance(v, float):
        return None if v != v else round(v, 9)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> str:
    """Empty if equal, else what differs."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = {d[0]: str(d[1]) for d in rel.description}
    want = rows_of(names, rel.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    alike = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    bad = {c: (t, kinds[c]) for c, t in df.dtypes if alike.get(t) != kinds[c]}
    if bad:
        return f"types {bad}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    diff = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(diff)} of {len(got)} rows differ, first: {diff[0]}" if diff else ""


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = contract.oracle_sql()
    wrong = 0
    for name, fn in contract.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        t0 = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, name, fn, sql[name], sf_dir)
                label = "equal" if not problem else f"WRONG {problem}"
            else:
                label = f"rows only ({fn(spark, sf_dir).count()})"
        except Exception as e:  # noqa: BLE001
            label = f"WRONG {type(e).__name__}: {str(e)[:600]}"
        wrong += label.startswith("WRONG")
        print(f"{time.time() - t0:6.1f}s {name}: {label}", flush=True)
    print(f"{wrong} wrong")


if __name__ == "__main__":
    main()

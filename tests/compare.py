"""Run the registered queries against their SQL: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.append("/opt/oracle")


def sql_rows(sf_dir: str, sql: str):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view events as select * from '{sf_dir}/events.parquet'")
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    lines = [tuple(row[i] for i in order) for row in relation.fetchall()]
    return sorted(names), lines


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(row[n] for n in names) for row in df.collect()]


def normal(lines):
    def plain(value):
        if isinstance(value, float):
            return round(value, 5) + 0.0
        return value

    return sorted((tuple(plain(v) for v in line) for line in lines), key=repr)


def difference(spark, name: str, sf_dir: str) -> str:
    """Empty if both engines agree."""
    from __spark_entry__ import oracle_sql, queries

    got_names, got = spark_rows(queries()[name](spark, sf_dir))
    want_names, want = sql_rows(sf_dir, oracle_sql()[name])
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    got, want = normal(got), normal(want)
    if got == want:
        return "" if got else "both empty"
    lost, extra = sorted(set(want) - set(got), key=repr), sorted(set(got) - set(want), key=repr)
    return f"{len(got)} rows, want {len(want)}; missing {lost[:2]}, extra {extra[:2]}"


if __name__ == "__main__":
    from tests.conftest import new_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    from __spark_entry__ import queries

    session = new_session()
    for query in sys.argv[2:] or queries():
        start = time.time()
        try:
            problem = difference(session, query, f"/root/testdata/sf{sf}")
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{query:24s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)

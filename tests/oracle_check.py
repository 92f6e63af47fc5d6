"""Compare every registered query with its SQL counterpart. Usage: oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def canonical(frame: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return None
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
        return v.item() if hasattr(v, "item") else v

    frame = frame[sorted(frame.columns)]
    rows = [tuple(plain(v) for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def rows_of(spark_df) -> pd.DataFrame:
    return pd.DataFrame([tuple(r) for r in spark_df.collect()], columns=spark_df.columns, dtype=object)


def compare(spark, db, sf_dir: str, fn, sql: str | None):
    result = rows_of(fn(spark, sf_dir))
    if sql is None:
        return len(result), None
    got = canonical(result)
    cursor = db.execute(sql)
    want = canonical(pd.DataFrame(cursor.fetchall(), columns=[c[0] for c in cursor.description], dtype=object))
    if sorted(result.columns) != sorted(c[0] for c in cursor.description):
        return len(got), f"columns {sorted(result.columns)} / {sorted(c[0] for c in cursor.description)}"
    if got != want:
        extra = [r for r in got if r not in want[:2000]][:2] if len(got) < 3000 else []
        missing = [r for r in want if r not in got[:2000]][:2] if len(want) < 3000 else []
        first = next(((a, b) for a, b in zip(got, want) if a != b), None)
        return len(got), f"rows {len(got)} / {len(want)}; extra {extra} missing {missing} first {first}"[:700]
    return len(got), None


def main() -> int:
    import __spark_entry__ as entry
    from topicstream.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:]
    spark, db = local_session(8), connect(sf_dir)
    sql, failed = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            count, problem = compare(spark, db, sf_dir, fn, sql.get(name))
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            count, problem = -1, f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        kind = "rows-only" if name not in sql else "ok"
        print(f"{name:26s} {count:8d} rows {time.time() - start:6.1f} s  {problem or kind}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

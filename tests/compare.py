"""Run the registered queries and their SQL twins over one sample folder and compare all rows.

    python tests/compare.py [sample folder] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def twin_rows(folder: str, text: str) -> tuple[list[str], list[tuple], list[str]]:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    result = con.execute(text)
    return [c[0] for c in result.description], result.fetchall(), [str(c[1]) for c in result.description]


def differences(spark, folder: str, name: str) -> list[str]:
    """What differs between the query and its twin; empty if nothing does."""
    import __spark_entry__ as entry

    result = entry.queries()[name](spark, folder)
    columns, expected, _ = twin_rows(folder, entry.oracle_sql()[name])
    if sorted(columns) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} != {sorted(columns)}"]
    actual = Counter(map(tuple, result.select(*columns).collect()))
    expected = Counter(expected)
    if actual == expected:
        return []
    return [
        f"{sum(actual.values())} rows, expected {sum(expected.values())}",
        f"only here: {list((actual - expected).items())[:3]}",
        f"only in the twin: {list((expected - actual).items())[:3]}",
    ]


if __name__ == "__main__":
    from clickloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session()
    import __spark_entry__

    for query in sys.argv[2:] or __spark_entry__.queries():
        start = time.time()
        found = differences(spark, folder, query)
        print(f"{query:32s} {'ok' if not found else 'DIFFERS'} {time.time() - start:6.2f}s", flush=True)
        for line in found:
            print("   ", line)

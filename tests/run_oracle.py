"""Compare registered queries with their SQL twins: run_oracle.py SF_DIR [NAME ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
from comparison import connect, kinds, spark_multiset, sql_kinds, sql_multiset  # noqa: E402
from tallymark.session import build_session  # noqa: E402


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false", spark_driver_memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    queries, twins = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        begin = time.time()
        try:
            df = queries[name](spark, sf_dir)
            got = spark_multiset(df)
            spent = time.time() - begin
            want = sql_multiset(connection, twins[name]) if name in twins else got
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"ERROR {name}: {str(error)[:1500]}")
            continue
        same = got == want
        bad += not same
        print(f"{'ok  ' if same else 'DIFF'} {name} rows={sum(got[1].values())} {spent:.2f}s", flush=True)
        if not same:
            print("  spark", kinds(df))
            print("  sql  ", sql_kinds(connection, twins[name]), sum(want[1].values()))
            print("  only spark", list((got[1] - want[1]).items())[:3])
            print("  only sql  ", list((want[1] - got[1]).items())[:3])
    print(f"{bad} of {len(names or queries)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

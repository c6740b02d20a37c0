"""python tests/run_queries.py [sf_dir] [name ...]: compare registered queries with their oracles."""

import sys
import traceback

sys.path.insert(0, "/root/repo") if "/root/repo" not in sys.path else None

import __spark_entry__ as entry  # noqa: E402
from broadsheet.session import session  # noqa: E402
from tests.compare import compare, connect  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session()
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[2:] or list(queries)
    bad = 0
    for name in wanted:
        try:
            problem, seconds, n = compare(spark, con, name, queries[name], oracles.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            problem, seconds, n = f"{type(e).__name__}: {str(e)[:600]}", 0.0, 0
            if len(wanted) < 4:
                traceback.print_exc()
        bad += problem is not None
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name:32s} {n:7d} rows {seconds:6.2f}s {problem or ''}", flush=True)
    print("failures:", bad)


main()

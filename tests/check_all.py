"""Run every registered query against its SQL: python tests/check_all.py DIR [name...]"""

import os
import sys
import time

sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from oracle_check import duck, mismatch  # noqa: E402
from tasteline.session import local_session  # noqa: E402


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.monotonic()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                problem = mismatch(con, sqls[name], df)
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "sql " if name in sqls else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name:20s} {time.monotonic() - start:6.1f}s {problem or ''}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())

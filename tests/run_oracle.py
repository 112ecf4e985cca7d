"""Runs registered queries against their oracle: run_oracle.py SF_DIR [names]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_points  # noqa: E402
from tests.compare import connect, differences  # noqa: E402
from tierwise.session import local_session  # noqa: E402


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry_points.queries(), entry_points.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                problems = differences(df, con, oracle[name])
            else:
                problems = [f"no oracle, {df.count()} rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems) and name in oracle
        print(f"{name}: {'ok' if not problems else problems} {time.time() - start:.1f}s", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main())

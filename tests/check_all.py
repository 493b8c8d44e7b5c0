"""python tests/check_all.py <sf dir> [query ...]: every query against its SQL, with times."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import duck, mismatch  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from flowgraph.session import local_session  # noqa: E402


def main(sf_dir: str, wanted: list[str]) -> int:
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracle, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracle:
                problem = mismatch(df, con, oracle[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as failure:  # report and go on
            problem = f"{type(failure).__name__}: {str(failure)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - started:.1f}s {'' if name in oracle else '(rows only)'} {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

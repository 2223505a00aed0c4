"""Run every registered query against its oracle: ``python tests/run_compare.py [sf_dir] [names...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from lendlens.session import local_session  # noqa: E402
from tests.compare import compare, duck  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session()
    con = duck(sf)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in os_:
                r = compare(df, con, os_[name])
            else:
                r = {"rows_spark": df.count(), "match": "rows-only"}
        except Exception as e:  # report and continue
            r = {"error": repr(e)[:600], "match": False}
        ok = r.get("match")
        bad += ok is False
        print(f"{name:32s} {time.time() - t:6.2f}s {r}", flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()

"""Compare every query with its SQL: python tests/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as driver  # noqa: E402
from tests.compare import connect, mismatch  # noqa: E402
from tidelog.session import build_session  # noqa: E402


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session(
        "oracles", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), driver.oracle_sql(), 0
    for name, fn in driver.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            problem = mismatch(df, oracles[name], con) if name in oracles else None
            note = "" if name in oracles else f" (no SQL, {df.count()} rows)"
        except Exception:
            problem, note = traceback.format_exc().strip()[-1500:], ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s{note} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))

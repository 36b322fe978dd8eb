"""Compare queries with their oracles: run_oracles.py SF [name ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from compare import connect, difference  # noqa: E402

import __spark_entry__ as contract_entry  # noqa: E402
from flowmart import build_session  # noqa: E402


def main(sf: str, names: list[str]) -> int:
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = contract_entry.oracle_sql()
    bad = 0
    for name, fn in contract_entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = difference(fn(spark, sf_dir), con, oracles[name])
                note = "ok" if problem is None else f"DIFF {problem}"
            else:
                problem, note = None, f"rows {fn(spark, sf_dir).count()}"
        except Exception as error:  # noqa: BLE001
            problem = note = f"ERROR {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {note}", flush=True)
    print("failures", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))

"""Run the registered queries against DuckDB: python tests/check_suite.py FOLDER [NAME...]"""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import connect, duck_rows, spark_rows  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles = connect(folder), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        started = time.time()
        try:
            got = spark_rows(queries[name](spark, folder))
            took = time.time() - started
            started = time.time()
            want = duck_rows(con, oracles[name]) if name in oracles else None
            duck = time.time() - started
            if want is None:
                verdict = "no sql"
            elif got == want:
                verdict = "ok" if got[1] else "ok (empty)"
            else:
                verdict = "DIFFERENT"
                extra = [r for r in got[1] if r not in set(want[1])][:2]
                missing = [r for r in want[1] if r not in set(got[1])][:2]
                detail = f"{got[0]} {want[0]} {len(got[1])} {len(want[1])}\n    extra {extra}\n    missing {missing}"
                verdict += "\n    " + detail[:1500]
                bad += 1
            print(f"{name:28s} {len(got[1]):8d} {took:7.2f}s {duck:6.2f}s {verdict}", flush=True)
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"{name:28s} ERROR {str(error)[:int(os.environ.get("WIDTH", 600))]}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()
    print("bad:", bad, "of", len(names or queries))
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)

"""Runs queries against their SQL and prints one line each: python tests/check_all.py [sf_dir] [name...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from compare import database, differences  # noqa: E402
from tidegauge.session import local_session  # noqa: E402


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark, connection = local_session(cpus=8), database(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    failures = 0
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            result = query(spark, sf_dir).toPandas()
            spent = time.time() - began
            verdict = differences(result, connection.execute(oracles[name]).df()) if name in oracles else "no SQL"
            line = f"{verdict or 'same'} ({len(result)} rows, {spent:.1f} s, SQL {time.time() - began - spent:.1f} s)"
        except Exception as error:
            verdict, line = "error", f"{type(error).__name__}: {str(error)[:1500]}"
        failures += verdict not in (None, "no SQL")
        print(f"{name}: {line}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))

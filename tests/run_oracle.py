"""Run queries against their SQL and print one line each: python tests/run_oracle.py [sf] [name ...]"""

import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

import oracle  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as contract  # noqa: E402


def main() -> None:
    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle.connect(folder)
    queries, sqls = contract.queries(), contract.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        begun = time.time()
        try:
            frame = queries[name](spark, folder)
            if name in sqls:
                problem = oracle.difference(frame, sqls[name], connection)
                rows = connection.execute(f"SELECT count(*) FROM ({sqls[name]})").fetchone()[0]
            else:
                problem, rows = None, frame.count()
        except Exception as error:  # every query is to be tried
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} rows={rows} "
              f"{time.time() - begun:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()

"""Run registered queries beside their SQL: `check_queries.py SF_DIR [NAME ...]`."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from compare import compare, connect

import __spark_entry__ as entry
from changelake.session import build_session


def main(sf_dir, names):
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sql:
                faults = compare(spark, con, query, sql[name], sf_dir)
            else:
                faults = [f"rows only: {query(spark, sf_dir).count()}"]
        except Exception as error:
            faults = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(faults)
        print(f"{'ok  ' if not faults else 'FAIL'} {name} {time.time() - start:.1f}s", *faults, sep="\n     ", flush=True)
    print(bad, "not equal")


main(sys.argv[1], sys.argv[2:])

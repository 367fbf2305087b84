"""Run every registered query against its DuckDB oracle: python tests/run_oracle.py [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from oracle import compare, duck  # noqa: E402

from quarry.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E

    if os.environ.get("QUARRY_VANILLA") == "1":  # a plain session, like an outside driver's
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = local_session(int(os.environ.get("QUARRY_CORES", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in orc:
                ok, msg = compare(df, con, orc[name])
            else:
                n = df.count()
                ok, msg = True, f"rows-only: {n} rows"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t:6.1f}s  {msg}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()

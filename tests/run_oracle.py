"""Manual check: python -m tests.run_oracle [sf_dir] [name ...]"""

import json
import sys
import time

import __spark_entry__ as entry
from custlens.session import get_session
from tests.oracle_compare import compare, duck


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    for n in names:
        t0 = time.time()
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print(json.dumps({"query": n, "rows_only": df.count(), "sec": round(time.time() - t0, 2)}))
            continue
        try:
            r = compare(spark, con, qs[n], sqls[n], sf_dir)
        except Exception as e:  # report and continue
            r = {"error": repr(e)[:800]}
        r["sec"] = round(time.time() - t0, 2)
        print(json.dumps({"query": n, **r}, default=str))


if __name__ == "__main__":
    main()

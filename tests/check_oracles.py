"""Run every registered query against its oracle: python tests/check_oracles.py [sf_dir] [names...]"""

import json
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from harness import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from lakeledger.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = build_session("local[8]", 8)
con = duck(sf)
qs, ors = E.queries(), E.oracle_sql()
bad = 0
for name in names or list(qs):
    t = time.time()
    if name not in ors:
        n = qs[name](spark, sf).count()
        print(json.dumps({"q": name, "rows_only": n, "sec": round(time.time() - t, 2)}))
        continue
    try:
        r = compare(spark, con, qs[name], ors[name], sf)
    except Exception as exc:  # report and continue
        r = {"match": False, "error": repr(exc)[:800]}
    r["sec"] = round(time.time() - t, 2)
    bad += not r["match"]
    print(json.dumps({"q": name, **r}, default=str))
print("FAILED", bad)

"""CLI: compare all (or named) registered queries with their oracle; prints one line each."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_compare import compare, duck  # noqa: E402
from rivulet.plans import REGISTRY  # noqa: E402
from rivulet.session import build_session  # noqa: E402

sf = os.environ.get("RIVULET_ORACLE_SF", "/root/testdata/sf0.01")
names = sys.argv[1:] or sorted(REGISTRY)
spark = build_session(master="local[8]", shuffle_partitions=8)
con = duck(sf)
bad = 0
for n in names:
    q = REGISTRY[n]
    t = time.time()
    if q.sql is None:
        print(f"{n:32s} rows-only rows={q.build(spark, sf).count()} {time.time()-t:.1f}s", flush=True)
        continue
    try:
        r = compare(spark, q, sf, con)
    except Exception as e:  # report and go on
        bad += 1
        print(f"{n:32s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
        continue
    bad += not r["ok"]
    print(f"{n:32s} {'OK ' if r['ok'] else 'BAD'} rows={r['spark_rows']}/{r['oracle_rows']} {time.time()-t:.1f}s"
          + ("" if r["ok"] else f" {r}"), flush=True)
print("FAILED" if bad else "ALL OK", bad)

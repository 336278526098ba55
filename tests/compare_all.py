"""Compare every registered query with its SQL twin: python tests/compare_all.py SF_DIR [name part]"""

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from riskbook.catalog import ORACLES, QUERIES
from riskbook.sources.session import local_session
from tests.oracle import connect, difference

sf_dir = sys.argv[1]
parts = sys.argv[2:]
spark = local_session(8)
spark.sparkContext.setLogLevel("ERROR")
connection = connect(sf_dir)
bad = 0
for name, build in QUERIES.items():
    if parts and not any(p in name for p in parts):
        continue
    start = time.time()
    try:
        if name in ORACLES:
            found = difference(spark, connection, build, ORACLES[name], sf_dir)
        else:
            rows = build(spark, sf_dir).collect()
            found = None if rows else "no rows"
            print("    ", name, rows[:3])
    except Exception as error:
        found = "".join(traceback.format_exception_only(error))[:1500]
    bad += found is not None
    print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
print("bad:", bad)

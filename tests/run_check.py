"""Developer tool: python tests/run_check.py [sf_dir] [name prefix ...]"""

import sys
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_check import check, duck  # noqa: E402

from tidemill.plans.catalog import REGISTRY  # noqa: E402
from tidemill.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
wanted = sys.argv[2:]
spark = build_session(
    master="local[8]",
    **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
)
spark.sparkContext.setLogLevel("ERROR")
con = duck(sf)
bad = 0
for name, query in REGISTRY.items():
    if wanted and not any(name.startswith(w) for w in wanted):
        continue
    try:
        ok, text = check(query, spark, sf, con)
    except Exception as exc:  # noqa: BLE001
        ok, text = False, "".join(traceback.format_exception_only(exc))[:600]
    bad += not ok
    print(("ok  " if ok else "BAD ") + name + ": " + text, flush=True)
print("failures:", bad, "of", len(REGISTRY))

"""Compare catalog queries with their oracle SQL.

usage: python scripts/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwheel.plans.registry import load_all  # noqa: E402
from scripts.verify import compare, duck_connect  # noqa: E402
from cartwheel.session import build_session  # noqa: E402


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    reg = load_all()
    spark = build_session()
    con = duck_connect(sf)
    bad = 0
    for name, q in reg.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, q.fn, q.sql, sf)
        except Exception as e:  # report and continue with the rest
            r = {"query": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        r.pop("plan", None)
        if not r["status"].startswith(("ok", "rows-only")):
            bad += 1
        print(json.dumps(r), flush=True)
    print(f"# {len(reg) if not names else len(names)} checked, {bad} not ok", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

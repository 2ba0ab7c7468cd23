"""Run query keys on Spark and their oracle SQL on DuckDB; compare like the driver.

usage: python tools/check_oracle.py [sf_dir] [key ...] [--strict]

--strict compares floats exactly and requires equal pandas dtypes.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillsight.verify import compare  # noqa: E402

if __name__ == "__main__":
    from tillsight.session import local_session
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    strict = "--strict" in sys.argv
    keys = [a for a in sys.argv[2:] if a != "--strict"] or None
    spark = local_session(8)
    res = compare(spark, folder, keys, strict=strict)
    bad = {k: v for k, v in res.items() if not (v.startswith("ok") or v.startswith("rows-only"))}
    print(f"\n{len(res) - len(bad)}/{len(res)} pass")
    sys.exit(1 if bad else 0)

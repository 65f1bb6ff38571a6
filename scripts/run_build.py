"""Launcher for the daily build, for spark-submit or python.

    spark-submit --py-files ordermart.zip scripts/run_build.py SOURCE OUT [--as-of D]
    python scripts/run_build.py /root/testdata/sf0.01 /tmp/marts
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordermart.plans.build import BuildFailed, main  # noqa: E402

if __name__ == "__main__":
    try:
        main()
    except BuildFailed as e:
        print(str(e), file=sys.stderr)
        sys.exit(1)

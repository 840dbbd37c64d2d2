"""Print the physical plan of a registered job over staged Parquet inputs.

    python tools/explain.py <job-key> [sf_dir] [--run]

With ``--run`` the job is executed first, so the adaptive plan shown is the final
one (join strategies chosen at run time, reused exchanges).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from slicewright.registry import JOBS  # noqa: E402
from slicewright.session import build_session  # noqa: E402
from slicewright.sources.staging import stage_fixtures  # noqa: E402


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    key = args[0]
    sf_dir = args[1] if len(args) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 16)
    df = JOBS[key](spark, stage_fixtures(spark, sf_dir))
    if "--run" in sys.argv:
        df.collect()
    df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()

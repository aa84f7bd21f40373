"""Shuffle volume of the dedup, with and without the partial window limit.

Usage: python scripts/shuffle_metrics.py [sf_dir]

Runs the flagship query twice: as planned (partial WindowGroupLimit before
the exchange) and with the window-limit optimisation switched off, and prints
the records and bytes each shuffle wrote.
"""

from __future__ import annotations

import json
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from silverline.plans.diagnostics import shuffle_writes  # noqa: E402
from silverline.plans.queries import silver_videos  # noqa: E402
from silverline.session import build_session  # noqa: E402


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = build_session()
    result = {}
    for label, threshold in (("partial_limit", "1000"), ("no_limit", "-1")):
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
        df = silver_videos(spark, sf_dir)
        df.collect()  # measurement only: the result is ~1e5 rows at sf0.1
        result[label] = shuffle_writes(df)
    print(json.dumps({"sf_dir": sf_dir, "dedup_shuffle": result}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])

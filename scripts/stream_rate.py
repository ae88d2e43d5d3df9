"""Rows per second of the streaming prediction chain, from the query's progress log.

usage: python scripts/stream_rate.py [sf_dir] [house|plug]
"""

from __future__ import annotations

import json
import os
import platform
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loadlens.operators.keys import keys_of  # noqa: E402
from loadlens.session import get_spark, scratch_path  # noqa: E402
from loadlens.streaming.sinks import batch_progress, partition_per_batch, run_bounded  # noqa: E402
from loadlens.streaming.sources import stream_measurements  # noqa: E402
from loadlens.streaming.panes import prediction_stream  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    level = sys.argv[2] if len(sys.argv) > 2 else "house"
    spark = get_spark("local[8]", 8)
    s = prediction_stream(stream_measurements(spark, sf), keys_of(level), 3600, 21600, 3, watermark="0 seconds")
    t0 = time.time()
    q = run_bounded(s, partition_per_batch(scratch_path(spark, "rate-out")), "append", scratch_path(spark, "rate-ckpt"))
    wall = time.time() - t0
    prog = batch_progress(q)
    rows = sum(p["num_input_rows"] for p in prog)
    print(json.dumps({"level": level, "sf": sf, "input_rows": rows, "wall_sec": round(wall, 2),
                      "rows_per_sec_wall": round(rows / wall, 1), "batches": prog,
                      "machine": f"{platform.machine()} {os.cpu_count()} cpus"}))


if __name__ == "__main__":
    main()

"""The two programs of the original application as batch Spark jobs.

``run_processor`` turns measurements into the six set tables (house / plug
measures, averages history, predictions), each written under ``out_dir`` and
partitioned by slice size ``tf``.  ``run_quality`` recomputes plain slice
averages from the raw readings and compares them with the stored
predictions.  Usage::

    python -m loadlens.jobs.energy --sf-dir /path/to/tables --out /shared/energy --tf 3600
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from loadlens.operators import averages as avg
from loadlens.operators import predict as pr
from loadlens.operators import quality as q
from loadlens.operators.keys import HOUSE, PLUG
from loadlens.operators.measures import valid_load
from loadlens.functions.output import finish
from loadlens.session import scratch_path
from loadlens.sinks.writers import store_table, write_set_table
from loadlens.sources.tables import load_measurements

SET_TABLES = ("house_measure", "plug_measure", "house_averages", "plug_averages",
              "house_prediction", "plug_prediction")


def run_processor(measurements: DataFrame, out_dir: str, tf: int = 1, pane_seconds: int = 10,
                  panes_per_window: int = 3, median_source: str = "as_run") -> dict[str, str]:
    """Write the six set tables; returns their paths.

    ``median_source='as_run'`` reproduces what the original code computes; use
    ``'intended'`` for the slice-median prediction it was written for.
    """
    spark = measurements.sparkSession
    # read and checked once; every table and each of its passes starts from this narrow copy
    v = store_table(valid_load(measurements).select(*PLUG, "id", "timestamp", "value"), scratch_path(spark, "valid"))
    paths = {}
    for level, keys in (("house", HOUSE), ("plug", PLUG)):
        tables = {
            f"{level}_measure": (avg.measure_set(v, keys, tf), "value"),
            f"{level}_averages": (finish(avg.averages_set(v, keys, tf, pane_seconds)), "avg_load"),
            f"{level}_prediction": (pr.prediction_set(pr.state_prediction(
                v, keys, tf, pane_seconds, panes_per_window, median_source), keys, tf), "predicted_load"),
        }
        for name, (df, value_col) in tables.items():
            slice_col = "target_slice" if name.endswith("prediction") else "slice"
            path = f"{out_dir.rstrip('/')}/{name}"
            write_set_table(df, path, ["tf", slice_col, *keys, value_col])
            paths[name] = path
    return paths


def run_quality(spark: SparkSession, measurements: DataFrame, out_dir: str, tf: int = 1,
                align: str = "reference") -> dict[str, DataFrame]:
    """Absolute error of the stored predictions against measured slice averages."""
    v = valid_load(measurements)
    out = {}
    for level, keys in (("house", HOUSE), ("plug", PLUG)):
        stored = spark.read.parquet(f"{out_dir.rstrip('/')}/{level}_prediction").filter(f"tf = {tf}")
        pmin = q.prediction_min(stored, keys)
        out[f"{level}_error"] = finish(q.prediction_error(pmin, avg.slice_avg(v, keys, tf), keys, align))
    return out


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--tf", type=int, default=1)
    ap.add_argument("--pane", type=int, default=10)
    ap.add_argument("--panes-per-window", type=int, default=3)
    ap.add_argument("--median-source", default="as_run", choices=["as_run", "intended"])
    a = ap.parse_args(argv)
    from loadlens.session import get_spark

    spark = get_spark()
    m = load_measurements(spark, a.sf_dir)
    run_processor(m, a.out, a.tf, a.pane, a.panes_per_window, a.median_source)
    for name, df in run_quality(spark, m, a.out, a.tf).items():
        df.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/{name}")


if __name__ == "__main__":
    main()

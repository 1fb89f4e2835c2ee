"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from hindcast.plans.catalogue import CATALOGUE  # noqa: E402
from hindcast.session import local_session  # noqa: E402

HEADLINE = (
    "resample_first", "resample_mean_sum", "resample_median", "interpolate_time", "assemble_long", "rolling_mean_720",
    "decompose_25", "volatile_windows", "precedence_dedup", "archive_upsert", "snapshot_upsert", "asof_nearest",
    "asof_bitemporal", "crps_trapz", "quantile_order_gate", "local_to_utc", "json_payload", "html_table",
    "forecast_profile", "tiered_backtest", "experiment_grid",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    shared = tempfile.TemporaryDirectory(prefix="bench-")
    spark = local_session(cores, shared=shared.name)
    spark.sparkContext.setLogLevel("ERROR")
    CATALOGUE["ffill_bfill"].build(spark, folder).write.format("noop").mode("overwrite").save()
    taken = {}
    for name in HEADLINE:
        start = time.perf_counter()
        CATALOGUE[name].build(spark, folder).write.format("noop").mode("overwrite").save()
        taken[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    shared.cleanup()
    total = round(sum(taken.values()), 3)
    print(json.dumps({
        "metric": "total_query_time", "value": total, "unit": "sec", "queries": taken,
        "sf": Path(folder).name.removeprefix("sf"), "cpus": cores,
    }))


if __name__ == "__main__":
    main()

"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3).  Each query is run once to warm up, then BENCH_RUNS
times; the median is reported.  Outputs are forced with the ``noop`` sink, so
the whole plan runs without collecting rows to the driver.

Inputs (the domain layers derived from the driver tables) are written once
as parquet before timing -- in production they are files -- and that
one-off cost is reported as ``load_inputs``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from blockxwalk.plans.pipeline import BlockCrosswalk  # noqa: E402
from blockxwalk.session import local_session  # noqa: E402
from blockxwalk.sources.fixtures import Inputs  # noqa: E402


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=max(2 * cpus, 8), app="blockxwalk-bench",
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "6g"))

    t = time.time()
    inp = Inputs(spark, sf_dir)
    for name in ("segments", "parcels", "pad_addr", "pad_bill", "overrides"):
        getattr(inp, name)
    load = time.time() - t

    def fresh() -> BlockCrosswalk:
        return BlockCrosswalk(inp.segments, inp.parcels, inp.pad_addr, inp.pad_bill, inp.overrides)

    def q_master():
        _noop(fresh().master)

    def q_crosswalk():
        # five waves (each wave written to the checkpoint folder) + BBL crosswalk
        x = fresh()
        _noop(x.bbl_to_physical)

    def q_within_50():
        _noop(fresh().within_buffer)

    def q_nearest_150():
        _noop(fresh().nearest)

    def q_master_full():
        _noop(fresh().master_full)

    bench = {"master": q_master, "crosswalk_5_waves": q_crosswalk, "within_50": q_within_50,
             "nearest_150": q_nearest_150, "master_full": q_master_full}
    out = {}
    for name, fn in bench.items():
        fn()  # warm-up
        times = []
        for _ in range(runs):
            t = time.time()
            fn()
            times.append(time.time() - t)
        out[name] = round(statistics.median(times), 3)
    total = round(sum(out.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_median", "value": total, "unit": "sec",
                      "queries": out, "load_inputs": round(load, 3), "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()

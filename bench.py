"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of cores,
``BENCH_RUNS`` the measured runs per query after one warm-up; the median counts.
A line per query goes to standard error as it ends. A run of more than
``BENCH_LIMIT`` seconds (60) is stopped, and after ``BENCH_TOTAL`` seconds
(1500) no further query is begun; ``stopped`` in the JSON names these queries,
which are not in the total.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import threading
import time

from tallyloom.plans import load_all
from tallyloom.session import build_session

HEADLINE = (
    "jon_inner", "agg_group", "agg_dict", "agg_multi_key", "agg_box", "agg_ols", "agg_interval", "agg_dedupe",
    "agg_first_last", "agg_histogram", "prf_describe", "prf_nunique", "prf_duplicates", "prf_duplicates_count",
    "prj_derive", "prj_positional", "flt_bool", "flt_key_range", "jon_fk", "jon_semi", "jon_anti", "jon_lookup",
    "rsh_pivot_table_cols", "rsh_melt", "rsh_cube_rows", "win_rolling", "win_top_n", "win_rank_all", "win_change",
    "win_lap", "win_batches", "srt_order", "srt_top_k", "set_except_all", "str_regex", "str_phone", "str_email",
    "dat_anchor", "dat_range", "arr_matmul", "arr_elementwise", "jsn_parse", "tbl_update", "tbl_constraints",
    "udf_group", "udf_group_any", "jon_band_table", "tbl_update_buckets", "txt_language", "txt_spell", "txt_scrape", "src_csv", "snk_by_group",
)


LONG = 5.0  # seconds


def timed(spark, run, limit: float) -> float:
    """Seconds of a run; raises TimeoutError when it is stopped at the limit."""
    ended, over = threading.Event(), threading.Event()

    def stop() -> None:
        # a query is a row of jobs: those that begin later are stopped as well
        if not ended.wait(limit):
            over.set()
            while not ended.wait(0.5):
                spark.sparkContext.cancelAllJobs()

    threading.Thread(target=stop, daemon=True).start()
    start = time.perf_counter()
    try:
        run().write.format("noop").mode("overwrite").save()
    except Exception as e:
        if over.is_set():
            raise TimeoutError(f"stopped after {limit} s") from e
        raise
    finally:
        ended.set()
    return time.perf_counter() - start


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    limit, total = float(os.environ.get("BENCH_LIMIT", "60")), float(os.environ.get("BENCH_TOTAL", "1500"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    found, began = load_all(), time.perf_counter()
    seconds, stopped = {}, {}
    for name in names:
        if time.perf_counter() - began > total:
            stopped[name] = "not begun"
            continue

        def run(q=found[name]):
            return q.run(spark, root)

        try:
            warm_up = timed(spark, run, limit)
            # a long query varies little, so one measured run is enough
            repeats = 1 if warm_up > LONG else runs
            seconds[name] = round(statistics.median(timed(spark, run, limit) for _ in range(repeats)), 3)
        except TimeoutError as e:
            stopped[name] = str(e)
        print(f"{name} {seconds.get(name, stopped.get(name))}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
                **({"stopped": stopped} if stopped else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries and the layout sweeps; print one JSON line.

Every query runs once to warm up and then REPEAT times into a no-op sink; medians are reported.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.functions import udfs
from rowmill.operators import joins, radius
from rowmill.plans.joins import places, strip_place
from rowmill.registry import all_queries, table
from rowmill.session import build_session, session_settings
from rowmill.sinks.files import write_noop, write_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "2"))

HEADLINE = """
win_cumulative_ratio agg_count_forms agg_sums agg_mean agg_having agg_distinct_count agg_pivot agg_pivot_auto
agg_last wc_whitespace win_nth win_latest win_group_mean win_global_numbers join_inner join_broadcast
join_sort_merge join_salted join_anti join_radius join_self_pairs join_banded_pairs nul_group_mean dq_split
src_parquet_pruned src_html_links src_json_discovery snk_partitioned arr_fold udf_python udf_pandas udf_native
st_window_append st_fusion st_fusion_table pip_bus_trips pip_bus_ratios pip_sibling_pairs ml_linear
""".split()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def median(action) -> float:
    action()
    return round(statistics.median(timed(action) for _ in range(REPEAT)), 4)


def sweeps(spark: SparkSession) -> dict[str, float]:
    """The comparisons the tuning examples make, on the same data."""
    found: dict[str, float] = {}
    lines = table(spark, SF_DIR, "lineitem")
    parts = table(spark, SF_DIR, "part")

    for partitions, adaptive in (("200", "false"), ("16", "false"), ("1", "false"), ("200", "true")):
        with session_settings(
            spark, spark__sql__shuffle__partitions=partitions, spark__sql__adaptive__enabled=adaptive
        ):
            label = f"shuffle_{partitions}_{'aqe' if adaptive == 'true' else 'fixed'}"
            found[label] = median(lambda: write_noop(lines.groupBy("l_partkey").agg(F.avg("l_extendedprice"))))

    for split in ("128m", "384m", "2m"):
        with session_settings(spark, spark__sql__files__maxPartitionBytes=split):
            found[f"scan_split_{split}"] = median(lambda: write_noop(table(spark, SF_DIR, "lineitem")))

    small = parts.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    for name, frame in (("bench_lines", lines), ("bench_parts", small)):
        write_table(frame, name, f"{_scratch(spark)}/{name}", 8, ["l_partkey"])
    bucketed = spark.table("bench_lines"), spark.table("bench_parts")
    found["join_broadcast_hint"] = median(lambda: write_noop(joins.join_small(lines, small, "l_partkey")))
    with session_settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        found["join_shuffled_merge"] = median(lambda: write_noop(lines.join(small.hint("merge"), "l_partkey")))
        found["join_co_bucketed"] = median(lambda: write_noop(bucketed[0].join(bucketed[1].hint("merge"), "l_partkey")))
    for name in ("bench_lines", "bench_parts"):
        spark.sql(f"DROP TABLE {name}")

    readings = table(spark, SF_DIR, "customer").select(F.col("c_custkey").alias("r")).withColumns(strip_place("r"))
    points = places(spark, SF_DIR)
    found["radius_grid"] = median(lambda: write_noop(radius.radius_join(points, readings)))

    for name, column in (
        ("python", udfs.root_step_python("l_linenumber")), ("pandas", udfs.root_step_pandas("l_linenumber")),
        ("native", udfs.root_step(F.col("l_linenumber"))),
    ):
        found[f"function_{name}"] = median(lambda c=column: write_noop(lines.select(c)))

    def summaries(frame: DataFrame) -> None:
        for status in ("F", "O", "P"):
            write_noop(frame.where(F.col("o_orderstatus") == status).agg(F.sum("n")))

    grouped = table(spark, SF_DIR, "orders").groupBy("o_orderstatus", "o_custkey").agg(F.count(F.lit(1)).alias("n"))
    found["summaries_recomputed"] = median(lambda: summaries(grouped))
    kept = grouped.cache()
    found["summaries_cached"] = median(lambda: summaries(kept))
    kept.unpersist()
    return found


def _scratch(spark: SparkSession) -> str:
    from rowmill.session import fresh_path

    return fresh_path(spark, "bench")


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    })
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    timings = {
        name: median(lambda q=registered[name]: write_noop(q.run(spark, SF_DIR))) for name in HEADLINE
    }
    result = {
        "metric": "headline query seconds, total of medians", "value": round(sum(timings.values()), 3),
        "unit": "sec", "queries": timings, "sweeps": sweeps(spark), "sf": os.path.basename(SF_DIR.rstrip("/")),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()

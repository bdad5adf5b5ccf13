"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablewright.plans.registry import load_all  # noqa: E402
from tablewright.session import build_session  # noqa: E402

HEADLINE = [
    "io01_csv_declared_schema", "io07_year_partitions", "pr04_catalogue_top", "mv06_clean_transactions",
    "mv07_clean_buildings", "pf01_describe_numeric", "jn05_aggregate_before_join", "ag05_item_features",
    "ag06_user_features", "ag09_building_feature_table", "ag11_rfm", "ag13_daily_series", "ag18_long_tail",
    "wn01_recency_rank", "wn02_leave_last_out", "sp05_group_folds", "ss02_spearman", "ss05_binned_information",
    "ev06_auc", "ev10_ranking_metrics", "rc03_popularity_topk", "rc04_item_neighbours", "rc04_item_knn_topk",
    "rc07_factor_topk", "rc08_content_topk", "rc09_hybrid_topk", "rc11_similar_items", "rc14_negatives",
    "tx01_clean_tags", "tx04_cooccurrence", "tx09_search", "fc01_additive_forecast", "bk01_association_rules",
    "eq01_commune_equity", "wi01_what_if",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(2 * int(cpus)),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "20g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = load_all()
    spark.read.parquet(f"{folder}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    spent: dict[str, float] = {}
    for name in names:
        start = time.time()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.time() - start, 3)
        print(f"{name} {spent[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(spent.values()), 3), "unit": "sec", "queries": spent,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

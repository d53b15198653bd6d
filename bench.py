"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from songweave.catalog.queries import QUERIES
from songweave.session import build_session

HEADLINE = [
    "filter_rare_items",
    "preprocess_train",
    "preprocess_train_sparse",
    "interaction_counts",
    "pair_profile",
    "user_music_stats",
    "item_stats",
    "decayed_play_weight",
    "duplicate_embeddings",
    "embedding_topk",
    "embedding_topk_cells",
    "most_popular",
    "last_listen",
    "bm25_recommend",
    "item_knn",
    "rwr_recommend",
    "taste_cluster_recommend",
    "als_recommend",
    "candidates_wide",
    "feature_table",
    "ranker_train_pairs",
    "ranker_pairwise_scores",
    "diversify_three_each",
    "epsilon_greedy_topk",
    "recommend_final",
    "evaluate_model",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "songweave-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in only.split(",") if only else HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

from statlake.bindings import QUERIES
from statlake.session import local_session

HEADLINE = [
    "gold_player_game", "stat_pivot", "fantasy_points", "latest_per_key", "lagged_features",
    "temporal_split", "temporal_split_instants", "feature_dataset", "regression_metrics",
    "opponent_lateral", "semi_join_pairs", "new_rows_not_exists", "unprocessed_two_key",
    "upsert_rows", "upsert_blocks", "key_violations", "game_scores", "scores_wide",
    "player_summary", "last_n_games", "segment_sales", "explorer_page", "clean_html",
    "chunk_paragraphs", "chunk_tokens", "chunk_recursive", "compare_pairs", "chart_intent",
    "history_window", "flatten_games", "flatten_player_stats", "topk_cosine", "ranking_metrics",
    "version_metrics", "topk_many", "predict_batch", "embed_documents", "stream_upsert",
    "chunk_sentences", "clean_html_strict", "linear_of_one_input",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    # Start the JVM's code paths once; the first query would pay for it otherwise.
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()
    times: dict[str, float] = {}
    for name in names:
        # Twice, as the first run compiles code; the second one counts.
        for _ in range(2):
            start = time.perf_counter()
            # The whole result is computed and dropped: no column is pruned away.
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

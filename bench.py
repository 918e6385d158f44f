"""Headline timings: one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tagloom.plans.registry import QUERIES  # noqa: E402
from tagloom.session import build_session  # noqa: E402

HEADLINE = [
    "top_tokens",
    "doc_freq",
    "corpus_stats",
    "coverage_table",
    "html_segments",
    "body_tokens",
    "filter_term_docfreq",
    "bow_counts",
    "bow_tfidf",
    "skipgram_pairs",
    "stratified_split",
    "binary_relevance_squared_error",
    "supervised_bow",
    "unsupervised",
    "suggest_tags",
    "suggest_tags_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tagloom-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # starts the executor threads
    chosen = os.environ.get("BENCH_QUERIES")
    timings: dict[str, float] = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

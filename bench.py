"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores,
BENCH_QUERIES (optional, comma-separated) a choice of queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tasteline.operators import als  # noqa: E402
from tasteline.plans import catalog  # noqa: E402
from tasteline.session import local_session  # noqa: E402

HEADLINE = [
    "interactions",
    "split_counts",
    "user_codes",
    "track_codes",
    "encoded_val",
    "truth_val",
    "rows_of_users",
    "rows_except",
    "subsample_users",
    "subsample_rows",
    "roundtrip",
    "bias_items",
    "bias_users_items",
    "bias_topk",
    "bias_topk_unseen",
    "bias_precision",
    "ranking_metrics",
    "bias_tune",
    "als_fit",
    "als_rank_100",
    "factor_topk",
    "factor_topk_unseen",
    "bias_test",
    "popularity_test",
    "als_topk",
    "als_topk_unseen",
    "als_metrics",
    "als_score",
    "als_tune",
    "tag_embedding",
    "map_2d",
    "als_runs",
    "series_time",
]


def als_fit(spark, sf_dir):
    """The fit alone, without saving."""
    return als.item_factors(als.fit_als(catalog._encoded(spark, sf_dir).train, als.AlsParams()))


def als_rank_100(spark, sf_dir):
    """Fit and lists at a rank of the size that real searches use."""
    model = als.fit_als(catalog._encoded(spark, sf_dir).train, als.AlsParams(rank=100, max_iter=2))
    return als.recommend(model, catalog._users(spark, sf_dir), catalog.TOP)


OWN = {"als_fit": als_fit, "als_rank_100": als_rank_100}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    start = time.monotonic()
    catalog.workspace(spark, sf_dir)
    seconds["prepare"] = round(time.monotonic() - start, 3)
    for name in names:
        query = OWN.get(name) or catalog.QUERIES[name]
        start = time.monotonic()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()

"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskloom.operators.models import TrainingSettings, area_under_pr, build_estimator, param_grid  # noqa: E402
from riskloom.operators.sampling import with_folds  # noqa: E402
from riskloom.plans.training import balanced_split, encode_split  # noqa: E402
from riskloom.queries import QUERIES  # noqa: E402
from riskloom.queries.modeling import training_frame  # noqa: E402
from riskloom.session import local_session  # noqa: E402

DATA = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Rate reports over the line items and the events, the modelling frame, the
# profile, balance and folds, exact ranking metrics, medians, merging.
HEADLINE = (
    "sales_rate_by_category",
    "sales_rate_by_amount_band",
    "sales_rate_by_pair",
    "sales_top_customers_by_rate",
    "sales_daily_rate",
    "sales_percent_by_category",
    "sales_percent_by_amount_band",
    "sales_percent_by_pair",
    "sales_top_customers_by_volume",
    "sales_daily_percent",
    "rate_by_category",
    "rate_by_card_pair",
    "identity_join",
    "modeling_frame",
    "feature_profile",
    "approx_distinct",
    "top_categories",
    "balanced_sample",
    "fold_counts",
    "auc_exact",
    "auc_exact_ranged",
    "sales_auc_exact",
    "f1_accuracy",
    "sales_median_price",
    "aligned_predictions",
    "pk_duplicates",
)


def run(spark, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, DATA).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def run_training(spark) -> dict[str, float]:
    """Balance, split, profile, prepare and encode the modelling frame; one fold fit per model.

    About 28 000 training rows at sf0.1, the size of the published run.
    """
    settings = TrainingSettings()
    marks = [time.perf_counter()]
    encoded = encode_split(*balanced_split(training_frame(spark, DATA), settings), settings)
    encoded.test.count()
    marks.append(time.perf_counter())
    folds = with_folds(encoded.train, "transactionid", settings.folds)
    seconds = {"training_prepare": marks[1] - marks[0]}
    for name in ("rf", "gbt"):
        estimator = build_estimator(name, settings)
        started = time.perf_counter()
        model = estimator.fit(folds.where("cv_fold <> 0"), param_grid(name, estimator)[0])
        area_under_pr(model.transform(folds.where("cv_fold = 0")))
        seconds[f"{name}_fold"] = time.perf_counter() - started
    return {name: round(value, 3) for name, value in seconds.items()}


def main() -> None:
    spark = local_session("riskloom-bench", CPUS, **{"spark.driver.memory": "8g", "spark.sql.shuffle.partitions": CPUS})
    for name in HEADLINE[:2]:  # start-up and first compilation
        run(spark, name)
    seconds = {name: round(run(spark, name), 3) for name in HEADLINE}
    seconds.update(run_training(spark))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(DATA.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

``$BENCH_SF_DIR`` names the parquet folder, ``$BENCH_CPUS`` the local threads.
The store's tables are imported to parquet once, as a delivery would be, and the
features are computed from those. Reports, full read and lookup run over the
published features. ``features_from_source`` computes the features from the
given files instead. Each query warms up three times; the median of the next
three runs counts, and ``first_run`` keeps the very first.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F

from buyerlens.operators.integrity import key_violations, orphan_counts
from buyerlens.operators.sequence import order_sequence
from buyerlens.plans import features as plans
from buyerlens.plans import quality, reports
from buyerlens.plans.build import FEATURE_TABLES, clean_tables, feature_store, features_of
from buyerlens.session import build_session, shared_folder
from buyerlens.sources.standin import AS_OF, BASKET_BIN, BASKET_CAP, RISK_SPEND, standin_tables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
WARM_UPS = 3
RUNS = 3


def run(df) -> None:
    """Compute every row and column, and keep none."""
    df.write.format("noop").mode("overwrite").save()


def imported(spark, folder: str) -> dict:
    """The store's tables as parquet with one file per thread."""
    target = f"{shared_folder(spark)}/bench-{uuid.uuid4().hex}"
    tables = {}
    for name, df in standin_tables(spark, folder).items():
        df.repartition(CPUS).write.parquet(f"{target}/{name}")
        tables[name] = spark.read.parquet(f"{target}/{name}")
    return tables


def from_source(spark):
    return features_of(clean_tables(spark, standin_tables(spark, FOLDER, FEATURE_TABLES)), AS_OF)


def main() -> None:
    spark = build_session("buyerlens-bench", master=f"local[{CPUS}]", settings={
        "spark.sql.shuffle.partitions": str(CPUS),
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    tables = clean_tables(spark, imported(spark, FOLDER))
    store = feature_store(spark, f"{shared_folder(spark)}/bench-store-{uuid.uuid4().hex}")
    store.publish(features_of(tables, AS_OF))
    someone = store.read().agg(F.max(store.key)).first()[0]

    def amounts():
        return plans.order_amounts(tables["customers"], tables["orders"], tables["order_items"])

    queries = {
        "materialized_read": lambda: run(store.read()),
        "customer_lookup": lambda: store.lookup(someone).collect(),
        "order_amounts": lambda: run(amounts()),
        "order_sequence": lambda: run(order_sequence(amounts())),
        "key_violations": lambda: key_violations(tables).collect(),
        "orphan_counts": lambda: orphan_counts(tables).collect(),
        "cleaning_summary": lambda: quality.cleaning_summary(tables).collect(),
        "top_customers": lambda: plans.top_customers(store.read()).collect(),
        "features_summary": lambda: plans.features_summary(store.read()).collect(),
        "kpis": lambda: reports.kpis(store.read()).collect(),
        "recency_buckets": lambda: reports.recency_buckets(store.read()).collect(),
        "basket_histogram": lambda: reports.basket_histogram(store.read(), BASKET_CAP, BASKET_BIN).collect(),
        "frequency_buckets": lambda: reports.frequency_buckets(store.read()).collect(),
        "score_distribution": lambda: reports.score_distribution(store.read()).collect(),
        "negative_pct_histogram": lambda: reports.negative_pct_histogram(store.read()).collect(),
        "risk_kpis": lambda: reports.risk_kpis(store.read(), spend=RISK_SPEND).collect(),
        "top_at_risk": lambda: reports.top_at_risk(store.read(), spend=RISK_SPEND).collect(),
        "geo_by_state": lambda: reports.geo_by_state(store.read(), tables["customers"]).collect(),
        "customer_features": lambda: run(features_of(tables, AS_OF)),
        "features_from_source": lambda: run(from_source(spark)),
        "publish_features": lambda: store.publish(features_of(tables, AS_OF)),
    }

    first, median = {}, {}
    for name, query in queries.items():
        seconds = []
        for _ in range(WARM_UPS + RUNS):
            start = time.perf_counter()
            query()
            seconds.append(time.perf_counter() - start)
        first[name] = round(seconds[0], 3)
        median[name] = round(statistics.median(seconds[WARM_UPS:]), 3)
    spark.stop()

    print(json.dumps({
        "metric": "sum of warm medians",
        "value": round(sum(median.values()), 3),
        "unit": "sec",
        "queries": median,
        "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
        "first_run": first,
        "cpus": CPUS,
    }))


if __name__ == "__main__":
    main()

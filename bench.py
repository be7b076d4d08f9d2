"""Benchmark: headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every job is executed in full with the ``noop`` sink (the whole plan runs, no
rows are collected to the driver).  The binding's item numbering is a
checkpointed job and is timed as part of the first query (``master_build``).
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mercato.operators import features as fe  # noqa: E402
from mercato.plans.etl import master_location, materialize_master  # noqa: E402
from mercato.operators import reports as rp  # noqa: E402
from mercato.operators import split as sp  # noqa: E402
from mercato.operators import text as tx  # noqa: E402
from mercato.session import get_spark  # noqa: E402
from mercato.sources.binding import bind_marketplace, bind_review_corpus  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", app="mercato-bench", shuffle_partitions=max(8, 2 * cpus),
                      extra={"spark.driver.memory": "16g"})
    timings: dict[str, float] = {}

    def timed(name, build):
        t0 = time.perf_counter()
        run(build())
        timings[name] = round(time.perf_counter() - t0, 3)

    state = {}

    # master build = bind + join chain + write (clustered by order_id); the
    # downstream jobs read the written table, as in the pipeline
    t0 = time.perf_counter()
    path = master_location(spark, sf_dir)
    m = materialize_master(spark, bind_marketplace(spark, sf_dir), path)
    timings["master_build"] = round(time.perf_counter() - t0, 3)
    timed("kpis", lambda: rp.kpis(m))
    timed("sales_by_month", lambda: rp.sales_by_month(m))
    timed("delay_features", lambda: fe.delay_features(m))
    timed("customer_features", lambda: fe.customer_features(m))
    timed("seller_features", lambda: fe.seller_features(m))
    timed("pricing_features", lambda: fe.pricing_features(m))
    timed("interactions", lambda: fe.interactions(m))

    def tfidf():
        c = tx.clean_reviews(fe.sentiment_dataset(bind_review_corpus(spark, sf_dir)))
        c = sp.stratified_split(c.select("review_id", "sentiment", "review_clean"), "review_id", "sentiment")
        return tx.fit_apply_tfidf(c)[1]

    timed("tfidf", tfidf)
    total = round(sum(timings.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({"metric": "headline_total_seconds", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()

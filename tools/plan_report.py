"""Summarise the final (adaptive) physical plans of the headline jobs.

usage: python tools/plan_report.py [sf_dir]  -> markdown on stdout
Each job is executed (noop sink) so the adaptive plan is final; the summary lists
shuffles, join strategies, aggregates, windows, Python operators and the parquet
scans' pushed filters / read schemas.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from mercato.operators import features as fe  # noqa: E402
from mercato.operators import master as ms  # noqa: E402
from mercato.operators import reports as rp  # noqa: E402
from mercato.operators import split as sp  # noqa: E402
from mercato.operators import text as tx  # noqa: E402
from mercato.plans.etl import master_location, materialize_master  # noqa: E402
from mercato.session import get_spark  # noqa: E402
from mercato.sources.binding import bind_marketplace, bind_review_corpus  # noqa: E402


def summary(name: str, df) -> str:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    c = {k: len(re.findall(p, plan)) for k, p in {
        "hash shuffles": r"Exchange hashpartitioning", "range shuffles": r"Exchange rangepartitioning",
        "single-partition exchanges": r"Exchange SinglePartition", "broadcasts": r"BroadcastExchange",
        "sort-merge joins": r"SortMergeJoin", "broadcast hash joins": r"BroadcastHashJoin",
        "hash aggregates": r"\bHashAggregate", "object hash aggregates": r"ObjectHashAggregate",
        "sort aggregates": r"SortAggregate", "windows": r"\bWindow \[", "python (Arrow) operators":
        r"MapInPandas|ArrowEvalPython|BatchEvalPython", "reused exchanges": r"ReusedExchange"}.items()}
    out = [f"### {name}", "", "| operator | count |", "|---|---|"]
    out += [f"| {k} | {v} |" for k, v in c.items() if v]
    filters = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))
    if filters:
        out += ["", "Pushed parquet filters: " + "; ".join(f"`{f[:140]}`" for f in filters[:4])]
    return "\n".join(out) + "\n"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", shuffle_partitions=16, extra={"spark.driver.memory": "16g"})
    t = bind_marketplace(spark, sf_dir)
    print(f"# Final physical plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n")
    print(summary("build_master (binding + joins, before the write)", ms.build_master(t)))
    m = materialize_master(spark, t, master_location(spark, sf_dir))
    jobs = {
        "kpis": rp.kpis(m), "delay_features": fe.delay_features(m),
        "customer_features": fe.customer_features(m), "seller_features": fe.seller_features(m),
        "pricing_features": fe.pricing_features(m),
        "delay_temporal_split": sp.temporal_split(fe.delay_features(m).select("order_id", "order_purchase_timestamp"),
                                                  ["order_purchase_timestamp", "order_id"]),
    }
    for n, df in jobs.items():
        print(summary(n, df))
    c = tx.clean_reviews(fe.sentiment_dataset(bind_review_corpus(spark, sf_dir)))
    c = sp.stratified_split(c.select("review_id", "sentiment", "review_clean"), "review_id", "sentiment")
    print(summary("tfidf (fit + apply)", tx.fit_apply_tfidf(c)[1]))
    spark.stop()


if __name__ == "__main__":
    main()

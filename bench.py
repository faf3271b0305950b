"""Time the load and the analysis queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. Preparation, not timed: the raw invoice lines are written as CSV once,
because a load starts from CSV. full_load goes from the CSV files to the published star;
incremental_run offers the same files again. Each query is run once, in the listed order, and
its whole result is produced.
"""

import json
import os
import sys
import time

from tillstar_checks.registry import new_folder
from tillstar.operators import quality
from tillstar.plans import analysis, flat
from tillstar.plans.load import load_csv
from tillstar.session import get_session
from tillstar.sources.sample import raw_sales
from tillstar.sources.warehouse import Warehouse

STAR_QUERIES = {
    "q1_overall_metrics": analysis.overall_metrics,
    "q2_top_customers": analysis.top_customers,
    "q3_customer_segments": analysis.customer_segments,
    "q4_top_products": analysis.top_products,
    "q5_price_dispersion": analysis.price_dispersion,
    "q6_revenue_by_country": analysis.revenue_by_country,
    "q7_monthly_trend": analysis.monthly_trend,
    "q8_weekday_pattern": analysis.weekday_pattern,
    "q9_quality_summary": quality.quality_summary,
    "v1_daily_sales": analysis.daily_sales_summary,
    "v2_product_performance": analysis.product_performance,
    "v3_customer_summary": analysis.customer_summary,
    "r1_top_customers_short": analysis.top_customers_short,
    "r2_monthly_trend_short": analysis.monthly_trend_short,
    "c4_references": quality.reference_check,
}
FLAT_QUERIES = {
    "a1_flat_top_customers": flat.top_customers,
    "a2_flat_top_countries": flat.top_countries,
    "a3_flat_top_products": flat.top_products,
}


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(app_name="bench", cores=cores)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}

    def timed(name, action):
        started = time.perf_counter()
        result = action()
        times[name] = round(time.perf_counter() - started, 3)
        return result

    def produce(frame):
        frame.write.format("noop").mode("overwrite").save()

    source = new_folder(spark, "csv")
    raw_sales(spark, folder).repartition(int(cores)).write.options(
        header=True, encoding="ISO-8859-1", quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(source)
    warehouse = Warehouse(spark, new_folder(spark, "star")).create()

    report = timed("full_load", lambda: load_csv(spark, source, warehouse))
    timed("incremental_run", lambda: load_csv(spark, source, warehouse))
    star = warehouse.star()
    for name, query in STAR_QUERIES.items():
        timed(name, lambda query=query: produce(query(star)))
    for name, query in FLAT_QUERIES.items():
        timed(name, lambda query=query: produce(query(star)))

    print(json.dumps({
        "metric": "load_and_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "facts": report.added["fact_sales"],
        "cores": int(cores),
        "spark": spark.version,
    }))
    return 0


if __name__ == "__main__":
    sys.exit(main())

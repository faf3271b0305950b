"""spark-submit entry: python -m tillstar --source data.csv --warehouse <folder>"""

import logging
import sys

from pyspark.errors import StreamingQueryException

from tillstar import settings
from tillstar.operators.cleaning import BadBatch
from tillstar.plans.load import load_csv
from tillstar.session import get_session, partitions_for, shared_folder
from tillstar.sources.csv_source import SourceUnavailable
from tillstar.sources.warehouse import Warehouse
from tillstar.streaming.incremental import read_csv_stream, start_load


def run(spark, chosen):
    """One job: create the tables if asked or absent, then load. True on success."""
    shared_folder(spark)
    partitions = partitions_for(int(chosen.input_gb * 1024**3)) if chosen.input_gb else None
    strict, customers = not chosen.lenient, chosen.customers
    warehouse = Warehouse(spark, chosen.warehouse)
    if chosen.reset or not warehouse.exists():
        warehouse.create(chosen.seed)
    try:
        if chosen.stream:
            stream = read_csv_stream(spark, chosen.source, strict)
            start_load(stream, warehouse, strict=strict, customers=customers).awaitTermination()
        else:
            load_csv(
                spark, chosen.source, warehouse, multi_line=chosen.multi_line, strict=strict,
                customers=customers, partitions=partitions,
            )
    except (SourceUnavailable, BadBatch, StreamingQueryException) as problem:
        logging.getLogger("tillstar").error("load failed: %s", problem)
        return False
    return True


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    sys.exit(0 if run(get_session(), settings.parse()) else 1)

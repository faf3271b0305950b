"""The load as a stream: every micro-batch of raw invoice lines goes through the batch load.

The stream's own checkpoint says which files are new, so the high-water mark does not filter; it is
still moved. Rows may arrive in any order and as late as they like: copies are removed inside each
micro-batch, and against the published facts by a hash of the raw row, within the months the batch
touches. So a batch that is repeated after a failure, a file that comes twice, or a stream over what
a batch load has taken before adds nothing, and no row is dropped without a line in the audit.

A batch that is repeated as it was is recognised by its number and its stream's id, and skipped.
"""

import logging

from pyspark.errors import AnalysisException

from tillstar.operators.cleaning import EmptyBatch
from tillstar.plans.load import load_batch
from tillstar.schemas import RAW
from tillstar.sources.csv_source import AS_TEXT, OPTIONS, SourceUnavailable, from_text

log = logging.getLogger(__name__)


def read_parquet_stream(spark, folder, **options):
    return spark.readStream.options(**options).schema(RAW).parquet(folder)


def read_csv_stream(spark, folder, strict=True, **options):
    try:
        text = spark.readStream.options(**OPTIONS).options(**options).schema(AS_TEXT).csv(folder)
    except AnalysisException as problem:
        raise SourceUnavailable(f"cannot read {folder}: {problem}") from problem
    return from_text(text, strict)


def start_load(raw_stream, warehouse, checkpoint=None, strict=True, customers="insert", **trigger):
    """Start the stream. trigger: as for DataStreamWriter.trigger(), default availableNow.

    The default checkpoint belongs to the warehouse as it was created; after another create() the
    stream starts from the beginning. strict, customers: as for load_batch().
    """
    state = warehouse.state()
    if state is None:
        raise ValueError(f"{warehouse.root} has no load state; call create() first")
    checkpoint = checkpoint or f"{warehouse.root}/_checkpoint/{state.generation}"

    def load_one(batch, number):
        # The id is kept in the checkpoint, so it is the same after a restart.
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        try:
            load_batch(
                batch, warehouse, use_mark=False, batch=number if stream else None,
                stream=stream or "", strict=strict, customers=customers,
            )
        except EmptyBatch:
            log.info("batch %s has no rows", number)

    return (
        raw_stream.writeStream.foreachBatch(load_one)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )

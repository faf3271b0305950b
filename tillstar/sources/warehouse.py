"""The star's tables as Parquet folders.

    <root>/dim_date/load_id=<n>/
    <root>/dim_product/load_id=<n>/
    <root>/dim_customer/load_id=<n>/
    <root>/customer_versions/load_id=<n>/   only of loads that keep history
    <root>/customer_days/load_id=<n>/       likewise
    <root>/fact_sales/load_id=<n>/SalesMonth=<yyyymm>/
    <root>/fact_index/load_id=<n>/SalesMonth=<yyyymm>/   which rows a load may have taken
    <root>/rejects/load_id=<n>/
    <root>/load_audit/load_id=<n>/
    <root>/load_state/slot=<n % 2>/    written last: this publishes the load
    <root>/_working/load_id=<n>/...    a load's own tables, removed when it is published

Every load only adds folders of its own id, and readers ignore ids above the last published one.
A load that dies half-way leaves nothing visible, and its replay overwrites its own folders.
The state keeps its last two rows in two slots, written in turn: while one is replaced, the other
is whole. One writer at a time.

The state also says from which load id on each table counts: compact() writes a table's rows as one
part under a new id, and an update of a dimension replaces it whole; either way the older parts
stay for readers that have begun, until the next compaction. Months of facts that a load rewrites, because
versions of customers have changed, count from that load on.
"""

import uuid
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar import schemas
from tillstar.operators import membership

LOAD_ID = T.StructField("load_id", T.IntegerType())
SALES_MONTH = T.StructField("SalesMonth", T.IntegerType())

STATE = T.StructType(
    [*schemas.WATERMARK.fields, T.StructField("LastSalesKey", T.LongType()),
     T.StructField("Batches", T.MapType(T.StringType(), T.LongType())),
     T.StructField("Bases", T.MapType(T.StringType(), T.IntegerType())),
     T.StructField("Generation", T.StringType()), T.StructField("load_id", T.IntegerType())]
)

# Stored columns per folder, in the order a reset clears them: facts before dimensions.
STORED = {
    "fact_sales": T.StructType([*schemas.FACT_SALES.fields, schemas.ROW_HASH, SALES_MONTH]),
    "fact_index": schemas.FACT_INDEX,
    "dim_product": schemas.DIM_PRODUCT,
    "dim_customer": schemas.DIM_CUSTOMER,
    "customer_versions": schemas.CUSTOMER_VERSIONS,
    "customer_days": schemas.CUSTOMER_DAYS,
    "dim_date": schemas.DIM_DATE,
    "rejects": schemas.REJECTS,
    "load_audit": schemas.AUDIT,
}
PARTITIONS = {"fact_sales": ["SalesMonth"], "fact_index": ["SalesMonth"]}
# Among the bases of a warehouse whose index holds all its facts, as one does that create() or
# compact() has made.
INDEXED = "fact_index"

# Default high-water mark before the first load.
DEFAULT_SEED = datetime(1900, 1, 1)


@dataclass(frozen=True)
class State:
    """batches: last batch number by stream. bases: first load id that counts, by table, or by
    table/month for months that were rewritten since."""

    load_id: int
    mark: datetime | None
    last_sales_key: int
    batches: dict
    bases: dict
    generation: str

    @property
    def last_batch(self):
        return max(self.batches.values(), default=None)


@dataclass(frozen=True)
class Star:
    """The four tables the analysis reads."""

    fact: DataFrame
    dates: DataFrame
    products: DataFrame
    customers: DataFrame


# What to call after a publication, by session and folder.
_followers = {}


def _as_map(values):
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


class Warehouse:
    def __init__(self, spark, root):
        self.spark = spark
        self.root = str(root).rstrip("/")

    def path(self, table):
        return f"{self.root}/{table}"

    # -- create and seed ---------------------------------------------------------------

    def create(self, seed=DEFAULT_SEED):
        """Drop whatever is there, create empty tables, seed the high-water mark.

        The state goes first, so that a reset that dies leaves no mark over emptied tables. Streams
        start anew: their default checkpoint belongs to the warehouse's generation.
        """
        self._overwrite(self.path("load_state"), self._empty(STATE), ["load_id"])
        for table, schema in STORED.items():
            empty = self._empty(T.StructType([*schema.fields, LOAD_ID]))
            self._overwrite(self.path(table), empty, ["load_id"])
        self.publish(State(0, seed, 0, {}, {INDEXED: 0}, uuid.uuid4().hex))
        return self

    def _empty(self, schema):
        columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        return self.spark.range(0).select(columns)

    def _overwrite(self, folder, rows, partition_by=(), mode="overwrite"):
        (
            rows.write.mode(mode)
            .option("partitionOverwriteMode", "static")
            .option("compression", "zstd")
            .partitionBy(*partition_by)
            .parquet(folder)
        )

    def exists(self):
        """Whether create() has run for this folder."""
        try:
            return self.state() is not None
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return False
            raise

    # -- writing -----------------------------------------------------------------------

    def write(self, table, load_id, rows, mode="overwrite"):
        """Replace one load's part of a table."""
        stored = rows.select(
            [F.col(f.name).cast(f.dataType).alias(f.name) for f in STORED[table]]
        )
        self._overwrite(self._part(table, load_id), stored, PARTITIONS.get(table, []), mode)

    def write_more(self, table, load_id, rows):
        """Add rows to a load's part of a table, after the write() that has begun it."""
        self.write(table, load_id, rows, mode="append")

    def write_nothing(self, table, load_id):
        """Leave one load's part of a table empty, also of what a failed attempt left there."""
        if self._read_part(table, load_id) is not None:
            self.write(table, load_id, self._empty(STORED[table]))

    def publish(self, state):
        """Make a load visible: one row, one file, one rename. Registered views follow."""
        values = [
            "fact_sales", state.mark, state.last_sales_key, _as_map(state.batches),
            _as_map(state.bases), state.generation, state.load_id,
        ]
        columns = [v if isinstance(v, Column) else F.lit(v) for v in values]
        row = self.spark.range(1).select(
            [c.cast(f.dataType).alias(f.name) for c, f in zip(columns, STATE, strict=True)]
        )
        self._overwrite(f"{self.path('load_state')}/slot={state.load_id % 2}", row)
        for follow in _followers.get(self._place(), []):
            follow(self)

    def follow(self, action):
        """Call action(warehouse) after each load this session publishes here."""
        actions = _followers.setdefault(self._place(), [])
        if action not in actions:
            actions.append(action)

    def _place(self):
        return self.spark.sparkContext.applicationId, self.root

    def compact(self):
        """Rewrite the published parts of each table as one, and publish that.

        Nothing a query sees changes. Parts that an earlier compaction replaced are removed.
        """
        state = self.state()
        load_id = state.load_id + 1
        for table in STORED:
            # One load's words for all facts, fewer than those of the loads they came with.
            rows = membership.words_of(self.read("fact_sales")) if table == INDEXED else self.read(table)
            if table == "fact_sales":
                rows = rows.hint("rebalance", "SalesMonth").sortWithinPartitions("SalesMonth", "DateKey", "InvoiceNo")
            self.write(table, load_id, rows)
            for old in range(state.bases.get(table, 1)):
                self.remove(self._part(table, old))
        self.publish(replace(state, load_id=load_id, bases=dict.fromkeys(STORED, load_id)))

    def remove(self, folder):
        """Delete a folder of this warehouse, if it is there."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)

    def working(self, name):
        return f"{self.root}/_working/{name}"

    def write_working(self, name, rows):
        """Write a working table of the current load and read it back.

        A written table, not a cached one: it outlives executors and ends the lineage.
        """
        rows.write.mode("overwrite").option("compression", "zstd").parquet(self.working(name))
        return self.spark.read.schema(rows.schema).parquet(self.working(name))

    # -- reading -----------------------------------------------------------------------

    def _last_state(self):
        rows = self.spark.read.schema(STATE).parquet(self.path("load_state"))
        return rows.orderBy(F.desc("load_id")).limit(1)

    def state(self):
        """Last published load, or None if the warehouse was never seeded."""
        row = self._last_state().first()
        if row is None:
            return None
        return State(
            row.load_id, row.LastLoadedDate, row.LastSalesKey, dict(row.Batches or {}),
            dict(row.Bases or {}), row.Generation,
        )

    def get_watermark(self):
        """Date up to which facts are loaded; None if the state row is absent."""
        state = self.state()
        return state.mark if state else None

    def watermark(self):
        """The load-state table: one row per target."""
        return self._last_state().select(schemas.WATERMARK.fieldNames())

    def _part(self, table, load_id):
        return f"{self.path(table)}/load_id={load_id}"

    def _read_part(self, table, load_id):
        """One load's part of a table, without listing the others; None if it has none."""
        try:
            return self.spark.read.schema(STORED[table]).parquet(self._part(table, load_id))
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def read(self, table, upto=None):
        """Rows of the published loads (or up to a given load id)."""
        state = self.state()
        schema = T.StructType([*STORED[table].fields, LOAD_ID])
        rows = self.spark.read.schema(schema).parquet(self.path(table))
        last = state.load_id if upto is None else upto
        first = F.lit(state.bases.get(table, 0))
        rewritten = {int(k.split("/")[1]): v for k, v in state.bases.items() if k.startswith(f"{table}/")}
        if rewritten:
            # On partition columns only, so parts that no longer count are not read.
            first = F.coalesce(F.element_at(_as_map(rewritten), F.col("SalesMonth")), first)
        return rows.filter(F.col("load_id").between(first, F.lit(last))).drop("load_id")

    def read_load(self, table, load_id):
        """Rows one load added."""
        rows = self._read_part(table, load_id)
        return self._empty(STORED[table]) if rows is None else rows

    def star(self):
        return Star(
            fact=self.read("fact_sales").drop(schemas.ROW_HASH.name),
            dates=self.read("dim_date"),
            products=self.read("dim_product"),
            customers=self.read("dim_customer"),
        )

"""Helpers shared by the operators of this subpackage."""

import uuid

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tillstar.session import shared_folder

# Rows handed to an operator's Python function at once: bounds what a worker holds besides the
# Arrow batch, which Spark itself bounds by rows and bytes.
SLICE_ROWS = 256


def read_table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id):
    """Whether a row is kept from training: crc32 of the id's text is a multiple of five.

    A missing id counts as an empty text, whose remainder is zero, so such rows never train.
    """
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def sampled(df, share, seed, *columns):
    """About that share (a number or column) of the rows, the same ones whatever the layout: by a
    hash of these columns. They must tell rows apart, or copies come and go together."""
    place = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in columns]), F.lit(1 << 40))
    share = share if isinstance(share, Column) else F.lit(float(share))
    return df.filter(place < share * float(1 << 40))


def written(df, name):
    """The frame as a Parquet table in the shared folder: computed once, safe from lost executors."""
    folder = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex[:12]}/{name}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# Keys that hold more than this part of all rows are joined by broadcast: fewer keys than this number.
HEAVY_KEYS = 1_000


def attached(rows, table, key, size):
    """Rows joined with a written table that is unique by key and counts its rows in the column `size`.

    A key with more than one in HEAVY_KEYS of all rows is broadcast, so that no task meets all rows of
    a hot key; there are fewer than HEAVY_KEYS such keys at any size. The others meet by their key.
    Rows without a key, or with one the table does not have, are left out.
    """
    total = table.agg(F.sum(size)).first()[0] or 0
    heavy = F.col(size) * HEAVY_KEYS > total
    hot = table.filter(heavy)
    if hot.isEmpty():
        return rows.join(table, key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table.filter(~heavy), key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def map_rows(df, inputs, make, columns, keep=None):
    """Add computed columns to rows by a Python function over slices of Arrow batches.

    inputs: column expressions the function reads. make(): called once per task, returns a
    function from their pyarrow arrays to one array or list per added column. columns: names and
    types of these. keep: columns of df to carry along, all by default; they travel as one struct
    named "row", so that no name in df can clash with an added one.
    """
    keep = df.columns if keep is None else keep
    names = [f"in{i}" for i in range(len(inputs))]
    source = df.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        *[c.alias(n) for c, n in zip(inputs, names, strict=True)],
    )
    made = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in columns.items()))
    types = [to_arrow_type(field.dataType) for field in made.fields]
    added = T.StructType([source.schema["row"], *made.fields])

    def run(batches):
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                arrays = [
                    x if isinstance(x, pa.Array) else pa.array(x, t)
                    for x, t in zip(work(*part.columns[1:]), types, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], added.names)

    return source.mapInArrow(run, added)


def unpacked(df, *more):
    """Columns of the carried row, then the added ones; on a clash the added one replaces."""
    carried = df.schema["row"].dataType.names
    taken = set(more)
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in carried if c not in taken], *more)

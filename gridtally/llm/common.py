"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.plans.session import shared_dir

LOWEST_ID = -(1 << 63)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back.

    The files survive a lost executor; Spark's cleaner removes them when the
    DataFrame is no longer used.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def utf8(col: str) -> Column:
    """The text's UTF-8 bytes; a null text counts as the empty one."""
    return F.coalesce(F.col(col).cast("string").cast("binary"), F.lit(b""))


def id_or_lowest(col: str) -> Column:
    """A document id as long; rows without one share an id below all others."""
    return F.coalesce(F.col(col).cast("long"), F.lit(LOWEST_ID))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, made longer where ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def kept_beside(df: DataFrame, keep: list[Column], *results: str) -> list[Column]:
    """``keep`` without columns that are called like a result column.

    The rule of all operators of this subpackage: a result column keeps its name, and a
    kept column of that name, in whatever case, gives way.
    """
    names = df.select(*keep).columns if keep else []
    taken = {r.lower() for r in results}
    return [c for c, n in zip(keep, names) if n.lower() not in taken]


def row_hash(df: DataFrame) -> Column:
    """One hash of all hashable columns: tells rows of one id apart."""
    plain = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    return F.xxhash64(*plain) if plain else F.lit(0).cast("long")


def shipped(spark: SparkSession, model):
    """Broadcast a fitted model; with its class, which executors may not have."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def unpacked(held):
    """The model of ``shipped``, in a task."""
    return pickle.loads(held.value)


def map_text(df: DataFrame, columns: list[Column], text: str, func: Callable,
             out: list[T.StructField]) -> DataFrame:
    """Apply ``func`` to the UTF-8 bytes of a text column, batch by batch.

    ``columns`` (aliased) travel along unchanged; see ``kept_beside``. ``func()`` is called once per
    task and returns the function that turns one text into a tuple of values,
    one for each field of ``out``.
    """
    columns = kept_beside(df, columns, *[f.name for f in out])
    titles = df.select(*columns).schema.fields if columns else []
    # names without dots, which mapInArrow would read as fields
    inner = [f"_gt_c{i}" for i in range(len(columns))]
    given = df.select(*[c.alias(n) for c, n in zip(columns, inner)], utf8(text).alias("_gt_text"))
    schema = T.StructType(list(given.schema.fields[:-1]) + out)

    def run(batches: Iterator):
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in out]
        names = [f.name for f in out]
        state = None
        for batch in batches:
            col = batch.column(batch.num_columns - 1)
            rest = [batch.column(i) for i in range(batch.num_columns - 1)]
            head = batch.schema.names[:-1]
            n = batch.num_rows
            state = state or func()
            # pieces of a batch, so that results of long texts never pile up
            start, size = 0, 0
            cells: list[tuple] = []
            for i in range(n):
                value = col[i].as_py()
                cells.append(state(value))
                size += len(value)
                if size >= 8 << 20 or i == n - 1:
                    stop = i + 1
                    arrays = [x.slice(start, stop - start) for x in rest]
                    arrays += [pa.array([c[k] for c in cells], types[k]) for k in range(len(out))]
                    yield pa.RecordBatch.from_arrays(arrays, names=head + names)
                    start, size, cells = stop, 0, []

    done = given.mapInArrow(run, schema)
    return done.select(*[F.col(n).alias(f.name) for n, f in zip(inner, titles)],
                       *[f.name for f in out])

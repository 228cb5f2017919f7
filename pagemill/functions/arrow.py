"""Pandas functions as column functions, made when they are called: modules import without a session."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes a core, up to which rows of few files are dealt out.
SPREAD_BYTES = 64 << 20


#: Rows of a page or a document each that a function sees at a time: their results go on before the next ones are made.
PAGES = 256


def in_parts(f: Callable, most: int) -> Callable:
    """The function on batches of columns, run on no more than ``most`` rows at a time."""

    def run(batches):
        for batch in batches:
            columns = batch if isinstance(batch, tuple) else (batch,)
            for first in range(0, max(1, len(columns[0])), most):
                yield f(*[c.iloc[first : first + most].reset_index(drop=True) for c in columns])

    return run


def arrow_udf(ddl: str, once: bool = False, most: int | None = None) -> Callable:
    """Decorates a function of pandas series; the result takes columns and gives a column of type ``ddl``.

    ``once``: the optimiser must not copy it into filters or other expressions, so it runs once a row.
    ``most``: rows that the function sees at a time, for large values; else it sees Arrow's batches.
    """

    def wrap(f: Callable) -> Callable[..., Column]:
        def call(*columns) -> Column:
            udf = F.pandas_udf(in_parts(f, most), ddl, F.PandasUDFType.SCALAR_ITER) if most else F.pandas_udf(f, ddl)
            return (udf.asNondeterministic() if once else udf)(*columns)

        call.__name__, call.__doc__ = f.__name__, f.__doc__
        return call

    return wrap


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a small scan with fewer files than cores, dealt out to all cores before a costly step.

    A larger scan, a stream and rows in memory stay as they are, so the shuffle is bounded by ``SPREAD_BYTES`` a core.
    """
    if rows.isStreaming:
        return rows
    cores, files = rows.sparkSession.sparkContext.defaultParallelism, len(rows.inputFiles())
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return rows.repartition(cores) if 0 < files < cores and size < cores * SPREAD_BYTES else rows

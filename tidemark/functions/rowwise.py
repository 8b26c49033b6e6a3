"""Python rules on texts, one row at a time."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

STRINGS = pa.list_(pa.string())


def one_by_one(rule: Callable, kind: str, arrow: pa.DataType) -> Callable[..., Column]:
    """A UDF that gives a rule one row after the other. Beside the Arrow batch that Spark sends, a worker holds the values of one row and the results; the batch's texts are never Python strings all at once."""

    @F.arrow_udf(kind)
    def run(first: pa.Array, *more: pa.Array) -> pa.Array:
        return pa.array((rule(*(v.as_py() for v in row)) for row in zip(first, *more, strict=True)), arrow)

    return run

"""One extra column computed per Arrow batch: for matrix products that built-in functions
cannot express. The other columns pass through as Arrow data, untouched."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T


def with_batch_column(
    df: DataFrame, keep: Sequence[str], argument: Column, out: str, data_type: T.DataType,
    compute: Callable[[pa.Array], list],
) -> DataFrame:
    """The columns ``keep`` of ``df`` and ``out``; ``compute`` turns a batch of arguments
    into Python values."""
    kept = list(keep)
    schema = T.StructType([*df.select(*kept).schema.fields, T.StructField(out, data_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        arrow_type = to_arrow_type(data_type)
        for batch in batches:
            found = pa.array(compute(batch.column("_argument")), type=arrow_type)
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, found], names=[*kept, out])

    return df.select(*kept, argument.alias("_argument")).mapInArrow(run, schema)


def matrix(lists: pa.Array) -> np.ndarray:
    """Lists of equal length as the rows of a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)

"""Small helpers for functions that run over pandas batches of a partition."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

#: Bytes of rows sent to a Python worker at once.
BATCH = 2 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_UNITS = {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}


def bound_batches(spark: SparkSession, most: int = BATCH) -> None:
    """From now on this session sends about ``most`` bytes of rows to a Python worker at once; a smaller setting stays.

    Spark's own bounds are 10,000 rows and 64 MB.  A batch of whole texts is held by the JVM outside its
    heap, twice while it grows, and by the worker as bytes and as strings, of which the worker keeps much.
    """
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(_BATCH_SETTING).strip().lower()).groups()
    if int(number) << _UNITS[unit] > most:
        spark.conf.set(_BATCH_SETTING, str(most))


def slices(batches: Iterable[pd.DataFrame], column: str, limit: int = 4 << 20) -> Iterator[pd.DataFrame]:
    """Cut batches so that the texts (or bytes) of ``column`` in one piece come to about ``limit`` characters."""
    for batch in batches:
        sizes = batch[column].str.len().fillna(0).cumsum() // limit
        for _, part in batch.groupby(sizes.to_numpy(), sort=False):
            yield part.reset_index(drop=True)


def groups(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of a partition sorted by ``keys``; a group that spans batches is joined.

    Only for groups of a bounded size.
    """
    rest: pd.DataFrame | None = None
    for batch in batches:
        if batch.empty:
            continue
        whole = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        last = (whole[keys] == whole[keys].iloc[-1]).all(axis=1).to_numpy()
        rest = whole[last].reset_index(drop=True)
        done = whole[~last]
        if len(done):
            for _, part in done.groupby(keys, sort=False):
                yield part.reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest


def map_texts(df: DataFrame, function: Callable[[list], dict], added: str, column: str = "text", limit: int = 4 << 20) -> DataFrame:
    """``df`` without ``column``, with the columns ``added`` that ``function`` makes from lists of its values.

    Other columns pass through as Arrow arrays, so null and large ids stay as they are.  One call
    sees values of about ``limit`` characters in all (a longer one alone).
    """
    rest = [c for c in df.columns if c != column]
    fields = StructType.fromDDL(added).fields
    out = StructType([df.schema[c] for c in rest] + fields)
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, values = 0, batch.column(column)
            sizes = pc.fill_null(pc.binary_length(values), 0).to_pylist()
            while place < batch.num_rows:
                end, total = place + 1, sizes[place]
                while end < batch.num_rows and total + sizes[end] <= limit:
                    total += sizes[end]
                    end += 1
                made = function(values.slice(place, end - place).to_pylist())
                arrays = [batch.column(c).slice(place, end - place) for c in rest]
                arrays += [made[f.name] if isinstance(made[f.name], pa.Array) else pa.array(made[f.name], k) for f, k in zip(fields, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=out.names)
                place = end

    return df.mapInArrow(run, out)

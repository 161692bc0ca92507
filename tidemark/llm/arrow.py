"""Applying Python to texts in Arrow batches, with other columns passed as they are."""

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

ARROW = {
    LongType(): pa.int64(),
    IntegerType(): pa.int32(),
    DoubleType(): pa.float64(),
    BooleanType(): pa.bool_(),
    StringType(): pa.string(),
    BinaryType(): pa.binary(),
    ArrayType(StringType()): pa.list_(pa.string()),
    ArrayType(LongType()): pa.list_(pa.int64()),
    ArrayType(IntegerType()): pa.list_(pa.int32()),
}


def fields(**types: DataType) -> list[StructField]:
    return [StructField(name, kind) for name, kind in types.items()]


def as_batch(columns: Sequence, added: list[StructField]) -> list[pa.Array]:
    return [pa.array(c, ARROW[f.dataType]) for c, f in zip(columns, added)]


def map_texts(
    docs: DataFrame,
    keep: Sequence[str],
    added: list[StructField],
    make: Callable[[], Callable[[str], tuple]],
    text: str = "text",
) -> DataFrame:
    """The columns ``keep`` of each row and the values that a function finds in its text.

    ``make`` is called once in each task and gives the function from a text (empty
    for a null) to one value for each of ``added``. Rows stay as many and in their
    partitions. Only the columns asked for are read, so others cannot clash; one in
    ``keep`` with the name of an added one is an error.
    """
    keep = list(dict.fromkeys(keep))
    if clash := set(keep) & {f.name for f in added}:
        raise ValueError(f"columns {sorted(clash)} have the names of results")
    names = keep + [f.name for f in added]
    schema = StructType([docs.schema[c] for c in keep] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            values = zip(*(function(t or "") for t in texts)) if texts else [()] * len(added)
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(kept + as_batch(list(values), added), names)

    return docs.select(*keep, docs[text].alias("_text")).mapInArrow(run, schema)

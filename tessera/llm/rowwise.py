"""Row-wise operators over a text column as narrow ``mapInArrow`` stages.

``annotate`` hands slices of a text column to a function that returns one value
per row. Input rows travel in one struct column, so extra columns of the input
can't clash with the operator's results. No shuffle; a lost executor's
partitions are simply scanned again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.scan import Texts, slices

ROW, TEXT = "_row", "_text"
Results = dict[str, object]


def annotate(
    df: DataFrame,
    text: str,
    fields: Sequence[T.StructField],
    scan: Callable[[Texts], Results],
    carry: Sequence[str],
) -> DataFrame:
    """Columns ``_row`` (struct of ``carry``) and ``fields`` for every input row.

    ``scan`` maps a slice of texts to ``{field: values}``, one value per text.
    """
    if not carry:
        raise ValueError("carry at least one column")
    src = df.select(
        F.col(f"`{text}`").cast("string").alias(TEXT), F.struct(*[F.col(f"`{c}`") for c in carry]).alias(ROW)
    )
    schema = T.StructType([src.schema[ROW], *fields])
    types = to_arrow_schema(T.StructType(list(fields)))

    def run(batches):
        for part in slices(batches, TEXT):
            got = scan(part)
            columns = [part.rows.column(ROW)]
            for f in types:
                x = got[f.name]
                columns.append(x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, type=f.type))
            yield pa.RecordBatch.from_arrays(columns, [ROW, *types.names])

    return src.mapInArrow(run, schema)


WHOLE = "_whole"


def annotate_whole(df: DataFrame, text: str, fields: Sequence[T.StructField], scan: Callable[[Texts], Results]) -> DataFrame:
    """As ``annotate`` over all columns of ``df``, with the text as ``_whole``: it travels once
    to the task and once back. ``whole_rows`` gives the columns of ``df`` again."""
    rest = [c for c in df.columns if c != text]
    whole = T.StructField(WHOLE, T.StringType())
    return annotate(df, text, [whole, *fields], lambda t: scan(t) | {WHOLE: t.rows.column(TEXT)}, rest or [text])


def whole_rows(got: DataFrame, columns: Sequence[str], text: str) -> DataFrame:
    return got.select(*[F.col(WHOLE).alias(c) if c == text else F.col(f"{ROW}.`{c}`").alias(c) for c in columns])


def unpacked(df: DataFrame, *names: str) -> DataFrame:
    """The carried columns followed by ``names``."""
    return df.select(f"{ROW}.*", *names)

"""Pieces that several text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters between words: space and \x09 to \x0D. The same set that bytes.split() uses.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task makes of them stays small too."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8(column: pa.Array) -> Iterator[bytes]:
    """Texts as bytes, some at a time; null is empty."""
    for start in range(0, len(column), 256):
        yield from (b"" if x is None else x for x in column.slice(start, 256).cast(pa.binary()).to_pylist())


def strings(column: pa.Array) -> Iterator[str]:
    """Texts as strings; null is empty, bytes that are not UTF-8 become U+FFFD."""
    return (x.decode("utf-8", "replace") for x in utf8(column))


def refuse(df: DataFrame, *names: str) -> None:
    """Raise if ``df`` has a column of one of these names, whatever the case."""
    taken = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if taken:
        raise ValueError(f"columns exist already: {', '.join(sorted(taken))}")


def with_row_id(df: DataFrame, name: str = "rid") -> DataFrame:
    """A number for each row, as identities may be null or repeated. Store the result before using it twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_key(doc_id: Column, text: Column) -> Column:
    """Tells documents apart by identity and text; rows that agree in both are the same document."""
    return F.xxhash64(doc_id.cast("string"), F.coalesce(text, F.lit("")))

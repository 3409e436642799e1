"""Small things that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm.tokens import pieces


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(name: str, taken: list[str]) -> str:
    """The name, with as many underscores in front as keep it apart from the columns there are (and what they begin with)."""
    name = "__" + name
    while any(c.lower().startswith(name.lower()) for c in taken):
        name = "_" + name
    return name


def need_integers(docs: DataFrame, column: str = "doc_id") -> None:
    """Operators that compare ids work on integers (up to 64 bits)."""
    kind = dict(docs.dtypes)[column]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{column} must be an integer column, not {kind}")


def remainder(doc_id: str | Column, m: int) -> Column:
    """crc32 of the id as text, modulo m; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit(""))), F.lit(m)).cast("int")


def by_piece(f: Callable[[pa.RecordBatch], pa.RecordBatch | None], column: str = "text", most: int = 4 << 20):
    """mapInArrow function that calls f on slices of bounded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, column, most):
            out = f(b)
            if out is not None and out.num_rows:
                yield out

    return run


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0

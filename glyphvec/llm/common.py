"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

#: The white space that separates words, for Java and RE2 patterns.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` refers to it."""
    return F.transform(F.array(value), use).getItem(0)


def words(text: Column) -> Column:
    """The words of ``text`` in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % modulus


def portions(rows, most: int = 1024) -> Iterator:
    """Consecutive parts of an Arrow array or batch, so that few rows are Python objects at a time."""
    return (rows.slice(start, most) for start in range(0, len(rows), most))


def slices(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose sizes add up to ``most`` at most; a larger item stands alone."""
    start = total = end = 0
    for end, size in enumerate(sizes):
        if end > start and total + size > most:
            yield start, end
            start, total = end, 0
        total += size
        end += 1
    if end > start:
        yield start, end


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores behind it until no column of ``df`` has the name."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish

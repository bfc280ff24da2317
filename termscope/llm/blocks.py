"""Documents in blocks of about equal size, dealt by a hash of the id and the text.

A block is what one task holds: it asks for its own slice of a corpus-wide
table (rows of one block and key), and meets the answer in a cogroup.  The
number of blocks follows the number of characters, so a block's size does not
depend on the corpus, a hot key has at most one row per block, and an id that many rows
have spreads over the blocks.  Copies in id and text stay together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 16 << 20


def block_count(docs: DataFrame, text_col: str, block_chars: int = BLOCK_CHARS) -> int:
    chars = docs.agg(F.sum(F.length(text_col).cast("long"))).first()[0] or 0
    return max(1, math.ceil(chars / block_chars))


def in_blocks(docs: DataFrame, blocks: int, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(block, id, text, more) of all rows; a null text is empty."""
    text, id_ = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).cast("long")
    block = F.pmod(F.xxhash64(id_, text), F.lit(blocks)).cast("int").alias("block")
    return docs.select(block, id_.alias("id"), text.alias("text"), *more)


def texts(table: pa.Table) -> Iterator[str]:
    for value in table.column("text"):
        yield value.as_py()

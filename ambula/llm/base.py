"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text handed to a tokenizer at once; longer texts are cut where a cut cannot change the tokens.
PIECE_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """The column of that very name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def safe_pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of about limit characters, cut before single spaces between other characters only."""
    start = 0
    while len(text) - start > limit:
        at = start + limit
        while at < len(text) - 1 and not (text[at] == " " and not text[at - 1].isspace() and not text[at + 1].isspace()):
            at += 1
        if at >= len(text) - 1:
            break
        yield text[start:at]
        start = at
    yield text[start:] if start else text

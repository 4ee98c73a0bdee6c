"""Expressions and small helpers that several operators share."""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters \x20 and \x09-\x0D, and a regex of one run of them.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """`text` with A-Z in lower case and nothing else changed.

    `lower` is only used on pure ASCII, where it does the same in one pass over bytes.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words_of(text: Column) -> Column:
    """The runs of characters other than `SPACES`, in order."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def random_unit(*parts: Column | str) -> Column:
    """A number in (0, 1) that depends on the parts alone, from 48 bits of their MD5.

    Null parts are written as an empty string, so a row with a null key has one too.
    """
    texts = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 12), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 48)


def blocks(keys: pa.Array, texts: pa.Array, most_bytes: int) -> Iterator[tuple[list, list]]:
    """Keys and texts of an Arrow batch as lists of about `most_bytes` of text, or of a single longer text."""
    start, held = 0, 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        held += size
        if held >= most_bytes or i + 1 == len(texts):
            yield keys.slice(start, i + 1 - start).to_pylist(), texts.slice(start, i + 1 - start).to_pylist()
            start, held = i + 1, 0

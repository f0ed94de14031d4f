"""Terms of a text: runs of ASCII letters and digits and of everything beyond ASCII, with only A-Z lower-cased."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column


def _normal(byte: int) -> int:
    char = chr(byte)
    if byte < 0x80 and not char.isalnum():
        return ord(" ")
    return ord(char.lower()) if byte < 0x80 else byte


#: UTF-8 byte → the byte that stands at the same place of the normalised text. Lengths do not change, so offsets carry over.
NORMAL = bytes(_normal(b) for b in range(256))


def terms(body: bytes | None) -> list[bytes]:
    return body.translate(NORMAL).split() if body else []


def keyed_bodies(rows: DataFrame, id_col: str, text_col: str, key: str) -> DataFrame:
    """The id as ``key`` and the text's UTF-8 bytes as ``body``: no other column of the input can clash."""
    return rows.select(column(id_col).cast("long").alias(key), column(text_col).cast("string").cast("binary").alias("body"))

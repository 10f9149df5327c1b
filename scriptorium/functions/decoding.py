"""Text of an HTTP body, by the declaration that deserves trust."""

from __future__ import annotations

import codecs
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

_META = re.compile(rb"""<meta[^>]+charset\s*=\s*["']?\s*([A-Za-z0-9_.:-]+)""", re.I)
_HEADER = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)


def _known(name: str | None) -> str | None:
    try:
        return codecs.lookup(name).name if name else None
    except LookupError:
        return None


def detect(content: bytes) -> str:
    """UTF-8 where the bytes allow it; else UTF-16 by its mark, else windows-1252."""
    if content[:2] in (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE):
        return "utf-16"
    try:
        content.decode("utf-8")
    except UnicodeDecodeError:
        return "cp1252"
    return "utf-8"


def decode_body(content: bytes | None, content_type: str | None = None) -> str | None:
    """A charset in the header is trusted; without one a <meta> charset, and failing that detection.

    A default such as ISO-8859-1 that nobody declared is no declaration. Unknown codecs fall through to the next rule and
    bad bytes become replacement characters: no content raises. Null gives null.
    """
    if content is None:
        return None
    declared = _HEADER.search(content_type or "")
    meta = _META.search(content[:4096])
    codec = _known(declared and declared[1]) or _known(meta and meta[1].decode("ascii")) or detect(content)
    return content.decode(codec, "replace")


def _decoded(content: pd.Series, content_type: pd.Series) -> pd.Series:
    return pd.Series([decode_body(None if c is None else bytes(c), t) for c, t in zip(content, content_type, strict=True)])


def decode_column(content: Column | str, content_type: Column | str) -> Column:
    """decode_body over columns, in Arrow batches."""
    return pandas_udf(_decoded, "string")(content, content_type)

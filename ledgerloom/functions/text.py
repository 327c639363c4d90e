"""Text comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Compares like a database server of the usual settings: neither case nor trailing blanks matter.
SERVER = "UTF8_LCASE_RTRIM"


def folded(text: Column, collation: str | None) -> Column:
    """``text`` as it takes part in comparisons and join keys: byte by byte, unless a collation is named."""
    return text if collation is None else F.collate(text, collation)

"""Which rows may have their key in a smaller set of keys, told before anything is shuffled.

A join of a wide table with a few of its keys moves the whole table. Here the keys set bits of a bit map, whose pieces of 4 KB are
joined by broadcast with the wide table, so that only rows whose bit is set go on to the exact join. The map has sixteen bits
for each key, between 2^15 and 2^28 bits: 32 MB at most, whatever the table's size. With more than some 16 million keys it lets
more strangers through, up to all rows; it never holds a row back whose key is in the set, so results do not depend on it.

Rows: null keys are a key like others; no keys give a map without bits; an empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialize

PIECE, LEAST, MOST = 1 << 15, 15, 28


class BitMap(NamedTuple):
    """Pieces (__piece, __bits) of a map of ``size`` bits: at most ``size`` / 8 bytes."""

    pieces: DataFrame
    size: int


def _place(columns: list[str], size: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(size))


def bit_map(keys: DataFrame, columns: list[str], label: str) -> BitMap:
    """The bits of the distinct or repeated ``keys``. Columns are hashed by value and type: use the same types in ``flagged``."""
    size = 1 << max(LEAST, min(MOST, (16 * keys.count()).bit_length()))
    place = _place(columns, size)
    pieces = keys.select((place / PIECE).cast("int").alias("__piece"), (place % PIECE).alias("at"))
    pieces = pieces.groupBy("__piece").agg(F.bitmap_construct_agg("at").alias("__bits"))
    return BitMap(materialize(pieces, label), size)


def flagged(rows: DataFrame, columns: list[str], found: BitMap, flag: str) -> DataFrame:
    """``rows`` with a boolean ``flag``: false only where the key is not among those of the map."""
    marked = rows.withColumn("__at", _place(columns, found.size)).withColumn("__piece", (F.col("__at") / PIECE).cast("int"))
    # Broadcast by hand: BitMap bounds the pieces at 2^13 rows of 4 KB.
    joined = marked.join(F.broadcast(found.pieces), "__piece", "left")
    byte = f"cast(conv(hex(substring(__bits, cast(__at % {PIECE} div 8 as int) + 1, 1)), 16, 10) as int)"
    hit = F.expr(f"coalesce(shiftright({byte}, cast(__at % 8 as int)) & 1 = 1, false)")
    return joined.withColumn(flag, hit).select(*rows.columns, flag)


def left_after(marked: DataFrame, verdicts: DataFrame, bound: Column | None = None) -> DataFrame:
    """(__row, __own) of ``marked`` without the rows that ``verdicts`` (__own, kept) drops; of equal keys one stays.

    Rows whose key no dropped row can have stay where they are; only the others move, to be joined with the kept keys and
    made distinct. Rows for which ``bound`` is false stay in any case.
    """
    dropped = bit_map(verdicts.where("NOT kept"), ["__own"], "dropped-bits")
    doubtful = F.col("__doubt") if bound is None else F.col("__doubt") & bound
    seen = flagged(marked, ["__own"], dropped, "__doubt")
    kept = flagged(verdicts.where("kept"), ["__own"], dropped, "__doubt").where("__doubt").select("__own")
    chosen = seen.where(doubtful).join(kept, "__own", "left_semi").dropDuplicates(["__own"])
    return seen.where(~doubtful).unionByName(chosen).select("__row", "__own")

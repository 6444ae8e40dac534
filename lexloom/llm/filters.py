"""Filters of a fixed size: arrays of bits that hold hashes of keys, and may let other keys pass."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lexloom.llm.store import keep


def bit_filter(keys: DataFrame, column: str, bits: int, name: str) -> Callable[[str], Column]:
    """A condition for columns of other tables: whether their value is among the keys, or shares its bit with one that is.
    bits: a multiple of 64; as many go to every task, however many keys there are."""

    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(bits))

    some = keys.select(place(column).alias("p")).distinct().groupBy(F.shiftright("p", 6).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("w"))
    whole = keys.sparkSession.range(bits // 64).withColumnRenamed("id", "i").join(some, "i", "left")
    words = F.transform(F.array_sort(F.collect_list(F.struct("i", F.coalesce("w", F.lit(0).cast("long")).alias("w")))), lambda x: x["w"])
    table = keep(whole.agg(words.alias("bits")), name)

    def holds(c: str) -> Column:
        word = F.element_at(table.scalar(), F.shiftright(place(c), 6).cast("int") + 1)
        return F.bit_get(word, place(c).bitwiseAND(F.lit(63)).cast("int")) == 1

    return holds

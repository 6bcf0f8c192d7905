"""Many columns as one text, and back: a row that is shuffled whole takes less room that way.

A row in a shuffle has eight bytes for each column besides its value, most of which do not compress. Values come
back as they were, whatever they hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR, NO_VALUE = "\x01", "\x02"
AS_TEXT, AS_HEX = "t", "x"          # how a row's values are written: as they are, or in hex where one holds a mark
# types whose text gives the same value again
TEXT_TYPES = (T.StringType, T.IntegralType, T.DoubleType)


def pack(df: DataFrame, keep, packed_col: str = "__packed") -> DataFrame:
    """``df`` with the columns ``keep`` and all others in one text column; see :func:`unpack`."""
    names = [c for c in df.columns if c not in keep]
    wrong = [c for c in names if not isinstance(df.schema[c].dataType, TEXT_TYPES)]
    if wrong:
        raise TypeError(f"columns that do not come back from text: {wrong}")
    values = [F.col(f"`{c}`").cast("string") for c in names]

    def joined(mark: str, parts: list[Column]) -> Column:
        return F.concat_ws(SEPARATOR, F.lit(mark), *[F.coalesce(p, F.lit(NO_VALUE)) for p in parts])

    every = F.concat_ws("", *[v for c, v in zip(names, values) if isinstance(df.schema[c].dataType, T.StringType)])
    odd = every.contains(SEPARATOR) | every.contains(NO_VALUE) | ~F.is_valid_utf8(every)
    text = F.when(odd, joined(AS_HEX, [F.hex(v) for v in values])).otherwise(joined(AS_TEXT, values))
    return df.select(*[F.col(f"`{c}`") for c in keep], text.alias(packed_col))


def unpack(df: DataFrame, schema: T.StructType, packed_col: str = "__packed") -> DataFrame:
    """The columns of ``schema``, the one that :func:`pack` was given, those kept taken as they are."""
    kept, parts = set(df.columns), "__parts"
    names = [f.name for f in schema if f.name not in kept]
    split = df.select(*[F.col(f"`{c}`") for c in df.columns if c != packed_col],
                      F.split(packed_col, SEPARATOR).alias(parts))

    def value(k: int, to: T.DataType) -> Column:
        part = F.nullif(F.get(parts, F.lit(k + 1)), F.lit(NO_VALUE))
        return F.when(F.get(parts, F.lit(0)) == AS_HEX, F.unhex(part).cast("string")).otherwise(part).cast(to)

    place = {c: k for k, c in enumerate(names)}
    return split.select(*[F.col(f"`{f.name}`") if f.name in kept else value(place[f.name], f.dataType).alias(f.name)
                          for f in schema])

"""Output contract shared by a Spark query and its SQL oracle.

A spec is a string of ``name:type`` items; types: l bigint, i int, d double (rounded to 6 digits, no
negative zero), s string, t timestamp, b boolean; dN rounds a double to N digits (large sums of squares).  The Spark result and the oracle are projected onto
the same names, order and types, so that their value hashes can be compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

DIGITS = 6
# v: sums of squares of decimal data are often exact decimal halves (445.51125); last-bit summation
# differences between engines would flip the rounded digit, so they are scaled by 1 + 2**-33 (moving
# exact halves off the boundary identically in both engines) and rounded to 4 places.
NUDGE = 1.0 + 2.0 ** -33
# Doubles of a row up to which Spark rounds them; more are rounded over Arrow batches, as the code for a wide row is too long to be compiled.
NARROW = 8


def parse(spec: str) -> list[tuple[str, str]]:
    out = []
    for item in spec.split():
        name, typ = item.rsplit(":", 1)
        out.append((name, typ))
    return out


def rounded(x: Column, digits: int) -> Column:
    """``F.round(x, digits)`` of a double, bit for bit; the decimal it goes through is made only near a half.

    x * 10**digits is off by less than 0.001 below 10**12, so away from a half its nearest whole number is the decimal's, and
    the quotient of two exact doubles is the double nearest to that decimal.  NaN, infinities and nulls are rounded as before."""
    scale = F.lit(10.0 ** digits)
    y = x * scale
    plain = (F.abs(y) < 1e12) & (F.abs(F.abs(y - F.floor(y)) - F.lit(0.5)) > 1e-3)
    return F.when(plain, F.floor(y + F.lit(0.5)).cast("double") / scale).otherwise(F.round(x, digits))


_EXACT = Context(prec=60, rounding=ROUND_HALF_UP)


def rounded_array(values: np.ndarray, digits: int) -> np.ndarray:
    """``rounded`` of an array of doubles: by decimals only near a half."""
    scale = 10.0 ** digits
    with np.errstate(all="ignore"):
        y = values * scale
        plain = (np.abs(y) < 1e12) & (np.abs(np.abs(y - np.floor(y)) - 0.5) > 1e-3)
        out = np.where(plain, np.floor(y + 0.5) / scale, values)
    for i in np.flatnonzero(~plain & (np.abs(values) < 1e17)):
        out[i] = float(Decimal(repr(float(values[i]))).quantize(Decimal(1).scaleb(-digits), context=_EXACT))
    return out + 0.0


def _rounded_batches(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """``df`` with the doubles of ``digits`` rounded over Arrow batches: Spark's code for that many is too long to be compiled."""
    schema = df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = []
            for name, column in zip(schema.names, batch.columns):
                if name in digits:
                    has = column.is_valid().to_numpy(zero_copy_only=False)
                    values = np.where(has, column.to_numpy(zero_copy_only=False), 0.0)
                    values = values * NUDGE if name in nudged else values
                    column = pa.array(rounded_array(values, digits[name]), mask=~has)
                columns.append(column)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    nudged = {name for name, d in digits.items() if d < 0}
    digits = {name: abs(d) for name, d in digits.items()}
    return df.mapInArrow(run, schema)


def spark_project(df: DataFrame, spec: str) -> DataFrame:
    cols, wide = [], {}
    narrow = sum(typ[0] in "dv" for _, typ in parse(spec)) <= NARROW
    for name, typ in parse(spec):
        c = F.col(f"`{name}`")
        if typ[0] in "dv":
            digits = 4 if typ == "v" else int(typ[1:]) if len(typ) > 1 else DIGITS
            c = c.cast("double")
            if narrow:
                c = rounded(c * F.lit(NUDGE) if typ == "v" else c, digits) + F.lit(0.0)
            wide[name] = -digits if typ == "v" else digits
        elif typ == "l":
            c = c.cast("long")
        elif typ == "i":
            c = c.cast("int")
        elif typ == "s":
            c = c.cast("string")
        elif typ == "b":
            c = c.cast("boolean")
        cols.append(c.alias(name))
    out = df.select(*cols)
    return out if narrow else _rounded_batches(out, wide)


def sql_project(inner: str, spec: str) -> str:
    cols = []
    for name, typ in parse(spec):
        q = f'"{name}"'
        if typ == "v":
            cols.append(f"round(CAST({q} AS DOUBLE) * {NUDGE!r}::DOUBLE, 4) + 0.0 AS {q}")
        elif typ.startswith("d"):
            cols.append(f"round(CAST({q} AS DOUBLE), {int(typ[1:]) if len(typ) > 1 else DIGITS}) + 0.0 AS {q}")
        elif typ == "l":
            cols.append(f"CAST({q} AS BIGINT) AS {q}")
        elif typ == "i":
            cols.append(f"CAST({q} AS INTEGER) AS {q}")
        elif typ == "s":
            cols.append(f"CAST({q} AS VARCHAR) AS {q}")
        elif typ == "b":
            cols.append(f"CAST({q} AS BOOLEAN) AS {q}")
        else:
            cols.append(q)
    return f"SELECT {', '.join(cols)} FROM (\n{inner}\n) AS q"

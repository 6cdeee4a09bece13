"""Chronological split and expanding time-series folds.

Only the rows at the boundaries are looked for (``nth_keys``: counts in ever narrower ranges); every other row gets
its part by comparing its time and tiebreak with them.  No row is shuffled or ranked, so a table whose rows all
share a day, or a microsecond, is no special case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from raretide.functions.timecols import ts_micros
from raretide.operators.scan import at_or_before, nth_keys, with_row_index
from raretide.session import written

# Fixed values of the reference's split.
TRAIN_RATIO = 0.7
VAL_RATIO = 0.3
N_FOLDS = 3


def _ordered(df: DataFrame, ts: str, tiebreak: str | None, write: bool = True) -> tuple[DataFrame, list[str]]:
    """``df`` with its integer order columns: time, the tiebreak, and a hash of the row for the rest; written once unless it
    is a written table already."""
    tb = [tiebreak] if tiebreak and tiebreak in df.columns else []
    d = df.withColumn("_us", ts_micros(ts)).withColumn("_h", F.shiftright(F.xxhash64(*df.columns), 2))
    if tb:
        d = d.withColumn("_tb", F.col(tb[0]).cast("long"))
    return written(d, "split") if write else d, ["_us", *(["_tb"] if tb else []), "_h"]


def _cut_at(d: DataFrame, order: list[str], positions: Sequence[int], n: int) -> list[Column]:
    """For each position whether a row is among the first so many of all ``n`` (equal rows go together)."""
    narrow = d.select(*order)
    inner = [p for p in positions if 0 < p < n]
    keys = dict(zip(inner, nth_keys(narrow, order, inner)))
    return [F.lit(p >= n) if p not in keys else at_or_before(order, keys[p]) for p in positions]


def position_buckets(df: DataFrame, firsts: list[int], n: int, ts: str = "ts", tiebreak: str | None = "row_id", name: str = "_b") -> DataFrame:
    """Add ``name``: how many of the row counts ``firsts`` (ascending) lie before the row's position by (ts, tiebreak).

    ``df`` is a written table of ``n`` rows.  Counts narrow down the cut rows; the rows themselves are only compared with
    them, never shuffled."""
    d, order = _ordered(df, ts, tiebreak, write=False)
    bucket = sum((F.when(c, 0).otherwise(1) for c in _cut_at(d, order, firsts, n)), F.lit(0))
    return d.withColumn(name, bucket.cast("int")).drop("_us", "_tb", "_h")


def chrono_split(df: DataFrame, train_ratio: float = TRAIN_RATIO, val_ratio: float = VAL_RATIO,
                 ts: str = "ts", tiebreak: str | None = "row_id", split_col: str = "split",
                 embargo_rows: int = 0) -> DataFrame:
    """First int(n*train_ratio) rows 'train', the next int(n*val_ratio) rows 'val'; the rest is dropped.

    ``embargo_rows`` > 0 drops that many train rows before the boundary (labels that look ahead);
    0 reproduces the reference.
    """
    d, order = _ordered(df, ts, tiebreak)
    n = d.select(*order).count()
    n_train = int(n * float(train_ratio))
    n_val = min(int(n * float(val_ratio)), n - n_train)
    safe, train, val = _cut_at(d, order, [n_train - embargo_rows, n_train, n_train + n_val], n)
    split = F.when(safe, F.lit("train")).when(~train & val, F.lit("val"))
    return d.withColumn(split_col, split).where(F.col(split_col).isNotNull()).drop("_us", "_tb", "_h")


def time_series_folds(df: DataFrame, n_splits: int = N_FOLDS, ts: str = "ts", tiebreak: str | None = "row_id",
                      fold_col: str = "fold", embargo_rows: int = 0) -> DataFrame:
    """Expanding-window folds: test block size n div (n_splits+1); fold i (1..n_splits) tests the i-th of the
    last n_splits blocks and trains on every earlier row.  ``fold`` = 0 for rows before the first test block.
    Train rows of fold i are ``fold < i``.

    With ``embargo_rows`` the column ``embargoed`` marks that many rows before each test block: labels that look ahead know that
    block, so fold i trains without the marked rows of fold i - 1."""
    df = written(df, "folds")
    n = df.count()
    size = n // (n_splits + 1)
    firsts = [n - (n_splits - i) * size for i in range(n_splits)] if size else []
    if not embargo_rows:
        return position_buckets(df, firsts, n, ts, tiebreak, fold_col)
    if embargo_rows >= size:
        raise ValueError(f"an embargo of {embargo_rows} rows leaves nothing of blocks of {size} rows")
    halves = position_buckets(df, [p for f in firsts for p in (f - embargo_rows, f)], n, ts, tiebreak, "_half")
    return halves.withColumns({fold_col: F.floor(F.col("_half") / 2).cast("int"), "embargoed": F.col("_half") % 2 == 1}).drop("_half")


def is_sorted_violations(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts",
                         tiebreak: str | None = "row_id") -> DataFrame:
    """Rows whose stored order (by ``tiebreak``) disagrees with time order: count of ts decreases.

    One row: ``n_rows``, ``n_decreases`` (0 = monotonic increasing in stored order).
    """
    from pyspark.sql import Window
    from raretide.operators.scan import row_block_halo
    keys = list(keys)
    d = df.withColumn("_us", F.col(tiebreak).cast("long"))
    d = with_row_index(d, keys, "_us", None, bucket_us=65_536, name="rn")   # buckets of 65,536 ids
    d = row_block_halo(d, "rn", 65_536, before=1)
    prev = F.lag(ts, 1).over(Window.partitionBy(*keys, "_hb").orderBy("rn"))
    d = d.withColumn("_dec", (prev > F.col(ts)).cast("int")).where("_home")
    return d.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("_dec"), F.lit(0)).cast("long").alias("n_decreases"))

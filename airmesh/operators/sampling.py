"""Deterministic sampling, train/test split and cross-validation folds.

``DataFrame.sample`` / ``randomSplit`` depend on how rows are laid out in
partitions, so the same seed gives different rows after a repartition.  Here
every decision is integer arithmetic on a bigint key, identical in any
engine and any layout.  Keys are first reduced modulo the hash modulus so the
products stay far below 2**63 (no ANSI overflow at any key size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: split / fold hash parameters and workload constants ---
SPLIT_MULTIPLIER = 1103515245
SPLIT_INCREMENT = 12345
SPLIT_MODULUS = 2147483647  # 2**31 - 1, a prime: every digit of the hash depends on the whole key
SAMPLE_MODULUS = 2147483648  # 2**31
FOLD_MULTIPLIER = 69069
FOLD_SCALE = 7919
FOLD_MODULUS = 2147483647  # 2**31 - 1
TRAIN_BUCKETS = 7  # of 10 → 70 / 30
NUM_FOLDS = 5
SAMPLE_TARGET = 500_000
HISTOGRAM_BUCKETS = 65536
# --- end fixed values ---


def _key(key) -> Column:
    return (F.col(key) if isinstance(key, str) else key).cast("long")


def split_hash(key) -> Column:
    """``(key * 1103515245 + 12345) mod (2**31 - 1)`` without overflow."""
    k = F.pmod(_key(key), F.lit(SPLIT_MODULUS))
    return F.pmod(k * F.lit(SPLIT_MULTIPLIER) + F.lit(SPLIT_INCREMENT), F.lit(SPLIT_MODULUS))


def sample_hash(key) -> Column:
    """The sampler's hash, in [0, 2**31); only its order (its high digits) is used."""
    k = F.pmod(_key(key), F.lit(SAMPLE_MODULUS))
    return F.pmod(k * F.lit(SPLIT_MULTIPLIER) + F.lit(SPLIT_INCREMENT), F.lit(SAMPLE_MODULUS))


def unit_hash(key) -> Column:
    """Uniform-looking value in [0, 1) from the key."""
    return sample_hash(key).cast("double") / F.lit(float(SAMPLE_MODULUS))


def is_train(key, train_buckets: int = TRAIN_BUCKETS) -> Column:
    return F.pmod(split_hash(key), F.lit(10)) < F.lit(train_buckets)


def fold_of(key, folds: int = NUM_FOLDS) -> Column:
    """Fold id from a second, independent hash (reusing the split hash skews folds)."""
    k = F.pmod(_key(key), F.lit(FOLD_MODULUS))
    h = F.pmod(F.pmod(k * F.lit(FOLD_MULTIPLIER) + F.lit(1), F.lit(FOLD_MODULUS)) * F.lit(FOLD_SCALE),
               F.lit(FOLD_MODULUS))
    return F.pmod(h, F.lit(folds)).cast("int")


def train_test_split(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    flag = is_train(key)
    return df.filter(flag), df.filter(~flag)


def sample_to_target(df: DataFrame, key: str, target: int = SAMPLE_TARGET) -> DataFrame:
    """Keep about ``target`` rows: fraction ``min(1, target / count)`` by key hash,
    then at most ``target`` rows in (hash, key) order.

    The cap is a cutoff on the hash, found from two histograms of at most
    ``HISTOGRAM_BUCKETS`` rows, so the result is a filter over the table's own
    partitions.  Only rows whose hash equals the cutoff are ever ordered.
    """
    if target <= 0:
        return df.limit(0)
    coarse = SAMPLE_MODULUS // HISTOGRAM_BUCKETS
    h = sample_hash(key)
    counts = {r["b"]: r["n"] for r in df.groupBy(F.floor(h / coarse).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if total <= target:
        return df
    fraction = target / total
    kept = df.filter(unit_hash(key) < F.lit(fraction))
    # the bucket in which the target is passed, then the hash; rows without a key hash to null and go
    passed, bucket = _passed({b: n for b, n in counts.items() if b is not None}, target)
    if bucket is None:
        return kept
    fine = df.filter(F.floor(h / coarse) == bucket).groupBy(h.alias("h")).agg(F.count(F.lit(1)).alias("n")).collect()
    more, cutoff = _passed({r["h"]: r["n"] for r in fine}, target - passed)
    ties = kept.filter(h == cutoff).orderBy(key).limit(target - passed - more)
    return kept.filter(h < cutoff).unionByName(ties)


def _passed(counts: dict, target: int) -> tuple[int, int | None]:
    """Rows before, and the first value at which the running count exceeds ``target``."""
    before = 0
    for value in sorted(counts):
        if before + counts[value] > target:
            return before, value
        before += counts[value]
    return before, None

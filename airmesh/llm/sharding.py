"""A uniform shuffle of a corpus into shards of exact sizes.

With n_i rows in input partition i and exact shard sizes m_j (at most one
apart), the counts that go from i to j under a uniform permutation follow a
multivariate hypergeometric law; they are drawn on the driver (partitions x
shards numbers).  Each partition then deals its rows out by a random
arrangement of its row of that matrix, the exchange brings the rows together,
and a keyed permutation of 0..m_j-1 (a Feistel network, stepped until it lands
inside) places each shard's arrivals once more.  So every row has its shard
and its slot before the exchange, which is one shuffle to partitions of equal
row counts: no sort, no window, no task that holds a shard.

The draws are fixed by the seed, the partitions' numbers and their row counts.
The input is written once, each row with its partition and its place there;
counts and deal read that table, however a later scan cuts its files.

Defined results: the law is ``rows``, whatever the texts; equal texts are
placed independently (a group may hold a third of all rows, more than a shard);
null ids and texts and repeated rows are rows like any other; with fewer rows
than shards the last shards are empty; an empty table gives an empty result.
Columns of the input are kept; one that is called shard or slot is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import map_rows, stored

SEED = 40_503
ROUNDS = 6
_ROW = "_scan_row"
#: Bits of a row's place in its partition, in the ids that Spark gives; those above name the partition.
PLACE_BITS = 33
#: Rows of an output partition of the exchange, about.
PART_ROWS = 50_000
#: Standard deviations either way that a drawn count may lie from its mean.
SPREADS = 40


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Sizes at most one apart."""
    return np.array([rows // shards + (j < rows % shards) for j in range(shards)], np.int64)


def communication_matrix(counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(partitions, shards) row counts with exact sums both ways, under a uniform permutation."""
    rng, left = np.random.default_rng(seed), shard_sizes(int(counts.sum()), shards)
    out = np.zeros((len(counts), shards), np.int64)
    for i, n in enumerate(counts):
        # numpy's "marginals" method takes less than 10**9 rows in all
        out[i] = rng.multivariate_hypergeometric(left, int(n), method="marginals") if left.sum() < 10 ** 9 else _by_halves(rng, left, int(n))
        left -= out[i]
    return out


def _by_halves(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """One draw for totals past numpy's limit: the shards are split in two, again and again."""
    if len(left) == 1:
        return np.array([n], np.int64)
    half = len(left) // 2
    first = hypergeometric(rng, int(left[:half].sum()), int(left[half:].sum()), n)
    return np.concatenate((_by_halves(rng, left[:half], first), _by_halves(rng, left[half:], n - first)))


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` rows drawn without return are among ``good`` of ``good + bad``, by inversion.

    Neighbouring counts' probabilities have a plain ratio.  The sums of its
    logarithms over all counts within ``SPREADS`` standard deviations give the
    law itself; any count further off is too unlikely for a double to tell from 0.
    """
    least, most = max(0, n - bad), min(n, good)
    share = good / max(1, good + bad)
    around = SPREADS * (math.sqrt(n * share * (1 - share) * (good + bad - n) / max(1, good + bad - 1)) + 1)
    low, high = max(least, math.floor(n * share - around)), min(most, math.ceil(n * share + around))
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    logs = np.concatenate(([0.0], np.cumsum(steps)))
    sums = np.cumsum(np.exp(logs - logs.max()))
    return low + min(int(np.searchsorted(sums, rng.random() * sums[-1], side="right")), high - low)


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """Keyed bits of x: the finaliser of a 64-bit mixing generator over x plus a spread key."""
    x = x + np.uint64((key * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """The images of ``index`` under a keyed permutation of 0..size-1."""
    bits = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask, out = np.uint64((1 << bits) - 1), index.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right = out[todo] >> np.uint64(bits), out[todo] & mask
            for r in range(ROUNDS):
                left, right = right, left ^ (_mix(right, key * ROUNDS + r) & mask)
            out[todo] = (left << np.uint64(bits)) | right
            todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def shard_rows(docs: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """``docs`` with columns shard (0..shards-1) and slot (0.. within the shard), exchanged to that order."""
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    # numbered names meanwhile: those of the input may hold dots, or be this operator's own
    names, docs = docs.columns, docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    rows = stored(docs.withColumn(_ROW, F.monotonically_increasing_id()), "shard-rows")
    tallies = rows.select(F.shiftright(_ROW, PLACE_BITS).alias("part")).groupBy("part").count().collect()
    counts = np.zeros(max((r["part"] for r in tallies), default=-1) + 1, np.int64)
    for r in tallies:
        counts[r["part"]] = r["count"]
    total = int(counts.sum())
    sizes = shard_sizes(total, shards)
    matrix = communication_matrix(counts, shards, seed)
    plan = spark.sparkContext.broadcast((matrix, np.cumsum(matrix, 0) - matrix))
    before = np.cumsum(sizes) - sizes
    parts = max(shards, -(-total // PART_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def arranged(part: int) -> tuple[np.ndarray, np.ndarray]:
        """Shard and slot of each place of a written partition."""
        to, first = plan.value[0][part], plan.value[1][part]
        targets = np.random.default_rng([seed, part]).permutation(np.repeat(np.arange(shards), to))
        slots = np.zeros(len(targets), np.int64)
        for j in np.flatnonzero(to):
            slots[targets == j] = permuted(first[j] + np.arange(to[j]), int(sizes[j]), seed * shards + int(j))
        return targets.astype(np.int32), slots

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = -1, None
        for batch in batches:
            ids = batch.column(_ROW).to_numpy()
            of, places = ids >> PLACE_BITS, ids & ((1 << PLACE_BITS) - 1)
            own, slots = np.zeros(len(ids), np.int32), np.zeros(len(ids), np.int64)
            for part in np.unique(of).tolist():
                if part != last:
                    last, known = part, arranged(part)
                at = np.flatnonzero(of == part)
                own[at], slots[at] = known[0][places[at]], known[1][places[at]]
            yield batch.drop_columns([_ROW]).append_column("shard", pa.array(own)).append_column("slot", pa.array(slots))

    # as types, not as text: names of fields may hold anything
    dealt = map_rows(rows, deal, StructType([*docs.schema.fields, StructField("shard", IntegerType()), StructField("slot", LongType())]))
    # the place in the whole shuffled order says which of equal parts a row goes to
    place = F.element_at(F.array(*(F.lit(int(b)) for b in before)), F.col("shard") + 1) + F.col("slot")
    part = F.floor(place * F.lit(parts) / F.lit(max(total, 1))).cast("int")
    return dealt.repartitionById(parts, part).toDF(*names, "shard", "slot")

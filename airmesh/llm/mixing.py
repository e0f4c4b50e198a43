"""Mixing sources to target weights, block by block, in DataFrame operations only.

Each source is a stream of words cut into blocks of ``BLOCK_WORDS``; the mix is
a sequence of output slots in shards of ``SHARD_SLOTS``, each slot one block.

* Targets: the sources, in code point order (null last), weigh 1, 2, 3 and
  again; they share all words by weight.  No target exceeds ``MOST_EPOCHS``
  times its source's words; the excess is shared anew by weight.
* Source counts of the output shards are multinomial draws, conditioned on each
  source's total: all draws are dealt to the mix's slots by one keyed permutation
  and counted per (shard, source) (``shard_counts``).  So every shard is a random
  draw at the target weights and every source meets its target to within a block.
  The counts decide what follows: a shard's share of a source are that many draws
  of it, numbered on from the shards before, and get permuted slots of the shard.
* A source's k-th draw takes block p(k mod blocks), with p a keyed permutation
  of the source's block numbers, another one for each pass over it.  So no
  block is taken more than ``MOST_EPOCHS`` times, none twice before all once.
* Slots and blocks are joined by (source, block), a key of one block and at
  most ``MOST_EPOCHS`` slots: a hot source is spread over all tasks.

Word positions in a source come from two-level prefix sums: documents are dealt
into chunks by a hash of the row, chunks are totalled, and only a chunk's rows
(about ``CHUNK_ROWS``) are ever ordered together.  Rows that are equal in every
column are interchangeable and are numbered within their chunk.

Defined results: null texts and texts without words have size 0 and take 0; a
null source is a source (the last); repeated rows each keep their row; other
columns are left out by ``mix_documents``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, free_name, stored

BLOCK_WORDS = 32
SHARD_SLOTS = 4096
MOST_EPOCHS = 3
CHUNK_ROWS = 5_000
SEED = 17
#: Sources whose targets may be broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 100_000
_ROW = "_scan_row"
#: Steps of a permutation until it lands inside its range; the chance of more is under 1e-20.
MOST_STEPS = 40


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def permuted(index: Column, size: Column, *key: Column) -> Column:
    """The image of ``index`` under a keyed permutation of 0..size-1.

    A Feistel network on a x b numbers (a * b barely above size), stepped on
    until it lands below size.
    """
    a = F.ceil(F.sqrt(size.cast("double"))).cast("long")
    b = F.ceil(size / a).cast("long")

    def step(x: Column) -> Column:
        left, right = F.floor(x / b).cast("long"), x % b
        for r in range(3):
            if r % 2 == 0:
                left = F.pmod(left + F.pmod(F.xxhash64(right, F.lit(2 * r + 1), *key), a), a)
            else:
                right = F.pmod(right + F.pmod(F.xxhash64(left, F.lit(2 * r + 1), *key), b), b)
        return left * b + right

    first = step(index)
    landed = F.aggregate(F.sequence(F.lit(2), F.lit(MOST_STEPS)), first,
                         lambda x, _: F.when(x < size, x).otherwise(step(x)))
    return F.when(size <= 1, F.lit(0).cast("long")).when(first < size, first).otherwise(
        F.when(landed < size, landed).otherwise(F.raise_error(F.lit("a permutation left its range")).cast("long")))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from ``sizes`` (source, size), all of it in Spark.

    Water-filling: with capacity per weight c = 3 * size / weight, a source is
    full if c is at most the level of the water.  In the order of c, the level
    after the first k are full is (all - their capacity) / weight of the rest.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source; byte order of UTF-8 is code point order
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weighed = by_source.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1)
    whole = Window.partitionBy()
    by_room = Window.orderBy(F.col("room"), F.col("source").isNull(), F.col("source")).rowsBetween(Window.unboundedPreceding, -1)
    filled = (weighed.withColumn("capacity", F.col("source_size") * MOST_EPOCHS)
              .withColumn("room", F.col("capacity") / F.col("weight"))
              .withColumn("total", F.sum("source_size").over(whole).cast("double"))
              .withColumn("weights", F.sum("weight").over(whole))
              .withColumn("before", F.coalesce(F.sum("capacity").over(by_room), F.lit(0)))
              .withColumn("weight_before", F.coalesce(F.sum("weight").over(by_room), F.lit(0)))
              .withColumn("level", (F.col("total") - F.col("before")) / (F.col("weights") - F.col("weight_before")))
              # full sources come first; the level of the first that is not full is the level of all the rest
              .withColumn("open_level", F.min(F.when(F.col("room") > F.col("level"), F.struct("room", "level"))).over(whole)["level"]))
    target = F.when(F.col("open_level").isNull() | (F.col("room") <= F.col("level")), F.col("capacity").cast("double")).otherwise(
        F.col("open_level") * F.col("weight"))
    return filled.select("source", "source_size", F.least(target, F.col("capacity").cast("double")).alias("target"))


def placed_documents(docs: DataFrame, *also: str) -> DataFrame:
    """``docs`` (doc_id, text, source) with size, and first: the words of its source before it.

    Columns: doc_id, source, size, chunk, place, first and ``also``; (chunk,
    source, place) names a row.
    """
    rows = docs.count()
    chunks = max(1, -(-rows // CHUNK_ROWS))
    sized = docs.select(
        "doc_id", "source", n_words(F.col("text")).alias("size"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), *also)
    sized = sized.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_key", F.lit(SEED)), F.lit(chunks)))
    own = Window.partitionBy("chunk", "source").orderBy("doc_id", "text_key", "size")
    sized = (sized.withColumn("place", F.row_number().over(own))
             .withColumn("within", F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")))
    return stored(sized, "mix-documents")


def with_offsets(placed: DataFrame) -> DataFrame:
    totals = placed.groupBy("source", "chunk").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    return (placed.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
            .withColumn("first", F.col("offset") + F.col("within")).drop("s", "c", "offset", "within"))


def source_draws(targets: DataFrame) -> DataFrame:
    """(source, blocks, draws, first_draw, all_draws): how many blocks the mix draws of each source."""
    drawn = targets.filter("source_size > 0").select(
        "source", F.ceil(F.col("source_size") / BLOCK_WORDS).cast("long").alias("blocks"),
        F.col("target"), F.col("source_size"))
    drawn = drawn.withColumn("draws", F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"), F.col("blocks") * MOST_EPOCHS))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    return drawn.filter("draws > 0").select(
        "source", "blocks", "draws", (F.sum("draws").over(order) - F.col("draws")).alias("first_draw"),
        F.sum("draws").over(Window.partitionBy()).alias("all_draws"))


def shard_counts(draws: DataFrame, seed: int = SEED) -> DataFrame:
    """(source, blocks, shard, count, first, place, slots): each output shard's draws of each source.

    first: the source's draws in the shards before; place: the shard's draws of
    the sources before; slots: all of the shard's.
    """
    # draws are made in runs, so that a hot source's are spread before they are many
    runs = draws.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("draws") - 1) / SHARD_SLOTS).cast("long"))))
    # few small rows that become many: a fixed number of partitions keeps AQE from making one of them
    runs = runs.repartition(int(draws.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source", "run")
    each = runs.withColumn("draw", F.explode(F.sequence(
        F.col("run") * SHARD_SLOTS, F.least(F.col("run") * SHARD_SLOTS + SHARD_SLOTS, F.col("draws")) - 1)))
    slot = permuted(F.col("first_draw") + F.col("draw"), F.col("all_draws"), F.lit(seed + 1))
    counts = stored(each.select("source", "blocks", F.floor(slot / SHARD_SLOTS).cast("long").alias("shard"))
                    .groupBy("source", "blocks", "shard").agg(F.count(F.lit(1)).alias("count"))
                    .withColumn("stretch", F.floor(F.col("shard") / SHARD_SLOTS).cast("long")), "mix-counts")
    # two levels: shards are summed in stretches, so that no window holds a hot source's every shard
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    stretches = counts.groupBy("source", "stretch").agg(F.sum("count").alias("held")).select(
        F.col("source").alias("s"), F.col("stretch").alias("t"),
        F.coalesce(F.sum("held").over(before(Window.partitionBy("source").orderBy("stretch"))), F.lit(0)).alias("offset"))
    within = F.coalesce(F.sum("count").over(before(Window.partitionBy("source", "stretch").orderBy("shard"))), F.lit(0))
    own = Window.partitionBy("shard")
    return (counts.withColumn("within", within)
            .join(stretches, F.col("source").eqNullSafe(F.col("s")) & (F.col("stretch") == F.col("t")))
            .withColumn("first", F.col("offset") + F.col("within"))
            .withColumn("place", F.coalesce(F.sum("count").over(before(own.orderBy(F.col("source").isNull(), F.col("source")))), F.lit(0)))
            .withColumn("slots", F.sum("count").over(own))
            .select("source", "blocks", "shard", "count", "first", "place", "slots"))


def mix_slots(targets: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix: (source, block, epoch, slot, shard), one row per output slot, made from the shards' source counts."""
    counts = shard_counts(source_draws(targets), seed)
    # a row is at most a shard's slots; a fixed number of partitions again
    counts = counts.repartition(int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source", "shard")
    each = counts.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)))
    draw = F.col("first") + F.col("k")
    each = each.withColumn("draw", draw).withColumn("epoch", F.floor(draw / F.col("blocks")).cast("int")).withColumn(
        "source_key", F.xxhash64(F.coalesce("source", F.lit("\x00"))))
    block = permuted(F.col("draw") % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("source_key"), F.col("epoch"))
    slot = F.col("shard") * SHARD_SLOTS + permuted(F.col("place") + F.col("k"), F.col("slots"), F.lit(seed + 2), F.col("shard"))
    return each.select("source", block.alias("block"), "epoch", slot.alias("slot"), "shard")


def block_pieces(placed: DataFrame) -> DataFrame:
    """(chunk, source, place, block, words, at): what each document has in each block; at: its first word there."""
    last = F.col("first") + F.col("size")
    blocks = placed.filter("size > 0").select(
        "chunk", "source", "place", "first", last.alias("last"),
        F.explode(F.sequence(F.floor(F.col("first") / BLOCK_WORDS).cast("long"), F.floor((last - 1) / BLOCK_WORDS).cast("long"))).alias("block"))
    start = F.greatest(F.col("first"), F.col("block") * BLOCK_WORDS)
    words = F.least(F.col("last"), (F.col("block") + 1) * BLOCK_WORDS) - start
    return blocks.select("chunk", "source", "place", "block", words.alias("words"), (start - F.col("first")).alias("at"))


def taken_pieces(placed: DataFrame, targets: DataFrame) -> DataFrame:
    """Pieces of documents joined with the slots that take their blocks."""
    slots = mix_slots(targets).withColumnRenamed("source", "s").withColumnRenamed("block", "b")
    pieces = block_pieces(placed)
    # the planner takes exploded rows for as few as they came from: no broadcast here, at any size
    return pieces.hint("merge").join(slots.hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).drop("s", "b")


def mix_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_slot, last_shard) of every row of ``docs`` (doc_id, text, source).

    first_slot and last_shard: the first slot of the mix and the last output
    shard that hold words of the row; null if none does.
    """
    placed = placed_documents(docs)
    targets = stored(source_targets(placed), "mix-targets")
    own = ("chunk", "source", "place")
    taken = taken_pieces(with_offsets(placed), targets).groupBy(*own).agg(
        F.sum("words").alias("took"), F.min("slot").alias("first_slot"), F.max("shard").alias("last_shard"))
    taken = taken.select(*(F.col(c).alias(f"t_{c}") for c in own), "took", "first_slot", "last_shard")
    rows = placed.join(taken.hint("merge"), F.col("source").eqNullSafe(F.col("t_source")) & (F.col("chunk") == F.col("t_chunk"))
                       & (F.col("place") == F.col("t_place")), "left")
    known = targets.withColumnRenamed("source", "g")
    return (rows.join(F.broadcast(known) if known.count() <= BROADCAST_SOURCES else known, F.col("source").eqNullSafe(F.col("g")))
            .select("doc_id", "size", "source_size", "target", F.coalesce("took", F.lit(0)).cast("long").alias("taken"),
                    "first_slot", "last_shard"))


def mixed_texts(docs: DataFrame) -> DataFrame:
    """The mix as documents: a row of ``docs`` for each pass that takes words of it, all its columns.

    Its text holds the words that the pass takes: the text as it is if that is
    all of them, else those of the taken blocks, in order, with single blanks.
    ``n_chars``, where it is a column, follows the text.  Rows without words are
    in no mix.
    """
    row, other, whole, pieces = (free_name(docs, f"_mix_{c}") for c in ("row", "other", "whole", "pieces"))
    # written once: another scan may cut the files otherwise, and number the rows anew
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    placed = placed_documents(numbered.select("doc_id", "source", "text", F.col(row).alias(_ROW)), _ROW)
    targets = stored(source_targets(placed), "mix-targets")
    own = ("chunk", "source", "place")
    taken = taken_pieces(with_offsets(placed), targets).groupBy(*own, "epoch").agg(
        F.sum("words").alias("took"), F.array_sort(F.collect_list(F.struct("at", "words"))).alias("pieces"))
    taken = taken.select(*(F.col(c).alias(f"t_{c}") for c in own), "epoch", "took", "pieces")
    rows = placed.hint("merge").join(
        taken.hint("merge"), F.col("source").eqNullSafe(F.col("t_source")) & (F.col("chunk") == F.col("t_chunk")) & (F.col("place") == F.col("t_place")))
    rows = rows.select(F.col(_ROW).alias(other), (F.col("took") == F.col("size")).alias(whole), F.col("pieces").alias(pieces))
    mixed = numbered.hint("merge").join(rows.hint("merge"), F.col(row) == F.col(other))
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    # the words are bound once; named inside the inner function they would be cut again for each piece
    parts = F.transform(F.array(words), lambda w: F.flatten(
        F.transform(pieces, lambda p: F.slice(w, (p["at"] + 1).cast("int"), p["words"].cast("int")))))[0]
    mixed = mixed.withColumn("text", F.when(F.col(whole), F.col("text")).otherwise(F.array_join(parts, " ")))
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return mixed.select(*(F.col(f"`{c}`") for c in docs.columns))

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from airmesh.llm import mixing, ngramjoin, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets_by_hand(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, full = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full) or 1
        target = {s: 3 * sizes[s] if s in full else left * weight[s] / open_weight for s in order}
        over = {s for s in order if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_native_permutation(spark, n):
    got = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3))).collect()]
    assert sorted(got) == list(range(n))


def test_mix_meets_its_targets(docs, odd):
    for table in (docs, odd):
        rows = table.collect()
        sizes = Counter()
        for r in rows:
            sizes[r.source] += len(WORD.findall(r.text or ""))
        by_hand = targets_by_hand(sizes)
        source = {(r.doc_id, len(WORD.findall(r.text or ""))): r.source for r in rows if r.doc_id is not None}
        got = mixing.mix_documents(table).collect()
        assert Counter((g.doc_id, g.size) for g in got) == Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in rows)
        assert all(0 <= g.taken <= 3 * g.size for g in got)
        assert sorted({round(g.target, 6) for g in got}) == sorted({round(float(t), 6) for t in by_hand.values()})
        assert all(g.source_size == sizes[source[g.doc_id, g.size]] for g in got if g.doc_id is not None)
    source_of = {r.doc_id: r.source for r in docs.collect()}
    taken, target = Counter(), {}
    for g in mixing.mix_documents(docs).collect():
        taken[source_of[g.doc_id]] += g.taken
        target[source_of[g.doc_id]] = g.target
    # to within rounding to blocks and the last, shorter block's passes
    assert all(abs(taken[s] - target[s]) <= 3 * mixing.BLOCK_WORDS for s in target)


def test_mix_is_the_same_again(docs):
    rows = lambda: sorted(map(tuple, mixing.mix_documents(docs).collect()))
    assert rows() == rows()


def test_shard_counts_decide_the_mix(spark, docs, monkeypatch):
    """Counts add up to the draws, slots follow the counts, and takings equal a mix made by hand from the slots."""
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 64)
    placed = mixing.placed_documents(docs)
    targets = mixing.source_targets(placed)
    draws = {r.source: r for r in mixing.source_draws(targets).collect()}
    counts = mixing.shard_counts(mixing.source_draws(targets)).collect()
    slots = mixing.mix_slots(targets).collect()
    total = sum(d.draws for d in draws.values())
    assert Counter({s: d.draws for s, d in draws.items()}) == sum((Counter({c.source: c["count"]}) for c in counts), Counter())
    assert Counter((c.source, c.shard) for c in counts for _ in range(c["count"])) == Counter((s.source, s.shard) for s in slots)
    assert sorted(s.slot for s in slots) == list(range(total)) and all(s.slot // 64 == s.shard for s in slots)
    for source, d in draws.items():  # every block once before any twice
        taken = Counter(s.block for s in slots if s.source == source)
        assert len(taken) == min(d.blocks, d.draws) and max(taken.values()) == -(-d.draws // d.blocks)
    # counts scatter as draws without replacement do: chi-square over the shards that are full
    full = total // 64
    expected = {s: 64 * d.draws / total for s, d in draws.items()}
    held = {(c.source, c.shard): c["count"] for c in counts}
    chi = sum((held.get((s, j), 0) - e) ** 2 / e for s, e in expected.items() for j in range(full))
    free = (len(expected) - 1) * (full - 1)
    assert abs(chi - free) < 5 * math.sqrt(2 * free)
    # by hand: sources as word streams, cut into blocks, slot by slot
    took, first_slot = Counter(), {}
    rows = mixing.with_offsets(placed).collect()
    owner = {(r.source, r.first + i): (r.doc_id, r.source) for r in rows for i in range(r.size)}
    for s in slots:
        for w in range(s.block * mixing.BLOCK_WORDS, (s.block + 1) * mixing.BLOCK_WORDS):
            if doc := owner.get((s.source, w)):
                took[doc[0]] += 1
                first_slot[doc[0]] = min(first_slot.get(doc[0], s.slot), s.slot)
    for g in mixing.mix_documents(docs).collect():
        assert (g.taken, g.first_slot) == (took[g.doc_id], first_slot.get(g.doc_id))


def test_small_sources_are_capped(spark):
    rows = [(i, "w " * 500, "a") for i in range(50)] + [(100, "x y z", "b"), (101, "only", "c"), (102, None, "c"), (103, "", None)]
    got = mixing.mix_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by_id = {g.doc_id: g for g in got}
    assert by_id[100].target == 9 and by_id[100].taken == 9 and by_id[101].taken == 3 and by_id[102].taken == 0
    assert by_id[103].target == 0 and by_id[103].source_size == 0


def test_mixed_texts_hold_the_taken_words(docs):
    taken = Counter()
    for g in mixing.mix_documents(docs).collect():
        taken[g.doc_id] += g.taken
    mixed = mixing.mixed_texts(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
    assert words == Counter({k: v for k, v in taken.items() if v})


def test_mix_of_nothing(empty):
    assert mixing.mix_documents(empty).collect() == [] and mixing.mixed_texts(empty).collect() == []


def test_shards_are_exact(docs, odd, empty):
    for table, shards in ((docs, 40), (docs.repartition(7), 3), (odd, 40), (empty, 40)):
        n = table.count()
        got = sharding.shard_rows(table, shards)
        assert set(table.columns) <= set(got.columns)
        rows = got.collect()
        slots = defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
        sizes = sharding.shard_sizes(n, shards)
        assert all(sorted(slots[j]) == list(range(sizes[j])) for j in range(shards))
        key = lambda r: (r.doc_id, r.text)
        assert Counter(map(key, rows)) == Counter(map(key, table.collect()))


def test_communication_matrix_sums():
    counts = np.array([0, 5, 1000, 37, 0, 1])
    for seed in range(5):
        m = sharding.communication_matrix(counts, 7, seed)
        assert (m.sum(1) == counts).all() and (m.sum(0) == sharding.shard_sizes(int(counts.sum()), 7)).all() and (m >= 0).all()
    left = np.array([600_000_000, 500_000_000, 400_000_001])
    assert sharding._by_halves(np.random.default_rng(1), left, 700_000_000).sum() == 700_000_000


def test_counts_follow_the_hypergeometric_law():
    rng = np.random.default_rng(5)
    for good, bad, n in ((3, 4, 5), (10, 1, 6), (1, 30, 2), (0, 5, 3), (4, 0, 2), (50, 70, 40)):
        all_ways, draws = math.comb(good + bad, n), 4000
        got = Counter(sharding.hypergeometric(rng, good, bad, n) for _ in range(draws))
        for k in range(n + 1):
            p = math.comb(good, k) * math.comb(bad, n - k) / all_ways
            assert abs(got[k] - draws * p) <= 5 * math.sqrt(draws * p * (1 - p)) + 1e-9
    # past numpy's limit: few rows of many, and mean and spread of many
    assert Counter(sharding.hypergeometric(rng, 3 * 10 ** 9, 10 ** 9, 1) for _ in range(4000))[1] == pytest.approx(3000, abs=140)
    many = np.array([sharding.hypergeometric(rng, 10 ** 10, 3 * 10 ** 10, 10 ** 6) for _ in range(400)])
    assert abs(many.mean() - 250_000) < 120 and 380 < many.std() < 490
    left = np.array([10 ** 9] * 40)
    assert sharding._by_halves(rng, left, 7).sum() == 7


def test_every_place_is_as_likely():
    hits = Counter(int(sharding.permuted(np.array([0]), 10, key)[0]) for key in range(2000))
    assert set(hits) == set(range(10)) and max(hits.values()) < 300


@pytest.fixture()
def other_splits(spark):
    """Call it, and later scans cut their files otherwise, as they do when an executor has gone."""
    key = "spark.sql.files.maxPartitionBytes"
    was = spark.conf.get(key)
    yield lambda *_: spark.conf.set(key, "20000")
    spark.conf.set(key, was)


def test_rows_keep_their_names_when_later_scans_are_cut_otherwise(docs, other_splits, monkeypatch):
    whole = Counter(ngramjoin.one_of_each_group(docs).collect()), Counter(mixing.mixed_texts(docs).collect())
    dealt = sharding.shard_rows(docs, 7)
    for module in (ngramjoin, mixing):
        plain = module.stored
        monkeypatch.setattr(module, "stored", lambda df, name, plain=plain: (plain(df, name), other_splits())[0])
    assert Counter(ngramjoin.one_of_each_group(docs).collect()) == whole[0]
    docs.sparkSession.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert Counter(mixing.mixed_texts(docs).collect()) == whole[1]
    other_splits()
    assert Counter(r[:-2] for r in dealt.collect()) == Counter(tuple(r) for r in docs.collect())

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from airmesh.llm import decontam, langid, toxicity, urlfilter
from airmesh.llm.common import id_fold
from airmesh.llm.queries import table

from ..conftest import SF_ORACLE

# ---------------------------------------------------------------- decontamination


def holds(item, text, most):
    """Whether a stretch of the text is within ``most`` edits of the item, by the plain recurrence."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for word in text:
        new = [0]
        for i, own in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (own != word)))
        row = new
        best = min(best, row[-1])
    return best <= most


@pytest.fixture(scope="module")
def leaks(spark):
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [[rnd.choice(vocabulary) for _ in range(rnd.randrange(12, 60))] for _ in range(30)]
    texts, planted = [], set()
    for i in range(120):
        own = [rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 300))]
        if i % 2:
            n = rnd.randrange(len(items))
            leak = list(items[n])
            for _ in range(rnd.randrange(decontam.edits_allowed(len(leak)) + 1)):
                at = rnd.randrange(len(leak))
                rnd.choice((lambda: leak.insert(at, "new"), lambda: leak.pop(at), lambda: leak.__setitem__(at, "other")))()
            at = rnd.randrange(len(own) + 1)
            own[at:at] = leak
            planted.add((i, n))
        texts.append((i, " ".join(w.upper() + "," if rnd.random() < 0.2 else w for w in own)))
    return (spark.createDataFrame(texts, "doc_id long, text string"),
            spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(98, None), (99, "too short")], "item_id long, text string"),
            planted)


def test_leaks_are_found_and_verified(leaks):
    docs, benchmark, planted = leaks
    items = {r.item_id: decontam.words_of(r.text) for r in benchmark.collect()}
    exact = {(r.doc_id, i) for r in docs.collect() for i, item in items.items()
             if item and holds(item, decontam.words_of(r.text), decontam.edits_allowed(len(item)))}
    found = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, benchmark).collect()}
    assert planted <= exact and found <= exact
    assert len(found) >= 0.98 * len(exact)


def test_blocks_of_items_find_as_much(leaks, monkeypatch):
    """Codes of words, and so the walks, differ by block: what is found near the edit bound may, how much of it not."""
    docs, benchmark, planted = leaks
    pairs = lambda: {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, benchmark).collect()}
    whole = pairs()
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 7)
    parts = pairs()
    assert len(parts & planted) >= 0.95 * len(planted) and len(whole & planted) >= 0.95 * len(planted)
    assert len(parts & whole) >= 0.9 * len(parts | whole)


def test_short_and_unspaced_items_are_found(spark):
    # fixed values: invented items in two scripts, one word, two words
    long_item = "测试数据集中的问题是关于山和水的故事"
    benchmark = spark.createDataFrame([(1, long_item), (2, "山水"), (3, "Zyxwv!"), (4, "red Fox"), (5, "?!"), (6, ""), (7, None)], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "前言" + long_item + "。后记"), (2, "前" + long_item[:9] + "新" + long_item[10:]), (3, "山、水"),
        (4, "he said: zyxwv, twice: zyxwv"), (5, "a red, fox"), (6, "red and fox, zyxwvu"), (7, long_item[:8]), (8, ""), (9, None), (10, "fox")],
        "doc_id long, text string")
    found = {(r.doc_id, r.item_id): (r.edits, r.first_word) for r in decontam.find_leaks(docs, benchmark).collect()}
    assert found == {(1, 1): (0, 2), (2, 1): (1, 1), (4, 3): (0, 2), (5, 4): (0, 1)} | {(3, 2): (0, 0)}
    assert {r.doc_id for r in decontam.without_leaks(docs, benchmark).collect()} == {6, 7, 8, 9, 10}


def test_windows_in_blocks_find_the_same(monkeypatch):
    rnd = random.Random(8)
    items = [(n, " ".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(1, 40)))) for n in range(40)]
    text = decontam.words_of(" ".join(" ".join((x, "new")) for _, x in rnd.sample(items, 30)))
    index = decontam.ItemIndex(items)
    codes = np.array([index.codes.get(w, 0) for w in text], np.int64)
    whole = index.matches(codes)
    monkeypatch.setattr(decontam, "WINDOW_CELLS", 200)
    parts = index.matches(codes)
    assert {n: m[0] for n, m in parts.items()} == {n: m[0] for n, m in whole.items()} and len(whole) >= 30


def test_windows_that_hold_no_item_are_not_walked(monkeypatch):
    """Pieces of many items of one length: any window holds many of their word pairs, but few of any one item."""
    rnd = random.Random(4)
    items = [(n, " ".join(f"w{n}x{k}" for k in range(20))) for n in range(30)]
    pieces = [" ".join(items[rnd.randrange(30)][1].split()[4:9]) for _ in range(60)]
    index = decontam.ItemIndex(items)
    walked, walks = [], decontam.walks
    monkeypatch.setattr(decontam, "walks", lambda windows: walked.append(len(windows)) or walks(windows))
    matches = lambda text: index.matches(np.array([index.codes.get(w, 0) for w in text.split()], np.int64))
    assert matches(" ".join(pieces)) == {} and not walked
    edited = items[3][1].replace("w3x7", "new").replace("w3x12", "other")
    assert matches(" ".join([*pieces, edited, *pieces])) == {3: (2, 300)}
    assert 0 < sum(walked) < 60


def test_distances_of_many_windows():
    rnd = np.random.default_rng(6)
    for _ in range(50):
        item, texts = rnd.integers(1, 5, rnd.integers(1, 12)), rnd.integers(0, 5, (7, rnd.integers(1, 20)))
        distances, ends = decontam.edit_distances_within(item, texts)
        for text, distance, end in zip(texts.tolist(), distances.tolist(), ends.tolist(), strict=True):
            assert holds(item.tolist(), text[:end], distance) and not holds(item.tolist(), text, distance - 1)


def test_clean_documents_stay(leaks, odd, empty):
    docs, benchmark, _ = leaks
    hit = {r.doc_id for r in decontam.find_leaks(docs, benchmark).collect()}
    clean = decontam.without_leaks(docs, benchmark)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - hit
    assert decontam.without_leaks(odd, benchmark).columns == odd.columns
    assert decontam.without_leaks(odd, benchmark).count() == odd.count()
    assert decontam.without_leaks(empty, benchmark).count() == 0
    assert decontam.without_leaks(docs, benchmark.filter("item_id < 0")).count() == docs.count()


def test_workers_keep_few_word_codes():
    codes = decontam._Codes({"leak": 1})
    for k in range(200_000):
        assert codes[f"w{k}"] == 0 and codes["(leak)"] == 1 and codes["..."] == -1
    assert len(codes) < 60_000


# ---------------------------------------------------------------- language


def test_languages_of_held_out_documents(spark):
    docs = table(spark, SF_ORACLE, "documents")
    got = langid.predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_languages_of_odd_documents(odd, empty):
    rows = odd.collect()
    got = langid.predict_languages(odd).collect()
    assert len(got) == len(rows)
    letters = {r.doc_id: any(map(str.isalpha, r.text or "")) for r in rows if r.doc_id is not None}
    assert all((g.lang_pred != "und") == letters[g.doc_id] for g in got if g.doc_id is not None)
    assert all(g.score == 0 for g in got if g.lang_pred == "und")
    assert langid.predict_languages(empty).collect() == []
    kept = langid.keep_identified(odd)
    assert kept.columns == odd.columns
    assert Counter(r.text for r in kept.collect()) == Counter(r.text for r in rows if any(map(str.isalpha, r.text or "")))


def test_nothing_to_learn_from(odd):
    got = langid.predict_languages(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert all(g.lang_pred == "und" and g.score == 0 for g in got)


def test_texts_with_letters_stay_where_nothing_is_learned(odd):
    docs = odd.withColumn("lang", F.lit(None).cast("string"))
    letters = Counter(r.text for r in docs.collect() if any(map(str.isalpha, r.text or "")))
    assert letters and Counter(r.text for r in langid.keep_identified(docs).collect()) == letters


def test_a_long_text_in_chunks_counts_the_same(monkeypatch):
    low = langid._low_slots()
    for text in ("Ein langer Text, mit Wörtern. " * 50, "a  --  b" + " " * 300 + "日本語 c", "x" * 130, "...", "ab", ""):
        monkeypatch.setattr(langid, "CHUNK", 1 << 20)
        whole = langid.text_grams(text, low)
        for size in (1, 2, 3, 7, 64):
            monkeypatch.setattr(langid, "CHUNK", size)
            parts = langid.text_grams(text, low)
            assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True))


# ---------------------------------------------------------------- toxicity


def test_toxicity_of_held_out_documents(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    got = toxicity.score_toxicity(docs, labels)
    assert got.count() == docs.count()
    held = got.filter("held_out").join(labels, "doc_id").collect()
    hits = sum(r.predicted == 1 and r.toxic == 1 for r in held)
    assert hits >= 0.8 * sum(r.toxic for r in held)
    assert hits >= 0.9 * sum(r.predicted for r in held)


def test_toxicity_by_hand(spark, odd, empty):
    rows = [(i, ("you vile " if i % 5 == 0 else "you good ") + " ".join(f"w{(i * k) % 97}" for k in range(1, 30))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    held = {r.doc_id for r in docs.filter(id_fold(F.col("doc_id")) == 2).collect()}
    assert {i for i, r in got.items() if r.held_out} == held
    wrong = sum(got[i].predicted != (i % 5 == 0) for i in held)
    assert wrong <= 0.05 * len(held)
    out = toxicity.score_toxicity(odd, labels).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score_toxicity(empty, labels).collect() == []
    none = toxicity.score_toxicity(docs, labels.withColumn("toxic", F.lit(None).cast("int"))).collect()
    assert all(r.score == 0 and r.predicted == 0 for r in none)


def test_shared_model_backs_off_through_every_order(spark):
    """Against Kneser-Ney by hand: every order from 7 to 1 counts its distinct left neighbours."""
    words = {"vile": (5, 1), "evil": (2, 4), "viler": (1, 0), "civil": (0, 3), "devilish": (1, 2), "anvils": (0, 6), "villages": (1, 7)}
    counts = {}
    for word, (t, o) in words.items():
        for gram in toxicity.word_grams(word):
            was = counts.get(gram, (0, 0))
            counts[gram] = (was[0] + t, was[1] + o)
    left, types = {}, set(counts)
    for n in range(toxicity.ORDER - 1, 0, -1):
        left[n] = Counter(g[1:] for g in types)
        types = set(left[n])

    def p(g):
        if len(g) == 1:
            return left[1][g] / sum(left[1].values())
        same = [c for other, c in left[len(g)].items() if other[:-1] == g[:-1]]
        return (max(left[len(g)][g] - toxicity.DISCOUNT, 0) + toxicity.DISCOUNT * len(same) * p(g[1:])) / sum(same)

    grams = spark.createDataFrame([(g, t, o) for g, (t, o) in counts.items()], "gram string, t long, o long")
    got = {r.key: r.value for r in toxicity.log_ratios(grams).collect() if len(r.key) == toxicity.ORDER}
    assert set(got) == {g for g, (t, _) in counts.items() if t}
    for gram, value in got.items():
        of = [c for g, c in counts.items() if g[:-1] == gram[:-1]]
        (t, o), n_t, n_o = counts[gram], sum(c[0] for c in of), sum(c[1] for c in of)
        k_t, k_o = sum(c[0] > 0 for c in of), sum(c[1] > 0 for c in of)
        ordinary = (max(o - toxicity.DISCOUNT, 0) + toxicity.DISCOUNT * k_o * p(gram[1:])) / n_o if n_o else p(gram[1:])
        toxic = (max(t - toxicity.DISCOUNT, 0) + (toxicity.STRENGTH + toxicity.DISCOUNT * k_t) * ordinary) / (n_t + toxicity.STRENGTH)
        assert abs(value - np.log(toxic / ordinary)) < 1e-9


def test_tables_outside_the_head_give_the_same_scores(spark, monkeypatch):
    docs, labels = table(spark, SF_ORACLE, "documents"), table(spark, SF_ORACLE, "labels")
    rows = lambda: sorted((r.doc_id, round(r.ratio, 7)) for r in toxicity.score_toxicity(docs, labels).collect())
    whole = rows()
    monkeypatch.setattr(toxicity.word_ratios, "__defaults__", (500,))
    monkeypatch.setattr(toxicity.text_ratios, "__defaults__", (500,))
    assert rows() == whole


def test_curve_separates():
    slope, offset = toxicity.fit_curve([(0.1, 1, 30), (0.0, 0, 200), (0.05, 1, 3), (0.04, 0, 5)])
    score = lambda x: 1 / (1 + np.exp(-(slope * x + offset)))
    assert score(0.1) > 0.9 and score(0.0) < 0.1


# ---------------------------------------------------------------- urls


def test_fixed_rules(spark):
    urls = {
        "http://A.Example.NET/en/1": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "https://example.net/fr/": ("example.net", "/fr/", "net/", "block"),
        "https://notexample.net/en/": ("notexample.net", "/en/", "net/", "block"),
        "ftp://x.example.com/de/?q#f": ("x.example.com", "/de/", "example.com/de/", "block"),
        "http://x.org/fr/a": ("x.org", "/fr/a", "org/fr/", "allow"),
        "http://net": ("net", "", None, None),
        "http://x.net?y=/": ("x.net", "", None, None),
        "http://a.com/x://b.net/": ("a.com", "/x://b.net/", None, None),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "://": ("", "", None, None),
        "http://example.com/d": ("example.com", "/d", None, None),
        "http://example.com:80/de/": ("example.com:80", "/de/", None, None),
    }
    rows = [(i, u, "extra") for i, u in enumerate(urls)] + [(50, None, "extra"), (50, None, "extra"), (None, "http://b.net/", "extra")]
    got = urlfilter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert len(got) == len(rows)
    by_id = {g.page_id: g for g in got}
    for i, (host, path, rule, verdict) in enumerate(urls.values()):
        assert (by_id[i].host, by_id[i].path, by_id[i].rule) == (host, path, rule)
        assert verdict is None or by_id[i].verdict == verdict
    assert (by_id[50].host, by_id[50].path, by_id[50].rule, by_id[50].verdict) == ("", "", None, "allow")


def test_mined_rules_by_counting(spark):
    pages = table(spark, SF_ORACLE, "pages")
    url = F.col("url")
    judged = pages.select("url", urlfilter.host_of(url).alias("host"), urlfilter.path_of(url).alias("path"))
    judged = judged.withColumn("fixed", urlfilter.rule_of(F.col("host"), F.col("path")))
    tokens = urlfilter.tokens_of(url, F.col("host"), F.col("path"))
    urls = {r.url: (set(r.tokens), r.verdict) for r in judged.filter("url like '%://%'").select(
        "url", tokens.alias("tokens"), F.col("fixed.verdict").alias("verdict")).collect()}
    labelled = [(t, v == "block") for t, v in urls.values() if v]
    least = max(urlfilter.LEAST_ROWS, math.ceil(urlfilter.LEAST_SUPPORT * len(labelled)))
    counts = Counter()
    for t, b in labelled:
        for n in (1, 2, 3):
            counts.update((c, b) for c in itertools.combinations(sorted(t), n))
    sure = {c: (n, n / (n + counts[c, False])) for (c, b), n in counts.items() if b and n >= least}
    sure = {c: v for c, v in sure.items() if v[1] >= urlfilter.LEAST_CONFIDENCE}
    found = urlfilter.mine_rules(spark.createDataFrame([(sorted(t), b) for t, b in labelled], "tokens array<string>, blocked boolean"))
    mined = {tuple(r.tokens): r for r in found.collect()}
    assert mined and mined.keys() == sure.keys()
    for c, r in mined.items():
        assert (r.hits, pytest.approx(r.confidence)) == sure[c] and r.rarest in c
    rules = [c for c, (_, own) in sure.items()
             if not any(sure[p][1] >= own for n in range(1, len(c)) for p in itertools.combinations(c, n) if p in sure)]
    share = sum(b for _, b in labelled) / len(urls)
    opened = [t for t, v in urls.values() if not v]
    rules = [set(c) for c in rules if sure[c][0] >= urlfilter.LEAST_LIFT * share * (
        sure[c][0] / sure[c][1] + sum(set(c) <= t for t in opened)) - 1e-9]
    for r in urlfilter.judge_urls(pages).join(pages.select("page_id", "url"), "page_id").collect():
        if r.rule is None and r.url in urls:
            assert (r.verdict == "block") == any(x <= urls[r.url][0] for x in rules)


def test_many_shared_tokens(spark):
    shared = "/".join(f"part{chr(97 + i % 26)}{i}x" for i in range(30))
    rows = [(i, f"http://h{i}.net/{shared}/u{i}") for i in range(20)] + [(100 + i, f"http://h{i}.info/plain{i}") for i in range(40)] + [(200, f"http://z.info/{shared}")]
    got = {r.page_id: r.verdict for r in urlfilter.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[200] == "block" and all(got[i] == "block" for i in range(20)) and all(got[100 + i] == "allow" for i in range(40))


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urlfilter.judge_urls(none).collect() == []
    only_open = spark.createDataFrame([(1, "http://a.com/b")], "page_id long, url string")
    assert [r.verdict for r in urlfilter.judge_urls(only_open).collect()] == ["allow"]

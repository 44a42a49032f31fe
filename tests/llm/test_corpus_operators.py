"""Operators over whole tables, against brute force."""

import collections
import hashlib
import math
import random
import re
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from tidegauge.llm import dedup, packing, quality, simhash, surrogate, topk
from tidegauge.session import materialise

SCHEMA = "doc_id long, text string, lang string, id int, digest string, node long, row string"


def docs_of(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "en", 7, "d", 1, "r") if len(r) == 2 else r for r in rows], SCHEMA).repartition(parts)


# --- exact dedup -----------------------------------------------------------------------------


def copies(seed=1, n=300):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a b", "a  b", "a\n\tb", "c", "", None, " ", "é", f"own {i}", "x " * 2000])) for i in range(n)]
    return [*rows, (None, "null id"), (None, "c"), (3, rows[3][1]), (500, "\xa0"), (501, " \xa0")]


@pytest.mark.parametrize("max_cells,groups", [(1 << 10, 0), (dedup.MAX_CELLS, dedup.BROADCAST_GROUPS)])
def test_group_members(spark, monkeypatch, max_cells, groups):
    monkeypatch.setattr(dedup, "BROADCAST_GROUPS", groups)
    rows = copies()
    got = dedup.group_members(docs_of(spark, rows), max_cells=max_cells).collect()
    members = collections.defaultdict(list)
    for i, t in rows:
        members[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()].append(i)
    expected = collections.Counter()
    for digest, ids in members.items():
        keep = min((i is None, i or 0) for i in ids)
        first = None if keep[0] else keep[1]
        for k, i in enumerate(sorted(ids, key=lambda i: (i is None, i or 0))):
            expected[(i, first, len(ids), k == 0, digest)] += 1
    assert collections.Counter(map(tuple, got)) == expected
    assert dedup.group_members(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("groups", [0, dedup.BROADCAST_GROUPS])
def test_keep_first(spark, monkeypatch, groups):
    monkeypatch.setattr(dedup, "BROADCAST_GROUPS", groups)
    rows = copies()
    kept = dedup.keep_first(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, rows).columns
    marked = collections.Counter((r.doc_id, r.text_sha256) for r in dedup.group_members(docs_of(spark, rows)).collect() if r.kept)
    again = collections.Counter((r.doc_id, r.text_sha256) for r in dedup.group_members(kept).collect())
    assert again == marked and dedup.keep_first(docs_of(spark, [])).count() == 0


def test_the_filter_passes_no_repeated_digest(spark):
    rng = np.random.default_rng(0)
    digests = [rng.bytes(32) for _ in range(3000)]
    table = spark.createDataFrame([(bytearray(d),) for d in digests + digests[:500]], "digest binary").repartition(5)
    for max_cells, n in ((dedup.MAX_CELLS, 1), (1 << 14, 4)):
        assert len(dedup.slices(table, 3500, max_cells)) == n
        rows = dedup.marked(table, 3500, max_cells).collect()
        assert collections.Counter(bytes(r.digest) for r in rows) == collections.Counter(digests + digests[:500])
        suspects = {bytes(r.digest) for r in rows if r.suspect}
        assert set(digests[:500]) <= suspects and len(suspects) < 700
        assert not suspects & {bytes(r.digest) for r in rows if not r.suspect}


def test_a_slice_reads_only_its_range(spark):
    table = materialise(docs_of(spark, copies()).select(dedup.text_digest(F.col("text")).alias("digest")).sortWithinPartitions("digest"), "digests")
    plan = dedup.slices(table, 300, 1 << 10)[1]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(digest" in plan and "LessThan(digest" in plan


# --- near duplicates -------------------------------------------------------------------------


def near_copies(seed, originals=25, copies_each=5):
    rng, rows = random.Random(seed), []
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    for o in range(originals):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 200]))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(copies_each):
            edited = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
            rows.append((len(rows), "\n".join(edited).upper() if rng.random() < 0.3 else " ".join(edited)))
    return [*rows, (900, None), (901, ""), (902, " \t"), (903, "one"), (903, "one"), (None, "one")]


def linked(prints, distance, total=None):
    a = np.array(prints, np.uint64).reshape(len(prints), -1)
    each = np.bitwise_count(a[:, None, :] ^ a[None, :, :]).astype(int)
    near = (each <= distance).any(axis=2)
    if total is not None:
        near &= each.sum(axis=2) <= total
    label = np.arange(len(prints))
    while True:
        new = np.where(near, label[None, :], len(prints)).min(axis=1)
        if (new == label).all():
            return label
        label = new


@pytest.mark.parametrize("parts", [None, 2, 3, 4])
def test_near_duplicates(spark, parts):
    rows = near_copies(2)
    prints = [simhash.fingerprint(t) for _, t in rows]
    label = linked(prints, 4)
    least = {}
    for (i, _), c in zip(rows, label.tolist(), strict=True):
        least[c] = min(least.get(c, math.inf), math.inf if i is None else i)
    expected = collections.Counter((i, f"{p[0]:016x}", least[c]) for (i, _), p, c in zip(rows, prints, label.tolist(), strict=True))
    assert collections.Counter(map(tuple, simhash.near_duplicates(docs_of(spark, rows), parts=parts).collect())) == expected


def test_fingerprint_by_its_definition(spark):
    import xxhash

    for text in ("a b c d e f a b c d", "Ä B C", "one", "a b c d", "É x y z É x y z"):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        assert simhash.fingerprint(text)[0] == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == [0]


def shingle_sets(rows):
    out = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append({" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b)


def least_of_groups(rows, similarity=0.8):
    """The ids that stay, by comparing all pairs."""
    sets = shingle_sets(rows)
    label = np.arange(len(rows))
    near = np.array([[jaccard(a, b) >= similarity for b in sets] for a in sets])
    while not np.array_equal(label, new := np.where(near, label[None, :], len(rows)).min(axis=1)):
        label = new
    least = {}
    for (i, _), c in zip(rows, label.tolist(), strict=True):
        least[c] = min(least.get(c, math.inf), math.inf if i is None else i)
    return sorted(least.values())


@pytest.mark.parametrize("keys", [None, 0])
def test_keep_one(spark, monkeypatch, keys):
    if keys is not None:  # nothing is broadcast
        monkeypatch.setattr(simhash, "BROADCAST_KEYS", keys)
        monkeypatch.setattr(simhash, "LINKS_A_TASK", 2)
    rows = near_copies(3)
    kept = simhash.keep_one(docs_of(spark, rows))
    got, expected = sorted(r.doc_id for r in kept.collect()), least_of_groups(rows)
    assert set(expected) <= set(got) and len(got) <= len(expected) + 1
    assert kept.columns == docs_of(spark, rows).columns and simhash.keep_one(docs_of(spark, [])).count() == 0
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def pairs_of_similarity(low, high, n, seed):
    rng, out = random.Random(seed), []
    vocabulary = ["".join(rng.choice("abcdefghijklm") for _ in range(6)) for _ in range(5000)]
    while len(out) < n:
        words = [rng.choice(vocabulary) for _ in range(rng.choice([80, 200, 500]))]
        edited = list(words)
        for _ in range(max(1, round(len(words) * rng.uniform(0.01, 0.06)))):
            edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
        pair = [(None, " ".join(words)), (None, " ".join(edited))]
        if low <= jaccard(*shingle_sets(pair)) < high:
            out.append((pair[0][1], pair[1][1]))
    return out


def test_recall_and_exactness_of_keep_one(spark):
    """Of pairs at 0.8 to 0.83 nine in ten are found at least; of those below 0.8 none is linked."""
    near, apart = pairs_of_similarity(0.8, 0.83, 150, 1), pairs_of_similarity(0.74, 0.8, 150, 2)
    rows = [(2 * i + k, t) for i, pair in enumerate(near + apart) for k, t in enumerate(pair)]
    kept = {r.doc_id for r in simhash.keep_one(docs_of(spark, rows)).collect()}
    assert {i for i, _ in rows if i % 2 == 0 or i >= 300} <= kept
    assert sum(i % 2 == 1 and i < 300 and i not in kept for i, _ in rows) >= 0.9 * len(near)


def hard_rows():
    """Links that fingerprints of texts miss or nearer links hide: pairs at the bound, repeated lines, and a group of copies around the bound."""
    rng, texts = random.Random(6), [t for pair in pairs_of_similarity(0.8, 0.81, 60, 7) + pairs_of_similarity(0.78, 0.8, 40, 8) for t in pair]
    vocabulary = ["".join(rng.choice("nopqrstuv") for _ in range(6)) for _ in range(3000)]
    for _ in range(5):  # alike as sets of shingles, or (the last) far from the first though its bits are alike
        line, text, other = (" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (6, 60, 60))
        texts += [f"{text} {line} {line}", text + f" {line}" * 90, other + f" {line}" * 90]
    centre = [rng.choice(vocabulary) for _ in range(150)]
    for _ in range(250):
        edited = list(centre)
        for _ in range(rng.choice([1, 2, 4, 6, 9])):
            edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
        texts.append(" ".join(edited))
    rng.shuffle(texts)
    return [*enumerate(texts), (None, "null id"), (900, None), (901, "")]


@pytest.mark.parametrize("block", [simhash.BLOCK, 8])
def test_keep_one_loses_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rows = hard_rows()
    kept = [math.inf if r.doc_id is None else r.doc_id for r in simhash.keep_one(docs_of(spark, rows)).collect()]
    assert sorted(kept) == least_of_groups(rows)


def test_missed_links_alone_find_all_groups(spark):
    """Without any link from fingerprints; the likeliest link of a node and a group is not the only one looked at."""
    rows = hard_rows()[:-3]
    prints = materialise(simhash.set_table(docs_of(spark, rows), "doc_id", "text", 5, 1), "prints")
    nodes = materialise(prints.groupBy("set_key", "w0").agg(F.count("*").alias("rows"), F.min("row").alias("node")), "nodes")
    none = materialise(spark.createDataFrame([], "node long, root long"), "roots")
    found = simhash.missed_links(prints, nodes, none, ["set_key", "w0"], 0.8)
    prints = prints.collect()
    names, equal = {r.row: r.id for r in prints}, {r.set_key: r.id for r in prints}
    edges = [(names[a], names[b]) for a, b in found.collect()] + [(r.id, equal[r.set_key]) for r in prints]
    label = simhash.merge(np.arange(len(rows)), *np.array(edges).T)
    assert sorted(set(label.tolist())) == least_of_groups(rows)


def test_sets_of_the_similarity_share_a_rare_shingle():
    rng = np.random.default_rng(3)
    counts = rng.integers(2, 9, 1 << simhash.SKETCH_BITS).astype(np.uint32)
    for n in [*range(1, 40), 400]:
        for gone in range(n // 5 + 1):
            one = np.unique(rng.integers(0, 1 << simhash.HASH_BITS, n, dtype=np.uint64))
            for other in (one[rng.permutation(len(one))[gone:]], np.r_[one[rng.permutation(len(one))[gone // 2 :]], rng.integers(0, 1 << simhash.HASH_BITS, gone // 2, dtype=np.uint64)]):
                both = len(np.intersect1d(one, other))
                if both >= 0.8 * (len(one) + len(other) - both):
                    (a, _), (b, _) = simhash.prefix(one, counts, 0.8), simhash.prefix(np.unique(other), counts, 0.8)
                    assert len(np.intersect1d(a, b))


def test_spanning_links_connect_and_prefer_the_first():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 200, (2, 900))
    label, chosen = simhash.spanning(np.arange(200), a, b)
    whole = simhash.merge(np.arange(200), a, b)
    assert label.tolist() == whole.tolist() and len(chosen) == 200 - len(set(whole.tolist()))
    assert simhash.merge(np.arange(200), a[chosen], b[chosen]).tolist() == whole.tolist()
    first = np.flatnonzero(a != b)[0]
    assert first in chosen


@pytest.mark.parametrize("tables,distance", [(1, 4), (2, 6)])
def test_split_buckets_lose_no_link(monkeypatch, tables, distance):
    """One large group of near copies: its buckets are dealt to many blocks, and rows stay few."""
    import pyarrow as pa

    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, tables, dtype=np.uint64)
    fps = np.unique(np.concatenate([centre ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (300, 3, tables)).astype(np.uint64), axis=1), rng.integers(0, 1 << 63, (200, tables), dtype=np.uint64)]), axis=0)
    node = np.arange(len(fps))
    batch = pa.RecordBatch.from_arrays([pa.array(node), *(pa.array(fps[:, t].view(np.int64)) for t in range(tables))], names=["node", *simhash.words(tables)])
    groups = [[list(range(i, 64, 5)) for i in range(5)] for _ in range(tables)] if distance == 4 else [[list(range(i, 64, 6)) for i in range(6)] for _ in range(tables)]
    plans = []
    for t, own in enumerate(groups):
        histogram = {i: np.bincount(simhash.project(fps[:, t], g), minlength=1 << len(g)) for i, g in enumerate(own)}
        plans.append(simhash.Plan(own, histogram, distance))
        assert set(plans[t].thresholds([simhash.project(fps[:, t], g) for g in own]).sum(axis=0).tolist()) == {distance - len(own) + 1}

    class Shared:
        value = plans

    rows = pa.Table.from_batches(list(simhash._entries(Shared)([batch]))).sort_by([("bucket", "ascending"), ("block", "ascending"), ("role", "ascending")])
    assert len(set(rows["block"].to_pylist())) > 10
    for total in (None, 40):
        edges = list(simhash._verify(distance, total)(rows.to_batches(max_chunksize=500)))
        a, b = (np.concatenate([e.column(i).to_numpy() for e in edges]) for i in (0, 1))
        label = simhash.merge(node.copy(), a, b)
        assert label.tolist() == linked(fps, distance, total).tolist()
        if total:
            assert (np.bitwise_count(fps[a] ^ fps[b]).sum(axis=1) <= total).all()


def test_a_bucket_gives_a_forest_not_its_pairs():
    fps = np.arange(3000, dtype=np.uint64).reshape(-1, 1)  # within 12 bits: a chain of links to all
    a, b = simhash.forest(np.arange(3000), np.arange(3000), fps, fps, 0, 4, None)
    assert len(a) == 2999 and set(b.tolist()) == {0}


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (5, 5)]
    got = dict(map(tuple, simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}


# --- search ----------------------------------------------------------------------------------


@pytest.mark.parametrize("query_bytes", [1, 4 << 20])
def test_top_k(spark, query_bytes):
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(size=6).round(1).tolist()) for i in range(260)] + [(300, [0.5] * 6), (400, [0.5] * 6), (401, [0.5] * 6), (402, [0.5] * 6)]
    odd = [(500, None), (501, []), (502, [1.0, float("nan")] * 3), (503, [float("inf")] * 6), (504, [None] * 6), (505, [1.0] * 4), (None, [1.0] * 6), (600, [1.0] * 4), (700, [2e5] * 6), (701, [3e9] * 6)]
    table = spark.createDataFrame([(i, v, 1) for i, v in vectors + odd], "vec_id long, embedding array<double>, score int").repartition(3)
    got = topk.top_k(table, table.filter("vec_id % 100 = 0"), query_bytes=query_bytes)
    ints = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors + odd if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    expected = []
    for q, v in ints:
        if q % 100 == 0:
            scored = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w, strict=True)))), i) for i, w in ints if i != q and len(w) == len(v))
            expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:10])]
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert topk.top_k(table.limit(0), table.limit(0)).count() == 0


def test_bounds_hold_and_few_exact_vectors_are_read():
    rng = np.random.default_rng(7)
    for scale, kind in ((1, "<i2"), (1e3, "<i4"), (1e8, "<f8"), (1e20, "<f8")):
        vectors = np.floor(rng.normal(size=(3000, 24)) * 1000 * scale)
        file = topk.ApproximationFile.from_row(*topk.ApproximationFile.of(np.arange(3000), vectors).row())
        assert file.exact.dtype.str == kind and np.array_equal(file.exact, vectors)
        centre, reach = file.bounds(vectors[:50])
        assert (np.abs(vectors[:50] @ vectors.T - centre) <= reach[:, None]).all()
    vectors = np.floor(rng.normal(size=(20_000, 16)) * 1000)
    asked = topk.Asked(np.arange(100), vectors[:100], 10)
    for at in range(0, len(vectors), 4096):
        asked.search(topk.ApproximationFile.of(np.arange(at, min(len(vectors), at + 4096)), vectors[at : at + 4096]))
    assert asked.exact_reads < 0.02 * 100 * len(vectors)


# --- quality ---------------------------------------------------------------------------------


def plain_model(texts):
    """Interpolated modified Kneser-Ney over the symbols of quality.grams(), by its definition."""
    size, grams = quality.SYMBOLS, collections.Counter(g for t in texts for g in quality.grams(t).tolist())
    counts = {4: grams}
    for n in (3, 2, 1):
        counts[n] = collections.Counter(g % size**n for g in counts[n + 1])
    d = {n: [0, *quality.discounts_from([sum(c == i for c in counts[n].values()) for i in (1, 2, 3, 4)])] for n in counts}
    totals, freed = {n: collections.Counter() for n in counts}, {n: collections.Counter() for n in counts}
    for n, own in counts.items():
        for g, c in own.items():
            totals[n][g // size] += c
            freed[n][g // size] += d[n][min(c, 3)]

    def p(n, g):
        if n == 0:
            return 1 / size
        context, lower = g // size, p(n - 1, g % size ** (n - 1))
        if not totals[n][context]:
            return lower
        c = counts[n][g]
        return (c - d[n][min(c, 3)] if c else 0) / totals[n][context] + freed[n][context] / totals[n][context] * lower

    return lambda text: -sum(math.log2(p(4, g)) for g in quality.grams(text).tolist())


def plain_limits(known, quantile):
    """Limits by language, and that of other languages, from (lang, symbols, bits) of held-out rows."""
    mean = round(sum(b for _, _, b in known) / sum(n for _, n, _ in known), 9)
    drawn = [(lang, (b + quality.PRIOR_SYMBOLS * mean) / (n + quality.PRIOR_SYMBOLS)) for lang, n, b in known]

    def at(values):
        return math.ceil(round(sorted(values)[math.ceil(len(values) * quantile) - 1] * quality.BINS, 6)) / quality.BINS

    by_lang = collections.defaultdict(list)
    for lang, x in drawn:
        by_lang[lang].append(x)
    apart = [x - (sum(own) - x) / (len(own) - 1) for own in by_lang.values() if len(own) > 1 for x in own]
    beyond = at(apart) if apart else 0
    if len(apart) > 1 and len(apart) * (1 - quantile) < 1:
        beyond = max(beyond, quality.DEVIATIONS * statistics.stdev(apart))
    limits = {lang: at(own) if len(own) * (1 - quantile) >= 1 else sum(own) / len(own) + beyond for lang, own in by_lang.items()}
    return mean, limits, at([x for _, x in drawn])


def quality_rows(n=120):
    rng = random.Random(6)
    syllables = {"aa": ["ka", "lo", "mi", "ta"], "bb": ["ster", "ung", "ich", "ver"]}
    rows, labels = [], []
    for i in range(n):
        lang = ("aa", "bb")[i % 2]
        words = ["".join(rng.choice(syllables[lang]) for _ in range(rng.choice([1, 2, 3]))) for _ in range(80)]
        junk = i % 10 == 9
        rows.append((i, " ".join(w + "***" if junk else w for w in words), lang, 1, "d", 1, "r"))
        labels.append((i, 0 if junk else 1))
    return rows, labels


@pytest.mark.parametrize("quantile", [0.995, 0.8])
def test_quality(spark, monkeypatch, quantile):
    rows, labels = quality_rows()
    rows += [(1000, None, "aa", 1, "d", 1, "r"), (1001, "", None, 1, "d", 1, "r"), (None, "kalo mita", "aa", 1, "d", 1, "r"), (1002, "kalo mita", "zz", 1, "d", 1, "r"), (3, rows[3][1], "bb", 1, "d", 1, "r")]
    docs, marks = docs_of(spark, rows), spark.createDataFrame([*labels, (None, 1), (7, None), (0, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.classify(docs, marks, quantile=quantile).collect()}
    held_out = {r.text for r in docs.filter(quality.is_held_out(F.xxhash64("text"))).collect()}
    trusted = {i for i, q in labels if q == 1}
    bits = plain_model([t for i, t, *_ in rows if i in trusted and t not in held_out])
    mean, limits, pooled = plain_limits([(lang, len(t), bits(t)) for i, t, lang, *_ in rows if i in trusted and t in held_out], quantile)
    for i, t, lang, *_ in rows:
        assert got[i].n_chars == len(t or "") and got[i].threshold == pytest.approx(2 ** limits.get(lang, pooled), rel=1e-6)
        if t:
            assert got[i].perplexity == pytest.approx(2 ** (bits(t) / len(t)), rel=1e-4)
            drawn = (bits(t) + quality.PRIOR_SYMBOLS * mean) / (len(t) + quality.PRIOR_SYMBOLS)
            assert got[i].kept == (drawn <= limits.get(lang, pooled)) or abs(drawn - limits.get(lang, pooled)) < 1e-5
        else:
            assert got[i].perplexity is None and not got[i].kept
    assert not any(got[i].kept for i, q in labels if q == 0)
    kept = quality.keep_good(docs, marks, quantile=quantile)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows if got[r[0]].kept) and kept.columns == docs.columns
    assert quality.classify(docs_of(spark, []), marks).count() == 0
    before = quality.classify(docs, marks, quantile=quantile).collect()
    assert len(before) == len(rows)
    monkeypatch.setattr(quality, "BROADCAST_IDS", 0)
    monkeypatch.setattr(quality, "BROADCAST_LANGS", 0)
    monkeypatch.setattr(quality, "BLOCK_DOCS", 7)
    shuffled = quality.classify(docs, marks, quantile=quantile).collect()
    assert collections.Counter((r.doc_id, r.kept, r.threshold) for r in shuffled) == collections.Counter((r.doc_id, r.kept, r.threshold) for r in before)
    untaught = quality.classify(docs, marks.limit(0)).collect()
    assert all(r.kept == bool(r.n_chars) for r in untaught)


def test_clean_documents_pass_where_few_are_trusted(spark):
    """Ten trusted documents a language: the model knows their own grams, the limit must not."""
    rng = random.Random(8)
    letters = {"aa": "aeioumnlrstdk", "bb": "aeouügwpfbzhj"}
    rows = [(i, " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.choice([2, 4, 7]))) for _ in range(60)), lang, 1, "d", 1, "r") for i in range(100) for lang in [("aa", "bb")[i % 2]]]
    rows += [(100 + i, " ".join("".join(rng.choice("!#$%*+/") for _ in range(5)) for _ in range(60)), ("aa", "bb")[i % 2], 1, "d", 1, "r") for i in range(10)]
    got = quality.classify(docs_of(spark, rows), spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")).collect()
    assert sum(r.kept for r in got if 20 <= r.doc_id < 100) >= 72 and not any(r.kept for r in got if r.doc_id >= 100)


def test_grams_are_code_units():
    size = quality.SYMBOLS
    assert quality.grams("aЖ").tolist() == [97, 97 * size + 0x416]
    assert quality.grams("x🙂").tolist() == [120, 120 * size + 0xD83D, (120 * size + 0xD83D) * size + 0xDE42]
    assert quality.grams("abcde").tolist()[-1] == int.from_bytes(b"\0b\0c\0d\0e", "big") and not len(quality.grams(""))


def test_long_texts_are_counted_by_slices(monkeypatch):
    text = "".join(random.Random(1).choice("ab 日🙂\ud800") for _ in range(1000))
    whole = quality.gram_counts(text)
    for size in (1, 2, 7, 64):
        monkeypatch.setattr(quality, "SLICE_CHARS", size)
        assert all(np.array_equal(a, b) for a, b in zip(quality.gram_counts(text), whole, strict=True))


@pytest.mark.parametrize("syllables", [["при", "вет", "мир", "дом", "ста"], ["λόγ", "ος", "καί", "θεά"], ["مرح", "با", "سلا", "كتب"], ["日本", "東京", "学生", "天気"]])
def test_shuffled_letters_of_other_scripts_cost_more(syllables):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice(syllables) for _ in range(rng.choice([1, 2]))) for _ in range(60)) for _ in range(30)]
    bits = plain_model(texts[:25])
    for text in texts[25:]:
        shuffled = " ".join("".join(rng.choice("".join(syllables)) for _ in word) for word in text.split(" "))
        assert bits(shuffled) > 1.5 * bits(text)


def test_model_is_a_probability(spark):
    rows, labels = quality_rows(20)
    model = quality.train(docs_of(spark, rows).select("text"))
    shards = {r.shard: quality.Shard(r.model, model.unigrams) for r in model.shards.collect()}
    for context in [*quality.grams("kalo ")[1:].tolist(), *quality.grams("日本")[1:].tolist()]:
        every = np.uint64(context << quality.BITS & (1 << 64) - 1) | np.arange(quality.SYMBOLS, dtype=np.uint64)
        shard = int(quality.shard_of(quality._symbol(every[:1], 2), quality._symbol(every[:1], 1))[0])
        own = shards.get(shard) or quality.Shard(None, model.unigrams)
        assert np.exp2(own.log2p(every)).sum() == pytest.approx(1.0, rel=1e-4)


def test_packed_blocks_round_trip():
    every = [quality.gram_counts(t) for t in ("", "abc abc", "z" * 100_000, "Ünï ¡日本!", "abc", "")]
    got = [collections.Counter() for _ in every]
    for shard, packed in quality.pack_block(every):
        distinct, sizes, docs, counts = quality.unpack_block(packed)
        for doc, gram, n in zip(docs.tolist(), np.repeat(distinct, sizes).tolist(), counts.tolist(), strict=True):
            one = np.array([gram], np.uint64)
            assert int(quality.shard_of(quality._symbol(one, 2), quality._symbol(one, 1))[0]) == shard
            got[doc][gram] += n
    assert got == [collections.Counter(dict(zip(g.tolist(), n.tolist(), strict=True))) for g, n in every]


# --- pipeline --------------------------------------------------------------------------------


def plain_pipeline(spark, rows, labels):
    """(doc_id, text) that the pipeline packs, stage by stage in one place."""
    from tests.llm.test_text_operators import plain_attempts

    docs = docs_of(spark, rows)
    held_out = {r.text for r in docs.filter(quality.is_held_out(F.xxhash64("text"))).collect()}
    trusted = {i for i, q in labels if q == 1}
    bits = plain_model([t for i, t, *_ in rows if i in trusted and t not in held_out])
    mean, limits, pooled = plain_limits([(lang, len(t), bits(t)) for i, t, lang, *_ in rows if i in trusted and t in held_out], quality.QUANTILE)
    left = [(i, t) for i, t, lang, *_ in rows if t and (bits(t) + quality.PRIOR_SYMBOLS * mean) / (len(t) + quality.PRIOR_SYMBOLS) <= limits.get(lang, pooled)]
    first = {}
    for i, t in left:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        first[key] = min(first.get(key, i), i)
    left = [(i, t) for i, t in left if i in set(first.values())]
    ids = set(least_of_groups(left))
    left = [(i, t) for i, t in left if i in ids]
    attempts = plain_attempts([t for _, t in left])
    return {i: surrogate.replaced(t, attempts, surrogate.KEY)[0] for i, t in left}


def test_pipeline(spark, tmp_path):
    rows, labels = quality_rows(60)
    rng = random.Random(9)
    for i in (0, 1, 2):  # an exact and a near copy
        words = rows[i][1].split()
        words[rng.randrange(len(words))] = words[0]
        rows += [(100 + i, rows[i][1], rows[i][2], 1, "d", 1, "r"), (200 + i, " ".join(words), rows[i][2], 1, "d", 1, "r")]
    rows += [(300, rows[4][1] + " write kalo.mita@mail.example.com", "aa", 1, "d", 1, "r"), (301, None, None, None, None, None, None)]
    docs_of(spark, rows).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == [*docs_of(spark, []).columns, "n_chars"]
        left[name] = {r.doc_id: r for r in docs.collect()}
    good = {i for i, q in labels if q == 1}
    assert {i for i in left["quality_classifier"] if i < 100} == good
    assert set(left["quality_classifier"]) - set(left["exact_dedup"]) == {100, 101, 102}
    assert not {200, 201, 202} & set(left["simhash_near_dedup"]) and good <= set(left["simhash_near_dedup"])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "pii_surrogates", "best_fit_packing"]
    assert all("kalo.mita@" not in r.text for r in left["pii_surrogates"].values())
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    expected = plain_pipeline(spark, rows, labels)
    assert {i: r.text for i, r in left["pii_surrogates"].items()} == expected
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    lengths = {i: len(encoder.whole(t)) // 4 + 1 for i, t in expected.items()}
    assert {i: sum(p.length for p in pieces if p.doc_id == i) for i in {p.doc_id for p in pieces}} == lengths
    bins = collections.defaultdict(list)
    for p in pieces:
        bins[p.sequence_id].append((p.offset, p.length))
    assert all(sum(n for _, n in own[:k]) == at for own in map(sorted, bins.values()) for k, (at, _) in enumerate(own)) and all(sum(n for _, n in own) <= 4096 for own in bins.values())


def test_pipeline_without_documents_or_trusted_ones(spark, tmp_path):
    docs_of(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, text string").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

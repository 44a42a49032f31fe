"""Near-duplicates by SimHash: all links within a Hamming distance, by the generalised pigeonhole principle.

The 64 bits are grouped so that correlated bits share a partition. For m partitions
and distance t, thresholds t_1..t_m of at least -1 that add up to t - m + 1 suffice:
if every partition i differed in more than t_i bits, more than t would differ in
all. Each fingerprint gets its own thresholds, by dynamic programming over the
partitions on the candidates that a histogram of the partitions' values promises;
a threshold of -1 leaves a partition out. A fingerprint enters each partition under
its own value (data) and asks there for every value within its threshold (probe);
each bucket compares its probes with its data and keeps what is within t.

Scale: equal fingerprints are one node, so copies never meet each other. A bucket
that the histogram says is large is split into blocks of data times blocks of
probes, each a task's worth of its own. A bucket returns a spanning forest of what
it linked and not the links, so a group of near copies gives as many rows as it has
members. The number of partitions follows from a cost model on the number of nodes;
any number gives the same links. What reaches the driver are 64 x 64 bit counts and
histograms of at most 2^16 values a partition, never fingerprints, links or components.
Components come from rounds of hooking each root to its least neighbour and
halving paths, as joins over tables written in the shared folder.

Defined results: a null, empty or white text has fingerprint zero and is linked
like any other; repeated rows each get a row; a null id never names a component
unless all ids in it are null; an empty table gives an empty result; columns other
than id and text are not read (keep_one() passes them through).

keep_one() takes fingerprints of sets of shingles and looks at each link again by the exact
similarity of the two sets. A large bucket returns its nearest links first and of those only
what connects, so links to look at grow with nodes as well. What this leaves out (links beyond
the distance, and links that hold where nearer ones between the same groups fail) is found by
missed_links(): two sets of at least the similarity share one of their rarest shingles, so
all pairs of different groups that do are looked at. Groups are then those of all pairs.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.packed import pack, unpack
from tidegauge.session import broadcast_up_to, drop, materialise, ship

SHINGLE_WORDS = 4
DISTANCE = 4
SEED = 42
#: Values a histogram tells apart in a partition.
HISTOGRAM_BITS = 16
#: Fingerprints on each side of a block of a split bucket.
BLOCK = 4096
#: A row in a bucket costs as much as comparing this many candidates: the shuffle, not the processor, bounds it.
ROW_COST = 2000
#: Partitions of a table at most, which bounds `distance`.
MOST_PARTS = 32
#: Keys of rows to drop that go to every executor at most; more meet the rows in a shuffle.
BROADCAST_KEYS = 2_000_000
WIDEST_RADIUS = 2
#: Steps of distance in which a large bucket's links are taken.
BANDS = 3
#: Links of a node that are looked at in one task; a node of more is copied to several.
LINKS_A_TASK = 500
#: Bits kept of a shingle's hash for exact similarities.
HASH_BITS = 40
#: Cells that count shingles, to tell rare ones from frequent ones; any counts give the same links.
SKETCH_BITS = 20
SKETCH_PARTS = 64
#: A float's error in a bound on counts of shingles is less.
SLACK = 1e-6


def shingle_hashes(text: str | None, words_each: int = SHINGLE_WORDS) -> np.ndarray:
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= words_each:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - words_each + 1].tolist(), ends[words_each - 1 :].tolist(), strict=True)], np.uint64)


def mixed(hashes: np.ndarray, table: int) -> np.ndarray:
    """Hashes for one of several tables; the first has them as they are."""
    if not table:
        return hashes
    out = hashes + np.uint64(table * 0x9E3779B97F4A7C15 % (1 << 64))
    out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


def fingerprint(text: str | None, words_each: int = SHINGLE_WORDS, tables: int = 1) -> list[int]:
    """For each table 64 bits: a bit is set if it is in over half the hashes of the shingles, repeats included."""
    return fingerprint_of(shingle_hashes(text, words_each), tables)


def fingerprint_of(hashes: np.ndarray, tables: int) -> list[int]:
    return [int((bit_counts(mixed(hashes, t)) * 2 > len(hashes)) @ (np.uint64(1) << np.arange(64, dtype=np.uint64))) for t in range(tables)]


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = np.ascontiguousarray(hashes[at : at + 65536])
        out += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return out


def words(tables: int) -> list[str]:
    return [f"w{t}" for t in range(tables)]


def _fingerprints(words_each: int, tables: int):
    def run(batches):
        for batch in batches:
            found: list[list[int]] = []
            for at in range(0, batch.num_rows, 256):
                found += [fingerprint(t, words_each, tables) for t in batch.column(1).slice(at, 256).to_pylist()]
            columns = np.array(found, np.uint64).reshape(-1, tables).view(np.int64).T
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns)], names=["id", "text_key", *words(tables)])

    return run


def _longs(names: list[str]) -> str:
    return ", ".join(f"{n} long" for n in names)


def fingerprint_table(docs: DataFrame, id_col: str, text_col: str, words_each: int, tables: int) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    return rows.mapInArrow(_fingerprints(words_each, tables), f"id {kind}, text_key long, {_longs(words(tables))}")


def _set_prints(words_each: int, tables: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [np.unique(shingle_hashes(t, words_each)) for t in part.column(1).to_pylist()]
                columns = np.array([fingerprint_of(x, tables) for x in sets], np.uint64).reshape(-1, tables).view(np.int64).T
                keys = np.array([xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in sets], np.uint64).view(np.int64)
                packed = [pack([np.unique(x >> np.uint64(64 - HASH_BITS))]) for x in sets]
                arrays = [part.column(0), part.column(2), part.column(3), pa.array(keys, pa.int64()), pa.array(packed, pa.binary()), *(pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns)]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "text_key", "row", "set_key", "shingles", *words(tables)])

    return run


def set_table(docs: DataFrame, id_col: str, text_col: str, words_each: int, tables: int) -> DataFrame:
    """For each row a number of its own, the key of its set of shingles, the set (of HASH_BITS a shingle), and the set's fingerprints."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).select("id", "text", F.xxhash64("text").alias("text_key"), F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(_set_prints(words_each, tables), f"id {kind}, text_key long, row long, set_key long, shingles binary, {_longs(words(tables))}")


# --- partitions and thresholds ---------------------------------------------------------------


def bit_groups(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Greedy grouping by absolute correlation, given how often two bits are set together among n fingerprints."""
    share = together / max(n, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    correlation = np.abs((share - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(correlation, 0)
    left, groups = set(range(64)), []
    for i in range(parts):
        size = 64 // parts + (i < 64 % parts)
        seed = max(left, key=lambda b: (correlation[b, sorted(left)].max(), -b))
        group = [seed]
        left.discard(seed)
        while len(group) < size:
            best = max(left, key=lambda b: (correlation[b, group].sum(), -b))
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def best_parts(nodes: int, distance: int = DISTANCE, tables: int = 1) -> int:
    """The number of partitions with the least expected cost if fingerprints were uniform. A row has a word for each table."""

    def cost(parts: int) -> float:
        width, budget = 64 // parts, distance - parts + 1
        base, more = divmod(budget, parts)
        probes = sum(sum(_choose(width, k) for k in range(base + (i < more) + 1)) for i in range(parts))
        return probes * ROW_COST * (3 + tables) / 4 + probes * nodes / 2**width

    return min((p for p in range(2, distance + 2) if distance - p + 1 <= WIDEST_RADIUS * p), key=cost)


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def project(fps: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of a group, the first as the highest."""
    out = np.zeros(len(fps), np.int64)
    for bit in group:
        out = (out << 1) | ((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)
    return out


def flips(width: int, radius: int) -> np.ndarray:
    """Masks of exactly `radius` bits."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.int64)


class Plan:
    """Groups of bits, and per partition what a histogram value promises: candidates and costs for each radius."""

    def __init__(self, groups: list[list[int]], histogram: dict[int, np.ndarray], distance: int):
        self.groups, self.distance, self.widths = groups, distance, [len(g) for g in groups]
        self.coarse = [max(0, w - HISTOGRAM_BITS) for w in self.widths]
        self.near: list[np.ndarray] = []  # [radius, value]: candidates within the radius
        for part, width in enumerate(self.widths):
            counts = histogram[part].astype(np.float64) / 2 ** self.coarse[part]
            known = width - self.coarse[part]
            values = np.arange(len(counts))
            rings = [counts]
            for radius in range(1, WIDEST_RADIUS + 1):
                ring = np.zeros(len(counts))
                for seen in range(radius + 1):  # bits that differ among those the histogram knows
                    share = _choose(self.coarse[part], radius - seen)
                    if share:
                        for mask in flips(known, seen):
                            ring += share * counts[values ^ mask]
                rings.append(ring)
            self.near.append(np.cumsum(rings, axis=0))

    def seen_value(self, part: int, values: np.ndarray) -> np.ndarray:
        return values >> self.coarse[part]

    def thresholds(self, values: list[np.ndarray]) -> np.ndarray:
        """[partition, fingerprint]: the allocation of least cost."""
        parts, n = len(values), len(values[0])
        target = self.distance - parts + 1
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {0: (np.zeros(n), np.zeros((0, n), np.int8))}
        for part in range(parts):
            near = self.near[part][:, self.seen_value(part, values[part])]
            probes = np.cumsum([_choose(self.widths[part], r) for r in range(WIDEST_RADIUS + 1)])
            step: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            rest = parts - part - 1
            for used, (cost, chosen) in best.items():
                for radius in range(-1, WIDEST_RADIUS + 1):
                    total = used + radius
                    if not -rest <= target - total <= WIDEST_RADIUS * rest:
                        continue
                    own = cost if radius < 0 else cost + ROW_COST * (probes[radius] - 1) + near[radius]
                    path = np.vstack([chosen, np.full((1, n), radius, np.int8)])
                    if total in step:
                        old_cost, old_path = step[total]
                        better = own < old_cost
                        step[total] = (np.where(better, own, old_cost), np.where(better, path, old_path))
                    else:
                        step[total] = (own, path)
            best = step
        return best[target][1]

    def blocks(self, part: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Into how many blocks the data and the probes of these buckets are split."""
        near = self.near[part][:, self.seen_value(part, values)]
        usual = min(WIDEST_RADIUS, max(0, -(-(self.distance - len(self.groups) + 1) // len(self.groups))))  # the radius that most probes come from
        return np.maximum(1, np.ceil(near[0] / BLOCK)).astype(np.int64), np.maximum(1, np.ceil(near[usual] / BLOCK)).astype(np.int64)


def _together(batches):
    total = None
    for batch in batches:
        total = np.zeros((batch.num_columns, 64, 64), np.int64) if total is None else total
        for table, column in enumerate(batch.columns):
            fps = column.to_numpy().view(np.uint64)
            for at in range(0, len(fps), 65536):
                bits = np.unpackbits(np.ascontiguousarray(fps[at : at + 65536]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total[table] += (bits.T @ bits).astype(np.int64)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel(), pa.int64())], names=["cell", "n"])


def _histogram(groups: list[list[list[int]]]):
    def run(batches):
        for batch in batches:
            for table, column in enumerate(batch.columns):
                fps = column.to_numpy().view(np.uint64)
                for part, group in enumerate(groups[table]):
                    at, own = np.unique(project(fps, group) >> max(0, len(group) - HISTOGRAM_BITS), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), table * MOST_PARTS + part), pa.int32()), pa.array(at, pa.int32()), pa.array(own, pa.int64())], names=["part", "value", "n"])

    return run


def make_plans(nodes: DataFrame, n: int, tables: int, distance: int, parts: int | None) -> list[Plan]:
    together = np.zeros(tables * 4096, np.int64)
    fps = nodes.select(*words(tables))
    for cell, count in fps.mapInArrow(_together, "cell int, n long").groupBy("cell").agg(F.sum("n")).collect():
        together[cell] = count
    parts = parts or best_parts(n, distance, tables)
    groups = [bit_groups(x, n, parts) for x in together.reshape(tables, 64, 64)]
    histograms = [{i: np.zeros(1 << min(len(g), HISTOGRAM_BITS), np.int64) for i, g in enumerate(own)} for own in groups]
    for place, value, count in fps.mapInArrow(_histogram(groups), "part int, value int, n long").groupBy("part", "value").agg(F.sum("n")).toLocalIterator():
        histograms[place // MOST_PARTS][place % MOST_PARTS][value] = count
    return [Plan(g, h, distance) for g, h in zip(groups, histograms, strict=True)]


# --- probing and verifying -------------------------------------------------------------------

DATA, BOTH, PROBE = 0, 1, 2


def _spread(fps: np.ndarray, blocks: np.ndarray, salt: int) -> np.ndarray:
    out = (fps ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return ((out >> np.uint64(33)).astype(np.int64)) % blocks


def _entries(shared):
    """Rows (bucket, block, role, node, words): each node as data and as a probe, copied to the blocks it meets."""

    def run(batches):
        plans: list[Plan] = shared.value
        for batch in batches:
            whole = np.stack([c.to_numpy() for c in batch.columns])
            for at in range(0, batch.num_rows, 16384):
                rows = whole[:, at : at + 16384]
                for table, plan in enumerate(plans):
                    fps = np.ascontiguousarray(rows[1 + table]).view(np.uint64)
                    values = [project(fps, g) for g in plan.groups]
                    chosen = plan.thresholds(values)
                    for part, own in enumerate(values):
                        every = np.arange(len(own))
                        data_blocks, probe_blocks = plan.blocks(part, own)
                        asks = chosen[part] >= 0
                        both = asks & (data_blocks == 1) & (probe_blocks == 1)
                        yield from _rows(plan, table, part, own, fps, rows, every[both], BOTH)
                        yield from _rows(plan, table, part, own, fps, rows, every[~both], DATA)
                        yield from _rows(plan, table, part, own, fps, rows, every[asks & ~both], PROBE)
                        for radius in range(1, WIDEST_RADIUS + 1):
                            further = every[chosen[part] >= radius]
                            if len(further):
                                masks = flips(plan.widths[part], radius)
                                for mask in np.array_split(masks, max(1, len(masks) // 64)):
                                    asked = own[further][:, None] ^ mask[None, :]
                                    yield from _rows(plan, table, part, asked.ravel(), fps, rows, np.repeat(further, len(mask)), PROBE, given=True)

    return run


def _rows(plan: Plan, table: int, part: int, values: np.ndarray, fps: np.ndarray, rows: np.ndarray, who: np.ndarray, role: int, given: bool = False):
    """values: of each entry if given, else of each node."""
    if not given:
        values = values[who]
    for first in range(0, len(who), 65536):
        value, own = values[first : first + 65536], who[first : first + 65536]
        data_blocks, probe_blocks = plan.blocks(part, value)
        copies, mine = (data_blocks, probe_blocks) if role == PROBE else (probe_blocks, data_blocks)
        block = _spread(fps[own], mine, 7 if role == PROBE else 11)
        at = np.repeat(np.arange(len(own)), copies)
        other = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
        data_at, probe_at = (other, block[at]) if role == PROBE else (block[at], other)
        heads = [np.int64(table * MOST_PARTS + part) << 40 | value[at], data_at << 24 | probe_at]
        arrays = [pa.array(c, pa.int64()) for c in heads] + [pa.array(np.full(len(at), role), pa.int32())] + [pa.array(c, pa.int64()) for c in rows[:, own[at]]]
        yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "block", "role", "node", *words(len(rows) - 1)])


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Unite the components of a[i] and b[i]; a label is the least node known of a component, and labels itself."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        least = np.minimum(la, lb)
        np.minimum.at(label, la, least)
        np.minimum.at(label, lb, least)
        while not np.array_equal(label, shorter := label[label]):
            label = shorter


def spanning(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(label, chosen): which of the links (a[i], b[i]), the first ones first, join components; no others are needed. Each round takes the first link out of each component."""
    chosen = []
    left = np.arange(len(a))
    while True:
        left = left[label[a[left]] != label[b[left]]]
        if not len(left):
            return label, np.concatenate(chosen) if chosen else left
        first = np.full(len(label), len(a))
        np.minimum.at(first, label[a[left]], left)
        np.minimum.at(first, label[b[left]], left)
        chosen.append(np.unique(first[first < len(a)]))
        label = merge(label, a[chosen[-1]], b[chosen[-1]])


def forest(data: np.ndarray, probes: np.ndarray, data_words: np.ndarray, probe_words: np.ndarray, table: int, distance: int, total: int | None) -> tuple[np.ndarray, np.ndarray]:
    """What connects as the links between data and probes do. Words: [node, table].

    Without a total: (node, least node of its component), least nodes left out. With one, links themselves, nearer ones
    first (by BANDS of distance), as they may be looked at again.
    """
    nodes = np.unique(np.concatenate([data, probes]))
    label = np.arange(len(nodes))
    d, p = np.searchsorted(nodes, data), np.searchsorted(nodes, probes)
    own = np.ascontiguousarray(data_words[:, table])
    step = max(1, 1_000_000 // max(1, len(data)))
    taken = []
    for band in range(1, BANDS + 1 if total is not None else 2):
        for at in range(0, len(probes), step):
            i, j = np.nonzero(np.bitwise_count(probe_words[at : at + step, table][:, None] ^ own[None, :]) <= distance)
            i += at
            new = label[p[i]] != label[d[j]]
            i, j = i[new], j[new]
            if total is None:
                if len(i):
                    label = merge(label, p[i], d[j])
                continue
            apart = np.bitwise_count(probe_words[i] ^ data_words[j]).sum(axis=1, dtype=np.int64)
            near = np.flatnonzero(apart <= total * band // BANDS)
            near = near[np.argsort(apart[near], kind="stable")]
            label, chosen = spanning(label, p[i[near]], d[j[near]])
            taken.append(np.stack([p[i[near[chosen]]], d[j[near[chosen]]]]))
    if total is None:
        moved = label != np.arange(len(nodes))
        return nodes[moved], nodes[label[moved]]
    a, b = np.concatenate(taken, axis=1)
    return nodes[a], nodes[b]


def _links_of(bucket: np.ndarray, block: np.ndarray, role: np.ndarray, node: np.ndarray, fps: np.ndarray, distance: int, total: int | None):
    """Links of whole buckets, whose rows come by role. fps: [row, table]."""
    starts = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])])
    ends = np.r_[starts[1:], len(bucket)]
    probes = np.add.reduceat((role >= BOTH).astype(np.int64), starts)
    data = np.add.reduceat((role <= BOTH).astype(np.int64), starts)
    pairs = data * probes
    small = np.flatnonzero((pairs > 0) & (pairs <= 256))
    sums = np.cumsum(pairs[small])
    for some in np.split(small, np.searchsorted(sums, np.arange(1_000_000, sums[-1], 1_000_000))) if len(small) else []:
        n = pairs[some]
        group = np.repeat(some, n)
        k = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
        a = starts[group] + k // probes[group]
        b = ends[group] - probes[group] + k % probes[group]
        table = (bucket[a] >> 40) // MOST_PARTS
        linked = (node[a] != node[b]) & (np.bitwise_count(fps[a, table] ^ fps[b, table]) <= distance)
        a, b = a[linked], b[linked]
        if total is not None:
            near = np.bitwise_count(fps[a] ^ fps[b]).sum(axis=1, dtype=np.int64) <= total
            a, b = a[near], b[near]
        yield node[a], node[b]
    for g in np.flatnonzero(pairs > 256):
        d, p = slice(starts[g], starts[g] + data[g]), slice(ends[g] - probes[g], ends[g])
        yield forest(node[d], node[p], fps[d], fps[p], int(bucket[starts[g]] >> 40) // MOST_PARTS, distance, total)


def _verify(distance: int, total: int | None):
    def out(a: np.ndarray, b: np.ndarray):
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], names=["a", "b"])

    def links_in(rows: list[np.ndarray]):
        fps = np.stack(rows[4:], axis=1).view(np.uint64)
        for a, b in _links_of(*rows[:4], fps, distance, total):
            if len(a):
                yield out(a, b)

    def run(batches):
        held: list[np.ndarray] | None = None
        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held:
                now = [np.concatenate([h, x]) for h, x in zip(held, now, strict=True)]
            same = (now[0] == now[0][-1]) & (now[1] == now[1][-1]) if len(now[0]) else np.zeros(0, bool)
            cut = len(same) - int(same.sum())  # the last bucket may go on in the next batch
            held = [x[cut:] for x in now]
            if cut:
                yield from links_in([x[:cut] for x in now])
        if held and len(held[0]):
            yield from links_in(held)

    return run


def links(nodes: DataFrame, tables: int = 1, distance: int = DISTANCE, total: int | None = None, parts: int | None = None) -> DataFrame:
    """Pairs (a, b) of nodes whose components are those of all pairs within the distance in some table (and within `total` over all tables).

    nodes: a table of `node` and a word for each table, all words together distinct.
    """
    spark = nodes.sparkSession
    plans = spark.sparkContext.broadcast(make_plans(nodes, nodes.count(), tables, distance, parts))
    names = ["node", *words(tables)]
    entries = nodes.select(*names).mapInArrow(_entries(plans), f"bucket long, block long, role int, {_longs(names)}")
    dealt = entries.repartition("bucket", "block").sortWithinPartitions("bucket", "block", "role")
    return dealt.mapInArrow(_verify(distance, total), "a long, b long").distinct()


# --- components ------------------------------------------------------------------------------


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of the pairs (a, b), the root being the least node of its component in numeric order."""
    edges = materialise(pairs.select("a", "b").filter("a <> b"), "edges")
    mapping: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")).select(F.col("a").alias("node"), "to"), "hooks")
        while True:  # halve the paths until every node points at a root
            nxt = hooks.select(F.col("node").alias("to"), F.col("to").alias("further"))
            jumped = materialise(hooks.join(nxt, "to", "left").select("node", F.col("further").alias("to"), (F.col("further") != F.col("to")).alias("moved")), "hooks")
            settled = jumped.filter("moved").isEmpty()
            drop(hooks)
            hooks = jumped
            if settled:
                break
        on_a, on_b = hooks.select(F.col("node").alias("a"), F.col("to").alias("ra")), hooks.select(F.col("node").alias("b"), F.col("to").alias("rb"))
        left = materialise(edges.join(on_a, "a").join(on_b, "b").filter("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
        drop(edges)
        edges = left
        if mapping is None:
            mapping = hooks
        else:
            further = hooks.select(F.col("node").alias("to"), F.col("to").alias("further"))
            joined = materialise(mapping.join(further, "to", "left").select("node", F.coalesce("further", "to").alias("to")), "roots")
            drop(mapping, hooks)
            mapping = joined
    if mapping is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return mapping.select("node", F.col("to").alias("root"))


# --- exact similarity ------------------------------------------------------------------------


def _similar(similarity: float):
    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                (one,), (other,) = unpack(a.as_py(), ["<u8"]), unpack(b.as_py(), ["<u8"])
                both = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(both >= similarity * (len(one) + len(other) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    return run


def similar_links(pairs: DataFrame, prints: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets of shingles have at least this Jaccard similarity. pairs: a written table of rows of prints.

    A node of many links is copied, so that no task has them all.
    """
    asked = broadcast_up_to(materialise(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), "asked"), BROADCAST_KEYS)
    sets = materialise(prints.select(F.col("row").alias("node"), "shingles").join(asked, "node"), "shingles")
    met = pairs.select("a", "b")
    for side, other in (("a", "b"), ("b", "a")):
        hubs = pairs.groupBy(F.col(side).alias("node")).agg(F.ceil(F.count(F.lit(1)) / LINKS_A_TASK).alias("copies")).filter("copies > 1")
        hubs = broadcast_up_to(materialise(hubs, "hubs"), BROADCAST_KEYS)
        copied = sets.join(hubs, "node", "left").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("copies", F.lit(1)) - 1)))
        dealt = met.join(hubs.withColumnRenamed("node", side), side, "left").withColumn("copy", F.pmod(F.xxhash64(other), F.coalesce("copies", F.lit(1)))).drop("copies")
        met = dealt.join(copied.select(F.col("node").alias(side), "copy", F.col("shingles").alias(f"of_{side}")), [side, "copy"]).drop("copy")
    return met.select("a", "b", "of_a", "of_b").mapInArrow(_similar(similarity), "a long, b long")


def _tallies(batches):
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in batches:
        for packed in batch.column(0):
            np.add.at(counts, unpack(packed.as_py(), ["<u8"])[0] >> np.uint64(HASH_BITS - SKETCH_BITS), 1)
    if counts.any():
        yield _packed_tallies(dict(enumerate(np.split(counts, SKETCH_PARTS))))


def _packed_tallies(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
    packed = [pack([np.minimum(x, 0xFFFFFFFF).astype("<u4")]) for x in parts.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array(packed, pa.binary())], names=["place", "counts"])


def _added(batches):
    parts: dict[int, np.ndarray] = {}
    for batch in batches:
        for place, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            parts[place] = parts.get(place, 0) + unpack(packed.as_py(), ["<u4"])[0].astype(np.int64)
    if parts:
        yield _packed_tallies(parts)


def shingle_counts(prints: DataFrame) -> np.ndarray:
    """How often shingles of each cell occur, in all sets."""
    kind = "place int, counts binary"
    counts = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.uint32)
    for place, packed in prints.select("shingles").mapInArrow(_tallies, kind).repartition("place").mapInArrow(_added, kind).collect():
        counts[place] = unpack(bytes(packed), ["<u4"])[0]
    return counts.ravel()


def prefix(shingles: np.ndarray, counts: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, place) of the rarest shingles: sets of this similarity at least have one in common. Those of no other set are left out."""
    seen = np.minimum(counts[shingles >> np.uint64(HASH_BITS - SKETCH_BITS)], (1 << 63 - HASH_BITS) - 1).astype(np.uint64)
    ordered = np.sort(seen << np.uint64(HASH_BITS) | shingles)[: len(shingles) - math.ceil(similarity * len(shingles) - SLACK) + 1]
    at = np.flatnonzero(ordered >> np.uint64(HASH_BITS) > 1)
    return ordered[at].view(np.int64), at


def _prefixes(shared, similarity: float):
    def run(batches):
        counts = shared.value

        def out(found):
            which = np.repeat(np.arange(len(found)), [len(f[4]) for f in found])
            arrays = [pa.array(np.concatenate([f[4] for f in found]), pa.int64()), *(pa.array(np.array([f[k] for f in found], np.int64)[which], pa.int64()) for k in range(4)), pa.array(np.concatenate([f[5] for f in found]), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["shingle", "node", "label", "size", "n", "at"])

        for batch in batches:
            found, rows = [], 0
            for node, label, size, packed in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3), strict=True):
                (own,) = unpack(packed.as_py(), ["<u8"])
                shingles, at = prefix(own, counts, similarity)
                found.append((node, label, size, len(own), shingles, at))
                rows += len(at)
                if rows > 65536:
                    yield out(found)
                    found, rows = [], 0
            if rows:
                yield out(found)

    return run


def candidates(prints: DataFrame, nodes: DataFrame, roots: DataFrame, own: list[str], similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes of different groups that can have this similarity: group_a, group_b, and how many of their rarest shingles they share.

    A shingle that only one group has gives no pairs; the largest group of a shingle meets the others, not itself. A
    shingle of many nodes is dealt in blocks.
    """
    spark = prints.sparkSession
    counts = spark.sparkContext.broadcast(shingle_counts(prints))
    groups = roots.join(roots.groupBy("root").agg(F.count(F.lit(1)).alias("size")), "root")
    marks = nodes.join(groups, "node", "left").filter("root is not null or rows > 1").select(*own, "node", F.coalesce("root", "node").alias("label"), F.coalesce("size", F.lit(1)).alias("size"))
    marks = broadcast_up_to(materialise(marks, "groups"), BROADCAST_KEYS)
    members = prints.select(*own, "row", "shingles").join(marks, own, "left").filter("node is null or node = row")
    members = members.select(F.col("row").alias("node"), F.coalesce("label", "row").alias("label"), F.coalesce("size", F.lit(1)).alias("size"), "shingles")
    rows = members.mapInArrow(_prefixes(counts, similarity), _longs(["shingle", "node", "label", "size", "n", "at"]))
    each = Window.partitionBy("shingle")
    ranked = rows.select("shingle", "node", "n", "at", F.struct((-F.col("size")).alias("less"), "label").alias("rank"))
    met = ranked.select("*", F.min("rank").over(each).alias("first"), F.max("rank").over(each).alias("last"), F.ceil(F.count(F.lit(1)).over(each) / BLOCK).alias("blocks")).filter("first <> last")
    met = materialise(met.drop("last"), "met")
    mine, others = F.pmod(F.xxhash64("node"), F.col("blocks")), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    one = met.filter("rank <> first").select("shingle", mine.alias("x"), others.alias("y"), *(F.col(c).alias(f"{c}_a") for c in ("node", "n", "at", "rank")))
    other = met.select("shingle", mine.alias("y"), others.alias("x"), *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "at", "rank")))
    longer = F.greatest("n_a", "n_b") * similarity - SLACK <= F.least("n_a", "n_b")
    enough = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= (F.col("n_a") + F.col("n_b")) * (similarity / (1 + similarity)) - SLACK
    pairs = one.join(other, ["shingle", "x", "y"]).filter((F.col("rank_b") < F.col("rank_a")) & longer & enough)
    pairs = pairs.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b"), F.col("rank_a.label").alias("group_a"), F.col("rank_b.label").alias("group_b")).agg(F.count(F.lit(1)).alias("shared"))
    pairs = materialise(pairs, "candidates")
    drop(met)
    return pairs


def missed_links(prints: DataFrame, nodes: DataFrame, roots: DataFrame, own: list[str], similarity: float) -> DataFrame:
    """Pairs (a, b) that hold, of nodes of different groups; with the groups they connect all that have the similarity. roots: (node, root) of the groups so far.

    Of the pairs of a node and a group the likeliest is looked at first, then all pairs that are still apart.
    """
    pairs = candidates(prints, nodes, roots, own, similarity)
    likeliest = pairs.groupBy("a", "group_a", "group_b").agg(F.max(F.struct("shared", "b")).alias("best"))
    likeliest = materialise(likeliest.select("a", F.col("best.b").alias("b"), "group_a", "group_b"), "likeliest")
    held = materialise(similar_links(likeliest, prints, similarity), "links")
    joined = materialise(components(likeliest.join(held, ["a", "b"]).select(F.col("group_a").alias("a"), F.col("group_b").alias("b"))), "joined")
    left = pairs.join(likeliest.select("a", "b"), ["a", "b"], "left_anti")
    for side in ("a", "b"):
        left = left.join(joined.select(F.col("node").alias(f"group_{side}"), F.col("root").alias(f"root_{side}")), f"group_{side}", "left")
    left = left.filter(F.coalesce("root_a", "group_a") != F.coalesce("root_b", "group_b"))
    left = materialise(left.select("a", "b"), "left")
    return held.union(materialise(similar_links(left, prints, similarity), "links"))


def bits_apart(similarity: float, bits: int, deviations: float) -> int:
    """Bits in which texts of this Jaccard similarity (of shingle sets of like size) differ, and so many standard deviations more."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(bits * share + deviations * math.sqrt(bits * share * (1 - share)))


# --- over a table ----------------------------------------------------------------------------


def _with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _among(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows joined with keys (id, text_key, and more), broadcast up to BROADCAST_KEYS of them."""
    other = broadcast_up_to(keys.withColumnsRenamed({"id": "other_id", "text_key": "other_key"}), BROADCAST_KEYS)
    return rows.join(other, rows["id"].eqNullSafe(other["other_id"]) & (rows["text_key"] == other["other_key"]), how)


def _nodes(docs: DataFrame, id_col: str, text_col: str, words_each: int, tables: int) -> tuple[DataFrame, DataFrame]:
    """The table (id, text_key, words) of all rows; and (words, node) of all fingerprints, with the least id, the rows, and the key of one of them."""
    ship(docs.sparkSession)
    prints = materialise(fingerprint_table(docs, id_col, text_col, words_each, tables), "fingerprints")
    grouped = prints.groupBy(*words(tables)).agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows"), F.min(F.struct("id", "text_key")).alias("one"))
    return prints, materialise(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")


def _named(prints: DataFrame, nodes: DataFrame, pairs: DataFrame, own: list[str]) -> DataFrame:
    """prints with component_id: the least id a row is linked with over any number of the pairs. own: the columns that tell nodes apart.

    Only nodes of several rows or with links have to be looked up, by a broadcast up to BROADCAST_KEYS of them.
    """
    roots = materialise(components(pairs), "roots")
    rooted = roots.join(nodes.select("node", "least"), "node")
    least = materialise(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    linked = roots.join(least, "root").select("node", "component_id", F.lit(True).alias("is_linked"))
    named = nodes.join(linked, "node", "left").filter("is_linked or rows > 1").select(*own, F.coalesce("component_id", "least").alias("component_id"))
    named = broadcast_up_to(materialise(named, "components"), BROADCAST_KEYS)
    return prints.join(named, own, "left").withColumn("component_id", F.coalesce("component_id", "id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = SHINGLE_WORDS, distance: int = DISTANCE, parts: int | None = None) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits) and component_id, the least id it is linked with over any number of links."""
    prints, nodes = _nodes(docs, id_col, text_col, words_each, 1)
    named = _named(prints, nodes, links(nodes, 1, distance, None, parts), words(1))
    return named.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("w0"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, words_each: int = 5, tables: int = 4, distance: int = 9, parts: int | None = None) -> DataFrame:
    """docs with one document, that of least id, of each group of near duplicates; all columns as they were.

    Texts are near duplicates from a Jaccard similarity of their sets of shingles on; none of these links is lost, and equal
    sets are one node. Most are found by fingerprints of the sets: one table of 64 bits would miss many, so there are
    several independent ones: a pair is found by the pigeonhole search if any table is within `distance` and all together
    are within bits_apart(similarity) of two and a half deviations, and linked if its exact similarity reaches the bound.
    The rest are found by missed_links().
    A row is known by its id and text; of rows equal in both, one stays. Where no row of a group has an id, all stay.
    """
    ship(docs.sparkSession)
    prints = materialise(set_table(docs, id_col, text_col, words_each, tables), "fingerprints")
    own = ["set_key", *words(tables)]
    nodes = materialise(prints.groupBy(*own).agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows"), F.min("row").alias("node")), "nodes")
    pairs = materialise(links(nodes, tables, distance, bits_apart(similarity, 64 * tables, 2.5), parts), "pairs")
    roots = materialise(components(similar_links(pairs, prints, similarity)), "roots")
    found = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(missed_links(prints, nodes, roots, own, similarity))
    rows = _with_key(docs, id_col, text_col)
    named = _named(prints, nodes, found, own)
    gone = materialise(named.filter(~F.col("id").eqNullSafe(F.col("component_id"))).select("id", "text_key"), "gone")
    kept = _among(rows.drop("text"), gone, "left_anti")
    again = materialise(prints.filter("id is not null").groupBy("id", "text_key").count().filter("count > 1").select("id", "text_key"), "again")
    if not again.isEmpty():
        kept = _among(kept, again, "left_anti").union(_among(kept, again, "left_semi").dropDuplicates(["id", "text_key"]))
    return kept.select("row.*")

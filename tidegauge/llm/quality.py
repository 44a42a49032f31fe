"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of character n-grams, trained on trusted text.

A symbol is a UTF-16 code unit, so each letter, mark and digit of every script in common
use has its own (rarer characters take two), and a 4-gram is 64 bits.

Training. A hashed share of the trusted texts, one in FOLDS, is held out. The 4-grams of
the others are counted per task, then per gram; lower orders hold continuation counts, the
number of different symbols seen before a gram. Discounts D1, D2 and D3+ come from the
counts of counts of each order. The two middle symbols of a 4-gram decide its shard, where
its context, the trigram it backs off to and that one's context lie as well; bigrams, which
are few, go to every shard that may ask for them. So a shard has all that its
probabilities need, and they are computed there, one shuffle for all orders.

Scoring is a join of counts, shard by shard, at every size. A block of documents becomes
one packed row a shard: its distinct grams, which documents have each, and how often.
These rows meet the model's shards sorted by shard, the model's row first, so a task holds
one shard and streams the blocks past it; shards are salted, so there are more tasks than
shards. Each row gives the block's documents a partial sum, and the sums of a block meet again.

A document is judged by its mean code length, drawn to the held-out mean by
PRIOR_SYMBOLS characters so that a short one is not judged by a few, against the quantile
of the held-out documents of its language, exact to a bin of 1/BINS bit. Where a language
has too few for its own quantile, the limit is its mean and the quantile of how far the
held-out documents of all languages are from the mean of the others of their language;
where it has none, the quantile of all of them. Where all of them are too few for that
quantile, DEVIATIONS standard deviations stand in for it if they reach further.

Defined results: without text there is no perplexity and the document is rejected; if
no trusted text exists, or none is held out, nothing else is; a null lang is a language of
its own; labels without id or quality play no part, repeated ones count once, and of
conflicting ones any 1 makes a document trusted; repeated documents are judged each; an
empty table gives an empty result; further columns pass through keep_good() unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.packed import pack, unpack
from tidegauge.session import broadcast_up_to, drop, materialise, ship

ORDER = 4
BITS = 16
SYMBOLS = 1 << BITS
#: Shards are one of LAST_PARTS by the last symbol but one, and of these one of BEFORE_PARTS by the one before it.
LAST_PARTS = BEFORE_PARTS = 4
SHARDS = LAST_PARTS * BEFORE_PARTS
QUANTILE = 0.995
PRIOR_SYMBOLS = 200
FOLDS = 4
BINS = 1000
DEVIATIONS = 3
BLOCK_DOCS = 1024
BLOCK_CHARS = 2_000_000
#: Characters of one text whose grams are held at once.
SLICE_CHARS = 1 << 20
MAX_FILTER_BITS = 1 << 28
#: Up to so many trusted or rejected ids, or languages, go to every executor; beyond that the joins shuffle.
BROADCAST_IDS = 2_000_000
BROADCAST_LANGS = 100_000


def grams(text: str) -> np.ndarray:
    """The n-gram that ends at each symbol, symbol 0 standing before the first."""
    symbols = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2").astype(np.uint64)
    padded = np.concatenate([np.zeros(ORDER - 1, np.uint64), symbols])
    out = np.zeros(len(symbols), np.uint64)
    for k in range(ORDER):
        out = out << np.uint64(BITS) | padded[k : k + len(symbols)]
    return out


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams in order, and how often each occurs; long texts are counted by slices."""
    if len(text) <= SLICE_CHARS:
        return np.unique(grams(text), return_counts=True)
    found, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for at in range(0, len(text), SLICE_CHARS):
        before = text[max(0, at - ORDER + 1) : at]
        own, n = np.unique(grams(before + text[at : at + SLICE_CHARS])[len(before.encode("utf-16-le", "surrogatepass")) // 2 :], return_counts=True)
        found, counts = united([found, own], [counts, n])
    return found, counts


def united(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, back = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(back, weights=np.concatenate(counts), minlength=len(found)).astype(np.int64)


def _part(symbol, parts: int):
    """One of so many parts by a symbol: the same in numpy and as a Spark column."""
    if isinstance(symbol, Column):
        return F.shiftright(((symbol * 40503) % SYMBOLS) * parts, BITS).cast("int")
    return ((symbol.astype(np.int64) * 40503 % SYMBOLS) * parts >> BITS).astype(np.int32)


def shard_of(before, last):
    """Of the two symbols before the last one of a gram."""
    return _part(last, LAST_PARTS) * BEFORE_PARTS + _part(before, BEFORE_PARTS)


def _symbol(gram, back: int):
    """The symbol so many places before the last."""
    if isinstance(gram, Column):
        return F.shiftrightunsigned(gram, BITS * back).bitwiseAND(SYMBOLS - 1)
    return (gram >> np.uint64(BITS * back)) & np.uint64(SYMBOLS - 1)


# --- trusted rows ----------------------------------------------------------------------------


def _filter_cells(ids: np.ndarray, cells: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) ^ (ids.astype(np.uint64) >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return np.stack([(mixed >> np.uint64(s)) & np.uint64(cells - 1) for s in (0, 16, 35)], axis=1).astype(np.int64)


def _filter_rows(cells: int):
    def run(batches):
        for batch in batches:
            found = np.unique(_filter_cells(batch.column(0).to_numpy(), cells))
            for segment in np.unique(found >> 16):
                own = (found[found >> 16 == segment] & 0xFFFF).astype("<u2")
                yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([own.tobytes()], pa.binary())], names=["segment", "cells"])

    return run


def _maybe_trusted(shared, cells: int):
    def run(batches):
        table = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            at = _filter_cells(batch.column(0).to_numpy(), cells)
            yield batch.filter(pa.array(((table[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1), pa.bool_()))

    return run


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Labels: doc_id and quality."""
    own = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("trusted_id")).distinct()
    return materialise(own, "trusted")


def trusted_texts(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The texts of docs with a trusted id, as a column `text`."""
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    n = trusted.count()
    if n <= BROADCAST_IDS:
        return rows.join(F.broadcast(trusted), rows["id"] == trusted["trusted_id"], "left_semi").select("text")
    cells = 1 << 16
    while cells < 8 * n and cells < MAX_FILTER_BITS:
        cells *= 2
    bits = np.zeros(cells // 8, np.uint8)  # at most MAX_FILTER_BITS / 8 bytes, whatever the input
    for segment, own in trusted.mapInArrow(_filter_rows(cells), "segment int, cells binary").toLocalIterator():
        at = np.frombuffer(own, "<u2").astype(np.int64) + (segment << 16)
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    shared = docs.sparkSession.sparkContext.broadcast(bits.tobytes())
    own = rows.mapInArrow(_maybe_trusted(shared, cells), "id long, text string")
    return own.join(trusted, own["id"] == trusted["trusted_id"], "left_semi").select("text")


def is_held_out(text_key: Column) -> Column:
    """Equal texts share a fold."""
    return F.pmod(text_key, F.lit(FOLDS)) == 0


# --- model -----------------------------------------------------------------------------------


def _count_grams(batches):
    for batch in batches:
        held, size = [], 0
        texts = batch.column(0)
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            if text:
                held.append(gram_counts(text))
                size += len(held[-1][0])
            if held and (size > SLICE_CHARS or i == batch.num_rows - 1):
                found, n = united([g for g, _ in held], [c for _, c in held])
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["gram", "n"])
                held, size = [], 0


def discounts_from(n: list[int]) -> list[float]:
    """D1, D2 and D3+ of modified Kneser-Ney from the counts of the counts 1 to 4; where these don't allow an estimate, an absolute discount."""
    if not n[0] or not n[1]:
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    found = [i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else 0.9 * i for i in (1, 2, 3)]
    return [min(max(d, 0.05), 0.95 * i) for i, d in enumerate(found, 1)]


def unigram_probabilities(seen: dict[int, int]) -> np.ndarray:
    """By symbol, from the number of different symbols seen before each; what the discount frees is shared by all."""
    counts = np.zeros(SYMBOLS)
    counts[list(seen)] = list(seen.values())
    d = np.array([0.0, *discounts_from([int((counts == i).sum()) for i in (1, 2, 3, 4)])])
    less = d[np.minimum(counts, 3).astype(int)]
    return (counts - less) / counts.sum() + less.sum() / counts.sum() / SYMBOLS


class Model:
    """Rows (shard, model), and log2 probabilities of the symbols alone; None where nothing was learnt."""

    def __init__(self, shards: DataFrame, unigrams: np.ndarray):
        self.shards, self.unigrams = shards, unigrams


def train(texts: DataFrame) -> Model | None:
    """texts: a column `text`."""
    raw = texts.mapInArrow(_count_grams, "gram long, n long")
    four = materialise(raw.groupBy("gram").agg(F.sum("n").alias("n")), "grams4")

    def shorter(counts: DataFrame, order: int) -> DataFrame:
        return counts.groupBy(F.col("gram").bitwiseAND((1 << BITS * order) - 1).alias("gram")).agg(F.count(F.lit(1)).alias("n"))

    three = materialise(shorter(four, 3), "grams3")
    two = materialise(shorter(three, 2), "grams2")
    ones = {r["gram"]: r["n"] for r in shorter(two, 1).collect()}  # at most SYMBOLS rows
    if not ones:
        return None
    unigrams = unigram_probabilities(ones)
    levels = {4: four, 3: three, 2: two}
    few = [df.filter("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("of")).select(F.lit(k).alias("order"), "n", "of") for k, df in levels.items()]
    of = {(r["order"], r["n"]): r["of"] for r in few[0].union(few[1]).union(few[2]).collect()}  # 12 rows
    discounts = {k: discounts_from([of.get((k, i), 0) for i in (1, 2, 3, 4)]) for k in levels}
    gram = F.col("gram")
    own = [levels[k].select(shard_of(_symbol(gram, 2), _symbol(gram, 1)).alias("shard"), F.lit(k).alias("order"), "gram", "n") for k in (4, 3)]
    every = F.explode(F.array(*(_part(_symbol(gram, 1), LAST_PARTS) * BEFORE_PARTS + i for i in range(BEFORE_PARTS))))
    own.append(two.select(every.alias("shard"), F.lit(2).alias("order"), "gram", "n"))
    shared = texts.sparkSession.sparkContext.broadcast(unigrams)
    dealt = own[0].union(own[1]).union(own[2]).repartition(SHARDS, "shard").sortWithinPartitions("shard")
    shards = materialise(dealt.mapInArrow(_build_shards(shared, discounts), "shard int, model binary"), "model")
    drop(four, three, two)
    return Model(shards, np.log2(unigrams))


def _build_shards(shared, discounts: dict[int, list[float]]):
    """One row a shard, from rows sorted by shard."""

    def row(shard: int, held: dict[int, list]):
        levels = {}
        for order, parts in held.items():
            keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            at = np.argsort(keys)
            levels[order] = (keys[at], n[at])
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([pack(shard_arrays(levels, discounts, shared.value))], pa.binary())], names=["shard", "model"])

    def run(batches):
        current, held = None, {}
        for batch in batches:
            shards, orders, keys, n = (c.to_numpy() for c in batch.columns)
            for shard in np.unique(shards).tolist():
                if shard != current:
                    if current is not None:
                        yield row(current, held)
                    current, held = shard, {}
                for order in (4, 3, 2):
                    mine = (shards == shard) & (orders == order)
                    if mine.any():
                        held.setdefault(order, []).append((keys[mine].view(np.uint64), n[mine]))
        if current is not None:
            yield row(current, held)

    return run


#: For orders 4, 3 and 2: grams, log2 of their probabilities, contexts, and log2 of what a context leaves to the lower order.
KINDS = ["<u8", "<f4", "<u8", "<f4"] * 3


def shard_arrays(levels: dict[int, tuple[np.ndarray, np.ndarray]], discounts: dict[int, list[float]], unigrams: np.ndarray) -> list[np.ndarray]:
    """levels: by order, sorted grams of a shard and their counts."""
    out, below = [], None
    for order in (2, 3, 4):
        keys, n = levels.get(order, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
        less = np.array([0.0, *discounts[order]])[np.minimum(n, 3)]
        contexts, own = np.unique(keys >> np.uint64(BITS), return_inverse=True)
        total = np.bincount(own, weights=n, minlength=len(contexts))
        rest = np.bincount(own, weights=less, minlength=len(contexts)) / total
        suffix = keys & np.uint64((1 << BITS * (order - 1)) - 1)
        lower = unigrams[suffix.astype(np.int64)] if below is None else below[1][np.searchsorted(below[0], suffix)]
        p = (n - less) / total[own] + rest[own] * lower
        below = (keys, p)
        out = [keys, np.log2(p).astype("<f4"), contexts, np.log2(rest).astype("<f4"), *out]
    return out


class Shard:
    def __init__(self, packed: bytes | None, unigrams: np.ndarray):
        arrays = unpack(packed, KINDS) if packed else [np.zeros(0, kind) for kind in KINDS]
        self.tables = {order: arrays[4 * i : 4 * i + 4] for i, order in enumerate((4, 3, 2))}
        self.unigrams = unigrams

    def log2p(self, wanted: np.ndarray) -> np.ndarray:
        out = self.unigrams[(wanted & np.uint64(SYMBOLS - 1)).astype(np.int64)]
        for order in (2, 3, 4):
            keys, p, contexts, rest = self.tables[order]
            if not len(keys):
                continue
            gram = wanted & np.uint64((1 << BITS * order) - 1)
            at = np.minimum(np.searchsorted(contexts, gram >> np.uint64(BITS)), len(contexts) - 1)
            out = out + np.where(contexts[at] == gram >> np.uint64(BITS), rest[at].astype(np.float64), 0.0)
            at = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
            out = np.where(keys[at] == gram, p[at].astype(np.float64), out)
        return out


# --- scoring ---------------------------------------------------------------------------------

HEAD = -1
NAMES = ["shard", "first", "block", "packed", "ids", "keys", "langs", "lengths"]


def _blocks(kind: pa.DataType):
    """Per block of documents: a head row with ids, keys, languages and lengths, and a packed row a shard."""

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                every, lengths, size = [], [], 0
                while at < batch.num_rows and len(every) < BLOCK_DOCS and size < BLOCK_CHARS:
                    text = batch.column(3)[at].as_py() or ""
                    size += len(text)
                    lengths.append(len(text))
                    every.append(gram_counts(text))
                    at += 1
                first = at - len(every)
                packed = list(pack_block(every))
                n = len(packed)
                own = [batch.column(i).slice(first, len(every)).to_pylist() for i in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([HEAD, *(s for s, _ in packed)], pa.int32()),
                        pa.array([False] * (n + 1)),
                        pa.array([part << 32 | number] * (n + 1), pa.int64()),
                        pa.array([None, *(p for _, p in packed)], pa.binary()),
                        *(pa.array([values, *[None] * n], pa.list_(t)) for values, t in zip([*own, lengths], [kind, pa.int64(), pa.string(), pa.int64()], strict=True)),
                    ],
                    names=NAMES,
                )
                number += 1

    return run


def pack_block(every: list[tuple[np.ndarray, np.ndarray]]):
    """(shard, bytes): distinct grams, how many documents have each, which, and how often."""
    keys = np.concatenate([g for g, _ in every])
    counts = np.concatenate([n for _, n in every])
    docs = np.repeat(np.arange(len(every), dtype=np.uint16), [len(g) for g, _ in every])
    shards = shard_of(_symbol(keys, 2), _symbol(keys, 1)).astype(np.int8)
    for shard in range(SHARDS):
        own = np.flatnonzero(shards == shard)
        if not len(own):
            continue
        own = own[np.argsort(keys[own], kind="stable")]  # documents stay in order within a gram
        mine, doc, n = keys[own], docs[own], counts[own]
        new = np.r_[True, mine[1:] != mine[:-1]]
        starts = np.flatnonzero(new)
        steps = np.where(new, doc, np.diff(doc, prepend=np.uint16(0))).astype("<u2")
        many = np.flatnonzero(n > 255)
        yield shard, pack([mine[starts], np.diff(np.r_[starts, len(own)]).astype("<u2"), steps, np.minimum(n, 255).astype("u1"), many.astype("<u4"), n[many].astype("<i8")])


def unpack_block(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct grams, documents that have each, these documents, count of the gram in each)."""
    distinct, sizes, steps, counts, many, large = unpack(packed, ["<u8", "<u2", "<u2", "u1", "<u4", "<i8"])
    sizes, steps = sizes.astype(np.int64), steps.astype(np.int64)
    along = np.cumsum(steps)
    starts = np.cumsum(sizes) - sizes
    docs = along - np.repeat(along[starts] - steps[starts], sizes)
    counts = counts.astype(np.int64)
    counts[many] = large
    return distinct, sizes, docs, counts


def _score(shared):
    """Rows sorted by shard and salt, that of the model first; sums as little-endian doubles, one for each document of the block."""

    def run(batches):
        current, shard = None, None
        for batch in batches:
            sums: list[bytes | None] = []
            shards, firsts, packs = batch.column("shard").to_pylist(), batch.column("first").to_pylist(), batch.column("packed")
            for i, (number, is_model) in enumerate(zip(shards, firsts, strict=True)):
                if number == HEAD:
                    sums.append(None)
                    continue
                if is_model or number != current:
                    current, shard = number, Shard(packs[i].as_py() if is_model else None, shared.value)
                if is_model:
                    sums.append(None)
                    continue
                distinct, sizes, docs, counts = unpack_block(packs[i].as_py())
                sums.append(np.bincount(docs, weights=np.repeat(-shard.log2p(distinct), sizes) * counts).astype("<f8").tobytes())
            out = pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("block", "shard", "ids", "keys", "langs", "lengths")), pa.array(sums, pa.binary())], names=["block", "shard", "ids", "keys", "langs", "lengths", "bits"])
            yield out.filter(pa.array([not x for x in firsts], pa.bool_()))

    return run


def _unite(kind: pa.DataType):
    """Rows sorted by block, heads first: one row a document."""

    def run(batches):
        head, total = None, None

        def rows():
            ids, keys, langs, lengths = head
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(keys, pa.int64()), pa.array(langs, pa.string()), pa.array(lengths, pa.int64()), pa.array(total, pa.float64())], names=["id", "text_key", "lang", "symbols", "bits"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] == HEAD:
                    if head is not None:
                        yield rows()
                    head, total = (row["ids"], row["keys"], row["langs"], row["lengths"]), np.zeros(len(row["ids"]))
                else:
                    own = np.frombuffer(row["bits"], "<f8")
                    total[: len(own)] += own
        if head is not None:
            yield rows()

    return run


def code_lengths(docs: DataFrame, model: Model, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Per row of docs: id, text_key, lang, symbols (its characters) and the bits they take under the model."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_key"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    sql_kind, kind = docs.schema[id_col].dataType.simpleString(), to_arrow_type(docs.schema[id_col].dataType)
    lists = f"ids array<{sql_kind}>, keys array<long>, langs array<string>, lengths array<long>"
    salts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")) // SHARDS)
    blocks = rows.mapInArrow(_blocks(kind), f"shard int, first boolean, block long, packed binary, {lists}").withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
    shards = model.shards.select("shard", F.lit(True).alias("first"), F.lit(None).cast("long").alias("block"), F.col("model").alias("packed"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    met = blocks.unionByName(shards, allowMissingColumns=True).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.desc("first"))
    scored = met.drop("salt").mapInArrow(_score(spark.sparkContext.broadcast(model.unigrams)), f"block long, shard int, {lists}, bits binary")
    dealt = scored.repartition("block").sortWithinPartitions("block", "shard")
    return dealt.mapInArrow(_unite(kind), f"id {sql_kind}, text_key long, lang string, symbols long, bits double")


# --- limits ----------------------------------------------------------------------------------


def quantile_by(values: DataFrame, key: str, value: str, quantile: float) -> DataFrame:
    """(key, q): the least multiple of 1/BINS that at least this share of the key's values doesn't exceed. What is merged of a key is as long as its values' range."""
    bins = values.select(key, F.ceil(F.round(F.col(value) * BINS, 6)).alias("bin"))
    return bins.groupBy(key).agg((F.expr(f"percentile_disc({quantile}) WITHIN GROUP (ORDER BY bin)") / BINS).alias("q"))


def limits_of(known: DataFrame, quantile: float) -> tuple[DataFrame, float | None]:
    """(lang, n, limit) and the limit of languages not among these, from held-out rows (lang, drawn)."""
    centres = materialise(known.groupBy("lang").agg(F.round(F.avg("drawn"), 9).alias("centre"), F.count(F.lit(1)).alias("n")), "centres")  # a row a language
    apart = known.join(broadcast_up_to(centres, BROADCAST_LANGS), "lang").filter("n > 1")
    apart = apart.select(F.lit(0).alias("all"), ((F.col("drawn") - F.col("centre")) * F.col("n") / (F.col("n") - 1)).alias("apart"))
    spread = quantile_by(apart, "all", "apart", quantile).first()
    wide = apart.agg(F.count(F.lit(1)).alias("n"), F.round(DEVIATIONS * F.stddev_samp("apart"), 9).alias("w")).first()
    beyond = max(spread["q"], wide["w"] if wide["n"] * (1 - quantile) < 1 and wide["w"] is not None else -np.inf) if spread else 0.0
    pooled = quantile_by(known.select(F.lit(0).alias("all"), "drawn"), "all", "drawn", quantile).first()
    limit = F.when(F.col("n") * (1 - quantile) >= 1, F.col("q")).otherwise(F.col("centre") + F.lit(float(beyond)))
    limits = centres.join(quantile_by(known, "lang", "drawn", quantile), "lang").select("lang", "n", limit.alias("limit"))
    return materialise(limits, "limits"), pooled["q"] if pooled else None


def _judged(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, quantile: float) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    trusted = trusted_ids(labels)
    model = train(trusted_texts(docs, trusted, id_col, text_col).filter(~is_held_out(F.xxhash64("text"))))
    if model is None:
        text = F.col(text_col).cast("string")
        none = F.lit(None).cast("double")
        bare = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("symbols"))
        return bare.select("*", none.alias("perplexity"), none.alias("threshold"), (F.col("symbols") > 0).alias("kept"))
    scores = materialise(code_lengths(docs, model, id_col, text_col, lang_col).withColumn("lang", F.coalesce("lang", F.lit(""))), "scores")
    ids = broadcast_up_to(trusted, BROADCAST_IDS)
    own = scores.filter((F.col("symbols") > 0) & is_held_out(F.col("text_key")))
    known = materialise(own.join(ids, own["id"].cast("long") == ids["trusted_id"], "left_semi").select("lang", "symbols", "bits"), "held_out")
    # rounded, so that the order of summing shows nowhere
    mean = known.agg(F.round(F.sum("bits") / F.sum("symbols"), 9).alias("m")).first()["m"]
    drawn = F.round((F.col("bits") + PRIOR_SYMBOLS * F.lit(mean).cast("double")) / (F.col("symbols") + PRIOR_SYMBOLS), 9)
    limits, pooled = limits_of(known.select("lang", drawn.alias("drawn")), quantile)
    judged = scores.join(broadcast_up_to(limits, BROADCAST_LANGS), "lang", "left").withColumn("limit", F.coalesce("limit", F.lit(pooled).cast("double")))
    return judged.select(
        "id",
        "text_key",
        "symbols",
        F.when(F.col("symbols") > 0, F.pow(F.lit(2.0), F.col("bits") / F.col("symbols"))).alias("perplexity"),
        F.pow(F.lit(2.0), "limit").alias("threshold"),
        ((F.col("symbols") > 0) & (F.col("limit").isNull() | (drawn <= F.col("limit")))).alias("kept"),
    )


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE) -> DataFrame:
    """Per document: doc_id, n_chars, perplexity (per character), threshold (of its language) and kept."""
    judged = _judged(docs, labels, id_col, text_col, lang_col, quantile)
    return judged.select(F.col("id").alias(id_col), F.col("symbols").alias("n_chars"), "perplexity", "threshold", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE) -> DataFrame:
    """docs without those that classify() rejects, all columns as they were. Rows equal in id, text and language share one verdict."""
    judged = _judged(docs, labels, id_col, text_col, lang_col, quantile)
    gone = materialise(judged.filter(~F.col("kept")).select(F.col("id").alias("gone_id"), F.col("text_key").alias("gone_key")), "rejected")
    gone = broadcast_up_to(gone, BROADCAST_IDS)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_key"))
    return rows.join(gone, rows["id"].eqNullSafe(gone["gone_id"]) & (rows["text_key"] == gone["gone_key"]), "left_anti").select("row.*")

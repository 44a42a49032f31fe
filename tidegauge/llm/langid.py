"""Language identification by prediction by partial matching (PPM) over bytes.

Each language has a tree of byte contexts of up to three bytes, with the counts of
what followed. The code length of a byte is that of its longest known context, by
escape method C: a context seen n times with u different successors gives a
successor seen c times c / (n + u), and an escape to the next shorter context
u / (n + u); bytes that a longer context would have coded are excluded there, and
below the empty context the bytes left share what is left evenly. The statistics
are frozen: scoring never changes them. A text's language is the one whose tree
codes all of its bytes in the fewest bits.

Training takes about `docs_per_language` documents of each language, whole, chosen
by a hash of id and text: a documented bound on the model, not on what is scored. Scoring
has no shuffle. All four-byte strings seen in training get their code length in
every language once; other strings are coded by the same trees when they occur.

Defined results: a null text, or one without a letter, is `und` with score 0, as is
every text if there is nothing to learn from; ties go to the name that sorts first;
a null id counts as the empty string for the hold-out; repeated rows are scored
each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.session import ship

ORDER = 3
DOCS_PER_LANGUAGE = 400
#: A model holds a tree for each; more is an error rather than a worse answer.
MOST_LANGUAGES = 400
#: Two-byte strings of each half of a four-byte string that the direct index knows.
INDEXED_PAIRS = 4000
UNDETERMINED = "und"
#: Code lengths held at once, over all languages.
CELLS = 1 << 22


def remainder(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte with the three before it, as one number; and where each text starts. Before a text come zero bytes."""
    pad = bytes(ORDER)
    joined = np.frombuffer(pad.join([b"", *texts, b""]), np.uint8).astype(np.uint32)
    grams = joined[:-3] << 24 | joined[1:-2] << 16 | joined[2:-1] << 8 | joined[3:]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return grams, np.cumsum(np.r_[0, lengths[:-1] + ORDER]) if len(texts) else np.zeros(0, np.int64)


class ContextTree:
    """The contexts of one language, longest first: successors by (context, byte), and totals by context."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.levels = []
        longer = None
        for order in range(ORDER, -1, -1):
            mask = np.uint64((1 << 8 * (order + 1)) - 1)
            keys, back = np.unique(grams.astype(np.uint64) & mask, return_inverse=True)
            seen = np.bincount(back, weights=counts, minlength=len(keys))
            contexts, own = np.unique(keys >> np.uint64(8), return_inverse=True)
            total = np.bincount(own, weights=seen, minlength=len(contexts))
            kinds = np.bincount(own, minlength=len(contexts)).astype(np.float64)
            self.levels.append((keys, seen, contexts, total, kinds))
            if longer is not None:  # what the longer context excludes here: the counts of its successors in this one
                long_keys, long_contexts = longer
                excluded = seen[np.searchsorted(keys, long_keys & mask)]
                self.excluded.append(np.bincount(np.searchsorted(long_contexts, long_keys >> np.uint64(8)), weights=excluded, minlength=len(long_contexts)))
            else:
                self.excluded = []
            longer = (keys, contexts)

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each four-byte string, after the first three."""
        grams = grams.astype(np.uint64)
        out = np.zeros(len(grams))
        going = np.arange(len(grams))
        less_total, less_kinds = np.zeros(len(grams)), np.zeros(len(grams))
        for depth, order in enumerate(range(ORDER, -1, -1)):
            keys, seen, contexts, total, kinds = self.levels[depth]
            wanted = grams[going] & np.uint64((1 << 8 * (order + 1)) - 1)
            context, known = self._find(contexts, wanted >> np.uint64(8))
            symbol, coded = self._find(keys, wanted)
            n, u = total[context] - less_total, kinds[context] - less_kinds
            coded &= known
            out[going[coded]] += np.log2((n + u)[coded]) - np.log2(seen[symbol[coded]])
            escapes = known & ~coded & (u > 0)
            out[going[escapes]] += np.log2((n + u)[escapes]) - np.log2(u[escapes])
            less_kinds = np.where(known, kinds[context], 0.0)
            if order:
                less_total = np.where(known, self.excluded[depth][context], 0.0)
            stay = ~coded
            going, less_total, less_kinds = going[stay], less_total[stay] if order else less_total[stay], less_kinds[stay]
        out[going] += np.log2(256 - less_kinds)
        return out


class Model:
    """Trees by language, and a direct index from four-byte strings seen in training to their code lengths in all languages."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.key = uuid.uuid4().hex
        self.languages = sorted(counts)
        self.trees = [ContextTree(*counts[x]) for x in self.languages]
        self.grams = np.unique(np.concatenate([counts[x][0] for x in self.languages])) if counts else np.zeros(0, np.uint32)

    def lengths(self, grams: np.ndarray) -> np.ndarray:
        return np.stack([t.bits(grams) for t in self.trees], axis=1)

    def build(self) -> None:
        """On each worker: the index. 0 is a string that isn't in it."""

        def places(pairs: np.ndarray) -> tuple[np.ndarray, int]:
            found, n = np.unique(pairs, return_counts=True)
            found = np.sort(found[np.argsort(-n, kind="stable")[:INDEXED_PAIRS]])
            place = np.zeros(65536, np.int32)
            place[found] = np.arange(1, len(found) + 1)
            return place, len(found) + 1

        self.first, rows = places(self.grams >> 16)
        self.second, self.columns = places(self.grams & 0xFFFF)
        at = self.first[self.grams >> 16].astype(np.int64) * self.columns + self.second[self.grams & 0xFFFF]
        indexed = (self.first[self.grams >> 16] > 0) & (self.second[self.grams & 0xFFFF] > 0)
        self.index = np.zeros(rows * self.columns, np.int32)
        self.index[at[indexed]] = np.arange(1, indexed.sum() + 1)
        self.table = np.vstack([np.zeros(len(self.languages)), self.lengths(self.grams[indexed])])

    @property
    def block(self) -> int:
        """Bytes scored at once."""
        return max(1024, CELLS // len(self.languages))

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """[string, language]."""
        at = self.index[self.first[grams >> 16].astype(np.int64) * self.columns + self.second[grams & 0xFFFF]]
        bits = self.table[at]
        missing = np.flatnonzero(at == 0)
        if len(missing):
            new, back = np.unique(grams[missing], return_inverse=True)
            bits[missing] = self.lengths(new)[back]
        return bits

    def score(self, texts: list[bytes]) -> np.ndarray:
        """[text, language]: bits. No text may be empty; one longer than a block comes alone and is scored in slices."""
        if len(texts) == 1 and len(texts[0]) > self.block:
            text, total = texts[0], 0
            for at in range(0, len(text), self.block):
                before = min(at, ORDER)
                part = text[at - before : at + self.block]
                total = total + self.bits(grams_of([part])[0][before : len(part)]).sum(axis=0)
            return total[None, :]
        grams, starts = grams_of(texts)
        bits = self.bits(grams)
        ends = starts + np.fromiter(map(len, texts), np.int64, len(texts))
        edges = np.stack([starts, ends], axis=1).ravel()[:-1]
        return np.add.reduceat(bits[: ends[-1]], edges, axis=0)[::2]


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (remainder(F.col(id_col)) != 1))
    sizes = labelled.groupBy(F.col(lang_col).alias("lang")).count().limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    if not sizes:
        return Model({})
    share = F.create_map(*(F.lit(x) for row in sizes for x in (row["lang"], docs_per_language / row["count"])))[F.col(lang_col)]
    sample = labelled.filter(F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 30)) < share * (1 << 30))
    counted = sample.select(F.col(lang_col).alias("lang"), F.col(text_col).cast("string")).mapInArrow(_count, "lang string, gram long, n long")
    counts: dict[str, list] = {}
    for lang, gram, n in counted.groupBy("lang", "gram").agg(F.sum("n")).toLocalIterator():  # bounded by the sample
        counts.setdefault(lang, []).append((gram, n))
    return Model({lang: (np.array([g for g, _ in rows], np.uint32), np.array([n for _, n in rows], np.float64)) for lang, rows in counts.items()})


def _count(batches):
    for batch in batches:
        langs = batch.column(0).to_pylist()
        texts = [t.encode() for t in batch.column(1).to_pylist()]
        for lang in sorted(set(langs)):
            grams, starts = grams_of(own := [t for t, x in zip(texts, langs, strict=True) if x == lang and t])
            inside = np.zeros(len(grams) + 1, np.int32)
            if own:
                np.add.at(inside, starts, 1)
                np.add.at(inside, starts + np.fromiter(map(len, own), np.int64, len(own)), -1)
            found, n = np.unique(grams[np.cumsum(inside[:-1]) > 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64), pa.int64()), pa.array(n, pa.int64())], names=["lang", "gram", "n"])


_built: dict[str, Model] = {}


def _model(shared) -> Model:
    model = shared.value
    if model.key not in _built:
        _built.clear()
        model.build()
        _built[model.key] = model
    return _built[model.key]


def _predict(shared):
    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if shared is not None:
                model, block, size = _model(shared), [], 0

                def flush():
                    bits = model.score([t for _, t in block])
                    least = bits.argmin(axis=1)
                    share = 1 / np.exp2(np.maximum(bits[np.arange(len(bits)), least][:, None] - bits, -1000)).sum(axis=1)
                    for (i, _), at, s in zip(block, least.tolist(), share.tolist(), strict=True):
                        langs[i], scores[i] = model.languages[at], s
                    block.clear()

                for i, text in enumerate(texts):
                    if text and any(map(str.isalpha, text)):
                        coded = text.encode()
                        if block and size + len(coded) > model.block:
                            flush()
                            size = 0
                        block.append((i, coded))
                        size += len(coded)
                if block:
                    flush()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """Per document: doc_id, held_out (it took no part in training), lang_pred and score, the share of the best language if all were as likely before."""
    spark = docs.sparkSession
    ship(spark)
    model = train(docs, id_col, text_col, lang_col, docs_per_language)
    shared = spark.sparkContext.broadcast(model) if model.languages else None
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), (remainder(F.col(id_col)) == 1).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_predict(shared), f"doc_id {kind}, held_out boolean, lang_pred string, score double")

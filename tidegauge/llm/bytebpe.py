"""Byte-level BPE encoding by overlapping chunks, and decoding.

A long text is cut into chunks that overlap. Each chunk is split into pre-tokens
and encoded by itself, in parallel. Where a chunk begins it may cut a pre-token,
so its first boundaries can be wrong, as can its last one. But the split only
looks ahead: two scans that share one boundary share all that follow. So the
stitch walks the chunks of a document, enters each at the first boundary that is
known to be right and that the chunk has as well, and takes the chunk's encoded
pre-tokens from there. A run longer than the overlap, which leaves no common
boundary, is split anew from the last right boundary over the joined chunks, twice as
many each time, so that the work stays in proportion to the run.
Texts of one chunk take the same path without a shuffle.

Decoding concatenates the bytes of the ids; they needn't be whole characters
until they are all there.

Defined results: a null text is the empty text, with no ids; repeated rows are
encoded each (rows are told apart by a row key, not by their id); null ids pass
through; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import array
import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.packed import pack, unpack
from tidegauge.llm.patterns import Splitter
from tidegauge.session import ship

CHUNK = 32_768
OVERLAP = 1_024
CACHED_PIECES = 400_000
#: How far past its start a match may look to choose a contraction; nearer to a chunk's end no boundary is certain.
LOOKAHEAD = 4
RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class Vocabulary:
    """Ranks of a tiktoken file; encodes single pre-tokens, which it remembers, and decodes ids."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.pattern = Splitter(pattern)
        self.known: dict[str, bytes] = {}

    def piece(self, text: str) -> bytes:
        """Ids of one pre-token as little-endian unsigned 32-bit integers."""
        ids = self.known.get(text)
        if ids is None:
            if len(self.known) >= CACHED_PIECES:
                self.known.clear()
            ids = array.array("I", self.encoding._encode_single_piece(text)).tobytes()
            if len(text) < 64:
                self.known[text] = ids
        return ids

    def encode(self, text: str) -> bytes:
        known = self.known
        return b"".join([known.get(p) or self.piece(p) for p in self.pattern.of(text).findall(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(1)
def vocabulary_of(ranks_path: str, pattern: str) -> Vocabulary:
    """One for each Python worker, which serves many tasks."""
    return Vocabulary(ranks_path, pattern)


def chunks_of(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, str]]:
    """(start, text) of each chunk; the last one ends where the text does."""
    start = 0
    while True:
        yield start, text[start : start + chunk + overlap]
        if start + chunk + overlap >= len(text):
            return
        start += chunk


def split_chunk(vocabulary: Vocabulary, start: int, text: str) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Boundaries (the start and each end, in the whole text), the count of ids up to each, and the ids."""
    ends, counts, ids = [start], [0], []
    total = 0
    for match in vocabulary.pattern.of(text).finditer(text):
        coded = vocabulary.piece(match[0])
        total += len(coded) // 4
        ends.append(start + match.end())
        counts.append(total)
        ids.append(coded)
    return np.array(ends, np.int64), np.array(counts, np.int64), b"".join(ids)


def stitch(vocabulary: Vocabulary, chunks: list[tuple]) -> bytes:
    """The ids of a text from its chunks in order: (start, text, ends, counts, ids)."""
    out, at, i, more = [], 0, 0, 1
    while i < len(chunks):
        start, text, ends, counts, ids = chunks[i]
        last = i + 1 == len(chunks)
        # bridge from the boundary that is right to the first that this chunk has too
        first = int(np.searchsorted(ends, at))
        while not (first < len(ends) and ends[first] == at):
            match = vocabulary.pattern.any_text.match(text, at - start)
            if match is None or (not last and match.end() > len(text) - LOOKAHEAD):
                break
            out.append(vocabulary.piece(match[0]))
            at = start + match.end()
            first = int(np.searchsorted(ends, at))
        synced = first < len(ends) and ends[first] == at
        if last:
            if synced:
                out.append(ids[4 * int(counts[first]) :])
            return b"".join(out)
        # leave at the first boundary that the next chunk has as well; none near the end of a chunk is certain
        certain = ends[first:][ends[first:] <= start + len(text) - LOOKAHEAD] if synced else ends[:0]
        if not len(certain):
            certain = np.array([at])
        following = chunks[i + 1]
        shared = certain[np.isin(certain, following[2], assume_unique=True)]
        leave = int(shared[0]) if len(shared) else int(certain[-1])
        if synced:
            out.append(ids[4 * int(counts[first]) : 4 * int(counts[np.searchsorted(ends, leave)])])
        at = leave
        if leave < following[0]:  # a run longer than the overlap: split the text of this and further chunks anew from here
            parts, end, j = [text[leave - start :]], start + len(text), min(i + more, len(chunks) - 1)
            for next_start, next_text, *_ in chunks[i + 1 : j + 1]:
                parts.append(next_text[end - next_start :])
                end = next_start + len(next_text)
            joined = "".join(parts)
            chunks[j] = (leave, joined, *split_chunk(vocabulary, leave, joined))
            i, more = j, 2 * more
        else:
            i, more = i + 1, 1
    return b"".join(out)


def _digest(vocabulary: Vocabulary, ids: bytes) -> tuple[int, str, str]:
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(vocabulary.decode(ids)).hexdigest()


def _table(ids: list, kind: pa.DataType, results: list[tuple]) -> pa.RecordBatch:
    counts, coded, decoded = zip(*results, strict=True) if results else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _encode_short(ranks_path: str, pattern: str):
    def run(batches):
        vocabulary = vocabulary_of(ranks_path, pattern)
        for batch in batches:
            results = []
            for at in range(0, batch.num_rows, 256):
                results += [_digest(vocabulary, vocabulary.encode(t or "")) for t in batch.column(1).slice(at, 256).to_pylist()]
            yield _table(batch.column(0).to_pylist(), batch.schema.field(0).type, results)

    return run


def _cut_long(chunk: int, overlap: int):
    def run(batches):
        for batch in batches:
            kind = batch.schema.field(1).type
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                starts, texts = zip(*chunks_of(text, chunk, overlap), strict=True)
                n = len(starts)
                for a in range(0, n, 64):  # a very long text leaves in several batches
                    k = len(starts[a : a + 64])
                    yield pa.RecordBatch.from_arrays([pa.array([row] * k, pa.int64()), pa.array([doc_id] * k, kind), pa.array(starts[a : a + 64], pa.int64()), pa.array(texts[a : a + 64], pa.string())], names=["row_key", "doc_id", "start", "text"])

    return run


def _encode_chunks(ranks_path: str, pattern: str):
    def run(batches):
        vocabulary = vocabulary_of(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                part = batch.slice(at, 32)
                done = [split_chunk(vocabulary, s, t) for s, t in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                steps = [pack([np.diff(ends).astype("<u4"), np.diff(counts).astype("<u4"), np.frombuffer(ids, "<u4")]) for ends, counts, ids in done]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(steps, pa.binary())], names=["row_key", "doc_id", "start", "text", "coded"])

    return run


def _stitch_group(ranks_path: str, pattern: str):
    def run(table: pa.Table) -> pa.Table:
        vocabulary = vocabulary_of(ranks_path, pattern)
        chunks = []
        for row in table.sort_by("start").select(["start", "text", "coded"]).to_pylist():
            steps, counts, ids = unpack(row["coded"], ["<u4"] * 3)
            chunks.append((row["start"], row["text"], row["start"] + np.r_[0, np.cumsum(steps, dtype=np.int64)], np.r_[0, np.cumsum(counts, dtype=np.int64)], ids.tobytes()))
        doc_id = table.column("doc_id")[0].as_py()
        return pa.Table.from_batches([_table([doc_id], table.schema.field("doc_id").type, [_digest(vocabulary, stitch(vocabulary, chunks))])])

    return run


def encode_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per document: doc_id, n_tokens, and SHA-256 of its ids and of the bytes they decode to."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    is_long = F.coalesce(F.length("text") > chunk + overlap, F.lit(False))
    short = rows.filter(~is_long).mapInArrow(_encode_short(ranks_path, pattern), f"doc_id {kind}, {RESULT}")
    long = rows.withColumn("row_key", F.monotonically_increasing_id()).filter(is_long).select("row_key", "doc_id", "text")
    chunks = long.mapInArrow(_cut_long(chunk, overlap), f"row_key long, doc_id {kind}, start long, text string").repartition("row_key", "start")
    coded = chunks.mapInArrow(_encode_chunks(ranks_path, pattern), f"row_key long, doc_id {kind}, start long, text string, coded binary")
    # the chunks of one document are as much as its one row was
    stitched = coded.groupBy("row_key").applyInArrow(_stitch_group(ranks_path, pattern), f"doc_id {kind}, {RESULT}")
    return short.union(stitched)

"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents are tokenised where they are read and only the lengths of their pieces
travel on. Each task packs its share by online best-fit over a fixed number of
open bins: a bitset with one bit for each amount of free space finds the tightest
open bin that takes a piece in a few machine words; when all bins are open and
none fits, the fullest closes. A bin that is full closes at once.

Pieces are dealt to tasks by a hash and sorted by it within a task, so a repeated
task packs as it did before and a source that holds a third of all rows is spread.
A task leaves at most `open_bins` sequences unfilled; the pieces of a task grow
with the partition size, not with the number of tasks, so that share stays small.

Defined results: a null text is the empty text, which still has its closing id;
repeated rows are packed each; null ids are packed like others; an empty table
gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.patterns import Splitter
from tidegauge.session import ship

SEQUENCE_TOKENS = 4096
END_ID = 1
OPEN_BINS = 2048
CACHED_WORDS = 250_000
#: Only words up to this long are remembered, which bounds the cache's bytes.
CACHED_CHARS = 64
#: str.split() also splits at these, the tokenizer doesn't.
ODD_SPACES = re.compile("[\x1c-\x1f]")
#: Ends a word for the merges: no byte of UTF-8.
WORD_END = b"\xff"
#: Below this, texts are in normal form C and lower-cased character by character; beyond it the tokenizer itself encodes.
BEYOND_PLAIN = re.compile("[^\x00-\u024f]")


class WordEncoder:
    """Token ids of texts as little-endian bytes.

    No token spans white space, so each distinct word is encoded once while it is remembered. A new
    word is split by the tokenizer's own pattern and its byte merges are looked up by rank, the mark
    that ends a word standing as one more byte that merges with the last one first. Words with
    characters past U+024F or with a special token's opening go through the tokenizer as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        model = json.loads(self.tokenizer.to_str())
        pattern = model["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        ends, vocabulary = model["model"]["end_of_word_suffix"], model["model"]["vocab"]
        char_byte = {c: b for b, c in byte_characters().items()}
        tokens = {}
        for token, token_id in vocabulary.items():
            ended = token.endswith(ends) and len(token) > len(ends)
            raw = bytes(char_byte[c] for c in (token.removesuffix(ends) if ended else token))
            if WORD_END not in raw:
                tokens[raw + WORD_END * ended] = token_id
        # merges by order of ids, which is that of the merges; a byte with the word's end comes before all merges
        singles = [bytes([b]) + WORD_END for b in range(255)]
        merged = sorted((t for t in tokens if len(t) > 1 and t not in set(singles)), key=tokens.__getitem__)
        order = [*singles, *merged, *(bytes([b]) for b in range(256))]
        self.ids = [tokens.get(t, 0).to_bytes(4, "little") for t in order]
        self.merges = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(order)}, special_tokens={})._core_bpe
        self.pattern = Splitter(pattern).plain_text
        self.known: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: str) -> bytes:
        if "<|" in word or BEYOND_PLAIN.search(word):
            return self.whole(word)
        out = []
        for unit in self.pattern.findall(word.lower()):
            ids = self.units.get(unit)
            if ids is None:
                if len(self.units) > CACHED_WORDS:
                    self.units.clear()
                ids = b"".join([self.ids[i] for i in self.merges.encode_single_piece(unit.encode() + WORD_END)])
                if len(unit) <= CACHED_CHARS:
                    self.units[unit] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        out, known = [], self.known
        for text in texts:
            if ODD_SPACES.search(text):
                out.append(self.whole(text))
                continue
            if len(known) > CACHED_WORDS:
                known.clear()
            words = text.split()
            long = {}
            for word in words:
                if word not in known:
                    (known if len(word) <= CACHED_CHARS else long)[word] = self.word(word)
            out.append(b"".join([known[w] for w in words] if not long else [long[w] if w in long else known[w] for w in words]))
        return out


@lru_cache(1)
def word_encoder(path: str) -> WordEncoder:
    """One for each Python worker, which serves many tasks."""
    return WordEncoder(path)


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(prints)]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


def cut(n_tokens: int, size: int) -> list[tuple[int, int, int]]:
    """(piece, start, length) of a document: only one longer than a sequence is cut."""
    return [(i, start, min(size, n_tokens - start)) for i, start in enumerate(range(0, n_tokens, size))]


def _pieces(path: str, size: int, end_id: int):
    def run(batches):
        encoder = word_encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for at in range(0, len(ids), 256):
                texts = [t or "" for t in batch.column(1).slice(at, 256).to_pylist()]
                for doc_id, coded in zip(ids[at : at + 256], encoder.encode(texts), strict=True):
                    coded += end
                    for piece, start, length in cut(len(coded) // 4, size):
                        rows.append((doc_id, piece, start, length, zlib.crc32(coded[4 * start : 4 * (start + length)])))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE_TOKENS, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(_pieces(tokenizer_path, size, end_id), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class BestFit:
    """Bounded-space online best-fit. place(length) gives (bin, offset)."""

    def __init__(self, size: int, open_bins: int, first_bin: int = 0):
        self.size, self.most, self.next_bin = size, open_bins, first_bin
        self.free = 0  # bit f is set if an open bin has f free tokens
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]
        self.open = 0

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            own = self.bins[space].pop()
            self.open -= 1
            if not self.bins[space]:
                self.free ^= 1 << space
        else:
            own, space = self.next_bin, self.size
            self.next_bin += 1
        left = space - length
        if left:
            if self.open >= self.most:
                fullest = (self.free & -self.free).bit_length() - 1
                if left <= fullest:
                    return own, self.size - space
                self.bins[fullest].pop()
                self.open -= 1
                if not self.bins[fullest]:
                    self.free ^= 1 << fullest
            self.bins[left].append(own)
            self.free |= 1 << left
            self.open += 1
        return own, self.size - space


def _pack(size: int, open_bins: int):
    def run(batches):
        packer = BestFit(size, open_bins, TaskContext.get().partitionId() << 40)
        for batch in batches:
            placed = [packer.place(n) for n in batch.column("length").to_pylist()]
            bins, offsets = zip(*placed, strict=True) if placed else ((), ())
            columns = [batch.column(i) for i in range(5)] + [pa.array(bins, pa.int64()), pa.array(offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, size: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS) -> DataFrame:
    """Adds sequence_id and offset to tokenised_pieces()."""
    dealt = pieces.withColumn("deal", F.xxhash64("doc_id", "piece", "ids_crc32")).repartition("deal").sortWithinPartitions("deal", "doc_id", "piece", "length")
    kind = pieces.schema["doc_id"].dataType.simpleString()
    return dealt.drop("deal").mapInArrow(_pack(size, open_bins), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE_TOKENS, end_id: int = END_ID, open_bins: int = OPEN_BINS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents to placed pieces, see tokenised_pieces() and pack()."""
    return pack(tokenised_pieces(docs, tokenizer_path, size, end_id, id_col, text_col), size, open_bins)

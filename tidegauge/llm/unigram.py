"""Token counts under a unigram model, by dynamic programming shared through a trie.

A text's pre-tokens are its runs of non-white-space (space and \\t to \\r are
white space), each led by the vocabulary's word mark; white space itself counts
nothing. The best segmentation of a pre-token is the one with the highest sum of
piece scores, and of equal sums the one with fewer pieces; a character without a
piece costs one byte piece for each of its UTF-8 bytes.

The distinct pre-tokens of a block go into a trie. A depth-first walk computes
the forward score of each node once, from the scores of its ancestors, whichever
number of pre-tokens run through it; at a terminal node the count of pieces of
the best segmentation is stored, and each occurrence just looks it up. Pre-tokens of more
than TRIE_CHARS characters are scored by the same step, one by one.

The vocabulary file orders pieces by merge rank and holds no probabilities, so a
piece of rank r scores by Zipf's law, -log(r + 1), up to a constant. Nothing is
trained. A count depends on the pre-token only, so blocks need no exchange: the
operator has no shuffle, and no key can be hot.

Defined results: a null or empty text has 0 tokens; null ids pass through;
repeated rows are counted each; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import gc
import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.session import ship

WORD_MARK = "▁"
CACHED_WORDS = 400_000
#: Longer pre-tokens, which hardly share prefixes, are scored alone and not remembered: a trie would take a node a character.
TRIE_CHARS = 64
PRE_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def load_scores(model_path: str) -> tuple[dict[str, float], float]:
    """Scores of the pieces, and of one byte piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    scores, rank = {}, 0
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            scores[model.id_to_piece(i)] = -math.log(rank + 1)
            rank += 1
    return scores, -math.log(rank + 1)


def vocabulary_trie(scores: dict[str, float]) -> dict:
    """Pieces by character; the entry under the empty string is the score of the piece that ends there."""
    root: dict = {}
    for piece, score in scores.items():
        node = root
        for char in piece:
            node = node.setdefault(char, {})
        node[""] = score
    return root


def forward(char: str, pieces: dict, byte_score: float, score: float, minus: int, begun: list) -> tuple[float, int, list]:
    """From the forward value before a character to that after it: score, minus the pieces, and the pieces begun that go on.

    A forward value is (score, minus the pieces), so that the larger of two is the better. begun: the vocabulary nodes
    reached, each with the forward value it started from.
    """
    best, best_minus, going, alone = -math.inf, 0, [], False
    for at, from_score, from_minus in [*begun, (pieces, score, minus)]:
        reached = at.get(char)
        if reached is not None:
            going.append((reached, from_score, from_minus))
            own = reached.get("")
            if own is not None:
                alone = alone or at is pieces
                total = from_score + own
                if total > best or (total == best and from_minus - 1 > best_minus):
                    best, best_minus = total, from_minus - 1
    if not alone:
        k = len(char.encode("utf-8", "surrogatepass"))
        total = score + k * byte_score
        if total > best or (total == best and minus - k > best_minus):
            best, best_minus = total, minus - k
    return best, best_minus, going


def long_count(word: str, pieces: dict, byte_score: float) -> tuple[int, float]:
    """(number of pieces, score) of one pre-token, which shares no prefix."""
    score, minus, begun = 0.0, 0, []
    for char in word:
        score, minus, begun = forward(char, pieces, byte_score, score, minus, begun)
    return -minus, score


class Trie:
    """Nodes are dicts of children; a node's own entry under the empty string is the pre-token that ends there."""

    def __init__(self, words):
        self.root: dict = {}
        for word in words:
            node = self.root
            for char in word:
                node = node.setdefault(char, {})
            node[""] = word

    def counts(self, pieces: dict, byte_score: float) -> dict[str, tuple[int, float]]:
        """(number of pieces, score) of each pre-token, given the vocabulary's trie."""
        out: dict[str, tuple[int, float]] = {}
        stack = [(self.root, 0.0, 0, [])]
        while stack:
            node, score, minus, begun = stack.pop()
            for char, child in node.items():
                if char == "":
                    out[child] = (-minus, score)
                else:
                    stack.append((child, *forward(char, pieces, byte_score, score, minus, begun)))
        return out


@lru_cache(1)
def vocabulary_of(model_path: str) -> tuple[dict, float, dict[str, tuple[int, float]]]:
    """The vocabulary's trie, the score of a byte piece, and the counts known so far: one for each Python worker, which serves many tasks."""
    scores, byte_score = load_scores(model_path)
    return vocabulary_trie(scores), byte_score, {}


def _count(model_path: str):
    def run(batches):
        collects = gc.isenabled()
        gc.disable()  # tries of many small dicts, without cycles
        try:
            yield from _counted(batches, *vocabulary_of(model_path))
        finally:
            if collects:
                gc.enable()

    return run


def _counted(batches, pieces: dict, byte_score: float, known: dict[str, tuple[int, float]]):
    for batch in batches:
        tokens, words_in, logs = [], [], []
        for at in range(0, batch.num_rows, 1024):
            if len(known) > CACHED_WORDS:
                known.clear()
            split = [PRE_TOKEN.findall(t) if t else [] for t in batch.column(1).slice(at, 1024).to_pylist()]
            new = {w for words in split for w in words if w not in known}
            long = {w: long_count(WORD_MARK + w, pieces, byte_score) for w in new if len(w) > TRIE_CHARS}
            found = Trie(WORD_MARK + w for w in new if w not in long).counts(pieces, byte_score)
            known.update((w[1:], v) for w, v in found.items())
            for words in split:
                stored = [known[w] if w in known else long[w] for w in words] if long else [known[w] for w in words]
                tokens.append(sum(n for n, _ in stored))
                words_in.append(len(words))
                logs.append(sum(s for _, s in stored))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.int64()), pa.array(words_in, pa.int64()), pa.array(logs, pa.float64())], names=["doc_id", "n_tokens", "n_pretokens", "score"])


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, n_pretokens and the summed score of its pieces."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_count(model_path), f"doc_id {kind}, n_tokens long, n_pretokens long, score double")

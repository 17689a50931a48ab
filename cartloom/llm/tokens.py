"""Token counts by a linear longest-match automaton.

A word is cut greedily: always the longest vocabulary piece that starts at the cursor. The automaton
is the vocabulary's trie; each state has a failure link and the number of pieces popped on the way
along it, so one pass over the bytes gives the number of pieces and none is ever built. Words
``[^\\x20\\x09-\\x0D]+`` are read with one leading mark byte (a space), as byte-level vocabularies have
it; for a word-piece vocabulary the mark starts the word-initial pieces. A word that cannot be cut
into pieces counts as one unknown piece.

Null and empty texts have no words and no tokens. Rows are independent: repeated rows and null ids
give rows of their own, an empty table gives an empty result. Only the id and text columns are read.
Memory: the automaton is bounded by the vocabulary, a worker's word cache by ``CACHED_WORDS``.
"""

from __future__ import annotations

import base64
import uuid
from collections import deque
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = b" "
CACHED_WORDS, CACHED_LENGTH = 200_000, 64


def rank_file_pieces(path: str) -> list[bytes]:
    """Pieces of a byte-level vocabulary file of base64 tokens and ranks."""
    with open(path, "rb") as file:
        return [base64.b64decode(line.split()[0]) for line in file if line.strip()]


def word_piece_pieces(vocabulary: Iterable[str], continued: str = "##") -> list[bytes]:
    """Pieces of a word-piece vocabulary: ``continued`` starts those inside a word."""
    return [
        p[len(continued):].encode() if p.startswith(continued) and len(p) > len(continued) else MARK + p.encode()
        for p in vocabulary
    ]


def build_automaton(pieces: Iterable[bytes]) -> dict[str, np.ndarray]:
    """Edges (``state * 256 + byte`` and target), failure links (-1: none) and popped counts."""
    edges: dict[int, int] = {}
    parent, byte, final = [0], [0], [False]
    for piece in pieces:
        state = 0
        for c in piece:
            state, source = edges.get(state << 8 | c, -1), state
            if state < 0:
                state = edges[source << 8 | c] = len(parent)
                parent.append(source)
                byte.append(c)
                final.append(False)
        final[state] = final[state] or state > 0
    children: list[list[int]] = [[] for _ in parent]
    for state in range(1, len(parent)):
        children[parent[state]].append(state)
    fail, pops = [-1] * len(parent), [0] * len(parent)
    queue = deque(children[0])
    while queue:
        state = queue.popleft()
        queue.extend(children[state])
        if final[state]:
            fail[state], pops[state] = 0, 1
            continue
        at, popped = parent[state], 0
        while at >= 0:  # pop pieces off the parent's match until the byte can follow
            popped += pops[at]
            at = fail[at]
            if at >= 0 and (at << 8 | byte[state]) in edges:
                fail[state], pops[state] = edges[at << 8 | byte[state]], popped
                break
    return {
        "edges": np.fromiter(edges.keys(), np.int64, len(edges)), "targets": np.fromiter(edges.values(), np.int32, len(edges)),
        "fail": np.array(fail, np.int32), "pops": np.array(pops, np.int32),
    }


class PieceCounter(dict):
    """Number of pieces per word; remembers short words."""

    def __init__(self, automaton: dict[str, np.ndarray]):
        super().__init__()
        self.edges = dict(zip(automaton["edges"].tolist(), automaton["targets"].tolist(), strict=True))
        self.fail, self.pops = automaton["fail"].tolist(), automaton["pops"].tolist()

    def __missing__(self, word: bytes) -> int:
        n = self.count(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = n
        return n

    def count(self, word: bytes) -> int:
        edges, fail, pops = self.edges, self.fail, self.pops
        state, n = 0, 0
        for c in MARK + word:
            while (after := edges.get(state << 8 | c)) is None:
                n += pops[state]
                state = fail[state]
                if state < 0:
                    return 1
            state = after
        while state:
            n += pops[state]
            state = fail[state]
            if state < 0:
                return 1
        return n


_counters: dict[str, PieceCounter] = {}  # of this worker


def token_counts(docs: DataFrame, pieces: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_words`` and ``n_tokens``."""
    automaton = docs.sparkSession.sparkContext.broadcast(build_automaton(pieces))
    name = uuid.uuid4().hex

    @F.pandas_udf("n_words long, n_tokens long")
    def count(texts: pd.Series) -> pd.DataFrame:
        counter = _counters.get(name)
        if counter is None:
            _counters.clear()
            counter = _counters[name] = PieceCounter(automaton.value)
        n_words, n_tokens = [], []
        for text in texts:
            words = text.encode("utf-8", "surrogatepass").split() if text else []
            n_words.append(len(words))
            n_tokens.append(sum(map(counter.__getitem__, words)))
        return pd.DataFrame({"n_words": n_words, "n_tokens": n_tokens}, dtype="int64")

    counted = docs.select(F.col(id_col).alias("doc_id"), count(F.col(text_col)).alias("counts"))
    return counted.select("doc_id", "counts.n_words", "counts.n_tokens")

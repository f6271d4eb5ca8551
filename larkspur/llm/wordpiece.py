"""Token counts by a linear longest-match automaton.

The vocabulary is a trie with two roots: pieces that may start a word and pieces that
may continue one.  Where the trie has no edge for the next character, a failure link
leads to the state of what is left after the longest pieces are taken off the front,
and the number of pieces taken is stored with the link.  One pass over a word then counts
its greedy pieces; no piece is ever built.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from larkspur.llm import common

_MEMO = 200_000
_START, _NEXT, _NONE = 0, 1, -1
START_MARK = "▁"


def pieces_of(path: str) -> tuple[list[str], list[str]]:
    """(starting, continuing) pieces of a sentencepiece vocabulary.

    A piece with the word mark in front starts a word; one without continues it.
    Control, unknown and byte pieces are left out.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    starting, continuing = [], []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        if piece.startswith(START_MARK):
            starting.append(piece[1:])
        else:
            continuing.append(piece)
    return [p for p in starting if p and START_MARK not in p], [p for p in continuing if START_MARK not in p]


class Automaton:
    """Counts the greedy pieces of words over one vocabulary."""

    def __init__(self, starting: list[str], continuing: list[str]):
        self.edges: list[dict[str, int]] = [{}, {}]
        whole: set[int] = set()
        for root, pieces in ((_START, starting), (_NEXT, continuing)):
            for piece in pieces:
                at = root
                for c in piece:
                    if c not in self.edges[at]:
                        self.edges[at][c] = len(self.edges)
                        self.edges.append({})
                    at = self.edges[at][c]
                whole.add(at)
        self.link = [_NONE] * len(self.edges)
        self.popped = [0] * len(self.edges)
        self._link_up(whole)
        self.memo: dict[str, int] = {}

    def _link_up(self, whole: set[int]) -> None:
        """Breadth first, so that a state's parent and everything shorter is linked already."""
        level = [_START, _NEXT]
        while level:
            below = []
            for state in level:
                for c, child in self.edges[state].items():
                    below.append(child)
                    if child in whole:
                        self.link[child], self.popped[child] = _NEXT, 1
                    else:
                        self.link[child], self.popped[child] = self._walk(self.link[state], c, self.popped[state])
            level = below

    def _walk(self, state: int, c: str, taken: int) -> tuple[int, int]:
        """Follow failure links until `c` has an edge; (state behind it or none, pieces taken)."""
        while state != _NONE and c not in self.edges[state]:
            taken += self.popped[state]
            state = self.link[state]
        return (self.edges[state][c], taken) if state != _NONE else (_NONE, 0)

    def count(self, word: str) -> int:
        """Number of pieces of a word; 0 if some part of it is in no piece."""
        state, taken = _START, 0
        for c in word:
            state, taken = self._walk(state, c, taken)
            if state == _NONE:
                return 0
        while state not in (_NEXT, _NONE):
            taken += self.popped[state]
            state = self.link[state]
        return taken if state == _NEXT else 0

    def count_known(self, word: str) -> int:
        got = self.memo.get(word)
        if got is None:
            got = self.count(word)
            if len(self.memo) >= _MEMO:
                self.memo.clear()
            if len(word) <= 64:
                self.memo[word] = got
        return got


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return Automaton(*pieces_of(path))


def token_counts(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`df` with n_words, n_tokens, n_unknown and most_tokens (of one word) of `text`.

    Words are what white space separates, as they stand.  A word that the vocabulary
    cannot spell counts as one unknown token.  Null and empty texts have zero of everything.
    `path` is a sentencepiece model every executor can open.
    """
    fields = [(n, T.LongType()) for n in ("n_words", "n_tokens", "n_unknown", "most_tokens")]

    def make():
        own = automaton(path)

        def work(texts: pa.Array) -> list[pa.Array]:
            rows = []
            for t in common.as_bytes(texts):
                counts = Counter(common.words(t))
                n = tokens = unknown = most = 0
                for word, k in counts.items():
                    got = own.count_known(word.decode())
                    n += k
                    unknown += k * (got == 0)
                    tokens += k * max(1, got)
                    most = max(most, got, 1)
                rows.append((n, tokens, unknown, most))
            return [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)]

        return work

    return common.add_columns(df, [text], fields, make)

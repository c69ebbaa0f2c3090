"""Token counts: greedy longest-match word pieces by a linear automaton.

The vocabulary is a trie over bytes with an end-of-word symbol.  A node's failure link
leads to where matching goes on once the longest match inside it is popped, and its
popped-token count says how many pieces that pops; a word's count is one pass over its
symbols, no piece is ever built and nothing is matched twice.

Nulls and edge cases: a null or blank text has 0 words and 0 tokens; a byte that no piece covers
counts one token; repeated rows are counted one by one; an empty table gives no rows;
columns but doc_id and text are ignored.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclonespark.llm.common import ship, split_words

END = 256
#: remembered words of a Python worker
MEMO = 500_000


def byte_symbols() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable Latin-1 as itself, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in plain):
        out[chr(256 + i)] = b
    return out


def vocabulary(path: str) -> list[tuple[int, ...]]:
    """Pieces of a tokenizer file as symbols: bytes, and END where a piece ends a word."""
    with open(path, encoding="utf-8") as f:
        pieces = json.load(f)["model"]["vocab"]
    symbols = byte_symbols()
    out = []
    for p in pieces:
        ends = p.endswith("</w>")
        body = p[:-4] if ends else p
        if all(c in symbols for c in body):
            out.append((*[symbols[c] for c in body], *([END] if ends else [])))
    return [p for p in out if p]


class LongestMatch:
    """Automaton of a vocabulary; ``count`` gives the number of greedy pieces of a word."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        step: list[dict[int, int]] = [{}]
        piece = [False]
        for p in pieces:
            node = 0
            for c in p:
                if c not in step[node]:
                    step[node][c] = len(step)
                    step.append({})
                    piece.append(False)
                node = step[node][c]
            piece[node] = True
        fail, pops = [-1] * len(step), [0] * len(step)
        queue = deque([(0, None, 0)])
        while queue:
            node, symbol, parent = queue.popleft()
            if symbol is not None:
                if piece[node]:
                    fail[node], pops[node] = 0, 1
                else:
                    # what the parent pops before its remainder can be followed by the symbol
                    at, popped = fail[parent], pops[parent]
                    while at > -1 and symbol not in step[at]:
                        popped += pops[at]
                        at = fail[at]
                    if at > -1:
                        fail[node], pops[node] = step[at][symbol], popped
            queue.extend((child, c, node) for c, child in step[node].items())
        self.step, self.fail, self.pops = step, fail, pops

    def count(self, word: bytes) -> int:
        """Pieces of ``word`` followed by the end of a word; a symbol that nothing covers is one piece."""
        step, fail, pops = self.step, self.fail, self.pops
        node = total = 0
        for c in (*word, END):
            nxt = step[node].get(c)
            while nxt is None:
                if not node:  # no piece begins with this symbol
                    total += 1
                    break
                if fail[node] < 0:
                    return self._stuck(word)
                total += pops[node]
                node = fail[node]
                nxt = step[node].get(c)
            else:
                node = nxt
        while node:
            if fail[node] < 0:
                return self._stuck(word)
            total += pops[node]
            node = fail[node]
        return total

    def _stuck(self, word: bytes) -> int:
        """A vocabulary that lacks single symbols: match piece by piece, unknown symbols as one piece each."""
        symbols, i, total = (*word, END), 0, 0
        while i < len(symbols):
            node, best, j = 0, 1, i
            while j < len(symbols) and (nxt := self.step[node].get(symbols[j])) is not None:
                node, j = nxt, j + 1
                if self.fail[node] == 0 and self.pops[node] == 1:
                    best = j - i
            i, total = i + best, total + 1
        return total


_AUTOMATA: dict[str, LongestMatch] = {}


def automaton(path: str) -> LongestMatch:
    """The Python worker's own automaton, built once."""
    if path not in _AUTOMATA:
        _AUTOMATA[path] = LongestMatch(vocabulary(path))
    return _AUTOMATA[path]


def count_tokens(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words and n_tokens of every whole, lower-cased text.

    ``vocabulary_path`` is a file of the tokenizers library that ends words with ``</w>``, on every executor.
    """

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = automaton(vocabulary_path).count
        memo: dict[str, int] = {"": 0}
        for batch in batches:
            n_words, n_tokens = [], []
            for t in batch["text"]:
                ws = [] if t is None else split_words(t.lower())
                for w in set(ws):
                    if w not in memo:
                        memo[w] = count(w.encode("utf-8", "surrogatepass"))
                n_words.append(len(ws) - ws.count(""))
                n_tokens.append(sum(map(memo.__getitem__, ws)))
                if len(memo) > MEMO:
                    memo = {"": 0}
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_words": np.asarray(n_words, "int64"), "n_tokens": np.asarray(n_tokens, "int64")})

    ship(docs.sparkSession)
    columns = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return columns.mapInPandas(task, "doc_id long, n_words long, n_tokens long")

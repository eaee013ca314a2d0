"""Token counts by a linear longest-match automaton (operator 10).

Greedy word-piece takes the longest vocabulary entry at every position of a
word. The automaton reads each byte of a word once: where the trie has no next
byte, a node's failure link leads to the state that has the same rest of the
word still open, and the node's popped-token count says how many pieces are
thereby finished. Only counts are kept; no piece is ever built.

Words begin with a marker (one space), so entries with a leading space are
initial pieces and all others continue a word. A word that cannot be cut into
entries counts as one unknown token.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from followrec.llm.textvec import RangeHash, slices, words_of

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Distinct words whose counts a task remembers.
REMEMBER = 500_000


def read_vocabulary(path: str) -> list[bytes]:
    """Entries of a file with one base64 entry and its rank per line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


@dataclass
class Automaton:
    """Trie edges by ``node * 256 + byte``, failure links (-1: none), popped-token counts."""

    edges: dict[int, int] = field(default_factory=dict)
    fail: list[int] = field(default_factory=lambda: [-1])
    pops: list[int] = field(default_factory=lambda: [0])

    @classmethod
    def build(cls, vocabulary: Iterable[bytes]) -> Automaton:
        a = cls()
        whole = set(vocabulary) - {b""}
        depth: list[list[tuple[int, int, int, bool]]] = []  # (parent, byte, node, is entry)
        nodes = 1
        for entry in sorted(whole):
            v = 0
            for k, c in enumerate(entry):
                u = a.edges.get(v << 8 | c)
                if u is None:
                    u = a.edges[v << 8 | c] = nodes
                    nodes += 1
                    if len(depth) <= k:
                        depth.append([])
                    depth[k].append((v, c, u, entry[:k + 1] in whole))
                v = u
        a.fail, a.pops = [-1] * nodes, [0] * nodes
        for level in depth:  # links of shorter strings are complete
            for parent, c, v, is_entry in level:
                if is_entry:
                    a.fail[v], a.pops[v] = 0, 1
                    continue
                z, popped = a.fail[parent], a.pops[parent]
                while z >= 0 and (z << 8 | c) not in a.edges:
                    popped += a.pops[z]
                    z = a.fail[z]
                if z >= 0:
                    a.fail[v], a.pops[v] = a.edges[z << 8 | c], popped
        return a

    def count(self, word: bytes) -> int:
        """Number of greedy pieces of a word, -1 if it has none."""
        edges, fail, pops = self.edges, self.fail, self.pops
        v = n = 0
        for c in word:
            while (u := edges.get(v << 8 | c)) is None:
                n += pops[v]
                v = fail[v]
                if v < 0:
                    return -1
            v = u
        while v:
            n += pops[v]
            v = fail[v]
            if v < 0:
                return -1
        return n


def count_tokens(docs: DataFrame, vocabulary: list[bytes], marker: bytes = b" ") -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown per row of ``docs(doc_id, text)``.

    The automaton is built once and broadcast; its size depends on the vocabulary
    alone. Null, empty and blank texts have no tokens; a null doc_id is kept, and
    repeated rows give equal rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Automaton.build(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = shared.value, {}
        for batch in batches:
            for rows, texts in slices(batch):
                words = words_of(texts)
                keys, first, inverse = np.unique(
                    RangeHash(texts.buf)(words.start, words.end),
                    return_index=True, return_inverse=True)
                if len(known) > REMEMBER:
                    known.clear()
                pieces = np.empty(len(keys), np.int64)
                for i, (key, at) in enumerate(zip(keys.tolist(), first.tolist(), strict=True)):
                    n = known.get(key)
                    if n is None:
                        word = texts.buf[words.start[at]:words.end[at]].tobytes()
                        n = known[key] = automaton.count(marker + word)
                    pieces[i] = n
                each = pieces[inverse]
                total = [np.concatenate([[0], np.cumsum(x)])
                         for x in (np.where(each < 0, 1, each), each < 0)]
                tokens, unknown = (t[words.first[1:]] - t[words.first[:-1]] for t in total)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(words.first), pa.int64()),
                     pa.array(tokens, pa.int64()), pa.array(unknown, pa.int64())],
                    ["doc_id", "n_words", "n_tokens", "n_unknown"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint")

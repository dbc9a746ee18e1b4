"""Token counts by a linear longest-match automaton (operator 1).

Greedy word pieces take the longest vocabulary entry at every place. The
automaton is a trie of the vocabulary with a failure link per node: when the
next byte does not continue the trie, the link leads to the node of what is
left after the greedy pieces of the present prefix were popped, and a
precomputed number says how many pieces those are. Every byte moves the
automaton on once, so a word takes linear time and no piece is ever built.
"""

from __future__ import annotations

import base64
from functools import lru_cache

from pyspark.sql import DataFrame

from tessera.llm.common import Memo, map_batches, tokenizer_path

VOCABULARY = "byte_bpe_50k.tiktoken"
SCHEMA = "doc_id long, n_bytes long, n_words long, n_tokens long"
# Words of longer texts are streamed instead of listed (memory bound).
LISTED_CHARS = 1 << 20


class Automaton:
    """Counts greedy longest-match pieces of byte strings.

    A single byte outside the vocabulary counts as one (unknown) piece, so
    every byte string has a count.
    """

    def __init__(self, vocabulary):
        goto: dict[int, int] = {}
        token, parent, last = [False], [0], [0]
        for piece in [*vocabulary, *(bytes([b]) for b in range(256))]:
            node = 0
            for byte in piece:
                nxt = goto.get(node << 8 | byte)
                if nxt is None:
                    nxt = goto[node << 8 | byte] = len(token)
                    token.append(False)
                    parent.append(node)
                    last.append(byte)
                node = nxt
            token[node] = node != 0
        depth = [0] * len(token)
        for node in range(1, len(token)):  # a parent always precedes its children
            depth[node] = depth[parent[node]] + 1
        fail, popped = [0] * len(token), [0] * len(token)
        for node in sorted(range(1, len(token)), key=depth.__getitem__):
            if token[node]:
                popped[node] = 1
                continue
            at, n = fail[parent[node]], popped[parent[node]]
            while (nxt := goto.get(at << 8 | last[node])) is None:
                n += popped[at]
                at = fail[at]
            fail[node], popped[node] = nxt, n
        self.goto, self.fail, self.popped = goto, fail, popped

    def count(self, word: bytes) -> int:
        goto, fail, popped = self.goto, self.fail, self.popped
        node = n = 0
        for byte in word:
            while (nxt := goto.get(node << 8 | byte)) is None:
                n += popped[node]
                node = fail[node]
            node = nxt
        while node:
            n += popped[node]
            node = fail[node]
        return n


@lru_cache(maxsize=2)
def _counter(path: str | None):
    """The worker's word splitter and memo; one automaton per Python worker."""
    import public_tokenizers
    import regex

    with open(path or tokenizer_path(VOCABULARY), "rb") as lines:
        automaton = Automaton(base64.b64decode(line.split()[0]) for line in lines if line.strip())
    return regex.compile(public_tokenizers.PATTERN), Memo(lambda w: automaton.count(w.encode()))


def token_counts(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """One row per document: doc_id, UTF-8 bytes, words and greedy word pieces.

    Words are the matches of the vocabulary's own split pattern (a word keeps
    its leading space). A null or empty text has 0 of each; repeated rows stay
    repeated; an empty table gives an empty table. No shuffle: each scan
    partition is counted where it is read. ``vocabulary_path`` names a rank
    file on every executor (default: the installed public vocabulary).
    """

    def rows(batch):
        pattern, memo = _counter(vocabulary_path)
        out = {"doc_id": batch.column(0), "n_bytes": [], "n_words": [], "n_tokens": []}
        for text in batch.column(1):
            text = text.as_py() or ""
            n_words = n_tokens = 0
            if len(text) <= LISTED_CHARS:
                words = pattern.findall(text)
                n_words, n_tokens = len(words), sum(map(memo.__getitem__, words))
            else:
                for match in pattern.finditer(text):
                    n_words += 1
                    n_tokens += memo[match[0]]
            out["n_bytes"].append(len(text.encode()))
            out["n_words"].append(n_words)
            out["n_tokens"].append(n_tokens)
        yield out

    return map_batches(docs.select("doc_id", "text"), rows, SCHEMA)

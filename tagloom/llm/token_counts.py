"""Token counts by trie-shared dynamic programming under a unigram model.

Words repeat and begin alike. The distinct pre-tokens of a batch are inserted in a trie; the best score of each prefix, and its number
of pieces, is computed once at the prefix's node and shared by all words below; a word's count is stored at its terminal node.
Counts of frequent words stay in a bounded table for the task's next batches.

The pieces and the order of their scores come from a public vocabulary file; a piece of rank r has the log probability
of Zipf's law, -ln(r + 2) - c.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame

from tagloom.llm.common import text_chunks

CACHE = 300_000
COST = 2.5


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def piece_scores(path: str) -> tuple[dict[bytes, float], int]:
    """Log probability of each piece, and the longest piece. Every single byte is a piece."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return {p: -log(r + 2) - COST for p, r in ranks.items()}, max(map(len, ranks))


class Trie:
    """Nodes are numbers; ``best`` and ``pieces`` are the forward score and piece count of each node's prefix."""

    def __init__(self, scores: dict[bytes, float], longest: int):
        self.scores, self.longest = scores, longest
        self.children: list[dict[int, int]] = [{}]
        self.best, self.pieces = [0.0], [0]
        self.computed = 0

    def insert(self, word: bytes) -> int:
        """Walk or grow the path of ``word``; returns the number of pieces of its best segmentation.

        Of equally good segmentations the one with the longest last piece counts.
        """
        node, path, scores, longest = 0, [0], self.scores, self.longest
        for j in range(1, len(word) + 1):
            nxt = self.children[node].get(word[j - 1])
            if nxt is None:
                top, count = float("-inf"), 0
                for i in range(max(0, j - longest), j):
                    s = scores.get(word[i:j])
                    if s is not None and self.best[path[i]] + s > top:
                        top, count = self.best[path[i]] + s, self.pieces[path[i]] + 1
                nxt = len(self.best)
                self.children[node][word[j - 1]] = nxt
                self.children.append({})
                self.best.append(top)
                self.pieces.append(count)
                self.computed += 1
            node = nxt
            path.append(node)
        return self.pieces[node]


def count_tokens(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` of every row.

    A pre-token is a blank and the word after it; words are parted by ASCII blanks. Null and empty texts count 0;
    repeated rows are counted each; other columns are not read.
    """
    path = ranks or default_ranks()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, longest = piece_scores(path)
        known: dict[bytes, int] = {}
        for batch in batches:
            words_of, tokens_of = [], []
            for _, _, data, bounds in text_chunks(batch["text"]):
                raw = data.tobytes()
                texts = [raw[a:b].split() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                new = set().union(*texts) - known.keys()
                if len(known) + len(new) > CACHE:
                    known.clear()
                    new = set().union(*texts)
                trie = Trie(scores, longest)
                for word in new:
                    known[word] = trie.insert(b" " + word)
                words_of += map(len, texts)
                tokens_of += [sum(map(known.__getitem__, t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(words_of, pa.int64()), pa.array(tokens_of, pa.int64())],
                ["doc_id", "n_pretokens", "n_tokens"],
            )

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_pretokens long, n_tokens long")

"""Token ids of the public byte-level BPE vocabulary, fast enough for a whole corpus.

Ids are those of the ``tokenizers`` library for the given JSON file. Nothing is kept between texts.
"""

from __future__ import annotations

import base64
import json

import numpy as np

VOCABULARY = "byte_bpe_50k"
LONG_TEXT = 1 << 20


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(f"{VOCABULARY}.json")


class Encoder:
    """``ids(text)`` as little-endian unsigned 32-bit bytes. One is made per task."""

    def __init__(self, json_path: str, ranks_path: str | None = None):
        import public_tokenizers
        import tiktoken

        self.json_path, self._whole = json_path, None
        ranks_path = ranks_path or json_path.removesuffix(".json") + ".tiktoken"
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(json_path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f).get("added_tokens", [])]
        self._encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):  # a special token's own string is that token
            if self._whole is None:
                from tokenizers import Tokenizer

                self._whole = Tokenizer.from_file(self.json_path)
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(text) > LONG_TEXT:  # without a Python object for each id
            return self._encoding.encode_to_numpy(text).astype("<u4").tobytes()
        return np.array(self._encoding.encode_ordinary(text), dtype="<u4").tobytes()

"""Subword ids of whole texts by a public tokenizer file, with nothing kept from text to text.

The file names a byte-level BPE vocabulary. Where a token's id is also its rank among the merges, as in the default file,
the ids come from tiktoken, several times as fast as `tokenizers` over the same vocabulary and equal to it
(tests compare both over every code point). Other files, and texts with a very long run of white space, on which
tiktoken's pattern gives up, go through `tokenizers`.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

BYTE_BPE = "byte_bpe_50k.json"
_LONG_SPACE = re.compile(r"\s{2000}")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(BYTE_BPE)


@lru_cache(maxsize=2)
def subwords(path: str) -> "Subwords":
    """One instance per worker process and file: its size is that of the vocabulary."""
    return Subwords(path)


def byte_of_character() -> dict[str, int]:
    """A byte-level vocabulary writes a printable byte as itself and the n-th other byte as U+0100 + n."""
    printable = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + n): b for n, b in enumerate(others)}


def ranks(path: str) -> dict[bytes, int] | None:
    """Bytes and id of each token; None where ids aren't merge ranks or the file does more than byte-level BPE."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (model.get("type") in (None, "BPE") and spec.get("normalizer") is None and split.get("type") == "ByteLevel"
             and split.get("use_regex", True) and not split.get("add_prefix_space") and not model.get("ignore_merges"))
    if not plain:
        return None
    special = {t["content"] for t in spec.get("added_tokens", []) if t.get("special")}
    byte_of = byte_of_character()
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    by_rank = [model["vocab"][m] for m in merges]
    if by_rank != sorted(by_rank):
        return None
    return {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}


class Subwords:
    def __init__(self, path: str):
        self.path = path
        self._slow = self._fast = None
        if (found := ranks(path)) is not None:
            import public_tokenizers
            import tiktoken

            self._fast = tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=found,
                                           special_tokens={})

    @property
    def tokenizer(self):
        if self._slow is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
            self._slow.encode_special_tokens = True  # their strings in a text are ordinary text
        return self._slow

    def _ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self._fast is None or _LONG_SPACE.search(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self._fast.encode_ordinary(text)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text (null: none), without special tokens."""
        return [np.array(self._ids(t), dtype="<u4").tobytes() for t in texts]

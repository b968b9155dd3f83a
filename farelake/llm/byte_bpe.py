"""Token ids of a byte-level BPE tokenizer file, with a bounded memory of words.

The file is one of the `tokenizers` library. Its vocabulary is handed to `tiktoken`, which does the
same merges several times faster; when a task opens the file, both libraries are compared on a probe
and, should they differ, `tokenizers` itself is used. Texts that contain an added token of the file, as
`<|endoftext|>`, always go through `tokenizers` as a whole, so their ids are its own.

A text without double spaces falls apart before each space: the pretokens of this family never span
a space that follows a character, so each part is encoded once and remembered. Other texts are
encoded as a whole.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import tiktoken

#: Pretokens of this family of tokenizers; a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PROBE = "Un  élan, 12 it's\n\n über\t日本 \U0001f600 x "
#: Parts remembered by a task at most; then it starts anew.
REMEMBERED = 200_000


def byte_letters() -> dict[str, int]:
    """The printable letter by which such files spell each byte, and the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Parts(dict):
    """Ids, as little-endian unsigned 32-bit bytes, of the parts of texts after a space."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, part: str) -> bytes:
        ids = self.encode(" " + part)
        self[part] = ids
        return ids


class ByteBpe:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        spelled = byte_letters()
        ranks = {
            bytes(spelled[c] for c in token): number
            for token, number in vocabulary.items()
            if all(c in spelled for c in token)
        }
        self.slow = Tokenizer.from_file(path)
        self.added = sorted(t.content for t in self.slow.get_added_tokens_decoder().values())
        ranks = {token: n for token, n in ranks.items() if token.decode("utf-8", "replace") not in self.added}
        fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.ordinary = fast.encode_ordinary
        if self.ordinary(PROBE) != self.slow_ids(PROBE):
            self.ordinary = self.slow_ids
        self.parts = Parts(self.packed)

    def slow_ids(self, text: str) -> list[int]:
        return self.slow.encode(text, add_special_tokens=False).ids

    def packed(self, text: str) -> bytes:
        return np.array(self.ordinary(text), dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit bytes."""
        if any(token in text for token in self.added):
            return np.array(self.slow_ids(text), dtype="<u4").tobytes()
        if "  " in text:
            return self.packed(text)
        if len(self.parts) > REMEMBERED:
            self.parts.clear()
        first, *rest = text.split(" ")
        return (self.packed(first) if first else b"") + b"".join(map(self.parts.__getitem__, rest))


@lru_cache(maxsize=2)
def open_tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)

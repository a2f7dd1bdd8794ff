"""Vocabulary files of byte-level tokenizers, read on the driver and sent to the tasks."""

from __future__ import annotations

import base64
import json
from functools import cached_property, lru_cache

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

JSON_PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS_PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
# The same where no two white space characters meet; without the look-ahead it matches faster.
SINGLE_SPACE_PATTERN = PATTERN.replace(r"\s+(?!\S)|", "")


class LibraryTokenizer:
    """A byte-level BPE file of the ``tokenizers`` library.

    Holds the file's content, about 1.5 MB, bounded by the vocabulary. ``ids`` is
    the library itself; ``fast`` merges by the ranks in the vocabulary, which gives
    the same for files whose merges are in the order of their ids and whose
    strings all come out of their own merges (``tests/llm`` proves it for the
    default file).
    """

    def __init__(self, content: str):
        spec = json.loads(content)
        before = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or spec["model"]["type"] != "BPE":
            raise ValueError("not a plain byte-level BPE tokenizer")
        self.content, self.special = content, tuple(t["content"] for t in spec["added_tokens"])

    @classmethod
    def read(cls, path: str) -> LibraryTokenizer:
        with open(path, encoding="utf-8") as f:
            return cls(f.read())

    def __reduce__(self):
        return LibraryTokenizer, (self.content,)

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_str(self.content)

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        alphabet, vocabulary = byte_alphabet(), json.loads(self.content)["model"]["vocab"]
        return {bytes(map(alphabet.__getitem__, t)): i for t, i in vocabulary.items() if t not in self.special}

    def fast(self, pattern: str) -> tiktoken.Encoding:
        return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def has_special(self, text: str) -> bool:
        return any(s in text for s in self.special)


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks, from a ``tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}


@lru_cache(maxsize=1)
def byte_alphabet() -> dict[str, int]:
    """The printable characters by which byte-level vocabularies write the 256 bytes.

    Printable Latin-1 bytes stand for themselves; the others follow from U+0100 on, in order.
    """
    own = [b for b in range(256) if chr(b).isprintable() and b != 0x20 and b != 0xAD]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}

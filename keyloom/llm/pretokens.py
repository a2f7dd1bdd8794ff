"""Splitting text in front of byte-level merges, as the tokenizer libraries do it."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import regex
import tiktoken

_CLASS = re.compile(r"\\p\{(\w)\}|\\([sS])|\\.|[\[\]]|[^\\\[\]]+", re.DOTALL)


@lru_cache(maxsize=1)
def unicode_classes() -> dict[str, str]:
    """Letters, numbers and white space as ranges.

    Asked of the library over all code points, because its Unicode version is
    not that of Python's regex modules.
    """
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    found = {}
    for name in ("L", "N", "s"):
        ask = tiktoken.Encoding("ask", pat_str=rf"\p{{{name}}}" if name != "s" else r"\s", mergeable_ranks=single, special_tokens={})
        held = sorted(map(ord, bytes(ask.encode_ordinary(points)).decode()))
        ranges: list[list[int]] = []
        for c in held:
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
        found[name] = "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in ranges)
    return found


def spelled_out(pattern: str) -> str:
    r"""``pattern`` for Python's ``re``, its ``\p{L}``, ``\p{N}`` and ``\s`` as explicit ranges."""
    classes, out, inside = unicode_classes(), [], False
    for m in _CLASS.finditer(pattern):
        part = m[0]
        if m[1] or m[2] == "s":
            body = classes[m[1] or "s"]
            out.append(body if inside else f"[{body}]")
        elif m[2] == "S":
            out.append(f"[^{classes['s']}]")
        else:
            if part in "[]":
                inside = part == "["
            out.append(part)
    return "".join(out)


class Splitter:
    """Matches of ``pattern`` in a text, with the library's Unicode classes.

    Below ``agreed`` Python's ``regex`` has the same classes and is faster. Made
    on the driver and sent to the tasks.
    """

    def __init__(self, pattern: str):
        self.pattern, self.spelled = pattern, spelled_out(pattern)
        points = "".join(map(chr, range(0xD800)))
        differing = set()
        for name in "LN":
            differing ^= set(re.findall(f"[{unicode_classes()[name]}]", points)) ^ set(regex.findall(rf"\p{{{name}}}", points))
        self.agreed = min(differing, default="\ud7ff")

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("fast", "exact")}

    def findall(self, text: str) -> list[str]:
        if "fast" not in self.__dict__:
            self.fast, self.exact = regex.compile(self.pattern), re.compile(self.spelled)
        agreed = text.isascii() or max(text) < self.agreed
        return (self.fast if agreed else self.exact).findall(text)


class Memo(dict):
    """A function's results by argument, about ``limit`` of them; those not asked for lately are forgotten."""

    def __init__(self, function: Callable, limit: int):
        super().__init__()
        self.function, self.limit, self.older = function, limit // 2, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        self[key] = value
        return value

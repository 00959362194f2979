"""Vocabulary files and the caches that encode texts chunk by chunk.

The pattern of the byte-level vocabularies puts a boundary before every space that a non-space follows, whatever stands
around it. Texts are cut there, and what a chunk encodes to is remembered: common words are encoded once for each
worker. A full cache gives up what was not asked for lately, so its memory is bounded and no text is encoded otherwise than any other.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable

#: A space that starts a chunk: a non-space follows. \s of str patterns covers more than the vocabularies' white space, which only makes chunks longer.
BOUNDARY = re.compile(r" (?=\S)")
#: First bytes of parts that may begin with white space (ASCII, or the lead bytes of wider spaces).
WIDE = frozenset(b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\xc2\xe1\xe2\xe3")


def read_file(path: str) -> bytes:
    """A vocabulary file on the driver; workers get its bytes (a few MB at most) with the closure's broadcast."""
    with open(path, "rb") as f:
        data = f.read()
    if len(data) > 64 << 20:
        raise ValueError(f"{path} is too large for a vocabulary: {len(data)} bytes")
    return data


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to ids, from a rank file (base64 and id on each line) or a tokenizer's JSON with a byte alphabet."""
    if not data.lstrip().startswith(b"{"):
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]  # printable bytes stand for themselves, the others follow from 256
    back = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(own))}
    spec = json.loads(data)
    special = {x["content"] for x in spec["added_tokens"]}
    return {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}


def load_added(data: bytes) -> dict[bytes, int]:
    """Texts of added tokens, as UTF-8, to ids: a tokenizer's JSON has them matched in texts before all else; a rank file has none."""
    added = json.loads(data)["added_tokens"] if data.lstrip().startswith(b"{") else []
    if odd := [x["content"] for x in added if x.get("lstrip") or x.get("rstrip") or x.get("single_word")]:
        raise ValueError(f"added tokens that match by what is around them: {odd}")
    return {x["content"].encode(): x["id"] for x in added if x["content"]}


def splitter(added: dict[bytes, int]) -> re.Pattern:
    """Splits a text by its added tokens, the leftmost and of these the longest first; each second part is a token."""
    return re.compile(b"(" + b"|".join(re.escape(x) for x in sorted(added, key=len, reverse=True)) + b")" if added else b"((?!))")


class Irregular(Exception):
    """A space that white space or nothing follows: the text needs the slower split."""


class TwoAges(dict):
    """Remembers value(key). With limit entries it turns into the older age and starts anew, so it holds two times limit at most."""

    def __init__(self, value: Callable, limit: int = 250_000, longest: int = 64):
        super().__init__()
        self.value, self.limit, self.longest, self.older = value, limit, longest, {}

    def __missing__(self, key):
        if (out := self.older.get(key)) is None:
            out = self.value(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = out
        return out


class ChunkCache(TwoAges):
    """Chunks without their leading space to value(chunk with it)."""

    def __init__(self, value: Callable[[bytes], bytes], limit: int = 250_000):
        super().__init__(lambda part: value(b" " + part), limit)
        self.heads = TwoAges(value, limit // 8)

    def __missing__(self, part: bytes) -> bytes:
        if not part or part[0] in WIDE and part.decode()[0].isspace():
            raise Irregular
        return super().__missing__(part)

    def values_of(self, text: bytes) -> list[bytes]:
        """The values of the text's chunks, in order; none for an empty text."""
        head, *rest = text.split(b" ")
        try:
            out = list(map(self.__getitem__, rest))
        except Irregular:
            head, *rest = (x.encode() for x in BOUNDARY.split(text.decode()))
            out = list(map(self.__getitem__, rest))
        return [self.heads[head], *out] if head else out

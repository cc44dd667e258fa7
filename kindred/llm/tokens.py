"""Token ids of whole texts by the `tokenizers` library, with a cache of pieces between its pre-token borders.

A byte-level BPE never merges across the borders that its pre-tokenizer draws, so the ids of a text are the ids of
its pieces in a row. Natural text repeats pieces; only pieces that a worker has not met go through the library.
Texts with characters whose class may depend on a Unicode version, or with the text of an added token, go through
the library whole, as do all texts where a file's pre-tokenizer, normalizer or model is of another kind.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import regex

#: The alphabet whose character classes are the same in every Unicode version in use; other texts go through whole.
USUAL = [chr(i) for i in (*range(0x250), *range(0x2010, 0x2028), 0x20AC)]
#: About 200 bytes each, for as long as a Python worker lives.
CACHE_PIECES = 520_000
#: Where workers live beside what earlier stages have left.
CACHE_PIECES_SHARED = 130_000


def _members(prop: str) -> str:
    return "".join(re.escape(c) for c in USUAL if regex.match(prop, c))


def piece_pattern() -> re.Pattern:
    """The pre-tokenizer's borders (contractions, letters, numbers, other, white space) over the usual alphabet."""
    letters, numbers, spaces = _members(r"\p{L}"), _members(r"\p{N}"), _members(r"\p{White_Space}")
    return re.compile(
        f" ?[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
        f"|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
    )


def byte_symbols() -> dict[int, int]:
    """A symbol for each byte: printable bytes stand for themselves, the others follow from 256 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


class PieceTokenizer(dict):
    """Maps a piece to its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, cache: int = CACHE_PIECES):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pattern = piece_pattern()
        self.symbols = byte_symbols()
        self.unusual = re.compile(f"[^{''.join(map(re.escape, USUAL))}]")
        self.limit = cache
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        spec = json.loads(self.tokenizer.to_str())
        before = spec.get("pre_tokenizer") or {}
        usual = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        model = spec.get("model") or {}
        plain = not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        #: Whether pieces by piece_pattern() are tokenized as the whole text is.
        self.by_pieces = usual and not spec.get("normalizer") and model.get("type") == "BPE" and plain
        self.added = re.compile("|".join(map(re.escape, added))) if added else None

    def __missing__(self, piece: str) -> bytes:
        symbols = piece.encode().decode("latin-1").translate(self.symbols)
        if len(self) >= self.limit:
            self.clear()
        ids = [t.id for t in self.model.tokenize(symbols)]
        self[piece] = out = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_pieces or self.unusual.search(text) or (self.added and self.added.search(text)):
            return self.whole(text)
        return b"".join(map(self.__getitem__, self.pattern.findall(text)))

    def encode_all(self, texts: Iterable[str | None]) -> Iterable[bytes]:
        return map(self.encode, texts)


@lru_cache(maxsize=2)
def tokenizer(path: str, cache: int = CACHE_PIECES) -> PieceTokenizer:
    """One tokenizer and cache for each Python worker."""
    return PieceTokenizer(path, cache)

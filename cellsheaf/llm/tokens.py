"""Token ids of whole texts with a given tokenizer file, word by word through a bounded memory of words.

The vocabulary files are BPE over single pre-tokens, so the ids of a text are those of its
pre-tokens in a row. Texts of plain characters are cut here by the pre-token pattern of the
file and each distinct pre-token goes through the library's model once; any other text goes
through the library as a whole. Both give the same ids.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable, Iterator

#: Pre-tokens remembered in a worker: so many new ones, and as many of those before them that are still met.
MEMORY = 200_000
_LETTER, _NUMBER = "a-zA-ZªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾"
#: Space, line ends and the printable characters of Latin-1: letters, numbers, case and normal forms of these are the same everywhere.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-\xff]*\Z")
#: The pre-token patterns of the two kinds of files.
_PATTERNS = {
    "bytes": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+"),
    "words": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+"),
}


def _printable() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class _Memory(dict):
    def __init__(self, model):
        super().__init__()
        self.model, self.shown, self.older = model, _printable(), {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMORY:
            self.older = dict(self)
            self.clear()
        out = self.older.get(word)
        if out is None:
            ids = [t.id for t in self.model.tokenize("".join([self.shown[b] for b in word.encode()]))]
            out = struct.pack(f"<{len(ids)}I", *ids)
        self[word] = out
        return out


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.kind = self._kind(spec)
        self.memory = _Memory(self.whole.model)
        self.special = [t["content"] for t in spec["added_tokens"]]

    @staticmethod
    def _kind(spec: dict) -> str | None:
        """The pattern that the file uses, None if it is another one."""
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        if spec.get("model", {}).get("type") != "BPE" or spec.get("post_processor") is not None:
            return None
        if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            return "bytes"
        steps = [(p.get("type"), p.get("behavior"), p.get("invert"), p.get("use_regex")) for p in pre.get("pretokenizers", [])]
        forms = [n.get("type") for n in (norm or {}).get("normalizers", [])]
        if steps == [("Split", "Removed", True, None), ("ByteLevel", None, None, False)] and forms == ["NFC", "Replace", "Lowercase"]:
            return "words"
        return None

    def __call__(self, text: str) -> bytes:
        if self.kind is None or not _PLAIN.match(text) or any(s in text for s in self.special):
            ids = self.whole.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        words = _PATTERNS[self.kind].findall(text.lower() if self.kind == "words" else text)
        return b"".join(map(self.memory.__getitem__, words))


_ENCODERS: dict[str, Encoder] = {}


def encoded(path: str, texts: Iterable[str | None], end: int) -> Iterator[bytes]:
    """Ids of each text, with `end` behind them; null is the empty text. A worker keeps one encoder for each file."""
    encoder = _ENCODERS.get(path)
    if encoder is None:
        encoder = _ENCODERS[path] = Encoder(path)
    last = struct.pack("<I", end)
    for text in texts:
        yield encoder(text or "") + last

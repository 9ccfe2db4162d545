"""Exact token ids of whole texts, fast enough for a corpus.

``Tokenizer.encode`` spends most of its time on alignment bookkeeping that a
corpus job never reads.  A BPE tokenizer encodes each pre-token alone, so a
word met before has the ids it had then.  :class:`TextEncoder` splits a text
into pre-tokens with the same pattern and joins the remembered ids; a new
pre-token goes to the tokenizer's own BPE model.  Every text outside the
character range for which this is provably the same (combining marks, other
scripts, control characters, the tokenizer's added tokens) goes through
``Tokenizer.encode`` itself, so ids never differ from the library's.
"""

from __future__ import annotations

import json
import re
from struct import pack

import numpy as np

#: Lower-case letters of the fast range after ``str.lower`` (Latin-1 and Latin Extended-A).
_LETTERS = "a-zß-öø-ÿĀ-ıĲ-ſ"
#: A character outside the fast range.  U+0130 lower-cases to two characters;
#: the excluded Latin-1 signs are numbers, marks or white space by other rules.
_SLOW = re.compile("[^\t\n\r -~À-ÖØ-öø-įı-ſ–—‘’“”…]")
_CONTROL = re.compile("[^\t\n\r -~]")
#: Fixed value: the pre-token pattern of the tokenizer file, on the fast range.
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_alphabet() -> list[str]:
    """Byte-level BPE writes a byte as itself where printable, else as the next free code point from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in shown else next(free)) for b in range(256)]


_MEMOS: list[_Memo] = []


def only(*memos: _Memo) -> None:
    """Empty all memos of this worker but these: a worker goes from one operator's tasks to another's, and
    what the earlier one remembered would stay beside what the next one does."""
    for m in _MEMOS:
        if m and not any(m is k for k in memos):
            m.clear()
    if not any(m is k for e in _ENCODERS.values() for m in (e.pieces, e.words) for k in memos):
        _ENCODERS.clear()
        _MEMOS[:] = [m for m in _MEMOS if not isinstance(getattr(m.make, "__self__", None), TextEncoder)]


class _Memo(dict):
    """What one function said, kept up to ``limit`` entries; then emptied, so memory is bounded."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit
        _MEMOS.append(self)

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        value = self.make(key)
        if len(key) <= 64:
            self[key] = value
        return value


class TextEncoder:
    """``encode(text)`` returns the ids as little-endian bytes of ``dtype``."""

    def __init__(self, path: str, memo: int = 250_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"].lower() for t in spec.get("added_tokens") or []]
        self.fast = self._known(spec)
        self.alphabet = _byte_alphabet()
        self.pieces = _Memo(self._piece, memo)
        self.words = _Memo(self._word, memo)

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else "".join([self.alphabet[b] for b in piece.encode()])
        ids = [t.id for t in self.tokenizer.model.tokenize(shown)]
        return pack(f"<{len(ids)}{self.code}", *ids)

    def _word(self, word: str) -> bytes:
        """No pre-token holds white space, so the words of a text are encoded one by one."""
        if word.isalpha():
            return self._piece(word)
        if word[:-1].isalpha() and word[-1] in ".,;:!?":
            return self.pieces[word[:-1]] + self.pieces[word[-1]]
        return b"".join([self.pieces[p] for p in _PIECES.findall(word)])

    @staticmethod
    def _known(spec: dict) -> bool:
        """The shortcut holds for this normaliser and this pre-tokenizer only; any other file is encoded by the library."""
        norm = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        return (norm == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in pre] == ["Split", "ByteLevel"]
                and pre[0]["pattern"].get("Regex") == _PATTERN and not pre[1]["add_prefix_space"])

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        low = text.lower()
        if not self.fast or any(a in low for a in self.added) or not text.isascii() and _SLOW.search(text) \
                or text.isascii() and _CONTROL.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        return b"".join(map(self.words.__getitem__, low.split()))


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder per Python worker and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    only(_ENCODERS[path].pieces, _ENCODERS[path].words)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")

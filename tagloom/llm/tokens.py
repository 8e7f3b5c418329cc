"""Token ids of whole texts, as little-endian 32-bit integers.

Byte-level pair encoding never joins pieces that its pattern splits, so the
ids of a text are those of its pieces in a row. Pieces seen before are looked up;
the tokenizers library encodes each new piece. Texts with characters outside a
fixed plain set (where Unicode tables of two libraries might differ) or with the
name of a special token go to the library whole.
"""

from __future__ import annotations

import re
import sys
import types
from array import array
from collections.abc import Callable

# fixed values: the vocabulary's own pre-tokenisation pattern, its classes written out for the plain characters
LETTERS, DIGITS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^\s{LETTERS}{DIGITS}]+|\s+(?!\S)|\s+"
PLAIN = "[\n\r\t\x20-\x7e¡-¬®-ɏ‐-‧]*"
_CACHE = 400_000


def _byte_names() -> dict[int, int]:
    """Byte-level vocabularies name printable bytes by themselves and the others, in order, by characters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in shown)}


_BYTE_NAMES = _byte_names()


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str) -> Encoder:
    """The encoder of this worker process, which keeps what it has learned for the tasks that follow."""
    held = sys.modules.setdefault("_encoders_of_worker", types.ModuleType("_encoders_of_worker")).__dict__
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.merge = self.whole.model.tokenize
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.split, self.plain = re.compile(PIECES).findall, re.compile(PLAIN).fullmatch
        if not _splits_by_pieces(self.whole):
            self.plain = lambda text: None  # every text goes to the library whole
        self.known: dict[str, bytes] = _Known(self._new)
        self.older: dict[str, bytes] = {}

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.plain(text) or any(s in text for s in self.special):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if len(self.known) > _CACHE:  # what is in use comes back from the older half
            self.older, self.known = self.known, _Known(self._new)
        return b"".join(map(self.known.__getitem__, self.split(text)))

    def _new(self, piece: str) -> bytes:
        code = self.older.get(piece)
        if code is None:
            named = piece.replace(" ", "\u0120") if piece.isascii() and piece.isprintable() else _named(piece)
            code = array("I", [t.id for t in self.merge(named)]).tobytes()
        return code


class _Known(dict):
    """Codes by piece; a piece that is missing is made on the way."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, piece: str) -> bytes:
        code = self[piece] = self.make(piece)
        return code


def _splits_by_pieces(whole) -> bool:
    """Whether a tokenizer cuts texts by the fixed pattern and then merges bytes; others cut or change them in their own way."""
    from tokenizers import models, pre_tokenizers

    cut, model = whole.pre_tokenizer, whole.model
    return (
        isinstance(cut, pre_tokenizers.ByteLevel) and cut.use_regex and not cut.add_prefix_space and whole.normalizer is None
        and isinstance(model, models.BPE) and not model.continuing_subword_prefix and not model.end_of_word_suffix
        and not model.dropout and not model.byte_fallback and not model.ignore_merges
    )


def _named(piece: str) -> str:
    return piece.encode().decode("latin-1").translate(_BYTE_NAMES)

"""Token ids of whole texts by a public tokenizer, cached by word piece in each Python worker."""

from __future__ import annotations

import array
import json
import re
import sys
import types
import zlib

#: What the fast way below stands for; a tokenizer with other parts encodes whole texts.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

#: The same split for printable ASCII and the letters U+00C0 to U+00FF, which NFC leaves alone.
_PIECES = re.compile("[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\\sa-z0-9ß-öø-ÿ]+", re.ASCII)  # letters first: most pieces are words
_LATIN = bytes([*range(128), *(c for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))])
_KEPT = "creditflow_llm_worker_cache"
_MOST = 600_000


def _byte_letters() -> dict[int, int]:
    """The letter that byte-level models write for each byte: itself where printable, else the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {b: 256 + k for k, b in enumerate(others)}


_LETTERS = _byte_letters()


class _Pieces(dict):
    """Ids, as little-endian bytes, of each piece seen by this worker; emptied when full."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, piece: str) -> bytes:
        letters = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(_LETTERS)
        if len(self) >= _MOST:
            self.clear()
        found = self[piece] = array.array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        return found


class WordIds:
    """``ids(text)``: little-endian 32-bit ids without special tokens, as the tokenizer itself gives them."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(source)
        parts = json.loads(source)
        steps = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.special = [t["content"] for t in parts.get("added_tokens") or []]
        self.fast = ((parts.get("normalizer") or {}).get("normalizers") == NORMALIZERS and (steps[0].get("pattern") or {}).get("Regex") == SPLIT
                     and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True and len(steps) == 2
                     and steps[1].get("type") == "ByteLevel" and not steps[1].get("use_regex") and not steps[1].get("add_prefix_space")
                     and not parts.get("post_processor") and not parts.get("truncation") and not parts["model"].get("dropout"))
        self.pieces, self.words = _Pieces(self.tokenizer.model), {}

    def _whole(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= _MOST:
                self.words.clear()
            found = self.words[word] = self._latin(word) if _is_latin(word) else self._whole(word)
        return found

    def _latin(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, _PIECES.findall(text.lower())))

    def ids(self, text: str) -> bytes:
        if not self.fast or any(s in text for s in self.special):
            return self._whole(text)
        if _is_latin(text):
            return self._latin(text)
        return b"".join(map(self._word, filter(None, text.replace("\n", " ").split(" "))))  # no piece reaches over a space


def _is_latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        return not text.encode("latin-1").translate(None, _LATIN)
    except UnicodeEncodeError:
        return False


def worker_ids(source: str) -> WordIds:
    """This worker's tokenizer for a tokenizer file's content; its cache outlives the task."""
    kept = sys.modules.setdefault(_KEPT, types.ModuleType(_KEPT)).__dict__.setdefault("held", {})
    key = (len(source), zlib.crc32(source.encode()))
    if key not in kept:
        kept[key] = WordIds(source)
    return kept[key]

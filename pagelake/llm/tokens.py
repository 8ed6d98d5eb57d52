"""Ids of a tokenizer file, quickly.

The ids are those of the ``tokenizers`` library for the file.  Its encoding
objects cost several times the merges, so the merges of a byte-level BPE file
are run by ``tiktoken``'s loop over the same vocabulary: merge ranks are the
file's ids.  Two kinds of file are known:

* byte-level, with the pattern ``PATTERN``: the text goes in as it is;
* with word ends (``</w>``), normalised by NFC, one blank for white space and
  lower case: the text is normalised and cut to pre-tokens here, and a NUL
  stands for the word end.

Texts for which the two libraries could differ (special tokens' strings, NUL,
separators, letters that Python folds differently, characters outside the
ranges whose classes are the same in all Unicode versions) are encoded by
``tokenizers``, and so is everything if the file is of another kind.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

# The pre-token patterns of the two kinds of file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
# The letters, numbers and white space of lower-cased Latin-1, for the same pattern in ``re``.
_LETTERS, _NUMBERS, _SPACES = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\x09-\x0d \x85\xa0"
_LATIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+").findall
_ODD = "\x00\x1c\x1d\x1e\x1f\u0130\u03a3"  # NUL, separators, dotted capital I, capital sigma
# Character ranges whose classes no Unicode version since 7.0 has changed (Latin, Greek, Cyrillic,
# punctuation, currency signs, kana, CJK, Hangul, full-width forms); elsewhere two libraries may differ.
_STABLE = re.compile("[^\x00-\u0220\u0250-\u036f\u0384-\u03ff\u0400-\u052f\u2010-\u205e\u20a0-\u20b9\u3001-\u3029"
                     "\u3041-\u3096\u30a1-\u30fe\u4e00-\u9fa5\uac00-\ud7a3\uff01-\uff5e]")
_LOADED: dict[str, "FileEncoder"] = {}


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 characters for themselves, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def latin(text: str) -> bool:
    """Whether all characters are below U+0100 (much faster than a search)."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class FileEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = [*_ODD, *self.special]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], (spec["normalizer"] or {}).get("normalizers", [])
        suffix = model.get("end_of_word_suffix")
        plain = model["type"] == "BPE" and not model.get("unk_token") and not model.get("dropout")
        if plain and not suffix and spec["normalizer"] is None and spec["pre_tokenizer"] == {
                "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            self._ranks(model["vocab"], PATTERN)
            self.prepare = str
        elif plain and suffix == WORD_END and [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] \
                and WORD_PATTERN in json.dumps(spec["pre_tokenizer"]).replace("\\\\", "\\"):
            import regex

            find = regex.compile(WORD_PATTERN).findall
            self._ranks(model["vocab"], r"[^\x00]+\x00")
            # Latin-1 is in NFC, and ``re`` cuts it several times as fast
            self.prepare = lambda t: "\0".join([*(
                _LATIN_WORDS(t.lower()) if latin(t) else find(unicodedata.normalize("NFC", t).lower())), ""])
        else:
            self.prepare = None

    def _ranks(self, vocab: dict[str, int], pattern: str) -> None:
        import tiktoken

        letters = byte_letters()
        ranks = {}
        for token, i in vocab.items():
            if token in self.special:
                continue
            body, end = (token[:-len(WORD_END)], b"\0") if token.endswith(WORD_END) else (token, b"")
            ranks[bytes(letters[c] for c in body) + end] = i
        self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def load(cls, path: str) -> "FileEncoder":
        """One encoder per worker process."""
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        text = text or ""
        if self.prepare is None or any(x in text for x in self.odd) or not (latin(text) or not _STABLE.search(text)):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(self.prepare(text))
        return np.asarray(ids, dtype="<u4").tobytes()


def slices(batches, chars: int = 1_000_000, column: int = 1):
    """Arrow batches cut to rows of about ``chars`` characters of text in all
    (one row at least), so a worker's memory follows the longest text, not the
    batch."""
    import pyarrow.compute as pc

    for b in batches:
        if not b.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < b.num_rows:
            base = size[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(size, base + chars, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi

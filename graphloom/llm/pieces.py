"""Pre-tokens of byte-level BPE vocabularies, and the ids of whole texts by way of them."""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import numpy as np

# Fixed value: how the byte-level pre-tokenizer cuts a text.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts in which no two spaces meet, where looking ahead finds nothing else.
_CUT_ALONE = _CUT.replace(r"|\s+(?!\S)", "")
#: The same for ``re``, whose classes agree but for ``odd`` characters.
_PIECE = re.compile(r" ?[^\W\d_]++|'(?:[stmd]|re|ve|ll)| ?\d++| ?(?:[^\s\w]|_)++|\s+(?!\S)|\s+")


class _Odd(dict):
    """Whether ``re`` may class a character otherwise than the library: numbers other than decimal
    digits, code points without a character, and the separators that only ``re`` takes for space."""

    def __missing__(self, c: str) -> bool:
        made = self[c] = "\x1c" <= c <= "\x1f" or unicodedata.category(c) in ("No", "Nl", "Cn")
        return made


_ODD = _Odd()
#: Those of ASCII.
_ODD_ASCII = "\x1c\x1d\x1e\x1f"


def odd(text: str) -> bool:
    """Whether a text has such a character."""
    if text.isascii():
        return any(c in text for c in _ODD_ASCII)
    return any(map(_ODD.__getitem__, set(text)))


#: What both ``re`` and the library take for space.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def spaced(text: str) -> bool:
    """Whether two spaces of any kind follow each other in a text."""
    here = [c for c in _SPACE if c in text]
    return any(a + b in text for a in here for b in here)


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """One for each path in a worker, which lives from task to task."""
    return Vocabulary(path)


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for
    themselves, and the others, in order, for what comes from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranked(path: str) -> dict[bytes, int] | None:
    """The ranks of the file's vocabulary, or None where it is not byte-level or its merges don't rank as their
    ids do."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, cut, byte = whole["model"], whole.get("pre_tokenizer") or {}, _byte_of()
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex") or whole.get("normalizer"):
        return None
    vocab = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocab.get(a + b, -1) for a, b in merges]
    if ids != sorted(ids) or model.get("unk_token") or not all(c in vocab for c in byte):
        return None
    made = {*byte, *(a + b for a, b in merges)}
    return {bytes(byte[c] for c in token): vocab[token] for token in made}


class Vocabulary:
    """A BPE file of the ``tokenizers`` library.

    Texts with special strings, or with characters on whose class libraries differ, go through the library, which
    is loaded with the first of them. All others are encoded by the ranks of the file's merges, which gives the library's
    ids; a file without such ranks is read by the library throughout.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        added = whole.get("added_tokens") or []
        special = [re.escape(t["content"]) for t in added]
        self.special = re.compile("|".join(special)) if special else None
        size = max([*whole["model"]["vocab"].values(), *(t["id"] for t in added)]) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self._size, self._ranks = size, _ranked(path)

    def _encoder_of(self, cut: str):
        import tiktoken

        # Without any special string, an empty one is looked for at each character; no regular text holds this one.
        special = {_ODD_ASCII[0]: self._size}
        return tiktoken.Encoding("ranks", pat_str=cut, mergeable_ranks=self._ranks, special_tokens=special)

    @functools.cached_property
    def _encoder(self):
        return self._encoder_of(_CUT)

    @functools.cached_property
    def _encoder_alone(self):
        return self._encoder_of(_CUT_ALONE)

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.path)
        made.no_truncation()
        made.no_padding()
        return made

    def irregular(self, text: str) -> bool:
        """Whether the library has to read a text as a whole."""
        if self._ranks is None or (self.special is not None and self.special.search(text)):
            return True
        return odd(text)

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a regular text."""
        return _PIECE.findall(text)

    def count(self, pieces: list[str]) -> list[int]:
        """How many ids each pre-token of a regular text has."""
        return [len(self._encoder.encode_ordinary(p)) for p in pieces]

    def library_ids(self, text: str) -> np.ndarray:
        """Ids of a whole text by the library alone."""
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype)

    def ids(self, text: str) -> np.ndarray:
        """Ids of a whole text, as the library gives them."""
        if self.irregular(text):
            return self.library_ids(text)
        encoder = self._encoder if spaced(text) else self._encoder_alone
        return encoder.encode_to_numpy(text, disallowed_special=()).astype(self.dtype)

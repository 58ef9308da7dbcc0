"""The ids of a word-level BPE tokenizer file (tokenizers library), remembered by word.

Ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``.  A text
is cut at spaces and line ends, which such a tokenizer drops; what stands
between them is encoded by itself and remembered.  Plain words (Latin letters,
then ASCII punctuation) go straight to the library's merging model, everything
else through its whole chain.
"""

from __future__ import annotations

import json
import re
import struct

from .wfst import Memo

#: Remembered words in a task.
REMEMBERED = 300_000
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-^`{-~]*)").fullmatch


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in letters]
    return letters | {b: chr(256 + k) for k, b in enumerate(rest)}


def supported(spec: dict) -> bool:
    """Whether the short way is right for a tokenizer file."""
    steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    cut = [x.get("type") for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    model = spec["model"]
    return steps == ["NFC", "Replace", "Lowercase"] and cut == ["Split", "ByteLevel"] and model.get("end_of_word_suffix") == "</w>" and not model.get("dropout") and not model.get("ignore_merges")


class WordTokenizer:
    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        text = file.decode()
        self.library = Tokenizer.from_str(text)
        spec = json.loads(text)
        if not supported(spec):
            raise ValueError("not a word-level BPE file with NFC, lower case and word ends")
        self.model = self.library.model
        letters = _byte_letters()
        self.latin = {c: "".join(letters[x] for x in chr(c).encode()) for c in range(0xC0, 0x100)}
        self.forget()

    def forget(self) -> None:
        """Drop what is remembered of the texts so far."""
        self.words = Memo(self._word, REMEMBERED)
        self.marks = Memo(self._library, 10_000)
        self.chunks = Memo(self._chunk, REMEMBERED)
        self.marks[""] = b""

    def _library(self, chunk: str) -> bytes:
        ids = self.library.encode(chunk, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        found = [x.id for x in self.model.tokenize(word if word.isascii() else word.translate(self.latin))]
        return struct.pack(f"<{len(found)}I", *found)

    def _chunk(self, chunk: str) -> bytes:
        plain = _PLAIN(chunk)
        if plain is None:
            return self._library(chunk) if chunk else b""
        word, marks = plain.groups()
        return self.words[word.lower()] + self.marks[marks]

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))


_made: dict[bytes, WordTokenizer] = {}


def tokenizer(file: bytes) -> WordTokenizer:
    """One tokenizer for each file in a worker process."""
    key = file[:64] + len(file).to_bytes(8, "little")
    if key not in _made:
        _made.clear()
        _made[key] = WordTokenizer(file)
    return _made[key]

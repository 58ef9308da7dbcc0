"""SentencePiece encoding and decoding by weighted finite-state transduction.

A model file is compiled into transducers (``wfst``): the normaliser (dummy
prefix, extra spaces, spaces written as U+2581), the pieces with their weights,
and byte fallback, which reads a character's UTF-8 bytes and writes their
pieces.  A text is composed with the normaliser, and what that writes with the
union of pieces and fallback, word by word,
because no piece of such a model reaches from one word into the next; the
shortest path in the tropical semiring is the encoding.  Paths of frequent
words are remembered in the worker, but for very long ones.  In a merge model,
runs of spaces have pieces of equal rank, of which only the order of merging tells: there,
merging itself, by a heap, finds the path.

Decoding runs the chain backwards: ids to pieces, bytes to characters (a wrong
byte sequence gives U+FFFD), U+2581 to spaces, and off goes the dummy prefix.

Defined cases: a null or empty text has no ids and decodes to the empty text;
repeated rows give repeated results; an empty table gives an empty result;
other columns are ignored.  A U+2581 in a text can't be told from a space
afterwards, as in the library.  Models with a character map are refused.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wfst import COPY, Fst, Memo, Merges, MergeTransducer, UnigramTransducer, Union

#: Words whose paths are remembered, and characters up to which they are.
REMEMBERED, SHORT = 250_000, 64
SPACE = "▁"
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# Numbers of fields and of piece types in the public model format.
_PIECE, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes):
    """(number, value) of a protocol buffer message: int, or bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = varint() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
        yield key >> 3, data[at : at + size]
        at += size


class Model:
    """Pieces, scores and options of a model file."""

    def __init__(self, file: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        trainer, rules = {}, {}
        for number, value in _fields(file):
            if number == _PIECE:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(float(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0]))
                self.types.append(piece.get(3, _NORMAL))
            elif number == _TRAINER:
                trainer = dict(_fields(value))
            elif number == _NORMALIZER:
                rules = dict(_fields(value))
        if rules.get(2):
            raise ValueError("models with a character map aren't supported")
        if _USER in self.types or not rules.get(5, 1) or trainer.get(24, 0):
            raise ValueError("user-defined pieces, unescaped or trailing spaces aren't supported")
        self.kind = {1: "unigram", 2: "bpe"}[trainer.get(3, 1)]
        self.dummy_prefix, self.squeeze = bool(rules.get(3, 1)), bool(rules.get(4, 1))
        self.unknown = self.types.index(_UNKNOWN)
        self.bytes = {int(p[3:5], 16): k for k, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)) if t == _BYTE}


def normaliser(prefix: bool, squeeze: bool) -> Fst:
    """Spaces to U+2581, one of them before the first character; with ``squeeze``, only between words."""
    same, head = ((COPY,), 0.0, 1), (SPACE,) if prefix else ()
    if not squeeze:
        return Fst([{" ": (head + (SPACE,), 0.0, 1), None: (head + (COPY,), 0.0, 1)}, {" ": ((SPACE,), 0.0, 1), None: same}])
    # Before the first word, in a word, between words.
    return Fst([{" ": ((), 0.0, 0), None: (head + (COPY,), 0.0, 1)}, {" ": ((), 0.0, 2), None: same}, {" ": ((), 0.0, 2), None: ((SPACE, COPY), 0.0, 1)}])


class Transducer:
    """A model, compiled."""

    def __init__(self, file: bytes):
        self.model = m = Model(file)
        usable = {p: k for k, (p, t) in enumerate(zip(m.pieces, m.types, strict=True)) if t in (_NORMAL, _UNUSED)}
        if any(SPACE in p.lstrip(SPACE) for p in usable):
            raise ValueError("pieces that reach from one word into the next aren't supported")
        # An unknown character weighs 10 more than the dearest piece.
        weights = {p: -m.scores[k] for p, k in usable.items()}
        dear = 10 + max(weights.values(), default=0)
        fallback = Fst([{b: ((k,), dear, 0) for b, k in m.bytes.items()}]) if m.bytes else None
        if m.kind == "bpe":
            self.merges = Merges(lambda a, b, get=weights.get: get(a + b))
            self.machine = MergeTransducer(usable, self.merges)
        else:
            self.machine = UnigramTransducer({p: m.scores[k] for p, k in usable.items()}, dear)
        self.normaliser = normaliser(m.dummy_prefix, m.squeeze)
        self.union = Union(usable, fallback, m.unknown, weights)
        self.memo = Memo(self._word, REMEMBERED)
        self.texts = [SPACE.encode() if t in (_CONTROL, _UNKNOWN) else p.replace(SPACE, " ").encode() for p, t in zip(m.pieces, m.types, strict=True)]
        for byte, k in m.bytes.items():
            self.texts[k] = bytes([byte])
        for k, t in enumerate(m.types):
            if t == _CONTROL:
                self.texts[k] = b""
            elif t == _UNKNOWN:
                self.texts[k] = " ⁇ ".encode()

    def normalise(self, text: str) -> str:
        return "".join(self.normaliser.compose(text)[0])

    def _path(self, word: str) -> list[str]:
        if SPACE * 2 in word and self.model.kind == "bpe":
            return [node[0] for node in self.merges.run(list(word))]
        return self.machine.shortest(word)

    def _word(self, word: str) -> bytes:
        ids, known = [], self.union.pieces.get
        for piece in self._path(word):
            k = known(piece)
            if k is None:
                ids += self.union.arc(piece)[0]
            else:
                ids.append(k)
        return struct.pack(f"<{len(ids)}i", *ids)

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        words = _WORD.findall(self.normalise(text))
        remembered, found = self.memo.__getitem__, self._word
        return b"".join([remembered(w) if len(w) <= SHORT else found(w) for w in words])

    def decode(self, ids) -> str:
        text = b"".join(map(self.texts.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


_made: dict[int, Transducer] = {}


def transducer(file: bytes) -> Transducer:
    """One compiled model for each file in a worker process."""
    key = hash(file)
    if key not in _made:
        _made.clear()
        _made[key] = Transducer(file)
    return _made[key]


def encode(docs: DataFrame, model_file: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id and ids (array of int)."""

    def run(batches):
        machine = transducer(model_file)
        for batch in batches:
            found = [machine.encode(x.as_py() or "") for x in batch[1]]
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found], dtype=np.int64)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), "<i4")))
            yield pa.RecordBatch.from_arrays([batch[0], ids], [id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string").alias(text_col)).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(encoded: DataFrame, model_file: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row for each row of encoded: id, ids and text.  Null ids decode to the empty text."""

    def run(batches):
        machine = transducer(model_file)
        for batch in batches:
            column = batch[1]
            values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            texts = [machine.decode(values[a:b].tolist()) for a, b in zip(offsets, offsets[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch[0], column, pa.array(texts, pa.string())], [id_col, "ids", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, F.col(ids_col).alias("ids")).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, text string")

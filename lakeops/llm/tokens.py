"""Token ids from a public tokenizer file, for use inside tasks.

A byte-pair tokenizer cuts a text into pieces (words, numbers, signs) before any merge, so the ids of a text are the ids of
its pieces in a row. Most pieces of a corpus repeat: the texts of a block are cut at once, as arrays of bytes, each distinct
piece of the block is looked up once, and each Python worker keeps the ids of the pieces it has met, so that only new ones go
to the tokenizer's model. The cache has a fixed size and changes no result. Pieces are cut here only where the characters
leave no doubt (below U+0250, without strings of added tokens); other texts go to the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE_PIECES = 680_000
# Bytes of the texts that are cut together; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
# Letters and numbers below U+0250, as Unicode classes them.
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_LETTER, _NUMBER, _SIGN, _BLANK, _UNSURE = range(5)
_SURE_BELOW = 0x250
# The two kinds of tokenizer file whose pieces are known.
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _kind(spec: dict) -> str | None:
    """Which of the known ways of cutting a tokenizer file asks for."""
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
        return "bytes"
    steps = pre.get("pretokenizers") or []
    if (
        [s["type"] for s in steps] == ["Split", "ByteLevel"] and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex")
        and steps[0]["pattern"].get("Regex") == _WORD_SPLIT and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        and [n["type"] for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
    ):
        return "words"
    return None


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable bytes stand for themselves, the others follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _classes() -> np.ndarray:
    """Class of each character that two bytes of UTF-8 can hold."""
    found = np.full(0x800, _UNSURE, np.uint8)
    for code in range(_SURE_BELOW):
        c = chr(code)
        kinds = ((_LETTER, f"[{_L}]"), (_NUMBER, f"[{_N}]"), (_UNSURE, "[\x1c-\x1f]"), (_BLANK, r"\s"))
        found[code] = next((kind for kind, chars in kinds if re.match(chars, c)), _SIGN)
    return found


_CLASSES = _classes()
# By byte; characters of more bytes get theirs from their first two.
_BYTE_CLASSES = np.concatenate([_CLASSES[:0x80], np.full(0x80, _UNSURE, np.uint8)])


def _buffers(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each text begins and the last one ends."""
    _, places, data = texts.buffers()
    if not len(texts) or data is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int32)
    bounds = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def _classed(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte belongs to; bytes of longer characters are unsure."""
    classes = _BYTE_CLASSES[data]
    lead = np.flatnonzero(data >= 0xC2)
    lead = lead[data[lead] < 0xE0]
    own = _CLASSES[(data[lead].astype(np.uint16) & 0x1F) << 6 | data[lead + 1] & 0x3F]
    classes[lead], classes[lead + 1] = own, own
    return classes


def _starts(kind: str, data: np.ndarray, classes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where pieces begin, and the end. What "words" drops between its pieces is a piece of blanks here."""
    n = len(data)
    text, start = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    text[bounds] = True
    np.not_equal(classes[1:], classes[:-1], out=start[1:n])
    start |= text
    blank = classes == _BLANK
    if kind == "bytes":  # the last blank of a run goes with what follows if it is a space, else it is a piece of its own
        ends = blank[:-1] & ~blank[1:] & ~text[1:n]
        space = data[:-1] == 0x20
        joined = ends & space
        start[1:n] &= ~joined
        start[: n - 1] |= joined
        last = np.flatnonzero(ends & ~space)
        start[last - ((data[last] & 0xC0) == 0x80)] = True
    else:  # a piece for each number
        start[:n] |= (classes == _NUMBER) & ((data & 0xC0) != 0x80)
    # 's 't 'm 'd 're 've 'll at the beginning of a piece
    sign = np.flatnonzero(start[:n] & (data == 0x27))
    sign = sign[sign + 1 < n]
    sign = sign[(classes[sign + 1] == _LETTER) & ~text[sign + 1]]
    one, after = data[sign + 1], np.minimum(sign + 2, n - 1)
    two = one.astype(np.uint16) << 8 | data[after]
    short = np.isin(one, list(b"stmd"))
    long = np.isin(two, [int.from_bytes(x, "big") for x in (b"re", b"ve", b"ll")]) & (sign + 2 < n) & ~text[after]
    start[sign[short | long] + 1] = False
    start[sign[short] + 2] = True
    start[sign[long] + 3] = True
    return np.flatnonzero(start).astype(np.int32)


def blocks(texts: pa.Array) -> Iterator[pa.StringArray]:
    """The texts in slices that are cut together; nulls are empty."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    bounds, at = _buffers(texts)[1], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, int(bounds[at]) + BLOCK_BYTES, "right")) - 1)
        yield texts.slice(at, to - at)
        at = to


class _Pieces(dict):
    """Ids by piece, of a fixed number of pieces at most; a piece asked for the first time is made.

    Pieces are kept in two halves: when the newer half is full it becomes the older one, whose pieces go unless they are
    asked for again.
    """

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.make(piece)
        if len(self) >= max(1, self.most // 2):
            self.older = self.copy()
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit integers, ``arrays(texts)`` the number of ids
    of each text and all ids in a row."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.kind = _kind(spec)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.letters = _byte_letters()
        self.model = self.tokenizer.model
        self.cache = _Pieces(self._piece, cache_pieces)

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        if self.kind == "words" and piece.isspace():
            return b""
        if piece.isascii() and piece.isprintable():  # only the space has another letter
            letters = piece.replace(" ", self.letters[0x20])
        else:
            letters = piece.encode().decode("latin-1").translate(self.letters)
        return _packed([t.id for t in self.model.tokenize(letters)])

    def _with_added(self, texts: pa.StringArray) -> np.ndarray:
        """Which texts hold the string of an added token."""
        found, data = np.zeros(len(texts), bool), _buffers(texts)[0].tobytes()
        for token in self.added:
            if token.encode() in data:
                found |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        return found

    def _cut(self, data: np.ndarray, classes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and the ids, by distinct pieces."""
        starts = _starts(self.kind, data, classes, bounds)
        pieces = pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data)).dictionary_encode()
        known = [*map(self.cache.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False))]
        sizes = np.fromiter(map(len, known), np.int32, len(known)) // 4
        lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), np.frombuffer(b"".join(known), "<u4"))
        taken = lists.take(pieces.indices)
        ends = taken.offsets.to_numpy()[np.searchsorted(starts, bounds)]
        return np.diff(ends).astype(np.int64), taken.flatten().to_numpy()

    def _block(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        whole = np.ones(len(texts), bool)
        if self.kind:
            low = pa.array([t.lower() for t in texts.to_pylist()], pa.string()) if self.kind == "words" else texts
            data, bounds = _buffers(low)
            classes, whole = _classed(data), self._with_added(texts)
            whole[np.searchsorted(bounds, np.flatnonzero(classes == _UNSURE), "right") - 1] = True
            if not whole.any():
                return self._cut(data, classes, bounds)
        counts, rows = np.zeros(len(texts), np.int64), [np.empty(0, "<u4")] * len(texts)
        for i in np.flatnonzero(whole).tolist():
            rows[i] = np.frombuffer(self._whole(texts[i].as_py()), "<u4")
            counts[i] = len(rows[i])
        if not whole.all():
            data, bounds = _buffers(low.filter(pa.array(~whole)))
            counts[~whole], ids = self._cut(data, _classed(data), bounds)
            ends = np.cumsum(counts[~whole])
            for i, a, b in zip(np.flatnonzero(~whole).tolist(), ends - counts[~whole], ends, strict=True):
                rows[i] = ids[a:b]
        return counts, np.concatenate(rows)

    def arrays(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [self._block(b) for b in blocks(texts)]
        return np.concatenate([np.empty(0, np.int64), *(c for c, _ in found)]), np.concatenate([np.empty(0, "<u4"), *(x for _, x in found)])

    def encode(self, texts: list[str]) -> list[bytes]:
        counts, ids = self.arrays(pa.array(texts, pa.string()))
        ends, packed = (4 * np.cumsum(counts)).tolist(), ids.tobytes()
        return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker."""
    return Encoder(path)


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)

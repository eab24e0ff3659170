"""Token ids of whole texts, by the tokenizers library, as little-endian bytes.

The vocabulary file is a parameter. A byte-level BPE with the usual word pattern never joins
text over certain places: before white space, before the last white space of several, behind
one that is no blank, and between ASCII or Latin letters, digits and ASCII marks (the apostrophe
apart). The texts of a batch are cut there, on their bytes as Arrow holds them; its distinct
pieces are encoded once and remembered, words by the library's model alone, and taken back in
order. Characters that may count as white space are never cut at. A text that spells out a token
the vocabulary marks as added, as ``<|endoftext|>``, goes to the library as a whole, which
gives that token's id. Tests hold the result against the library on the whole text.

A worker process keeps its pieces for the tasks that follow. Once ``CACHED`` of them are held,
they become the old generation and the one before is dropped; an old piece that is met again
joins the new ones. So frequent pieces stay, and memory is bounded. A process that has encoded
nothing for ``IDLE`` seconds gives its pieces up: other steps need the memory then.
"""

from __future__ import annotations

import gc
import os
import threading
import time
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from prairie.llm.batches import give_back

CACHED = 400_000  # pieces of a generation, with a blank, of which a worker remembers two (and as many without)
IDLE = 8.0  # seconds
LONGEST = 64  # characters of a piece that is remembered
SLICE = 4 << 20  # bytes of text that are cut at once, if it is not one text
_LATIN = "\u0240"  # letters of two bytes end before

# Classes of bytes. A place between two bytes is one between pieces as their classes say.
_UNSURE, _BLANK, _SPACE, _LETTER, _DIGIT, _MARK, _OTHER = range(7)


def _classes() -> np.ndarray:
    """The class of each byte; of characters beyond ASCII all are other ones at first, and no white space."""
    found = np.full(256, _OTHER, np.uint8)
    for b in range(128):
        c = chr(b)
        if c.isalnum():
            found[b] = _LETTER if c.isalpha() else _DIGIT
        elif c.isspace():
            found[b] = _BLANK if c == " " else _SPACE if c in "\t\n\v\f\r" else _UNSURE
        elif c.isprintable() and c != "'":  # which can begin a word of letters
            found[b] = _MARK
    return found


def _places() -> np.ndarray:
    """For two classes (of 8): bit 0, pieces part between the two bytes; bit 1, before the first, if the text goes on."""
    found = np.zeros((8, 8), np.uint8)
    white, words = (_BLANK, _SPACE), (_LETTER, _DIGIT, _MARK)
    for a in range(7):
        for b in range(7):
            if b in white and a not in (*white, _UNSURE) or a == _SPACE and b not in (*white, _UNSURE):
                found[a, b] |= 1
            if a in words and b in words and a != b:
                found[a, b] |= 1
            if a in white and b not in (*white, _UNSURE):
                found[a, b] |= 2
    return found.reshape(-1)


_CLASS, _PLACE = _classes(), _places()
#: First two bytes of characters among which are white ones (U+0085, U+00A0, U+1680, U+180E, U+2000 and on, U+3000).
_WHITE = np.array([0xC285, 0xC2A0, 0xE19A, 0xE1A0, 0xE280, 0xE281, 0xE380], np.uint16)


def cuts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pieces begin in the bytes of texts that lie one behind the other and end at ``ends``."""
    kind = _CLASS[data]
    if len(data) and data.max() >= 0x80:
        at = np.flatnonzero(data[:-1] >= 0xC2)
        two = data[at].astype(np.uint16) << 8 | data[at + 1]
        latin = at[(two >= 0xC380) & (two <= 0xC8BF) & (two != 0xC397) & (two != 0xC3B7)]  # U+00C0 to U+023F, less two signs
        kind[latin] = kind[latin + 1] = _LETTER
        white = at[np.isin(two, _WHITE)]
        for i in range(3):
            kind[np.minimum(white[data[white] >= 0xE0] if i == 2 else white, len(data) - 1 - i) + i] = _UNSURE
    place = _PLACE[kind[:-1] << 3 | kind[1:]]
    inner = ends[(ends > 0) & (ends < len(data))]
    place[inner - 1] = 0
    begins = np.zeros(len(data), bool)
    begins[1:] = place & 1
    begins[:-1] |= place > 1
    begins[inner] = True
    begins[:1] = True
    return begins


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_characters() -> dict[int, str]:
    """The characters that a byte-level vocabulary writes bytes as: printable ones as they are."""
    shown = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Library:
    """The library's tokenizer, and its model for single words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.code = "H" if self.size <= 1 << 16 else "I"
        self.ids = [array(self.code, [i]).tobytes() for i in range(self.size)]
        self.table = _byte_characters()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokenize = self.tokenizer.model.tokenize

    def word(self, text: str) -> bytes:
        """One word of the pattern, in the characters of the vocabulary."""
        ids = self.ids
        return b"".join([ids[t.id] for t in self.tokenize(text)])

    def whole(self, text: str) -> bytes:
        [found] = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return array(self.code, found.ids).tobytes()


class _Pieces(dict):
    """Id bytes of pieces; a missing one is taken from the old generation, or encoded.

    All begin with a blank, or none does: ``skip`` characters are before the word.
    """

    def __init__(self, library: _Library, skip: int):
        super().__init__()
        self.library, self.skip = library, skip
        self.shown = library.table[32] * skip
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        raw = self.old.get(piece)
        if raw is None:
            raw = self.encoded(piece)
        if len(piece) > LONGEST:
            return raw
        if len(self) >= CACHED:
            self.old = dict(self)
            self.clear()
        self[piece] = raw
        return raw

    def encoded(self, piece: str) -> bytes:
        library, word = self.library, piece[self.skip :]
        if word.isascii():
            if word.isalpha() or word.isdigit():  # which the vocabulary writes as they are
                return library.word(self.shown + word)
        elif word.isalpha() and max(word) < _LATIN:  # other scripts: what counts as a letter is left to the library
            return library.word(self.shown + word.encode().decode("latin-1").translate(library.table))
        return library.whole(piece)


class _Worker:
    """What a process remembers of a vocabulary."""

    def __init__(self, path: str):
        self.library = _Library(path)
        self.first, self.spaced = _Pieces(self.library, 0), _Pieces(self.library, 1)
        self.used, self.watched = time.monotonic(), False

    def use(self) -> None:
        """Pieces are wanted; someone watches until they are not."""
        self.used = time.monotonic()
        if not self.watched:
            self.watched = True
            threading.Thread(target=self._watch, daemon=True).start()

    def _watch(self) -> None:
        while (rest := self.used + IDLE - time.monotonic()) > 0:
            time.sleep(rest)
        self.watched = False
        for pieces in (self.first, self.spaced):  # a text that comes just now finds them missing, no more
            pieces.old = {}
            pieces.clear()
        give_back()

    def pieces(self, pieces: pa.Array) -> list[bytes]:
        """Ids of each piece, in any order: it says nothing of its neighbours."""
        behind = pc.starts_with(pieces, " ").to_numpy(zero_copy_only=False).tolist()
        spaced, first = self.spaced, self.first
        collecting = gc.isenabled()
        gc.disable()  # many strings and no cycles
        try:
            return [spaced[p] if b else first[p] for p, b in zip(pieces.to_numpy(zero_copy_only=False).tolist(), behind)]
        finally:
            if collecting:
                gc.enable()


_HELD: dict[str, _Worker] = {}  # of this process, by vocabulary


class Encoder:
    """``encode`` gives the ids of each text as bytes of ``dtype``, followed by those of ``end``."""

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        if path not in _HELD:
            _HELD[path] = _Worker(path)
        self.worker = _HELD[path]
        library = self.worker.library
        self.size = library.size
        self.dtype = "<u2" if library.code == "H" else "<u4"
        self.end = array(library.code, [end]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_batch(pa.array(texts, pa.large_string())).to_pylist()

    def encode_batch(self, texts: pa.Array) -> pa.Array:
        """Ids of an array of texts (null: empty), as an array of bytes."""
        self.worker.use()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        made, first = [], 0
        while first < len(texts):
            last = max(int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1, first + 1)
            last = min(last, len(texts))
            made.append(self._slice(texts.slice(first, last - first), offsets[first : last + 1]))
            first = last
        return pa.concat_arrays(made).cast(pa.binary()) if made else pa.array([], pa.binary())

    def _slice(self, texts: pa.Array, offsets: np.ndarray) -> pa.Array:
        """Pieces and an empty one behind each text, all of which lie in one buffer; their ids likewise."""
        n, ends = len(texts), offsets[1:] - offsets[0]
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer else np.zeros(0, np.uint8)
        begins = cuts(data, ends)
        for word in self.worker.library.added:
            for i in np.flatnonzero(pc.match_substring(texts, word).to_numpy(zero_copy_only=False)):
                begins[ends[i - 1] + 1 if i else 1 : ends[i]] = False
        starts = np.flatnonzero(begins)
        before = np.searchsorted(starts, ends)  # pieces of this text and those before
        bounds = np.append(np.insert(starts, before, ends), ends[-1])
        pieces = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        distinct = pieces.dictionary
        ids = self.worker.pieces(distinct)
        ids[pc.index(distinct, "").as_py()] = self.end
        taken = pa.array(ids, pa.large_binary()).take(pieces.indices)
        last = np.concatenate([[0], before + np.arange(1, n + 1)])  # the piece behind each text's empty one
        ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset :][last]
        return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), taken.buffers()[2]])


def numbers(raw: bytes, width: int) -> np.ndarray:
    """Ids of bytes in which each takes ``width`` bytes."""
    return np.frombuffer(raw, f"<u{width}")


def all_numbers(column: pa.Array, width: int) -> np.ndarray:
    """Ids of a whole column of such bytes (without nulls), one row behind the other."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1] if len(column) else [0]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(f"<u{width}") if data else numbers(b"", width)

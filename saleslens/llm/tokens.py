"""Token ids of whole texts, many texts at a time.

A byte-level BPE with the public split pattern never joins bytes across certain places: a
white-space run starts a piece, its last character belongs to what follows if it is a
space and else is a piece of its own, and a sign behind a letter starts a piece. Texts are
cut at those places over their bytes, chunks are looked up among those that the worker has
met lately (Arrow's hash look-up, by whole bytes), and the tokenizer reads only the others.
The ids are those that the tokenizer gives for the whole text.
"""

from __future__ import annotations

import os
import re
import sys
import types
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KNOWN = 1_000_000  # chunks that a worker remembers
SEGMENT = 2_000_000  # chunks looked up together
LINES = 2000  # chunks that the tokenizer reads as lines of one text
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
# The tokenizer's spelling of bytes: printable ones stand for themselves, the others for
# the characters from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPELLING = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
# Letters of ASCII and U+00C0 to U+00FF (without the signs of multiplication and division).
WORD = re.compile(rb" ?(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+").fullmatch
_BLANK = np.zeros(256, bool)
_BLANK[[*range(9, 14), 32]] = True
# Signs that may start a piece behind a letter; an apostrophe may start a contraction.
_SIGN = np.zeros(256, bool)
_SIGN[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = True
# Other white space, in UTF-8: lead byte, then (following bytes) that make it a blank.
_WIDE_BLANKS = {0xC2: [(0x85,), (0xA0,)], 0xE1: [(0x9A, 0x80)],
                0xE2: [*((0x80, x) for x in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)), (0x81, 0x9F)], 0xE3: [(0x80, 0x80)]}


def _blanks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per byte: whether it is of a white-space character, and whether it starts one."""
    blank = _BLANK[data]
    first = blank.copy()
    for lead, tails in _WIDE_BLANKS.items():
        at = np.flatnonzero(data == lead)
        for tail in tails if len(at) else []:
            # a character's bytes are all there: it is never cut by the end
            met = at[np.all([data[np.minimum(at + i + 1, len(data) - 1)] == x for i, x in enumerate(tail)], axis=0)]
            first[met] = True
            for i in range(len(tail) + 1):
                blank[met + i] = True
    return blank, first


def chunk_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where chunks start in the bytes of non-empty texts that start at ``texts``."""
    blank, first = _blanks(data)
    start = np.zeros(len(data), bool)
    start[texts] = True
    own = start.copy()  # text starts
    start[1:] |= blank[1:] & ~blank[:-1]
    letter = _LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    start[1:] |= _SIGN[data[1:]] & letter[:-1]
    last = behind = np.flatnonzero(~blank[1:] & blank[:-1] & ~own[1:]) + 1  # first of a word behind a run
    for _ in range(3):  # to the first byte of the blank before it
        last = last - (~first[last] | (last == behind))
    start[last] = True
    start[behind[data[last] != 32]] = True
    return np.flatnonzero(start)


class Encoder:
    """Ids of texts by a tokenizer file; special tokens in a text are ordinary text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.newline = self._raw(["\n"])[0]
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_binary())
        self.flat, self.begins, self.sizes = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64)

    def _raw(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: pa.Array) -> None:
        """Remember distinct chunks. Plain words are one piece, which the model reads as it
        is; as a newline between two other chunks is a piece of its own, those are read as
        lines of one text; white space is read by itself."""
        words, lines, others = [], [], []
        for chunk in chunks.to_pylist():
            if WORD(chunk):
                words.append(chunk)
            elif chunk[-1] > 32 and (chunk[-1] < 128 or not chunk.decode().isspace()):
                lines.append(chunk)
            else:
                others.append(chunk)
        ids, sizes = [self.flat], [self.sizes]
        spelled = b"\n".join(words).decode("latin-1").translate(SPELLING).split(SPELLING[10]) if words else []
        for start in range(0, len(spelled), LINES):
            read = [[token.id for token in self.model.tokenize(word)] for word in spelled[start:start + LINES]]
            ids.append(np.fromiter(chain.from_iterable(read), "<u4"))
            sizes.append(np.fromiter(map(len, read), np.int64, len(read)))
        for start in range(0, len(lines), LINES):
            read = np.array(self._raw([b"\n".join(lines[start:start + LINES]).decode()])[0], "<u4")
            cut = read == self.newline[0]
            ids.append(read[~cut])
            sizes.append(np.diff(np.concatenate(([-1], np.flatnonzero(cut), [len(read)]))) - 1)
        for read in self._raw([c.decode() for c in others]):
            ids.append(np.array(read, "<u4"))
            sizes.append(np.array([len(read)]))
        self.known = pa.concat_arrays([self.known, pa.array(words + lines + others, pa.large_binary())])
        self.flat, self.sizes = np.concatenate(ids), np.concatenate(sizes)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def _segment(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of consecutive chunks and how many each has."""
        chunks = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)])
        if len(self.known) > KNOWN:
            self._forget()
        which = pc.index_in(chunks, value_set=self.known)
        if which.null_count:
            self._learn(pc.unique(chunks.filter(pc.is_null(which))))
            which = pc.index_in(chunks, value_set=self.known)
        which = which.to_numpy(zero_copy_only=False)
        counts = self.sizes[which]
        before = np.cumsum(counts) - counts
        return self.flat[np.repeat(self.begins[which] - before, counts) + np.arange(counts.sum())], counts

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, ``end`` behind each, and where each starts
        (one more than there are texts). Null is empty."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.ascontiguousarray(np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]])
        offsets = offsets - offsets[0]
        if not len(data):
            return np.full(len(texts), end, "<u4"), np.arange(len(texts) + 1)
        starts = chunk_starts(data, np.unique(offsets[:-1][np.diff(offsets) > 0]))
        edges = np.append(starts, len(data)).astype(np.int64)
        parts = [self._segment(data, edges[i:i + SEGMENT + 1]) for i in range(0, len(starts), SEGMENT)]
        before = np.concatenate(([0], np.cumsum(np.concatenate([c for _, c in parts]))))
        # tokens before each text; with one end token a text, text i is moved by i
        at = before[np.searchsorted(starts, offsets)] + np.arange(len(texts) + 1)
        out = np.empty(at[-1], "<u4")
        ends = np.zeros(at[-1], bool)
        ends[at[1:] - 1] = True
        out[ends] = end
        out[~ends] = np.concatenate([ids for ids, _ in parts])
        return out, at


def encoder(path: str) -> Encoder:
    """The worker's encoder: tasks that a Python worker runs one after the other share it."""
    shared = sys.modules.setdefault("_saleslens_encoders", types.ModuleType("_saleslens_encoders"))
    if path not in shared.__dict__:
        shared.__dict__[path] = Encoder(path)
    return shared.__dict__[path]

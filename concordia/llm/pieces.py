"""Pre-tokens of a SentencePiece BPE model and their token ids.

In the model's normal form a space is the letter U+2581, and one is put before the text.
A merge can only reach over a place if some piece holds the two characters beside it.  No
piece of the model has U+2581 after another character, or a line feed, so texts may be cut
there: the parts have the same pieces alone as together.  ``check_model`` verifies this
for the model at hand.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece

SPACE = "▁"
PRETOKEN = re.compile(rf"\n+[^\n {SPACE}]*|[ {SPACE}]+[^\n {SPACE}]*|[^\n {SPACE}]+")
#: Pre-tokens whose ids a task remembers, but for those of the slice at hand.
CACHE = 1 << 18
#: Bytes of texts whose pre-tokens are cut together.
SLICE_BYTES = 4 << 20
#: Pre-tokens whose ids are put in a row at a time.
_RUN = 1 << 17


@lru_cache(maxsize=4)
def load_model(path: str) -> sentencepiece.SentencePieceProcessor:
    return check_model(sentencepiece.SentencePieceProcessor(model_file=path))


def check_model(model: sentencepiece.SentencePieceProcessor) -> sentencepiece.SentencePieceProcessor:
    """Raise if merges of this model could cross the cuts between pre-tokens."""
    crossing = re.compile(rf"[^{SPACE}]{SPACE}|\n")
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            if crossing.search(model.id_to_piece(i)):
                raise ValueError(f"piece {i} crosses the cuts between pre-tokens")
    if model.encode("a  b ▁c", out_type=str)[0] != f"{SPACE}a" or model.normalize(" ﬁ") != f"{SPACE}{SPACE}ﬁ":
        raise ValueError("the model changes spaces or letters before cutting")
    return model


def pretokens(text: str | None) -> list[str]:
    """The cuts of a text; joined they are the text with one space before it."""
    return PRETOKEN.findall(f" {text}") if text else []


def cuts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The cuts of some texts, as ``pretokens`` makes them, and how many there are up to each text's end."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    empty = pa.scalar("", pa.large_string())
    spaced = pc.binary_join_element_wise(empty, texts, pa.scalar(" ", pa.large_string()))
    plain = pc.if_else(pc.equal(texts, empty), empty, spaced)
    offsets = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
    if not len(plain) or offsets[0] == offsets[-1]:
        return pa.array([], pa.large_string()), np.zeros(len(plain), np.int64)
    data = np.frombuffer(plain.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    # Where a blank begins, and where one ends; they differ for U+2581 of three bytes.
    begins = data == 0x20
    ends = begins
    if (mark := SPACE.encode()) in data.tobytes():
        wide = np.flatnonzero((data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2]))
        ends = begins.copy()
        begins[wide], ends[wide + 2] = True, True
    feeds = data == 0x0A
    cut = begins.copy()
    cut[1:] &= ~ends[:-1]
    cut[1:] |= feeds[1:] & ~feeds[:-1]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(cut)
    bounds = pa.py_buffer(np.append(starts, len(data)))
    found = pa.LargeStringArray.from_buffers(len(starts), bounds, pa.py_buffer(data))
    return found, np.searchsorted(starts, offsets[1:])


def pretoken_ids(model: sentencepiece.SentencePieceProcessor, terms: list[str]) -> list[list[int]]:
    """Token ids of pre-tokens as they stand inside a text."""
    # The space that the model puts before its input stands for a leading space.  Other
    # parts are set after a line feed, whose pieces and that of the space are dropped.
    inputs, drop = [], []
    for t in terms:
        spaced = t[0] in (" ", SPACE)
        inputs.append(t[1:] if spaced else t if t[0] == "\n" else f"\n{t}")
        drop.append(0 if spaced else 1 if t[0] == "\n" else 2)
    lone = [model.piece_to_id(SPACE)]
    found = model.encode(inputs, num_threads=1)
    return [ids[n:] if text else lone for ids, n, text in zip(found, drop, inputs)]


class PieceIds:
    """Ids of pre-tokens as little-endian bytes; those not seen for long are forgotten."""

    def __init__(self, model_path: str):
        self.model = load_model(model_path)
        self.dtype = np.dtype("<u2" if self.model.get_piece_size() <= 1 << 16 else "<u4")
        #: Those seen lately, and those seen before them.
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Token ids of whole texts; the pre-tokens of a few megabytes are cut and looked up together."""
        sums = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at, before = 0, 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(sums, before + SLICE_BYTES, side="right")))
            yield from self._encoded(texts.slice(at, end - at))
            at, before = end, sums[end - 1]

    def _encoded(self, texts: pa.Array) -> Iterator[np.ndarray]:
        found, ends = cuts(texts)
        found = found.dictionary_encode()
        # Millions of small lists, none in a cycle: looking for cycles only costs time.
        gc.disable()
        try:
            ids = self._learned(found.dictionary.to_numpy(zero_copy_only=False).tolist())
        finally:
            gc.enable()
        flat = np.frombuffer(b"".join(ids), self.dtype)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        # The ids of every cut, one after the other.
        which, parts = found.indices.to_numpy(), [flat[:0]]
        for first in range(0, len(which), _RUN):
            some = which[first : first + _RUN]
            n = sizes.take(some)
            at = np.arange(n.sum()) + np.repeat(starts.take(some) - (np.cumsum(n) - n), n)
            parts.append(flat.take(at))
        out = np.concatenate(parts)
        stops = np.append(0, np.cumsum(sizes.take(which))).take(ends)
        for s, e in pairwise([0, *stops.tolist()]):
            yield out[s:e]

    def _learned(self, terms: list[str]) -> list[bytes]:
        """Ids of distinct pre-tokens."""
        if len(self.known) >= CACHE // 2:
            self.known, self.earlier = {}, self.known
        found, absent = list(map(self.known.get, terms)), []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            if (ids := self.earlier.get(terms[i])) is None:
                absent.append(i)
            else:
                self.known[terms[i]] = found[i] = ids
        new = [terms[i] for i in absent]
        cut = pretoken_ids(self.model, new)
        flat = np.fromiter(chain.from_iterable(cut), self.dtype).tobytes()
        places = accumulate((len(ids) * self.dtype.itemsize for ids in cut), initial=0)
        for i, term, (s, e) in zip(absent, new, pairwise(places)):
            self.known[term] = found[i] = flat[s:e]
        return found

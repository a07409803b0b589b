"""Exact subword ids at the cost of a table lookup per word.

A byte-pair encoder works on pre-tokens: runs of letters, digits or marks, perhaps with the space before. So a text's ids
are the ids of its chunks, put together, where chunks end at places that end a pre-token in every context:

* before a space that follows a letter, digit or mark, or that one of these follows;
* between letters, digits and marks, and between these and other white space;
* after a single white-space character, other than a space, between two of these.

Letters, digits and marks are ASCII here, and letters are those of Latin-1 and Latin Extended-A too. Next to anything
else, such as an apostrophe (contractions) or a combining mark, no text is cut; that costs time, never ids.

Places are found over the bytes of an Arrow array of texts, chunks are numbered by Arrow's dictionary encoding, and ids
are gathered by numpy from a pool. Each distinct chunk is encoded once by the ``tokenizers`` library and remembered.
Texts that hold one of the encoder's special strings, and encoders of any other shape, go to the library whole.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_OTHER, _LETTER, _DIGIT, _MARK, _SPACE, _WHITE = range(6)


def _kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    for i in range(0x21, 0x7F):
        kinds[i] = _LETTER if chr(i).isalpha() else _DIGIT if chr(i).isdigit() else _MARK
    kinds[ord("'")] = _OTHER
    kinds[ord(" ")] = _SPACE
    kinds[[9, 10, 11, 12, 13]] = _WHITE
    return kinds


def _borders() -> np.ndarray:
    """By 8 * kind + next kind: whether a chunk ends between the two."""
    ends = np.zeros(64, np.bool_)
    for a in (_LETTER, _DIGIT, _MARK):
        for b in (_LETTER, _DIGIT, _MARK, _SPACE, _WHITE):
            ends[8 * a + b] = a != b
    return ends


_KINDS, _BORDERS = _kinds(), _borders()


def borders(data: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    """Places in the UTF-8 bytes of texts before which a chunk may begin; ``lasts``: where texts' last bytes stand."""
    kind = _KINDS[data]
    # two-byte Latin letters but the signs for times and division, and the one capital whose small form is two characters
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5))
    first, second = data[lead], data[lead + 1]
    lead = lead[~((first == 0xC3) & ((second == 0x97) | (second == 0xB7)) | (first == 0xC4) & (second == 0xB0))]
    kind[lead] = kind[lead + 1] = _LETTER
    plain = (kind >= _LETTER) & (kind <= _MARK)
    ends = _BORDERS[8 * kind[:-1] + kind[1:]]  # between a place and the next
    space = (kind[1:-1] == _SPACE) & plain[2:]
    space[lasts[(lasts > 0) & (lasts < len(data) - 1)] - 1] = False  # what follows there is another text
    ends[:-1] |= space
    ends[1:] |= plain[:-2] & (kind[1:-1] == _WHITE) & plain[2:]
    return np.flatnonzero(ends) + 1


class Subwords:
    """``limit``: chunks remembered at most; beyond that memory is given back and filled again, results don't change."""

    def __init__(self, path: str, limit: int = 700_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.encoder, self.limit = Tokenizer.from_file(path), limit
        with open(path, encoding="utf-8") as file:
            shape = json.load(file)
        pre, norm = shape.get("pre_tokenizer") or {}, shape.get("normalizer")
        self.special = [x["content"] for x in shape.get("added_tokens", [])]
        self.largest = max([*self.encoder.get_vocab().values(), 0])
        steps = pre.get("pretokenizers", [])
        with_space = norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        by_kind = norm and steps and steps[0].get("type") == "Split" and steps[0].get("invert") and r"[\p{L}]+" in (steps[0].get("pattern") or {}).get("Regex", "")
        self.mark = self.special[0] if self.special and (with_space or by_kind) else None
        self.mark_id = self.encoder.token_to_id(self.mark) if self.mark else None
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pool, self.at, self.used = np.empty(1 << 16, "<u4"), np.zeros(1 << 14, np.int64), 0

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.encoder.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, chunks: list[bytes]) -> None:
        """Encode chunks and add them to the pool; ``at[i]`` is where chunk i's ids begin, ``at[i + 1]`` where they end."""
        for i in range(0, len(chunks), 1000):
            some = chunks[i : i + 1000]
            line = self.mark.join(x.decode() for x in some)
            ids = np.array(self.encoder.encode_batch_fast([line], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids))
            n, made = len(self.known), len(ids) - len(some) + 1
            while self.used + made > len(self.pool):
                self.pool = np.append(self.pool, np.empty_like(self.pool))
            while n + len(some) + 1 > len(self.at):
                self.at = np.append(self.at, np.zeros_like(self.at))
            self.pool[self.used : self.used + made] = ids[ids != self.mark_id]
            self.at[n + 1 : n + 1 + len(some)] = self.used + ends - np.arange(len(some))
            self.used += made
            self.known.update(zip(some, range(n, n + len(some)), strict=True))

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        if offsets[-1] == offsets[0]:
            return np.empty(0, "<u4"), np.zeros(len(texts), np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        starts = offsets[:-1][offsets[1:] > offsets[:-1]]
        begins = np.zeros(len(data) + 1, np.bool_)
        if len(data) > 2:
            begins[borders(data, offsets[1:][offsets[1:] > offsets[:-1]] - 1)] = True
        begins[starts] = begins[len(data)] = True
        cuts = np.flatnonzero(begins).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)]).dictionary_encode()
        names = chunks.dictionary.to_pylist()
        missed = [x for x in names if x not in self.known]
        if missed:
            if len(self.known) + len(missed) > self.limit:
                self._forget()
                missed = names
            self._learn(missed)
        number = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))[chunks.indices.to_numpy()]
        first = self.at[number]
        sizes = self.at[number + 1] - first
        sums = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.repeat(first - sums[:-1], sizes) + np.arange(sums[-1])]
        return ids, sums[np.searchsorted(cuts, offsets[1:])]

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (strings without null) one after the other, and where each text's end."""
        texts = texts.cast(pa.string()) if texts.type != pa.string() else texts
        whole = pa.array([self.mark is None] * len(texts), pa.bool_())
        for x in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, x))
        if not pc.any(whole).as_py():
            return self._plain(texts)
        parts, ends, at, i = [], [], 0, 0
        flags = whole.to_pylist()
        while i < len(texts):
            if flags[i]:
                ids, own, n = self.whole(texts[i].as_py()), None, 1
                own = np.array([len(ids)])
            else:
                n = next((k for k in range(i, len(texts)) if flags[k]), len(texts)) - i
                ids, own = self._plain(texts.slice(i, n))
            parts.append(ids)
            ends.append(own + at)
            at, i = at + len(ids), i + n
        return np.concatenate(parts), np.concatenate(ends)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        ids, ends = self.flat(pa.array(texts, pa.string()))
        return np.split(ids, ends[:-1])


@lru_cache(maxsize=2)
def subwords(path: str) -> Subwords:
    """One encoder per worker process, kept between tasks."""
    return Subwords(path)


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)

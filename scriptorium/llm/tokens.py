"""Exact token ids at speed: texts are cut at ASCII blanks, and each distinct piece is encoded once per worker.

That is exact for tokenizers that cut at white space and then between letters and punctuation, whose normaliser treats
characters apart from their neighbours beyond white space, as the word-level BPE used here does. Tests compare with the
plain call on whole texts.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from scriptorium.llm.common import Words

KNOWN_MOST = 500_000  # distinct pieces in each of a worker's two generations; the older one is dropped when the younger is full
LETTERS = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+$"  # letters that stay single letters in lower case and in NFC
ENDS = ".,;:!?#%&*$|"  # punctuation that no normaliser joins with a letter before it


@functools.cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def listed(words: pa.Array) -> list[str]:
    """What to_pylist() gives, in a tenth of its time, as no Arrow scalar is made for each word."""
    return words.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Ids travel as bytes, four a token, little-endian: a text's are those of its pieces joined."""

    def __init__(self, path: str, most: int = KNOWN_MOST):
        self.path, self.most = path, most
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _unknown(self, words: Iterable[str]) -> list[str]:
        """Those to be encoded; words that only the older generation knows move to the younger."""
        known, older = self.known, self.older
        out = []
        for w in words:
            if w not in known:
                if (ids := older.get(w)) is None:
                    out.append(w)
                else:
                    known[w] = ids
        return out

    def _encode_each(self, words: list[str]) -> None:
        made = tokenizer(self.path).encode_batch_fast(words, add_special_tokens=False)
        self.known.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(words, made, strict=True))

    def _encode_letters(self, words: list[str]) -> None:
        """Words of letters alone go in one text, as each is one piece before merging; where one is not, singly."""
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            made = tokenizer(self.path).encode(" ".join(part), add_special_tokens=False)
            piece = np.array(made.word_ids, np.int64)
            if len(piece) and piece[-1] + 1 == len(part) == len(np.unique(piece)):
                ids = np.array(made.ids, "<u4").tobytes()
                stops = (4 * np.cumsum(np.bincount(piece))).tolist()
                self.known.update((w, ids[x:y]) for w, x, y in zip(part, [0, *stops], stops, strict=False))
            else:
                self._encode_each(part)

    def _learn(self, fresh: pa.Array) -> None:
        """Letters with punctuation after them are put together from both parts, letters in lower case where that is ASCII's."""
        stems = pc.utf8_rtrim(fresh, characters=ENDS)
        letters = pc.match_substring_regex(stems, LETTERS)
        low = pc.if_else(pc.string_is_ascii(stems), pc.ascii_lower(stems), stems)
        cut = pc.and_(letters, pc.not_equal(low, fresh))
        low, whole, known = listed(low.filter(cut)), listed(fresh.filter(cut)), self.known
        ends = [w[len(x) :] for w, x in zip(whole, low, strict=True)]
        plain = listed(fresh.filter(pc.and_not(letters, cut)))
        self._encode_letters(self._unknown(dict.fromkeys([*low, *plain])))
        self._encode_each(self._unknown(dict.fromkeys([*listed(fresh.filter(pc.invert(letters))), *ends])))
        known.update((w, known[x] + known[e]) for w, x, e in zip(whole, low, ends, strict=True))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text. Null: none."""
        words = Words(texts)
        distinct = listed(words.distinct)
        if len(self.known) > self.most:
            self.known, self.older = {}, self.known
        known = self.known
        if fresh := self._unknown(distinct):
            self._learn(pa.array(fresh, pa.large_string()))
        if not len(words.codes):
            return [b""] * len(texts)
        flat = pa.array([known[w] for w in distinct], pa.large_binary()).take(pa.array(words.codes))  # words in the texts' order: no Python work for each
        _, stops, ids = flat.buffers()
        stops, ids = np.frombuffer(stops, np.int64)[words.starts].tolist(), memoryview(ids or b"")  # none where all words are blanks beyond ASCII
        return [bytes(ids[x:y]) for x, y in zip(stops, stops[1:], strict=False)]


@functools.cache
def encoder(path: str, most: int = KNOWN_MOST) -> Encoder:
    """One for each worker process, which serves many tasks."""
    return Encoder(path, most)

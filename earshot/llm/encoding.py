"""Token ids of whole texts by the ``tokenizers`` library, each distinct word encoded about once per task process.

The byte-level pre-tokenizer never joins a character that is not white space with a white space that follows it. A text may
therefore be cut before each white space that follows another character, and the ids of the pieces, one after the other, are the
ids of the text. Where words stand one blank or line end apart, a piece is a word and what leads it. Numpy finds and hashes the
words of a run of documents; ids of known words come from a table by their 64-bit hash, the others from the library. A text
with other white space, or with some at either end, is encoded in one go.
"""

from __future__ import annotations

import os
import re

import numpy as np

from earshot.llm.common import SPACE_BYTES, Words, mix, ranges

VOCABULARY = "byte_bpe_50k.json"
SLOT_BITS = 22
MAX_WORDS = 1_200_000

_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ɏ]+)([\x21-\x40\x5b-\x60\x7b-\x7e].*)?", re.DOTALL)

# White space of several bytes, and characters that some libraries count as white space.
ODD_SPACES = "\x85\xa0 ᠎           ​    　﻿"
_ODD_TWO = [int.from_bytes(c.encode(), "big") for c in ODD_SPACES if len(c.encode()) == 2]
_ODD_THREE = [int.from_bytes(c.encode(), "big") for c in ODD_SPACES if len(c.encode()) == 3]
_ODD_FIRST = np.zeros(256, dtype=bool)
_ODD_FIRST[[c.encode()[0] for c in ODD_SPACES]] = True
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b".,;:?!")] = True
# 1: blank or line end, 2: other white space and separators of the control range
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(SPACE_BYTES)] = 2
_KIND[[0x1C, 0x1D, 0x1E, 0x1F]] = 2
_KIND[[0x20, 0x0A]] = 1


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b if b in shown else next(spare)) for b in range(256)}


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.line_end = self.whole("\n")
        self.tails: dict[str, list[int]] = {}
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(1 << SLOT_BITS, np.uint64)
        self.entry = np.zeros(1 << SLOT_BITS, np.int32)
        self.first = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.entries, self.used = 0, 0

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def word(self, lead: str, word: str) -> list[int]:
        """Ids of a word after a blank, a line end or nothing."""
        if lead == "\n":
            return self.line_end + self.word("", word)
        found = _WORD.fullmatch(word)
        if not found:
            return self.whole(lead + word)
        # a word of letters is one piece for the pre-tokenizer, so the model takes it in the byte alphabet as it is
        ids = [t.id for t in self.model.tokenize((lead + found[1]).encode().decode("latin-1").translate(self.letters))]
        tail = found[2]
        if tail:  # the pre-tokenizer cuts between a letter and an ASCII mark or digit
            held = self.tails.get(tail)
            if held is None:
                held = self.whole(tail)
                if len(tail) < 8 and len(self.tails) < 50_000:
                    self.tails[tail] = held
            ids = ids + held
        return ids

    def _learn(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray, lead: np.ndarray) -> np.ndarray:
        """Encode words and put them into the table; their entry numbers."""
        raw, tokenize = data.tobytes(), self.model.tokenize
        other = np.concatenate([[0], np.cumsum(~_ASCII_LETTER[data])])
        letters = (other[end] == other[start]) & (lead < 2)  # ASCII letters are themselves in the byte alphabet
        shown = raw.decode("latin-1")
        blank = self.letters[0x20]
        made = [
            [t.id for t in tokenize(blank + shown[a:b] if k else shown[a:b])] if simple else self.word(("", " ", "\n")[k], raw[a:b].decode())
            for a, b, k, simple in zip(start.tolist(), end.tolist(), lead.tolist(), letters.tolist(), strict=True)
        ]
        counts = np.array([len(m) for m in made], np.int64)
        ids = np.array([i for m in made for i in m], np.uint32)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.entries + len(made) > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        number = self.entries + np.arange(len(made))
        self.ids[self.used : self.used + len(ids)] = ids
        self.first[number] = self.used + np.cumsum(counts) - counts
        self.count[number] = counts
        slot = (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        self.keys[slot], self.entry[slot] = keys, number
        self.entries += len(made)
        self.used += len(ids)
        return number

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which documents are words that stand one blank or line end apart."""
        kind = _KIND[data]
        odd = kind == 2
        two = (kind[1:] > 0) & (kind[:-1] > 0)
        odd[1:] |= two
        at = np.flatnonzero(_ODD_FIRST[data])
        if len(at):
            padded = np.concatenate([data, np.zeros(2, np.uint8)]).astype(np.int64)
            pair = padded[at] << 8 | padded[at + 1]
            odd[at[np.isin(pair, _ODD_TWO) | np.isin(pair << 8 | padded[at + 2], _ODD_THREE)]] = True
        bad = np.zeros(len(offsets) - 1, dtype=bool)
        bad[np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1] = True
        full = np.flatnonzero(offsets[1:] > offsets[:-1])
        bad[full] |= (kind[offsets[full]] > 0) | (kind[offsets[full + 1] - 1] > 0)
        return ~bad

    def chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, where each document's begin and the last one's end)."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self.entries > MAX_WORDS:
            self._clear()
        plain = self._plain(data, offsets)
        words = Words(data, offsets)
        doc = np.repeat(np.arange(len(plain)), np.diff(words.bounds))
        keep = plain[doc]
        start, end, doc, keys = words.start[keep], words.end[keep], doc[keep], words.hash[keep]
        lead = np.ones(len(start), np.uint64)
        lead[data[np.maximum(start - 1, 0)] == 10] = 2
        lead[start == offsets[doc]] = 0
        # a mark after an ASCII letter is a piece of its own
        marked = (end - start > 1) & _MARK[data[end - 1]] & _ASCII_LETTER[data[np.maximum(end - 2, 0)]]
        parts = 1 + marked
        word, second = np.repeat(np.arange(len(start)), parts), (np.cumsum(parts) - 1)[marked]
        start, end, doc, keys, lead = start[word], end[word], doc[word], keys[word], lead[word]
        end[second - 1] -= 1
        start[second], lead[second] = end[second] - 1, 0
        split = np.concatenate([second - 1, second])
        keys[split] = words.prefix.slices(start[split], end[split])
        keys = mix(keys + lead) | np.uint64(1)
        slot = (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        entry = self.entry[slot].astype(np.int64)
        missing = np.flatnonzero(self.keys[slot] != keys)
        if len(missing):
            _, first, back = np.unique(keys[missing], return_index=True, return_inverse=True)
            at = missing[first]
            entry[missing] = self._learn(keys[at], data, start[at], end[at], lead[at])[back]
        counts = self.count[entry]
        ids = self.ids[ranges(self.first[entry], counts)]
        sizes = np.bincount(doc, weights=counts, minlength=len(plain)).astype(np.int64)
        if plain.all():
            return ids, np.concatenate([[0], np.cumsum(sizes)])
        parts, at, raw = [], 0, data.tobytes()
        for i, fits in enumerate(plain.tolist()):
            if fits:
                parts.append(ids[at : at + sizes[i]])
                at += sizes[i]
            else:
                parts.append(np.array(self.whole(raw[offsets[i] : offsets[i + 1]].decode()), np.uint32))
                sizes[i] = len(parts[-1])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this process for a vocabulary file; the file is read once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]

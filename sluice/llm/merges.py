"""Byte-pair merges of many words at once, from a public vocabulary file.

Merging a word means: as long as two neighbours have a rank, join the pair with the best
rank, the first of them if there are several. Here a batch of words does one such step
together, as rows of a matrix, and words that are done leave the batch.
"""

from __future__ import annotations

import json
import os
from functools import cached_property

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
# Longer words are left to the library.
LONGEST = 128
# Words that are merged together: their matrices stay in a core's cache.
BATCH = 1 << 11


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free code from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Merges:
    """The merge table of a byte-level vocabulary file."""

    def __init__(self, path: str):
        self._path = path
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        model = self.spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError("a byte-level BPE file is needed")
        self.vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.letters = byte_letters()
        self._ids = np.array([self.vocab[self.letters[b]] for b in range(256)], np.int32)
        self._last_ids = np.array([self.vocab[self.letters[b] + suffix] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([(self.vocab[a] << 32) + self.vocab[b] for a, b in pairs], np.uint64)
        self._merged = np.array([self.vocab[a + b] for a, b in pairs], np.int32)
        self._none = len(pairs)
        self.spec["model"] = None  # as large as the tables made of it
        self._build(keys)

    @cached_property
    def library(self):
        """The library's tokenizer of the same file; many tasks never need it."""
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return Tokenizer.from_file(self._path)

    def _build(self, keys: np.ndarray) -> None:
        """A hash table with open addressing: pair of ids to rank."""
        bits = max(4, int(len(keys) * 3).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self._ranks = np.full(1 << bits, self._none, np.int32)
        waiting, slots = np.arange(len(keys)), ((keys * MIX) >> self._shift).astype(np.int64)
        while len(waiting):
            free = self._ranks[slots] == self._none
            # Of several that want a free slot one gets it.
            self._ranks[slots[free]] = waiting[free]
            won = self._ranks[slots] == waiting
            self._keys[slots[won]] = keys[waiting[won]]
            waiting, slots = waiting[~won], (slots[~won] + 1) & self._mask

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; one above all ranks where the pair has none, as all with the id -1."""
        key = (left.astype(np.uint64) << np.uint64(32)) + right.astype(np.uint64)
        slot = ((key * MIX) >> self._shift).astype(np.int64)
        there = self._keys[slot]
        rank, other = self._ranks[slot], there != key
        missed = np.flatnonzero(other & (rank != self._none))
        rank[other] = self._none
        while len(missed):
            slot[missed] = (slot[missed] + 1) & self._mask
            at = slot[missed]
            hit = self._keys[at] == key[missed]
            rank[missed[hit]] = self._ranks[at[hit]]
            missed = missed[~hit & (self._ranks[at] != self._none)]
        return rank

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, merged alone, as little-endian 32-bit numbers; no word is empty."""
        out = [b""] * len(words)
        lengths = np.array([len(w) for w in words], np.int64)
        for i in np.flatnonzero(lengths > LONGEST):
            text = "".join(self.letters[b] for b in words[i])
            out[i] = np.array([t.id for t in self.library.model.tokenize(text)], "<i4").tobytes()
        low = 0
        for high in (4, 6, 8, 10, 12, 16, 24, 40, 64, LONGEST):
            group = np.flatnonzero((lengths > low) & (lengths <= high))
            for at in range(0, len(group), BATCH):
                places = group[at : at + BATCH]
                self._encode([words[i] for i in places.tolist()], places, high, out)
            low = high
        return out

    def _encode(self, words: list[bytes], places: np.ndarray, width: int, out: list[bytes]) -> None:
        if not words:
            return
        size = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        ids = self._ids[raw]
        rows = np.arange(len(words))
        ids[rows, size - 1] = self._last_ids[raw[rows, size - 1]]
        ids[np.arange(width)[None, :] >= size[:, None]] = -1
        ids = np.hstack([ids, np.full((len(words), 1), -1, np.int32)])
        ranks = self._rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(words), width)
        column = np.arange(width)[None, :]
        while len(rows):
            best = ranks.argmin(axis=1)
            rank = ranks[rows, best]
            done = rank == self._none
            if done.any():
                block, at = ids[done].astype("<i4").tobytes(), 0
                for place, n in zip(places[done].tolist(), size[done].tolist()):
                    out[place] = block[at : at + 4 * n]
                    at += 4 * width + 4
                keep = ~done
                ids, ranks, size, places, best, rank = ids[keep], ranks[keep], size[keep], places[keep], best[keep], rank[keep]
                rows = np.arange(len(places))
            if not len(rows):
                break
            # The pair becomes one id and all behind it move up.
            behind = column > best[:, None]
            ids[:, :-1] = np.where(behind, ids[:, 1:], ids[:, :-1])
            ids[rows, best] = self._merged[rank]
            ranks[:, :-1] = np.where(behind[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = self._none
            size = size - 1
            before = np.flatnonzero(best > 0)
            r, c = np.concatenate([rows, before]), np.concatenate([best, best[before] - 1])
            ranks[r, c] = self._rank(ids[r, c], ids[r, c + 1])

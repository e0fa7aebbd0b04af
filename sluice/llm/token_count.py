"""Token counts of whole texts by the whole-token shortcut.

When a worker starts, every string of the vocabulary is merged alone; those that end as one
token are whole tokens. In a text, each pre-token that is a whole token counts one
without any merging. Only the rest is merged, and a bounded cache keeps the results.

Texts with characters on which regular expression engines may disagree (control
characters, unusual spaces, rarely used or newly assigned letters) are counted by the
library itself, so counts equal the library's on every text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, filterfalse

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.merges import Merges
from sluice.llm.workers import give_back
from sluice.session import small_batches

# Cached counts of pre-tokens that are not whole tokens.
CACHE = 1 << 18
# Pre-tokens that are looked at together.
TOGETHER = 1 << 17

# Fixed value: the public pre-token pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Long-settled characters: ASCII, Latin, Greek, Cyrillic, common punctuation and kana, CJK.
PLAIN = r"[\t\n\r -~¡-¬®-ɏΑ-ΡΣ-ώЀ-џ‐-‧‰-›€ぁ-ゖァ-ヺ一-龥]*"


class TokenCounter:
    """Counts tokens as the library does for a byte-level vocabulary file."""

    def __init__(self, path: str):
        self._merges = Merges(path)
        spec = self._merges.spec
        level = spec["pre_tokenizer"] or {}
        if level.get("type") != "ByteLevel" or level.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("a byte-level file without normalizer or prefix space is needed")
        special = [t["content"] for t in spec["added_tokens"]]
        self._split = regex.compile("|".join(map(regex.escape, special))) if special else None
        self._pretokens = regex.compile(PATTERN)
        self._plain = regex.compile(PLAIN)
        self.whole_tokens = self._proved()
        self._counts = dict.fromkeys(self.whole_tokens, 1)

    def _proved(self) -> frozenset[str]:
        """Strings of the vocabulary that merging alone leaves as one token; parts of a character apart."""
        back = {c: b for b, c in self._merges.letters.items()}
        strings = []
        for token in self._merges.vocab:
            if all(c in back for c in token):
                strings.append(bytes(back[c] for c in token))
        alone = [s for s, ids in zip(strings, self._merges.encode(strings)) if len(ids) == 4]
        out = set()
        for s in alone:
            try:
                out.add(s.decode())
            except UnicodeDecodeError:
                continue
        return frozenset(out)

    def _learn(self, pretokens: Iterable[str]) -> None:
        """Merge the pre-tokens that are not known yet."""
        if len(self._counts) > len(self.whole_tokens) + CACHE:
            self._counts = dict.fromkeys(self.whole_tokens, 1)
        new = list(set(filterfalse(self._counts.__contains__, pretokens)))
        merged = self._merges.encode([p.encode() for p in new])
        self._counts.update((p, len(ids) // 4) for p, ids in zip(new, merged))

    def counts(self, texts: Iterable[str | None]) -> list[int]:
        """Tokens of each text; none of a null text."""
        out: list[int] = []
        waiting: list[tuple[int, list[str]]] = []

        def flush() -> None:
            self._learn(chain.from_iterable(p for _, p in waiting))
            for i, pretokens in waiting:
                out[i] += sum(map(self._counts.__getitem__, pretokens))
            waiting.clear()

        together = 0
        for i, text in enumerate(texts):
            out.append(0)
            if not text:
                continue
            if not self._plain.fullmatch(text):
                out[i] = len(self._merges.library.encode(text, add_special_tokens=False).ids)
                continue
            parts = self._split.split(text) if self._split else [text]
            out[i] = len(parts) - 1
            for part in parts:
                pretokens = self._pretokens.findall(part)
                waiting.append((i, pretokens))
                together += len(pretokens)
            if together > TOGETHER:
                flush()
                together = 0
        flush()
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """One counter per worker and file."""
    return TokenCounter(path)


def token_counts(text: Column, path: str) -> Column:
    """Tokens of each text; a null text counts as empty."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(counter(path).counts(texts), dtype="int64")
        give_back()

    return run(text)


def count_tokens(
    docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    ``path`` names the vocabulary file, which every executor can open there. Special
    strings inside a text count as the library counts them by default: one token each.
    Null texts count as empty, repeated rows stay, no row is moved between tasks.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(
        F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), token_counts(text, path).alias("n_tokens")
    )
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

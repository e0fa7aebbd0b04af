"""URL rules judged by one bit-parallel wildcard automaton.

All glob rules are packed side by side into the bits of a few 64-bit words. One step of
the extended Shift-And automaton moves all rules over one character of every URL of a
batch: ``state = ((state << 1 | starts) & accepts[c]) | (state & stays[c])``. A wildcard
is a bit that stays on while the characters it covers pass by. The cost is characters
times words, whatever the number of matches.

Globs match a whole canonical URL, which is host (A-Z lower-cased) followed by path:
``*`` covers any run of characters without ``/``, ``**`` any run at all, ``?`` one
character but ``/``; a backslash takes the next character as it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """A verdict for a host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    def globs(self) -> list[str]:
        quoted = "".join("\\" + c if c in "*?\\" else c for c in self.host + self.path) + "**"
        return [quoted, "*." + quoted]


class GlobAutomaton:
    """Tells which globs match each of many strings."""

    def __init__(self, globs: Sequence[str]):
        tokens = [self._parse(g) for g in globs]
        literals = sorted({t for glob in tokens for t in glob if len(t) == 1} | {"/"})
        # Symbol 0 stands for every character that no rule names.
        self._known = np.array([ord(c) for c in literals], np.uint32)
        width = sum(len(t) + 1 for t in tokens)
        self.words = max(1, -(-width // 64))
        symbols = len(literals) + 1
        accepts, stays = (np.zeros((symbols, self.words), np.uint64) for _ in range(2))
        skips, starts = (np.zeros(self.words, np.uint64) for _ in range(2))
        self._final, at = [], 0
        others = [i for i in range(symbols) if i == 0 or literals[i - 1] != "/"]
        for glob in tokens:
            # Bit `at` is on before anything is read; bit `at + i` once token i was taken.
            self._set(starts, at)
            for i, token in enumerate(glob, 1):
                if token in ("*", "**") and len(token) == 2 or token == "any":
                    for symbol in others if token == "any" else range(symbols):
                        self._set(stays[symbol], at + i)
                    self._set(skips, at + i)
                elif token == "one":
                    for symbol in others:
                        self._set(accepts[symbol], at + i)
                else:
                    self._set(accepts[literals.index(token) + 1], at + i)
            self._final.append(at + len(glob))
            at += len(glob) + 1
        self._accepts, self._stays, self._skips = accepts, stays, skips
        self._longest_skip = max((self._run(t) for t in tokens), default=0)
        self._start = self._skip(starts[None, :])[0]

    @staticmethod
    def _parse(glob: str) -> list[str]:
        out, i = [], 0
        while i < len(glob):
            c = glob[i]
            if c == "\\" and i + 1 < len(glob):
                i += 1
                out.append(glob[i])
            elif glob.startswith("**", i):
                out.append("**")
                i += 1
            else:
                out.append({"*": "any", "?": "one"}.get(c, c))
            i += 1
        return out

    @staticmethod
    def _run(tokens: list[str]) -> int:
        longest = now = 0
        for t in tokens:
            now = now + 1 if t in ("any", "**") else 0
            longest = max(longest, now)
        return longest

    @staticmethod
    def _set(words: np.ndarray, bit: int) -> None:
        words[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    @staticmethod
    def _shift(state: np.ndarray) -> np.ndarray:
        out = state << np.uint64(1)
        out[:, 1:] |= state[:, :-1] >> np.uint64(63)
        return out

    def _skip(self, state: np.ndarray) -> np.ndarray:
        """A wildcard may cover nothing, so its bit goes on with the one before it."""
        for _ in range(self._longest_skip):
            state = state | (self._shift(state) & self._skips)
        return state

    def matches(self, texts: Sequence[str]) -> np.ndarray:
        """A boolean matrix: strings by globs."""
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.minimum(np.searchsorted(self._known, codes), len(self._known) - 1)
        symbols = np.where(self._known[place] == codes, place + 1, 0)
        begins = (np.cumsum(lengths) - lengths)[order]
        state = np.repeat(self._start[None, :], len(texts), axis=0)
        sizes = lengths[order]
        for position in range(int(sizes[0]) if len(sizes) else 0):
            active = int(np.searchsorted(-sizes, -position, side="left"))  # longer than position
            c = symbols[begins[:active] + position]
            now = state[:active]
            state[:active] = self._skip((self._shift(now) & self._accepts[c]) | (now & self._stays[c]))
        out = np.zeros((len(texts), len(self._final)), bool)
        for g, bit in enumerate(self._final):
            out[order, g] = (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) == 1
        return out


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def judge_urls(
    pages: DataFrame, rules: Sequence[UrlRule], url_col: str = "url", default: str = "allow", keep: Sequence[str] = ("page_id",)
) -> DataFrame:
    """The columns ``keep`` with ``host``, ``path``, ``rule`` and ``verdict`` of every row's URL.

    The longest fitting rule decides (host and path together; of equally long ones that
    with the longer host, then the one named first). Where none fits, ``rule`` is null
    and the verdict is ``default``; so for a null URL and for one without ``://``, whose
    host and path are empty. Repeated rows stay. No shuffle: rules travel with the
    function, the table is read once.
    """
    if not rules:
        raise ValueError("no rules")
    ranked = sorted(range(len(rules)), key=lambda i: (-len(rules[i].host + rules[i].path), -len(rules[i].host), i))
    best = [rules[i] for i in ranked]
    automaton = GlobAutomaton([g for r in best for g in r.globs()])
    names = np.array([r.host + r.path for r in best] + [None], object)
    verdicts = np.array([r.verdict for r in best] + [default], object)

    @F.pandas_udf("rule string, verdict string")
    def judged(urls: pd.Series) -> pd.DataFrame:
        found = automaton.matches(urls.tolist())
        fits = found.reshape(len(urls), len(best), 2).any(axis=2)
        first = np.where(fits.any(axis=1), fits.argmax(axis=1), len(best))
        return pd.DataFrame({"rule": names[first], "verdict": verdicts[first]})

    host, path = url_parts(F.col(url_col))
    kept = [c for c in keep if c not in ("host", "path")]
    parts = pages.select(*kept, host.alias("host"), path.alias("path"))
    return parts.withColumn("_judged", judged(F.concat("host", "path"))).select(*kept, "host", "path", "_judged.*")

"""Column names for the paths of nested documents."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

# What names are made of (fixed values): the text of a node, and characters a column name cannot have.
TEXT_NODE = "/$"
CHARACTERS = {"@": "atr_", ":": "_"}
# Segments that a name starts with.
WIDTH = {"generic": 1, "custom": 2}


def _candidates(node: str, width: int, remove: Sequence[str]) -> Iterator[str]:
    """Names for a node in order of preference: its last segments, ever more of them, then numbered."""
    for part in remove:
        node = node.replace(part, "")
    segments = node.lower().split("/")
    for first in range(max(0, len(segments) - width), -1, -1):
        name = "_".join(segments[first:]).strip()
        for character, text in CHARACTERS.items():
            name = name.replace(character, text)
        yield name
    while True:
        name += "_1"
        yield name


def column_names(
    paths: Iterable[str], naming: str = "custom", remove: Sequence[str] = (), update: Sequence[str] = ()
) -> dict[str, str]:
    """Name per path. ``generic``: last segment; ``custom``: parent and last segment.

    With ``custom`` paths ending in ``/$`` are the text of their parent and share its
    name. Paths in ``update`` (generic: their last segment; custom: how they end) get one
    more segment. Nodes choose in the order of their paths, each the first free name.
    """
    fold = naming == "custom"
    nodes = {p: p.removesuffix(TEXT_NODE) if fold else p for p in paths}
    wide = {p for p in nodes if (p.endswith(tuple(update)) if fold else p.rsplit("/", 1)[-1] in update)}
    names: dict[str, str] = {}
    for node in sorted(set(nodes.values())):
        taken = set(names.values())
        names[node] = next(c for c in _candidates(node, WIDTH[naming] + (node in wide), remove) if c not in taken)
    return {p: names[node] for p, node in nodes.items()}

"""The splitters written plainly, one text at a time, for comparison."""

import re

SEPARATORS = ("\n\n", "\n", " ", "")


def pack(weights: list[int], size: int, overlap: int) -> list[tuple[int, int]]:
    """Greedy runs of atoms of at most ``size``, as (first, after-last) indexes.

    The next run starts with the trailing atoms that weigh at most ``overlap``
    and still leave room for the atom that did not fit.
    """
    runs, first, load = [], 0, 0
    for i, w in enumerate(weights):
        if load + w > size and i > first:
            runs.append((first, i))
            while first < i and (load > overlap or load + w > size):
                load -= weights[first]
                first += 1
        load += w
    if first < len(weights):
        runs.append((first, len(weights)))
    return runs


def atoms(text: str, start: int, size: int, separators=SEPARATORS) -> list[tuple[int, int]]:
    """Contiguous spans of at most ``size`` characters, cut at the coarsest separator."""
    if len(text) <= size:
        return [(start, start + len(text))] if text else []
    rank = next(i for i, s in enumerate(separators) if s in text)
    sep, finer = separators[rank], separators[rank + 1:]
    if not sep:
        return [(start + i, start + i + 1) for i in range(len(text))]
    spans, at = [], 0
    while at < len(text):
        found = text.find(sep, at)
        end = len(text) if found < 0 else found + len(sep)
        spans.extend(atoms(text[at:end], start + at, size, finer))
        at = end
    return spans


def recursive_chunks(text: str, size: int, overlap: int) -> list[str]:
    spans = atoms(text, 0, size)
    runs = pack([b - a for a, b in spans], size, overlap)
    chunks = (text[spans[i][0]:spans[j - 1][1]].strip() for i, j in runs)
    return [c for c in chunks if c]


def sentence_chunks(text: str, size: int, overlap: int) -> list[str]:
    """Whole sentences packed up to ``size`` words; a longer sentence stays whole."""
    spans = [m.span() for m in re.finditer(r"\S.*?(?:[.!?]+(?=\s)|\Z)", text, re.S)]
    runs = pack([len(text[a:b].split()) for a, b in spans], size, overlap)
    return [text[spans[i][0]:spans[j - 1][1]].strip() for i, j in runs]

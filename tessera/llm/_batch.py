"""Word coding of text batches, for operators whose tasks run numpy: the words of some
texts are numbered, so that whatever depends on a word alone is computed once for each
distinct word and then gathered by number."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np

#: Characters of text that a task codes at once; one longer text is coded alone, whole.
CHARS = 2_500_000


def slices(texts: Iterable[str | None], chars: int = CHARS) -> Iterator[list[str]]:
    """``texts`` in order, some at a time; null becomes the empty text."""
    some, n = [], 0
    for t in texts:
        t = t or ""
        if some and n + len(t) > chars:
            yield some
            some, n = [], 0
        some.append(t)
        n += len(t)
    if some:
        yield some


def coded(texts: list[str], split: Callable[[str], list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(vocabulary, codes, ends): ``codes[ends[i - 1]:ends[i]]`` are the words of text i as
    positions in the vocabulary."""
    index: dict[str, int] = defaultdict(count().__next__)  # a new word gets the next number
    number = index.__getitem__
    codes, ends, n = [], np.zeros(len(texts), np.int64), 0
    for i, t in enumerate(texts):
        own = split(t)
        codes.append(np.fromiter(map(number, own), np.int32, len(own)))
        n += len(own)
        ends[i] = n
    return list(index), np.concatenate(codes) if codes else np.zeros(0, np.int32), ends


def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` between successive ``ends``; zero for empty ranges."""
    out = np.zeros((len(ends), *values.shape[1:]), values.dtype)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    some = ends > starts
    if some.any():
        out[some] = np.add.reduceat(values, starts[some], axis=0)
    return out

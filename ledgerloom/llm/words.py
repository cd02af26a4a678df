"""Encoding texts word by word, each distinct word once while a worker remembers it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

#: Words that a worker remembers at most; then it starts anew. Bounds its memory only.
REMEMBERED = 200_000
#: Ids that it remembers at most, for each of those words: long words count for more.
IDS_PER_WORD = 8


class WordMemory:
    """``encode`` maps new words to their ids, all in one array, and how many each word has; it may reorder the words it is given."""

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], remembered: int = REMEMBERED):
        self.encode_new, self.remembered = encode, remembered
        self.forget()

    def forget(self) -> None:
        self.known: dict = {}
        self.ids, self.sizes, self.begins = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int64)

    def encode(self, texts: Sequence[list]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts given as lists of words, in one array, and where each text's ids end."""
        words = [word for text in texts for word in text]
        ends = np.cumsum([len(text) for text in texts], dtype=np.int64)
        flat, bounds = self.joined(self.places(words))
        return flat, bounds[ends]

    def places(self, words: list) -> np.ndarray:
        """The numbers of words, new ones encoded; they hold until the next call."""
        if len(self.known) > self.remembered or len(self.ids) > IDS_PER_WORD * self.remembered:
            self.forget()
        if new := list(set(words).difference(self.known)):
            ids, sizes = self.encode_new(new)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
            self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])
            self.begins = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def joined(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words by their numbers, in one array, and 0 and where each word's ids end."""
        sizes = self.sizes.take(places)
        bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        return self.ids.take(np.repeat(self.begins.take(places) - bounds[:-1], sizes) + np.arange(bounds[-1])), bounds

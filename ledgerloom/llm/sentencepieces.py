"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The best segmentation of a text is the one whose pieces have the highest sum of log scores. Pieces are
looked up in a double-array trie over UTF-8 bytes; a character that no piece covers costs ``UNKNOWN_PENALTY``
more than the rarest piece and is written as its bytes (``<0x00>`` to ``<0xFF>``).

White space is marked as in the piece files: a text gets a leading space, and each space is the marker
U+2581. In the trie the marker is the space itself, so a U+2581 that stands in a text is an uncovered character,
kept as bytes, and decoding gives every text back exactly.

The vocabulary files are not trained here. A file of merge ranks holds no log scores, so ranks are
turned into scores by Zipf's law, ``-ln(rank * H)`` with the harmonic sum ``H``; files that hold scores keep them.

As no piece goes on after a space or across a line break, words are segmented on their own, each
distinct word once while a worker remembers it. Texts of any length are handled whole.

NULL texts give NULL ids, empty texts no ids; NULL ids give a NULL text. Columns are expressions on one
column, so other columns, repeated rows and empty tables need no care.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, free_name, read
from .words import WordMemory

MARKER = "▁"
UNKNOWN_PENALTY = 10.0

_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
_WORDS = re.compile(rb"\n| *[^ \n]+| +")
_LINES = re.compile(rb"\n|[^\n]+")
#: Bytes of the character that begins with a byte.
_CHARACTER = np.repeat([1, 2, 3, 4], [0xC0, 0x20, 0x10, 0x10])
#: Words up to so many bytes are searched side by side, so many at a time: the work arrays stay below 15 MB.
_SIDE_BY_SIDE = 48
_TOGETHER = 8192


@dataclass(frozen=True)
class PieceTrie:
    """Everything the workers need: bounded by the vocabulary file."""

    base: np.ndarray  # child of node s by byte c: base[s] + c, if check there is s
    check: np.ndarray
    piece: np.ndarray  # id of the piece that ends in a node, or -1
    scores: np.ndarray
    texts: list[bytes]  # by id, markers as spaces
    byte_ids: list[int]
    unknown_score: float
    by_word: bool

    def cutter(self) -> re.Pattern[bytes]:
        return _WORDS if self.by_word else _LINES


def build_trie(keys: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A double-array trie: nodes are placed breadth first at the lowest base that holds all their children."""
    nodes: list[dict[int, int]] = [{}]
    ends = [-1]
    for key, number in keys:
        at = 0
        for byte in key:
            if byte not in nodes[at]:
                nodes[at][byte] = len(nodes)
                nodes.append({})
                ends.append(-1)
            at = nodes[at][byte]
        ends[at] = number

    # Bases are tried a window at a time; one window more than all nodes need is always free.
    window = 4096
    size = len(nodes) + 256 * window
    base, check, piece = (np.full(size, fill, dtype=np.int32) for fill in (0, -1, -1))
    free = np.ones(size, dtype=bool)
    free[0], check[0] = False, 0
    lowest, used = 1, 1
    waiting = [(0, 0)]
    for at, slot in waiting:
        piece[slot] = ends[at]
        children = np.array(sorted(nodes[at]), dtype=np.int64)
        if not len(children):
            continue
        while not free[lowest]:
            lowest += 1
        start = max(1, lowest - int(children[0]))
        while not (fits := np.logical_and.reduce([free[start + c : start + c + window] for c in children])).any():
            start += window
        start += int(fits.argmax())
        places = start + children
        base[slot], free[places], check[places] = start, False, slot
        used = max(used, int(places[-1]) + 1)
        waiting += zip((nodes[at][c] for c in children.tolist()), places.tolist(), strict=True)
    return base[:used], check[:used], piece[:used]


def load_pieces(path: str) -> PieceTrie:
    """Read a piece file on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    count = model.GetPieceSize()
    plain = [i for i in range(count) if not (model.IsByte(i) or model.IsControl(i) or model.IsUnknown(i) or model.IsUnused(i))]
    given = {i: model.GetScore(i) for i in plain}
    texts = [b""] * count
    byte_ids = [0] * 256
    for i in range(count):
        if model.IsByte(i):
            value = int(_BYTE_PIECE.fullmatch(model.IdToPiece(i))[1], 16)
            byte_ids[value], texts[i] = i, bytes([value])
    for i in plain:
        texts[i] = model.IdToPiece(i).replace(MARKER, " ").encode()

    scores = np.full(count, -np.inf)
    if all(float(s).is_integer() for s in given.values()):
        harmonic = float(np.sum(1.0 / np.arange(1, len(plain) + 1)))
        for rank, i in enumerate(plain, 1):
            scores[i] = -np.log(rank * harmonic)
    else:
        for i in plain:
            scores[i] = given[i]
    base, check, piece = build_trie([(texts[i], i) for i in plain])
    by_word = not any(b" " in texts[i].lstrip(b" ") or b"\n" in texts[i] for i in plain)
    return PieceTrie(base, check, piece, scores, texts, byte_ids, float(scores[plain].min()) - UNKNOWN_PENALTY, by_word)


class Segmenter:
    """Viterbi over words: many short words side by side in numpy, long ones alone."""

    def __init__(self, trie: PieceTrie):
        pad = 256  # a step from any node stays inside
        self.base = np.concatenate([trie.base, np.zeros(pad, np.int32)])
        self.check = np.concatenate([trie.check, np.full(pad, -1, np.int32)])
        self.piece = np.concatenate([trie.piece, np.full(pad, -1, np.int32)])
        self.lists = self.base.tolist(), self.check.tolist(), self.piece.tolist(), trie.scores.tolist()
        self.scores, self.byte_ids, self.unknown = trie.scores, trie.byte_ids, trie.unknown_score
        self.bytes = np.array(trie.byte_ids, np.int32)
        self.cut = trie.cutter().findall
        self.memory = WordMemory(self.best_of_all)

    def path(self, word: bytes, begins: list[int], found: list[int]) -> list[int]:
        """Ids of the path that ends at the word's end; ``begins`` and ``found`` by end."""
        ids: list[int] = []
        end = len(word)
        while end > 0:
            start = begins[end]
            ids += [found[end]] if found[end] >= 0 else [self.byte_ids[b] for b in reversed(word[start:end])]
            end = start
        ids.reverse()
        return ids

    def best(self, word: bytes) -> list[int]:
        """Ids of the best path; of equal ones that whose last piece starts first."""
        base, check, piece, scores = self.lists
        size = len(word)
        reached = [float("-inf")] * (size + 1)
        reached[0] = 0.0
        begins, ids = [0] * (size + 1), [-1] * (size + 1)
        for start in range(size):
            so_far = reached[start]
            if so_far == float("-inf"):
                continue  # inside a character
            character = start + int(_CHARACTER[word[start]])
            covered, node, end = False, 0, start
            while end < size:
                step = base[node] + word[end]
                if check[step] != node:
                    break
                node, end = step, end + 1
                found = piece[node]
                if found >= 0:
                    covered = covered or end == character
                    score = so_far + scores[found]
                    if score > reached[end]:
                        reached[end], begins[end], ids[end] = score, start, found
            if not covered and so_far + self.unknown > reached[character]:
                reached[character], begins[character], ids[character] = so_far + self.unknown, start, -1
        return self.path(word, begins, ids)

    def best_of_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``best`` of each word, one step of all searches at a time: ids in one array, and how many each word has."""
        sizes = np.array([len(w) for w in words])
        width = int(sizes.max())
        letters = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width).astype(np.int32)
        reached = np.full((len(words), width + 1), -np.inf)
        reached[:, 0] = 0.0
        begins = np.zeros((len(words), width + 1), np.int32)
        ids = np.full((len(words), width + 1), -1, np.int32)
        for start in range(width):
            rows = np.flatnonzero((sizes > start) & (reached[:, start] > -np.inf))
            all_rows, so_far = rows, reached[rows, start]
            all_so_far, node = so_far, np.zeros(len(rows), np.int32)
            character = start + _CHARACTER[letters[:, start]]
            covered = np.zeros(len(words), bool)
            for end in range(start, width):
                step = self.base[node] + letters[rows, end]
                on = (self.check[step] == node) & (sizes[rows] > end)
                rows, so_far, node = rows[on], so_far[on], step[on]
                if not len(rows):
                    break
                found = self.piece[node]
                hit = found >= 0
                covered[rows[hit & (character[rows] == end + 1)]] = True
                score = so_far[hit] + self.scores[found[hit]]
                better = score > reached[rows[hit], end + 1]
                at = rows[hit][better]
                reached[at, end + 1], begins[at, end + 1], ids[at, end + 1] = score[better], start, found[hit][better]
            open_ = ~covered[all_rows]
            at, score = all_rows[open_], all_so_far[open_] + self.unknown
            better = score > reached[at, character[at]]
            at = at[better]
            reached[at, character[at]], begins[at, character[at]], ids[at, character[at]] = score[better], start, -1
        out, count = np.zeros((len(words), width), np.int32), np.zeros(len(words), np.int64)
        rows, end = np.arange(len(words)), sizes.copy()
        while len(rows):
            start, found = begins[rows, end], ids[rows, end]
            whole = found >= 0
            out[rows[whole], count[rows[whole]]] = found[whole]
            count[rows[whole]] += 1
            for back in range(1, 5):  # bytes of characters that no piece covers
                some = ~whole & (end - back >= start)
                at = rows[some]
                out[at, count[at]] = self.bytes[letters[at, end[some] - back]]
                count[at] += 1
            on = start > 0
            rows, end = rows[on], start[on]
        return out[:, ::-1][np.arange(width)[::-1] < count[:, None]], count

    def best_of_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``best`` of words of any length, which are put in order of length."""
        words.sort(key=len)
        short = sum(len(w) <= _SIDE_BY_SIDE for w in words)
        done = [self.best_of_many(words[at : min(at + _TOGETHER, short)]) for at in range(0, short, _TOGETHER)]
        for word in words[short:]:
            ids = self.best(word)
            done.append((np.array(ids, np.int32), np.array([len(ids)])))
        return np.concatenate([ids for ids, _ in done]), np.concatenate([sizes for _, sizes in done])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text's ids end."""
        return self.memory.encode([self.cut(b" " + t.encode()) if t else [] for t in texts])


def decode_ids(ids: np.ndarray, texts: list[bytes]) -> str:
    return b"".join(map(texts.__getitem__, ids.tolist())).removeprefix(b" ").decode("utf-8", "replace")


def _lists(flat: np.ndarray, ends: np.ndarray, nulls: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat, pa.int32()), mask=nulls)


def encode_pieces(text: Column, trie: PieceTrie) -> Column:
    """The ids of a text column, as ``array<int>``."""

    @F.arrow_udf("array<int>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        segmenter = Segmenter(trie)
        for texts in batches:
            yield _lists(*segmenter.encode(texts.to_pylist()), texts.is_null())

    return encoded(text)


def checked_pieces(text: Column, trie: PieceTrie) -> Column:
    """A struct of ``ids`` and ``round_trip``, whether decoding them gives the text back."""

    @F.arrow_udf("ids array<int>, round_trip boolean")
    def checked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        segmenter = Segmenter(trie)
        for texts in batches:
            rows = texts.to_pylist()
            flat, ends = segmenter.encode(rows)
            parts = np.split(flat, ends[:-1])
            same = [t is None or decode_ids(p, trie.texts) == t for t, p in zip(rows, parts, strict=True)]
            yield pa.StructArray.from_arrays([_lists(flat, ends, texts.is_null()), pa.array(same)], ["ids", "round_trip"])

    return checked(text)


def decode_pieces(ids: Column, trie: PieceTrie) -> Column:
    """The text of an ``array<int>`` column of ids."""
    texts = trie.texts

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            flat, starts = rows.values.to_numpy(), rows.offsets.to_numpy()
            present = rows.is_valid().to_pylist()
            yield pa.array(
                [decode_ids(flat[a:b], texts) if p else None for p, a, b in zip(present, starts, starts[1:], strict=False)], pa.string()
            )

    return decoded(ids)


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def with_pieces(df: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    """Add the column ``ids`` (replaced if there is one)."""
    return bounded(df).withColumn(ids, encode_pieces(F.col(text), load_pieces(path or default_pieces())))


def round_trips(df: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """Add ``ids``, ``n_pieces`` and ``round_trip``, whether decoding the ids gives the text back (replaced where they exist)."""
    pieces = free_name(df, "_pieces")
    encoded = bounded(df).withColumn(pieces, checked_pieces(F.col(text), load_pieces(path or default_pieces())))
    ids = F.col(f"{pieces}.ids")
    counted = {"ids": ids, "n_pieces": F.coalesce(F.size(ids), F.lit(0)).cast("long"), "round_trip": F.col(f"{pieces}.round_trip")}
    return encoded.withColumns(counted).drop(pieces)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and whether they decode to its text."""
    return round_trips(read(spark, sf_dir, "documents")).select("doc_id", "ids", "n_pieces", "round_trip")

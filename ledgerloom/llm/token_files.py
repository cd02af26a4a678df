"""Token-id files: encode texts, write their ids as coded blocks, read them back.

Texts are put in ascending order of their id by a range partitioning; each partition's ids form one stream (an end id after
each document), cut into blocks of ``BLOCK_IDS`` ids that are coded by ``context_mixing``.

File format: a Parquet folder with one row per block.

``part``       number of the partition; parts are in ascending order of ids
``offset``     ids of the part before this block
``n_ids``      ids in the block
``payload``    the coded block, with its own length and checksum
``rows``       numbers of the documents in the part that the block holds ids of
``doc_ids``    their ids
``counts``     how many of their ids lie in this block; documents longer than a block go on in the next

A block needs no other to be read, a lost task writes its part again, and a worker holds ``LANES`` lanes of ids at a
time however long a document is. NULL and empty texts have the end id alone. Rows may share an id or lack one (those come first); rows
that agree are in any order, as nothing tells them apart. An empty table gives files without rows.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage_folder
from .common import BATCH_BYTES, bounded, read
from .context_mixing import BLOCK_IDS, LANE_IDS, decode_blocks, encode_blocks
from .words import WordMemory

END_ID = 0
#: Lanes of ``LANE_IDS`` ids coded side by side.
LANES = 4096
#: New pieces of texts given to the tokenizer at once.
TOGETHER = 100
#: Pieces remembered: those of several partitions, as new ones cost most of the encoding.
REMEMBERED = 1_300_000

SCHEMA = "part int, offset long, n_ids long, payload binary, rows array<long>, doc_ids array<long>, counts array<long>"


def default_tokenizer() -> str:
    """The tokenizer file's text, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def _flags() -> bytes:
    """By byte: 1 ASCII letter, 2 printed ASCII, 4 ASCII but no letter, 8 ASCII blank, 16 space, 32 no whitespace character begins with it, 64 line break or tab."""
    out = np.zeros(256, np.uint8)
    out[:0x80] |= 4
    for letters in (slice(0x41, 0x5B), slice(0x61, 0x7B)):
        out[letters] = 1
    out[0x21:0x7F] |= 2
    out[0x09:0x0E] |= 8 | 64
    out[0x20] |= 8 | 16
    out[0x21:0x80] |= 32
    out[0xC3:] |= 32
    out[0xE1:0xE4] = 0
    return out.tobytes()


_FLAGS = _flags()


def text_pieces(texts: pa.Array, specials: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The pieces of texts (no nulls) as bytes, and how many pieces come before the end of each text.

    A text is cut where the byte-level pattern always splits it: before a space that a solid character follows, after an
    ASCII letter that an ASCII character other than a letter follows, and before and after a line break between a printed
    ASCII character and a solid one. Texts with special tokens, which the tokenizer takes out before it splits, are one piece each.
    """
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    flags = np.frombuffer(raw.tobytes().translate(_FLAGS), np.uint8)
    left, right = flags[:-1], flags[1:]
    cut = np.zeros(len(raw) + 1, bool)
    cut[:-2] = left & (right >> 1) & 16
    cut[np.maximum(offsets[1:] - 1, 0)] = False  # no character of a text follows its last one
    cut[1:-1] |= (left & (right >> 2) & 3).astype(bool)
    cut[2:-1] |= ((left[:-1] << 5) & left[1:] & (right[1:] << 1) & 64).astype(bool)
    for special in specials:
        for k in np.flatnonzero(pc.match_substring(texts, special).to_numpy(zero_copy_only=False)):
            cut[offsets[k] : offsets[k + 1]] = False
    cut[offsets] = True
    bounds = np.flatnonzero(cut)
    found = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
    return found.dictionary_encode(), np.searchsorted(bounds, offsets[1:])


@lru_cache(maxsize=1)
def text_encoder(tokenizer_json: str, pattern: str):
    """A function from texts to their ids, in one array, and the places where each text ends. A worker keeps it between tasks.

    A byte-level tokenizer cuts its special tokens out of a text, splits the rest by its pattern before it merges bytes, and no
    merge crosses a split, so each distinct piece of the text between two splits is encoded once. With another pattern than
    that of ``public_tokenizers`` or another kind of tokenizer, whole texts are encoded. Special tokens in a text become their own ids, as the
    library has it by default; ``add_special_tokens=False`` only keeps it from adding some around the text.
    """
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer, spec = Tokenizer.from_str(tokenizer_json), json.loads(tokenizer_json)
    specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    splits = spec.get("pre_tokenizer") or {}
    known = splits.get("type") == "ByteLevel" and splits.get("use_regex", True) and not splits.get("add_prefix_space") and not spec.get("normalizer")
    cuts = known and pattern == public_tokenizers.PATTERN
    # Letters and line breaks form no special token when they are joined.
    glue = tokenizer.encode("\n", add_special_tokens=False).ids
    joins = cuts and len(glue) == 1 and not any(s.replace(" ", "").replace("\n", "").isalpha() for s in specials)

    def encode_joined(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces of letters and how many each has: a line break between them is always split off."""
        found = tokenizer.encode_batch_fast(["\n".join(pieces)], add_special_tokens=False)[0]
        ids = np.array(found.ids, np.int32)
        breaks = np.flatnonzero(ids == glue[0])
        return np.delete(ids, breaks), np.diff(breaks, prepend=-1, append=len(ids)) - 1

    def encode_others(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        return np.array(found.ids, np.int32), np.bincount(np.array(found.word_ids, np.int64), minlength=len(pieces))

    def encode_pieces(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        letters, others = [], []
        for piece in pieces:
            text = piece.decode()
            (letters if joins and text[text[:1] == " " :].isalpha() else others).append(text)
        pieces[:] = [text.encode() for text in letters + others]
        found = [
            encode(some[at : at + TOGETHER]) for encode, some in ((encode_joined, letters), (encode_others, others)) for at in range(0, len(some), TOGETHER)
        ]
        return np.concatenate([ids for ids, _ in found]), np.concatenate([sizes for _, sizes in found])

    memory = WordMemory(encode_pieces, REMEMBERED)

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces, ends = text_pieces(pc.fill_null(texts, ""), specials if cuts else [""])
        flat, bounds = memory.joined(memory.places(pieces.dictionary.to_pylist()).take(pieces.indices.to_numpy()))
        return flat, bounds[ends]

    return encode


def larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined to ``BATCH_BYTES`` or just above, so that a word is looked up once for more of its places."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= BATCH_BYTES:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def coded_blocks(df: DataFrame, row_id: str, text: str, tokenizer_json: str, pattern: str, parts: int | None = None, lanes: int = LANES, end_id: int = END_ID) -> DataFrame:
    """The rows of the file format, in ascending order of ids. Without a number of ``parts`` Spark joins small ones."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode = TaskContext.get().partitionId(), text_encoder(tokenizer_json, pattern)
        waiting, sizes, names, first_row, offset = [], [], [], 0, 0  # ids not yet coded; per document ids left and id
        together = lanes * LANE_IDS

        def flush(count: int) -> pa.RecordBatch:
            """Code the first ``count`` waiting ids."""
            nonlocal waiting, sizes, names, first_row, offset
            ids = np.concatenate(waiting)
            waiting = []
            blocks = [ids[at : min(at + BLOCK_IDS, count)] for at in range(0, count, BLOCK_IDS)]
            ends = np.cumsum(np.array(sizes, np.int64))
            starts = ends - np.array(sizes, np.int64)
            rows: dict[str, list] = {k: [] for k in ("rows", "doc_ids", "counts")}
            for at, block in zip(range(0, count, BLOCK_IDS), blocks, strict=True):
                low, high = np.searchsorted(ends, at, side="right"), np.searchsorted(starts, at + len(block), side="left")
                rows["rows"].append(list(range(first_row + low, first_row + high)))
                rows["doc_ids"].append(names[low:high])
                rows["counts"].append((np.minimum(ends[low:high], at + len(block)) - np.maximum(starts[low:high], at)).tolist())
            out = pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part] * len(blocks), pa.int32()),
                    "offset": pa.array(range(offset, offset + count, BLOCK_IDS), pa.int64()),
                    "n_ids": pa.array([len(b) for b in blocks], pa.int64()),
                    "payload": pa.array(encode_blocks(blocks), pa.binary()),
                }
                | {k: pa.array(v, pa.list_(pa.int64())) for k, v in rows.items()}
            )
            done = int(np.searchsorted(ends, count, side="right"))
            left = ends[done:] - np.maximum(starts[done:], count)
            waiting, sizes, names, first_row, offset = [ids[count:]], left.tolist(), names[done:], first_row + done, offset + count
            return out

        for batch in larger(batches):
            flat, ends = encode(batch.column(1))
            waiting.append(np.insert(flat, ends, end_id).view(np.uint32))
            sizes += (np.diff(ends, prepend=0) + 1).tolist()
            names += batch.column(0).to_pylist()
            while sum(sizes) >= together:
                yield flush(together)
        if total := sum(sizes):
            yield flush(total)

    chosen = bounded(df).select(F.col(row_id).cast("long").alias("id"), F.col(text).alias("text"))
    ascending = F.col("id").asc_nulls_first()
    ranged = chosen.repartitionByRange(parts, ascending) if parts else chosen.repartitionByRange(ascending)
    ordered = ranged.sortWithinPartitions(ascending)
    return ordered.mapInArrow(code, SCHEMA)


def pieces(blocks: DataFrame, lanes: int = LANES, with_ids: bool = True) -> DataFrame:
    """Each document's ids in each block: ``part``, ``row``, ``doc_id``, ``at`` (place in the part), ``n``, ``crc``, and if
    asked for ``ids``, as binary of unsigned 32-bit numbers."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        room = lanes

        def flush() -> pa.RecordBatch:
            nonlocal held, room
            found: dict[str, list] = {k: [] for k in ("part", "row", "doc_id", "at", "n", "crc", "ids")}
            for block, ids in zip(held, decode_blocks([b["payload"] for b in held]), strict=True):
                at = 0
                for row, name, count in zip(block["rows"], block["doc_ids"], block["counts"], strict=True):
                    raw = ids[at : at + count]
                    for k, v in zip(found, (block["part"], row, name, block["offset"] + at, count, zlib.crc32(raw)), strict=False):
                        found[k].append(v)
                    if with_ids:
                        found["ids"].append(raw.tobytes())
                    at += count
            held, room = [], lanes
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            arrays = {k: pa.array(v, kind) for (k, v), kind in zip(found.items(), kinds, strict=True) if with_ids or k != "ids"}
            return pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))

        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                room -= -(-row["n_ids"] // LANE_IDS)
                if room <= 0:
                    yield flush()
        if held:
            yield flush()

    schema = "part int, row long, doc_id long, at long, n long, crc long"
    return blocks.mapInArrow(decode, f"{schema}, ids binary" if with_ids else schema)


_SHIFTS: dict[int, tuple[int, ...]] = {0: tuple(1 << k for k in range(32))}


def _shift(count: int) -> tuple[int, ...]:
    """What appending ``count`` zero bytes does to each bit of a crc32: found by squaring, as the change is linear."""
    if count in _SHIFTS:
        return _SHIFTS[count]
    if count == 1:
        step = []
        for value in _SHIFTS[0]:
            for _ in range(8):
                value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
            step.append(value)
    else:
        half = _shift(count // 2)
        step = [_apply(half, v) for v in half]
        if count % 2:
            step = [_apply(_shift(1), v) for v in step]
    if len(_SHIFTS) > 4096:
        _SHIFTS.clear()
        _SHIFTS[0] = tuple(1 << k for k in range(32))
    _SHIFTS[count] = tuple(step)
    return _SHIFTS[count]


def _apply(matrix: tuple[int, ...], value: int) -> int:
    out, k = 0, 0
    while value:
        if value & 1:
            out ^= matrix[k]
        value >>= 1
        k += 1
    return out


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """The crc32 of joined bytes from the (crc32, length) of the parts."""
    total = 0
    for crc, size in parts:
        total = _apply(_shift(size), total) ^ crc if total else crc
    return total


def whole_crc(parts: Column) -> Column:
    """``joined_crc`` of an array of structs (at, crc, n) of pieces of 32-bit ids."""

    @F.arrow_udf("long")
    def joined(lists: pa.Array) -> pa.Array:
        return pa.array([joined_crc([(p["crc"], 4 * p["n"]) for p in row]) for row in lists.to_pylist()], pa.int64())

    return joined(F.array_sort(parts))


def documents_of(blocks: DataFrame) -> DataFrame:
    """From the files: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32``."""
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    starts = sizes.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    found = pieces(blocks, with_ids=False).groupBy("part", "row").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"), F.collect_list(F.struct("at", "crc", "n")).alias("crcs")
    )
    return found.join(starts, "part").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", whole_crc(F.col("crcs")).alias("ids_crc32"))


def write_tokens(df: DataFrame, path: str, row_id: str = "doc_id", text: str = "text", tokenizer_json: str | None = None, pattern: str | None = None) -> None:
    """Write the ids of all texts to a folder in the file format."""
    import public_tokenizers

    coded_blocks(df, row_id, text, tokenizer_json or default_tokenizer(), pattern or public_tokenizers.PATTERN).write.parquet(path)


def op8_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{stage_folder(spark)}/token-blocks-{uuid.uuid4().hex}"
    write_tokens(read(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return documents_of(spark.read.schema(SCHEMA).parquet(path))

"""A context-mixing entropy coder for token ids.

Ids are coded in blocks that carry their length, checksums and frequencies, so each can be read alone. A block is cut into
lanes of ``LANE_IDS`` ids. Inside a lane three models predict the next id:

* order 2: the id that last followed these two ids,
* order 1: the id that last followed this id,
* order 0: how often the block's ids come that neither of the others predicts.

They are mixed: a model's share of the code space is how often it is right in the block in the same context, which is how
sure the order-2 and the order-1 prediction were lately. A 48-bit asymmetric numeral system (a range coder that writes
backwards) turns the shares into 16-bit words. All results are integers, so every machine reads the same ids.

The lanes of all blocks are coded side by side in numpy, one id of each at a time.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Sequence

import numpy as np

LANE_IDS = 2048
BLOCK_LANES = 128
BLOCK_IDS = LANE_IDS * BLOCK_LANES
MAGIC = b"CMR2"
_HEADER = "<4sIIII"  # magic, ids, crc32 of the ids, crc32 of all that follows, bytes of the packed tables
_HEADER_SIZE = struct.calcsize(_HEADER)
_SLOTS = 512
#: Bits of the shares of the models, and of the frequencies of ids.
_MIX, _FREQUENCY = 12, 16
_LOWEST, _TOP = 1 << 32, 48
#: Ids with a frequency of their own; any others follow an escape, in two words.
_SYMBOLS = 1 << 15
#: Ids up to here are counted in a table by id.
_DENSE = 1 << 20
#: Blocks read side by side, as each has a table of all places in its code space.
_TABLES = 64
#: The kind by whether order 1 and order 2 (twice) were right.
_KIND = np.array([2, 1, 0, 0], np.uint8)
#: The code of a lane that has ended, and which codes say that neither model was right.
_ENDED = 255
_IS_MISS = (np.arange(256) % 3 == 2) & (np.arange(256) != _ENDED)


class _Model:
    """The models of all lanes: a row for order 1, one for order 2.

    A slot holds ``4 * id + sure``: the id that came last, and how often in a row (to 3). Of ids from 2**30 on it holds the lower
    bits, so that these two models never predict them.
    """

    def __init__(self, lanes: int):
        self.slots = np.zeros(2 * lanes * _SLOTS, np.uint32)
        self.base = np.arange(2 * lanes).reshape(2, lanes) * _SLOTS
        self.last, self.hash = np.zeros(lanes, np.uint32), np.zeros((2, lanes), np.uint32)

    def predict(self, n: int) -> np.ndarray:
        """Look up both predictions for the first ``n`` lanes; returns the contexts, 0 to 15."""
        now = self.last[:n] * _HASH
        self.hash[1, :n] += now
        self.hash[0, :n] = now
        self.at = (self.hash[:, :n] >> _HASH_SHIFT) + self.base[:, :n]
        self.hash[1, :n] = now * _HASH
        self.slot = self.slots.take(self.at)
        self.sure = self.slot & _SURE
        return (self.sure[1] << 2) + self.sure[0]

    def learn(self, ids: np.ndarray) -> np.ndarray:
        """Returns whether the predictions of order 1 and order 2 were right (on the lower 30 bits)."""
        new = ids << 2
        right = (self.slot ^ new) <= _SURE
        self.slots[self.at] = np.where(right, self.slot + (self.sure < _SURE), new)
        self.last = ids
        return right


_HASH, _HASH_SHIFT, _SURE = np.uint32(0x9E3779B1), np.uint32(32 - (_SLOTS.bit_length() - 1)), np.uint32(3)


def _lanes(lengths: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block, place in it and length of each lane, the longest first."""
    counts = [-(-n // LANE_IDS) for n in lengths]
    block = np.repeat(np.arange(len(lengths)), counts)
    start = np.concatenate([[0], *(np.arange(c) * LANE_IDS for c in counts)])[1:].astype(np.int64)
    size = np.minimum(LANE_IDS, np.array(lengths, np.int64)[block] - start)
    order = np.argsort(-size, kind="stable")
    return block[order], start[order], size[order]


def _active(size: np.ndarray) -> list[int]:
    """How many lanes are that long, by step."""
    return (len(size) - np.searchsorted(size[::-1], np.arange(int(size[0]) if len(size) else 0), side="right")).tolist()


def _scaled(counts: np.ndarray, bits: int) -> np.ndarray:
    """Frequencies of at least 1 that add up to ``2**bits``, along the last axis."""
    space = (1 << bits) - counts.shape[-1]
    out = 1 + counts * space // np.maximum(1, counts.sum(axis=-1, keepdims=True))
    rest = (1 << bits) - out.sum(axis=-1)
    np.put_along_axis(out, (most := counts.argmax(axis=-1)[..., None]), np.take_along_axis(out, most, -1) + rest[..., None], -1)
    return out


class _Writer:
    def __init__(self, lanes: int):
        self.state = np.full(lanes, _LOWEST, np.int64)
        self.out, self.size = np.zeros((lanes, LANE_IDS), np.uint16), np.zeros(lanes, np.int64)

    def put(self, lane, state: np.ndarray, below: np.ndarray, share: np.ndarray, bits: int) -> np.ndarray:
        """The lanes' states with ``share`` parts of ``2**bits`` after ``below``. ``lane``: their numbers, None for the first ones."""
        if (full := np.flatnonzero(state >= share << (_TOP - bits))).size:
            where, old = full if lane is None else lane[full], state[full]
            size = self.size[where]
            if (need := int(size.max()) + 4) > self.out.shape[1]:
                self.out = np.concatenate([self.out, np.zeros((len(self.out), need // 2), np.uint16)], axis=1)
            self.out[where, size] = old & 0xFFFF
            self.size[where] = size + 1
            state[full] = old >> 16
        # Below 2**48 and divided by less than 2**16, a double is cut to the right integer.
        return state + below + (state / share).astype(np.int64) * ((1 << bits) - share)


def encode_blocks(blocks: Sequence[np.ndarray]) -> list[bytes]:
    """Each block of ids (0 to 2**32 - 1, at most ``BLOCK_IDS`` of them) as bytes."""
    blocks = [np.asarray(b).astype("<u4", copy=False) for b in blocks]
    block, start, size = _lanes([len(b) for b in blocks])
    active = _active(size)
    ids, codes = np.zeros((len(active), len(size)), np.uint32), np.full((len(active), len(size)), _ENDED, np.uint8)
    for k, (i, at, n) in enumerate(zip(block.tolist(), start.tolist(), size.tolist(), strict=True)):
        ids[:n, k] = blocks[i][at : at + n]

    # What the models predict: a code is three times the context and the kind (0: order 2 was right, 1: order 1, 2: neither).
    model, wide = _Model(len(size)), any(len(b) and int(b.max()) >= 1 << 30 for b in blocks)
    for step, n in enumerate(active):
        now = ids[step, :n]
        context = model.predict(n)
        right1, right2 = model.learn(now)
        if wide:
            right1, right2 = right1 & (now < 1 << 30), right2 & (now < 1 << 30)
        codes[step, :n] = context * 3 + _KIND.take(2 * right2.view(np.uint8) + right1)
    del model

    shares, tables, symbols, frequencies = np.zeros((len(blocks), 48), np.int64), [], np.zeros_like(ids), [np.empty(0, np.int64)]
    first_symbol = 0
    for i, whole in enumerate(blocks):
        mine = np.flatnonzero(block == i)
        of_block, kinds = ids[:, mine], codes[:, mine]
        shares[i] = _scaled(np.bincount(kinds.ravel(), minlength=256)[:48].reshape(16, 3), _MIX).ravel()
        missed = of_block[_IS_MISS[kinds]]
        dense = not len(whole) or int(whole.max()) < _DENSE
        if dense:
            counts = np.bincount(missed)
            values = np.flatnonzero(counts)
            counts = counts[values]
        else:
            values, counts = np.unique(missed, return_counts=True)
        if len(values) > _SYMBOLS:
            kept = np.sort(np.argsort(-counts, kind="stable")[:_SYMBOLS])
            counts = np.concatenate([[counts.sum() - counts[kept].sum()], counts[kept]])
            values = values[kept]
        else:
            counts = np.concatenate([[0], counts])
        if len(whole) and len(values):
            if dense:
                number = np.zeros(int(whole.max()) + 1, np.uint32)
                number[values] = np.arange(1, len(values) + 1)
                found = number.take(of_block)
            else:
                found = np.minimum(np.searchsorted(values, of_block), len(values) - 1)
                found = np.where(values[found] == of_block, found + 1, 0)
            symbols[:, mine] = found + first_symbol
        scaled = _scaled(counts, _FREQUENCY)
        frequencies.append(scaled)
        first_symbol += len(scaled)
        tables.append(_pack_tables(shares[i], values, scaled))

    # The writer works from the last id to the first, so that the reader meets them in order.
    writer = _Writer(len(size))
    share = shares.ravel()
    below = (np.cumsum(shares.reshape(-1, 3), axis=1) - shares.reshape(-1, 3)).ravel()
    frequency = np.concatenate(frequencies)
    before = np.concatenate([np.cumsum(f) - f for f in frequencies])
    escape = np.cumsum([0] + [len(f) for f in frequencies[1:]])[:-1]
    escaping = np.array([f[0] > 1 for f in frequencies[1:]], bool)[block] if len(blocks) else np.empty(0, bool)
    any_escape, own = bool(escaping.any()), block * 48
    for step in range(len(active) - 1, -1, -1):
        n = active[step]
        code = codes[step, :n]
        state = writer.state[:n]
        lane = np.flatnonzero(_IS_MISS.take(code))
        if len(lane):
            symbol, missed = symbols[step].take(lane), state.take(lane)
            if any_escape:
                far = np.flatnonzero(symbol == escape[block[lane]])
                if len(far):
                    raw = ids[step, lane[far]].astype(np.int64)
                    one = np.ones(len(far), np.int64)
                    missed[far] = writer.put(lane[far], missed[far], raw & 0xFFFF, one, 16)
                    missed[far] = writer.put(lane[far], missed[far], raw >> 16, one, 16)
            state[lane] = writer.put(lane, missed, before.take(symbol), frequency.take(symbol), _FREQUENCY)
        at = own[:n] + code
        writer.state[:n] = writer.put(None, state, below.take(at), share.take(at), _MIX)

    lanes: list[list[int]] = [[] for _ in blocks]
    for k in np.argsort(start, kind="stable").tolist():
        lanes[block[k]].append(k)
    out = []
    for i, whole in enumerate(blocks):
        mine = lanes[i]
        words = [writer.out[k, : writer.size[k]][::-1] for k in mine]
        states = writer.state[mine].astype("<u8").tobytes() + writer.size[mine].astype("<u4").tobytes()
        body = tables[i] + states + b"".join(w.astype("<u2").tobytes() for w in words)
        out.append(struct.pack(_HEADER, MAGIC, len(whole), zlib.crc32(whole.tobytes()), zlib.crc32(body), len(tables[i])) + body)
    return out


def _pack_tables(shares: np.ndarray, values: np.ndarray, frequencies: np.ndarray) -> bytes:
    """The shares, the gaps between the ids, and the frequencies, the first of which is the escape's; equal bytes of numbers lie together."""
    gaps = np.diff(values.astype(np.int64), prepend=0).astype("<u4")
    parts = (shares.astype("<u2"), gaps, (frequencies - 1).astype("<u2"))
    return zlib.compress(b"".join(p.view(np.uint8).reshape(-1, p.itemsize).T.tobytes() for p in parts), 1)


def _unpack_tables(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(packed), np.uint8)
    count = (len(raw) - 98) // 6
    cuts = ((0, 96, "<u2"), (96, 96 + 4 * count, "<u4"), (96 + 4 * count, len(raw), "<u2"))
    shares, gaps, frequencies = (np.ascontiguousarray(raw[a:b].reshape(np.dtype(t).itemsize, -1).T).view(t).ravel() for a, b, t in cuts)
    return shares.astype(np.int64), np.cumsum(gaps, dtype=np.int64), frequencies.astype(np.int64) + 1


def decode_blocks(payloads: Sequence[bytes]) -> list[np.ndarray]:
    """The ids of each block. A block that does not match its checksums raises ``ValueError``."""
    out: list[np.ndarray] = []
    for at in range(0, len(payloads), _TABLES):
        out += _decode(payloads[at : at + _TABLES])
    return out


def _decode(payloads: Sequence[bytes]) -> list[np.ndarray]:
    heads = []
    for payload in payloads:
        if len(payload) < _HEADER_SIZE or payload[:4] != MAGIC:
            raise ValueError("not a block of token ids")
        heads.append(struct.unpack_from(_HEADER, payload))
        if zlib.crc32(memoryview(payload)[_HEADER_SIZE:]) != heads[-1][3]:
            raise ValueError("a block of token ids is damaged")
    if not payloads:
        return []
    block, start, size = _lanes([h[1] for h in heads])
    shares, values, frequencies, states, words = [], [], [], np.zeros(len(size), np.int64), []
    at, total = np.zeros(len(size), np.int64), 0  # where a lane's next word is; words so far
    by_block: list[list[int]] = [[] for _ in payloads]
    for k in np.argsort(start, kind="stable").tolist():
        by_block[block[k]].append(k)
    for payload, head, mine in zip(payloads, heads, by_block, strict=True):
        cut = _HEADER_SIZE + head[4]
        table = _unpack_tables(payload[_HEADER_SIZE:cut])
        shares.append(table[0])
        values.append(np.concatenate([[0], table[1]]))
        frequencies.append(table[2])
        states[mine] = np.frombuffer(payload, "<u8", len(mine), cut)
        sizes = np.frombuffer(payload, "<u4", len(mine), cut + 8 * len(mine)).astype(np.int64)
        words.append(np.frombuffer(payload, "<u2", -1, cut + 12 * len(mine)) if sizes.sum() else np.empty(0, "<u2"))
        at[mine] = total + np.cumsum(sizes) - sizes
        total += len(words[-1])
    words = np.concatenate([*words, np.zeros(1, "<u2")])
    share = np.concatenate(shares)
    below = (np.cumsum(share.reshape(-1, 3), axis=1) - share.reshape(-1, 3)).ravel()
    bound1, bound2 = below[1::3].copy(), below[2::3].copy()
    value, frequency = np.concatenate(values).astype(np.uint32), np.concatenate(frequencies)
    before = np.concatenate([np.cumsum(f) - f for f in frequencies])
    places = np.concatenate([np.repeat(np.arange(len(f), dtype=np.uint16), f) for f in frequencies])
    escape = np.cumsum([0] + [len(f) for f in frequencies])[:-1]
    own, own_places, own_symbols = block * 16, block << _FREQUENCY, escape[block]

    def more(lane: np.ndarray | None, state: np.ndarray) -> np.ndarray:
        """The states, with the next word where they are low."""
        if (low := np.flatnonzero(state < _LOWEST)).size:
            where = low if lane is None else lane[low]
            place = at[where]
            state[low] = (state[low] << 16) | words.take(place)
            at[where] = place + 1
        return state

    active = _active(size)
    ids, model = np.zeros((len(active), len(size)), np.uint32), _Model(len(size))
    for step, n in enumerate(active):
        context = model.predict(n) + own[:n]
        state = states[:n]
        spot = state & ((1 << _MIX) - 1)
        is1, is2 = spot >= bound1.take(context), spot >= bound2.take(context)
        code = context * 3 + is1 + is2
        state = more(None, share.take(code) * (state >> _MIX) + spot - below.take(code))
        now = np.where(is1, *model.slot) >> 2
        lane = np.flatnonzero(is2)
        if len(lane):
            missed = state.take(lane)
            spot = missed & ((1 << _FREQUENCY) - 1)
            symbol = places.take(own_places.take(lane) + spot) + own_symbols.take(lane)
            missed = more(lane, frequency.take(symbol) * (missed >> _FREQUENCY) + spot - before.take(symbol))
            found = value.take(symbol)
            far = np.flatnonzero(symbol == own_symbols.take(lane))
            if len(far):
                high = missed[far] & 0xFFFF
                missed[far] = more(lane[far], missed[far] >> 16)
                found[far] = (high << 16) | (missed[far] & 0xFFFF)
                missed[far] = more(lane[far], missed[far] >> 16)
            now[lane], state[lane] = found, missed
        states[:n] = state
        model.learn(now)
        ids[step, :n] = now
    out = []
    for head, mine in zip(heads, by_block, strict=True):
        found = np.ascontiguousarray(ids[:, mine].T).ravel()[: head[1]].astype("<u4", copy=False)
        if zlib.crc32(found.tobytes()) != head[2]:
            raise ValueError("a block of token ids is damaged")
        out.append(found)
    return out

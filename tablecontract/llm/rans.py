"""Static range asymmetric numeral system over token ids, in numpy.

A segment holds up to ``SEGMENT`` ids. One table of frequencies is shared by its blocks.
Each block has ``LANES`` interleaved coders of its own, its own stream of 32-bit words and its own
checksums, so blocks decode in any order or side by side; within a block, checkpoints keep
the coders' states every ``EVERY`` steps, so that decoding may also begin there.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Ids of a segment, about 1.5 MB of its bytes and 30 MB while it is coded.
SEGMENT = 1 << 20
LANES, BLOCKS, EVERY = 64, 16, 256
#: A coder's state stays within [LOW, LOW << 32).
LOW = np.uint64(1 << 31)

_MAGIC = b"RANS"
# Magic, version, bits of the table's sum, lanes, blocks, steps, steps between checkpoints, ids, symbols, bytes of the packed table.
_HEAD = "<4sBBHHIIIII"
_HEAD_BYTES = struct.calcsize(_HEAD)
# Words, checksum of the block's words and states, checksum of its ids.
_BLOCK = np.dtype([("words", "<u4"), ("bytes_crc", "<u4"), ("ids_crc", "<u4")])


class CorruptSegment(ValueError):
    """A segment whose bytes are not those that were written."""


def shared_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct ids, their frequencies, at least 1 each, and the bits of the frequencies' sum."""
    symbols, counts = np.unique(ids, return_counts=True)
    bits = max(14, int(len(symbols)).bit_length() + 2)
    total = 1 << bits
    freq = 1 + counts.astype(np.int64) * (total - len(symbols)) // max(1, len(ids))
    freq[np.argmax(freq)] += total - int(freq.sum())
    return symbols.astype(np.uint32), freq.astype(np.uint32), bits


def encode(ids: np.ndarray) -> bytes:
    """A segment of at least one id."""
    n = len(ids)
    symbols, freq, bits = shared_table(ids)
    blocks = min(BLOCKS, -(-n // (LANES * 16)))
    steps = -(-n // (blocks * LANES))
    place = np.searchsorted(symbols, ids)
    padded = np.full(blocks * steps * LANES, int(np.argmax(freq)), np.int64)
    # A block is a run of ids; its lanes take them in turn. What fills up the last block is not counted.
    padded[:n] = place
    grid = padded.reshape(blocks, steps, LANES).transpose(1, 0, 2)
    wide = freq.astype(np.uint64)
    below = np.concatenate(([0], np.cumsum(wide)[:-1])).astype(np.uint64)
    low = np.empty(grid.shape, "<u4")
    out = np.empty(grid.shape, bool)
    marks = -(-steps // EVERY)
    states = np.empty((marks, blocks, LANES), "<u8")
    x = np.full((blocks, LANES), LOW, np.uint64)
    shift, limit = np.uint64(bits), np.uint64(63 - bits)
    for t in range(steps - 1, -1, -1):
        f, c = wide[grid[t]], below[grid[t]]
        full = x >= (f << limit)
        low[t], out[t] = x, full  # the low half of the state
        x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        x = (q << shift) + (x - q * f) + c
        if t % EVERY == 0:
            states[t // EVERY] = x
    packed = zlib.compress(np.diff(symbols, prepend=np.uint32(0)).astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 6)
    table, bodies = np.zeros(blocks, _BLOCK), []
    for b in range(blocks):
        words = low[:, b][out[:, b]].tobytes()
        # Words that a decoder has read before each checkpoint.
        per_step = np.concatenate(([0], np.cumsum(out[:, b].sum(axis=1))))[: steps : EVERY].astype("<u4").tobytes()
        body = states[:, b].tobytes() + per_step + words
        table[b] = (len(words) // 4, zlib.crc32(body), zlib.crc32(_span(ids, b, steps).astype("<u4").tobytes()))
        bodies.append(body)
    head = struct.pack(_HEAD, _MAGIC, 1, bits, LANES, blocks, steps, EVERY, n, len(symbols), len(packed)) + table.tobytes() + packed
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(bodies)


def _span(ids: np.ndarray, block: int, steps: int) -> np.ndarray:
    return ids[block * steps * LANES : (block + 1) * steps * LANES]


class Segment:
    """A segment's table and the places of its blocks; ids are decoded when asked for."""

    def __init__(self, data: bytes):
        if len(data) < _HEAD_BYTES:
            raise CorruptSegment("a segment ends within its head")
        magic, version, bits, lanes, blocks, self.steps, self.every, self.n, symbols, packed = struct.unpack_from(_HEAD, data)
        if magic != _MAGIC or version != 1 or lanes != LANES:
            raise CorruptSegment("this is no segment of token ids")
        end = _HEAD_BYTES + blocks * _BLOCK.itemsize + packed
        if len(data) < end + 4 or struct.unpack_from("<I", data, end)[0] != zlib.crc32(data[:end]):
            raise CorruptSegment("the head of a segment fails its checksum")
        self.blocks = np.frombuffer(data, _BLOCK, blocks, _HEAD_BYTES)
        raw = np.frombuffer(zlib.decompress(data[end - packed : end]), "<u4")
        self._symbols, freq = np.cumsum(raw[:symbols], dtype=np.uint32), raw[symbols:].astype(np.uint64)
        self._bits, self._freq = bits, freq
        self._below = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
        self._at = np.repeat(np.arange(symbols, dtype=np.uint32), freq.astype(np.int64))
        marks = -(-self.steps // self.every)
        fixed = marks * (LANES * 8 + 4)
        self._starts = end + 4 + np.concatenate(([0], np.cumsum(fixed + 4 * self.blocks["words"].astype(np.int64))))
        self._data, self._marks = data, marks
        if len(data) != self._starts[-1]:
            raise CorruptSegment("a segment is cut off")

    def _body(self, block: int) -> bytes:
        body = self._data[self._starts[block] : self._starts[block + 1]]
        if zlib.crc32(body) != self.blocks["bytes_crc"][block]:
            raise CorruptSegment(f"block {block} of a segment fails its checksum")
        return body

    def decode(self, blocks: list[int] | None = None, mark: int = 0, marks: int | None = None) -> np.ndarray:
        """Ids of the given blocks, or of all, a row a block, from checkpoint ``mark`` for ``marks`` checkpoints, or to the end."""
        chosen = list(range(len(self.blocks))) if blocks is None else blocks
        bodies = [self._body(b) for b in chosen]
        states = np.stack([np.frombuffer(x, "<u8", LANES, mark * LANES * 8) for x in bodies]).astype(np.uint64)
        fixed = self._marks * LANES * 8
        read = np.array([np.frombuffer(x, "<u4", 1, fixed + 4 * mark)[0] for x in bodies], np.int64)
        words = [np.frombuffer(x, "<u4", offset=fixed + 4 * self._marks) for x in bodies]
        stream = np.concatenate([*words, np.zeros(LANES, "<u4")]).astype(np.uint64)
        at = np.concatenate(([0], np.cumsum([len(w) for w in words])))[:-1] + read
        begin = mark * self.every
        stop = self.steps if marks is None else min(self.steps, begin + marks * self.every)
        out = np.empty((stop - begin, len(chosen), LANES), np.uint32)
        x, shift, mask = states, np.uint64(self._bits), np.uint64((1 << self._bits) - 1)
        for t in range(stop - begin):
            slot = x & mask
            s = self._at[slot]
            out[t] = s
            x = self._freq[s] * (x >> shift) + slot - self._below[s]
            low = x < LOW
            taken = np.cumsum(low, axis=1)
            # Lanes read the block's stream in their order.
            word = stream[at[:, None] + taken - low]
            x = np.where(low, (x << np.uint64(32)) | word, x)
            at = at + taken[:, -1]
        return self._symbols[out].transpose(1, 0, 2).reshape(len(chosen), -1)

    def ids(self) -> np.ndarray:
        """All ids, each block held against its checksum."""
        rows, found = self.decode(), []
        for b, row in enumerate(rows):
            row = row[: self.n - b * self.steps * LANES]
            if zlib.crc32(row.astype("<u4").tobytes()) != self.blocks["ids_crc"][b]:
                raise CorruptSegment(f"the ids of block {b} of a segment fail their checksum")
            found.append(row)
        return np.concatenate(found)

    def some(self, start: int, count: int) -> np.ndarray:
        """Ids from ``start`` on, decoded from the checkpoints around them alone."""
        stop, found = min(self.n, start + max(0, count)), []
        per_block, per_mark = self.steps * LANES, self.every * LANES
        while start < stop:
            b, inside = divmod(start, per_block)
            end = min(stop, (b + 1) * per_block)
            mark, skip = divmod(inside, per_mark)
            marks = -(-(end - b * per_block - mark * per_mark) // per_mark)
            found.append(self.decode([b], mark, marks)[0][skip : skip + end - start])
            start = end
        return np.concatenate(found) if found else np.zeros(0, np.uint32)


def crc_joined(first: int, second: int, length: int) -> int:
    """The CRC-32 of two byte strings one after the other, from the CRC-32 of each and the second one's length.

    Appending a byte multiplies a checksum by x**8 modulo the polynomial; squaring that
    power of x as often as the length has bits appends any number of them.
    """
    power, times = 1 << 31 >> 8, length  # x**8, highest coefficient last
    while times:
        if times & 1:
            first = _product(first, power)
        power, times = _product(power, power), times >> 1
    return first ^ second


def _product(a: int, b: int) -> int:
    """Of two polynomials over bits, modulo the one of CRC-32, with the constant term in the highest bit."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
    return out

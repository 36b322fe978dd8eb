"""CRC-32C of many byte strings at once, with array operations.

A checksum is linear: that of a string is the exclusive or of what each byte adds, which
depends on the byte and on how far from the end it stands. Strings are filled up with
zeros in front, which add nothing, cut into blocks, each block is looked up byte by byte
and summed, and neighbouring blocks are combined in rounds, the left one moved by the
right one's length.
"""

from __future__ import annotations

import numpy as np

_POLYNOMIAL = 0x82F63B78  # fixed value: Castagnoli, reflected
_BLOCK = 128
#: Added to the rotated checksum; a fixed value of the record format.
_MASK_DELTA = 0xA282EAD8


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), table >> np.uint32(1))
    return table.astype(np.uint32)


def _position_tables() -> np.ndarray:
    """What a byte adds, by its place in a block."""
    tables = np.zeros((_BLOCK, 256), np.uint32)
    tables[-1] = _byte_table()
    for place in range(_BLOCK - 2, -1, -1):
        later = tables[place + 1]
        tables[place] = (later >> np.uint32(8)) ^ tables[-1][later & np.uint32(255)]
    return tables


_TABLES = _position_tables()


def _moved(values: np.ndarray, tables: np.ndarray) -> np.ndarray:
    out = tables[0][values & np.uint32(255)]
    for k in range(1, 4):
        out = out ^ tables[k][(values >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _block_move() -> np.ndarray:
    """Tables that move a checksum by one block of zeros, one per byte of it."""
    tables = []
    for k in range(4):
        values = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(_BLOCK):
            values = (values >> np.uint32(8)) ^ _TABLES[-1][values & np.uint32(255)]
        tables.append(values)
    return np.stack(tables)


_MOVE = _block_move()


def checksums(strings: list[bytes]) -> np.ndarray:
    """CRC-32C of each string; strings have 4 bytes at least."""
    if not strings:
        return np.zeros(0, np.uint32)
    lengths = np.array([len(s) for s in strings], np.int64)
    counts = -(-lengths // _BLOCK)
    ends = np.cumsum(counts) * _BLOCK
    filled = np.frombuffer(
        bytearray().join([s.rjust(n, b"\0") for s, n in zip(strings, (counts * _BLOCK).tolist(), strict=True)]), np.uint8
    )
    filled[((ends - lengths)[:, None] + np.arange(4)).ravel()] ^= 0xFF  # the checksum's start value
    rows = filled.reshape(-1, _BLOCK)
    sums = np.zeros(len(rows), np.uint32)
    for at in range(0, len(rows), 8192):
        places = np.ascontiguousarray(rows[at : at + 8192].T)
        part = sums[at : at + 8192]
        for table, place in zip(_TABLES, places, strict=True):
            part ^= table[place]
    move = _MOVE
    while counts.max() > 1:
        even = counts + (counts & 1)
        bounds = np.cumsum(even)
        padded = np.zeros(int(bounds[-1]), np.uint32)
        shift = np.repeat((bounds - counts) - (np.cumsum(counts) - counts), counts)
        padded[np.arange(len(sums)) + shift] = sums
        sums = _moved(padded[::2], move) ^ padded[1::2]
        counts = even // 2
        move = np.stack([_moved(table, move) for table in move])
    return sums ^ np.uint32(0xFFFFFFFF)


def masked(sums: np.ndarray) -> np.ndarray:
    """Rotated and shifted, so that checksums of data that hold checksums stay sound."""
    return ((sums >> np.uint32(15)) | (sums << np.uint32(17))) + np.uint32(_MASK_DELTA)

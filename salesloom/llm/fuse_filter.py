"""Static binary-fuse filters (Graf and Lemire, 2022) over 64-bit keys, built and asked with numpy."""

from __future__ import annotations

import math
import struct

import numpy as np

_HEAD = struct.Struct("<QII")  # seed, segment length, segment count


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _slots(h: np.ndarray, length: int, count: int) -> np.ndarray:
    """Three slots of each key, in three neighbouring segments."""
    first = ((h >> np.uint64(32)) * np.uint64(length * count)) >> np.uint64(32)
    mask = np.uint64(length - 1)
    second = (first + np.uint64(length)) ^ ((h >> np.uint64(14)) & mask)
    third = (first + np.uint64(2 * length)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(29))).astype(np.uint8)


def build(keys: np.ndarray) -> bytes:
    """Filter that contains every key; others pass with probability 1/256. Keys may repeat; none gives b''."""
    keys = np.unique(np.asarray(keys, dtype=np.uint64))
    n = len(keys)
    if not n:
        return b""
    length = min(1 << 18, 1 << max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    count = max(1, math.ceil(n * factor / length) - 2)
    seed = 0x9E3779B97F4A7C15
    for attempt in range(200):
        h = _mixed(keys, seed)
        slots = _slots(h, length, count)
        order = _peel(slots, (count + 2) * length)
        if order is not None:
            break
        seed = (seed * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        count += attempt % 8 == 7  # tiny sets may need a little more room
    else:
        raise RuntimeError("no peeling order was found")
    table, own = np.zeros((count + 2) * length, np.uint8), _prints(h)
    for peeled, slot in reversed(order):
        three = slots[:, peeled]
        rest = table[three[0]] ^ table[three[1]] ^ table[three[2]]  # the slot itself still holds 0
        table[slot] = own[peeled] ^ rest
    return _HEAD.pack(seed, length, count) + table.tobytes()


def _peel(slots: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the slot that only this key still uses); None if some keys can't be freed."""
    n = slots.shape[1]
    uses = np.bincount(slots.ravel(), minlength=size)
    total = np.zeros(size, np.int64)  # sum of the keys that use a slot: the key itself where one is left
    np.add.at(total, slots.ravel(), np.tile(np.arange(n), 3))
    order, left = [], n
    look = np.flatnonzero(uses == 1)
    while len(look):
        freed, at = np.unique(total[look], return_index=True)
        order.append((freed, look[at]))
        left -= len(freed)
        gone = slots[:, freed].ravel()
        np.subtract.at(uses, gone, 1)
        np.subtract.at(total, gone, np.tile(freed, 3))
        touched = np.unique(gone)
        look = touched[uses[touched] == 1]
    return None if left else order


def contains(filter_bytes: bytes, keys: np.ndarray) -> np.ndarray:
    keys = np.asarray(keys, dtype=np.uint64)
    if not filter_bytes:
        return np.zeros(len(keys), bool)
    seed, length, count = _HEAD.unpack_from(filter_bytes)
    table = np.frombuffer(filter_bytes, np.uint8, offset=_HEAD.size)
    h = _mixed(keys, seed)
    a, b, c = _slots(h, length, count)
    return (table[a] ^ table[b] ^ table[c]) == _prints(h)

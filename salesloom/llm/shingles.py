"""Sets of word shingles as sorted 64-bit hashes, and the parity sketches of these sets."""

from __future__ import annotations

import functools
import math

import numpy as np

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ODD = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    found = []
    for base in (_ODD, pow(_ODD, -1, 1 << 64)):
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        found.append(np.cumprod(factors, dtype=np.uint64))
    return found[0], found[1]


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word ``[^\\x20\\x09-\\x0D]+`` after A-Z became lower case."""
    data = np.frombuffer(text.encode().translate(_LOWER), np.uint8)
    inner = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.flatnonzero(inner[1:] != inner[:-1])
    starts, ends = edges[::2], edges[1::2]
    powers, inverses = _powers(1 << max(16, len(data).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[data] * powers[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Distinct shingles of ``words`` words; with fewer words the whole sequence is one; without words none."""
    hashes = word_hashes(text)
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(words, n)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total = mixed(total * np.uint64(_ODD) + hashes[k : n - width + 1 + k])
    return np.unique(total)


class Bands:
    """Size bands and the number of blocks that sets of a band are cut into.

    Sets that link have at most ``budget(a + b)`` elements in one of them only. A band's sets are cut into one block
    more than that for two sets of its largest size, so two linked sets of a band have a block without a difference.
    Sets that can link with a larger band's are cut by that band's number too.
    """

    def __init__(self, numerator: int, denominator: int, ratio: float = 1.4):
        self._numerator, self._denominator, self._ratio = numerator, denominator, ratio

    def _top(self, band: int) -> int:
        """Largest size of a band."""
        return math.ceil(self._ratio ** (band + 1)) - 1

    def linked(self, common, total):
        """Whether sets of ``total`` elements together link that have ``common`` elements in both."""
        return self._denominator * common >= self._numerator * (total - common)

    def possible(self, a, b):
        """Whether sets of these sizes can link."""
        return self._denominator * np.minimum(a, b) >= self._numerator * np.maximum(a, b)

    def budget(self, total):
        return (self._denominator - self._numerator) * total // (self._denominator + self._numerator)

    @functools.lru_cache(maxsize=4096)  # noqa: B019
    def of(self, size: int) -> list[tuple[int, int]]:
        """(band, blocks) that a set of ``size`` elements is cut for."""
        band = max(0, int(math.log(size) / math.log(self._ratio)) - 2)
        while self._top(band) < size:
            band += 1
        found, most = [], size * self._denominator // self._numerator  # largest size that can link
        while True:
            found.append((band, self.budget(2 * self._top(band)) + 1))
            if self._top(band) >= most:
                return found
            band += 1


#: Ways to cut a small set into blocks, at most.
CUTS = 16


def _block_parities(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each block a hash of its parity sketch, and its number of elements.

    The sketch has 2^64 bits; an element's hash is the number of its bit. The hash of a sketch is the XOR of the numbers
    of its bits, so blocks that agree have, but for chance in 64 bits, equal elements.
    """
    block = (((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    block = block[order]
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    sketch = np.zeros(blocks, np.uint64)
    sketch[block[starts]] = np.bitwise_xor.reduceat(hashes[order], starts)
    return sketch, np.bincount(block, minlength=blocks)


def block_keys(shingles: np.ndarray, band: int, blocks: int) -> np.ndarray:
    """Keys of the blocks: the block's number and its parity sketch, hashed to 64 bits.

    An element flips one bit of one block, so a block without a difference has the same key in both sets. Blocks of few
    elements tell little; with many blocks they are left out: two linked sets that agree in such blocks only have a
    difference in each of the others, which the hash of the elements to the blocks brings about with a probability
    below ``0.63 ** blocks used``, one in a million or less.

    A smaller set keeps all blocks. Empty ones would be the same in unrelated sets, so a set that has some is cut once
    more by another hash instead, and again while a cut leaves one empty. Two linked sets that agree in empty blocks
    only are both cut again, so they meet in a later cut; the last one keeps its empty blocks.
    """
    number = np.arange(blocks, dtype=np.uint64) * np.uint64(_ODD)
    sketch, counts = _block_parities(shingles, blocks)

    def keys(held: np.ndarray, cut: int) -> np.ndarray:
        salt = np.uint64((band * 0xD6E8FEB86659FD93 + cut * 0xC2B2AE3D27D4EB4F) % (1 << 64))
        return mixed(mixed(sketch[held]) + number[held] + salt)

    for least in (3, 2, 1):
        held = counts >= least
        if held.sum() >= 30:
            return keys(held, 0)
    found = [keys(counts > 0, 0)]
    for cut in range(1, CUTS):
        if counts.all():
            break
        sketch, counts = _block_parities(mixed(shingles + np.uint64(cut * _ODD % (1 << 64))), blocks)
        found.append(keys((counts > 0) | (cut == CUTS - 1), cut))
    return np.concatenate(found)


def parity_words(size):
    """64-bit words of the parity sketch of a set of ``size`` elements: a power of two, 1.5 bits an element or more."""
    return 1 << np.maximum(2, np.ceil(np.log2(np.maximum(size, 1) * 1.5 / 64))).astype(np.int64)


def parity(shingles: np.ndarray) -> np.ndarray:
    """Parity bits of a whole set. The halves of a sketch, XORed, are the sketch of half as many words."""
    words = int(parity_words(len(shingles)))
    at = (shingles & np.uint64(words - 1)) * np.uint64(64) + ((shingles >> np.uint64(40)) & np.uint64(63))
    bits = np.bincount(at.astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<u8")


class Parities:
    """Sketches of many sets, one after the other in ``words``."""

    def __init__(self, sizes: np.ndarray, starts: np.ndarray, words: np.ndarray):
        self._length, self._start, self._words = parity_words(sizes), starts, words

    def _of(self, x: np.ndarray, length: int, folded: bool) -> np.ndarray:
        found = self._words[self._start[x][:, None] + np.arange(length)]
        return found[:, : length // 2] ^ found[:, length // 2 :] if folded else found

    def distances(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Hamming distances of x[i] and y[i] (or of one x and all y), at most the symmetric differences.

        Sketches of different length are compared in the shorter one; beyond a factor of two the distance is 0.
        """
        x = np.broadcast_to(x, y.shape)
        found = np.zeros(len(y), np.int64)
        a, b = self._length[x], self._length[y]
        for one, other in np.unique(np.stack([a, b], axis=1), axis=0).tolist():
            if max(one, other) <= 2 * min(one, other):
                at = np.flatnonzero((a == one) & (b == other))
                bits = self._of(x[at], one, one > other) ^ self._of(y[at], other, other > one)
                found[at] = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        return found

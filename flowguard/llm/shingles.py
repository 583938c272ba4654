"""Numpy kernels on batches of texts: hashes of words and word shingles, MinHash values."""

from __future__ import annotations

import numpy as np

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)  # a random value for each byte
_P = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2 ** 64
_PINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE = np.array([pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(64)], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


_SLICE = 1 << 19  # bytes hashed at a time
_KEPT: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """Powers 0 to n - 1 modulo 2 ** 64; those of a usual slice are kept."""
    if n <= _SLICE and int(base) in _KEPT:
        return _KEPT[int(base)][:n]
    out = np.full(max(n, _SLICE), base, np.uint64)
    out[0] = 1
    out = np.multiply.accumulate(out)
    if len(out) == _SLICE:
        _KEPT[int(base)] = out
    return out[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Words:
    """Words of a batch of UTF-8 texts: hash, first and last byte, and where each text's words begin.

    A word's hash is a polynomial in random byte values, read off one running sum over the batch.
    """

    def __init__(self, texts: list[bytes]):
        self.raw = b" ".join([*texts, b""])
        a = np.frombuffer(self.raw, np.uint8)
        space = _SPACE[a]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]  # of each word
        at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        self.first = np.searchsorted(self.start, at)  # per text and one more: index of its first word
        self.hash = np.zeros(len(self.start), np.uint64)
        i = 0
        while i < len(self.start):  # a slice of words at a time: the sums take eight bytes for each of the text
            lo = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, lo + _SLICE, "right")))
            here, size = slice(i, j), int(self.end[j - 1] - lo)
            run = np.zeros(size + 1, np.uint64)
            np.cumsum(_BYTE[a[lo:lo + size]] * _powers(_P, size), out=run[1:])
            begin, end = self.start[here] - lo, self.end[here] - lo
            self.hash[here] = mixed((run[end] - run[begin]) * _powers(_PINV, size)[begin] + (end - begin).astype(np.uint64))
            i = j

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of n words, and where each text's begin (one more place than texts).

        A text of fewer words, but one at least, has one shingle of all its words.
        """
        count = np.diff(self.first)
        have = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
        begin = np.concatenate([[0], np.cumsum(have)])
        total = int(begin[-1])
        if not total:
            return np.zeros(0, np.uint64), begin
        text = np.repeat(np.arange(len(have)), have)
        word = self.first[:-1][text] + (np.arange(total) - begin[:-1][text])
        h, last = np.zeros(total, np.uint64), len(self.hash) - 1
        short = count[text] < n
        for k in range(n):
            part = self.hash[np.minimum(word + k, last)] * _PLACE[k]
            h += np.where(short & (k >= count[text]), np.uint64(0), part)
        return mixed(h + np.minimum(count[text], n).astype(np.uint64)), begin


def minhash(hashes: np.ndarray, begin: np.ndarray, perms: int, seed: int = 11) -> np.ndarray:
    """MinHash values, texts x perms (uint32); a text without shingles has the largest value everywhere."""
    r = np.random.Generator(np.random.PCG64(seed))
    mul = r.integers(0, 1 << 32, perms, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    add = r.integers(0, 1 << 32, perms, dtype=np.uint64).astype(np.uint32)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    texts = np.flatnonzero(np.diff(begin))
    out = np.full((len(begin) - 1, perms), 0xFFFFFFFF, np.uint32)
    cut, i = begin[:-1][texts], 0
    while i < len(texts):  # runs of texts whose shingles stay in the processor's cache
        j = max(i + 1, int(np.searchsorted(cut, cut[i] + 16384)))
        part = x[cut[i]:cut[j] if j < len(cut) else len(x)]
        here, buf = cut[i:j] - cut[i], np.empty_like(part)
        got = np.empty((perms, j - i), np.uint32)
        for k in range(perms):
            np.bitwise_xor(part, add[k], out=buf)
            np.multiply(buf, mul[k], out=buf)
            np.minimum.reduceat(buf, here, out=got[k])
        out[texts[i:j]] = got.T
        i = j
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` MinHash values, texts x bands; the band's number is part of it."""
    n, perms = signature.shape
    s = signature.reshape(n, perms // rows, rows).astype(np.uint64)
    h = np.arange(perms // rows, dtype=np.uint64)[None, :] * _P
    for k in range(rows):
        h = mixed(h + s[:, :, k] * _PLACE[k])
    return h.view(np.int64)


def star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of links (a, b): every node but the smallest of its component, and that smallest."""
    ids, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v, root = both[:len(a)], both[len(a):], np.arange(len(ids))
    while True:
        x, y = root[u], root[v]
        if not (open_ := x != y).any():
            break
        u, v, x, y = u[open_], v[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != root[root]).any():
            root = root[root]
    rest = root != np.arange(len(ids))
    return ids[rest], ids[root[rest]]

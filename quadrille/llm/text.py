"""Word hashes of whole texts, computed on byte arrays inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes hashed at a time; a longer text is cut at white space, so memory stays bounded.
SLICE = 1 << 18
ODD = np.uint64(0x9E3779B97F4A7C15)

_blank = np.zeros(256, bool)
_blank[[0x20, *range(0x09, 0x0E)]] = True
_fold = np.arange(256, dtype=np.uint8)
_fold[65:91] += 32
def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Two primes under 2^31 and a seeded base for each: a word's number modulo each is its hash. Fixed values.
FIELDS = ((2147483647, 1168430377), (2147483629, 803981251))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, prime: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0 to base^(n-1) modulo ``prime``, and their inverses; kept between calls."""
    have = _powers.get(prime)
    if have is None or len(have[0]) < n:
        have = tuple(_table(max(n, SLICE + 2), prime, b) for b in (base, pow(base, -1, prime)))
        _powers[prime] = have
    return have[0][:n], have[1][:n]


def _table(n: int, prime: int, base: int) -> np.ndarray:
    out, size, step = np.ones(n, np.uint64), 1, base
    while size < n:
        more = min(size, n - size)
        out[size : size + more] = out[:more] * np.uint64(step) % np.uint64(prime)
        size, step = size + more, step * step % prime
    return out


def summed(part: np.ndarray, prime: int, base: int) -> np.ndarray:
    """Running sums of (byte + 1) * base^place, right modulo ``prime``: every 2^24 of them, which add up to less than 2^63, they are reduced."""
    out, up = np.zeros(len(part) + 1, np.uint64), powers(len(part), prime, base)[0]
    for a in range(0, len(part), 1 << 24):
        some = (part[a : a + (1 << 24)].astype(np.uint64) + np.uint64(1)) * up[a : a + (1 << 24)]
        out[a + 1 : a + 1 + len(some)] = out[a] % np.uint64(prime) + np.cumsum(some)
    return out


def stretch_hash(sums: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit names of the stretches [start, end) by ``sums`` over all FIELDS: equal for equal bytes, else as random."""
    out = (end - start).astype(np.uint64) * ODD
    for total, (prime, base) in zip(sums, FIELDS, strict=True):
        p = np.uint64(prime)
        out = mix(out + (total[end] % p + p - total[start] % p) % p * powers(len(total), prime, base)[1][start] % p)
    return out


def hashed_words(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the words `[^\\x20\\x09-\\x0D]+` of a byte array, A-Z folded to lower case."""
    starts, hashes, at = [], [], 0
    while at < len(buffer):
        end = min(len(buffer), at + SLICE)
        if end < len(buffer) and not _blank[buffer[end]]:
            cut = np.flatnonzero(_blank[buffer[at:end]])
            if len(cut):
                end = at + int(cut[-1]) + 1
            else:  # one word longer than a slice: up to its end
                far = end
                while far < len(buffer) and not _blank[buffer[far : far + SLICE]].any():
                    far += SLICE
                end = min(len(buffer), far + SLICE)
        part = buffer[at:end]
        word = np.concatenate([[False], ~_blank[part], [False]])
        edges = np.flatnonzero(word[1:] != word[:-1])
        s, e = edges[::2], edges[1::2]
        folded = _fold[part]
        starts.append(s + at)
        hashes.append(stretch_hash([summed(folded, *field) for field in FIELDS], s, e))
        at = end
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def batches(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bounds, hashes): the words of texts first..last-1; those of the i-th are hashes[bounds[i]:bounds[i+1]]."""
    first = 0
    while first < len(texts):
        raw, size, last = [], 0, first
        while last < len(texts) and (last == first or size < SLICE):
            raw.append((texts[last] or "").encode("utf-8", "surrogatepass"))
            size += len(raw[-1]) + 1
            last += 1
        buffer = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        ends = np.cumsum([len(r) + 1 for r in raw])
        starts, hashes = hashed_words(buffer)
        yield first, last, np.concatenate([[0], np.searchsorted(starts, ends)]), hashes
        first = last


def shingled(bounds: np.ndarray, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every shingle of ``size`` words; a shorter text with words is one shingle of them all."""
    counts = np.diff(bounds)
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(counts)), n)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[:-1], n)
    ends = np.minimum(at + size, bounds[1:][doc])
    out = np.zeros(len(doc), np.uint64)
    for k in range(size):
        here = at + k < ends
        out[here] = mix(out[here] * ODD + hashes[at[here] + k] + np.uint64(k))
    return doc, out


def distinct(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, value) pairs in that order, and how often each is found; ``doc`` ascends."""
    order = np.argsort(value)
    small = doc.astype(np.uint16) if len(doc) and doc[-1] < 1 << 16 else doc
    order = order[np.argsort(small[order], kind="stable")]
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return doc[at], value[at], np.diff(np.append(at, len(doc)))

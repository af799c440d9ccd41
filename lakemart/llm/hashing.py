"""Vectorised splitting and hashing of texts, for use inside Arrow tasks.

A batch of texts is cut at separator bytes with numpy and every piece gets a 64-bit hash of its bytes. Work arrays
are bounded by ``CHUNK`` bytes whatever the batch or the longest text holds (a single piece longer than that counts
as a whole).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

CHUNK = 1 << 18
SPACES = b" \t\n\x0b\x0c\r"
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_BYTE_CODES = np.random.Generator(np.random.PCG64(0x5EED)).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n + 1, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        out[1:] = np.cumprod(np.full(n, base, np.uint64), dtype=np.uint64)
    return out


_POW = _powers(int(_BASE), CHUNK + 1)
_INV = _powers(pow(int(_BASE), -1, 1 << 64), CHUNK + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def lut(separators: bytes = SPACES) -> np.ndarray:
    """Table that marks separator bytes."""
    table = np.zeros(256, bool)
    table[list(separators)] = True
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)
IS_SPACE = lut()


def _long_hash(piece: np.ndarray) -> np.uint64:
    """Hash of one piece of any length, part by part."""
    total, done = 0, 0
    for at in range(0, len(piece), CHUNK):
        part = _BYTE_CODES[piece[at : at + CHUNK]] * _POW[: min(CHUNK, len(piece) - at)]
        total = (total + int(part.sum(dtype=np.uint64)) * pow(int(_BASE), done, 1 << 64)) & (2**64 - 1)
        done += len(part)
    return _U(total)


def piece_bounds(buffer: np.ndarray, is_separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes that are no separators."""
    edge = np.empty(len(buffer) + 2, bool)
    edge[0] = edge[-1] = False
    np.logical_not(is_separator[buffer], out=edge[1:-1])
    change = np.flatnonzero(edge[1:] != edge[:-1])
    return change[::2], change[1::2]


def bounds_hash(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes in each [start, end) of a buffer of at most CHUNK bytes."""
    prefix = np.empty(len(buffer) + 1, np.uint64)
    prefix[0] = 0
    np.cumsum(_BYTE_CODES[buffer] * _POW[: len(buffer)], dtype=np.uint64, out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * _INV[starts] + (ends - starts).astype(np.uint64))


def buffers(texts: Sequence[bytes], is_separator: np.ndarray, glue: bytes) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """Buffers of whole pieces, with (text number, end of its part) for each; a text may take several buffers."""
    parts, ends, size = [], [], 0
    for number, text in enumerate(texts):
        at = 0
        while True:
            if len(text) - at <= CHUNK // 2:
                part, at = text[at:], len(text)
            else:
                window = np.frombuffer(text, np.uint8, CHUNK // 2, at)
                cut = np.flatnonzero(is_separator[window])
                if len(cut):
                    end = at + int(cut[-1]) + 1
                else:  # one very long piece: up to its end
                    end, step = at + CHUNK // 2, CHUNK // 2
                    while end < len(text):
                        found = np.flatnonzero(is_separator[np.frombuffer(text, np.uint8, min(step, len(text) - end), end)])
                        if len(found):
                            end += int(found[0]) + 1
                            break
                        end += min(step, len(text) - end)
                part, at = text[at:end], end
            if size and size + len(part) + 1 > CHUNK:
                yield glue.join(parts), ends
                parts, ends, size = [], [], 0
            parts.append(part)
            size += len(part) + 1
            ends.append((number, size))
            if at >= len(text):
                break
    if parts:
        yield glue.join(parts), ends


def piece_hashes(
    texts: Sequence[bytes], is_separator: np.ndarray = IS_SPACE, fold: np.ndarray = LOWER, most: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all pieces of all texts in order, and the number of pieces of each text.

    ``fold`` maps bytes before hashing (A-Z to a-z by default). Equal pieces have equal hashes in every task. With
    ``most``, only so many first bytes of a piece count.
    """
    glue = bytes([int(np.flatnonzero(is_separator)[0])])
    counts = np.zeros(len(texts), np.int64)
    out = []
    for data, ends in buffers(texts, is_separator, glue):
        buffer = fold[np.frombuffer(data, np.uint8)]
        starts, stops = piece_bounds(buffer, is_separator)
        if most is not None:
            stops = np.minimum(stops, starts + most)
        if len(buffer) <= CHUNK:
            out.append(bounds_hash(buffer, starts, stops))
        else:
            raw = np.array([_long_hash(buffer[a:b]) for a, b in zip(starts, stops, strict=True)], np.uint64)
            out.append(mix(raw + (stops - starts).astype(np.uint64)))
        place = np.searchsorted(starts, [end for _, end in ends])
        np.add.at(counts, [number for number, _ in ends], np.diff(place, prepend=0))
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), counts


def utf8(values) -> list[bytes]:
    """Texts as UTF-8, null as empty."""
    return [b"" if v is None else v.encode("utf-8", "surrogatepass") for v in values]

"""64-bit hashes of the words of whole texts, with numpy, in pieces of bounded memory. Used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text hashed at a time; a longer word makes a longer piece.
PIECE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    held = _powers.get(str(base))
    if held is None or len(held) < n:
        held = np.full(max(n, PIECE + 4096), base, dtype=np.uint64)
        held[0] = 1
        held = np.cumprod(held, dtype=np.uint64)
        _powers[str(base)] = held
    return held[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_piece(raw: np.ndarray, is_word: np.ndarray) -> np.ndarray:
    low = LOWER[raw]
    inside = is_word[low]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _power(BASE, len(low)), out=sums[1:], dtype=np.uint64)
    words = (sums[ends] - sums[starts]) * _power(INVERSE, len(low) + 1)[starts]
    return mix(words + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(texts: list[bytes | None], is_word: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes of the words of some texts one after another, number of words of each), in order. ``is_word``: for each byte,
    after A-Z were lower-cased, whether it belongs to a word; it must hold of no byte that can stand inside another
    character. Null has no words."""
    ends_word = ~is_word
    at = 0
    while at < len(texts):
        group, size = [], 0
        while at < len(texts) and (not group or size + len(texts[at] or b"") <= PIECE):
            group.append(texts[at] or b"")
            size += len(group[-1]) + 1
            at += 1
        if len(group) == 1 and size > PIECE:
            raw = np.frombuffer(group[0], np.uint8)
            parts, start = [], 0
            while start < len(raw):
                end = min(start + PIECE, len(raw))
                while end < len(raw):
                    gap = np.flatnonzero(ends_word[LOWER[raw[end : end + PIECE]]])
                    if len(gap):
                        end += int(gap[0])
                        break
                    end = min(end + PIECE, len(raw))
                parts.append(_hash_piece(raw[start:end], is_word))
                start = end
            hashes = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            yield hashes, np.array([len(hashes)])
            continue
        # A separator after every text, so that words never run on.
        gap = bytes([int(np.flatnonzero(ends_word)[0])])
        raw = np.frombuffer(gap.join(group) + gap, np.uint8)
        low = is_word[LOWER[raw]]
        begins = np.flatnonzero(low & ~np.concatenate(([False], low[:-1])))
        bounds = np.cumsum([len(g) + 1 for g in group])
        counts = np.diff(np.concatenate(([0], np.searchsorted(begins, bounds))))
        yield _hash_piece(raw, is_word), counts


def gram_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A hash of every k words in a row, one fewer than k at the end."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, np.uint64(seed * 2 + 1), np.uint64)
    for j in range(k):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + words[j : j + n]
    return mix(out)

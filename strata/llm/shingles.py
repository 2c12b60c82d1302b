"""Word shingle sets of documents as sorted 64-bit hashes, in numpy over blocks of texts.

Words are maximal runs of characters other than ASCII white space, A-Z
lower-cased. A word's hash adds one fixed random number for each (byte, place)
(tabulation hashing); a shingle's hash mixes those of its words. Two different
shingles share a hash with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

WORDS = 5
# Bytes of text worked on at a time; a longer text is hashed in pieces of this size.
BLOCK_BYTES = 1 << 22
_PLACES = 32
_RNG = np.random.Generator(np.random.PCG64(20240229))
_TABLE = _RNG.integers(0, 1 << 64, (_PLACES, 256), np.uint64).ravel()
_ROUND, _STEP, _MIX = (int(x) | 1 for x in _RNG.integers(1 << 62, 1 << 64, 3, np.uint64))
_SPACES = b" \t\n\x0b\x0c\r"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(_SPACES)] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(_MIX)
    return h ^ (h >> np.uint64(29))


def _word_hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of lower-cased bytes."""
    inside = ~_IS_SPACE[text]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    heads = np.append(0, starts).astype(np.int32)
    place = np.arange(len(text), dtype=np.int32) - np.repeat(heads, np.diff(np.append(heads, len(text))))
    values = _TABLE[(place % _PLACES) * 256 + text]
    if int((ends - starts).max()) > _PLACES:  # later rounds of a long word count differently
        values *= np.uint64(_ROUND) ** (place // _PLACES).astype(np.uint64)
    values[~inside] = 0
    return starts, np.add.reduceat(values, starts)


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in pieces cut at white space."""
    start = 0
    while len(text) - start > BLOCK_BYTES:
        stop = max(text.rfind(bytes([c]), start, start + BLOCK_BYTES) for c in _SPACES)
        if stop <= start:  # one word longer than a block
            found = [p for c in _SPACES if (p := text.find(bytes([c]), start + 1)) > 0]
            stop = min(found, default=len(text))
        yield text[start:stop]
        start = stop
    yield text[start:]


def _shingled(hashes: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(len(hashes) - words + 1, np.uint64)
    for k in range(words):
        out = out * np.uint64(_STEP) + hashes[k:len(out) + k]
    return mixed(out)


def shingle_sets(texts: list[str | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes (int64) of each text, in order."""
    block: list[bytes] = []
    size = 0
    for text in texts:
        raw = (text or "").encode().lower()
        if block and size + len(raw) > BLOCK_BYTES:
            yield from _block_sets(block, words)
            block, size = [], 0
        block.append(raw)
        size += len(raw)
    yield from _block_sets(block, words)


def _block_sets(block: list[bytes], words: int) -> Iterator[np.ndarray]:
    if len(block) == 1 and len(block[0]) > BLOCK_BYTES:
        hashes = np.concatenate([_word_hashes(np.frombuffer(p, np.uint8))[1] for p in _pieces(block[0])])
        bounds = np.array([0, len(hashes)])
    else:
        starts, hashes = _word_hashes(np.frombuffer(b" ".join(block), np.uint8))
        offsets = np.cumsum([0] + [len(b) + 1 for b in block])
        bounds = np.searchsorted(starts, offsets)
    full = _shingled(hashes, words).view(np.int64) if len(hashes) >= words else np.empty(0, np.int64)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            found = np.sort(full[a:b - words + 1])
            yield found[np.append(True, found[1:] != found[:-1])]
        elif b > a:
            yield _shingled(hashes[a:b], b - a).view(np.int64)
        else:
            yield np.empty(0, np.int64)


def set_key(found: np.ndarray) -> int:
    """A 64-bit key (signed) of a shingle set."""
    key = xxhash.xxh3_64_intdigest(found.tobytes())
    return key - (1 << 64) if key >> 63 else key

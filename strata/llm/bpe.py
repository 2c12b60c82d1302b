"""BPE encoding and decoding with a pair occurrence index.

A partition's texts are cut into pieces by the tokenizer's pattern. The
distinct pieces of a block that are not cached yet lie one after another in one
symbol sequence, and an index maps every adjacent pair that has a rank to all
its positions. Ranks are applied in ascending order: all positions of the pair
are merged, and the lists of the pairs this makes at their neighbours grow. A
merge can only make pairs of a higher rank (they hold the new token), so one
pass over the ranks is enough. A stale position is known by its symbols.

The vocabulary file is read on the driver and sent to the tasks as one
broadcast of fixed size (50,000 merges). Memory in a task is bounded by the
block (``BLOCK_BYTES``, of which only the distinct pieces are kept as strings) and
the piece cache (``CACHE_BYTES``, emptied when full); neither changes a result.
The codec goes when its task ends, so a reused Python worker keeps nothing of it.

Defined results: null text encodes as empty: no tokens, the digests of empty
input. Repeated rows and ids give one row each. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from strata.llm.common import map_batches, slices

BLOCK_BYTES = 1 << 22
CACHE_BYTES = 64 << 20
# What a cached piece takes besides its text and ids.
_ENTRY_BYTES = 220
# Over the number of ids of any vocabulary read here; a pair is one integer.
VOCAB_BITS = 1 << 24
# Symbols that are no ids: between pieces, and merged into the one before.
BORDER, GONE = -1, -2
# Fixed value: the pre-tokenizer pattern of byte-level BPE files that name none of their own.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + n)
    return {b: table[b] for b in range(256)}


def load(path: str) -> dict:
    """Merges, byte ids, token bytes and special tokens of a byte-level BPE ``tokenizer.json``.

    The path is one the driver can read; tasks get the loaded model.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
    back = {c: b for b, c in alphabet.items()}
    pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
    merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
    tokens = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    tokens.update({i: t.encode() for t, i in special.items()})
    return {"merges": merges, "byte_ids": [vocab[alphabet[b]] for b in range(256)], "tokens": tokens, "special": special}


class PairIndex:
    """Merges all pieces of one block together, rank by rank."""

    def __init__(self, model: dict):
        merges = sorted((a * VOCAB_BITS + b, rank, joined) for (a, b), (rank, joined) in model["merges"].items())
        self.keys, self.ranks, joined = (np.array(x, np.int64) for x in zip(*merges, strict=True))
        self.pair_of_rank = {int(r): (int(k) // VOCAB_BITS, int(k) % VOCAB_BITS, int(j))
                             for k, r, j in zip(self.keys, self.ranks, joined, strict=True)}
        self.byte_ids = np.array(model["byte_ids"], np.int64)

    def _file(self, index: dict[int, list], active: list[int], left, right, positions) -> None:
        """Put the positions of the pairs that have a rank into that rank's list."""
        keys = left.astype(np.int64) * VOCAB_BITS + right
        slot = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = (self.keys[slot] == keys) & (left >= 0) & (right >= 0)
        if not hit.any():
            return
        ranks, positions = self.ranks[slot[hit]], positions[hit]
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for rank, part in zip(ranks[np.r_[0, cuts]].tolist(), np.split(positions, cuts), strict=True):
            if rank in index:
                index[rank].append(part)
            else:
                index[rank] = [part]
                heapq.heappush(active, rank)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Packed little-endian 32-bit ids of each piece."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        # one border after each piece, and one in front, that no pair crosses
        size = int(sizes.sum()) + len(pieces) + 1
        symbols = np.full(size, BORDER, np.int32)
        ends = np.cumsum(sizes + 1)
        inside = np.ones(size, bool)
        inside[0] = False
        inside[ends] = False
        symbols[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        after, before = np.arange(1, size + 1, dtype=np.int32), np.arange(-1, size - 1, dtype=np.int32)
        index: dict[int, list] = {}
        active: list[int] = []
        step = 1 << 19  # the pairs of the whole block are filed part by part
        for at in range(0, size - 1, step):
            to = min(at + step, size - 1)
            self._file(index, active, symbols[at:to], symbols[at + 1:to + 1], np.arange(at, to, dtype=np.int32))
        while active:
            rank = heapq.heappop(active)
            left, right, joined = self.pair_of_rank[rank]
            lists = index.pop(rank)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            at = at[(symbols[at] == left) & (symbols[after[at]] == right)]
            if left == right:  # in a run of one symbol, each second position merges
                at = self._apart(at, after)
            if not len(at):
                continue
            gone = after[at]
            follow = after[gone]
            symbols[at], symbols[gone] = joined, GONE
            after[at], before[follow] = follow, at
            lead = before[at]
            where = np.concatenate((at, lead))
            self._file(index, active, symbols[where], symbols[np.concatenate((follow, at))], where)
        kept = symbols >= 0
        counts = np.cumsum(kept)[ends]
        packed, stops = symbols[kept].astype("<u4").tobytes(), (counts * 4).tolist()
        return [packed[i:j] for i, j in zip([0, *stops], stops, strict=False)]

    @staticmethod
    def _apart(at, after):
        taken, last = [], -1
        for i, j in zip(at.tolist(), after[at].tolist(), strict=True):
            if i != last:
                taken.append(i)
                last = j
        return np.array(taken, np.int64)


class Codec:
    """Encodes texts to packed little-endian 32-bit ids and decodes them again."""

    def __init__(self, model: dict, cache_bytes: int = CACHE_BYTES):
        self.index, self.cache_bytes, self.used = PairIndex(model), cache_bytes, 0
        self.find = regex.compile(PATTERN).findall
        self.special = model["special"]
        names = sorted(self.special, key=len, reverse=True)
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.packed: dict[str, bytes] = {}
        self.special_packed = {t: struct.pack("<I", i) for t, i in self.special.items()}
        size = max(model["tokens"]) + 1
        self.tokens = [model["tokens"].get(i, b"") for i in range(size)]

    def _pieces(self, text: str) -> list[str]:
        if self.special_cut is None or not any(t in text for t in self.special):
            return self.find(text)
        out: list[str] = []
        for part in self.special_cut.split(text):
            if part in self.special:
                out.append(part)
            else:
                out.extend(self.find(part))
        return out

    def encode_block(self, texts: list[str]) -> list[bytes]:
        number: defaultdict[str, int] = defaultdict(count().__next__)  # each distinct piece has a number
        cut = [np.fromiter(map(number.__getitem__, self._pieces(t)), np.int32) for t in texts]
        if self.used > self.cache_bytes:
            self.packed, self.used = {}, 0
        known = self.packed
        # a special token is one piece only where the cut made it one; its text never comes out of the pattern whole
        missing = [p for p in number if p not in known and p not in self.special]
        known.update(zip(missing, self.index.encode([p.encode() for p in missing]), strict=True))
        self.used += sum(len(p) + len(known[p]) for p in missing) + _ENTRY_BYTES * len(missing)
        known.update(self.special_packed)
        packed = [known[p] for p in number]
        return [b"".join(map(packed.__getitem__, pieces.tolist())) for pieces in cut]

    def decode(self, packed: bytes) -> str:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(packed, "<u4").tolist()]).decode("utf-8", errors="replace")


def encode(docs: DataFrame, tokenizer_path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and the ids themselves if asked for."""
    model = docs.sparkSession.sparkContext.broadcast(load(tokenizer_path))
    id_type = pa.int64()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    digest = lambda b: hashlib.sha256(b).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model.value)
        for batch in batches:
            for block in slices(batch, 1, BLOCK_BYTES):
                packed = codec.encode_block([t or "" for t in block.column(1).to_pylist()])
                columns = [block.column(0).cast(id_type),
                           pa.array([len(p) // 4 for p in packed], pa.int64()),
                           pa.array([digest(p) for p in packed], pa.string()),
                           pa.array([digest(codec.decode(p).encode()) for p in packed], pa.string())]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(p, "<u4").astype(np.int64) for p in packed],
                                            pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * with_ids
    return map_batches(docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")), run, schema)

"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

All pre-tokens of a step that are not known yet lie in one linked list of positions, with a gap after each.
A bucket for each merge rank holds the positions whose pair has that rank; bitmaps of three levels say which
buckets are filled, and find-first-set gives the next rank in constant time. An entry whose pair has changed
since is stale and is skipped. The work is linear in the number of bytes and merges, for however long a pre-token.
"""

from __future__ import annotations

import base64
import functools
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import EMPTIED, PieceCache, map_steps, text_of


#: Pairs whose joined rank is remembered.
MOST_PAIRS = 300_000


class RankQueue:
    """Positions by rank, least rank first."""

    def __init__(self, n_ranks: int):
        self.low, self.mid, self.top = [0] * (n_ranks // 64 + 1), [0] * (n_ranks // 4096 + 1), 0
        self.buckets: dict[int, list[int]] = {}

    def put(self, rank: int, positions: list[int]) -> None:
        """Fills the empty bucket of rank."""
        self.buckets[rank] = positions
        b = rank >> 6
        if not self.low[b]:
            self.mid[b >> 6] |= 1 << (b & 63)
            self.top |= 1 << (b >> 6)
        self.low[b] |= 1 << (rank & 63)

    def first(self) -> int:
        """The least rank with a filled bucket, or -1."""
        if not self.top:
            return -1
        a = (self.top & -self.top).bit_length() - 1
        x = self.mid[a]
        b = a << 6 | (x & -x).bit_length() - 1
        x = self.low[b]
        return b << 6 | (x & -x).bit_length() - 1

    def take(self, rank: int) -> list[int]:
        """Empties the bucket of rank."""
        b, a = rank >> 6, rank >> 12
        self.low[b] &= ~(1 << (rank & 63))
        if not self.low[b]:
            self.mid[a] &= ~(1 << (b & 63))
            if not self.mid[a]:
                self.top &= ~(1 << a)
        return self.buckets.pop(rank)


class ByteBpe:
    """Encodes and decodes by a rank file; each match of pattern is encoded separately, special strings are plain text."""

    def __init__(self, rank_file: str, pattern: str):
        import regex

        with open(rank_file, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = regex.compile(pattern).findall
        self.n_ranks = max(self.ranks.values()) + 1
        self.bytes_of: list[bytes] = [b""] * self.n_ranks
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.of_bytes = np.array([[self.ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)], np.int32)
        self.rights: list[dict[int, int]] = [{-1: -1} for _ in range(self.n_ranks)]
        self.n_pairs = 0
        self.cache = PieceCache(self.encode_pieces, most=700_000, most_chars=14_000_000)

    def forget_pairs(self) -> None:
        """By left token: right token to the rank of the two joined, or -1. The gap (-1) joins with nothing."""
        self.n_pairs = 0
        for known in self.rights:
            if len(known) > 1:
                known.clear()
                known[-1] = -1

    def pair(self, a: int, b: int) -> int:
        self.n_pairs += 1
        return self.rights[a].setdefault(b, self.ranks.get(self.bytes_of[a] + self.bytes_of[b], -1))

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as little-endian 32-bit integers."""
        rights, pair = self.rights, self.pair
        if self.n_pairs > MOST_PAIRS:
            self.forget_pairs()
        lengths = np.array([len(p) for p in pieces])
        starts = [0, *np.cumsum(lengths + 1).tolist()]
        raw = np.full(starts[-1] + 1, -1, np.int32)  # a gap after each piece: no pair reaches over it; the last entry stands before position 0, as position -1
        filled = np.ones(len(raw), bool)
        filled[np.array(starts[1:]) - 1] = filled[-1] = False
        raw[filled] = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(raw)
        token = np.where(raw >= 0, self.of_byte[raw], -1).tolist()
        ranks = np.where((raw[:-1] >= 0) & (raw[1:] >= 0), self.of_bytes[raw[:-1], raw[1:]], -1)
        rank_at = [*ranks.tolist(), -1]  # of the pair that begins here
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = RankQueue(self.n_ranks)
        order = np.argsort(ranks, kind="stable")[int((ranks < 0).sum()) :]
        first = np.flatnonzero(np.diff(ranks[order], prepend=-1))
        places = order.tolist()
        for r, a, b in zip(ranks[order[first]].tolist(), first.tolist(), [*first[1:].tolist(), len(places)]):
            queue.put(r, places[a:b])
        buckets, put, held = queue.buckets, queue.put, queue.buckets.get
        while (rank := queue.first()) >= 0:
            positions = queue.take(rank)
            positions.sort()
            with_rank = rights[rank]
            for k, i in enumerate(positions):
                if rank_at[i] != rank:
                    continue  # stale
                j = after[i]
                end = after[j]
                token[i], token[j], rank_at[j], after[i], before[end] = rank, -2, -1, end, i
                least = rank
                b = token[end]
                r = with_rank.get(b)
                if r is None:
                    r = pair(rank, b)
                rank_at[i] = r
                if r >= 0:
                    bucket = held(r)
                    if bucket is None:
                        put(r, [i])
                    else:
                        bucket.append(i)
                    if r < rank:
                        least = r
                h = before[i]
                a = token[h]
                if a >= 0:
                    r = rights[a].get(rank)
                    if r is None:
                        r = pair(a, rank)
                    rank_at[h] = r
                    if r >= 0:
                        bucket = held(r)
                        if bucket is None:
                            put(r, [h])
                        else:
                            bucket.append(h)
                        if r < least:
                            least = r
                if least < rank and k + 1 < len(positions):  # a lesser rank has come up: the rest of this bucket waits
                    if rank in buckets:
                        buckets[rank] += positions[k + 1 :]
                    else:
                        put(rank, positions[k + 1 :])
                    break
        left = np.array(token, np.int64)
        left = np.where(left >= 0, left, -1)
        ends = np.concatenate([[0], np.cumsum(left >= 0)])[starts].tolist()
        ids = left[left >= 0].astype("<u4").tobytes()
        return [ids[4 * a : 4 * b] for a, b in zip(ends, ends[1:])]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, as little-endian 32-bit integers. A piece that is a token is that token."""
        raw = [p.encode() for p in pieces]
        out = [self.ranks.get(p) for p in raw]
        rest = [k for k, r in enumerate(out) if r is None]
        done: list = [r if r is None else r.to_bytes(4, "little") for r in out]
        for group in grouped(rest, raw, 1 << 20):
            for k, ids in zip(group, self.merge([raw[k] for k in group]), strict=True):
                done[k] = ids
        return done

    def encode(self, texts: list[str]) -> list[bytes]:
        return list(map(b"".join, self.cache.values([self.split(t) for t in texts])))

    def decode(self, ids: bytes) -> bytes:
        """The bytes of little-endian 32-bit ids."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def grouped(keys: list[int], raw: list[bytes], limit: int) -> list[list[int]]:
    """keys in groups of about limit bytes."""
    at = accumulate((len(raw[k]) for k in keys), initial=0)
    groups: dict[int, list[int]] = {}
    for k, before in zip(keys, at):
        groups.setdefault(before // limit, []).append(k)
    return list(groups.values())


@functools.lru_cache(2)
def bpe(rank_file: str, pattern: str) -> ByteBpe:
    return ByteBpe(rank_file, pattern)


EMPTIED[__name__] = bpe.cache_clear


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (binary: little-endian unsigned 32-bit) for every row of docs; rank_file: a path on every machine.

    A null text is an empty one and has no ids. A null id stays null; repeated rows give repeated results; other
    columns of docs are not read, whatever their names; an empty table gives an empty result.
    """
    return map_steps(text_of(docs, id_col, text_col), text_col, lambda part: (part.column(id_col), bpe(rank_file, pattern).encode(part.column(text_col).to_pylist())), f"`{id_col}` long, ids binary")


def decode_documents(encoded: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """id, ids, decoded (binary) from what encode_documents returns; null ids decode to nothing."""

    def make(part):
        ids = [x or b"" for x in part.column("ids").to_pylist()]
        return part.column(id_col), ids, list(map(bpe(rank_file, pattern).decode, ids))

    return map_steps(encoded.select(id_col, F.coalesce("ids", F.lit(b"")).alias("ids")), "ids", make, f"`{id_col}` long, ids binary, decoded binary")


def round_trip_documents(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids, decoded: what encode_documents and then decode_documents give, in one pass, so that a task has one Python worker and not two."""

    def make(part):
        own = bpe(rank_file, pattern)
        ids = own.encode(part.column(text_col).to_pylist())
        return part.column(id_col), ids, list(map(own.decode, ids))

    return map_steps(text_of(docs, id_col, text_col), text_col, make, f"`{id_col}` long, ids binary, decoded binary")

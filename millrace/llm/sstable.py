"""Sorted-string-table shards of token ids, keyed by document identifier.

A shard: compressed blocks of entries in key order, each key without the prefix it shares with the one before;
a sparse index with the first key of every block; a Bloom filter of the keys; a footer of fixed length.
get() reads footer and filter, searches the index by halves, then reads one block.
Shards of one partition follow each other, and partitions hold ascending ranges of identifiers.
"""

from __future__ import annotations

import bisect
import functools
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm._common import PieceCache, cut, put_file, read_range, steps, store, task_name, text_of, uncollected

MAGIC = b"MRSST001"
FOOTER = struct.Struct("<QQQQQQQB7x8s")  # index offset and length, filter offset and length, documents, tokens, tokens before (in the partition), bytes an id
#: Characters of a text that order rows of one id; a hash of the whole text decides beyond.
TIE = 64
BLOCK_BYTES, SHARD_BYTES, STEP = 64 << 10, 16 << 20, 8 << 20


def key_of(doc_id: int | None) -> bytes:
    """Keys sort as identifiers do, null first."""
    return b"\0" if doc_id is None else b"\1" + (doc_id + (1 << 63)).to_bytes(8, "big")


def id_of(key: bytes) -> int | None:
    return None if key == b"\0" else int.from_bytes(key[1:], "big") - (1 << 63)


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def bloom_places(key: bytes, bits: int, hashes: int = 7) -> list[int]:
    h = xxhash.xxh64_intdigest(key)
    a, b = h & 0xFFFFFFFF, h >> 32 | 1
    return [(a + i * b) % bits for i in range(hashes)]


class ShardWriter:
    """Takes entries in key order; data() is the file."""

    def __init__(self, width: int, before: int):
        self.width, self.before, self.out, self.index, self.keys = width, before, bytearray(), [], []
        self.block, self.first, self.last, self.tokens = bytearray(), b"", b"", 0
        self.pack = zstandard.ZstdCompressor(level=3)

    def add(self, key: bytes, value: bytes) -> None:
        if not self.block:
            self.first, self.last = key, b""
        shared = next((i for i, (a, b) in enumerate(zip(self.last, key)) if a != b), min(len(self.last), len(key)))
        self.block += varint(shared) + varint(len(key) - shared) + varint(len(value)) + key[shared:] + value
        self.keys.append(key)
        self.last = key
        self.tokens += len(value) // self.width
        if len(self.block) >= BLOCK_BYTES:
            self.end_block()

    def end_block(self) -> None:
        if self.block:
            packed = self.pack.compress(bytes(self.block))
            self.index.append((self.first, len(self.out), len(packed)))
            self.out += packed
            self.block = bytearray()

    def data(self) -> bytes:
        self.end_block()
        index = b"".join(varint(len(k)) + k + varint(at) + varint(n) for k, at, n in self.index)
        filled = np.zeros(max(64, -(-10 * len(self.keys) // 8) * 8), dtype=np.uint8)
        for k in self.keys:
            filled[bloom_places(k, len(filled))] = 1
        bloom = np.packbits(filled).tobytes()
        at = len(self.out)
        return bytes(self.out) + index + bloom + FOOTER.pack(at, len(index), at + len(index), len(bloom), len(self.keys), self.tokens, self.before, self.width, MAGIC)


class Shard:
    """A shard that is read by ranges."""

    def __init__(self, path: str):
        files, at = store(path)
        self.path, size = path, files.get_file_info(at).size
        i, n_i, b, n_b, self.n_docs, self.n_tokens, self.before, self.width, magic = FOOTER.unpack(read_range(path, size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no shard")
        data = read_range(path, i, n_i + n_b)
        self.bloom, self.index, p = data[n_i:], [], 0
        while p < n_i:
            n, p = read_varint(data, p)
            key, p = data[p : p + n], p + n
            at, p = read_varint(data, p)
            length, p = read_varint(data, p)
            self.index.append((key, at, length))

    def may_hold(self, key: bytes) -> bool:
        return all(self.bloom[p >> 3] >> (7 - (p & 7)) & 1 for p in bloom_places(key, 8 * len(self.bloom)))

    def entries(self, block: int) -> Iterator[tuple[bytes, bytes]]:
        _, at, n = self.index[block]
        data, p, key = zstandard.ZstdDecompressor().decompress(read_range(self.path, at, n)), 0, b""
        while p < len(data):
            shared, p = read_varint(data, p)
            own, p = read_varint(data, p)
            length, p = read_varint(data, p)
            key, p = key[:shared] + data[p : p + own], p + own
            yield key, data[p : p + length]
            p += length

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every document with this identifier in the shard."""
        key = key_of(doc_id)
        if not self.may_hold(key):
            return []
        found, firsts = [], [k for k, _, _ in self.index]
        for block in range(max(0, bisect.bisect_left(firsts, key) - 1), bisect.bisect_right(firsts, key)):
            found += [np.frombuffer(v, f"<u{self.width}") for k, v in self.entries(block) if k == key]
        return found


class WordEncoder:
    """Ids by a tokenizers file, without special tokens of its own; each word is encoded once while it is remembered.

    White space ends every pre-token of such a file and its normalisation reaches over none, so words are encoded
    apart; a text that writes out an added token goes to the library whole. Where all characters are below U+0250
    (there NFC changes nothing and lower case depends on no neighbour) words are put in lower case and cut into
    pre-tokens by the file's own pattern; new pre-tokens go to the library many at a time, with spaces between, and
    its ids are told apart by the mark that ends a pre-token's last token.
    """

    SPACE = re.compile("[ \t\n\r\f\v]+")
    OTHER = re.compile("[\x1c-\x1f\x85\xa0\u0130\u0250-\U0010ffff]")

    def __init__(self, file: str):
        import regex
        from tokenizers import Tokenizer

        self.library, self.bare = Tokenizer.from_file(file), Tokenizer.from_file(file)
        self.bare.normalizer = None
        with open(file) as f:
            stated = json.load(f)
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        ends = stated["model"]["end_of_word_suffix"]
        self.last = np.zeros(max(stated["model"]["vocab"].values()) + 1, bool)
        self.last[[i for s, i in stated["model"]["vocab"].items() if s.endswith(ends)]] = True
        self.cut = regex.compile(stated["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.odd, self.plain = PieceCache(self.whole, most=100_000), PieceCache(self.words, most=900_000, most_chars=18_000_000)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, f"<u{self.width}").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def new_pieces(self, pieces: list[str]) -> list[bytes]:
        if not pieces:
            return []
        joined = [" ".join(pieces[at : at + 64]) for at in range(0, len(pieces), 64)]
        ids = np.concatenate([np.array(e.ids, f"<u{self.width}") for e in self.bare.encode_batch_fast(joined, add_special_tokens=False)])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(pieces):
            return self.whole(pieces)
        raw, at = ids.tobytes(), [0, *(self.width * ends).tolist()]
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def parts(self, word: str) -> list[str]:
        """The pre-tokens of a word: letters, letters with a mark behind, or whatever the pattern says."""
        if word.isalpha() or not word:
            return [word] if word else []
        if word[-1] in ".," and word[:-1].isalpha():
            return [word[:-1], word[-1]]
        return self.cut(word)

    def words(self, words: list[str]) -> list[bytes]:
        lists = list(map(self.parts, words))
        pieces = list({p for x in lists for p in x})
        known = dict(zip(pieces, self.new_pieces(pieces), strict=True))
        return [known[x[0]] if len(x) == 1 else b"".join(map(known.__getitem__, x)) for x in lists]

    def plain_texts(self, texts: list[str]) -> list[bytes]:
        """Texts of the plain alphabet: their words are numbered in arrays, looked up once each, and the ids put in place in arrays."""
        lists = pc.utf8_split_whitespace(pc.utf8_lower(pa.array(texts, pa.string())))
        numbered = lists.flatten().dictionary_encode()
        (values,) = self.plain.values([numbered.dictionary.to_pylist()])
        number = numbered.indices.to_numpy()
        size = np.fromiter(map(len, values), np.int32, len(values)) // self.width
        begin = np.cumsum(size, dtype=np.int32) - size
        counts = size[number]
        ends = np.cumsum(counts, dtype=np.int32)  # a step's ids are far fewer than 2^31
        total = int(ends[-1]) if len(ends) else 0
        ids = np.frombuffer(b"".join(values), f"<u{self.width}")[np.repeat(begin[number] - ends + counts, counts) + np.arange(total, dtype=np.int32)]
        at = (np.concatenate([[0], ends])[lists.offsets.to_numpy()] * self.width).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = [any(t in text for t in self.added) for text in texts]
        odd = [w or self.OTHER.search(text) is not None for w, text in zip(whole, texts)]
        plain = iter(self.plain_texts([text for o, text in zip(odd, texts) if not o]))
        others = iter(self.odd.values([[text] if w else [x for x in self.SPACE.split(text) if x] for w, o, text in zip(whole, odd, texts) if o]))
        return [b"".join(next(others)) if o else next(plain) for o in odd]


@functools.lru_cache(1)
def encoder(file: str) -> WordEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(file)


def write_shards(spark: SparkSession, docs: DataFrame, tokenizer: str, out: str, end_id: int | None = None, partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the ids of every row of docs into shards under out; returns their manifest: part, roll, path, first_id, last_id, n_docs, n_tokens, before.

    end_id is appended to every document. A null text is an empty one; a null id sorts first; rows that share an id
    all stay, in the order of the first TIE characters of their texts, then of a hash of the whole. Other columns of docs are not read, whatever their names. An empty table
    writes no shard. out and the tokenizer's path must be the same place on every machine.
    """

    def run(batches):
        coder = encoder(tokenizer)
        end = b"" if end_id is None else np.array([end_id], f"<u{coder.width}").tobytes()
        name, rolled, before, rows, shard = task_name(), 0, 0, [], None
        first = last = None

        def close():
            nonlocal rolled, before, shard
            path = f"{out}/{name}-{rolled:05d}.sst"
            put_file(path, shard.data())
            rows.append((int(name.split("-")[1]), rolled, path, first, last, len(shard.keys), shard.tokens, before))
            rolled, before, shard = rolled + 1, before + shard.tokens, None

        for part in steps(batches, text_col, STEP):
            with uncollected():
                encoded = coder.encode(part.column(text_col).to_pylist())
            for doc_id, ids in zip(part.column(id_col).to_pylist(), encoded, strict=True):
                if shard is None:
                    shard, first = ShardWriter(coder.width, before), doc_id
                shard.add(key_of(doc_id), ids + end)
                last = doc_id
                if len(shard.out) >= SHARD_BYTES:
                    close()
        if shard is not None:
            close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))], names=["part", "roll", "path", "first_id", "last_id", "n_docs", "n_tokens", "before"])

    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows without id, or of one id, are ranged and sorted by the same; only rows with the same text are split by where they were read
    order = (F.asc_nulls_first(id_col), F.substring(text_col, 1, TIE), F.xxhash64(text_col))
    ranged = text_of(docs, id_col, text_col).withColumn("__read", F.spark_partition_id())
    ordered = ranged.repartitionByRange(n, *order, "__read").sortWithinPartitions(*order).drop("__read")
    return cut(spark, ordered.mapInArrow(run, "part int, roll int, path string, first_id long, last_id long, n_docs long, n_tokens long, before long"), "sst-manifest")


def read_shards(spark: SparkSession, manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, start (ids of all documents before it), n_tokens, ids (binary, little-endian unsigned 32-bit) of all shards, from their files.

    What goes to the driver is one sum for each range partition.
    """
    sums = {r["part"]: r["n"] for r in manifest.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    start, total = {}, 0
    for part in sorted(sums):
        start[part], total = total, total + sums[part]

    def run(batches):
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            for part, path in zip(batch.column("part").to_pylist(), batch.column("path").to_pylist()):
                shard = Shard(path)
                at = start[part] + shard.before
                rows, held = [], 0
                for block in range(len(shard.index)):
                    for key, value in shard.entries(block):
                        ids = np.frombuffer(value, f"<u{shard.width}").astype("<u4").tobytes()
                        rows.append((id_of(key), at, len(ids) // 4, ids))
                        at, held = at + len(ids) // 4, held + len(ids)
                    if held >= 4 << 20 or block + 1 == len(shard.index):
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[id_col, "start", "n_tokens", "ids"])
                        rows, held = [], 0

    return manifest.select("part", "path").repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))).mapInArrow(run, f"`{id_col}` long, start long, n_tokens long, ids binary")


def lookup(manifest_rows: list, doc_id: int | None) -> list[np.ndarray]:
    """The ids of a document: shards whose range has it, by halves over their first identifiers, then by filter, index and block."""
    keys = [key_of(r["first_id"]) for r in manifest_rows]
    at, found = bisect.bisect_right(keys, key_of(doc_id)) - 1, []
    while at >= 0 and key_of(manifest_rows[at]["last_id"]) >= key_of(doc_id):
        found = Shard(manifest_rows[at]["path"]).get(doc_id) + found
        at -= 1
    return found

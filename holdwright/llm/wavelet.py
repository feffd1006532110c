"""Token ids in a wavelet matrix per shard.

A shard's ids are held as succinct bit-planes, highest bit first; each plane is
ordered by the bits above it, zeros before ones, and carries a directory of ones.
From the one compressed file come access to any token, the number of occurrences of an
id in a stretch, and the place of its k-th occurrence.

Documents are written in ascending order of id (nulls first, then by text), whole
documents to a shard. Defined results: a null text is empty, and has the end id
alone; repeated rows are documents of their own; an empty table gives no shards.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import uuid
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, shared_dir

END_ID = 1
#: Tokens in a shard, about; a task holds one shard.
SHARD_TOKENS = 1 << 20
#: Words whose ids a worker keeps in each of two generations; those used since the last change outlive it.
CACHE_WORDS = 500_000
#: Bytes of text that are encoded together, about.
ENCODE_BYTES = 1 << 22
#: Between words that are encoded together: a piece of its own, and one token.
MARK = b"\x01"
WORD_END = "</w>"
#: Words of printable ASCII and of small letters of Latin-1, which normalization leaves alone, in UTF-8.
PLAIN = re.compile(rb"(?:[\x21-\x7E]|\xC3[\x9F-\xB6\xB8-\xBF])+")
#: The pieces that the tokenizer cuts such a word into: its own pattern, where these are all letters and digits.
PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|(?:[a-z]|\xC3[\x9F-\xB6\xB8-\xBF])+|[0-9]|[\x21-\x2F\x3A-\x60\x7B-\x7E]+")
#: What the tokenizer's settings hold if these pieces are its own.
BY_WORD = [json.dumps(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"), '"Lowercase"', '"Removed"', '"ByteLevel"', f'"{WORD_END}"']
BLOCK = 512
MAGIC = b"WAVELET1"


class WaveletMatrix:
    """planes[l] are the packed bits of level l (little-endian bits in uint64 words), zeros[l] their number of zeros."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        levels = max(int(ids.max()).bit_length(), 1) if len(ids) else 1
        planes, zeros, ranks = [], [], []
        ids = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        for level in range(levels - 1, -1, -1):
            bit = (ids & ids.dtype.type(1 << level)) != 0
            packed = np.packbits(bit, bitorder="little")
            packed = np.pad(packed, (0, -len(packed) % (BLOCK // 8) + BLOCK // 8))
            planes.append(packed.view("<u8"))
            per = np.bitwise_count(planes[-1]).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
            ranks.append(np.concatenate(([0], np.cumsum(per)[:-1])).astype("<u4"))
            zeros.append(int(len(bit) - np.count_nonzero(bit)))
            ids = np.concatenate((ids[~bit], ids[bit]))
        return cls(len(ids), planes, zeros, ranks)

    def _bit(self, level: int, i: np.ndarray) -> np.ndarray:
        return (self.planes[level][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)

    def rank1(self, level: int, i: np.ndarray) -> np.ndarray:
        """Ones before position i (0..n): the directory's count, then the words of one block."""
        i = np.asarray(i, np.int64)
        block, words = i // BLOCK, BLOCK // 64
        of = self.planes[level].reshape(-1, words)[block]
        keep = np.clip((i % BLOCK)[..., None] - 64 * np.arange(words), 0, 64).astype(np.uint64)
        mask = np.where(keep == 64, ~np.uint64(0), (np.uint64(1) << np.minimum(keep, np.uint64(63))) - np.uint64(1))
        return self.ranks[level][block].astype(np.int64) + np.bitwise_count(of & mask).sum(axis=-1, dtype=np.int64)

    def access(self, i) -> np.ndarray:
        """The ids at positions i."""
        i = np.asarray(i, np.int64)
        out = np.zeros(i.shape, np.int64)
        for level in range(len(self.planes)):
            bit = self._bit(level, i).astype(np.int64)
            ones = self.rank1(level, i)
            i = np.where(bit, self.zeros[level] + ones, i - ones)
            out = out << 1 | bit
        return out

    def _stretch(self, symbol: int, lo: int, hi: int) -> tuple[int, int]:
        if symbol < 0 or symbol >> len(self.planes):
            return 0, 0
        for level in range(len(self.planes)):
            a, b = (int(x) for x in self.rank1(level, np.array([lo, hi])))
            if symbol >> (len(self.planes) - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, symbol: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of symbol at positions lo..hi-1."""
        a, b = self._stretch(symbol, lo, self.n if hi is None else hi)
        return b - a

    def _select(self, level: int, one: int, k: int) -> int:
        """The position of the k-th (from 0) one, or zero, of a plane."""
        starts = self.ranks[level].astype(np.int64)
        if not one:
            starts = np.arange(len(starts), dtype=np.int64) * BLOCK - starts
        block = int(np.searchsorted(starts, k, "right")) - 1
        words = self.planes[level].reshape(-1, BLOCK // 64)[block]
        bits = np.unpackbits(words.view(np.uint8), bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == one)[k - int(starts[block])])

    def select(self, symbol: int, k: int) -> int:
        """The position of the k-th occurrence (from 0) of symbol; -1 if there are fewer."""
        lo, hi = self._stretch(symbol, 0, self.n)
        if not 0 <= k < hi - lo:
            return -1
        at = lo + k
        for level in range(len(self.planes) - 1, -1, -1):
            one = symbol >> (len(self.planes) - 1 - level) & 1
            at = self._select(level, one, at - (self.zeros[level] if one else 0))
        return at

    def decode(self) -> np.ndarray:
        """All ids: from the last level up, each plane says which of its places its zeros and its ones go back to."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for k in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[k].view(np.uint8), count=self.n, bitorder="little").view(bool)
            above = np.empty(self.n, kind)
            above[~bit] = out[: self.zeros[k]]
            above[bit] = out[self.zeros[k] :] | kind(1 << (len(self.planes) - 1 - k))
            out = above
        return out.astype(np.uint32)


def write_shard(ids: np.ndarray, doc_ids: list[int | None], starts: np.ndarray) -> bytes:
    """One file: magic, the length of the head, the head (JSON), then its sections, each a Zstandard frame."""
    m = WaveletMatrix.build(ids)
    sections = {
        "docs": np.array([0 if d is None else d for d in doc_ids], "<i8"),
        "null": np.flatnonzero([d is None for d in doc_ids]).astype("<i8"),
        "starts": np.diff(starts, prepend=0).astype("<i8"),
    }
    for k, (p, r) in enumerate(zip(m.planes, m.ranks, strict=True)):
        sections |= {f"plane{k}": p, f"rank{k}": np.diff(r, prepend=np.uint32(0)).astype("<u2")}
    frames = {k: zstandard.ZstdCompressor(level=1).compress(v.tobytes()) for k, v in sections.items()}
    head = json.dumps({"n": m.n, "zeros": m.zeros, "sections": [[k, len(f)] for k, f in frames.items()]}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *frames.values()])


def read_shard(data: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    """(matrix, doc ids, starts); starts has one more entry, the number of ids."""
    if data[:8] != MAGIC:
        raise ValueError("not a shard")
    at = 12 + int.from_bytes(data[8:12], "little")
    head = json.loads(data[12:at])
    raw = {}
    for k, size in head["sections"]:
        raw[k] = zstandard.ZstdDecompressor().decompress(data[at : at + size])
        at += size
    planes = [np.frombuffer(raw[f"plane{k}"], "<u8") for k in range(len(head["zeros"]))]
    ranks = [np.cumsum(np.frombuffer(raw[f"rank{k}"], "<u2"), dtype=np.uint32) for k in range(len(head["zeros"]))]
    docs: list[int | None] = np.frombuffer(raw["docs"], "<i8").tolist()
    for k in np.frombuffer(raw["null"], "<i8").tolist():
        docs[k] = None
    return WaveletMatrix(head["n"], planes, head["zeros"], ranks), docs, np.cumsum(np.frombuffer(raw["starts"], "<i8"))


class WordIds:
    """word -> its ids as bytes, by a tokenizer that drops white space and never looks across it.

    Words that are not known yet are encoded by the library, many at once. Words of plain letters are cut
    into the tokenizer's pieces beforehand, which leaves the library its merges alone; a piece's ids
    reach to the next word end of the vocabulary. Other words go through the whole tokenizer with a mark
    between them. Known words are kept in two generations; those used since the last change outlive it.
    """

    def __init__(self, tokenizer):
        from tokenizers import Tokenizer, pre_tokenizers

        self.full, told = tokenizer, json.loads(tokenizer.to_str())
        shape = json.dumps([told["normalizer"], told["pre_tokenizer"], told["model"].get("end_of_word_suffix")])
        self.by_word = told["model"]["type"] == "BPE" and all(x in shape for x in BY_WORD)
        self.plain = Tokenizer(tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = tokenizer.get_vocab()
        self.kind = np.dtype(np.uint16 if max(vocabulary.values()) < 1 << 16 else np.uint32)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith(WORD_END)]] = True
        self.now: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encoded(self, text: bytes, plain: bool = False) -> np.ndarray:
        t = self.plain if plain else self.full
        return np.array(t.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, self.kind)

    def _keep(self, words: list[bytes], ids: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> None:
        raw, size = ids.tobytes(), self.kind.itemsize
        self.now.update(zip(words, [raw[a:z] for a, z in zip((starts * size).tolist(), (stops * size).tolist(), strict=True)], strict=True))

    def learn(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, which now holds afterwards."""
        if len(self.now) > CACHE_WORDS:
            self.now, self.older = {}, self.now
        now, older = self.now, self.older
        found = list(map(now.get, words))
        cut: list[tuple[bytes, list[bytes]]] = []
        marked, pieces = [], []
        for w in [w for w, ids in zip(words, found, strict=True) if ids is None]:
            if (ids := older.get(w)) is not None:
                now[w] = ids
            elif w.isalpha():
                pieces.append(w)
            elif PLAIN.fullmatch(w):
                cut.append((w, PIECES.findall(w)))
            elif MARK in w:
                now[w] = self.encoded(w).tobytes()
            else:
                marked.append(w)
        if marked:
            ids, mark = self.encoded((b" " + MARK + b" ").join(marked)), self.encoded(MARK)
            at = np.flatnonzero(ids == mark[0])
            self._keep(marked, ids, np.concatenate(([0], at + 1)), np.append(at, len(ids)))
        pieces = [w for w in dict.fromkeys(chain(pieces, *[p for _, p in cut])) if w not in now]
        if pieces:
            ids = self.encoded(b" ".join(pieces), True)
            stops = np.flatnonzero(self.ends[ids]) + 1
            self._keep(pieces, ids, np.concatenate(([0], stops[:-1])), stops)
        now.update([(w, b"".join([now[x] for x in p])) for w, p in cut])
        return [ids if ids is not None else now[w] for w, ids in zip(words, found, strict=True)]


def _known(tokenizer: str) -> WordIds:
    """What this worker process knows of a tokenizer; it outlasts the task."""
    state = sys.modules.setdefault("holdwright_worker_state", types.ModuleType("holdwright_worker_state")).__dict__
    if tokenizer not in state:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        state[tokenizer] = WordIds(Tokenizer.from_file(tokenizer))
    return state[tokenizer]


def encoder(tokenizer: str, end_id: int = END_ID) -> Callable[[pa.Array], list[np.ndarray]]:
    """A function from texts to their ids with the end id.

    Where the tokenizer is seen to work by words, a word is encoded once and its ids are kept.
    Other tokenizers, and texts that may spell a special token, encode whole texts.
    """

    def encode(texts: pa.Array) -> list[np.ndarray]:
        words = _known(tokenizer)
        whole = pc.match_substring(texts, "<|") if words.by_word else pa.repeat(True, len(texts))
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(whole, "", texts)))
        index = split.flatten().dictionary_encode()
        found = index.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        ids = words.learn(found)
        offsets = np.cumsum([0, *map(len, ids)]) // words.kind.itemsize
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), words.kind)))
        taken = ids.take(index.indices)
        flat, ends = taken.flatten().to_numpy(), taken.offsets.to_numpy()
        ends = (ends - ends[0])[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        out = []
        for k, special in enumerate(whole.to_pylist()):
            got = words.encoded(texts[k].as_py().encode()) if special else flat[ends[k] : ends[k + 1]]
            out.append(np.append(got.astype("<u4"), np.uint32(end_id)))
        return out

    return encode


def write_tokens(docs: DataFrame, path: str, tokenizer: str, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shards under path; returns (part, seq, path, docs, tokens), a row for every complete file, in order of (part, seq)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("id").sortWithinPartitions("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        store, root = pafs.FileSystem.from_uri(path)
        store.create_dir(root, recursive=True)
        encode = encoder(tokenizer)
        ids: list[np.ndarray] = []
        names: list[int | None] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal held, seq
            name = f"{root}/{part:06d}-{seq:06d}-{uuid.uuid4().hex}.ids"
            starts = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
            with store.open_output_stream(name) as f:
                f.write(write_shard(np.concatenate(ids), names, starts))
            out = pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "path": [name], "docs": [len(names)], "tokens": [held]})
            ids.clear()
            names.clear()
            held, seq = 0, seq + 1
            return out

        for b in batches:
            step = max(1, ENCODE_BYTES * b.num_rows // max(b.nbytes, 1))
            for at in range(0, b.num_rows, step):
                some = b.slice(at, step)
                for name, x in zip(some.column(0).to_pylist(), encode(some.column(1)), strict=True):
                    ids.append(x)
                    names.append(name)
                    held += len(x)
                    if held >= shard_tokens:
                        yield close()
        if names:
            yield close()

    return materialize(rows.mapInArrow(write, "part long, seq long, path string, docs long, tokens long"), "token-shards")


def read_tokens(files: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document of the shards that write_tokens returned: id, start (ids of all
    documents before it), n_tokens, ids_crc32 (of its ids as little-endian 32-bit numbers)."""
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    placed = files.withColumn("within", F.coalesce(F.sum("tokens").over(before), F.lit(0))).join(parts, "part")
    placed = placed.select("path", (F.col("base") + F.col("within")).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(path)
        for b in batches:
            for name, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with store.open_input_stream(name) as f:
                    m, docs, starts = read_shard(f.read())
                ids = memoryview(m.decode().astype("<u4")).cast("B")
                ends = starts.tolist()
                crc = [zlib.crc32(ids[4 * a : 4 * z]) for a, z in zip(ends[:-1], ends[1:], strict=True)]
                arrays = [pa.array(docs, pa.int64()), pa.array(starts[:-1] + base), pa.array(np.diff(starts)), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "start", "n_tokens", "ids_crc32"])

    n = files.count()
    dealt = placed.repartition(max(1, min(n, 10_000)), "path")
    return dealt.mapInArrow(read, f"{id_col} long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """docs written to new shards in the shared folder and read back."""
    path = shared_dir(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, path, tokenizer), path)

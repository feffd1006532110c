"""Stupid-backoff scores of documents under an n-gram model of a corpus, by default their own.

S(w | u v) is c(u v w) / c(u v) where the corpus has the n-gram at least ``min_count``
times, else alpha * S(w | v), down to c(w) / N; a word that the corpus lacks counts as
one. The first words of a document have the context there is. Words are runs of bytes
other than space and \\x09-\\x0D with A-Z lower-cased; a score is the sum of log S.

Three steps, as relations. The n-grams of all orders are exploded, combined in blocks of
documents and dealt by hash: a row is what one block has for one part of the hashes. Each
part adds its rows up to its piece of the count table and joins it to the same rows, so
every block gets the counts of its n-grams back. There they are looked up for each word
and summed per document. An n-gram that every document has is one entry a block, so no
key is hot. A block closes by words and by documents, so its size is fixed; a part's rows have
one entry of a common n-gram from every block.

Texts are read once: a block comes with its n-grams out of one pass, travels beside them and meets their
counts, so that a task that is run again, on rows in another order, brings a block and n-grams that belong together.

N-grams are told apart by BITS bits of a hash within a part, which another hash chooses, and words by 64 bits. As parts
have a fixed size, about one n-gram in 2 * 10^9 shares its count with another, whatever the size of the
corpus. Within a block they are told apart by their words.

Defined results: null and empty texts have no words and score 0; rows that repeat an id
or a text are documents of their own, and each counts in the corpus; an empty table gives
no rows. A task holds the words of BLOCK_WORDS words or BLOCK_DOCS documents, or of one document if it has more.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema

ALPHA = 0.4
ORDER = 3
MIN_COUNT = 1
#: Words at which a block of documents closes, and documents.
BLOCK_WORDS = 3 << 19
BLOCK_DOCS = 1 << 16
#: Exploded n-grams in a part of the count table, about.
PART_GRAMS = 1 << 21
#: Bits of an n-gram's hash that are kept beside its part.
BITS = 52
#: A word's hash.
DIGEST = np.dtype("<u8")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def pack(x: np.ndarray) -> bytes:
    """Unsigned numbers by byte: how many bytes each needs and how long each plane is, then the planes of all lowest bytes, all
    next ones. Each is compressed alone, as those of one hash's high and low bytes have nothing in common."""
    x = np.ascontiguousarray(x, "<u8")
    k = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = [zstandard.compress(p.tobytes(), 1) for p in x.view(np.uint8).reshape(-1, 8)[:, :k].T]
    return bytes([k]) + np.array([len(p) for p in planes], "<u4").tobytes() + b"".join(planes)


def unpack(data: bytes) -> np.ndarray:
    ends = 1 + 4 * data[0] + np.cumsum(np.frombuffer(data, "<u4", data[0], 1))
    planes = [np.frombuffer(zstandard.decompress(data[i:j]), np.uint8) for i, j in zip([1 + 4 * data[0], *ends[:-1].tolist()], ends.tolist(), strict=True)]
    out = np.zeros((len(planes[0]), 8), np.uint8)
    out[:, : len(planes)] = np.stack(planes, axis=1)
    return out.view("<u8").ravel()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(29))


class Block:
    """The words of some documents: words[i] indexes kinds, numbered as they come up first, sizes has each document's number of words."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, kinds: list[bytes]):
        self.words, self.sizes, self.kinds = words.astype(np.int32), sizes.astype(np.int64), kinds
        self.digests = np.fromiter(map(xxhash.xxh3_64_intdigest, kinds), DIGEST, len(kinds))
        self.place = np.arange(len(words), dtype=np.int32) - np.repeat((np.cumsum(self.sizes) - self.sizes).astype(np.int32), self.sizes)

    def laid(self) -> dict[str, bytes]:
        """The block in little room: a word that comes up first is 0, as its number is the next one, and the kinds are text,
        which takes half the room of their hashes."""
        new = np.diff(np.maximum.accumulate(self.words), prepend=-1) > 0
        return {"words": pack(np.where(new, 0, self.words + 1)), "sizes": pack(self.sizes), "kinds": zstandard.compress(b"\n".join(self.kinds), 3)}

    @classmethod
    def read(cls, words: bytes, sizes: bytes, kinds: bytes) -> Block:
        w = unpack(words).astype(np.int64) - 1
        new = w < 0
        w[new] = np.arange(new.sum())
        return cls(w, unpack(sizes), zstandard.decompress(kinds).split())

    def grams(self, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """For n from 1 to order, the n-gram that each word ends: a number among this block's n-grams of all
        orders, -1 where the document is too short. Then the n-grams' frequencies and their two hashes."""
        kinds, base = len(self.digests), 0
        at, times = [self.words], [np.bincount(self.words, minlength=kinds).astype(np.int32)]
        keys, deals = [self.digests], [_mixed(self.digests * _A)]
        for n in range(2, order + 1):
            ends = np.flatnonzero(self.place >= n - 1)
            pair = (at[-1][ends - 1].astype(np.int64) - base) * kinds + self.words[ends]
            pair, of, f = np.unique(pair, return_inverse=True, return_counts=True)
            head, tail = np.divmod(pair, max(kinds, 1))
            keys.append(_mixed(keys[-1][head] * _A + keys[0][tail]))
            deals.append(_mixed(deals[-1][head] * _B + deals[0][tail]))
            base += len(times[-1])
            here = np.full(len(self.words), -1, np.int32)
            here[ends] = base + of
            at.append(here)
            times.append(f.astype(np.int32))
        return at, np.concatenate(times), np.concatenate(keys), np.concatenate([d >> np.uint64(32) for d in deals])


def dealt(keys: np.ndarray, deals: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams in order of part and hash, their hashes in that order, and where each part begins."""
    h = keys >> np.uint64(64 - BITS)
    order = np.argsort(h).astype(np.int32)
    part = (deals[order] * np.uint64(parts) >> np.uint64(32)).astype(np.uint16 if parts <= 1 << 16 else np.uint32)
    order = order[np.argsort(part, kind="stable")]
    return order, h[order], np.concatenate(([0], np.cumsum(np.bincount(part, minlength=parts))))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, Block]]:
    """(number, ids, block) of a task's documents (id, text), in their order, so that each pass over them finds the same blocks."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    index: defaultdict = defaultdict(count().__next__)
    ids: list[pa.Array] = []
    words: list[np.ndarray] = []

    def close() -> tuple[int, pa.Array, Block]:
        return number, pa.concat_arrays(ids), Block(np.concatenate(words), np.array([len(w) for w in words]), list(index))

    held = 0
    for b in batches:
        begun = 0
        for i, text in enumerate(b.column(1)):
            found = text.as_py().lower().split()
            words.append(np.fromiter(map(index.__getitem__, found), np.int32, len(found)))
            held += len(found)
            if held >= BLOCK_WORDS or len(words) >= BLOCK_DOCS:
                ids.append(b.column(0).slice(begun, i + 1 - begun))
                yield close()
                index, ids, words, held, begun, number = defaultdict(count().__next__), [], [], 0, i + 1, number + 1
        ids.append(b.column(0).slice(begun))
    if words:
        yield close()


#: Of a block's own row; null in those of its n-grams.
LAID = ("ids", "words", "sizes", "kinds")


def exploded(texts: DataFrame, order: int, parts: int, counted: bool = True, laid: bool = True) -> DataFrame:
    """(part, block, hashes, times): each block's n-grams by part, of texts (id, text); times is null if they are only asked for.

    laid: with a row of its own for each block, its number below zero as the part: the ids, words, sizes and kinds of words.
    """
    arrow = arrow_schema(_schema(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = lambda **x: pa.RecordBatch.from_arrays([pa.array([x.get(f.name)], f.type) for f in arrow], schema=arrow)
        for number, ids, block in _blocks(batches):
            _, times, keys, deals = block.grams(order)
            by, h, begins = dealt(keys, deals, parts)
            if laid:
                yield row(part=-1 - number, block=number, ids=ids.to_pylist(), **block.laid())
            for p in np.flatnonzero(np.diff(begins)).tolist():
                at = slice(begins[p], begins[p + 1])
                yield row(part=p, block=number, hashes=pack(np.diff(h[at], prepend=np.uint64(0))), times=pack(times[by[at]]) if counted else None)

    return texts.mapInArrow(run, _schema(texts))


def _schema(texts: DataFrame) -> str:
    kind = texts.schema["id"].dataType.simpleString()
    return f"part long, block long, hashes binary, times binary, ids array<{kind}>, words binary, sizes binary, kinds binary"


def counts(rows: DataFrame) -> DataFrame:
    """rows with the counts of their n-grams for hashes and times: the count table of each part, joined to what blocks have there. Blocks' own rows stay."""

    def join(t: pa.Table) -> pa.Table:
        kept = t.select(["block", "part", *LAID])
        if t.column("part")[0].as_py() < 0:
            return kept.append_column("counts", pa.nulls(len(t), pa.binary()))
        h = [np.cumsum(unpack(x.as_py()), dtype=np.uint64) for x in t.column("hashes")]
        times = [unpack(x.as_py()) if x.is_valid else np.zeros(len(y)) for x, y in zip(t.column("times"), h, strict=True)]
        kinds, of = np.unique(np.concatenate(h), return_inverse=True)
        total = np.bincount(of, np.concatenate(times).astype(float), len(kinds)).astype(np.uint64)[of]
        ends = np.cumsum([len(x) for x in h])
        found = [pack(total[z - len(x) : z]) for x, z in zip(h, ends, strict=True)]
        return kept.append_column("counts", pa.array(found, pa.binary()))

    kind = rows.schema["ids"].dataType.simpleString()
    return rows.groupBy("part").applyInArrow(join, f"block long, part long, ids {kind}, words binary, sizes binary, kinds binary, counts binary")


def _scored(block: Block, c: list[np.ndarray], total: int, alpha: float, min_count: int) -> list[np.ndarray]:
    """n_backoff, n_single and score by document. c[n - 1]: the count of the n-gram that each word ends, 0 where there is none."""
    full = np.minimum(block.place + 1, len(c))
    scores, backed = np.zeros(len(full)), np.zeros(len(full), bool)
    single, left = np.zeros(len(full), bool), np.ones(len(full), bool)
    for n in range(len(c), 0, -1):
        single |= (full == n) & (c[n - 1] == 1)
        now = left & (full >= n) & ((c[n - 1] >= min_count) if n > 1 else True)
        i = np.flatnonzero(now)
        under = np.log(np.maximum(c[n - 2][i - 1], 1)) if n > 1 else math.log(max(total, 1))
        scores[i] = np.log(np.maximum(c[n - 1][i], 1)) - under + (full[i] - n) * math.log(alpha)
        backed[i] = full[i] > n
        left &= ~now
    of, n = np.repeat(np.arange(len(block.sizes)), block.sizes), len(block.sizes)
    return [np.bincount(of, backed, n).astype(np.int64), np.bincount(of, single, n).astype(np.int64), np.bincount(of, scores, n).astype(float)]


def score(
    docs: DataFrame, corpus: DataFrame | None = None, order: int = ORDER, alpha: float = ALPHA, min_count: int = MIN_COUNT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, n_words, n_backoff (words scored by a shorter n-gram than there was
    room for), n_single (words whose longest n-gram the corpus has once), score.

    corpus: the table that the model is of, with the same text column; None: docs.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = lambda d: d.agg(F.sum(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] or 0
    total = words(docs if corpus is None else corpus)
    parts = max(1, -(-order * (total if corpus is None else total + words(docs)) // PART_GRAMS))
    own = docs.select(F.col(id_col).alias("id"), text.cast("binary").alias("text"))
    rows = exploded(own, order, parts, corpus is None)
    if corpus is not None:
        known = exploded(corpus.select(F.lit(None).cast(docs.schema[id_col].dataType).alias("id"), text.cast("binary").alias("text")), order, parts, laid=False)
        rows = rows.unionByName(known.withColumn("block", F.lit(-1).cast("long")))
    kind = docs.schema[id_col].dataType.simpleString()

    def finish(t: pa.Table) -> pa.Table:
        part = t.column("part").to_numpy()
        rows = np.argsort(part).tolist()  # the block itself, then its parts
        me = {c: t.column(c)[rows[0]] for c in LAID}
        block = Block.read(*[me[c].as_py() for c in LAID[1:]])
        at, _, keys, deals = block.grams(order)
        n = np.zeros(len(keys) + 1, np.int64)  # the last is for words without an n-gram
        if len(keys):
            found = t.column("counts")
            n[dealt(keys, deals, parts)[0]] = np.concatenate([unpack(found[r].as_py()) for r in rows[1:]])
        backed, single, sums = _scored(block, [n[x] for x in at], total, alpha, min_count)
        return pa.table([me["ids"].values, block.sizes, backed, single, sums], names=[id_col, "n_words", "n_backoff", "n_single", "score"])

    back = counts(rows).filter("block >= 0")
    return back.groupBy("block").applyInArrow(finish, f"{id_col} {kind}, n_words long, n_backoff long, n_single long, score double")

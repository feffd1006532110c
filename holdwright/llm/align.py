"""Two tokenizers' ids of the same text, aligned where both end a token.

Both encode the whole text. Every end that both share closes a group of ids, and links the two tokens that end there;
ends are compared in numpy over many texts at once. The bytes of each side's tokens, joined, must
be the text's own, or it has no tokens.

How often the corpus links a pair of ids is counted by Spark: documents are laid in blocks, a
block has a row for each of its pairs, those are summed by pair and joined back, and each block
adds its documents up from its own counts. A pair that every document has is one row a block.

Blocks are written once and read by both steps, so that numbers within them can't differ
between two readings. A block closes by links, by bytes of text and by documents, so no task grows with the corpus;
a text longer than that is a block of its own.

Defined results: null and empty texts, and those whose tokens' bytes are not the text's (a tokenizer
that changes it), have zeros and no groups; rows that repeat an id or a text are
documents of their own and all count; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, materialize

#: Links, bytes and documents at which a block closes.
BLOCK_LINKS = 1 << 19
BLOCK_BYTES = 1 << 22
BLOCK_DOCS = 1 << 13
#: Tokens whose text form is made at once, about; a document's are not parted.
MEMO = 1 << 16
#: Bytes of text that are encoded together, about.
CHUNK = 1 << 20
#: Fixed value: how byte-level tokenizers cut a text before merging.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Below U+3000 the two libraries' classes of letters, numbers and spaces agree, which a test holds.
COMMON = re.compile("[^\u0000-\u2fff]")
SPACE_MARK = "▁"


class Tokens:
    """What is known of a vocabulary: each id's bytes and their number."""

    def __init__(self, of: dict[int, bytes]):
        n = max(of, default=0) + 1
        self.raw = [of.get(i, b"") for i in range(n)]
        self.size = np.array([len(x) for x in self.raw], np.int64)
        self.kind = np.dtype(np.uint16 if n <= 1 << 16 else np.uint32)
        # An id as text with a comma behind it, then all once more with the mark that ends its side of a group.
        self.told = {stop: [f"{i}," for i in range(n)] + [f"{i}{stop}" for i in range(n)] for stop in "|;"}


class ByteTokens(Tokens):
    """A byte-level BPE of the tokenizers library. Where its ids are the order of its merges, texts of common
    characters go through tiktoken, which gives the same ids about five times as fast."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.full.encode_special_tokens = True
        told = json.loads(self.full.to_str())
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        of = {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(sorted(set(range(256)) - set(shown)))}
        special = {x["content"] for x in told["added_tokens"]}
        vocabulary = told["model"]["vocab"]
        known = {i: bytes(of[c] for c in w) for w, i in vocabulary.items() if w not in special}
        super().__init__(known)
        merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in told["model"]["merges"]]
        before = told["pre_tokenizer"]
        plain = told["normalizer"] is None and before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        self.quick = None
        if plain and merged == list(range(256, 256 + len(merged))) and not told["model"]["ignore_merges"]:
            import tiktoken

            self.quick = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks={b: i for i, b in known.items()}, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        texts = [f" {t}" for t in texts]
        out: list = [None] * len(texts)
        if self.quick:
            out = [None if COMMON.search(t) else self.quick.encode_to_numpy(t, disallowed_special=()).astype(self.kind) for t in texts]
        rest = [k for k, x in enumerate(out) if x is None]
        for k, e in zip(rest, self.full.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False), strict=True):
            out[k] = np.array(e.ids, self.kind)
        return out


class PieceTokens(Tokens):
    """A sentencepiece model, which adds the space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        pieces = {i: m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i))}
        super().__init__({i: bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in pieces.items()})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, self.kind) for x in self.model.encode(texts, num_threads=1)] if texts else []


def spelled(t: Tokens, ids: np.ndarray, raw: bytes) -> bool:
    """Whether the tokens' bytes are the text's; one without bytes is none of a text's."""
    return bool(t.size[ids].all()) and b"".join(map(t.raw.__getitem__, ids.tolist())) == raw


class Memo:
    """What a task keeps of both vocabularies: each id's text forms, first's, then second's."""

    def __init__(self, a: Tokens, b: Tokens):
        self.told, self.second = a.told["|"] + b.told[";"], len(a.told["|"])


def aligned(a: Tokens, b: Tokens, memo: Memo, docs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Of texts, each its ids in a and in b with the same bytes: the digests of their groups, the groups' numbers, and the
    pairs of ids that end together (a's in the upper half), text by text."""
    ids = [np.concatenate(x) for x in zip(*docs, strict=True)]
    ends = [np.cumsum(t.size[x]) for t, x in zip((a, b), ids, strict=True)]
    mark = np.zeros(int(ends[0][-1]) + 1, np.uint8)
    mark[ends[0]] = 1
    mark[ends[1]] |= 2
    shared = [mark[x] == 3 for x in ends]
    last_a, last_b = (np.flatnonzero(x) for x in shared)
    pairs = ids[0][last_a].astype(np.int64) << 32 | ids[1][last_b].astype(np.int64)
    # Tokens in the order of the text form: by group, a's before b's. A token's place is its own and that of the other side's before it.
    group_a, group_b = (np.cumsum(x) - x for x in shared)
    told = np.empty(len(ids[0]) + len(ids[1]), np.int64)
    told[np.arange(len(ids[0])) + np.concatenate(([0], last_b + 1))[group_a]] = ids[0].astype(np.int64) + shared[0] * len(a.raw)
    told[np.arange(len(ids[1])) + (last_a + 1)[group_b]] = ids[1].astype(np.int64) + shared[1] * len(b.raw) + memo.second
    words = list(map(memo.told.__getitem__, told.tolist()))
    stops = np.cumsum([len(x) + len(y) for x, y in docs]).tolist()
    sha = [hashlib.sha256("".join(words[i:j])[:-1].encode()).hexdigest() for i, j in zip([0, *stops[:-1]], stops, strict=True)]
    groups = np.diff(np.cumsum(shared[0])[np.cumsum([len(x) for x, _ in docs]) - 1], prepend=0)
    return sha, groups, pairs


DOC = "n_a long, n_b long, n_groups long, groups_sha256 string, links array<int>, times array<int>"
#: Of a block: its pairs of ids and how often it links them; a document's links are their numbers.
PAIRS = "a array<int>, b array<int>, n array<long>"


class Block:
    """Documents that are laid together: their id, and their ids in both vocabularies (None: no tokens)."""

    def __init__(self, number: int):
        self.number = number
        self.docs: list[tuple] = []
        self.links = self.bytes = 0

    def rows(self, a: Tokens, b: Tokens, memo: Memo) -> Iterator[dict]:
        some, held, sha, groups, pairs = [], 0, [], [], []
        full = [(x, y) for _, x, y in self.docs if x is not None]
        for k, (x, y) in enumerate(full):
            some.append((x, y))
            held += len(x) + len(y)
            if held >= MEMO or k == len(full) - 1:
                for out, more in zip((sha, groups, pairs), aligned(a, b, memo, some), strict=True):
                    out.append(more)
                some, held = [], 0
        sha = [x for xs in sha for x in xs]
        many = np.concatenate([np.zeros(0, np.int64), *groups])
        kinds, of = np.unique(np.concatenate([np.zeros(0, np.int64), *pairs]), return_inverse=True)
        # Each document's different links, all documents at once.
        keys, times = np.unique(np.repeat(np.arange(len(many)), many) * len(kinds) + of, return_counts=True)
        doc, links = np.divmod(keys, max(len(kinds), 1))
        begins = np.searchsorted(doc, np.arange(len(many) + 1)).tolist()
        k = 0
        for i, x, y in self.docs:
            row = {"block": self.number, "id": i, "n_a": 0, "n_b": 0, "n_groups": 0, "groups_sha256": "", "links": [], "times": []}
            if x is not None:
                at = slice(begins[k], begins[k + 1])
                row |= {"n_a": len(x), "n_b": len(y), "n_groups": int(many[k]), "groups_sha256": sha[k], "links": links[at], "times": times[at]}
                k += 1
            yield row
        yield {"block": self.number, "a": kinds >> 32, "b": kinds & 0xFFFFFFFF, "n": np.bincount(of, minlength=len(kinds))}


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0), batch.column(1), strict=True):
            ids.append(i.as_py())
            texts.append(text.as_py() or "")
            held += len(texts[-1])
            if held >= CHUNK or len(ids) >= BLOCK_DOCS:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _blocks(batches: Iterator[pa.RecordBatch], a: Tokens, b: Tokens, first: int) -> Iterator[Block]:
    block = Block(first)
    for ids, texts in _chunks(batches):
        raws = [f" {t}".encode() if t else b"" for t in texts]
        full = [k for k, t in enumerate(texts) if t]
        of_a, of_b = (dict(zip(full, t.encode([texts[k] for k in full]), strict=True)) for t in (a, b))
        for k, i in enumerate(ids):
            x, y = of_a.get(k), of_b.get(k)
            if x is None or not (spelled(a, x, raws[k]) and spelled(b, y, raws[k])):
                x = y = None
            block.docs.append((i, x, y))
            block.links += 0 if x is None else min(len(x), len(y))
            block.bytes += len(raws[k])
            if block.links >= BLOCK_LINKS or block.bytes >= BLOCK_BYTES or len(block.docs) >= BLOCK_DOCS:
                yield block
                block = Block(block.number + 1)
    if block.docs:
        yield block


def lay(docs: DataFrame, byte_path: str, piece_path: str, id_col: str, text_col: str) -> DataFrame:
    """A row for each document, and one for each block with its pairs, not yet counted over the corpus."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"block long, id {kind}, {DOC}, {PAIRS}"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a, b = ByteTokens(byte_path), PieceTokens(piece_path)
        memo = Memo(a, b)
        for block in _blocks(batches, a, b, TaskContext.get().partitionId() << 32):
            rows = list(block.rows(a, b, memo))
            yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in arrow], schema=arrow)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def align(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose count is the highest
    of their piece's id), count_sum (of the links' counts over the corpus), groups_sha256.

    byte_path: a byte-level BPE for the tokenizers library (a); piece_path: a sentencepiece model (b).
    """
    kind = docs.schema[id_col].dataType.simpleString()
    laid = materialize(lay(docs, byte_path, piece_path, id_col, text_col), "aligned")
    pairs = laid.filter("a IS NOT NULL").select(F.col("block").alias("of"), F.posexplode(F.arrays_zip("a", "b", "n")).alias("k", "p")).select("of", "k", "p.*")
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("linked"))
    counts = counts.withColumn("best", F.col("linked") == F.max("linked").over(Window.partitionBy("b")))
    found = pairs.select("of", "k", "a", "b").join(counts, ["a", "b"]).select("of", "k", "linked", "best")

    def finish(rows: pa.Table, found: pa.Table) -> pa.Table:
        linked, best = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
        k = found.column("k").to_numpy()
        linked[k], best[k] = found.column("linked").to_numpy(), found.column("best").to_numpy(zero_copy_only=False)
        w, times = (rows.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("links", "times"))
        doc = np.repeat(np.arange(len(rows)), pc.list_value_length(rows.column("links")).to_numpy())
        sums = []
        for x in (linked, best):
            total = np.zeros(len(rows), np.int64)
            np.add.at(total, doc, x[w] * times)
            sums.append(total)
        n = rows.column("n_groups")
        out = [rows.column("id"), rows.column("n_a"), rows.column("n_b"), n, n, pa.array(sums[1]), pa.array(sums[0]), rows.column("groups_sha256")]
        return pa.table(out, names=[id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    out = f"{id_col} {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    rows = laid.filter("a IS NULL").select("block", "id", "n_a", "n_b", "n_groups", "groups_sha256", "links", "times")
    return rows.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(finish, out)

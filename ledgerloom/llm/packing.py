"""Packing along a space-filling curve.

A document is tokenised once; its hashed token vector is projected to three dimensions, whose
quantised point has a Hilbert key. Tokenised documents are written to the shared folder, range-sorted
by (key, doc_id, row), and each range is cut into sequences of ``SEQ`` tokens: neighbours on the
curve share sequences, documents are cut wherever a sequence ends, and only the last sequence of a
range is short.

Defined cases: a null or empty text is the end id alone; repeated rows are packed as often as they
occur; ties on the curve go by doc_id (nulls first), then row; an empty table gives an empty result;
other columns are ignored. A very long text is encoded whole in one task and is one row of 2 bytes a token.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import common as C

SEQ = 2048
END_ID = 1
DIMS, BITS = 3, 10
#: Tokens of a range: bounds what a task sorts, and sets how many short sequences there are.
RANGE_TOKENS = 8 << 20

_encoders: dict[tuple[str, str], "Encoder"] = {}


class _Odd(Exception):
    """White space that the pre-tokeniser does not treat chunk by chunk."""


class _Chunks(C.Memo):
    """Ids of chunks, each with ``before`` in front, as little-endian 16-bit bytes."""

    def __init__(self, piece, before: str):
        def make(chunk: str) -> bytes:
            if not chunk or chunk != chunk.strip():
                raise _Odd
            return np.array(piece(before + chunk), "<u2").tobytes()

        super().__init__(make)


class Encoder:
    """Token ids of whole texts as little-endian 16-bit bytes.

    The byte-level pre-tokeniser splits before every blank and around every line end, so a text whose
    white space is single blanks and single line ends is encoded chunk by chunk, from memory where a
    chunk is known. Other texts are encoded whole, and one that names a special token goes through
    the tokenizer itself.
    """

    def __init__(self, tokenizer_file: str, rank_file: str):
        import base64
        import json

        import public_tokenizers
        import tiktoken

        self.file, self.loaded = public_tokenizers.path(tokenizer_file), None
        with open(self.file, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        with open(public_tokenizers.path(rank_file), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        self.piece = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary
        self.newline = np.array(self.piece("\n"), "<u2").tobytes()
        self.forget()

    def forget(self) -> None:
        """Drop what was remembered of the texts of a task."""
        self.first, self.after = _Chunks(self.piece, ""), _Chunks(self.piece, " ")

    def whole(self, text: str) -> list[int]:
        if self.loaded is None:
            from tokenizers import Tokenizer

            self.loaded = Tokenizer.from_file(self.file)
        return self.loaded.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.whole(text), "<u2").tobytes()
        if not text:
            return b""
        lines = text.split("\n")
        end = self.newline if len(lines) > 1 and not lines[-1] and lines[-2] else b""
        first, after = self.first, self.after.__getitem__
        try:
            if end:
                lines.pop()
            return self.newline.join([first[(words := line.split(" "))[0]] + b"".join(map(after, words[1:])) for line in lines]) + end
        except _Odd:
            return np.array(self.piece(text), "<u2").tobytes()


def encoder(tokenizer_file: str, rank_file: str) -> Encoder:
    key = (tokenizer_file, rank_file)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Keys of integer points (rows of ``points``) along a Hilbert curve of ``bits`` bits a dimension."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess work of the Gray code, from the top bit down
        low = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & low
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] = np.where(on, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


class Projection:
    """Token ids to a point: hashed square-root frequencies of unit length, projected at random."""

    def __init__(self, seed: int, buckets: int = 4096):
        rng = np.random.default_rng(seed)
        self.bucket = rng.integers(0, buckets, 1 << 16)
        self.axes = rng.standard_normal((buckets, DIMS))
        self.buckets = buckets

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        v = np.sqrt(np.bincount(self.bucket[ids], minlength=self.buckets))
        x = v @ self.axes / max(1.0, float(np.sqrt(v @ v)))
        return np.minimum((1 << BITS) / (1 + np.exp(-1.702 * x)), (1 << BITS) - 1).astype(np.int64)


TOKENISED = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])
PIECES = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def tokenised(docs: DataFrame, doc_id: str, text: str, tokenizer_file: str, rank_file: str, seed: int) -> DataFrame:
    end = np.array([END_ID], "<u2").tobytes()

    def run(batches):
        encode, project = encoder(tokenizer_file, rank_file), Projection(seed)
        for batch in C.slices(batches):
            ids = [encode(x) + end for x in C.strings(batch.column("text"))]
            arrays = [np.frombuffer(x, "<u2") for x in ids]
            keys = hilbert(np.stack([project(a) for a in arrays]), BITS)
            yield pa.record_batch([batch.column("doc_id"), batch.column("rid"), pa.array(keys), pa.array([len(a) for a in arrays], pa.int64()), pa.array(ids, pa.binary())], schema=TOKENISED)
        encode.forget()

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("rid"), F.col(text).alias("text"))
    return slim.mapInArrow(run, "doc_id long, rid long, key long, n long, ids binary")


def cut(batches):
    """Pieces of the documents of one range, in order, in sequences of SEQ tokens."""
    from pyspark import TaskContext

    first, at = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        out = [[] for _ in PIECES]
        for doc, n, ids in zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            wide, start = memoryview(np.frombuffer(ids, "<u2").astype("<u4").tobytes()), 0
            while start < n:
                size = min(n - start, SEQ - at % SEQ)
                for column, x in zip(out, (doc, start, size, zlib.crc32(wide[4 * start : 4 * (start + size)]), n, first + at // SEQ, at % SEQ), strict=True):
                    column.append(x)
                start += size
                at += size
        yield pa.record_batch([pa.array(c, pa.int64()) for c in out], schema=PIECES)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer_file: str = "byte_bpe_50k.json", rank_file: str = "byte_bpe_50k.tiktoken", seed: int = 11, range_tokens: int = RANGE_TOKENS) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer_file`` and ``rank_file`` are two forms of one vocabulary, by their public names.
    """
    staged = C.stage(tokenised(docs, doc_id, text, tokenizer_file, rank_file, seed), "pack-tokens", "zstd")
    total = staged.agg(F.sum("n")).first()[0] or 0
    ranges = max(1, -(-total // range_tokens))
    ordered = staged.repartitionByRange(ranges, "key", "doc_id", "rid").sortWithinPartitions("key", "doc_id", "rid")
    return ordered.mapInArrow(cut, ", ".join(f"{c} long" for c in PIECES.names))

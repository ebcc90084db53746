"""Packing by concatenate-and-cut: prefix sums over partition token totals, then fixed windows.

First pass: each task tokenises its partition once, writes the ids and, per document, the number of ids of
the partition before it. The partitions' totals (one row each) are summed up in order, which gives every
document its place in the one long stream of ids. Second pass: the stored ids are cut at multiples of the
window. No text or id is shuffled. Only the last sequence may be short.

Defined results: the strings of ``SPECIALS`` become their ids, as in the tokenizer file. A null text is empty and holds the end id alone. Repeated rows are packed as often as they
occur. An empty table gives no pieces. Extra columns are ignored. Order is that of the partitions and rows read.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskframe.sources.staging import stage

WINDOW = 2048
END_ID = 1
SPECIALS = {"<|endoftext|>": 50256}  # the added tokens of the tokenizer file
_ROWS = 256  # documents held as ids at a time
_SLICE = 1 << 20  # characters tokenised at a time
_SAFE_CUT = re.compile(r"\S(?= [^\W\d_])")  # no token spans the place before a blank between a sign and a letter


@functools.lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> tiktoken.Encoding:
    """Byte-level BPE from a rank file, without special tokens."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, bpe: tiktoken.Encoding) -> np.ndarray:
    """The ids of a text as little-endian unsigned 32-bit integers; long texts go slice by slice."""
    parts, at = [], 0
    while len(text) - at > _SLICE:
        cut = _SAFE_CUT.search(text, at + _SLICE)
        if cut is None:
            break
        parts.append(np.array(bpe.encode_ordinary(text[at:cut.end()]), dtype="<u4"))
        at = cut.end()
    parts.append(np.array(bpe.encode_ordinary(text[at:] if at else text), dtype="<u4"))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


_SPECIAL = re.compile(f"({'|'.join(map(re.escape, SPECIALS))})")


def token_ids(text: str, bpe: tiktoken.Encoding) -> np.ndarray:
    """The ids of a text in which special tokens' strings stand for their ids."""
    parts = [np.array([SPECIALS[t]], dtype="<u4") if t in SPECIALS else encode(t, bpe) for t in _SPECIAL.split(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _stored(bpe: tiktoken.Encoding) -> str:
    return "<u2" if max(bpe.n_vocab - 1, *SPECIALS.values()) < 1 << 16 else "<u4"


def tokenised(docs: DataFrame, path: str, pattern: str, end_id: int = END_ID, doc_id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """doc_id, part (partition), before (ids of the partition before the document), n, ids."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, before = tokenizer(path, pattern), TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                block = batch.slice(lo, _ROWS)
                ids = [np.append(token_ids(t or "", bpe), np.uint32(end_id)) for t in block.column("text").to_pylist()]
                n = np.array([len(x) for x in ids], dtype=np.int64)
                starts = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), pa.array(np.full(len(n), part, dtype=np.int32)), pa.array(starts), pa.array(n),
                     pa.array([x.astype(_stored(bpe)).tobytes() for x in ids], pa.binary())],
                    names=["doc_id", "part", "before", "n", "ids"])

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(
        run, f"doc_id {kind}, part int, before long, n long, ids binary")


def pack(docs: DataFrame, path: str, pattern: str, window: int = WINDOW, end_id: int = END_ID, doc_id: str = "doc_id",
         text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if wanted, ids
    (little-endian unsigned 32-bit). Rows with start > 0 or whose document goes on are the boundary records."""
    spark = docs.sparkSession
    stored = stage(tokenised(docs, path, pattern, end_id, doc_id, text), "tokens")
    totals = stored.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("n")).orderBy("part").collect()
    first = np.cumsum([0, *(r["n"] for r in totals)])
    bases = spark.createDataFrame([(r["part"], int(b)) for r, b in zip(totals, first, strict=False)], "part int, base long")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _stored(tokenizer(path, pattern))
        for batch in batches:
            column = {c: batch.column(c).to_numpy() for c in ("base", "before", "n")}
            for lo in range(0, batch.num_rows, _ROWS):
                rows, pieces = [], []
                for i in range(lo, min(lo + _ROWS, batch.num_rows)):
                    at, n, start = int(column["base"][i] + column["before"][i]), int(column["n"][i]), 0
                    ids = np.frombuffer(batch.column("ids")[i].as_buffer(), dtype=kind).astype("<u4")
                    while start < n:
                        offset = (at + start) % window
                        length = min(n - start, window - offset)
                        piece = ids[start:start + length].tobytes()
                        rows.append((i, start, length, zlib.crc32(piece), n, (at + start) // window, offset))
                        pieces += [piece] if with_ids else []
                        start += length
                made = np.array(rows, dtype=np.int64).T
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(made[0])), *map(pa.array, made[1:]),
                     *([pa.array(pieces, pa.binary())] if with_ids else [])], names=names)

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + (", ids binary" if with_ids else ""))
    names = [c.split()[0] for c in schema.split(", ")]
    return stored.join(F.broadcast(bases), "part").select("doc_id", "base", "before", "n", "ids").mapInArrow(cut, schema)

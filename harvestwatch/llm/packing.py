"""Harmonic packing of documents into fixed-length sequences (operator 4).

Lengths are parted into classes by the reciprocal of the capacity: class ``k``
holds pieces of exactly ``capacity // k`` tokens, and each of its bins takes
``capacity // (capacity // k)`` of them.  Documents may be cut, so a document is cut greedily: the
longest class length that fits, then the same for the rest, which shrinks
quadratically (three cuts on average).  A class's bins hold a fixed number of
pieces, so every worker fills its own bins without knowing the others.  What
is left in unfilled bins at the end of a task, less than one bin per class, is
laid end to end and cut at the capacity; its tail is cut into powers of two,
which need no padding.

One pass, no shuffle: a task holds at most one open bin per class (about ninety
classes for 2048), whatever the input.  Sequence ids carry the partition
number, so they are unique without coordination; a redone task reads the same
split and gives the same ids.

Defined results: a null or empty text is its end-of-document id alone; an empty
table gives no rows; repeated rows are packed separately; a null document id is
carried through.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ._common import prepare, slices, table
from .bpe import _list_array, default_path, load

SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long, ids array<int>")


def cuts(n: int, capacity: int) -> list[int]:
    """Class lengths a document of ``n`` tokens is cut into, in order."""
    out = [capacity] * (n // capacity)
    n %= capacity
    while n:
        size = capacity // -(-capacity // n)
        out.append(size)
        n -= size
    return out


class Packer:
    """Open bins of one task.  Pieces are (doc_id, start, doc_tokens, ids)."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list] = {}
        self.rows: list[tuple] = []

    def _close(self, pieces: list) -> None:
        held, offset = sum(len(p[3]) for p in pieces), 0
        for doc, start, doc_tokens, ids in pieces:
            self.rows.append((doc, start, len(ids), doc_tokens, self.next_id, offset, held, ids))
            offset += len(ids)
        self.next_id += 1

    def add(self, doc, ids: np.ndarray) -> None:
        start = 0
        for size in cuts(len(ids), self.capacity):
            bin_ = self.open.setdefault(size, [])
            bin_.append((doc, start, len(ids), ids[start:start + size]))
            start += size
            if len(bin_) == self.capacity // size:
                self._close(self.open.pop(size))

    def finish(self) -> None:
        left = [p for size in sorted(self.open, reverse=True) for p in self.open[size]]
        total = sum(len(p[3]) for p in left)
        lengths = [self.capacity] * (total // self.capacity)
        lengths += [1 << b for b in reversed(range(self.capacity.bit_length())) if total % self.capacity >> b & 1]
        at = 0
        for length in lengths:
            pieces = []
            while length:
                doc, start, doc_tokens, ids = left[at]
                take = min(length, len(ids))
                pieces.append((doc, start, doc_tokens, ids[:take]))
                left[at] = (doc, start + take, doc_tokens, ids[take:])
                at += take == len(ids)
                length -= take
            self._close(pieces)
        self.open = {}

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows, strict=True)) or [()] * 8
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in columns[:7]], _list_array(list(columns[7]))],
            names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "ids"])


def pack(df: DataFrame, capacity: int = 2048, end_id: int = 1, path: str | None = None,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents with their place in a sequence and their token ids."""
    prepare(df.sparkSession)
    path = path or default_path()

    def run(batches):
        packer = Packer(capacity, TaskContext.get().partitionId() << 36)
        bpe = load(path)
        for batch in batches:
            for part in slices(batch, 1):
                docs = part.column(0).to_pylist()
                for doc, ids in zip(docs, bpe.encode(part.column(1).to_pylist()), strict=True):
                    packer.add(doc, np.append(ids, np.int32(end_id)))
                if packer.rows:
                    yield packer.batch()
        packer.finish()
        yield packer.batch()

    return df.select(df[doc_id].cast("long"), text).mapInArrow(run, SCHEMA)


def _crc32(df: DataFrame) -> DataFrame:
    """Unsigned CRC-32 of each piece's ids as little-endian 32-bit numbers."""
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        for b in batches:
            ids = b.column(b.schema.get_field_index("ids"))
            flat, at = ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False), ids.offsets.to_numpy()
            crc = pa.array([zlib.crc32(flat[i:j].tobytes()) for i, j in zip(at[:-1], at[1:], strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [crc if c == "ids_crc32" else b.column(b.schema.get_field_index(c)) for c in keep], names=keep)

    return df.mapInArrow(run, ", ".join(f"{c} long" for c in keep))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 2048 tokens."""
    return _crc32(pack(table(spark, sf_dir, "documents")))

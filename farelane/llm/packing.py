"""Best-fit packing of tokenised documents into sequences: sum-of-squares packing (operator 5).

A document is its ids by the byte-level BPE, then id 0. Longer ones are cut into pieces of
``CAPACITY`` ids of which the first may be shorter; a full piece is a sequence of its own. All
other pieces are dealt by a hash of their row to blocks of about ``BLOCK`` pieces, whatever the
number of sources or the order of arrival, and each block is packed by one task, largest piece first:
a piece goes to the open bin after which the sum over all residual gaps of the squared number of open
bins with that gap is smallest; ties go to the fullest bin; a new bin is opened only where no open one
has room (opening one to even out the gaps took up to 2 % more sequences). Only the counts by gap are looked at, so a placement costs O(CAPACITY) whatever the number of bins. Bins don't span blocks: what is
lost by that is the last few bins of a block of about 65,000 pieces.

Edges: null text is empty text and gives one piece of one id. Repeated rows and repeated ids are
packed as often as they come. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import default_path, encoder
from .common import prepare, table

CAPACITY = 2048
END = 0
#: Pieces that one task packs.
BLOCK = 65_536
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_ids(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids."""
    head = n % capacity
    starts = [0, *range(head, n, capacity)] if head else list(range(0, n, capacity))
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n], strict=True)]


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """The pieces of every document, without their ids but with a checksum of them."""
    path = path or default_path()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            rows: list[tuple[int | None, int, int, int, int]] = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                ids = np.append(ids, np.uint32(END)).astype("<u4", copy=False)
                rows += [(doc, k, a, n, zlib.crc32(ids[a : a + n])) for k, (a, n) in enumerate(cut_ids(len(ids), capacity))]
            doc, piece, start, length, crc = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.record_batch([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(of, PIECES)


def sum_of_squares(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size, placed largest first; sizes are at most the capacity."""
    count = np.zeros(capacity + 1, np.int64)  # open bins by gap; gaps 0 and capacity are never counted
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, used = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0
    never = np.iinfo(np.int64).max
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        fits = count[s:] > 0
        if fits.any():
            # change of the sum of squares: a bin of gap g becomes one of gap g - s
            change = np.where(fits, 2 * (count[: capacity - s + 1] - count[s:]) + 2, never)
            if fits[0]:
                change[0] = 1 - 2 * count[s]  # a filled bin is no longer open
            gap = int(change.argmin()) + s
            bins[i] = open_bins[gap].pop()
            count[gap] -= 1
        else:
            bins[i], gap, used = used, capacity, used + 1
        offsets[i] = capacity - gap
        if gap > s:
            open_bins[gap - s].append(bins[i])
            count[gap - s] += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """Adds sequence_id and offset to pieces."""
    spark = prepare(pieces.sparkSession)
    held = pieces.withColumn("row", F.monotonically_increasing_id()).checkpoint()  # tokenised once
    part = held.filter(F.col("length") < capacity)
    blocks = max(1, -(-part.count() // block))
    out = f"{PIECES}, sequence_id long, offset long"

    def packed(t: pa.Table) -> pa.Table:
        bins, offsets = sum_of_squares(t.column("length").to_numpy(), capacity)
        first = t.column("block")[0].as_py() << 32
        return t.drop_columns(["block", "row"]).append_column("sequence_id", pa.array(bins + first)).append_column("offset", pa.array(offsets))

    dealt = part.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    full = held.filter(F.col("length") >= capacity).select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return dealt.groupBy("block").applyInArrow(packed, out).unionByName(full)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents")))

"""Which hashes occur more than once anywhere, told to the blocks of documents that hold them.

Documents are dealt into blocks by a hash of the row. A map task packs what it finds, one binary
value per bucket of the hash space, so that Spark moves few large rows instead of one row for
every hash. A bucket's task finds the hashes with a second occurrence and answers each block that
asked. A hash that one task already meets often enough is answered there and sent on a bounded
number of times, so that a hash with a third of all rows does not fill its bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FLUSH = 500_000
LOW = np.uint64(0xFFFFFFFF)
HOT = np.uint64(1 << 63)
ASKED = "bucket int, known boolean, ids binary, blks binary, counts binary"
TOLD = "blk int, ids binary"

#: Of a batch with columns blk and text: hashes, the row of each and, if they may repeat in a row, True.
Finder = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]]


def block_count(spark: SparkSession) -> int:
    """Blocks and buckets: a few for each shuffle task, so that they shrink as the cluster is sized up."""
    return 2 * max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))


def in_blocks(docs: DataFrame, blocks: int, *columns: str) -> DataFrame:
    """(blk, rid, doc_id, text) and further columns; rid is a hash of the row, so equal rows share it."""
    rid = F.xxhash64(F.col("doc_id"), F.col("text"))
    return docs.select(
        F.pmod(rid, F.lit(blocks)).cast("int").alias("blk"), rid.alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text", *columns
    )


def ids_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the upper half, 32 further bits of the hash in the lower one."""
    return ((hashes >> np.uint64(33)) % np.uint64(buckets) << np.uint64(32)) | (hashes & LOW)


def split_by(keys: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Each key with its part of the arrays."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    arrays = [a[order] for a in arrays]
    for low, high in zip(cuts, np.r_[cuts[1:], len(keys)]):
        yield int(keys[low]), [a[low:high] for a in arrays]


def runs(ordered: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values, and the length."""
    return np.r_[np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]), len(ordered)] if len(ordered) else np.zeros(1, np.int64)


def tell(keys: np.ndarray, blks: np.ndarray) -> Iterator[tuple[int, bytes]]:
    for blk, (own,) in split_by(blks, keys):
        yield blk, np.unique(own).tobytes()


def repeated(docs: DataFrame, find: Finder, buckets: int, hot: int = 2, within: bool = False) -> DataFrame:
    """(blk, ids): the ids of hashes that occur in two rows or more (``within``: or twice in one).

    The top bit marks hashes with ``hot`` occurrences or more. Ids hold a bucket and 32 bits of the
    hash: a false alarm is rare and harmless to callers that compare what lies around.
    """

    blk_type = np.uint16 if buckets < 1 << 16 else np.int32

    def ask(hashes: np.ndarray, blks: np.ndarray) -> Iterator[tuple]:
        ids = ids_of(hashes, buckets)
        order = np.argsort(ids, kind="stable")
        ids, blks = ids[order], blks[order]
        cuts = runs(ids)
        size = np.diff(cuts)
        common = np.repeat(size >= hot, size)
        for home, (own, own_blks) in split_by(blks[common] % buckets, ids[common] | HOT, blks[common]):
            cell = np.unique(np.stack([own_blks.astype(np.uint64), own]), axis=1)
            yield home, True, cell[1].tobytes(), cell[0].astype(blk_type).tobytes(), b""
        # One line for each hash and block; of a common hash one line that says so.
        first = cuts[:-1][size >= hot]
        sent = np.r_[ids[~common], ids[first]]
        to = np.r_[blks[~common], blks[first]]
        count = np.r_[np.ones(len(sent) - len(first), np.uint16), np.full(len(first), hot, np.uint16)]
        for bucket, (own, own_blks, n) in split_by((sent >> np.uint64(32)).astype(np.int64), sent, to, count):
            yield bucket, False, (own & LOW).astype(np.uint32).tobytes(), own_blks.astype(blk_type).tobytes(), n.tobytes() if n.max() > 1 else b""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def flush() -> pa.RecordBatch:
            rows = list(ask(np.concatenate([h for h, _ in held]), np.concatenate([b for _, b in held])))
            kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], [x.split()[0] for x in ASKED.split(", ")])

        for batch in batches:
            blks = batch.column("blk").to_numpy(zero_copy_only=False).astype(np.int32)
            for hashes, rows in find(batch):
                if not within and len(hashes):
                    order = np.lexsort((hashes, rows))
                    hashes, rows = hashes[order], rows[order]
                    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])]
                    hashes, rows = hashes[new], rows[new]
                held.append((hashes, blks[rows]))
                waiting += len(hashes)
                if waiting >= FLUSH:
                    yield flush()
                    held, waiting = [], 0
        if waiting:
            yield flush()

    def answer(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = np.uint64(key[0].as_py()) << np.uint64(32)
        ids, blks, counts = [], [], []
        out = []
        for batch in batches:
            for row in batch.to_pylist():
                to = np.frombuffer(row["blks"], blk_type)
                if row["known"]:
                    out += tell(np.frombuffer(row["ids"], np.uint64), to)
                    continue
                ids.append(np.frombuffer(row["ids"], np.uint32))
                blks.append(to)
                counts.append(np.frombuffer(row["counts"], np.uint16) if row["counts"] else np.ones(len(to), np.uint16))
        if ids:
            own, to, n = np.concatenate(ids), np.concatenate(blks), np.concatenate(counts)
            order = np.argsort(own, kind="stable")
            own, to, n = own[order], to[order], n[order].astype(np.int64)
            cuts = runs(own)
            total = np.repeat(np.add.reduceat(n, cuts[:-1]), np.diff(cuts))
            live = total >= 2
            full = own[live].astype(np.uint64) | home
            out += tell(np.where(total[live] >= hot, full | HOT, full), to[live])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["blk", "ids"])

    return docs.mapInArrow(asked, ASKED).groupBy("bucket").applyInArrow(answer, TOLD)


def told_ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All ids told to a block, sorted, and those with the mark."""
    parts = [np.frombuffer(x, np.uint64) for x in table.column("ids").to_pylist() if x]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    hot = (ids & HOT) > 0
    return np.unique(ids & ~HOT), np.unique(ids[hot] & ~HOT)

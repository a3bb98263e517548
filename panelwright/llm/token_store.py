"""Token-id shards with a minimal perfect hash index over document keys.

Shards hold raw ids in ascending ``doc_id`` order behind a 16-byte header.
The index is cut into hash buckets of bounded size; a bucket's file holds a
minimal perfect hash of its keys (levels of collision-free bits and their
ranks) and, per slot, a 32-bit key fingerprint and the document's shard,
offset, length and global start. A lookup computes the bucket, the slot and
one comparison: constant time, and an absent key is rejected by its
fingerprint (false accept 2^-32).

Rows: null text is empty; a null ``doc_id`` sorts first and is a key like any
other; rows that repeat a ``doc_id`` are kept all, keyed by (doc_id, number
of the repeat), in order of their text. An empty table gives no shards.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, columns, commit, runs, shared_path, store, text_of, tmp_name, written
from .wordbpe import ENCODED_ROWS, default_vocabulary, encoder

MAGIC = b"TOKSHRD1"
HEADER, HEADER_BYTES = "<8sII", 16        # magic, bytes per id, reserved
GAMMA = 2.0                              # bits per key of a hash level
LOCATED = "doc_id long, rep long, shard string, offset long, n_tokens long, start long"


# -- minimal perfect hash ------------------------------------------------
def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser; a bijection for each seed."""
    x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(doc_id: np.ndarray, rep: np.ndarray, null: np.ndarray) -> np.ndarray:
    h = mix(doc_id.astype(np.int64).view(np.uint64), 101)
    again = (rep > 0) | null
    h[again] = mix(h[again] ^ mix(rep[again].astype(np.uint64) * np.uint64(2) + null[again].astype(np.uint64), 102), 103)
    return h


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: each level gives a key
    alone in its cell a set bit; the others go to the next level. A key's slot
    is the rank of its bit."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.first = np.cumsum([0, *(int(x.sum()) for x in levels)])
        self.ranks = [np.cumsum(x) - 1 for x in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        levels: list[np.ndarray] = []
        while len(keys):
            if len(levels) > 200:
                raise ValueError("keys repeat")
            size = max(8, int(GAMMA * len(keys)))
            at = (mix(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            n = np.bincount(at, minlength=size)
            levels.append(n == 1)
            keys = keys[n[at] != 1]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for a key that falls through all levels."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for i, bits in enumerate(self.levels):
            if not len(left):
                break
            at = (mix(keys[left], i) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = self.first[i] + self.ranks[i][at[hit]]
            left = left[~hit]
        return out

    def dump(self, f) -> None:
        f.write(struct.pack("<I", len(self.levels)))
        for x in self.levels:
            packed = np.packbits(x)
            f.write(struct.pack("<QQ", len(x), len(packed)))
            f.write(packed.tobytes())

    @classmethod
    def load(cls, f) -> "PerfectHash":
        levels = []
        for _ in range(struct.unpack("<I", f.read(4))[0]):
            n, size = struct.unpack("<QQ", f.read(16))
            levels.append(np.unpackbits(np.frombuffer(f.read(size), np.uint8), count=n).astype(bool))
        return cls(levels)


SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<i8"), ("n_tokens", "<i8"), ("start", "<i8")])


def dump_bucket(keys: np.ndarray, slots: np.ndarray, shards: list[str]) -> bytes:
    """A bucket's index file. ``slots`` are in the order of ``keys``."""
    h = PerfectHash.build(keys)
    rows = np.zeros(len(keys), SLOT)
    rows[h.slots(keys)] = slots
    f = io.BytesIO()
    h.dump(f)
    names = "\n".join(shards).encode()
    f.write(struct.pack("<QQ", len(names), len(rows)))
    f.write(names)
    f.write(rows.tobytes())
    return f.getvalue()


def load_bucket(data: bytes) -> tuple[PerfectHash, np.ndarray, np.ndarray]:
    f = io.BytesIO(data)
    h = PerfectHash.load(f)
    n, rows = struct.unpack("<QQ", f.read(16))
    names = f.read(n).decode().split("\n")
    return h, np.frombuffer(f.read(rows * SLOT.itemsize), SLOT), np.array(names, dtype=object)


# -- shards --------------------------------------------------------------
def _write_shards(path: str, vocabulary: str, end_id: int, width: int, shard_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task = encoder(vocabulary), TaskContext.get().partitionId()
        files, root = store(path)
        end = np.array([end_id], "<u4").tobytes()
        out = name = tmp = None
        k = ids = rep = 0
        last: object = ()
        for b in columns(batches):
            rows = []
            for doc, ids_of in zip(b["doc_id"].to_pylist(), enc.ids_batch(b["text"].to_pylist())):
                rep = rep + 1 if last == (doc,) else 0
                last = (doc,)
                if out is not None and ids >= shard_ids:
                    out.close()
                    commit(files, tmp, f"{root}/{name}")
                    out = None
                if out is None:
                    name, ids = f"shard-{task:06d}-{k:05d}.bin", 0
                    k += 1
                    tmp = tmp_name(f"{root}/{name}")
                    out = files.open_output_stream(tmp)
                    out.write(struct.pack(HEADER, MAGIC, width, 0))
                data = ids_of + end
                n = len(data) // 4
                if width == 2:
                    whole = np.frombuffer(data, "<u4")
                    if whole.max(initial=0) > 0xFFFF:
                        raise ValueError(f"id {whole.max()} does not fit in 2 bytes")
                    data = whole.astype("<u2").tobytes()
                out.write(data)
                rows.append((doc, rep, name, HEADER_BYTES + ids * width, n, ids))
                ids += n
            yield _batch(rows)
        if out is not None:
            out.close()
            commit(files, tmp, f"{root}/{name}")
    return write


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "rep", "shard", "offset", "n_tokens", "start"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def _write_index(path: str):
    def write(batches):
        files, root = store(path)
        for bucket, t in runs(batches, "bucket"):
            null = t["doc_id"].is_null().to_numpy()
            keys = key_hash(t["doc_id"].fill_null(0).to_numpy(), t["rep"].to_numpy(), null)
            names, at = np.unique(t["shard"].to_numpy(), return_inverse=True)
            slots = np.zeros(len(keys), SLOT)
            slots["fingerprint"] = mix(keys, 7) >> np.uint64(32)
            slots["shard"] = at
            for c in ("offset", "n_tokens", "start"):
                slots[c] = t[c].to_numpy()
            name = f"{root}/index-{bucket:07d}.mph"
            with files.open_output_stream(tmp := tmp_name(name)) as f:
                f.write(dump_bucket(keys, slots, list(names)))
            commit(files, tmp, name)
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int64()), "n": pa.array([len(keys)], pa.int64())})
    return write


def _find(path: str):
    def find(batches):
        files, root = store(path)
        at = index = None
        for b in batches:
            if not b.num_rows:
                continue
            bucket = b.column("bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
            for lo, hi in zip(cuts, cuts[1:]):
                if bucket[lo] != at:
                    at, name = bucket[lo], f"{root}/index-{bucket[lo]:07d}.mph"
                    index = None
                    if files.get_file_info(name).size:
                        with files.open_input_file(name) as f:
                            index = load_bucket(f.read())
                if index is None:
                    continue
                h, slots, names = index
                part = b.slice(lo, hi - lo)
                doc, rep = part.column("doc_id"), part.column("rep")
                keys = key_hash(doc.fill_null(0).to_numpy(), rep.to_numpy(), doc.is_null().to_numpy(zero_copy_only=False))
                s = h.slots(keys)
                rows = slots[s]
                ok = np.flatnonzero((s >= 0) & (rows["fingerprint"] == (mix(keys, 7) >> np.uint64(32))))
                rows = rows[ok]
                yield pa.RecordBatch.from_arrays(
                    [doc.take(pa.array(ok)), rep.take(pa.array(ok)), pa.array(names[rows["shard"]], pa.string()),
                     *(pa.array(rows[c]) for c in ("offset", "n_tokens", "start"))],
                    names=["doc_id", "rep", "shard", "offset", "n_tokens", "start"])
    return find


def _read(path: str, with_ids: bool):
    def read(batches):
        files, root = store(path)
        name = f = None
        width = 4
        for b in columns(batches):
            data, crc = [], []
            for shard, offset, n in zip(b["shard"].to_pylist(), b["offset"].to_pylist(), b["n_tokens"].to_pylist()):
                if shard != name:
                    if f:
                        f.close()
                    name, f = shard, files.open_input_file(f"{root}/{shard}")
                    magic, width, _ = struct.unpack(HEADER, f.read(HEADER_BYTES))
                    if magic != MAGIC:
                        raise ValueError(f"{shard} is no token shard")
                f.seek(offset)
                raw = f.read(n * width)
                raw = raw if width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()
                crc.append(zlib.crc32(raw))
                data.append(raw if with_ids else None)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["rep"], b["start"], b["n_tokens"], pa.array(crc, pa.int64()),
                                              pa.array(data, pa.binary())],
                                             names=["doc_id", "rep", "start", "n_tokens", "ids_crc32", "ids"])
        if f:
            f.close()
    return read


@dataclass
class TokenStore:
    spark: SparkSession
    path: str
    buckets: int

    def locate(self, keys: DataFrame) -> DataFrame:
        """Where the documents of (doc_id, rep) are; absent keys give no row."""
        return (_bucketed(keys.select("doc_id", "rep"), self.buckets)
                .repartition("bucket").sortWithinPartitions("bucket")
                .mapInArrow(_find(self.path), LOCATED))

    def read(self, keys: DataFrame, with_ids: bool = True) -> DataFrame:
        """(doc_id, rep, start, n_tokens, ids_crc32, ids) of the keys, read
        from the shards in file order; ids are little-endian unsigned 32-bit
        (null without ``with_ids``, their checksum is taken either way)."""
        return (self.locate(keys).repartitionByRange("shard", "offset").sortWithinPartitions("shard", "offset")
                .mapInArrow(_read(self.path, with_ids), "doc_id long, rep long, start long, n_tokens long, ids_crc32 long, ids binary"))


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "rep"), F.lit(buckets)).cast("long"))


def keys_of(docs: DataFrame) -> DataFrame:
    """One (doc_id, rep) per row of the table."""
    w = Window.partitionBy("doc_id").orderBy("doc_id")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")).withColumn("rep", F.row_number().over(w).cast("long") - 1)


def write_store(docs: DataFrame, vocabulary: str | None = None, end_id: int = 2, id_bytes: int = 2,
                shard_ids: int = 1 << 24, bucket_keys: int = 200_000) -> TokenStore:
    """Encode every text, append ``end_id``, write shards and index.

    ``id_bytes`` is 2 (ids below 65,536) or 4. A task writes the shards of one
    range of ``doc_id``; a shard is closed at ``shard_ids`` ids. Buckets hold
    about ``bucket_keys`` keys.
    """
    spark = docs.sparkSession
    bounded_batches(spark, ENCODED_ROWS)
    path = shared_path(spark, "tokens")
    files, root = store(path)
    files.create_dir(root)
    vocabulary = vocabulary or default_vocabulary()
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    made = (src.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(*order)
            .mapInArrow(_write_shards(path, vocabulary, end_id, id_bytes, shard_ids), LOCATED))
    made = written(made, "token-manifest")
    # one row per shard, far fewer than documents: shard names sort in doc_id order
    shards = made.groupBy("shard").agg(F.sum("n_tokens").alias("ids"), F.count(F.lit(1)).alias("docs"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    rows = shards.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
    buckets = max(1, -(-rows // bucket_keys))
    entries = made.join(base, "shard").withColumn("start", F.col("start") + F.col("base")).drop("base")
    index = (_bucketed(entries, buckets).repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(_write_index(path), "bucket long, n long"))
    indexed = index.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if indexed != rows:
        raise RuntimeError(f"{indexed} of {rows} documents indexed")
    return TokenStore(spark, path, buckets)

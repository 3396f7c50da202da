"""Bloom filters of once- and repeatedly-seen keys, partitioned by ranges of the hash and merged over tasks.

For each range a pair of filters is kept: *once* has every key, *twice* every key that may have come a
second time. Each file of a table sends its distinct hashes, and which of them it has several times,
packed by range; the task of a range adds them file by file, ``twice |= once & new``, and answers each
file with one bit per hash. So a key costs some six bytes and a bit on the way instead of its row, a
filter is sized by the keys of its range however many there are in all, and none reaches the driver or
is broadcast. It forgets no repeat; a false alarm only sends a row to the exact grouping behind it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .worker import trimmed

HASHES, BITS_PER_KEY, MIN_BITS, RANGE = 4, 12, 10, 1 << 20  # keys wanted in a range


def size_for(n: int) -> int:
    return max(MIN_BITS, int(np.ceil(np.log2(max(1, n) * BITS_PER_KEY))))


def _bits(key: np.ndarray, bits: int):
    a, b = key * np.uint64(0x9E3779B97F4A7C15), key * np.uint64(0xC2B2AE3D27D4EB4F) | np.uint64(1)  # the first bits of a range's keys are all alike
    for k in range(HASHES):
        yield ((a + np.uint64(k) * b) >> np.uint64(64 - bits)).astype(np.int64)


def has(filt: np.ndarray, key: np.ndarray, bits: int) -> np.ndarray:
    ok = np.ones(len(key), bool)
    for at in _bits(key, bits):
        ok &= (filt[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return ok


def add(filt: np.ndarray, key: np.ndarray, bits: int) -> None:
    for at in _bits(key, bits):
        np.bitwise_or.at(filt, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))


def answers(sent: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Of each file's distinct keys, which may have come again; sent: (keys, several in the file itself)."""
    bits = size_for(sum(len(k) for k, _ in sent))
    once, twice = np.zeros(1 << bits >> 3, np.uint8), np.zeros(1 << bits >> 3, np.uint8)
    for key, several in sent:
        add(twice, key[several | has(once, key, bits)], bits)
        add(once, key, bits)
    return [has(twice, key, bits) for key, _ in sent]


def _file(folder: str, part: int):
    where, at = fs.FileSystem.from_uri(folder)
    for info in where.get_file_info(fs.FileSelector(at)):
        name = info.path.rpartition("/")[2]
        if name.endswith(".parquet") and int(name[5:].partition("-")[0]) == part:
            return where.open_input_file(info.path)
    raise FileNotFoundError(f"part {part} of {folder}")


def parts_of(folder: str) -> list[int]:
    """Numbers of the part files of a written table."""
    where, at = fs.FileSystem.from_uri(folder)
    names = [f.path.rpartition("/")[2] for f in where.get_file_info(fs.FileSelector(at))]
    return sorted(int(n[5:].partition("-")[0]) for n in names if n.startswith("part-") and n.endswith(".parquet"))


def _keys(file: pq.ParquetFile, hash_col: str) -> np.ndarray:
    return file.read([hash_col])[hash_col].to_numpy().astype(np.int64).view(np.uint64)


def marked(scratch: Scratch, name: str, table: DataFrame, rows: int, hash_col: str = "h1") -> DataFrame:
    """``table`` (kept as ``name``, of about ``rows`` rows) with a column ``again``: false where the hash surely comes once."""
    spark, folder = scratch.spark, scratch.path(name)
    parts = parts_of(folder)
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in table.schema)}, again boolean"
    if not parts:
        return table.withColumn("again", F.lit(False))
    range_bits = max(0, int(np.ceil(np.log2(max(1, rows) / RANGE))))
    n, ranges = len(parts), 1 << range_bits

    def send(batches):
        for batch in batches:
            for unit in batch.column(0).to_pylist():
                with _file(folder, parts[unit]) as opened:
                    key, count = np.unique(_keys(pq.ParquetFile(opened), hash_col), return_counts=True)
                cuts = np.searchsorted(key, np.arange(1, ranges, dtype=np.uint64) << np.uint64(64 - range_bits)) if range_bits else []
                for r, (k, c) in enumerate(zip(np.split(key, cuts), np.split(count, cuts))):
                    if len(k):
                        planes = np.ascontiguousarray(k.view(np.uint8).reshape(-1, 8).T).tobytes() + np.packbits(c > 1).tobytes()
                        yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([unit], pa.int32()), pa.array([len(k)], pa.int32()), pa.array([pa.compress(planes, "zstd", asbytes=True)], pa.binary())], ["range", "unit", "n", "blob"])

    def answer(batches):
        at, units, sent = None, [], []

        def made():
            bits = answers(sent)
            yield pa.RecordBatch.from_arrays([pa.array(units, pa.int32()), pa.array([at] * len(units), pa.int32()), pa.array([len(b) for b in bits], pa.int32()), pa.array([pa.compress(np.packbits(b).tobytes(), "zstd", asbytes=True) for b in bits], pa.binary())], ["unit", "range", "n", "blob"])

        for batch in batches:
            for r, unit, k, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if r != at and units:
                    yield from made()
                    units, sent = [], []
                at = r
                raw = np.frombuffer(pa.decompress(blob, 8 * k + (k + 7) // 8, "zstd", asbytes=True), np.uint8)
                sent.append((np.ascontiguousarray(raw[: 8 * k].reshape(8, k).T).view(np.uint64).ravel(), np.unpackbits(raw[8 * k :])[:k].astype(bool)))
                units.append(unit)
        if units:
            yield from made()

    def apply(batches):
        held: dict[int, list[tuple[int, np.ndarray]]] = {}
        for batch in batches:
            for unit, r, k, blob in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(unit, []).append((r, np.unpackbits(np.frombuffer(pa.decompress(blob, (k + 7) // 8, "zstd", asbytes=True), np.uint8))[:k]))
        for unit, bits in held.items():
            repeat = np.concatenate([b for _, b in sorted(bits, key=lambda x: x[0])]).astype(bool)
            with _file(folder, parts[unit]) as opened:
                file = pq.ParquetFile(opened)
                distinct = np.unique(_keys(file, hash_col))
                for batch in file.iter_batches(10_000):
                    own = batch.column(batch.schema.get_field_index(hash_col)).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(repeat[np.searchsorted(distinct, own)])], [*batch.schema.names, "again"])

    units = spark.range(n).select(F.col("id").cast("int").alias("unit")).repartitionById(n, F.col("unit"))
    sent = units.mapInArrow(trimmed(send), "range int, unit int, n int, blob binary")
    owned = sent.repartitionById(min(ranges, 4000), F.col("range") % min(ranges, 4000)).sortWithinPartitions("range", "unit")
    said = scratch.keep(owned.mapInArrow(trimmed(answer), "unit int, range int, n int, blob binary"), f"{name}_said")
    return said.repartitionById(n, F.col("unit")).mapInArrow(trimmed(apply), schema)

"""Problem 1: new batches against all history, by a prefix-tree hash forest that persists.

Each distinct core gets one key per tree: LEVELS fields of FIELD bits, one minwise value each, so that
keys sort as a prefix tree and any number of leading fields is a prefix. A *run* is what one ``add``
leaves behind: every tree's entries sorted by key, cut into ranges (buckets) and these into slices, a
row group each, whose bounds say which keys it holds. A batch is signed once and shuffled by bucket;
each bucket locates its keys in the runs by range search (only slices whose bounds hold a wanted prefix
are read), compares 64-bit sketches, and hands candidates to exact verification on whole cores.

``depth`` leading fields are as wide as a prefix must get for the recall target with the trees there
are. A text starts at the shortest prefix with no more than 2 * ``near`` entries, or with all fields,
and the BEST closest candidates of each tree are verified. Where that was less than all entries of its
``depth`` fields and no candidate proved near-same, the prefix is widened: the text is held against all
entries of its ``depth`` fields, in blocks of asked texts that read the wanted slices of the runs. So no
candidate is dropped, no task holds all pairs of a key, and only asked prefixes are read again.

The index lies in a folder (manifest, runs, cores in numbered row groups) and can be opened again.
Cost follows the batch: slices with wanted prefixes, and row groups of cores with a candidate, are read.
An index that outgrows ``expected`` keeps its recall, which follows from depth and trees alone; only
chance meetings grow. Over RUNS runs are merged into one.

Defined cases: null, empty, blank or bare-punctuation texts have no core and are never found;
rows with a null id or an unknown batch are left out; repeated rows count once; a text that
stands in several batches is judged by each row's batch; extra columns are ignored; an empty
batch finds nothing. Cores of one or two characters have no pieces and only match equal cores.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import Scratch
from . import bloom
from .dedupe_exact import hash_core
from .minhash import FIELD, LEVELS, bit_sketch, prefix_keys, prefix_of, signatures, trees_needed
from .skew import hot_keys, sliced_join
from .textform import PIECE, core, likeness
from .worker import trimmed

LIMIT, TARGET, RECALL = 0.6, 0.66, 0.99  # near-same from LIMIT; recall wanted at TARGET, more above it
NEAR, SKETCH_MIN, BEST = 256, 43, 8  # half of the entries tried at once; sketch bits of 64 that must agree; candidates of a text and tree before widening
ENTRIES, SLICE, CHUNK = 1 << 19, 1 << 13, 1 << 21  # entries wanted in a bucket, in a slice; entries a task holds at a time (of 28 bytes, some copies)
BLOCK_ROWS, ASKED_ROWS, PAGE, GROUPS, RUNS = 25_000, 4_096, 4_096, 16, 8  # cores signed together; of them in an asked block; cores in a row group; row groups read at a time; runs before a merge
RUN = "kind int, bucket int, lo long, hi long, n int, blob binary"
ENTRY, PAIRS, OPEN, READ = range(4)  # kinds of a run's rows: sorted slice; candidates; texts to widen; slices read (n) of those there (lo)
_types = (np.uint64, np.int64, np.uint64, np.uint32)  # key, number of the core, sketch, ord


def _prepare(batches):
    for batch in batches:
        cores = [core(t) for t in batch.column(1).to_pylist()]
        keep = pa.array([bool(c) for c in cores], pa.bool_())
        raw = np.frombuffer(b"".join(map(hash_core, cores)), np.int64).reshape(-1, 2)
        made = pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(raw[:, 0]), pa.array(raw[:, 1]), pa.array([c.encode("utf-16-le", "surrogatepass") for c in cores], pa.binary())], ["id", "ord", "h1", "h2", "core"])
        yield made.filter(keep)


def _numbered(wave: int):
    """Gives each core the number wave, partition, row; the file and row that Spark writes it to follow from it."""

    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        if part >= 1 << 23:
            raise ValueError("over 8 million partitions")
        for batch in batches:
            no = np.arange(at, at + batch.num_rows) + ((wave << 55) + (part << 32))
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(no), *batch.columns], ["no", *batch.schema.names])

    return run


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Columns of equal length, byte planes apart so that sorted keys compress."""
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() for a in arrays]
    return len(arrays[0]).to_bytes(4, "little") + pa.compress(b"".join(planes), "zstd", asbytes=True)


def _unpack(blob: bytes, types: tuple = _types) -> list[np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    raw = np.frombuffer(pa.decompress(blob[4:], n * sum(np.dtype(t).itemsize for t in types), "zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for kind in types:
        w = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + n * w].reshape(w, n).T).view(kind).ravel())
        at += n * w
    return out


class Forest:
    """Shape of the forest for an index of about ``n`` cores."""

    def __init__(self, n: int, target: float = TARGET, recall: float = RECALL):
        self.depth = min(LEVELS, max(3, math.ceil(math.log(max(n, 1)) / math.log(150))))  # a level thins chance meetings of one text some 150 times
        self.trees = trees_needed(target, self.depth, recall)
        self.range_bits = max(0, math.ceil(math.log2(max(1, n) / ENTRIES)))

    @classmethod
    def of(cls, shape: dict) -> Forest:
        made = cls(1)
        made.__dict__.update(shape)
        return made

    @property
    def buckets(self) -> int:
        return self.trees << self.range_bits

    def entries(self, block: int, some: bool = False):
        """Task function: (bucket, packed entries) of (no, ord, core) rows, a block of rows at a time; with ``some`` on, of the buckets in a fourth column only."""

        def run(batches):
            held, n = [], 0
            for batch in batches:
                for at in range(0, batch.num_rows, block):
                    held.append(batch.slice(at, block))
                    n += held[-1].num_rows
                    if n >= block:
                        yield self._packed(held, some)
                        held, n = [], 0
            if n:
                yield self._packed(held, some)

        return run

    def _packed(self, batches: list, some: bool) -> pa.RecordBatch:
        cores = [c.decode("utf-16-le", "surrogatepass") for b in batches for c in b.column(2).to_pylist()]
        sig = signatures([c if len(c) >= PIECE else c + "\0\0" for c in cores], max(64, self.trees * self.depth))[1]
        no = np.concatenate([b.column(0).to_numpy() for b in batches]).astype(np.int64)
        order = np.concatenate([b.column(1).to_numpy() for b in batches]).astype(np.uint32)
        keys, sketch = prefix_keys(sig, self.depth, self.trees), bit_sketch(sig)
        wanted = [set(x) for b in batches for x in b.column(3).to_pylist()] if some else []
        buckets, blobs = [], []
        for t in range(self.trees):
            by = np.argsort(keys[:, t], kind="stable")
            key = keys[by, t]
            cuts = np.searchsorted(key, np.arange(1, 1 << self.range_bits, dtype=np.uint64) << np.uint64(FIELD * LEVELS - self.range_bits))
            for r, idx in enumerate(np.split(np.arange(len(by)), cuts)):
                if some:
                    idx = idx[[t << self.range_bits | r in wanted[k] for k in by[idx]]] if len(idx) else idx
                if len(idx):
                    k = by[idx]
                    buckets.append(t << self.range_bits | r)
                    blobs.append(_pack([key[idx], no[k], sketch[k], order[k]]))
        return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"])


def _starts(x: np.ndarray) -> np.ndarray:
    """Of each place of a sorted array, the first place of its value."""
    new = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.empty(0, np.int64)
    return np.repeat(new, np.diff(np.append(new, len(x))))


def match(key: np.ndarray, sketch: np.ndarray, order: np.ndarray, fresh: np.ndarray, near: int, depth: int):
    """(v, u, open): positions of candidate pairs, v fresh and u of an earlier batch, sketches close; fresh positions to be widened.

    Each entry is held against those of the shortest prefix of ``depth`` or more fields that has at most 2 * ``near``
    entries; of longer lists with all fields equal, against the ``near`` before it and the ``near`` earliest. The BEST
    closest are given. Open is what has earlier entries in its ``depth`` fields that were not given.
    """
    n = len(key)
    v_out, u_out, open_ = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    left = np.lexsort((key, order, prefix_of(key, depth))) if n else np.empty(0, np.int64)
    for level in range(depth, LEVELS + 1):
        left = left[np.lexsort((key[left], order[left], prefix_of(key[left], level)))] if level > depth else left
        prefix = prefix_of(key[left], level)
        start = _starts(prefix)
        size = np.bincount(start, minlength=len(left))[start] if len(left) else start
        few = (size <= 2 * near) | (level == LEVELS)
        if level == depth and not few.all():  # narrower prefixes leave out entries of this one, unless all of it is as late
            wide = ~few & fresh[left] & (order[left] > order[left[start]])
            open_.append(left[wide])
        v, u, more = _nearest(prefix[few], sketch[left[few]], order[left[few]], fresh[left[few]], near)
        v_out.append(left[few][v])
        u_out.append(left[few][u])
        open_.append(left[few][more])
        left = left[~few]
        if not len(left):
            break
    return np.concatenate(v_out), np.concatenate(u_out), np.unique(np.concatenate(open_))


def _nearest(prefix: np.ndarray, sketch: np.ndarray, order: np.ndarray, fresh: np.ndarray, near: int):
    """(v, u, more) within equal prefixes; arrays are sorted by (prefix, order)."""
    n = len(prefix)
    start = _starts(prefix)
    # Entries before v that aren't of v's own batch: those before ``first``.
    first = np.maximum.accumulate(np.where(np.concatenate(([True], (prefix[1:] != prefix[:-1]) | (order[1:] != order[:-1]))), np.arange(n), 0)) if n else start
    asks = np.flatnonzero(fresh & (first > start))
    if not len(asks):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    first, start = first[asks], start[asks]
    far, who, seen = np.full((BEST, len(asks)), 65, np.uint8), np.zeros((BEST, len(asks)), np.int32), np.zeros(len(asks), np.int32)  # the BEST closest of each, closest first

    def offer(q: np.ndarray, u: np.ndarray) -> None:
        d = np.bitwise_count(sketch[asks[q]] ^ sketch[u]).astype(np.uint8)
        ok = d <= 64 - SKETCH_MIN
        q, u, d = q[ok], u[ok], d[ok]
        seen[q] += 1
        for j in range(BEST if len(q) else 0):
            nearer, d0, u0 = d < far[j, q], far[j, q], who[j, q]
            far[j, q], who[j, q] = np.where(nearer, d, d0), np.where(nearer, u, u0)
            d, u = np.where(nearer, d0, d), np.where(nearer, u0, u)

    q = np.arange(len(asks))
    for k in range(1, near + 1):
        q = q[first[q] - k >= start[q]]
        if not len(q):
            break
        offer(q, first[q] - k)
    q = np.flatnonzero(first - start > near)
    for k in range(near):
        q = q[start[q] + k < first[q] - near]
        if not len(q):
            break
        offer(q, start[q] + k)
    slot, q = np.nonzero(far < 65)
    return asks[q], who[slot, q].astype(np.int64), asks[(first - start > 2 * near) | (seen > BEST)]


def _files(folder: str, known: dict) -> dict[int, str]:
    """Spark's part files of a table that is whole, by partition; ``known`` keeps them for a task."""
    if folder not in known:
        where, at = fs.FileSystem.from_uri(folder)
        names = [f.path for f in where.get_file_info(fs.FileSelector(at)) if f.path.endswith(".parquet")]
        known[folder] = {int(p.rpartition("/")[2][5:].partition("-")[0]): p for p in names}
    return known[folder]


def _slices(run: tuple[str, int], bucket: int, wanted: np.ndarray | None, depth: int, known: dict, tally: list[int]):
    """Entries of a run's bucket, a few slices at a time; only those whose first fields are among the sorted ``wanted``, if given."""
    folder, parts = run
    path = _files(folder, known).get(bucket % parts)
    if not path:
        return
    where = fs.FileSystem.from_uri(folder)[0]
    with where.open_input_file(path) as opened:
        file = pq.ParquetFile(opened)
        groups = []
        for g in range(file.num_row_groups):  # a row each, so bounds are the values
            row = file.metadata.row_group(g)
            kind, b, lo, hi = (row.column(c).statistics for c in range(4))
            if kind.min == ENTRY and b.min == bucket:
                tally[1] += 1
                if wanted is None or np.searchsorted(wanted, prefix_of(np.uint64(lo.min), depth)) < np.searchsorted(wanted, prefix_of(np.uint64(hi.min), depth), "right"):
                    groups.append(g)
        tally[0] += len(groups)
        for k in range(0, len(groups), GROUPS):
            cols = _joined([_unpack(b) for b in file.read_row_groups(groups[k : k + GROUPS], ["blob"])["blob"].to_pylist()])
            if wanted is not None:
                prefix = prefix_of(cols[0], depth)
                cols = _taken(cols, wanted[np.minimum(np.searchsorted(wanted, prefix), len(wanted) - 1)] == prefix)
            if len(cols[0]):
                yield cols


def _joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, t) for t in _types]


def _taken(cols: list[np.ndarray], at: np.ndarray) -> list[np.ndarray]:
    return [c[at] for c in cols]


def _earliest(cols: list[np.ndarray], n: int, depth: int) -> list[np.ndarray]:
    """The ``n`` earliest entries of each prefix of ``depth`` fields."""
    cols = _taken(cols, np.lexsort((cols[0], cols[3], prefix_of(cols[0], depth))))
    return _taken(cols, np.arange(len(cols[0])) - _starts(prefix_of(cols[0], depth)) < n)


def _rows(kind: int, bucket: int, made: list[tuple[int, int, int, bytes | None]]) -> pa.RecordBatch:
    lo, hi, n, blob = zip(*made)
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(made), pa.int32()), pa.array([bucket] * len(made), pa.int32()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(n, pa.int32()), pa.array(blob, pa.binary())], ["kind", "bucket", "lo", "hi", "n", "blob"])


def _sorted_slices(bucket: int, cols: list[np.ndarray], rows: int):
    cols = _taken(cols, np.argsort(cols[0], kind="stable"))
    for at in range(0, len(cols[0]), rows * GROUPS):
        made = []
        for k in range(at, min(at + rows * GROUPS, len(cols[0])), rows):
            part = [c[k : k + rows] for c in cols]
            made.append((int(part[0][0]), int(part[0][-1]), len(part[0]), _pack(part)))
        yield _rows(ENTRY, bucket, made)


class Bucket:
    """One bucket as it streams by, in a task of the search: entries of the batch, held in bounded numbers."""

    def __init__(self, bucket: int, runs: list[tuple[str, int]], near: int, chunk: int, depth: int, rows: int, known: dict):
        self.rows = rows
        self.bucket, self.runs, self.near, self.chunk, self.depth, self.known = bucket, runs, near, chunk, depth, known
        self.parts, self.held, self.tally = [], 0, [0, 0]
        self.pivots: list[list[np.ndarray]] = []  # earliest entries of crowded prefixes that were let go
        self.crowded = np.empty(0, np.uint64)

    def _crowd(self, cols: list[np.ndarray]) -> np.ndarray:
        """Marks entries of the prefixes that make up most of what is held."""
        prefix = prefix_of(cols[0], self.depth)
        kinds, n = np.unique(prefix, return_counts=True)
        many = kinds[n >= max(1, self.chunk // 8)]
        self.crowded = np.union1d(self.crowded, many)
        return np.isin(prefix, many)

    def put(self, cols: list[np.ndarray]):
        self.parts.append(cols)
        self.held += len(cols[0])
        if self.held >= self.chunk:
            cols = _joined(self.parts)
            go = self._crowd(cols)
            if go.any():
                yield from self._matched(_taken(cols, go))
                cols = _taken(cols, ~go)
            self.parts, self.held = [cols], len(cols[0])

    def end(self):
        if self.held:
            yield from self._matched(_joined(self.parts))
        if self.tally[1]:
            yield _rows(READ, self.bucket, [(self.tally[1], 0, self.tally[0], None)])

    def _matched(self, own: list[np.ndarray]):
        yield from _sorted_slices(self.bucket, own, self.rows)
        wanted = np.unique(prefix_of(own[0], self.depth))
        past, held = [], 0
        for run in self.runs:
            for cols in _slices(run, self.bucket, wanted, self.depth, self.known, self.tally):
                past.append(cols)
                held += len(cols[0])
                if held >= self.chunk:  # crowded in history: the earliest stand for all until the prefix is widened
                    cols = _joined(past)
                    many = self._crowd(cols)
                    past = [_taken(cols, ~many), _earliest(_taken(cols, many), 2 * self.near, self.depth)]
                    held = sum(len(p[0]) for p in past)
        seen = _joined([own, *past, *self.pivots])
        fresh = np.arange(len(seen[0])) < len(own[0])
        v, u, more = match(seen[0], seen[2], seen[3], fresh, self.near, self.depth)
        crowd = np.isin(prefix_of(seen[0], self.depth), self.crowded)
        if crowd.any():
            more = np.union1d(more, np.flatnonzero(crowd & fresh))
            mine = np.isin(prefix_of(own[0], self.depth), self.crowded)
            self.pivots = [_earliest(_joined([_taken(own, mine), *self.pivots]), 2 * self.near, self.depth)]
        if len(v):
            yield _rows(PAIRS, self.bucket, [(0, 0, len(v), _pack([seen[1][v], seen[1][u]]))])
        if len(more):
            yield _rows(OPEN, self.bucket, [(0, 0, len(more), _pack([seen[1][more]]))])


def _widened(asked: list[np.ndarray], chunks, depth: int):
    """(v, u) numbers of asked entries and all earlier ones with their ``depth`` fields and a close sketch, a chunk at a time."""
    by = np.argsort(asked[0], kind="stable")
    asked = _taken(asked, by)
    mine = prefix_of(asked[0], depth)
    for cols in chunks:
        cols = _taken(cols, np.argsort(cols[0], kind="stable"))
        theirs = prefix_of(cols[0], depth)
        kinds = np.intersect1d(mine, theirs)
        ends = zip(np.searchsorted(mine, kinds), np.searchsorted(mine, kinds, "right"), np.searchsorted(theirs, kinds), np.searchsorted(theirs, kinds, "right"))
        for a0, a1, c0, c1 in ends:
            for a in range(a0, a1, 256):
                va = slice(a, min(a + 256, a1))
                for c in range(c0, c1, 1 << 13):
                    uc = slice(c, min(c + (1 << 13), c1))
                    ok = (64 - np.bitwise_count(asked[2][va, None] ^ cols[2][None, uc]) >= SKETCH_MIN) & (cols[3][None, uc] < asked[3][va, None])
                    i, j = np.nonzero(ok)
                    if len(i):
                        yield asked[1][va][i], cols[1][uc][j]


class History:
    """Index of everything accepted so far, in ``folder`` (by default one of its own in the shared folder, gone with the driver)."""

    def __init__(self, spark: SparkSession, expected: int, near: int = NEAR, chunk: int = CHUNK, folder: str | None = None, slice_rows: int = SLICE):
        self.slice = slice_rows
        self.spark, self.near, self.chunk, self.forest = spark, near, chunk, Forest(expected)
        self.scratch = Scratch(spark, "history")
        self.root = (folder or self.scratch.path("index")).rstrip("/")
        self.runs: list[tuple[str, int]] = []  # name, partitions
        self.waves = 0

    @classmethod
    def open(cls, spark: SparkSession, folder: str, **options) -> History:
        """The index that was left in ``folder``."""
        where, at = fs.FileSystem.from_uri(folder.rstrip("/"))
        with where.open_input_file(f"{at}/manifest.json") as file:
            said = json.loads(file.read())
        index = cls(spark, 1, folder=folder, **options)
        index.forest, index.runs, index.waves = Forest.of(said["forest"]), [tuple(r) for r in said["runs"]], said["waves"]
        return index

    def _save(self) -> None:
        """A wave counts once the manifest names it; it is replaced as a whole."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest.json")
        text = json.dumps({"forest": self.forest.__dict__, "runs": self.runs, "waves": self.waves})
        out = at.getFileSystem(conf).create(at, True)
        out.write(bytearray(text.encode()))
        out.close()

    def _places(self) -> list[tuple[str, int]]:
        return [(f"{self.root}/runs/{name}", parts) for name, parts in self.runs]

    def _table(self, df: DataFrame, at: str, group: int, **options) -> DataFrame:
        schema = df.schema
        df.write.option("parquet.block.row.count.limit", group).options(**options).mode("overwrite").parquet(f"{self.root}/{at}")
        return self.spark.read.schema(schema).parquet(f"{self.root}/{at}")

    def _search(self, blobs: DataFrame, name: str) -> DataFrame:
        """The run of a batch, with candidates and texts to widen beside the slices."""
        runs, near, chunk, depth, rows = self._places(), self.near, self.chunk, self.forest.depth, self.slice

        def run(batches):
            bucket, known = None, {}
            for batch in batches:
                for b, blob in zip(*(c.to_pylist() for c in batch.columns)):
                    if bucket is None or b != bucket.bucket:
                        if bucket:
                            yield from bucket.end()
                        bucket = Bucket(b, runs, near, chunk, depth, rows, known)
                    yield from bucket.put(_unpack(blob))
            if bucket:
                yield from bucket.end()

        n = min(self.forest.buckets, 4000)
        placed = blobs.repartitionById(n, F.col("bucket") % n).sortWithinPartitions("bucket")
        made = self._table(placed.mapInArrow(trimmed(run), RUN), f"runs/{name}", 1, compression="uncompressed", **{"parquet.enable.dictionary": "false"})
        self.runs.append((name, n))
        return made

    def _widen(self, asked: DataFrame) -> DataFrame:
        """(v, u) of asked texts (no, ord, core, buckets) and all entries of their prefixes; a block of texts and bucket is the unit of work."""
        runs, depth, chunk = self._places(), self.forest.depth, self.chunk

        def run(batches):
            known: dict = {}
            for batch in batches:
                for b, blob in zip(*(c.to_pylist() for c in batch.columns)):
                    own = _unpack(blob)
                    wanted = np.unique(prefix_of(own[0], depth))
                    v, u, held = [], [], 0
                    for a, c in _widened(own, (cols for r in runs for cols in _slices(r, b, wanted, depth, known, [0, 0])), depth):
                        v.append(a)
                        u.append(c)
                        held += len(a)
                        if held >= chunk:
                            yield _pairs(np.concatenate(v), np.concatenate(u))
                            v, u, held = [], [], 0
                    if held:
                        yield _pairs(np.concatenate(v), np.concatenate(u))

        blobs = asked.mapInArrow(trimmed(self.forest.entries(ASKED_ROWS, some=True)), "bucket int, blob binary")
        n = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 2 * self.spark.sparkContext.defaultParallelism)
        return blobs.repartition(n).mapInArrow(trimmed(run), "v long, u long")

    def _with_core(self, df: DataFrame, by: str, columns: dict[str, str]) -> DataFrame:
        """Adds columns of the core whose number ``by`` holds; rows should come sorted by it. Only row groups that are asked for are read."""
        root, at, names = self.root, df.columns.index(by), list(columns)

        def run(batches):
            held: dict = {}  # the file and row group at hand
            known: dict = {}

            def page(wave: int, part: int, row: int):
                if held.get("file") != (wave, part):
                    if "opened" in held:
                        held["opened"].close()
                    folder = f"{root}/cores/w{wave}"
                    held["opened"] = fs.FileSystem.from_uri(folder)[0].open_input_file(_files(folder, known)[part])
                    held["reader"], held["file"], held["group"] = pq.ParquetFile(held["opened"]), (wave, part), None
                    md = held["reader"].metadata
                    held["ends"] = np.cumsum([md.row_group(g).num_rows for g in range(md.num_row_groups)])
                group = int(np.searchsorted(held["ends"], row, "right"))
                if held["group"] != group:
                    held["table"], held["group"] = held["reader"].read_row_group(group, names), group
                return held["table"], row - (int(held["ends"][group - 1]) if group else 0)

            for batch in batches:
                no = batch.column(at).to_numpy()
                made: list[list] = [[] for _ in names]
                cut = np.flatnonzero(np.diff(no >> 12)) + 1  # stays within a page, so mostly within a row group
                for idx in np.split(np.arange(len(no)), cut) if len(no) else []:
                    tables: dict = {}
                    for k in idx:
                        x = int(no[k])
                        table, row = page(x >> 55, x >> 32 & (1 << 23) - 1, x & (1 << 32) - 1)
                        if id(table) not in tables:
                            tables[id(table)] = [table[c].combine_chunks().to_pylist() if c != "core" else table[c].combine_chunks() for c in names]
                        for j, c in enumerate(tables[id(table)]):
                            made[j].append(c[row].as_py() if names[j] == "core" else c[row])
                types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
                yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(m, types[columns[c]]) for m, c in zip(made, names)]], [*batch.schema.names, *names])

        had = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
        return df.mapInArrow(trimmed(run), ", ".join([*had, *[f"{c} {t}" for c, t in columns.items()]]))

    def _verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """(v, h1, h2) of every v that has a u with likeness of LIMIT or more, or an equal core."""

        def check(batches):
            for batch in batches:
                cu, cv = batch.column(batch.schema.get_field_index("cu")).to_pylist(), batch.column(batch.schema.get_field_index("core")).to_pylist()
                ok = [a == b or likeness(a.decode("utf-16-le", "surrogatepass"), b.decode("utf-16-le", "surrogatepass")) >= LIMIT for a, b in zip(cu, cv)]
                yield batch.select(["v", "h1", "h2"]).filter(pa.array(ok, pa.bool_()))

        # By range of (u, v): the candidates of a text that many point at are spread.
        first = self._with_core(pairs.repartitionByRange("u", "v").sortWithinPartitions("u"), "u", {"core": "binary"}).select("v", F.col("core").alias("cu"))
        second = self._with_core(first.repartition(F.shiftright("v", 12)).sortWithinPartitions("v"), "v", {"h1": "long", "h2": "long", "core": "binary"})
        return self.scratch.keep(second.mapInArrow(trimmed(check), "v long, h1 long, h2 long").distinct(), name)

    def add(self, rows: DataFrame) -> DataFrame:
        """(id) of every row that repeats or nearly repeats a text of an earlier ``ord``; rows: id, text, ord. The rows become part of the index.

        All ``ord`` must be later than those added before.
        """
        self.waves += 1
        w, keep = self.waves, self.scratch.keep
        kind = rows.schema["id"].dataType.simpleString()
        rows = rows.select("id", F.col("text").cast("string"), F.col("ord").cast("int")).where("id is not null and ord is not null")
        made = keep(rows.mapInArrow(trimmed(_prepare), f"id {kind}, ord int, h1 long, h2 long, core binary"), f"rows{w}")
        known = made.select("id", "h1", "h2", "ord")
        n = made.count()
        flagged = bloom.marked(self.scratch, f"rows{w}", made, n)
        again, single = flagged.where("again"), flagged.where("not again").select("h1", "h2", "ord", "core")
        firsts = again.groupBy("h1", "h2").agg(F.min(F.struct("ord", "core")).alias("x")).select("h1", "h2", "x.ord", "x.core")
        reps = self._table(single.unionByName(firsts).mapInArrow(_numbered(w), "no long, h1 long, h2 long, ord int, core binary"), f"cores/w{w}", PAGE, compression="zstd")
        # Equal cores in this batch; those in history meet in every tree.
        several = keep(again.select("id", "h1", "h2", "ord"), f"again{w}")
        hot = keep(hot_keys(several, ["h1", "h2"], n), f"hot{w}")
        start = several.groupBy("h1", "h2").agg(F.min("ord").alias("first"), F.max("ord").alias("last")).where("last > first").drop("last")
        exact = sliced_join(several, start, ["h1", "h2"], hot, "id").where("ord > first").select("id")
        # Candidates, the closest first, then the wider prefix for what stays open.
        blobs = reps.select("no", "ord", "core").mapInArrow(trimmed(self.forest.entries(BLOCK_ROWS)), "bucket int, blob binary")
        run = self._search(blobs, f"w{w}")
        pairs = keep(run.where(F.col("kind") == PAIRS).select("blob").mapInArrow(_unpacked(2), "v long, u long").distinct(), f"pairs{w}")
        near = self._verified(pairs, f"near{w}")
        opened = run.where(F.col("kind") == OPEN).select("blob", "bucket").mapInArrow(_unpacked(1), "v long, bucket int")
        open_ = keep(opened.join(near.select("v"), "v", "left_anti").groupBy("v").agg(F.collect_set("bucket").alias("buckets")), f"open{w}")  # at most one bucket a tree
        near = near.select("h1", "h2")
        if not open_.isEmpty():
            placed = open_.repartition(F.shiftright("v", 12)).sortWithinPartitions("v")
            asked = keep(self._with_core(placed, "v", {"ord": "int", "core": "binary"}).select("v", "ord", "core", "buckets"), f"asked{w}")
            more = keep(self._widen(asked).distinct(), f"more{w}")
            near = near.unionByName(self._verified(more, f"more_near{w}").select("h1", "h2"))
        found = keep(exact.unionByName(sliced_join(known, near, ["h1", "h2"], hot, "id", "left_semi").select("id")).distinct(), f"found{w}")
        self.scratch.drop(*(f"{t}{w}" for t in ("rows", "again", "hot", "pairs", "near", "open", "asked", "more", "more_near")), f"rows{w}_said")
        self._save()
        if len(self.runs) > RUNS:
            self.merge_runs()
        return found

    def slices_read(self) -> tuple[int, int]:
        """(slices read, slices there) in the search of the last batch."""
        run = self.spark.read.schema(RUN).parquet(self._places()[-1][0]).where(F.col("kind") == READ)
        read = run.agg(F.sum("n"), F.sum("lo")).first()
        return read[0] or 0, read[1] or 0

    def merge_runs(self) -> None:
        """Merges all runs into one, a bucket at a time; a bucket of over CHUNK entries keeps sorted parts of up to that many."""
        runs, n, chunk, rows, name = self._places(), min(self.forest.buckets, 4000), self.chunk, self.slice, f"m{self.waves}"
        if len(runs) < 2:
            return

        def run(batches):
            known: dict = {}
            for batch in batches:
                for b in batch.column(0).to_pylist():
                    parts, held = [], 0
                    for cols in (x for r in runs for x in _slices(r, b, None, 0, known, [0, 0])):
                        parts.append(cols)
                        held += len(cols[0])
                        if held >= chunk:
                            yield from _sorted_slices(b, _joined(parts), rows)
                            parts, held = [], 0
                    if held:
                        yield from _sorted_slices(b, _joined(parts), rows)

        buckets = self.spark.range(self.forest.buckets).select(F.col("id").cast("int").alias("b"))
        self._table(buckets.repartitionById(n, F.col("b") % n).mapInArrow(trimmed(run), RUN), f"runs/{name}", 1, compression="uncompressed", **{"parquet.enable.dictionary": "false"})
        self.runs = [(name, n)]
        self._save()
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for folder, _ in runs:
            at = jvm.org.apache.hadoop.fs.Path(folder)
            at.getFileSystem(conf).delete(at, True)


def _pairs(v: np.ndarray, u: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v), pa.array(u)], ["v", "u"])


def _unpacked(columns: int):
    """Task function: numbers of packed rows; of one column, with the bucket beside them."""

    def run(batches):
        for batch in batches:
            for k, blob in enumerate(batch.column(0).to_pylist()):
                cols = _unpack(blob, (np.int64,) * columns)
                yield _pairs(*cols) if columns == 2 else pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(np.full(len(cols[0]), batch.column(1)[k].as_py(), np.int32))], ["v", "bucket"])

    return run


def batch_order(runs: DataFrame) -> DataFrame:
    """(batch_id, ord): place of each batch by its first non-null ``created_at``; one row a batch, bounded by the number of runs."""
    first = runs.where("created_at is not null and batch_id is not null").groupBy("batch_id").agg(F.min("created_at").alias("at"))
    return first.select("batch_id", F.dense_rank().over(Window.orderBy("at")).cast("int").alias("ord"))


def repeats_of_history(texts: DataFrame, runs: DataFrame, id_col: str = "text_id", text_col: str = "raw_text", waves: int = 2, folder: str | None = None) -> DataFrame:
    """(id) of texts near-same to a text of an earlier batch. Batches are added to an index in ``waves`` of consecutive ones."""
    spark = texts.sparkSession
    order = batch_order(runs)
    rows = texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), "batch_id").join(F.broadcast(order), "batch_id").select("id", "text", "ord")
    last = order.agg(F.max("ord")).first()[0] or 0
    index = History(spark, texts.count(), folder=folder)
    found, done = None, 0
    cuts = sorted({math.ceil(last * (k + 1) / waves) for k in range(waves)} - {0}) or [0]
    for cut in cuts:
        part = index.add(rows.where((F.col("ord") > done) & (F.col("ord") <= cut)))
        found = part if found is None else found.unionByName(part)
        done = cut
    return found.distinct()

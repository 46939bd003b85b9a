"""MinHash near-duplicate detection with a circulant signature.

Two permutations make every signature coordinate: ``sigma`` maps a shingle to a point of the ring of 32-bit integers and
``pi`` is read at that point shifted circularly by k, so coordinate k of a set is ``min(pi(sigma(x) + k))``. Bands of
coordinates are the bucket keys; every reported link is confirmed by the exact Jaccard similarity of the full sets.

How candidates stay linear in the input:

1. Texts with equal shingle sets collapse into one node before banding (partial aggregation, so a group of copies of any
   size costs one row per task).
2. Rows (bucket, node) are dealt out by range and sorted, so a bucket of any size is spread over as many tasks as it fills
   and no key is hot. A sweep links each node to the first node of its bucket in the partition; buckets cut by a partition border
   get links between the parts. Each node is compared with one such node, and confirmed pairs make components.
3. A second sweep in the same manner looks for buckets whose nodes have different components still. At most ``SMALL`` nodes
   are compared as pairs; more of them, or a bucket cut by a border, in blocks of about ``BLOCK`` nodes in order of set size. Two
   blocks meet unless they share one component or their sizes rule a link out; one matrix product counts all intersections of a
   meeting, and only links that join components leave its task.

No pair of different components is dropped, so every link between different texts that banding can see is confirmed or
refuted, or its two ends are already known to be connected.

Full sets are made for nodes in shared buckets only. A bitmap of their texts' hashes (one bit a hash, ``BITMAP_BITS`` bits at
most) goes to every task and keeps other texts out of the shuffle; it decides nothing else, and the join after it is exact.

Edge cases: null or empty texts and texts of white space have no set, ``n_shingles`` 0 and are linked with nothing. Repeated
rows are copies. Rows whose doc_id is null take part in links; a component of nulls only has a null id, and its rows are
all kept by :func:`near_duplicates`, while :func:`deduplicated` leaves one row of it as of every component. Other columns of the
input are ignored or carried along untouched, so clashing names do no harm. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.scratch import Tables, sliced, small_batches
from larkspur.llm.textbytes import buffer_of, mix64, row_slices, words

SHINGLE_WORDS = 5
#: Bands and rows of a band: two sets of similarity 0.75 miss every bucket with probability (1 - 0.75**5)**40 = 0.00002.
BANDS, ROWS = 40, 5
#: A link needs 100 * |intersection| >= PERCENT * |union|.
PERCENT = 75
#: Open buckets up to SMALL nodes are compared as pairs, larger ones in blocks of about BLOCK nodes.
SMALL, BLOCK = 8, 512
#: Most bits of the bitmap that is sent to every task (32 MB), and bits for each hash in it below that.
BITMAP_BITS, BITS_EACH = 1 << 28, 16
_COLUMNS = 4096  # shingles of a block counted at once

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """For each row the sorted distinct 64-bit hashes of its k-word shingles; the whole sequence if it has fewer words."""
    hashes, starts, _ = words(data, offsets)
    first = np.searchsorted(starts, offsets[:-1])
    last = np.append(first[1:], len(hashes))
    n = len(hashes)
    if n >= k:
        rolled = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            rolled += hashes[j : n - k + 1 + j] * _MULTIPLIERS[j % 5]
        rolled = mix64(rolled)
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            short = (hashes[a:b] * _MULTIPLIERS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix64(np.array([short], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _pi(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def band_keys(sets: list[np.ndarray], bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Band keys, one row of ``bands`` 64-bit integers for each (non-empty) set."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    sigma = (mix64(np.concatenate(sets) ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)
    keys = np.empty((len(sets), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(sets), band + 1, np.uint64)
        for row in range(rows):
            shift = np.uint32(band * rows + row)
            least = np.minimum.reduceat(_pi(sigma + shift), starts)
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + least)
        keys[:, band] = key
    return keys.view(np.int64)


def _cut(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    yield from row_slices(offsets, 1 << 19)


def _digest(items: bytes) -> bytes:
    return hashlib.blake2b(items, digest_size=16).digest()


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS, row_col: str | None = None) -> DataFrame:
    """row (null without ``row_col``), doc_id, text_key, n_shingles, set_key (128-bit digest of the set, null if empty) and band
    keys of every row; no shuffle. Of equal sets in one partition only the first has band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # at most one digest a row of the partition
        for batch in sliced(batches):
            data, offsets = buffer_of(batch.column(3))
            for lo, hi in _cut(offsets):
                sets = shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                keys = [_digest(s.tobytes()) if len(s) else None for s in sets]
                fresh = []
                for i, key in enumerate(keys):
                    if key is not None and key not in seen:
                        seen.add(key)
                        fresh.append(i)
                banded: list = [None] * len(sets)
                if fresh:
                    for i, row in zip(fresh, band_keys([sets[i] for i in fresh], bands, rows), strict=True):
                        banded[i] = row
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in batch.columns[:3]), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(banded, pa.list_(pa.int64()))],
                    ["row", "doc_id", "text_key", "n_shingles", "set_key", "bands"],
                )

    row = F.lit(None) if row_col is None else F.col(row_col)
    narrow = small_batches(docs).select(row.cast("long").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("binary")).alias("text_key"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(run, "row long, doc_id long, text_key long, n_shingles long, set_key binary, bands array<long>")


def _bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """Bits of the hashes in ``column``, modulo the number of bits, as bytes; the number grows with the hashes up to a bound."""
    wanted = keys.count() * BITS_EACH
    bits = min(BITMAP_BITS, max(1 << 15, 1 << wanted.bit_length()))
    at = F.pmod(F.col(column), F.lit(bits)) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("piece")).collect()
    out = np.zeros(bits >> 3, np.uint8)
    for r in parts:  # 4 kB each, BITMAP_BITS bits together at most
        out[(r.part - 1) * 4096 : r.part * 4096] = np.frombuffer(r.piece, np.uint8)
    return out


def _node_sets(docs: DataFrame, wanted: DataFrame, text_col: str) -> DataFrame:
    """node and full set (little-endian 64-bit integers) of the nodes in ``wanted`` (node, set_key, text_key); nodes may share a set.

    The last step is by (set_key, node), which the join has dealt by set_key already.
    """
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted, "text_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = bits.value, set()
        for batch in sliced(batches):
            at = batch.column(0).to_numpy() & (len(known) * 8 - 1)
            some = np.flatnonzero(known[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            if not len(some):
                continue
            data, offsets = buffer_of(batch.column(1).take(pa.array(some)))
            for lo, hi in _cut(offsets):
                packed = [s.tobytes() for s in shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])]
                made = {_digest(p): p for p in packed if p}
                made = {k: p for k, p in made.items() if k not in seen}
                seen.update(made)
                yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.binary()), pa.array(list(made.values()), pa.binary())], ["set_key", "items"])

    texts = docs.select(F.xxhash64(F.col(text_col).cast("binary")).alias("text_key"), F.col(text_col).cast("binary").alias("text"))
    made = texts.mapInArrow(run, "set_key binary, items binary")
    return wanted.select("node", "set_key").join(made, "set_key").dropDuplicates(["set_key", "node"]).select("node", "items")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            good = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(both) - common):
                    good.append(i)
            take = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take)], ["a", "b"])

    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def components(edges: DataFrame, tables: Tables | None = None) -> DataFrame:
    """node and label (smallest node reachable) of every node of the undirected ``edges`` (a, b).

    Every round gives each node the least label among itself and its neighbours and then follows labels once (pointer
    jumping); labels meet after about the logarithm of the longest path. Each round is a written table of two longs a node. A
    node of very many edges is one key of these joins; no aggregation hangs on that key, so Spark's skew join splits it.
    """
    tables = tables or Tables(edges.sparkSession, "components")
    both = tables.written(edges.union(edges.select("b", "a")).distinct().toDF("node", "other"), "edges")
    labels = tables.written(both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        stepped = tables.written(labels.join(near, "node").select("node", F.least("label", "near").alias("new"), F.col("label").alias("old")), "step")
        jump = stepped.select(F.col("node").alias("new"), F.col("new").alias("further"))
        moved = tables.written(stepped.join(jump, "new").select("node", F.least("new", "further").alias("label"), "old"), "labels")
        tables.drop(stepped, labels)
        done = not moved.where("label <> old").limit(1).count()
        labels = moved
        if done:
            tables.drop(both)
            return labels.select("node", "label")


def _with_label(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``label``: the component of ``node``, itself if it has no link yet."""
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _block_links(percent: int):
    """A function that finds, in one group of nodes (node, label, items), links enough to join all components they join."""

    def run(group: pa.Table) -> pa.Table:
        nodes, labels = group.column("node").to_numpy(), group.column("label").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("items")]
        sizes = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, token, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = np.flatnonzero(often[token] > 1)
        order = shared[np.argsort(token[shared], kind="stable")]
        rank = np.unique(token[order], return_inverse=True)[1]
        common = np.zeros((len(sets), len(sets)), np.float32)  # counts below 2**24 are exact
        for lo in range(0, int(rank[-1]) + 1 if len(rank) else 0, _COLUMNS):
            a, b = np.searchsorted(rank, [lo, lo + _COLUMNS])
            has = np.zeros((len(sets), min(_COLUMNS, int(rank[-1]) + 1 - lo)), np.float32)
            has[owner[order[a:b]], rank[a:b] - lo] = 1.0
            common += has @ has.T
        union = sizes[:, None] + sizes[None, :] - common
        close = (100 * common.astype(np.float64) >= percent * union) & (labels[:, None] != labels[None, :])
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = x = parent.get(parent[x], parent[x])
            return x

        found = []
        for i, j in np.argwhere(np.triu(close, 1)).tolist():
            x, y = top(int(labels[i])), top(int(labels[j]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                found.append((int(nodes[i]), int(nodes[j])))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return run


def _dealt(rows: DataFrame, *by: str) -> DataFrame:
    """Rows in sorted partitions, dealt out by range of all of ``by``: a bucket that is too large for one partition fills several."""
    return rows.repartitionByRange(*by).sortWithinPartitions(*by)


def _first_sweep(nodes: DataFrame) -> DataFrame:
    """bucket, node, size, leader (first node of the bucket in the partition), leader_size and border, for the nodes of shared buckets.

    A border row stands for the first or last bucket of a partition, whatever its number of nodes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "node", "size", "leader", "leader_size", "border"]

        def out(bucket, node, size, leader, leader_size, border: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (bucket, node, size, leader, leader_size, np.full(len(bucket), border))], names)

        held = None  # (bucket, leader, its size, whether the leader's own row is out) of the run that the last batch ended in
        for batch in batches:
            bucket, node, size = (c.to_numpy() for c in batch.columns)
            if not len(bucket):
                continue
            if held is not None:  # the leader of the open run stands in front
                bucket, node, size = (np.append(x, y) for x, y in zip(held, (bucket, node, size), strict=False))
            begins = np.concatenate([[True], bucket[1:] != bucket[:-1]])
            starts = np.flatnonzero(begins)
            lengths = np.diff(np.append(starts, len(bucket)))
            leader, leader_size = np.repeat(node[starts], lengths), np.repeat(size[starts], lengths)
            show = np.repeat(lengths > 1, lengths)
            if held is not None and held[3]:
                show[0] = False
            if show.any():
                yield out(bucket[show], node[show], size[show], leader[show], leader_size[show], False)
            if held is None:
                yield out(bucket[:1], node[:1], size[:1], node[:1], size[:1], True)
            last = starts[-1]
            held = (bucket[last], node[last], size[last], lengths[-1] > 1 or (held is not None and last == 0 and held[3]))
        if held is not None:
            one = [np.array([x]) for x in held[:3]]
            yield out(*one, *one[1:], True)

    rows = nodes.select(F.explode("bands").alias("bucket"), "node", "size")
    return _dealt(rows, "bucket", "node").mapInArrow(run, "bucket long, node long, size long, leader long, leader_size long, border boolean")


def _members(nodes: DataFrame, tables: Tables) -> DataFrame:
    """bucket, node, size, leader and leader_size of all nodes that share a bucket; the parts of a cut bucket lead to its first node."""
    swept = tables.written(_first_sweep(nodes), "swept")
    border = swept.where("border").select("bucket", "node", "size").distinct()  # two rows a partition at most
    first = border.groupBy("bucket").agg(F.min(F.struct("node", "size")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    across = border.join(first, "bucket").select("bucket", "node", "size", F.col("top.node").alias("leader"), F.col("top.size").alias("leader_size"))
    return swept.where("not border").drop("border").unionByName(across)


def _second_sweep(tagged: DataFrame, percent: int, small: int, block: int) -> DataFrame:
    """What is left to compare in buckets (bucket, size, node, label) that hold several components.

    A row is a pair of nodes (a, b; block null) or a node of a block (bucket, block, a: the node, label, size).
    """
    names = ["bucket", "block", "a", "b", "label", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32  # of the next block
        held: np.ndarray | None = None  # rows of the run that the last batch ended in: columns bucket, size, node, label
        cut = True  # whether that run began in an earlier partition, perhaps, or gave blocks already

        def pairs(runs: list[np.ndarray]) -> pa.RecordBatch:
            a, b = [], []
            for r in runs:
                i, j = np.triu_indices(len(r), 1)
                good = (r[i, 3] != r[j, 3]) & (r[i, 2] != r[j, 2]) & (100 * r[i, 1] >= percent * r[j, 1])  # in order of size
                a.append(np.minimum(r[i, 2], r[j, 2])[good])
                b.append(np.maximum(r[i, 2], r[j, 2])[good])
            none = pa.nulls(sum(map(len, a)), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, pa.array(np.concatenate(a)), pa.array(np.concatenate(b)), none, none], names)

        def blocks(r: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            ids = number + np.arange(len(r)) // block
            number = int(ids[-1]) + 1
            return pa.RecordBatch.from_arrays([pa.array(r[:, 0]), pa.array(ids), pa.array(r[:, 2]), pa.nulls(len(r), pa.int64()), pa.array(r[:, 3]), pa.array(r[:, 1])], names)

        for batch in batches:
            rows = np.stack([c.to_numpy() for c in batch.columns], axis=1)
            if not len(rows):
                continue
            rows = rows if held is None else np.concatenate([held, rows])
            starts = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
            ends = np.append(starts[1:], len(rows))
            open_ = np.minimum.reduceat(rows[:, 3], starts) != np.maximum.reduceat(rows[:, 3], starts)
            few = []
            for k in np.flatnonzero(open_ | (starts == 0)).tolist():
                if k == len(starts) - 1:
                    break  # perhaps not whole yet
                r = rows[starts[k] : ends[k]]
                if (k == 0 and cut) or (open_[k] and len(r) > small):
                    yield blocks(r)
                elif open_[k]:
                    few.append(r)
            if few:
                yield pairs(few)
            cut = cut and len(starts) == 1
            held = rows[starts[-1] :]
            full = len(held) // block * block
            if full > block:  # a long run goes out block by block
                yield blocks(held[:full])
                held, cut = held[full:], True
                if not len(held):
                    held = None
        if held is not None:
            yield blocks(held)  # the run may go on in the next partition

    return _dealt(tagged.select("bucket", "size", "node", "label"), "bucket", "size", "node").mapInArrow(run, "bucket long, block long, a long, b long, label long, size long")


def _block_meetings(blocked: DataFrame, sets: DataFrame, tables: Tables, percent: int) -> DataFrame:
    """Links between components inside buckets that were cut into blocks; ``blocked`` has bucket, block, node, label and size."""
    ranges = blocked.groupBy("bucket", "block").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("size").alias("least"), F.max("size").alias("most"))
    ranges = tables.written(ranges, "blocks")  # a row for each block
    x, y = ranges.alias("x"), ranges.alias("y")
    meets = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.block") <= F.col("y.block")))
    meets = meets.where(f"least(x.low, y.low) <> greatest(x.high, y.high) and 100 * x.most >= {percent} * y.least and 100 * y.most >= {percent} * x.least")
    meets = meets.select(F.col("x.block").alias("i"), F.col("y.block").alias("j"))
    # Joined by block, not by bucket: no key has more than ``block`` rows.
    sides = meets.select("i", "j", F.col("i").alias("block")).unionByName(meets.where("i <> j").select("i", "j", F.col("j").alias("block")))
    sent = blocked.select("block", "node", "label").join(tables.written(sides, "meets"), "block").select("i", "j", "node", "label")
    return sent.join(sets, "node").groupBy("i", "j").applyInArrow(_block_links(percent), "a long, b long")


def node_links(docs: DataFrame, nodes: DataFrame, text_col: str, tables: Tables, percent: int = PERCENT, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """node and label of all nodes with a confirmed link; ``nodes`` has node, set_key, text_key, size and bands."""
    own = Tables(docs.sparkSession, "node-links")
    members = _members(nodes, own)
    wanted = own.written(members.select("node").distinct().join(nodes, "node").select("node", "set_key", "text_key"), "wanted")
    sets = own.written(_node_sets(docs, wanted, text_col), "sets")
    near = members.where(f"leader <> node and 100 * least(size, leader_size) >= {percent} * greatest(size, leader_size)")
    first = near.groupBy(F.col("node").alias("b")).agg(F.min("leader").alias("a")).select("a", "b")
    edges = own.written(_confirmed(first, sets, percent), "links")
    labels = components(edges, own)
    left = own.written(_second_sweep(_with_label(members, labels), percent, small, block), "open")
    blocked = left.where("block is not null").select("bucket", "block", F.col("a").alias("node"), "label", "size")
    more = _confirmed(left.where("block is null").select("a", "b").distinct(), sets, percent).unionByName(_block_meetings(blocked, sets, own, percent))
    labels = tables.written(components(edges.unionByName(own.written(more, "links")), own), "labels")
    own.clear()
    return labels


def _grouped(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, percent: int, row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The signature of every row, and set_key, label (of the component) and rep (least doc_id of the set) of every set."""
    tables = Tables(docs.sparkSession, "near-duplicates")
    found = tables.written(signatures(docs, id_col, text_col, bands, rows, row_col), "signatures")
    nodes = found.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.min("text_key").alias("text_key"), F.max("n_shingles").alias("size"), F.any_value("bands", ignoreNulls=True).alias("bands"))
    nodes = tables.written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    labelled = _with_label(nodes.select("node", "rep", "set_key"), node_links(docs, nodes, text_col, tables, percent))
    return found, labelled


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept (doc_id is component_id) of every row."""
    found, labelled = _grouped(docs, id_col, text_col, bands, rows, percent)
    least = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = labelled.join(least, "label").select("set_key", "component_id")
    out = found.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each component, and every row that has no shingle.

    Rows and not ids are judged, so a repeated or null doc_id neither saves a copy nor takes another text away. The row with the
    smallest doc_id stays (null last), then the one with the smallest hash of text and other columns; of equal rows any one.
    """
    tables = Tables(docs.sparkSession, "deduplicated")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*columns).alias("doc"), F.xxhash64(*columns).alias("tie"))
    keyed = tables.written(keyed, "rows")  # row numbers are fixed from here on
    texts = keyed.select("row", F.col(f"doc.`{id_col}`").alias("doc_id"), F.col(f"doc.`{text_col}`").alias("text"))
    found, labelled = _grouped(texts, "doc_id", "text", bands, rows, percent, row_col="row")
    ties = found.select("row", "doc_id", "set_key").join(keyed.select("row", "tie"), "row")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie", "row")
    by_set = ties.where("set_key is not null").groupBy("set_key").agg(F.min(rank).alias("first"))
    chosen = by_set.join(labelled.select("set_key", "label"), "set_key").groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row"))
    stay = tables.written(chosen.unionByName(found.where("n_shingles = 0").select("row")), "stay")
    return keyed.join(stay.hint("merge"), "row", "left_semi").select("doc.*")  # as many survivors as rows, perhaps: never broadcast

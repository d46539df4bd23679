"""SimHash near-duplicates by a grid over per-segment bit counts."""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import add_columns
from tidemark.llm.components import connected_components
from tidemark.shared import new_folder

SHINGLE_WORDS = 4
MOST_BITS = 4
SEED = 42
#: The 32 segments of two bits lie in one of these numbers of blocks; fingerprints within ``MOST_BITS`` agree in all counts
#: of all blocks but ``MOST_BITS`` at least. More blocks make more and smaller cells.
BLOCKS = range(7, 25)
#: Fingerprints that one task compares with each other; a fuller cell is cut into pairs of parts.
PART = 2048
#: Up to this many, the fingerprints of a cell are compared at once with those of other cells.
SMALL_CELL = 24
_BITS_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Majority bits of the XXH64 values of all shingles, as a signed 64-bit number; zero without words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    # bytes.lower() changes A-Z alone, bytes.split() cuts at space and U+0009 to U+000D
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    starts = [0, *ends[: n - 1].tolist()]
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _BITS_AT_ONCE):
        ones += np.unpackbits(hashes[at : at + _BITS_AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """The id and the ``fingerprint`` (long) of each row; a null text has no words."""
    return add_columns(docs, [id_column], [text_column], lambda: lambda part: {"fingerprint": [fingerprint(t, shingle) for t in part[text_column]]}, {"fingerprint": "long"})


def segment_counts(fingerprint_column: str) -> Column:
    """Bit counts of the 32 two-bit segments, packed in their places: a half adder, since sums could overflow."""
    low = F.lit(0x5555555555555555)
    first, second = F.col(fingerprint_column).bitwiseAND(low), F.shiftrightunsigned(fingerprint_column, 1).bitwiseAND(low)
    return first.bitwiseXOR(second).bitwiseOR(F.shiftleft(first.bitwiseAND(second), 1))


def blocks_for(n: int, most_bits: int = MOST_BITS) -> int:
    """Blocks with the least work for a fingerprint among ``n``: its cells, and those it meets there by chance.

    Two random segments have equal counts with probability 3/8. So the pairs that meet grow with little more than the
    number of fingerprints, not with its square.
    """
    cells = {b: comb(b, most_bits) for b in BLOCKS}
    return min(BLOCKS, key=lambda b: cells[b] * (1 + n * 0.375 ** (32 * (b - most_bits) / b)))


def cell_masks(blocks: int = BLOCKS[0], most_bits: int = MOST_BITS) -> list[int]:
    """Masks over the packed counts, one for each choice of blocks that may have to agree.

    The Manhattan distance of the counts is at most the number of differing bits, so at most ``most_bits``
    blocks hold a difference and the others agree.
    """
    cut = [round(32 * k / blocks) for k in range(blocks + 1)]
    parts = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(cut, cut[1:])]
    masks = [reduce(lambda x, y: x | y, chosen) for chosen in combinations(parts, blocks - most_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def cells(distinct: DataFrame, blocks: int) -> DataFrame:
    """(cell, fp): each fingerprint in its grid cell of every choice of blocks."""
    masks = F.array(*[F.lit(m) for m in cell_masks(blocks)])
    counted = distinct.select("fp", segment_counts("fp").alias("counts"))
    return counted.select("fp", "counts", F.posexplode(masks).alias("k", "mask")).select(F.xxhash64("k", F.col("counts").bitwiseAND(F.col("mask"))).alias("cell"), "fp")


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs pass the lower bound on their counts, and then the exact test."""
    half = np.uint64(0x5555555555555555)
    left, right = a - ((a >> np.uint64(1)) & half), b - ((b >> np.uint64(1)) & half)
    # Two-bit counts differ by 1 or 2: bit 0 of the difference's size is the exclusive or of bits 0, bit 1 is left when those agree.
    odd, two = (left ^ right) & half, ((left ^ right) >> np.uint64(1)) & half
    bound = np.bitwise_count(odd).astype(np.int8) + 2 * np.bitwise_count(two & ~odd & half).astype(np.int8)
    near = bound <= MOST_BITS
    near[near] = np.bitwise_count((a ^ b)[near]) <= MOST_BITS
    return near


def _links(values: np.ndarray, other: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``values``, or between them and ``other``, that span all components: not all pairs."""
    right = values if other is None else other
    nodes = values if other is None else np.concatenate([values, other])
    label = np.arange(len(nodes))
    shift = 0 if other is None else len(values)
    rows, columns = [], []
    for at in range(0, len(values), 256):
        left = values[at : at + 256]
        near = _near(np.repeat(left, len(right)), np.tile(right, len(left)))
        hit = np.flatnonzero(near)
        rows.append(hit // len(right) + at)
        columns.append(hit % len(right) + shift)
    i, j = np.concatenate(rows), np.concatenate(columns)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        np.minimum.at(new, label[i], least)
        np.minimum.at(new, label[j], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _runs(batches):
    """Sorted (cell, fp) rows as arrays that hold whole cells; of a cell over ``PART`` rows its key and its size."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    skipped = 0  # rows of the last cell that are no longer held
    for batch in batches:
        cell, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        if held:
            cell, fp = np.concatenate([held[0][0], cell]), np.concatenate([held[0][1], fp])
        if not len(cell):
            continue
        last = int(np.searchsorted(cell, cell[-1], side="left"))
        if last:
            yield cell[:last], fp[:last], skipped
            skipped = 0
        cell, fp = cell[last:], fp[last:]
        if len(cell) > PART + 1:
            skipped += len(cell) - PART - 1
            cell, fp = cell[: PART + 1], fp[: PART + 1]
        held = [(cell, fp)]
    if held:
        yield held[0][0], held[0][1], skipped


_LINK_SCHEMA = "a long, b long, size long"


def _link_batch(a: np.ndarray, b: np.ndarray, size: np.ndarray | None = None) -> pa.RecordBatch:
    size = np.zeros(len(a), dtype=np.int64) if size is None else size
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(size)], names=["a", "b", "size"])


def _cell_links(batches):
    for cell, fp, skipped in _runs(batches):
        new = np.r_[True, cell[1:] != cell[:-1]]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(cell)])
        lag, small = 1, np.repeat((sizes > 1) & (sizes <= SMALL_CELL), sizes)
        while lag < SMALL_CELL:
            i = np.flatnonzero(small[:-lag] & (cell[lag:] == cell[:-lag])) if lag < len(cell) else np.empty(0, dtype=np.int64)
            if not len(i):
                break
            i = i[_near(fp[i], fp[i + lag])]
            if len(i):
                yield _link_batch(fp[i], fp[i + lag])
            lag += 1
        for k in np.flatnonzero(sizes > SMALL_CELL):
            start, size = starts[k], int(sizes[k])
            if size > PART:
                # skipped rows belong to the cell that came over from the batch before, the first one here
                full = size + (skipped if k == 0 else 0)
                yield _link_batch(cell[start : start + 1], np.zeros(1, dtype=np.int64), np.array([full]))
            else:
                yield _link_batch(*_links(fp[start : start + size]))


def _pair_links(batches):
    """The same for pairs of parts: rows (cell, i, j, part, fp) sorted by the first three."""
    key, held = None, []

    def done():
        part = np.concatenate([p for p, _ in held])
        fp = np.concatenate([f for _, f in held])
        i, j = key[1], key[2]
        return _link_batch(*(_links(fp) if i == j else _links(fp[part == i], fp[part == j])))

    for batch in batches:
        columns = [batch.column(k).to_numpy() for k in range(5)]
        if not batch.num_rows:
            continue
        change = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)])
        for a, b in zip(change, [*change[1:], batch.num_rows]):
            this = tuple(int(c[a]) for c in columns[:3])
            if key is not None and this != key:
                yield done()
                held = []
            key = this
            held.append((columns[3][a:b], columns[4][a:b].view(np.uint64)))
    if held:
        yield done()


def near_links(distinct: DataFrame) -> DataFrame:
    """(a, b) links between distinct fingerprints that differ in at most ``MOST_BITS`` bits.

    Not every near pair is a link, but the links connect every near pair. Cells are compared inside tasks. A
    cell over ``PART`` fingerprints is reported instead; its rows are then cut into parts by hash, and every pair of
    parts is a task group of its own: bounded tasks, no pair left out.
    """
    spark = distinct.sparkSession
    gridded = cells(distinct, blocks_for(distinct.count()))
    folder = new_folder(spark, "simhash-links")
    gridded.repartition("cell").sortWithinPartitions("cell").mapInArrow(_cell_links, _LINK_SCHEMA).write.parquet(folder)
    found = spark.read.parquet(folder)
    links = found.where("size = 0").select("a", "b")
    full = found.where("size > 0").select(F.col("a").alias("cell"), F.ceil(F.col("size") / PART).cast("int").alias("parts"))
    if not full.take(1):
        return links
    parted = gridded.join(full, "cell").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    pairs = parted.select(
        "cell", "part", "fp", F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least(k, F.col("part")).alias("i"), F.greatest(k, F.col("part")).alias("j")))).alias("pair")
    ).select("cell", "pair.i", "pair.j", "part", "fp")
    more = pairs.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j").mapInArrow(_pair_links, _LINK_SCHEMA)
    return links.unionByName(more.select("a", "b"))


def near_duplicates(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``fingerprint`` (long) and ``component_id`` of each row: the smallest id that near links lead to.

    Equal fingerprints are one node, so copies never meet in pairs. Rows without words have fingerprint zero and
    are linked like any others. Repeated rows stay and share a component; a null id never becomes the
    smallest one, and a component without any id has a null component_id. An empty table gives an empty result,
    other columns are not read.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "simhash-fingerprints")
    fingerprints(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")), id_column="id").write.parquet(folder)
    rows = spark.read.parquet(folder)
    nodes = rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("id").alias("least"))
    roots = connected_components(near_links(nodes.select("fp")))
    member = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = member.select("fp", "root").join(least, "root").select(F.col("fp").alias("fingerprint"), "component_id")
    return rows.join(classes, "fingerprint").select(F.col("id").alias(id_column), "fingerprint", "component_id")

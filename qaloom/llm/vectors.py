"""Near-duplicate vectors: exact cosine links by PCA-ordered tiled comparison."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qaloom.llm.components import connected_components
from qaloom.llm.shared import bound_batches, runs_of
from qaloom.session import materialise

THRESHOLD = 0.93
BLOCK = 1024
LEAD = 8
EDGE = 1e-9
CELLS = 4096
#: so many leading components are turned to the principal axes; those after them stay as they are
ROTATED = 1024


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as a matrix, each row scaled to a largest component of 1."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return x / np.abs(x).max(axis=1, keepdims=True)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _turn(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Rows along the axes, and their components past the axes as they are; lengths and products stay the same."""
    n = len(axes)
    return x @ axes[: x.shape[1]] if x.shape[1] <= n else np.concatenate((x[:, :n] @ axes, x[:, n:]), axis=1)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sum of outer products of its unit vectors' leading components, a row of the matrix at a time."""
    total = np.zeros((0, 0))
    for batch in batches:
        for dim in np.unique(batch.column("dim").to_numpy()):
            x = _matrix(batch.filter(pc.equal(batch.column("dim"), int(dim))).column("vector"))
            x = _unit(x)[:, :ROTATED]
            size = x.shape[1]
            if size > len(total):
                total = np.pad(total, (0, size - len(total)))
            total[:size, :size] += x.T @ x
    i, j = np.indices(total.shape)
    yield pa.RecordBatch.from_arrays(
        [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "v"]
    )


def principal_axes(vectors: DataFrame) -> np.ndarray:
    """Orthonormal axes, the one with most of the vectors' squared length first.

    From the second moments of the leading ``ROTATED`` components of all vectors
    (shorter ones count as padded with zeros); the sums are added up by Spark, and
    only the matrix reaches the driver.
    """
    parts = vectors.mapInArrow(_moments, "i int, j int, v double")
    rows = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    size = max((r["i"] for r in rows), default=-1) + 1
    moments = np.zeros((size, size))
    for r in rows:
        moments[r["i"], r["j"]] = r["v"]
    return np.linalg.eigh(moments)[1][:, ::-1] if size else moments


def _products(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The products of the rows ``i`` of ``x`` and ``j`` of ``y``."""
    if 8 * len(i) > len(x) * len(y):
        return (x @ y.T)[i, j]
    step = max(1, (1 << 20) // x.shape[1])
    parts = [np.einsum("pd,pd->p", x[i[k : k + step]], y[j[k : k + step]]) for k in range(0, len(i), step)]
    return np.concatenate(parts)


def linked_pairs(
    x: np.ndarray, y: np.ndarray, raw_x: np.ndarray, raw_y: np.ndarray, threshold: float, lead: int = LEAD
) -> np.ndarray:
    """Which rows of ``x`` and ``y`` (unit vectors along the principal axes) reach the cosine.

    Products are added up over ever more leading dimensions. By Cauchy's inequality
    what the rest can add is at most the product of the two suffix norms; a pair
    leaves once that can't bring it to the threshold, and the comparison ends when
    no pair is left. Pairs that end within rounding of the threshold are decided by
    their given vectors.
    """
    dims = x.shape[1]
    ends = [e for e in (lead << k for k in range(16)) if e < dims] + [dims]
    rest_x, rest_y = (np.sqrt(np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1]) for m in (x, y))
    start = ends[0]
    got = x[:, :start] @ y[:, :start].T
    bound = rest_x[:, [start]] * rest_y[:, start] if start < dims else 0.0
    i, j = np.nonzero(got + bound >= threshold - EDGE)
    got = got[i, j]
    for end in ends[1:]:
        if not len(i):
            break
        got = got + _products(x[:, start:end], y[:, start:end], i, j)
        bound = rest_x[i, end] * rest_y[j, end] if end < dims else 0.0
        keep = got + bound >= threshold - EDGE
        i, j, got, start = i[keep], j[keep], got[keep], end
    if len(near := np.flatnonzero(np.abs(got - threshold) <= EDGE)):
        a, b = raw_x[i[near]], raw_y[j[near]]
        cos = np.einsum("pd,pd->p", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))
        got[near] = cos
    keep = got >= threshold
    return np.stack([i[keep], j[keep]], axis=1)


def _spanning(n: int, pairs: np.ndarray) -> list[int]:
    """Which of the pairs are needed to connect what all of them connect."""
    root = list(range(n))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    out = []
    for at, (a, b) in enumerate(pairs.tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append(at)
    return out


SIDE = 512


def _compare_tiles(axes: np.ndarray, threshold: float):
    """Task body: rows of a tile (one or two blocks) come in together; out go the links
    each vector has in the tile, and the few links that connect the tile's parts."""

    def tile(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = _matrix(batch.column("vector"))
        ids, copies = batch.column("node").to_numpy(), batch.column("copies").to_numpy()
        second = batch.column("second").to_numpy(zero_copy_only=False)
        unit = _turn(_unit(raw), axes)
        a = np.flatnonzero(~second)
        b = np.flatnonzero(second) if second.any() else a
        links = np.zeros(len(ids), dtype=np.int64)
        kept: list[np.ndarray] = [np.empty((0, 2), np.int64)]
        for p in range(0, len(a), SIDE):
            for q in range(p if b is a else 0, len(b), SIDE):
                i, j = a[p : p + SIDE], b[q : q + SIDE]
                found = linked_pairs(unit[i], unit[j], raw[i], raw[j], threshold)
                pairs = np.stack([i[found[:, 0]], j[found[:, 1]]], axis=1)
                if b is a:
                    pairs = pairs[pairs[:, 0] < pairs[:, 1]]
                np.add.at(links, pairs[:, 0], copies[pairs[:, 1]])
                np.add.at(links, pairs[:, 1], copies[pairs[:, 0]])
                kept.append(pairs[_spanning(len(ids), pairs)])
        pairs = np.concatenate(kept)
        pairs = pairs[_spanning(len(ids), pairs)]
        own = np.flatnonzero(links)
        nodes = np.concatenate((ids[own], ids[pairs[:, 0]]))
        other = pa.array(np.concatenate((ids[own], ids[pairs[:, 1]])), mask=np.arange(len(nodes)) < len(own))
        count = np.concatenate((links[own], np.zeros(len(pairs), np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(nodes), other, pa.array(count)], ["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            for s, e in zip(*runs_of(batch.column("tile").to_numpy())):
                part = batch.slice(s, e - s)
                if held and held[0].column("tile")[0] != part.column("tile")[0]:
                    yield tile(pa.concat_batches(held))
                    held = []
                held.append(part)
        if held:
            yield tile(pa.concat_batches(held))

    return run


def _place(axes: np.ndarray, lead: int):
    """Task body: adds each unit vector's place along the leading axes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, e in zip(*runs_of(batch.column("dim").to_numpy())) if batch.num_rows else ():
                part = batch.slice(s, e - s)
                x = _unit(_matrix(part.column("vector")))[:, : len(axes)]
                at = x @ axes[: x.shape[1], :lead]
                ends = pa.array(np.arange(0, at.size + 1, lead), pa.int32())
                yield part.append_column("at", pa.ListArray.from_arrays(ends, pa.array(at.ravel())))

    return run


def _blocks(placed: DataFrame, block: int) -> DataFrame:
    """``placed`` with ``block``: about ``block`` neighbours along the first axis in each.

    Blocks of vectors past ``ROTATED`` components have fewer rows, so that all hold about as many numbers.
    Counts of ``CELLS`` cells per label give the places of the cuts; the vectors of one
    cell are dealt over its places by a hash, so that a dense cell is several blocks.
    """
    key = ["label", "dim"]
    cell = F.floor((F.col("at")[0] + 1.0) / 2.0 * CELLS).cast("int").alias("cell")
    rows = placed.withColumn("cell", cell)
    before = Window.partitionBy(*key).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy(*key, "cell").agg(F.count("*").alias("n"))
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    part = F.pmod(F.xxhash64("node"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rows_in = F.greatest(F.lit(1), F.floor(F.lit(block * ROTATED) / F.greatest(F.col("dim"), F.lit(ROTATED))))
    place = F.floor((F.col("before") + F.col("n") * part) / rows_in).cast("long")
    return rows.join(cells, [*key, "cell"]).withColumn("block", place).drop("cell", "n", "before")


def _tiles(blocks: DataFrame, lead: int, threshold: float) -> DataFrame:
    """Pairs of blocks of one label that may hold a link: ``label``, ``dim``, ``first``, ``last``, ``tile``."""
    key = ["label", "dim"]
    ends = blocks.groupBy(*key, "block").agg(
        F.array(*(F.min(F.col("at")[k]) for k in range(lead))).alias("low"),
        F.array(*(F.max(F.col("at")[k]) for k in range(lead))).alias("high"),
    )
    a = ends.select(*key, F.col("block").alias("first"), F.col("low").alias("low_a"), F.col("high").alias("high_a"))
    b = ends.select(*key, F.col("block").alias("last"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    gaps = [
        F.greatest(F.lit(0.0), F.col("low_a")[k] - F.col("high_b")[k], F.col("low_b")[k] - F.col("high_a")[k])
        for k in range(lead)
    ]
    apart = sum((g * g for g in gaps), F.lit(0.0))
    pairs = a.join(b, key).where((F.col("first") <= F.col("last")) & (apart <= 2 - 2 * threshold + EDGE))
    return pairs.select(*key, "first", "last", F.xxhash64(*key, "first", "last").alias("tile"))


def vector_links(nodes: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Link counts and connecting links of distinct vectors: ``a``, ``b`` (null in a count's row), ``n``.

    ``nodes`` has ``node``, ``label``, ``dim``, ``vector`` and ``copies``. The vectors of
    a label and length are ordered along the first principal axis and cut into blocks;
    every pair of blocks is a tile, so a label with a third of all rows is many tasks,
    and a task holds one tile at a time. A tile is left out when its blocks' ranges on
    the leading axes are farther apart than the threshold allows (unit vectors with
    that cosine are at most ``sqrt(2 - 2 * threshold)`` apart).
    """
    bound_batches(nodes.sparkSession)
    axes = principal_axes(nodes.select("dim", "vector"))
    lead = min(LEAD, axes.shape[1])
    if not lead:
        return nodes.select(F.col("node").alias("a"), F.col("node").alias("b"), F.col("copies").alias("n"))
    schema = "node long, label string, dim int, copies long, vector array<double>, at array<double>"
    placed = nodes.select("node", "label", "dim", "copies", "vector").mapInArrow(_place(axes, lead), schema)
    blocks = materialise(_blocks(materialise(placed), block))
    tiles = materialise(_tiles(blocks, lead, threshold))
    rows = blocks.drop("at")
    key = ["label", "dim", "block"]
    firsts = rows.join(tiles.withColumnRenamed("first", "block").drop("last"), key).withColumn("second", F.lit(False))
    lasts = rows.join(
        tiles.where("first < last").withColumnRenamed("last", "block").drop("first"), key
    ).withColumn("second", F.lit(True))
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = firsts.unionByName(lasts).select("tile", "second", "node", "copies", "vector")
    dealt = dealt.repartition(parts, "tile").sortWithinPartitions("tile")
    return dealt.mapInArrow(_compare_tiles(axes, threshold), "a long, b long, n long")


def vector_groups(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """``id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors``.

    Two rows link if their labels are equal and not null, their vectors are as long
    as each other, and the cosine in double precision reaches ``threshold``. A null
    or empty vector, one with a null, NaN or infinite component and the zero vector
    link with nothing. Equal vectors are compared once and counted as often as they
    occur, so a group of copies of any size is one vector. ``component_id`` is the
    smallest id reachable, ``kept`` says whether that is the row's own. A null id
    gives no name to its group. Repeated rows are rows of their own. Vectors may have
    any number of components. An empty table gives an empty table.
    """
    given = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    fine = F.coalesce(fine, F.lit(False)) & F.exists("vector", lambda v: v != 0) & F.col("label").isNotNull()
    given = given.withColumn("key", F.when(fine, F.xxhash64("label", "vector")))
    distinct = given.where("key is not null").groupBy("key", "label", "vector")
    nodes = materialise(
        distinct.agg(F.min("id").alias("first"), F.count("*").alias("copies")).select(
            F.monotonically_increasing_id().alias("node"),
            "key",
            "label",
            F.size("vector").alias("dim"),
            "vector",
            "first",
            "copies",
        )
    )
    links = materialise(vector_links(nodes, threshold, block))
    counts = links.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    parts = materialise(connected_components(links.where("b is not null").select("a", "b"))).withColumnRenamed(
        "node", "linked"
    )
    named = nodes.join(counts, "node", "left").join(parts, F.col("node") == F.col("linked"), "left")
    named = named.withColumn("group", F.coalesce("component", "node"))
    names = named.groupBy("group").agg(F.min("first").alias("component_id"))
    found = named.join(names, "group").select(
        "key", "label", "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    return given.join(found, ["key", "label", "vector"], "left").select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("key").isNull(), True).otherwise(F.col("id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )

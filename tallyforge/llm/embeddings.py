"""Near duplicates of embeddings by PCA-ordered tiled comparison."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import components, settle, slices

# Leading axes whose cells decide which vectors can meet, at most; dimensions compared at a time.
GRID = 4
STEP = 8
# Room for rounding where a bound prunes; pairs at the threshold that are looked at together.
SLACK = 1e-9
PAIRS = 1 << 14


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return np.array(column.flatten().cast(pa.float64())).reshape(len(column), dims)


def principal(vectors: DataFrame, dims: int) -> np.ndarray:
    """Principal axes of all unit vectors, strongest first: every task sums its outer products, and the
    sums (dims x dims numbers a task) are added up by entry before they reach the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((dims, dims)), 0
        for batch in batches:
            x = _matrix(batch.column("v"), dims)
            x /= np.linalg.norm(x, axis=1)[:, None]
            total, seen = total + x.T @ x, seen + len(x)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], names=["i", "s"])

    rows = vectors.select("v").mapInArrow(sums, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    second = np.zeros(dims * dims)
    for r in rows:
        second[r["i"]] = r["s"]
    _, axes = np.linalg.eigh(second.reshape(dims, dims))
    return axes[:, ::-1]


def _find(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of each row of ``x`` with the same row of ``y``."""
    dot = lambda a, b: np.einsum("ij,ij->i", a, b)
    return dot(x, y) / np.sqrt(dot(x, x) * dot(y, y))


def compare(
    x: np.ndarray, y: np.ndarray, threshold: float, given: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of ``x`` and ``y`` with cosine of at least ``threshold``.

    Rows are unit vectors on the principal axes. Products of the leading dimensions accumulate step by
    step; what is left of a product is at most the product of the norms of the two suffixes, and a pair
    is dropped when even that cannot reach the threshold. What remains is the whole product, in double
    precision. Turning the axes changes it by a few units in the last place, so pairs within SLACK of the
    threshold are decided on the vectors as ``given``, where these are passed.
    """
    dims = x.shape[1]
    tails = lambda m: np.sqrt(np.maximum(0, np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1]))
    tail_x, tail_y = tails(x), tails(y)
    at = min(STEP, dims)
    so_far = x[:, :at] @ y[:, :at].T
    rest = tail_x[:, at][:, None] * tail_y[:, at][None, :] if at < dims else 0.0
    i, j = np.nonzero(so_far + rest >= threshold - SLACK)
    value = so_far[i, j]
    while at < dims and len(i):
        to = min(at + STEP, dims)
        if len(i) * 4 > x.shape[0] * y.shape[0]:  # most pairs are left: one matrix product beats picking rows
            value = value + (x[:, at:to] @ y[:, at:to].T)[i, j]
        else:
            value = value + np.einsum("ij,ij->i", x[i, at:to], y[j, at:to])
        at = to
        bound = value + (tail_x[i, at] * tail_y[j, at] if at < dims else 0.0)
        keep = bound >= threshold - SLACK
        i, j, value = i[keep], j[keep], value[keep]
    keep = value >= threshold
    if given is not None and len(border := np.flatnonzero(np.abs(value - threshold) <= SLACK)):
        for k in range(0, len(border), PAIRS):
            part = border[k : k + PAIRS]
            keep[part] = cosines(given[0][i[part]], given[1][j[part]]) >= threshold
    return i[keep], j[keep]


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.98, *, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", rows_per_tile: int = 1024,
) -> DataFrame:
    """Rows of equal, non-null label whose cosine reaches ``threshold`` are linked.

    All vectors are turned onto the principal axes of the corpus. Unit vectors with that cosine differ by
    at most d = sqrt(2 - 2 threshold) in any direction, so on a grid of side d over the leading axes only
    neighbouring cells of the same label can link. Cells are cut into tiles of bounded size, and every
    pair of tiles is one task's work (``compare``): a hot cell becomes many small tasks, none of which
    holds more than two tiles. Equal vectors of a label are compared once and count as often as they
    occur. A pair of tiles reports counts by vector and the links of a spanning forest, never its pairs.

    Vectors that are null, zero or hold null or non-finite parts, and rows without a label, link with
    nothing; so do vectors of different lengths. Rows with the same id and vector are copies of each
    other and link. Null ids and an empty table are fine: every input row gives one row. Other columns
    are left out, whatever their names.

    Returns vec_id, n_links, component_id (the smallest vec_id reachable), kept (vec_id = component_id).
    """
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.coalesce(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False)
    )
    rows = settle(
        vectors.select(
            F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), v.alias("v"),
            (fine & F.col(label_col).isNotNull()).alias("fine"), F.monotonically_increasing_id().alias("rid"),
        ),
        "vectors",
    )
    # One representative of equal vectors; -0.0 and 0.0 are equal.
    key = F.sha2(F.concat_ws(",", F.transform("v", lambda x: (x + 0.0).cast("string"))), 256)
    named = rows.where("fine").withColumn("key", key)
    distinct = settle(
        named.groupBy("label", "key").agg(
            F.count("*").alias("copies"), F.first("v").alias("v"), F.min("rid").alias("node"),
        ),
        "vectors-distinct",
    )
    lengths = [r[0] for r in distinct.select(F.size("v")).distinct().collect()]
    if not lengths:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"),
        )
    links = None
    for dims in sorted(lengths):
        found = _links(distinct.where(F.size("v") == dims), dims, threshold, rows_per_tile)
        links = found if links is None else links.unionByName(found)
    links = settle(links, "vector-links")

    counted = links.where("other IS NULL").groupBy("node").agg(F.sum("n").cast("long").alias("n"))
    joined = components(links.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")), "vector-components")
    nodes = (
        distinct.select("label", "key", "node", "copies").join(counted, "node", "left").join(joined, "node", "left")
        .select("label", "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    )
    members = settle(
        named.select("vec_id", "label", "key").join(nodes, ["label", "key"]).select("vec_id", "n_links", "root"), "vector-members"
    )
    smallest = members.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    linked = members.join(smallest, "root").select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _links(distinct: DataFrame, dims: int, threshold: float, rows_per_tile: int) -> DataFrame:
    """Links between different vectors of one length: (node, n) with ``other`` null counts them, (node,
    other) with ``n`` null joins two nodes of a component."""
    axes = principal(distinct, dims)
    side = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    # An axis more cuts a cell in about four and gives it three times the neighbours: worth it once cells
    # hold several tiles.
    most = distinct.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    grid = min(GRID, dims, max(1, math.ceil(math.log(most / (4 * rows_per_tile), 4)) if most > 4 * rows_per_tile else 1))

    def turned_rows(raw: np.ndarray) -> np.ndarray:
        return (raw / np.linalg.norm(raw, axis=1)[:, None]) @ axes

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.floor(turned_rows(_matrix(batch.column("v"), dims))[:, :grid] / side).astype(np.int32)
            lists = lambda m, t: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel(), t))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("node"), batch.column("copies"), batch.column("v"), lists(cell, pa.int32())],
                names=["label", "node", "copies", "v", "cell"],
            )

    kind = distinct.schema["label"].dataType.simpleString()
    turned = settle(
        distinct.select("label", "node", "copies", "v")
        .mapInArrow(turn, f"label {kind}, node long, copies long, v array<double>, cell array<int>"),
        "vectors-turned",
    )
    # Tiles: a cell is cut by a hash into as many as its rows ask for.
    sizes = turned.groupBy("label", "cell").agg(F.count("*").alias("n")).withColumn("tiles", F.ceil(F.col("n") / rows_per_tile).cast("int"))
    tiled = turned.join(sizes.select("label", "cell", "tiles"), ["label", "cell"]).withColumn(
        "tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    ).drop("tiles")
    # Pairs of tiles that can link: of one cell, or of neighbouring ones; each pair once.
    steps = [s for s in itertools.product((-1, 0, 1), repeat=grid) if s > (0,) * grid]
    cells = settle(sizes.select("label", "cell", "tiles"), "vector-cells")
    near = cells.select(
        "label", F.col("cell").alias("cell_a"), F.col("tiles").alias("tiles_a"),
        F.explode(F.array(*[
            F.struct(F.array(*[F.col("cell")[k] + s[k] for k in range(grid)]).alias("cell"), F.lit(any(s)).alias("other"))
            for s in [(0,) * grid, *steps]
        ])).alias("to"),
    ).select("label", "cell_a", "tiles_a", F.col("to.cell").alias("cell_b"), F.col("to.other").alias("other"))
    pairs = (
        near.join(cells.select("label", F.col("cell").alias("cell_b"), F.col("tiles").alias("tiles_b")), ["label", "cell_b"])
        .withColumn("tile_a", F.explode(F.sequence(F.lit(0), F.col("tiles_a") - 1)))
        .withColumn("tile_b", F.explode(F.sequence(F.lit(0), F.col("tiles_b") - 1)))
        .where("other OR tile_a <= tile_b")
    )
    # Pairs are told apart by their columns: a hash of them may be shared by two labels.
    pair = ["label", "cell_a", "cell_b", "tile_a", "tile_b"]
    side_a = pairs.select(*pair, F.col("cell_a").alias("cell"), F.col("tile_a").alias("tile"), F.lit(0).alias("side"))
    side_b = pairs.where("other OR tile_a <> tile_b").select(
        *pair, F.col("cell_b").alias("cell"), F.col("tile_b").alias("tile"), F.lit(1).alias("side")
    )
    work = tiled.join(side_a.unionByName(side_b), ["label", "cell", "tile"]).select(*pair, "side", "node", "copies", "v")

    def link(group: pa.Table) -> pa.Table:
        out_node, out_other, out_n = [], [], []
        group = group.combine_chunks()
        side_of = np.array(group.column("side"))
        node, copies = np.array(group.column("node")), np.array(group.column("copies"))
        raw = _matrix(group.column("v").chunk(0), dims)
        x = turned_rows(raw)
        a, b = np.nonzero(side_of == 0)[0], np.nonzero(side_of == 1)[0]
        same = not len(b)
        if same:
            b = a
        i, j = compare(x[a], x[b], threshold, (raw[a], raw[b]))
        if same:
            keep = i != j
            i, j = i[keep], j[keep]
        i, j = a[i], b[j]
        counts = np.zeros(len(node), np.int64)
        np.add.at(counts, i, copies[j])
        if not same:
            np.add.at(counts, j, copies[i])
        # A spanning forest of the links: at most one link a vector.
        parent = np.arange(len(node))
        for p, q in zip(i.tolist(), j.tolist()):
            if same and p > q:
                continue
            p, q = _find(parent, p), _find(parent, q)
            if p != q:
                parent[max(p, q)] = min(p, q)
        for k in np.nonzero(counts)[0].tolist():
            out_node.append(int(node[k])), out_other.append(None), out_n.append(int(counts[k]))
            root = _find(parent, k)
            if root != k:
                out_node.append(int(node[k])), out_other.append(int(node[root])), out_n.append(None)
        return pa.table({"node": pa.array(out_node, pa.int64()), "other": pa.array(out_other, pa.int64()), "n": pa.array(out_n, pa.int64())})

    return work.groupBy(*pair).applyInArrow(link, "node long, other long, n long")

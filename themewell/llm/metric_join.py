"""Exact range join of vectors by cosine, in cells around pivots.

On unit vectors a least cosine is a greatest distance r. Within a label each
vector belongs to the cell of its nearest pivot. By the triangle inequality a
partner of a vector in cell i lies within d(v, p_i) + 2r of p_i, and within the
cell's radius plus r, so a vector is copied to the cells it may have partners in.
Only the vector with the higher cell travels, so each pair meets in one cell.
Cells join independently of each other, large ones in tiles.

Equal vectors are one node with a weight, so a vector that a third of the rows
share costs nothing. A tile gives each node its number of links and a spanning
forest of the links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themewell.llm.arrow import batch_of, map_batches
from themewell.llm.components import components, merge
from themewell.session import cut

CELL_ROWS = 500  # vectors per pivot, while that gives few enough pivots
MAX_PIVOTS = 2048  # in all, besides one per label at most
PIVOT_BYTES = 16 << 20  # of these pivots, which every task is sent
TILE = 4096  # rows of a cell that meet at a time
SLACK = 1e-9  # for rounding of distances, which only decide who meets


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): rows that can have links, in double precision."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    return rows.where(known & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def _nodes(vectors: DataFrame) -> DataFrame:
    """(label, v, node, n): different vectors of a label, their least id and their rows."""
    # -0.0 and 0.0 are equal numbers but other bytes.
    plain = _usable(vectors).withColumn("v", F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)))
    return plain.groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"))


def _pivots(nodes: DataFrame, cell_rows: int, max_pivots: int) -> tuple[dict[tuple[str, int], np.ndarray], int]:
    """Pivots by (label, width): rows drawn by a hash, about one per ``cell_rows``; bounded by ``max_pivots``.

    Labels with fewer rows than a cell have none and are one cell.
    """
    width = F.size("v")
    total, widest = nodes.agg(F.count("*"), F.max(width)).head()
    max_pivots = max(1, min(max_pivots, PIVOT_BYTES // (8 * (widest or 1))))
    cell = max(cell_rows, math.ceil(total / max_pivots))
    large = nodes.groupBy("label", width.alias("width")).count().where(F.col("count") > cell)
    # At most total / cell, so at most max_pivots labels, and in all about twice as many pivots.
    shares = {(r["label"], r["width"]): min(1.0, 1.0 / cell) for r in large.collect()}
    if not shares:
        return {}, cell
    wanted = large.select(F.col("label").alias("_l"), F.col("width").alias("_w"))
    dice = F.pmod(F.xxhash64(F.lit(11), "v"), F.lit(1 << 40)) / float(1 << 40)
    rolled = nodes.withColumn("_dice", dice).where(F.col("_dice") < 1.0 / cell)
    drawn = rolled.join(wanted, (F.col("label") == F.col("_l")) & (width == F.col("_w")))
    out: dict[tuple[str, int], list] = {}
    # About max_pivots rows; which of them are pivots only decides how many rows travel, not what is found.
    for r in drawn.orderBy("_dice", "node").select("label", "v").limit(2 * max_pivots).collect():
        out.setdefault((r["label"], len(r["v"])), []).append(r["v"])
    return {k: unit(np.array(v)) for k, v in out.items()}, cell


def _homes(nodes: DataFrame, pivots: dict) -> DataFrame:
    """(node, n, label, v, cell, d): unit vectors with home cell and distance to its pivot."""

    def make(schema: pa.Schema):
        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                labels = batch.column("label").to_pylist()
                vs = [np.array(v, float) for v in batch.column("v").to_pylist()]
                # The largest component first made 1, so that squares neither vanish nor overflow.
                vs = [v / np.abs(v).max() for v in vs]
                groups: dict = {}
                for i, (label, v) in enumerate(zip(labels, vs, strict=True)):
                    groups.setdefault((label, len(v)), []).append(i)
                cell, far, out = [0] * len(vs), [0.0] * len(vs), [b""] * len(vs)
                for key, at in groups.items():
                    x = unit(np.array([vs[i] for i in at]))
                    near, d = np.zeros(len(at), int), np.zeros(len(at))
                    if key in pivots:
                        gaps = distances(x, pivots[key])
                        near = gaps.argmin(axis=1)
                        d = gaps[np.arange(len(at)), near]
                    for i, c, g, row in zip(at, near, d, x, strict=True):
                        cell[i], far[i], out[i] = int(c), float(g), row.astype("<f8").tobytes()
                yield batch_of(
                    schema,
                    {"node": batch.column("node"), "n": batch.column("n"), "label": labels, "cell": cell, "d": far, "v": out},
                )

        return run

    return map_batches(nodes, make, "node long, n long, label string, cell int, d double, v binary")


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


def _placed(homes: DataFrame, pivots: dict, radii: dict, r: float) -> DataFrame:
    """Rows (label, width, cell, home, node, n, v): each vector at home, and copied to lower cells it may have links in."""

    def make(schema: pa.Schema):
        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                cols = {c: batch.column(c).to_pylist() for c in ("node", "n", "label", "cell", "d", "v")}
                out: dict[str, list] = {f.name: [] for f in schema}
                groups: dict = {}
                for i, (label, v) in enumerate(zip(cols["label"], cols["v"], strict=True)):
                    groups.setdefault((label, len(v) // 8), []).append(i)
                for (label, width), at in groups.items():
                    home = np.array([cols["cell"][i] for i in at])
                    goes = np.zeros((len(at), 1), bool)
                    if (label, width) in pivots:
                        gaps = distances(np.array([np.frombuffer(cols["v"][i], "<f8") for i in at]), pivots[label, width])
                        own = np.array([cols["d"][i] for i in at])
                        reach = np.array([radii.get((label, width, c), -1.0) for c in range(gaps.shape[1])])
                        goes = (gaps <= own[:, None] + 2 * r + SLACK) & (gaps <= reach + r + SLACK) & (reach >= 0)
                        goes &= np.arange(gaps.shape[1]) < home[:, None]
                    for k, i in enumerate(at):
                        for cell in (int(home[k]), *np.flatnonzero(goes[k]).tolist()):
                            row = (label, width, cell, cell == home[k], cols["node"][i], cols["n"][i], cols["v"][i])
                            for name, value in zip(out, row, strict=True):
                                out[name].append(value)
                yield batch_of(schema, out)

        return run

    return map_batches(homes, make, "label string, width int, cell int, home boolean, node long, n long, v binary")


def _tiled(placed: DataFrame, tile: int) -> DataFrame:
    """Adds ``part`` and ``tile``: home parts of a cell meet two by two, and each visiting part meets the home parts.

    A task never holds more than two parts. Visitors do not meet each other here: they do at one's home.
    """
    cell = ["label", "width", "cell"]
    size = lambda rows: F.ceil(F.count(rows) / F.lit(tile)).cast("int")
    sizes = placed.groupBy(*cell).agg(size(F.expr("if(home, 1, null)")).alias("homes"), size(F.expr("if(home, null, 1)")).alias("visits"))
    rows = placed.join(sizes, cell)
    inner = F.pmod(F.xxhash64("node"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("visits")))
    rows = rows.withColumn("part", (inner + F.when(F.col("home"), 0).otherwise(F.col("homes"))).cast("int"))
    parts = F.col("homes") + F.col("visits")
    meets = F.transform(
        F.sequence(F.lit(0), F.when(F.col("home"), parts).otherwise(F.col("homes")) - 1),
        lambda o: (F.least(F.col("part"), o).cast("long") * parts + F.greatest(F.col("part"), o)),
    )
    return rows.select(*cell, F.explode(meets).alias("tile"), "part", "node", "n", "v")


def _meet(tiles: DataFrame, least_cosine: float) -> DataFrame:
    """(node, links, other, pairs): links of a node with rows of other vectors, or a link of the forest (links null).

    ``pairs`` counts the cosines that were computed for the node's row.
    """

    def join(table: pa.Table) -> pa.Table:
        part = table.column("part").to_numpy()
        nodes, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        width = table.column("width")[0].as_py()
        x = np.frombuffer(b"".join(table.column("v").to_pylist()), "<f8").reshape(-1, width)
        groups, links = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
        pairs = np.zeros(len(nodes), np.int64)
        a, b = [], []
        cross = part.min() != part.max()
        left, right = np.flatnonzero(part == part.min()), np.flatnonzero(part == part.max())
        step = max(1, min(256, (1 << 20) // len(right)))
        for at in range(0, len(left), step):
            rows = left[at : at + step]
            cols = right if cross else right[at:]
            near = x[rows] @ x[cols].T >= least_cosine
            if not cross:
                near &= np.arange(len(rows))[:, None] < np.arange(len(cols))
            pairs[rows] = len(cols)
            links[rows] += near @ n[cols]
            links[cols] += n[rows] @ near
            for k in np.flatnonzero(near.any(axis=1)):
                for j in merge(groups, int(rows[k]), cols[near[k]]):
                    a.append(nodes[rows[k]])
                    b.append(nodes[j])
        some = np.flatnonzero((links > 0) | (pairs > 0))
        return pa.table(
            {
                "node": pa.array(np.concatenate((nodes[some], a)).astype(np.int64)),
                "links": pa.array([*links[some].tolist(), *[None] * len(a)], pa.int64()),
                "other": pa.array([*[None] * len(some), *b], pa.int64()),
                "pairs": pa.array([*pairs[some].tolist(), *[0] * len(a)], pa.int64()),
            }
        )

    return tiles.groupBy("label", "width", "cell", "tile").applyInArrow(join, "node long, links long, other long, pairs long")


def placed_vectors(vectors: DataFrame, r: float, cell_rows: int = CELL_ROWS, max_pivots: int = MAX_PIVOTS) -> tuple[DataFrame, DataFrame]:
    """The different vectors, and their places in the cells: (label, width, cell, home, node, n, v)."""
    nodes = cut(_nodes(vectors))
    pivots, _ = _pivots(nodes, cell_rows, max_pivots)
    homes = cut(_homes(nodes, pivots))
    width = (F.octet_length("v") / 8).cast("int").alias("width")
    # A row per pivot at most.
    inner = homes.where(F.col("label").isin(sorted({k[0] for k in pivots}))) if pivots else homes.limit(0)
    radii = {(x["label"], x["width"], x["cell"]): x["d"] for x in inner.groupBy("label", width, "cell").agg(F.max("d").alias("d")).collect()}
    return nodes, cut(_placed(homes, pivots, radii, r))


def work(vectors: DataFrame, least_cosine: float = 0.93, cell_rows: int = CELL_ROWS, max_pivots: int = MAX_PIVOTS, tile: int = TILE) -> DataFrame:
    """(vectors, copies, computed, all_pairs), one row: how far the cells save work on these vectors."""
    nodes, placed = placed_vectors(vectors, math.sqrt(max(0.0, 2 - 2 * least_cosine)), cell_rows, max_pivots)
    each = nodes.groupBy("label", F.size("v")).agg(F.count("*").alias("k"))
    pairs = each.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("vectors"), F.coalesce(F.sum(F.expr("k * (k + 1) div 2")), F.lit(0)).alias("all_pairs"))
    copies = placed.agg(F.count("*").alias("copies"))
    computed = _meet(_tiled(placed, tile), least_cosine).agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("computed"))
    return spread_one(pairs, copies, computed)


def spread_one(*ones: DataFrame) -> DataFrame:
    """One row of the columns of several frames of one row."""
    out = ones[0].withColumn("_one", F.lit(1))
    for more in ones[1:]:
        out = out.join(more.withColumn("_one", F.lit(1)), "_one")
    return out.drop("_one")


def near_vectors(
    vectors: DataFrame,
    least_cosine: float = 0.93,
    cell_rows: int = CELL_ROWS,
    max_pivots: int = MAX_PIVOTS,
    tile: int = TILE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors`` (vec_id, embedding, label).

    Rows of equal, known label and equal width are linked if the cosine in
    double precision is ``least_cosine`` or more. Vectors that are null, empty, zero or
    hold a null, NaN or infinite component have no links and are their own
    component, and so are rows without id (whose component is null). Repeated rows
    are vectors of their own. Empty in, empty out; other columns are not read.
    """
    r = math.sqrt(max(0.0, 2 - 2 * least_cosine))
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    nodes, placed = placed_vectors(ids, r, cell_rows, max_pivots)
    tiles = _tiled(placed, tile)
    met = cut(_meet(tiles, least_cosine))
    links = met.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(met.where("other is not null"), "node", "other")
    found = nodes.select("label", "v", "node", "n").join(links, "node", "left")
    found = found.join(groups, "node", "left").select(
        "label", "v", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component")
    )
    zeroed = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    rows = ids.withColumn("vector", zeroed).drop("embedding")
    same = (F.col("label") == F.col("of")) & (F.col("vector") == F.col("v")) & F.col("vec_id").isNotNull()
    joined = rows.join(found.withColumnRenamed("label", "of"), same, "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id",
        F.when(F.col("n").isNull(), F.lit(0)).otherwise(F.col("links") + F.col("n") - 1).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )

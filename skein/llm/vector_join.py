"""Embedding near-dedup: an exact metric range join over pivot cells."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, block_pairs, components, renumbered

COSINE = 0.9
#: Pivots come from a bounded sample; they only steer the partitioning, the join is exact for any pivots.
PIVOT_SAMPLE = 2048
#: A task joins two blocks of at most so many vectors.
BLOCK = 16384
#: Rows of the left block that are compared at once.
STRIPE = 512
EPS = 1e-7
#: Single precision decides where it lies further than this from the threshold; the rest is computed in double.
DOUBT = 1e-4


def _unit(raw: list[bytes], dim: int) -> np.ndarray:
    """Vectors as bytes of 4 or 8 for each number to unit rows in double precision."""
    kind = np.float32 if len(raw[0]) == 4 * dim else np.float64
    m = np.frombuffer(b"".join(raw), kind).reshape(len(raw), dim).astype(np.float64)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Valid vectors alone, as bytes, with their length and a fingerprint."""
    for b in batches:
        column = b.column("_vec")
        kind = np.float32 if column.type.value_type == pa.float32() else np.float64
        ids, dims, prints, raw = [], [], [], []
        for i, v in zip(b.column("_id").to_pylist(), column.to_pylist(), strict=True):
            if i is None or not v or None in v:
                continue
            x = np.array(v, kind)
            if np.isfinite(x).all() and x.any():
                x = x + kind(0)  # one zero
                ids.append(i)
                dims.append(len(x))
                raw.append(x.tobytes())
                prints.append(xxhash.xxh3_128_digest(raw[-1]))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(prints, pa.binary()), pa.array(raw, pa.binary())], ["_id", "_dim", "_print", "_raw"])


def _spread(m: np.ndarray, most: int, apart: float) -> np.ndarray:
    """Farthest-first: up to `most` of the sampled vectors, each as far as can be from those before, but none
    within `apart` of another."""
    chosen, far = [0], np.arccos(np.clip(m @ m[0], -1, 1))
    while len(chosen) < most and far.max() > apart:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.arccos(np.clip(m @ m[chosen[-1]], -1, 1)))
    return m[chosen]


def _presence(angle: np.ndarray, pivots: np.ndarray, reach: float, radii: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's home, the nearest pivot, and the cells in which it must be present beside it.

    Let u be at home at p and v, within `reach` of u, at home at c. By the triangle inequality angle(u, c) is at most
    angle(v, c) + reach, so at most angle(u, p) + 2 reach and at most the radius of c + reach. And u lies within `reach`
    of the half-space that is nearer to c than to p: u.p - u.c <= sin(reach) |p - c|. A pair of two homes is joined in
    the cell with the smaller number.
    """
    rows, cells = np.arange(len(angle)), np.arange(angle.shape[1])
    home = angle.argmin(axis=1)
    cosines = np.cos(angle)
    far = cosines[rows, home][:, None] - cosines <= math.sin(min(reach, math.pi / 2)) * np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))[home] + EPS
    present = (angle <= angle[rows, home][:, None] + 2 * reach + EPS) & (cells < home[:, None]) & far
    if radii is not None:
        present &= angle <= radii + reach + EPS
    return home, present


def planned(sample: np.ndarray, n: int, reach: float) -> np.ndarray:
    """Of 1, 2, 4, ... pivots those that cost least, by what the sample says of n vectors: rows to move and pairs to compare.

    In a space where all vectors lie far from each other no pivot prunes, and one cell, cut into blocks, is the best plan.
    """
    most, best, least = max(1, min(len(sample), 4 * -(-n // BLOCK))), None, math.inf
    spread, m = _spread(sample, most, 2 * reach), 1
    while True:
        pivots = spread[:m]
        angle = np.arccos(np.clip(sample @ pivots.T, -1, 1))
        home, present = _presence(angle, pivots, reach, None)
        radii = np.array([angle[home == c, c].max(initial=-np.inf) for c in range(len(pivots))])
        present &= angle <= radii + reach + EPS
        homes, guests = np.bincount(home, minlength=len(pivots)) * n / len(sample), present.sum(axis=0) * n / len(sample)
        blocks, others = np.ceil(homes / BLOCK), np.ceil(guests / BLOCK)
        rows, pairs = (homes * (blocks + others) + guests * blocks).sum(), (homes * homes / 2 + homes * guests).sum()
        if rows + pairs / 40_000 < 0.95 * least:
            best, least = pivots, rows + pairs / 40_000
        if m >= len(spread):
            return best
        m = min(2 * m, len(spread))


def _placer(pivots: dict[int, np.ndarray], reach: float, radii: dict[tuple[int, int], float] | None):
    """Home cells (radii None): (_rep, _dim, _cell, _angle). Else one row for each cell where a vector must be present."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("_dim").to_numpy()
            for d in np.unique(dims):
                part, p = b.filter(pa.array(dims == d)), pivots[int(d)]
                for at in range(0, part.num_rows, 4096):
                    rows = part.slice(at, 4096)
                    angle = np.arccos(np.clip(_unit(rows.column("_raw").to_pylist(), int(d)) @ p.T, -1, 1))
                    if radii is None:
                        home = angle.argmin(axis=1)
                        yield pa.RecordBatch.from_arrays([rows.column("_rep"), rows.column("_dim"), pa.array(home.astype(np.int32)), pa.array(angle[np.arange(len(home)), home])], ["_rep", "_dim", "_cell", "_angle"])
                        continue
                    home, present = _presence(angle, p, reach, np.array([radii.get((int(d), c), -np.inf) for c in range(len(p))]))
                    present[np.arange(len(home)), home] = True
                    who, cell = np.nonzero(present)
                    out = rows.take(pa.array(who))
                    yield pa.RecordBatch.from_arrays([out.column(n) for n in ("_rep", "_dim", "_n", "_raw")] + [pa.array(cell.astype(np.int32)), pa.array(cell == home[who])], ["_rep", "_dim", "_n", "_raw", "_cell", "_home"])

    return place


def _near(a: np.ndarray, b: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows with a product of at least `least` in double precision, for one stripe of a at a time."""
    b32 = b.astype(np.float32)
    for at in range(0, len(a), STRIPE):
        sim = a[at : at + STRIPE].astype(np.float32) @ b32.T
        i, j = np.nonzero(sim >= least - DOUBT)
        sure = sim[i, j] > least + DOUBT
        for k in range(0, len(doubt := np.flatnonzero(~sure)), 65536):
            d = doubt[k : k + 65536]
            sure[d] = (a[at + i[d]] * b[j[d]]).sum(axis=1) >= least
        yield at + i[sure], j[sure]


def _hooked(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the trees of a and b, pair by pair; roots are the smallest members."""
    while True:
        while (parent != (up := parent[parent])).any():
            parent = up
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        np.minimum.at(parent, np.maximum(x[apart], y[apart]), np.minimum(x[apart], y[apart]))


def _block(least: float):
    def join(table: pa.Table) -> pa.Table:
        """Of one pair of blocks: how many vectors each one links with, and the smallest id that it reaches here. Its
        memory is bounded by the blocks and one stripe of pairs."""
        side, dim = table.column("_side").to_numpy(), table.column("_dim")
        alone = table.column("_i")[0] == table.column("_j")[0]
        a = table.filter(pa.array(side == 0))
        b = a if alone else table.filter(pa.array(side == 1))
        if not a.num_rows or not b.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("_rep", "_links", "_root")})
        d = dim[0].as_py()
        both = a if alone else pa.concat_tables([a, b])
        ids, times = both.column("_rep").to_numpy(), both.column("_n").to_numpy()
        order = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        at_b = 0 if alone else a.num_rows
        ma = _unit(a.column("_raw").to_pylist(), d)
        mb = ma if alone else _unit(b.column("_raw").to_pylist(), d)
        links, parent = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for i, j in _near(ma, mb, least):
            if alone:
                once = i < j
                i, j = i[once], j[once]
            j = j + at_b
            links += np.bincount(i, times[j], len(ids)).astype(np.int64) + np.bincount(j, times[i], len(ids)).astype(np.int64)
            parent = _hooked(parent, rank[i], rank[j])
        while (parent != (up := parent[parent])).any():
            parent = up
        roots = ids[order][parent][rank]
        use = links > 0
        return pa.table({"_rep": pa.array(ids[use], pa.int64()), "_links": pa.array(links[use], pa.int64()), "_root": pa.array(roots[use], pa.int64())})

    return join


def placed(ws: Workspace, reps: DataFrame, cosine: float) -> DataFrame:
    """(_dim, _cell, _home, _rep, _n, _raw): every vector at home in one cell, and as a guest wherever the bounds ask for it."""
    reach = math.acos(cosine)
    counts = {r["_dim"]: r["n"] for r in reps.groupBy("_dim").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row for each length
    sample: dict[int, list[bytes]] = {}
    for r in reps.select("_dim", "_raw").orderBy(F.xxhash64("_rep"), "_rep").limit(PIVOT_SAMPLE).collect():
        sample.setdefault(r["_dim"], []).append(bytes(r["_raw"]))
    if missing := [d for d in counts if d not in sample]:  # a length that the sample lacks
        for r in reps.filter(F.col("_dim").isin(missing)).groupBy("_dim").agg(F.min("_raw").alias("_raw")).collect():
            sample[r["_dim"]] = [bytes(r["_raw"])]
    pivots = {d: planned(_unit(raw, d), counts[d], reach) for d, raw in sample.items()}
    homes = reps.mapInArrow(_placer(pivots, reach, None), "_rep long, _dim int, _cell int, _angle double")
    radii = {(r["_dim"], r["_cell"]): r["_radius"] for r in homes.groupBy("_dim", "_cell").agg(F.max("_angle").alias("_radius")).collect()}  # one row for each pivot
    return ws.put("present", reps.mapInArrow(_placer(pivots, reach, radii), "_rep long, _dim int, _n long, _raw binary, _cell int, _home boolean"))


def tasks(present: DataFrame) -> DataFrame:
    """The pairs of blocks of each cell in which a vector takes part: homes meet each other and the guests."""
    blocks = lambda c: F.ceil(c / BLOCK).cast("int")
    sizes = present.groupBy("_dim", "_cell").agg(blocks(F.count_if("_home")).alias("_hb"), blocks(F.count_if(~F.col("_home"))).alias("_gb"))
    sized = present.join(F.broadcast(sizes), ["_dim", "_cell"])  # one row for each pivot
    return block_pairs(sized, F.col("_home"), F.col("_hb"), F.col("_gb"), "_rep").select("_dim", "_cell", "_i", "_j", "_side", "_rep", "_n", "_raw")


def pruned(present: DataFrame) -> dict[str, float]:
    """What the bounds save: vectors, copies of each, and pairs that are compared as a share of all pairs."""
    cells = present.groupBy("_dim", "_cell").agg(F.count_if("_home").alias("h"), F.count_if(~F.col("_home")).alias("g")).collect()  # one row for each pivot
    n = sum(r["h"] for r in cells)
    pairs = sum(r["h"] * (r["h"] - 1) / 2 + r["h"] * r["g"] for r in cells)
    return {"vectors": n, "copies": (n + sum(r["g"] for r in cells)) / max(1, n), "compared": pairs / max(1, n * (n - 1) / 2)}


def vector_links(ws: Workspace, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector, by cosine >= `cosine` in double precision.

    1. Equal vectors collapse into their smallest id with a count.
    2. Pivots, farthest first from a bounded sample and more than twice the search angle apart, split the unit sphere
       into cells: a vector is at home at its nearest pivot. How many of them pay is planned from the sample. By the
       triangle inequality a vector is present, beside its home, only in cells that a vector within the angle can be at home in.
    3. Cells join independently, each pair of vectors in one cell. A cell is cut into blocks and each pair of blocks is
       joined alone, in bounded memory, so a cell with a third of all vectors spreads over many tasks.
    4. A task returns link counts and one edge to the smallest id for each vector, never the pairs.

    A vector that is null, empty, zero, or holds a null or non-finite number links with nothing, as does a null id
    (component null, kept true). Vectors of different lengths never link. Rows that share an id count as vectors
    of their own but are one node. Ids of any type with an order will do; those that aren't whole numbers are numbered in
    their order first. Other columns, labels too, are ignored.
    """
    rows, names = renumbered(ws, "ids", vectors.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_vec")))
    valid = ws.put("valid", rows.mapInArrow(_prepared, "_id long, _dim int, _print binary, _raw binary"))
    classes = ws.put("classes", valid.groupBy("_print").agg(F.min("_id").alias("_rep"), F.count(F.lit(1)).alias("_n")))
    reps = valid.join(classes.withColumnRenamed("_print", "_p"), (F.col("_id") == F.col("_rep")) & (F.col("_print") == F.col("_p"))).select("_rep", "_dim", "_n", "_raw").dropDuplicates(["_rep", "_raw"])
    present = placed(ws, ws.put("reps", reps), cosine)
    joined = ws.put("joined", tasks(present).groupBy("_dim", "_cell", "_i", "_j").applyInArrow(_block(cosine), "_rep long, _links long, _root long"))
    ws.drop("present", "reps")
    labels = ws.put("labels", components(ws, "cc", joined.filter("_root <> _rep").select(F.col("_rep").alias("a"), F.col("_root").alias("b"))))
    counts = joined.groupBy("_rep").agg(F.sum("_links").alias("_links"))
    found = classes.join(counts, "_rep", "left").join(labels, F.col("_rep") == F.col("node"), "left")
    found = ws.put("found", found.select(F.col("_print").alias("_p"), (F.coalesce("_links", F.lit(0)) + F.col("_n") - 1).alias("_links"), F.coalesce("label", "_rep").alias("_component")))
    linked = valid.select("_id", "_print").join(found, F.col("_print") == F.col("_p")).groupBy("_id").agg(F.max("_links").alias("_links"), F.min("_component").alias("_component"))
    out = rows.select("_id").join(linked.withColumnRenamed("_id", "_v"), F.col("_id") == F.col("_v"), "left")
    out = out.select("_id", F.coalesce("_links", F.lit(0)).cast("long").alias("_links"), F.coalesce("_component", "_id").alias("_component"))
    out = out.withColumn("_kept", F.coalesce(F.col("_id") == F.col("_component"), F.lit(True)))
    if names is not None:
        out = out.join(names, "_id", "left").drop("_id").withColumnRenamed("_name", "_id")
        out = out.join(names.toDF("_component", "_name"), "_component", "left").drop("_component").withColumnRenamed("_name", "_component")
    out = ws.put("result", out.select(F.col("_id").alias(id_col), F.col("_links").alias("n_links"), F.col("_component").alias("component_id"), F.col("_kept").alias("kept")))
    ws.drop("valid", "classes", "joined", "labels", "found")
    return out

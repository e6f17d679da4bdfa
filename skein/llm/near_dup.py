"""MinHash near-dedup on SetSketch registers."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, block_pairs, components, fresh, renumbered, running, small

REGISTERS, BAND, BASE, LEVELS = 190, 5, 1.02, 4000
WORDS, PERCENT = 4, 80
#: A candidate is verified unless its likelihood estimate lies this many standard errors below the threshold.
MARGIN = 5.5
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles of a whole text; fewer words: one hash of them all.

    Bytes lower-case A-Z alone and split at exactly the ASCII white space that separates words here.
    """
    hashes = [xxhash.xxh64_intdigest(w) for w in (text or "").encode("utf-8", "surrogatepass").lower().split()]
    if not hashes:
        return np.empty(0, np.uint64)
    w = np.fromiter(hashes, np.uint64, len(hashes))
    k = min(n, len(w))
    run = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        run = _mixed(run * _MIX[2] + w[i : len(w) - k + 1 + i])
    return np.unique(run)


@lru_cache(1)
def _multipliers() -> np.ndarray:
    return _mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64) * _MIX[2]) | np.uint64(1)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers: of register i the smallest of exponential values x_i(element), on the truncated scale
    floor(1 - log_base x). Registers of a union are the elementwise maxima of the parts' registers."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    by = _multipliers()
    for at in range(0, len(hashes), 4096):  # bounded memory for very long texts
        np.minimum(least, (hashes[at : at + 4096, None] * by).min(axis=0), out=least)
    x = -np.log1p(-(least.astype(np.float64) + 1) / 2.0**64 * (1 - 1e-12))
    return np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, LEVELS).astype(np.int16)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """(sets x registers) to (sets x bands) 64-bit keys of the registers of each band."""
    n = REGISTERS // BAND
    r = registers[:, : n * BAND].reshape(len(registers), n, BAND).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, n + 1, dtype=np.uint64), (len(registers), n)) * _MIX[2]
    for i in range(BAND):
        key = _mixed(key * _MIX[1] + r[:, :, i])
    return key


def likely(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where neither the sizes nor the joint maximum-likelihood estimate rule the threshold out, and the estimate.
    The sizes are compared in whole numbers: at 4 to 5 a set inside the other is exactly at the threshold.

    With u, v the shares of the two known set sizes, a register of the first set is larger with probability
    p(u - v J), smaller with p(v - u J), p(x) = -log_base(1 - x (base - 1) / base). The log-likelihood is concave
    in J; the estimate is its maximum over a grid, with the spread of equal registers as its standard error.
    """
    u = na / (na + nb)
    v = 1 - u
    above, below = (ra > rb).sum(axis=1), (ra < rb).sum(axis=1)
    same = ra.shape[1] - above - below
    most = np.minimum(u / v, v / u)
    best, top = np.zeros(len(u)), np.full(len(u), -np.inf)

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / math.log(BASE)

    for share in np.linspace(0, 1, 51):
        j = most * share
        up, down = p(u - v * j), p(v - u * j)
        value = above * np.log(up) + below * np.log(down) + same * np.log(np.maximum(1 - up - down, 1e-12))
        better = value > top
        best[better], top[better] = j[better], value[better]
    threshold = PERCENT / 100
    error = math.sqrt(threshold * (1 - threshold) / ra.shape[1])
    return (100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb)) & (best >= threshold - MARGIN * error - 0.01), best


def _rows(column) -> np.ndarray:
    """A binary column of equal lengths as a matrix of registers."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int16).reshape(len(column), REGISTERS)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, prints, out = [], [], []
        for text in b.column("_text").to_pylist():
            h = shingle_set(text)
            n.append(len(h))
            prints.append(xxhash.xxh3_128_digest(h.tobytes()))
            out.append(sketch(h).tobytes() if len(h) else None)
        yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_version"), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(out, pa.binary())], ["_id", "_version", "_n", "_print", "_sketch"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            part = b.slice(at, 1000)
            keys = band_keys(_rows(part.column("_sketch"))).astype(np.int64)
            rows = {"_key": pa.array(keys.ravel())}
            for name in ("_rep", "_label"):
                rows[name] = pa.array(np.repeat(part.column(name).to_numpy(zero_copy_only=False).astype(np.int64), keys.shape[1]))
            yield pa.RecordBatch.from_pydict(rows)


def _likely_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        estimate = pa.array([], pa.float64())
        if b.num_rows:
            size = [b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("_na", "_nb")]
            keep, best = likely(_rows(b.column("_sa")), _rows(b.column("_sb")), *size)
            b, estimate = b.filter(pa.array(keep)), pa.array(best[keep])
        yield pa.RecordBatch.from_arrays([b.column("_a"), b.column("_b"), estimate], ["_a", "_b", "_estimate"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [shingle_set(t).tobytes() for t in b.column("_text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(map(xxhash.xxh3_128_digest, sets), pa.binary()), pa.array(sets, pa.binary())], ["_id", "_print", "_set"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = []
        for x, y in zip(b.column("_xa"), b.column("_xb"), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            keep.append(_alike(x, y))
        yield b.filter(pa.array(keep, pa.bool_())).select(["_a", "_b"])


def _alike(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _sharing(keys: np.ndarray, label: np.ndarray, allowed) -> np.ndarray:
    """Codes of the pairs (i < j, i * rows + j) of different components that share a band, of those that `allowed` lets through."""
    codes = []
    for band in range(keys.shape[1]):
        order = np.argsort(keys[:, band], kind="stable")
        edges = np.flatnonzero(np.diff(keys[order, band])) + 1
        for run in np.split(order, edges):
            if len(run) > 1 and len(np.unique(label[run])) > 1:
                i, j = (run[k] for k in np.triu_indices(len(run), 1))
                i, j = np.minimum(i, j), np.maximum(i, j)
                use = (label[i] != label[j]) & allowed(i, j)
                codes.append(np.unique(i[use] * len(keys) + j[use]))
    return np.unique(np.concatenate(codes)) if codes else np.empty(0, np.int64)


def _first_sharing(keys: np.ndarray, bucket: int, label: np.ndarray, allowed) -> np.ndarray:
    """Codes of the pairs of different components for which this bucket is the first that they share; all rows are in it."""
    band = int(np.flatnonzero((keys.view(np.int64) == bucket).all(axis=0))[0])
    i, j = np.triu_indices(len(keys), 1)
    use = (label[i] != label[j]) & allowed(i, j)
    i, j = i[use], j[use]
    for before in range(band):
        new = keys[i, before] != keys[j, before]
        i, j = i[new], j[new]
    return i * len(keys) + j


def _blocks_joined(key: tuple, table: pa.Table) -> pa.Table:
    """Links between components in one pair of blocks: pairs that share a band, pass the estimate and then the exact
    check on whole sets. Once two components are linked here, their other pairs needn't be tried."""
    same = key[2].as_py() == key[3].as_py()
    rep, label, block = (table.column(c).to_numpy() for c in ("_rep", "_label", "_block"))
    sketches, sets = _rows(table.column("_sketch").combine_chunks()), [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("_set")]
    size, keys = np.array([len(x) for x in sets], float), band_keys(sketches)
    allowed = lambda i, j: same | (block[i] != block[j])
    codes = _first_sharing(keys, key[1].as_py(), label, allowed) if key[0].as_py() else _sharing(keys, label, allowed)
    links = []
    if len(codes):
        i, j = np.divmod(codes, len(rep))
        parent = {x: x for x in label.tolist()}

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for at in range(0, len(i), 20_000):
            a, b = i[at : at + 20_000], j[at : at + 20_000]
            keep, best = likely(sketches[a], sketches[b], size[a], size[b])
            for k in np.argsort(-best, kind="stable"):
                if keep[k]:
                    x, y = find(int(label[a[k]])), find(int(label[b[k]]))
                    if x != y and _alike(sets[a[k]], sets[b[k]]):
                        parent[max(x, y)] = min(x, y)
                        links.append((int(rep[a[k]]), int(rep[b[k]])))
    return pa.table({"_a": pa.array([x for x, _ in links], pa.int64()), "_b": pa.array([y for _, y in links], pa.int64())})


def _confirm(ws: Workspace, pairs: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """For each text its likeliest pair, if that passes the estimate and then the exact check on whole sets."""
    side = lambda x: reps.select(F.col("_rep").alias(f"_{x}"), F.col("_n").alias(f"_n{x}"), F.col("_sketch").alias(f"_s{x}"))
    near = pairs.hint("merge").join(side("a"), "_a").join(side("b").hint("merge"), "_b").filter((F.col("_na") * 100 >= F.col("_nb") * PERCENT) & (F.col("_nb") * 100 >= F.col("_na") * PERCENT))
    near = near.mapInArrow(_likely_pairs, "_a long, _b long, _estimate double").groupBy("_a").agg(F.max_by("_b", "_estimate").alias("_b"))
    near = ws.put("near", near)
    sets = _sets_of(ws, "star_sets", near.select("_a").unionByName(near.select(F.col("_b").alias("_a"))).distinct(), reps, texts)
    a, b = (sets.select(F.col("_rep").alias(f"_{x}"), F.col("_set").alias(f"_x{x}")) for x in "ab")
    links = ws.put("star_links", near.hint("merge").join(a, "_a").join(b.hint("merge"), "_b").mapInArrow(_verified, "_a long, _b long"))
    ws.drop("near", "star_sets")
    return links


def _sets_of(ws: Workspace, name: str, nodes: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """(_rep, _set) of these nodes (a column of any name), from one of their texts each."""
    needed = ws.put(f"{name}_ids", nodes.toDF("_rep").join(reps.select("_rep", "_id", "_print").hint("merge"), "_rep"))
    ids = small(needed.select("_id").distinct())
    sets = texts.join(ids, "_id", "left_semi").mapInArrow(_sets, "_id long, _print binary, _set binary")
    found = ws.put(name, sets.join(small(needed), ["_id", "_print"]).select("_rep", "_set").dropDuplicates(["_rep"]))
    ws.drop(f"{name}_ids")
    return found


#: A block of the last step holds about so many texts, or so many shingles if they are long.
BLOCK_TEXTS, BLOCK_SHINGLES = 512, 2_000_000
#: A cluster of more blocks is joined bucket by bucket.
CLUSTER_BLOCKS = 8


def _pools(pools: DataFrame) -> DataFrame:
    """Adds to texts of pools (_mode, _pool, _rep, _label, _n) whether they belong to the pool's commonest component, and
    how many blocks both kinds need. Texts of the same component needn't meet, so the commonest one meets the others alone."""
    by_label = pools.groupBy("_mode", "_pool", "_label").agg(F.count(F.lit(1)).alias("_k"), F.sum("_n").alias("_s"))
    top = by_label.groupBy("_mode", "_pool").agg(F.max(F.struct("_k", "_s", "_label")).alias("_top"), F.sum("_k").alias("_k"), F.sum("_s").alias("_s"))
    blocks = lambda k, s: F.greatest(F.ceil(k / BLOCK_TEXTS), F.ceil(s / BLOCK_SHINGLES)).cast("int")
    sizes = top.select("_mode", "_pool", F.col("_top._label").alias("_main"), blocks(F.col("_k") - F.col("_top._k"), F.col("_s") - F.col("_top._s")).alias("_others"), blocks(F.col("_top._k"), F.col("_top._s")).alias("_mains"))
    return pools.join(sizes, ["_mode", "_pool"]).withColumn("_other", F.col("_label") != F.col("_main"))


def _between(ws: Workspace, reps: DataFrame, labels: DataFrame, members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between components that share buckets, from the members (_key, _rep) of buckets with several components.

    Texts that share mixed buckets, directly or through others, form a cluster. A cluster of few blocks is one pool: each of its
    texts is moved to CLUSTER_BLOCKS tasks at most. Of larger clusters each bucket is a pool of its own, so a text is moved
    once for each of its buckets and blocks of them, not for all blocks of its cluster. In a pool each pair of blocks is
    joined in one task of bounded size; pairs never leave the task, only links do.
    """
    hubs = ws.put("hubs", members.groupBy("_key").agg(F.min("_rep").alias("_hub")))
    clusters = components(ws, "cl", members.join(hubs, "_key").select(F.col("_rep").alias("a"), F.col("_hub").alias("b")).distinct())
    # components() names all but the smallest of a cluster
    named = clusters.unionByName(clusters.select(F.col("label").alias("node"), "label").distinct()).select(F.col("node").alias("_rep"), F.col("label").alias("_pool"))
    known = named.hint("merge").join(reps.select("_rep", "_n"), "_rep").join(labels, F.col("_rep") == F.col("node"), "left")
    tagged = ws.put("clusters", known.select(F.lit(0).alias("_mode"), "_pool", "_rep", F.coalesce("label", "_rep").alias("_label"), "_n"))
    wide = F.col("_others") + F.col("_mains") > CLUSTER_BLOCKS
    pools = ws.put("pools", _pools(tagged))
    large = pools.filter(wide).select("_rep", "_label", "_n")
    if large.limit(1).count():
        buckets = _pools(members.join(large, "_rep").select(F.lit(1).alias("_mode"), F.col("_key").alias("_pool"), "_rep", "_label", "_n"))
        pools = ws.put("all_pools", pools.filter(~wide).unionByName(buckets.select(pools.columns)))
    # a pool of one component has nothing to join
    pools = pools.filter("_others > 0")
    sets = _sets_of(ws, "rest_sets", pools.select("_rep").distinct(), reps, texts)
    rows = block_pairs(pools, F.col("_other"), F.col("_others"), F.col("_mains"), "_rep").select("_mode", "_pool", "_i", "_j", "_block", "_label", "_rep")
    rows = rows.hint("merge").join(reps.select("_rep", "_sketch"), "_rep").join(sets.hint("merge"), "_rep")
    links = ws.put("rest_links", rows.groupBy("_mode", "_pool", "_i", "_j").applyInArrow(_blocks_joined, "_a long, _b long"))
    ws.drop("hubs", "clusters", "pools", "all_pools", "rest_sets")
    return links


def near_duplicates(ws: Workspace, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", version_col: str | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): components of texts whose shingle sets have Jaccard 0.8 or more.

    1. Every text becomes a set, a fingerprint and 190 registers. Equal sets collapse into one node.
    2. 38 bands of 5 registers give bucket keys; a pair at 0.8 shares none with probability (1 - 0.8^5)^38, 3e-7.
    3. Each member of a bucket is paired with the bucket's smallest node. Of the pairs that the likelihood estimate
       doesn't rule out (5.5 standard errors) each text's likeliest is verified on whole sets.
    4. Buckets that still hold several components: their texts are joined block by block inside tasks, where
       pairs of different components that share a band are estimated and verified. So every pair of a bucket
       lies inside one component or is verified, and copies that step 3 has linked cost nothing more.

    A null or blank text has an empty set and is linked with nothing. A null id is linked with nothing: component null, kept
    true. Rows that share an id are documents of their own where their sets differ; each row is returned, with the
    component of its own set. Ids of any type with an order will do; those that aren't whole numbers are numbered in their order
    first, which moves the texts once. Other columns are ignored. `version_col` names a further column with a hash of the
    text, which tells rows that share an id apart.
    """
    texts, names = renumbered(ws, "ids", docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")))
    versions = texts.withColumn("_version", F.xxhash64("_text"))
    all_sets = ws.put("sketches", versions.mapInArrow(_sketches, "_id long, _version long, _n long, _print binary, _sketch binary"))
    known = all_sets.filter("_n > 0 and _id is not null")
    classes = ws.put("classes", known.groupBy("_print").agg(F.min("_id").alias("_id")))
    # a node is the smallest id of its set; where sets share that id, their places in the order of ids serve as nodes
    shared = classes.groupBy("_id").agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1").limit(1).count() > 0
    if shared:
        ranked = running(ws, "ranked", classes.withColumn("_all", F.lit(0)), "_all", ["_id", "_print"], F.lit(1))
        nodes = ws.put("nodes", ranked.select("_print", "_id", F.col("before").alias("_rep")))
    else:
        nodes = classes.withColumn("_rep", F.col("_id"))
    reps = ws.put("reps", known.join(nodes.hint("merge"), ["_id", "_print"]).select("_rep", "_id", "_print", "_n", "_sketch").dropDuplicates(["_rep"]))

    bands = reps.withColumn("_label", F.col("_rep")).mapInArrow(_bands, "_key long, _rep long, _label long").select("_key", "_rep")
    hubs = ws.put("hubs", bands.groupBy("_key").agg(F.min("_rep").alias("_hub"), F.max("_rep").alias("_last")).filter("_hub < _last").drop("_last"))
    stars = ws.put("stars", bands.join(hubs.hint("merge"), "_key").filter("_rep <> _hub").select(F.col("_rep").alias("_a"), F.col("_hub").alias("_b")).distinct())
    ws.drop("hubs")
    links = _confirm(ws, stars, reps, texts)
    ws.drop("stars")
    labels = ws.put("labels", components(ws, "cc", links.select(F.col("_a").alias("a"), F.col("_b").alias("b"))))

    labelled = reps.join(labels.hint("merge"), F.col("_rep") == F.col("node"), "left").select("_rep", F.coalesce("label", "_rep").alias("_label"), "_sketch")
    bands = labelled.mapInArrow(_bands, "_key long, _rep long, _label long")
    mixed = ws.put("mixed", bands.groupBy("_key").agg(F.min("_label").alias("_x"), F.max("_label").alias("_y")).filter("_x < _y").select("_key"))
    members = ws.put("members", bands.join(mixed.hint("merge"), "_key").select("_key", "_rep"))
    more = _between(ws, reps, labels, members, texts)
    ws.drop("mixed", "members")
    labels = ws.put("labels2", components(ws, "cd", links.unionByName(more).select(F.col("_a").alias("a"), F.col("_b").alias("b"))))
    ws.drop("labels")

    found = nodes.join(labels, F.col("_rep") == F.col("node"), "left").select(F.col("_print").alias("_p"), F.coalesce("label", "_rep").alias("_component"))
    if shared:
        found = found.join(nodes.select(F.col("_rep").alias("_component"), F.col("_id").alias("_named")), "_component").select("_p", F.col("_named").alias("_component"))
    found = ws.put("found", found)
    out = all_sets.select("_id", "_version", "_n", "_print").join(found.hint("merge"), (F.col("_print") == F.col("_p")) & (F.col("_n") > 0) & F.col("_id").isNotNull(), "left")
    out = out.select("_id", "_version", "_n", F.coalesce("_component", "_id").alias("_component")).withColumn("_kept", F.coalesce(F.col("_id") == F.col("_component"), F.lit(True)))
    if names is not None:
        out = out.join(names, "_id", "left").drop("_id").withColumnRenamed("_name", "_id")
        out = out.join(names.toDF("_component", "_name"), "_component", "left").drop("_component").withColumnRenamed("_name", "_component")
    version = [F.col("_version").alias(version_col)] if version_col else []
    out = ws.put("result", out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), F.col("_component").alias("component_id"), F.col("_kept").alias("kept"), *version))
    ws.drop("sketches", "classes", "ranked", "nodes", "reps", "found", "labels2", "star_links", "rest_links", "ids", "ids_rows")
    return out


def keep_one(ws: Workspace, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the documents whose component has a smaller id. Rows with a null id stay. Of rows that share an id
    each text is a document of its own; rows that are equal in both are one, and stay or go together."""
    found = near_duplicates(ws, docs, id_col, text_col, "_version").filter("not kept")
    gone = found.select(F.col(id_col).alias(out := fresh("_gone", docs)), F.col("_version").alias(text := fresh("_gone_text", docs))).distinct()
    return docs.join(small(gone), (F.col(id_col) == F.col(out)) & (F.xxhash64(text_col) == F.col(text)), "left_anti")

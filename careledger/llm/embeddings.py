"""Operator 3: embedding near-dedup by sorted projection passes.

In each pass the vectors stand in the lexicographic order of their concatenated random
hashes (62 random projections, each cut at the median that a sample of the table has among
the vectors with the same bits so far, so that crowded directions are split as finely as
others), and every vector is compared, in double precision, with the ``window`` vectors
behind it. A pair counts in the first pass that brings it within a window, which both
vectors' ranks tell without gathering pairs. There are as many passes as pairs of the least
cosine, laid at sampled vectors, need to meet in windows of a table of its size (``_passes``).
Links of all passes are united into components. Components larger than a window are then
compared within in square blocks, so that a crowded neighbourhood loses no link to the
window's bound. Equal vectors are one class, compared once and counted by their number.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as c

PASSES, WINDOW, CHUNK, SQUARE, BITS, SEED = 8, 768, 3072, 2048, 62, 5
LEAST = 0.95
#: Sampled vectors (and their most bytes), rows of the sample below which bits have no medians of their own, levels with them.
SAMPLE, SAMPLE_BYTES, LEAF, LEVELS = 16384, 32 << 20, 16, 10
#: Pairs laid at sampled vectors, share of them that windows must bring together, most passes.
TRIED, MEET, MOST = 4096, 0.999, 64


def _described(batches):
    """Class digest and the unit vector of each valid vector."""
    for b in batches:
        out = [[], [], []]
        for i, v in enumerate(b.column(1)):
            if not v.is_valid:
                continue
            x = v.values.cast(pa.float64()).to_numpy(zero_copy_only=False) if v.values.null_count == 0 else np.array([np.nan])
            with np.errstate(all="ignore"):
                top = np.abs(x).max() if len(x) else 0.0
                if not np.isfinite(x).all() or top == 0:
                    continue
                u = x / top
                u = u / np.sqrt((u * u).sum())
            out[0].append(b.column(0)[i].as_py())
            out[1].append(int(c.mix(np.frombuffer((u + 0.0).tobytes(), np.uint64) * c.seeds(len(u), 31)).sum(dtype=np.uint64)) >> 1)
            out[2].append(u)
        yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.float64()))], names=["id", "node", "u"])


def _planes(seed, d, p):
    return np.random.default_rng([seed, d, p]).standard_normal((BITS, d))


def _cuts(proj):
    """Where each bit is cut, from a sample's projections: (node medians of the first levels, medians of the leaves for the rest).

    Nodes count as in a heap. One with fewer than ``LEAF`` sampled vectors has the cuts of its parent's vectors.
    """
    levels = max(0, min(LEVELS, (len(proj) // LEAF).bit_length() - 1))
    nodes = np.zeros(1 << levels)
    groups = [np.arange(len(proj))]
    for level in range(levels):
        below = []
        for k, rows in enumerate(groups):
            nodes[(1 << level) + k] = cut = np.median(proj[rows, level])
            right = proj[rows, level] > cut
            below += [g if len(g) >= LEAF // 2 else rows for g in (rows[~right], rows[right])]
        groups = below
    if len(proj) < LEAF:
        return nodes, np.zeros((1, BITS))
    return nodes, np.array([np.median(proj[rows], axis=0) for rows in groups], np.float32)[:, levels:]


def _bits(proj, cuts):
    """The bits of vectors from their projections."""
    nodes, leaves = cuts
    levels = len(nodes).bit_length() - 1
    at = np.ones(len(proj), np.int64)
    bits = np.empty(proj.shape, bool)
    for level in range(levels):
        bits[:, level] = proj[:, level] > nodes[at]
        at = 2 * at + bits[:, level]
    bits[:, levels:] = proj[:, levels:] > leaves[at - (1 << levels)]
    return bits


def _key(bits):
    return bits @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _passes(sample, total, least, window, passes, seed):
    """(passes, {length: cuts of each pass}) for ``total`` vectors of which ``sample`` = {length: vectors} were drawn.

    At sampled vectors partners of cosine ``least`` are laid in random directions. A pair meets in a pass if the vectors
    that share its common bits (the share that the sample has of them; below the sample's resolution a half for each
    further bit) fit a window. Passes are added until ``MEET`` of the pairs have met, ``passes`` at least.
    """
    drawn = max(1, sum(map(len, sample.values())))
    cuts = {d: [] for d in sample}
    tried = {}
    for d, u in sample.items():
        rng = np.random.default_rng([seed, d, 1 << 20])
        x = u[rng.permutation(len(u))[: max(1, TRIED * len(u) // drawn)]]
        z = rng.standard_normal(x.shape)
        z -= (z * x).sum(1, keepdims=True) * x
        z /= np.maximum(np.sqrt((z * z).sum(1, keepdims=True)), 1e-300)
        tried[d] = x, least * x + np.sqrt(max(0.0, 1 - least * least)) * z, np.zeros(len(x), bool)
    for p in range(MOST if passes < MOST else passes):
        for d, u in sample.items():
            planes = _planes(seed, d, p).T
            proj = u @ planes
            cuts[d].append(_cuts(proj))
            x, y, met = tried[d]
            own = np.sort(_key(_bits(proj, cuts[d][p])))
            a, b = _bits(x @ planes, cuts[d][p]), _bits(y @ planes, cuts[d][p])
            differ = a != b
            common = np.where(differ.any(1), differ.argmax(1), BITS)
            low = _key(a) >> (BITS - common) << (BITS - common)
            near = np.searchsorted(own, low + (1 << (BITS - common)) - 1, side="right") - np.searchsorted(own, low)
            # beyond the levels with medians the sample is too thin to count: halves of the leaf
            levels = len(cuts[d][p][0]).bit_length() - 1
            top = np.minimum(common, levels)
            low = _key(a) >> (BITS - top) << (BITS - top)
            leaf = np.searchsorted(own, low + (1 << (BITS - top)) - 1, side="right") - np.searchsorted(own, low)
            near = np.where(near >= LEAF, near, np.maximum(leaf, 1) * 0.5 ** (common - top)) * (total / drawn)
            met |= near <= window
        share = sum(t[2].sum() for t in tried.values()) / max(1, sum(len(t[2]) for t in tried.values()))
        if p + 1 >= passes and (share >= MEET or not sample):
            return p + 1, cuts
    if share < MEET:
        warnings.warn(f"{p + 1} passes bring about {share:.4f} of the pairs at cosine {least} within a window of {window} in {total} vectors", stacklevel=3)
    return p + 1, cuts


def _keyed(cuts, passes, seed):
    """The keys of all passes of each class."""

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            us = b.column(1)
            size = np.diff(np.asarray(us.offsets))
            flat, off = np.asarray(us.flatten()), np.concatenate([[0], np.cumsum(size)])
            keys = np.zeros((b.num_rows, passes), np.int64)
            for d in np.unique(size):
                d = int(d)
                own = np.flatnonzero(size == d)
                if d not in planes:
                    planes[d] = np.stack([_planes(seed, d, p).T for p in range(passes)])
                u = flat[off[own][:, None] + np.arange(d)]
                for p in range(passes):
                    keys[own, p] = _key(_bits(u @ planes[d][p], cuts[d][p] if d in cuts else (np.zeros(1), np.zeros((1, BITS)))))
            flat_keys = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, passes, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.record_batch([b.column(0), pa.array(size.astype(np.int32)), flat_keys], names=["node", "dim", "keys"])

    return run, "node long, dim int, keys array<long>"


def _sample(classes, total, seed):
    """{length: vectors} of some classes, drawn by their digest; bounded whatever the table."""
    longest = classes.agg(F.max(F.size("u"))).first()[0] or 1
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * longest)))
    drawn = classes.where(F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(1 << 40)) < int((1 << 40) * min(1.0, most / max(1, total)))).select("node", "u").toArrow()
    out: dict[int, list] = {}
    for node, v in sorted(zip(drawn["node"].to_pylist(), (x.values.to_numpy() for x in drawn["u"]), strict=True), key=lambda r: r[0]):
        out.setdefault(len(v), []).append(v)
    return {d: np.array(v) for d, v in sorted(out.items())}


def _numbered(batches):
    """(pass, node, partition, place in it) of a sorted partition."""
    from pyspark import TaskContext

    part, at = TaskContext.get().partitionId(), 0
    for b in batches:
        n = b.num_rows
        yield pa.record_batch([b.column(0), b.column(1), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n, dtype=np.int64))], names=["p", "node", "part", "place"])
        at += n


def _ranks(keyed: DataFrame, passes: int, total: int) -> DataFrame:
    """(node, ranks): the place of each of the ``total`` classes in the order of every pass; vectors of one length stand
    together. One sort for all passes: a pass begins where the one before has had its ``total`` rows."""
    rows = keyed.select("dim", "node", F.posexplode("keys").alias("p", "key"))
    rows = rows.repartitionByRange(c.partitions_for(keyed.sparkSession, total * passes, 1 << 18), "p", "dim", "key", "node")
    rows = rows.sortWithinPartitions("p", "dim", "key", "node").select("p", "node")
    rows = c.stored(rows.mapInArrow(_numbered, "p int, node long, part int, place long"), "order")
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"))
    base = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    got = rows.join(F.broadcast(base), "part").select("node", "p", (F.col("base") + F.col("place") - F.col("p") * F.lit(total)).alias("rank"))  # a row for each partition
    return got.groupBy("node").agg(F.transform(F.sort_array(F.collect_list(F.struct("p", "rank"))), lambda x: x["rank"]).alias("ranks"))


def _compared(window, least, whole):
    """Links of each group of rows: counts by node and a spanning forest.

    whole = False: group (pass, chunk, side), rows of side 1 being the next chunk's head; a pair counts if its ranks lie
    within the window in this pass and in none before. whole = True: group (component, i, j), blocks i and j of it
    (side 0 and 1), pairs beyond the window in all passes.
    """
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("n", pa.int64())])

    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        key = np.stack([t.column(i).to_numpy().astype(np.int64) for i in range(3)])
        side, node, weight = (t.column(i).to_numpy().astype(np.int64) for i in (3, 4, 5))
        ranks = np.array(t.column(6).combine_chunks().flatten()).reshape(len(node), -1)
        us = t.column(7).combine_chunks()
        size = np.diff(np.asarray(us.offsets))
        flat, off = np.asarray(us.flatten()), np.concatenate([[0], np.cumsum(size)])
        by_rank = ranks[np.arange(len(node)), np.zeros(len(node), np.int64) if whole else key[0]]
        order = np.lexsort((by_rank, side, key[2], key[1], key[0]))
        k = key[:, order]
        first = np.flatnonzero(np.concatenate([[True], (k[:, 1:] != k[:, :-1]).any(0)]))
        for f, e in zip(first, np.append(first[1:], len(order)), strict=True):
            rows = order[f:e]
            dims = size[rows]
            count = np.zeros(len(rows), np.int64)
            parent = np.arange(len(rows))
            edges = []

            def root(i, parent=parent):
                while parent[i] != i:
                    parent[i] = parent[parent[i]]
                    i = parent[i]
                return i

            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                u = flat[(off[rows[own]][:, None] + np.arange(d))].reshape(len(own), d)
                r = ranks[rows[own]]
                p = 0 if whole else int(k[0, f])
                step = 256
                for a in range(0, len(own), step):
                    b = min(len(own), a + step)
                    if whole:
                        lo, hi = a, len(own)
                    else:
                        lo, hi = a, int(np.searchsorted(r[:, p], r[b - 1, p] + window, side="right"))
                    s = u[a:b] @ u[lo:hi].T
                    i, j = np.nonzero(s >= least)
                    i, j = i + a, j + lo
                    ok = j > i
                    if whole:
                        if k[1, f] != k[2, f]:
                            ok &= side[rows[own[i]]] != side[rows[own[j]]]
                        i, j = i[ok], j[ok]
                        ok = (np.abs(r[i] - r[j]) > window).all(1)
                    else:
                        ok &= side[rows[own[i]]] == 0
                        i, j = i[ok], j[ok]
                        ok = (r[j, p] - r[i, p] <= window) & (np.abs(r[i, :p] - r[j, :p]) > window).all(1)
                    i, j = own[i[ok]], own[j[ok]]
                    np.add.at(count, i, weight[rows[j]])
                    np.add.at(count, j, weight[rows[i]])
                    for x, y in zip(i, j, strict=True):
                        q, w = root(x), root(y)
                        if q != w:
                            parent[max(q, w)] = min(q, w)
                            edges.append((node[rows[x]], node[rows[y]]))
            hit = np.flatnonzero(count)
            x = np.concatenate([node[rows[hit]], np.array([a for a, _ in edges], np.int64)])
            y = np.concatenate([node[rows[hit]], np.array([b for _, b in edges], np.int64)])
            n = np.concatenate([count[hit], np.zeros(len(edges), np.int64)])
            yield pa.record_batch([pa.array(x), pa.array(y), pa.array(n)], schema=schema)

    return run, "x long, y long, n long"


def near_vectors(table: DataFrame, least: float = LEAST, passes: int = PASSES, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """One row (vec_id, n_links, component_id, kept) per row of ``table`` (vec_id, embedding; others are ignored).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of unlike
    lengths do not link. ``passes`` are the fewest made. n_links counts the other rows linked directly, equal vectors among them; component_id is the
    smallest vec_id reachable and kept marks its row. Repeated ids are rows of their own; a null id has a null component
    and is not kept. An empty table gives no rows.
    """
    spark = table.sparkSession
    rows = c.columns_of(table, {"vec_id": "long", "embedding": "array<double>"})
    seen = c.stored(rows.mapInArrow(_described, "id long, node long, u array<double>"), "vectors")
    classes = c.stored(seen.groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("weight"), F.first("u").alias("u")), "classes")
    total = classes.count()
    passes, cuts = _passes(_sample(classes, total, seed), total, least, window, passes, seed)
    fn, schema = _keyed(cuts, passes, seed)
    keyed = c.stored(classes.select("node", "u").mapInArrow(fn, schema), "keys")
    placed = c.stored(_ranks(keyed, passes, total).join(classes.select("node", "weight", "u"), "node"), "placed")

    chunk = lambda x: F.floor(x / CHUNK).cast("int")
    each = placed.select("*", F.posexplode("ranks").alias("p", "rank"))
    spots = F.array(F.struct(chunk(F.col("rank")).alias("c"), F.lit(0).alias("side")),
                    F.when((F.col("rank") % CHUNK < window) & (F.col("rank") >= CHUNK), F.struct((chunk(F.col("rank")) - 1).alias("c"), F.lit(1).alias("side"))))
    each = each.withColumn("at", F.explode(F.filter(spots, lambda s: s.isNotNull())))
    each = each.select("p", F.col("at.c").alias("c"), F.lit(0).alias("z"), F.col("at.side").alias("side"), "node", "weight", "ranks", "u")
    fn, schema = _compared(window, least, False)
    found = c.stored(each.repartition(c.partitions_for(spark, total * passes, 2 * CHUNK), "p", "c").mapInArrow(fn, schema), "found")
    comp = c.components(found.where("x <> y"), "x", "y")

    crowd = comp.groupBy("component").agg(F.count("*").alias("m")).where(F.col("m") > window)
    crowd = comp.join(crowd, "component").join(placed, "node").withColumn("squares", F.ceil(F.col("m") / SQUARE).cast("int"))
    crowd = crowd.withColumn("own", F.pmod(F.xxhash64("node"), F.col("squares")).cast("int"))
    spots = F.transform(F.sequence(F.lit(0), F.col("squares") - 1), lambda o: F.struct(
        F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j"), F.when(F.col("own") <= o, 0).otherwise(1).alias("side")))
    crowd = crowd.withColumn("at", F.explode(spots)).select("component", F.col("at.i").alias("i"), F.col("at.j").alias("j"), F.col("at.side").alias("side"),
                                                            "node", "weight", "ranks", "u")
    fn, schema = _compared(window, least, True)
    more = crowd.repartition(c.partitions_for(spark, total, SQUARE), "component", "i", "j").mapInArrow(fn, schema)
    links = found.union(more).where("x = y").groupBy("x").agg(F.sum("n").alias("n"))

    named = classes.select("node", "id", "weight").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least_id = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = named.join(least_id, "component").join(links.withColumnRenamed("x", "node"), "node", "left")
    named = named.select("node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    valid = seen.select("id", "node").join(named, "node").select("id", "n_links", "component_id")
    rest = rows.select(F.col("vec_id").alias("id")).exceptAll(seen.select("id")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = valid.union(rest)
    return out.select(F.col("id").alias("vec_id"), "n_links", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op3_embedding_near_dedup(spark, sf_dir):
    return near_vectors(c.read_table(spark, sf_dir, "embeddings"))

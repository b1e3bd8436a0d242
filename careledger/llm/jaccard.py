"""Operator 7: n-gram Jaccard join as a blocked sparse product of the document x n-gram incidence.

Rows of the matrix are classes of equal shingle sets, columns are 5-word shingles.
Only the entries that a size-derived bound leaves are multiplied:

* the columns have one order for all rows, rarest first, and a row of n entries with similarity t needs its first
  ``n - ceil(t n) + 1`` only. Counts are taken over all columns: every window of texts sends the leading bits of its
  shingles, packed to about two bytes each, to the task that counts their range; the columns counted most often
  (``LISTED`` at most) go to all tasks with their count's class. While that list has every column counted twice, the
  others stand in one row and are not multiplied at all;
* columns are dealt in blocks by hash; a block first multiplies each column's entries with one of them, the hub;
* pairs found that way are dropped where the sizes, the places of the column in both rows, or the parity sketches of
  both rows (the number of differing bits never exceeds the number of differing shingles) rule the threshold out; the
  overlap of the others is counted on their whole sets;
* rows so linked need no further product: the columns that still hold several components are multiplied in square
  blocks, between different components only. The products of a pair are accumulated over all blocks: columns shared
  and the last places in both rows, and a pair goes where these and what may follow cannot reach the threshold.

No pair at or above the threshold is lost, and no column or row is capped. Beyond ``LISTED`` columns the order knows
only the more frequent ones, which changes the cost, not the result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

#: Rows of a square block of a column.
SQUARE = 2048
#: Columns in the list of counted ones (9 bytes each, sent to every task), shingles of a counting window.
LISTED, WINDOW = 2_000_000, 4 << 20
#: Classes of counts: a column's class is the last of these that its count reaches.
CLASSES = np.array([2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 256, 1024, 65536])
#: Buckets of document ids whose sets are fetched (a bitmap of 1 MB).
ID_BUCKETS = 1 << 20
#: 64-bit words of the smallest sketch; a row's has two bits for each shingle or more.
SKETCH = 8
#: 64-bit words at most of the folded sketch that goes with an entry into the square blocks.
SQUARE_SKETCH = 32
#: Entries of a group of columns (those with one hub) that are multiplied in one task, so that a pair's products meet there.
GROUP = 20_000
#: Pairs with one row before that row's set is sent to several tasks.
PAIRS_EACH = 256


def _sketch(h: np.ndarray) -> np.ndarray:
    """Parity of the number of hashes at each bit; a power of two of words, halves fold by XOR."""
    words = max(SKETCH, 1 << (len(h) // 32).bit_length())
    bit = c.mix(h) & np.uint64(64 * words - 1)
    odd = np.bincount(bit.astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _folded(sketch):
    """A row's sketch folded once (a bit for each shingle or more), SQUARE_SKETCH words at most, as a column."""
    return F.expr(f"""transform(sequence(0, least({SQUARE_SKETCH}, greatest({SKETCH}, int(size({sketch}) / 2))) - 1), i -> aggregate(
        sequence(0, int(size({sketch}) / least({SQUARE_SKETCH}, greatest({SKETCH}, int(size({sketch}) / 2)))) - 1), 0L,
        (s, j) -> s ^ {sketch}[j * least({SQUARE_SKETCH}, greatest({SKETCH}, int(size({sketch}) / 2))) + i]))""")


def _apart(a, b):
    """Differing bits of two sketches, the longer folded once if need be (twice as long rules a link out)."""

    def fold(x, y):
        half = F.floor(F.size(x) / 2).cast("int")
        return F.when(F.size(x) > F.size(y), F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))).otherwise(F.col(x))

    return F.aggregate(F.zip_with(fold(a, b), fold(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)


def _digest(h: np.ndarray) -> int:
    """63-bit id of a set, the same for equal sets."""
    return int(c.mix(h ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64) ^ np.uint64(len(h))) >> 1


def _layout(shingles: int) -> tuple[int, int]:
    """(leading bits by which columns are counted, of which the first name the counting task's range)."""
    bits = min(48, max(24, shingles.bit_length() + 5))
    return bits, min(bits - 16, max(0, (shingles // WINDOW).bit_length()))


def _describe(k, bits, range_bits):
    schema = pa.schema([("kind", pa.int8()), ("id", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("sketch", pa.list_(pa.int64())),
                        ("bins", pa.binary()), ("low", pa.binary())])
    inner = bits - 16 - range_bits

    def counted(seen):
        """A window's shingles by range: how many there are in each bin of their leading bits, and the 16 bits behind."""
        key = np.sort(np.concatenate(seen) >> np.uint64(64 - bits))
        of = (key >> np.uint64(bits - range_bits)).astype(np.int64)
        at = np.unique(of, return_index=True)[1]
        end = np.append(at[1:], len(key))
        mid = ((key >> np.uint64(16)) & np.uint64((1 << inner) - 1)).astype(np.int64)
        low = (key & np.uint64(0xFFFF)).astype(np.uint16)
        m = len(at)
        return pa.record_batch([pa.array(np.ones(m, np.int8)), pa.nulls(m, pa.int64()), pa.array(of[at].astype(np.int32)), pa.nulls(m, pa.int64()),
                                pa.nulls(m, pa.list_(pa.int64())),
                                pa.array([np.bincount(mid[i:j], minlength=1 << inner).astype(np.uint32).tobytes() for i, j in zip(at, end, strict=True)], pa.binary()),
                                pa.array([low[i:j].tobytes() for i, j in zip(at, end, strict=True)], pa.binary())], schema=schema)

    def run(batches):
        c.forget()
        seen, held, nodes = [], 0, set()
        for b in batches:
            ids = b.column(0)
            n, node, sk = [], [], []
            for _, h in c.shingle_sets(c.texts_of(b.column(1)), k):
                d = _digest(h)
                n.append(len(h))
                node.append(d if len(h) else None)
                sk.append(_sketch(h) if len(h) else None)
                if d not in nodes and len(h):
                    nodes.add(d)
                    seen.append(h)
                    held += len(h)
                    if held >= WINDOW:
                        yield counted(seen)
                        seen, held, nodes = [], 0, set()
            m = len(n)
            yield pa.record_batch([pa.array(np.zeros(m, np.int8)), ids, pa.array(n, pa.int32()), pa.array(node, pa.int64()),
                                   pa.array(sk, pa.list_(pa.int64())), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary())], schema=schema)
        if seen:
            yield counted(seen)

    return run, "kind tinyint, id long, n int, node long, sketch array<long>, bins binary, low binary"


def _count_ranges(bits, range_bits):
    """(class of the count, number of columns, their leading bits) of each range; the rows of a range come together."""
    inner = bits - 16 - range_bits

    def tallied(at, parts):
        keys, m = np.unique(np.concatenate(parts), return_counts=True)
        keys, m = keys[m > 1] | np.uint64(at << (bits - range_bits)), m[m > 1]
        grade = np.searchsorted(CLASSES, m, side="right") - 1
        have = np.unique(grade)
        return pa.record_batch([pa.array(have, pa.int32()), pa.array([int((grade == g).sum()) for g in have], pa.int64()),
                                pa.array([keys[grade == g].tobytes() for g in have], pa.binary())], names=["grade", "columns", "keys"])

    def run(batches):
        now, parts = None, []
        for b in batches:
            for at, bins, low in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if at != now and parts:
                    yield tallied(now, parts)
                    parts = []
                now = at
                mid = np.repeat(np.arange(1 << inner, dtype=np.uint64), np.frombuffer(bins, np.uint32))
                parts.append((mid << np.uint64(16)) | np.frombuffer(low, np.uint16).astype(np.uint64))
        if parts:
            yield tallied(now, parts)

    return run, "grade int, columns long, keys binary"


class _Order:
    """The list of counted columns: sorted leading bits, their classes, and whether it has all columns counted twice."""

    def __init__(self, bits, keys, grade, whole):
        o = np.argsort(keys, kind="stable")
        self.shift, self.keys, self.grade, self.whole = np.uint64(64 - bits), keys[o], grade[o], whole

    def sorted(self, h: np.ndarray) -> tuple[np.ndarray, int]:
        """(the columns of a row, rarest first, how many of them are not listed)."""
        if not len(self.keys):
            return h, len(h)
        key = h >> self.shift
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        grade = np.where(self.keys[at] == key, self.grade[at] + np.uint8(1), np.uint8(0))
        return h[np.argsort(grade, kind="stable")], int((grade == 0).sum())


def _counted_order(spark, seen, bits, range_bits) -> _Order:
    """The columns counted most often, whole classes of counts from the top, LISTED columns at most."""
    fn, schema = _count_ranges(bits, range_bits)
    ranges = seen.where("kind = 1").select("n", "bins", "low").repartition(max(1 << range_bits, 1), "n").sortWithinPartitions("n")
    tallies = c.stored(ranges.mapInArrow(fn, schema), "counts")
    by_grade = {r["grade"]: r["m"] for r in tallies.groupBy("grade").agg(F.sum("columns").alias("m")).collect()}  # a row a class
    room, grades = LISTED, []
    for g in sorted(by_grade, reverse=True):
        if by_grade[g] > room:
            break
        room -= by_grade[g]
        grades.append(g)
    rows = tallies.where(F.col("grade").isin(grades)).select("grade", "keys").toArrow() if grades else None  # LISTED keys at most
    c.drop_stored(tallies)
    parts = [np.frombuffer(k, np.uint64) for k in rows.column(1).to_pylist()] if rows else []
    keys = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    grade = np.repeat(rows.column(0).to_numpy().astype(np.uint8), [len(p) for p in parts]) if parts else np.zeros(0, np.uint8)
    return _Order(bits, keys, grade, len(grades) == len(by_grade))


def _entries(k, order, num, den):
    """Entries of each row within its bound: (column, row, its size, the column's place in it). Equal rows of a task once."""

    def rows_of(col, node, size, place, per):
        return pa.record_batch([pa.array(np.concatenate(col).view(np.int64)), pa.array(np.repeat(np.array(node, np.int64), per)),
                                pa.array(np.repeat(np.array(size, np.int32), per)), pa.array(np.concatenate(place))], names=["col", "node", "n", "place"])

    def run(batches):
        c.forget()
        o = order.value
        met: set[int] = set()
        for b in batches:
            ok = ~np.asarray(b.column(0).is_null())
            col, node, size, place, per, held = [], [], [], [], [], 0
            for i, h in c.shingle_sets(c.texts_of(b.column(1)), k):
                n = len(h)
                if not n or not ok[i]:
                    continue
                d = _digest(h)
                if d in met:
                    continue
                if len(met) > 1_000_000:
                    met.clear()
                met.add(d)
                if held > 200_000:
                    yield rows_of(col, node, size, place, per)
                    col, node, size, place, per, held = [], [], [], [], [], 0
                p = n - -(-num * n // den) + 1
                h, alone = o.sorted(h)
                first = min(p, alone) if o.whole else 0
                if first == p:
                    continue
                col.append(h[first:p])
                place.append(np.arange(first, p, dtype=np.int32))
                per.append(p - first)
                held += p - first
                node.append(d)
                size.append(n)
            if per:
                yield rows_of(col, node, size, place, per)

    return run, "col long, node long, n int, place int"


def _sets(k, bitmap, whole):
    kind = pa.list_(pa.int64() if whole else pa.int32())

    def run(batches):
        need = bitmap.value
        for b in batches:
            ids = b.column(0)
            ok = np.asarray(ids.is_valid())
            raw = np.asarray(ids.fill_null(0))
            ok &= need[(c.mix(raw.view(np.uint64)) % np.uint64(ID_BUCKETS)).astype(np.int64)]
            pick = np.flatnonzero(ok)
            texts = c.texts_of(b.column(1).take(pa.array(pick)))
            got = [(int(raw[pick[i]]), _digest(h), h.view(np.int64) if whole else (h >> np.uint64(32)).astype(np.uint32).view(np.int32)) for i, h in c.shingle_sets(texts, k) if len(h)]
            for at in range(0, len(got), 512):
                x = got[at : at + 512]
                yield pa.record_batch([pa.array([r[0] for r in x], pa.int64()), pa.array([r[1] for r in x], pa.int64()),
                                       pa.array([r[2] for r in x], kind)], names=["id", "node", "hashes"])

    return run, "id long, node long, hashes " + ("array<long>" if whole else "array<int>")


def _unique_pairs(lo, hi):
    o = np.lexsort((hi, lo))
    lo, hi = lo[o], hi[o]
    new = np.ones(len(lo), bool)
    new[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    return lo[new], hi[new]


def _reachable(n, place, m, other, num, den):
    """Whether rows of n and m entries that share a column at these places can reach the threshold: as many columns before
    it as the smaller place, as many behind as the shorter rest."""
    n, m, place, other = (np.asarray(x).astype(np.int64) for x in (n, m, place, other))
    most = np.minimum(place, other) + 1 + np.minimum(n - place, m - other) - 1
    return (den * np.minimum(n, m) >= num * np.maximum(n, m)) & ((den + num) * most >= num * (n + m))


def _first_products(num, den):
    schema = pa.schema([("kind", pa.int8()), ("x", pa.int64()), ("y", pa.int64()), ("n", pa.int32()), ("place", pa.int32())])

    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        col, node, n, place = (t.column(i).to_numpy() for i in range(4))
        o = np.lexsort((node, place, col))  # equal rows have equal places; the hub is the row with the fewest rarer columns
        col, node, n, place = col[o], node[o], n[o], place[o]
        new = np.ones(len(col), bool)
        new[1:] = (col[1:] != col[:-1]) | (node[1:] != node[:-1])
        col, node, n, place = col[new], node[new], n[new], place[new]
        first = np.flatnonzero(np.concatenate([[True], col[1:] != col[:-1]]))
        length = np.diff(np.append(first, len(col)))
        hub = np.repeat(first, length)
        shared = np.repeat(length > 1, length)
        yield pa.record_batch([pa.array(np.ones(shared.sum(), np.int8)), pa.array(col[shared]), pa.array(node[shared]), pa.array(n[shared]),
                               pa.array(place[shared])], schema=schema)
        b = np.flatnonzero(hub != np.arange(len(col)))
        a = hub[b]
        ok = _reachable(n[a], place[a], n[b], place[b], num, den)
        x, y = _unique_pairs(node[b[ok]], node[a[ok]])
        yield pa.record_batch([pa.array(np.zeros(len(x), np.int8)), pa.array(x), pa.array(y), pa.nulls(len(x), pa.int32()), pa.nulls(len(x), pa.int32())], schema=schema)

    return run, "kind tinyint, x long, y long, n int, place int"


class _Sketches:
    """Sketches of a block's rows, in the length of each and in all shorter ones (halves folded by XOR)."""

    def __init__(self, column: pa.ChunkedArray, order: np.ndarray):
        lists = column.combine_chunks()
        off = np.asarray(lists.offsets).astype(np.int64)
        words = np.asarray(lists.values).view(np.uint64)
        self.size = np.diff(off)[order]
        self.at, self.of = {}, {}
        longer, rows = np.zeros((0, 0), np.uint64), np.zeros(0, np.int64)
        for w in sorted(set(self.size.tolist()), reverse=True):
            while longer.shape[1] > w:
                longer = longer[:, : longer.shape[1] // 2] ^ longer[:, longer.shape[1] // 2 :]
            own = np.flatnonzero(self.size == w)
            mine = words[(off[order[own]][:, None] + np.arange(w))]
            longer = np.concatenate([longer.reshape(-1, w), mine])
            rows = np.concatenate([rows, own])
            place = np.zeros(len(self.size), np.int64)
            place[rows] = np.arange(len(rows))
            self.of[w], self.at[w] = longer, place

    def apart(self, i: int, r: np.ndarray) -> np.ndarray:
        """Differing bits of row i and rows r, in the shorter length of each two."""
        out = np.zeros(len(r), np.int64)
        short = np.minimum(self.size[r], self.size[i])
        for w in np.unique(short).tolist():
            k = short == w
            of, at = self.of[w], self.at[w]
            out[k] = np.bitwise_count(of[at[r[k]]] ^ of[at[i]]).sum(1, dtype=np.int64)
        return out


def _square_products(num, den):
    """Square blocks of columns: the products of pairs of different components that the bounds and sketches leave, summed
    over the blocks of a task: columns shared, and the last place of a shared column in either row."""

    def summed(out):
        x, y, nx, ny, px, py, m = (np.concatenate(v) for v in zip(*out, strict=True))
        o = np.lexsort((y, x))
        x, y, nx, ny, px, py, m = (v[o] for v in (x, y, nx, ny, px, py, m))
        first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
        return [(x[first], y[first], nx[first], ny[first], np.maximum.reduceat(px, first), np.maximum.reduceat(py, first), np.add.reduceat(m, first))]

    names = ["x", "y", "nx", "ny", "px", "py", "shared"]

    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        key = np.stack([t.column(i).to_numpy().astype(np.int64) for i in range(3)])
        o = np.lexsort(key[::-1])
        key = key[:, o]
        node, comp, n, place, side = (t.column(i).to_numpy()[o] for i in range(3, 8))
        n, place = n.astype(np.int64), place.astype(np.int64)
        sketches = _Sketches(t.column(8), o)
        first = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(0)]))
        out, held = [], 0
        for f, e in zip(first, np.append(first[1:], len(node)), strict=True):
            rows = np.arange(f, e)
            same = key[1, f] == key[2, f]
            left = rows[side[rows] == 0]
            right = left if same else rows[side[rows] == 1]
            for i in left:
                r = right[right > i] if same else right
                r = r[(comp[r] != comp[i]) & _reachable(n[r], place[r], n[i], place[i], num, den)]
                if len(r):
                    r = r[sketches.apart(i, r) * (den + num) <= (den - num) * (n[r] + n[i])]
                if len(r):
                    big = node[r] > node[i]
                    out.append((np.maximum(node[r], node[i]), np.minimum(node[r], node[i]), np.where(big, n[r], n[i]), np.where(big, n[i], n[r]),
                                np.where(big, place[r], place[i]), np.where(big, place[i], place[r]), np.ones(len(r), np.int64)))
                    held += len(r)
                    if held > 1_000_000:
                        out = summed(out)
                        if len(out[0][0]) > 500_000:
                            yield pa.record_batch([pa.array(v) for v in out[0]], names=names)
                            out = []
                        held = len(out[0][0]) if out else 0
        if out:
            yield pa.record_batch([pa.array(v) for v in summed(out)[0]], names=names)

    return run, "x long, y long, nx long, ny long, px long, py long, shared long"


def _verified(rows, pairs, classes, k, num, den, whole):
    """Pairs (x, y, linked) whose sets reach the threshold.

    With ``whole`` on 64-bit sets, all linked. Otherwise on the leading 32 bits, which is half to move: pairs so
    near the threshold that a few equal leading bits could decide have linked = false and are left to a second call.
    """
    spark = rows.sparkSession
    need = pairs.select("x").union(pairs.select("y")).distinct()
    reps = c.stored(need.join(classes.select(F.col("node").alias("x"), "id"), "x"), "reps")

    @F.pandas_udf("int")
    def bucket(ids):
        import pandas as pd

        return pd.Series((c.mix(ids.to_numpy(np.int64).view(np.uint64)) % np.uint64(ID_BUCKETS)).astype(np.int32))

    bits = np.zeros(ID_BUCKETS, bool)
    got = reps.select(bucket("id").alias("b")).distinct().toArrow().column(0).to_numpy()  # ID_BUCKETS rows at most
    bits[got] = True
    bitmap = spark.sparkContext.broadcast(bits)
    fn, schema = _sets(k, bitmap, whole)
    sets = rows.mapInArrow(fn, schema).join(reps.select(F.col("x").alias("node"), "id"), ["node", "id"])
    sets = c.stored(sets.dropDuplicates(["node"]).select("node", "hashes"), "sets")
    bitmap.destroy()
    left = sets.select(F.col("node").alias("x"), F.col("hashes").alias("hx"), F.size("hashes").alias("nx"))
    right = sets.select(F.col("node").alias("y"), F.col("hashes").alias("hy"), F.size("hashes").alias("ny"))
    # a row with many pairs meets them in several tasks
    many = pairs.groupBy("y").agg(F.ceil(F.count("*") / PAIRS_EACH).cast("int").alias("parts"))
    right = right.join(many, "y").select("y", "hy", "ny", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    dealt = pairs.select("x", "y").join(many, "y").select("x", "y", F.pmod(F.xxhash64("x"), F.col("parts")).cast("int").alias("part"))
    both = dealt.join(left, "x").join(right, ["y", "part"]).withColumn("over", F.size(F.array_intersect("hx", "hy")))
    doubt = F.lit(0) if whole else 3 + F.ceil(F.col("nx").cast("double") * F.col("ny") * 10 / 2.0**32).cast("int")
    reach = lambda over: (den + num) * over >= num * (F.col("nx") + F.col("ny"))
    out = c.stored(both.where(reach(F.col("over") + doubt)).select("x", "y", reach(F.col("over") - doubt).alias("linked")), "links")
    c.drop_stored(sets)
    c.drop_stored(reps)
    return out


def jaccard_join(docs: DataFrame, k: int = 5, num: int = 75, den: int = 100) -> DataFrame:
    """One row (doc_id, n_shingles, component_id, node, component) per row of ``docs`` (doc_id, text; other columns are ignored).

    Two rows link when ``den * |A and B| >= num * |A or B|`` over their distinct k-word shingles
    (A-Z lower-cased, fewer than k words: one shingle); component_id is the smallest doc_id reachable.
    Null or empty text: 0 shingles, linked with nothing, its own component. Rows of a null doc_id are
    counted, not linked, and have a null component. Repeated ids are separate rows; rows of equal
    sets are one component. An empty table gives no rows. ``node`` is a digest
    of the row's set and ``component`` one of its group of linked sets, null for an empty set; where ids repeat, groups that
    share a smallest doc_id differ in it.
    """
    rows = c.columns_of(docs, {"doc_id": "long", "text": "string"})
    spark = rows.sparkSession
    c.workers_import(spark)
    letters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    bits, range_bits = _layout(letters // 6)
    fn, schema = _describe(k, bits, range_bits)
    seen = c.stored(rows.mapInArrow(fn, schema), "rows")
    each = seen.where("kind = 0").select("id", "n", "node")
    classes = c.stored(seen.where("kind = 0 and node is not null and id is not null").groupBy("node").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    total = classes.agg(F.sum(F.floor(F.col("n") * (den - num) / den) + 1)).first()[0] or 0

    order = spark.sparkContext.broadcast(_counted_order(spark, seen, bits, range_bits))
    fn, schema = _entries(k, order, num, den)
    blocks = rows.mapInArrow(fn, schema).repartition(c.partitions_for(spark, total, 200_000), "col")
    fn, schema = _first_products(num, den)
    product = c.stored(blocks.mapInArrow(fn, schema), "product")
    order.destroy()  # the list is in the driver's memory too

    side = classes.select("node", "n", "sketch")

    def near(pairs):
        """Pairs that the sizes and the rows' own sketches leave."""
        pairs = pairs.join(side.toDF("x", "nx", "sx"), "x").join(side.toDF("y", "ny", "sy"), "y")
        pairs = pairs.where(den * F.least("nx", "ny") >= num * F.greatest("nx", "ny"))
        return c.stored(pairs.where(_apart("sx", "sy") * (den + num) <= (den - num) * (F.col("nx") + F.col("ny"))).select("x", "y"), "pairs")

    first = near(product.where("kind = 0").select("x", "y").distinct())
    found = _verified(rows, first, classes, k, num, den, False)
    done = [found]

    joined = c.components(found.where("linked").select("x", "y"), "x", "y")
    lists = product.where("kind = 1").select(F.col("x").alias("col"), F.col("y").alias("node"), "n", "place")
    lists = lists.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = lists.groupBy("col").agg(F.count("*").alias("d"), F.min("component").alias("lo"), F.max("component").alias("hi"),
                                     F.min(F.struct("place", "node")).alias("hub"))
    lists = c.stored(lists.join(sizes.where("lo < hi").select("col", "d", F.col("hub.node").alias("hub")), "col"), "lists")
    c.drop_stored(product)
    copied = lists.agg(F.sum(F.ceil(F.col("d") / SQUARE))).first()[0] or 0
    links = []
    if copied:  # else no column holds rows of several components
        rows_at = classes.select("node", _folded("sketch").alias("sketch"))
        groups = lists.groupBy("hub").agg(F.ceil(F.sum(F.ceil(F.col("d") / SQUARE)) / GROUP).cast("int").alias("parts"))
        lists_at = lists.join(rows_at, "node").join(groups, "hub").withColumn("part", F.pmod(F.xxhash64("col"), F.col("parts"))).withColumn("squares", F.ceil(F.col("d") / SQUARE).cast("int"))
        lists_at = lists_at.withColumn("own", F.pmod(F.xxhash64("node"), F.col("squares")).cast("int"))
        spots = F.transform(F.sequence(F.lit(0), F.col("squares") - 1), lambda o: F.struct(
            F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j"), F.when(F.col("own") <= o, 0).otherwise(1).alias("side")))
        blocks = lists_at.withColumn("at", F.explode(spots)).select("col", F.col("at.i").alias("i"), F.col("at.j").alias("j"), "node", "component",
                                                                    "n", "place", F.col("at.side").alias("side"), "sketch", "hub", "part")
        blocks = blocks.repartition(c.partitions_for(spark, copied, 100_000), "hub", "part", "i", "j").drop("hub", "part")
        fn, schema = _square_products(num, den)
        known = first.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
        sums = blocks.mapInArrow(fn, schema).groupBy("x", "y", "nx", "ny").agg(F.max("px").alias("px"), F.max("py").alias("py"), F.sum("shared").alias("shared"))
        # what the two share in their bounds, and what may follow the last column of it in either
        most = F.col("shared") + F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py")) - 1
        sums = sums.where((den + num) * most >= num * (F.col("nx") + F.col("ny"))).select("x", "y")
        rest = near(sums.join(known, ["x", "y"], "left_anti"))
        done.append(rest)
        if not rest.isEmpty():
            more = _verified(rows, rest, classes, k, num, den, False)
            done.append(more)
            found = found.union(more)
            links.append(more.where("linked").select("x", "y"))
    c.drop_stored(lists)
    close = c.stored(found.where("not linked").select("x", "y"), "close")
    if not close.isEmpty():
        sure = _verified(rows, close, classes, k, num, den, True)
        done.append(sure)
        links.append(sure.select("x", "y"))

    comp = joined
    if links:  # the stars of the first components stand for their links
        stars = joined.select(F.col("node").alias("x"), F.col("component").alias("y"))
        comp = c.components(functools.reduce(DataFrame.union, links, stars), "x", "y")
        done.append(joined)
    named = classes.select("node", F.col("id").alias("rep")).join(comp, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").select("node", "component_id", "component")
    out = each.join(named, "node", "left")
    out = c.stored(out.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                              F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"), "node", "component"), "jaccard")
    for table in (seen, classes, first, close, comp, *done):
        c.drop_stored(table)
    return out


def with_node(docs: DataFrame, k: int = 5) -> DataFrame:
    """(row, node): each row of ``docs`` and the digest of its set as in ``jaccard_join``, null for a text without words."""

    def run(batches):
        for b in batches:
            node = [_digest(h) if len(h) else None for _, h in c.shingle_sets(c.texts_of(b.column(1)), k)]
            yield pa.record_batch([b.column(0), pa.array(node, pa.int64())], names=["row", "node"])

    rows = c.as_row(docs, "text")
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, node long")


def op7_ngram_jaccard_join(spark, sf_dir):
    return jaccard_join(c.read_table(spark, sf_dir, "documents")).drop("node", "component")


def oracle_sql() -> str:
    """Brute force: every pair that shares a shingle, reachability by a recursive query."""
    return """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
n AS (SELECT d.doc_id, count(s) AS n FROM d LEFT JOIN sh USING (doc_id) GROUP BY 1),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= 75 * (p.n + q.n - o)),
e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
r(a, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.a)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, c.component_id
FROM n JOIN (SELECT a, min(c) AS component_id FROM r GROUP BY 1) c ON c.a = n.doc_id
"""

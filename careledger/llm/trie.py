"""Operator 12: the prefix trie of conversations from sorted matrices of turn ids.

A conversation is one record: its conv_id, 16 bytes for each turn (a digest of role and text) and the turns' lengths;
texts stay behind. Records are dealt over shards by ranges of (turn ids, conv_id), so equal conversations spread over as
many shards as their number asks for. In a shard

* the records are sorted as rows of a matrix, padded with 0 (a shorter conversation comes first), a band of columns at a
  time: numpy lexsort of the place that earlier bands gave, the columns, and whether a row goes on;
* a node of depth d starts where one of the first d columns changes: the change masks of the columns are accumulated by
  OR, depth after depth, over the rows that reach it;
* the members of a node are then a run of rows, and reduceat gives their number and smallest conv_id; from the deepest
  depth up it also sums what hangs below a node.

Only nodes on the paths of a shard's first and last row can go on in another shard. They leave the shard as partial
rows with a digest of their path and are recombined: sums over shards, less what the shards counted each for itself
(a shared node's text, a leaf, a child), which runs up each path as a running sum.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as c

#: Columns sorted at a time, turns of a shard, members' conv_ids in a piece of text.
BAND, SHARD_TURNS, PIECE = 16, 200_000, 10_000
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _records(turns: DataFrame) -> DataFrame:
    """(conv_id, ids binary, sizes array<int>): each conversation's turns in order, 16 bytes and a length a turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id is not null").select(
        "conv_id", "turn", role.alias("role"), F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("id"), F.length(text).alias("size"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "id", "size"))).alias("t"))
    return rows.select("conv_id", F.unhex(F.array_join("t.id", "")).alias("ids"), F.col("t.size").alias("sizes"))


def rebuilt_from_bases(records: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Each record c with its first h = crc32(decimal c) % most turns replaced by those of conversation c - c % every."""
    head = records.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.substring("ids", 1, 16 * (most - 1)).alias("base_ids"), F.slice("sizes", 1, most - 1).alias("base_sizes"))
    out = records.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(head, "base", "left")
    out = out.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int"))
    return out.selectExpr(
        "conv_id",
        "concat(coalesce(substring(base_ids, 1, 16 * h), X''), substring(ids, 16 * h + 1)) AS ids",
        "concat(coalesce(slice(base_sizes, 1, h), cast(array() AS array<int>)), slice(sizes, h + 1, size(sizes))) AS sizes")


class _Shard:
    """The nodes of one shard's records."""

    def __init__(self, conv: np.ndarray, raw: np.ndarray, sizes: np.ndarray, length: np.ndarray):
        """conv_id and number of turns of each record; ids (two columns a turn) and sizes of all turns in a row."""
        first = np.cumsum(length) - length
        n = len(conv)
        ids = (raw.astype(np.uint64) >> np.uint64(1)) + np.uint64(1)  # 126 of 128 bits, never the padding
        order, place = np.lexsort((conv, length > 0)), np.zeros(n, np.int64)
        for d in range(0, int(length.max(initial=0)), BAND):
            live = np.flatnonzero(length[order] > d)
            rows = order[live]
            wide = int(min(BAND, length[rows].max() - d))
            key = np.zeros((2 * wide + 2, len(rows)), np.uint64)
            key[0], key[-1] = place[live], length[rows] > d + wide
            for j in range(wide):
                has = length[rows] > d + j
                key[2 * j + 1 : 2 * j + 3, has] = ids[first[rows[has]] + d + j].T
            o = np.lexsort(key[::-1])
            order[live] = rows[o]
            changed = (key[:, o[1:]] != key[:, o[:-1]]).any(0)
            place[live] = live[np.maximum.accumulate(np.where(np.append(True, changed), np.arange(len(live)), 0))]
        self.conv, self.length, first = conv[order], length[order], first[order]
        self.n, self.ids = n, ids
        self.first, self.sizes = first, sizes
        self.raw = raw
        self._nodes()

    def _nodes(self):
        live, mask = np.arange(self.n), np.zeros(self.n, bool)
        mask[:1] = True
        self.depths = []
        group = np.zeros(self.n, np.int64)
        size = np.zeros(self.n, np.int64)  # of the last turn at this depth
        d = 0
        while len(live):
            start = np.flatnonzero(mask)
            count = np.diff(np.append(start, len(live)))
            deeper = self.length[live] > d
            ends = count - np.add.reduceat(deeper, start)
            self.depths.append(dict(row=live[start], live=live, start=start, count=count, least=np.minimum.reduceat(self.conv[live], start),
                                    ends=ends, size=size[start], parent=group[start]))
            group = np.cumsum(mask) - 1
            live, group = live[deeper], group[deeper]
            if not len(live):
                break
            at = self.first[live] + d
            size = self.sizes[at].astype(np.int64)
            change = (self.ids[at[1:]] != self.ids[at[:-1]]).any(1)
            mask = np.append(True, change | (group[1:] != group[:-1]))
            d += 1
        saved, leaves = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        for at in reversed(self.depths):
            saved[at["row"]] += (at["count"] - 1) * at["size"]
            at["leaf"] = at["ends"] == at["count"]
            leaves[at["row"]] += at["leaf"]
            at["saved"] = np.add.reduceat(saved[at["live"]], at["start"])
            at["leaves"] = np.add.reduceat(leaves[at["live"]], at["start"])
        for at, below in zip(self.depths, [*self.depths[1:], None], strict=True):
            at["children"] = np.bincount(below["parent"], minlength=len(at["row"])) if below else np.zeros(len(at["row"]), np.int64)

    def members(self, d: int, k: int) -> np.ndarray:
        """conv_ids that end at node k of depth d, ascending."""
        at = self.depths[d]
        return self.conv[at["row"][k] : at["row"][k] + at["ends"][k]]

    def paths(self) -> list[list[tuple[int, str]]]:
        """(node, digest of its path) by depth along the first and the last row."""
        out = []
        for row in (0, self.n - 1):
            h, path = hashlib.md5(), []
            for d in range(int(self.length[row]) + 1):
                if d:
                    h.update(self.raw[self.first[row] + d - 1].tobytes())
                path.append((int(np.searchsorted(self.depths[d]["row"], row, side="right")) - 1, h.copy().hexdigest()))
            out.append(path)
        return out


def _digits(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


_INNER = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
                    ("kind", pa.int8()), ("path", pa.string()), ("key", pa.string()), ("parent_key", pa.string()), ("own", pa.bool_()),
                    ("size", pa.int64()), ("leaf", pa.int64()), ("piece", pa.string())])
_SHARD = _NODE + ", kind tinyint, path string, key string, parent_key string, own boolean, size long, leaf long, piece string"
#: Kinds of a shard's rows: a whole node, a node on a border path, a piece of the members that end at such a node.
NODE, BORDER, PIECES = 0, 1, 2


def _shards(batches):
    """The rows of a shard: nodes, border nodes, pieces."""
    from pyspark import TaskContext

    c.forget()
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    t = pa.Table.from_batches(got)
    ids = t.column(1).combine_chunks().cast(pa.large_binary())
    raw, off = c.buffers(ids)
    raw = raw.view(">u8").reshape(-1, 2)
    sizes = t.column(2).combine_chunks().flatten().to_numpy()
    s = _Shard(t.column(0).to_numpy(), raw, sizes, np.diff(off) // 16)
    shard = TaskContext.get().partitionId()
    paths = s.paths()
    border = [dict() for _ in s.depths]  # node: (path, key) by depth
    for side, path in enumerate(paths):
        for d, (k, key) in enumerate(path):
            border[d].setdefault(k, (f"{shard}.{side}", key))

    def batch(rows: dict):
        n = len(next(iter(rows.values())))
        return pa.record_batch([pa.array(rows[f.name], f.type) if f.name in rows else pa.nulls(n, f.type) for f in _INNER], schema=_INNER)

    for d, at in enumerate(s.depths):
        inner = np.ones(len(at["row"]), bool)
        inner[list(border[d])] = False
        k = np.flatnonzero(inner)
        if not len(k):
            continue
        parent = at["parent"][k]
        above = border[d - 1]  # a whole node is not the root
        own = [above.get(p) for p in parent.tolist()]
        least = s.depths[d - 1]["least"][parent]
        sha = [hashlib.sha256(_digits(s.members(d, x)).encode()).hexdigest() for x in k.tolist()]
        yield batch(dict(conv_id=at["least"][k], depth=np.full(len(k), d), parent_conv_id=[None if o else v for o, v in zip(own, least.tolist(), strict=True)],
                         n_convs=at["count"][k], n_children=at["children"][k], n_leaves=at["leaves"][k], saved_tokens=at["saved"][k], ends_sha256=sha,
                         kind=np.zeros(len(k), np.int8), path=[o and o[0] for o in own]))
    for side, path in enumerate(paths):
        rows = {f.name: [] for f in _INNER}
        for d, (k, key) in enumerate(path):
            at = s.depths[d]
            own = border[d][k][0] == f"{shard}.{side}"
            row = dict(conv_id=at["least"][k], depth=d, n_convs=at["count"][k], n_children=at["children"][k], n_leaves=at["leaves"][k],
                       saved_tokens=at["saved"][k], kind=BORDER, path=f"{shard}.{side}", key=key, parent_key=path[d - 1][1] if d else None, own=own,
                       size=at["size"][k], leaf=int(at["leaf"][k]))
            for f in _INNER:
                rows[f.name].append(row.get(f.name))
            if own:
                who = s.members(d, k)
                for a in range(0, len(who), PIECE):
                    yield batch(dict(conv_id=who[a : a + 1], depth=[d], kind=np.array([PIECES], np.int8), key=[key], piece=[_digits(who[a : a + PIECE])]))
        yield batch(rows)


def _joined(batches):
    """SHA-256 of each key's pieces, joined by commas in the order they come."""
    now, h, out = None, None, []
    for b in batches:
        for key, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if key != now:
                if h:
                    out.append((now, h.hexdigest()))
                now, h = key, hashlib.sha256()
            else:
                h.update(b",")
            h.update(piece.encode())
    if h:
        out.append((now, h.hexdigest()))
    yield pa.record_batch([pa.array([k for k, _ in out], pa.string()), pa.array([d for _, d in out], pa.string())], names=["key", "ends"])


def prefix_trie(records: DataFrame) -> DataFrame:
    """The nodes of the trie of ``records`` (conv_id, ids, sizes as ``rebuilt_from_bases`` gives them)."""
    spark = records.sparkSession
    records = c.stored(records, "records")
    turns = records.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    shards = records.repartitionByRange(c.partitions_for(spark, turns, SHARD_TURNS), "ids", "conv_id")
    rows = c.stored(shards.mapInArrow(_shards, _SHARD), "nodes")

    border = rows.where(f"kind = {BORDER}")
    whole = border.where("own").groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.first("parent_key").alias("parent_key"), F.min("path").alias("at"), (F.count("*") - 1).alias("again"),
        F.first("size").alias("size"), F.sum("leaf").alias("leaf"))
    whole = c.stored(whole, "border")
    # what the shards counted each for itself, once on one path of the node, summed up that path and over the paths
    extra = whole.select("key", F.col("at").alias("path"), (F.col("again") * F.col("size")).alias("more"),
                         ((F.col("leaf") == F.col("again") + 1).cast("long") - F.col("leaf")).alias("less"))
    up = Window.partitionBy("path").orderBy(F.desc("depth"))
    sums = border.select("path", "depth", "key").join(extra, ["key", "path"], "left")
    sums = sums.select("key", F.sum(F.coalesce("more", F.lit(0))).over(up).alias("more"), F.sum(F.coalesce("less", F.lit(0))).over(up).alias("less"))
    sums = sums.groupBy("key").agg(F.sum("more").alias("more"), F.sum("less").alias("less"))
    twice = whole.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.sum("again").alias("twice"))

    pieces = rows.where(f"kind = {PIECES}").select("key", "piece", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    ends = pieces.select("key", "piece").mapInArrow(_joined, "key string, ends string")
    parent = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    nothing = hashlib.sha256().hexdigest()
    edge = whole.join(sums, "key").join(twice, "key", "left").join(ends, "key", "left").join(parent, "parent_key", "left")
    edge = edge.select("conv_id", "depth", "parent_conv_id", "n_convs", (F.col("n_children") - F.coalesce("twice", F.lit(0))).alias("n_children"),
                       (F.col("n_leaves") + F.col("less")).alias("n_leaves"), (F.col("saved_tokens") + F.col("more")).alias("saved_tokens"),
                       F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"))

    node = rows.where(f"kind = {NODE}")
    names = [f.split()[0] for f in _NODE.split(", ")]
    # children of a border node: its smallest member is known now; they come from one shard's rows
    known = border.select("path", "depth", "key").join(whole.select("key", F.col("conv_id").alias("above")), "key")
    known = known.select("path", (F.col("depth") + 1).alias("depth"), "above")
    below = node.where("path is not null").join(known, ["path", "depth"]).withColumn("parent_conv_id", F.col("above"))
    return node.where("path is null").select(*names).union(below.select(*names)).union(edge.select(*names))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of the conversations in ``turns`` (conv_id, turn, role, text; other columns are
    ignored), rebuilt on the first turns of their bases: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Turns go by turn, null first; rows of one turn by role, then by digest of the text, repeated rows stay. Null role or
    text is empty; rows of a null conv_id are left out; conversations without turns after rebuilding end at the root. An
    empty table has no nodes. Turns are the same when 126 bits of their digests are. A conversation's digests (20 bytes a
    turn) lie in one task, its texts do not.
    """
    c.workers_import(turns.sparkSession)
    rows = c.columns_of(turns, {"conv_id": "long", "turn": "long", "role": "string", "text": "string"})
    return prefix_trie(rebuilt_from_bases(c.stored(_records(rows), "conversations")))


def op12_conversation_trie(spark, sf_dir):
    return conversation_trie(c.read_table(spark, sf_dir, "conversations"))


def oracle_sql() -> str:
    """Every prefix of every rebuilt conversation, grouped; subtrees by each node's own path; crc32 bit by bit."""
    return """
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p,
                  {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''),
             lambda s: [unicode(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END), 4294967295) % 6 AS h FROM t),
turns AS (SELECT i.c, t.p, t.t FROM ids i JOIN t ON t.c = i.c - i.c % 100 AND t.p <= i.h
          UNION ALL SELECT i.c, t.p + 10, t.t FROM ids i JOIN t ON t.c = i.c AND t.p > i.h),
conv AS (SELECT i.c, coalesce(list(t ORDER BY p) FILTER (t IS NOT NULL), []) AS l FROM ids i LEFT JOIN turns USING (c) GROUP BY i.c),
member AS (SELECT c, d, l[1:d] AS k, len(l) = d AS last FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM conv)),
node AS (SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, coalesce(len(k[d].text), 0) AS size, bool_and(last) AS leaf,
                sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256 FROM member GROUP BY d, k),
up AS (SELECT n.*, unnest(range(0, d + 1)) AS a FROM node n),
sums AS (SELECT a AS d, k[1:a] AS k, sum(leaf::INT) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens, count(*) FILTER (d = a + 1) AS n_children FROM up GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM node n JOIN sums s USING (d, k) LEFT JOIN node p ON p.d = n.d - 1 AND p.k = n.k[1:n.d - 1]
"""

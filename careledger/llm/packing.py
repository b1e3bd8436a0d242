"""Operator 8: hierarchical packing of documents into sequences of several lengths.

Each task tokenizes its documents and packs them in groups of ``GROUP`` tokens or so:

* a document's whole windows of the longest length are sequences of their own; what is
  left of it (or all of it) goes to the tier of the shortest sequence that holds it, a
  quarter, a half or the whole of the longest;
* from the longest tier down, a remainder opens a sequence of its tier's length, and the
  gap behind it is filled from the same and shorter tiers, longest that fits first; a gap
  that no whole remainder fits takes the head of the next one, whose rest goes to its own tier;
* the last sequence of a task shrinks to the smallest power of two that holds it; the
  others are full. A task so wastes less than half a window;
* sequences of a group are dealt to step groups of ``per_step`` longest ones' tokens, by
  length and then by the sum of squares of their pieces' lengths (the cost of attention),
  up and down in turn, so that steps of a group hold alike numbers of each length.

Nothing is shuffled, and a task that is run again packs the same rows the same way: the
sequence ids carry the number of the task's partition.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as c
from .tokens import token_ids, tokenizer_path

LONGEST = 1024
#: Tokens packed at a time.
GROUP = 1 << 22


def _lengths(window):
    """Lengths of sequences, the shortest first."""
    return sorted({max(1, window // 4), max(1, window // 2), window})


def _lay(pieces, window):
    """Fill sequences with remainders, pieces = [(length, key)]: lists of (key, start in piece, length).

    Returns the full sequences and the pieces left over, less than a window together.
    """
    tiers = defaultdict(list)
    for n, key in sorted(pieces, key=lambda x: (x[0], x[1])):
        tiers[n].append((key, 0))
    lengths = sorted(tiers)
    left = sum(n for n, _ in pieces)
    full = []
    own = _lengths(window)
    while lengths:
        opened = own[bisect.bisect_left(own, lengths[-1])]  # the tier of the longest that is left
        if left < opened:
            break
        gap, row = opened, []
        while gap:
            at = bisect.bisect_right(lengths, gap) - 1
            if at >= 0:  # the longest that fits
                n = lengths[at]
                key, s = tiers[n].pop()
                row.append((key, s, n))
                gap -= n
            else:  # the head of the shortest
                n = lengths[0]
                key, s = tiers[n].pop()
                row.append((key, s, gap))
                rest = n - gap
                if not tiers[rest]:
                    bisect.insort(lengths, rest)
                tiers[rest].append((key, s + gap))
                gap = 0
            if not tiers[n]:
                lengths.remove(n)
        left -= opened
        full.append(row)
    return full, [(n, key, s) for n in reversed(lengths) for key, s in tiers[n]]


def _packed(path, end_id, window, per_step):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                        ("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_length", pa.int32()), ("tier", pa.int32()), ("step_group", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 36
        made = [0]
        held = []  # ((document, start), ids) to be packed
        docs = {}  # document -> (doc_id, tokens, tier)
        state = {"n": 0, "key": 0}
        own = _lengths(window)

        def flush(last):
            pieces = [(len(x), k) for k, (_, x) in enumerate(held)]
            rows, rest = _lay(pieces, window)
            if last and rest:
                rows.append([(k, s, n) for n, k, s in rest])
            out = list(emit(rows, last and bool(rest)))
            if last:
                held.clear()
            else:
                held[:] = [((held[k][0][0], held[k][0][1] + s), held[k][1][s : s + n].copy()) for n, k, s in rest]
                keep = {d for (d, _), _ in held}
                for d in [d for d in docs if d not in keep]:
                    del docs[d]
            state["n"] = sum(len(x) for _, x in held)
            return out

        def emit(rows, partial):
            used = [sum(n for _, _, n in row) for row in rows]
            order = sorted(range(len(rows)), key=lambda r: (-used[r], -sum(n * n for _, _, n in rows[r]), r))
            steps = max(1, sum(used) // (per_step * window))
            step = {}
            for at, r in enumerate(order):
                turn, place = divmod(at, steps)
                step[r] = place if turn % 2 == 0 else steps - 1 - place
            first_step = made[0]
            cols = [[] for _ in schema]
            for r, row in enumerate(rows):
                length = used[r] if not (partial and r == len(rows) - 1) else max(1, 1 << (used[r] - 1).bit_length())
                at = 0
                for k, s, n in row:
                    (d, start), x = held[k]
                    doc_id, total, tier = docs[d]
                    part = x[s : s + n]
                    for col, v in zip(cols, (doc_id, start + s, n, zlib.crc32(part.tobytes()), total, base + made[0] + r, at, length, tier, base + first_step + step[r], part.view(np.int32)), strict=True):
                        col.append(v)
                    at += n
            made[0] += len(rows)
            for at in range(0, len(cols[0]), 4096):
                yield pa.record_batch([pa.array(col[at : at + 4096], f.type) for col, f in zip(cols, schema, strict=True)], schema=schema)

        for b in batches:
            ids = b.column(0).to_pylist()
            for i, _, flat, per in token_ids(c.texts_of(b.column(1)), path):
                at = np.cumsum(per) - per
                for x in range(len(per)):
                    t = np.empty(per[x] + 1, np.uint32)
                    t[:-1] = flat[at[x] : at[x] + per[x]]
                    t[-1] = end_id
                    key = state["key"]
                    state["key"] += 1
                    rest = len(t) % window
                    docs[key] = (ids[i + x], len(t), own[bisect.bisect_left(own, rest or window)])
                    for s in range(0, len(t) - rest, window):
                        held.append(((key, s), t[s : s + window]))
                    if rest:
                        held.append(((key, len(t) - rest), t[len(t) - rest :]))
                    state["n"] += len(t)
                    if state["n"] >= GROUP:
                        yield from flush(False)
        if held:
            yield from flush(True)

    return run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length int, tier int, step_group long, ids array<int>"


def pack(docs: DataFrame, path: str | None = None, end_id: int = 0, window: int = LONGEST, per_step: int = 8) -> DataFrame:
    """One row per piece of a document (doc_id, text; other columns are ignored) with its place in a sequence.

    A document's ids are those of its text (null: empty) and ``end_id``, so an empty text is one id. doc_tokens
    counts them, start those before the piece; ids are the piece's. ids_crc32 is over little-endian unsigned
    32-bit ids. sequence_length is the padded length, tier the sequence length that the document's remainder is routed to. Null or repeated
    ids are documents of their own. An empty table gives no rows.
    """
    rows = c.columns_of(docs, {"doc_id": "long", "text": "string"})
    fn, schema = _packed(path or tokenizer_path("byte_bpe_50k.json"), end_id, window, per_step)
    return rows.mapInArrow(fn, schema)


def op8_hierarchical_packing(spark, sf_dir):
    return pack(c.read_table(spark, sf_dir, "documents")).drop("ids")

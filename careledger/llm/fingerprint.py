"""Operator 5: document fingerprints of improbable features.

A window of ``WINDOW`` bytes begins at every word, and at every character that has more
than ``WINDOW`` bytes without white space before it. Its entropy (over 32 classes of bytes)
falls into one of ``BINS`` bins, and one pass over the corpus counts how many windows each
bin has: the fewer, the rarer. Of the windows in reach of one another the one of the rarest
bin is selected, so selection depends on its surroundings only. Hashes of the selected windows go in order
into Bloom filters of 2,048 bits, a new one after every 128 features. Two chains are
compared filter by filter: common bits beyond those that chance gives, over the most
there could be, best match for each filter of the shorter chain, averaged by its bits.
Texts of under 512 bytes also have all their windows of 8 bytes as features, and those of
under 64 bytes no others, so that an edit across a limit leaves features in common.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as c

WINDOW, REACH, BINS = 32, 3, 256
BITS, EACH, HASHES = 2048, 128, 5
SHORT, SHORT_BOTH, SHORT_ONLY = 8, 512, 64
#: Bits of entropy below which a window says nothing; it comes last.
PLAIN = 2.0
#: Windows whose entropy is found at a time.
AT_ONCE = 1 << 17

_COUNT = np.arange(WINDOW + 1, dtype=np.float64)
_PLOGP = np.where(_COUNT > 0, -(_COUNT / WINDOW) * np.log2(np.maximum(_COUNT, 1) / WINDOW), 0.0)
_FIELDS = [np.where(np.arange(256) % 32 // 8 == q, np.uint64(1) << (np.arange(256).astype(np.uint64) % np.uint64(8) * np.uint64(8)), np.uint64(0)) for q in range(4)]


def _starts(raw, off):
    """(start, text) of words and, in stretches without white space, of the characters beyond their first ``WINDOW`` bytes."""
    s, _, text = c.words_of(raw, off)
    at = np.arange(len(raw))
    last = np.maximum.accumulate(np.where(c.SPACE[raw], at, -1))  # white space at or before each byte
    last = np.maximum(last, np.repeat(off[:-1], np.diff(off)) - 1)  # of this text
    more = np.flatnonzero((at - last > WINDOW) & ((raw & 0xC0) != 0x80))
    if not len(more):
        return s, text
    s = np.union1d(s, more)
    return s, np.searchsorted(off, s, side="right") - 1


def _windows(raw, off):
    """(start, text, bin) of the whole windows at ``_starts``."""
    s, text = _starts(raw, off)
    ok = s + WINDOW <= off[text + 1] if len(s) else np.zeros(0, bool)
    s, text = s[ok], text[ok]
    h = np.zeros(len(s))
    for f in _FIELDS:
        p = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(f[raw], out=p[1:], dtype=np.uint64)  # eight counters in a word; differences are exact
        for i in range(0, len(s), AT_ONCE):
            x = s[i : i + AT_ONCE]
            h[i : i + AT_ONCE] += _PLOGP[(p[x + WINDOW] - p[x]).view(np.uint8).reshape(-1, 8)].sum(1)
    return s, text, np.minimum((h * (BINS / 5.0)).astype(np.int64), BINS - 1)


def _tally(batches):
    for b in batches:
        raw, off = c.buffers(c.texts_of(b.column(0)))
        total = np.zeros(BINS, np.int64)
        for i, j in c.slices(off):
            total += np.bincount(_windows(raw[off[i] : off[j]], off[i : j + 1] - off[i])[2], minlength=BINS)
        yield pa.record_batch([pa.array(np.arange(BINS, dtype=np.int32)), pa.array(total)], names=["bin", "n"])


def rarity(docs: DataFrame) -> np.ndarray:
    """Rank of each entropy bin, the rarest first, counted over all texts; BINS rows reach the driver."""
    got = docs.select(F.col("text").cast("string")).mapInArrow(_tally, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(BINS, np.int64)
    for r in got:
        n[r["bin"]] = r["n"]
    plain = np.arange(BINS) < PLAIN * BINS / 5.0
    rank = np.empty(BINS, np.int64)
    rank[np.lexsort((np.arange(BINS), n, plain))] = np.arange(BINS)
    return rank


def chains(texts: list[str], rank: np.ndarray) -> list[np.ndarray]:
    """The Bloom filters of each text, (filters, BITS / 64) uint64. A text with no window is one feature, an empty one none."""
    raw, off = c.buffers(pa.array(texts, pa.large_string()))
    out = []
    for i, j in c.slices(off):
        part, o = raw[off[i] : off[j]], off[i : j + 1] - off[i]
        s, text, bins = _windows(part, o)
        h = c.span_hashes(part, s, s + WINDOW)
        key = (rank[bins].astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16))
        take = np.ones(len(s), bool)
        for d in range(1, REACH + 1):
            other = text[d:] != text[:-d]
            take[d:] &= other | (key[d:] < key[:-d])
            take[:-d] &= other | (key[:-d] <= key[d:])
        h, text = h[take], text[take]
        whole = c.span_hashes(part, o[:-1], o[1:])
        at = np.searchsorted(text, np.arange(j - i + 1))
        for x in range(j - i):
            n = int(o[x + 1] - o[x])
            f = h[at[x] : at[x + 1]] if n >= SHORT_ONLY else h[:0]
            if SHORT <= n < SHORT_BOTH:
                begin = np.arange(n - SHORT + 1)
                f = np.concatenate([f, c.span_hashes(part[o[x] : o[x + 1]], begin, begin + SHORT)])
            if not len(f) and n:
                f = whole[x : x + 1]
            if len(f):
                _, first = np.unique(f, return_index=True)
                f = f[np.sort(first)]
            filters = np.zeros(-(-len(f) // EACH) * BITS, bool)
            base = np.arange(len(f)) // EACH * BITS
            f = c.mix(f)
            for k in range(HASHES):
                filters[base + ((f >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = True
            out.append(np.packbits(filters).view(np.uint64).reshape(-1, BITS // 64))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1; equal chains (empty ones too) 1, an empty and another 0."""
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    nb = np.bitwise_count(b).sum(1).astype(np.float64)
    score = bits = 0.0
    for x in a:
        nx = float(np.bitwise_count(x).sum())
        common = np.bitwise_count(b & x).sum(1)
        chance = nx * nb / BITS
        bits += nx
        score += nx * float(np.clip((common - chance) / np.maximum(np.minimum(nb, nx) - chance, 1e-9), 0.0, 1.0).max())
    return score / bits


def _text(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def _compare(rank):
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.large_string()),
                        ("edited_fingerprint", pa.large_string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches):
        last = None  # (id, text, chain) whose next row is still to come
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                guard, ids = part.column(1).to_pylist(), part.column(2).to_pylist()
                texts = c.texts_of(part.column(3)).to_pylist()
                own = chains(texts, rank)
                rows = list(zip(guard, ids, texts, own, strict=True))
                if last is not None:
                    rows.insert(0, last)
                pairs = [(x, y) for x, y in zip(rows, rows[1:]) if not x[0]]
                last = rows[-1]
                edited = []
                for x, y in pairs:
                    n = len(x[2]) // 4
                    edited.append(x[2][: len(x[2]) - n] + y[2][:n])
                other = chains(edited, rank)
                cols = [[x[1] for x, _ in pairs], [len(x[2]) for x, _ in pairs], [hashlib.sha256(e.encode()).hexdigest() for e in edited],
                        [_text(x[3]) for x, _ in pairs], [_text(e) for e in other], [likeness(x[3], e) for (x, _), e in zip(pairs, other, strict=True)],
                        [likeness(x[3], y[3]) for x, y in pairs]]
                yield pa.record_batch([pa.array(v, f.type) for v, f in zip(cols, schema, strict=True)], schema=schema)

    return run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame, rows_each: int = 4000) -> DataFrame:
    """One row (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row of ``docs``
    (doc_id, text; other columns are ignored).

    The next document is that of the next doc_id (null first, repeated ids by text), after the last the first; a lone
    row is its own next. Ranges of doc_id are sorted each for itself, and each gets the first row of the next range as
    a guard, so no task sees more than its range. A null text is empty; an empty text has an empty fingerprint. An
    empty table gives no rows.
    """
    rows = c.columns_of(docs, {"doc_id": "long", "text": "string"})
    rank = rarity(rows)
    bounds = c.range_bounds(rows, "doc_id", rows_each)
    rows = rows.select(c.range_of(F.col("doc_id"), bounds).cast("int").alias("part"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    least = rows.groupBy("part").agg(F.min("doc_id").alias("id"), F.max(F.col("doc_id").isNull()).alias("none"))
    least = least.select("part", F.when(~F.col("none"), F.col("id")).alias("id"))
    order = Window.orderBy("part")  # a row for each range
    to = F.coalesce(F.lag("part").over(order), F.last("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    least = c.stored(least.select("part", "id", to.alias("to")), "firsts")
    guards = rows.join(least.withColumnRenamed("part", "p"), (F.col("part") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("id")))
    guards = guards.groupBy("to", "doc_id").agg(F.min("text").alias("text")).select(F.col("to").alias("part"), F.lit(True).alias("guard"), "doc_id", "text")
    both = rows.select("part", F.lit(False).alias("guard"), "doc_id", "text").union(guards)
    both = both.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "guard", "doc_id", "text")
    fn, schema = _compare(rank)
    return both.mapInArrow(fn, schema)


def op5_document_fingerprints(spark, sf_dir):
    return fingerprints(c.read_table(spark, sf_dir, "documents"))

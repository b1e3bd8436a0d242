"""Operator 1: substring dedup by content-defined chunks.

A gear rolling hash (a byte's table value added to the doubly shifted hash, so 16 bytes
of memory) is read at the end of each word; a chunk ends where it is the largest among
the two word ends on either side. Cuts depend on nothing farther away, so an insertion
shifts no other chunk. Compared are groups of adjacent chunks, the fewest that hold
``min_words`` words from a chunk on (or up to a chunk that ends none of those), by a 64-bit
digest of their chunks in order: every occurrence but the first (smallest doc_id, then
position; later ones within one text included) is a repeat, and the chunks it covers are
removed. So short chunks that each came before, but not together, stay. A removed run
misses at most the chunk cut by either end of a repeated passage.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

#: Words of adjacent chunks that repeat together that make them a repeated passage.
MIN_WORDS = 16
#: So many bytes for each of min_words count too (text without white space).
LONG_WORD = 24
#: Word ends on either side that a cut must exceed.
REACH = 2
#: A text without white space is also cut at characters after so many bytes without any.
UNBROKEN = 64

_GEAR = (c.seeds(256, 7000) >> np.uint64(32)).astype(np.uint32)


def gear(raw: np.ndarray) -> np.ndarray:
    """Rolling hash at each byte: sum of table[byte k back] << 2k, k = 0..15, in 32 bits."""
    h = _GEAR[raw]
    for m in (1, 2, 4, 8):
        s = np.zeros_like(h)
        s[m:] = h[:-m] << np.uint32(2 * m)
        h = h + s
    return h


def cuts_of(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks (start, end, text) that tile the texts raw[off[i]:off[i+1]]; a cut lies after a word and the
    white space behind it."""
    space = c.SPACE[raw]
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    lead = (raw & 0xC0) != 0x80
    begin = np.zeros(n, bool)  # a word begins here
    begin[1:] = ~space[1:] & space[:-1]
    last = np.where(space, np.arange(n), -1)
    last = np.maximum.accumulate(last)
    begin |= lead & (np.arange(n) - np.maximum(last, np.repeat(off[:-1], np.diff(off))) > UNBROKEN)
    begin[off[:-1][off[:-1] < n]] = False
    at = np.flatnonzero(begin)
    text = np.searchsorted(off, at, side="right") - 1
    # the hash sees the word's end: bytes before the white space, of this text only
    solid = np.maximum.accumulate(np.where(space, -1, np.arange(n))) + 1  # behind the last solid byte up to here
    word_end = np.maximum(solid[at - 1], off[text] + 1)
    h = gear(raw)
    score = h[word_end - 1].astype(np.int64)
    near = word_end - off[text] < 16  # the hash would reach into the text before
    for i in np.flatnonzero(near):
        v = 0
        for b in raw[off[text[i]] : word_end[i]]:
            v = ((v << 2) + int(_GEAR[b])) & 0xFFFFFFFF
        score[i] = v
    cut = np.ones(len(at), bool)
    for d in range(1, REACH + 1):
        same = text[d:] == text[:-d]
        cut[d:] &= ~same | (score[d:] >= score[:-d])
        cut[:-d] &= ~same | (score[:-d] > score[d:])
    edges = np.union1d(at[cut], off[:-1][np.diff(off) > 0])
    start = edges
    end = np.append(edges[1:], n)
    return start, end, np.searchsorted(off, start, side="right") - 1


def _n_words(raw, start, end, off):
    """Words that begin in each chunk."""
    s, _, _ = c.words_of(raw, off)
    return np.searchsorted(s, end) - np.searchsorted(s, start)


def _trimmed(raw, start, end):
    """End of each chunk without the white space behind it; the first byte stays."""
    solid = np.maximum.accumulate(np.where(c.SPACE[raw], -1, np.arange(len(raw)))) + 1  # behind the last solid byte up to here
    return np.maximum(np.minimum(end, solid[end - 1]), start + 1) if len(end) else end.copy()


def _groups(raw, off, start, end, text, min_words):
    """(first chunk, end, text, digest) of the groups of adjacent chunks, by text and first chunk."""
    n = len(start)
    stop = _trimmed(raw, start, end)
    lo, hi = np.searchsorted(text, text), np.searchsorted(text, text, side="right")
    first, last = np.full(n, n + 1), np.full(n, -1)  # shortest group from a chunk on, up to a chunk
    for size, least in ((_n_words(raw, start, end, off), min_words), (stop - start, LONG_WORD * min_words)):
        cum = np.concatenate([[0], np.cumsum(size)])
        first = np.minimum(first, np.searchsorted(cum, cum[:-1] + least))
        last = np.maximum(last, np.searchsorted(cum, cum[1:] - least, side="right") - 1)
    i = np.flatnonzero(first <= hi)
    j = np.flatnonzero(last >= lo)
    j = j[first[last[j]] != j + 1]
    a, b = np.concatenate([i, last[j]]), np.concatenate([first[i], j + 1])
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    r, rinv = c._powers(n + 1)
    p = np.zeros(n + 1, np.uint64)
    np.cumsum(c.span_hashes(raw, start, stop) * r[:-1], out=p[1:], dtype=np.uint64)
    return a, b, text[a], c.mix((p[b] - p[a]) * rinv[a] + (b - a).astype(np.uint64))


def _chunks(min_words):
    """Distinct (digest, id) of the groups of each text."""

    def run(batches):
        c.forget()
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            raw, off = c.buffers(c.texts_of(b.column(1)))
            for i, j in c.slices(off):
                part, o = raw[off[i] : off[j]], off[i : j + 1] - off[i]
                _, _, text, h = _groups(part, o, *cuts_of(part, o), min_words)
                if not len(h):
                    continue
                order = np.lexsort((h, text))
                h, text = h[order], text[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                yield pa.record_batch([pa.array(h[new].view(np.int64)), pa.array(ids[i:j][text[new]], pa.int64())], names=["digest", "id"])

    return run


def _kept(min_words):
    schema = pa.schema([("row", pa.int64()), ("n_chunks", pa.int64()), ("n_repeated", pa.int64()), ("n_words_removed", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("text", pa.large_string())])

    def run(batches):
        for b in batches:
            rows, texts, marks = b.column(0), b.column(1), b.column(2).to_pylist()
            arr = c.texts_of(texts)
            null = np.asarray(texts.is_null())
            raw, off = c.buffers(arr)
            out = [[], [], [], [], []]
            for i, j in c.slices(off):
                part, o = raw[off[i] : off[j]], off[i : j + 1] - off[i]
                start, end, text = cuts_of(part, o)
                g, g_end, g_text, h = _groups(part, o, start, end, text, min_words)
                order = np.lexsort((np.arange(len(h)), h, g_text))
                twice = np.zeros(len(h), bool)  # came before in the same text
                twice[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (g_text[order[1:]] == g_text[order[:-1]])
                words = _n_words(part, start, end, o)
                first = np.searchsorted(text, np.arange(j - i + 1))
                g_first = np.searchsorted(g_text, np.arange(j - i + 1))
                for x in range(j - i):
                    f, e = first[x], first[x + 1]
                    of = slice(g_first[x], g_first[x + 1])
                    m = marks[i + x]
                    seen = twice[of]
                    if m:
                        seen = seen | np.isin(h[of], np.array(m, np.int64).view(np.uint64))
                    spans, gone = [], 0
                    again = np.zeros(e - f, bool)  # chunks that a group seen before covers
                    if seen.any():
                        rep = np.zeros(e - f + 2, np.int64)
                        np.add.at(rep, g[of][seen] - f + 1, 1)
                        np.add.at(rep, g_end[of][seen] - f + 1, -1)
                        again = np.cumsum(rep)[1:-1] > 0
                        rep[:] = 0
                        rep[1:-1] = again
                        up, down = np.flatnonzero(np.diff(rep) == 1), np.flatnonzero(np.diff(rep) == -1)
                        cum = np.concatenate([[0], np.cumsum(words[f:e])])
                        for s, t in zip(up, down, strict=True):
                            spans.append((int(start[f + s] - o[x]), int(end[f + t - 1] - o[x])))
                            gone += int(cum[t] - cum[s])
                    body = bytes(part[o[x] : o[x + 1]])
                    cps, keep, at = [], [], 0
                    for s, t in spans:
                        keep.append(body[at:s].decode())
                        cps.append([len(body[:s].decode()), len(body[:t].decode())])
                        at = t
                    keep.append(body[at:].decode())
                    out[0].append(int(e - f))
                    out[1].append(int(again.sum()))
                    out[2].append(gone)
                    out[3].append(cps)
                    out[4].append(None if null[i + x] else _joined(keep))
            yield pa.record_batch([rows.cast(pa.int64()), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                                   pa.array(out[3], schema.field("spans").type), pa.array(out[4], pa.large_string())], schema=schema)

    return run, "row long, n_chunks long, n_repeated long, n_words_removed long, spans array<array<bigint>>, text string"


def _joined(parts):
    """What is left, without white space where a passage went from an end."""
    if len(parts) == 1:
        return parts[0]
    return re.sub(r"^[ \t-\r]+|[ \t-\r]+$", "", "".join(parts))


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows of ``docs`` (doc_id, text and any others) with text rid of repeated passages, n_chars where there is one
    made to fit, and new columns dedup_n_chunks, dedup_n_repeated, dedup_n_words_removed and dedup_spans (removed
    [start, end) code points of the old text).

    A passage stays where it comes first: in the document of the smallest doc_id, at its first place there. Null
    texts stay null, empty ones empty; a null doc_id comes first; rows of one doc_id count as one document and lose
    nothing to each other. A text wholly repeated becomes empty; its row stays. An empty table gives no rows. Columns of
    the new ones' names are replaced; names of the others may be any.
    """
    c.workers_import(docs.sparkSession)
    docs = docs.drop(*NEW)
    own, marked = (next(n for n in (f"__{x}{k or ''}" for k in range(len(docs.columns) + 1)) if n not in docs.columns) for x in ("id", "marks"))
    rows = docs.withColumn(own, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))))
    occ = rows.select(own, F.col("text").cast("string")).mapInArrow(_chunks(min_words), "digest long, id long")
    known = occ.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    again = occ.join(known, "digest").where("id > first")
    marks = again.groupBy("id").agg(F.collect_set("digest").alias(marked)).withColumnRenamed("id", own)
    return _cut(rows.join(marks, own, "left"), docs, min_words, own, marked)


#: Columns that substring_dedup adds.
NEW = ("dedup_n_chunks", "dedup_n_repeated", "dedup_n_words_removed", "dedup_spans")


def _cut(both: DataFrame, docs: DataFrame, min_words: int, own: str, marked: str) -> DataFrame:
    """Apply the marks; the other columns ride along."""
    names = docs.columns
    keep, _ = _kept(min_words)
    has_chars = "n_chars" in names

    def run(batches):
        for b in batches:
            got = next(keep([pa.record_batch([b.column(b.schema.get_field_index(x)) for x in (own, "text", marked)], names=["row", "text", "marks"])]))
            out = []
            for x in names:
                col = b.column(b.schema.get_field_index(x))
                if x == "text":
                    col = got.column("text").cast(col.type)
                elif x == "n_chars" and has_chars:
                    col = pa.array([None if t is None else len(t) for t in got.column("text").to_pylist()], pa.int64()).cast(col.type)
                out.append(col)
            out += [got.column("n_chunks"), got.column("n_repeated"), got.column("n_words_removed"), got.column("spans")]
            yield pa.record_batch(out, names=[*names, *NEW])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return both.mapInArrow(run, kinds + ", dedup_n_chunks long, dedup_n_repeated long, dedup_n_words_removed long, dedup_spans array<array<bigint>>")


def op1_substring_dedup(spark, sf_dir):
    docs = c.columns_of(c.read_table(spark, sf_dir, "documents"), {"doc_id": "long", "text": "string", "n_chars": "long"})
    out = substring_dedup(docs)
    return out.select("doc_id", "n_chars", F.col("dedup_n_words_removed").alias("n_words_removed"), F.col("dedup_n_chunks").alias("n_chunks"),
                      F.col("dedup_n_repeated").alias("n_repeated"), F.col("dedup_spans").alias("removed_spans"), "text")

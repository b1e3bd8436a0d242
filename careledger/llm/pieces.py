"""Operator 11: SentencePiece (BPE) encoding by vectorised merge rounds, and decoding.

The merges are those of the library: of all adjacent pairs whose join is a piece, the one of the
highest score goes first, the leftmost of equal ones. A text is cut where no merge can cross:

* before a run of spaces, as no piece has a space behind another character (checked on loading);
  the words so cut are encoded once for each distinct one, and a worker keeps those it has met;
* between two characters that stand side by side in no piece.

All segments of the new words lie in flat arrays of symbols. A round takes the lowest rank of a pair
in each segment, merges its occurrences from left to right in all segments at once, looks up the
pairs that arose, and lets go of segments without a pair. Occurrences behind a merge that made a
pair of the same or a lower rank wait for a later round, so the order is the library's. A long segment
that is held up so again and again (a page of spaces) is finished by a queue.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

#: Words that a worker keeps, and the longest of their ids in bytes.
KEPT, LONGEST = 600_000, 128
#: Bytes of text encoded at a time (a longer text alone).
SLICE = 16 << 20
#: Segments of more symbols that are held up more often are finished by a queue.
LONG, WAITS = 256, 16
NONE = np.int32(2**31 - 1)
SPACE = "▁"
_loaded: dict[str, Vocabulary] = {}


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Vocabulary:
    """Pieces of a model as arrays: symbols are piece ids, then characters that only occur inside pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        names = {sp.id_to_piece(i): i for i in plain}
        if [sp.normalize(t) for t in ("", " a  b ", "A\t\nÅﬁ é")] != ["", "__a__b_".replace("_", SPACE), "_A\t\nÅﬁ_é".replace("_", SPACE)]:
            raise ValueError("only models that leave characters as they are and put a space before a text")
        self.bytes = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        if any(sp.is_unused(i) for i in plain) or not all(sp.is_byte(int(i)) for i in self.bytes):
            raise ValueError("only models of byte fallback without unused pieces")
        if any(SPACE in p.lstrip(SPACE) for p in names):
            raise ValueError("a piece holds a space behind another character")
        self.symbols = dict(names)
        for ch in sorted({ch for p in names for ch in p}):
            self.symbols.setdefault(ch, n + len(self.symbols))
        self.base = max(self.symbols.values()) + 1
        self.n_pieces = n
        self.char = np.full(0x110000, -1, np.int32)
        for s, i in self.symbols.items():
            if len(s) == 1:
                self.char[ord(s)] = i
        order = {s: r for r, s in enumerate(sorted({-sp.get_score(i) for i in plain}))}
        pairs = {}
        for p, i in names.items():
            r = order[-sp.get_score(i)]
            for k in range(1, len(p)):
                a, b = self.symbols.get(p[:k]), self.symbols.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * self.base + b] = (r, i)
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int32)
        self.joined = np.array([pairs[k][1] for k in self.keys.tolist()], np.int32)
        beside = {self.symbols[p[k]] * self.base + self.symbols[p[k + 1]] for p in names for k in range(len(p) - 1)}
        self.beside = np.array(sorted(beside), np.int64)
        self.known: dict[str, bytes] = {}
        c.KEPT_BY_WORKER.append(self.known)

    def _at(self, table: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the sorted table, whether it is there) of each pair of symbols."""
        key = a.astype(np.int64) * self.base + b
        at = np.searchsorted(table, key)
        at[at == len(table)] = 0
        return at, (table[at] == key) & (a >= 0) & (b >= 0)

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, joined symbol) of each pair; NONE where the join is no piece."""
        at, ok = self._at(self.keys, a, b)
        return np.where(ok, self.ranks[at], NONE), np.where(ok, self.joined[at], -1)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of each); the words are not empty, spaces as U+2581."""
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        length = np.fromiter(map(len, words), np.int64, len(words))
        sym, pos = self.char[code], np.arange(len(code))
        new = np.ones(len(code), bool)
        new[1:] = ~self._at(self.beside, sym[:-1], sym[1:])[1]
        new[np.cumsum(length)[:-1]] = True
        done, waits = [], {}
        rank, join = np.full(len(sym), NONE), np.full(len(sym), -1, np.int32)
        inner = np.flatnonzero(~new) - 1
        rank[inner], join[inner] = self.pair(sym[inner], sym[inner + 1])
        while len(sym):
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, len(sym)))
            lowest = np.minimum.reduceat(rank, first)
            if (lowest == NONE).any():
                live = np.repeat(lowest != NONE, size)
                done.append((pos[~live], sym[~live]))
                sym, pos, new, rank, join = sym[live], pos[live], new[live], rank[live], join[live]
                if not len(sym):
                    break
                keep = lowest != NONE
                lowest, size = lowest[keep], size[keep]
            seg = np.repeat(np.arange(len(size)), size)
            here = np.flatnonzero(rank == lowest[seg])
            run = np.ones(len(here), bool)
            run[1:] = np.diff(here) != 1
            start = np.flatnonzero(run)
            here = here[(np.arange(len(here)) - np.repeat(start, np.diff(np.append(start, len(here))))) % 2 == 0]
            here, held = self._in_order(here, sym, join, new, seg, lowest)
            sym[here] = join[here]
            stay = np.ones(len(sym), bool)
            stay[here + 1] = False
            for x in held[size[held] > LONG]:  # long segments that are held up again and again: one by one
                a = np.cumsum(size)[x] - size[x]
                waits[pos[a]] = waits.get(pos[a], 0) + 1
                if waits[pos[a]] > WAITS:
                    b = a + size[x]
                    on = a + np.flatnonzero(stay[a:b])
                    first, left = self._queue(sym[on].tolist())
                    done.append((pos[on[first]], np.array(left, np.int32)))
                    stay[a:b] = False
                    here = here[(here < a) | (here >= b)]
            at = (np.cumsum(stay) - 1)[here]
            sym, pos, new, rank, join = sym[stay], pos[stay], new[stay], rank[stay], join[stay]
            touched = np.zeros(len(sym), bool)
            touched[at] = True
            touched[at[~new[at]] - 1] = True
            left = np.flatnonzero(touched)
            end = np.append(new[1:], True)[left]
            rank[left[end]] = NONE
            left = left[~end]
            rank[left], join[left] = self.pair(sym[left], sym[left + 1])
        at = np.concatenate([p for p, _ in done])
        o = np.argsort(at, kind="stable")
        at, sym = at[o], np.concatenate([s for _, s in done])[o]
        return self._ids(code, at, sym, length)

    def _in_order(self, here, sym, join, new, seg, lowest):
        """(merges of a round that come before any pair of the same or a lower rank that they make, segments so held up)."""
        none = np.zeros(0, np.int64)
        many = np.bincount(seg[here], minlength=len(lowest))[seg[here]] > 1
        if not many.any():
            return here, none
        m = here[many]
        merged = np.zeros(len(sym) + 2, bool)
        merged[m] = True
        had = ~new[m]
        left = np.where(merged[m - 2] & had & (m >= 2), join[m - 2], sym[m - 1])
        lower = np.full(len(m), False)
        lower[had] = self.pair(left[had], join[m[had]])[0] <= lowest[seg[m[had]]]
        has = m + 2 < len(sym)
        has[has] = ~new[m[has] + 2]
        lower[has] |= self.pair(join[m[has]], sym[m[has] + 2])[0] <= lowest[seg[m[has]]]
        if not lower.any():
            return here, none
        stop = np.full(len(lowest), len(sym))
        np.minimum.at(stop, seg[m[lower]], m[lower])
        return here[here <= stop[seg[here]]], np.flatnonzero(stop < len(sym))

    def _queue(self, sym: list[int]) -> tuple[np.ndarray, list[int]]:
        """(place of the first, symbol) of what is left of one segment, its merges taken from a queue."""
        n = len(sym)
        before, after, queue = list(range(-1, n - 1)), [*range(1, n), -1], []
        rank, join = self.pair(np.array(sym[:-1], np.int64), np.array(sym[1:], np.int64))
        table = {}

        def offer(a, b):
            key = (sym[a], sym[b])
            if key not in table:
                r, j = self.pair(np.array(key[:1]), np.array(key[1:]))
                table[key] = int(r[0]), int(j[0])
            r, j = table[key]
            if r != NONE:
                heapq.heappush(queue, (r, a, b, *key, j))

        queue = [(r, a, a + 1, sym[a], sym[a + 1], j) for a, (r, j) in enumerate(zip(rank.tolist(), join.tolist(), strict=True)) if r != NONE]
        heapq.heapify(queue)
        while queue:
            _, a, b, x, y, j = heapq.heappop(queue)
            if sym[a] != x or after[a] != b or sym[b] != y:
                continue
            sym[a], sym[b] = j, -2
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
                offer(a, after[a])
            if before[a] >= 0:
                offer(before[a], a)
        left = [k for k in range(n) if sym[k] != -2]
        return np.array(left), [sym[k] for k in left]

    def _ids(self, code, at, sym, length):
        """Symbols to ids: characters that are no piece by their UTF-8 bytes."""
        owner = np.searchsorted(np.cumsum(length), at, side="right")
        odd = np.flatnonzero((sym < 0) | (sym >= self.n_pieces))
        if not len(odd):
            return sym, np.bincount(owner, minlength=len(length))
        text = code[at[odd]]
        wide = 1 + (text > 0x7F) + (text > 0x7FF) + (text > 0xFFFF)
        count = np.ones(len(sym), np.int64)
        count[odd] = wide
        ids = np.repeat(sym, count)
        raw = np.frombuffer(text.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        first = (np.cumsum(count) - count)[odd]
        ids[np.repeat(first - (np.cumsum(wide) - wide), wide) + np.arange(len(raw))] = self.bytes[raw]
        return ids, np.bincount(owner, weights=count, minlength=len(length)).astype(np.int64)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all distinct words in a row, number of each), new ones encoded together."""
        parts = list(map(self.known.get, words))
        new = [k for k, got in enumerate(parts) if got is None]
        if new:
            if len(self.known) + len(new) > KEPT:
                self.known.clear()
            ids, n = self.merge([words[k].replace(" ", SPACE) for k in new])
            raw, at = ids.astype(np.int32).tobytes(), 0
            for k, e in zip(new, (4 * np.cumsum(n)).tolist(), strict=True):
                parts[k] = raw[at:e]
                if e - at <= LONGEST:
                    self.known[words[k]] = parts[k]
                at = e
        return np.frombuffer(b"".join(parts), np.int32), np.fromiter(map(len, parts), np.int64, len(parts)) // 4

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, end, their ids in a row, number of ids of each), a slice of texts at a time."""
        if pc.any(pc.match_substring(texts, SPACE)).as_py():
            texts = pc.replace_substring(texts, SPACE, " ")
        blank, none = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
        texts = pc.if_else(pc.equal(texts, none), none, pc.binary_join_element_wise(blank, texts, none))
        raw, off = c.buffers(texts)
        for i, j in c.slices(off, SLICE):
            part, o = np.ascontiguousarray(raw[off[i] : off[j]]), off[i : j + 1] - off[i]
            if not len(part):
                yield i, j, np.zeros(0, np.int32), np.zeros(j - i, np.int64)
                continue
            space = part == 32
            cut = space.copy()
            cut[1:] &= ~space[:-1]
            cut[o[:-1][np.diff(o) > 0]] = True
            start = np.flatnonzero(cut)
            coded = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(np.append(start, len(part))), pa.py_buffer(part)).dictionary_encode()
            ids, n = self.words(coded.dictionary.to_pylist())
            index = coded.indices.to_numpy().astype(np.int64)
            first, per = np.cumsum(n) - n, n[index]
            total = np.cumsum(per)
            flat = ids[np.arange(total[-1]) + np.repeat(first[index] - total + per, per)]
            yield i, j, flat, np.diff(np.concatenate([[0], total])[np.searchsorted(start, o)])


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _encode(path: str, decode: bool):
    def run(batches):
        c.forget()
        v = vocabulary(path)
        for b in batches:
            for i, j, flat, n in v.encode(c.texts_of(b.column(1))):
                at = np.concatenate([[0], np.cumsum(n)])
                out = [b.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))]
                if decode:
                    out.append(pa.array(v.library.decode([flat[s:e].tolist() for s, e in zip(at[:-1], at[1:], strict=True)]), pa.string()))
                yield pa.record_batch(out, names=["doc_id", "ids", "decoded"][: len(out)])

    return run


def encode(docs: DataFrame, path: str | None = None, decode: bool = False) -> DataFrame:
    """One row (doc_id, ids array<int>) per row of ``docs`` (doc_id, text; other columns are ignored), with ``decode``
    also ``decoded``, the text that the library makes of the ids.

    The ids are those of the library's encode(text) without begin and end ids. Null or empty text: no ids and an empty
    text. Repeated rows and null doc_ids are separate rows; an empty table gives no rows. A very long text is encoded alone.
    """
    c.workers_import(docs.sparkSession)
    rows = c.columns_of(docs, {"doc_id": "long", "text": "string"})
    kind = "doc_id long, ids array<int>" + (", decoded string" if decode else "")
    return rows.mapInArrow(_encode(path or model_path(), decode), kind)


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, decoded) of rows (doc_id, ids array<int>; other columns are ignored) by the library; null or empty ids:
    an empty text, null among them: left out."""
    path = path or model_path()

    def run(batches):
        sp = vocabulary(path).library
        for b in batches:
            got = [[i for i in x or [] if i is not None] for x in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(sp.decode(got), pa.string())], names=["doc_id", "decoded"])

    c.workers_import(rows.sparkSession)
    return c.columns_of(rows, {"doc_id": "long", "ids": "array<int>"}).mapInArrow(run, "doc_id long, decoded string")


def op11_sentencepiece(spark, sf_dir):
    out = encode(c.read_table(spark, sf_dir, "documents"), decode=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

"""Tokens of texts by a public tokenizer, vectorised over the distinct words of a batch.

The pre-tokenizers of both vocabularies never join a letter with the white space or
punctuation (apostrophes aside) behind it, so a text is cut there, equal pieces are encoded
once, and a worker keeps the ids of pieces it has met (at most ``KEPT``). Where the
tokenizer folds case and drops white space, that is done to ASCII before. A text that may
hold the string of an added token (``<|endoftext|>``) is encoded whole by the tokenizer as loaded.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import common as c

KEPT = 700_000
_known: dict[str, dict] = {}
_loaded: dict[str, object] = {}
_whole: dict[str, tuple[object, list[str]]] = {}
_folds: dict[str, bool] = {}
_marks: dict[str, np.ndarray] = {}
#: Words that are one pre-token each, encoded _RUN at a time.
_PLAIN_FOLDED, _PLAIN = re.compile("[a-z\u00e0-\u00f6\u00f8-\u00ff]+"), re.compile(" [A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_RUN = 500


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[x for x in range(33, 127) if not chr(x).isalnum() and chr(x) != "'"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _tokenizer(path: str):
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        _whole[path] = whole, [t.content for t in whole.get_added_tokens_decoder().values()]
        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True  # words are encoded in runs, which must not make an added token's string
        _loaded[path] = t
        _known[path] = {}
        c.KEPT_BY_WORKER.append(_known[path])
        words = t.get_vocab(True)
        marks = np.zeros(max(words.values()) + 1, bool)
        marks[[i for w, i in words.items() if w.endswith("</w>")]] = True
        marked_ends = marks.any()
        if not marked_ends:
            marks[[i for w, i in words.items() if w.startswith("\u0120")]] = True
        _marks[path] = marks
        _folds[path] = bool(marked_ends) and t.normalizer is not None and [t.normalizer.normalize_str("A \t"), len(t.encode("a a").ids)] == ["a ", 2 * len(t.encode("a").ids)]
    return _loaded[path]


def _encode_words(t, path: str, words: list[str], known: dict) -> None:
    """Encode plain words in one run. Each is one pre-token, so its ids end (folding vocabulary: at an id with the
    word-end suffix) or begin (else: at an id with a leading space) where the vocabulary says so."""
    (run,) = t.encode_batch_fast([(" " if _folds[path] else "").join(words)], add_special_tokens=False)
    ids = np.array(run.ids, np.uint32)
    mark = _marks[path][ids]
    cut = np.flatnonzero(mark) + 1 if _folds[path] else np.append(np.flatnonzero(mark), len(ids))[1:]
    if len(cut) != len(words) or cut[-1] != len(ids):
        raise ValueError("the tokenizer does not keep words apart")
    raw, a = ids.tobytes(), 0
    for w, b in zip(words, (4 * cut).tolist(), strict=True):
        known[w] = raw[a:b]
        a = b


def _piece_ids(path: str, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all pieces in a row, number of each)."""
    t = _tokenizer(path)
    known = _known[path]
    new = [p for p in pieces if p not in known]  # distinct, as pieces are
    if new:
        if len(known) + len(new) > KEPT:
            known.clear()
            new = pieces
        plain = _PLAIN_FOLDED if _folds[path] else _PLAIN
        words = [p for p in new if plain.fullmatch(p)]
        others = [p for p in new if not plain.fullmatch(p)]
        for at in range(0, len(words), _RUN):
            _encode_words(t, path, words[at : at + _RUN], known)
        for at in range(0, len(others), 20_000):
            part = others[at : at + 20_000]
            for p, e in zip(part, t.encode_batch_fast(part, add_special_tokens=False), strict=True):
                ids = e.ids
                known[p] = struct.pack(f"{len(ids)}I", *ids)
    got = list(map(known.__getitem__, pieces))
    n = np.fromiter(map(len, got), np.int64, len(got)) // 4
    return np.frombuffer(b"".join(got), np.uint32), n


def token_ids(arr: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, ids of these texts in a row, number of ids of each), 4 MB of texts at a time.

    The ids are those of ``encode(text, add_special_tokens=False)`` of the tokenizer as it is loaded.
    """
    _tokenizer(path)
    whole, added = _whole[path]
    odd = np.zeros(len(arr), bool)
    for content in added:
        odd |= np.asarray(pc.match_substring(arr, content, ignore_case=True))
    if not odd.any():
        yield from _plain_ids(arr, path)
        return
    for i, j, flat, n in _plain_ids(pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), arr), path):
        parts, n = np.split(flat, np.cumsum(n)[:-1]), n.copy()
        for k in np.flatnonzero(odd[i:j]):
            parts[k] = np.array(whole.encode(arr[int(i + k)].as_py(), add_special_tokens=False).ids, np.uint32)
            n[k] = len(parts[k])
        yield i, j, np.concatenate(parts).astype(np.uint32), n


def _plain_ids(arr: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """As ``token_ids``, for texts without the string of an added token."""
    raw, off = c.buffers(arr)
    for i, j in c.slices(off, 4 * c.SLICE_BYTES):
        part, o = np.ascontiguousarray(raw[off[i] : off[j]]), off[i : j + 1] - off[i]
        if not len(part):
            yield i, j, np.zeros(0, np.uint32), np.zeros(j - i, np.int64)
            continue
        _tokenizer(path)
        space = c.SPACE[part]
        before = part[:-1]
        letter = _LETTER[before]
        letter[1:] |= (part[:-2] == 0xC3) & (before[1:] >= 0x80) & (before[1:] != 0x97) & (before[1:] != 0xB7)
        cut = np.zeros(len(part), bool)
        cut[1:] = (space[1:] & ~space[:-1]) | (letter & _MARK[part[1:]])
        if _folds[path]:
            cut[1:] |= space[:-1] & ~space[1:]
        cut[o[:-1][np.diff(o) > 0]] = True
        if _folds[path]:
            keep = ~space
            o = np.concatenate([[0], np.cumsum(keep)])[o]
            part, cut = np.ascontiguousarray(_LOWER[part[keep]]), cut[keep]
            if not len(part):
                yield i, j, np.zeros(0, np.uint32), np.zeros(j - i, np.int64)
                continue
        start = np.flatnonzero(cut)
        ends = np.append(start, len(part))
        pieces = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(part))
        coded = pieces.dictionary_encode()
        ids, n = _piece_ids(path, coded.dictionary.to_pylist())
        index = coded.indices.to_numpy().astype(np.int64)
        first = np.cumsum(n) - n
        per = n[index]
        total = np.cumsum(per)
        flat = ids[np.arange(total[-1]) + np.repeat(first[index] - total + per, per)]
        at = np.concatenate([[0], total])[np.searchsorted(start, o)]
        yield i, j, flat, np.diff(at)

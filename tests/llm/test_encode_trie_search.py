"""Operators 11 to 13 against the library, brute force and odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from careledger.llm import pieces, search, trie

# ------------------------------------------------------------------ 11

PARTS = ["a", "b", "e", "t", "h", " ", "  ", "▁", "\n", "\t", "==", "aaaa", "the", "ing", "日本", "語", "😀", "é", "é", "x" * 50, " " * 33, "<s>", "<0x0A>",
         "\x00", "ab" * 20, "1", "0" * 9, "-" * 70, "ﬁ", "http://www.", "​", "АБ", "ска"]


def odd_texts():
    rng = random.Random(4)
    out = [None, "", " ", "  ", "▁", " a  b ", "same", "same", " " * 4000, "x" * 5000, "=-" * 3000, "long " * 30_000]
    out += ["".join(rng.choices(PARTS, k=rng.randint(1, 40))) for _ in range(1500)]
    return out + ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzABC0123456789+/", k=20_000))]


def test_pieces_are_those_of_the_library(spark):
    library = pieces.vocabulary(pieces.model_path()).library
    texts = odd_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'x' AS ids", "1 AS decoded")
    rows = pieces.encode(docs, decode=True).collect()
    want = library.encode([t or "" for t in texts])
    assert len(rows) == len(texts)
    for r in rows:
        assert list(r.ids) == want[r.doc_id], repr(texts[r.doc_id][:60])
        assert r.decoded == library.decode(want[r.doc_id])
    back = pieces.decode(pieces.encode(docs)).collect()
    assert {r.doc_id: r.decoded for r in back} == {r.doc_id: r.decoded for r in rows}


def test_pieces_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a null id"), (3, None), (3, "a"), (3, "a")], "doc_id long, text string")
    got = sorted(((r.doc_id, len(r.ids), r.decoded) for r in pieces.encode(docs, decode=True).collect()), key=str)
    assert got == sorted([(None, 3, "a null id"), (3, 0, ""), (3, 1, "a"), (3, 1, "a")], key=str)
    assert pieces.encode(docs.where("doc_id > 9"), decode=True).count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [264, None])], "doc_id long, ids array<int>")
    assert sorted(map(tuple, pieces.decode(odd).collect())) == [(1, ""), (2, ""), (3, "a")]


# ------------------------------------------------------------------ 12


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {k: [x[1:] for x in sorted(v)] for k, v in own.items()}
    built = {}
    for k in own:
        h = zlib.crc32(str(k).encode()) % 6
        built[k] = own.get(k - math.fmod(k, 100), [])[:h] + own[k][h:]
    members = defaultdict(list)
    for k, turns in sorted(built.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(k)
    sums = defaultdict(lambda: [0, 0, 0])
    children = Counter(p[:-1] for p in members if p)
    for path, who in members.items():
        for d in range(len(path) + 1):
            s = sums[path[:d]]
            s[0] += path not in children
            s[1] += (len(who) - 1) * len(path[-1][1]) if path else 0
    out = []
    for path, who in members.items():
        ends = ",".join(str(k) for k in who if len(built[k]) == len(path))
        out.append((who[0], len(path), members[path[:-1]][0] if path else None, len(who), children[path], sums[path][0], sums[path][1],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def talks():
    rng = random.Random(8)
    rows = []
    for conv in range(0, 420):
        if conv in (100, 300):
            continue  # absent bases
        n = rng.choice([1, 2, 3, 4, 5, 8]) if conv % 50 else 40
        seed = conv % 7
        for t in range(n):
            deep = rng.random() < 0.1
            rows.append((conv, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {conv if deep else seed} é😀"))
    for conv in range(1000, 1300):  # one very common conversation, and its copies' ids of several widths
        rows += [(conv * 7, t, "user", "hello") for t in range(5)]
    rows += [(2001, None, None, None), (2001, 0, "user", ""), (2001, 1, "", None), (2002, 0, None, ""), (2002, 1, "user", None)]
    rows += [(-5, 0, "user", "below zero"), (-105, 0, "user", "below zero"), (None, 0, "user", "no id")]
    for conv in (5001, 5002, 5003):  # 90 equal turns and a tail each
        rows += [(conv, t, "user", f"step {t}") for t in range(90)] + [(conv, 90, "user", str(conv))]
    return rows


@pytest.mark.parametrize("shard_turns", [40, 100_000])
def test_trie_equals_brute_force(spark, monkeypatch, shard_turns):
    monkeypatch.setattr(trie, "SHARD_TURNS", shard_turns)  # the first: many shards, borders inside equal conversations
    rows = talks()
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS ids", "'k' AS key", "2 AS depth")
    got = sorted(map(tuple, trie.conversation_trie(turns.repartition(5)).collect()), key=str)
    assert got == brute_trie(rows)


def test_trie_odd_rows(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert trie.conversation_trie(spark.createDataFrame([], kind)).count() == 0
    assert trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], kind)).count() == 0
    rows = [(7, 1, "user", "a"), (7, 1, "user", "a"), (7, 1, "user", "a")]
    assert sorted(map(tuple, trie.conversation_trie(spark.createDataFrame(rows, kind)).collect()), key=str) == brute_trie(rows)


# ------------------------------------------------------------------ 13


def terms(t):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t or "")]


def brute_search(docs, items, top):
    own = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, words = sum(bool(x) for _, x in own), sum(sum(x.values()) for _, x in own)
    df = Counter(t for _, x in own for t in x)
    out = []
    for item, text in items:
        scores = []
        for d, have in own:
            m = 75 + (25 * sum(have.values()) * n_docs) // max(words, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * have[t]) // (1000 * have[t] + 12 * m)) for t in terms(text) if have[t])
            if s > 0:
                scores.append((-s, d is None, d, s))
        scores.sort(key=lambda x: x[:2] + (x[2] or 0,))
        out += [(item, k, d, s) for k, (_, _, d, s) in enumerate(scores[:top], 1)]
    return sorted(out, key=str)


def library():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "naïve", "日本", "x-y", "A", "a"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(150)]
    docs += [(200 + i, docs[5][1]) for i in range(40)] + [(5, docs[5][1]), (None, docs[5][1]), (400, None), (401, ""), (402, "--"), (403, "W1 " * 4000)]
    common = [rng.sample(words, 12) for _ in range(4)]
    items = [(i, " ".join(rng.choice(common) + rng.choices(words, k=rng.randint(0, 9)))) for i in range(40)]
    return docs, items + [(40, None), (41, "..."), (42, "nowhere"), (43, "w1 w1 W1 w2")]


@pytest.mark.parametrize("block,cells", [(50_000, 4_000_000), (120, 4_000_000)])
def test_search_equals_brute_force(spark, monkeypatch, block, cells):
    monkeypatch.setattr(search, "BLOCK_TERMS", block)  # the second: several blocks of items
    docs, items = library()
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item", "2 AS score").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id")
    got = sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in search.ranked_search(d, q).collect()), key=str)
    assert got == brute_search(docs, items, 20)


def test_search_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    assert search.ranked_search(docs.where("doc_id > 5"), items).count() == 0
    assert search.ranked_search(docs, items.where("item_id > 5")).count() == 0
    assert search.ranked_search(docs, spark.createDataFrame([(1, None)], "item_id long, text string")).count() == 0


def test_the_sharing_graph_sums_to_the_items():
    rng = random.Random(5)
    items = [rng.choices(range(30), k=rng.randint(0, 25)) for _ in range(60)]
    leaves, joins, nodes = search.sharing_graph(items)
    held = [Counter(x) for x in leaves]
    for a, b in joins:
        held.append(held[a] + held[b])
    for want, mine in zip(items, nodes, strict=True):
        assert sum((held[k] for k in mine), Counter()) == Counter(want)
    assert sum(map(len, nodes)) + len(joins) < sum(map(len, items))
    pairs = Counter((a, b) for mine in nodes for i, a in enumerate(mine) for b in mine[i + 1 :])
    assert max(pairs.values(), default=0) < 2

"""Operator 13: ranked lexical search for many queries at once, with shared work done once.

Scores are sums over the terms of an item, so items that share terms share parts of the sum:

* the terms of all items are mined for shared sets: terms held by the same items form one node, then
  the two nodes that most items still share are joined into a new node, again and again, until no two
  nodes have two items in common. A node of the resulting graph is the sum of two others;
* documents are read twice, in blocks: once for the counts over all documents (N, L and each term's
  document frequency), once to score. In a block each node's accumulator (one score a document) is made
  once, from the nodes below it, and every item is the sum of the few nodes left to it;
* a task keeps the best documents of each item, and the best of all tasks are ranked.

Nothing of the documents is shuffled but those best rows. Items are taken in blocks of bounded size, so
what is sent to the executors does not grow with the table of items.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as c

#: Largest number of terms (repeats counted) of the items taken together.
BLOCK_TERMS = 50_000
#: Scores held at a time: documents of a block times rows (terms and nodes).
CELLS = 4_000_000
SCALE = 1_000_000_000
_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text: str | None) -> list[str]:
    """Terms of a short text: maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""
    return [t.translate(_LOWER) for t in _TERM.findall(text or "")]


def sharing_graph(items: list[list[int]]) -> tuple[list[list[int]], list[tuple[int, int]], list[list[int]]]:
    """(leaf nodes, joins, nodes of each item) for items given as elements, repeats included.

    A leaf is a list of elements that the same items hold equally often; join k, node ``len(leaves) + k``, is the sum
    of two earlier nodes; an item is the sum of its nodes. The r-th repeat of an element is an element of its own.
    """
    holders = defaultdict(set)
    for q, elements in enumerate(items):
        for e, n in Counter(elements).items():
            for r in range(n):
                holders[e, r].add(q)
    same = defaultdict(list)
    for (e, _), who in sorted(holders.items()):
        same[frozenset(who)].append(e)
    leaves = list(same.values())
    nodes = [set() for _ in items]
    for k, who in enumerate(same):
        for q in who:
            nodes[q].add(k)
    shared = {k for k, who in enumerate(same) if len(who) > 1}
    users, pairs = {k: set(who) for k, who in enumerate(same)}, Counter()
    for have in nodes:
        have = sorted(have & shared)
        pairs.update((a, b) for i, a in enumerate(have) for b in have[i + 1 :])
    by_count = defaultdict(set)
    for p, n in pairs.items():
        if n > 1:
            by_count[n].add(p)

    def recount(a, b, less):
        p = (min(a, b), max(a, b))
        n = pairs[p]
        by_count[n].discard(p)
        pairs[p] = n - less
        if n - less > 1:
            by_count[n - less].add(p)

    joins = []
    for n in range(max(by_count, default=1), 1, -1):
        while by_count[n]:
            a, b = min(by_count[n])
            both, new = users[a] & users[b], len(leaves) + len(joins)
            joins.append((a, b))
            for q in both:
                others = [x for x in nodes[q] if len(users[x]) > 1 and x not in (a, b)]
                for x in others:
                    recount(a, x, 1)
                    recount(b, x, 1)
                    pairs[x, new] += 1
                recount(a, b, 1)
                nodes[q] -= {a, b}
                nodes[q].add(new)
            users[new] = both
            users[a], users[b] = users[a] - both, users[b] - both
            for x in {x for q in both for x in nodes[q]}:
                if pairs[x, new] > 1:
                    by_count[pairs[x, new]].add((x, new))
    return leaves, joins, [sorted(x) for x in nodes]


class Plan:
    """Terms, sharing graph and items of a block of items, as sent to the executors."""

    def __init__(self, rows: list[tuple[int, list[str]]]):
        words = sorted({t for _, ts in rows for t in ts})
        place = {t: k for k, t in enumerate(words)}
        self.item_ids = [i for i, _ in rows]
        self.leaves, self.joins, self.items = sharing_graph([[place[t] for t in ts] for _, ts in rows])
        raw, off = c.buffers(c.texts_of(pa.array(words, pa.string())))
        h = c.span_hashes(np.ascontiguousarray(raw), off[:-1], off[1:], fold=True) if words else np.zeros(0, np.uint64)
        o = np.argsort(h)
        self.hashes, self.number, self.n_terms = h[o], o, len(words)
        self.weights = np.zeros(len(words), np.int64)
        self.n_docs = self.n_words = 0

    def counted(self, docs: int, words: int, df: np.ndarray) -> None:
        self.n_docs, self.n_words = docs, words
        self.weights = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)

    def postings(self, texts: pa.Array):
        """(first text, terms of each text, text, term, occurrences): one slice of texts at a time."""
        raw, off = c.buffers(texts)
        for i, j in c.slices(off):
            part, o = raw[off[i] : off[j]], off[i : j + 1] - off[i]
            inside = np.zeros(len(part) + 2, bool)
            inside[1:-1] = _INSIDE[part]
            first, last = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
            cut = o[1:-1]
            cut = cut[(cut > 0) & (cut < len(part))]
            cut = cut[inside[cut] & inside[cut + 1]]
            first[cut] = last[cut] = True
            s, e = np.flatnonzero(first), np.flatnonzero(last)
            text = np.searchsorted(o, s, side="right") - 1
            n = np.bincount(text, minlength=j - i)
            if not self.n_terms or not len(s):
                yield i, n, *(np.zeros(0, np.int64),) * 3
                continue
            h = c.span_hashes(part, s, e, fold=True)
            at = np.searchsorted(self.hashes, h)
            at[at == len(self.hashes)] = 0
            hit = self.hashes[at] == h
            key, tf = np.unique(text[hit] * self.n_terms + self.number[at[hit]], return_counts=True)
            yield i, n, key // self.n_terms, key % self.n_terms, tf

    def scores(self, n: np.ndarray, text: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Scores (items x texts) of a block of texts with n terms each."""
        m = 75 + (25 * n.astype(np.int64) * self.n_docs) // max(1, self.n_words)
        part = np.zeros((self.n_terms, len(n)), np.int64)
        part[term, text] = self.weights[term] * ((SCALE * tf) // (1000 * tf + 12 * m[text]))
        sums = np.zeros((len(self.leaves) + len(self.joins), len(n)), np.int64)
        for k, elements in enumerate(self.leaves):
            sums[k] = part[elements].sum(0)
        for k, (a, b) in enumerate(self.joins, len(self.leaves)):
            np.add(sums[a], sums[b], out=sums[k])
        return np.stack([sums[x].sum(0) for x in self.items]) if self.items else np.zeros((0, len(n)), np.int64)

    def blocks(self, n, text, term, tf):
        """Ranges of texts small enough for CELLS scores, with their postings."""
        rows = max(1, self.n_terms + len(self.leaves) + len(self.joins) + len(self.items))
        step = max(1, CELLS // rows)
        for a in range(0, len(n), step):
            b = min(len(n), a + step)
            f, l = np.searchsorted(text, [a, b])
            yield a, n[a:b], text[f:l] - a, term[f:l], tf[f:l]


def _count(plan):
    def run(batches):
        c.forget()
        p = plan.value
        df, docs, words = np.zeros(p.n_terms, np.int64), 0, 0
        for b in batches:
            for _, n, _, term, _ in p.postings(c.texts_of(b.column(1))):
                df += np.bincount(term, minlength=p.n_terms)
                docs += int((n > 0).sum())
                words += int(n.sum())
        k = np.flatnonzero(df)
        yield pa.record_batch([pa.array(np.concatenate([[-2, -1], k])), pa.array(np.concatenate([[docs, words], df[k]]))], names=["term", "n"])

    return run


def _best(plan, top):
    """The best rows of each item in a task: (item, doc_id, score)."""

    def first(item, score, doc, null):
        o = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[o], score[o], doc[o], null[o]
        start = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.zeros(0, np.int64)
        keep = np.arange(len(item)) - np.repeat(start, np.diff(np.append(start, len(item)))) < top
        return item[keep], score[keep], doc[keep], null[keep]

    def run(batches):
        c.forget()
        p = plan.value
        best = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))
        least = np.ones(len(p.items), np.int64)  # a score below has no place
        for b in batches:
            ids, nulls = np.asarray(b.column(0).fill_null(0)), np.asarray(b.column(0).is_null())
            for i, n, text, term, tf in p.postings(c.texts_of(b.column(1))):
                for a, nb, tx, tm, f in p.blocks(n, text, term, tf):
                    s = p.scores(nb, tx, tm, f)
                    item, at = np.nonzero(s >= least[:, None])
                    if len(item):
                        row = i + a + at
                        best = first(*(np.concatenate(x) for x in zip(best, (item, s[item, at], ids[row], nulls[row]), strict=True)))
                        full = np.bincount(best[0], minlength=len(p.items)) == top
                        low = np.full(len(p.items), np.iinfo(np.int64).max)
                        np.minimum.at(low, best[0], best[1])
                        least = np.where(full, low, 1)
        item, score, doc, null = best
        yield pa.record_batch([pa.array(item), pa.array(doc, mask=null), pa.array(score)], names=["item", "doc_id", "score"])

    return run


def _taken_together(items: DataFrame):
    """Blocks of (item_id, terms), at most BLOCK_TERMS terms each or a single item; the driver holds one at a time."""
    block, held = [], 0
    for r in items.orderBy("item_id").toLocalIterator():
        terms = terms_of(r["text"])
        if block and held + len(terms) > BLOCK_TERMS:
            yield block
            block, held = [], 0
        block.append((r["item_id"], terms))
        held += len(terms)
    if block:
        yield block


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 20) -> DataFrame:
    """The ``top`` documents of highest score above 0 for each item: (item_id, rank, doc_id, score).

    ``docs`` has (doc_id, text), ``items`` (item_id, text); other columns are ignored. Null and empty texts have no
    terms and score 0. Equal scores rank by ascending doc_id (null last); equal rows of a doc_id rank beside each other.
    Item rows of a repeated or null item_id are items of their own, each with its ranks. An empty table of documents or
    items gives no rows. A term is compared by a 64-bit hash.
    """
    spark = docs.sparkSession
    c.workers_import(spark)
    rows = c.columns_of(docs, {"doc_id": "long", "text": "string"})
    out = None
    for block in _taken_together(c.columns_of(items, {"item_id": "long", "text": "string"})):
        plan = Plan(block)
        sent = spark.sparkContext.broadcast(plan)
        counts = rows.mapInArrow(_count(sent), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        got = {r["term"]: r["n"] for r in counts.collect()}  # the terms of this block at most
        plan.counted(got.get(-2, 0), got.get(-1, 0), np.array([got.get(k, 0) for k in range(plan.n_terms)], np.int64))
        sent = spark.sparkContext.broadcast(plan)
        best = rows.mapInArrow(_best(sent, top), "item long, doc_id long, score long")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        best = best.withColumn("share", F.pmod(F.spark_partition_id(), F.lit(64)))
        for by in (["item", "share"], ["item"]):
            best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(plan.item_ids)), "item long, item_id long")  # of one block
        found = best.join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.union(found)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def op13_ranked_search(spark, sf_dir):
    return ranked_search(c.read_table(spark, sf_dir, "documents"), c.read_table(spark, sf_dir, "benchmark"))


def oracle_sql() -> str:
    """Every item's terms against every document that holds them."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    term = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({lower}, {term}) AS t FROM documents),
size AS (SELECT doc_id, len(t) AS n FROM d WHERE len(t) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM size),
q AS (SELECT item_id, unnest(regexp_extract_all({lower}, {term})) AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, docs),
part AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))) AS s
         FROM tf JOIN w USING (term) JOIN size USING (doc_id), total),
score AS (SELECT item_id, doc_id, sum(s)::BIGINT AS score FROM q JOIN part USING (term) GROUP BY ALL HAVING sum(s) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM score QUALIFY rank <= 20
"""

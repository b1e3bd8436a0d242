"""Operator 10: quality classifier as a sparse rule ensemble.

Statistics of the whole text (shares of kinds of characters, word lengths, repetition) are
counted in one pass. A forest of shallow trees is grown on labelled rows; every path from
a root is a rule, a conjunction of bounds on statistics. A logistic model with a lasso
penalty weighs the rules, and those of a nonzero weight become one Spark column expression,
which scores all rows without a model object. No label, language, source or id enters it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as c

#: Labelled rows that are fitted on at most, those of the smallest hash of their id.
FIT_ROWS = 20_000
TREES, DEPTH, PENALTY, SEED = 24, 3, 0.001, 11
#: Score from which label 1 is predicted.
KEEP = 0.7

_KINDS = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": (32,), "line": (10, 13),
    "stop": b".,;:", "cry": b"!?", "bar": b"|<>[]{}\\/=_~^", "mark": b"#$%&*@+", "wide": range(128, 256),
}
STATS = [f"s_{k}" for k in _KINDS] + ["s_words", "s_length", "s_long", "s_distinct", "s_grams", "s_same", "s_tail", "s_capital"]


def _counts(arr: pa.Array) -> np.ndarray:
    """(texts, STATS) doubles; an empty text has zeros."""
    raw, off = c.buffers(arr)
    out = np.zeros((len(arr), len(STATS)))
    kinds = np.zeros(256, np.int64)
    for k, (_, codes) in enumerate(_KINDS.items()):
        kinds[list(codes)] = k + 1
    for i, j in c.slices(off):
        part, o = raw[off[i] : off[j]], off[i : j + 1] - off[i]
        n = np.diff(o)
        kind = kinds[part]
        text_of = np.repeat(np.arange(j - i), n)
        m = len(_KINDS) + 1
        seen = np.bincount(text_of * m + kind, minlength=(j - i) * m).reshape(j - i, m)
        out[i:j, : m - 1] = seen[:, 1:] / np.maximum(n, 1)[:, None]
        s, e, text = c.words_of(part, o)
        h = c.span_hashes(part, s, e)
        words = np.bincount(text, minlength=j - i)
        size = e - s
        at = m - 1
        w = np.maximum(words, 1)
        out[i:j, at] = np.log1p(words)
        out[i:j, at + 1] = np.bincount(text, size, minlength=j - i) / w
        out[i:j, at + 2] = np.bincount(text, size > 16, minlength=j - i) / w
        order = np.lexsort((h, text))
        hs, ts = h[order], text[order]
        new = np.ones(len(h), bool)
        new[1:] = (hs[1:] != hs[:-1]) | (ts[1:] != ts[:-1])
        out[i:j, at + 3] = np.bincount(ts, new, minlength=j - i) / w
        if len(h) > 2:
            g = c.mix(h[:-2] + h[1:-1] * np.uint64(3) + h[2:] * np.uint64(7))
            t3 = text[2:][text[2:] == text[:-2]]
            g = g[text[2:] == text[:-2]]
            order = np.lexsort((g, t3))
            g, t3 = g[order], t3[order]
            new = np.ones(len(g), bool)
            new[1:] = (g[1:] != g[:-1]) | (t3[1:] != t3[:-1])
            grams = np.bincount(t3, minlength=j - i)
            out[i:j, at + 4] = np.where(grams > 0, np.bincount(t3, new, minlength=j - i) / np.maximum(grams, 1), 1.0)
        else:
            out[i:j, at + 4] = 1.0
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
        out[i:j, at + 5] = np.bincount(text, same, minlength=j - i) / w
        if len(h):
            last, first = part[e - 1], part[s]
            out[i:j, at + 6] = np.bincount(text, np.isin(kinds[last], (7, 8, 9)), minlength=j - i) / w
            out[i:j, at + 7] = np.bincount(text, kinds[first] == 1, minlength=j - i) / w
        out[i:j, at + 4][words == 0] = 0.0
    return out


def with_stats(docs: DataFrame) -> DataFrame:
    """``docs`` and the STATS of its text (null: empty). The other columns ride along."""
    names = docs.columns

    def run(batches):
        c.forget()
        for b in batches:
            x = _counts(c.texts_of(b.column(b.schema.get_field_index("text"))))
            yield pa.record_batch([*b.columns, *[pa.array(x[:, k]) for k in range(x.shape[1])]], names=[*names, *STATS])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, kinds + "".join(f", {s} double" for s in STATS))


def _rules(debug: str) -> list[tuple]:
    """Conjunctions ((statistic, '<=' or '>', bound), ...) of all paths from the roots of a printed forest."""
    found, path = set(), []
    for line in debug.splitlines():
        m = re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, (int(m[3]), m[4], float(m[5])))]
        found.add(tuple(sorted({p[1] for p in path})))
    return sorted(found, key=lambda r: (len(r), r))


def _holds(rule) -> Column:
    out = F.lit(True)
    for k, op, v in rule:
        out = out & (F.col(STATS[k]) <= v if op == "<=" else F.col(STATS[k]) > v)
    return out


def fit(rows: DataFrame, label: str) -> tuple[Column, bool]:
    """(score expression over STATS, whether it tells rows apart), fitted on ``rows`` (STATS and a 0/1 ``label``; null labels
    are left out).

    Without rows of both labels, or without a rule, the score is a constant: the share of label 1, or 0.5 without any label.
    """
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = rows.where(F.col(label).isin(0, 1)).withColumn("y", F.col(label).cast("double"))
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    if not 0 < ones < n:
        return F.lit(float(ones / n) if n else 0.5), False
    data = VectorAssembler(inputCols=STATS, outputCol="x").transform(rows)
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.5,
                                    minInstancesPerNode=5).fit(data)
    rules = _rules(forest.toDebugString)
    if not rules:
        return F.lit(float(ones / n)), False
    hold = rows.select("y", *[_holds(r).cast("double").alias(f"r{k}") for k, r in enumerate(rules)])
    hold = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="x").transform(hold).select("x", "y")
    model = LogisticRegression(featuresCol="x", labelCol="y", elasticNetParam=1.0, regParam=PENALTY, maxIter=60).fit(hold)
    score = F.lit(float(model.intercept))
    for r, w in zip(rules, model.coefficients.toArray(), strict=True):
        if w:
            score = score + F.when(_holds(r), float(w)).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score)), bool(model.coefficients.toArray().any())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(stats: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[Column, bool]:
    """Score expression and whether it tells rows apart (``fit``) for ``labels.quality`` from the rows of ``stats`` (doc_id, STATS) that are not held out."""
    marks = c.columns_of(labels, {"doc_id": "long", "quality": "int"}).where("quality is not null")
    train = stats.join(marks, "doc_id").where(~held_out(F.col("doc_id")))
    train = train.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", *STATS).limit(rows).select("quality", *STATS)
    train = c.stored(train, "train")
    out = fit(train, "quality")
    c.drop_stored(train)
    return out


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row (doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text; other columns are ignored).

    Null and empty texts are scored by the same rules from statistics of zero. Repeated ids are rows of their own;
    a null id is not held out. An empty table gives no rows.
    """
    stats = c.stored(with_stats(c.columns_of(docs, {"doc_id": "long", "text": "string"})).drop("text"), "stats")
    score, _ = learn(stats, labels)
    out = stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= KEEP).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id, text and any others) that the classifier keeps, with the columns of ``docs``.

    Every row is kept where no classifier can be learnt: without labels, or with those of one kind only. Null and empty
    texts are judged by statistics of zero, repeated rows alike; a null doc_id has no label but is judged. Names of the
    other columns may be any. An empty table gives no rows.
    """
    # statistics before the join with the labels, so that no text is shuffled
    stats = c.stored(with_stats(c.columns_of(docs, {"doc_id": "long", "text": "string"})).drop("text"), "stats")
    score, learnt = learn(stats, labels)
    c.drop_stored(stats)
    return with_stats(c.as_row(docs, "text")).where(score >= KEEP).select("row.*") if learnt else docs


def op10_quality_classifier(spark, sf_dir):
    return classify(c.read_table(spark, sf_dir, "documents"), c.read_table(spark, sf_dir, "labels"))

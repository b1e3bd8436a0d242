"""Operators of careledger.llm against brute force, round trips and held-out labels."""

from __future__ import annotations

import hashlib
import re
import tempfile
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from careledger.llm import chat, common, embeddings, fingerprint, html_text, jaccard, mixing, packing, quality, substring, tokenfile, tokens

SF = "/root/testdata/sf0.001"
WORDS = [f"w{i}{'abcde'[i % 5]}" for i in range(4000)]
ODD = [(1, None), (2, ""), (3, "  \n"), (4, "one two three"), (4, "one two three"), (5, "x" * 5000), (None, "a null id " * 9), (6, "é ü 日本語   end"), (7, "long " * 20000)]


def text(seed, n):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


def frame(spark, rows, extra=True):
    """Rows (doc_id, text), with further columns of clashing names."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.selectExpr("doc_id", "text", "'x' AS component_id", "1 AS node", "'s' AS source", "0 AS n") if extra else docs


def empty(spark):
    return frame(spark, [(1, "a")]).where("doc_id > 5")


def table(spark, name):
    return common.read_table(spark, SF, name)


# ------------------------------------------------------------------ 7


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {d: root(d) for d, _ in sets}


def family(n=60, seed=3):
    """A base, edited copies of it at all distances from it, a shared passage and plain texts."""
    rng = np.random.default_rng(seed)
    base = text(1, 150).split()
    passage = text(2, 60)
    rows = [(0, " ".join(base))]
    for i in range(1, n):
        w = list(base)
        for at in rng.choice(150, rng.integers(0, 8), replace=False):
            w[at] = f"new{i}at{at}"
        rows.append((i, " ".join(w)))
    rows += [(n + i, passage + " " + text(100 + i, 40)) for i in range(30)]
    rows += [(n + 30 + i, rows[i][1].upper()) for i in range(10)]
    return rows


@pytest.mark.parametrize("listed", [2_000_000, 40, 0])
def test_jaccard_equals_brute_force(spark, monkeypatch, listed):
    monkeypatch.setattr(jaccard, "LISTED", listed)  # all shared columns in the order, some, none
    monkeypatch.setattr(jaccard, "SQUARE", 7)  # many square blocks
    monkeypatch.setattr(jaccard, "PAIRS_EACH", 5)
    rows = family()
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in jaccard.jaccard_join(frame(spark, rows)).collect()}
    want = brute_components(rows)
    assert {d: c for d, (c, _) in got.items()} == want
    assert all(got[d][1] == len(shingles(t)) for d, t in rows)


def test_jaccard_odd_rows(spark):
    got = sorted(map(tuple, jaccard.jaccard_join(frame(spark, ODD)).drop("node", "component").collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (5, 1, 5), (None, 3, None), (6, 1, 6), (7, 1, 7)], key=str)
    assert jaccard.jaccard_join(empty(spark)).count() == 0


# ------------------------------------------------------------------ 1


def test_repeated_passages_go_and_clean_texts_stay(spark):
    passage = text(9, 55)
    rows = [(i, text(200 + i, 80) + " " + passage + " " + text(300 + i, 50)) for i in range(8)]
    rows += [(50 + i, text(400 + i, 120)) for i in range(8)]
    out = {r.doc_id: r for r in substring.substring_dedup(frame(spark, rows, False)).collect()}
    assert out[0].text == rows[0][1]
    for i in range(1, 8):
        left = sum(w in out[i].text.split() for w in passage.split())
        assert passage not in out[i].text and left < 30 and out[i].dedup_n_words_removed > 25
        s = "".join(c for k, c in enumerate(rows[i][1]) if not any(a <= k < b for a, b in out[i].dedup_spans))
        assert s.strip() == out[i].text.strip()
        assert text(200 + i, 80)[:300] in out[i].text and text(300 + i, 50)[-200:] in out[i].text
    assert all(out[50 + i].text == rows[8 + i][1] for i in range(8))


def test_chunks_that_came_before_apart_stay(spark):
    clean = text(60, 80)
    w, rows = clean.split(), []
    raw, off = common.buffers(common.texts_of(__import__("pyarrow").array([clean])))
    for k, (a, b) in enumerate(zip(*substring.cuts_of(raw, off)[:2], strict=True)):  # each chunk in a text of its own, with 4 words about it
        i, j = len(clean[:a].split()), len(clean[:b].split())
        assert j - max(0, i - 4) < 16
        rows.append((k, f"{text(500 + k, 30)} {' '.join(w[max(0, i - 4) : j + 4])} {text(600 + k, 30)}"))
    rows += [(900, clean), (901, text(61, 30) + " " + clean)]
    out = {r.doc_id: r for r in substring.substring_dedup(frame(spark, rows, False)).collect()}
    assert out[900].text == clean and out[900].dedup_spans == []
    assert out[901].dedup_n_words_removed >= 70


def test_chunks_tile_and_resist_shifts():
    def chunks(t):
        raw, off = common.buffers(common.texts_of(__import__("pyarrow").array([t])))
        s, e, _ = substring.cuts_of(raw, off)
        return [bytes(raw[a:b]).decode() for a, b in zip(s, e, strict=True)]

    t = text(5, 400)
    a, b = chunks(t), chunks("some words before " + t[:900] + " an insertion " + t[900:])
    assert "".join(a) == t and len(set(a) - set(b)) <= 6
    assert chunks("") == [] and "".join(chunks("日本語" * 300)) == "日本語" * 300


def test_substring_odd_rows(spark):
    out = substring.substring_dedup(frame(spark, ODD))
    assert out.columns[:6] == ["doc_id", "text", "component_id", "node", "source", "n"]
    assert sorted(((r.doc_id, r.text is None) for r in out.collect()), key=str) == sorted(((d, t is None) for d, t in ODD), key=str)
    assert substring.substring_dedup(empty(spark)).count() == 0


# ------------------------------------------------------------------ 2


def test_html(spark):
    page = ("<header><nav>a</nav></header><article><h1>T&amp;C</h1><p>A  b&nbsp;<b>c</b>d<br>e<p>short</article><section id=comments><p>I say</p></section>"
            "<div class='sidebar'>side bar</div><form>mail</form><script>x='</p>'</script><!-- <p>no</p> --><footer>foot</footer>")
    rows = [(1, "u", page), (2, None, None), (None, "v", ""), (3, "w", "<p"), (4, "x", "<article>" + "<p>z z" * 3000), (4, "x", "<div title='a>b")]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'q' AS text")).collect()
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in out}
    assert got[1, "u"] == ("T&C A b cd e short", 18)
    assert got[2, None] == ("", 0) and got[None, "v"] == ("", 0) and len(out) == 6
    assert all(html_text._says(html_text.fit(spark), x) == (y > 0.5) for x, y in html_text.labelled())


def test_html_custom_elements_and_empty_drawings_hide_nothing():
    for tag in ("<svg-icon></svg-icon>", "<video-js id=v></video-js>", "<button-x>", "<title-card />", "<svg/>", "<svg class='i' viewBox=\"0 0 1 1\" />", "<math/>", "<svg><path d='M0'/></svg>"):
        page = f"<article><p>one</p>{tag}<p>two</p></article>"
        assert [t for t, _ in html_text.blocks(page)] == ["one", "two"], tag
    assert [t for t, _ in html_text.blocks("<p>a</p><svg a='/'><text>no</text></svg><button type=x>no</button><p>b</p>")] == ["a", "b"]


def test_html_articles_of_the_table(spark):
    import html

    pages = pq.read_table(f"{SF}/pages.parquet").to_pandas().set_index("page_id")
    for r in html_text.op2_html_extraction(spark, SF).collect():
        h = pages.html[r.page_id]
        inner = h[h.index("<article>") + 9 : h.index("</article>")]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"<(?:/?p|/?h1|br)>", inner))
        assert r.text == " ".join(x for x in parts if x)


# ------------------------------------------------------------------ 3


def test_embeddings_recall(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 16))
    x[100:180] = x[0] + 0.05 * rng.standard_normal((80, 16))
    x[200:220] = x[5]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, []), (904, [1.0, None]), (None, x[5].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS node", "2 AS n")
    got = {r.vec_id: r for r in embeddings.near_vectors(df, window=32).collect()}  # the crowd is larger than a window
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.95
    copies = {5, *range(200, 220)}  # the null id is one more copy of 5
    for i in range(400):
        assert got[i].n_links == near[i].sum() - 1 + (i in copies)
        assert got[i].component_id == min(np.flatnonzero(near[i]))
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(900, 905))
    assert got[None].component_id is None and got[None].n_links == 21 and not got[None].kept
    assert embeddings.near_vectors(df.where("vec_id < 0")).count() == 0


def test_embeddings_recall_in_a_crowded_topic(spark):
    rng = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x, axis=1)[:, None]
    x = unit(rng.standard_normal((4500, 32)))
    x[:1500] = unit(np.sqrt(0.8) * x[-1] + np.sqrt(0.2) * x[:1500])  # a third about one topic
    near = rng.standard_normal((600, 32))
    near = unit(near - (near * x[:600]).sum(1, keepdims=True) * x[:600])
    x[600:1200] = 0.96 * x[:600] + 0.28 * near
    want = ((x @ x.T) >= 0.95).sum(1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embeddings.near_vectors(df, window=12).collect()}
    assert want.sum() >= 1200 and sum(got.values()) >= 0.99 * want.sum()
    assert all(got[i] <= want[i] for i in got)


# ------------------------------------------------------------------ 4


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "a</s>\\"), (1, 1, "user", "<\\s>[AND]"), (1, 2, None, None), (1, 3, "tool[SAYS]", "x[/ROLE]\n"), (1, 3, "tool[SAYS]", "x[/ROLE]\n"),
            (2, None, "assistant", ""), (2, 0, "assistant", "[REPLY]\n"), (2, 1, "user", "[\\\\AND]"), (2, 2, "assistant", "é" * 3000), (None, 1, "system", "<</s>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'m' AS mask", "0 AS turns")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}
    for c in (1, 2, None):
        want = [(r[2], r[3] or "") for r in rows if r[0] == c]
        assert [tuple(t) for t in got[c].turns] == want
        assert got[c].loss_texts == [t for role, t in want if role == "assistant"]
    assert chat.format_chats(df.where("conv_id > 5")).count() == 0


def test_chat_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    df = chat.op4_chat_formatting(spark, SF)
    want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({chat.oracle_sql()})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


# ------------------------------------------------------------------ 5


def test_fingerprints(spark):
    rows = [(i * 3, text(i, 20 + 15 * i)) for i in range(40)] + [(7, None), (8, ""), (10, "short"), (11, text(39, 605)), (None, "x y z")]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = {r.doc_id: r for r in fingerprint.fingerprints(frame(spark, rows), rows_each=6).collect()}
    assert len(got) == len(rows)
    for (d, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True):
        t, nxt = t or "", nxt or ""
        k = len(t) // 4
        edited = t[: len(t) - k] + nxt[:k]
        assert (got[d].n_chars, got[d].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[d].near_next <= 1 and (len(t) < 200 or 0.5 < got[d].near_edited <= 1 and got[d].near_next < 0.3)
    assert got[117].fingerprint == got[11].fingerprint and got[7].fingerprint == got[8].fingerprint
    assert fingerprint.fingerprints(empty(spark)).count() == 0


def test_fingerprints_of_texts_without_white_space(spark):
    rng = np.random.default_rng(8)
    signs = lambda n: "".join(map(chr, 0x4E00 + rng.integers(0, 3000, n)))
    base, other = signs(600), signs(600)
    alike = base[:20] + other[20:]  # begins like base
    late = signs(12) + base[12:]  # differs in its first 36 bytes
    mixed = "some words first " + base
    rank = fingerprint.rarity(frame(spark, [(1, base), (2, other), (3, late)]))
    b, a, n, m, o = fingerprint.chains([base, alike, late, mixed, "some words first " + other], rank)
    assert fingerprint.likeness(b, a) < 0.3 and fingerprint.likeness(b, n) > 0.8
    assert fingerprint.likeness(b, m) > 0.8 and fingerprint.likeness(m, o) < 0.3


# ------------------------------------------------------------------ 6


def brute_targets(sizes, weights=(5, 2, 1), percent=150, most=2):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()) * percent / 100, set(names), {}
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            out |= share
            break
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def test_mixing(spark):
    rng = np.random.default_rng(2)
    rows = [(i, text(i, int(rng.integers(1, 200))), [None, "b", "a", "é", "Z", "hot", "hot", "hot"][i % 8]) for i in range(3000)] + [(9000, None, "none"), (9001, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS target", "'x' AS s")
    out = mixing.mix(mixing.sized(df, 7)).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    taken = {}
    for r in out:
        assert r.mix_source_size == sizes[r.source] and abs(r.mix_target - want[r.source]) < 1e-6 * (1 + want[r.source])
        assert 0 <= r.mix_copies <= 2
        taken[r.source] = taken.get(r.source, 0) + r.mix_copies * r.mix_size
    assert len(out) == len(rows) and all(abs(taken[s] - want[s]) <= 0.05 * want[s] + 400 for s in sizes)
    again = mixing.mix(mixing.sized(df.repartition(7), 7)).collect()
    assert sorted((r.doc_id, r.mix_copies) for r in out) == sorted((r.doc_id, r.mix_copies) for r in again)
    assert mixing.mixed_rows(df).count() == sum(r.mix_copies for r in out)
    assert mixing.mixed_rows(df.where("doc_id < 0")).count() == 0


# ------------------------------------------------------------------ 8, 9


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_ids_equal_the_library(name):
    import pyarrow as pa

    path = tokens.tokenizer_path(name)
    t = Tokenizer.from_file(path)
    texts = [x for _, x in ODD] + ["don't I'LL  3.14\t\tq", "x<|endoftext|>y \n\n z", "ΑΣ ΑΣ. é áb", "a, b.c! 'tis", *pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()]
    got = [ids.tolist() for _, _, flat, n in tokens.token_ids(common.texts_of(pa.array(texts)), path) for ids in np.split(flat, np.cumsum(n)[:-1])]
    assert got == [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_packing_places_every_id_once(spark):
    docs = table(spark, "documents").select("doc_id", "text").union(frame(spark, [(1000 + i, t) for i, (_, t) in enumerate(ODD)], False))
    rows = {r.doc_id: r.text for r in docs.collect()}
    out = packing.pack(docs).toPandas()
    t = Tokenizer.from_file(tokens.tokenizer_path("byte_bpe_50k.json"))
    for d, g in out.groupby("doc_id"):
        g = g.sort_values("start")
        ids = np.concatenate([np.array(x) for x in g.ids])
        assert ids.tolist() == t.encode(rows[d] or "", add_special_tokens=False).ids + [0]
        assert (g.start.values == np.cumsum(g.length) - g.length).all() and (g.doc_tokens == len(ids)).all()
        assert all(zlib.crc32(np.array(x, "<u4").tobytes()) == k for x, k in zip(g.ids, g.ids_crc32, strict=True))
    assert set(out.doc_id) == set(rows)
    short = 0
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        n, length = int(g.length.sum()), int(g.sequence_length.iloc[0])
        assert (g.offset.values == np.cumsum(g.length) - g.length).all() and n <= length <= 1024
        assert length == 1024 or length & (length - 1) == 0 and n > length // 2
        short += n < length
    assert short <= docs.rdd.getNumPartitions()
    assert packing.pack(empty(spark)).count() == 0


def test_packing_routes_remainders_to_sequences_of_several_lengths(spark):
    rows = [(i, text(i, int(n))) for i, n in enumerate([*np.random.default_rng(3).integers(1, 400, 400), *np.random.default_rng(4).integers(1, 50, 900)])]
    out = packing.pack(frame(spark, rows).coalesce(1)).toPandas()
    last = out.sequence_id.max()
    seqs = out[out.sequence_id != last].groupby("sequence_id").agg(length=("sequence_length", "first"), used=("length", "sum"), longest=("length", "max"), step=("step_group", "first"))
    assert set(seqs.length) == {256, 512, 1024} and (seqs.used == seqs.length).all()
    assert (seqs.longest[seqs.length == 512] > 256).all() and (seqs.longest[seqs.length == 1024] > 512).all()
    assert set(out.tier) == {256, 512, 1024}
    each = seqs.groupby(["step", "length"]).size().unstack(fill_value=0)
    assert len(each) > 3 and (each.max() - each.min() <= 2).all()


def test_token_files(spark):
    docs = frame(spark, ODD + [(100 + i, text(i, 300)) for i in range(60)])
    files = tokenfile.write_tokens(docs, common.new_dir(spark, "test"), rows_each=9)
    out = tokenfile.read_tokens(spark, files).collect()
    t = Tokenizer.from_file(tokens.tokenizer_path("word_bpe_49k.json"))
    want = sorted(((d, x) for d, x in ((r.doc_id, r.text) for r in docs.collect())), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at = 0
    for (d, x), r in zip(want, sorted(out, key=lambda r: r.start), strict=True):
        ids = t.encode(x or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert tokenfile.read_tokens(spark, tokenfile.write_tokens(empty(spark), common.new_dir(spark, "test"))).count() == 0


def test_token_file_reads_only_what_is_asked_and_checks_it():
    path = tempfile.mkdtemp(prefix="llm-tok-") + "/a.tok"
    w = tokenfile.Writer(path, 2, frame=100)
    docs = [np.arange(n, dtype=np.uint32) for n in (30, 0, 500, 7, 90)]
    for i, d in enumerate(docs):
        w.add(i, d)
    w.close()
    r = tokenfile.Reader(path)
    assert r.document(3).tolist() == docs[3].tolist() and r.frames_read == 1
    assert all(r.document(i).tolist() == d.tolist() for i, d in enumerate(docs))
    raw = bytearray(open(path, "rb").read())
    import zstandard

    assert zstandard.ZstdDecompressor().stream_reader(bytes(raw), read_across_frames=True).read()  # a plain reader takes it
    raw[int(r.start[2]) + 12] ^= 255
    open(path, "wb").write(raw)
    with pytest.raises(Exception):
        tokenfile.Reader(path).document(2)


# ------------------------------------------------------------------ 10


def test_quality_held_out(spark):
    labels = {r.doc_id: r.quality for r in table(spark, "labels").collect()}
    out = quality.op10_quality_classifier(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in common.read_table(spark, "/root/testdata/sf0.01", "labels").collect()}
    held = [r for r in out if r.held_out and r.doc_id in labels]
    assert len(out) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.classify(frame(spark, ODD), labels).collect()
    assert len(out) == len(ODD) and all(r.score == 1.0 for r in out)  # one label only: its share
    assert quality.classify(empty(spark), labels.where("doc_id < 0")).count() == 0


# ------------------------------------------------------------------ 2: wrappers, unclosed elements, linked blocks


@pytest.mark.parametrize("page,want", [
    ("<div class='layout has-sidebar'><article><p>{long}</p></article><div class=sidebar><p>{more}</p></div></div>", "{long}"),
    ("<div class='page with-sidebar'><div class='content'><p>{long}</p></div></div>", "{long}"),
    ("<form id=aspnetForm><article><p>{long}</p></article><div>Search <input></div></form>", "{long}"),
    ("<article><p>{long}</p><button>x<p>{more}</p></article>", "{long} x {more}"),
    ("<article><p>{long}</p><video src=a><p>{more}</p></article>", "{long} {more}"),
    ("<article><p>{long}</p><button>Share</button><p>{more}</p></article>", "{long} {more}"),
])
def test_articles_in_wrappers_stay(spark, page, want):
    words = {"long": html_text._LONG, "more": html_text._MORE}
    pages = spark.createDataFrame([(1, "u", page.format(**words))], "page_id long, url string, html string")
    assert html_text.extract(pages).first().text == want.format(**words)


def test_blocks_inside_a_link_are_linked():
    got = html_text.blocks("<a href=1><h3>Teaser</h3><p>All of it</p></a><p>Free</p>")
    assert [b["links"] for _, b in got] == [1.0, 1.0, 0.0]
    assert [b["links"] for _, b in html_text.blocks("<p>a <a href=1>b c</p><p>Free</p>")][1] == 0.0

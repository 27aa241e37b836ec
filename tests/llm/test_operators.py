"""The training-data operators against brute force, round trips and held-out labels."""

import itertools
import os
import random
import re
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from basketry.llm import bpe, chat, decontam, extract, language, near, passages, quality, topk, urls
from basketry.llm.queries import RULES, VOCABULARY

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, id string, sig string, ids string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(ws):
    return {tuple(ws[j : j + 5]) for j in range(max(1, len(ws) - 4))} if ws else set()


def similar(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies of all degrees, shared passages, nulls, empty, short and long texts."""
    rnd = random.Random(4)
    new = lambda n: [f"w{rnd.randrange(5000)}" for _ in range(n)]
    texts = [None, "", " \n\t", "one", "one", "one two", " ".join(new(4000))]
    for _ in range(5):
        base = new(150)
        for _ in range(12):
            copy = list(base)
            for _ in range(rnd.randrange(8)):
                copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(9999)}"
            texts.append(" ".join(copy))
        texts += [" ".join(base), " ".join(base).upper()]
    passage = new(60)
    texts += [" ".join(new(40) + passage + new(70)) for _ in range(6)]
    return [(i, t, "en", "x", None, "y") for i, t in enumerate(texts)]


def test_near_duplicates_are_those_of_brute_force(spark, corpus):
    got = {r.doc_id: r for r in near.near_duplicates(spark.createDataFrame(corpus, DOCS)).collect()}
    sets = {i: shingles(words(t)) for i, t, *_ in corpus}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if similar(sets[a], sets[b]):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), find(i), find(i) == i) for i in sets
    }


def test_near_duplicates_of_repeated_and_nameless_rows(spark):
    text = "a b c d e f g"
    df = spark.createDataFrame([(5, text), (5, text), (None, text), (7, text), (5, "q r s t u v")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in near.near_duplicates(df).collect())
    assert got == [(-1, None, True), (5, 5, True), (5, 5, True), (5, 5, True), (7, 5, False)]
    assert near.near_duplicates(df.limit(0)).count() == 0


def test_pruning_keeps_what_it_promises():
    for n in (32, 64, 96, 128):
        m = near.least_matches(n, 0.75, 1e-4)
        assert 0 < m < 0.75 * n


def test_repeated_passages_cover_brute_force(spark, corpus):
    docs = spark.createDataFrame(corpus, DOCS)
    found = passages.repeated_passages(docs)
    rows = found.collect()
    ws = {i: words(t) for i, t, *_ in corpus}
    seen, want = {}, {}
    for i in sorted(ws):
        for j in range(len(ws[i]) - 49):
            if seen.setdefault(tuple(ws[i][j : j + 50]), i) < i:
                want.setdefault(i, set()).update(range(j, j + 50))
    got = {}
    for r in rows:
        a = ws[r.doc_id][r.first_word : r.first_word + r.n_words]
        b = ws[r.kept_doc_id][r.kept_first_word : r.kept_first_word + r.kept_n_words]
        assert r.kept_doc_id < r.doc_id and len(a) >= 50 and similar(shingles(a), shingles(b))
        got.setdefault(r.doc_id, set()).update(range(r.first_word, r.first_word + r.n_words))
    # A passage that a document shares with the hub of its min-hashes is always found. Of near
    # copies with many changes, a stretch shared with another document only may be missed.
    planted = {i for i, t, *_ in corpus[-6:]} | {i for i in ws if any(ws[i] == ws[k] for k in range(i))}
    assert all(want[i] <= got[i] for i in planted if i in want)
    assert sum(len(places & got.get(i, set())) for i, places in want.items()) >= 0.9 * sum(map(len, want.values()))
    cut = passages.without_passages(docs, spark.createDataFrame(rows, found.schema)).collect()
    assert len(cut) == len(corpus)
    for r in cut:
        assert words(r.text) == [w for k, w in enumerate(ws[r.doc_id]) if k not in got.get(r.doc_id, ())]
    assert passages.repeated_passages(docs.limit(0)).count() == 0


def test_passages_that_the_smallest_document_holds_in_part(spark):
    """Partial quotes and edited copies: what later documents share with each other only."""
    rnd = random.Random(14)
    new = lambda n: [f"w{rnd.randrange(50000)}" for _ in range(n)]
    texts = []
    for quotes in ([slice(0, 40), slice(20, 60)], [slice(0, 45)], [slice(0, 49)], []):
        for _ in range(6):
            passage = new(60)
            texts += [new(40) + passage[q] + new(40) for q in quotes]
            texts += [new(40) + passage + new(40) for _ in range(3)]
    for _ in range(8):
        base = new(120)
        for _ in range(6):
            copy = list(base)
            for k in rnd.sample(range(120), 2):
                copy[k] = new(1)[0]
            texts.append(new(40) + copy + new(40))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for block in (512, 2):
        got = {}
        for r in passages.repeated_passages(docs, settings=passages.PassageSettings(block=block)).collect():
            a = texts[r.doc_id][r.first_word : r.first_word + r.n_words]
            b = texts[r.kept_doc_id][r.kept_first_word : r.kept_first_word + r.kept_n_words]
            assert r.kept_doc_id < r.doc_id and len(a) >= 50 and similar(shingles(a), shingles(b))
            got.setdefault(r.doc_id, set()).update(range(r.first_word, r.first_word + r.n_words))
        seen = set()
        for i, t in enumerate(texts):
            own = [tuple(t[j : j + 50]) for j in range(len(t) - 49)]
            want = {p for j, x in enumerate(own) if x in seen for p in range(j, j + 50)}
            assert want <= got.get(i, set())
            seen.update(own)


def test_leaks_are_those_of_brute_force(spark):
    rnd = random.Random(6)
    items = [(k, " ".join(f"b{rnd.randrange(900)}" for _ in range(n))) for k, n in enumerate([3, 8, 15, 21, 30, 57])] + [(9, None), (10, "")]
    texts = [None, "", "x y"]
    for k, item in items[:6]:
        own = item.split()
        for spoil in (0, 1, 4):
            copy = list(own)
            for _ in range(spoil):
                copy[rnd.randrange(len(copy))] = "zz"
            texts.append(" ".join([f"c{rnd.randrange(99)}" for _ in range(37)] + copy + ["tail"] * 9))
    docs = spark.createDataFrame([(i, t, "en", "x", None, "y") for i, t in enumerate(texts)], DOCS)
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set()
    for (i, t), (k, item) in itertools.product(enumerate(texts), items[:6]):
        w, own = words(t), words(item)
        for j in range(1 - len(own), len(w)):
            part = w[max(j, 0) : j + len(own)]
            if similar(shingles(part), shingles(own)):
                want.add((i, k))
    assert got == want and len(got) >= 6


def test_leaks_with_replaced_words(spark):
    """Copies close to the threshold, as blocks or single words, in items of all lengths."""
    rnd = random.Random(16)
    bag = lambda ws: Counter(tuple(ws[j : j + 5]) for j in range(max(1, len(ws) - 4))) if ws else Counter()

    def similarity(a, b):
        both = sum((a & b).values())
        return both / max(sum(a.values()) + sum(b.values()) - both, 1)

    items = [[f"b{rnd.randrange(9999)}" * rnd.choice([1, 1, 1, 6]) for _ in range(n)] for n in (40, 60, 80, 120, 200, 400)]
    items += [["x", "y", "z"] * 17, ["one", "two"], ["solo"]]
    docs = [["y", "z", "x"] * 15 + ["q"] + ["x", "y", "z"] * 16, ["a", "one", "two"], ["solo"], items[2][9:], items[3][:-12]]
    for item in items[:6]:
        for row in (1, 2, 4, 8, 16, 24, 48):
            for _ in range(2):
                copy, at = list(item), rnd.randrange(len(item))
                copy[at : at + row] = [f"r{rnd.randrange(9999)}" for _ in copy[at : at + row]]
                docs.append([f"c{rnd.randrange(99)}" for _ in range(30)] + copy + ["tail"] * 30)
        for changes in (1, 2, 3, 5, 9):
            copy = list(item)
            for at in rnd.sample(range(len(item)), changes):
                copy[at] = "replaced" * 3
            docs.append(["c"] * 7 + copy + ["tail"] * 30)
    rows = decontam.leaks(
        spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(docs)], "doc_id long, text string"),
        spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string"),
    ).collect()
    got = {(r.doc_id, r.item_id): (r.similarity, r.first_word, r.n_words) for r in rows}
    want = {}
    for (i, w), (k, own) in itertools.product(enumerate(docs), enumerate(items)):
        if not set(w) & set(own):
            continue
        bags = [(bag(w[max(j, 0) : max(j + len(own), 0)]), j) for j in range(1 - len(own), len(w))]
        most, j = max((similarity(b, bag(own)), -max(j, 0)) for b, j in bags)
        if most >= 0.75:
            places = [(s, -max(j, 0), min(j + len(own), len(w)) - max(j, 0)) for b, j in bags if (s := similarity(b, bag(own))) == most]
            s, first, n = max(places)
            want[i, k] = (s, -first, n)
    assert got == want and len(want) > 30


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    rnd = random.Random(8)
    parts = ["a", "b", " ", "  ", "\n", "é", "ß", "1", "😀", "<|endoftext|>", "the", "ing", "----", "\t", "\x00", "aaaa", "'s", ".", "=" * 7]
    texts = [None, "", "a" * 70_000] + ["".join(rnd.choices(parts, k=rnd.randrange(14))) for _ in range(400)]
    docs = spark.createDataFrame([(i, t, "en", "x", None, "y") for i, t in enumerate(texts)], DOCS)
    one = bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY).collect()
    both = bpe.round_trip(docs, VOCABULARY).collect()
    for rows in (one, both):
        for r in rows:
            ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
            assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)


def test_html_parts(spark):
    page = (
        "<html><body><header>Site</header><div class='cookie-notice'>We use the cookies of the site and it is for you.</div>"
        "<article><h1>A &amp; B</h1><p>This is\n the <b>text</b><br>of it.<p>Short.</article>"
        "<section class=comments><article><p>I think that this is the best of the comments.</p></article></section>"
        "<form><p>name</p></form><aside>more</aside><script>var t='</p>'</script><footer>x &copy; y</footer>"
    )
    rows = [(0, page, "t"), (1, None, None), (2, "", None), (3, "<p>" + "word " * 30_000, None)]
    got = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(rows, "page_id long, html string, text string")).collect()}
    assert got[0] == "A & B\nThis is the text of it.\nShort." and got[1] == got[2] == ""
    assert len(got[3].split()) == 30_000


def test_article_of_every_page():
    import pyarrow.parquet as pq
    from html import unescape

    for html in pq.read_table(f"{DATA}/pages.parquet").column("html").to_pylist():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
        assert extract.main_text(html) == "\n".join(t for t in (" ".join(unescape(p).split()) for p in parts) if t)


def test_url_rules(spark):
    rows = [
        ("http://A.NET/x?q", "a.net", "/x", "net/", "block"),
        ("x://b.example.net/en/1#f", "b.example.net", "/en/1", "example.net/en/", "allow"),
        ("https://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
        ("https://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        ("https://c.net", "c.net", "", None, "allow"),
        ("no address", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    df = spark.createDataFrame([(i, r[0], "z") for i, r in enumerate(rows)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df, RULES).collect()}
    assert got == {i: r[1:] for i, r in enumerate(rows)}


def test_url_templates_of_blocked_labels(spark):
    rows = [(f"http://h.org/a/{i}", True) for i in range(40)] + [(f"http://h.org/b/{i}", False) for i in range(40)]
    df = spark.createDataFrame([*rows, ("http://h.org/a/999", None), ("http://h.org/b/999", None)], "url string, bad boolean")
    got = {r.url: r.verdict for r in urls.judge(df, (), blocked="bad").collect()}
    assert got["http://h.org/a/999"] == "block" and got["http://h.org/b/999"] == "allow"


def test_chat_masks_are_what_the_speaker_says(spark):
    rows = [(1, t, f"r{t % 3}", f"said {t}<|im_end|>") for t in range(200)]
    rows += [(1, 0, "system", "be kind"), (2, None, None, None), (2, 3, "ann", "hi"), (2, 3, "ann", "hi"), (None, 1, "bob", "ho"), (4, 0, "system", "x")]
    out = chat.perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(r.conv_id, r.speaker) for r in out} == {(1, "r0"), (1, "r1"), (1, "r2"), (2, "unknown"), (2, "ann"), (None, "bob")}
    assert all(r.n_messages <= 64 and r.text.count("<|im_end|>") == r.n_messages for r in out if r.conv_id == 1)
    for who in range(3):
        pieces = sorted((r.part, r.piece, r) for r in out if r.conv_id == 1 and r.speaker == f"r{who}")
        own = [r.text[s.start : s.stop] for _, _, r in pieces for s in r.mask]
        assert own == [f"said {t}< |im_end|><|im_end|>" for t in range(200) if t % 3 == who]


def test_language_uses_all_evidence(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    profiles = language.fit(docs)
    assert set(profiles.languages) == {"de", "en", "es", "fr"}
    pages = spark.read.parquet(f"{DATA}/pages.parquet").withColumn("lang", F.lit("x"))
    got = language.identify(pages, profiles).collect()
    right = [r.lang == re.search(r"/(\w\w)/", r.url)[1] for r in got]
    assert len(got) == pages.count() and sum(right) >= 0.97 * len(right)
    odd = spark.createDataFrame([(1, None, None), (2, "http://a.org", '<html lang="DE-at"><p>'), (3, "x", "")], "page_id long, url string, html string")
    assert [r.lang is not None for r in language.identify(odd, profiles).collect()] == [True] * 3
    none = language.fit(docs.limit(0))
    assert {r.lang for r in language.identify(odd, none).collect()} == {None}


def test_stretches_lie_where_enough_functions_agree():
    """Windows are cut to what windows of another function cover; lone ones and short rests go."""
    import pyarrow as pa

    windows = [(8, 0, 99, 50), (17, 40, 159, 60), (10, 200, 299, 250), (16, 120, 159, 130), (24, 10, 70, 5)]
    members = [[{"v": v, "lo": lo, "hi": hi, "at": at, "first": 3} for v, lo, hi, at in windows], [{"v": 8, "lo": 0, "hi": 99, "at": 9, "first": 3}]]
    cover = pa.array([[], []], pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64())])))
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array(members), cover], ["id", "members", "cover"])
    got = next(passages._stretches(passages.PassageSettings())([batch])).to_pylist()
    assert [(r["v"], r["id"], r["lo"], r["hi"], r["outside"]) for r in got] == [(8, 7, 40, 99, True), (17, 7, 40, 99, True)]


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumnRenamed("doc_id", "id")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    stored = quality.features(docs.select("id", "text"))
    scored = quality.score_features(stored, quality.fit_on(stored, labels))
    rows = scored.join(labels, scored.id == labels.doc_id).filter(quality.held_out(F.col("id"))).collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.97
    odd = quality.features(spark.createDataFrame([(1, None), (2, ""), (3, "w " * 50_000)], "id long, text string"))
    assert all(0 <= r.score <= 1 for r in quality.score_features(odd, quality.fit_on(stored, labels.limit(0))).collect())


def test_top_k_is_exact(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(8)]) for i in range(300)]
    rows += [(400, rows[0][1]), (450, rows[0][1]), (500, None), (550, [None] * 8), (600, [float("nan")] * 8), (650, [1e10] * 8), (None, rows[1][1]), (700, [0.5, 0.5]), (701, [0.1, 0.2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    small = topk.TopSettings(rows=64, queries=2)
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_inner_products(df, settings=small).collect()]
    ints = {i: [int(256 * x // 1) for x in v] for i, v in rows if i is not None and v and None not in v and v[0] == v[0]}
    want = []
    for q, v in ints.items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ints.items() if i != q and len(w) == len(v))
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:5])]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("scale", [1, 2**30])
def test_top_k_of_many_queries_at_once(scale):
    """Bounds of a whole tile of queries, ties, own ids, and scores beyond exact doubles."""
    rnd = np.random.default_rng(5)
    values = rnd.integers(-9, 9, (500, 6)) * scale
    ids = rnd.permutation(500)
    queries = np.concatenate([values[:149], np.zeros((1, 6), np.int64)])
    own = np.concatenate([ids[:149], [-1]])
    got = list(topk.SortedLists(ids, values).top(queries, own, topk.TopSettings()))
    for q, i, (best, scores) in zip(queries, own, got, strict=True):
        all_scores = sorted((-int(s), int(j)) for j, s in zip(ids, values @ q) if j != i)[:5]
        assert [(-int(s), int(j)) for j, s in zip(best, scores)] == all_scores
    few = topk.SortedLists(ids[:3], values[:3])
    assert [best.size for best, _ in few.top(queries[:4], own[:4], topk.TopSettings())] == [2, 2, 2, 3]


@pytest.mark.parametrize("name", ["op1_chat_perspectives", "op10_top_k"])
def test_query_matches_sql(spark, name):
    import duckdb

    from basketry.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    for table in ("conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want, key=str)


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, DATA)
    rows = out.collect()
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    assert 0 < len(rows) < spark.read.parquet(f"{DATA}/documents.parquet").count()


def test_documents_that_share_less_than_a_passage(spark):
    rnd = random.Random(8)
    shared = [f"s{i}" for i in range(49)]
    texts = [" ".join([f"a{rnd.randrange(9999)}" for _ in range(60)] + shared) for _ in range(6)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = passages.repeated_passages(docs.coalesce(1))
    assert all(r.n_words < 66 for r in found.collect())
    assert [r.text for r in passages.without_passages(docs, found.filter("false")).orderBy("doc_id").collect()] == texts


def test_near_duplicates_of_rows_that_share_an_id(spark):
    """Both texts of document 1 keep their links, in whatever order the rows come."""
    rnd = random.Random(12)
    a, b = ([f"{c}{rnd.randrange(9000)}" for _ in range(80)] for c in "ab")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join([*a[:-1], "x"])), (3, " ".join([*b[:-1], "y"])), (4, "one two")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        got = sorted((r.doc_id, r.component_id) for r in near.near_duplicates(docs).collect())
        assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]


def test_templates_without_labels_are_judged_by_other_hosts(spark):
    rows = [(i, f"https://a{i % 5}.net/promo/{i}") for i in range(50)] + [(100 + i, f"https://shop.com/promo/{i}") for i in range(5)]
    rows += [(200 + i, f"https://w{i % 4}.org/fr/story") for i in range(40)] + [(300 + i, "https://shop.com/fr/story") for i in range(3)]
    rows += [(400, "https://shop.com/unseen"), (401, None)]
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), RULES).collect()}
    assert {got[i] for i in range(50)} == {("net/", "block")}
    assert {got[100 + i] for i in range(5)} == {(None, "block")}
    assert {got[300 + i] for i in range(3)} == {(None, "allow")} and got[400] == got[401] == (None, "allow")


def test_very_long_benchmark_items(spark):
    rnd = random.Random(2)
    long = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(20_000))
    docs = spark.createDataFrame([(1, "x " + long + " y"), (2, "nothing of it"), (3, long[:1000])], "doc_id long, text string")
    items = spark.createDataFrame([(7, long), (8, long[:1000]), (9, long)], "item_id long, text string")
    found = decontam.leaks(docs, items, settings=decontam.LeakSettings(block_bytes=20_000))
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(1, 7), (1, 8), (1, 9), (3, 8)]

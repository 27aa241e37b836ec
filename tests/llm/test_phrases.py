"""Collocations against a count of every phrase, word by word."""

import random
import re
from collections import Counter

import duckdb
import pytest

from basketry.llm import phrases
from basketry.llm.queries import ORACLES, QUERIES
from basketry.llm.phrases import PhraseSettings

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, a int"


def brute(rows, settings):
    counts, total = {}, Counter()
    for _, text, lang, *_ in rows:
        f = counts.setdefault(lang or "und", Counter())
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for size in range(1, settings.longest + 1):
                f.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        n, rows = total[lang], []
        for p, a in f.items():
            if len(p) < 2 or a < settings.least:
                continue
            longer = [q for q in f if len(q) > len(p) and f[q] >= settings.least and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * f[q] >= settings.replaced * a for q in longer):
                continue
            cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], k))
        for rank, (score, a, p, left, right, k) in enumerate(sorted(rows)[: settings.top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score, k))
    return sorted(out)


def found(spark, rows, settings, parts=3):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(map(tuple, phrases.collocations(frame, settings=settings).collect()))


def corpus(seed):
    rnd = random.Random(seed)
    words = ["the", "THE", "of", "new", "york", "city", "aé", "Zürich", "x'", "1.5", "\x00", "　"]
    rows = []
    for i in range(300):
        parts = []
        for _ in range(rnd.randrange(0, 30)):
            parts.append(rnd.choice(["new york city hall", "one two three four five six", rnd.choice(words), rnd.choice(words)]))
            parts.append(rnd.choice([" ", " ", "  ", "\t", ", ", "\n", "! ", " . "]))
        rows.append((i, "".join(parts), rnd.choice(["en", "de", None, "und"]), "p", 3, 4))
    rows += [(i, t, g, None, None, None) for i, (t, g) in enumerate([(None, "en"), ("", None), (" \t", "fr"), (".,;", "en")])]
    rows += [(900, "buy " * 4000, "en", "p", 1, 1), (901, "long " + "w" * 5000 + " end", "en", "p", 1, 1)]
    return rows


@pytest.mark.parametrize("settings", [PhraseSettings(least=6), PhraseSettings(least=3, replaced=60, top=40), PhraseSettings(longest=3, least=5, bits=16)])
def test_collocations_are_those_of_a_full_count(spark, settings):
    rows = corpus(1)
    assert found(spark, rows, settings) == brute(rows, settings)


def test_a_full_bitmap_changes_nothing(spark):
    rows = corpus(2)
    assert found(spark, rows, PhraseSettings(least=4, bits=16)) == found(spark, rows, PhraseSettings(least=4, bits=3))


def test_phrases_with_one_hash_are_told_apart(spark, monkeypatch):
    rows = corpus(3)[:120]
    want = brute(rows, PhraseSettings(least=4))
    monkeypatch.setattr(phrases.W, "_PLACE", phrases.W._PLACE * 0)
    pieces = phrases.split(phrases.pa.array([t or "" for _, t, *_ in rows]))
    ids = phrases.np.unique(pieces.hash, return_inverse=True)[1]
    at = phrases.np.arange(ids.size - 1)
    _, counts = phrases._distinct(pieces, ids, at, 2, phrases.np.uint64(1))
    assert sorted(counts.tolist()) == sorted(Counter(zip(ids[:-1].tolist(), ids[1:].tolist())).values()) and want


def test_tables_without_phrases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert phrases.collocations(empty).isEmpty()
    rows = [(1, None, None, None, None, None), (2, "a b", "en", None, None, None)] * 2
    assert found(spark, rows, PhraseSettings()) == []


def test_query_matches_sql(spark):
    data = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    got = QUERIES["op13_collocations"](spark, data)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES['op13_collocations']})").fetchall()
    assert want and sorted(map(tuple, got.collect())) == sorted(want)

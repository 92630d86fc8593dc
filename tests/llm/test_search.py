"""Ranked search, nearest neighbours and collocations against brute force and SQL."""

import math
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from check_oracles import compare, duck
from conftest import SF001, SF01
from lakemart.llm import collocations, lexical, neighbours
from lakemart.llm.tables import table
from pyspark.sql import functions as F

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
LONG = " ".join(f"word{i % 7} x{i % 97}." for i in range(60_000))


@pytest.mark.parametrize("name", ["op11_lexical_search", "op13_collocations"])
def test_query_equals_its_sql(spark, name):
    r = compare(spark, duck(SF01), SF01, name, entry.queries()[name], entry.oracle_sql()[name])
    assert r["status"] == "ok", r


# ---- ranked search ----------------------------------------------------------------------

def brute_search(docs, items, k):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    rows = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    rows = [r for r in rows if r[2]]
    big_n, big_l, out = len(rows), sum(r[2] for r in rows), []
    for item, text in dict.fromkeys(items):
        found = []
        for i, count, n in rows:
            m, s = 100 - 75 + (75 * n * big_n) // big_l, 0
            for t in terms(text):
                if tf := count[t]:
                    df = sum(t in r[1] for r in rows)
                    s += math.floor(1000 * math.log((2 * big_n + 2) / (2 * df + 1))) * ((10 ** 9 * tf) // (1000 * tf + 8 * m))
            if s > 0:
                found.append((-s, i is not None, i))
        for r, x in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out.append((item, r, x[2], -x[0]))
    return sorted(out, key=str)


def collect(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "日本語", "x-y", "A1"]
    some = [" ".join(rng.choice(words, rng.integers(1, 40))) for _ in range(300)]
    return [*enumerate(some), (5, some[9]), (301, some[9]), (302, some[9]), (None, some[9]), (303, None), (304, ""), (305, " -- "),
            (306, LONG), (307, LONG), (308, "w1 " * 50)]


def test_lexical_search_equals_brute_force(spark, texts):
    docs = spark.createDataFrame([(i, t, "s", 1, "x") for i, t in texts], "doc_id bigint, text string, term string, n int, `item.id` string")
    items = [(1, "W1 w2 w2 ünï"), (2, None), (3, "-"), (4, "absent"), (5, "word1 x3 w1"), (6, "x y a1 日本語"), (6, "w7"), (1, "W1 w2 w2 ünï"),
             (7, " ".join(f"w{i}" for i in range(60)) + " " + " ".join(f"x{i}" for i in range(97))), (8, "w1 " * 20)]
    asked = spark.createDataFrame([(i, t, "q") for i, t in items], "item_id bigint, text string, score string")
    want = brute_search(texts, items, 10)
    assert collect(lexical.search(docs.repartition(5), asked)) == want
    assert collect(lexical.search(docs.repartition(3), asked, group_items=3, block_docs=16)) == want


def test_lexical_search_edges(spark, texts):
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in texts[:50]], "doc_id string, text string")
    items = spark.createDataFrame([("a", "w1 w2")], "item_id string, text string")
    got = lexical.search(docs, items, k=3).collect()
    assert [r["rank"] for r in sorted(got)] == [1, 2, 3] and got[0]["doc_id"].startswith("d")
    assert lexical.search(docs.limit(0), items).collect() == [] and lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(docs.select("doc_id", F.lit(None).cast("string").alias("text")), items).collect() == []


def test_masks_group_documents_by_their_lists():
    rng = np.random.default_rng(1)
    lists = [np.flatnonzero(rng.random(200) < 0.2) for _ in range(130)]
    some, group, bits = lexical.group_masks(lists, 200)
    for d, g in zip(some, group):
        assert [d in x for x in lists] == bits[g].astype(bool).tolist()
    assert len({tuple(b) for b in bits}) == len(bits)


# ---- nearest neighbours -----------------------------------------------------------------

def brute_nearest(ids, x, asked, k):
    n, out = np.sqrt((x * x).sum(1)), {}
    for i in asked:
        s = (x * x[i]).sum(1) / (n * n[i])
        others = [(-s[j], ids[j]) for j in range(len(ids)) if j != i]
        out[ids[i]] = sorted(others)[:k]
    return out


def recall(got, want):
    hits = total = 0
    for q, best in want.items():
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r for r, _, _ in mine] == list(range(1, len(best) + 1))
        assert all(a[2] > b[2] or a[2] == b[2] and a[1] < b[1] for a, b in zip(mine, mine[1:]))
        total += len(best)
        hits += len({i for _, i, _ in mine} & {i for _, i in best})
    return hits / total


@pytest.mark.parametrize("cell_rows", [2048, 64])
def test_nearest_recall_on_the_table(spark, cell_rows):
    v = table(spark, SF01, "embeddings")
    rows = v.orderBy("vec_id").collect()
    ids, x = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float)
    got = neighbours.nearest(v, F.col("vec_id") % 20 == 0, cell_rows=cell_rows).collect()
    want = brute_nearest(ids, x, [i for i, q in enumerate(ids) if q % 20 == 0], 5)
    assert recall(got, want) >= 0.9
    exact = {(q, i): -s for q, best in want.items() for s, i in best}
    assert all(abs(exact[r["query_id"], r["vec_id"]] - r["score"]) < 1e-12 for r in got if (r["query_id"], r["vec_id"]) in exact)


def test_nearest_with_copies_dense_places_and_bad_vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1200, 12))
    x[300:700] = x[10]                                             # a third are copies of one vector
    x[700:1000] = x[11] + 1e-3 * rng.standard_normal((300, 12))    # and a dense place
    rows = [(i, v.tolist(), "n") for i, v in enumerate(x)]
    bad = [(2000, None), (2020, []), (2040, [0.0] * 12), (2060, [float("nan")] + [1.0] * 11), (2080, [None] + [1.0] * 11),
           (2100, [float("inf")] + [1.0] * 11), (2120, [1.0] * 3), (None, [1.0] * 12)]
    v = spark.createDataFrame(rows + [(i, b, "n") for i, b in bad], "vec_id bigint, embedding array<double>, label string")
    v = v.withColumn("cell", F.lit(1)).withColumn("q", F.lit("x")).withColumn("a.b", F.lit(0))
    asked = [i for i in range(1200) if i % 20 == 0]
    want = brute_nearest(list(range(1200)), x, asked, 5)
    got = neighbours.nearest(v.repartition(4), F.col("vec_id") % 20 == 0, cell_rows=100, block_rows=64).collect()
    assert {r["query_id"] for r in got} == set(asked) and recall(got, want) >= 0.95
    full = neighbours.nearest(v, F.col("vec_id") % 20 == 0, confidence=1 - 1e-12, cell_rows=100).collect()
    copies = {q: [i for _, i in best] for q, best in want.items() if q == 10 or 300 <= q < 700}
    assert {q: [r["vec_id"] for r in sorted(full, key=lambda r: r["rank"]) if r["query_id"] == q] for q in copies} == copies
    assert recall(full, want) == 1


def test_nearest_small_tables(spark):
    v = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [1.0, 0.0]), (1, [1e200, 1e200])],
                              "vec_id bigint, embedding array<double>")
    got = collect(neighbours.nearest(v, F.col("vec_id") == 1).withColumn("score", F.round("score", 6)))
    assert got == [(1, 1, 0, 0.707107), (1, 2, 0, 0.707107), (1, 3, 0, 0.707107)]
    assert neighbours.nearest(v.limit(0), F.col("vec_id") == 1).collect() == []
    assert neighbours.nearest(v, F.col("vec_id") == 7).collect() == []
    text = neighbours.nearest(v.select(F.col("vec_id").cast("string"), "embedding"), F.col("vec_id") == "1", k=1).collect()
    assert text[0]["vec_id"] == "0"


def test_chi_square_of_the_stopping_test():
    # even degrees of freedom have a closed form
    for x in (0.5, 3.0, 15.5, 40.0):
        closed = 1 - math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(4))
        assert abs(neighbours.chi2_cdf(x, 8) - closed) < 1e-12
    assert abs(neighbours.chi2_quantile(0.95, 8) - 15.507) < 1e-3


# ---- collocations -----------------------------------------------------------------------

def brute_phrases(rows, support, inside, top):
    langs, out = {}, []
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            langs.setdefault(lang or "und", []).append(re.findall(r"[^\x20\x09]+", piece))
    for lang, pieces in langs.items():
        f = Counter(tuple(p[i:i + k]) for p in pieces for k in range(1, 5) for i in range(len(p) - k + 1))
        n = sum(c for w, c in f.items() if len(w) == 1)
        cands = {w: c for w, c in f.items() if len(w) > 1 and c >= support}
        ranked = []
        for w, a in cands.items():
            score, k = min((2_000_000 * a // (f[w[:k]] + f[w[k:]]), k) for k in range(1, len(w)))
            longer = [x for x in cands if len(x) > len(w) and any(x[i:i + len(w)] == w for i in range(len(x)))]
            if not any(100 * f[x] >= inside * a for x in longer):
                ranked.append((-score, -a, " ".join(w).encode(), f[w[:k]], f[w[k:]]))
        for r, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, r, p.decode(), -a, left, right, n, -s))
    return sorted(out, key=str)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_collocations_equal_brute_force(spark, shards):
    rng = np.random.default_rng(9)
    words = ["New", "york", "city", "Ünï", "日本", "a", "b'c", "d", "e\x0bf", "g h"]
    rows = [(str(rng.choice(["en", "de", "fr"], p=[.6, .3, .1])),
             " ".join(rng.choice(words, rng.integers(1, 30)))
             + rng.choice([".", ", new york city", "\tnew  york\n", "", "; one two three four"])) for _ in range(600)]
    rows += [(None, "same line here"), (None, None), ("und", ""), ("xx", " . ")] + [(None, "same line here.")] * 40
    docs = spark.createDataFrame([(i, t, la, "w") for i, (la, t) in enumerate(rows)], "doc_id int, text string, lang string, words string")
    docs = docs.withColumn("a.b", F.lit(1)).repartition(6)
    for support in (30, 4):
        got = collect(collocations.collocations(docs, support=support, shards=shards, top=40))
        assert got == brute_phrases(rows, support, 80, 40)


def test_collocations_edges(spark):
    docs = spark.createDataFrame([("en", LONG), ("en", LONG), ("de", "x")], "lang string, text string")
    got = collect(collocations.collocations(docs, top=5))
    assert got == brute_phrases([("en", LONG), ("en", LONG), ("de", "x")], 30, 80, 5)
    assert collocations.collocations(docs.limit(0)).collect() == []
    assert collocations.collocations(docs.select("lang", F.lit(None).cast("string").alias("text"))).collect() == []


def test_a_clash_of_hashes_keeps_words_apart(monkeypatch):
    texts = [b"ab cd ab, ef", b"gh"]
    plain = collocations.Chunk("en", texts)
    clash = collocations.Words

    class Weak(clash):
        def __init__(self, *a):
            super().__init__(*a)
            self.hash = self.hash & np.uint64(1)
    monkeypatch.setattr(collocations, "Words", Weak)
    weak = collocations.Chunk("en", texts)
    assert [weak.spelled[i].as_py() for i in weak.word] == [plain.spelled[i].as_py() for i in plain.word] == ["ab", "cd", "ab", "ef", "gh"]
    assert plain.start.tolist() == [True, False, False, True, True]

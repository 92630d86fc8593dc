"""Operators against brute force on small generated inputs, and the bounds they state."""

import hashlib
import itertools
import math
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import components, decontaminate, fingerprint, langid, licenses, mixing, near_dup, secrets, toxicity
from lakemart.llm import words as W
from lakemart.session import local_path, scratch_path

FILLER = [f"filler{i}" for i in range(400)]


def filler(rng, n):
    return " ".join(rng.choice(FILLER) for _ in range(n))


# ---- op4 --------------------------------------------------------------------------------

def notices(rng):
    """Texts with whole, cut, edited, neighbouring and repeated notices."""
    out = [(i, filler(rng, 40)) for i in range(5)]
    for i, (name, text) in enumerate(licenses.TEMPLATES.items()):
        ws = text.split()
        out.append((100 + i, f"{filler(rng, rng.randint(0, 30))} {text} {filler(rng, 20)}"))
        out.append((300 + i, f"{' '.join(ws[:max(3, int(len(ws) * rng.uniform(.5, .95)))])} {filler(rng, 9)}"))
        edited = [w if rng.random() > 0.04 else "xx" for w in ws]
        out.append((500 + i, " ".join(edited)))
        other = rng.choice(list(licenses.TEMPLATES.values()))
        out.append((700 + i, f"{text}\n{other}\n{text}"))
    return [*out, (None, "nothing here at all"), (None, licenses.TEMPLATES["MIT"]), (7, "clean"), (7, licenses.TEMPLATES["MIT"]),
            (8, None), (9, "")]


def test_license_scan_equals_its_sql_on_generated_notices(spark):
    rows = notices(random.Random(2))
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(licenses.oracle()).fetchall()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert sum(r.n_licenses > 0 for r in got) > 50
    null = sorted(r.licenses for r in got if r.doc_id is None)
    assert null == ["", "MIT"] and sorted(r.licenses for r in got if r.doc_id == 7) == ["", "MIT"]


# ---- op1, op5: bounded samples ----------------------------------------------------------

def test_language_sample_is_bounded_whatever_repeats(spark, monkeypatch):
    seen = []
    keep = langid.Model
    monkeypatch.setattr(langid, "Model", lambda langs, x, y: seen.append(len(y)) or keep(langs, x, y))
    one = spark.range(20_000).select(F.lit(1).alias("doc_id"), F.lit("the same text here").alias("text"), F.lit("en").alias("lang"))
    many = spark.range(3000).select("id", F.concat(F.lit("ein wort "), F.md5(F.col("id").cast("string"))), F.lit("de"))
    other = spark.range(20_000).select(F.lit(5).alias("i"), F.concat(F.lit("mot "), F.col("id").cast("string")), F.lit("fr"))
    model = langid.train(one.union(many).union(other), sample=300)
    assert sorted(model.langs) == ["de", "en", "fr"] and seen[0] <= 400


def test_short_texts_stay_in_bounded_pieces():
    sizes = [len(p) for _, p in langid.pieces(["abcde"] * 10_000)]
    assert max(sizes) <= langid.TEXTS and sum(sizes) == 10_000
    at = [s for s, _ in langid.pieces(["x" * 300_000, "y", "z" * 600_000] * 3)]
    assert at[0] == 0 and at == sorted(at)


def test_toxicity_sample_takes_one_text_of_an_id(spark, monkeypatch):
    seen = []
    keep = toxicity.Model
    monkeypatch.setattr(toxicity, "Model", lambda p, r, s, y: seen.append(len(y)) or keep(p, r, s, y))
    docs = spark.range(20_000).select(F.lit("a").alias("doc_id"), F.concat(F.lit("you idiot "), F.col("id").cast("string")).alias("text"))
    docs = docs.union(spark.range(40).select(F.concat(F.lit("n"), F.col("id").cast("string")), F.concat(F.lit("fine words "), F.col("id").cast("string"))))
    labels = spark.createDataFrame([("a", 1)] + [(f"n{i}", i % 2) for i in range(40)], "doc_id string, toxic int")
    toxicity.train(docs, labels)
    assert seen == [41]


# ---- op2 --------------------------------------------------------------------------------

def test_removal_of_spans_does_not_depend_on_the_size(spark):
    rng = random.Random(7)
    items = [(i, filler(rng, 25)) for i in range(30)] + [(99, "short one"), (98, None)]
    texts = []
    for i in range(60):
        part = rng.choice(items)[1] or ""
        ws = part.split()
        texts.append((i % 50, f"{filler(rng, 12)}, {' '.join(ws[:rng.randint(5, 25)])}! {filler(rng, 5)} Short. One"))
    texts += [(None, texts[0][1]), (3, None), (4, "")]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in texts], "doc_id bigint, text string, `a.b` int, row string").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    small = decontaminate.remove_spans(docs, bench)
    large = decontaminate.remove_spans(docs, bench, max_windows=0)
    assert small.columns == docs.columns
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))
    left = decontaminate.contamination(small, bench).where("contaminated")
    # what is left over are hits that a removal has joined; a second pass finds them
    assert left.count() < 5 and small.where("text is null").count() == 1
    a = decontaminate.contamination(docs, bench).drop("spans")
    b = decontaminate.contamination(docs, bench, max_windows=0).drop("spans")
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("a", "one two three four five six"), ("b", "one two three four five six"), ("c", None)],
                                 "doc_id string, text string")
    bench = spark.createDataFrame([("q", "two three")], "item_id string, text string")
    assert {r.doc_id: r.contaminated for r in decontaminate.contamination(docs, bench).collect()} == {"a": True, "b": True, "c": False}
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()} == {"a": "a", "b": "a", "c": "c"}
    assert {r.doc_id for r in toxicity.score_documents(docs, toxicity.LexiconModel()).collect()} == {"a", "b", "c"}
    assert {r.doc_id for r in mixing.mixture(docs.withColumn("source", F.lit("s"))).collect()} == {"a", "b", "c"}


# ---- op3 --------------------------------------------------------------------------------

def test_components_by_stars_equal_those_of_one_task(spark):
    rng = np.random.default_rng(4)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(1, 1), (None, 3), (7, 7)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(80)]
    df = spark.createDataFrame(links, "a bigint, b bigint").repartition(5)
    one = {r.node: r.component for r in components.components(df).collect()}
    assert one == {r.node: r.component for r in components.components(df, one_task=0).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    assert one == {x: find(x) for x in parent}
    assert components.components(df.limit(0)).collect() == []


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rng = random.Random(11)
    texts, base = [], [filler(rng, rng.randint(60, 90)).split() for _ in range(8)]
    for i in range(160):
        ws = list(base[i % 8])
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            ws[rng.randrange(len(ws))] = f"e{rng.randrange(10_000)}"
        texts.append((i, " ".join(ws)))
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(
        spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)).collect()}
    sets = {i: {tuple(t.split()[j:j + 4]) for j in range(len(t.split()) - 3)} for i, t in texts}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in sets}


# ---- op8 --------------------------------------------------------------------------------

def test_likeness_is_near_the_true_similarity():
    """Against the Jaccard similarity of the texts' 5-word shingles: 256 bins of 4 bits have
    a deviation of at most 0.034; texts of fewer shingles than bins repeat donors and vary more."""
    rng = random.Random(8)
    errors = defaultdict(list)
    for n in (60, 400, 3000):
        for share in (0.0, 0.1, 0.3, 0.6, 0.9, 1.0):
            common = filler(rng, int(n * share)).split()
            a, b = (common + [f"own{rng.random()}" for _ in range(n - len(common))] for _ in range(2))
            sets = [{tuple(x[i:i + 5]) for i in range(len(x) - 4)} for x in (a, b)]
            true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
            prints = fingerprint.fingerprints([" ".join(a), " ".join(b)])
            errors[n].append(abs(float(fingerprint.likeness(prints[:1], prints[1:])[0]) - true))
    assert np.mean(errors[3000]) < 0.034 and max(errors[3000]) < 0.11
    assert max(errors[400]) < 0.15 and max(errors[60]) < 0.3
    same = fingerprint.fingerprints(["one two three four five six"] * 2 + ["", " "])
    assert fingerprint.likeness(same[:1], same[1:2])[0] == 1.0 and fingerprint.likeness(same[2:3], same[3:])[0] == 1.0
    assert fingerprint.likeness(same[:1], same[2:3])[0] == 0.0


def test_densification_fills_every_empty_bin_from_a_full_one():
    low = np.full((3, fingerprint.BINS), fingerprint.EMPTY, np.uint64)
    low[0, 5], low[1, :200:3] = 77, np.arange(67)
    full = fingerprint.densify(low)
    assert (full[0] == 77).all() and (full[2] == fingerprint.EMPTY).all()
    kept = low[1] != fingerprint.EMPTY
    assert (full[1][kept] == low[1][kept]).all() and set(full[1]) <= set(low[1][kept])
    # the donor of a bin depends on its number and the full bins alone
    assert (fingerprint.densify(low[1:2])[0] == full[1]).all()


# ---- op9 --------------------------------------------------------------------------------

PATTERNS = {"assign": r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}


def base_spans(text):
    out = []
    for m in re.finditer(PATTERNS["assign"], text, re.I | re.A):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, m.end()))
    for k, least in (("access", 20), ("hex", 24)):
        out += [(m.start(), ("access", "hex").index(k) + 1, m.end()) for m in re.finditer(PATTERNS[k], text) if m.end() - m.start() >= least]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out)]


def secret_texts(rng, n):
    parts = ["password", "PASSWD", "api_key", "apikey", "toKen", "secret", " ", "  ", ":", "=", '"', "'", "AKIA", "eyJ", "-----BEGIN ",
             "RSA PRIVATE KEY-----", "ghp_", "xoxb-", "sk_live_", "é", "日", "\n", ".", "/", "K", "ſecret", "AKIA" + "Q7" * 9, "eyJaaaaaaaa.bbbbbbbb.cc_cccccc", "ghp_" + "aB3" * 12]
    alphabet = "abcdef0123456789ABCXYZ_-+/=."
    for i in range(n):
        yield "".join(rng.choice(parts) if rng.random() < .5 else "".join(rng.choice(alphabet) for _ in range(rng.choice([1, 5, 6, 16, 24, 40])))
                      for _ in range(rng.randint(0, 14)))


def test_secret_scan_equals_brute_force(spark):
    rng = random.Random(3)
    texts = list(secret_texts(rng, 800)) + [None, "", "token=" + "a" * 100_000]
    rows = [(i % 600 if i % 17 else None, t) for i, t in enumerate(texts)]
    got = secrets.scan_documents(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    want = sorted((repr(i), hashlib.sha256(",".join(base_spans(t or "")).encode()).hexdigest()) for i, t in rows)
    assert sorted((repr(r.doc_id), r.base_sha256) for r in got) == want
    for r in got:
        kinds = [s.split(":")[0] for s in r.spans.split(",") if s]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
    every = ",".join(r.spans for r in got)
    assert all(f"{k}:" in every for k in ("assign", "access", "hex", "jwt", "service_token"))


def test_every_added_kind_is_found_and_near_misses_are_not():
    assert [s.split(":")[0] for s in secrets.render(secrets.find_spans(
        "-----BEGIN RSA PRIVATE KEY----- ghp_" + "x" * 36 + " eyJ" + "a" * 8 + "." + "b" * 8 + "." + "c" * 8)).split(",")] == [
        "private_key", "service_token", "jwt"]
    for miss in ("-----BEGIN PUBLIC KEY-----", "ghp_" + "x" * 35, "eyJaaaaaaaa.bbbbbbbb", "AKIA" + "A" * 15, "g" * 40, "password: short"):
        assert secrets.find_spans(miss) == []


def test_a_ledger_without_success_marker_is_read(spark):
    path = scratch_path(spark, "t-ledger")
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        docs = spark.createDataFrame([(1, "token = abcdef99"), (2, "plain")], "doc_id bigint, text string")
        first = secrets.scan_documents(docs, path).collect()
        more = docs.union(spark.createDataFrame([(3, "token = abcdef99"), (4, "AKIA" + "Q" * 16)], docs.schema))
        second = secrets.scan_documents(more, path).collect()
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert {r.doc_id: r.n_assign for r in first} == {1: 1, 2: 0}
    assert {r.doc_id: (r.n_assign, r.n_access) for r in second} == {1: (1, 0), 2: (0, 0), 3: (1, 0), 4: (0, 1)}
    assert spark.read.parquet(path).count() == 3                 # one row a blob, nothing scanned twice


# ---- op10 -------------------------------------------------------------------------------

def test_mixture_equals_a_plan_made_in_python(spark):
    rng = random.Random(6)
    rows = [(i, filler(rng, rng.choice([1, 5, 40, 200])), rng.choice("aaaaaabbc")) for i in range(400)]
    rows += [(900, None, "a"), (901, "", "b"), (902, "x y", None), (902, "z", None), (None, "w v", "c"), (903, filler(rng, 20_000), "d")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, source string, `a.b` int").repartition(3)
    mix = mixing.Mixture()
    got = mixing.mixture(docs, mix).collect()
    assert len(got) == len(rows)
    tokens, weight = defaultdict(int), {}
    for r in got:
        tokens[r.source] += r.n_tokens
        weight[r.source] = r.weight
    total = sum(tokens.values())
    share = {s: t / total for s, t in tokens.items() if t}
    assert abs(sum(weight.values()) - 1) < 1e-9
    # one exponent for all sources
    known = [s for s in share if s is not None and 0 < share[s] < 1]
    powers = {round((math.log(weight[a]) - math.log(weight[b])) / (math.log(share[a]) - math.log(share[b])), 6)
              for a in known for b in known if share[a] > share[b]}
    assert len(powers) == 1 and 0 <= powers.pop() <= 1
    need = max(t / weight[s] for s, t in tokens.items() if t)
    for s in tokens:
        mine = sorted((r for r in got if r.source == s), key=lambda r: (r.block, r.place, r.doc_id is not None, r.doc_id or 0))
        budget = max(math.floor(weight[s] * need + 1e-6), tokens[s])
        rounds, rest, run = budget // tokens[s], budget % tokens[s], 0
        for place, group in itertools.groupby(mine, key=lambda r: (r.block, r.place, r.doc_id)):
            group = list(group)                     # rows that repeat an id share a place
            run += sum(r.n_tokens for r in group)
            assert {r.copies for r in group} == {rounds + (1 if rest and run <= rest else 0)}, (s, place)
    again = mixing.mixed(docs, mix)
    assert again.columns == docs.columns and again.count() == sum(r.copies for r in got)

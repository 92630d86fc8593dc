"""Repeated paragraphs against all pairs, and rows judged by their own text."""

import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from lakemart.llm import paragraphs as P

P80 = " ".join(f"shared{i}" for i in range(80))


def sentence(rng, n):
    return " ".join(f"v{rng.randrange(3000)}" for _ in range(n)) + "."


def brute_units(docs):
    """{doc: [(unit, words)]}, by the rule that the module states."""
    out = {}
    for i, text in docs:
        parts = [re.findall(r"[a-z0-9]+", s) for s in re.split(r"(?<=[.!?])\s+|\n", text.lower())]
        out[i] = [tuple(p) for p in parts if len(p) >= P.MIN_WORDS]
    return out


def brute_rows(docs, run_words):
    units = brute_units(docs)
    nodes = sorted({u for us in units.values() for u in us})
    parent = {u: u for u in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    sets = {u: {u[i:i + 5] for i in range(len(u) - 4)} for u in nodes if len(u) >= P.NEAR_WORDS}
    long = list(sets)
    for i, a in enumerate(long):
        for b in long[i + 1:]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    where = defaultdict(set)
    for i, us in units.items():
        for u in us:
            where[find(u)].add(i)
    rows = set()
    for i, us in units.items():
        run = []
        for n, u in [*enumerate(us), (None, None)]:
            if u is not None and len(where[find(u)]) > 1:
                run.append((n, u))
                continue
            if sum(len(x) for _, x in run) >= run_words:
                rows |= {(i, k, len(x), len(where[find(x)])) for k, x in run}
            run = []
    return rows


def test_units_equal_all_pairs(spark):
    rng = random.Random(5)
    pool = [sentence(rng, rng.randint(14, 30)) for _ in range(25)] + [sentence(rng, 6) for _ in range(6)]
    docs = []
    for i in range(200):
        parts = []
        for _ in range(rng.randint(2, 7)):
            s = rng.choice(pool) if rng.random() < .6 else sentence(rng, rng.randint(4, 30))
            ws = s.split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                ws[rng.randrange(len(ws) - 1)] = f"e{rng.randrange(10_000)}"
            parts.append(" ".join(ws))
        docs.append((i, rng.choice([" ", "\n"]).join(parts)))
    df = spark.createDataFrame(docs, "doc_id int, text string").repartition(4)
    want = brute_rows(docs, 30)
    got = [r for r in P.repeated_paragraphs(df).collect() if r.unit is not None]
    found = {(r.doc_id, r.unit, r.n_words, r.n_docs) for r in got}
    # runs are measured from the first to the last word, as in the brute force; nothing is missed
    assert len(want) > 100 and found == want
    keepers = defaultdict(list)
    for r in got:
        keepers[r.cluster_id].append(r.kept)
    assert all(sum(k) <= 1 for k in keepers.values())


def test_bands_find_pairs_of_the_similarity():
    rng = np.random.default_rng(2)
    hit = total = 0
    seeds = P.W.stream(404, P.BANDS * P.ROWS)
    for _ in range(300):
        a = [f"a{x}" for x in rng.integers(0, 10 ** 6, 60)]
        b = list(a)
        b[30] = "changed"                                    # 5 of 56 shingles differ: 51 / 61 = 0.836
        keys, _, _ = P._bands(P.Units([(" ".join(a) + ".\n" + " ".join(b)).encode()]), P.BANDS, P.ROWS, seeds)
        hit += (keys[:, 0] == keys[:, 1]).any()
        total += 1
    assert hit == total


def test_rows_of_one_id_and_of_none_are_judged_by_their_own_text(spark):
    rows = [(0, P80 + "."), (1, "a b c d e f g h. " + P80 + "."), (1, "hi there"), (None, "clean words of their own"),
            (None, "x y z. " + P80 + "."), (None, None), (1, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = P.repeated_paragraphs(docs).collect()
    assert sorted(map(str, (r.doc_id for r in got))) == ["0", "1", "None"] and {r.n_docs for r in got} == {3}
    left = sorted((str(r.doc_id), r.text or "") for r in P.without_repeats(docs).collect())
    # the null id sorts as 0 with its text's hash; one of the three occurrences stays
    assert ("1", "hi there") in left and ("None", "clean words of their own") in left
    assert sum(P80 in t for _, t in left) == 1 and len(left) == 7


def test_a_passage_shared_inside_one_id_is_found(spark):
    # no sentence ends: only the window search can find it
    own = [" ".join(f"{c}{i}" for i in range(40)) for c in "pqrs"]
    rows = [(5, f"{own[0]} {P80} {own[1]}"), (5, f"x {own[2]} {P80} {own[3]}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = P.repeated_paragraphs(docs).collect()
    assert sorted((r.doc_id, r.first_word, r.n_words, r.kept) for r in got) in (
        [(5, 40, 80, False), (5, 41, 80, True)], [(5, 40, 80, True), (5, 41, 80, False)])
    texts = spark.createDataFrame([("a", rows[0][1]), ("b", rows[1][1]), ("c", "c d")], "doc_id string, text string")
    assert sorted(r.doc_id for r in P.repeated_paragraphs(texts).collect()) == ["a", "b"]


def test_keys_that_two_holders_have_are_all_found(spark):
    rng = np.random.default_rng(3)
    key = rng.integers(0, 2 ** 63, 4000).astype(np.uint64) * np.uint64(2)
    holder = rng.integers(0, 2 ** 31, 4000).astype(np.uint32)
    packed = P.Packed(4)
    out = list(packed.add(np.concatenate((key, key[:500], key[500:900])), np.concatenate((holder, holder[:500] + np.uint32(1), holder[500:900]))))
    out += list(packed.flush())
    rows = [(p, k, c) for b in out for p, k, c in zip(*(b.column(i).to_pylist() for i in range(3)))]
    shared = P._shared_keys(spark.createDataFrame(rows, P.PACKED).repartition(3)).value
    assert P.has(shared, P.short(key[:500], 4)).all()
    assert P.has(shared, P.short(key[500:], 4)).mean() < 0.01      # by chance alone


def test_hot_key_is_two_entries_of_a_task():
    packed = P.Packed(4)
    out = list(packed.add(np.full(P.TASK_ENTRIES, 7, np.uint64), np.arange(P.TASK_ENTRIES).astype(np.uint32)))
    assert [len(b.column(1)[0].as_py()) for b in out] == [8]

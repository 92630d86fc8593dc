"""Cases in which an operator once did less than its whole job."""

import random

from lakemart.llm import paragraphs


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_paragraphs_find_every_shared_window_of_51_words(spark):
    rng = random.Random(5)

    def prose(n):
        return [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
    long, sixty, lines, short = prose(100), prose(60), "\n".join(["red green blue"] * 17), prose(50)
    third = prose(70)
    inside = sixty[:15] + [sixty[15].capitalize()] + sixty[16:40]
    pasted = " ".join(sixty[:14]) + f" {sixty[14]}. " + " ".join(sixty[15:39]) + f" {sixty[39]}. " + " ".join(sixty[40:])
    texts = {1: " ".join(prose(90) + long + prose(110)), 2: " ".join(prose(20) + long + prose(180)),
             3: " ".join(prose(7)) + " " + pasted + " " + " ".join(prose(9)), 4: " ".join(prose(11)) + " " + pasted + " " + " ".join(prose(5)) + ".",
             5: lines, 6: "Other start here. " + lines, 7: " ".join(prose(9) + short + prose(9)), 8: " ".join(short + prose(30)),
             9: " ".join(prose(4) + third + prose(3)), 10: " ".join(third[:60] + prose(9)), 11: " ".join(prose(8) + third[8:] + inside),
             12: " ".join(prose(200)), 13: "", 14: None}
    words = {i: (t or "").lower().replace(".", "").split() for i, t in texts.items()}
    where = {}
    for i, w in words.items():
        for j in range(len(w) - 50):
            where.setdefault(tuple(w[j:j + 51]), set()).add(i)
    want = {(i, q) for i, w in words.items() for j in range(len(w) - 50) if len(where[tuple(w[j:j + 51])]) > 1 for q in range(j, j + 51)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    rows = paragraphs.repeated_paragraphs(docs).collect()
    got = {(r.doc_id, q) for r in rows for q in range(r.first_word, r.first_word + r.n_words)}
    assert {i for i, _ in want} == {1, 2, 3, 4, 5, 6, 9, 10, 11}
    assert got >= want and {i for i, _ in got} == {i for i, _ in want}
    assert {p for p in got if p[0] in (1, 2, 9, 10, 11)} == {p for p in want if p[0] in (1, 2, 9, 10, 11)}
    assert {r.doc_id for r in rows if not r.kept} >= {2, 4, 6, 10, 11}
    left = {i: (r.text or "").lower().replace(".", "").split() for i, r in by_id(paragraphs.without_repeats(docs)).items()}
    once = [tuple(w[j:j + 51]) for w in left.values() for j in range(len(w) - 50)]
    assert len(set(once)) == len(once)
    assert set().union(*map(set, left.values())) == set().union(*map(set, words.values()))

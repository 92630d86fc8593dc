"""Training-data operators against brute force, round trips and held-out accuracy."""

import hashlib
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from check_oracles import compare, duck
from conftest import SF001
from lakemart.llm import decontaminate, fingerprint, langid, licenses, mixing, near_dup, paragraphs, secrets
from lakemart.llm import token_files, toxicity
from lakemart.llm.tables import fold, table
from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
PASSAGE = " ".join(f"passage{i} shared" for i in range(30)) + "."
TEXTS = [(1, None), (2, ""), (3, " \n "), (4, "One two three four five six seven eight nine ten eleven twelve."),
         (5, "One two three four five six seven eight nine ten eleven twelve."), (6, LONG), (7, LONG + " tail"),
         (8, "a b"), (8, "a b"), (None, "one word"), (9, "Own start here. " + PASSAGE), (10, "Other words again!\n" + PASSAGE + " End."),
         (11, "token = 'abcdef123' AKIA" + "Z" * 16 + " " + "0a" * 14 + " password: short"), (12, "日本語 ünïcode"),
         (13, "Released under the MIT License.")]
SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, n bigint, key string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i and i % 2 else None, None if i == 3 else f"s{(i or 0) % 3}", len(t or ""), "x", 7, "k") for i, t in TEXTS]
    return spark.createDataFrame(rows, SHAPE).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SHAPE)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


@pytest.mark.parametrize("name", ["op2_decontaminate", "op3_superminhash_dedup", "op4_license_scan"])
def test_query_equals_its_sql(spark, name):
    r = compare(spark, duck(SF001), SF001, name, entry.queries()[name], entry.oracle_sql()[name])
    assert r["status"] == "ok", r


def test_superminhash_estimates_jaccard_and_stops_early():
    a = np.unique(np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    doc = np.concatenate((np.zeros(1000, int), np.ones(900, int)))
    sig = near_dup.superminhash(doc, np.concatenate((a, a[:900])), 3, 252)
    assert abs((sig[0] == sig[1]).mean() - 0.9) < 0.08
    assert (sig[2] == np.iinfo(np.uint64).max).all() and int(sig[0].max() >> np.uint64(32)) < 8


def test_near_duplicates_edges(docs, none):
    got = by_id(near_dup.near_duplicates(docs))
    assert [got[i]["n_shingles"] for i in (1, 2, 3, 8)] == [0, 0, 0, 1]
    assert got[5]["component_id"] == 4 and got[7]["component_id"] == 6 and not got[7]["kept"]
    assert got[1]["kept"] and got[None]["component_id"] is None and got[None]["kept"]
    assert near_dup.near_duplicates(none).count() == 0


def test_decontamination_by_broadcast_and_by_join_agree(spark, docs, none):
    items = spark.createDataFrame([(1, "TWO three, four"), (2, "one two three four five six seven eight nine ten eleven"),
                                   (3, None), (4, "..."), (None, "passage0 shared")], "item_id bigint, text string")
    a = decontaminate.contamination(docs, items)
    b = decontaminate.contamination(docs, items, max_windows=0)
    key = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"]
    assert sorted(map(str, a.select(key).collect())) == sorted(map(str, b.select(key).collect()))
    got = by_id(a)
    assert got[4]["n_hit"] == 11 and got[4]["n_items"] == 2 and got[4]["spans"] == ["0:11"]
    assert got[4]["items_sha256"] == hashlib.sha256(b"1,2").hexdigest()
    assert got[1]["n_words"] == 0 and not got[1]["contaminated"]
    cut = by_id(decontaminate.remove_spans(docs, items))
    assert cut[4]["text"] == " twelve." and cut[1]["text"] is None and cut[4]["key"] == "k"
    assert decontaminate.contamination(none, items).count() == 0


def test_license_edges(docs, none):
    got = by_id(licenses.scan_licenses(docs))
    assert got[13]["licenses"] == "MIT" and got[13]["containment"] == 1.0 and got[1]["n_licenses"] == 0
    assert licenses.scan_licenses(none).count() == 0


def test_secret_ledger_is_incremental(spark, docs, none):
    from lakemart.session import scratch_path
    path = scratch_path(spark, "test-ledger")
    half = docs.where("doc_id <= 8")
    secrets.update_ledger(half, path, path_col="doc_id")
    before = spark.read.parquet(path).count()
    secrets.update_ledger(half, path, path_col="doc_id")
    assert spark.read.parquet(path).count() == before
    got = by_id(secrets.scan_documents(docs, path))
    r = got[11]
    assert (r["n_assign"], r["n_access"], r["n_hex"]) == (1, 1, 1)
    text = dict((i, t) for i, t in TEXTS)[11]
    m = re.search(r"token = 'abcdef123", text)
    assert r["spans"].startswith(f"assign:{m.start()}:{m.end()},access:{m.end() + 2}:{m.end() + 22},hex:")
    assert r["base_sha256"] == hashlib.sha256(r["spans"].encode()).hexdigest() and got[1]["spans"] == ""
    for bound in (0, 10 ** 6):
        secrets.update_ledger(docs, path, rules=f"r{bound}", path_col="doc_id", broadcast_rows=bound)
    n = {r["rules"]: r["count"] for r in spark.read.parquet(path).select("rules", "blob").distinct().groupBy("rules").count().collect()}
    assert n["r0"] == n["r1000000"] == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert secrets.scan_documents(none).count() == 0


def test_fingerprints_equal_brute_force(docs, none):
    rows = sorted(((i if i is not None else -1 << 63, t or "") for i, t in TEXTS), key=lambda r: (-r[0], r[1]))
    got = fingerprint.fingerprint_documents(docs).collect()
    want = []
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        n = len(t)
        edited = t[:n - n // 2] + nxt[:n // 2]
        a, b, c = (fingerprint.fingerprints([x]) for x in (t, edited, nxt))
        want.append((i, n, hashlib.sha256(edited.encode()).hexdigest(), fingerprint.packed(a)[0],
                     float(fingerprint.likeness(a, b)[0]), float(fingerprint.likeness(a, c)[0])))
    low = -1 << 63
    assert sorted(want) == sorted((r.doc_id if r.doc_id is not None else low, r.n_chars, r.edited_sha256, r.fingerprint,
                                   r.near_edited, r.near_next) for r in got)
    assert fingerprint.fingerprint_documents(none).count() == 0


def test_token_files_round_trip(docs, none):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(token_files.default_vocabulary())
    got = token_files.token_table(docs).collect()
    start = 0
    rows = sorted(((i if i is not None else -1, t or "") for i, t in TEXTS))
    want = []
    for i, t in rows:
        ids = plain.encode(t, add_special_tokens=False).ids + [0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert want == sorted((r.doc_id if r.doc_id is not None else -1, r.start, r.n_tokens, r.ids_crc32) for r in got)
    assert token_files.token_table(none).count() == 0
    data = bytearray(token_files.pack([1], [3], np.array([5, 6, 7], np.uint32)))
    data[-6] ^= 255
    with pytest.raises(ValueError):
        token_files.unpack(bytes(data))


def test_language_accuracy_and_edges(spark, docs, none):
    got = entry.queries()["op1_language_id"](spark, SF001).join(table(spark, SF001, "documents").select("doc_id", "lang"), "doc_id")
    assert got.where("held_out and lang_pred = lang").count() >= 0.95 * got.where("held_out").count()
    got = by_id(langid.identify(docs, fold("doc_id", 4) == 2))
    assert got[1]["lang_pred"] == got[3]["lang_pred"] == "und" and got[4]["lang_pred"] == "en"
    assert langid.identify(none, fold("doc_id", 4) == 2).count() == 0
    code = langid.codewords(9)
    assert min((code[i] != code[j]).sum() for i in range(9) for j in range(i)) >= 5


def test_toxicity_ranks_held_out_labels(spark, docs, none):
    r = (entry.queries()["op5_toxicity"](spark, SF001).join(table(spark, SF001, "labels"), "doc_id").select("toxic", "score").collect())
    bad, good = [x.score for x in r if x.toxic == 1], [x.score for x in r if x.toxic == 0]
    assert np.mean([[b > g for g in good] for b in bad]) > 0.85
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (5, None)], "doc_id bigint, toxic int")
    assert toxicity.toxicity(docs, labels, fold("doc_id", 3) == 1).where("score between 0 and 1").count() == len(TEXTS)
    assert toxicity.toxicity(none, labels, fold("doc_id", 3) == 1).count() == 0


def test_mixture_keeps_all_and_meets_budgets(spark, none):
    d = table(spark, SF001, "documents")
    rows = mixing.mixture(d).toPandas()
    assert (rows.copies >= 1).all() and len(rows) == d.count()
    small = mixing.mixture(d, mixing.Mixture(budget=20_000, block_tokens=2000)).toPandas()
    read = (small.n_tokens * small.copies).groupby(small.source).sum()
    budget = small.groupby("source").weight.first() * 20_000
    assert (read <= budget + 1).all() and abs(small.groupby("source").weight.first().sum() - 1) < 1e-9
    for _, g in small.sort_values(["block", "place", "doc_id"]).groupby("source"):
        assert (np.diff(g.copies) <= 0).all()          # the last round ends at one place of the permutation
    assert mixing.mixture(none).count() == 0 and mixing.mixed(none).count() == 0
    out = mixing.mixed(d, mixing.Mixture(budget=20_000, block_tokens=2000))
    assert out.columns == d.columns and out.count() == small.copies.sum()


def test_paragraphs_catch_passages_and_leave_clean_text(docs, none):
    got = paragraphs.repeated_paragraphs(docs).collect()
    assert {9, 10, 4, 6, 7} >= {r.doc_id for r in got} >= {9, 10, 6, 7}
    a, b = ([r for r in got if r.doc_id == i][0] for i in (9, 10))
    assert a.cluster_id == b.cluster_id and a.kept and not b.kept and b.n_words == 60
    cut = by_id(paragraphs.without_repeats(docs))
    assert cut[10]["text"] == "Other words again!\nEnd." and cut[9]["text"].endswith(PASSAGE) and cut[7]["text"] == ""
    assert paragraphs.repeated_paragraphs(none).count() == 0


def test_pipeline_decisions(spark):
    import corpus_pipeline
    from lakemart.llm.toxicity import train
    d = table(spark, SF001, "documents")
    out = corpus_pipeline.run(spark, SF001).toPandas()
    model = train(d, table(spark, SF001, "labels").where(fold("doc_id", 3) != 1))
    rows = [(r.doc_id, r.text) for r in d.collect()]
    rows = [r for r, s in zip(rows, model.scores([t for _, t in rows])) if s < 0.7]
    sets = {}
    for i, t in sorted(rows):
        w = t.lower().split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} or {tuple(w)}
    group = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((group[i], group[j]))
                group = {k: a if v == b else v for k, v in group.items()}
    known = decontaminate.WindowSet([(str(r.item_id), r.text) for r in table(spark, SF001, "benchmark").collect()])
    keep = [i for i, t in rows if group[i] == i and not list(known.hits(decontaminate.W.Words([t.encode()], decontaminate.W.BY_ALNUM)))]
    assert sorted(set(out.doc_id)) == sorted(keep)

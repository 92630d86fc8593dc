"""Property checks of column rules against plain-Python statements of the rule."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakemart.functions.order import balanced_part
from lakemart.functions.text import title_text, title_year
from lakemart.operators.labels import balanced_ranges


def test_balanced_part_equals_range_rule_on_a_grid(spark):
    rows = [(total, parts, rn) for total in range(1, 61) for parts in range(1, 9) for rn in range(1, total + 1)]
    df = spark.createDataFrame(rows, "total long, parts int, rn long")
    got = {}
    for parts in range(1, 9):
        sub = df.where(F.col("parts") == parts)
        for r in sub.select("total", "rn", balanced_part(F.col("rn"), F.col("total"), parts).alias("s")).collect():
            got[(r.total, parts, r.rn)] = r.s
    for total in range(1, 61):
        for parts in range(1, 9):
            for shard, (lo, hi) in enumerate(balanced_ranges(total, parts)):
                for rn in range(lo + 1, hi + 1):
                    assert got[(total, parts, rn)] == shard, (total, parts, rn)


def _title_rule(t: str):
    """The title rule in plain Python (1-based positions as in SQL)."""
    n, p = len(t), t.find(":") + 1
    sub = t[p: p + max(n - p - 7, 0)].strip() if p else ""
    base = t[: max(p - 1 if p else n - 6, 0)].strip()
    out = " ".join(x for x in (sub, base) if x)
    year_txt = t[max(n - 5, 0): max(n - 5, 0) + 4] if n >= 5 else None
    year = int(year_txt) if year_txt and year_txt.isdigit() else None
    return (out or None), year


words = st.text(alphabet="abcXYZ ", min_size=0, max_size=12)


@settings(max_examples=60, deadline=None)
@given(base=words, sub=st.one_of(st.none(), words), year=st.integers(1900, 2030),
       suffix=st.sampled_from(["year", "bad", "none"]))
def test_title_parser_matches_rule(spark, base, sub, year, suffix):
    t = base + (f": {sub}" if sub is not None else "")
    t += {"year": f" ({year})", "bad": " (n/a)", "none": ""}[suffix]
    if len(t) < 5:
        return
    r = spark.createDataFrame([(t,)], "t string").select(title_text("t").alias("a"), title_year("t").alias("y")).collect()[0]
    assert (r.a, r.y) == _title_rule(t), t


@settings(max_examples=10, deadline=None)
@given(labels=st.lists(st.one_of(st.none(), st.integers(0, 3)), min_size=1, max_size=60),
       ranges=st.integers(1, 9))
def test_index_within_equals_row_number(spark, labels, ranges):
    from pyspark.sql import Window
    from lakemart.functions.order import index_within
    df = spark.createDataFrame([(i, lab, f"k{(i * 7919) % 101:03d}") for i, lab in enumerate(labels)],
                               "id long, label int, k string")
    got = {r.id: (r.rn, r.n) for r in index_within(df, ["label"], ["k", "id"], "rn", ranges, size_col="n").collect()}
    w = Window.partitionBy("label").orderBy("k", "id")
    want = {r.id: (r.rn, r.n) for r in df.select("id", F.row_number().over(w).alias("rn"),
                                                 F.count(F.lit(1)).over(Window.partitionBy("label")).alias("n")).collect()}
    assert got == want


def _keywords_brute_force(docs, min_len=3, min_freq=10, k=3):
    import re
    from collections import Counter
    from lakemart.functions.fixed import STOPWORDS, TOKEN_SPLIT_STRICT
    stop = set(STOPWORDS)
    out = set()
    for doc_id, cat, txt in docs:
        toks = [t for t in re.split(TOKEN_SPLIT_STRICT, txt)
                if t not in stop and len(t) >= min_len and not re.fullmatch(r"\d+(\.\d+)?", t)]
        counts = [(t, c) for t, c in Counter(toks).items() if c >= min_freq]
        for t, c in sorted(counts, key=lambda x: (-x[1], x[0]))[:k]:
            out.add((doc_id, cat, t, c))
    return out


vocab = st.sampled_from(["spark", "Spark", "lake", "the", "and", "12", "3.5", "ab", "data,", "data",
                         "what?", "now!", "end.", "x:", "tok"])
seps = st.sampled_from([" ", ", ", ": ", "! ", "? ", ". ", "\n", ",", "  "])


@settings(max_examples=15, deadline=None)
@given(docs=st.lists(st.lists(st.tuples(vocab, seps), min_size=0, max_size=80), min_size=1, max_size=4))
def test_keywords_equal_brute_force(spark, docs):
    from lakemart.operators import text
    rows = [(i, "c", "".join(w + s for w, s in d)) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "ArticleID long, Category string, Text string")
    got = {(r.ArticleID, r.Category, r.Tag, r.Frequency) for r in text.keywords(df, min_freq=3).collect()}
    assert got == _keywords_brute_force(rows, min_freq=3)


ATTRS6 = ["intelligence", "strength", "speed", "durability", "power", "combat"]


def _roles_brute_force(members):
    """members: list of dicts with name + six attributes (one team)."""
    def best(rows, score):
        return min(rows, key=lambda r: (-score(r), r["name"]))["name"]
    leader = best(members, lambda r: r["intelligence"])
    rest = [r for r in members if r["name"] != leader]
    tank = best(rest, lambda r: r["strength"] + r["durability"]) if rest else None
    rest = [r for r in rest if r["name"] != tank]
    damage = best(rest, lambda r: r["speed"] + r["power"] + r["combat"]) if rest else None
    others = sorted(r["name"] for r in rest if r["name"] != damage)
    strongest = best(members, lambda r: sum(r[a] for a in ATTRS6))
    return leader, tank, damage, (others + [None, None])[0], (others + [None, None])[1], strongest


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), min_size=6, max_size=6), min_size=1, max_size=12))
def test_roles_equal_brute_force(spark, attrs):
    from lakemart.operators import roster
    rows = [dict(name=f"h{i:02d}", team=i // 5, **dict(zip(ATTRS6, a))) for i, a in enumerate(attrs)]
    df = spark.createDataFrame([tuple(r[c] for c in ["name", "team", *ATTRS6]) for r in rows],
                               "name string, team int, " + ", ".join(f"{a} int" for a in ATTRS6))
    got = {r.team: (r.leader, r.tank, r.damage, r.the_other_guy, r.the_other_guy2, r.strongest)
           for r in roster.assign_roles(df).dropDuplicates(["team"]).collect()}
    want = {t: _roles_brute_force([r for r in rows if r["team"] == t]) for t in {r["team"] for r in rows}}
    assert got == want


def _tournament_brute_force(teams, n, draw):
    """teams: {name: (speed, height, flights)}; draw: names in bracket-draw order."""
    size = max(len(draw) // n, 1)
    bracket = {name: min((i // size), n - 1) for i, name in enumerate(draw)}
    out, rnd, width = set(), 1, n
    while True:
        winners = {}
        for b in sorted(set(bracket.values())):
            members = sorted(t for t, x in bracket.items() if x == b)
            wins = {m: 0 for m in members}
            for i, a in enumerate(members):
                for c in members[i + 1:]:
                    sa, ha, fa = teams[a]
                    sc, hc, fc = teams[c]
                    pa = (sa > sc) + (ha > hc) + fa
                    pc = (sc > sa) + (hc > ha) + fc
                    wins[a if pa >= pc else c] += 1
            w = min(members, key=lambda m: (-wins[m], m))
            winners[b] = w
            out.add((rnd, b, w, wins[w]))
        if width <= 1:
            return out
        bracket = {w: b // 2 for b, w in winners.items()}
        width, rnd = (width + 1) // 2, rnd + 1


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 2)), min_size=1, max_size=12))
def test_tournament_equals_brute_force(spark, stats):
    import hashlib
    from lakemart.operators import tournament
    teams = {f"T{i:02d}": s for i, s in enumerate(stats)}
    df = spark.createDataFrame([(k, float(v[0]), float(v[1]), v[2]) for k, v in teams.items()],
                               "team_name string, top_average_speed double, top_average_height double, "
                               "flight_count int")
    draw = sorted(teams, key=lambda k: (hashlib.md5(f"5|{k}".encode()).hexdigest(), k))
    got = {(r["round"], r.bracket, r.winner, r.wins) for r in tournament.tournament(df, n=4, seed=5).collect()}
    assert got == _tournament_brute_force(teams, 4, draw)


def _grades_brute_force(mid, proj):
    names = {n for n, _ in mid} | {n for n, _ in proj}
    out = set()
    for n in names:
        m = min((g for k, g in mid if k == n), default=0.0)
        p = min((g for k, g in proj if k == n), default=0.0)
        out.add((n, m, p, (m + p) / 2.0, (m + p) / 2.0 >= 50.0))
    return out


grade_rows = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["A", "B", "C", "D"])),
                                st.integers(0, 100).map(float)), max_size=10)


@settings(max_examples=15, deadline=None)
@given(mid=grade_rows, proj=grade_rows)
def test_grade_report_equals_cogroup_brute_force(spark, mid, proj):
    from lakemart.operators import grades
    schema = "student string, grade double"
    got = {(r.student, r.midterm, r.project, r.avg_grade, r.passed) for r in
           grades.grade_report(spark.createDataFrame(mid, schema), spark.createDataFrame(proj, schema)).collect()}
    assert got == _grades_brute_force(mid, proj)


@settings(max_examples=12, deadline=None)
@given(pairs=st.lists(st.tuples(st.sampled_from(["a1", "a2", "b7", "c3", "d9"]),
                                st.sampled_from(["Drama", "Comedy", "Horror"])), min_size=1, max_size=25),
       parts=st.integers(1, 6))
def test_fetch_plan_equals_brute_force(spark, pairs, parts):
    from lakemart.operators import labels
    df = spark.createDataFrame(pairs, "imdb_id string, genre string")
    got = sorted(tuple(r) for r in labels.fetch_plan(labels.assign_shards(df, parts)).collect())
    ordered = sorted(pairs)
    want = []
    for shard, (lo, hi) in enumerate(labels.balanced_ranges(len(ordered), parts)):
        chunk = ordered[lo:hi]
        fetched, there = {}, set()      # a process fetches an id once and copies that file later
        for imdb, genre in chunk:
            target = f"images/{genre}/{imdb}.jpg"
            if imdb not in fetched:
                fetched[imdb] = target
                want.append((shard, imdb, genre, "fetch", target, None))
            elif target in there:
                want.append((shard, imdb, genre, "present", target, None))
            else:
                want.append((shard, imdb, genre, "copy", target, fetched[imdb]))
            there.add(target)
    assert sorted(map(str, got)) == sorted(map(str, want))


tag_rows = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 2),
                              st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))), max_size=25)


@settings(max_examples=15, deadline=None)
@given(rows=tag_rows)
def test_tag_lists_and_repeats_equal_brute_force(spark, rows):
    from collections import Counter
    from lakemart.operators import tags
    t = spark.createDataFrame(rows, "user_id int, movie_id int, tag string")
    got_lists = {(r.user_id, r.movie_id): r.tags for r in tags.tag_lists(t).collect()}
    want_lists = {}
    for u, m, g in rows:
        want_lists.setdefault((u, m), [])
        if g is not None:
            want_lists[(u, m)].append(g)
    assert got_lists == {k: sorted(v) for k, v in want_lists.items()}
    users = spark.createDataFrame([(0, "Ann", "Lee"), (1, "Bo", None)], "user_id int, first_name string, last_name string")
    movies = spark.createDataFrame([(0, "M0"), (2, "M2")], "movie_id int, title string")
    got = Counter(tuple(r) for r in tags.repeated_tags(t, users, movies).collect())
    names, titles = {0: "Ann Lee", 1: "Bo"}, {0: "M0", 2: "M2"}
    want = Counter()
    for (u, m, g), c in Counter(rows).items():
        if g is not None and c > 1 and u in names and m in titles:
            want[(u, names[u], m, titles[m])] += 1
    assert got == want


rating_rows = st.lists(st.tuples(st.integers(0, 5), st.integers(1, 5), st.integers(2003, 2017)), min_size=1,
                       max_size=40)


@settings(max_examples=15, deadline=None)
@given(rows=rating_rows, n=st.integers(1, 4))
def test_top_titles_equal_brute_force(spark, rows, n):
    import datetime as dt
    from lakemart.operators import facts
    titles = {0: "A", 1: "B", 2: "A", 3: "C", 4: "D", 5: "E"}          # movies 0 and 2 share a title
    r = spark.createDataFrame([(1, m, float(v), dt.datetime(y, 6, 1)) for m, v, y in rows],
                              "user_id int, movie_id int, rating double, created_at timestamp")
    mv = spark.createDataFrame(list(titles.items()), "movie_id int, title string")
    got = [(x.title, x.rating_sum, x.average_rating) for x in facts.top_titles(r, mv, 2005, 2015, 3.0, n).collect()]
    per = {}
    for m, v, y in rows:
        if 2005 <= y <= 2015:
            s, c = per.get(titles[m], (0.0, 0))
            per[titles[m]] = (s + v, c + 1)
    kept = [(t, s, s / c) for t, (s, c) in per.items() if s / c >= 3.0]
    top = sorted(kept, key=lambda x: (-x[1], x[0]))[:n]
    assert got == sorted(top, key=lambda x: (-x[2], x[0]))


entity = st.fixed_dictionaries({"id": st.integers(0, 999),
                                "name": st.one_of(st.none(), st.text(alphabet="ab C'", max_size=6))})


@settings(max_examples=25, deadline=None)
@given(cells=st.lists(st.lists(entity, max_size=4), min_size=1, max_size=5))
def test_repaired_python_literals_parse_like_python(spark, cells):
    import ast
    from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
    from lakemart.functions.nested import parse_array
    schema = ArrayType(StructType([StructField("id", IntegerType()), StructField("name", StringType())]))
    texts = [repr(c) for c in cells]                       # Python literal form, as in the source files
    # a name holding both quote kinds would need a backslash escape, which the
    # repair rule removes (whole cell lost, as the golden table shows); the
    # generated names hold only apostrophes, so every cell must survive
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: [tuple(e) for e in r.p] for r in df.select("i", parse_array("t", schema).alias("p")).collect()}
    want = {i: [(d["id"], d["name"]) for d in ast.literal_eval(t)] for i, t in enumerate(texts)}
    assert got == want


name_sets = st.lists(st.sets(st.sampled_from(list("abcdefg")), max_size=7), min_size=3, max_size=3)


@settings(max_examples=15, deadline=None)
@given(sets=name_sets)
def test_align_names_equals_set_union(spark, sets):
    from lakemart.operators import roster
    tables = [spark.createDataFrame([(n, i) for n in sorted(s)], "name string, v int") for i, s in enumerate(sets)]
    union = set().union(*sets)
    for i, aligned in enumerate(roster.align_names(*tables)):
        got = {r.name: r.v for r in aligned.collect()}
        assert got == {n: (i if n in sets[i] else None) for n in union}
        assert aligned.count() == len(union)

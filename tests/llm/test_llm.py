"""The llm operators against brute force, and their defined results on odd input."""

import itertools
import os
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scanloom.llm import boruvka, canonical, hamming_groups, history, mixing, packing, prose, sentences, terms, tokens

ZERO = "0" * 256


def hexed(n):
    return f"{n:0256x}"


def fp_rows(seed=3, n=30):
    """Bases, near copies at chosen distances, exact copies, many codes agreeing in most of the image, bad codes."""
    rng = random.Random(seed)
    shared = rng.getrandbits(1024)
    out = []
    for k in range(n):
        base = rng.getrandbits(1024)
        if k % 3 == 0:  # half of the image is the same in unrelated codes
            base = (shared >> 512 << 512) | (base & ((1 << 512) - 1))
        out.append(hexed(base))
        for d in rng.sample([0, 1, 5, 9, 10, 11, 12, 40], 4):
            c = base
            for p in rng.sample(range(1024), d):
                c ^= 1 << p
            out.append(hexed(c))
    out += [c.upper() for c in out[:5]] + [ZERO, ZERO, None, "", "ab", "z" * 256, out[0][:-1], out[0] + "0"]
    rng.shuffle(out)
    return [(i, f"s{i % 3}", f"r{i % 7}" if i % 11 else None, c, rng.choice([0, 0, 1, 2, 3, None]), "other") for i, c in enumerate(out)]


FP = "row_id bigint, source string, relpath string, fp_hex string, batch_no int, cid string"


def valid(c):
    return c is not None and len(c) == 256 and set(c.lower()) <= set("0123456789abcdef") and c != ZERO


def dist(a, b):
    return bin(int(a, 16) ^ int(b, 16)).count("1")


@pytest.fixture(scope="module")
def fp(spark):
    return spark.createDataFrame(fp_rows(), FP)


@pytest.mark.parametrize("hot", [1, 1000])
def test_near_rows_equal_all_pairs(spark, fp, hot, monkeypatch):
    monkeypatch.setattr(hamming_groups.near_codes, "__defaults__", ("cid", "code", hot))
    rows = [r for r in fp_rows() if valid(r[3])]
    want = {(a[0], b[0]) for a, b in itertools.combinations(rows, 2) if a[1:3] != b[1:3] and dist(a[3], b[3]) <= 10}
    got = hamming_groups.near_rows(fp, 10).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == want and want
    assert hamming_groups.near_rows(fp.limit(0), 10).count() == 0


def test_near_groups_equal_search(spark, fp):
    rows = [r for r in fp_rows() if valid(r[3])]
    group = {r[0]: r[0] for r in rows}
    links = Counter()
    for a, b in itertools.combinations(rows, 2):
        if dist(a[3], b[3]) <= 10:
            ga, gb = group[a[0]], group[b[0]]
            for k, v in group.items():
                if v == max(ga, gb):
                    group[k] = min(ga, gb)
    for a in rows:
        links[a[0]] = len({b[3].lower() for b in rows if dist(a[3], b[3]) <= 10}) - 1
    got = {r.row_id: (r.group_id, r.n_links) for r in hamming_groups.near_groups(fp, 10).collect()}
    assert got == {k: (v, links[k]) for k, v in group.items()}


def brute_cases(rows):
    cases, accepted = set(), []
    for batch in sorted({r[4] for r in rows if r[4] is not None}):
        mine = [r for r in rows if r[4] == batch and valid(r[3])]
        hit = {r[0] for r in mine if any(dist(r[3], a) <= 10 for a in accepted)}
        cases |= hit
        accepted += [r[3] for r in mine if r[0] not in hit]
    return cases


def test_batches_equal_one_by_one(spark, fp, tmp_path):
    rows = fp_rows()
    want = brute_cases(rows)
    assert {r.row_id for r in history.batch_cases(fp, "batch_no", 10).collect()} == want and want
    assert {r.row_id for r in history.batch_cases(fp, "batch_no", 10, hot=1).collect()} == want
    kept = history.History(spark, f"file://{tmp_path}/h", 10)
    got = set()
    for b in (0, 1, 2, 3):
        got |= {r.row_id for r in kept.check(fp.where(F.col("batch_no") == b), b).collect() if r.is_case}
    assert got == want
    again = {r.row_id for r in kept.check(fp.where("batch_no = 2"), 2).collect() if r.is_case}  # as after a failure
    assert again == {i for i in want if i in {r.row_id for r in fp.where("batch_no = 2").collect()}}
    assert kept.check(fp.limit(0), 4).count() == 0
    assert history.batch_cases(fp.limit(0), "batch_no", 10).count() == 0


def test_chains_of_batches(spark):
    """A row near a refused row only is accepted, and refuses later ones."""
    steps = [0]
    for k in range(5):
        steps.append(steps[-1] | (((1 << 8) - 1) << (8 * k)))
    base = (1 << 1023) | 1
    rows = [(i, "s", "r", hexed(base ^ (s << 4)), i, "") for i, s in enumerate(steps)]
    df = spark.createDataFrame(rows, FP)
    assert {r.row_id for r in history.batch_cases(df, "batch_no", 10).collect()} == brute_cases(rows) == {1, 3, 5}


def test_repeated_ids(spark):
    rows = [(1, "Ab-1", 0), (2, "ab1.h5", 1), (3, "ab1", 0), (4, "NA", 1), (5, None, 1), (6, "x", 1), (7, "X ", 1), (8, "x", None)]
    df = spark.createDataFrame(rows, "row_id bigint, anon_accession string, batch_no int")
    assert [r.row_id for r in history.repeated_ids(df, "batch_no", "row_id", "anon_accession").collect()] == [2]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 14)), st.integers(0, 14)), max_size=25))
def test_components_equal_search(spark, edges):
    near = {}
    for a, b in edges:
        if a is not None:
            near.setdefault(a, set()).add(b), near.setdefault(b, set()).add(a)
    want = {}
    for n in sorted(near):
        todo = [n] if n not in want else []
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = n
                todo += near[x]
    df = spark.createDataFrame(edges, "a int, b int")
    assert {r.node: r.component for r in boruvka.components(df).collect()} == want


def test_components_of_chain_and_star(spark):
    chain = spark.range(2000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(500).select(F.lit(10_000).cast("bigint").alias("a"), (F.col("id") + 20_000).alias("b"))
    assert {r.component for r in boruvka.components(chain.union(star)).select("component").distinct().collect()} == {0, 10_000}


def test_match_groups(spark):
    rows = [(" A", "./x//1.h5", "b", "y.h5"), ("B ", "y.h5", "a", "x/1.h5"), ("b", "./y.h5", "C", "z"), ("a", None, "b", "q"), (None, "n", "a", "m"), ("d", "self", "D", "self")]
    df = spark.createDataFrame(rows, "source_a string, file_a string, source_b string, file_b string")
    got = {tuple(r) for r in boruvka.match_groups(df).collect()}
    assert got == {("a", "x/1.h5", "a", "x/1.h5"), ("b", "y.h5", "a", "x/1.h5"), ("c", "z", "a", "x/1.h5"), ("d", "self", "d", "self")}
    assert boruvka.match_groups(df.limit(0)).count() == 0


def test_term_counts(spark):
    import re

    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(9000)] + ["Épreuve", "größe", "x1"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 9))) + "-" for _ in range(3000)] + ["A a_A", "A a_A", None, "", "  "] * 3 + ["hot hot"] * 900
    rows = [(t, rng.choice([None, 0, 1, 7])) for t in texts]
    df = spark.createDataFrame(rows, "t string, w int").withColumn("term", F.lit("clash"))
    n, occ, weight = Counter(), Counter(), Counter()
    for t, w in rows:
        found = re.findall(r"[^\W_]+", t.lower()) if t else []
        n.update(set(found)), occ.update(found)
        for x in found:
            weight[x] += w or 0
    got = {r.term: (r.n_rows, r.n_occurrences, r.weight) for r in terms.term_counts(df, "t", "w").collect()}
    assert got == {k: (n[k], occ[k], weight[k]) for k in n}
    marks = {r.term: r.mark for r in terms.marked_terms(df, "t", "w").collect()}
    assert marks["hot"] == "common" and marks["w1"] == ("rare" if n["w1"] < 3 or weight["w1"] < 20 else None)
    assert terms.term_counts(df.limit(0), "t", "w").count() == 0


VIEWS = [(1, "SAX_CINE", "short axis cine"), (2, "SAX_BASE", "short axis basal slice"), (6, "THREECH", "three chamber cine"), (7, "FOURCH", "four chamber cine"), (17, "QFLOW_PA", "pulmonary trunk flow"), (22, "T2STAR", "iron susceptibility map"), (37, "VEINS", "pulmonary venous return")]


def test_canonical_values(spark):
    cases = {
        "Short_axis_cine nav b03": 1, "CINE-SHORT/AXIS": 1, "Saxcine": 1, "sax base gated": 2, "short axis apical slice": 0, "3 chamber cine": 6, "4_Chamser_Cine": 7, "4-chaber-cine-3": 7, "#3": 0, "FOURCH.78": 7,
        "ThreeChamberCine": 6, "3ChmbrCine": 6, "pulm trunk flow": 17, "plmnrytrunkflow": 17, "iron sscptblty map": 22, "T2Star iso": 22, "pulmonary venous rteurn": 37, "chamber pressure log": 0, "83a08f00": 0,
    }
    rows = [(i, t, None) for i, t in enumerate(cases)] + [(100, "seq", "sax cine"), (101, None, " "), (102, "", None), (103, "noise", ""), (104, "x" * 20_000, None)]
    rows += [(200 + i, *r[1:]) for i, r in enumerate(rows[:3])]
    df = spark.createDataFrame(rows, "map_id bigint, a string, b string").withColumn("word", F.lit(1))
    views = spark.createDataFrame(VIEWS, "view_id bigint, view_code string, view_name string")
    got = {r.row_id: r.entry for r in canonical.mapped(df, "map_id", ("a", "b"), views, "view_id", ("view_name", "view_code")).collect()}
    want = dict(enumerate(cases.values())) | {100: 1, 103: 0, 104: 0} | {200 + i: list(cases.values())[i] for i in range(3)}
    assert got == want
    assert canonical.mapped(df.limit(0), "map_id", ("a", "b"), views, "view_id", ("view_name", "view_code")).count() == 0


def test_near_words_equal_brute_force(spark):
    rng = random.Random(2)
    known = ["short", "axis", "cine", "pulmonary", "susceptibility", "map", "basal", "two"]
    letters = "abcdefghijklmnopqrstuvwxyz"

    def edit(w):
        for _ in range(rng.randint(1, 3)):
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i + 1 :]]) or "q"
        return w

    free = sorted({edit(rng.choice(known)) for _ in range(300)} | set(known))

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        return row[-1]

    want = set()
    for w in free:
        d = {k: lev(w, k) for k in known}
        ok = {k: v for k, v in d.items() if v <= (2 if len(k) >= 6 else 1 if len(k) >= 4 else 0)}
        want |= {(w, k, v) for k, v in ok.items() if v == min(ok.values())} if w not in known else {(w, w, 0)}
    k = spark.createDataFrame([(x, False) for x in known], "ref string, single boolean")
    got = {tuple(r) for r in canonical.near_words(spark.createDataFrame([(w,) for w in free], "word string"), k).collect()}
    assert got == want


# -- packing and mixing ---------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 400), max_size=30))
def test_placements_fill_packs(histogram):
    placed = packing.place(histogram, 50)
    packs, seen = Counter(), Counter()
    for length, rank, n, first in placed:
        assert rank == seen[length]
        seen[length] += n
        for p in range(first, first + n):
            packs[p] += length
    assert seen == Counter(histogram) and all(v <= 50 for v in packs.values()) and sorted(packs) == list(range(len(packs)))
    total = sum(k * v for k, v in histogram.items())
    assert len(packs) <= 2 * max(1, -(-total // 50)) + 1


def test_packs(spark):
    rng = random.Random(8)
    sizes = [(i, rng.choice([0, 7, 7, 7, 100, 101, 250, rng.randint(1, 400)])) for i in range(3000)] + [(5000, 0), (5001, 100)]
    df = spark.createDataFrame(sizes, "doc_id bigint, tokens bigint").withColumn("salt", F.lit("clash"))
    rows = packing.packed(df, 100).collect()
    held = Counter()
    parts = {}
    for r in rows:
        if r.pack_id >= 0:
            held[r.pack_id] += r.n_tokens
        parts.setdefault(r.doc_id, []).append((r.part, r.start_token, r.n_tokens))
    assert max(held.values()) <= 100 and {r.fill for r in rows if r.pack_id >= 0} == {v / 100 for v in held.values()}
    for i, n in sizes:
        got = sorted(parts[i])
        assert sum(x for *_, x in got) == n and len(got) == max(1, -(-n // 100)) and all(s == p * 100 for p, s, _ in got)
    assert sum(held.values()) / (100 * len(held)) > 0.95
    assert packing.packed(df.limit(0), 100).count() == 0
    assert {r.pack_id for r in packing.packed(df.where("tokens = 0"), 100).collect()} == {-1}


def test_flight_keeps_totals():
    rng = random.Random(1)
    for count in (True, False):
        t = [float(rng.choice([1, 5, 5, 90, 4000])) for _ in range(500)]
        p = [rng.random() for _ in t]
        q = mixing.flight(t, p, random.Random(2), 0, count)
        assert sum(a * b for a, b in zip(t, q)) == pytest.approx(sum(a * b for a, b in zip(t, p)))
        if count:
            assert sum(q) == pytest.approx(sum(p))
        assert sum(0 < x < 1 for x in q) <= (2 if count else 1)
        assert set(mixing.landing(t, q, rng)) <= {0.0, 1.0}
    n = Counter()
    for s in range(400):  # every unit keeps its inclusion probability
        for i, x in enumerate(mixing.flight([1.0, 2.0, 3.0, 4.0, 5.0, 6.0], [0.5] * 6, random.Random(s), 0)):
            n[i] += x
    assert all(150 < n[i] < 250 for i in range(6))


def test_mixture_reaches_its_weights(spark):
    rng = random.Random(3)
    docs = [(i, rng.choice(["a"] * 6 + ["b"] * 3 + ["c", None, "untargeted"]), int(rng.paretovariate(1.2) * 50)) for i in range(4000)] + [(9000, "a", 0), (9001, "a", 0)]
    sizes = spark.createDataFrame(docs, "doc_id bigint, source string, tokens bigint").withColumn("rate", F.lit(3))
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.35, None), ("c", 0.25, 3), ("absent", 0.0, 2)], "source string, target_weight double, max_repeats int")
    draws = mixing.drawn(sizes.drop("rate"), targets)
    rows = draws.collect()
    assert len(rows) == len(docs)
    caps = {"a": 1, "b": 1, "c": 3}
    assert all(r.copies <= caps.get(r.source, 0) for r in rows) and all(r.copies == 0 for r in rows if not r.tokens)
    for r in mixing.shares(draws, targets).collect():
        assert r.reached_share == pytest.approx(r.target_weight, abs=2e-4)
    assert sorted((r.doc_id, r.copies) for r in mixing.drawn(sizes.drop("rate"), targets).collect()) == sorted((r.doc_id, r.copies) for r in rows)
    assert mixing.drawn(sizes.drop("rate").limit(0), targets).count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (4, "<|endoftext|> 日本語 " * 2000)], "doc_id bigint, text string").withColumn("tokens2", F.lit(1))
    got = {r.doc_id: r.tokens for r in tokens.counted(df, ("doc_id",)).collect()}
    enc = tokens.encoding(f"{tokens.TOKENIZERS}/{tokens.VOCABULARY}")
    assert got == {1: 2, 2: 0, 3: 0, 4: len(enc.encode_ordinary("<|endoftext|> 日本語 " * 2000))}
    assert enc.decode(enc.encode_ordinary("größe 日本 x\n\n  y")) == "größe 日本 x\n\n  y"


# -- sentences ------------------------------------------------------------------------------------------

PY = '''# Licence-Id: X-1
# Stop! iOS-style names are not read. The dial
# opens at 3 a.m. and ends.
import os

def f(a):
    """
    Sec. A.5 says why. See Fig. 4 for more. 50 of them go dense.
    """
    x = "No sentence. Here."  # It tracks the grid, etc.
    # y = call(a, 3)
    # return a + b
    return 'a # b'
'''
C = "/*\n * First one here. The file a.b.cfg is\n * read.\n */\nint f() {\n    // x = 1;\n    g(\"// no\");  // Wait... it may be late\n}\n"
MD = "# Title Here\n\nThe dial closes it. Why? Nobody knows which\ndial runs. \"Is it plain?\" asks the dial. (The dial is optional.)\n\n1. One item\n* The second. And more.\n\n```\nNot this. Nor this.\n```\n\nCopyright-Year: 2001\n\n設定を保存する。「保存する。」と表示する。終わり！\n"


def parts(spark, texts, langs=None):
    filler = [f"The dial closes every grid, etc. The grid opens at {i} a.m. The grid ends, i.e. it stops. See Fig. {i} and Sec. {i} for the dial. Runs of {i} a.m. and more. It is lost." for i in range(40)]
    rows = [(i, t, (langs or {}).get(i, "en")) for i, t in enumerate(texts)] + [(1000 + i, t, "en") for i, t in enumerate(filler)]
    rows += [(2000 + i, f"Ο πίνακας μένει. Ο κόμβος γράφει τον πίνακας, π.χ. {i},1. Ο δείκτης κρατά τον κόμβος. Ο κόμβος μένει.", "el") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("start", F.lit("clash"))
    out = {}
    for r in sentences.sentences(df).where("doc_id < 1000").orderBy("doc_id", "start_pos").collect():
        out.setdefault(r.doc_id, []).append(" ".join(texts[r.doc_id][r.start_pos : r.end_pos].split()))
    return out


def test_sentences_of_files(spark):
    got = parts(spark, [PY, C, MD, None, "", " \n", "﻿" + PY.replace("\n", "\r\n"), C])
    assert got[0] == [
        "Stop!", "iOS-style names are not read.", "The dial # opens at 3 a.m. and ends.", "Sec. A.5 says why.", "See Fig. 4 for more.", "50 of them go dense.", "It tracks the grid, etc.",
    ]
    assert got[1] == ["First one here.", "The file a.b.cfg is * read.", "Wait... it may be late"] == got[7]
    assert got[2] == [
        "The dial closes it.", "Why?", "Nobody knows which dial runs.", '"Is it plain?" asks the dial.', "(The dial is optional.)", "One item", "The second.", "And more.", "設定を保存する。", "「保存する。」と表示する。", "終わり！",
    ]
    assert got[6] == got[0] and not {3, 4, 5} & set(got)


def test_sentences_of_scripts(spark):
    texts = [
        "# T\n\nตารางอ่านระบบ ตารางล้างระบบทุก 37.5 วินาที ช่องใช้ cache เพื่อเรียงช่อง\n", "# T\n\n它提示“索引已读取。”为什么？请先保存……然后退出。\n", "# T\n\nΟ κόμβος γράφει, π.χ. 25,1. Ο δείκτης κρατά; Ναι.\n",
        "# T\n\n« Le tampon lit ! » Le flux part. ¿Qué? ¡Sí!\n", "# T\n\nसूची पढ़ता है। “खंड लिखता है।” क्या?\n",
    ]
    got = parts(spark, texts, {0: "th", 1: "zh", 2: "el", 3: "FR", 4: None})
    assert got[0] == ["ตารางอ่านระบบ", "ตารางล้างระบบทุก 37.5 วินาที", "ช่องใช้ cache เพื่อเรียงช่อง"]
    assert got[1] == ["它提示“索引已读取。”", "为什么？", "请先保存……然后退出。"]
    assert got[2] == ["Ο κόμβος γράφει, π.χ. 25,1.", "Ο δείκτης κρατά;", "Ναι."]
    assert got[3] == ["« Le tampon lit ! »", "Le flux part.", "¿Qué?", "¡Sí!"]
    assert got[4] == ["सूची पढ़ता है।", "“खंड लिखता है।”", "क्या?"]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab.!? \n#/*-`\"'()=;{}0。「」x", max_size=200))
def test_blocks_lie_in_the_text(text):
    for start, piece in prose.blocks(text):
        assert 0 <= start and start + len(piece) <= len(text)
        for i, c in enumerate(piece):
            assert c == text[start + i] or c == " "
        model = sentences.Model([])
        last = 0
        for a, b in sentences.split(piece, "en", model):
            assert last <= a < b <= len(piece) and not piece[a].isspace() and not piece[b - 1].isspace()
            last = b


def test_very_long_text(spark):
    text = "# T\n\n" + "The dial closes the grid. " * 20_000 + "\n" + "x" * 100_000
    assert len(parts(spark, [text])[0]) >= 20_000


# -- every query against its SQL --------------------------------------------------------------------------

DATA = "/root/testdata/sf0.001"


def _queries():
    from scanloom.llm import queries

    return queries


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(_queries().QUERIES))
def test_query_equals_sql(spark, name):
    from tests.compare import same_rows

    same_rows(_queries().QUERIES[name](spark, DATA), _queries().SQL.get(name), DATA)


def test_pivots_are_fixed():
    assert np.array_equal(history.pivot_codes(), history.pivot_codes()) and history.pivot_codes().shape == (8, 16)

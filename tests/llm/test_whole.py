"""The llm operators do the whole job: nothing is decided from a part of the input."""

import pytest

from scanloom.llm import prose, sentences

COMMENT = "# The dial closes the grid.\n"
CODE = "import os\n\ndef f(a):\n    x = g(a)\n    # It stops here.\n    return x\n"


@pytest.mark.parametrize("head", [COMMENT * 900, '"""\n' + "The dial closes the grid.\n" * 900 + '"""\n'])
def test_kind_beyond_a_long_head(head):
    assert len(head) > 20_000
    assert prose.kind_of(head + CODE) == "hash"
    found = "".join(piece for _, piece in prose.blocks(head + CODE))
    assert found.count("The dial closes the grid.") == 900 and "It stops here." in found and "import" not in found and "return" not in found


@pytest.mark.parametrize("places", [(0, 1, 2), (0, 500, 1000), (998, 999, 1000)])
def test_few_lines_of_code_leave_prose(places):
    lines = ["The dial closes the grid of the day.\n"] * 1001
    for i in places:
        lines[i] = "x = call(a)\n"
    assert prose.kind_of("".join(lines)) == "prose"


def test_unclosed_block_comment_hides_no_line():
    assert prose.kind_of('"""\n' + "The dial closes the grid.\n" * 900) == "prose"
    assert prose.kind_of('"""\n' + CODE * 3) == "hash"


@pytest.mark.parametrize("room", [20, 0])
def test_rare_words_count_as_common_ones(spark, room, monkeypatch):
    """Entries beyond the collected list decide as they do above it."""
    text = [f"The dial closes every grid, etc. The grid opens at {i} a.m. The grid ends, i.e. Mode is on. See Fig. {i} and Sec. {i} of vol. Two for the dial. It is lost." for i in range(40)]
    rows = [(i % 30, t, ["en", "de", None][i % 3]) for i, t in enumerate(text)] + [(100, None, "en"), (101, "", "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")

    def found():
        return sorted(map(tuple, sentences.sentences(df).collect()))

    monkeypatch.setattr(sentences, "MODEL_WORDS", 10**9)
    whole = found()
    monkeypatch.setattr(sentences, "MODEL_WORDS", room)
    assert found() == whole
    monkeypatch.setattr(sentences, "LEAST_COUNT", 10**9)
    assert found() != whole


def _history_rows(n, seed=4):
    import random

    rng = random.Random(seed)
    return [(i, f"s{i}", "r", f"{rng.getrandbits(1024) | 1:0256x}", 0, "") for i in range(n)]


def test_history_is_joined_where_it_lies(spark, tmp_path):
    """No exchange above the scan of the stored distances or codes, and distances out of reach are filtered in the scan."""
    from scanloom.llm import history
    from scanloom.llm.hamming_groups import code_rows

    df = spark.createDataFrame(_history_rows(300), "row_id bigint, source string, relpath string, fp_hex string, batch_no int, cid string")
    kept = history.History(spark, f"file://{tmp_path}/h", 10)
    kept.check(df, 0)
    rows = code_rows(df.where("row_id < 20"), "row_id", "fp_hex").select(history.F.col("row_id").alias("cid"), "code")
    probes = history.pivot_table(rows, 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = probes.select(history._cell(history.F.lit(3)).alias("cell"))
        past = kept._before("pivots", 1).where("d0 between 480 and 520")
        plan = past.join(asked.distinct(), "cell", "left_semi")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(i for i, line in enumerate(plan.splitlines()) if "Bucketed: true" in line)
    above = plan.splitlines()[:scan]
    assert not any("Exchange" in line for line in above) and "GreaterThanOrEqual(d0,480)" in plan
    kept.close()


@pytest.mark.parametrize(("hot", "reads"), [(24, 2), (0, 3)])
def test_a_batch_leaves_the_history_where_it_lies(spark, tmp_path, monkeypatch, hot, reads):
    """Shuffles of more partitions than the history has buckets do not shuffle it, and tables of a batch that is done are gone."""
    import os

    from scanloom import session
    from scanloom.llm import history

    old = _history_rows(200)
    new = [(1000 + i, s, r, f"{int(c, 16) ^ 1 << 700:0256x}", 1, "") for i, s, r, c, *_ in old[:30]] + [(2000 + i, s, r, c, 1, "") for i, s, r, c, *_ in _history_rows(30, 5)]
    df = spark.createDataFrame(old + new, "row_id bigint, source string, relpath string, fp_hex string, batch_no int, cid string")
    plans, paths = [], []

    def seen(plain):
        def write(frame, *a):
            plans.append(frame._jdf.queryExecution().executedPlan().toString())
            out = plain(frame, *a)
            paths.append(out._written_to.removeprefix("file://"))
            return out

        return write

    monkeypatch.setattr(history, "stored", seen(session.stored))
    monkeypatch.setattr(history, "cut", seen(session.cut))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = history.History(spark, f"file://{tmp_path}/h", 10, buckets=3, hot=hot)
        kept.check(df.where("batch_no = 0"), 0)
        got = {r.row_id for r in kept.check(df.where("batch_no = 1"), 1).where("is_case").collect()}
        kept.close()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == set(range(1000, 1030))
    scans = [line for plan in plans for line in plan.splitlines() if "history_pivots" in line or "history_codes" in line]
    assert len(scans) >= reads and all("Bucketed: true" in line for line in scans)
    assert not [p for p in paths if os.path.basename(p).startswith(("batch-", "probes-")) and os.path.exists(p)]


def test_a_history_opened_again_goes_on(spark, tmp_path):
    from scanloom.llm import history

    df = spark.createDataFrame(_history_rows(40), "row_id bigint, source string, relpath string, fp_hex string, batch_no int, cid string")
    first = history.History(spark, f"file://{tmp_path}/h", 10, buckets=3)
    assert first.check(df.where("row_id < 20"), 0).where("is_case").count() == 0
    first.close()
    again = history.History(spark, f"file://{tmp_path}/h", 10, buckets=7)
    assert again.buckets == 3
    assert {r.row_id for r in again.check(df, 1).where("is_case").collect()} == set(range(20))
    again.close()


def test_crowded_cells_of_the_history_are_split(spark, tmp_path, monkeypatch):
    """Many codes alike in one segment are split, and every close pair is still found."""
    import random

    from scanloom.llm import history

    rng = random.Random(8)
    mask = sum(1 << (1023 - p) for p in range(1024) if p % 11 == 0)
    same = rng.getrandbits(1024) & mask
    old = [rng.getrandbits(1024) & ~mask | same for _ in range(200)]
    new = [c ^ (1 << rng.randrange(1024)) for c in old[:30]] + [rng.getrandbits(1024) & ~mask | same for _ in range(30)]
    rows = [(i, "s", "r", f"{c:0256x}", 0 if i < 200 else 1, "") for i, c in enumerate(old + new)]
    df = spark.createDataFrame(rows, "row_id bigint, source string, relpath string, fp_hex string, batch_no int, cid string")
    calls, plain = [], history.split_rows
    monkeypatch.setattr(history, "split_rows", lambda *a: calls.append(1) or plain(*a))
    got = {r.row_id for r in history.batch_cases(df, "batch_no", 10, hot=5).collect()}
    assert got == set(range(200, 230)) and calls


def test_mixture_keeps_both_totals_at_every_size(spark):
    """Sources of 14, 400 and 200,000 documents of very uneven lengths: tokens and documents come out as promised."""
    import random

    from scanloom.llm import mixing

    rng = random.Random(6)
    docs, n = [], 0
    for source, size in (("small", 14), ("middle", 400), ("large", 200_000)):
        docs += [(n + i, source, int(rng.paretovariate(1.3) * 60)) for i in range(size)]
        n += size
    tokens = {s: sum(d[2] for d in docs if d[1] == s) for s in ("small", "middle", "large")}
    sizes = spark.createDataFrame(docs, "doc_id bigint, source string, tokens bigint")
    total = 0.6 * sum(tokens.values())
    weights = [(s, 0.4 * tokens[s] / total, 1) for s in tokens]
    weights[0] = ("small", 0.55 * tokens["small"] / total, 1)
    targets = spark.createDataFrame(weights, "source string, target_weight double, max_repeats int")
    for r in mixing.shares(mixing.drawn(sizes, targets), targets).collect():
        mean = tokens[r.source] / {"small": 14, "middle": 400, "large": 200_000}[r.source]
        assert abs(r.doc_residual) <= 1.001, r
        assert abs(r.token_residual) <= (mean if r.source == "small" else 2), r


def test_long_documents_keep_their_probability():
    import random

    from scanloom.llm import mixing

    t = [150.0, 80.0] + [10.0 + i % 31 for i in range(300)]
    n = [0, 0]
    for s in range(300):
        q = mixing.settle_long(t, [0.3] * len(t), random.Random(s))
        assert {q[0], q[1]} <= {0.0, 1.0}
        assert abs(sum(q) - 0.3 * len(t)) < 1e-6 and abs(sum(a * b for a, b in zip(t, q)) - 0.3 * sum(t)) < 1e-3
        n = [n[0] + q[0], n[1] + q[1]]
    assert 55 < n[0] < 130 and 55 < n[1] < 130


def test_a_document_too_long_to_balance_in_number_keeps_the_tokens():
    import random

    from scanloom.llm import mixing

    t = [2000.0] + [10.0 + i % 7 for i in range(900)]
    p = [0.4] * len(t)
    q = mixing.decided(t, p, random.Random(2), True)
    assert set(q) <= {0.0, 1.0} and abs(sum(a * b for a, b in zip(t, q)) - 0.4 * sum(t)) < 3


def test_count_arrays_are_not_larger_than_the_counts(monkeypatch):
    """Few counts over a vocabulary of 8 million ids stay few, sorted by id, and sum up to the same."""
    import numpy as np
    import pyarrow as pa

    from scanloom.llm import terms

    rng = np.random.default_rng(2)
    tid = np.sort(rng.integers(0, 8_000_000, 20_000))
    dense = np.arange(40_960, 45_056)
    tid = np.sort(np.concatenate([tid, dense]))
    rows = pa.RecordBatch.from_arrays([pa.array(tid), *[pa.array(np.ones(len(tid), np.int64) * k) for k in (1, 2, 3)]], names=["tid", "rows", "occ", "weight"])
    arrays = list(terms._accumulate(iter([rows.slice(0, 7000), rows.slice(7000)])))
    assert sum(b.nbytes for b in arrays) < 2 * rows.nbytes
    assert any(not b.column("at")[i].is_valid for b in arrays for i in range(b.num_rows))
    twice = pa.Table.from_batches(arrays + arrays).sort_by("block").to_batches()
    got = pa.Table.from_batches(list(terms._sum_sorted(iter(twice))))
    ids, n = np.unique(tid, return_counts=True)
    assert (got["tid"].to_numpy() == ids).all() and (got["rows"].to_numpy() == 2 * n).all() and (got["weight"].to_numpy() == 6 * n).all()


def test_terms_of_a_very_long_text(spark):
    from scanloom.llm import terms

    df = spark.createDataFrame([(" ".join(f"w{i % 30_000}" for i in range(100_000)), 2), ("w1 w1", 5)], "t string, w int")
    got = {r.term: (r.n_rows, r.n_occurrences, r.weight) for r in terms.term_counts(df, "t", "w").where("term in ('w1', 'w29999')").collect()}
    assert got == {"w1": (2, 6, 18), "w29999": (1, 3, 6)}


def test_packs_of_one_crowded_length(spark, monkeypatch):
    """A length of most items, documents of many full pieces, and parts and blocks much smaller than they are."""
    from collections import Counter

    from scanloom.llm import packing

    monkeypatch.setattr(packing, "RANKED_ROWS", 50)
    monkeypatch.setattr(packing, "RANK_BLOCK", 16)
    sizes = [(i, 30) for i in range(2000)] + [(5000 + i, 100 * (i % 5)) for i in range(400)] + [(9000, 100 * 700 + 1)] + [(9100 + i, i % 100) for i in range(300)]
    df = spark.createDataFrame(sizes, "doc_id bigint, tokens bigint")
    rows = packing.packed(df, 100).collect()
    held, parts = Counter(), {}
    for r in rows:
        held[r.pack_id] += r.n_tokens
        parts.setdefault(r.doc_id, []).append((r.part, r.start_token, r.n_tokens))
    assert max(held.values()) <= 100 and all(r.fill == held[r.pack_id] / 100 for r in rows)
    assert {p for p in held if p >= 0} == set(range(len(held) - 1))
    for i, n in sizes:
        got = sorted(parts[i])
        assert sum(x for *_, x in got) == n and len(got) == max(1, -(-n // 100)) and all(s == p * 100 for p, s, _ in got)


def _split(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    texts = {r[0]: r[1] for r in rows}
    out = {}
    for r in sentences.sentences(df).orderBy("doc_id", "start_pos").collect():
        out.setdefault(r.doc_id, []).append(texts[r.doc_id][r.start_pos : r.end_pos])
    return out


def test_collocations_keep_abbreviations_before_sentence_starters(spark):
    """A word that begins sentences elsewhere does not end the one before where it belongs to an abbreviation."""
    import random

    rng = random.Random(3)
    nouns, verbs = ["gate", "lamp", "door", "wheel", "panel", "lever", "valve", "spring"], ["turns", "blocks", "holds", "opens", "closes"]

    def plain():
        return f"{rng.choice(['The', 'Every', 'Some', 'A', 'Each', 'This', 'It and the'])} {rng.choice(nouns)} {rng.choice(verbs)} {rng.choice(['the', 'no', 'one', 'every'])} {rng.choice(nouns)}."

    def odd(i):
        return [f"Compare No. {i} vs. No. {i + 1} in the {rng.choice(nouns)}.", "No.", f"It {rng.choice(verbs)} one {rng.choice(nouns)} only."]

    want = {i: [x for _ in range(12) for x in (plain(), plain(), *(odd(i) if rng.random() < 0.04 else [plain()]))] for i in range(60)}
    got = _split(spark, [(i, " ".join(x), "en") for i, x in want.items()])
    assert [(x, y) for i in want for x, y in zip(want[i], got[i]) if x != y] == [] and got == want


def test_quotes_of_several_languages(spark):
    rows = [
        (1, "„Der Faden liest.“ „Der Puffer wartet.“ Das Ende naht.", "de"), (2, "« Le canal lit !\n» Il ferme. « Il lit ? » Puis il part.", "fr"),
        (3, "The plain winch turns.v2.1では記録を読む。「索引を読む。」と表示する。", "ja"), (4, 'He wrote: "Keep it."「設定を読む。」と表示する。', "ja"),
    ]
    got = _split(spark, rows)
    assert got[1] == ["„Der Faden liest.“", "„Der Puffer wartet.“", "Das Ende naht."]
    assert got[2] == ["« Le canal lit !\n»", "Il ferme.", "« Il lit ? »", "Puis il part."]
    assert got[3] == ["The plain winch turns.", "v2.1では記録を読む。", "「索引を読む。」と表示する。"]
    assert got[4] == ['He wrote: "Keep it."', "「設定を読む。」と表示する。"]


def test_words_before_a_period_are_whole(spark):
    long = "x" * 60
    assert sentences._before(f"a {long}. B", 62) == long


def test_a_comment_after_a_byte_order_mark_goes_on():
    text = "﻿// The dial closes\n// the grid.\nint a;\nint b = f(a);\n"
    assert [p.replace(" " * 4, " ").split() for _, p in prose.blocks(text)] == ["The dial closes the grid.".split()]

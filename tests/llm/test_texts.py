"""Looks, cores, duplicates, history, overlaps and terms against brute force on small tables."""

import random
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gramspan.llm import bloom, history
from gramspan.llm.dedupe_exact import duplicate_sets, hidden_duplicates
from gramspan.llm.minhash import signatures, trees_needed
from gramspan.llm.overlap import overlap_classes, overlap_pairs, overlap_report, overlaps
from gramspan.llm.terms import term_counts
from gramspan.llm.textform import core, likeness, look, pieces
from gramspan.llm.unify import lookalike_classes, lookalike_pairs, unify
from gramspan.session import Scratch

ODD = "aẹ́́̈가간가ㄴᆫᆨ　  ​‍﻿Ａ１ﬁ①аοΝі\t\n ;|:😀ẍ́ﾊﾞΆӏἀ"
EMPTY = [None, "", "   ", "...", "​"]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(ODD, max_size=12), min_size=1, max_size=60))
def test_unify_equals_look(spark, texts):
    df = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "id string, text string")
    for r in unify(df, "id", "text").collect():
        assert r.look == look(r.text), ascii(r.text)


def test_look_and_core():
    assert look("Ｎоνа ​é") == "Nova é" and look(look(ODD)) == look(ODD)
    assert unicodedata.normalize("NFKC", look(ODD)) == look(ODD)
    assert core("내용: 가 나 | 장소: B1") == core("장소:b1\n내용:가나") == "내용가나장소b1"
    assert core("가: 나") == "가나" and core("12:30에 가; 나") == "1230에가나" and [core(t) for t in EMPTY] == [""] * 5
    long = "x" * 21
    assert core(f"{long}: a | b: c") == f"{long}abc"


def test_unify_edges(spark):
    rows = [("a", None), ("b", ""), ("c", "​"), ("d", "plain"), ("d", "plain"), ("e", "가" * 30_000 + " "), (None, "é")]
    df = spark.createDataFrame(rows, "id string, text string").withColumn("look", F.lit("clash"))
    got = {r.id: r.look for r in unify(df, "id", "text").collect()}
    assert got["a"] is None and got["b"] == "" and got["c"] == "" and got["d"] == "plain" and got["e"] == "가" * 30_000 + " "
    assert unify(df.where("false"), "id", "text").count() == 0


def test_lookalike_pairs(spark):
    rows = [("a", "Nova 1"), ("b", "Νоva 1"), ("c", "Ｎova 1"), ("d", "Nova 1"), ("e", None), ("f", "​"), ("g", ""), ("h", "Nová 1"), ("b", "Νоva 1")]
    df = spark.createDataFrame(rows, "id string, text string")
    got = sorted(map(tuple, lookalike_pairs(df, "id", "text").collect()))
    assert got == [("a", "b"), ("a", "c"), ("b", "c"), ("b", "d"), ("c", "d")]
    assert lookalike_pairs(df.where("false"), "id", "text").count() == 0
    links = Counter(k for pair in got for k in pair)
    assert {r.id: (r.class_id, r.links) for r in lookalike_classes(df, "id", "text").collect()} == {k: ("a", n) for k, n in links.items()}
    assert lookalike_classes(df.where("false"), "id", "text").count() == 0


def test_bloom_forgets_no_repeat(spark, monkeypatch):
    rng = random.Random(1)
    keys = [rng.randrange(-(2**63), 2**63) for _ in range(3000)]
    rows = [(k, k // 3) for k in keys + keys[:700]]
    rng.shuffle(rows)
    scratch = Scratch(spark, "bloom")
    for parts, span in ((7, 1 << 20), (5, 100), (1, 1 << 20)):  # one range, and many
        monkeypatch.setattr(bloom, "RANGE", span)
        kept = scratch.keep(spark.createDataFrame(rows, "h1 long, h2 long").repartition(parts), f"t{parts}")
        got = Counter((r.h1, r.again) for r in bloom.marked(scratch, f"t{parts}", kept, len(rows)).collect())
        assert sum(got.values()) == len(rows) and all(got[k, True] == 2 for k in keys[:700])
        assert sum(n for (k, again), n in got.items() if again) < 1500
    assert bloom.marked(scratch, "none", scratch.keep(kept.where("false"), "none"), 0).count() == 0


def test_hidden_duplicates(spark, monkeypatch):
    from gramspan.llm import dedupe_exact

    monkeypatch.setattr(dedupe_exact, "LEAST_HOT", 5)
    rows = [(f"t{k:03d}", f"같은 글 {k % 4}!" if k < 40 else "핫 한 글" + " " * (k % 3)) for k in range(90)]
    rows += [("x1", "a: b | c: d"), ("x2", "C: D;A: B"), ("x3", None), ("x4", "  "), ("x4", "  "), (None, "같은 글 0"), ("t000", "같은 글 0!"), ("y", "홀로")]
    df = spark.createDataFrame(rows, "id string, text string").withColumn("h1", F.lit(1))
    got = {r.id: (r.kept_id, r.copies) for r in hidden_duplicates(df, "id", "text").collect()}
    sets = defaultdict(set)
    for i, t in rows:
        if i is not None and core(t):
            sets[core(t)].add(i)
    want = {i: (min(s), len(s)) for s in sets.values() for i in s} | {"x3": ("x3", 1), "x4": ("x4", 1)}
    assert got == want
    a, b = duplicate_sets(df.where("false"), "id", "text")
    assert a.count() == b.count() == 0


def corpus(seed, n=240):
    rng = random.Random(seed)
    words = [f"{rng.choice('가나다라마바사')}{rng.choice('방장점실')}{k}" for k in range(400)]
    texts = []
    for k in range(n):
        if texts and rng.random() < 0.35:
            parts = rng.choice(texts).split()
            for _ in range(rng.randint(0, 3)):
                parts[rng.randrange(len(parts))] = rng.choice(words)
            texts.append(" ".join(parts))
        else:
            texts.append(" ".join(rng.choice(words) for _ in range(rng.randint(8, 20))))
    return texts


def brute(rows):
    """Ids near-same to a text of an earlier ord."""
    cs = [(i, core(t), o) for i, t, o in rows if i is not None and o is not None and core(t)]
    return {i for i, c, o in cs if any(p < o and (c == d or likeness(c, d) >= 0.6) for _, d, p in cs)}


@pytest.mark.parametrize(("near", "chunk"), [(48, 1 << 21), (1, 1 << 21), (2, 40)])
def test_history_in_waves(spark, near, chunk):
    texts = corpus(5)
    hot = ["아주 흔한 안내문 문장이 여기 그대로 있습니다 번호 " + str(k) for k in range(60)]  # one prefix for many distinct cores
    rows = [(f"t{k}", t, k * 6 // 300) for k, t in enumerate(texts + hot)] + [("n", None, 2), (None, texts[0], 3), ("u", texts[1], None), ("b", "..", 3), ("t0", texts[0], 0), ("t5", texts[5], 0)]
    kind = "id string, text string, ord int"
    index, found = history.History(spark, 300, near=near, chunk=chunk), set()
    for k in range(6):
        part = [r for r in rows if r[2] == k or r[2] is None and k == 0]
        got = {r.id for r in index.add(spark.createDataFrame(part, kind).withColumn("core", F.lit(0))).collect()}
        found |= got
        if k == 3:
            index.merge_runs()
            assert len(index.runs) == 1
    want = brute(rows)
    assert found <= want and len(want - found) <= 0.02 * len(want)
    assert index.add(spark.createDataFrame([], kind)).count() == 0


def test_repeats_of_history_and_order(spark):
    texts = corpus(8, 120)
    rows = [(f"t{k}", t, f"b{k % 3}") for k, t in enumerate(texts)] + [("z", texts[0], "unknown")]
    runs = spark.sql("SELECT * FROM VALUES ('b0', timestamp'2030-01-03'), ('b0', NULL), ('b1', timestamp'2030-01-01'), ('b1', timestamp'2030-01-09'), ('b2', timestamp'2030-01-02') AS t(batch_id, created_at)")
    df = spark.createDataFrame(rows, "text_id string, raw_text string, batch_id string")
    order = {"b1": 1, "b2": 2, "b0": 3}
    want = brute([(i, t, order.get(b)) for i, t, b in rows])
    for waves in (1, 2, 5):
        got = {r.id for r in history.repeats_of_history(df, runs, waves=waves).collect()}
        assert got <= want and len(want - got) <= 0.02 * len(want)
    assert history.repeats_of_history(df.where("false"), runs).count() == 0


def test_match_gives_all_or_leaves_open():
    rng = np.random.default_rng(3)
    n, depth = 600, 3
    key = np.sort((rng.integers(0, 4, n, dtype=np.uint64) << np.uint64(24)) | rng.integers(0, 6, n, dtype=np.uint64))
    order, fresh = rng.integers(0, 9, n).astype(np.uint32), rng.random(n) < 0.8
    sketch = rng.integers(0, 2**63, n, dtype=np.uint64) & np.uint64(0xFFFF)
    every = {(a, b) for a in range(n) for b in range(n) if fresh[a] and key[a] >> np.uint64(24) == key[b] >> np.uint64(24) and order[b] < order[a]}
    for near in (2, 20, 1000):
        v, u, more = history.match(key, sketch, order, fresh, near, depth)
        got, open_ = set(zip(v.tolist(), u.tolist())), set(more.tolist())
        assert got <= every and len(got) == len(v) and open_ <= {a for a, _ in every}
        assert all((a, b) in got for a, b in every if a not in open_ and 64 - bin(int(sketch[a] ^ sketch[b])).count("1") >= history.SKETCH_MIN)
    assert history.match(key[:0], sketch[:0], order[:0], fresh[:0], 5, depth)[0].size == 0


def test_index_opened_again_reads_few_slices(spark, tmp_path):
    texts, folder = corpus(11, 200), f"file://{tmp_path}/index"
    rows = [(f"t{k}", t, 1) for k, t in enumerate(texts)] + [("s1", "가", 1), ("s2", "나b", 1)]
    kind = "id string, text string, ord int"
    assert history.History(spark, 200, folder=folder, slice_rows=4).add(spark.createDataFrame(rows, kind)).count() == 0
    index = history.History.open(spark, folder)
    late = [("a", texts[7] + " 끝", 2), ("b", "전혀 다른 이야기를 새로 적은 글입니다", 2), ("c", "가!", 2), ("d", "나", 2)]
    assert {r.id for r in index.add(spark.createDataFrame(late, kind)).collect()} == {"a", "c"}
    read, there = index.slices_read()
    assert 0 < read < 0.15 * there
    again = history.History.open(spark, folder)
    assert len(again.runs) == 2 and {r.id for r in again.add(spark.createDataFrame([("e", late[1][1], 3)], kind)).collect()} == {"e"}


def test_overlap(spark):
    texts = corpus(11, 150)
    splits = ["train", " Training", "DEV", "valid", "test", None, "other"]
    rows = [(f"g{k:03d}", t, splits[k % 7], f"s{k % 3}") for k, t in enumerate(texts)]
    rows += [("h1", texts[0], "test", "s0"), ("h2", "", "test", "s0"), ("h3", None, "train", "s1"), (None, texts[1], "test", "s1"), rows[0]]
    df = spark.createDataFrame(rows, "example_id string, sentence string, split string, source string").withColumn("core", F.lit(1))
    side = {"train": "train", "training": "train", "dev": "dev", "val": "dev", "valid": "dev", "test": "test"}
    clean = {(i, core(t), side.get((s or "").strip().lower()), c) for i, t, s, c in rows if i and core(t)}
    want = {tuple(sorted((a[0], b[0]))) for a in clean for b in clean if a[2] == "train" and b[2] in ("dev", "test") and (a[1] == b[1] or likeness(a[1], b[1]) >= 0.6)}
    members, pairs = overlaps(df)
    got = {tuple(r) for r in overlap_pairs(members, pairs).collect()}
    assert got <= want and len(want - got) <= 0.02 * len(want)
    assert sum(r.pairs for r in overlap_report(members, pairs).collect()) == len(got)
    links = Counter(k for pair in got for k in pair)
    assert {r.id: r.links for r in overlap_classes(members, pairs).collect()} == links
    assert overlap_pairs(*overlaps(df.where("false"))).count() == overlap_classes(*overlaps(df.where("false"))).count() == 0


def test_recall_of_trees():
    for depth in (3, 4, 6):
        trees = trees_needed(0.66, depth, 0.99)
        assert 1 - (1 - 0.66**depth) ** trees >= 0.99 > 1 - (1 - 0.66**depth) ** (trees - 1)
    grams, counts = pieces(["", "ab", "abc", "😀가나다", "abcd"])
    assert counts.tolist() == [0, 0, 1, 2, 2] and len(grams) == 5
    at, sig = signatures(["", "abc", "abc", "xyzw"], 8)
    assert at.tolist() == [1, 2, 3] and (sig[0] == sig[1]).all()


def test_terms(spark):
    rows = [("t1", "h1", "Ａ  b", "x"), ("t1", "h1", "Ａ  b", "x"), ("t1", "h2", "a B", None), ("t2", "h3", " ", ""), ("t3", "h4", "a b", "​"), ("t4", "h5", "a b", "x"), (None, "h6", "a b", "x"), ("t5", "h7", None, "У" * 5000)]
    df = spark.createDataFrame(rows, "text_id string, hit_id string, span_text string, regex_match_text string").withColumn("term", F.lit("clash"))
    got = {(r.field_name, r.term): (r.occurrences, r.records, r.mark) for r in term_counts(df, ["span_text", "regex_match_text"]).collect()}
    assert got == {("span_text", "a b"): (4, 3, "common"), ("regex_match_text", "x"): (2, 2, "rare"), ("regex_match_text", "y" * 5000): (1, 1, "rare")}
    assert term_counts(df.where("false"), ["span_text"]).count() == 0


def test_terms_like_counting(spark):
    rng = random.Random(2)
    rows = [(f"t{rng.randrange(300)}", f"h{k}", rng.choice(["가", "가 ", "나", f"말{k % 50}"])) for k in range(900)]
    got = {r.term: (r.occurrences, r.records) for r in term_counts(spark.createDataFrame(rows, "text_id string, hit_id string, f string"), ["f"]).collect()}
    occ, rec = Counter(), defaultdict(set)
    for i, _, v in rows:
        w = re.sub(r"\s+", " ", v).strip()
        occ[w] += 1
        rec[w].add(i)
    assert got == {w: (n, len(rec[w])) for w, n in occ.items()}

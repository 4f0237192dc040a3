"""Near-duplicate vectors, n-gram Jaccard and repeated passages against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import repeats, shingles
from tidemark.llm.components import connected_components
from tidemark.llm.repeats import intervals, remove_repeats
from tidemark.llm.shingles import ngram_jaccard
from tidemark.llm.vectors import near_duplicate_vectors


def smallest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)] + [(7, 7), (8, None), (900, 3), (3, 900)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = smallest_reachable({x for e in edges for x in e if x is not None} - {7, 8}, [e for e in edges if None not in e and e[0] != e[1]])
    assert {r["node"]: r["component"] for r in found} == want
    assert not connected_components(spark.createDataFrame([], "a long, b long")).collect()


# --- vectors ---------------------------------------------------------------------------------------------------------


def brute_vectors(rows, threshold=0.95):
    ok = [
        (i, np.array(v, float)) for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links, count = [], Counter()
    for p, (i, x) in enumerate(ok):
        for j, y in ok[p + 1 :]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links.append((i, j))
                count[i] += 1
                count[j] += 1
    labels = smallest_reachable({i for i, _ in rows if i is not None}, links)
    return {i: (count[i], labels[i], labels[i] == i) for i, _ in rows if i is not None}


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 16))
    rows = [(i, base[i].tolist()) for i in range(40)]
    rows += [(100 + i, (base[0] + 0.05 * rng.standard_normal(16)).tolist()) for i in range(60)]  # saturates every list
    rows += [(200 + i, base[5].tolist()) for i in range(30)] + [(300, (2.5 * base[7]).tolist())]
    chain = [(400 + i, [float(np.cos(0.25 * i)), float(np.sin(0.25 * i))]) for i in range(8)]  # links along a path only
    odd = [(500, None), (501, []), (502, [0.0] * 16), (503, [float("nan")] * 16), (504, [float("inf")] + [1.0] * 15), (505, [None] + [1.0] * 15)]
    rows += chain + odd
    df = spark.createDataFrame([(i, v, "x") for i, v in rows] + [(None, base[5].tolist(), "y")], "vec_id long, embedding array<double>, rep string")
    found = near_duplicate_vectors(df, k=4, tables=4, audit=50).collect()
    assert len(found) == len(rows) + 1
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found if r["vec_id"] is not None}
    assert got == brute_vectors(rows)
    (unnamed,) = [r for r in found if r["vec_id"] is None]
    assert (unnamed["n_links"], unnamed["component_id"]) == (0, None)


def test_vectors_of_dense_groups_with_a_single_link_between(spark):
    """Two groups in which all are linked, and one pair of vectors that bridges them: 12 times."""
    rng = np.random.default_rng(11)
    turned = lambda x, y, degrees: np.cos(np.radians(degrees)) * x + np.sin(np.radians(degrees)) * y
    found, bridges = [], []
    for _ in range(12):
        x, y = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
        for centre, other in ((0, 26), (26, 0)):
            for _ in range(150):
                noise = rng.standard_normal(32)
                noise -= (noise @ x) * x + (noise @ y) * y
                found.append(turned(turned(x, y, centre), noise / np.linalg.norm(noise), 5))
            bridges.append(len(found))
            found.append(turned(x, y, centre + (5 if other > centre else -5)))
    ids = rng.permutation(len(found))
    rows = [(int(i), v.tolist()) for i, v in zip(ids, found, strict=True)]
    unit = np.array(found) / np.linalg.norm(found, axis=1, keepdims=True)
    i, j = np.nonzero(np.triu(unit @ unit.T >= 0.95, 1))
    links = list(zip(ids[i].tolist(), ids[j].tolist(), strict=True))
    assert all((p, q) in set(zip(i.tolist(), j.tolist(), strict=True)) for p, q in zip(bridges[::2], bridges[1::2], strict=True))
    labels = smallest_reachable(ids.tolist(), links)
    assert len(set(labels.values())) == 12
    count = Counter(x for link in links for x in link)
    got = near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {n: (count[n], labels[n]) for n in ids.tolist()}


def test_vectors_repeated_rows_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    twice = near_duplicate_vectors(spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [-1.0, 0.0])], schema)).collect()
    assert sorted(tuple(r) for r in twice) == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
    assert near_duplicate_vectors(spark.createDataFrame([], schema)).collect() == []
    other = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (4, [0.011, 1.0])]
    found = near_duplicate_vectors(spark.createDataFrame(other, schema)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == [(1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1), (4, 2, 1)]


# --- shingles --------------------------------------------------------------------------------------------------------


def brute_shingles(rows):
    sets = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    where, links = defaultdict(list), []
    for doc, own in sets.items():
        for s in own:
            where[s].append(doc)
    for doc, own in sets.items():
        for other, common in Counter(o for s in own for o in where[s] if o < doc).items():
            if 100 * common >= 80 * (len(own) + len(sets[other]) - common):
                links.append((doc, other))
    labels = smallest_reachable(sets, links)
    return {d: (len(s), labels[d]) for d, s in sets.items()}


def documents(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    rows, passage = [], " ".join(word() for _ in range(60))
    for i in range(n):
        words = [word() for _ in range(rng.choice([1, 3, 5, 6, 8, 12, 30, 150, 600]))]
        rows.append((10 * i, " ".join(words)))
        for j in range(rng.choice([0, 0, 1, 4])):
            changed = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 30))):
                changed[rng.randrange(len(changed))] = word()
            rows.append((10 * i + j + 1, rng.choice([" ", "\t", "\n\n"]).join(changed)))
        if i % 3 == 0:
            rows.append((10 * i + 8, " ".join([passage, *words[:20]])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_equals_brute_force(spark, seed):
    rows = documents(seed) + [(9000, None), (9001, ""), (9002, " \n "), (9003, "One two"), (9004, "one\ttwo"), (9005, "É é"), (9006, "x " * 30_000)]
    found = ngram_jaccard(spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, size int")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_shingles(rows)


def test_jaccard_near_copies_of_one_text(spark):
    """A family in which many pairs are alike and many are not: no link may be lost to the choice of leaders."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        changed = list(words)
        for at in rng.sample(range(120), rng.randint(0, 4)):
            changed[at] = f"c{i}_{at}"
        rows.append((i, " ".join(changed)))
    found = ngram_jaccard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_shingles(rows)


def test_jaccard_null_ids_repeats_and_no_rows(spark):
    text = "a b c d e f g"
    found = ngram_jaccard(spark.createDataFrame([(None, text), (3, text), (3, text), (2, text)], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in found) == [(0, 3, None), (2, 3, 2), (3, 3, 2), (3, 3, 2)]
    assert ngram_jaccard(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_near_copies_leave_one_row_of_every_group(spark):
    words = lambda name, n=80: [f"{name}{i}" for i in range(n)]
    twice, other, unnamed = words("twice"), words("other"), words("unnamed")
    rows = [(1, twice), (1, twice), (2, [*twice[:-1], "x"]), (1, other), (None, unnamed), (None, unnamed), (None, [*unnamed, "y"])]
    rows += [(3, words("named")), (None, words("named")), (4, []), (4, []), (5, words("alone")), (None, None)]
    rows = [(d, None if w is None else " ".join(w), "en") for d, w in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = corpus_pipeline.near_copies(spark, df, "").collect()
    assert Counter(tuple(r) for r in found if r["doc_id"] is not None) == Counter([rows[0], rows[3], rows[7], rows[9], rows[10], rows[11]])
    (kept, blank) = sorted((r["text"] or "" for r in found if r["doc_id"] is None), reverse=True)
    assert blank == "" and kept in (rows[4][1], rows[6][1])
    left = corpus_pipeline.materialise(spark.createDataFrame(found, df.schema), "near-copies")
    assert {r["n_removed"] for r in remove_repeats(left).collect()} == {0}


def test_signatures_meet_in_every_similar_pair():
    """The guarantee itself: similar sets share at least as many signatures as each asks for."""
    rng = np.random.default_rng(9)
    bands = shingles.Bands(80)
    for _ in range(400):
        size = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        gone = rng.integers(0, max(1, size // 9) + 1)
        b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, int(rng.integers(0, size // 9 + 1))).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if len(b) and 100 * common >= 80 * (len(a) + len(b) - common):
            (s, need_s), (t, need_t) = shingles.signatures(a, bands), shingles.signatures(b, bands)
            shared = len(set(s.tolist()) & set(t.tolist()))
            assert shared >= max(1, min(need_s, need_t))


# --- repeats ---------------------------------------------------------------------------------------------------------


def brute_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        covered = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                covered[i : i + length] = True
        edges = np.diff(np.concatenate([[0], covered.astype(int)]))
        out.append((len(t), int(covered.sum()), int((edges == 1).sum()), bytes(np.frombuffer(t, np.uint8)[~covered])))
    return out


def test_repeats_equal_brute_force(spark):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, base = text(450), text(1500)
    rows = [(1, "a" * 1000), (2, "ab" * 400), (3, base), (4, base[100:700] + "x" + base[:150]), (5, None), (6, "")]
    rows += [(7, "x" * 199), (8, "y" * 201), (9, base[:200]), (9, base[:200]), (10, base[50:251]), (11, "é" * 150)]
    rows += [(12, "z" + "é" * 150), (None, base[300:520]), (13, "qrs" * 66 + "uv" + "qrs" * 66), (14, base[800:999])]
    for i in range(30):
        cut = rng.randint(0, 300)
        rows.append((100 + i, text(rng.randint(0, 400)) + passage[cut : cut + rng.randint(150, 450)] + text(rng.randint(0, 300))))
    rows.append((200, text(120_000) + passage))
    df = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, place int")
    df = df.withColumn("key", F.lit("k"))
    found = {r["place"]: r for r in remove_repeats(df).collect()}
    want = brute_repeats([(t or "").encode() for _, t in rows], 200)
    for i, expected in enumerate(want):
        r = found[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == expected, rows[i][0]
        assert (r["doc_id"], r["key"]) == (rows[i][0], "k")


def test_equal_rows_are_each_others_repeats(spark):
    df = spark.createDataFrame([(1, "q" + "w" * 9 + "e" * 300)] * 2, "doc_id long, text string")
    assert [r["n_removed"] for r in remove_repeats(df).collect()] == [310, 310]
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_many_equal_rows_and_clashing_columns(spark):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh ") for _ in range(900))
    df = spark.createDataFrame([(1, text, 5)] * 40 + [(2, "#" * 50 + text[300:600] + "?", 6), (3, "alone", 7)], "doc_id long, text string, kept int")
    df = df.withColumn("n_bytes", F.lit("old"))
    found = remove_repeats(df)
    assert sorted(found.columns) == sorted(["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found.collect())
    assert got == [(1, 900, 900, 1, b"")] * 40 + [(2, 351, 300, 1, b"#" * 50 + b"?"), (3, 5, 0, 0, b"alone")]


def test_common_prefix_intervals():
    assert sorted(intervals([3, 5, 5, 0, 4], 1)) == [(3, 0, 3), (4, 4, 5), (5, 1, 3)]


def test_maximal_repeats_differ_on_the_left():
    texts = [b"1" + b"m" * 5 + b"x", b"2" + b"m" * 5 + b"y", b"2" + b"m" * 5 + b"z"]
    numbers = np.arange(3)
    found = {(d, tuple(sorted(b.tolist()))) for d, _, b in repeats.maximal_repeats(texts, np.zeros(3, int), numbers, numbers * 100, 5)}
    assert (5, (1, 101, 201)) in found and (6, (100, 200)) in found

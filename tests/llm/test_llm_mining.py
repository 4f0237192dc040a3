"""Source mixing, hard negatives and lexical search against brute force, on ties, nulls and repeated rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lexical, negatives
from tidemark.llm.lexical import Trie, lexical_search
from tidemark.llm.mixing import mix_sources, taken_words
from tidemark.llm.negatives import best_in_windows, hard_negatives, reference_directions, score_bounds

DOCS = "doc_id long, source string, text string, size string"


def mixed_rows():
    rng = random.Random(3)
    rows = [(i, rng.choice(["b", "a", "é", "a", None]), " ".join(["w"] * rng.randrange(0, 40)), "x") for i in range(300)]
    rows += [(300, "z", None, None), (301, "z", "", None), (302, "z", " \n\t", None), (None, "b", "one two", None), (None, "b", "three", None)]
    rows += [(7, "a", "equal rows", None)] * 3 + [(7, "b", "another text", None), (303, "long", "w " * 5000, None)]
    return rows


def targets_by_hand(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), share * sum(sizes.values())
    while True:
        level = rest / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not above:
            return target | {s: weight[s] * level for s in open_}
        target |= {s: most * sizes[s] for s in above}
        open_, rest = open_ - above, rest - sum(target[s] for s in above)


def test_mix(spark):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, DOCS)
    mix = mix_sources(df, block=16)
    docs, pieces = taken_words(mix).collect(), mix.pieces.collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((d["doc_id"], d["source"], d["size"]) for d in docs) == Counter((r[0], r[1], words(r[2])) for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r[1]] += words(r[2])
    want, taken = targets_by_hand(sizes), Counter()
    for d in docs:
        assert d["source_size"] == sizes[d["source"]] and d["target"] == pytest.approx(want[d["source"]])
        assert 0 <= d["taken"] <= 2 * d["size"]
        taken[d["source"]] += d["taken"]
    assert all(taken[s] == math.floor(want[s] + 0.5) for s in sizes)

    source = {d["row"]: d["source"] for d in mix.documents.collect()}
    slots, seen = {}, set()
    for p in pieces:
        slots.setdefault(p["slot"], []).append(p)
        for place in range(p["start"], p["start"] + p["length"]):
            assert (p["row"], p["times"], place) not in seen
            seen.add((p["row"], p["times"], place))
    short = [k for k, v in slots.items() if sum(p["length"] for p in v) != 16]
    assert len(short) <= len(sizes) and all(len({source[p["row"]] for p in v}) == 1 for v in slots.values())
    order = [source[slots[k][0]["row"]] for k in sorted(slots)]
    share = {s: n / len(order) for s, n in Counter(order).items()}
    for n in range(1, len(order)):
        got = Counter(order[:n])
        assert all(abs(got[s] - share[s] * n) < 5 for s in share)


def test_mix_is_the_same_again(spark):
    df = spark.createDataFrame(mixed_rows(), DOCS)
    runs = [taken_words(mix_sources(x, block=16)).collect() for x in (df, df.repartition(5, "text"), df.orderBy("text"))]
    a, b, c = (Counter(map(tuple, r)) for r in runs)
    assert a == b == c


def test_mix_of_nothing(spark):
    empty = mix_sources(spark.createDataFrame([], DOCS))
    assert taken_words(empty).count() == 0 and empty.pieces.count() == 0
    blank = taken_words(mix_sources(spark.createDataFrame([(1, "a", None, None), (2, None, " ", None)], DOCS))).collect()
    assert sorted((d["doc_id"], d["size"], d["target"], d["taken"]) for d in blank) == [(1, 0, 0, 0), (2, 0, 0, 0)]


def negatives_by_hand(rows, anchors, k=5, n=3):
    out = []
    good = [(i, l, [math.floor(256 * x) for x in v]) for i, v, l in rows if usable((i, v, l))]
    for i, label, v in {(i, l, tuple(math.floor(256 * x) for x in v)) for i, v, l in anchors if usable((i, v, l))}:
        scored = [(-sum(map(int.__mul__, v, w)), j, m) for j, m, w in good if len(v) == len(w)]
        scored.sort()
        for p, pid, _ in [s for s in scored if s[2] == label and s[1] != i][:k]:
            fits = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:n]
            out += [(i, pid, rank, s[1], -p, -s[0]) for rank, s in enumerate(fits, 1)]
    return out


def usable(row):
    i, v, label = row
    return None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)


@pytest.mark.parametrize("rows_per_block, anchors_per_block", [(8192, 8192), (60, 4)])
def test_negatives(spark, monkeypatch, rows_per_block, anchors_per_block):
    monkeypatch.setattr(negatives, "ROWS", rows_per_block)
    monkeypatch.setattr(negatives, "ANCHORS", anchors_per_block)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, 8))
    rows = [(i, (centres[i % 6] + 0.5 * rng.standard_normal(8)).tolist(), int(rng.integers(3))) for i in range(400)]
    rows += [(1000 + i, rows[3][1], i % 3) for i in range(40)]  # ties
    rows += [rows[50], rows[50], (50, rows[9][1], 1), (51, None, 1), (52, [1.0, None], 0), (53, [float("nan")] * 8, 0)]
    rows += [(54, [float("inf")] * 8, 1), (55, [1.0] * 8, None), (None, [1.0] * 8, 1), (100, [0.0] * 8, 1), (150, [1.0, 2.0], 1)]
    rows += [(151, [2.0, 2.0], 1), (152, [1.5, 1.5], 0), (200, [], 1), (201, [], 1)]
    schema = "vec_id long, embedding array<double>, label int, id string, score long"
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], schema)
    found = hard_negatives(df, df.where("vec_id % 50 = 0")).collect()
    want = negatives_by_hand(rows, [r for r in rows if r[0] is not None and r[0] % 50 == 0])
    assert want and Counter(map(tuple, found)) == Counter(want)


def test_negatives_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert hard_negatives(df, df).count() == 0
    df = spark.createDataFrame([(50, [1.0], 1)], df.schema)
    assert hard_negatives(df, df).count() == 0


def test_bounds_hold_and_spare_products():
    rng = np.random.default_rng(1)
    centres = 20 * rng.standard_normal((40, 16))
    make = lambda n: np.floor(256 * (centres[np.sort(rng.integers(40, size=n))] + rng.standard_normal((n, 16))))
    x, y = make(200), make(1600)
    directions = reference_directions(list(y[::4]), 16, 16)
    side = {}
    for name, q in (("anchors", x), ("rows", y)):
        norm = np.linalg.norm(q, axis=1)
        side[name] = {"q": q.astype(int), "norm": norm, "angles": np.arccos(np.clip(q @ directions.T / norm[:, None], -1, 1))}
        side[name] |= {"id": np.arange(len(q)) + 10_000 * (name == "anchors"), "label": np.zeros(len(q), int)}
    a, r = side["anchors"], side["rows"]
    lower, upper = score_bounds(a["angles"], a["norm"], r["angles"], r["angles"], r["norm"], r["norm"])
    true = x @ y.T
    assert (lower <= true).all() and (true <= upper).all()
    a |= {"low": np.full((200, 1), negatives.NONE), "high": np.full((200, 1), -negatives.NONE)}
    i, _, j, score, products = best_in_windows(a, r, True, 5)
    order = np.lexsort((np.broadcast_to(np.arange(1600), true.shape), -true))[:, :5]
    assert (j.reshape(200, 5) == order).all() and (score == true[i, j]).all()
    assert products < 0.5 * true.size


def terms_by_hand(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def ranking_by_hand(docs, items, top=10):
    counted = [(i, Counter(terms_by_hand(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item in {i for i, _ in items}:
        terms = {t for i, x in items if i == item for t in terms_by_hand(x)}
        scored = []
        for doc, c in counted:
            m = 10 + 90 * sum(c.values()) * n // total
            weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in terms if t in c}
            score = sum(w * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, w in weight.items())
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, rank, s[2], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)]
    return out


def test_search(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "ünï", "日本", "X9"]
    text = lambda n: " ".join(rng.choices(words, range(len(words), 0, -1), k=n))
    docs = [(i, text(rng.randrange(1, 60))) for i in range(800)] + [(2000 + i, "same text w59 w3") for i in range(50)]
    docs += [(3000, None), (3001, ""), (3002, "-- ,,"), (None, "w1 w2 w58"), (5, "w58 repeated id"), (3003, "w57 " * 70_000)]
    docs += [(4000 + i, " ".join(words[: i % 60 + 1])) for i in range(180)]  # every vector begins another
    items = [(i, text(12)) for i in range(20)] + [(20, None), (21, "no such term"), (22, "w58-W57 x9"), (22, "日本"), (None, "w0")]
    left = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, rank int, item_id string").repartition(6)
    right = spark.createDataFrame([(*i, 3) for i in items], "item_id long, text string, doc_id int")
    found = lexical_search(left, right)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == Counter(ranking_by_hand(docs, items))


def test_search_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_BYTES", 20)
    docs, items = [(i, f"a{i % 7} b{i % 3} c") for i in range(100)], [(i, f"a{i} b1 c") for i in range(9)]
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert Counter(map(tuple, lexical_search(left, right).collect())) == Counter(ranking_by_hand(docs, items))


def test_search_of_nothing(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search(docs, items).collect() == []
    assert lexical_search(items.toDF("doc_id", "text"), items.where("item_id > 1")).collect() == []


def test_tries_leave_documents_out():
    rng = np.random.default_rng(4)
    documents = {}
    for doc in range(3000):
        topic = doc % 60
        path = np.unique(np.concatenate([rng.integers(0, 20, 6), 20 + topic * 10 + rng.integers(0, 10, 6)]))
        documents.setdefault((path.astype(">u4").tobytes(), np.ones(len(path), ">u4").tobytes(), 100), []).append(doc)
    trie = Trie(documents, 620, 10)
    best = []
    terms = np.array([0, 1, 20, 21, 22, 23])
    scored = trie.search(terms, np.array([10, 10, 3000, 3000, 3000, 3000]), best, 10)
    assert len(best) == 10 and scored < 0.3 * len(documents)


def test_common_passage_gives_few_candidates(spark, monkeypatch):
    from tidemark.llm import shingles

    made, plain = {}, shingles.materialise

    def counted(df, name, path=None):
        out = plain(df, name, path)
        made[name] = made.get(name, 0) + (out.count() if name in ("blocks", "pairs") else 0)
        return out

    monkeypatch.setattr(shingles, "materialise", counted)
    passage = " ".join(f"c{i}" for i in range(60))
    docs = [(i, f"{passage} " + " ".join(f"u{i}x{j}" for j in range(30))) for i in range(2000)]
    docs += [(5000, docs[7][1] + " end")]
    found = shingles.ngram_jaccard(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in found if r["component_id"] != r["doc_id"]} == {5000}
    assert made["blocks"] < 2000 and made["pairs"] < 50_000

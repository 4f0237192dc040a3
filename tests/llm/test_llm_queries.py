"""The registered queries on whole tables: against SQL where there is SQL, else against brute force."""

from __future__ import annotations

import hashlib
import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

import corpus_pipeline
from tidemark.llm.oracle import LLM_ORACLE
from tidemark.llm.queries import LLM_QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def texts(db):
    return dict(db.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_sql(spark, db, name):
    found = LLM_QUERIES[name](spark, SF_DIR)
    expected = db.execute(LLM_ORACLE[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(found.columns)
    rows = [tuple(map(str, r)) for r in expected.fetchall()]
    assert rows and sorted(tuple(map(str, r)) for r in found.select(names).collect()) == sorted(rows)


def test_scores(spark, db, texts):
    rows = LLM_QUERIES["op2_quality_classifier"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    labels = dict(db.execute("SELECT doc_id, quality FROM labels").fetchall())
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in texts if zlib.crc32(str(d).encode()) % 5 == 0}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held if r["doc_id"] in labels]) > 0.95


def test_packed_pieces(spark, texts):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: [*library.encode(t, add_special_tokens=False).ids, 0] for d, t in texts.items()}
    filled, starts = {}, {}
    for r in sorted(LLM_QUERIES["op3_packing"](spark, SF_DIR).collect(), key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(piece, "<u4").tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        starts.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    assert set(starts) == set(ids) and sorted(filled) == list(range(len(filled)))
    assert all(filled[s] == 1024 for s in range(len(filled) - 1))
    for doc, parts in starts.items():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [s for s, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] == len(ids[doc])


def test_pieces(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    rows = LLM_QUERIES["op9_sentencepiece"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_eos=True)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == digest(" ".join(map(str, ids)))
        assert r["decoded_sha256"] == digest(library.decode(ids))
        # A byte piece stands for one byte, an end id for none, all others for what the library calls their surface.
        surfaces = [*(p.surface for p in library.encode(texts[r["doc_id"]], return_type="proto").pieces), ""]
        sizes = [1 if library.is_byte(i) else 0 if library.is_control(i) else len(s.encode()) for i, s in zip(ids, surfaces, strict=True)]
        ends = np.cumsum(sizes).tolist()
        assert r["spans_sha256"] == digest(" ".join(map(str, [*([0, *ends][:-1]), *ends])))
        assert r["n_source_bytes"] == len(texts[r["doc_id"]].encode())


def repeats_by_hand(texts, length=200):
    seen = {}
    for text in texts.values():
        for i in range(len(text) - length + 1):
            h = hash(text[i : i + length])
            seen[h] = seen.get(h, 0) + 1
    out = {}
    for doc, text in texts.items():
        covered = np.zeros(len(text) + 1, int)
        for i in range(len(text) - length + 1):
            if seen[hash(text[i : i + length])] > 1:
                covered[i] += 1
                covered[i + length] -= 1
        covered = np.cumsum(covered)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        out[doc] = len(text), int(covered.sum()), spans, np.frombuffer(text, np.uint8)[~covered].tobytes()
    return out


def test_removed_repeats(spark, texts):
    want = repeats_by_hand({d: t.encode() for d, t in texts.items()})
    rows = LLM_QUERIES["op8_suffix_array_dedup"](spark, SF_DIR).collect()
    assert len(rows) == len(want)
    for r in rows:
        n, removed, spans, kept = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (n, removed, spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_licence_lines(spark, texts):
    import re

    fixed = {"Apache License": "apache-2.0", "MIT License": "mit", "General Public License, version 3": "gpl-3.0", "CC BY-NC": "cc-by-nc"}
    want = set()
    for doc, text in texts.items():
        for i, line in enumerate(text.split("\n")):
            want |= {(doc, i, f) for mark, f in fixed.items() if re.search(rf"(under|the) .*{mark}", line) and len(line) < 90}
    rows = LLM_QUERIES["op5_licence_scan"](spark, SF_DIR).collect()
    assert {(r["doc_id"], r["paragraph"], r["family"]) for r in rows if r["confirmed"]} == want and want


def test_repaired_chats(spark, db):
    rows = LLM_QUERIES["op4_chat_format"](spark, SF_DIR).collect()
    assert len(rows) == db.execute("SELECT count(*) FROM conversations").fetchall()[0][0]
    assert all(r["action"] == "keep" and r["cost"] == 0 for r in rows if r["role"] == r["repaired_role"] and r["action"] == "keep")


def test_stages_one_by_one(spark, db):
    """Every stage on what the one before kept, against what brute force says of it."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, SF_DIR), "stage")
        assert docs.columns == list(seen[0].columns), name
        seen.append(docs.toPandas().sort_values("doc_id"))
    ids = [set(frame["doc_id"]) for frame in seen]
    assert ids[0] > ids[1] > ids[2] > ids[3] == ids[4]
    labels = dict(db.execute("SELECT doc_id, quality FROM labels").fetchall())
    assert np.mean([labels[d] for d in ids[1] if d in labels]) > 0.99
    assert np.mean([labels[d] == 0 for d in ids[0] - ids[1] if d in labels]) > 0.9

    from test_llm_pairs import brute_shingles
    from test_llm_texts import brute_rules

    failed = {r.doc_id for r in seen[1].itertuples() if brute_rules(r.text)[-1]}
    assert not failed & ids[2] and len(ids[1] - ids[2] - failed) <= 0.01 * len(ids[1])
    groups = brute_shingles([(r.doc_id, r.text) for r in seen[2].itertuples()])
    assert ids[3] == {d for d, (_, component) in groups.items() if d == component}
    want = repeats_by_hand({r.doc_id: r.text.encode() for r in seen[3].itertuples()})
    for r in seen[4].itertuples():
        kept = want[r.doc_id][3]
        assert r.text.encode() == kept or "�" in r.text
        assert r.n_chars == len(r.text)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {p["doc_id"] for p in pieces} == ids[4]
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for t in seen[4]["text"])
    assert sum(p["length"] for p in pieces) == total


def licence_lines_by_hand(texts, model):
    """Every line's family and probability out of the weights, and its best template."""
    import math
    import re

    from tidemark.llm.licences import TEMPLATES, UNKNOWN

    weights, bias, temperature = model
    weights = {r["gram"]: r["weights"] for r in weights.collect()}

    def grams(text):
        words = [w for w in re.split(r"[^\w]+|_", text.lower()) if w]
        return {" ".join(words[i : i + n]) for n in (2, 3) for i in range(len(words) - n + 1)}

    wanted = [(f, grams(t)) for f, t in TEMPLATES]
    for doc, text in texts.items():
        for number, line in enumerate(text.split("\n")):
            found = grams(line) & weights.keys()
            if found:
                logits = {f: (sum(weights[g][i] for g in found) + bias[f]) / temperature for i, f in enumerate(bias)}
                family = max(logits, key=logits.get)
                probability = 1 / sum(math.exp(x - logits[family]) for x in logits.values())
                if family != UNKNOWN and probability >= 0.5:
                    overlap = max(len(found & w) / len(w) for f, w in wanted if f == family)
                    yield doc, number, family, round(probability, 6), overlap >= 0.5


def test_licence_lines_by_brute_force(spark, texts):
    from pyspark.sql import functions as F

    from tidemark.llm.licences import scan_licences, train, words_of

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    lines = docs.select(F.explode(F.split("text", "\n", -1)).alias("line")).withColumn("words", words_of(F.col("line")))
    model = train(lines)
    found = scan_licences(docs.union(docs.where("doc_id % 3 = 0")), model=model).collect()
    single = {(r["doc_id"], r["paragraph"], r["family"], round(r["probability"], 6), r["confirmed"]) for r in found if "\n" not in r["line"]}
    want = set(licence_lines_by_hand(texts, model))
    confirmed = {w for w in want if w[-1]}
    assert confirmed and {s for s in single if s[-1]} == confirmed and single <= want
    assert len(found) == len({(r["doc_id"], r["paragraph"], r["line"]) for r in found})


def test_licences_in_very_long_lines(spark):
    import time

    from pyspark.sql import functions as F

    from tidemark.llm.licences import scan_licences, train, words_of

    lines = spark.createDataFrame([("some other line of text",)], "line string").withColumn("words", words_of(F.col("line")))
    model = train(lines)
    notice, took = "Licensed under the Apache License, Version 2.0.", []
    for n in (5_000, 20_000):
        text = " ".join(f"word{i}" for i in range(n)) + " the terms of the " * 500 + "\n" + notice
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        begin = time.perf_counter()
        assert [(r["paragraph"], r["family"], r["confirmed"]) for r in scan_licences(df, model=model).collect() if r["confirmed"]] == [(1, "apache-2.0", True)]
        took.append(time.perf_counter() - begin)
    assert took[1] < 8 * took[0] + 5

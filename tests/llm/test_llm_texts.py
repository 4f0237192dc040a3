"""Classifier, packing, chat, licences, archive, pieces and rules on small tables."""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import textwrap
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from tidemark.llm import chat
from tidemark.llm.archive import archive_folder, read_archive, write_archive
from tidemark.llm.chat import format_chat
from tidemark.llm.licences import scan_licences
from tidemark.llm.packing import byte_level_encoding, pack
from tidemark.llm.pieces import CharacterMap, Model, encode_pieces, spans
from tidemark.llm.quality import fit_quality, held_out
from tidemark.llm.rules import quality_rules

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "a", "don't  I'LL 123　x\r\n\t", "é😀​ ́", "<|endoftext|> </s> ▁ <0x0A>", "x" * 3000, " " * 500 + "y", "\x00\x01", "a b"]


# --- packing ---------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("text", ODD)
def test_ids_are_those_of_the_tokenizers_library(text):
    theirs = tokenizers.Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids
    assert byte_level_encoding(BPE).encode_to_numpy(text, allowed_special="all").tolist() == theirs


def packed(df, **options):
    rows = pack(df, BPE, width=32, window=4, unit=8, **options).collect()
    return [(r["doc_id"], r["start"], r["length"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"], r["sequence_id"], r["offset"], r["padded_length"]) for r in rows]


def check_packing(rows, texts, width=32):
    encoding = byte_level_encoding(BPE)
    want = Counter()
    for doc, text in texts:
        want[doc, tuple(encoding.encode_ordinary(text or "")) + (0,)] += 1
    by_doc = {}
    for doc, start, length, ids, total, *_ in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        assert length == len(ids) > 0
        by_doc.setdefault(doc, []).append((start, ids, total))
    for doc, parts in by_doc.items():
        if sum(n for (d, _), n in want.items() if d == doc) == 1:
            joined = [i for _, ids, _ in parts for i in ids]
            assert want[doc, tuple(joined)] == 1 and {t for *_, t in parts} == {len(joined)}
    assert sum(r[2] for r in rows) == sum(len(ids) * n for (_, ids), n in want.items())
    filled = Counter()
    for *_, length, _, _, sequence, offset, padded in [(r[0], r[2], r[3], r[4], r[5], r[6], r[7]) for r in sorted(rows, key=lambda r: (r[5], r[6]))]:
        assert filled[sequence] == offset
        filled[sequence] += length
        assert filled[sequence] <= padded
    assert sorted(filled) == list(range(len(filled)))
    assert all(filled[s] == width for s in range(len(filled) - 1))


def test_packing_holds_every_id_once_and_fills_sequences(spark):
    texts = [(i, "word " * (i % 37)) for i in range(80)] + [(1000, None), (1001, ""), (1002, "y" * 5000)]
    rows = [(d, t, ["a", "a", "b", None][d % 4], 1) for d, t in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n int").repartition(5)
    check_packing(packed(df), texts)
    check_packing(packed(df, weights={"a": 0.2, "b": 0.7, None: 0.1}), texts)
    check_packing(packed(df, max_queues=1), texts)


def test_windows_hold_the_mixture(spark):
    rows = [(i, "alpha beta gamma " * 20, "a" if i % 4 else "b") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = pack(df, BPE, width=64, window=8, unit=8).collect()
    windows = Counter()
    for r in found:
        windows[r["sequence_id"] // 8, "a" if r["doc_id"] % 4 else "b"] += r["length"]
    last = max(w for w, _ in windows)
    assert all(abs(windows[w, "b"] / 512 - 0.25) < 0.05 for w in range(last - 1))


def test_small_sources_of_a_shared_queue_come_evenly(spark):
    texts = [(i, "alpha beta gamma " * (1 + i % 9)) for i in range(3000)] + [(4000, "delta " * 3000), (4001, None)]
    sources = {d: f"s{d % 2}" if d < 1500 else f"t{d % 40}" for d, _ in texts} | {4001: None}
    rows = [(d, t, sources[d]) for d, t in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    found = pack(df, BPE, width=64, window=8, unit=16, max_queues=2).collect()
    check_packing(packed(df, max_queues=2), texts)
    end = max(r["sequence_id"] for r in found) + 1
    for source in [f"t{i}" for i in range(40)]:
        mine = [r for r in found if sources[r["doc_id"]] == source]
        total = sum(r["length"] for r in mine)
        for part in (0.25, 0.5, 0.75):
            early = sum(r["length"] for r in mine if r["sequence_id"] < part * end)
            assert abs(early - part * total) < 100, (source, part, early, total)


def test_packing_repeated_rows_and_no_rows(spark):
    schema = "doc_id long, text string, source string"
    rows = packed(spark.createDataFrame([(1, "same text", "s")] * 3 + [(None, "x", "s")], schema))
    check_packing(rows, [(1, "same text")] * 3 + [(None, "x")])
    assert packed(spark.createDataFrame([], schema)) == []


def test_packing_tiny_and_weightless_sources(spark):
    import pyarrow as pa

    from tidemark.llm.packing import Rounds, _cut

    texts = [(i, "word " * (i % 37)) for i in range(60)]
    df = spark.createDataFrame([(d, t, "ab"[d % 2]) for d, t in texts], "doc_id long, text string, source string")
    rows = packed(df, weights={"a": 1.0, "b": 0.0})
    check_packing(rows, texts)
    ordered = sorted((r[5], r[6], "ab"[r[0] % 2]) for r in rows)
    assert [s for *_, s in ordered] == sorted(s for *_, s in ordered)
    check_packing(packed(df, weights={"b": 1.0}, max_queues=1), texts)
    # A source of 1,000 tokens beside 10**12: millions of windows lie between its units.
    rounds = Rounds([10**12, 1000], [1 << 30, 1], 64)
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded_length"]
    schema = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in names])
    row = pa.RecordBatch.from_pydict({"doc_id": [1], "q": [1], "place": [0], "n": [1000], "ids": [b"abcd" * 1000]})
    found = pa.Table.from_batches(list(_cut(rounds, 1024, 10**12 + 1000, schema)([row]))).to_pydict()
    assert found["start"][0] == 0 and sum(found["length"]) == 1000 and len(found["start"]) < 40


# --- pieces ----------------------------------------------------------------------------------------------------------


def test_pieces_spans_and_decoding(spark):
    texts = [*ODD, None, "Zwei  Wörter\nund 3 Zeilen " * 400]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = {r["doc_id"]: r for r in encode_pieces(df, PIECES).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        text, r = text or "", found[i]
        assert r["ids"] == library.encode(text, add_eos=True) and r["decoded"] == library.decode(r["ids"])
        data, at = text.encode(), 0
        for number, begin, end in zip(r["ids"], r["begins"], r["ends"], strict=True):
            assert begin == at and end >= begin
            piece, at = library.id_to_piece(number), end
            if re.fullmatch("<0x[0-9A-F]{2}>", piece) and library.is_byte(number):
                assert data[begin:end] == bytes([int(piece[3:5], 16)])
            elif not library.is_control(number):
                want = piece.replace("▁", " ").encode()
                assert data[begin:end].replace("▁".encode(), b" ") in (want, want[1:] if begin == 0 else want)
        assert at == len(data)
    assert encode_pieces(spark.createDataFrame([], "doc_id long, text string"), PIECES).collect() == []


def compiled(entries):
    """A double-array trie for a few prefixes, laid out by hand: units hold child offset, leaf flag and label."""
    units, pool, used, bases = [0] * 4096, b"", {0}, set()
    tree = {}
    for key, value in entries.items():
        node = tree
        for byte in key:
            node = node.setdefault(byte, {})
        node[None] = len(pool)
        pool += value + b"\0"

    def place(node, at):
        labels = [k for k in node if k is not None]
        wanted = [*labels, *([0] if None in node else [])]
        base = next(b for b in range(1, 1000) if b not in bases and all((b ^ k) not in used for k in wanted))
        bases.add(base)
        offset = base ^ at
        units[at] |= (offset << 10) | (0x100 if None in node else 0)
        used.update(base ^ k for k in labels)
        if None in node:
            used.add(base)
            units[base] = node[None] | 0x80000000
        for k in labels:
            units[base ^ k] = k
            place(node[k], base ^ k)

    place(tree, 0)
    blob = np.array(units, "<u4").tobytes()
    return np.array([len(blob)], "<u4").tobytes() + blob + pool


def test_longest_prefixes_and_their_source():
    model = Model(PIECES)
    model.map = CharacterMap(compiled({b"ab": b"X", b"abc": b"YZ", "é".encode(): b"e", b"-": b" "}))
    assert list(model.map.parts("abcabé-q".encode())) == [(0, 3, b"YZ"), (3, 5, b"X"), (5, 7, b"e"), (7, 8, b" "), (8, 9, b"q")]
    length, source = model.normalise("abcabé-q".encode())
    assert length == 3 + 2 + 1 + 1 + 3 + 1
    assert source.tolist() == [0, 0, 0, 0, 0, 3, 5, 7, 7, 7, 8, 9]
    model.squeeze = True
    length, source = model.normalise(b"  q -- ab  ")
    assert (length, source.tolist()) == (3 + 1 + 3 + 1, [2, 2, 2, 2, 3, 3, 3, 7, 9])
    with pytest.raises(ValueError):
        spans(model, b"abc", np.array([5]))


# --- rules -----------------------------------------------------------------------------------------------------------


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


GOOD = "\n".join(" ".join(f"word{i}x{j}" for j in range(9)) + " ends here." for i in range(8))


@pytest.mark.parametrize(
    ("text", "kept"),
    [
        (GOOD, True),
        (GOOD + "\nHome About Contact\nAll rights reserved.\nx | y | z | w", True),
        ("\n".join(f"w{i} | v{i} | u{i} | t{i} | s{i}" for i in range(30)), False),
        (" ".join(f"w{i}%%%%" for i in range(80)) + ".", False),
        ("spam ham eggs " * 40, False),
        (None, False),
        ("", False),
    ],
)
def test_rules_judge_lines_first(spark, text, kept):
    (row,) = quality_rules(spark.createDataFrame([(1, text, "old")], "doc_id long, text string, kept string")).collect()
    assert row["kept"] is kept
    assert tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == brute_rules(text)
    assert row["cleaned"] == (GOOD if kept else row["cleaned"])


def test_rule_counts_on_odd_texts(spark):
    texts = ["a b c a b c a b", "a a a a", "x\x0by\x1cz w v", "\n\n a\n a\n", "é*#\n" * 3, "w " * 50_000, *ODD]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] * 2, "doc_id long, text string")
    for r in quality_rules(df).where("not kept").collect():
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == brute_rules(texts[r["doc_id"]])
    assert quality_rules(df.limit(0)).collect() == []


# --- classifier ------------------------------------------------------------------------------------------------------


def test_classifier_on_held_out_rows(spark):
    rng = np.random.default_rng(2)
    nice, junk = [f"nice{i}" for i in range(60)], [f"junk{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(junk if i % 3 == 0 else nice, 40)), i % 3) for i in range(600)] + [(7000, None, 0), (7001, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(k > 0)) for i, _, k in rows[:600]] + [(None, 1), (5, None)], "doc_id long, quality int")
    scored = fit_quality(docs, labels).score(docs, keep_text=False).withColumn("held", held_out("doc_id")).collect()
    assert len(scored) == 602 and all(0 <= r["score"] <= 1 for r in scored)
    held = [r for r in scored if r["held"] and r["doc_id"] < 600]
    assert len(held) > 80 and np.mean([r["predicted"] == int(r["doc_id"] % 3 > 0) for r in held]) > 0.95
    again = fit_quality(docs.repartition(3), labels).score(docs).collect()
    assert {r["doc_id"]: round(r["score"], 6) for r in again} == {r["doc_id"]: round(r["score"], 6) for r in scored}


def test_classifier_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "x", 0)], "doc_id long, text string, n int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in fit_quality(docs, none).score(docs).collect()] == [0.5]
    assert fit_quality(docs.limit(0), none).score(docs.limit(0)).collect() == []


# --- chat ------------------------------------------------------------------------------------------------------------


def cheapest(roles):
    best = {0: 0.0}
    for role in roles:
        then = {}
        for state, cost in best.items():
            for a, b, more, *_ in chat.MOVES[role]:
                if a == state:
                    then[b] = min(then.get(b, 1e9), cost + more)
        best = then
    return min(c for s, c in best.items() if s in chat.FINAL)


def test_every_short_conversation_is_repaired_at_least_cost(spark):
    names = ["system", "user", "assistant", None]
    every = [p for n in (1, 2, 3, 4) for p in itertools.product(names, repeat=n)]
    rows = [(c, t, r, f"{c}.{t}", 0.5) for c, p in enumerate(every) for t, r in enumerate(p)]
    rows += [(9000, t, "user" if t % 2 else "assistant", None, 0.5) for t in range(2000)]
    rows += [(9001, None, "tool", "a", 0.5), (9001, 1, " USER ", "b", 0.5), (9001, 1, " USER ", "b", 0.5), (None, 1, "user", "q", 0.5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, cost double")
    found = {}
    for r in format_chat(df).collect():
        found.setdefault(r["conv_id"], []).append(r)
    assert sum(map(len, found.values())) == len(rows)
    for conv, messages in found.items():
        messages.sort(key=lambda r: (r["part"], r["pos"]))
        roles = [chat._number(r["role"]) for r in messages]
        assert sum(r["cost"] for r in messages) == pytest.approx(cheapest(roles)), conv
        text = "".join(r["rendered"] for r in messages)
        turns = re.findall(r"<\|im_start\|>(\w+)\n", text)
        state = 0
        for role in turns:
            assert chat.ROLES.index(role) + 1 in chat.LEGAL[state]
            state = chat.ROLES.index(role) + 1
        assert state in chat.FINAL and text.count("<|im_end|>\n") == len(turns) == messages[-1]["out_turn"] + 1
        assert all((r["text"] if "text" in r else "") in text for r in messages)
    assert len({r["part"] for r in found[9000]}) >= 1
    assert format_chat(df.limit(0)).collect() == []


def test_chunks_of_one_conversation_meet(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", str(t)) for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = sorted(format_chat(df).collect(), key=lambda r: (r["part"], r["pos"]))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r["part"] for r in found}) > 1 and [r["turn"] for r in found] == list(range(300))
    assert sum(r["cost"] for r in found) == pytest.approx(cheapest([chat._number(r["role"]) for r in found]))
    assert found[-1]["out_turn"] + 1 == "".join(r["rendered"] for r in found).count("<|im_start|>")


# --- licences --------------------------------------------------------------------------------------------------------


def test_licences_by_paragraph(spark):
    prose = "\n".join(f"Line {i} speaks of rivers, fields and number {i * 31}." for i in range(50))
    texts = {
        1: f"{prose}\nReleased under the MIT License.",
        2: f"Licensed under the Apache License, Version 2.0.\n{prose}",
        3: "This work is licensed under the GNU General Public License, version 3.\n\nLicensed under CC BY-NC 4.0.",
        4: prose,
        5: "",
        6: None,
        7: "A driving license is needed here.\nthe public of the work is in the field",
    }
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, line string")
    found = sorted((r["doc_id"], r["paragraph"], r["family"]) for r in scan_licences(df).collect() if r["confirmed"])
    assert found == [(1, 50, "mit"), (2, 0, "apache-2.0"), (3, 0, "gpl-3.0"), (3, 2, "cc-by-nc")]
    assert scan_licences(df.limit(0)).collect() == []


def test_licences_of_whole_and_wrapped_paragraphs(spark):
    gpl = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
    notices = {
        "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "gpl-2.0": gpl.format(2).replace("software:", "software;"),
        "gpl-3.0": gpl.format(3),
    }
    prose = "\n".join(f"Row {i} speaks of rivers, fields and number {i * 31}." for i in range(20))
    rows, want = [], []
    for i, (family, notice) in enumerate(notices.items()):
        wrapped = "\n".join(f" * {x}" for x in textwrap.wrap(notice, 75))
        rows += [(3 * i, f"{prose}\n{notice}"), (3 * i + 1, f"{prose}\n{wrapped}\n{prose}"), (3 * i + 2, f"Title\n\n{wrapped}")]
        want += [(3 * i, 20, family), (3 * i + 1, 20, family), (3 * i + 2, 2, family)]
    found = scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["paragraph"], r["family"]) for r in found if r["confirmed"]) == want


# --- archive ---------------------------------------------------------------------------------------------------------


def test_archive_round_trip(spark):
    rows = [(1, "http://a", "<p>x</p>"), (5, "http://b\r\nWARC-Type: fake", "<p>x</p>"), (3, None, "é"), (-4, "u", None), (-9, "v", ""), (2**62, "w", "big")]
    rows += [(7, "t", "twice"), (7, "t", "twice"), (None, "n", "<p>x</p>"), (None, "m", "alone"), (8, "l", "z" * 300_000)]
    df = spark.createDataFrame([(a, b, c, "d") for a, b, c in rows], "page_id long, url string, html string, digest string")
    folder = archive_folder(spark)
    write_archive(df, folder)
    found = read_archive(spark, folder).collect()
    largest = {}
    for page, _, html in rows:
        data = (html or "").encode()
        largest[data] = max(largest.get(data, -(2**63)), -(2**63) if page is None else page)
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        response = page == largest[data] or (page is None and largest[data] == -(2**63))
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((str(page), len(data), digest, "response" if response else "revisit", None if response else largest[data], data))
    got = [(str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], bytes(r["payload"])) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    for r in found:
        head, body = bytes(r["record"]).split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.1\r\n") and head.count(b"WARC-Type") + head.count(b"%0D%0AWARC-Type") >= 1
        assert int(re.search(rb"Content-Length: (\d+)", head)[1]) == len(body) - 4
        assert b"\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n" in head + b"\r\n" and b"\r\nWARC-Record-ID: <urn:uuid:" in head
        if r["record_type"] == "response":
            http, body = body.split(b"\r\n\r\n", 1)
            assert http.startswith(b"HTTP/1.1 200 OK\r\n") and int(re.search(rb"Content-Length: (\d+)", http)[1]) == len(r["payload"])
            assert b"Content-Type: application/http; msgtype=response" in head
        assert body == (bytes(r["payload"]) if r["record_type"] == "response" else b"") + b"\r\n\r\n"
    assert spark.read.parquet(f"{folder}/payloads").count() == len(largest)


def test_small_payloads_are_responses_and_no_rows(spark):
    schema = "page_id long, url string, html string"
    folder = archive_folder(spark)
    write_archive(spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy")], schema), folder, least=3)
    assert {r["record_type"] for r in read_archive(spark, folder).collect()} == {"response"}
    empty = archive_folder(spark)
    write_archive(spark.createDataFrame([], schema), empty)
    assert read_archive(spark, empty).collect() == []

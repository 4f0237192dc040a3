"""Repeated passages: anchors bring equal passages together, an enhanced suffix array finds the maximal repeats."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, slices

#: Bytes of context that one suffix array takes; a group of contexts is never cut.
BLOCK = 2 << 20


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column, and where each value begins (with the end at last)."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), offsets


def _sliding(op, x: np.ndarray, width: int) -> np.ndarray:
    """``op`` over every window of ``width`` values, by doubling."""
    reach, span = x, 1
    while 2 * span <= width:
        reach, span = op(reach[:-span], reach[span:]), 2 * span
    return reach if span == width else op(reach[: len(x) - width + 1], reach[width - span : width - span + len(x) - width + 1])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, size: int) -> np.ndarray:
    """Positions of the k-grams of ``size`` bytes that some window of ``length`` bytes of one document picks.

    A window picks those of its k-grams with the smallest hash (all, if there are ties), so that equal windows pick
    alike, wherever they are.
    """
    begin, end = int(offsets[0]), int(offsets[-1])
    wide, window = 32, length - size + 1
    n = end - begin
    if n < length:
        return np.empty(0, np.int64)
    mixed = np.random.default_rng(7).integers(1, 1 << 32, 256, np.uint32)
    h, span = mixed[data[begin:end]], 1
    while span < wide:
        h = h[:-span] * np.uint32((0x9E3779B1 + 2 * span * span) & 0xFFFFFFFF) + h[span:]
        span *= 2
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA77)
    h ^= h >> np.uint32(13)
    h |= np.uint32(1)
    h = np.concatenate([h, np.full(n - len(h), 0xFFFFFFFF, np.uint32)])
    low = _sliding(np.minimum, h, window)[: n - length + 1]
    inside = np.zeros(len(low), bool)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= length:
            inside[a - begin : b - begin - length + 1] = True
    low[~inside] = 0
    padded = np.concatenate([np.zeros(window - 1, np.uint32), low, np.zeros(window - 1, np.uint32)])
    high = _sliding(np.maximum, padded, window)
    return np.flatnonzero(high == h[: len(high)]) + begin


def _anchor_rows(length: int, size: int, schema: pa.Schema):
    """Rows (anchor, context, key, place): digests of the k-gram and of all bytes that a window with it can have."""
    side = length - size

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                data, offsets = flat(part["text"])
                at = anchors(data, offsets, length, size)
                doc = np.searchsorted(offsets, at, "right") - 1
                low = np.maximum(at - side, offsets[doc])
                high = np.minimum(at + length, offsets[doc + 1])
                view = memoryview(data)
                gram = [digest(view[p : p + size]) for p in at.tolist()]
                around = [
                    digest(view[a:b], seed=p - a)
                    for a, p, b in zip(low.tolist(), at.tolist(), high.tolist(), strict=True)
                ]
                place = ((at - offsets[doc]) << 16) + ((high - at) & 0xFFFF)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array(gram, np.uint64).view(np.int64)),
                        pa.array(np.array(around, np.uint64).view(np.int64)),
                        part["key"].take(pa.array(doc)),
                        pa.array(place),
                    ],
                    schema=schema,
                )

    return run


def _contexts(length: int, size: int, schema: pa.Schema):
    side = length - size

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = flat(part["text"])
                rows = part["asked"].to_pylist()
                out = [[], [], [], [], []]
                for key, begin, asked in zip(part["key"].to_pylist(), offsets.tolist(), rows, strict=False):
                    for one in asked:
                        at, right = one["place"] >> 16, one["place"] & 0xFFFF
                        low = max(0, at - side)
                        values = (one["anchor"], key, low, at - low, data[begin + low : begin + at + right].tobytes())
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
                columns = [pa.array(c, f.type) for c, f in zip(out, schema, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the ``length`` bytes from every position on; those that reach past the end mean nothing."""
    mixed = np.random.default_rng(3).integers(0, 1 << 64, 256, np.uint64)
    n, span, power = len(data), 1, mixed[data]
    whole, done = np.zeros(n, np.uint64), 0
    while span <= length:
        raised = np.uint64(pow(0x9E3779B97F4A7C15, span, 1 << 64))
        if length & span:
            # The strings of `done` bytes from here on, followed by `span` more.
            later = power[done:]
            whole = whole * raised + np.concatenate([later, np.zeros(n - len(later), np.uint64)])
            done += span
        power, span = power[: max(0, len(power) - span)] * raised + power[span:], 2 * span
    return whole


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differs = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differs.argmax()) if differs.any() else n


def intervals(lcp: list[int], least: int):
    """Intervals (lcp value, first, last) of the common-prefix tree with a value of at least ``least``.

    ``lcp[i]`` is the common prefix of entries ``i`` and ``i + 1``. A stack holds the open intervals.
    """
    stack = []
    for i, value in enumerate([*lcp, 0]):
        first = i
        while stack and stack[-1][0] > value:
            depth, first = stack.pop()
            if depth >= least:
                yield depth, first, i
        if not stack or stack[-1][0] < value:
            stack.append((value, first))


def maximal_repeats(texts: list[bytes], groups: np.ndarray, keys: np.ndarray, lows: np.ndarray, length: int):
    """Maximal repeats of at least ``length`` bytes among texts of one group: arrays (begin, end) per occurrence.

    Yields (repeat length, text numbers, begins in the documents). Two texts may overlap in a document: a place counts
    once, in the text that goes on longest. A repeat is maximal if its occurrences don't all have the same byte before
    them.

    The suffix array is built bucket by bucket: suffixes that agree in group and hash of the first ``length`` bytes
    stand together, and buckets whose suffixes all have the same byte before them are left out at once, as their
    repeats begin further left. The others are sorted by their bytes, with the common prefixes of neighbours.
    """
    buffer = b"".join(texts)
    data = np.frombuffer(buffer, np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    begins, owner = ends - sizes, np.repeat(np.arange(len(texts)), sizes)
    at = np.flatnonzero(np.arange(len(data)) + length <= ends[owner])
    code = window_hashes(data, length)[at] ^ (groups[owner[at]].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    order = np.argsort(code)
    at, code = at[order], code[order]
    same = code[1:] == code[:-1]
    first = np.flatnonzero(same & ~np.concatenate([[False], same[:-1]]))
    last = np.flatnonzero(same & ~np.concatenate([same[1:], [False]])) + 1
    if not len(first):
        return
    before = np.where(at == begins[owner[at]], -1 - np.arange(len(at)), data[at - 1].astype(np.int64))
    cuts = np.stack([first, last + 1], axis=1).ravel()
    padded = np.append(before, 0)
    low, high = np.minimum.reduceat(padded, cuts)[::2], np.maximum.reduceat(padded, cuts)[::2]
    diverse = (low < 0) | (low != high)
    for a, b in zip(first[diverse].tolist(), last[diverse].tolist(), strict=True):
        longest = {}
        for p, left in zip(at[a : b + 1].tolist(), before[a : b + 1].tolist(), strict=True):
            text = int(owner[p])
            place = int(keys[text]), int(lows[text] + p - begins[text])
            known = longest.get(place)
            if known is None or ends[text] - p > len(known[0]):
                longest[place] = (buffer[p : int(ends[text])], text, place[1], left)
        if len(longest) < 2:
            continue
        entries = sorted(longest.values())
        lcp = [common_prefix(x[0], y[0]) for x, y in zip(entries[:-1], entries[1:], strict=True)]
        for depth, i, j in intervals(lcp, length):
            lefts = {e[3] for e in entries[i : j + 1]}
            if len(lefts) > 1 or min(lefts) < 0:
                yield depth, np.array([e[1] for e in entries[i : j + 1]]), np.array([e[2] for e in entries[i : j + 1]])


def _spans(length: int, schema: pa.Schema):
    """One span per context: the union of the maximal repeats in it (all hold the anchor)."""

    def block(texts, groups, keys, lows):
        keys, lows = np.array(keys, np.int64), np.array(lows, np.int64)
        low, high = np.full(len(texts), 1 << 62), np.zeros(len(texts), np.int64)
        for depth, text, begin in maximal_repeats(texts, np.array(groups, np.int64), keys, lows, length):
            np.minimum.at(low, text, begin)
            np.maximum.at(high, text, begin + depth)
        hit = high > 0
        return pa.RecordBatch.from_arrays([pa.array(keys[hit]), pa.array(low[hit]), pa.array(high[hit])], schema=schema)

    def run(batches):
        held, size = [[], [], [], []], 0
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("bytes", "anchor", "key", "low")), strict=True)
            for row in rows:
                if size >= BLOCK and row[1] != held[1][-1]:
                    yield block(*held)
                    held, size = [[], [], [], []], 0
                for column, value in zip(held, row, strict=True):
                    column.append(value)
                size += len(row[0])
        if size:
            yield block(*held)

    return run


def _remove(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            out = [[], [], [], []]
            for text, begins, ends in zip(*(part[c].to_pylist() for c in ("text", "begins", "ends")), strict=True):
                kept, spans, done = [], 0, 0
                for a, b in sorted(zip(begins or (), ends or (), strict=True)):
                    if a > done or not spans:
                        kept.append(text[done:a])
                        spans += 1
                    done = max(done, b)
                kept = b"".join([*kept, text[done:]])
                for column, value in zip(out, (len(text), len(text) - len(kept), spans, kept), strict=True):
                    column.append(value)
            columns = [pa.array(c, t) for c, t in zip(out, (*[pa.int64()] * 3, pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([part["row"], *columns], ["row", "n_bytes", "n_removed", "n_spans", "kept"])


#: What the operator adds to a row.
COUNTED = ("n_bytes", "n_removed", "n_spans", "kept")


def remove_repeats(
    df: DataFrame, text_col: str = "text", length: int = 200, size: int = 96
) -> DataFrame:
    """All columns of ``df`` plus ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the bytes that stay).

    Every byte goes that is covered by a string of ``length`` bytes which also starts anywhere else, in the same row or
    another one; texts are taken as UTF-8, matches stay inside a row, and all are judged on the input.

    1. Every window of ``length`` bytes picks an anchor, a k-gram of ``size`` bytes, by its content alone. Equal
       windows so meet in the group of their anchor. The bytes around an anchor that such windows can have are its
       context.
    2. Contexts that occur twice are covered as a whole. Groups with one context only are done; the others send one
       copy of each context to a suffix array. A stack scan gives its common-prefix intervals; those whose occurrences
       differ in the byte before them are maximal repeats, and each occurrence is covered.
    3. The spans of a row are merged and cut out.

    Rows are told apart by a 64-bit hash of all that they hold; equal rows are each other's repeats. Null texts count
    as empty. Extra columns pass through, but for those named like the four of the result, which they replace. No rows
    give no rows.
    """
    side = length - size
    names = df.columns
    rows = df.select(
        F.xxhash64(*[x for i, c in enumerate(names) for x in (F.lit(i), F.col(f"`{c}`").cast("string"))]).alias("key"),
        F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "utf-8").alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in names if c != text_col and c not in COUNTED]).alias("row"),
    )
    numbers = [pa.field(c, pa.int64()) for c in ("anchor", "context", "key", "place")]
    found = rows.select("key", "text").where(F.length("text") >= length)
    found = found.mapInArrow(_anchor_rows(length, size, pa.schema(numbers)), "anchor long, context long, key long, place long")
    group = Window.partitionBy("anchor")
    found = found.withColumn("low", F.min("context").over(group)).withColumn("high", F.max("context").over(group))
    found = found.withColumn("same", F.count("*").over(Window.partitionBy("anchor", "context")))
    single = F.col("same") == 1
    found = found.where((F.col("low") != F.col("high")) | ~single)
    found = found.withColumn("first", F.row_number().over(Window.partitionBy("anchor", "context").orderBy("key", "place")) == 1)
    found = found.withColumn("open", F.max(single).over(group))
    found = materialise(found.select("anchor", "key", "place", "same", "first", "open"), "anchors")

    at, right = F.shiftright("place", 16), F.col("place").bitwiseAND(0xFFFF)
    whole = found.where("same > 1").select("key", F.greatest(F.lit(0), at - side).alias("begin"), (at + right).alias("end"))

    asked = found.where("open AND first").groupBy("key").agg(F.collect_list(F.struct("anchor", "place")).alias("asked"))
    context = pa.schema([*[pa.field(c, pa.int64()) for c in ("anchor", "key", "low", "at")], pa.field("bytes", pa.binary())])
    once = rows.where(F.length("text") >= length).groupBy("key").agg(F.first("text").alias("text"))
    contexts = once.join(asked, "key").mapInArrow(
        _contexts(length, size, context), "anchor long, key long, low long, at long, bytes binary"
    )
    contexts = contexts.repartition("anchor").sortWithinPartitions("anchor", "key", "low")
    span = pa.schema([pa.field(c, pa.int64()) for c in ("key", "begin", "end")])
    partial = contexts.mapInArrow(_spans(length, span), "key long, begin long, end long")
    # A set: equal rows name the same places, which then travel once.
    spans = whole.union(partial).groupBy("key").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    spans = spans.select("key", F.col("spans.begin").alias("begins"), F.col("spans.end").alias("ends"))
    spans = materialise(spans, "spans")

    joined = rows.join(spans, "key", "left").select("row", "text", "begins", "ends")
    row_type = joined.schema["row"].dataType.simpleString()
    out = joined.mapInArrow(_remove, f"row {row_type}, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(*[F.col("row")[c].alias(c) for c in names if c != text_col and c not in COUNTED], *COUNTED)

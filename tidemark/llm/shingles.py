"""Near-duplicate documents by PartEnum signatures over word shingles, verified on the whole shingle sets."""

from __future__ import annotations

from bisect import bisect_left
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Bounded, materialise, new_path, release, slices
from .components import connected_components

#: Subsets of SUB second-level partitions that leave out DROP of them are enumerated in every first-level partition.
SUB, DROP = 2, 1
#: Sizes of neighbouring bands grow by this factor.
GROWTH = 1.5
#: Members of a signature that are compared at a time.
BLOCK = 1024


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hasher() -> Bounded:
    return Bounded(xxhash.xxh3_64_intdigest)


def shingle_set(text: str | None, hashes: Bounded, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles (of the whole text if it has fewer words)."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    width = min(words, len(codes))
    rolled = np.full(len(codes) - width + 1, width, np.uint64)
    for i in range(width):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - width + 1 + i]
    return np.unique(_mix(rolled))


class Bands:
    """Size bands and, per band, the partitions of the hash domain for pairs inside it or reaching into the next.

    Similar sets differ in at most ``miss * (|s| + |t|)`` shingles, with miss = (1 - J) / (1 + J). Band ``i`` holds
    pairs of smaller size up to ``r_i``, so that ``k_i = miss * (1 + 1 / J) * r_i`` bounds their differences. More than
    ``k_i / (DROP + 1)`` first-level partitions leave one with at most DROP differences, and one of its enumerated
    subsets without any.
    """

    def __init__(self, percent: int):
        self.percent, self.tops, self.schemes = percent, [1], {}

    def of(self, size: int) -> list[int]:
        while self.tops[-1] < size:
            self.tops.append(max(self.tops[-1] + 1, int(self.tops[-1] * GROWTH)))
        band = bisect_left(self.tops, size)
        lower = band and size * self.percent <= 100 * self.tops[band - 1]
        return [band, band - 1] if lower else [band]

    def scheme(self, band: int):
        if band not in self.schemes:
            top, j = self.tops[band], self.percent
            k = top * (100 - j) * (100 + j) // ((100 + j) * j)
            first = int(0.8 * k) + 2 if k else 1
            edges = [(i << 64) // (first * SUB) for i in range(1, first * SUB)]
            self.schemes[band] = k, first, np.array(edges, np.uint64)
        return self.schemes[band]


#: Which second-level partitions each enumerated subset keeps.
KEPT = np.array([[i in kept for i in range(SUB)] for kept in combinations(range(SUB), SUB - DROP)])
#: Subsets that hold one given partition, and so change with one difference.
HOLDING = int(KEPT[:, 0].sum())


def signatures(hashes: np.ndarray, bands: Bands) -> tuple[np.ndarray, int]:
    """The set's signatures, and how many of them it shares at least with any set similar to it."""
    size, out, need = len(hashes), [], len(hashes)
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(hashes + np.uint64(1)), dtype=np.uint64)])
    unsure = False
    for band in bands.of(size):
        k, first, edges = bands.scheme(band)
        at = np.concatenate([[0], np.searchsorted(hashes, edges), [size]])
        filled = (at[1:] > at[:-1]).reshape(first, SUB)
        sums = (running[at[1:]] - running[at[:-1]]).reshape(first, SUB)
        projected = filled.astype(np.int64) @ KEPT.T.astype(np.int64) > 0
        values = np.stack([sums[:, kept].sum(axis=1, dtype=np.uint64) for kept in KEPT], axis=1)
        place = np.arange(first * len(KEPT), dtype=np.uint64).reshape(first, len(KEPT)) + np.uint64(band << 40)
        out.append(_mix(values + _mix(place + np.uint64(1)))[projected])
        # Of the first-level partitions at most k / (DROP + 1) have more than DROP differences; and each difference
        # changes at most HOLDING signatures. The rest is shared.
        sure = max(int(projected.all(axis=1).sum()) - k // (DROP + 1), int(projected.sum()) - k * HOLDING)
        unsure |= sure < 1
        need = min(need, max(1, sure))
    if unsure:  # too many empty partitions for the guarantee: every shingle is a signature as well
        out.append(_mix(hashes ^ np.uint64(0x5851F42D4C957F2D)))
    return np.concatenate(out).view(np.int64), need


FEATURES = [("doc_id", pa.int64()), ("size", pa.int64()), ("node", pa.int64()), ("need", pa.int64())]


def _digest(shingles: np.ndarray) -> int:
    return int(_mix(shingles + np.uint64(3)).sum(dtype=np.uint64).view(np.int64)) if len(shingles) else 0


def _sign(words: int, percent: int, schema: pa.Schema):
    """One row per document with its set's size and digest; the first of each digest in a task also lists signatures."""

    def run(batches):
        hashes, bands, seen = word_hasher(), Bands(percent), Bounded(lambda key: [])
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [[] for _ in FEATURES]
                found = []
                for doc, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    shingles = shingle_set(text, hashes, words)
                    node, need, own = _digest(shingles), 0, np.empty(0, np.int64)
                    if len(shingles) and doc is not None and not seen[node]:
                        seen[node].append(doc)
                        own, need = signatures(shingles, bands)
                    for column, value in zip(rows, (doc, len(shingles), node, need), strict=True):
                        column.append(value)
                    found.append(own)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in found])])
                values = pa.array(np.concatenate(found)) if found else pa.array([], pa.int64())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                columns = [pa.array(c, t) for c, (_, t) in zip(rows, FEATURES, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, lists], schema=schema)

    return run


def histogram(shingles: np.ndarray) -> bytes:
    """Counts (255: that or more) over equal ranges of the hash domain, about one shingle to a range."""
    bits = min(14, max(6, len(shingles).bit_length()))
    counts = np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def most_common(a: bytes, b: bytes) -> int:
    """No two sets with these histograms have more shingles in common."""
    x, y = (np.frombuffer(h, np.uint8).astype(np.int64) for h in (a, b))
    x[x == 255], y[y == 255] = 1 << 40, 1 << 40
    n = min(len(x), len(y))
    return int(np.minimum(x.reshape(n, -1).sum(axis=1), y.reshape(n, -1).sum(axis=1)).sum())


def _sets(words: int, schema: pa.Schema):
    def run(batches):
        hashes = word_hasher()
        for batch in batches:
            for part in slices(batch, "text"):
                found = [shingle_set(text, hashes, words) for text in part["text"].to_pylist()]
                columns = [
                    pa.array([_digest(x) for x in found], pa.int64()),
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.array([histogram(x) for x in found], pa.binary()),
                    pa.array([x.tobytes() for x in found], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _possible(percent: int, schema: pa.Schema):
    """Pairs whose histograms leave room for enough common shingles."""

    def run(batches):
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("hist_a", "hist_b", "size_a", "size_b"))
            keep = []
            for i, (x, y, m, n) in enumerate(zip(*columns, strict=True)):
                common = min(most_common(x, y), m, n)
                if 100 * common >= percent * (m + n - common):
                    keep.append(i)
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["a"].take(keep), batch["b"].take(keep)], schema=schema)

    return run


def _verify(percent: int, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch["shingles_a"], batch["shingles_b"], strict=True)):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                s, t = (s, t) if len(s) <= len(t) else (t, s)
                at = np.searchsorted(t, s)
                common = int((t[np.minimum(at, len(t) - 1)] == s).sum()) if len(t) else 0
                if common and 100 * common >= percent * (len(s) + len(t) - common):
                    keep.append(i)
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["a"].take(keep), batch["b"].take(keep)], schema=schema)

    return run


def common_at_most(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``most_common`` of every row of counts ``a`` with every row of ``b``.

    Small counts are spelled as steps (1 or more, 2 or more, ..), of which two rows share the sum of their minima: one
    matrix product per step.
    """
    top = int(min(a.max(initial=0), b.max(initial=0)))
    if top > 8:
        return np.stack([np.minimum(row, b).sum(axis=1, dtype=np.int64) for row in a])
    out = np.zeros((len(a), len(b)), np.float32)
    for step in range(1, top + 1):
        out += (a >= step).astype(np.float32) @ (b >= step).astype(np.float32).T
    return out.astype(np.int64)


def _counts(histograms: list[bytes]) -> np.ndarray:
    """Histograms as rows over the ranges of the coarsest one; a full count has no bound."""
    width = min(map(len, histograms))
    out = np.empty((len(histograms), width), np.int32)
    for row, h in zip(out, histograms, strict=True):
        counts = np.frombuffer(h, np.uint8).astype(np.int32)
        counts[counts == 255] = 1 << 24
        np.minimum(counts.reshape(width, -1).sum(axis=1), 1 << 24, out=row)
    return out


def _across(percent: int, schema: pa.Schema):
    """Pairs of one bundle from different components whose histograms leave room for enough common shingles.

    A group holds whole bundles, or two blocks of one (or a block with itself). Only what passes leaves the task.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("low")
        low, node, size, component, block, p, q = (table[c].to_numpy() for c in ("low", "node", "size", "component", "block", "p", "q"))
        hist, found = table["hist"].to_pylist(), [np.empty((2, 0), np.int64)]
        cuts = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1, [len(low)]])
        for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            same = p[begin] == q[begin]
            left = begin + np.flatnonzero(same | (block[begin:end] == p[begin]))
            right = left if same else begin + np.flatnonzero(block[begin:end] == q[begin])
            if not len(left) or not len(right):
                continue
            counts = _counts(hist[begin:end])
            common = common_at_most(counts[left - begin], counts[right - begin])
            m, n = size[left][:, None], size[right]
            common = np.minimum(common, np.minimum(m, n))
            keep = (100 * common >= percent * (m + n - common)) & (component[left][:, None] != component[right])
            i, j = np.nonzero(np.triu(keep) if same else keep)
            found.append(np.stack([node[left[i]], node[right[j]]]))
        pairs = np.unique(np.sort(np.concatenate(found, axis=1), axis=0), axis=1)
        return pa.table([pa.array(pairs[0]), pa.array(pairs[1])], schema=schema)

    return run


def ngram_jaccard(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (smallest id reachable over pairs with Jaccard >= percent / 100).

    1. One pass over the texts gives every set's size and 64-bit digest, and its PartEnum signatures once per digest
       and task. Documents with equal digests are one class; all that follows works on classes.
    2. Signatures of one class only go; so do classes with fewer shared signatures than any similar set would share
       with them (``need``, which follows from the number of non-empty partitions). Of the others each leaves out its
       ``need - 1`` most frequent signatures: two sets that share ``need`` still share one of the rest, as all take the
       same order. Passages that many documents share so seldom bring them together, and nothing similar is lost.
    3. In every signature's group each member is paired with one leader; repeated pairs are removed, and so are those
       whose hash histograms rule out enough common shingles; the rest is verified on the whole sets. Groups that are one
       component by then are done. Others get other leaders, three times in all.
    4. What is still open is compared in blocks of at most about BLOCK members: matrix products over the histograms bound
       the shingles that two members have in common, and only pairs across components that the bound leaves are given
       out and verified. So no link is missed, and pairs of unlike texts on a common passage never become rows. The
       products of such a group still grow with its square.

    Words are split at ASCII white space, A-Z is lower-cased. Texts with fewer words than a shingle are one shingle;
    null or empty texts and texts without words have none and link with nothing, as do rows with a null id (their
    component is null). Components are made of texts: of an id that repeats with different texts every row has the
    component of its own text, and repeated rows share one. Other columns are ignored.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    arrow = pa.schema([*FEATURES, ("sigs", pa.list_(pa.int64()))])
    plain = "doc_id long, size long, node long, need long"
    signed = rows.mapInArrow(_sign(words, percent, arrow), f"{plain}, sigs array<long>")
    path = new_path(df, "signed")
    signed = materialise(signed, "signed", path)
    docs = materialise(signed.select("doc_id", "size", "node", "need"), "sizes")

    group = Window.partitionBy("sig")
    sigs = signed.where("need > 0").select("node", F.explode("sigs").alias("sig"))
    shared = sigs.withColumn("low", F.min("node").over(group)).withColumn("high", F.max("node").over(group))
    shared = materialise(shared.where("low <> high").select("sig", "node").distinct(), "shared")
    release(signed, path)

    classes = docs.where("size > 0 AND doc_id IS NOT NULL").groupBy("node")
    classes = classes.agg(F.min("doc_id").alias("rep"), F.max("size").alias("size"), F.max("need").alias("need"))
    own = Window.partitionBy("node")
    counted = shared.withColumn("often", F.count("*").over(group)).join(classes, "node")
    counted = counted.withColumn("got", F.count("*").over(own))
    counted = counted.withColumn("place", F.row_number().over(own.orderBy(F.desc("often"), "sig")))
    rare = counted.where("got >= need AND place >= need")
    rare = rare.withColumn("low", F.min("node").over(group)).withColumn("high", F.max("node").over(group))
    member = materialise(rare.where("low <> high").select("sig", "node", "size", "rep"), "members")
    asked = materialise(member.select(F.col("rep").alias("doc_id")).distinct(), "asked")
    member = member.drop("rep").withColumn("component", F.col("node"))
    schema = pa.schema([("node", pa.int64()), ("size", pa.int64()), ("hist", pa.binary()), ("shingles", pa.binary())])
    sets = rows.join(asked, "doc_id", "left_semi")
    sets = sets.mapInArrow(_sets(words, schema), "node long, size long, hist binary, shingles binary")
    sets = materialise(sets.dropDuplicates(["node"]), "sets")

    near = F.expr(f"100 * least(size_a, size_b) >= {percent} * greatest(size_a, size_b)")
    pair = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def beside(pairs: DataFrame, *names: str) -> DataFrame:
        """Pairs with columns of both sets."""
        for side in "ba":
            own = sets.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in names])
            pairs = pairs.join(own, side)
        return pairs

    def in_blocks(member: DataFrame) -> DataFrame:
        """Pairs that may be similar and share a signature.

        Signatures with the same smallest member are one bundle, in which every member stands once: groups of much the
        same members have it in common, so that their pairs are compared once. Small bundles share a task, large ones
        are cut into blocks.
        """
        bundles = member.withColumn("low", F.min("node").over(group)).groupBy("low", "node")
        bundles = bundles.agg(F.max("size").alias("size"), F.max("component").alias("component"))
        bundles = materialise(bundles, "bundles")
        blocks = bundles.groupBy("low").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        tasks = F.lit(max(1, bundles.count() // BLOCK))
        placed = bundles.join(blocks, "low").join(sets.select("node", "hist"), "node")
        placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        task = F.when(F.col("blocks") > 1, F.col("low")).otherwise(F.pmod(F.xxhash64("low"), tasks))
        placed = placed.withColumns({"p": F.least("block", "other"), "q": F.greatest("block", "other"), "task": task, "alone": F.col("blocks") > 1})
        columns = ["alone", "task", "p", "q", "low", "node", "size", "component", "block", "hist"]
        return placed.select(columns).groupBy("alone", "task", "p", "q").applyInArrow(_across(percent, pair), "a long, b long")

    def verified(pairs: DataFrame, bounded: bool) -> DataFrame:
        if not bounded:
            pairs = beside(pairs, "hist", "size").mapInArrow(_possible(percent, pair), "a long, b long").distinct()
            pairs = materialise(pairs, "possible")
        possible = beside(pairs, "shingles")
        return possible.mapInArrow(_verify(percent, pair), "a long, b long").distinct()

    # From turn to turn only the members of groups that are not yet one component go on.
    edges, labels, tried = None, None, None
    for turn in range(4):
        if labels is not None:
            known = labels.select("node", F.col("component").alias("now"))
            member = member.join(known, "node", "left").withColumn("component", F.coalesce("now", "component")).drop("now")
        member = member.withColumn("low", F.min("component").over(group)).withColumn("high", F.max("component").over(group))
        member = materialise(member.where("low <> high").select("sig", "node", "size", "component"), "open")
        if turn < 3:
            order = F.xxhash64("node", F.lit(turn))
            lead = F.first(F.struct("node", "size", "component")).over(group.orderBy(order, "node"))
            pairs = member.withColumn("lead", lead).where("lead.component <> component")
            pairs = pairs.select("node", "size", F.col("lead.node").alias("other"), F.col("lead.size").alias("other_size"))
            pairs = pairs.select(
                F.least("node", "other").alias("a"),
                F.greatest("node", "other").alias("b"),
                F.col("size").alias("size_a"),
                F.col("other_size").alias("size_b"),
            )
            pairs = pairs.where(near).select("a", "b").distinct()
        else:
            pairs = materialise(in_blocks(member), "blocks").distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        tried = pairs if tried is None else tried.union(pairs)
        links = materialise(verified(pairs, turn == 3), "links")
        edges = links if edges is None else edges.union(links)
        labels = materialise(connected_components(edges), "labels")

    reps = classes.select("node", "rep").join(labels, "node", "left")
    reps = reps.select("node", "rep", F.coalesce("component", "node").alias("component"))
    smallest = reps.groupBy("component").agg(F.min("rep").alias("smallest"))
    names = materialise(reps.join(smallest, "component").select("node", "smallest"), "names")
    out = docs.join(names, "node", "left")
    return out.select(
        F.col("doc_id").alias(id_col),
        F.col("size").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull() & (F.col("size") > 0), F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"),
    )

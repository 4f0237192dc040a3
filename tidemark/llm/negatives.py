"""Hard negatives by angular triangle filtering: angles to reference directions bound every inner product."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

#: Rows of a block and anchors of a block: what a task holds at a time.
ROWS, ANCHORS = 8192, 8192
#: Rows whose angles are bounded together, and anchors that go over a block together.
LEAF, TOGETHER = 32, 128
#: Angles are taken to be exact to SLACK; products to a share of ROUND.
SLACK, ROUND = 1e-7, 1e-9
NONE = -(1 << 62)


def reference_directions(vectors: list[np.ndarray], dim: int, number: int) -> np.ndarray:
    """Unit rows, each the sample's vector farthest from those before; random ones where the sample has no more."""
    chosen = np.random.default_rng(dim).standard_normal((number, max(1, dim)))[:, :dim]
    sample = [v for v in vectors if np.any(v)]
    if sample:
        sample = np.array(sample, np.float64)
        sample /= np.linalg.norm(sample, axis=1, keepdims=True)
        closest = np.full(len(sample), -1.0)
        at = 0
        for i in range(min(number, len(sample))):
            chosen[i] = sample[at]
            closest = np.maximum(closest, sample @ chosen[i])
            at = int(closest.argmin())
    norms = np.linalg.norm(chosen, axis=1, keepdims=True)
    return chosen / np.where(norms > 0, norms, 1)


def _dense(column, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def _measure(references: dict[int, np.ndarray], number: int, schema: pa.Schema):
    """Whole-numbered vectors with norm, angles to all references, and the nearest reference (``cell``)."""

    def run(batches):
        for batch in batches:
            lengths = pa.compute.list_value_length(batch["vec"]).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dim))
                q = np.floor(256 * _dense(part["vec"], dim, np.float64))
                norm = np.linalg.norm(q, axis=1)
                if dim not in references:
                    references[dim] = reference_directions([], dim, number)
                cosine = (q @ references[dim].T) / np.where(norm > 0, norm, 1)[:, None]
                angles = np.arccos(np.clip(cosine, -1, 1))
                cell = angles.argmin(axis=1)
                lists = [
                    pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), kind))
                    for x, kind in ((q.astype(np.int64), pa.int64()), (angles, pa.float64()))
                ]
                near = angles[np.arange(len(cell)), cell]
                columns = [part["id"], part["label"], pa.array([dim] * len(q), pa.int32()), pa.array(norm), *lists]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(cell, pa.int32()), pa.array(near)], schema=schema)

    return run


def score_bounds(angles, norm, low, high, least, most) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products of anchors (rows) with leaves (columns) whose angles and norms lie in ranges.

    On the sphere the angle between two vectors is at least the difference of their angles to any third, and at most
    their sum or what is left of the full circle.
    """
    near, far = np.zeros((len(angles), len(low))), np.full((len(angles), len(low)), np.pi)
    for i in range(angles.shape[1]):
        own = angles[:, i, None]
        np.maximum(near, np.maximum(own - high[:, i], low[:, i] - own), out=near)
        np.minimum(far, np.minimum(own + high[:, i], 2 * np.pi - own - low[:, i]), out=far)
    top, bottom = np.cos(np.maximum(near - SLACK, 0)), np.cos(np.minimum(far + SLACK, np.pi))
    room = 1 + ROUND * norm[:, None] * most
    upper = norm[:, None] * top * np.where(top > 0, most, least)
    lower = norm[:, None] * bottom * np.where(bottom > 0, least, most)
    return lower - room, upper + room


def best_in_windows(anchors: dict, rows: dict, same: bool, k: int) -> tuple:
    """For each anchor and each of its score windows the ``k`` best rows inside: anchor, window, row, score; and how
    many products were taken.

    ``rows`` are in the order of their leaves. Rows of the anchor's label are looked at if ``same`` (those of its own id
    left out), else the others.
    """
    n, cuts = len(rows["id"]), np.arange(0, len(rows["id"]), LEAF)
    low, high = (f.reduceat(rows["angles"], cuts, axis=0) for f in (np.minimum, np.maximum))
    least, most = (f.reduceat(rows["norm"], cuts) for f in (np.minimum, np.maximum))
    exact = anchors["norm"].max() * rows["norm"].max() < 2.0**52
    kind = np.float64 if exact else np.int64
    q, products, found = rows["q"].astype(kind), 0, []
    for begin in range(0, len(anchors["id"]), TOGETHER):
        part = slice(begin, begin + TOGETHER)
        own, floor, top = anchors["q"][part].astype(kind), anchors["low"][part].copy(), anchors["high"][part]
        lower, upper = score_bounds(anchors["angles"][part], anchors["norm"][part], low, high, least, most)
        best = np.full((*floor.shape, k), NONE)
        for leaf in np.argsort(-upper.sum(axis=0), kind="stable").tolist():
            open_ = (upper[:, leaf, None] >= floor) & (lower[:, leaf, None] <= top) & (floor <= top)
            at = np.flatnonzero(open_.any(axis=1))
            if not len(at):
                continue
            where = slice(cuts[leaf], min(n, cuts[leaf] + LEAF))
            score = (own[at] @ q[where].T).astype(np.int64)
            products += score.size
            fits = (anchors["label"][part][at, None] == rows["label"][where]) == same
            if same:
                fits &= anchors["id"][part][at, None] != rows["id"][where]
            for w in range(floor.shape[1]):
                hit = fits & (score >= floor[at, w, None]) & (score <= top[at, w, None])
                some = hit.any(axis=1)
                if not some.any():
                    continue
                a, inside = at[some], np.where(hit[some], score[some], NONE)
                best[a, w] = np.partition(np.concatenate([best[a, w], inside], axis=1), -k, axis=1)[:, -k:]
                floor[a, w] = np.maximum(floor[a, w], best[a, w].min(axis=1))
                i, j = np.nonzero(inside >= np.maximum(floor[a, w], NONE + 1)[:, None])
                found.append((a[i] + begin, np.full(len(i), w), where.start + j, inside[i, j]))
    if not found:
        return *(np.empty(0, np.int64) for _ in range(4)), products
    a, w, r, score = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((rows["id"][r], -score, w, a))
    a, w, r, score = a[order], w[order], r[order], score[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (w[1:] != w[:-1])])
    first = np.flatnonzero(new)
    rank = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a))))
    keep = rank < k
    return a[keep], w[keep], r[keep], score[keep], products


def _in_group(same: bool, k: int, windows: int, schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table["is_anchor"].to_numpy()
        parts = []
        for flag in (True, False):
            part = table.filter(pa.array(side == flag))
            x = {c: part[c].to_numpy() for c in ("id", "label", "norm", "anchor", "cell", "near")}
            for c, width, kind in (("q", part["dim"][0].as_py() if part.num_rows else 0, np.int64), ("angles", -1, np.float64)):
                width = width if width >= 0 else len(part[c][0]) if part.num_rows else 0
                x[c] = _dense(part[c].combine_chunks() if part.num_rows else pa.array([], pa.list_(pa.int64())), width, kind)
            if flag:
                for c, empty in (("low", 1), ("high", 0)):
                    x[c] = np.full((part.num_rows, windows), empty, np.int64)
                    for i, values in enumerate(part[c].to_pylist()):
                        x[c][i, : len(values)] = values
            parts.append(x)
        anchors, rows = parts
        if not len(anchors["id"]) or not len(rows["id"]):
            return schema.empty_table()
        for x in parts:
            order = np.lexsort((x["near"], x["cell"]))
            x.update({c: v[order] for c, v in x.items()})
        a, w, r, score, _ = best_in_windows(anchors, rows, same, k)
        return pa.table([pa.array(c) for c in (anchors["anchor"][a], w, rows["id"][r], score)], schema=schema)

    return run


def hard_negatives(
    df: DataFrame,
    anchors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    references: int = 16,
    sample: int = 2000,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    A row's score for an anchor is the inner product of both vectors after every component ``x`` has become
    ``floor(256 * x)``. An anchor's positives are its best ``positives`` other rows of its label; the negatives of a
    positive are the best ``negatives`` rows of other labels whose score lies between ``window`` per cent of the
    positive's. Equal scores rank by id. ``anchors`` are rows of the same form as ``df``.

    1. Every row keeps its norm and its angles to ``references`` directions, chosen from a sample of ``sample`` rows
       (those of smallest id hash), each the farthest from those before. Rows are put in blocks by nearest direction and
       the angle to it; blocks of anchors meet blocks of rows, so that a task holds one of each.
    2. In a task rows lie in leaves of similar angles. For an anchor and a leaf the triangle inequality on the sphere
       gives an interval of cosines, times the norms an interval of scores, widened by more than rounding can shift it.
       Only leaves whose interval meets a window that is still open get whole-number products. For positives the window
       opens at the lowest of the best found so far, for negatives it is that of the positive, closing from below.
    3. The tasks' best of every window are merged; negatives run once all positives are known.

    Rows with a null label or id, a null vector, or a null or non-finite component take no part. Vectors of different
    lengths have no product. The anchor's own id is not a positive of it; repeated rows and ids are candidates each, equal
    anchors are one. Zero and empty vectors score 0. Scores have to fit in 62 bits. Other columns are ignored. An
    anchor without positives, or a positive without negatives, has no rows.
    """
    spark = df.sparkSession

    def usable(table: DataFrame) -> DataFrame:
        table = table.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
        bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        return table.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & ~bad)

    rows = usable(df)
    by_dim: dict[int, list] = {}
    for row in rows.select("vec").orderBy(F.xxhash64("id"), "id").limit(sample).toLocalIterator():
        by_dim.setdefault(len(row["vec"]), []).append(np.floor(256 * np.array(row["vec"], np.float64)))
    chosen = {dim: reference_directions(x, dim, references) for dim, x in by_dim.items()}
    kinds = [("id", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("norm", pa.float64()), ("q", pa.list_(pa.int64()))]
    arrow = pa.schema([*kinds, ("angles", pa.list_(pa.float64())), ("cell", pa.int32()), ("near", pa.float64())])
    plain = "id long, label long, dim int, norm double, q array<long>, angles array<double>, cell int, near double"
    measure = _measure(chosen, references, arrow)

    measured = rows.mapInArrow(measure, plain)
    blocks = max(1, -(-rows.count() // ROWS))
    measured = measured.repartitionByRange(blocks, "dim", "cell", "near", "id").withColumn("block", F.spark_partition_id())
    measured = materialise(measured, "measured")
    blocks = (measured.agg(F.max("block")).first()[0] or 0) + 1
    asked = usable(anchors).distinct().mapInArrow(measure, plain).withColumn("anchor", F.xxhash64("id", "label", "q"))
    asked = materialise(asked, "anchors")
    groups = max(1, -(-asked.count() // ANCHORS))
    wide = measured.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    none = F.array().cast("array<long>")
    wide = wide.withColumns({"is_anchor": F.lit(False), "anchor": F.lit(0).cast("long"), "low": none, "high": none})
    pair = pa.schema([("anchor", pa.int64()), ("window", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])

    def search(asked: DataFrame, same: bool, k: int, windows: int, name: str) -> DataFrame:
        asked = asked.withColumn("group", F.pmod("anchor", F.lit(groups)).cast("int")).withColumn("is_anchor", F.lit(True))
        asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        both = asked.select(*wide.columns).union(wide)
        found = both.groupBy("group", "block", "dim").applyInArrow(_in_group(same, k, windows, pair), "anchor long, window long, row long, score long")
        order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "row")
        return materialise(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), name)

    whole = {"low": F.array(F.lit(NONE)), "high": F.array(F.lit(-NONE))}
    best = search(asked.withColumns(whole), True, positives, 1, "positives")
    lists = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "row", "score"))).alias("best"))
    a, b = window
    lists = lists.select(
        "anchor",
        F.transform("best", lambda x: F.ceil(x["score"] * F.lit(a).cast("decimal(10,0)") / 100).cast("long")).alias("low"),
        F.transform("best", lambda x: F.floor(x["score"] * F.lit(b).cast("decimal(10,0)") / 100).cast("long")).alias("high"),
    )
    mined = search(asked.join(lists, "anchor"), False, negatives, positives, "negatives")
    positive = best.select("anchor", (F.col("rank") - 1).cast("long").alias("window"), F.col("row").alias("positive_id"), F.col("score").alias("positive_score"))
    names = asked.select("anchor", F.col("id").alias("anchor_id"))
    mined = mined.select("anchor", "window", "rank", F.col("row").alias("negative_id"), F.col("score").alias("negative_score"))
    out = mined.join(positive, ["anchor", "window"]).join(names, "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

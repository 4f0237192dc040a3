"""Near-duplicate vectors by NN-descent: seed a neighbour graph, refine it through neighbours of neighbours, audit it."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise
from .components import connected_components

#: Rows a seeding pass compares with, before and after, along the projection inside a bucket.
REACH = 24
#: Average number of vectors in a bucket of a seeding table.
BUCKET = 16
#: Vectors per side of a block comparison inside a component.
BLOCK = 4096


def _units(vectors) -> np.ndarray:
    x = np.vstack([np.asarray(v, dtype=np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _seed_rows(first: int, tables: int, bits: int):
    """Rows (bucket, place, rep, vec), one per vector and seeding table."""

    def run(batches):
        for pdf in batches:
            for dim, part in pdf.groupby(pdf["vec"].map(len)):
                unit = _units(part["vec"])
                for table in range(first, first + tables):
                    planes = np.random.default_rng([dim, table]).standard_normal((dim, bits + 1))
                    seen = unit @ planes
                    code = (seen[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
                    yield pd.DataFrame(
                        {
                            "bucket": (np.int64(table) << 48) + code + (np.int64(dim % 256) << 40),
                            "place": seen[:, bits],
                            "rep": part["rep"].to_numpy(),
                            "vec": part["vec"].to_numpy(),
                        }
                    )

    return run


def _pairs(a, b, sim) -> pd.DataFrame:
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "sim": sim})


def _no_pairs() -> pd.DataFrame:
    return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64"), "sim": pd.Series(dtype="float64")})


def _compare_in_order(floor: float):
    """Each row with the ``REACH`` rows before it in its bucket; only those rows are kept between batches."""

    def run(batches):
        tail = None
        for pdf in batches:
            fresh = 0 if tail is None else len(tail)
            pdf = pdf if tail is None else pd.concat([tail, pdf], ignore_index=True)
            tail = pdf.iloc[-REACH:]
            sizes = pdf["vec"].map(len).to_numpy()
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                unit, bucket = _units(pdf["vec"].iloc[at]), pdf["bucket"].to_numpy()[at]
                rep, new = pdf["rep"].to_numpy()[at], at >= fresh
                for step in range(1, min(REACH, len(at) - 1) + 1):
                    sim = np.einsum("ij,ij->i", unit[step:], unit[:-step])
                    hit = np.flatnonzero((sim >= floor) & (bucket[step:] == bucket[:-step]) & new[step:])
                    if len(hit):
                        yield _pairs(rep[hit + step], rep[hit], sim[hit])

    return run


def _local_join(floor: float):
    """Pairs from different components among the neighbours of one vector, 256 rows at a time against all later ones."""

    def run(pdf):
        found = [_no_pairs()]
        unit, rep, component = _units(pdf["vec"]), pdf["u"].to_numpy(), pdf["component"].to_numpy()
        for begin in range(0, len(pdf), 256):
            sim = unit[begin : begin + 256] @ unit[begin:].T
            apart = component[begin : begin + 256, None] != component[begin:]
            i, j = np.nonzero(np.triu((sim >= floor) & apart, 1))
            found.append(_pairs(rep[begin + i], rep[begin + j], sim[i, j]))
        return pd.concat(found, ignore_index=True)

    return run


def _block_links(threshold: float):
    """For every guest of a block its closest vector of the host's block, if that is a link."""

    def run(pdf):
        hosts, guests = pdf[pdf["host_side"]], pdf[~pdf["host_side"]]
        found = [_no_pairs()]
        if len(hosts) and len(guests):
            unit, rep = _units(hosts["vec"]), hosts["rep"].to_numpy()
            for begin in range(0, len(guests), 512):
                part = guests.iloc[begin : begin + 512]
                sim = _units(part["vec"]) @ unit.T
                best = sim.argmax(axis=1)
                top = sim[np.arange(len(part)), best]
                hit = np.flatnonzero(top >= threshold)
                found.append(_pairs(part["rep"].to_numpy()[hit], rep[best[hit]], top[hit]))
        return pd.concat(found, ignore_index=True)

    return run


def _block_counts(threshold: float):
    """Linked rows for every vector of two blocks of one component (or of one block with itself)."""

    def run(pdf):
        p, q = int(pdf["p"].iloc[0]), int(pdf["q"].iloc[0])
        left = pdf[pdf["block"] == p]
        right = pdf[pdf["block"] == q]
        if not len(left) or not len(right):
            return pd.DataFrame({"rep": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64")})
        x, y = _units(left["vec"]), _units(right["vec"])
        of_x, of_y = np.zeros(len(x), dtype=np.int64), np.zeros(len(y), dtype=np.int64)
        n_x, n_y = left["n"].to_numpy(), right["n"].to_numpy()
        for begin in range(0, len(x), 512):
            hit = x[begin : begin + 512] @ y.T >= threshold
            if p == q:
                hit[np.arange(len(hit)), np.arange(begin, begin + len(hit))] = False
            of_x[begin : begin + 512] += hit @ n_y
            of_y += n_x[begin : begin + 512] @ hit
        out = pd.DataFrame({"rep": left["rep"].to_numpy(), "links": of_x})
        return out if p == q else pd.concat([out, pd.DataFrame({"rep": right["rep"].to_numpy(), "links": of_y})])

    return run


def _with_components(pairs: DataFrame, labels: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Pairs with the components of both ends (``c_`` columns); a vector without links is its own component."""
    for side in (a, b):
        of = labels.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
        pairs = pairs.join(of, side, "left").withColumn(f"c_{side}", F.coalesce(f"c_{side}", side))
    return pairs


def _lists(pairs: DataFrame, labels: DataFrame, k: int) -> DataFrame:
    """The nearest known neighbours ``u`` of every vector ``v``: ``k`` of its own component and ``k`` of others."""
    both = pairs.select(F.col("a").alias("v"), F.col("b").alias("u"), "sim")
    both = both.union(pairs.select(F.col("b").alias("v"), F.col("a").alias("u"), "sim"))
    both = _with_components(both, labels, "v", "u").withColumn("apart", F.col("c_v") != F.col("c_u"))
    order = Window.partitionBy("v", "apart").orderBy(F.desc("sim"), "u")
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _borders(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Components with a known pair between them: the larger as ``host``, the other as ``guest``, and their sizes.

    Two single vectors are left out, as their pair is all there is to compare.
    """
    sizes = labels.groupBy("component").agg(F.count("*").alias("m"))
    found = _with_components(pairs.select("a", "b"), labels).where("c_a <> c_b").select("c_a", "c_b").distinct()
    for side in ("c_a", "c_b"):
        found = found.join(sizes.select(F.col("component").alias(side), F.col("m").alias(f"m_{side}")), side, "left")
        found = found.withColumn(f"m_{side}", F.coalesce(f"m_{side}", F.lit(1).cast("long")))
    a, b = F.struct(F.col("m_c_a").alias("m"), F.col("c_a").alias("c")), F.struct(F.col("m_c_b").alias("m"), F.col("c_b").alias("c"))
    found = found.withColumn("host", F.greatest(a, b)).withColumn("guest", F.least(a, b)).where("host.m > 1")
    return found.select(
        F.col("host.c").alias("host"), F.col("host.m").alias("host_m"), F.col("guest.c").alias("guest"), F.col("guest.m").alias("guest_m")
    ).distinct()


def _links_across(borders: DataFrame, classes: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """Links between hosts and guests: all vectors of a host with all of its guests, block by block."""
    known = labels.withColumnRenamed("node", "rep")
    member = classes.select("rep", "vec").join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    size = borders.groupBy("host").agg(F.max("host_m").alias("host_m"), F.sum("guest_m").alias("guests"))
    for name, of in (("p_blocks", "host_m"), ("q_blocks", "guests")):
        size = size.withColumn(name, F.ceil(F.col(of) / BLOCK).cast("int"))
    size = size.select("host", "p_blocks", "q_blocks")
    hosts = member.withColumnRenamed("component", "host").join(size, "host")
    hosts = hosts.withColumn("p", F.pmod(F.xxhash64("rep"), "p_blocks").cast("int"))
    hosts = hosts.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)))
    guests = member.withColumnRenamed("component", "guest").join(borders.select("host", "guest"), "guest").join(size, "host")
    guests = guests.withColumn("q", F.pmod(F.xxhash64("rep"), "q_blocks").cast("int"))
    guests = guests.withColumn("p", F.explode(F.sequence(F.lit(0), F.col("p_blocks") - 1)))
    columns = ["host", "p", "q", "rep", "vec"]
    both = hosts.select(*columns, F.lit(True).alias("host_side")).union(guests.select(*columns, F.lit(False).alias("host_side")))
    return _distinct(both.groupBy("host", "p", "q").applyInPandas(_block_links(threshold), "a long, b long, sim double"))


def _distinct(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "b").agg(F.max("sim").alias("sim"))


def true_links(classes: DataFrame, among: DataFrame, threshold: float, queries: int) -> DataFrame:
    """All links of ``queries`` vectors of ``among`` (column ``rep``), those of smallest id hash.

    The queries are compared with all rows; their number is the parameter, so they may travel with the tasks.
    """
    chosen = among.select("rep").distinct().orderBy(F.xxhash64("rep"), "rep").limit(queries)
    asked = classes.select("rep", "vec").join(chosen, "rep", "left_semi").collect()
    by_dim: dict[int, list] = {}
    for row in asked:
        by_dim.setdefault(len(row["vec"]), []).append(row)
    asked = {d: (np.array([r["rep"] for r in rows]), _units([r["vec"] for r in rows])) for d, rows in by_dim.items()}

    def run(batches):
        for pdf in batches:
            for dim, part in pdf.groupby(pdf["vec"].map(len)):
                if dim in asked:
                    rep, unit = asked[dim]
                    sim = _units(part["vec"]) @ unit.T
                    i, j = np.nonzero(sim >= threshold)
                    found = _pairs(part["rep"].to_numpy()[i], rep[j], sim[i, j])
                    yield found[found["a"] != found["b"]]

    return _distinct(classes.select("rep", "vec").mapInPandas(run, "a long, b long, sim double"))


def _recall(links: DataFrame, labels: DataFrame, seeded: DataFrame) -> float:
    """Share of links that lie within one component; the lower of that of all links and of those that seeding missed."""
    before = _with_components(links, seeded).select("a", "b", (F.col("c_a") != F.col("c_b")).alias("late"))
    got = _with_components(before, labels).withColumn("got", F.col("c_a") == F.col("c_b"))
    row = got.agg(
        F.count("*").alias("n"), F.count_if("got").alias("got"), F.count_if("late").alias("late"), F.count_if(F.col("late") & F.col("got")).alias("late_got")
    ).first()
    return min(row["got"] / row["n"] if row["n"] else 1.0, row["late_got"] / row["late"] if row["late"] else 1.0)


def near_duplicate_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    threshold: float = 0.95,
    k: int = 16,
    tables: int = 12,
    audit: int = 1000,
    target: float = 0.999,
    passes: int = 6,
) -> DataFrame:
    """Per row: id, ``n_links`` (other rows linked directly), ``component_id``, ``kept``.

    1. Rows with the same vector become one class with a count; everything below works on classes.
    2. ``tables`` seeding tables put vectors into buckets by the signs of random projections; inside a bucket each is
       compared with its neighbours along one more projection. Bucket width follows the number of classes. A range
       partitioning splits full buckets.
    3. Descent: among the neighbours of a vector (``k`` of its own component, ``k`` of others, so that a dense group
       does not fill the list), pairs from different components are compared, round after round, until none of them is
       a link. Edges wider than twice the threshold's angle are not followed. Lists are saturated when the k-th
       neighbour is still a link; so components with any known pair between them are then compared as wholes, block by
       block, and while that gives a link the descent goes on.
    4. ``audit`` vectors, and as many of those with a known pair across the components of seeding, are compared with all
       rows. While fewer than ``target`` of their links, or of those links that seeding had left across components, lie
       within a component, the missed ones are added, the number of tables is doubled (at most ``passes`` times) and
       steps 2 and 3 go on. If the last pass misses the target, the operator raises ``RuntimeError``.
    5. All vectors of a component are compared block by block in double precision, and only counts leave a task.

    Vectors that are null, zero, or hold null or non-finite components, and rows with a null id, link with nothing;
    so do vectors of different lengths with each other. A row without links is its own component. Repeated rows count
    as rows of their own, also those that repeat an id with another vector. Other columns are ignored.
    """
    floor = math.cos(min(math.pi, 2 * math.acos(threshold)))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    nonzero = F.exists("vec", lambda x: x != 0)
    ok = F.coalesce(F.col("id").isNotNull() & ~bad & nonzero, F.lit(False))
    rows = rows.withColumn("vec", F.when(ok, F.col("vec")))
    classes = rows.where("vec is not null").groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    # A number of its own, as several classes can have the same smallest id; it is written, so it stays.
    classes = materialise(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    bits = max(2, math.ceil(math.log2(max(1, classes.count()) / BUCKET + 1)))
    vec_of = classes.select(F.col("rep").alias("u"), "vec")

    known, tried, first = None, None, 0
    for last in range(passes):
        seeds = classes.mapInPandas(
            _seed_rows(first, tables, bits), "bucket long, place double, rep long, vec array<double>"
        )
        ordered = seeds.repartitionByRange("bucket", "place").sortWithinPartitions("bucket", "place")
        pairs = ordered.mapInPandas(_compare_in_order(floor), "a long, b long, sim double")
        known = materialise(_distinct(pairs if known is None else known.union(pairs)), "graph")
        seeded = None
        while True:
            labels = materialise(connected_components(known.where(F.col("sim") >= threshold)), "labels")
            if seeded is None:
                seeded, seeds_known = labels, known
            lists = _lists(known, labels, k).select("v", "u")
            near = lists.union(lists.select(F.col("u").alias("v"), F.col("v").alias("u"))).distinct()
            near = near.join(vec_of, "u").join(labels.withColumnRenamed("node", "u"), "u", "left")
            near = near.select("v", "u", "vec", F.coalesce("component", "u").alias("component"))
            joined = near.groupBy("v").applyInPandas(_local_join(floor), "a long, b long, sim double")
            joined = materialise(_distinct(joined), "descent")
            known = known.union(joined)
            if not joined.where(F.col("sim") >= threshold).isEmpty():
                continue
            # Components only grow, so that smallest id and size tell what was compared before.
            borders = _borders(known, labels)
            if tried is not None:
                borders = borders.join(tried, borders.columns, "left_anti")
            borders = materialise(borders, "borders")
            tried = borders if tried is None else tried.union(borders)
            across = materialise(_links_across(borders, classes, labels, threshold), "across")
            if across.isEmpty():
                break
            known = known.union(across)
        late = _with_components(seeds_known, seeded).where("c_a <> c_b")
        late = late.select(F.explode(F.array("a", "b")).alias("rep"))
        links = true_links(classes, classes, threshold, audit).union(true_links(classes, late, threshold, audit)).distinct()
        links = materialise(links, "audit")
        recall = _recall(links, labels, seeded)
        if recall >= target:
            break
        if last == passes - 1:
            raise RuntimeError(f"near-duplicate vectors: the audit found {recall:.4f} of the links, {target} were asked for")
        known = known.union(links)
        first, tables = first + tables, 2 * tables

    sized = labels.join(labels.groupBy("component").agg(F.count("*").alias("m")), "component")
    member = sized.join(classes, F.col("node") == F.col("rep"))
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    member = member.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    member = member.select(
        "component", "rep", "n", "vec", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q")
    )
    counted = member.groupBy("component", "p", "q").applyInPandas(_block_counts(threshold), "rep long, links long")
    counted = counted.groupBy("rep").agg(F.sum("links").alias("links"))
    named = sized.join(classes.select("rep", "id"), F.col("node") == F.col("rep"))
    named = named.groupBy("component").agg(F.min("id").alias("component_id"))
    of_class = (
        classes.join(counted, "rep", "left")
        .join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .join(named, "component", "left")
        .select(
            "vec",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
    )
    of_class = materialise(of_class, "counts")
    return rows.join(of_class, "vec", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce("component_id", "id").eqNullSafe(F.col("id")).alias("kept"),
    )

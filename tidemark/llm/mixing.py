"""Mixing sources to target weights: golden-ratio slots mapped through cumulative weights, joined with shuffled blocks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Neighbouring Fibonacci numbers. STEP / SPAN is the golden ratio to 18 digits, so that the points
#: (i * STEP) mod SPAN are the golden-ratio sequence in whole numbers; after SPAN points it begins again.
STEP, SPAN = 1134903170, 1836311903
#: Slots whose ranks are counted together.
CHUNK = 1 << 16


@dataclass(frozen=True)
class Mix:
    """``documents``: a row per document with its source's size and target. ``pieces``: what every slot takes of them."""

    documents: DataFrame
    pieces: DataFrame


def _in_order(df: DataFrame, keys: list, name: str, **sums: str) -> DataFrame:
    """Rows with exclusive running totals in the order of ``keys`` over the whole table (new column = summed column).

    Range partitions hold the order; a row per partition carries the totals over, so no key has to fit in a task.
    """
    cut = materialise(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), name)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = cut.groupBy("_part").agg(*[F.sum(c).alias(f"_{c}") for c in sums.values()])
    parts = parts.select("_part", *[F.coalesce(F.sum(f"_{c}").over(before), zero).alias(f"_b_{c}") for c in sums.values()])
    out = cut.join(parts, "_part")
    out = out.withColumns({n: F.coalesce(F.sum(c).over(inside), zero) + F.col(f"_b_{c}") for n, c in sums.items()})
    return out.drop("_part", *[f"_b_{c}" for c in sums.values()])


def _targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """``target``: ``share`` of all sizes by weight, at most ``most`` times a source's size, the excess reshared.

    What is above is reshared in rounds until none is; each round is one aggregate over the sources.
    """
    first = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total, capped, free, level = share * (first["size"] or 0), 0, first["weight"] or 0, 0.0
    while free:
        level = (total - most * capped) / free
        above = F.col("weight") * F.lit(level) > F.lit(most) * F.col("source_size")
        row = sources.agg(
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)).alias("capped"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("free"),
        ).first()
        if row["capped"] == capped and row["free"] == free:
            break
        capped, free = row["capped"], row["free"]
    limit = F.lit(float(most)) * F.col("source_size")
    return sources.withColumn("target", F.least(limit, F.col("weight") * F.lit(level)) if free else limit)


def _schedule(sources: DataFrame, slots: int) -> DataFrame:
    """Columns ``number`` (source), ``rank``, ``slot``: which slot takes a source's block of that rank.

    Slot ``i`` has the point ``(i * STEP) mod SPAN``; the source whose share of 0..SPAN holds it gets the slot. Shares
    and points meet in equal cells, so that neither side of that join grows beyond twice the slots. Slots beyond a
    source's blocks are left out, blocks without a slot (the discrepancy, a few of each source) follow at the end.
    """
    spark = sources.sparkSession
    at = lambda c: F.floor(F.col(c) / F.lit(max(1, slots)) * F.lit(SPAN)).cast("long")
    shares = sources.where("blocks > 0").withColumn("after", F.col("before") + F.col("blocks"))
    shares = shares.select("number", "blocks", at("before").alias("low"), at("after").alias("high"))
    cells = max(1, shares.count())
    cell = lambda x: F.floor(x * F.lit(cells) / F.lit(SPAN)).cast("long")
    full = shares.where("high > low")
    spread = full.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high") - 1))))
    points = spark.range(slots).select(
        F.col("id").alias("slot"), ((F.col("id") % F.lit(SPAN)) * F.lit(STEP) % F.lit(SPAN)).alias("point")
    )
    given = points.withColumn("cell", cell(F.col("point"))).join(spread, "cell").where("point >= low AND point < high")
    given = given.select("number", "blocks", "slot", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    earlier = Window.partitionBy("number").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialise(given.groupBy("number", "chunk").agg(F.count("*").alias("n")), "slot-counts")
    counts = counts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    inside = Window.partitionBy("number", "chunk").orderBy("slot")
    ranked = given.withColumn("own", F.row_number().over(inside) - 1).join(counts, ["number", "chunk"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("own")).where("rank < blocks").select("number", "rank", "slot")
    got = counts.groupBy("number").agg(F.sum("n").alias("got"))
    late = shares.join(got, "number", "left").withColumn("got", F.coalesce("got", F.lit(0).cast("long")))
    late = late.where("got < blocks").select("number", "got", F.explode(F.expr("sequence(got, blocks - 1)")).alias("rank"))
    late = late.select("number", "rank", (F.lit(slots) + (F.col("rank") - F.col("got")) * F.lit(cells) + F.col("number")).alias("slot"))
    return ranked.union(late)


def mix_sources(
    df: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    block: int = 1024,
) -> Mix:
    """A mix of all sources in the proportions of their targets, as pieces of documents in the order of ``slot``.

    1. A document's size is its number of words. Sources in code point order (null last) take the ``weights`` in turn
       and share ``share`` times all words; ``most`` times its own size is the most a source gives.
    2. The documents of a source are shuffled by a digest of their ids, anew for every time round, and laid end to end;
       this stream is cut into blocks of ``block`` words and ends at the target (rounded half up).
    3. Golden-ratio points mapped through the cumulative numbers of blocks give every slot its source; slots are ranked
       per source, and the slot of rank ``r`` takes the source's block ``r``.

    ``documents``: ``row`` (a key), id, source, ``size``, ``source_size``, ``target``. ``pieces``: ``slot``, ``row``,
    id, ``times`` (0: first time round), ``start`` and ``length`` in words. Pieces of one slot take ``block`` words
    together (fewer in a source's last block). A source's pieces take its rounded target in words exactly, and of a
    document at most ``most`` times its size (rounded up to whole rounds only where ``most`` is none).

    Null texts, empty texts and texts without words have size 0 and no pieces. Rows with a null id are documents like
    others; so are repeated rows and repeated ids, of which any may be the one that is taken more often. An empty table
    gives two empty tables. Other columns are ignored. The same rows give the same mix, however they are partitioned.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    sized = df.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"))
    sized = materialise(sized.withColumn("row", F.monotonically_increasing_id()), "sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("long"))
    sources = _in_order(sources, [F.col("source").isNull(), "source"], "sources", number="one", base="source_size")
    turn = (F.col("number") % len(weights) + 1).cast("int")
    sources = sources.withColumn("weight", F.element_at(F.array([F.lit(w) for w in weights]), turn))
    sources = _targets(materialise(sources, "weights"), share, most)
    sources = sources.withColumn("quota", F.floor(F.col("target") + 0.5).cast("long"))
    sources = sources.withColumn("blocks", F.ceil(F.col("quota") / block).cast("long"))
    sources = _in_order(sources, [F.col("number")], "targets", before="blocks").drop("one")
    sources = materialise(sources, "sources")
    slots = sources.agg(F.sum("blocks")).first()[0] or 0

    kept = ["number", "source_size", "target", "quota", "base"]
    same = F.col("s.source").eqNullSafe(F.col("d.source"))
    placed = sized.alias("d").join(sources.alias("s"), same).select("d.*", *[f"s.{c}" for c in kept])
    rounds = int(-(-most // 1))
    for times in range(rounds):
        order = F.md5(F.concat(F.lit(f"{times}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"))
        keys = [F.col("number"), F.col("order"), F.col("id"), F.col("size"), F.col("row")]
        placed = _in_order(placed.withColumn("order", order), keys, f"placed-{times}", at="size").drop("order")
        placed = placed.withColumn(f"at_{times}", F.col("at") - F.col("base") + F.lit(times) * F.col("source_size")).drop("at")
    placed = materialise(placed, "placed")

    each = F.array([F.struct(F.lit(t).alias("times"), F.col(f"at_{t}").alias("begin")) for t in range(rounds)])
    runs = placed.where("size > 0").select("row", "id", "number", "size", "quota", F.inline(each))
    runs = runs.withColumn("end", F.least(F.col("begin") + F.col("size"), "quota")).where("begin < end")
    b = F.lit(block)
    runs = runs.withColumn("rank", F.explode(F.sequence(F.floor(F.col("begin") / b), F.floor((F.col("end") - 1) / b))))
    low, high = F.greatest("begin", F.col("rank") * b), F.least("end", (F.col("rank") + 1) * b)
    pieces = runs.join(_schedule(sources, slots), ["number", "rank"]).select(
        "slot", "row", F.col("id").alias(id_col), "times", (low - F.col("begin")).alias("start"), (high - low).alias("length")
    )
    documents = placed.select("row", F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target")
    return Mix(documents, pieces)


def taken_words(mix: Mix) -> DataFrame:
    """``mix.documents`` with ``taken``: the words that the mix takes of each, repeats counted."""
    taken = mix.pieces.groupBy("row").agg(F.sum("length").alias("taken"))
    return mix.documents.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long"))).drop("row")

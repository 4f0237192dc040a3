"""Mixture-controlled packing of token streams into sequences by deficit round-robin over source queues."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, slices

#: Fixed value: how the byte-level pre-tokenizer of the vocabulary file splits text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Rates are kept as whole multiples of 2**-16 tokens per window.
SHIFT = 16


def byte_level_encoding(path: str) -> tiktoken.Encoding:
    """A byte-level BPE in the JSON form of the tokenizers library; ids are the same, at several times the speed.

    Holds for vocabularies whose ids rise with the order of the merges and whose pre-tokenizer is the plain byte-level
    one. Added tokens are recognised in texts, as there.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(printable)]
    to_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(to_byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
    return tiktoken.Encoding("byte_level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def _tokenise(path: str, end_id: int, schema: pa.Schema):
    """Rows with their ids and the place of their first id among those of the same queue in this partition."""

    def run(batches):
        encoding, part, served = byte_level_encoding(path), TaskContext.get().partitionId(), {}
        tail = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for piece in slices(batch, "text"):
                ids, begins, counts = [], [], []
                for text, queue in zip(piece["text"].to_pylist(), piece["queue"].to_pylist(), strict=True):
                    found = encoding.encode_to_numpy(text, allowed_special="all") if text else np.empty(0, dtype="<u4")
                    ids.append(found.astype("<u4", copy=False).tobytes() + tail)
                    counts.append(len(found) + 1)
                    begins.append(served.get(queue, 0))
                    served[queue] = begins[-1] + counts[-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece["doc_id"],
                        piece["queue"],
                        pa.array([part] * len(ids), pa.int32()),
                        pa.array(begins, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    schema=schema,
                )

    return run


class Rounds:
    """Closed form of the round-robin: how much of each queue has been served after ``k`` windows.

    A window adds the queue's rate to its deficit; whole units of ``unit`` tokens are served and the rest is carried
    into the next window, until the queue is empty.
    """

    def __init__(self, totals, rates, unit: int):
        self.totals, self.rates, self.unit = np.asarray(totals, np.int64), np.asarray(rates, np.int64), unit
        self.done = -(-(self.totals << SHIFT) // self.rates)

    def served(self, k: np.ndarray) -> np.ndarray:
        """Rows: windows; columns: queues."""
        due = (np.minimum(k[:, None], self.done[None, :]) * self.rates[None, :]) >> SHIFT
        return np.where(due >= self.totals, self.totals, due // self.unit * self.unit)

    def window(self, queue: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The window in which the token at ``place`` of ``queue`` is served."""
        need = np.minimum(self.totals[queue], (place // self.unit + 1) * self.unit) << SHIFT
        return -(-need // self.rates[queue]) - 1


def _cut(rounds: Rounds, width: int, total: int, schema: pa.Schema):
    def pieces(queue, place, count):
        """Arrays: row, start in the row, length, position in the packed stream."""
        first = place // rounds.unit
        many = (place + count - 1) // rounds.unit - first + 1
        row = np.repeat(np.arange(len(queue)), many)
        served = np.repeat(first - np.cumsum(many) + many, many) + np.arange(len(row))
        k = rounds.window(queue[row], served * rounds.unit)
        # Only windows that serve a unit of the row: a small queue's units lie many windows apart.
        fresh = np.concatenate([[True], (row[1:] != row[:-1]) | (k[1:] != k[:-1])])[: len(row)]
        row, k = row[fresh], k[fresh]
        out = []
        step = max(1, (1 << 20) // len(rounds.totals))
        for i in range(0, len(row), step):
            r, q = row[i : i + step], queue[row[i : i + step]]
            now, then = rounds.served(k[i : i + step]), rounds.served(k[i : i + step] + 1)
            before = np.cumsum(then - now, axis=1) - (then - now)
            at = np.arange(len(r))
            begin = np.maximum(place[r], now[at, q])
            end = np.minimum(place[r] + count[r], then[at, q])
            position = now.sum(axis=1) + before[at, q] + begin - now[at, q]
            full = end > begin
            r, begin, end, position = r[full], begin[full], end[full], position[full]
            many = (position + end - begin - 1) // width - position // width + 1
            at = np.repeat(np.arange(len(r)), many)
            cut = (np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many) + position[at] // width) * width
            low, high = np.maximum(position[at], cut), np.minimum(position[at] + end[at] - begin[at], cut + width)
            out.append((r[at], begin[at] - place[r[at]] + low - position[at], high - low, low))
        return [np.concatenate(x) for x in zip(*out, strict=True)]

    def origin(part, count):
        """Ids of the document before the row, and of the whole document: rows may be fragments."""
        if "first" not in part.schema.names:
            return np.zeros_like(count), count
        return part["first"].to_numpy(), part["doc_tokens"].to_numpy()

    rest = total % width
    short = 1 << max(0, rest - 1).bit_length()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "ids"):
                count = part["n"].to_numpy()
                row, start, length, position = pieces(part["q"].to_numpy(), part["place"].to_numpy(), count)
                first, whole = origin(part, count)
                ids = part["ids"].to_pylist()
                cuts = [
                    ids[r][4 * s : 4 * (s + n)] for r, s, n in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)
                ]
                sequence = position // width
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"].take(pa.array(row)),
                        pa.array(start + first[row]),
                        pa.array(length),
                        pa.array(cuts, pa.binary()),
                        pa.array(whole[row]),
                        pa.array(sequence),
                        pa.array(position % width),
                        pa.array(np.where(sequence == total // width, short, width)),
                    ],
                    schema=schema,
                )

    return run


def _interleaved(rows: DataFrame, unit: int, total: int) -> DataFrame:
    """Rows of many small queues as fragments of one shared queue, in which each keeps its proportion.

    Unit ``j`` of a queue of ``m`` units stands at the point ``(j + phase) / m`` of the line from 0 to 1, the phase being
    a hash of the queue; fragments follow one another in the order of these points. Points are spread evenly, so equal
    cuts of the line make even groups, and sums per cut give every group its place.
    """
    place, ids = F.col("place"), F.col("ids")

    def fragment(j):
        begin, end = F.greatest(place, j * unit), F.least(place + F.col("n"), (j + 1) * unit)
        data = F.substring(ids, (4 * (begin - place) + 1).cast("int"), (4 * (end - begin)).cast("int"))
        return F.struct(j.alias("j"), begin.alias("begin"), (begin - place).alias("first"), (end - begin).alias("n"), data.alias("ids"))

    whole = F.floor(place / unit), F.floor((place + F.col("n") - 1) / unit)
    cut = rows.select("doc_id", "queue", "q", "of", "doc_tokens", F.explode(F.transform(F.sequence(*whole), fragment)).alias("f"))
    phase = F.pmod(F.xxhash64("queue"), F.lit(1 << 20)) / float(1 << 20)
    point = (F.col("f.j") + phase) / F.ceil(F.col("of") / unit)
    groups = total // (unit << 16) + 1
    cut = cut.select("doc_id", "queue", "q", "doc_tokens", "f.*", point.alias("point"), F.floor(point * groups).alias("g"))
    cut = materialise(cut, "fragments")
    before = cut.groupBy("g").agg(F.sum("n").alias("size"))
    before = before.select("g", (F.sum("size").over(Window.orderBy("g")) - F.col("size")).alias("before"))
    inside = Window.partitionBy("g").orderBy("point", "queue", "begin").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(before, "g")
    return cut.select("doc_id", "q", (F.col("before") + F.col("inside")).alias("place"), "n", "ids", "first", "doc_tokens")


def pack(
    df: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    queue_col: str = "source",
    width: int = 1024,
    window: int = 16,
    unit: int = 64,
    end_id: int = 0,
    weights: dict[str | None, float] | None = None,
    max_queues: int = 4096,
) -> DataFrame:
    """Pieces of every row's ids (``end_id`` appended): id, ``start``, ``length``, ``ids`` (little-endian unsigned 32
    bit), ``doc_tokens``, ``sequence_id``, ``offset``, ``padded_length``.

    Every source is a queue. A window is ``window`` sequences; in each, every queue gets its share of the tokens (its
    share of all tokens, or ``weights``) in units of ``unit``; what does not make a unit is a deficit carried into the
    next window. As rows may be cut anywhere, what a queue has been served after any number of windows has a closed
    form, so that each row finds its windows by itself: deficits go on across windows and partitions without a serial
    pass. An empty queue's turn goes to the others. Only the last sequence is short; it is padded to a power of two.

    Ids are written once to the shared folder with their place among the partition's; counts per partition and queue
    then give every partition its place in the queues. The ``max_queues`` largest sources have queues of their own, which
    bounds what travels to the tasks; all others share one, in which their units are interleaved in proportion, so that
    they too come evenly from the first window to the last. Null text counts as empty (one id, ``end_id``), a
    null source is a source; sources without a weight, or with weight 0, come after all others; repeated rows are packed
    once each; other columns are ignored; no rows give no pieces.
    """
    schema = "doc_id long, queue string, part int, begin long, n long, ids binary"
    arrow = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("queue", pa.string()),
            ("part", pa.int32()),
            ("begin", pa.int64()),
            ("n", pa.int64()),
            ("ids", pa.binary()),
        ]
    )
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(queue_col).cast("string").alias("queue"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    stored = materialise(rows.mapInArrow(_tokenise(tokenizer, end_id, arrow), schema), "ids")

    spark = df.sparkSession
    counts = materialise(stored.groupBy("queue", "part").agg(F.sum("n").alias("n")), "counts")
    per_queue = counts.groupBy("queue").agg(F.sum("n").alias("n"))
    # Sources with a weight come first, so that those that share a queue have none.
    weighted = F.lit(False)
    for q, w in (weights or {}).items():
        weighted = weighted | (F.col("queue").eqNullSafe(F.lit(q)) & F.lit(w > 0))
    largest = per_queue.orderBy(weighted.desc(), F.desc("n"), "queue").limit(max(max_queues, len(weights or ()))).collect()
    total = counts.agg(F.sum("n")).first()[0] or 0
    named = [(r["queue"], r["n"], i) for i, r in enumerate(largest)]
    totals = [n for _, n, _ in named]
    if sum(totals) < total or not totals:
        totals.append(total - sum(totals))
    weight = [n if weights is None else weights.get(q, 0) for q, n, _ in named]
    weight += totals[len(named) :] if weights is None else [0] * (len(totals) - len(named))
    scale = (window * width << SHIFT) / (sum(weight) or 1)
    rounds = Rounds(totals, [max(1, round(w * scale)) for w in weight], unit)

    numbers = spark.createDataFrame([(q, i) for q, _, i in named], "queue string, q long")
    numbered = counts.alias("c").join(F.broadcast(numbers.alias("m")), F.expr("c.queue <=> m.queue"), "left")
    whole = Window.partitionBy("c.queue")
    bases = numbered.select(
        "c.queue",
        "part",
        F.coalesce("q", F.lit(len(named))).alias("q"),
        (F.sum("n").over(whole.orderBy("part")) - F.col("n")).alias("base"),
        F.sum("n").over(whole).alias("of"),
    )
    bases = materialise(bases, "bases")

    placed = stored.alias("s").join(bases.alias("b"), F.expr("s.part = b.part AND s.queue <=> b.queue"))
    placed = placed.select(
        "doc_id", "s.queue", "q", "of", (F.col("base") + F.col("begin")).alias("place"), "n", "ids", F.col("n").alias("doc_tokens")
    )
    alone = placed.where(F.col("q") < len(named)) if len(totals) > len(named) else placed
    columns = ["doc_id", "q", "place", "n", "ids", "first", "doc_tokens"]
    units = alone.withColumn("first", F.lit(0).cast("long")).select(columns)
    if len(totals) > len(named):
        units = units.union(_interleaved(placed.where(F.col("q") == len(named)), unit, totals[-1]).select(columns))
    out = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids", pa.binary()),
            ("doc_tokens", pa.int64()),
            ("sequence_id", pa.int64()),
            ("offset", pa.int64()),
            ("padded_length", pa.int64()),
        ]
    )
    result = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, padded_length long"
    return units.mapInArrow(_cut(rounds, width, total, out), result).withColumnRenamed("doc_id", id_col)

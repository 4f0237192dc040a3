"""Ranked lexical search: branch-and-bound over tries of frequency-ordered term vectors of documents."""

from __future__ import annotations

import math
from bisect import insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, slices

#: A term character is an ASCII letter (A-Z lower-cased), a digit, or anything beyond ASCII; other bytes separate terms.
BYTES = bytes(
    b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)
#: Bytes of item texts that are searched in one pass; more items take more passes.
ITEM_BYTES = 1 << 20
#: Distinct documents in a leaf of a trie, and entries of one trie's table of frequencies (4 bytes each).
LEAF, CELLS = 16, 1 << 25
#: Stands for a null id, after all others.
NO_ID = (1 << 63) - 1


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(BYTES).split() if text else []


def _vectors(vocabulary: dict[bytes, int], schema: pa.Schema):
    """Per document with a term: id, number of terms, and which of the vocabulary it holds how often."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                rows, found = [], []
                for doc, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    terms = terms_of(text)
                    if terms:
                        hits = [n for n in map(vocabulary.get, terms) if n is not None]
                        found.append(np.unique(np.array(hits, np.int32), return_counts=True))
                        rows.append((NO_ID if doc is None else doc, len(terms)))
                ends = pa.array(np.cumsum([0, *(len(t) for t, _ in found)]), pa.int32())
                lists = [np.concatenate([np.empty(0, np.int32), *(f[i] for f in found)]).astype(np.int32) for i in (0, 1)]
                columns = [pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)]
                columns += [pa.ListArray.from_arrays(ends, pa.array(values, pa.int32())) for values in lists]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


class Trie:
    """Documents in the order of their vectors: every subtree is a range of them.

    A path is a run of terms, most frequent first, that all documents below it begin with. Nodes whose documents still
    agree have one child and are skipped, and a node with few children takes over those of its largest child.
    Neighbouring branches of a node that hold LEAF documents together or fewer are one leaf. Every node has the largest
    frequency of each term and the smallest ``m`` below it. Documents with equal vectors and equal ``m`` score alike for
    every item: they are one document with a list of ids, of which the ``top`` smallest can matter.
    """

    def __init__(self, documents: dict[tuple, list[int]], width: int, top: int):
        keys = sorted(documents)
        self.ids = [sorted(documents[k])[:top] for k in keys]
        self.m = np.array([k[2] for k in keys], np.int64)
        self.often = np.zeros((len(keys), width), np.int32)
        paths = []
        for row, (path, often, _) in zip(self.often, keys, strict=True):
            terms = np.frombuffer(path, ">u4").astype(np.int64)
            row[terms] = np.frombuffer(often, ">u4")
            paths.append(terms.tolist())
        nodes = [_branch(paths, 0, len(keys), 0, 0)]
        self.kids = []  # the children of a node are numbered one after another, after their parent
        for _, _, children in nodes:
            self.kids.append((len(nodes), len(nodes) + len(children)))
            nodes += children
        self.ranges = [(i, j) for i, j, _ in nodes]
        self.most = np.zeros((len(nodes), width), np.int32)
        self.least = np.array([self.m[i:j].min() for i, j in self.ranges])
        for node in reversed(range(len(nodes))):
            (i, j), (a, b) = self.ranges[node], self.kids[node]
            np.max(self.most[a:b] if a < b else self.often[i:j], axis=0, out=self.most[node])

    def search(self, terms: np.ndarray, weights: np.ndarray, best: list, top: int) -> int:
        """Enter documents into ``best`` (sorted pairs of negative score and id); how many were scored."""
        scored, stack = 0, [(1 << 62, 0)]
        while stack:
            bound, node = stack.pop()
            worst = -best[-1][0] if len(best) == top else 1
            if bound < worst:
                continue
            a, b = self.kids[node]
            if a < b:
                bounds = _scores(self.most[a:b].take(terms, axis=1), self.least[a:b], weights)
                order = np.argsort(bounds, kind="stable")
                order = order[np.searchsorted(bounds[order], worst) :]
                stack += zip(bounds[order].tolist(), (order + a).tolist(), strict=True)
                continue
            i, j = self.ranges[node]
            scored += j - i
            scores = _scores(self.often[i:j].take(terms, axis=1), self.m[i:j], weights)
            for doc in np.flatnonzero(scores >= worst).tolist():
                score = -int(scores[doc])
                for name in self.ids[i + doc]:
                    if len(best) == top and (score, name) >= best[-1]:
                        break
                    insort(best, (score, name))
                    del best[top:]
        return scored


def _branch(paths: list[list[int]], i: int, j: int, depth: int, level: int) -> tuple[int, int, list]:
    """A node: its range, and its children (none: a leaf). Very deep chains are cut in halves instead."""
    if j - i <= LEAF:
        return i, j, []
    shared = min(len(paths[i]), len(paths[j - 1]))
    while depth < shared and paths[i][depth] == paths[j - 1][depth]:
        depth += 1
    cuts = [i, *(x for x in range(i + 1, j) if paths[x][depth : depth + 1] != paths[x - 1][depth : depth + 1])]
    if len(cuts) == 1 or level > 100:  # the same terms throughout, in other frequencies: halves will do
        cuts = [i, (i + j) // 2]
    children, begin = [], i
    for end, following in zip([*cuts[1:], j], [*cuts[2:], j, None], strict=True):
        if following is None or following - begin > LEAF:
            children.append(_branch(paths, begin, end, depth, level + 1))
            begin = end
    while len(children) < LEAF and any(c[2] for c in children):
        largest = max((c for c in children if c[2]), key=lambda c: c[1] - c[0])
        at = children.index(largest)
        children[at : at + 1] = largest[2]
    return i, j, children


def _scores(often: np.ndarray, m: np.ndarray, weights: np.ndarray) -> np.ndarray:
    often = often.astype(np.int64)
    return (1_000_000_000 * often // (1000 * often + 8 * m[:, None])) @ weights


def _search(items: list, rank: np.ndarray, weight: np.ndarray, total: int, terms: int, top: int, schema: pa.Schema):
    """Every task's best documents for every item, from one trie after another."""
    size = max(LEAF, CELLS // max(1, len(rank)))
    weights = [weight[item] for item in items]

    def run(batches):
        best = [[] for _ in items]

        def finish(documents):
            trie = Trie(documents, len(rank), top)
            for item, own, found in zip(items, weights, best, strict=True):
                trie.search(item, own, found, top)

        documents = {}
        for batch in batches:
            for doc, n, own, often in zip(*(batch[c].to_pylist() for c in ("doc_id", "n", "terms", "often")), strict=True):
                path = rank[own]
                order = np.argsort(path)
                key = path[order].astype(">u4").tobytes(), np.array(often)[order].astype(">u4").tobytes()
                ids = documents.setdefault((*key, 10 + 90 * n * total // terms), [])
                ids.append(doc)
                if len(ids) > 4096:
                    ids[:] = sorted(ids)[:top]
                if len(documents) == size:
                    finish(documents)
                    documents = {}
        if documents:
            finish(documents)
        rows = [(n, doc, -score) for n, found in enumerate(best) for score, doc in found]
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def lexical_search(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = 10,
) -> DataFrame:
    """The ``top`` documents of every item: item, ``rank``, id, ``score``.

    Terms are maximal runs of ASCII letters (lower-cased), digits and characters beyond ASCII. A term's weight is
    ``floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``; a document scores the sum over the item's distinct terms of
    ``weight * (10**9 * tf div (1000 * tf + 8 * m))`` with ``m = 10 + 90 * n * N div L``, in 64-bit whole numbers (N:
    documents with a term, L: terms of all, n: of this one, df: documents that hold the term).

    1. One pass over the texts keeps of each document only the terms that items ask for, with their frequencies; N, L
       and all document frequencies are counted from that table.
    2. Every task builds tries of its documents' vectors, most frequent term first, so that documents share paths.
    3. Each item goes down each trie depth first, the most promising child first. The largest frequencies and the
       smallest ``m`` of a subtree bound what any document in it can score; a subtree below the worst of the ``top`` found
       so far (by that task, over all of its tries) is left out. Bounds never fall short, so nothing is lost.
    4. The tasks' lists, at most ``top`` per item, are merged.

    The items' terms go with the tasks; items are split by hash so that about ITEM_BYTES of item text go at a time. A trie
    takes a fixed number of cells, so its number of documents follows from the number of terms. Equal scores rank by id, null ids last (2**63 - 1 counts as null); repeated ids are
    documents of their own. Texts that are null or hold no term count nowhere and are never found. Rows of ``items`` with
    one id are one item with the terms of all; items without terms, or whose terms no document holds, have no rows. Other
    columns are ignored.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").cast("binary").alias("text"))
    volume = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-volume // ITEM_BYTES)
    share = F.pmod(F.xxhash64("item"), F.lit(max(1, parts)))
    arrow = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("often", pa.list_(pa.int32()))])
    found_arrow = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    kind = items.schema[item_col].dataType.simpleString()
    ranked = None
    for part in range(parts):
        terms: dict = {}
        for row in asked.where(share == part).toLocalIterator():
            terms.setdefault(row["item"], set()).update(terms_of(bytes(row["text"] or b"")))
        names = list(terms)
        vocabulary = {t: n for n, t in enumerate(sorted(set().union(*terms.values())))}
        vectors = rows.mapInArrow(_vectors(vocabulary, arrow), "doc_id long, n long, terms array<int>, often array<int>")
        vectors = materialise(vectors, "term-vectors")
        size = vectors.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        df_of = np.zeros(len(vocabulary), np.int64)
        for term, n in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # the vocabulary at most
            df_of[term] = n
        weight = np.array([math.floor(1000 * math.log((2 * size["docs"] + 2) / (2 * n + 1))) for n in df_of.tolist()], np.int64)
        rank = np.empty(len(df_of), np.int64)
        rank[np.lexsort((np.arange(len(df_of)), -df_of))] = np.arange(len(df_of))
        by_rank = np.zeros(len(df_of), np.int64)
        by_rank[rank] = weight
        wanted = [np.sort(rank[[vocabulary[t] for t in own]]) if own else np.empty(0, np.int64) for own in terms.values()]
        wanted = [x[(by_rank[x] > 0)] for x in wanted]
        search = _search(wanted, rank, by_rank, size["docs"], size["terms"] or 1, top, found_arrow)
        found = vectors.where(F.size("terms") > 0).mapInArrow(search, "item long, doc_id long, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        found = materialise(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top), "found")
        named = df.sparkSession.createDataFrame(list(enumerate(names)), f"item long, name {kind}")
        found = found.join(named, "item").select(
            F.col("name").alias(item_col), "rank", F.nullif("doc_id", F.lit(NO_ID)).alias(id_col), "score"
        )
        ranked = found if ranked is None else ranked.union(found)
    if ranked is None:
        return df.sparkSession.createDataFrame([], f"`{item_col}` {kind}, rank int, `{id_col}` long, score long")
    return ranked

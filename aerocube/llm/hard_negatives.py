"""Hard negatives by an inverted multi-index.

Vectors are cut in two halves; each half has a codebook of its own, and a pair of codewords is a cell. A codeword's bound on an
anchor's half-score is its inner product with the anchor's half plus the anchor half's length times the codeword's radius, the
farthest that any vector of the table lies from it. An anchor visits cells by falling sum of both bounds, which a heap over the
two sorted lists of half-bounds hands out one by one (multi-sequence). It stops where the next bound can't reach what it still
needs, so its positives and each positive's window of negatives are certified to be exact.

Visits go in rounds: each round every anchor that isn't certified asks for some more cells, the cells' vectors answer in blocks,
and the anchor's best are merged. Codebooks are fitted on a bounded sample; all vectors are indexed.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import work_table
from .vectors import longest, matrix, whole

#: Codewords of each half at most, vectors in the sample that codebooks are fitted on, and vectors of a cell on average until
#: codewords are at their most.
CODES, SAMPLE, CELL = 256, 16_384, 1024
#: Vectors of a block, blocks that a key of the join holds, and anchors of a group.
BLOCK, SHELF, GROUP = 256, 16, 256
#: Cells that an anchor visits in its first round, and how many times as many in each next one.
FIRST, MORE = 8, 8
KEY = ["vec_id", "tag"]


class Index(NamedTuple):
    """Codebooks and radii of both halves; `cut` is where a vector's second half begins."""

    dims: int
    cut: int
    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray


def _codebook(points: np.ndarray, codes: int, steps: int = 10) -> np.ndarray:
    """Lloyd's means of the sample, from points spread over it."""
    book = points[np.linspace(0, len(points) - 1, min(codes, len(points))).astype(int)]
    for _ in range(steps):
        near = ((book**2).sum(1) - 2 * points @ book.T).argmin(1)
        sums, sizes = np.zeros_like(book), np.bincount(near, minlength=len(book))
        np.add.at(sums, near, points)
        book = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], book)
    return book


def _coded(rows: DataFrame, dims: int, cut: int, books: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """rows (vec_id, label, x) with the codeword of each half and the distance to it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, out = matrix(batch.column("x"), dims).astype(float), {}
            for name, half, book in zip("ij", (x[:, :cut], x[:, cut:]), books, strict=True):
                code = ((book**2).sum(1) - 2 * half @ book.T).argmin(1)
                out |= {name: pa.array(code, pa.int32()), f"{name}_far": pa.array(np.sqrt(((half - book[code]) ** 2).sum(1)))}
            yield pa.record_batch({k: batch.column(k) for k in ("vec_id", "label", "x")} | out)

    return rows.mapInArrow(work, "vec_id long, label long, x array<long>, i int, i_far double, j int, j_far double")


def build(rows: DataFrame) -> tuple[Index, DataFrame, DataFrame] | None:
    """The index of rows (vec_id, label, x array<long>; none null), its cells (cell, parts, shelves; CODES ** 2 at most) and its
    blocks (cell, shelf, rows) as a written table. None without rows."""
    n, dims = rows.count(), longest(rows, "x")
    if not n:
        return None
    cut = (dims + 1) // 2
    sample = matrix(rows.orderBy(F.xxhash64("vec_id", "x")).limit(SAMPLE).select("x").toArrow().column(0).combine_chunks(), dims).astype(float)
    codes = int(min(max(round((n / CELL) ** 0.5), 1), CODES))
    books = tuple(_codebook(half, codes) for half in (sample[:, :cut], sample[:, cut:]))
    coded = work_table(_coded(rows, dims, cut, books).withColumn("tag", F.xxhash64("label", "x")))
    width = len(books[1])
    counts, radii = np.zeros(len(books[0]) * width, "int64"), tuple(np.zeros(len(b)) for b in books)
    for r in coded.groupBy("i", "j").agg(F.count("*"), F.max("i_far"), F.max("j_far")).collect():  # at most CODES ** 2 rows
        counts[r[0] * width + r[1]] = r[2]
        radii[0][r[0]], radii[1][r[1]] = max(radii[0][r[0]], r[3]), max(radii[1][r[1]], r[4])
    parts = [(c, -(-k // BLOCK)) for c, k in enumerate(counts.tolist()) if k]
    cells = coded.sparkSession.createDataFrame([(c, p, -(-p // SHELF)) for c, p in parts], "cell int, parts int, shelves int")
    parted = coded.withColumn("cell", F.col("i") * width + F.col("j")).join(F.broadcast(cells), "cell").withColumn("part", F.pmod(F.xxhash64(*KEY), F.col("parts")).cast("int"))
    blocks = parted.groupBy("cell", "part").agg(F.collect_set(F.struct("vec_id", "tag", "label", "x")).alias("rows"))
    blocks = blocks.select("cell", (F.col("part") / SHELF).cast("int").alias("shelf"), "rows")
    return Index(dims, cut, books, radii, counts), cells, work_table(blocks)


def visits(index: Index, x: np.ndarray) -> Iterator[tuple[float, int]]:
    """(bound, cell) of all cells by falling bound on x's score with the vectors of the cell."""
    bounds = []
    for half, book, radius in zip((x[: index.cut], x[index.cut :]), index.books, index.radii, strict=True):
        length = np.sqrt((half**2).sum())
        # rounded up, for sums in floating point
        bounds.append((book @ half + length * radius) + 1e-9 * (length * (np.sqrt((book**2).sum(1)) + radius) + 1))
    order = [np.argsort(-b, kind="stable") for b in bounds]
    (a, b), width = (b[o] for b, o in zip(bounds, order, strict=True)), len(index.books[1])
    heap = [(-(a[0] + b[0]), 0, 0)]
    while heap:
        bound, p, q = heapq.heappop(heap)
        yield -bound, int(order[0][p]) * width + int(order[1][q])
        if q + 1 < len(b):
            heapq.heappush(heap, (-(a[p] + b[q + 1]), p, q + 1))
        if q == 0 and p + 1 < len(a):
            heapq.heappush(heap, (-(a[p + 1] + b[0]), p + 1, 0))


def _ask(index: Index, quota: int):
    """Cells that each anchor visits next: at most `quota` that have vectors, none that can't reach `need`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked, seen = [], []
            for x, need, after in zip(matrix(batch.column("x"), index.dims).astype(float), batch.column("need").to_pylist(), batch.column("seen").to_pylist(), strict=True):
                cells, at = [], 0
                for at, (bound, cell) in enumerate(visits(index, x)):
                    if len(cells) == quota or (need is not None and bound < need):
                        break
                    if at >= after and index.counts[cell]:
                        cells.append(cell)
                else:
                    at = len(index.counts)
                asked.append(cells)
                seen.append(max(at, after))
            yield pa.record_batch([batch.column("vec_id"), batch.column("tag"), pa.array(asked, pa.list_(pa.int32())), pa.array(seen, pa.int32())], ["vec_id", "tag", "cells", "seen"])

    return work


def _scores(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, exact: by floating point where no sum can need more than its 53 bits."""
    most = int(np.abs(anchors).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * anchors.shape[1]
    return (anchors.astype(float) @ vectors.T.astype(float)).astype("int64") if most < 2**53 else anchors @ vectors.T


def _parts(column: pa.ListArray, k: int) -> dict[str, pa.Array]:
    """The fields of the structs in the k-th list."""
    flat = column.slice(k, 1).flatten()
    return {f.name: flat.field(f.name) for f in flat.type}


def _first(order: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """The first `most` of each row's entries in an order that goes row by row."""
    own = rows[order]
    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, int)
    place = np.arange(len(own)) - np.repeat(starts, np.diff(np.append(starts, len(own))))
    return order[place < most]


def _answer(dims: int, most: int, same: bool):
    """The best rows of a block for each anchor of a group: of the same label, or for each of its windows of another."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a, r = _parts(batch.column("anchors"), k), _parts(batch.column("rows"), k)
                ids, tags, label = (r[c].to_numpy() for c in ("vec_id", "tag", "label"))
                own, own_tag, own_label = (a[c].to_numpy() for c in ("vec_id", "tag", "label"))
                score = _scores(matrix(a["x"], dims), matrix(r["x"], dims))
                alike = own_label[:, None] == label
                if same:
                    least = np.array([-(2**63) if x is None else x for x in a["need"].to_pylist()])
                    fits = alike & ~((own[:, None] == ids) & (own_tag[:, None] == tags)) & (score >= least[:, None])
                    windows = [(np.arange(len(own)), np.full(len(own), 0), fits)]
                else:
                    lists = a["windows"]
                    of = np.repeat(np.arange(len(own)), lists.value_lengths().to_numpy(zero_copy_only=False))
                    one = lists.flatten()
                    low, high, number = (one.field(c).to_numpy() for c in ("need", "high", "window"))
                    windows = [(of[w : w + 512], number[w : w + 512], ~alike[of[w : w + 512]] & (score[of[w : w + 512]] >= low[w : w + 512, None]) & (score[of[w : w + 512]] <= high[w : w + 512, None])) for w in range(0, len(of), 512)]
                for of, number, fits in windows:
                    w, c = np.nonzero(fits)
                    s = score[of[w], c]
                    best = _first(np.lexsort((tags[c], ids[c], -s, w)), w, most)
                    w, c, s = w[best], c[best], s[best]
                    yield pa.record_batch([pa.array(own[of[w]]), pa.array(own_tag[of[w]]), pa.array(number[w], pa.int32()), pa.array(s), pa.array(ids[c]), pa.array(tags[c])], ["vec_id", "tag", "window", "score", "other_id", "other_tag"])

    return work


_FOUND = "vec_id long, tag long, window int, score long, other_id long, other_tag long"


def _round(index: Index, cells: DataFrame, blocks: DataFrame, state: DataFrame, quota: int, most: int, same: bool) -> tuple[DataFrame, DataFrame]:
    """Where each anchor's walk has got to (vec_id, tag, seen, asked), and what the cells that it asked for have for it."""
    asked = work_table(state.select(*KEY, "x", "need", "seen").mapInArrow(_ask(index, quota), "vec_id long, tag long, cells array<int>, seen int"))
    carried = ["vec_id", "tag", "label", "x", "need" if same else "windows"]
    groups = asked.select(*KEY, F.explode("cells").alias("cell")).join(state.select(*carried), KEY)
    groups = groups.join(F.broadcast(cells), "cell").withColumn("shelf", F.explode(F.sequence(F.lit(0), F.col("shelves") - 1))).withColumn("group", F.pmod(F.xxhash64(*KEY), F.lit(state.count() // GROUP + 1)))
    groups = groups.groupBy("cell", "shelf", "group").agg(F.collect_list(F.struct(*carried)).alias("anchors")).drop("group")
    found = groups.join(blocks, ["cell", "shelf"]).select("anchors", "rows").mapInArrow(_answer(index.dims, most, same), _FOUND)
    return asked.select(*KEY, "seen", (F.size("cells") > 0).alias("asked")), found


def _best(found: DataFrame, most: int) -> DataFrame:
    """(vec_id, tag, window, found): the first `most` of each window, best score first, ties by the smaller id."""
    by_score = Window.partitionBy(*KEY, "window").orderBy(F.desc("score"), "other_id", "other_tag")
    kept = found.withColumn("nth", F.row_number().over(by_score)).filter(F.col("nth") <= most)
    return kept.groupBy(*KEY, "window").agg(F.sort_array(F.collect_list(F.struct("nth", "score", "other_id", "other_tag"))).alias("found"))


def _search(index: Index, cells: DataFrame, blocks: DataFrame, state: DataFrame, most: int, same: bool) -> DataFrame:
    """_best() of all rows for anchors (vec_id, tag, label, x, need, seen and without `same` also windows): rounds until all
    walks have ended."""
    known, quota = None, FIRST
    while True:
        walked, found = _round(index, cells, blocks, state, quota, most, same)
        if known is not None:
            found = found.unionByName(known.select(*KEY, "window", F.explode("found").alias("f")).select(*KEY, "window", "f.score", "f.other_id", "f.other_tag"))
        known = work_table(_best(found, most))
        if not walked.filter("asked").limit(1).count():
            return known
        full = F.when(F.size("found") >= most, F.get("found", F.lit(most - 1))["score"])
        state = state.drop("seen").join(walked.drop("asked"), KEY)
        if same:
            state = state.drop("need").join(known.select(*KEY, full.alias("need")), KEY, "left")
        else:
            each = state.select(*KEY, F.explode("windows").alias("w")).select(*KEY, "w.*").join(known.select(*KEY, "window", full.alias("tenth")), [*KEY, "window"], "left")
            each = each.withColumn("need", F.greatest("need", "tenth"))
            each = each.groupBy(*KEY).agg(F.collect_list(F.struct("window", "need", "high")).alias("windows"), F.min("need").alias("need"))
            state = state.drop("windows", "need").join(each, KEY)
        # beyond the known counts all cells have been seen
        state, quota = work_table(state.filter(F.col("seen") < len(index.counts))), quota * MORE
        if not state.limit(1).count():
            return known


def mine(df: DataFrame, id_: str, vector: str, label: str, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor (a row for which
    is_anchor, over the columns vec_id and label, holds) and each of its positives (the first other rows of its label), the first
    rows of other labels whose score is between low and high percent of the positive's.

    Scores are inner products of whole numbers (vectors.whole), higher ones first, ties by the smaller id. Rows without an id or
    label, and those whose vector is null or has a null or non-finite component, take no part. Rows that repeat an id, label and
    vector count once; those that share an id only are rows of their own, as anchors too. Shorter vectors (empty ones too) count
    as zero beyond their end. An anchor whose positive has a negative score has no negatives for it. Scores beyond 64 bits are not
    supported. An empty table gives no rows; other columns, of any name, don't matter.
    """
    spark = df.sparkSession
    rows = work_table(df.select(F.col(id_).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), whole(F.col(vector)).alias("x")).filter("vec_id is not null and label is not null and x is not null"))
    built, empty = build(rows), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if built is None:
        return spark.createDataFrame([], empty)
    index, cells, blocks = built
    anchors = work_table(rows.filter(is_anchor).distinct().withColumn("tag", F.xxhash64("label", "x")))
    start = anchors.withColumns({"need": F.lit(None).cast("long"), "seen": F.lit(0)})
    near = _search(index, cells, blocks, start, positives, True)
    each = work_table(near.select(*KEY, F.explode("found").alias("p")).select(*KEY, F.col("p.nth").alias("window"), F.col("p.other_id").alias("positive_id"), F.col("p.score").alias("positive_score")))
    # the whole scores between the bounds; a window that holds none isn't asked for
    part = lambda percent: f"CAST(floor({percent} * CAST(positive_score AS DECIMAL(20, 0)) / 100) AS BIGINT)"
    bounds = each.selectExpr(*KEY, f"struct(window, -({part(-low)}) AS need, {part(high)} AS high) AS w").filter("w.need <= w.high")
    windows = anchors.join(bounds.groupBy(*KEY).agg(F.collect_list("w").alias("windows"), F.min("w.need").alias("need")), KEY).withColumn("seen", F.lit(0))
    hard = _search(index, cells, blocks, work_table(windows), negatives, False)
    out = hard.select(*KEY, "window", F.explode("found").alias("n")).join(each, [*KEY, "window"])
    return out.select(F.col("vec_id").alias("anchor_id"), "positive_id", F.col("n.nth").alias("rank"), F.col("n.other_id").alias("negative_id"), "positive_score", F.col("n.score").alias("negative_score"))


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(rows.select("vec_id", "embedding", moved.alias("label")), "vec_id", "embedding", "label", F.col("vec_id") % 100 == 0)


ORACLE = """WITH r AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS BIGINT) AS label,
  list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score FROM r a, r b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM s JOIN p USING (anchor_id) WHERE label <> anchor_label AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10"""

"""Near copies among vectors: spherical k-means cells, blocked cosine products inside cells, one kept per group.

Equal vectors become one with a count first. Centroids are fitted on at most ``SAMPLE`` vectors. Centroids that are
linked by cosines of the threshold or more are one cell, so a crowd of near copies, which draws many of them, stays
together. Every vector is a member of its ``PROBES`` nearest cells, so that close vectors on two sides of a border still
meet; a cell is as near as its nearest centroid, and cells too far beyond the nearest one to matter for any pair are left
out. Cells are cut into blocks, and every pair of blocks of a cell is a task. A pair that meets in several cells counts in the first of them. A
task gives a number of links and one edge for each of its vectors, never pairs. The number of centroids follows the root of the
number of vectors; the work of a crowd grows with the square of its size, as its links do. Links are exact cosines in double precision; a pair that shares no cell is missed: the tests ask for
a recall of 0.9 against brute force on pairs just over the threshold, and on a crowd of a third of the rows.

Defined results: vectors that are null, zero, of another dimension than most, or hold null or non-finite components link
with nothing and are kept; rows that repeat an id count once; null ids are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentispark.llm.vectors import identified, matrix, usable
from sentispark.operators.components import connected_components
from sentispark.session import cut_lineage

#: Vectors the centroids are fitted on at most, rounds of the fit, cells each vector belongs to, and rows of a block.
SAMPLE, ROUNDS, PROBES, BLOCK = 20_000, 6, 6, 2048
#: Fills the lists of cells; sorts behind all cells.
NO_CELL = np.iinfo(np.int32).max


def near_vectors(df: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept``."""
    every = cut_lineage(identified(df, id_col, vec_col))
    fit = usable(every)
    distinct = cut_lineage(fit.groupBy("vec").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    copies = fit.join(distinct, "vec").select("id", "rep", "copies")
    centres, begins = merged(centroids(distinct), threshold)
    cells = cut_lineage(distinct.mapInArrow(lambda b: _assign(b, centres, begins, threshold),
                                            "cell int, cells array<int>, rep long, copies long, vec array<double>"))
    blocks = cells.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = cells.join(blocks, "cell").withColumn("b", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    tiles = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select("cell", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "cells", "rep", "copies", "vec")
    found = cut_lineage(tiles.groupBy("cell", "i", "j").applyInArrow(lambda rows: _tile(rows, threshold), "rep long, links long, least long"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    component = connected_components(found.select(F.col("rep").alias("src"), F.col("least").alias("dst"))).select(
        F.col("id").alias("rep"), "component")
    told = copies.join(links, "rep", "left").join(component, "rep", "left").select(
        "id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    return (every.select("id").join(told, "id", "left")
            .select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))


def centroids(distinct: DataFrame) -> np.ndarray:
    """Unit centroids of a spherical k-means over a sample in hash order."""
    n = distinct.count()
    sample = distinct.orderBy(F.xxhash64("rep")).limit(SAMPLE).select("rep", "vec").toArrow()
    if not n:
        return np.zeros((1, 1))
    x = unit(matrix(sample["vec"])[np.argsort(sample["rep"].to_numpy())])
    k = min(int(np.ceil(np.sqrt(n))), max(1, len(x) // 8))
    c = x[np.random.default_rng(7).choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        nearest = np.concatenate([(x[a:a + 4096] @ c.T).argmax(1) for a in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, nearest, x)
        size = np.sqrt((total ** 2).sum(1))
        c = np.where(size[:, None] > 1e-9, total / np.maximum(size, 1e-9)[:, None], c)
    return c


def merged(centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The centroids in order of their cells, and where each cell begins."""
    label = _spread(np.arange(len(centres)), *np.nonzero(centres @ centres.T >= threshold))
    order = np.argsort(label, kind="stable")
    return centres[order], np.unique(label[order], return_index=True)[1]


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x ** 2).sum(1, keepdims=True))


def _assign(batches: Iterator[pa.RecordBatch], centres: np.ndarray, begins: np.ndarray, threshold: float) -> Iterator[pa.RecordBatch]:
    probes = min(PROBES, len(begins))
    # Two vectors of a pair that share a cell share one that is no farther than this beyond the nearest cell of each.
    reach = 2 * np.arccos(np.clip(threshold, -1, 1)) + 1e-6
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            rows = batch.slice(at, 1024)
            near = np.maximum.reduceat(unit(matrix(rows.column("vec"))) @ centres.T, begins, axis=1)
            cells = np.argpartition(-near, probes - 1, axis=1)[:, :probes].astype(np.int32)
            angle = np.arccos(np.clip(np.take_along_axis(near, cells, 1), -1, 1))
            cells = np.sort(np.where(angle <= angle.min(1, keepdims=True) + reach, cells, NO_CELL), axis=1)
            used = cells != NO_CELL
            take = pa.array(np.repeat(np.arange(len(cells)), used.sum(1)))
            flat = pa.array(cells[take.to_numpy()].ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(take) + 1, dtype=np.int32) * probes), flat)
            yield pa.RecordBatch.from_arrays([pa.array(cells[used]), lists, *(rows.column(c).take(take) for c in ("rep", "copies", "vec"))],
                                             ["cell", "cells", "rep", "copies", "vec"])


def _tile(rows: pa.Table, threshold: float) -> pa.Table:
    cell, i, j = (rows[c][0].as_py() for c in ("cell", "i", "j"))
    block, rep, copies = (rows[c].to_numpy() for c in ("b", "rep", "copies"))
    x = unit(matrix(rows["vec"]))
    cells = matrix(rows["cells"]).astype(np.int32)
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    links, label = np.zeros(len(rep), np.int64), rep.copy()
    weight, leads = copies.astype(np.float64), cells[:, 0] == cell
    for at in range(0, len(left), 512):
        part = left[at:at + 512]
        near = x[part] @ x[right].T >= threshold
        if i == j:
            near &= part[:, None] < right
        if not near.any():
            continue
        u, v = np.nonzero(near & ~(leads[part][:, None] | leads[right]))
        for k in range(0, len(u), 100_000):  # pairs that may have met in an earlier cell
            a, b = u[k:k + 100_000], v[k:k + 100_000]
            first = np.full(len(a), NO_CELL, np.int32)
            for p in range(cells.shape[1]):
                probe = cells[part[a], p]
                shared = (cells[right[b]] == probe[:, None]).any(1)
                first = np.where(shared & (probe < first), probe, first)
            near[a, b] = first == cell
        dense = near.astype(np.float64)
        links[part] += (dense @ weight[right]).astype(np.int64)
        links[right] += (weight[part] @ dense).astype(np.int64)
        a, b = np.nonzero(near & (label[part][:, None] != label[right]))
        label = _spread(label, part[a], right[b])
    hit = np.flatnonzero(links)
    return pa.table({"rep": rep[hit], "links": links[hit], "least": label[hit]})


def _spread(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the classes of each pair: every class takes its least label. Labels of earlier pairs stay joined."""
    names, of = np.unique(label, return_inverse=True)
    least = np.arange(len(names))
    a, b = of[a], of[b]
    while True:
        low = np.minimum(least[a], least[b])
        new = least.copy()
        np.minimum.at(new, least[a], low)
        np.minimum.at(new, least[b], low)
        new = np.minimum(new, new[new])
        if (new == least).all():
            return names[least[of]]
        least = new

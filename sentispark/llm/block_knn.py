"""Nearest neighbours by inner product: a block matrix join of 8-bit tiles with error bounds, exact in the end.

Queries and candidates are cut into blocks; every pair of a query block and a candidate block is a task that holds two
blocks and nothing else. A tile multiplies 8-bit codes. For codes ``x = s c + e`` the product of the codes is off by at
most ``|e_x| |y| + |s_x c_x| |e_y|``; a pair survives where the upper bound reaches the k-th best lower bound of its
query, so no true neighbour is lost. Survivors are computed anew in double precision and merged by heaps over the parts
of a tile; the best of each tile are ranked over all tiles.

Defined results: vectors that are null, zero, of another dimension than most, or hold null or non-finite components take
no part, as query or candidate; rows that repeat an id count once; null ids are left out; ties go to the smaller id; with
fewer than ``k`` candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sentispark.llm.vectors import identified, matrix, usable
from sentispark.session import cut_lineage

#: Rows of a block of candidates and of queries, and the part of a tile that is multiplied at a time.
CANDIDATES, QUERIES, STRIP = 8192, 2048, 256
_FOUND = "query_id long, vec_id long, score double"


def nearest(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``; ``is_query`` is a condition on the column ``id``."""
    rows = cut_lineage(usable(identified(df, id_col, vec_col)))
    queries = rows.where(is_query)
    n, m = rows.count(), queries.count()
    across, down = max(1, -(-n // CANDIDATES)), max(1, -(-m // QUERIES))
    left = _dealt(queries, down, "q").withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    right = _dealt(rows, across, "c").withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    sides = left.select("q", "c", F.lit(True).alias("asks"), "id", "vec").union(right.select("q", "c", F.lit(False), "id", "vec"))
    found = sides.groupBy("q", "c").applyInArrow(lambda rows: _tile(rows, k), _FOUND)
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _dealt(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    return rows.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes as 8-bit numbers, scale, length of the error and length of what the codes stand for."""
    scale = np.abs(x).max(1) / 127
    scale[scale == 0] = 1
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    near = codes * scale[:, None]
    return codes, scale, np.sqrt(((x - near) ** 2).sum(1)), np.sqrt((near ** 2).sum(1))


def _tile(rows: pa.Table, k: int) -> pa.Table:
    asks = rows["asks"].to_numpy()
    ids, x = rows["id"].to_numpy(), matrix(rows["vec"]) if rows.num_rows else np.zeros((0, 1))
    qid, q, cid, c = ids[asks], x[asks], ids[~asks], x[~asks]
    order = np.argsort(cid)
    cid, c = cid[order], c[order]
    heaps: list[list[tuple[float, int]]] = [[] for _ in qid]
    if len(qid) and len(cid):
        # whole numbers below 2^24 are exact as floats, and float products are the fast ones
        wide = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
        qc, qs, qe, qn = quantised(q)
        cc, cs, ce, cn = quantised(c)
        length = np.sqrt((c ** 2).sum(1))
        codes = cc.astype(wide).T
        for at in range(0, len(qid), STRIP):
            s = slice(at, at + STRIP)
            product = (qc[s].astype(wide) @ codes).astype(np.float64) * qs[s, None] * cs
            bound = (qe[s, None] * length + qn[s, None] * ce) * (1 + 1e-9) + 1e-12
            bound[qid[s, None] == cid] = np.inf
            product[qid[s, None] == cid] = -np.inf
            lower = np.where(np.isinf(bound), -np.inf, product - bound)
            floor = np.partition(lower, max(len(cid) - k, 0), axis=1)[:, max(len(cid) - k, 0)]
            row, column = np.nonzero((np.where(np.isinf(bound), -np.inf, product + bound) >= floor[:, None]) & np.isfinite(product))
            score = np.zeros(len(row))
            for d in range(x.shape[1]):  # in the order of the components, as anyone would sum them
                score += q[at + row, d] * c[column, d]
            for i, v, j in zip((at + row).tolist(), score.tolist(), cid[column].tolist()):
                heap = heaps[i]
                if len(heap) < k:
                    heapq.heappush(heap, (v, -j))
                elif (v, -j) > heap[0]:
                    heapq.heapreplace(heap, (v, -j))
    out = [(int(a), -j, v) for a, heap in zip(qid, heaps) for v, j in heap]
    return pa.table({"query_id": pa.array([r[0] for r in out], pa.int64()), "vec_id": pa.array([r[1] for r in out], pa.int64()),
                     "score": pa.array([r[2] for r in out], pa.float64())})

"""Exact top-k search by inner product: the threshold algorithm over sorted per-dimension lists.

Each task makes blocks of the candidates it reads, without a shuffle. A block keeps its rows in the order in which sorted
access meets them, that is by their best place from either end of any of the per-dimension lists: reading all lists to depth
h is reading a prefix of the block, and the lists themselves are needed only at the depths where reading may stop. Queries
read a block together: before it and after each deepening a query leaves when the sum of its weights times the values at the
current depth, an upper bound for every unread row, is below its kth score; new rows are scored (random access). The k best
are carried from block to block, so that later blocks may be left at once.

Slices of queries meet groups of blocks: candidates are sent once for each slice of slice_rows queries and queries once for
each group of group_rows candidates, both as the smallest integers that hold them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import stored

BLOCK_SCHEMA = "part int, seq int, ids binary, rows binary, size int, reach binary, upto binary, highs binary, lows binary, n int, dim int"
LEAST = np.iinfo(np.int64).min


def _matrix(vectors) -> np.ndarray:
    """Rows as int64; shorter vectors are filled with zeros, which add nothing to a product."""
    dim = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _packed(rows: np.ndarray) -> tuple[bytes, int]:
    """The rows as integers of the smallest size in bytes that holds them."""
    most = max(int(rows.max(initial=0)), -int(rows.min(initial=0)) - 1)
    size = next(b for b in (2, 4, 8) if most < 1 << (8 * b - 1))
    return rows.astype(f"<i{size}").tobytes(), size


def _unpacked(raw: bytes, size: int, n: int, dim: int, wide: int) -> np.ndarray:
    return np.pad(np.frombuffer(raw, f"<i{size}").reshape(n, dim), ((0, 0), (0, wide - dim)))


def build_block(ids: np.ndarray, rows: np.ndarray, first: int = 64) -> dict:
    """Sort each dimension's list once and keep the rows in the order in which sorted access meets them. reach: depths at
    which reading may stop; upto: rows met before each; highs, lows: what the lists hold at each depth."""
    n, dim = rows.shape
    depth = np.full(n, n, np.int64) if dim else np.zeros(n, np.int64)
    for d in range(dim):
        place = np.empty(n, np.int64)
        place[np.argsort(rows[:, d], kind="stable")] = np.arange(n)
        np.minimum(depth, np.minimum(place, n - 1 - place), out=depth)
    met = np.argsort(depth, kind="stable")
    reach = [0]
    while reach[-1] < n:
        reach.append(min(n, max(first, 2 * reach[-1])))
    at = np.array(reach)
    lists = np.sort(rows, axis=0)
    stop = np.minimum(at, n - 1)
    return {"ids": ids[met], "rows": rows[met], "reach": at, "upto": np.searchsorted(depth[met], at), "highs": lists[::-1][stop], "lows": lists[stop]}


def _blocks(batches, block_rows: int):
    part, seq, ids, vectors = TaskContext.get().partitionId(), 0, [], []

    def made():
        block = build_block(np.array(ids, np.int64), _matrix(vectors))
        rows, size = _packed(block["rows"])
        n, dim = block["rows"].shape
        raw = {k: block[k].astype("<i8").tobytes() for k in ("ids", "reach", "upto", "highs", "lows")}
        return pd.DataFrame([{"part": part, "seq": seq, **raw, "rows": rows, "size": size, "n": n, "dim": dim}])[[c.split()[0] for c in BLOCK_SCHEMA.split(", ")]]

    for pdf in batches:
        for i, v in zip(pdf["id"], pdf["vec"], strict=True):
            ids.append(i)
            vectors.append(v)
            if len(ids) == block_rows:
                yield made()
                seq, ids, vectors = seq + 1, [], []
    if ids:
        yield made()


def best_of(s: np.ndarray, i: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best scores and their ids of each row; of those at the kth score the smallest ids stay."""
    if s.shape[1] <= k:
        return s, i
    edge = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
    above, level = s > edge[:, None], s == edge[:, None]
    room = k - above.sum(1)
    keep = above | level
    for r in np.flatnonzero(level.sum(1) > room):
        tied = np.flatnonzero(level[r])
        keep[r, tied] = False
        keep[r, tied[np.argpartition(i[r, tied], room[r] - 1)[: room[r]]]] = True
    cols = np.nonzero(keep)[1].reshape(len(s), k)
    return np.take_along_axis(s, cols, 1), np.take_along_axis(i, cols, 1)


def threshold_search(block: dict, qids: np.ndarray, queries: np.ndarray, best_s: np.ndarray, best_i: np.ndarray, k: int) -> int:
    """Read a block for all queries; best_s and best_i (one row a query, k columns, LEAST where there is none yet) are brought
    up to date. Returns how many rows were scored, summed over the queries."""
    rows, ids = block["rows"], block["ids"]
    largest = (int(np.abs(rows).max(initial=0)) + 1) * (int(np.abs(queries).max(initial=0)) + 1) * max(rows.shape[1], 1)
    kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else np.int64
    rows, weights = rows.astype(kind), queries.astype(kind)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    active, at, scored = np.arange(len(queries)), 0, 0
    for step, to in enumerate(block["upto"].tolist()):
        if to > at:
            s = (weights[active] @ rows[at:to].T).astype(np.int64)
            scored += s.size
            i = np.broadcast_to(ids[at:to], s.shape)
            s = np.where(i == qids[active][:, None], LEAST, s)
            best_s[active], best_i[active] = best_of(np.concatenate([best_s[active], s], 1), np.concatenate([best_i[active], i], 1), k)
            at = to
        bound = up[active] @ block["highs"][step] + down[active] @ block["lows"][step]
        active = active[best_s[active].min(1) <= bound]
        if at == len(ids) or not len(active):
            break
    return scored


def exact_topk(queries: DataFrame, candidates: DataFrame, k: int = 20, block_rows: int = 8192, slice_rows: int = 65_536, group_rows: int = 131_072) -> DataFrame:
    """queries, candidates: (id long, vec array<bigint>) -> (query_id, rank, vec_id, score), k rows for each query.

    A candidate with the query's own id is left out. Rows with a null id or vector take no part. Candidates with one id are
    each a candidate of their own; queries with one id are asked one after the other and rank together. Fewer than k
    candidates: all of them. Either side empty: no rows. Extra columns are ignored; arrays may differ in length (zeros are
    added). No score is estimated and no list is cut: the bound stops only reading that cannot matter.
    """

    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<bigint>").alias("vec")).dropna()

    def made(df: DataFrame, rows: int) -> DataFrame:
        return stored(clean(df).mapInPandas(lambda it: _blocks(it, rows), BLOCK_SCHEMA))

    blocks, asked = made(candidates, block_rows), made(queries, 4096)
    n_c, n_q = (df.agg(F.sum("n")).first()[0] or 0 for df in (blocks, asked))
    slices = -(-n_q // slice_rows) or 1
    spread = min(-(-n_c // block_rows), blocks.sparkSession.sparkContext.defaultParallelism)
    groups = max(-(-n_c // group_rows), spread, 1)

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("part", "seq"), F.lit(n_own)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        wide = max([0, *left["dim"], *right["dim"]])
        qids = np.concatenate([np.frombuffer(x, "<i8") for x in left["ids"]] or [np.zeros(0, np.int64)])
        asked_ = np.concatenate([_unpacked(r.rows, r.size, r.n, r.dim, wide) for r in left.itertuples(index=False)] or [np.zeros((0, wide), np.int64)]).astype(np.int64)
        best_s, best_i = np.full((len(qids), k), LEAST), np.full((len(qids), k), np.iinfo(np.int64).max)
        for r in right.itertuples(index=False):
            block = {c: np.frombuffer(getattr(r, c), "<i8") for c in ("ids", "reach", "upto")} | {c: _unpacked(getattr(r, c), 8, len(r.upto) // 8, r.dim, wide) for c in ("highs", "lows")} | {"rows": _unpacked(r.rows, r.size, r.n, r.dim, wide)}
            for at in range(0, len(qids), 1024):
                own = slice(at, at + 1024)
                threshold_search(block, qids[own], asked_[own], best_s[own], best_i[own], k)
        q, c = np.nonzero(best_s > LEAST)
        return pd.DataFrame({"query_id": qids[q], "vec_id": best_i[q, c], "score": best_s[q, c]})

    left, right = dealt(asked, "qs", slices, "cg", groups), dealt(blocks, "cg", groups, "qs", slices)
    met = left.groupBy("qs", "cg").cogroup(right.groupBy("qs", "cg")).applyInPandas(meet, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def scaled(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(id, vec): each component x becomes floor(scale * x), x as double; vectors that are null or hold a null or
    non-finite component are left out."""
    v = F.col(vector_col)
    fine = v.isNotNull() & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return df.filter(fine).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("vec"))


def op1_topk(spark, sf_dir: str) -> DataFrame:
    vectors = scaled(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return exact_topk(vectors.filter(F.col("id") % 20 == 0), vectors, k=20)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

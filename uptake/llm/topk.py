"""Exact top-k inner products.

Vectors are turned into an orthogonal basis taken from the singular vectors of the whole table,
so that the first coordinates hold most of every product, and ordered by length. A task holds
one block of queries and one stripe of the vectors; every stripe has long and short vectors.
Blocks of a stripe are visited from long to short. A block whose longest vector times the
query's length cannot reach the query's k-th score ends the stripe for that query. Otherwise
the product of the first coordinates plus the product of the residual lengths bounds each score
from above (Cauchy-Schwarz), and only vectors that may reach the k-th score get an exact integer
product. The stripes' k best are merged per query.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.llm.common import stored

K = 20
SCALE = 64
QUERY_BLOCK = 2048
STRIPE = 16384
VECTOR_BLOCK = 1024
HEAD = 16
EXACT_DOUBLE = float(1 << 53)
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1

_FOUND = "query_row long, query_id long, vec_id long, score long"


def floored(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, null for a vector that takes no part."""
    parts = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    usable = F.forall(
        vector,
        lambda x: x.isNotNull()
        & ~F.isnan(x.cast("double"))
        & (F.abs(x.cast("double")) < float("inf")),
    )
    return F.when(vector.isNotNull() & usable, parts.cast("array<long>"))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _gram(width: int) -> Callable:
    """Sums of the products of all pairs of coordinates: ``width`` squared numbers a task."""

    def add(batches):
        total = np.zeros((width, width))
        for rows in batches:
            m = _matrix(rows["v"], width).astype(np.float64)
            total += m.T @ m
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "s": total.ravel()})

    return add


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of the table of vectors, strongest first.

    Only ``width`` squared sums reach the driver. Any orthogonal basis gives right results, so
    rounding costs pruning at most.
    """
    sums = vectors.mapInPandas(_gram(width), "i int, j int, s double")
    rows = sums.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    gram = np.zeros((width, width))
    for r in rows:
        gram[r["i"], r["j"]] = r["s"] if np.isfinite(r["s"]) else 0
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


def _exact(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer products, by doubles while no partial sum can be rounded."""
    most = np.abs(queries.astype(np.float64)).sum(1).max(initial=0)
    most *= np.abs(vectors.astype(np.float64)).max(initial=0)
    if most < EXACT_DOUBLE:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    products = queries.astype(object) @ vectors.T.astype(object)
    return np.clip(products, LEAST_LONG, MOST_LONG).astype(np.int64)


def search(
    queries: np.ndarray,
    query_ids: np.ndarray,
    vectors: np.ndarray,
    ids: np.ndarray,
    basis: np.ndarray,
    k: int = K,
    head: int = HEAD,
    block: int = VECTOR_BLOCK,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids and scores of the k best vectors of each query, those with its own id left out."""
    turned_q, turned_v = queries @ basis, vectors @ basis
    length_q, length_v = np.linalg.norm(turned_q, axis=1), np.linalg.norm(turned_v, axis=1)
    order = np.lexsort((ids, -length_v))
    vectors, ids, turned_v, length_v = (x[order] for x in (vectors, ids, turned_v, length_v))
    rest_q = np.linalg.norm(turned_q[:, head:], axis=1)
    rest_v = np.linalg.norm(turned_v[:, head:], axis=1)
    best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(queries)
    least = np.full(len(queries), -np.inf)
    # Doubles round: a bound must not fall below the true score for that.
    slack = 1e-9 * length_q * (length_v.max(initial=0)) + 1e-6
    for a in range(0, len(vectors), block):
        part = slice(a, a + block)
        live = np.flatnonzero(length_q * length_v[a] + slack >= least)
        if not len(live):
            break
        bound = turned_q[live, :head] @ turned_v[part, :head].T
        bound += np.outer(rest_q[live], rest_v[part])
        reach = bound + slack[live, None] >= least[live, None]
        columns = np.flatnonzero(reach.any(0))
        scores = _exact(queries[live], vectors[part][columns])
        reach = reach[:, columns] & (scores >= least[live, None])
        for row, q in enumerate(live.tolist()):
            found = np.flatnonzero(reach[row])
            found_ids = ids[part][columns[found]]
            own = found_ids != query_ids[q]
            if not own.any():
                continue
            all_ids = np.r_[best[q][0], found_ids[own]]
            all_scores = np.r_[best[q][1], scores[row, found][own]]
            # ~score falls as the score rises, and has no overflow at the least long.
            keep = np.lexsort((all_ids, ~all_scores))[:k]
            best[q] = all_ids[keep], all_scores[keep]
            if len(keep) == k:
                least[q] = float(all_scores[keep[-1]])
    return best


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    k: int = K,
) -> DataFrame:
    """The ``k`` highest integer products of every query row: ``query_id``, ``rank``, ``vec_id``
    and ``score``; ties go to the smaller id.

    Rows with a null id or an unusable vector (null, or with a null or non-finite component)
    take no part. A vector shorter than others counts as padded by zeros; an empty one scores 0.
    Rows equal in id and vector are one row. An id with several vectors is several candidates,
    and several queries; a query leaves out all rows with its own id. Scores beyond a long are
    cut to its range. No rows give no rows. Other columns are not looked at.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        floored(F.col(vector_col), scale).alias("v"),
        is_query.alias("q"),
    )
    rows = rows.where("id IS NOT NULL AND v IS NOT NULL").distinct()
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    count, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not count or not width:
        basis, width = np.eye(1), 1
    else:
        basis = rotation(rows.select("v"), width)
    stripes = max(1, -(-count // STRIPE))
    blocks = max(1, -(-rows.where("q").count() // QUERY_BLOCK))

    # Every block of queries meets every stripe: both sides name the pair they belong to.
    stripe = F.pmod(F.xxhash64("row"), F.lit(stripes)).cast("int")
    block = F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(blocks)).cast("int")
    candidates = rows.select(
        "row", "id", "v", F.lit(False).alias("q"), stripe.alias("stripe"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    queries = rows.where("q").select(
        "row", "id", "v", F.lit(True).alias("q"),
        F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"),
        block.alias("block"),
    )

    def searched(group: pd.DataFrame) -> pd.DataFrame:
        q, c = group[group["q"]], group[~group["q"]]
        q = q.reset_index(drop=True)
        found = search(
            _matrix(q["v"], width), q["id"].to_numpy(np.int64),
            _matrix(c["v"], width), c["id"].to_numpy(np.int64), basis, k,
        )
        sizes = [len(ids) for ids, _ in found]
        empty = [np.empty(0, np.int64)]
        return pd.DataFrame(
            {
                "query_row": np.repeat(q["row"].to_numpy(np.int64), sizes),
                "query_id": np.repeat(q["id"].to_numpy(np.int64), sizes),
                "vec_id": np.concatenate([ids for ids, _ in found] or empty),
                "score": np.concatenate([scores for _, scores in found] or empty),
            }
        )

    found = (
        candidates.unionByName(queries)
        .groupBy("stripe", "block")
        .applyInPandas(searched, _FOUND)
    )
    ranked = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

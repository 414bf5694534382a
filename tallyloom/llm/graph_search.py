"""Nearest neighbours by cosine over robust-pruned directed graphs, one per shard.

Vectors are dealt to shards of about ``shard_rows`` by a hash of the vector, so
no shard grows with the table. In each shard a graph is built in two rounds: a
greedy beam search proposes neighbours for every vector, and relaxed distance
pruning keeps those that no kept one is much closer to (``alpha``), at most
``degree`` of them. A query walks every shard's graph with a beam of ``beam``
candidates; those are scored again in double precision on the original vectors.

Copies of a vector are one node, which carries the smallest ids; as ties go to
smaller ids, more of them than are asked for can never be wanted. So a large
group of copies neither fills a shard nor a beam.

All rows are indexed. Queries travel to the shards: a task walks one shard's graph
for all queries, or for a block of ``block_rows`` where there are more, so the
index is shuffled once for that many queries. It is a written table, so a lost
executor costs one block.

Defined results: vectors that are null, empty or zero, or hold a null or a
non-finite component, take no part; vectors meet only those of their own length;
rows alike in id and vector are one row; an id with several vectors is as near as
the nearest pair of its vectors and the query's; a query's own id is no answer to
it; null ids take no part; fewer candidates than asked for are all returned; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import materialize

#: Nodes expanded at a time in each search.
_WIDTH = 4
#: Searches made side by side.
_BATCH = 256


def usable(vector: str) -> Column:
    v = F.col(vector)
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled by a power of two first, so that no square over- or underflows."""
    scaled = np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1))[1][:, None])
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the rows of ``b`` beside it, in double precision."""
    a = np.ldexp(a, -np.frexp(np.abs(a).max(axis=-1))[1][..., None])
    b = np.ldexp(b, -np.frexp(np.abs(b).max(axis=-1))[1][..., None])
    dots = np.einsum("id,ikd->ik", a, b)
    return dots / (np.sqrt(np.einsum("id,id->i", a, a))[:, None] * np.sqrt(np.einsum("ikd,ikd->ik", b, b)))


def beam_search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, start: int, beam: int):
    """Nodes and squared distances nearest to each query (-1 where there are fewer), and all nodes expanded."""
    n, m = len(x), len(queries)
    rows = np.arange(m)[:, None]
    nodes = np.full((m, beam), -1, dtype=np.int32)
    dist = np.full((m, beam), np.inf, dtype=np.float32)
    fresh = np.zeros((m, beam), dtype=bool)
    seen = np.zeros((m, n + 1), dtype=bool)  # the last column stands for no node
    seen[:, n] = True
    nodes[:, 0], dist[:, 0], fresh[:, 0] = start, 2 - 2 * (queries @ x[start]), True
    seen[:, start] = True
    expanded = []
    width = min(_WIDTH, beam)
    while fresh.any():
        open_dist = np.where(fresh, dist, np.inf)
        best = np.argpartition(open_dist, width - 1, axis=1)[:, :width]
        chosen = np.where(fresh[rows, best], nodes[rows, best], -1)
        fresh[rows, best] = False
        expanded.append(chosen)
        found = np.where(chosen[:, :, None] >= 0, graph[chosen], -1).reshape(m, -1)
        found = np.sort(np.where(found >= 0, found, n), axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = n
        found[seen[rows, found]] = n
        seen[rows, found] = True
        known = found < n
        near = 2 - 2 * np.einsum("mkd,md->mk", x[np.where(known, found, 0)], queries)
        near[~known] = np.inf
        all_dist = np.concatenate([dist, near], axis=1)
        keep = np.argpartition(all_dist, beam - 1, axis=1)[:, :beam]
        nodes = np.concatenate([nodes, np.where(known, found, -1).astype(np.int32)], axis=1)[rows, keep]
        fresh = np.concatenate([fresh, known], axis=1)[rows, keep]
        dist = all_dist[rows, keep]
    return nodes, dist, np.concatenate(expanded, axis=1)


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` neighbours of each point: the nearest candidate left, then without all that
    are ``alpha`` times nearer to it than to the point, and so on. -1 stands for none."""
    candidates = np.sort(candidates, axis=1)
    none = candidates < 0
    none[:, 1:] |= candidates[:, 1:] == candidates[:, :-1]
    none |= candidates == points[:, None]
    vectors = x[np.where(none, 0, candidates)]
    to_point = np.where(none, np.inf, 2 - 2 * np.einsum("mkd,md->mk", vectors, x[points]))
    between = 2 - 2 * (vectors @ vectors.transpose(0, 2, 1))
    rows = np.arange(len(points))
    kept = np.full((len(points), degree), -1, dtype=np.int32)
    left = to_point.copy()
    for k in range(degree):
        best = np.argmin(left, axis=1)
        some = np.isfinite(left[rows, best])
        if not some.any():
            break
        kept[some, k] = candidates[rows, best][some]
        covered = alpha**2 * between[rows, best] <= to_point
        left[covered & some[:, None]] = np.inf
        left[rows, best] = np.inf
    return kept


def build_graph(x: np.ndarray, degree: int, beam: int, alpha: float, seed: int) -> tuple[np.ndarray, int]:
    """The neighbours of each row of unit vectors ``x``, and the row where searches start."""
    n = len(x)
    start = int(np.argmax(x @ x.mean(axis=0)))
    if n <= degree + 1:
        everyone = np.tile(np.arange(n, dtype=np.int32), (n, 1))
        return np.where(everyone == np.arange(n)[:, None], -1, everyone).astype(np.int32), start
    random = np.random.default_rng(seed)
    graph = random.integers(0, n, (n, degree), dtype=np.int32)
    for slack in (1.0, alpha):
        order = random.permutation(n).astype(np.int32)
        for at in range(0, n, _BATCH):
            points = order[at : at + _BATCH]
            near, _, passed = beam_search(x, graph, x[points], start, beam)
            graph[points] = robust_prune(x, points, np.concatenate([near, passed, graph[points]], axis=1), degree, slack)
            _link_back(x, graph, points, degree, slack)
    return graph, start


def _link_back(x: np.ndarray, graph: np.ndarray, points: np.ndarray, degree: int, alpha: float) -> None:
    """Each new neighbour gets an edge back; where that makes too many, it is pruned."""
    sources = np.repeat(points, degree)
    targets = graph[points].ravel()
    sources, targets = sources[targets >= 0], targets[targets >= 0]
    order = np.argsort(targets, kind="stable")
    sources, targets = sources[order], targets[order]
    heads, first, counts = np.unique(targets, return_index=True, return_counts=True)
    for at in range(0, len(heads), _BATCH):
        some = slice(at, at + _BATCH)
        wide = int(counts[some].max())
        offered = np.full((len(heads[some]), wide), -1, dtype=np.int32)
        for k, (f, c) in enumerate(zip(first[some], counts[some], strict=True)):
            offered[k, :c] = sources[f : f + c]
        both = np.concatenate([graph[heads[some]], offered], axis=1)
        ordered = np.sort(both, axis=1)[:, ::-1]
        again = np.zeros_like(ordered, dtype=bool)
        again[:, 1:] = ordered[:, 1:] == ordered[:, :-1]
        ordered = np.sort(np.where(again, -1, ordered), axis=1)[:, ::-1]
        fits = (ordered >= 0).sum(axis=1) <= degree
        rows = heads[some]
        graph[rows[fits]] = ordered[fits, :degree]
        if not fits.all():
            graph[rows[~fits]] = robust_prune(x, rows[~fits], both[~fits], degree, alpha)


def build_index(
    vectors: DataFrame,
    id_column: str,
    vector: str,
    copies: int,
    shard_rows: int = 4096,
    degree: int = 32,
    beam: int = 64,
    alpha: float = 1.2,
) -> DataFrame:
    """A written table with a row per shard: its distinct vectors, their ``copies`` smallest ids, and the graph."""
    rows = (
        vectors.filter(usable(vector) & F.col(id_column).isNotNull())
        .select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
        .distinct()
    )
    by_id = Window.partitionBy("v").orderBy("id")
    nodes = materialize(
        rows.withColumn("place", F.row_number().over(by_id))
        .filter(F.col("place") <= copies)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("id")).alias("ids")),
        "nodes",
    )
    shards = F.lit(max(1, -(-nodes.count() // shard_rows)))
    dealt = nodes.withColumn("dim", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("v"), shards))

    def build(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.assign(first=[ids[0] for ids in shard["ids"]]).sort_values("first")  # as if never shuffled
        raw = np.stack(shard["v"].to_numpy()).astype(np.float64)
        graph, start = build_graph(unit(raw).astype(np.float32), degree, beam, alpha, seed=int(shard["shard"].iloc[0]))
        ids = np.full((len(raw), copies), -1, dtype=np.int64)
        held = np.zeros(len(raw), dtype=np.int32)
        for k, own in enumerate(shard["ids"]):
            ids[k, : len(own)], held[k] = own, len(own)
        return pd.DataFrame(
            {
                "dim": [raw.shape[1]], "shard": [shard["shard"].iloc[0]], "n": [len(raw)], "start": [start],
                "vectors": [raw.tobytes()], "ids": [ids.tobytes()], "held": [held.tobytes()], "graph": [graph.tobytes()],
            }
        )

    schema = "dim int, shard long, n long, start long, vectors binary, ids binary, held binary, graph binary"
    return materialize(dealt.groupBy("dim", "shard").applyInPandas(build, schema), "graphs")


def search(
    index: DataFrame,
    queries: DataFrame,
    id_column: str,
    vector: str,
    k: int,
    copies: int,
    beam: int = 192,
    block_rows: int = 65_536,
) -> DataFrame:
    """The ``k`` nearest ids that each query's walk through every shard finds: query_id, rank, vec_id, score."""
    asked = materialize(
        queries.filter(usable(vector) & F.col(id_column).isNotNull())
        .select(F.col(id_column).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("v"))
        .distinct(),
        "asked",
    )
    blocks = max(1, -(-asked.count() // block_rows))
    keyed = asked.withColumn("q_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    at = index.select(F.col("dim").alias("q_dim"), F.col("shard").alias("q_shard"))
    # every query visits every shard of its length: that is the search asked for
    visiting = keyed.join(at, F.size("v") == F.col("q_dim"))
    replicated = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def walk(graphs: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if graphs.empty or block.empty:
            return empty
        g = graphs.iloc[0]
        raw = np.frombuffer(g["vectors"], dtype=np.float64).reshape(g["n"], -1)
        ids = np.frombuffer(g["ids"], dtype=np.int64).reshape(g["n"], copies)
        held = np.frombuffer(g["held"], dtype=np.int32)
        graph = np.frombuffer(g["graph"], dtype=np.int32).reshape(g["n"], -1)
        x = unit(raw).astype(np.float32)
        out: dict[str, list[np.ndarray]] = {"query_id": [], "vec_id": [], "score": []}
        for begin in range(0, len(block), _BATCH):
            some = block.iloc[begin : begin + _BATCH]
            q = np.stack(some["v"].to_numpy()).astype(np.float64)
            nodes, _, _ = beam_search(x, graph, unit(q).astype(np.float32), int(g["start"]), beam)
            score = np.where(nodes >= 0, cosine(q, raw[np.maximum(nodes, 0)]), -np.inf)
            own = some["query_id"].to_numpy()
            for r in range(len(own)):
                real = nodes[r] >= 0
                each = held[nodes[r][real]]
                found = ids[nodes[r][real]][np.arange(copies) < each[:, None]]
                scores = np.repeat(score[r][real], each)
                scores, found = scores[found != own[r]], found[found != own[r]]
                best = np.lexsort((found, -scores))[:k]
                for c, values in (("query_id", np.full(len(best), own[r])), ("vec_id", found[best]), ("score", scores[best])):
                    out[c].append(values)
        return pd.DataFrame({c: np.concatenate(values) for c, values in out.items()})

    found = (
        replicated.groupBy("dim", "shard", "block")
        .cogroup(visiting.groupBy("q_dim", "q_shard", "q_block"))
        .applyInPandas(walk, "query_id long, vec_id long, score double")
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    nearest_pair = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return nearest_pair.withColumn("rank", place).filter(F.col("rank") <= k)


def nearest(
    vectors: DataFrame, queries: DataFrame, id_column: str, vector: str, k: int = 5, shard_rows: int = 4096, beam: int = 192
) -> DataFrame:
    """Each query's ``k`` nearest vectors found: query_id, rank, vec_id, score."""
    copies = k + 1  # one of them may be the query's own
    index = build_index(vectors, id_column, vector, copies, shard_rows)
    return search(index, queries, id_column, vector, k, copies, beam).select("query_id", "rank", "vec_id", "score")

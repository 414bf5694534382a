"""N-gram Jaccard join by a MinHash LSH forest, verified on whole shingle sets.

A document is the set of its ``n``-word shingles (one shingle of all its words
if it has fewer). Documents with the same set are one node. A signature has a
stretch of MinHash values for each of ``trees`` trees, ``longest`` values deep.
Two sets of similarity s share the first d values in some tree with probability
1 - (1 - s^d)^trees; the shortest prefix that is ever needed is the longest one
with which pairs at the threshold reach ``recall``.

1. Each tree is a trie of the sorted stretches. Nodes that share the shortest
   prefix meet in a task, sorted by their stretch. Prefixes are matched at full
   depth first; there whole signatures are compared, and those whose agreement
   could belong to a pair above the threshold (five standard errors below it and
   more) are linked. Then the prefix is shortened level by level, and only what
   is not connected yet is compared, until all rows of the trie node are
   connected or the shortest prefix is done. What is handed on is a forest of
   links, never pairs.
2. Connected nodes are a candidate class. Its members' shingle sets are built
   again from their whole texts and intersected, each pair once; Jaccard
   similarity is compared in whole numbers.
3. Verified links are counted per node, and classes are the connected nodes.

A trie node or class with more rows than a block is dealt to pairs of blocks, so
a task holds two blocks at most and no pair is left out. Two different blocks of
a trie node hand on only links that join what either block has not connected by
itself; a class's pair of blocks hands on a count and a link for each row.

Output per row of ``docs``: class_id (the smallest id of its class), n_links
(different shingle sets that are similar enough to its own) and n_copies (rows
with the same set, itself included).

Defined results: texts without words are alike to nothing: their class is their
own id, with no links and themselves as only copy; rows with a null id have a
null class and are no partners; repeated rows are copies; an empty table gives
an empty one; only the id and the text are read. Shingles are told apart by 64
bits, sets by 128.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import add_columns, materialize
from tallyloom.llm.groups import components, connected, in_blocks, join_rows, per_group
from tallyloom.llm.substring_dedup import _BASES, _mix, _word_hashes, range_hashes, split_words, word_hashes

#: Rows of a trie node, and of a class, that make a block.
NODE_ROWS, CLASS_ROWS = 1_500, 600
#: Values of a signature in each tree.
LONGEST = 7
#: Columns of shingles that are multiplied at a time.
_COLUMNS = 8_192
_SEED = 20_240


def recall_at(similarity: float, depth: int, trees: int) -> float:
    """The probability that two sets share a prefix of ``depth`` values in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def prefix_depth(threshold: float, trees: int, recall: float, longest: int = LONGEST) -> int:
    """The prefix at which shortening ends: the longest with which pairs at the threshold reach the target recall."""
    depth = longest
    while depth > 1 and recall_at(threshold, depth, trees) < recall:
        depth -= 1
    if recall_at(threshold, depth, trees) < recall:
        raise ValueError("too few trees for this recall")
    return depth


def shingles(text: str, n: int) -> np.ndarray:
    """The sorted set of 64-bit shingle hashes of a text."""
    words = split_words(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = word_hashes(words)
    size = min(n, len(words))
    begin = np.arange(len(words) - size + 1)
    return np.unique(_mix(range_hashes(hashes, _BASES[0], begin, begin + size) + np.uint64(size)))


@lru_cache(maxsize=4)
def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(_SEED)
    a = random.integers(0, 2**64, count, dtype=np.uint64, endpoint=False) | np.uint64(1)
    return a, random.integers(0, 2**64, count, dtype=np.uint64, endpoint=False)


def signature(items: np.ndarray, count: int) -> np.ndarray:
    """16 bits of each of ``count`` MinHash values."""
    a, b = _multipliers(count)
    least = np.full(count, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(items), 1024):
        np.minimum(least, (items[at : at + 1024, None] * a + b).min(axis=0), out=least)
    return (_mix(least) >> np.uint64(48)).astype("<u2")


def signed(docs: DataFrame, n: int, count: int) -> DataFrame:
    """Id, hash of the text, digest of the shingle set and signature of each row (id, text_hash, text) with a word."""

    def start():
        def sign(text):
            items = shingles(text, n)
            if not len(items):
                return None, None
            return xxhash.xxh3_128_digest(items.tobytes()), signature(items, count).tobytes()

        return sign, _word_hashes().clear

    kinds = {"digest": T.BinaryType(), "signature": T.BinaryType()}
    return add_columns(docs, ["text"], kinds, start, drop=("text",)).filter("digest IS NOT NULL")


def trie_links(rows: np.ndarray, trie: np.ndarray, depth: int, least_equal: int, block: np.ndarray) -> list[tuple[int, int]]:
    """Links between rows (signatures) that share the first ``depth`` values of ``trie``, their stretches of one tree.

    Rows are told apart by ``block``; where there are two, links inside one of them are not returned.
    """

    def alike(i: int, others: np.ndarray) -> np.ndarray:
        return (rows[others] == rows[i]).sum(axis=1) >= least_equal

    def shorten(members: np.ndarray) -> list[tuple[int, int]]:
        made = []
        shared = np.cumprod(trie[members[1:]] == trie[members[:-1]], axis=1).sum(axis=1)
        for level in range(trie.shape[1], depth - 1, -1):
            cuts = np.concatenate([[0], np.flatnonzero(shared < level) + 1, [len(members)]])
            for k in np.flatnonzero(np.diff(cuts) > 1):
                run = members[cuts[k] : cuts[k + 1]]
                if (root[run] != root[run[0]]).any():
                    made += join_rows(alike, root, run)
            if (root[members] == root[members[0]]).all():
                break  # shorter prefixes can join nothing more
        return made

    root = np.arange(len(rows))
    order = np.lexsort((root, *trie.T[::-1]))
    parts = np.unique(block)
    if len(parts) == 1:
        return shorten(order)
    for one in parts:
        shorten(order[block[order] == one])
    return shorten(order)


def _candidates(nodes: DataFrame, trees: int, depth: int, least_equal: int) -> DataFrame:
    """Links (a, b) between nodes that meet in a trie node and whose signatures agree often enough."""
    in_tries = nodes.select("node", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "signature").select(
        "node", "tree", F.substring("signature", F.col("tree") * 2 * LONGEST + 1, F.lit(2 * depth)).alias("prefix")
    )
    crowded = in_tries.groupBy("tree", "prefix").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
    members = materialize(in_tries.join(crowded, ["tree", "prefix"]), "trie-nodes")
    with_signatures = members.join(nodes.select("node", "signature"), "node")
    dealt = in_blocks(with_signatures, "size", NODE_ROWS, "node")
    keyed = dealt.select(
        F.concat_ws("/", "tree", F.hex("prefix"), "lo", "hi").alias("key"), "tree", "block", "node", "signature"
    )

    def link(group: pd.DataFrame) -> pd.DataFrame | None:
        if len(group) < 2:
            return None
        node = group["node"].to_numpy()
        order = np.argsort(node)
        node = node[order]
        rows = np.frombuffer(b"".join(group["signature"].to_numpy()[order]), dtype="<u2").reshape(len(group), -1)
        if len(group) == 2:  # most trie nodes; no level of a trie of two rows joins more than another
            return pd.DataFrame({"a": node[:1], "b": node[1:]}) if (rows[0] == rows[1]).sum() >= least_equal else None
        begin = int(group["tree"].iloc[0]) * LONGEST
        made = trie_links(rows, rows[:, begin : begin + LONGEST], depth, least_equal, group["block"].to_numpy()[order])
        return pd.DataFrame([(node[a], node[b]) for a, b in made], columns=["a", "b"]) if made else None

    return per_group(keyed, "key", link, "a long, b long")


def _intersections(sets_a: list[np.ndarray], sets_b: list[np.ndarray]) -> np.ndarray:
    """How many items each set of ``sets_a`` shares with each of ``sets_b``."""
    every = np.concatenate([*sets_a, *sets_b])
    rows = np.repeat(np.arange(len(sets_a) + len(sets_b)), [len(s) for s in (*sets_a, *sets_b)])
    order = np.argsort(every, kind="stable")
    every, rows = every[order], rows[order]
    column = np.cumsum(np.r_[False, every[1:] != every[:-1]])
    often = np.bincount(column)[column] > 1  # items of one set alone are in no intersection
    column, rows = np.unique(column[often], return_inverse=True)[1], rows[often]
    shared = np.zeros((len(sets_a), len(sets_b)), dtype=np.float64)
    bounds = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + _COLUMNS, _COLUMNS))
    for k, (begin, end) in enumerate(zip(bounds, bounds[1:], strict=False)):
        part = np.zeros((len(sets_a) + len(sets_b), _COLUMNS), dtype=np.float32)
        part[rows[begin:end], column[begin:end] - k * _COLUMNS] = 1
        shared += part[: len(sets_a)] @ part[len(sets_a) :].T
    return shared


def _verified(docs: DataFrame, nodes: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """For each node of a candidate class its verified links in a pair of blocks, and a node it is linked with."""
    sizes = classes.groupBy("label").agg(F.count("*").alias("size"))
    members = classes.join(sizes, "label").join(nodes.select("node", "id", "text_hash"), "node")
    texts = docs.join(members, ["id", "text_hash"]).select("node", "label", "size", "text").dropDuplicates(["node"])

    def start():
        return lambda text: (shingles(text, n).tobytes(),), _word_hashes().clear

    built = add_columns(texts, ["text"], {"items": T.BinaryType()}, start, drop=("text",))
    dealt = in_blocks(built, "size", CLASS_ROWS, "node")
    keyed = dealt.select(F.concat_ws("/", "label", "lo", "hi").alias("key"), "node", "block", "lo", "hi", "items")

    def verify(group: pd.DataFrame) -> pd.DataFrame | None:
        group = group.sort_values("node")
        lo, hi = group["lo"].iloc[0], group["hi"].iloc[0]
        items = [np.frombuffer(b, dtype=np.uint64) for b in group["items"]]
        node, block = group["node"].to_numpy(), group["block"].to_numpy()
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        if len(left) == 0 or len(right) == 0:
            return None
        size = np.array([len(i) for i in items], dtype=np.float64)
        shared = _intersections([items[i] for i in left], [items[i] for i in right])
        # |A and B| / |A or B| >= percent / 100, in whole numbers
        similar = (100 + percent) * shared >= percent * (size[left][:, None] + size[right][None, :])
        linked = np.zeros((len(node), len(node)), dtype=bool)
        linked[np.ix_(left, right)] = similar
        linked |= linked.T
        np.fill_diagonal(linked, False)
        root = components(lambda i, others: linked[i, others], len(node))
        return pd.DataFrame({"node": node, "links": linked.sum(axis=1), "root": node[root]})

    return per_group(keyed, "key", verify, "node long, links long, root long")


def join_similar(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    n: int = 5,
    percent: int = 80,
    trees: int = 20,
    recall: float = 0.9995,
) -> DataFrame:
    """A row per row of ``docs``: its id, text_hash, class_id, n_links, n_copies, and is_first (the row's text
    is the class's first by id and hash)."""
    depth = prefix_depth(percent / 100, trees, recall)
    count = trees * LONGEST
    error = (percent / 100 * (1 - percent / 100) / count) ** 0.5
    least_equal = int(count * max(0.0, percent / 100 - 5 * error))
    whole = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    whole = whole.withColumn("text_hash", F.xxhash64("text")).select("id", "text_hash", "text")
    usable = whole.filter(F.col("id").isNotNull() & F.col("text").isNotNull())
    rows = materialize(signed(usable, n, count), "signed")
    place = F.struct("id", "text_hash")
    nodes = materialize(
        rows.groupBy("digest")
        .agg(F.min(place).alias("at"), F.count("*").alias("n_copies"), F.any_value("signature").alias("signature"))
        .select("digest", "at.id", "at.text_hash", "n_copies", "signature", F.monotonically_increasing_id().alias("node")),
        "nodes",
    )
    candidates = connected(_candidates(nodes, trees, depth, least_equal))
    verified = materialize(_verified(usable, nodes, candidates, n, percent), "verified")
    links = verified.groupBy("node").agg(F.sum("links").alias("n_links"))
    labels = connected(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    placed = nodes.drop("signature").join(links, "node", "left").join(labels, "node", "left")
    placed = placed.withColumn("label", F.coalesce("label", "node"))
    # classes of one node need no grouping; those of several are few against the nodes
    firsts = labels.join(nodes.select("node", "id", "text_hash"), "node").groupBy("label").agg(F.min(place).alias("first"))
    classed = placed.join(firsts, "label", "left").select(
        "digest", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies", F.coalesce("first", place).alias("first")
    )
    found = rows.drop("signature").join(classed, "digest").select(
        "id", "text_hash", F.col("first.id").alias("class_id"), "n_links", "n_copies",
        (place == F.col("first")).alias("is_first"),
    )
    wordless = F.coalesce(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    alone = whole.filter(F.col("id").isNull() | wordless).select(
        "id", "text_hash", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("n_copies"), F.lit(True).alias("is_first"),
    )
    return found.unionByName(alone).withColumnRenamed("id", id_column)


def keep_first(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each class, that with the smallest id; rows with a null id stay."""
    found = join_similar(docs, id_column, text, **settings)
    firsts = found.filter(F.col("is_first") & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("_id"), F.col("text_hash").alias("_hash")
    )
    keyed = docs.withColumn("_id", F.col(f"`{id_column}`").cast("long")).withColumn("_hash", F.xxhash64(f"`{text}`"))
    kept = keyed.filter(F.col("_id").isNotNull()).join(firsts, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"])
    return kept.select(*docs.columns).unionByName(docs.filter(F.col(id_column).isNull()))

"""Near-duplicate documents: MinHash with tensored banding, every link confirmed on full sets.

Words are lower-cased (A-Z) and split at white space; a document's set is that of its runs of
five words. Two collections of HALVES half-keys, each made of HALF_ROWS minhashes, stand for
HALVES squared table keys: a table is a pair of half-keys, one of each collection, so a key of
four minhashes for each of 144 tables costs 48 minhashes and not 576. A pair of similarity s
shares a table unless it misses a whole collection: at s = 0.75 with odds of 1 in 10,000, at
0.8 of 1 in 100,000.

Work that is not needed is not done, and none is dropped:

* Documents with equal sets are one node.
* A table key can collide only if both its halves do, so only halves that some other node
  shares are multiplied out.
* In a table's bucket the nodes are compared with a hub, not with each other. Links make
  components, and only buckets that still hold several go on, with another hub. The nodes
  left then meet by shared rare shingles near the beginning of their sets, which finds every
  similar pair among them, and pairs of different components are confirmed like the others.

Defined results: a document without words, text or id is a component of its own and linked
with nothing; repeated rows are copies; rows that repeat an id with another text are documents
of their own, of which each gets its own row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh, map_rows, mix, quoted, shingle_hashes, word_hash_tables, word_hashes
from ledgerline.session import materialize

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75
HALVES = 12
HALF_ROWS = 2
HUB_ROUNDS = 2
_CHUNK = 4096
_WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"


def shingle_set(text: str | None, tables: dict[str, np.ndarray]) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = word_hashes((text or "").encode().lower(), tables)
    return np.unique(shingle_hashes(words, SHINGLE_WORDS))


def set_key(shingles: np.ndarray) -> int:
    """One 64-bit number for a whole set."""
    both = mix(shingles).sum(dtype=np.uint64, keepdims=True) + mix(np.bitwise_xor.reduce(shingles, keepdims=True))
    return int(mix(both + np.uint64(len(shingles))).view(np.int64)[0])


def _family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(9)
    n = 2 * HALVES * HALF_ROWS
    return rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def half_keys(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The half-keys of both collections, HALVES each."""
    add, times = family
    lowest = np.full(len(add), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _CHUNK):
        some = shingles[at : at + _CHUNK, None]
        np.minimum(lowest, ((some ^ add) * times).min(axis=0), out=lowest)
    rows = lowest.reshape(-1, HALF_ROWS)
    keys = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for i in range(HALF_ROWS):
        keys = mix(keys + rows[:, i])
    return keys.view(np.int64)


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, mark (a hash of the text, which tells rows that repeat an id apart),
    n_shingles, node (one number for the set) and half_keys; the last two null without words."""

    def each(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        tables, family = word_hash_tables(_WHITE), _family()
        for batch in batches:
            sizes, nodes, halves = [], [], []
            for doc in batch["text"]:
                shingles = shingle_set(doc, tables)
                sizes.append(len(shingles))
                nodes.append(set_key(shingles) if len(shingles) else None)
                halves.append(half_keys(shingles, family) if len(shingles) else None)
            yield {"id": batch["id"], "mark": batch["mark"], "n_shingles": sizes, "node": nodes, "half_keys": halves}

    kind = docs.schema[key].dataType.simpleString()
    given = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))
    return map_rows(given, each, f"id {kind}, mark long, n_shingles long, node long, half_keys array<long>")


def table_keys(nodes: DataFrame) -> DataFrame:
    """(table_key, node) for the table keys whose halves are both shared with another node."""
    halves = nodes.select("node", F.posexplode("half_keys").alias("at", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    live = halves.join(shared, "half").groupBy("node").agg(
        F.collect_list(F.when(F.col("at") < HALVES, F.col("half"))).alias("first"),
        F.collect_list(F.when(F.col("at") >= HALVES, F.col("half"))).alias("second"),
    )
    first = live.select("node", "second", F.explode("first").alias("one"))
    return first.select("node", "one", F.explode("second").alias("two")).select(
        F.xxhash64("one", "two").alias("table_key"), "node"
    )


def _sets(docs: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """(node, shingles) of the given nodes, from the text of their smallest documents."""
    texts = docs.select(F.col(key).alias("smallest"), F.col(text).alias("text"))

    def each(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, Any]]:
        tables = word_hash_tables(_WHITE)
        for batch in batches:
            found: dict[int, np.ndarray] = {}
            for node, doc in zip(batch["node"], batch["text"]):
                shingles = shingle_set(doc, tables)
                if len(shingles) and set_key(shingles) == node:
                    found[node] = shingles.view(np.int64)
            yield {"node": list(found), "shingles": list(found.values())}

    found = map_rows(nodes.join(texts, "smallest").select("node", "text"), each, "node long, shingles array<long>")
    return found.dropDuplicates(["node"])


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    right = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    small, large = F.least(F.size("set_a"), F.size("set_b")), F.greatest(F.size("set_a"), F.size("set_b"))
    joined = pairs.join(left, "b").join(right, "a")
    return joined.where(
        (100 * small >= SIMILARITY_PERCENT * large)
        & (100 * both >= SIMILARITY_PERCENT * (F.size("set_a") + F.size("set_b") - both))
    ).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link, by alternating large and small stars.

    Each step hangs a node's neighbours on the smallest of them, so paths shrink by a factor
    and the number of steps grows with the logarithm of the longest. No step brings a node's
    neighbours together other than for their minimum, which is pre-aggregated.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct(), "edges")
    before = None
    while True:
        both = edges.select(F.col("v").alias("u"), F.col("m").alias("w")).unionByName(
            edges.select(F.col("m").alias("u"), F.col("v").alias("w"))
        )
        least = both.groupBy("u").agg(F.min("w").alias("low")).select("u", F.least("u", "low").alias("m"))
        large = both.where("w > u").join(least, "u").where("w <> m").select(F.col("w").alias("v"), "m").distinct()
        low = large.groupBy("v").agg(F.min("m").alias("low"))
        small = large.join(low, "v").where("m <> low").select(F.col("m").alias("v"), F.col("low").alias("m")).unionByName(
            low.select("v", F.col("low").alias("m"))
        )
        edges = materialize(small.distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "m") % 1_000_003), F.sum(F.hash("v", "m").cast("long"))).first()
        if now == before:
            break
        before = now
    roots = edges.groupBy("v").agg(F.min("m").alias("root")).select(F.col("v").alias("node"), "root")
    return roots.unionByName(edges.select(F.col("m").alias("node"), F.col("m").alias("root")).distinct()).groupBy("node").agg(F.min("root").alias("root"))


def prefix_pairs(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes with different roots that may be similar enough: none is missed.

    With every set in one order, rare shingles first, similar sets share a shingle near their
    beginnings: the smaller one (y) among its first |y| - ceil(6/7 |y|) + 1, the larger one (x)
    among its first |x| - ceil(3/4 |x|) + 1 (2t / (1 + t) is 6/7 for t = 3/4). A shingle at
    position p leaves x at most |x| - p in common, which bounds |y| as well; sizes are matched by
    classes, so that the many sets of one group that differ too much do not meet at all.
    """
    own = nodes.join(sets, "node")
    each = own.select("node", F.explode("shingles").alias("shingle"))
    spread = each.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    # A shingle of one set only takes its place in the order, without meeting any.
    shared = each.join(spread, "shingle").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("common"))
    ranked = own.join(shared, "node").select(
        "node", "root", F.size("shingles").alias("n"), (F.size("shingles") - F.size("common")).alias("alone"), "common"
    )
    first = ranked.select("node", "root", "n", "alone", F.posexplode("common").alias("at", "one"))
    placed = first.select("node", "root", "n", (F.col("at") + F.col("alone")).alias("p"), F.col("one.shingle").alias("shingle"))
    smaller = placed.where("7 * p <= n").select(
        "shingle", F.col("node").alias("a"), F.col("root").alias("root_a"), F.col("n").alias("n_a"), _size_class(F.col("n")).alias("size")
    )
    least, most = F.ceil(F.col("n") * 0.75), F.least(F.col("n"), F.floor((4 * F.col("n") - 7 * F.col("p")) / 3))
    larger = placed.where("4 * p <= n").where(most >= least).select(
        "shingle", F.col("node").alias("b"), F.col("root").alias("root_b"), least.alias("least"), most.alias("most"),
        F.explode(F.sequence(_size_class(least), _size_class(most))).alias("size"),
    )
    met = smaller.join(larger, ["shingle", "size"]).where("n_a BETWEEN least AND most AND root_a <> root_b")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _size_class(n: Column) -> Column:
    """Classes of sizes: single ones at first, then of about three in a hundred."""
    return F.floor(F.log(n) * 32).cast("long")


def linked_nodes(docs: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """(node, root): the components of all links between different sets."""
    spark = docs.sparkSession
    keys = materialize(table_keys(nodes), "table-keys")
    crowded = keys.groupBy("table_key").agg(F.count("*").alias("n")).where("n > 1")
    active = materialize(keys.join(crowded, "table_key"), "buckets")
    if active.isEmpty():
        return spark.createDataFrame([], "node long, root long")
    sets = materialize(_sets(docs, active.select("node").distinct().join(nodes.select("node", "smallest"), "node"), key, text), "sets")
    links, tested, roots = [], [], None
    # A node that shares large buckets is in the middle of a group, so it is compared with the others first.
    weight = active.groupBy("node").agg(F.sum("n").alias("weight"))
    order = F.struct(-F.col("weight"), F.col("node"))
    active = materialize(active.join(weight, "node").select("table_key", "node", "weight", F.col("node").alias("root")), "buckets")
    for round_ in range(HUB_ROUNDS + 1):
        if round_ < HUB_ROUNDS:
            hubs = active.groupBy("table_key").agg(F.min_by("node", order).alias("hub"), F.min_by("root", order).alias("hub_root"))
            compared = active.join(hubs, "table_key").where("node <> hub")
            pairs = compared.where("root <> hub_root").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))
            active = compared.drop("hub", "hub_root")
        else:
            rest = materialize(active.select("node", "root").distinct(), "rest")
            pairs = prefix_pairs(rest, sets)
        pairs = pairs.distinct()
        for seen in tested:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        tested.append(materialize(pairs, "pairs"))
        found = materialize(confirm(tested[-1], sets), "links")
        if not found.isEmpty():
            links.append(found)
            roots = materialize(components(reduce(DataFrame.unionByName, links)), "roots")
            active = active.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        if round_ == HUB_ROUNDS:
            break
        # What is left of a bucket was not compared among itself; one component needs no comparing.
        open_keys = active.groupBy("table_key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        active = materialize(active.join(open_keys.select("table_key"), "table_key"), "buckets")
        if active.isEmpty():
            break
    return roots if roots is not None else spark.createDataFrame([], "node long, root long")


def _decided(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, mark, n_shingles, component_id, kept) for every document."""
    signed = materialize(signatures(docs, key, text), "signatures")
    linkable = F.col("node").isNotNull() & F.col("id").isNotNull()
    some = signed.where(linkable)
    nodes = materialize(some.groupBy("node").agg(F.min("id").alias("smallest"), F.first("half_keys").alias("half_keys")), "nodes")
    roots = linked_nodes(docs, nodes, key, text)
    labelled = nodes.select("node", "smallest").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    labels = labelled.groupBy("root").agg(F.min("smallest").alias("component_id"))
    final = labelled.join(labels, "root").select("node", "component_id")
    joined = some.select("id", "mark", "n_shingles", "node").join(final, "node").drop("node")
    alone = signed.where(~linkable).select("id", "mark", "n_shingles", F.col("id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_shingles, component_id (the smallest key reachable over links) and
    kept (whether that is its own)."""
    return _decided(docs, key, text).drop("mark").withColumnRenamed("id", key)


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of every component the document with the smallest key, once, in all its columns.

    Documents without a key are kept.
    """
    kept, mark, repeat = fresh(docs, "kept_key", "kept_mark", "n")
    chosen = _decided(docs, key, text).where("kept AND id IS NOT NULL")
    counts = chosen.groupBy(F.col("id").alias(kept), F.col("mark").alias(mark)).agg(F.count("*").alias(repeat))
    joined = docs.join(counts, (quoted(key) == F.col(kept)) & (F.xxhash64(quoted(text)) == F.col(mark)))
    once = joined.where(F.col(repeat) == 1).select(*map(quoted, docs.columns))
    # Only rows that repeat a key and text are brought together, to leave one of them.
    several = joined.where(F.col(repeat) > 1).dropDuplicates([kept, mark]).select(*map(quoted, docs.columns))
    return once.unionByName(several).unionByName(docs.where(quoted(key).isNull()))

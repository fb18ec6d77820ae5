"""Hard negatives for embeddings, found exactly through a GNAT-style tree.

Components become floor(256 * x), so that scores (inner products) are integers. A row's score
turns into a distance: every row gets one more coordinate that brings all norms to the largest
one, an anchor gets 0 there, and then ``distance**2 = |anchor|**2 + largest - 2 * score``. A window
of scores is thus an annulus around the anchor.

The tree is fitted on at most ``SAMPLE`` rows: in every node up to ``FANOUT`` split points, far
apart, share the space by hyperplanes (a row belongs to its nearest point). It has a fixed depth, so
its size is bounded whatever the table. All rows are then put into its leaves, and every split
point gets the smallest and largest distance to all rows below each of its siblings. An anchor
drops a subtree when, by the triangle inequality and one of these ranges, none of its rows can lie
in any of the anchor's annuli. Rows of the leaves that remain are scored exactly, in blocks.

A search has two rounds: the anchor's own leaf gives first results, whose last score narrows the
windows, and then the other leaves. Anchors travel to the blocks of the leaves they need; rows
stay where they are, and a leaf with many rows (copies of one vector) has many blocks.

Defined results: rows with a null id, label or vector, or a component that is null, not finite or not
finite times 256, take no part. Shorter vectors count as filled up with zeros; an empty one has
score 0 with all. Exact repeats of a row are one row; different rows of one id are all kept, none is
another's positive, and each mines for itself if the id is an anchor's. Ties go by id, then by
label and vector. Scores beyond 64 bits are shown as the largest ones. An empty table gives no rows. Further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from ledgerline.llm.common import small_batches
from ledgerline.session import materialize

SAMPLE = 4096
FANOUT = 8
DEPTH = 2
LEAF_SAMPLE = 16
BLOCK_ROWS = 16_384
ANCHORS_AT_ONCE = 64
SCALE = 256
EVERY, LABELS = 50, 10
POSITIVES, NEGATIVES = 5, 3
_LEAST, _MOST = -(2**63) + 1, 2**63 - 1


# ---- the tree: plain arrays, fitted on the sample ----

def lifted(x: np.ndarray, largest: float) -> np.ndarray:
    """Rows with the coordinate that makes all norms equal."""
    with np.errstate(all="ignore"):
        rest = np.sqrt(np.maximum(largest - (x * x).sum(1), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        square = (x * x).sum(1)[:, None] + (points * points).sum(1)[None] - 2.0 * (x @ points.T)
        return np.sqrt(np.maximum(square, 0.0))


def _far_apart(x: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` different rows, each the farthest from those before it."""
    chosen = [0]
    away = distances(x, x[:1])[:, 0]
    while len(chosen) < most:
        at = int(np.argmax(away))
        if not away[at] > 0 or (x[at] == x[chosen]).all(1).any():
            break
        chosen.append(at)
        away = np.minimum(away, distances(x, x[at : at + 1])[:, 0])
    return x[chosen]


def fit_tree(sample: np.ndarray) -> list[dict]:
    """Nodes in the order of levels: ``points``, and per point the node below it or ``~leaf``."""
    nodes: list[dict] = []
    waiting = [(sample, 0, None)]
    leaves = 0
    while waiting:
        x, level, place = waiting.pop(0)
        points = _far_apart(x, FANOUT) if level < DEPTH and len(x) > LEAF_SAMPLE else x[:0]
        if len(points) < 2 and nodes:
            nodes[place[0]]["kids"][place[1]] = ~leaves
            leaves += 1
            continue
        if len(points) < 2:
            points = x[:1]
        if place:
            nodes[place[0]]["kids"][place[1]] = len(nodes)
        nodes.append({"points": points, "kids": [0] * len(points)})
        nearest = np.argmin(distances(x, points), 1)
        for j in range(len(points)):
            waiting.append((x[nearest == j] if len(points) > 1 else x[:0], level + 1, (len(nodes) - 1, j)))
    return nodes


def descend(nodes: list[dict], x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per node its rows, their distances to its points and the point nearest to each."""
    at = {0: np.arange(len(x))}
    for number, node in enumerate(nodes):
        rows = at.pop(number, None)
        if rows is None or not len(rows):
            continue
        away = distances(x[rows], node["points"])
        nearest = np.argmin(away, 1)
        for j, kid in enumerate(node["kids"]):
            if kid >= 0:
                at[kid] = rows[nearest == j]
        yield number, rows, away, nearest


def leaf_of(nodes: list[dict], x: np.ndarray) -> np.ndarray:
    leaf = np.zeros(len(x), np.int32)
    for number, rows, _, nearest in descend(nodes, x):
        kids = np.array(nodes[number]["kids"])[nearest]
        leaf[rows[kids < 0]] = ~kids[kids < 0]
    return leaf


def remaining(nodes: list[dict], ranges: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray, inner: np.ndarray,
              outer: np.ndarray, slack: float) -> list[list[int]]:
    """Per anchor the leaves that may hold a row with a distance from ``inner`` to ``outer``, in
    any of its windows (one column each; a window that is not there has NaN for both).

    ``ranges[n][0][i, j]`` and ``[1][i, j]`` are the least and largest distance from split point
    i of node n to the rows below its sibling j.
    """
    found: list[list[int]] = [[] for _ in x]
    at = {0: np.arange(len(x))}
    for number, node in enumerate(nodes):
        rows = at.pop(number, None)
        if rows is None or not len(rows):
            continue
        least, most = ranges[number]
        away = distances(x[rows], node["points"])[:, :, None]
        with np.errstate(all="ignore"):
            nearest = np.maximum(least[None] - away, away - most[None]).max(1)[:, :, None]
            farthest = (away + most[None]).min(1)[:, :, None]
            out = (nearest > outer[rows][:, None, :] + slack) | (farthest < inner[rows][:, None, :] - slack)
        stays = (~out & ~np.isnan(inner[rows])[:, None, :]).any(2)
        for j, kid in enumerate(node["kids"]):
            if kid >= 0:
                at[kid] = rows[stays[:, j]]
            else:
                for row in rows[stays[:, j]]:
                    found[row].append(~kid)
    return found


# ---- exact scores ----

def score_type(largest: float, dim: int) -> type:
    """The narrowest number type in which inner products are exact."""
    total = largest * largest * max(dim, 1)
    return np.float32 if total < 2**24 else np.float64 if total < 2**53 else object


def _numbers(x: np.ndarray, kind: type) -> np.ndarray:
    return x.astype(kind) if kind is not object else np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)


def _best(scores: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (anchor, row) of each anchor's ``k`` highest scores from low to high; rows are in the order of ties."""
    inside = allowed & (scores >= low[:, None]) & (scores <= high[:, None])
    who, which = np.nonzero(inside.astype(np.bool_))
    order = np.lexsort((which, -scores[who, which].astype(np.float64), who)) if scores.dtype != object else np.array(
        sorted(range(len(who)), key=lambda t: (who[t], -scores[who[t], which[t]], which[t])), np.int64)
    who, which = who[order], which[order]
    rank = np.arange(len(who)) - np.searchsorted(who, who)
    return who[rank < k], which[rank < k]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dim) if dim else np.zeros((len(column), 1))


class Index:
    """All rows of a table of embeddings in the leaves of a tree, each subtree with its ranges."""

    def __init__(self, df: DataFrame):
        spark = df.sparkSession
        small_batches(spark)
        given = materialize(usable(df), "vectors")
        total = given.agg(
            F.count("*").alias("rows"), F.max(F.size("v")).alias("dim"), F.max("norm").alias("norm"), F.max("most").alias("most")
        ).first()
        self.spark, self.rows, self.dim = spark, total.rows, total.dim or 0
        self.largest, self.kind = total.norm or 0.0, score_type(total.most or 0.0, self.dim)
        dim, largest = self.dim, self.largest
        missing = F.array_repeat(F.lit(0.0), F.greatest(F.lit(dim) - F.size("v"), F.lit(0)))
        given = given.select("row", "vec_id", "label", F.concat("v", missing).alias("v"))
        taken = given.orderBy(F.xxhash64(F.lit(11), "vec_id"), "vec_id", "label", "v").limit(SAMPLE).select("v").collect()
        sample = np.array([r.v for r in taken], np.float64).reshape(len(taken), max(dim, 0) or 0)
        if not dim:
            sample = np.zeros((len(taken), 1))
        self.nodes = nodes = fit_tree(lifted(sample, largest)) if len(taken) else [{"points": np.zeros((1, max(dim, 1) + 1)), "kids": [~0]}]

        schema = T.StructType([*given.schema.fields, T.StructField("leaf", T.IntegerType())])
        arrow = to_arrow_schema(schema)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf = leaf_of(nodes, lifted(_matrix(batch.column(3), dim), largest))
                yield pa.RecordBatch.from_arrays([*[c.cast(f.type) for c, f in zip(batch.columns, arrow)], pa.array(leaf)], schema=arrow)

        self.table = materialize(given.mapInArrow(place, schema), "leaves")
        self.ranges = self._ranges()
        self.blocks = self._blocks()

    def _ranges(self) -> list[tuple[np.ndarray, np.ndarray]]:
        nodes, dim, largest = self.nodes, self.dim, self.largest

        def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept = [(np.full((len(n["kids"]),) * 2, np.inf), np.full((len(n["kids"]),) * 2, -np.inf)) for n in nodes]
            for batch in batches:
                for number, _, away, nearest in descend(nodes, lifted(_matrix(batch.column(0), dim), largest)):
                    for j in np.unique(nearest):
                        low, high = kept[number]
                        low[:, j] = np.minimum(low[:, j], away[nearest == j].min(0))
                        high[:, j] = np.maximum(high[:, j], away[nearest == j].max(0))
            for number, (low, high) in enumerate(kept):
                i, j = np.nonzero(high > -np.inf)
                yield pa.RecordBatch.from_pydict({
                    "node": pa.array(np.full(len(i), number, np.int32)), "i": pa.array(i.astype(np.int32)),
                    "j": pa.array(j.astype(np.int32)), "low": pa.array(low[i, j]), "high": pa.array(high[i, j])})

        found = self.table.select("v").mapInArrow(spans, "node int, i int, j int, low double, high double")
        ranges = [(np.full((len(n["kids"]),) * 2, np.inf), np.full((len(n["kids"]),) * 2, -np.inf)) for n in nodes]
        # As many rows as the tree has pairs of siblings.
        for r in found.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
            ranges[r.node][0][r.i, r.j], ranges[r.node][1][r.i, r.j] = r.low, r.high
        return ranges

    def _blocks(self) -> dict[int, int]:
        """Blocks per leaf: all leaves' blocks have about the same number of rows."""
        counts = {r.leaf: r["count"] for r in self.table.groupBy("leaf").count().collect()}
        rows = min(BLOCK_ROWS, max(1, self.rows // max(1, len(counts))))
        return {leaf: -(-n // rows) for leaf, n in counts.items()}

    def search(self, anchors: DataFrame, same_label: bool, k: int) -> DataFrame:
        """(row, w, score, vec_id): per anchor row and window the ``k`` best rows of the same or
        of another label, by score, then id. ``anchors`` has the columns of ``self.table`` and
        ``windows``, an array of (w, low, high)."""
        first = materialize(self._probe(anchors.withColumn("leaf", F.array("leaf")), same_label, k), "own")
        found = _top(first, k).groupBy("row", "w").agg(F.count("*").alias("n"), F.min("score").alias("last"))
        # At most as many entries per anchor as it has windows.
        known = found.where(F.col("n") == k).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("w", "last"))).alias("known"))
        raised = F.transform("windows", lambda x: F.struct(
            x.w.alias("w"), F.greatest(x.low, F.coalesce(F.try_element_at("known", x.w), x.low)).alias("low"), x.high.alias("high")))
        narrowed = anchors.join(known, "row", "left").withColumn("windows", raised).drop("known")
        rest = self._probe(self._leaves(narrowed), same_label, k)
        return _top(first.unionByName(rest), k)

    def _leaves(self, anchors: DataFrame) -> DataFrame:
        """``leaf`` becomes the list of the other leaves an anchor has to see."""
        nodes, ranges, dim, largest = self.nodes, self.ranges, self.dim, self.largest
        schema = T.StructType([T.StructField("leaf", T.ArrayType(T.IntegerType())) if f.name == "leaf" else f for f in anchors.schema])
        arrow = to_arrow_schema(schema)
        names = anchors.columns
        slack = 1e-6 * (largest**0.5 + 1.0)

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = dict(zip(names, batch.columns))
                x = _matrix(column["v"], dim)
                windows = column["windows"].to_pylist()
                width = max([len(w) for w in windows] or [0])
                inner, outer = np.full((len(x), width), np.nan), np.full((len(x), width), np.nan)
                norm = (x * x).sum(1)
                for i, given in enumerate(windows):
                    for t, w in enumerate(given):
                        if w["low"] <= w["high"]:
                            inner[i, t] = max(norm[i] + largest - 2.0 * w["high"], 0.0) ** 0.5
                            outer[i, t] = max(norm[i] + largest - 2.0 * w["low"], 0.0) ** 0.5
                whole = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
                near = remaining(nodes, ranges, whole, inner, outer, slack)
                own = column["leaf"].to_pylist()
                column["leaf"] = pa.array([[n for n in leaves if n != o] for leaves, o in zip(near, own)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([column[f.name].cast(f.type) for f in arrow], schema=arrow)

        return anchors.mapInArrow(choose, schema)

    def _probe(self, anchors: DataFrame, same_label: bool, k: int) -> DataFrame:
        """Anchors against all rows of the leaves in their ``leaf`` list, block by block."""
        dim, kind = self.dim, self.kind
        count = F.create_map(*[F.lit(x) for pair in (self.blocks or {0: 1}).items() for x in pair])
        none = F.lit(None).cast("array<struct<w:int,low:bigint,high:bigint>>")
        rows = self.table.withColumn("block", F.pmod(F.xxhash64("row"), F.try_element_at(count, F.col("leaf"))).cast("int"))
        rows = rows.select("leaf", "block", F.lit(0).alias("kind"), "row", "vec_id", "label", "v", none.alias("windows"))
        sent = anchors.withColumn("leaf", F.explode("leaf"))
        blocks = F.sequence(F.lit(0), (F.coalesce(F.try_element_at(count, F.col("leaf")), F.lit(1)) - 1).cast("int"))
        sent = sent.select("leaf", F.explode(blocks).alias("block"), F.lit(1).alias("kind"), "row", "vec_id", "label", "v", "windows")
        width = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 1)
        # Rows of one block in the order of ties, then the anchors that need it.
        dealt = rows.unionByName(sent).repartition(width, "leaf", "block").sortWithinPartitions("leaf", "block", "kind", "vec_id", "label", "v")

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, parts, data = None, [], None
            for batch in batches:
                keys = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
                cuts = np.flatnonzero(np.concatenate(([True], (np.diff(keys, axis=0) != 0).any(1), [True])))
                for a, b in zip(cuts[:-1], cuts[1:]):
                    if (keys[a, 0], keys[a, 1]) != key:
                        key, parts, data = (keys[a, 0], keys[a, 1]), [], None
                    part = batch.slice(a, b - a)
                    ids, labels = part.column(4).to_numpy(), part.column(5).to_numpy()
                    x = _matrix(part.column(6), dim)
                    if keys[a, 2] == 0:
                        parts.append((ids, labels, _numbers(x, kind)))
                        continue
                    if not parts:
                        continue
                    if data is None:
                        data = tuple(np.concatenate(p) for p in zip(*parts))
                        parts = [data]
                    for s in range(0, len(x), ANCHORS_AT_ONCE):
                        here = slice(s, s + ANCHORS_AT_ONCE)
                        yield from _scored(part.column(3).to_numpy()[here], ids[here], labels[here], _numbers(x[here], kind),
                                           part.column(7).slice(s, ANCHORS_AT_ONCE).to_pylist(), data, same_label, k)

        return dealt.mapInArrow(score, "row bigint, w int, score bigint, vec_id bigint")


def _scored(row: np.ndarray, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, windows: list[list[dict]],
            data: tuple[np.ndarray, np.ndarray, np.ndarray], same_label: bool, k: int) -> Iterator[pa.RecordBatch]:
    scores = x @ data[2].T
    allowed = (labels[:, None] == data[1][None]) == same_label
    allowed &= ids[:, None] != data[0][None]
    for t in range(max(len(w) for w in windows)):
        low = np.array([w[t]["low"] if t < len(w) else _MOST for w in windows], object)
        high = np.array([w[t]["high"] if t < len(w) else _LEAST for w in windows], object)
        if scores.dtype != object:
            low, high = low.astype(np.float64), high.astype(np.float64)
        who, which = _best(scores, allowed, low, high, k)
        if len(who):
            names = np.array([w[t]["w"] if t < len(w) else 0 for w in windows], np.int32)
            got = [min(max(int(v), _LEAST), _MOST) for v in scores[who, which]]
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(row[who]), "w": pa.array(names[who]), "score": pa.array(got, pa.int64()), "vec_id": pa.array(data[0][which])})


def _top(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best per anchor and window, out of at most ``k`` per block it met."""
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id"))), 1, k)
    return found.groupBy("row", "w").agg(best.alias("b")).select(
        "row", "w", F.explode("b").alias("b")
    ).select("row", "w", (-F.col("b.less")).alias("score"), F.col("b.vec_id").alias("vec_id"))


def usable(df: DataFrame) -> DataFrame:
    """(row, vec_id, label, v, norm, most): the rows that take part, exact repeats once, with whole components."""
    wide = F.transform("embedding", lambda x: x.cast("double") * SCALE)
    whole = F.transform("wide", lambda y: F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y))
    fits = F.forall("wide", lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    rows = df.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), wide.alias("wide"))
    rows = rows.where(fits).select("vec_id", "label", whole.alias("v")).distinct()
    square = F.aggregate("v", F.lit(0.0), lambda s, y: s + y * y)
    most = F.aggregate("v", F.lit(0.0), lambda s, y: F.greatest(s, F.abs(y)))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "v", square.alias("norm"), most.alias("most"))


def relabelled(df: DataFrame, every: int = 7, labels: int = LABELS) -> DataFrame:
    """The table with the labels of some rows moved on, as a source of wrong ones."""
    moved = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return df.select("vec_id", "embedding", moved.alias("label"))


def mine(
    df: DataFrame, anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least: int = 50, most: int = 95,
) -> DataFrame:
    """Per anchor and positive the best rows of other labels whose score is from ``least`` to ``most`` percent
    of the positive's: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``df`` has vec_id, label and embedding; ``anchor`` says of a row whether it is an anchor.
    """
    index = Index(df)
    chosen = index.table.where(F.col("vec_id") % EVERY == 0 if anchor is None else anchor)
    everything = F.array(F.struct(F.lit(0).alias("w"), F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high")))
    found = index.search(chosen.withColumn("windows", everything), True, positives)
    order = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id")))
    # At most ``positives`` per anchor. Decimals, so that the bounds do not overflow.
    wide = lambda c: c.cast("decimal(20,0)")
    ranked = materialize(found.groupBy("row").agg(order.alias("p")).select(
        "row", F.posexplode("p").alias("w", "p")).select("row", "w", F.col("p.vec_id").alias("positive_id"), (-F.col("p.less")).alias("positive_score")
    ), "positives")
    low = F.ceil(wide(F.col("positive_score")) * least / 100).cast("long")
    high = F.floor(wide(F.col("positive_score")) * most / 100).cast("long")
    windows = ranked.select("row", F.struct("w", low.alias("low"), high.alias("high")).alias("x")).where("x.low <= x.high")
    windows = windows.groupBy("row").agg(F.sort_array(F.collect_list("x")).alias("windows"))
    hard = index.search(chosen.join(windows, "row"), False, negatives)
    listed = hard.groupBy("row", "w").agg(order.alias("n")).select("row", "w", F.posexplode("n").alias("rank", "n"))
    return listed.join(ranked, ["row", "w"]).join(chosen.select("row", F.col("vec_id").alias("anchor_id")), "row").select(
        "anchor_id", "positive_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("negative_id"),
        "positive_score", (-F.col("n.less")).alias("negative_score"),
    )

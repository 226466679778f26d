"""Hard negatives by inner product, from cover trees over norm-augmented vectors (operator 12).

A vector x gets one more component, sqrt(M*M - |x|*|x|), M the largest norm of its tree. All rows of a
tree then have norm M, and the distance of a query q (with 0 there) to a row says their inner
product: q.x = (|q|^2 + M^2 - d^2) / 2. A node of a cover tree covers its rows within a radius that
shrinks from level to level, centres of a level being further apart than that radius. So distance to
the centre, plus and minus the radius, bounds the inner products of all rows below a node. The search
goes best bound first, for a group of anchors at once: a node is skipped for an anchor if its bounds
lie outside all of the anchor's windows, or below what each window has found already; at a leaf the
integer inner products are computed exactly.

On Spark: rows sorted by ranges of (label, nearest pivot, hash of the id) are cut into trees of at most
`TREE_ROWS`, so neither a hot label nor a hot vector makes a large task. Pivots come from a sample of
`PIVOTS` rows and only bring neighbours into one tree. Anchors are dealt into groups of about
`GROUP_ANCHORS`; each cell (group, part of the trees) streams its trees past the group, one at a time,
and keeps the best rows of each window. Few cells for each anchor, as few as keep the cluster busy, are
merged in the end. First the positives are searched, then the negatives with the positives' windows.
Results are exact, whatever the sample.

Rows with a null label, vector or id, and rows with a null or non-finite component take no part.
Equal rows under one id count once; different rows under one id are different rows. Vectors of
different length meet as if the shorter one ended in zeros; empty vectors score 0. Components are
floor(256 x); scores are exact up to 2**53. Extra columns are left out, whatever their names. An
empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.tables import Scratch, ship

SCALE = 256
ANCHOR_EVERY, RELABEL_EVERY, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
#: Window of a negative's score, in hundredths of the positive's.
LEAST, MOST = 50, 95
PIVOTS = 64
TREE_ROWS, LEAF_ROWS, FANOUT = 4096, 256, 64
#: The radius of a level as a part of the one above.
SHRINK = 0.8
GROUP_ANCHORS = 8192
SLICE = 1024


# Trees


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    rows: slice
    children: list[Node] = field(default_factory=list)


@dataclass
class Tree:
    """Rows in the order of the leaves, and the nodes over them."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    norm2: float
    root: Node


def _cover(points: np.ndarray, radius: float) -> np.ndarray | None:
    """The centre of each point, by its row: centres are more than `radius` apart, and each point
    is within it of its own, the nearest. None if that takes more than FANOUT centres."""
    centres = [0]
    away = np.linalg.norm(points - points[0], axis=1)
    owner = np.zeros(len(points), np.int64)
    while away.max() > radius:
        if len(centres) == FANOUT:
            return None
        new = int(away.argmax())
        distance = np.linalg.norm(points - points[new], axis=1)
        closer = distance < away
        owner[closer], away[closer] = new, distance[closer]
        centres.append(new)
    return owner


def _split(points: np.ndarray, rows: np.ndarray, radius: float) -> tuple[list, np.ndarray]:
    """Groups of rows of the next level that needs more than one centre, and its radius."""
    own = points[rows]
    while True:
        radius *= SHRINK
        owner = _cover(own, radius)
        if owner is None:
            return [], radius
        kinds = np.unique(owner)
        if len(kinds) > 1:
            return [(rows[c], rows[owner == c]) for c in kinds], radius


def grown(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Tree:
    """The cover tree of some rows. A node whose rows do not cluster, or are few, is a leaf."""
    norms = (vectors * vectors).sum(1)
    norm2 = float(norms.max())
    points = np.hstack([vectors, np.sqrt(np.maximum(norm2 - norms, 0.0))[:, None]])
    order: list[np.ndarray] = []
    placed = 0

    def node(centre: int, rows: np.ndarray, level: float) -> Node:
        nonlocal placed
        radius = float(np.linalg.norm(points[rows] - points[centre], axis=1).max())
        first = placed
        groups: list = []
        if len(rows) > LEAF_ROWS and radius > 0:
            # The centre stays a centre one level below.
            rows = np.concatenate([[centre], rows[rows != centre]])
            groups, level = _split(points, rows, min(level, radius))
        children = [node(c, own, level) for c, own in groups]
        if not children:
            order.append(rows)
            placed += len(rows)
        return Node(vectors[centre], radius, slice(first, placed), children)

    root = node(0, np.arange(len(ids)), np.inf)
    at = np.concatenate(order)
    return Tree(ids[at], labels[at], vectors[at], norm2, root)


# Search


class Found:
    """The best `k` rows of each window of each anchor: scores, then ids."""

    def __init__(self, least: np.ndarray, most: np.ndarray, k: int) -> None:
        self.least, self.most, self.k = least, most, k
        self.scores = np.full((*least.shape, k), -np.inf)
        self.ids = np.full((*least.shape, k), np.iinfo(np.int64).max)

    def floor(self) -> np.ndarray:
        """What a row must score, at least, to matter to a window."""
        return np.maximum(self.least, self.scores[..., -1])

    def add(self, anchors: np.ndarray, scores: np.ndarray, ids: np.ndarray, fits: np.ndarray) -> None:
        """Rows (columns of `scores`) that fit the anchors, where their scores matter."""
        for w in range(self.least.shape[1]):
            low = np.maximum(self.least[anchors, w], self.scores[anchors, w, -1])
            hit = fits & (scores >= low[:, None]) & (scores <= self.most[anchors, w][:, None])
            at, row = np.nonzero(hit)
            if not len(at):
                continue
            touched, index = np.unique(at, return_inverse=True)
            who = np.concatenate([np.repeat(touched, self.k), at])
            own = anchors[touched]
            score = np.concatenate([self.scores[own, w].ravel(), scores[at, row]])
            name = np.concatenate([self.ids[own, w].ravel(), ids[row]])
            order = np.lexsort((name, -score, who))
            begin = np.searchsorted(who[order], touched)
            best = order[begin[:, None] + np.arange(self.k)]
            self.scores[own, w], self.ids[own, w] = score[best], name[best]


def search(
    tree: Tree, anchors: np.ndarray, labels: np.ndarray, own: np.ndarray, found: Found, same: bool
) -> int:
    """Best-first descent for all anchors; the number of exact inner products.

    `same`: rows of the anchor's own label but for itself; else rows of other labels.
    """
    norms = (anchors * anchors).sum(1)
    reach = norms + tree.norm2
    first, last = tree.labels.min(), tree.labels.max()
    if same:
        able = (labels >= first) & (labels <= last)
    else:
        able = ~((labels == first) & (labels == last))
    able &= (found.most >= found.least).any(1)
    exact = 0

    def bounds(at: Node, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distance = np.sqrt(np.maximum(reach[who] - 2 * (anchors[who] @ at.centre), 0.0))
        slack = 1e-6 * (1 + distance + at.radius) + 1e-7 * np.sqrt(reach[who])
        near = np.maximum(distance - at.radius - slack, 0.0)
        far = distance + at.radius + slack
        return (reach[who] - far * far) / 2 - 1, (reach[who] - near * near) / 2 + 1

    def open_(who: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        inside = (high[:, None] >= found.floor()[who]) & (low[:, None] <= found.most[who])
        return inside.any(1)

    heap: list[tuple[float, int, Node, np.ndarray, np.ndarray, np.ndarray]] = []
    count = 0

    def push(at: Node, who: np.ndarray) -> None:
        nonlocal count
        low, high = bounds(at, who)
        left = open_(who, low, high)
        if left.any():
            count += 1
            heapq.heappush(heap, (-float(high[left].max()), count, at, who[left], low[left], high[left]))

    who = np.flatnonzero(able)
    if len(who):
        push(tree.root, who)
    while heap:
        _, _, at, who, low, high = heapq.heappop(heap)
        who = who[open_(who, low, high)]  # by now the windows may have found better rows
        if at.children:
            for child in at.children if len(who) else ():
                push(child, who)
            continue
        rows = at.rows
        for begin in range(0, len(who), SLICE):
            some = who[begin : begin + SLICE]
            scores = anchors[some] @ tree.vectors[rows].T
            exact += scores.size
            equal = labels[some][:, None] == tree.labels[rows][None, :]
            if same:
                itself = own[some][:, None] == tree.ids[rows][None, :]
                if itself.any():
                    itself &= (scores == norms[some][:, None]) & _equal(anchors[some], tree.vectors[rows], itself)
                fits = equal & ~itself
            else:
                fits = ~equal
            found.add(some, scores, tree.ids[rows], fits)
    return exact


def _equal(a: np.ndarray, b: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Where two vectors are the same, at the places asked for."""
    out = np.zeros(where.shape, bool)
    x, y = np.nonzero(where)
    out[x, y] = (a[x] == b[y]).all(1)
    return out


# Spark


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    """A row of whole numbers for each list, ended by zeros."""
    ends = column.offsets.to_numpy()
    values = np.asarray(column.values.to_numpy(zero_copy_only=False), np.float64)
    size = np.diff(ends)
    out = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(ends[0], ends[-1])
    out[row, at - np.repeat(ends[:-1], size)] = values[ends[0] : ends[-1]]
    return out


def _trees(width: int, tree_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cuts sorted rows into tables of at most `tree_rows`; a row of `trees` holds one."""
        rest: list[pa.RecordBatch] = []
        held = 0

        def packed(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(tables).combine_chunks()
            tree = grown(
                t["vec_id"].to_numpy(), t["label"].to_numpy().astype(np.int64),
                _vectors(t["vector"].chunk(0), width),
            )
            return pa.record_batch(
                {
                    "size": pa.array([len(tree.ids)], pa.int64()),
                    "rows": pa.array([_stored(tree)], pa.binary()),
                }
            )

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, tree_rows - held)
                batch = batch.slice(part.num_rows)
                rest.append(part)
                held += part.num_rows
                if held == tree_rows:
                    yield packed(rest)
                    rest, held = [], 0
        if held:
            yield packed(rest)

    return run


def _stored(tree: Tree) -> bytes:
    """A tree as bytes: header, nodes in preorder, ids, labels, vectors."""
    nodes: list[tuple[float, int, int, int]] = []
    centres: list[np.ndarray] = []

    def walk(at: Node) -> None:
        nodes.append((at.radius, at.rows.start, at.rows.stop, len(at.children)))
        centres.append(at.centre)
        for child in at.children:
            walk(child)

    walk(tree.root)
    small = np.abs(tree.vectors).max(initial=0) < 2**15
    kind = np.dtype("<i2" if small else "<f8")
    head = np.array([len(tree.ids), tree.vectors.shape[1], len(nodes), small, tree.norm2], "<f8")
    parts = [
        head, np.array(nodes, "<f8"), np.array(centres).astype(kind), tree.ids.astype("<i8"),
        tree.labels.astype("<i8"), tree.vectors.astype(kind),
    ]
    return b"".join(x.tobytes() for x in parts)


def _loaded(data: bytes) -> Tree:
    at = 0

    def take(kind: str, *shape: int) -> np.ndarray:
        nonlocal at
        n = int(np.prod(shape))
        out = np.frombuffer(data, kind, n, at).reshape(shape)
        at += out.nbytes
        return out

    n, width, count, small, norm2 = take("<f8", 5)
    n, width, count = int(n), int(width), int(count)
    kind = "<i2" if small else "<f8"
    nodes = take("<f8", count, 4).tolist()
    centres = take(kind, count, width).astype(np.float64)
    ids, labels = take("<i8", n), take("<i8", n)
    vectors = take(kind, n, width).astype(np.float64)
    place = 0

    def walk() -> Node:
        nonlocal place
        radius, first, last, children = nodes[place]
        own = Node(centres[place], radius, slice(int(first), int(last)))
        place += 1
        own.children = [walk() for _ in range(int(children))]
        return own

    return Tree(ids, labels, vectors, float(norm2), walk())


def _cells(width: int, k: int, same: bool):
    """Streams cells: the anchors of a group, then the trees that meet them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, state = None, [], None

        def begun():
            t = pa.Table.from_batches(waiting).combine_chunks()
            own = t["anchor_id"].to_numpy()
            vectors = _vectors(t["vector"].chunk(0), width)
            if same:
                most = np.full((len(own), 1), np.inf)
                least, ranks = -most, None
            else:
                ranks = t["scores"].chunk(0)
                widest = max(1, int(np.diff(ranks.offsets.to_numpy()).max(initial=0)))
                score = np.full((len(own), widest), np.nan)
                ends = ranks.offsets.to_numpy()
                size = np.diff(ends)
                row = np.repeat(np.arange(len(own)), size)
                column = np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], size)
                score[row, column] = ranks.values.to_numpy()[ends[0] : ends[-1]]
                # No positive, or a negative one: an empty window.
                least = np.where(score >= 0, np.ceil(score * LEAST / 100), np.inf)
                most = np.where(score >= 0, np.floor(score * MOST / 100), -np.inf)
            return t, vectors, own, Found(least, most, k)

        def ended(state) -> pa.RecordBatch:
            t, _, own, found = state
            who, window, place = np.nonzero(np.isfinite(found.scores))
            return pa.record_batch(
                {
                    "anchor_key": pa.array(t["anchor_key"].to_numpy()[who], pa.int64()),
                    "anchor_id": pa.array(own[who], pa.int64()),
                    "place": pa.array(window, pa.int32()),
                    "vec_id": pa.array(found.ids[who, window, place], pa.int64()),
                    "score": pa.array(found.scores[who, window, place].astype(np.int64), pa.int64()),
                }
            )

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "kind")], 1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for first, last in zip([0, *edges], [*edges, len(keys)]):
                part = batch.slice(first, last - first)
                if keys[first][0] != cell:
                    if state is not None:
                        yield ended(state)
                    cell, waiting, state = keys[first][0], [], None
                if keys[first][1] == 0:
                    waiting.append(part)
                    continue
                if not waiting:
                    continue  # a group without anchors
                state = state or begun()
                t, vectors, own, found = state
                labels = t["label"].to_numpy().astype(np.int64)
                for data in part.column("rows"):
                    search(_loaded(data.as_py()), vectors, labels, own, found, same)
        if state is not None:
            yield ended(state)

    return run


class HardNegatives:
    """Positives and hard negatives of the anchors of a table `vec_id, embedding, label`."""

    def __init__(
        self,
        embeddings: DataFrame,
        positives: int = POSITIVES,
        negatives: int = NEGATIVES,
        anchor_every: int = ANCHOR_EVERY,
        pivots: int = PIVOTS,
        tree_rows: int = TREE_ROWS,
        group_anchors: int = GROUP_ANCHORS,
    ) -> None:
        self.spark = embeddings.sparkSession
        ship(self.spark)
        self.positives_k, self.negatives_k = positives, negatives
        self.group_anchors = group_anchors
        self.scratch = Scratch(self.spark)
        raw = embeddings.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            F.col("embedding").cast("array<double>").alias("vector"),
        )
        bad = F.exists(
            "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
        )
        rows = (
            raw.dropna()
            .where(~bad)
            .select(
                "vec_id",
                F.transform("vector", lambda x: F.floor(x * float(SCALE)).cast("long")).alias("vector"),
                F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS)
                .otherwise(F.col("label"))
                .alias("label"),
            )
            .distinct()
        )
        self.rows = self.scratch.saved(rows, "rows")
        size = self.rows.agg(F.max(F.size("vector")), F.count_if(self._anchor(anchor_every))).first()
        self.width = max(1, size[0] or 0)
        self.groups = max(1, -(-(size[1] or 0) // group_anchors))
        self.trees = self._grown(pivots, tree_rows)
        # As few cells for each group as keep the cluster busy.
        cores = self.spark.sparkContext.defaultParallelism
        self.parts = max(1, -(-2 * cores // self.groups))
        self.anchors = self.rows.where(self._anchor(anchor_every)).select(
            F.xxhash64("vec_id", "label", "vector").alias("anchor_key"),
            F.col("vec_id").alias("anchor_id"), "label", "vector",
        )

    @staticmethod
    def _anchor(every: int):
        return F.col("vec_id") % every == 0

    def _grown(self, pivots: int, tree_rows: int) -> DataFrame:
        width = self.width
        # A bounded sample: `pivots` vectors.
        sample = self.rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("vector").toArrow()
        if sample.num_rows:
            centres = _vectors(sample["vector"].combine_chunks(), width)
        else:
            centres = np.zeros((1, width))
        half = (centres * centres).sum(1) / 2

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = _vectors(batch.column("vector"), width)
                pivot = (vectors @ centres.T - half).argmax(1) if len(vectors) else []
                yield batch.append_column("pivot", pa.array(pivot, pa.int64()))

        kind = "vec_id long, vector array<long>, label long"
        near = self.rows.select("vec_id", "vector", "label").mapInArrow(nearest, f"{kind}, pivot long")
        near = near.withColumn("spread", F.xxhash64("vec_id", "vector"))
        order = ["label", "pivot", "spread"]
        trees = (
            self.scratch.saved(near, "near")
            .repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .select("vec_id", "label", "vector")
            .mapInArrow(_trees(width, tree_rows), "size long, rows binary")
        )
        saved = self.scratch.saved(trees, "trees")
        self.scratch.drop("near")
        return saved

    def _met(self, anchors: DataFrame, k: int, same: bool) -> DataFrame:
        """The best rows of each window of the anchors: `anchor_key, anchor_id, place, vec_id, score`."""
        group = F.pmod(F.col("anchor_key"), F.lit(self.groups))
        left = anchors.withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1)))
        ).select(
            (group * self.parts + F.col("part")).alias("cell"), F.lit(0).alias("kind"),
            F.lit(None).cast("binary").alias("rows"), "anchor_key", "anchor_id", "label", "vector", "scores",
        )
        part = F.pmod(F.xxhash64("rows"), F.lit(self.parts))
        right = self.trees.withColumn(
            "group", F.explode(F.sequence(F.lit(0), F.lit(self.groups - 1)))
        ).select((F.col("group") * self.parts + part).alias("cell"), F.lit(1).alias("kind"), "rows")
        cells = self.groups * self.parts
        met = (
            left.unionByName(right, allowMissingColumns=True)
            .repartition(cells, "cell")
            .sortWithinPartitions("cell", "kind")
            .mapInArrow(
                _cells(self.width, k, same),
                "anchor_key long, anchor_id long, place int, vec_id long, score long",
            )
        )
        best = Window.partitionBy("anchor_key", "place").orderBy(F.desc("score"), "vec_id")
        return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    def positives(self) -> DataFrame:
        """The nearest rows of each anchor's label: `anchor_key, anchor_id, vec_id, score, rank`."""
        anchors = self.anchors.withColumn("scores", F.lit(None).cast("array<long>"))
        return self._met(anchors, self.positives_k, True).drop("place")

    def mined(self) -> DataFrame:
        """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score`."""
        positives = self.scratch.saved(self.positives(), "positives")
        per_anchor = positives.groupBy("anchor_key").agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]
            ).alias("scores")
        )  # at most `positives` entries each
        anchors = self.anchors.join(per_anchor, "anchor_key")
        found = self._met(anchors, self.negatives_k, False).withColumn("place", F.col("place") + 1)
        chosen = positives.select(
            F.col("anchor_key").alias("key"), F.col("rank").alias("at"),
            F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        )
        return found.join(
            chosen, (F.col("anchor_key") == F.col("key")) & (F.col("place") == F.col("at"))
        ).select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )


def hard_negatives(embeddings: DataFrame, **options) -> DataFrame:
    return HardNegatives(embeddings, **options).mined()

"""Hard negatives by a multiway hyperplane tree with ranges between siblings (GNAT).

A node has a few split points, and each of its rows belongs to the nearest.  Per split point and sibling subtree the
node knows the least and the greatest distance from the point to the subtree's rows, and of each subtree how long
its vectors are.  A window of scores around an anchor is an annulus of distances for vectors of given length, since
|a - x|^2 = |a|^2 + |x|^2 - 2 a.x; with the anchor's distance to a split point it becomes a range of distances from
that point, and siblings whose range it misses are passed over.  Leaves are compared exactly.

The top node is spread over the cluster: its split points come from a bounded sample, all rows are dealt to them, and
each region to chunks of bounded size that hold a tree each.  Anchors go only to the regions, and there to the
chunks, whose ranges meet their window, in blocks of bounded size.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.common import prepare, stored
from tablewright.llm.registry import query, table
from tablewright.llm.vectors import by_size

SAMPLE = 2048  # rows that the top split points are chosen from
REGIONS = 64  # top split points, at most
CHUNK = 4096  # rows of a tree, about
ANCHORS = 1024  # anchors that meet a tree in one task, about
FAN = 512  # ranges of chunks folded at a time
WAYS, LEAF = 8, 256  # split points of a node; rows of a leaf
EXACT = 2.0 ** 53  # whole numbers up to here are exact as doubles
FITS = 2.0 ** 62  # scores beyond would not fit a long


def split_points(matrix: np.ndarray, ways: int) -> np.ndarray:
    """Rows far from each other: each is the farthest from those before it.  Fewer where the rest are copies."""
    chosen, least = [0], _squares(matrix, matrix[:1])[:, 0]
    while len(chosen) < ways and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, _squares(matrix, matrix[chosen[-1:]])[:, 0])
    return matrix[chosen]


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b; exact below 2^53."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T), 0)


def scores_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of a with all rows of b, as whole numbers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < EXACT:
        return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


@dataclass
class Ranges:
    """Split points and, for each of them and each child, the distances to the child's rows; and the rows' lengths."""

    points: np.ndarray
    low: np.ndarray  # [point, child]
    high: np.ndarray
    short: np.ndarray  # [child]: squared length
    long: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, children: list[np.ndarray]) -> Ranges:
        distances = [np.sqrt(_squares(points, c)) for c in children]
        squares = [(c.astype(np.float64) ** 2).sum(axis=1) for c in children]
        return cls(points, np.stack([d.min(axis=1) for d in distances], axis=1), np.stack([d.max(axis=1) for d in distances], axis=1),
                   np.array([s.min() for s in squares]), np.array([s.max() for s in squares]))

    def meets(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """[anchor, child]: whether the child can hold rows whose score with the anchor lies between ``low`` and ``high``."""
        own = (anchors.astype(np.float64) ** 2).sum(axis=1)[:, None]
        low, high = low.astype(np.float64), high.astype(np.float64)
        inner = np.sqrt(np.maximum(own + self.short - 2 * high[:, None], 0))  # the annulus, per child
        outer = np.sqrt(np.maximum(own + self.long - 2 * low[:, None], 0))
        to = np.sqrt(_squares(anchors, self.points))[:, :, None]
        nearest = np.maximum(self.low - to, to - self.high).max(axis=1)  # of any row of the child, from the anchor
        farthest = (to + self.high).min(axis=1)
        slack = 1e-9 * (1 + outer + farthest)
        return (nearest <= outer + slack) & (farthest >= inner - slack)


class Tree:
    """A node with children, or a leaf with rows in the order of their ids."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray):
        self.children: list[Tree] = []
        points = split_points(matrix, WAYS) if len(ids) > LEAF else matrix[:1]
        if len(points) > 1:
            nearest = _squares(matrix, points).argmin(axis=1)
            parts = [np.flatnonzero(nearest == i) for i in range(len(points))]
            parts = [p for p in parts if len(p)]
            self.ranges = Ranges.of(points, [matrix[p] for p in parts])
            self.children = [Tree(ids[p], labels[p], matrix[p]) for p in parts]
        else:  # few rows, or copies only
            order = np.argsort(ids, kind="stable")
            self.ids, self.labels, self.matrix = ids[order], labels[order], matrix[order]

    def search(self, asked: Asked, active: np.ndarray) -> None:
        if not len(active):
            return
        if not self.children:
            for at in range(0, len(self.ids), LEAF):
                part = slice(at, at + LEAF)
                asked.compare(active, self.ids[part], self.labels[part], self.matrix[part])
            return
        # The nearest child first: what it holds narrows the windows for the others.
        own = asked.anchors[asked.anchor[active]]
        meets = self.ranges.meets(own, asked.low[active], asked.high[active])
        for i in np.argsort(-meets.sum(axis=0), kind="stable"):
            some = active[meets[:, i]]
            if len(some):
                still = self.ranges.meets(asked.anchors[asked.anchor[some]], asked.low[some], asked.high[some])[:, i]
                self.children[i].search(asked, some[still])


class Asked:
    """Windows of scores around anchors, and the best rows found in each so far."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, anchor: np.ndarray,
                 low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.ids, self.labels, self.anchors, self.anchor = ids, labels, anchors, anchor
        self.low, self.high, self.k, self.same = low.copy(), high, k, same
        self.found = np.full((len(anchor), k), np.iinfo(np.int64).max)
        self.scores = np.full((len(anchor), k), np.iinfo(np.int64).min)

    def compare(self, active: np.ndarray, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> None:
        """Take the rows (in the order of their ids) into account for the windows ``active``."""
        own, place = np.unique(self.anchor[active], return_inverse=True)
        fits = self.labels[own][:, None] == labels
        fits = (fits if self.same else ~fits) & (self.ids[own][:, None] != ids)
        scores = scores_of(self.anchors[own], matrix)[place]
        fits = fits[place] & (scores >= self.low[active][:, None]) & (scores <= self.high[active][:, None])
        hit = np.flatnonzero(fits.any(axis=1))
        if not len(hit):
            return
        lowest = np.iinfo(np.int64).min
        scores = np.where(fits[hit], scores[hit], lowest)
        if len(ids) > 4 * self.k:  # the k best of each, the first of equal ones
            edge = -np.partition(-np.maximum(scores, lowest + 1), self.k - 1, axis=1)[:, self.k - 1:self.k]
            above, level = scores > edge, (scores == edge) & (scores > lowest)
            keep = above | level & (np.cumsum(level, axis=1) <= self.k - above.sum(axis=1)[:, None])
            scores = np.where(keep, scores, lowest)
            columns = np.argsort(~keep, axis=1, kind="stable")[:, :self.k]
            scores, named = np.take_along_axis(scores, columns, axis=1), ids[columns]
        else:
            named = np.broadcast_to(ids, scores.shape)
        rows = active[hit]
        named = np.concatenate([self.found[rows], np.where(scores > lowest, named, np.iinfo(np.int64).max)], axis=1)
        scores = np.concatenate([self.scores[rows], scores], axis=1)
        order = np.lexsort((named, -np.maximum(scores, lowest + 1)), axis=1)[:, :self.k]
        self.found[rows] = np.take_along_axis(named, order, axis=1)
        self.scores[rows] = scores = np.take_along_axis(scores, order, axis=1)
        # Only rows as good as the k-th count from now on.
        self.low[rows] = np.maximum(self.low[rows], scores[:, -1])


def _regions(points: dict[int, np.ndarray]):
    """Adds the nearest top split point to each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, (rows, matrix) in by_size(batch.column("vec")).items():
                picked = batch.take(pa.array(rows))
                nearest = _squares(matrix, points[dim]).argmin(axis=1) if dim in points else np.zeros(len(rows))
                yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(nearest.astype(np.int32))], names=[*batch.schema.names, "region"])
    return run


def _chunk(points: dict[int, np.ndarray]):
    """One chunk: its tree, and its ranges from the top split points."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first, matrix = rows.iloc[0], np.stack(rows["vec"].to_numpy()).astype(np.int64)
        tree = Tree(rows["id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), matrix)
        ranges = Ranges.of(points.get(int(first["dim"]), matrix[:1]), [matrix])
        return pd.DataFrame({"dim": [first["dim"]], "region": [first["region"]], "salt": [first["salt"]],
                             "tree": [pickle.dumps(tree)], "ranges": [pickle.dumps(ranges)]})
    return run


def _together(parts: list[Ranges]) -> Ranges:
    """Ranges of one region from those of its chunks."""
    return Ranges(parts[0].points, np.min([p.low for p in parts], axis=0), np.max([p.high for p in parts], axis=0),
                  np.min([p.short for p in parts], axis=0), np.max([p.long for p in parts], axis=0))


def _region(rows: pd.DataFrame) -> pd.DataFrame:
    """Fold up to FAN ranges into one."""
    return pd.DataFrame({"dim": [rows["dim"].iloc[0]], "region": [rows["region"].iloc[0]], "salt": [rows["salt"].min()],
                         "ranges": [pickle.dumps(_together([pickle.loads(r) for r in rows["ranges"]]))]})


class Index:
    """The stored trees, and the top node: its split points and ranges, bounded by REGIONS and the kinds of length."""

    def __init__(self, rows: DataFrame):
        """``rows``: id, label, dim, vec (whole numbers)."""
        self.spark = rows.sparkSession
        total = rows.count()
        sample = rows.orderBy(F.xxhash64("id")).limit(SAMPLE).select("dim", "vec").toPandas()
        regions = min(REGIONS, max(1, total // CHUNK))
        self.points = {int(d): split_points(np.stack(part["vec"].to_numpy()).astype(np.int64), regions)
                       for d, part in sample.groupby("dim")}
        placed = stored(rows.mapInArrow(_regions(self.points), "id long, label long, dim int, vec array<long>, region int"), "neg-placed")
        salts = placed.groupBy("dim", "region").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("salts"))
        dealt = placed.join(salts, ["dim", "region"]).withColumn("salt", F.pmod(F.xxhash64("id"), "salts").cast("int")).drop("salts")
        self.chunks = stored(dealt.groupBy("dim", "region", "salt").applyInPandas(
            _chunk(self.points), "dim int, region int, salt int, tree binary, ranges binary"), "neg-trees")
        folded = self.chunks.select("dim", "region", F.floor(F.col("salt") / FAN).cast("int").alias("salt"), "ranges")
        for keys in (["dim", "region", "salt"], ["dim", "region"]):
            folded = folded.groupBy(*keys).applyInPandas(_region, "dim int, region int, salt int, ranges binary")
        self.top: dict[int, list[tuple[int, Ranges]]] = {}
        for r in folded.collect():  # REGIONS at most for each length
            self.top.setdefault(r["dim"], []).append((r["region"], pickle.loads(r["ranges"])))

    def search(self, windows: DataFrame, k: int, *, same: bool) -> DataFrame:
        """``windows``: window, id, label, dim, vec, low, high.  Adds found and score: of rows of the same (or another)
        label the k best within each window, less the anchor itself, per chunk; ``k`` of all chunks decide.
        """
        visits = stored(windows.mapInArrow(_visits(self.top), _ddl(windows) + ", region int"), "neg-visits")
        keys = ["dim", "region"]
        loads = visits.groupBy(*keys).agg(F.ceil(F.count_distinct("id") / ANCHORS).cast("int").alias("blocks"))
        chunks = self.chunks.join(loads, keys).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        salts = self.chunks.groupBy(*keys).agg(F.collect_list("salt").alias("salts"))
        asked = visits.join(loads, keys).join(salts, keys).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int")) \
            .withColumn("salt", F.explode("salts")).drop("salts", "blocks")
        by = [*keys, "salt", "block"]
        found = chunks.select(*by, "tree", "ranges").groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(
            _search(k, same), "window long, found long, score long")
        return stored(found, "neg-found")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{c} {t}" for c, t in df.dtypes)


def _visits(top: dict[int, list[tuple[int, Ranges]]]):
    """One row per window and region that it meets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, (rows, matrix) in by_size(batch.column("vec")).items():
                picked = batch.take(pa.array(rows))
                low, high = (picked.column(c).to_numpy() for c in ("low", "high"))
                for region, ranges in top.get(dim, []):
                    hit = pa.array(np.flatnonzero(ranges.meets(matrix, low, high)[:, 0]))
                    if len(hit):
                        yield pa.RecordBatch.from_arrays([*picked.take(hit).columns, pa.array(np.full(len(hit), region, np.int32))],
                                                         names=[*batch.schema.names, "region"])
    return run


def _search(k: int, same: bool):
    def run(chunk: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        names = ["window", "found", "score"]
        if not len(chunk) or not len(rows):
            return pd.DataFrame(np.empty((0, 3), np.int64), columns=names)
        ids, first, anchor = np.unique(rows["id"].to_numpy(np.int64), return_index=True, return_inverse=True)
        asked = Asked(ids, rows["label"].to_numpy(np.int64)[first], np.stack(rows["vec"].to_numpy()[first]).astype(np.int64), anchor,
                      rows["low"].to_numpy(np.int64), rows["high"].to_numpy(np.int64), k, same)
        ranges: Ranges = pickle.loads(chunk["ranges"].iloc[0])
        meets = ranges.meets(asked.anchors[anchor], asked.low, asked.high)[:, 0]
        pickle.loads(chunk["tree"].iloc[0]).search(asked, np.flatnonzero(meets))
        where = np.nonzero(asked.scores > np.iinfo(np.int64).min)
        return pd.DataFrame({"window": rows["window"].to_numpy(np.int64)[where[0]], "found": asked.found[where],
                             "score": asked.scores[where]}, columns=names)
    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("window").orderBy(F.desc("score"), "found")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchors: str, *, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Components are scaled and rounded down to whole numbers, and a score is the inner product.  ``anchors``: SQL
    condition on ``id`` that says which rows are anchors.  An anchor's positives are its best other rows of its label;
    to each, the best rows of other labels whose score is from ``low`` to ``high`` percent of the positive's.  Ties go
    to the smaller id.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part, nor vectors so long
    that a score would not fit a long; zero vectors do.  Of rows that share an id the smallest label and vector
    counts.  Vectors are compared with those of their length.  An anchor without positives, or a positive without
    negatives in its window (as with every score below 0), gives no row; an empty table gives an empty result.
    Other columns are not read.
    """
    prepare(vectors.sparkSession)
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale))
    length = F.aggregate(vector_col, F.lit(0.0), lambda a, x: a + F.pow(x.cast("double") * scale, F.lit(2.0)))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce(finite, F.lit(False)) & (length < FITS))
    rows = rows.groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.min(F.struct(F.col(label_col).cast("long").alias("label"), scaled.cast("array<long>").alias("vec"))).alias("row"))
    rows = stored(rows.select("id", "row.label", F.size("row.vec").alias("dim"), "row.vec"), "neg-rows")
    index = Index(rows)
    if not index.top:
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                                     "positive_score long, negative_score long")
    asked = rows.filter(anchors).withColumn("window", F.col("id"))
    everything = F.lit(int(-2 ** 62)).alias("low"), F.lit(int(2 ** 62)).alias("high")
    near = _first(index.search(asked.select("window", "id", "label", "dim", "vec", *everything), positives, same=True), positives)
    near = near.select(F.col("window").alias("id"), F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    # low * p <= 100 * n <= high * p, in whole numbers
    least = F.expr(f"({low} * positive_score + 99) div 100").alias("low")
    most = F.expr(f"{high} * positive_score div 100").alias("high")
    pairs = stored(near.filter("positive_score >= 0").join(asked.drop("window"), "id").withColumn("window", F.monotonically_increasing_id()), "neg-pairs")
    found = _first(index.search(pairs.select("window", "id", "label", "dim", "vec", least, most), negatives, same=False), negatives)
    return found.join(pairs.select("window", "id", "positive_id", "positive_score"), "window").select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("found").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


_SQL = """
with r as (select vec_id as id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label,
      list_transform(embedding, lambda x: floor(256 * cast(x as double))) as vec from embeddings
      where label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.id as anchor, b.id as other, a.label = b.label as same, cast(list_dot_product(a.vec, b.vec) as bigint) as score
      from r a join r b on a.id <> b.id where a.id % 50 = 0),
p as (select anchor, other, score from (select *, row_number() over (partition by anchor order by score desc, other) as n from s where same)
      where n <= 5),
n as (select p.anchor as anchor_id, p.other as positive_id,
      row_number() over (partition by p.anchor, p.other order by s.score desc, s.other) as rank,
      s.other as negative_id, p.score as positive_score, s.score as negative_score
      from p join s on p.anchor = s.anchor and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 3
"""


@query("op13_hard_negatives", _SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"), "id % 50 = 0")

"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of TABLES tables cuts space along HASHES random directions into cells of a width that follows the data.  A
query visits, in each table, its own cell and PROBES - 1 others, in the order in which they are likely to hold
neighbours: a step across a boundary costs the square of the query's distance to it.  Cells are dealt into shares
of bounded size, and a query goes only to the shares with cells that it visits.  Every share returns its nearest by
exact distance; the best of all shares and tables are the result.  A query that found too few is compared with
every row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.common import prepare, stored
from tablewright.llm.registry import query, table
from tablewright.llm.vectors import by_size, usable

TABLES, HASHES, PROBES = 6, 8, 200
WIDTH = 1.414  # of a cell, times the median distance in the sample
SAMPLE = 2048  # rows that the median is taken from
SHARE = 8192  # rows of an index share, about
QUERIES = 2048  # queries that a task takes at once, about


@lru_cache(maxsize=64)
def _directions(number: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Of one table: normal directions, and where the cells begin (as a share of their width)."""
    draw = np.random.default_rng([number, dim])
    return draw.standard_normal((dim, HASHES)), draw.uniform(0, 1, HASHES)


def _cell_ids(number: int, dim: int, cells: np.ndarray) -> np.ndarray:
    """A 64-bit name for each row of cell coordinates."""
    total = np.full(len(cells), np.uint64(number * 1_000_003 + dim), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for column in cells.astype(np.int64).view(np.uint64).T:
            total = (total ^ column) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
    return (total >> np.uint64(1)).astype(np.int64)


def _places(number: int, matrix: np.ndarray, width: float) -> np.ndarray:
    directions, begin = _directions(number, matrix.shape[1])
    return matrix @ directions / width + begin




def probe_cells(place: np.ndarray, probes: int) -> np.ndarray:
    """Cells in the order in which they are likely to hold neighbours, the own one first.

    Steps to the next cell up or down are ranked by their cost; sets of steps grow from cheap to dear by replacing
    or adding the next step (Lv et al., 2007).
    """
    own = np.floor(place).astype(np.int64)
    inside = place - own
    steps = sorted([(float(x) ** 2, i, -1) for i, x in enumerate(inside)] + [(float(1 - x) ** 2, i, 1) for i, x in enumerate(inside)])
    cells, heap = [own], [(steps[0][0], (0,))]
    while heap and len(cells) < probes:
        cost, chosen = heapq.heappop(heap)
        if len({steps[s][1] for s in chosen}) == len(chosen):
            cell = own.copy()
            for s in chosen:
                cell[steps[s][1]] += steps[s][2]
            cells.append(cell)
        last = chosen[-1]
        if last + 1 < len(steps):
            heapq.heappush(heap, (cost - steps[last][0] + steps[last + 1][0], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + steps[last + 1][0], (*chosen, last + 1)))
    return np.array(cells)


def _index(width: float, shares: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, (rows, matrix) in by_size(batch.column("vec")).items():
                picked = batch.take(pa.array(rows))
                for number in range(TABLES):
                    cells = _cell_ids(number, dim, np.floor(_places(number, matrix, width)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), number, np.int32)), pa.array((cells % shares).astype(np.int32)),
                         pa.array(cells), picked.column("id"), picked.column("vec")], names=["tab", "share", "cell", "id", "vec"])
    return run


def _probes(width: float, shares: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, (rows, matrix) in by_size(batch.column("vec")).items():
                for number in range(TABLES):
                    out: list[list] = [[], [], []]
                    for row, place in zip(rows, _places(number, matrix, width)):
                        cells = _cell_ids(number, dim, probe_cells(place, PROBES))
                        for share in np.unique(cells % shares):
                            for column, value in zip(out, (share, cells[cells % shares == share], row)):
                                column.append(value)
                    picked = batch.take(pa.array(out[2], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(picked), number, np.int32)), pa.array(np.array(out[0], np.int32)),
                         pa.array(out[1], pa.list_(pa.int64())), picked.column("id"), picked.column("vec")],
                        names=["tab", "share", "cells", "id", "vec"])
    return run


def _nearest(query_id: int, vector: np.ndarray, ids: np.ndarray, matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    distance = np.sqrt(((matrix - vector) ** 2).sum(axis=1))
    rows = np.flatnonzero(ids != query_id)
    if len(rows) > k:
        edge = np.partition(distance[rows], k - 1)[k - 1]
        rows = rows[distance[rows] <= edge]
    rows = rows[np.lexsort((ids[rows], distance[rows]))][:k]
    return ids[rows], distance[rows]


def _search(k: int):
    """Within one share: of the rows in the cells that a query visits, the k nearest.  No cells: all rows."""
    def run(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(points) and len(queries):
            points = points.sort_values("cell", kind="stable")
            sizes = points["vec"].map(len).to_numpy()
            for dim in np.unique(sizes):
                cells, ids = points["cell"].to_numpy()[sizes == dim], points["id"].to_numpy()[sizes == dim]
                matrix = np.stack(points["vec"].to_numpy()[sizes == dim]).astype(np.float64)
                for query_id, vector, visited in zip(queries["id"], queries["vec"], queries["cells"]):
                    if len(vector) != dim:
                        continue
                    rows = slice(None)
                    if len(visited):
                        visited = np.sort(visited)
                        rows = np.concatenate([np.arange(lo, hi) for lo, hi in zip(
                            np.searchsorted(cells, visited, "left"), np.searchsorted(cells, visited, "right")) if hi > lo]
                            or [np.empty(0, np.int64)])
                    near, distance = _nearest(query_id, np.asarray(vector, dtype=np.float64), ids[rows], matrix[rows], k)
                    found += zip([query_id] * len(near), near.tolist(), distance.tolist())
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
    return run


def _deal(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Search share by share.  Large shares are divided, and many queries of a share go to several tasks."""
    keys = ["tab", "share"]
    sizes = points.groupBy(*keys).agg(F.ceil(F.count("*") / (2 * SHARE)).cast("int").alias("salts"))
    loads = queries.groupBy(*keys).agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))
    sizes = stored(sizes.join(loads, keys), "ann-shares")
    salted = points.join(sizes, keys).withColumn("salt", F.pmod(F.xxhash64("id"), "salts").cast("int")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("salts", "blocks")
    asked = queries.join(sizes, keys).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int")) \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts", "blocks")
    by = [*keys, "salt", "block"]
    return salted.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(_search(k), "query_id long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, asked: str, *, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance) of each query's k nearest rows found.

    ``asked``: SQL condition on ``id`` that says which rows are queries; the others and these are candidates, but no
    row of the query's own.  Vectors that are null, zero or hold a null or a non-finite number take no part, nor
    rows without an id; of rows that repeat an id the smallest vector counts; vectors are compared with those of
    their length.  Ties go to the smaller id.  Fewer rows than k: all of them.  Other columns are not read.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.min(F.col(vector_col)).alias("vec"))
    rows = stored(rows, "ann-rows")
    kind = dict(rows.dtypes)["vec"]
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("id")).limit(SAMPLE).toPandas()["vec"]
    width, shares = WIDTH * _typical_distance(sample), max(1, -(-total // SHARE))
    points = stored(rows.mapInArrow(_index(width, shares), f"tab int, share int, cell long, id long, vec {kind}"), "ann-index")
    queries = rows.filter(asked)
    probes = queries.mapInArrow(_probes(width, shares), f"tab int, share int, cells array<long>, id long, vec {kind}")
    found = stored(_best(_deal(points, stored(probes, "ann-probes"), k), k), "ann-found")

    # The exact way for queries that found fewer than there are.
    others = rows.groupBy(F.size("vec").alias("dim")).agg((F.count("*") - 1).alias("others"))
    counts = found.groupBy("query_id").agg(F.count("*").alias("n"))
    short = queries.withColumn("dim", F.size("vec")).join(others, "dim").join(counts, queries["id"] == counts["query_id"], "left") \
        .filter(F.coalesce("n", F.lit(0)) < F.least(F.lit(k), "others")).select("id", "vec")
    short = stored(short, "ann-short")
    if not short.isEmpty():
        everything = rows.select(F.lit(0).alias("tab"), F.pmod(F.xxhash64("id"), F.lit(shares)).cast("int").alias("share"),
                                 F.lit(0).cast("long").alias("cell"), "id", "vec")
        to_all = short.select(F.lit(0).alias("tab"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"),
                              F.array().cast("array<long>").alias("cells"), "id", "vec")
        found = found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(
            _best(_deal(everything, to_all, k), k))
    return found.select("query_id", "rank", "vec_id", "score")


def _typical_distance(sample: pd.Series) -> float:
    """The median distance of neighbouring rows of the sample; 1 where there is none."""
    pairs = [np.linalg.norm(np.asarray(a, float) - np.asarray(b, float)) for a, b in zip(sample[:-1], sample[1:]) if len(a) == len(b)]
    return float(np.median(pairs)) or 1.0 if pairs else 1.0


@query("op3_nearest_neighbours")
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), "id % 100 = 0")

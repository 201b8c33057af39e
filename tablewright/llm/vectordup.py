"""Near-duplicate vectors of a label by tiled comparison in the order of principal components.

Equal vectors are one class.  Unit vectors are turned to principal axes, fitted on a bounded sample; the axes only
decide the order of work.  Two vectors of cosine t are at most sqrt(2 - 2t) apart, so cells of that width along the
leading axes need to be compared with their neighbours alone.  Cells are cut into tiles of bounded size, and pairs
of tiles are the unit of work: products accumulate axis by axis, what the remaining axes can add is at most the
product of the suffix norms, and rows, columns and finally the pair are given up when the threshold is out of reach.
A pair of tiles returns counts and a spanning forest, never its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import prepare, stored
from tablewright.llm.components import components
from tablewright.llm.registry import query, table
from tablewright.llm.vectors import usable

TILE = 256
AXES = 3  # leading axes that cells are cut along
STEP = 8  # axes added between two looks at the bound
SAMPLE = 20_000  # vectors the axes are fitted on


def principal_axes(sample: np.ndarray) -> np.ndarray:
    """Columns: orthonormal axes, the one with most spread first."""
    centred = sample - sample.mean(axis=0)
    return np.linalg.eigh(centred.T @ centred)[1][:, ::-1].copy()


def _axes(by_dim: dict[int, np.ndarray], dim: int) -> np.ndarray:
    return by_dim[dim] if dim in by_dim else np.eye(dim)


def _cells(by_dim: dict[int, np.ndarray], width: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = []
            for v in batch["vec"]:
                v = np.asarray(v, dtype=np.float64)
                v = v / np.abs(v).max()
                lead = (v / np.linalg.norm(v)) @ _axes(by_dim, len(v))[:, :AXES]
                cells.append(np.floor(lead / width).astype(np.int64).tolist() + [0] * (AXES - len(lead)))
            yield batch.assign(cell=cells)
    return run


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("rep")
    return pd.DataFrame({"tile": [rows["tile"].iloc[0]], "reps": [rows["rep"].to_numpy().astype("<i8").tobytes()],
                         "sizes": [rows["size"].to_numpy().astype("<i8").tobytes()],
                         "data": [np.stack(rows["vec"].to_numpy()).astype("<f8").tobytes()]})


def linked(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of a and b (double, not zero) have a cosine of ``threshold`` or more."""
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    a, b = a / np.linalg.norm(a, axis=1, keepdims=True), b / np.linalg.norm(b, axis=1, keepdims=True)
    ya, yb = a @ axes, b @ axes
    rest = lambda y: np.sqrt(np.maximum(0, np.cumsum((y ** 2)[:, ::-1], axis=1)[:, ::-1]))
    rest_a, rest_b = (np.hstack([rest(y), np.zeros((len(y), 1))]) for y in (ya, yb))
    rows, columns = np.arange(len(a)), np.arange(len(b))
    total = np.zeros((len(a), len(b)))
    for start in range(0, ya.shape[1], STEP):
        end = min(start + STEP, ya.shape[1])
        total += ya[rows, start:end] @ yb[columns, start:end].T
        alive = total + np.outer(rest_a[rows, end], rest_b[columns, end]) >= threshold - 1e-9
        keep_rows, keep_columns = alive.any(axis=1), alive.any(axis=0)
        if not keep_rows.any():
            return np.zeros((len(a), len(b)), dtype=bool)
        rows, columns, total = rows[keep_rows], columns[keep_columns], total[np.ix_(keep_rows, keep_columns)]
        alive = alive[np.ix_(keep_rows, keep_columns)]
    out = np.zeros((len(a), len(b)), dtype=bool)
    i, j = np.nonzero(alive)
    i, j = rows[i], columns[j]
    out[i, j] = (a[i] * b[j]).sum(axis=1) >= threshold  # on the vectors as given
    return out


def forest(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row and column the smallest id that links reach within this pair of tiles."""
    big = np.iinfo(np.int64).max
    while True:
        new_right = np.minimum(right, np.where(links, left[:, None], big).min(axis=0))
        new_left = np.minimum(left, np.where(links, new_right[None, :], big).min(axis=1))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def _compare(by_dim: dict[int, np.ndarray], threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for t in batch.itertuples(index=False):
                ra, rb, sa, sb = (np.frombuffer(x, "<i8") for x in (t.reps_a, t.reps_b, t.sizes_a, t.sizes_b))
                a, b = np.frombuffer(t.data_a, "<f8").reshape(len(ra), -1), np.frombuffer(t.data_b, "<f8").reshape(len(rb), -1)
                links = linked(a, b, _axes(by_dim, a.shape[1]), threshold)
                if same := t.a == t.b:
                    np.fill_diagonal(links, False)
                if not links.any():
                    continue
                to_a, to_b = forest(links, ra, rb)
                out = [(ra, links @ sb, to_a)] + ([] if same else [(rb, sa @ links, to_b)])
                for reps, weights, to in out:
                    hit = weights > 0
                    yield pd.DataFrame({"rep": reps[hit], "links": weights[hit], "to": to[hit]})
    return run


def near_duplicates(vectors: DataFrame, *, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors that are null, zero or hold a null or a non-finite number, rows without a label or an id, and vectors of
    different length link with nothing.  Rows that repeat an id are vectors of
    their own, each with its links and its component.
    An empty table gives an empty result.  Other columns are not read.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec"), F.col(label_col).alias("label"))
    good = rows.filter(usable(F.col("vec")) & F.col("id").isNotNull() & F.col("label").isNotNull())
    classes = stored(good.groupBy("label", "vec").agg(F.min("id").alias("least"), F.count("*").alias("size")) \
        .withColumn("rep", F.monotonically_increasing_id()), "vec-classes")  # a number of its own: ids may repeat
    sample = classes.orderBy(F.xxhash64("least", "label")).limit(SAMPLE).select("vec").toPandas()["vec"]
    by_dim = {}
    for dim in {len(v) for v in sample}:
        picked = np.stack([np.asarray(v, dtype=np.float64) for v in sample if len(v) == dim])
        by_dim[dim] = principal_axes(picked / np.linalg.norm(picked, axis=1, keepdims=True))
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6)

    placed = classes.mapInPandas(_cells(by_dim, width), f"{_schema(classes)}, cell array<long>").withColumn("dim", F.size("vec"))
    placed = stored(placed, "vec-cells")
    key = ["label", "dim", "cell"]
    cells = placed.groupBy(*key).agg(F.ceil(F.count("*") / TILE).cast("int").alias("subs"))
    tile = lambda sub: F.struct("label", "dim", "cell", sub.cast("int").alias("sub"))
    packed = stored(placed.join(cells, key).withColumn("tile", F.xxhash64(tile(F.pmod(F.xxhash64("rep"), F.col("subs"))))).select(
        "tile", "rep", "size", "vec").groupBy("tile").applyInPandas(_pack, "tile long, reps binary, sizes binary, data binary"), "vec-tiles")

    # Each pair of neighbouring cells once, then each pair of their tiles once.
    steps = F.array(*[F.lit(x) for x in (-1, 0, 1)])
    shifts = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(0).alias("z")))
    shifts = F.filter(F.flatten(F.flatten(F.transform(steps, lambda x: F.transform(steps, lambda y: F.transform(
        steps, lambda z: F.struct(x.alias("x"), y.alias("y"), z.alias("z"))))))),
        lambda s: s >= F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(0).alias("z")))
    near = cells.withColumn("s", F.explode(shifts)).select(
        "label", "dim", F.array(*[F.col("cell")[i] + F.col("s")[n] for i, n in enumerate("xyz")]).alias("cell"),
        F.col("cell").alias("from"), F.col("subs").alias("from_subs"))
    pairs = cells.join(near, key).withColumn("same", F.col("cell") == F.col("from")) \
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("from_subs") - 1))) \
        .withColumn("j", F.explode(F.sequence(F.when(F.col("same"), F.col("i")).otherwise(0), F.col("subs") - 1)))
    pairs = pairs.select(F.xxhash64(F.struct("label", "dim", F.col("from").alias("cell"), F.col("i").alias("sub"))).alias("a"),
                         F.xxhash64(tile(F.col("j"))).alias("b"))
    side = lambda s: packed.select(F.col("tile").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("reps", "sizes", "data")])
    found = stored(pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(
        _compare(by_dim, threshold), "rep long, links long, to long"), "vec-found")

    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("to").alias("b"))).withColumnRenamed("node", "rep")
    groups = groups.join(classes.select("rep", "least"), "rep")
    names = groups.groupBy("component").agg(F.min("least").alias("name"))
    groups = groups.join(names, "component").select("rep", "name")
    judged = classes.join(counts, "rep", "left").join(groups, "rep", "left").select(
        "label", "vec", F.coalesce("name", "least").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"))
    alone = ~usable(F.col("vec")) | F.col("id").isNull() | F.col("label").isNull()
    result = rows.filter(~alone).join(judged, ["label", "vec"], "left").select("id", "links", "component").unionByName(
        rows.filter(alone).select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component")))
    return result.select(F.col("id").alias(id_col), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
                         F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def _schema(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


_SQL = """
with recursive v as (select vec_id, label, cast(embedding as double[]) as e from embeddings),
p as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
      where list_cosine_similarity(a.e, b.e) >= 0.93),
r(a, b) as (select vec_id, vec_id from v union select r.a, p.b from r join p on r.b = p.a),
c as (select a as vec_id, min(b) as component_id from r group by a),
n as (select a as vec_id, count(*) as n from p group by a)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from c left join n using (vec_id)
"""


@query("op6_embedding_near_dedup", _SQL)
def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))

"""Near-duplicate texts by bottom-k sketches of one hash function.

A document's set is its distinct five-word shingles, as 64-bit hashes.  The sketch keeps the K smallest.  Documents
are first folded into classes of equal word sequences.  Inverted lists of retained values propose pairs; the union
of two sketches estimates their similarity and drops hopeless ones; the full sets decide.

Similar documents share most of the COUNTED smallest values, so they also share some of their rarest ones: only
these are listed.  A document of its own has none that occurs twice, and text that many documents contain, being
frequent, is listed only by documents that consist of little else.

A list is never multiplied out.  In a few rounds each list compares its members with one pivot only, and lists whose
members have all become connected are left alone.  The members of those that remain are dealt into tiles of bounded
size; a task compares the full sets of one tile and returns only the links of a spanning forest, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import fresh, gram_hashes, prepare, stored, whole_text, word_hashes
from tablewright.llm.components import components
from tablewright.llm.registry import query, table

WORDS = 5
# Values kept, values that lists are made of, and how far an estimate may lie below the threshold: five deviations of
# an estimate from K values.  See ``_least_shared``.
K, COUNTED, MARGIN = 64, 32, 0.27
DEPTH = 3  # values that similar documents share among those listed
ROUNDS = 2
BLOCK = 1024  # members of a list on one side of a tile, about
SHINGLES = 1_000_000  # and their shingles


def shingle_set(text: bytes) -> tuple[np.ndarray, bytes]:
    """The sorted distinct shingle hashes (63 bits) of a text, and the digest of its words."""
    words = text.lower().split()  # of bytes: A-Z, and white space of ASCII alone
    hashes = np.unique(gram_hashes(word_hashes(words), WORDS) >> np.uint64(1)).astype(np.int64)
    return hashes, xxhash.xxh3_128_digest(b" ".join(words))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.empty(0, np.int64)])))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [shingle_set(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("mark"), pa.array([d for _, d in made], pa.binary()),
             pa.array([len(s) for s, _ in made], pa.int64()), _lists([s[:K] for s, _ in made])],
            names=["doc", "mark", "digest", "n", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [shingle_set(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        # The id that names a class can have other texts as well.
        own = [i for i, (made_, digest) in enumerate(zip(made, batch.column("digest").to_pylist())) if made_[1] == digest]
        yield pa.RecordBatch.from_arrays([batch.column("c").take(pa.array(own, pa.int64())), _lists([made[i][0] for i in own])],
                                         names=["c", "shingles"])


def _estimate(a: Column, b: Column) -> Column:
    """Similarity of two sets from the K smallest values of the union of their sketches."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, K)
    return F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.size(union)


def _least_shared(n: Column, percent: int) -> Column:
    """How many of the COUNTED smallest values a set of n shares with any similar one.

    All of a small set is counted, so this follows from its size (less what the other set may have beyond COUNTED);
    of a larger one the number is binomial, and five deviations below its mean are left out (3e-7).
    """
    p = percent / 100
    sure = F.ceil(n * p) - F.greatest(F.lit(0), F.floor(n / p) - COUNTED)
    return F.when(n <= COUNTED, F.greatest(F.lit(1), sure)).otherwise(int(COUNTED * p - 5 * math.sqrt(COUNTED * p * (1 - p))))


def _lists_of(classes: DataFrame, percent: int) -> DataFrame:
    """v, c, copies: of each class the values that it must share with a similar one, less those that no other has.

    Two classes that share t of their values share DEPTH of the size - t + DEPTH rarest of either.
    """
    values = classes.select("c", F.explode(F.slice("sketch", 1, COUNTED)).alias("v"))
    counts = values.groupBy("v").agg(F.count("*").alias("df")).filter("df > 1")
    shared = values.join(counts, "v").groupBy("c").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("shared"))
    size = F.least(F.col("n"), F.lit(COUNTED))
    t = _least_shared(F.col("n"), percent)
    own = size - F.size("shared")  # the rarest of all: values that no other class has
    listed = shared.join(classes.select("c", "copies", "n"), "c").withColumn(
        "shared", F.slice("shared", F.lit(1), F.greatest(F.lit(0), size - t + F.least(F.lit(DEPTH), t) - own).cast("int")))
    return listed.filter(F.size("shared") >= F.least(F.lit(DEPTH), t)).select(
        "c", "copies", F.explode("shared.v").alias("v"))


def _with_shared(listed: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds n and s: how many shingles a class has, and how many of them another listed class has as well."""
    own = sets.select("c", F.explode("shingles").alias("x")).groupBy("x").agg(
        F.count("*").alias("df"), F.min("c").alias("c")).filter("df = 1").groupBy("c").agg(F.count("*").alias("own"))
    sizes = classes.select("c", "n").join(listed.select("c").distinct(), "c").join(own, "c", "left").select(
        "c", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("s"))
    return listed.join(sizes, "c")


def _may_link(n_a: Column, s_a: Column, n_b: Column, s_b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar: what is common is at most the smaller number of shared shingles."""
    return (100 + percent) * F.least(s_a, s_b) >= percent * (n_a + n_b)


def _hopeful_rows(listed: DataFrame, percent: int) -> DataFrame:
    """Without the rows that could not link even with the smallest and best shared sets of their list."""
    best = listed.groupBy("v").agg(F.min("n").alias("n_min"), F.max("s").alias("s_max"))
    n_b = F.greatest(F.col("n_min"), F.ceil(F.col("n") * percent / 100))
    return listed.join(best, "v").filter(_may_link(F.col("n"), F.col("s"), n_b, F.col("s_max"), percent)).drop("n_min", "s_max")


def _sides(pairs: DataFrame, values: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` with the columns of both sides, as x_a and x_b."""
    for side in "ab":
        pairs = pairs.join(values.select(F.col("c").alias(side), *[F.col(x).alias(f"{x}_{side}") for x in columns]), side)
    return pairs


class _Linker:
    """Tests pairs of classes and keeps what has been linked: comp (c, comp) changes with every ``link``."""

    def __init__(self, classes: DataFrame, sets: DataFrame, percent: int):
        self.classes, self.sets, self.percent = classes, sets, percent
        self.comp: DataFrame | None = None

    def labelled(self, rows: DataFrame) -> DataFrame:
        if self.comp is None:
            return rows.withColumn("comp", F.col("c"))
        comp = self.comp.select(F.col("node").alias("c"), "component")
        return rows.join(comp, "c", "left").withColumn("comp", F.coalesce("component", "c")).drop("component")

    def link(self, pairs: DataFrame) -> None:
        """``pairs``: a, b, comp_a, comp_b.  Links components of which a pair is similar."""
        p = self.percent
        pairs = pairs.select(*[F.when(F.col("a") < F.col("b"), F.col(x)).otherwise(F.col(y)).alias(x) for x, y in (
            ("a", "b"), ("b", "a"), ("comp_a", "comp_b"), ("comp_b", "comp_a"))]).distinct()
        hopeful = _sides(pairs, self.classes, ["n", "sketch"]).filter(
            (100 * F.least("n_a", "n_b") >= p * F.greatest("n_a", "n_b"))
            & (_estimate(F.col("sketch_a"), F.col("sketch_b")) >= p / 100 - MARGIN)).select("a", "b", "comp_a", "comp_b")
        both = F.size(F.array_intersect("shingles_a", "shingles_b")).cast("long")
        similar = _sides(stored(hopeful, "near-hopeful"), self.sets, ["shingles"]).select(
            F.col("comp_a").alias("a"), F.col("comp_b").alias("b"), both.alias("both"),
            (F.size("shingles_a") + F.size("shingles_b")).alias("sum")).filter((100 + p) * F.col("both") >= p * F.col("sum"))
        self.merge(similar.select("a", "b"))

    def merge(self, links: DataFrame) -> None:
        """``links``: a, b, components that belong together."""
        edges = stored(links.distinct(), "near-links")
        if edges.isEmpty():
            return
        merged = components(edges)
        if self.comp is None:
            self.comp = merged
            return
        up = merged.select(F.col("node").alias("component"), F.col("component").alias("up"))
        new = merged.join(self.comp.select("node"), "node", "left_anti")
        self.comp = stored(self.comp.join(up, "component", "left").select(
            "node", F.coalesce("up", "component").alias("component")).unionByName(new), "near-components")


def _open_lists(rows: DataFrame, key: str) -> DataFrame:
    """The rows of lists that hold more than one component."""
    mixed = rows.groupBy(key).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("length"))
    return rows.join(mixed.filter("lo < hi").select(key, "length"), key)


def _tiles(rows: DataFrame) -> DataFrame:
    """v, lo, hi, own, c, comp: of each list the pairs of blocks, and the members of both.

    Lists of the same members are one.
    """
    same = [F.bit_xor(F.xxhash64("c", F.lit(seed))).alias(f"x{seed}") for seed in (1, 2)]
    lists = rows.groupBy("v").agg(F.count("*").alias("m"), F.sum("n").alias("total"), *same)
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("total") / SHINGLES)).cast("int").alias("blocks")
    lists = lists.groupBy("m", "total", "x1", "x2").agg(F.min("v").alias("v")).select("v", blocks)
    dealt = rows.join(lists, "v").withColumn("own", F.pmod(F.xxhash64("c", F.lit(3)), "blocks").cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select("v", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "c", "comp")


def _forest(percent: int):
    """Within one tile: links between components, no more than connect them."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        comp, lo, hi = rows["comp"].to_numpy(), int(rows["lo"].iloc[0]), int(rows["hi"].iloc[0])
        left, right = (rows["own"] == lo).to_numpy(), (rows["own"] == hi).to_numpy()
        sets, links = [np.asarray(s, np.int64) for s in rows["shingles"]], []
        sizes = np.array([len(s) for s in sets])
        if (comp != comp[0]).any() and left.any() and right.any():
            begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            held, flat = np.unique(np.concatenate(sets), return_inverse=True)
            mark, root = np.zeros(len(held), np.int32), comp.copy()
            for a in np.flatnonzero(left):
                able = right & (root != root[a]) & (100 * np.minimum(sizes, sizes[a]) >= percent * np.maximum(sizes, sizes[a]))
                if lo == hi:
                    able[:a] = False
                if not able.any():
                    continue
                own = flat[begins[a]:begins[a] + sizes[a]]
                mark[own] = 1
                both = np.add.reduceat(mark[flat], begins)
                mark[own] = 0
                for b in np.flatnonzero(able & ((100 + percent) * both >= percent * (sizes + sizes[a]))):
                    if root[b] != root[a]:
                        links.append((int(comp[a]), int(comp[b])))
                        root[root == root[b]] = root[a]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")
    return run


def near_duplicates(docs: DataFrame, *, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc, n_shingles, component_id (smallest doc reachable by links), kept (it is that one).

    Two documents are linked if their sets are similar by ``percent`` or more.  Null and empty texts have no
    shingles and link with nothing; fewer than five words are one shingle; the texts of a repeated id are linked each
    by itself, and of one that is a component of its own the id is the name; a row without an id links with nothing
    and is kept; an empty table gives an empty result.  Other columns are not read.
    """
    return _judged(docs, percent, id_col, text_col).select("doc", "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """What ``near_duplicates`` returns, and mark (a hash of the text, which tells the texts of an id apart)."""
    spark = docs.sparkSession
    prepare(spark)
    text = whole_text(text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("mark"), text.alias("text"))
    sketches = stored(texts.mapInArrow(_sketches, "doc long, mark long, digest binary, n long, sketch array<long>"), "near-sketches")
    folded = sketches.filter("n > 0 and doc is not null").groupBy("digest").agg(
        F.min("doc").alias("least"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    # A class has a number of its own: its smallest id can be that of another class, too.
    classes = stored(folded.withColumn("c", F.monotonically_increasing_id()), "near-classes")
    listed = stored(_lists_of(classes, percent), "near-lists")
    able = listed.select("c").distinct().join(classes.select("c", "digest", F.col("least").alias("doc")), "c")
    needed = texts.join(able, "doc").select("c", "digest", "text")
    sets = stored(needed.mapInArrow(_sets, "c long, shingles array<long>"), "near-sets")
    sets = sets.dropDuplicates(["c"]) if _repeats(sets) else sets
    linker = _Linker(classes, sets, percent)

    rows = stored(_hopeful_rows(_with_shared(listed, classes, sets), percent), "near-hopeful")
    for number in range(ROUNDS):
        rows = stored(_open_lists(linker.labelled(rows.select("v", "c", "copies", "n", "s")), "v"), "near-open")
        if rows.isEmpty():
            break
        # The pivot: at first the member with most copies, then one by chance.
        order = F.struct(-F.col("copies"), "c") if number == 0 else F.struct(F.xxhash64("c", F.lit(number)), "c")
        pivots = rows.groupBy("v").agg(F.min(F.struct(order, F.struct("c", "comp", "n", "s"))).alias("least"))
        pivots = pivots.select("v", *[F.col("least")["col2"][x].alias(y) for x, y in (
            ("c", "a"), ("comp", "comp_a"), ("n", "n_a"), ("s", "s_a"))])
        linker.link(rows.join(pivots, "v").filter(
            (F.col("comp") != F.col("comp_a")) & _may_link(F.col("n_a"), F.col("s_a"), F.col("n"), F.col("s"), percent)).select(
            "a", F.col("c").alias("b"), "comp_a", F.col("comp").alias("comp_b")))
    rows = stored(_open_lists(linker.labelled(rows.select("v", "c", "copies", "n", "s")), "v"), "near-open")
    if not rows.isEmpty():
        linker.merge(_tiles(rows).join(sets, "c").groupBy("v", "lo", "hi").applyInPandas(_forest(percent), "a long, b long"))

    found = classes.select("digest", F.col("least").alias("component"))
    if linker.comp is not None:
        members = linker.comp.join(classes.select(F.col("c").alias("node"), "least"), "node")
        names = members.groupBy("component").agg(F.min("least").alias("name"))
        named = members.join(names, "component").select(F.col("node").alias("c"), "name")
        found = classes.join(named, "c", "left").select("digest", F.coalesce("name", "least").alias("component"))
    linked = F.col("n") > 0
    result = sketches.select("doc", "mark", "digest", "n").join(found, "digest", "left").select(
        "doc", "mark", F.col("n").alias("n_shingles"),
        F.when(linked & F.col("doc").isNotNull(), F.col("component")).otherwise(F.col("doc")).alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col("doc") == F.col("component_id"), F.lit(True)))


def _repeats(sets: DataFrame) -> bool:
    return not sets.groupBy("c").count().filter("count > 1").isEmpty()


def drop_near_duplicates(docs: DataFrame, *, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns unchanged: of each group the texts of the smallest id.

    Of an id with several texts those go that belong to a smaller id's group, and the others stay.
    """
    doc, mark = fresh(docs, "doc"), fresh(docs, "mark")
    gone = _judged(docs, percent, id_col, text_col).filter(~F.col("kept")).select(F.col("doc").alias(doc), F.col("mark").alias(mark)).distinct()
    return docs.join(gone, (F.col(id_col).cast("long") == F.col(doc)) & (F.xxhash64(whole_text(text_col)) == F.col(mark)), "left_anti")


_SQL = r"""
with recursive d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
w as (select doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from d),
s as (select doc_id, case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
      else list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) end as shingles from w),
x as (select doc_id, len(shingles) as n, unnest(shingles) as shingle from s),
p as (select a.doc_id as a, b.doc_id as b from x a join x b on a.shingle = b.shingle and a.doc_id <> b.doc_id
      and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
      group by a.doc_id, b.doc_id, a.n, b.n having 185 * count(*) >= 85 * (a.n + b.n)),
r(a, b) as (select doc_id, doc_id from d union select r.a, p.b from r join p on r.b = p.a)
select s.doc_id, cast(len(shingles) as bigint) as n_shingles, m.component_id, s.doc_id = m.component_id as kept
from s join (select a as doc_id, min(b) as component_id from r group by a) m using (doc_id)
"""


@query("op5_minhash_near_dedup", _SQL)
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return found.withColumnRenamed("doc", "doc_id")

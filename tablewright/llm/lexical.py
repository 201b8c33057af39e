"""Ranked lexical search by MaxScore with bounds on pairs of terms.

An index row holds a document's asked terms and their frequencies.  Tasks turn runs of rows into segments of bounded
size: per term its documents and their impacts (what the term adds to a score), and for pairs of common terms that an
item asks together the list of documents that hold both, with the joint impacts and their maximum.

A query goes through its terms by falling maximum impact.  The rest of the terms can add at most the sum of their
maxima, less what the pairs among them give up: no document gains more from a pair than the joint maximum or one
term alone.  Once that bound is below the score of the k-th best, no new documents are taken up, and known ones
are dropped as soon as they cannot reach it.  The k-th best is known early, from the lists and pair lists
themselves and from the segments before.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.common import prepare, stored, whole_text
from tablewright.llm.registry import query, table

SEGMENT = 1_000_000  # postings of a segment, about
PAIRED = 8  # terms of an item, the commonest, whose pairs have lists
BLOCK = 200_000  # distinct terms of items that are searched together, about
FAN = 16  # partial results merged at a time

# Of bytes: digits, letters and all beyond ASCII make terms, A-Z as a-z; the rest divides them.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [list(dict.fromkeys(terms_of(t))) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(made, pa.list_(pa.binary()))], names=["item", "terms"])


def _index_rows(vocabulary: Broadcast):
    """doc, n (terms with repeats), terms (numbers of the asked ones), tfs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        asked = number.keys()
        for batch in batches:
            sizes, terms, tfs = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = terms_of(text)
                counts = Counter(words)
                held = counts.keys() & asked
                sizes.append(len(words))
                terms.append([number[w] for w in held])
                tfs.append([counts[w] for w in held])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                names=["doc", "n", "terms", "tfs"])
    return run


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Segment:
    """Lists of one run of documents: ids, and by term and by pair the documents (as positions) with their impacts."""

    def __init__(self, ids: np.ndarray, docs: np.ndarray, terms: np.ndarray, impacts: np.ndarray, pairs: np.ndarray, k: int):
        self.ids, self.k = ids, k
        order = np.lexsort((docs, terms))
        docs, terms, impacts = docs[order], terms[order], impacts[order]
        held, begin = np.unique(terms, return_index=True)
        end = [*begin[1:], len(terms)]
        self.lists = {int(t): (docs[a:b], impacts[a:b]) for t, a, b in zip(held, begin, end)}
        self.most = {t: int(i.max()) for t, (_, i) in self.lists.items()}
        self.kth = {t: self._kth(i) for t, (_, i) in self.lists.items()}
        self.pairs: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.joint: dict[tuple[int, int], int] = {}
        dense, before = np.zeros(len(ids), np.int64), -1
        for a, b in pairs:  # sorted by a
            if a not in self.lists or b not in self.lists:
                continue
            if a != before:
                dense[:] = 0
                dense[self.lists[a][0]] = self.lists[a][1]
                before = a
            docs_b, impacts_b = self.lists[b]
            both = np.flatnonzero(dense[docs_b])
            joint = dense[docs_b[both]] + impacts_b[both]
            self.pairs[a, b] = docs_b[both], joint
            self.joint[a, b] = int(joint.max(initial=0))
            self.kth[a, b] = self._kth(joint)

    def _kth(self, impacts: np.ndarray) -> int:
        """A score that k documents reach."""
        return int(np.partition(impacts, len(impacts) - self.k)[-self.k]) if len(impacts) >= self.k else 0

    def _bounds(self, terms: list[int], pairs: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
        """At most what ``terms[i:]`` add to a score, for each i (and 0 at the end), and the scores the pairs are sure of."""
        place = {t: i for i, t in enumerate(terms)}
        gains, sure = [], []
        for a, b in pairs:
            if a in place and b in place and (a, b) in self.joint:
                sure.append(self.kth[a, b])
                gain = self.most[a] + self.most[b] - max(self.joint[a, b], self.most[a], self.most[b])
                if gain > 0:
                    gains.append((gain, a, b))
        less, used = [0] * len(terms), set()
        for gain, a, b in sorted(gains, reverse=True):  # each term in one pair, the best first
            if not {a, b} & used:
                used |= {a, b}
                less[min(place[a], place[b])] = gain
        bounds = [0]
        for i in reversed(range(len(terms))):
            bounds.append(bounds[-1] + self.most[terms[i]] - less[i])
        return bounds[::-1], sure

    def search(self, asked: list[int], pairs: list[tuple[int, int]], floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of all documents that can be among the k best, ``floor`` being a score that k others reach."""
        terms = sorted((t for t in asked if t in self.lists), key=lambda t: (-self.most[t], t))
        bounds, sure = self._bounds(terms, pairs)
        floor = max([floor, 1, *sure, *(self.kth[t] for t in terms)])
        scores, at = np.zeros(len(self.ids), np.int64), 0
        while at < len(terms) and bounds[at] >= floor:  # documents without these terms cannot reach the floor
            docs, impacts = self.lists[terms[at]]
            scores[docs] += impacts
            at += 1
            if at < len(terms) and at % 4 == 0:
                floor = max(floor, self._kth(scores))
        docs = np.flatnonzero(scores + bounds[at] * (scores > 0) >= floor)
        for i in range(at, len(terms)):
            if not len(docs):
                break
            listed, impacts = self.lists[terms[i]]
            where = np.searchsorted(listed, docs)
            where[where == len(listed)] = 0
            scores[docs] += np.where(listed[where] == docs, impacts[where], 0)
            floor = max(floor, self._kth(scores[docs]))
            docs = docs[scores[docs] + bounds[i + 1] >= floor]
        return self.ids[docs], scores[docs]


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _search(queries: Broadcast, k: int):
    """Per task: the k best documents of each query among its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights, pairs_of, pairs, total, length = queries.value
        weights = np.array(weights, dtype=np.int64)
        found = {q: (np.empty(0, np.int64), np.empty(0, np.int64)) for q in asked}

        def flush(held: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(held).combine_chunks()
            counts = rows["terms"].chunk(0).value_lengths().to_numpy()
            docs = np.repeat(np.arange(rows.num_rows), counts)
            terms = rows["terms"].chunk(0).flatten().to_numpy()
            tfs = rows["tfs"].chunk(0).flatten().to_numpy().astype(np.int64)
            m = 50 + 50 * rows["n"].to_numpy() * total // length
            impacts = weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 20 * m[docs]))
            segment = Segment(rows["doc"].to_numpy(), docs, terms, impacts, pairs, k)
            for q, terms_of_q in asked.items():
                ids, scores = found[q]
                more, their = segment.search(terms_of_q, pairs_of[q], int(scores[k - 1]) if len(scores) >= k else 0)
                found[q] = best(np.concatenate([ids, more]), np.concatenate([scores, their]), k)

        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += len(batch.column("terms").flatten())
            if size >= SEGMENT:
                flush(held)
                held, size = [], 0
        if held:
            flush(held)
        for q, (ids, scores) in found.items():
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), q, np.int64)), pa.array(ids), pa.array(scores)],
                                                 names=["query", "doc", "score"])
    return run


def _pairs(asked: dict[int, list[int]], dfs: list[int]) -> dict[int, list[tuple[int, int]]]:
    """Of each query the pairs of its commonest terms."""
    found = {}
    for q, terms in asked.items():
        common = sorted(sorted((t for t in terms if dfs[t]), key=lambda t: (-dfs[t], t))[:PAIRED])
        found[q] = [(a, b) for i, a in enumerate(common) for b in common[i + 1:]]
    return found


def _merge(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, ranked; in two steps, so that no task has the rows of all tasks for one query."""
    part = F.floor(F.spark_partition_id() / FAN).alias("part")
    order = [F.desc("score"), F.asc("doc")]
    some = found.select("*", part).withColumn("rank", F.row_number().over(W.partitionBy("query", "part").orderBy(*order)))
    some = some.filter(F.col("rank") <= k).drop("rank", "part")
    return some.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(*order))).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, *, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item, rank (from 1), doc, score: of each item the k best documents with a score above 0, ties to smaller ids.

    Rows of either table without an id take no part at all; rows that share a document id are documents of their
    own (ranks among equal ones are arbitrary); rows that share an item id are one item with the terms of all.
    Null and empty texts have no terms; items without terms, or whose terms nobody has, and empty tables give no
    rows.  Other columns are not read.  Items are taken in blocks of bounded size, each with its own index.
    """
    spark = docs.sparkSession
    prepare(spark)
    asked = items.filter(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item"), whole_text(item_text).alias("text"))
    kind = dict(asked.dtypes)["item"]
    terms = asked.mapInArrow(_item_terms, f"item {kind}, terms array<binary>").groupBy("item").agg(
        F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms"))
    terms = stored(terms.filter(F.size("terms") > 0).withColumn("query", F.monotonically_increasing_id()), "search-items")
    blocks = max(1, -(-(terms.agg(F.sum(F.size("terms"))).first()[0] or 0) // BLOCK))
    texts = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), whole_text(text_col).alias("text"))
    found = None
    for block in range(blocks):
        part = _search_block(texts, terms.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block), k)
        found = part if found is None else found.unionByName(part)
    return found.join(terms.select("query", "item"), "query").select("item", "rank", "doc", "score")


def _search_block(texts: DataFrame, block: DataFrame, k: int) -> DataFrame:
    spark = texts.sparkSession
    rows = block.select("query", "terms").collect()  # bounded by BLOCK
    number: dict[bytes, int] = {}
    asked = {r["query"]: [number.setdefault(bytes(t), len(number)) for t in r["terms"]] for r in rows}
    index = stored(texts.mapInArrow(_index_rows(spark.sparkContext.broadcast(number)),
                                    "doc long, n long, terms array<int>, tfs array<int>").filter("n > 0"), "search-index")
    total, length = index.agg(F.count("*"), F.sum("n")).first()
    dfs = [0] * len(number)
    for r in index.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        dfs[r["t"]] = r["count"]
    pairs_of = _pairs(asked, dfs)
    pairs = sorted({p for ps in pairs_of.values() for p in ps})
    queries = spark.sparkContext.broadcast((asked, [weight(total, df) if df else 0 for df in dfs], pairs_of, pairs, total, length or 1))
    return stored(_merge(index.select("doc", "n", "terms", "tfs").mapInArrow(_search(queries, k), "query long, doc long, score long"), k),
                  "search-found")


_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as words from documents),
t as (select doc_id, translate(unnest(words), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from w),
c as (select cast(count(*) as bigint) as big_n, cast(sum(len(words)) as bigint) as big_l from w where len(words) > 0),
m as (select doc_id, 100 - 50 + ((50 * len(words) * big_n) // big_l) as m from w, c where len(words) > 0),
p as (select doc_id, term, count(*) as tf from t group by doc_id, term),
i as (select distinct item_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from benchmark),
v as (select term, cast(floor(1000 * ln(cast(2 * big_n + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w
      from p, c where term in (select term from i) group by term, big_n),
s as (select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
      from i join v using (term) join p using (term) join m using (doc_id) group by item_id, doc_id),
r as (select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score from s where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from r where rank <= 50
"""


@query("op12_ranked_search", _SQL)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnsRenamed({"item": "item_id", "doc": "doc_id"})

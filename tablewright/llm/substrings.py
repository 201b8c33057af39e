"""Passages that occur earlier in the corpus, found by suffix automata of reference shards.

A window is ``WINDOW`` consecutive words.  Its anchor is the smallest hash among its five-word grams, so equal
windows have equal anchors wherever they stand, and a document needs only about one anchor in eight words.  Anchors
that occur once in the corpus rule their windows out.  The stretches of words around the others are the references:
equal ones are folded into their first occurrence, and they are dealt into shards by anchor, which is where each
document's stretch can find its match.  (Streaming every document past every shard would be quadratic.)

In a shard the references of an anchor, in the order of the corpus, become a suffix automaton whose states know
their first occurrence.  Streaming each stretch through it gives matching statistics, cut at the window's length:
the state reached tells where the window starts first.  The stretches of an anchor that very many texts share, such
as that of a common line, are dealt out window by window instead, so no shard grows with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import fresh, gram_hashes, prepare, stored, whole_text, word_hashes
from tablewright.llm.registry import query, table
from tablewright.naming import quote

WINDOW, GRAM = 20, 5
COMMON = 2000  # occurrences from which an anchor's windows are dealt out one by one
SHARD = 4000  # references per shard, about


def _anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram hashes, and for each window the position of its anchor (the first smallest gram)."""
    grams = gram_hashes(words, GRAM)
    if len(words) < window:
        return grams, np.empty(0, dtype=np.int64)
    width = window - GRAM + 1
    return grams, np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1) + np.arange(len(words) - window + 1)


def _index(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, hashes, places = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = text.split()
                grams, at = _anchors(word_hashes(words), window)
                at = np.unique(at)
                digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
                hashes.append(grams[at].view(np.int64))
                places.append(at.astype(np.int32))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in places])]).astype(np.int32))
            flat = lambda arrays, kind: pa.array(np.concatenate([*arrays, np.empty(0, kind)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("fp"), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(offsets, flat(hashes, np.int64)), pa.ListArray.from_arrays(offsets, flat(places, np.int32))],
                names=["doc", "fp", "digest", "h", "p"])
    return run


def _stretches(window: int):
    """Around each repeated anchor the words of all windows that it anchors; window by window if it is common."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc, fp, text, places, common in zip(*[batch.column(c).to_pylist() for c in ("doc", "fp", "text", "places", "common")]):
                words = word_hashes(text.encode().split())
                grams, anchor = _anchors(words, window)
                symbols = (words >> np.uint64(16)).astype("<u8")
                first = np.searchsorted(anchor, places, "left").tolist()
                last = np.searchsorted(anchor, places, "right").tolist()
                for place, lo, hi, often in zip(places, first, last, common):
                    for start, end in [(i, i + 1) for i in range(lo, hi)] if often else [(lo, hi)]:
                        data = symbols[start:end - 1 + window].tobytes()
                        digest = xxhash.xxh3_64_intdigest(data) - (1 << 63)
                        key = digest if often else int(grams[place].view(np.int64))
                        for column, value in zip(out, (key, digest, doc, fp, start, end - start, data)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                names=["key", "digest", "doc", "fp", "start", "n", "words"])
    return run


class SuffixAutomaton:
    """Of several word sequences; each state knows where its strings end first, in the order of adding."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]

    def _state(self, length: int, first: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.link) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of ``target`` for the strings that end at ``state`` + ``word``."""
        copy = self._state(self.length[state] + 1, self.first[target], self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, words: list[int], position: int) -> None:
        """``position``: of the first word; ends are counted from it."""
        last = 0
        for word in words:
            known = self.next[last].get(word)
            if known is not None:
                last = known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
            else:
                state, new = last, self._state(self.length[last] + 1, position, 0, {})
                while state >= 0 and word not in self.next[state]:
                    self.next[state][word] = new
                    state = self.link[state]
                if state >= 0:
                    known = self.next[state][word]
                    self.link[new] = known if self.length[known] == self.length[state] + 1 else self._split(state, word, known)
                last = new
            position += 1

    def matches(self, words: list[int], window: int) -> list[int]:
        """For each word from the window-th on, where the window that ends there ends first; -1: nowhere."""
        state, size, out = 0, 0, []
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            while self.length[self.link[state]] >= window if state else False:
                state = self.link[state]
            size = min(size, window)
            if i >= window - 1:
                out.append(self.first[state] if size == window else -1)
        return out


def _match_shard(window: int):
    """Per reference: the first occurrence of each of its windows."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "doc", "start"], kind="stable")
        sequences = [np.frombuffer(w, "<u8").tolist() for w in rows["words"]]
        keys, docs, starts = rows["key"].tolist(), rows["doc"].tolist(), rows["start"].tolist()
        first_docs, first_starts, lo = [], [], 0
        for hi in range(1, len(keys) + 1):
            if hi < len(keys) and keys[hi] == keys[lo]:
                continue
            automaton, owners, base = SuffixAutomaton(), [], []
            for i in range(lo, hi):
                automaton.add(sequences[i], len(owners))
                base.append(len(owners))
                owners += [i] * len(sequences[i])
            for i in range(lo, hi):
                ends = automaton.matches(sequences[i], window)
                owner = [owners[e] for e in ends]
                first_docs.append([docs[o] for o in owner])
                first_starts.append([starts[o] + e - base[o - lo] - window + 1 for o, e in zip(owner, ends)])
            lo = hi
        return pd.DataFrame({"key": keys, "digest": rows["digest"].to_numpy(), "first_docs": first_docs, "first_starts": first_starts})
    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (a null id comes before all others), fp (keeps apart the texts of a repeated id), text."""
    text = whole_text(text_col)
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64(text).alias("fp"), text.alias("text"))


def repeated_windows(docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, fp, all, starts: for documents with windows that start earlier in the corpus, where these start.

    ``all``: the document's words equal those of an earlier one, and every window is repeated.
    """
    prepare(docs.sparkSession)
    texts = _texts(docs, id_col, text_col)
    index = stored(texts.mapInArrow(_index(window), "doc long, fp long, digest binary, h array<long>, p array<int>"), "sub-index")
    index = index.filter(F.size("h") > 0)
    firsts = index.groupBy("digest").agg(F.min("doc").alias("rep"))
    index = index.join(firsts, "digest")
    copies = index.filter("doc <> rep").select("doc", "fp").distinct()
    anchors = index.filter("doc = rep").select("doc", "fp", F.explode(F.arrays_zip("h", "p")).alias("x")).select(
        "doc", "fp", F.col("x.h").alias("h"), F.col("x.p").alias("p"))
    repeated = anchors.groupBy("h").agg(F.count("*").alias("times")).filter("times > 1").select("h", (F.col("times") > COMMON).alias("common"))
    hits = anchors.join(repeated, "h").groupBy("doc", "fp").agg(F.array_sort(F.collect_set(F.struct("p", "common"))).alias("hits"))
    hits = stored(hits, "sub-hits").select("doc", "fp", F.col("hits.p").alias("places"), F.col("hits.common").alias("common"))
    stretches = stored(texts.join(hits, ["doc", "fp"]).mapInArrow(
        _stretches(window), "key long, digest long, doc long, fp long, start int, n int, words binary"), "sub-stretches")
    references = stretches.groupBy("key", "digest").agg(
        F.min(F.struct("doc", "start")).alias("at"), F.count("*").alias("times"), F.first("words").alias("words"))
    # A window that was dealt out on its own, and that no other equals, has no match.
    references = references.filter("times > 1 or key <> digest")
    shards = max(1, -(-stretches.count() // SHARD))
    matched = references.select("key", "digest", "at.doc", "at.start", "words", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")) \
        .groupBy("shard").applyInPandas(
            _match_shard(window), "key long, digest long, first_docs array<long>, first_starts array<int>")
    matched = stored(matched, "sub-matched")
    earlier = lambda d, j: (d < F.col("doc")) | ((d == F.col("doc")) & (F.col("first_starts")[j] < F.col("start") + j))
    found = stretches.select("key", "digest", "doc", "fp", "start").join(matched, ["key", "digest"]).select("doc", "fp", F.filter(
        F.transform("first_docs", lambda d, j: F.when(earlier(d, j), F.col("start") + j)), lambda x: x.isNotNull()).alias("starts"))
    found = found.filter(F.size("starts") > 0).groupBy("doc", "fp").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("starts")))).alias("starts"))
    found = found.select("doc", "fp", F.lit(False).alias("all"), "starts")
    return stored(found.unionByName(copies.select("doc", "fp", F.lit(True).alias("all"), F.array().cast("array<int>").alias("starts"))), "sub-found")


def _cut(words: list, everything: bool | None, starts: list[int] | None, window: int) -> list:
    """The words that no repeated window covers."""
    if everything:
        return []
    if starts is None or len(starts) == 0:
        return words
    kept, at = [], 0
    for start in starts:
        if start > at:
            kept += words[at:start]
        at = max(at, start + window)
    return kept + words[at:]


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the words of windows that start earlier in the corpus; every row and column is kept.

    Earlier: in a document with a smaller id (null first), or before in the same one.  A text that loses words is its
    kept words joined by one space; other texts, null ones included, are unchanged.  Texts shorter than a window
    lose nothing.  Equal rows are one document; an empty table gives an empty result.
    """
    doc, fp, everything, starts = (fresh(docs, name) for name in ("doc", "fp", "all", "starts"))
    found = repeated_windows(docs, window=window, id_col=id_col, text_col=text_col).toDF(doc, fp, everything, starts)

    @F.pandas_udf("string")
    def cut(texts, everything, starts):
        return pd.Series([b" ".join(_cut(t.encode().split(), a, s, window)).decode() for t, a, s in zip(texts, everything, starts)], dtype="object")
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    joined = docs.join(found, (key == F.col(doc)) & (F.xxhash64(whole_text(text_col)) == F.col(fp)), "left")
    changed = joined.filter(F.col(doc).isNotNull()).withColumn(text_col, cut(whole_text(text_col), F.col(everything), F.col(starts)))
    names = [F.col(quote(c)) for c in docs.columns]
    return changed.select(*names).unionByName(joined.filter(F.col(doc).isNull()).select(*names))


def _digests(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, sha = [], [], []
            for text, everything, starts in zip(*[batch.column(c).to_pylist() for c in ("text", "all", "starts")]):
                words = text.encode().split()
                kept = _cut(words, everything, starts, window)
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"])
    return run


_SQL = r"""
with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents),
w as (select doc_id, unnest(range(1, len(words) - 18)) as start, words from d where len(words) >= 20),
h as (select doc_id, start, array_to_string(words[start:start + 19], ' ') as win from w),
r as (select doc_id, start from h qualify row_number() over (partition by win order by doc_id, start) > 1),
c as (select distinct doc_id, unnest(range(start, start + 20)) as i from r),
g as (select doc_id, list(i) as gone from c group by doc_id),
k as (select doc_id, len(words) as n, list_filter(words, lambda x, i: not list_contains(coalesce(gone, []), i)) as kept
      from d left join g using (doc_id))
select doc_id, n as n_words, cast(n - len(kept) as bigint) as n_removed, sha256(array_to_string(kept, ' ')) as kept_sha256 from k
"""


@query("op9_substring_dedup", _SQL)
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = repeated_windows(docs)
    rows = _texts(docs, "doc_id", "text").join(found, ["doc", "fp"], "left")
    return rows.select(F.nullif("doc", F.lit(-(1 << 63))).alias("doc_id"), "text", "all", "starts").mapInArrow(
        _digests(WINDOW), "doc_id long, n_words long, n_removed long, kept_sha256 string")

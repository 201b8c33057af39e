"""Benchmark decontamination: training words past a generalised suffix automaton of the test items.

The items' words (A-Z in lower case) make one automaton for each shard of bounded size.  Documents are streamed
through it: the state after a word stands for the longest run of words that ends there and occurs in an item.  A run
of ``window`` words or more covers its words; an item of fewer words covers where the whole of it occurs.  Each
state knows the state of its last ``window`` words, and that one the items they are from.

Texts stay where they are: a shard's automaton is broadcast, and what it finds is a column beside the text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import fresh, prepare, stored, whole_text
from tablewright.llm.registry import query, table

WINDOW = 10
SHARD = 100_000  # words of items in one automaton, about; longer items are cut into overlapping parts
_FOUND_ARROW = pa.struct([("n_words", pa.int64()), ("longest", pa.int64()), ("starts", pa.list_(pa.int64())),
                          ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
FOUND = "struct<n_words:bigint,longest:bigint,starts:array<bigint>,ends:array<bigint>,items:array<string>>"

# Of bytes: digits, a-z and all beyond ASCII make words, A-Z as a-z; the rest divides them.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Automaton:
    """Suffix automaton of several word sequences, each with the name of its item (None: it covers but is not counted)."""

    def __init__(self, sequences: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.edges: list[dict[bytes, int]] = [{}]
        self.link, self.size = [-1], [0]
        ends = [self._add(words) for _, words in sequences]
        order = sorted(range(len(self.size)), key=self.size.__getitem__)
        short = {end for end, (_, words) in zip(ends, sequences) if len(words) < window}
        # Of each state: the state of its last ``window`` words, and the nearest that is a whole short item.
        self.last, self.whole = [-1] * len(order), [-1] * len(order)
        for s in order[1:]:
            up = self.link[s]
            if self.size[s] >= window:
                self.last[s] = s if self.size[up] < window else self.last[up]
            self.whole[s] = s if s in short else self.whole[up]
        self.names: dict[int, set[str]] = {s: set() for s in set(self.last) | set(short)}
        for (name, words), end in zip(sequences, ends):
            if name is None:
                continue
            if len(words) < window:
                self.names[end].add(name)
                continue
            state = 0
            for word in words:
                state = self.edges[state][word]
                if self.last[state] >= 0:
                    self.names[self.last[state]].add(name)
        self.least = min([window, *(len(words) for _, words in sequences)])

    def _state(self, size: int) -> int:
        self.edges.append({})
        self.link.append(0)
        self.size.append(size)
        return len(self.size) - 1

    def _copy(self, of: int, size: int) -> int:
        made = self._state(size)
        self.edges[made] = self.edges[of].copy()
        self.link[made] = self.link[of]
        self.link[of] = made
        return made

    def _redirect(self, state: int, word: bytes, old: int, new: int) -> None:
        while state >= 0 and self.edges[state].get(word) == old:
            self.edges[state][word] = new
            state = self.link[state]

    def _add(self, words: list[bytes]) -> int:
        """Add a sequence; the state of the whole of it."""
        at = 0
        for word in words:
            known = self.edges[at].get(word)
            if known is not None:  # an earlier sequence has this run
                if self.size[known] != self.size[at] + 1:
                    made = self._copy(known, self.size[at] + 1)
                    self._redirect(at, word, known, made)
                    known = made
                at = known
                continue
            made, back = self._state(self.size[at] + 1), at
            while back >= 0 and word not in self.edges[back]:
                self.edges[back][word] = made
                back = self.link[back]
            if back >= 0:
                known = self.edges[back][word]
                if self.size[known] != self.size[back] + 1:
                    copy = self._copy(known, self.size[back] + 1)
                    self._redirect(back, word, known, copy)
                    known = copy
                self.link[made] = known
            at = made
        return at

    def match(self, words: list[bytes]) -> tuple[int, list[int], list[int], set[str]]:
        """Longest run, covered stretches (starts and ends, apart and ascending), and the items they are from."""
        edges, link, size, window, least = self.edges, self.link, self.size, self.window, self.least
        root = edges[0]
        state = length = longest = 0
        starts: list[int] = []
        ends: list[int] = []
        items: set[str] = set()
        for at, word in enumerate(words):
            if word not in root:
                state = length = 0
                continue
            to = edges[state].get(word)
            while to is None:
                state = link[state]
                length = size[state]
                to = edges[state].get(word)
            state = to
            length += 1
            if length < least:
                continue
            covered = 0
            if length >= window:
                covered = length
                items |= self.names[self.last[state]]
            longest = max(longest, length)
            short = self.whole[state if length == size[state] else link[state]]
            while short >= 0:
                covered = max(covered, size[short])
                items |= self.names[short]
                short = self.whole[link[short]]
            if covered:
                start = at + 1 - covered
                while ends and ends[-1] >= start:
                    start = min(start, starts.pop())
                    ends.pop()
                starts.append(start)
                ends.append(at + 1)
        return longest, starts, ends, items


def _parts(window: int, most: int):
    """Items as words, joined by spaces; long ones in parts that share window - 1 words, so no window is lost."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, parts, sizes = [], [], []
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                words = words_of(text)
                for at in range(0, max(1, len(words) - window + 1) if words else 0, most):
                    part = words[at:at + most + window - 1]
                    names.append(name)
                    parts.append(b" ".join(part))
                    sizes.append(len(part))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(parts, pa.binary()), pa.array(sizes, pa.int64())],
                                             names=["name", "part", "size"])
    return run


def _built(window: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        made = Automaton([(name, part.split()) for name, part in zip(rows["name"], rows["part"])], window)
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "automaton": [pickle.dumps(made)]})
    return run


def automata(items: DataFrame, *, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """shard (from 0), automaton (pickled): together they hold every item; each is built in a task of its own."""
    spark = items.sparkSession
    prepare(spark)
    texts = items.select(F.col(id_col).cast("string").alias("name"), whole_text(text_col).alias("text"))
    parts = stored(texts.mapInArrow(_parts(window, max(1, shard // 2)), "name string, part binary, size long").distinct(), "leak-parts")
    shards = max(1, -(-(parts.agg(F.sum("size")).first()[0] or 0) // shard))
    dealt = parts.withColumn("shard", F.pmod(F.xxhash64("part"), F.lit(shards)))
    return stored(dealt.groupBy("shard").applyInPandas(_built(window), "shard long, automaton binary"), "leak-automata")


def _matcher(automaton: Broadcast):
    @F.arrow_udf(FOUND)
    def matched(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made: Automaton = pickle.loads(automaton.value)
        for column in texts:
            out: list[dict] = []
            for text in column.cast(pa.binary()).to_pylist():
                words = words_of(text)
                longest, starts, ends, items = made.match(words)
                out.append({"n_words": len(words), "longest": longest, "starts": starts, "ends": ends, "items": sorted(items)})
            yield pa.array(out, _FOUND_ARROW)
    return matched


def _merged(a: dict, b: dict) -> dict:
    """What two shards found in one text."""
    starts, ends = [], []
    for start, end in sorted(zip([*a["starts"], *b["starts"]], [*a["ends"], *b["ends"]])):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return {"n_words": max(a["n_words"], b["n_words"]), "longest": max(a["longest"], b["longest"]), "starts": starts, "ends": ends,
            "items": sorted({*a["items"], *b["items"]})}


def _both(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([_merged(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], _FOUND_ARROW)


def overlaps(docs: DataFrame, items: DataFrame, into: str, *, window: int = WINDOW, id_col: str = "item_id",
             item_col: str = "text", text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """Every row and column of ``docs`` and a struct ``into``, which must be a new name: n_words, longest (the longest
    run of words that an item has too), starts and ends (of the stretches of words to remove, from 0, ends exclusive,
    apart and ascending) and items (whose windows occur; sorted).

    Null and empty texts have no words and match nothing; items without words, and an empty table of items, match
    nothing; an item without an id covers words but is not listed; items that share an id are one; rows that repeat
    are matched each; an empty table gives an empty result.  Other columns are passed on unread.
    """
    if into in docs.columns:
        raise ValueError(f"column {into} is there already")
    spark = docs.sparkSession
    shards = automata(items, window=window, id_col=id_col, text_col=item_col, shard=shard)
    numbers = [r["shard"] for r in shards.select("shard").orderBy("shard").collect()]
    if not numbers:
        nothing = F.array().cast("array<bigint>")
        size = F.size(F.regexp_extract_all(F.lower(whole_text(text_col)), F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)")))
        return docs.withColumn(into, F.struct(size.cast("long").alias("n_words"), F.lit(0).cast("long").alias("longest"), nothing.alias("starts"),
                                              nothing.alias("ends"), F.array().cast("array<string>").alias("items")))
    for number in numbers:  # one bounded shard at a time; what is found so far is stored between them
        one = spark.sparkContext.broadcast(bytes(shards.filter(F.col("shard") == number).first()["automaton"]))
        found = _matcher(one)(whole_text(text_col))
        if number == numbers[0]:
            docs = docs.withColumn(into, found)
        else:
            docs = stored(docs, "leak-pass")
            other = fresh(docs, "other")
            docs = docs.withColumn(other, found).withColumn(into, F.arrow_udf(_both, FOUND)(F.col(into), F.col(other))).drop(other)
    return docs


def _cut(text: str, starts: list[int], ends: list[int]) -> str:
    """``text`` without the words of the stretches, and what stands between them."""
    spans = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for start, end in zip(starts, ends):
        out.append(text[at:spans[start][0]])
        at = spans[end - 1][1]
    return "".join([*out, text[at:]])


def _without(texts: pa.Array, found: pa.Array) -> pa.Array:
    return pa.array([t if not f["starts"] else _cut(t, f["starts"], f["ends"]) for t, f in zip(texts.to_pylist(), found.to_pylist())],
                    pa.string())


def decontaminate(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, coverage: float = 0.5, id_col: str = "item_id",
                  item_col: str = "text", text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """``docs`` without the stretches that ``overlaps`` finds, and without the documents of whose words they cover more
    than the share ``coverage``.  Texts without a stretch stay as they are, null included; other columns are unchanged.
    """
    into = fresh(docs, "found")
    found = overlaps(docs, items, into, window=window, id_col=id_col, item_col=item_col, text_col=text_col, shard=shard)
    covered = F.aggregate(F.zip_with(f"{into}.ends", f"{into}.starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    kept = found.filter(covered <= F.lit(coverage) * F.col(f"{into}.n_words"))
    text = F.when(F.size(f"{into}.starts") == 0, F.col(text_col)).otherwise(
        F.arrow_udf(_without, "string")(whole_text(text_col), F.col(into)))
    return kept.withColumn(text_col, text).drop(into)


_SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
i as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
c as (select item_id, w, least(len(w), 10) as size from i where len(w) > 0),
g as (select distinct item_id, size, array_to_string(w[k:k + size - 1], ' ') as gram
      from (select item_id, w, size, unnest(range(1, len(w) - size + 2)) as k from c)),
x as (select doc_id, size, k, array_to_string(w[k:k + size - 1], ' ') as gram
      from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as k from d, (select distinct size from c) where len(w) >= size)),
m as (select distinct x.doc_id, x.k, x.size, g.item_id from x join g on x.size = g.size and x.gram = g.gram),
h as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(k, k + size)) as p from m) group by doc_id),
t as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
      from (select distinct doc_id, cast(item_id as varchar) as item_id from m) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (doc_id) left join t using (doc_id)
"""


@query("op11_decontamination", _SQL)
def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = overlaps(docs, table(spark, sf_dir, "benchmark"), "found")
    n_hit = F.aggregate(F.zip_with("found.ends", "found.starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("doc_id", "found.n_words", n_hit.alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))

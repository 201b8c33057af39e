"""Documents packed into sequences of bounded length: best fit, then local search by moves and swaps.

Pieces are dealt by hash into shares of bounded size, so no task holds more than one share, and each share leaves
at most a bin or two that a single packing would have saved.  Inside a share the pieces go, longest first, to the
fullest bin that takes them.  The search then empties the emptiest bins: a piece moves to another bin, or changes
place with one or two smaller pieces of it, whenever that raises the sum of squared fills.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tiktoken.load import load_tiktoken_bpe

from tablewright.llm.bpe import BLOCK, VOCABULARY, Encoder
from tablewright.llm.common import prepare, stored, whole_text
from tablewright.llm.registry import query, table

CAPACITY = 2048
SHARE = 100_000  # pieces per task
LOOKS = 20  # per piece: pairs of bins that the search of a share looks at


class FastEncoder(Encoder):
    """The same ids from a compiled encoder of the same vocabulary.

    It is given a bounded part of a text at a time; where a text has no place to part it, the transducer goes on alone.
    """

    def __init__(self, path: str, ranks: str):
        super().__init__(path)
        self.compiled = tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                          mergeable_ranks=load_tiktoken_bpe(ranks))

    def _block(self, text: str) -> list[int]:
        return self.compiled.encode_ordinary(text) if len(text) <= 2 * BLOCK else super()._block(text)


@lru_cache(maxsize=1)
def _encoder(path: str, ranks: str) -> FastEncoder:
    return FastEncoder(path, ranks)


class Bins:
    """Bins of one share: which pieces each holds, and its room; found by room through a bit set."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.content: list[list[int]] = []
        self.room: list[int] = []
        self.looks = LOOKS * len(lengths)
        self.by_room: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.mask = 0

    def put(self, b: int, room: int) -> None:
        self.room[b] = room
        self.by_room[room].add(b)
        self.mask |= 1 << room

    def take(self, b: int) -> None:
        room = self.room[b]
        self.by_room[room].discard(b)
        if not self.by_room[room]:
            self.mask &= ~(1 << room)

    def fullest(self, size: int) -> int | None:
        """The bin with the least room that still takes ``size``."""
        rest = self.mask >> size
        if not rest:
            return None
        return next(iter(self.by_room[size + (rest & -rest).bit_length() - 1]))

    def fill(self) -> None:
        for piece in sorted(range(len(self.lengths)), key=lambda i: (-self.lengths[i], i)):
            size = self.lengths[piece]
            b = self.fullest(size)
            if b is None:
                b = len(self.content)
                self.content.append([])
                self.room.append(self.capacity)
            else:
                self.take(b)
            self.content[b].append(piece)
            self.put(b, self.room[b] - size)

    def exchange(self, a: int, gives: list[int], b: int, takes: list[int]) -> None:
        """Pieces ``gives`` go from a to b, and ``takes`` the other way."""
        delta = sum(self.lengths[p] for p in gives) - sum(self.lengths[p] for p in takes)
        for bin_, out, in_, change in ((a, gives, takes, delta), (b, takes, gives, -delta)):
            self.take(bin_)
            self.content[bin_] = [p for p in self.content[bin_] if p not in out] + in_
            if self.content[bin_]:
                self.put(bin_, self.room[bin_] + change)

    def _better(self, a: int, b: int, delta: int) -> bool:
        """Whether ``delta`` more in b, less in a, raises the sum of squares: 2 * delta * (fill b - fill a + delta)."""
        return delta > 0 and self.room[a] - self.room[b] + delta > 0

    def relieve(self, a: int) -> bool:
        """One improving step that takes load off bin a; whether there was one."""
        self.looks -= 1
        for piece in sorted(self.content[a], key=lambda p: -self.lengths[p]):
            size = self.lengths[piece]
            self.take(a)
            b = self.fullest(size)
            self.put(a, self.room[a])
            if b is not None and self._better(a, b, size):
                self.exchange(a, [piece], b, [])
                return True
        # Much room first: it takes the largest difference.  Bins of equal pieces are alike, and one of them will do.
        alike, sizes = set(), self.lengths
        for room in range(self.capacity, 0, -1):
            if not self.mask >> room & 1:
                continue
            for b in list(islice(self.by_room[room], max(0, self.looks))):
                self.looks -= 1
                if self.looks < 0:
                    return False
                kind = tuple(sorted(sizes[p] for p in self.content[b]))
                if b == a or kind in alike:
                    continue
                alike.add(kind)
                if (step := self._swap(a, b)) is not None:
                    self.exchange(a, step[0], b, step[1])
                    return True
        return False

    def _swap(self, a: int, b: int) -> tuple[list[int], list[int]] | None:
        """The exchange of one for one, one for two or two for one that moves most load from a to b."""
        size, room = self.lengths, self.room[b]
        # Pieces of equal length are alike: one of each alone, two in pairs.
        first = {b_: {size[p]: p for p in self.content[b_]} for b_ in (a, b)}
        single = {b_: [[p] for p in first[b_].values()] for b_ in (a, b)}
        pairs = {}
        for b_ in (a, b):
            second = {size[p]: p for p in self.content[b_] if first[b_][size[p]] != p}
            some = [*first[b_].values(), *second.values()]
            pairs[b_] = list({size[p] + size[q]: [p, q] for i, p in enumerate(some) for q in some[i + 1:]}.values())
        best, most = None, 0
        for left, right in ((single[a], single[b]), (single[a], pairs[b]), (pairs[a], single[b])):
            taken = sorted((sum(size[p] for p in ps), i) for i, ps in enumerate(right))
            for gives in left:
                given = sum(size[p] for p in gives)
                # The least that may come back, so that what goes over fits into the room.
                at = bisect_left(taken, (given - room, -1))
                if at < len(taken) and most < given - taken[at][0] and self._better(a, b, given - taken[at][0]):
                    best, most = (gives, right[taken[at][1]]), given - taken[at][0]
        return best

    def search(self) -> None:
        """Empty bins, the emptiest first, as long as steps improve; a bin that stays does not end the search."""
        least = -(-sum(self.lengths) // self.capacity)
        used = sum(map(bool, self.content))
        for a in sorted((b for b, c in enumerate(self.content) if c and self.room[b]), key=lambda b: -self.room[b]):
            if used <= least or self.looks < 0:
                break
            while self.content[a] and self.relieve(a):
                pass
            used -= not self.content[a]


def pack(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """Bin (from 0, gapless) and offset of each piece.  Lengths are from 1 to ``capacity``; ties go by position."""
    bins = Bins(lengths, capacity)
    bins.fill()
    bins.search()
    where, at = [0] * len(lengths), [0] * len(lengths)
    for number, content in enumerate(c for c in bins.content if c):
        offset = 0
        for piece in content:
            where[piece], at[piece] = number, offset
            offset += lengths[piece]
    return where, at


def _pieces(path: str, ranks: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(path, ranks)
        for batch in batches:
            out: list[list[int]] = [[] for _ in range(5)]
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*coder.encode(text), 0], dtype="<u4")
                cut = len(ids) % capacity or capacity
                bounds = [0, *range(cut, len(ids) + 1, capacity)]
                for piece, (start, end) in enumerate(zip(bounds, bounds[1:])):
                    for column, value in zip(out, (doc, piece, start, end - start, zlib.crc32(ids[start:end].tobytes()))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *[pa.array(c, pa.int64()) for c in out[2:]]],
                names=["doc", "piece", "start", "length", "ids_crc32"])
    return run


def _pack_share(capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets = pack(rows["length"].tolist(), capacity)
        rows["sequence_id"] = rows["share"].to_numpy() * (1 << 32) + np.array(bins, dtype=np.int64)
        rows["offset"] = offsets
        return rows.drop(columns="share")
    return run


def pack_documents(docs: DataFrame, *, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
                   path: str | None = None, ranks: str | None = None) -> DataFrame:
    """One row per piece: doc, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and a closing 0, so null and empty texts are one token.  Longer ones than ``capacity`` are
    cut, the first piece taking the remainder.  Repeated rows are packed each; rows without an id too; an empty
    table gives an empty result.  Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), whole_text(text_col).alias("text"))
    pieces = stored(texts.mapInArrow(
        _pieces(path or public_tokenizers.path(VOCABULARY), ranks or public_tokenizers.path(VOCABULARY.replace("json", "tiktoken")),
                capacity), "doc long, piece int, start long, length long, ids_crc32 long").withColumn(
        "row", F.monotonically_increasing_id()), "packing-pieces")
    shares = max(1, -(-pieces.count() // SHARE))
    # The number of the row, stored with it, deals rows out that repeat.
    dealt = pieces.withColumn("share", F.pmod(F.xxhash64("doc", "piece", "ids_crc32", "row"), F.lit(shares))).drop("row")
    return dealt.groupBy("share").applyInPandas(
        _pack_share(capacity),
        "doc long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")

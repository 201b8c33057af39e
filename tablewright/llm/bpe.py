"""Byte-pair encoding as a streaming transducer, and decoding as a streaming state machine.

For every prefix of a word exactly one token can come last: the one that ends there and whose neighbour before it
would not have merged with any part of it.  So the last token of each prefix follows from the last tokens of
shorter prefixes, and each prefix has a chain of tokens.  No token of a merge list is longer than its *lookahead*,
so the chain of any later prefix passes through one of the last ``lookahead`` prefixes: what their chains have in
common is final and is emitted.  The chains still open are all that is kept, however long the word is.

Words are split off by the byte-level pattern.  Short stretches of text are remembered with their ids, in a cache
of bounded size; this changes the speed only.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import prepare, whole_text
from tablewright.llm.registry import query, table

VOCABULARY = "byte_bpe_50k.json"
CACHED = 600_000  # stretches and words remembered, per generation (of two)
LONG = 64  # longer stretches are not remembered
BLOCK = 65_536  # characters of a text that are encoded at a time, about


def byte_characters() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies: themselves, or the next free from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A merge list: token bytes, merge ranks, and how each token is made."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        of = byte_characters()
        raw = lambda token: bytes(of[c] for c in token)
        self.ids = {raw(token): i for token, i in spec["model"]["vocab"].items()}
        self.bytes = {i: b for b, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes.update({i: content.encode() for content, i in self.special.items()})
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # token: left, right, rank
        for rank, (left, right) in enumerate(spec["model"]["merges"]):
            a, b = self.ids[raw(left)], self.ids[raw(right)]
            self.rank[a, b] = rank
            self.made.setdefault(self.ids[raw(left) + raw(right)], (a, b, rank))
        self._spines: tuple[dict, dict] = ({}, {})
        self.known: dict[tuple[int, int], bool] = {}  # of pairs asked for, whether they stay apart
        # Tokens that merging reaches; the others are never last.
        self.reached = {b: i for b, i in self.ids.items() if i not in self.made}
        for token in sorted(self.made, key=lambda t: self.made[t][2]):
            left, right, rank = self.made[token]
            if self.bytes[left] in self.reached and self.bytes[right] in self.reached and self._neighbours(left, right, rank):
                self.reached[self.bytes[token]] = token
        # No token that merging reaches is longer, so bytes further on change nothing.
        self.lookahead = max(map(len, self.reached))
        self.decimal = {i: str(i) for i in self.bytes}

    def _spine(self, token: int, side: int) -> list[tuple[int, int, float]]:
        """Parts at an edge of a token (0: right edge, 1: left edge): (part, made at rank, merged away at rank)."""
        known = self._spines[side]
        if token not in known:
            parts, until = [], float("inf")
            while True:
                left, right, rank = self.made.get(token, (0, 0, -1))
                parts.append((token, rank, until))
                if rank < 0:
                    break
                token, until = (right if side == 0 else left), rank
            known[parts[0][0]] = parts
            return parts
        return known[token]

    def _neighbours(self, a: int, b: int, before: float) -> bool:
        """Whether no part at the end of a merges with a part at the start of b, before the rank ``before``.

        Equal ranks go from left to right, so a pair across the edge comes after a's own merge of that rank and
        before b's.
        """
        for x, x_from, x_until in self._spine(a, 0):
            for y, y_from, y_until in self._spine(b, 1):
                rank = self.rank.get((x, y))
                if rank is not None and max(x_from, y_from) < rank < x_until and rank <= y_until and rank < before:
                    return False
        return True

    def fits(self, a: int, b: int) -> bool:
        """Whether a and b stay apart when merged together."""
        if len(self.known) > 2 * CACHED:
            self.known.clear()
        apart = self.known[a, b] = self._neighbours(a, b, float("inf"))
        return apart


class Transducer:
    """Bytes in, tokens out, for one word."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.start()

    def start(self) -> None:
        self.tail = b""  # the bytes after the last emitted token
        # Per prefix of the tail its last token and that token's length; of the empty prefix, the token emitted last.
        self.tokens, self.sizes = [-1], [0]

    def feed(self, data: bytes) -> Iterator[int]:
        reached, known, fits, most = self.v.reached.get, self.v.known.get, self.v.fits, self.v.lookahead
        for at in range(0, len(data), most):
            tail = self.tail = self.tail + data[at:at + most]
            tokens, sizes = self.tokens, self.sizes
            for end in range(len(tokens), len(tail) + 1):
                for begin in range(max(0, end - most), end):
                    token = reached(tail[begin:end])
                    if token is not None:
                        before = tokens[begin]
                        apart = True if before < 0 else known((before, token))
                        if apart or apart is None and fits(before, token):
                            tokens.append(token)
                            sizes.append(end - begin)
                            break
            if len(tail) > 2 * most:
                yield from self._settle()

    def whole(self, data: bytes) -> list[int]:
        """The tokens of one word; none of a short one is final before its end."""
        reached = self.v.reached.get
        token = reached(data)
        if token is not None:
            return [token]
        if len(data) > self.v.lookahead:
            return [*self.feed(data), *self.finish()]
        known, fits, tokens, sizes = self.v.known.get, self.v.fits, [-1], [0]
        for end in range(1, len(data) + 1):
            for begin in range(end):
                token = reached(data[begin:end])
                if token is not None:
                    before = tokens[begin]
                    apart = True if before < 0 else known((before, token))
                    if apart or apart is None and fits(before, token):
                        tokens.append(token)
                        sizes.append(end - begin)
                        break
        found, at = [], len(data)
        while at:
            found.append(tokens[at])
            at -= sizes[at]
        found.reverse()
        return found

    def _settle(self) -> list[int]:
        """Emit what the chains of the last ``lookahead`` prefixes share."""
        end = len(self.tail)
        open_ = set(range(end - self.v.lookahead + 1, end + 1))
        while len(open_) > 1:  # the longest prefix steps back until the chains meet
            far = max(open_)
            open_.remove(far)
            open_.add(far - self.sizes[far])
        return self._emit(open_.pop())

    def _emit(self, end: int) -> list[int]:
        found, at = [], end
        while at:
            found.append(self.tokens[at])
            at -= self.sizes[at]
        found.reverse()
        self.tail = self.tail[end:]
        self.tokens = [found[-1] if found else self.tokens[0], *self.tokens[end + 1:]]
        self.sizes = [0, *self.sizes[end + 1:]]
        return found

    def finish(self) -> list[int]:
        tokens = self._emit(len(self.tail))
        self.start()
        return tokens


class Encoder:
    """Texts to ids: special tokens, words by the byte-level pattern, then the transducer."""

    def __init__(self, path: str):
        self.v = Vocabulary(path)
        self.words = regex.compile(public_tokenizers.PATTERN)
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.v.special, key=len, reverse=True))) + ")") \
            if self.v.special else None
        self.transducer = Transducer(self.v)
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def _word(self, word: str) -> tuple[int, ...]:
        return tuple(self.transducer.whole(word.encode()))

    def _ids(self, text: str) -> tuple[int, ...]:
        if text.isascii() and text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return self._word(text)
        words = self.words.findall(text)
        return self._word(text) if len(words) == 1 else tuple(i for word in words for i in self._known(word, self._word))

    def _known(self, text: str, make: Callable[[str], tuple[int, ...]]) -> tuple[int, ...]:
        """The ids of a short text, remembered; old ones that are asked for again become young."""
        ids = self.young.get(text)
        if ids is None:
            ids = self.old.get(text)
            if ids is None:
                ids = make(text)
            if len(text) <= LONG:
                if len(self.young) >= CACHED:
                    self.old, self.young = self.young, {}
                self.young[text] = ids
        return ids

    def blocks(self, text: str) -> Iterator[list[int]]:
        """The ids of a text, those of a bounded part at a time."""
        for i, part in enumerate(self.special.split(text) if self.special else [text]):
            if i % 2:
                yield [self.v.special[part]]
                continue
            for window in windows(part, BLOCK):
                yield self._block(window)

    def _block(self, text: str) -> list[int]:
        ids: list[int] = []
        get = self.young.get
        for piece in _stretches(text):
            found = get(piece)
            if found is None:
                found = self._known(piece, self._ids)
                get = self.young.get
            ids += found
        return ids

    def encode(self, text: str) -> list[int]:
        return [i for block in self.blocks(text) for i in block]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; see ``Decoder``."""
        machine, ids = Decoder(self.v), iter(ids)
        out = []
        while block := list(islice(ids, 4096)):
            out.append(machine.feed(block))
        return "".join([*out, machine.finish()])


class Decoder:
    """Ids in, text out: tokens' bytes through an incremental UTF-8 machine.

    Incomplete sequences become the replacement character; ids that the vocabulary does not have are skipped.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.known, self.machine = vocabulary.bytes, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        try:
            data = b"".join([self.known[i] for i in ids])
        except KeyError:
            data = b"".join([self.known.get(i, b"") for i in ids])
        return self.machine.decode(data)

    def finish(self) -> str:
        return self.machine.decode(b"", True)


def windows(text: str, size: int) -> Iterator[str]:
    """Parts of about ``size`` characters whose words are those of the text: each begins with a space before no other."""
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        while 0 <= cut < len(text) - 1 and text[cut + 1].isspace():
            cut = text.find(" ", cut + 1)
        if not 0 <= cut < len(text) - 1:
            break
        yield text[at:cut]
        at = cut
    if at < len(text):
        yield text[at:]


def _stretches(text: str) -> list[str]:
    """Pieces whose words are those of the text: a space that a letter, digit or mark follows always begins a word."""
    first, *rest = text.split(" ")
    out = [first]
    for piece in rest:
        # Nothing, or white space, after the space: it may belong to a run of white space, so stay together.
        if piece and not piece[0].isspace():
            out.append(" " + piece)
        else:
            out[-1] += " " + piece
    return [x for x in out if x]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _coded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        decimal = coder.v.decimal
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column("text").to_pylist():
                n, ids_hash, text_hash, machine = 0, hashlib.sha256(), hashlib.sha256(), Decoder(coder.v)
                for ids in coder.blocks(text):
                    if ids:
                        ids_hash.update((("," if n else "") + ",".join([decimal[i] for i in ids])).encode())
                        n += len(ids)
                        text_hash.update(machine.feed(ids).encode())
                text_hash.update(machine.finish().encode())
                counts.append(n)
                ids_sha.append(ids_hash.hexdigest())
                text_sha.append(text_hash.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def encode_texts(docs: DataFrame, *, text_col: str = "text", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """Adds the array of token ids of each whole text; null and empty texts have none.  Every row and column is kept."""
    prepare(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)

    @F.pandas_udf("array<int>")
    def ids(texts):
        return texts.map(lambda t: encoder(path).encode(t))
    return docs.withColumn(ids_col, ids(whole_text(text_col)))


def decode_ids(rows: DataFrame, *, ids_col: str = "ids", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Adds the text of each array of ids; a null array gives an empty text.  Every row and column is kept."""
    prepare(rows.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)

    @F.pandas_udf("string")
    def text(ids):
        return ids.map(lambda x: encoder(path).decode(x))
    return rows.withColumn(text_col, text(F.coalesce(F.col(ids_col), F.array().cast("array<int>"))))


@query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", whole_text().alias("text"))
    return docs.mapInArrow(_coded(public_tokenizers.path(VOCABULARY)),
                           "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

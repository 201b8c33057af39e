"""Quality without hand labels: heuristic labellers, their accuracies by expectation-maximisation, a linear scorer.

Each labeller looks at one property of a text and votes good, bad or not at all.  Texts with equal votes are
counted over the whole corpus; there are at most 3 ** labellers such patterns, and from their counts EM estimates
how often each labeller votes what on good and on bad texts.  The posterior of a text's pattern is its label.  A
logistic scorer on hashed word shapes learns from these labels, so that it also judges texts that no labeller voted on.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tablewright.llm.common import prepare, stored, whole_text
from tablewright.llm.registry import query, table

GOOD, BAD, NONE = 1, 0, 2
# A labeller is built to vote bad on hardly any good text.  Without this bound EM may take a fault that only one
# labeller sees for a habit of good texts.
FALSE_ALARMS = 0.003
BUCKETS = 1024
CACHED = 100_000
_UPPER, _LOWER = np.arange(65, 91), np.arange(97, 123)
_MARKS = np.frombuffer(b"#$%&*@^~_=<>{}|\\", dtype=np.uint8)


def _vote(value: float, bad_above: float, good_below: float) -> int:
    return BAD if value > bad_above else GOOD if value < good_below else NONE


# The labellers: each takes (bytes of the text counted by value, the words, the text).
def _capitals(counts, words, text):
    letters = counts[_UPPER].sum() + counts[_LOWER].sum()
    return _vote(counts[_UPPER].sum() / letters, 0.4, 0.2) if letters >= 10 else NONE


def _marks(counts, words, text):
    return _vote(counts[_MARKS].sum() / max(1, counts.sum()), 0.03, 0.008)


def _shouts(counts, words, text):
    return _vote(text.count(b"!!") / len(words), 0.15, 0.01) if words else NONE


def _stutter(counts, words, text):
    return _vote(sum(map(bytes.__eq__, words, words[1:])) / (len(words) - 1), 0.15, 0.03) if len(words) >= 5 else NONE


def _variety(counts, words, text):
    return _vote(1 - len(set(words)) / len(words), 0.95, 0.6) if len(words) >= 30 else NONE


def _lists(counts, words, text):
    return _vote(words.count(b"|") / len(words), 0.15, 0.02) if words else NONE


def _empty(counts, words, text):
    return BAD if not words else NONE


LABELLERS = (_capitals, _marks, _shouts, _stutter, _variety, _lists, _empty)


def votes(text: str) -> str:
    """One digit per labeller."""
    data = text.encode()
    counts, words = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256), data.split()
    return "".join(str(f(counts, words, data)) for f in LABELLERS)


def em(patterns: dict[str, int], rounds: int = 100) -> dict[str, float]:
    """Posterior probability of *good* for each pattern of votes, given how often each occurs."""
    if not patterns:
        return {}
    names = sorted(patterns)
    n = np.array([patterns[p] for p in names], dtype=float)
    cast = np.array([[int(v) for v in p] for p in names])
    # At first: a bad vote outweighs good ones, since most heuristics look for one fault.
    good = np.where((cast == BAD).any(axis=1), 0.1, np.where((cast == GOOD).any(axis=1), 0.9, 0.5))
    hits = np.stack([cast == v for v in (BAD, GOOD)], axis=2).astype(float)  # not voting says nothing
    for _ in range(rounds):
        prior = (n @ good + 1) / (n.sum() + 2)
        on_good = np.einsum("p,plv->lv", n * good, hits) + 0.5
        on_bad = np.einsum("p,plv->lv", n * (1 - good), hits) + 0.5
        on_good, on_bad = (x / x.sum(axis=1, keepdims=True) for x in (on_good, on_bad))
        on_good[:, 0] = np.minimum(on_good[:, 0], FALSE_ALARMS)
        odds = np.log(prior / (1 - prior)) + np.einsum(
            "plv,lv->p", hits, np.log(on_good) - np.log(on_bad))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        done, good = np.abs(new - good).max() < 1e-6, new
        if done:
            break
    return dict(zip(names, good.tolist()))


_RUN = re.compile(r"([A-Z]+)|([^\W\d_]+)|(\d+)")


@lru_cache(maxsize=CACHED)
def _bucket(word: str) -> int:
    """Of a word's shape: letters by case, digits and marks, runs shortened."""
    shape = _RUN.sub(lambda m: "A" if m[1] else "a" if m[2] else "0", word)
    return zlib.crc32(shape[:12].encode()) % (BUCKETS - 1)


def features(text: str) -> np.ndarray:
    """Shares of hashed word shapes, of unrepeated words (last bucket), as square roots."""
    words = text.split()
    x = np.zeros(BUCKETS, dtype=np.float32)
    if words:
        distinct = Counter(words)
        for word, times in distinct.items():
            x[_bucket(word)] += times
        x[-1] = sum(1 for a, b in zip(words, words[1:]) if a == b)
        x = np.sqrt(x / len(words))
    return x


def train(x: np.ndarray, y: np.ndarray, rounds: int = 1000, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by adaptive gradient steps."""
    x, weight = x.astype(np.float64), 1 / max(1, len(y))
    w, bias, seen, seen_b = np.zeros(x.shape[1]), 0.0, np.full(x.shape[1], 1e-8), 1e-8
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30))) - y) * weight
        grad, grad_b = x.T @ error + ridge * w, error.sum()
        seen, seen_b = seen + grad ** 2, seen_b + grad_b ** 2
        w, bias = w - 0.5 * grad / np.sqrt(seen), bias - 0.5 * grad_b / math.sqrt(seen_b)
    return w, bias


def _train_task(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("key").drop_duplicates("text")
    w, bias = train(np.stack([features(t) for t in rows["text"]]), rows["good"].to_numpy())
    return pd.DataFrame({"model": [json.dumps([np.round(w, 6).tolist(), bias])]})


def fit(docs: DataFrame, *, fit_rows: int = 8_000, id_col: str = "doc_id", text_col: str = "text") -> str:
    """A scorer from weak labels.  Votes are counted over all rows; the scorer learns from at most ``fit_rows`` of
    them (the smallest hashes of the id), of which equal texts count once.  An empty table gives a scorer without
    weights."""
    prepare(docs.sparkSession)

    @pandas_udf("string")
    def cast(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(votes)
    key, fp = F.xxhash64(F.col(id_col).cast("string")), F.md5(whole_text(text_col))
    voted = stored(docs.select(key.alias("key"), fp.alias("fp"), cast(whole_text(text_col)).alias("votes")), "quality-votes")
    posterior = em({r["votes"]: r["n"] for r in voted.groupBy("votes").agg(F.count("*").alias("n")).collect()})
    if not posterior:
        return json.dumps([[0.0] * BUCKETS, 0.0])
    # An id can have many rows: each of its texts counts once.
    picked = voted.groupBy("key", "fp").agg(F.first("votes").alias("votes")).orderBy("key", "fp").limit(fit_rows)
    good = F.create_map(*[F.lit(x) for pair in posterior.items() for x in pair])
    picked = picked.select("key", "fp", good[F.col("votes")].alias("good"))
    rows = docs.select(key.alias("key"), fp.alias("fp"), whole_text(text_col).alias("text"))
    rows = rows.join(F.broadcast(picked), ["key", "fp"]).dropDuplicates(["key", "fp"])
    return rows.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(_train_task, "model string").first()["model"]


def quality(text: Column, model: str) -> Column:
    """The score, 0 to 1, of a whole text; null texts are empty, and empty texts score 0."""
    weights, bias = json.loads(model)

    @pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = np.array(weights)
        for batch in batches:
            yield pd.Series([float(1 / (1 + math.exp(-max(-30.0, min(30.0, features(t) @ w + bias))))) if t.strip() else 0.0
                             for t in batch], dtype="float64")
    return scores(whole_text_of(text))


def whole_text_of(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def score_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Adds ``score`` and ``kept`` (score of 0.5 or more) to every row; all columns stay.

    A column of these names in the input is replaced.  Repeated rows get equal scores.
    """
    model = fit(docs, id_col=id_col, text_col=text_col, **options)
    return docs.withColumn("score", quality(F.col(text_col), model)).withColumn("kept", F.col("score") >= 0.5)


@query("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "score", "kept")

"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers read the words of a clause: insults, threats, targets, negation and reported speech.  Their
composition (the product of their states) sorts each insult into a context: plain, aimed at somebody, negated or
reported; a threat counts when its target follows.  A text's score comes from what its clauses matched.

The insult lexicon is learnt from labelled rows: words and word beginnings are taken greedily, each for the toxic
texts that no earlier entry explains, so words that merely stand in the same texts are not taken.  The weights of
the contexts are a ridge regression towards a prior that discounts negated and reported insults.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tablewright.llm.common import prepare, whole_text
from tablewright.llm.registry import query, table

# The closed word classes of the grammar (English, German, French, Spanish).
TARGETS = frozenset("you your you're he she they him her them his their du dich dir ihr euch sie er tu toi vous il elle ils tú usted ustedes él ella ellos".split())
NEGATIONS = frozenset("not no never isn't aren't wasn't don't nicht kein keine nie pas jamais non nunca jamás".split())
REPORTS = frozenset("said says told called quoted reported claimed wrote sagte sagt nannte schrieb dit disait appelé écrit dijo dice llamó escribió".split())
THREATS = frozenset("kill hurt destroy stab shoot punch töten schlagen tuer frapper matar golpear".split())
# Insults to begin with; learnt weights take their place, and rows that speak against one remove it.
SEED = frozenset("idiot moron loser stupid pathetic worthless scum trash clown disgusting fool jerk dumb bastard vermin".split())
SEED_WEIGHT = 3.0
CONTEXTS = ("plain", "aimed", "negated", "reported", "threat")
PRIOR = np.array([-3.0, 1.2, 1.4, 0.3, 0.5, 1.5])  # bias, then one per context
CLAUSE = re.compile(r"[.!?;:\n]+")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
# How many words a negation reaches, and how many may stand between a threat and its target.
REACH = 3
PREFIXES = (4, 5, 6)


# A transducer: its states start at 0, ``step(state, word class) -> state``.
def _seen(kind: str):
    return lambda state, c: 1 if c == kind else state


def _countdown(kind: str):
    return lambda state, c: REACH if c == kind else max(0, state - 1)


TRANSDUCERS = {"target": _seen("T"), "negation": _countdown("N"), "report": _seen("R"), "threat": _countdown("H")}


def compose(classes: list[tuple[str, float]]) -> list[tuple[str, float]]:
    """Run the composed machine over a clause of (class, weight): the contexts it emits, with their weights.

    A target may follow its insult ("idiot, you ..."): an insult is aimed if the clause holds a target anywhere.
    """
    state = dict.fromkeys(TRANSDUCERS, 0)
    out, insults = [], []
    for kind, weight in classes:
        if kind == "T" and state["threat"]:
            out.append(("threat", 1.0))
        if kind == "I":
            insults.append(("reported" if state["report"] else "negated" if state["negation"] else "", weight))
        state = {name: step(state[name], kind) for name, step in TRANSDUCERS.items()}
    free = "aimed" if state["target"] else "plain"
    return out + [(context or free, weight) for context, weight in insults]


class Grammar:
    """The lexicon compiled to one automaton, and the weights of the contexts."""

    def __init__(self, words: dict[str, float], prefixes: dict[str, float], weights: list[float]):
        self.words, self.prefixes, self.weights = words, prefixes, np.array(weights)
        self.sizes = sorted({len(p) for p in prefixes})
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for entry in {*words, *prefixes, *THREATS}:
            self.automaton.add_word(entry, 1)
        self.automaton.make_automaton()

    def insult(self, word: str) -> float:
        return max([self.words.get(word, 0.0), *[self.prefixes.get(word[:n], 0.0) for n in self.sizes]])

    def kind(self, word: str) -> tuple[str, float]:
        if weight := self.insult(word):
            return "I", weight
        return ("T" if word in TARGETS else "N" if word in NEGATIONS else "R" if word in REPORTS
                else "H" if word in THREATS else "O"), 0.0

    def features(self, text: str) -> np.ndarray:
        """Per context: the largest weight plus the logarithm of their sum, over all clauses of the whole text."""
        found: dict[str, list[float]] = {}
        text = text.lower()
        done = -1
        for end, _ in self.automaton.iter(text):
            if end < done:
                continue  # its clause has been scored
            before = max(text.rfind(mark, 0, end) for mark in ".!?;:\n") + 1
            after = CLAUSE.search(text, end)
            done = after.start() if after else len(text)
            for context, weight in compose([self.kind(w) for w in WORD.findall(text, before, done)]):
                found.setdefault(context, []).append(weight)
        return np.array([max(found[c]) + math.log1p(sum(found[c])) if c in found else 0.0 for c in CONTEXTS])

    def score(self, text: str) -> float:
        return float(1 / (1 + math.exp(-(self.weights[0] + self.features(text) @ self.weights[1:]))))

    def dump(self) -> str:
        return json.dumps([self.words, self.prefixes, list(map(float, self.weights))])


@lru_cache(maxsize=8)
def load(dumped: str) -> Grammar:
    return Grammar(*json.loads(dumped))


def _forms(text: str) -> set[tuple[str, int]]:
    """Words (0) and their beginnings (their length) that occur in a text."""
    words = set(WORD.findall(text.lower()))
    return {(w, 0) for w in words} | {(w[:n], n) for n in PREFIXES for w in words if len(w) >= n}


def _surprise(a: float, b: float, n1: int, n0: int) -> float:
    """Log-likelihood ratio of a form seen in a of n1 toxic and b of n0 clean texts; 0 where it leans to clean."""
    rate, total = (a + b) / (n1 + n0), n1 + n0
    if a * n0 <= b * n1:
        return 0.0
    term = lambda k, n: k * math.log(k / n / rate) if k else 0.0
    return 2 * (term(a, n1) + term(b, n0)) * (1 - 1 / total)


def learn_lexicon(texts: list[str], toxic: list[int], most: int = 512) -> tuple[dict[str, float], dict[str, float]]:
    """Words and beginnings, with their weights, by greedy cover of the toxic texts.

    An entry must be surprising among the texts that no earlier entry explains, by more than the number of forms tried.
    """
    forms = [_forms(t) if y else None for t, y in zip(texts, toxic)]
    bad = Counter(f for fs in forms if fs for f in fs)
    bad = Counter({f: n for f, n in bad.items() if n >= 3})
    good = Counter(f for t, y in zip(texts, toxic) if not y for f in _forms(t) if f in bad)
    n1, n0 = sum(toxic), len(toxic) - sum(toxic)
    least = 2 * math.log(max(2, len(bad))) + 2
    holders: dict[tuple[str, int], list[int]] = {}
    for i, fs in enumerate(forms):
        for f in fs or ():
            if f in bad:
                holders.setdefault(f, []).append(i)
    left, chosen, covered = bad.copy(), {}, set()
    while len(chosen) < most and left:
        # Of the texts not yet explained.  Equal evidence: a whole word before a beginning, then the longer beginning.
        open_ = n1 - len(covered)
        best = max(left, key=lambda f: (_surprise(left[f], good[f], open_, n0), f[1] == 0, f[1], f[0]))
        if _surprise(left[best], good[best], open_, n0) < least:
            break
        chosen[best] = min(6.0, math.log((bad[best] + 0.5) / (good[best] + 0.5) * max(1, n0) / max(1, n1)))
        for i in holders[best]:
            if i not in covered:
                covered.add(i)
                for f in forms[i]:
                    if f in left:
                        left[f] -= 1
        left = Counter({f: n for f, n in left.items() if n >= 2 and f not in chosen})
    words = {f: w for (f, n), w in chosen.items() if n == 0 and w > 0}
    for seed in SEED - set(words):
        clean = sum(not y and (seed, 0) in _forms(t) for t, y in zip(texts, toxic) if seed in t.lower())
        if clean <= bad[seed, 0]:
            words[seed] = SEED_WEIGHT
    return words, {f: w for (f, n), w in chosen.items() if n and w > 0}


def learn_weights(x: np.ndarray, y: np.ndarray, ridge: float = 2.0) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards the prior."""
    x, w = np.hstack([np.ones((len(x), 1)), x]), PRIOR.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * (w - PRIOR)
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _fit_task(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("key").drop_duplicates("text")
    texts, toxic = rows["text"].tolist(), rows["toxic"].astype(int).tolist()
    grammar = Grammar(*learn_lexicon(texts, toxic), PRIOR.tolist())
    if texts:
        x = np.array([grammar.features(t) for t in texts])
        grammar.weights = learn_weights(x, np.array(toxic, dtype=float))
    return pd.DataFrame({"model": [grammar.dump()]})


def fit(docs: DataFrame, labels: DataFrame, *, fit_rows: int = 12_000, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> str:
    """A grammar learnt from at most ``fit_rows`` labelled rows (those with the smallest hash of their id).

    Rows whose crc32 of the id, as text, is divisible by 5 are never learnt from.  Null labels are left out; of
    repeated labels of an id the larger counts; equal texts are learnt from once.  Without labelled rows the
    lexicon is the seed and the weights are the prior.
    """
    prepare(docs.sparkSession)
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
             .filter(F.col("toxic").isNotNull() & ~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic")))
    known = known.withColumn("key", F.xxhash64(F.col("id").cast("string"))).orderBy("key", "id").limit(fit_rows)
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")).join(F.broadcast(known), "id")
    # An id can have many rows: each of its texts counts once, and the bound holds for texts.
    rows = rows.withColumn("fp", F.md5("text")).dropDuplicates(["key", "fp"]).orderBy("key", "fp").limit(fit_rows)
    found = rows.select("key", "text", "toxic", F.lit(1).alias("one")).groupBy("one").applyInPandas(
        _fit_task, "model string").collect()
    return found[0]["model"] if found else Grammar(*learn_lexicon([], []), PRIOR.tolist()).dump()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def toxicity(text: Column, model: str) -> Column:
    """The score, 0 to 1, of a whole text; null and empty texts get that of a text without matches."""
    @pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grammar = load(model)
        for batch in batches:
            yield pd.Series([grammar.score(t) for t in batch], dtype="float64")
    return scores(F.coalesce(text.cast("string"), F.lit("")))


def keep_clean(docs: DataFrame, model: str, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose score is below the threshold, all columns unchanged."""
    prepare(docs.sparkSession)
    return docs.filter(toxicity(F.col(text_col), model) < threshold)


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

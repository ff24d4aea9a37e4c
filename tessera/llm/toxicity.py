"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier."""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import integer_id, portions, release, stored, text_batches

#: The most labelled rows that a fit reads, the first by a hash of their ids.
FIT_ROWS = 8000
#: A term is in at least this share of the bad rows, and its rate there is this many times that in good rows.
SUPPORT, PURITY = 0.03, 40.0
#: Lexicon voters; each holds the terms of one rank class.
LEXICONS = 12
#: What a development label weighs against a posterior one.
GOLD_WEIGHT = 1
PREFIXES = (4, 5, 6)
#: Entries of a worker's table of known words.
KNOWN_WORDS = 200_000
WORD = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> list[str]:
    """A word and its beginnings; those end in *."""
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]


def patterns_of(text: str, n_words: int) -> list[float]:
    """Pattern voters' measures: share of capitals, exclamation and question marks a word, runs of one sign, long words."""
    n = max(1, len(text))
    capitals = sum(map(str.isupper, text)) / n if text.isascii() else sum(1 for c in text if c.isupper()) / n
    return [capitals, text.count("!") / max(1, n_words), text.count("?") / max(1, n_words), len(re.findall(r"(\S)\1{3}", text)) / max(1, n_words)]


PATTERN_CUTS = (0.3, 0.2, 0.1, 0.02)


@dataclass
class Model:
    """What scoring needs: each term's numbers and how often it must occur, weights (terms, patterns, any term at all), the intercept."""

    terms: dict[str, tuple[tuple[int, int], ...]]
    weights: np.ndarray
    intercept: float
    accuracies: np.ndarray
    correlations: np.ndarray

    def score(self, text: str, known: dict[str, tuple[str, ...]]) -> float:
        counts = Counter(WORD.findall(text.lower()))
        z = self.intercept
        if self.terms:
            hits: Counter = Counter()
            for word, n in counts.items():
                found = known.get(word)
                if found is None:
                    found = known[word] = tuple(t for t in terms_of(word) if t in self.terms)
                for t in found:
                    hits[t] += n
            found_terms = [self.weights[k] for t, n in hits.items() for k, least in self.terms[t] if n >= least]
            z += sum(found_terms) + (self.weights[-1] if found_terms else 0.0)
        cut = len(self.weights) - len(PATTERN_CUTS) - 1
        z += float(np.dot(self.weights[cut:-1], np.array(patterns_of(text, sum(counts.values()))) > PATTERN_CUTS)) if cut >= 0 else 0.0
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def distinct_terms(found: list[tuple[str, int, int]]) -> list[tuple[str, int]]:
    """Terms and how often they must occur, from (term, least, rows), the most frequent first.

    Without those that a chosen beginning covers; of nested terms in nearly the same rows the longest.
    """
    out: list[tuple[str, int]] = []
    for term, least, a in sorted(found, key=lambda t: (-t[2], t[1], len(t[0]), t[0])):
        stem = term.rstrip("*")
        longer = term.endswith("*") and any(m == least and n >= 0.97 * a and o != term and o.rstrip("*").startswith(stem) for o, m, n in found)
        covered = any(o == term or o.endswith("*") and stem.startswith(o[:-1]) for o, _ in out)
        if not longer and not covered:
            out.append((term, least))
    return out


def label_model(votes: np.ndarray, prior: float, gold: np.ndarray | None = None, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior labels, voters' accuracies and their correlations.

    votes: rows by voters, 1, -1 or 0 (abstains, which says nothing).  Expectation
    maximisation over how often a voter votes for and against either label; gold labels of a
    development set, where given, anchor it, GOLD_WEIGHT posterior ones each: a document that one
    voter alone speaks for would else drift towards the prior.  What two voters share
    beyond the label shows as the correlation of their residuals; a voter's log odds are
    divided by one plus its correlations, so that voters that repeat each other count as
    fewer.
    """
    n, m = votes.shape
    plus, minus = (votes > 0).astype(float), (votes < 0).astype(float)

    def tally(y: np.ndarray) -> np.ndarray:
        """Votes for and against, by label, and the labels themselves."""
        return np.stack([y @ plus, (1 - y) @ plus, y @ minus, (1 - y) @ minus, np.full(m, y.sum()), np.full(m, n - y.sum())])

    # without a development set the votes' majority is where the search begins, no more
    anchor = GOLD_WEIGHT * tally(gold) if gold is not None else np.zeros((6, m))
    counts = anchor if gold is not None else tally(np.where(votes.sum(1) > 0, 0.9, prior / 2))
    share, correlations = np.ones(m), np.zeros((m, m))
    posterior = np.full(n, prior)
    for turn in range(rounds):
        for_, against = (np.log((counts[k] + 0.5) / (counts[4] + 1)) - np.log((counts[k + 1] + 0.5) / (counts[5] + 1)) for k in (0, 2))
        posterior = 1 / (1 + np.exp(-np.clip(math.log(prior / (1 - prior)) + plus @ (for_ * share) + minus @ (against * share), -30, 30)))
        counts = anchor + tally(posterior)
        accuracy = (counts[0] + counts[3] + 0.5) / (counts[:4].sum(0) + 1)
        if turn % 5 == 4:
            rest = votes - np.abs(votes) * (2 * posterior[:, None] - 1) * (2 * accuracy - 1)
            scale = np.sqrt((rest**2).mean(0) + 0.02)  # residuals near 0 say nothing of each other
            correlations = (rest.T @ rest) / max(1, n) / np.outer(scale, scale)
            np.fill_diagonal(correlations, 0)
            share = 1 / (1 + np.where(correlations > 0.3, correlations, 0).sum(1))
    return posterior, accuracy, correlations


def linear(features: np.ndarray, target: np.ndarray, ridge: float = 0.05, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by Newton steps with a ridge; the intercept isn't penalised."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - target) + penalty * w
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> Model:
    """Learn from at most fit_rows labelled rows whose crc32(id as text) mod 5 isn't 0.

    Labels choose the lexicons' terms and anchor the label model's accuracies, as a
    development set; the classifier sees the label model's posteriors alone.  Terms and the
    rows' hits are what the driver gets: a term is in a share SUPPORT of the bad rows, so
    that there are at most 1 / SUPPORT times as many as a bad row has distinct ones; rows are
    at most fit_rows, of numbers.  Without labelled rows of both kinds the model scores
    everything alike, below 0.5.  An id with several labels counts as bad if one of them is;
    labels but 0 and 1, and rows without an id, teach nothing.
    """
    integer_id(docs, id_col)
    text_batches(docs.sparkSession)
    chosen = labels.where(f"{label_col} in (0, 1) and {id_col} is not null").groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(label_col).cast("int").alias("_y")).where(F.crc32(F.col("_id").cast("string")) % 5 != 0)
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, lambda b: b.column(2)):
            ids, ys, words, pats = [], [], [], []
            for i, y, text in zip(*(c.to_pylist() for c in batch.columns)):
                counts = Counter(WORD.findall((text or "").lower()))
                ids.append(i)
                ys.append(y)
                found: Counter = Counter()
                for w, n in counts.items():
                    for t in terms_of(w):
                        found[t] += n
                words.append(list(found.items()))
                pats.append(patterns_of(text or "", sum(counts.values())))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ys, pa.int32()), pa.array(words, pa.map_(pa.string(), pa.int32())), pa.array(pats, pa.list_(pa.float64()))], names=["id", "y", "found", "patterns"])

    # at most fit_rows rows of two numbers: safe to broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id").select("_id", "_y", "_text")
    rows = stored(rows.mapInArrow(take, "id long, y int, found map<string,int>, patterns array<double>"), "toxicity-fit")
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        release(rows)
        return Model({}, np.zeros(0), -3.0, np.zeros(0), np.zeros((0, 0)))
    levels = F.explode(F.filter(F.array(F.lit(1), F.lit(2)), lambda m: m <= F.col("n")))
    counted = rows.select("y", F.explode("found").alias("term", "n")).select("y", "term", levels.alias("least")).groupBy("term", "least").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    # a term's chance to be in bad rows alone by luck, over all terms, must be small; and it must matter
    least = max(math.ceil((math.log(max(2, counted.count())) + 2) / math.log((bad + good) / bad)), math.ceil(SUPPORT * bad))
    best = counted.where((F.col("a") >= least) & (F.col("b") * F.lit(bad) * PURITY <= F.col("a") * F.lit(good))).orderBy(F.desc("a"), "b", F.desc(F.length("term")), "term")
    lexicon = distinct_terms([(r["term"], r["least"], r["a"]) for r in best.collect()])
    numbers: dict[str, tuple[tuple[int, int], ...]] = {}
    for k, (term, m) in enumerate(lexicon):
        numbers[term] = numbers.get(term, ()) + ((k, m),)
    listed = docs.sparkSession.createDataFrame([(t, k, m) for k, (t, m) in enumerate(lexicon)] or [("", -1, 1)], "term string, k int, least int")
    pairs = rows.select("id", F.explode("found").alias("term", "n")).join(F.broadcast(listed), "term").where("n >= least").groupBy("id").agg(F.collect_list("k").alias("hits"))
    table = rows.select("id", "y", "patterns").join(pairs, "id", "left").orderBy("id").collect()
    release(rows)
    x, pats = np.zeros((len(table), len(lexicon))), np.zeros((len(table), len(PATTERN_CUTS)))
    for r, row in enumerate(table):
        x[r, row["hits"] or []] = 1
        pats[r] = np.array(row["patterns"]) > PATTERN_CUTS
    group = np.arange(len(lexicon)) % LEXICONS
    seen = np.stack([(x[:, group == g] > 0).sum(1) for g in range(LEXICONS)], 1)
    total = seen.sum(1)
    votes = np.where(seen > 0, 1, 0)
    none, many = np.where(total == 0, -1, 0)[:, None], np.where(total >= 3, 1, 0)[:, None]
    whole = np.array([not t.endswith("*") for t, _ in lexicon], bool)
    sure = np.where((x[:, whole] > 0).sum(1) > 1, 1, 0)[:, None]
    votes = np.hstack([votes, none, many, sure, np.where(pats > 0, 1, 0)])
    posterior, accuracies, correlations = label_model(votes, bad / (bad + good), np.array([row["y"] for row in table], float))
    weights, intercept = linear(np.hstack([x, pats, (total > 0)[:, None]]), posterior)
    return Model(numbers, weights, intercept, accuracies, correlations)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: bool = False, score_col: str = "score") -> DataFrame:
    """docs with their scores in [0, 1]: (id, score_col), or with keep all columns and score_col, which docs must not have. No shuffle.

    Null or empty text: the score of a text without words.  Null id: kept.  Repeated rows:
    as often, with one score.  Empty table: no rows.
    """
    if keep and score_col in docs.columns:
        raise ValueError(f"docs has a column {score_col}")
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the lexicon's terms and weights, see fit()
    token = uuid.uuid4().hex

    @F.pandas_udf(T.DoubleType())
    def of(texts):
        import pandas as pd

        if _known.get("of") != token:
            _known.clear()
            _known.update({"of": token, "words": {}})
        known = _known["words"]
        out = []
        for text in texts:
            out.append(shared.value.score(text or "", known))
            if len(known) > KNOWN_WORDS:
                known.clear()
        return pd.Series(out, dtype="float64")

    if keep:
        return docs.withColumn(score_col, of(F.col(f"`{text_col}`")))
    return docs.select(F.col(id_col), of(F.col(f"`{text_col}`")).alias(score_col))


#: A worker's words and their terms, for the last model only.
_known: dict = {}


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Fit on the labelled rows and score every row: (id, held_out, score, predicted).

    held_out: whether crc32(id as text) mod 5 is 0, null where the id is.  See fit() and
    score() for nulls, empty texts, repeated rows and empty tables.
    """
    scored = score(docs, fit(docs, labels, id_col, text_col, label_col), id_col, text_col)
    return scored.select(id_col, (F.crc32(F.col(id_col).cast("string")) % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

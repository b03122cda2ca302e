"""Toxicity by weak supervision.

1. Lexicon: from a bounded sample of the labelled rows (``SAMPLE_ROWS``), words and word
   beginnings that toxic documents hold far more often than others become terms: all that
   have the least support and ratio and that chance would not give (``CHANCE_TERMS``).  One
   pass over all texts finds the terms with an Aho-Corasick automaton.
2. Voters: two per term (held, held twice), and patterns (several terms, dense terms,
   shouting).  A voter says yes or nothing.
3. Label model: expectation-maximisation over the vote patterns of all rows that may be
   learnt from; the sample's labels are held fixed.  It estimates every voter's rate in
   both classes and the correlations of voters within a class; voters that say the same
   thing share their weight.
4. Classifier: logistic regression on the posterior labels of the sample, over term
   counts, densities and patterns.  Its score is the result.

Only rows with crc32(doc_id as text) mod 3 other than 1 are learnt from.  Labels,
language, source and id are never inputs of a score.  What reaches the driver is the
terms, which grow with the vocabulary of the labelled sample, sums over voters and over
pairs of voters that occur together, and the sample's feature rows, held sparsely.

Defined results
    null or empty text: no votes, a low score
    null doc_id: scored, never learnt from, held_out null
    repeated rows: each is scored; conflicting labels of one id count as given
    no labelled rows, or only one class: no terms; every score is the share of toxic
    labels (0 without labels)
    extra input columns: not read
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policyscan.session import stage

SAMPLE_ROWS = 20_000
MIN_TOXIC = 5
MIN_RATIO = 8.0
CHANCE_TERMS = 1.0  # terms that chance may bring among all words and beginnings looked at
STEMS = (4, 5, 6, 7)
ROUNDS = 6
THRESHOLD = 0.7
_CELLS = 1 << 21  # of a dense matrix of rows by terms
ANNOTATOR = 0.98  # reliability of a label as one more voter when the classifier is trained

WORDS_RE = re.compile(r"[^\W\d_]+")
SHOUTS_RE = re.compile(r"[!?]{2,}")
PATTERNS = ("two terms", "three terms", "many hits", "dense", "very dense", "shouting")


def features_of(text: str) -> set[str]:
    """Words (``=word``) and word beginnings (``beginning*``) of a text."""
    found = set()
    for word in set(WORDS_RE.findall(text.lower())):
        if len(word) > 2:
            found.add("=" + word)
            found.update(word[:n] + "*" for n in STEMS if len(word) > n)
    return found


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for begin in range(0, len(frame), 200):
            part = frame.iloc[begin : begin + 200]
            counts = {0: Counter(), 1: Counter()}
            for text, toxic in zip(part["text"], part["toxic"], strict=True):
                counts[int(toxic)].update(features_of(text or ""))
            for toxic, counter in counts.items():
                if counter:
                    yield pd.DataFrame({"feature": list(counter), "toxic": toxic, "n": list(counter.values())})


def lexicon(sample: DataFrame) -> list[str]:
    """Terms of ``text``, ``toxic`` rows, best first; none inside another."""
    classes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = classes.get(1, 0), classes.get(0, 0)
    if not toxic or not clean:
        return []
    counted = sample.select("text", "toxic").mapInPandas(_count, "feature string, toxic int, n long")
    by_feature = counted.groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"),
    )
    by_feature = stage(by_feature, "feature-counts")
    ratio = ((F.col("t") + 0.5) / toxic) / ((F.col("c") + 0.5) / clean)
    # Chernoff's bound of the chance that t of t + c rows are toxic, over all features looked at.
    share, part = toxic / (toxic + clean), F.col("t") / (F.col("t") + F.col("c"))
    others = F.when(F.col("c") > 0, F.col("c") * F.log((1 - part) / (1 - share))).otherwise(0.0)
    surprise = F.col("t") * F.log(part / share) + others
    least = math.log(max(1, by_feature.count()) / CHANCE_TERMS)
    best = (
        by_feature.filter(F.col("t") >= MIN_TOXIC)
        .withColumn("ratio", ratio)
        .filter((F.col("ratio") >= MIN_RATIO) & (surprise >= least))
        .orderBy((F.col("t") * F.log("ratio")).desc(), F.length("feature").desc(), "feature")
    )
    terms: list[str] = []
    for row in best.collect():
        core = row.feature.strip("=*")
        if not any(core.startswith(t.strip("=*")) or t.strip("=*").startswith(core) for t in terms):
            terms.append(row.feature)
    return terms


def hits(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, crc, terms (indices), counts, n_words, shouts of every row of doc_id, text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            machine.add_word(term.strip("=*"), (i, len(term) - 1, term[0] == "="))
        if terms:
            machine.make_automaton()
        for frame in frames:
            found, times, shouts, sizes = [], [], [], []
            for text in frame["text"]:
                low = (text or "").lower()
                counter: Counter = Counter()
                for end, (i, size, whole) in machine.iter(low) if terms and low else ():
                    begin = end - size + 1
                    if begin and low[begin - 1].isalpha():
                        continue
                    follows = low[end + 1 : end + 2].isalpha()
                    if not follows if whole else follows:
                        counter[i] += 1
                found.append(sorted(counter))
                times.append([counter[i] for i in sorted(counter)])
                sizes.append(low.count(" ") + low.count("\n") + 1)
                shouts.append(sum(1 for _ in SHOUTS_RE.finditer(low)) if "!!" in low or "??" in low or "!?" in low or "?!" in low else 0)
            yield frame[["doc_id", "remainder"]].assign(terms=found, counts=times, n_words=sizes, shouts=shouts)

    schema = "doc_id long, remainder int, terms array<int>, counts array<int>, n_words long, shouts long"
    return docs.select("doc_id", "remainder", "text").mapInPandas(run, schema)


def matrices(frame: pd.DataFrame, n_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Votes (0/1) and classifier features of the rows of ``hits``."""
    counts = np.zeros((len(frame), n_terms))
    for k, (terms, times) in enumerate(zip(frame["terms"], frame["counts"], strict=True)):
        if len(terms):
            counts[k, np.asarray(terms, np.int64)] = times
    size = np.maximum(frame["n_words"].to_numpy(np.float64), 1)
    distinct, total = (counts > 0).sum(axis=1), counts.sum(axis=1)
    density = 100 * total / size
    shout = 100 * frame["shouts"].to_numpy(np.float64) / size
    patterns = np.stack([distinct > 1, distinct > 2, total > 4, density > 0.5, density > 2, shout > 10], axis=1)
    votes = np.concatenate((counts > 0, counts > 1, patterns), axis=1).astype(np.float64)
    x = np.concatenate(
        (np.ones((len(frame), 1)), np.log1p(counts), counts > 1, np.minimum(distinct, 8)[:, None], np.log1p(total)[:, None],
         np.minimum(density, 10)[:, None], patterns), axis=1,
    )
    return votes, x


def parts(frame: pd.DataFrame, n_terms: int) -> Iterator[pd.DataFrame]:
    """The rows of ``hits`` in pieces whose matrices have a bounded size."""
    step = max(1, _CELLS // (n_terms + 1))
    for begin in range(0, len(frame), step):
        yield frame.iloc[begin : begin + step]


class LabelModel:
    """Rates of every voter in both classes, and weights that share what voters repeat."""

    def __init__(self, voters: int, prior: float):
        self.prior = prior
        self.rates = np.tile([[0.02], [0.3]], (1, voters))
        self.weight = np.ones(voters)

    def posterior(self, votes: np.ndarray, annotated: np.ndarray | float = np.nan) -> np.ndarray:
        """Probability of toxic; an annotation (0, 1, NaN: none) is one more voter of known reliability."""
        rates = np.clip(self.rates, 1e-6, 1 - 1e-6)
        yes, no = np.log(rates), np.log1p(-rates)
        odds = np.log(self.prior / (1 - self.prior))
        odds = odds + (votes * (yes[1] - yes[0]) + (1 - votes) * (no[1] - no[0])) @ self.weight
        odds = odds + np.nan_to_num(2.0 * np.asarray(annotated) - 1.0) * np.log(ANNOTATOR / (1 - ANNOTATOR))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def sums(self, votes: np.ndarray, times: np.ndarray, known: np.ndarray) -> dict[str, np.ndarray]:
        """Expected totals per class: rows, votes, and pairs of votes."""
        q = np.where(np.isnan(known), self.posterior(votes), known)
        both = np.stack(((1 - q) * times, q * times))
        return {"rows": both.sum(axis=1), "votes": both @ votes, "pairs": np.stack([(votes * b[:, None]).T @ votes for b in both])}

    def update(self, rows: np.ndarray, votes: np.ndarray, pairs: np.ndarray) -> None:
        self.prior = float(np.clip((rows[1] + 1) / (rows.sum() + 2), 1e-4, 1 - 1e-4))
        self.rates = (votes + [[0.05], [0.5]]) / (rows[:, None] + 1)
        p = votes / np.maximum(rows[:, None], 1e-9)
        covariance = pairs / np.maximum(rows[:, None, None], 1e-9) - p[:, :, None] * p[:, None, :]
        spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
        correlation = np.clip(covariance / (spread[:, :, None] * spread[:, None, :]), 0, 1)
        share = correlation * (rows / max(rows.sum(), 1e-9))[:, None, None]
        together = share.sum(axis=0)
        np.fill_diagonal(together, 0)
        self.weight = 1 / (1 + together.sum(axis=1))


def fit_label_model(patterns: DataFrame, n_terms: int, prior: float) -> LabelModel:
    """EM over ``terms``, ``counts``, ``n_words``, ``shouts``, ``toxic`` (null: unknown), ``times`` rows."""
    voters = 2 * n_terms + len(PATTERNS)
    model = LabelModel(voters, prior)
    for _ in range(ROUNDS):

        def expected(frames: Iterator[pd.DataFrame], model: LabelModel = model) -> Iterator[pd.DataFrame]:
            total = None
            for part in (p for frame in frames for p in parts(frame, n_terms)):
                votes, _ = matrices(part, n_terms)
                sums = model.sums(votes, part["times"].to_numpy(np.float64), part["toxic"].to_numpy(np.float64))
                # Each pair once; pairs that never occur together stay out.
                flat = np.concatenate([sums["rows"], sums["votes"].ravel(), np.triu(sums["pairs"]).ravel()])
                total = flat if total is None else total + flat
            if total is not None:
                place = np.flatnonzero(total)
                yield pd.DataFrame({"place": place, "value": total[place]})

        rows = patterns.mapInPandas(expected, "place long, value double").groupBy("place").agg(F.sum("value").alias("v")).toArrow()
        flat = np.zeros(2 + 2 * voters + 2 * voters * voters)
        flat[rows["place"].to_numpy()] = rows["v"].to_numpy()
        if not len(rows):
            return model
        pairs = flat[2 + 2 * voters :].reshape(2, voters, voters)
        pairs = pairs + np.triu(pairs, 1).transpose(0, 2, 1)
        fresh = LabelModel(voters, prior)
        fresh.update(flat[:2], flat[2 : 2 + 2 * voters].reshape(2, -1), pairs)
        model = fresh
    return model


def fit_classifier(rows: pd.DataFrame, n_terms: int, model: LabelModel, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression on the posterior labels of ``rows`` by Newton's steps."""
    width = matrices(rows.iloc[:0], n_terms)[1].shape[1]
    soft = [model.posterior(matrices(p, n_terms)[0], p["toxic"].to_numpy(np.float64)) for p in parts(rows, n_terms)]
    w = np.zeros(width)
    penalty = np.full(width, ridge)
    penalty[0] = 1e-6
    for _ in range(25):
        gradient, curvature = penalty * w, np.diag(penalty)
        for part, wanted in zip(parts(rows, n_terms), soft, strict=True):
            x, times = matrices(part, n_terms)[1], part["times"].to_numpy(np.float64)
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = gradient + x.T @ (times * (p - wanted))
            curvature = curvature + (x * (times * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
        step = np.linalg.solve(curvature, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def score(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted."""
    remainder = F.expr("CAST(crc32(encode(CAST(doc_id AS string), 'UTF-8')) % 3 AS int)")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("remainder", remainder)
    usable = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")
    ).filter((remainder != 1) & F.col("toxic").isin(0, 1))
    share = max(1, -(-usable.count() // sample_rows))
    # Bounded: at most twice the parameter, whatever the hash does.
    chosen = usable.filter(F.expr(f"pmod(xxhash64(doc_id, 5), {share}L) = 0")).limit(2 * sample_rows)
    chosen = stage(chosen, "label-sample")
    sample = stage(texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic"), "labelled-texts")
    terms = lexicon(sample)
    n_terms = len(terms)
    found = stage(hits(texts, terms), "term-hits")

    labelled = found.filter("remainder <> 1").join(F.broadcast(chosen), "doc_id", "left")
    kinds = labelled.groupBy("terms", "counts", "n_words", "shouts", "toxic").agg(F.count(F.lit(1)).alias("times"))
    kinds = stage(kinds, "vote-patterns")
    known = chosen.agg(F.avg("toxic")).first()[0]
    prior = min(max(float(known or 0.0), 1e-4), 0.9999)
    if n_terms:
        model = fit_label_model(kinds, n_terms, prior)
        rows = kinds.filter("toxic IS NOT NULL").toPandas()  # the bounded sample
        w = fit_classifier(rows, n_terms, model)
    else:
        w = None
    flat = prior if known else 0.0

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in (p for whole in frames for p in parts(whole, n_terms)):
            if w is None:
                result = np.full(len(frame), flat)
            else:
                result = 1 / (1 + np.exp(-np.clip(matrices(frame, n_terms)[1] @ w, -30, 30)))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "held_out": frame["remainder"].map(lambda r: None if r != r else r == 1), "score": result})

    scored = found.mapInPandas(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

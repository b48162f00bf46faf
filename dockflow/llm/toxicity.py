"""Toxicity: maximal scoring segments over token log-odds, judged by extreme-value statistics.

A word's score is the log-odds of standing in toxic against other texts, with a Dirichlet prior
that pulls rare words to the common rate, less a multiple of its standard error; all words that are
not clearly toxic have one small negative score. A linear scan finds every maximal
scoring segment of a text. Random texts of m words have maxima near ln(K m) / lambda, so a segment's
score is brought to lambda S - ln(K m), from which follow its p-value and, by a logistic curve, the
text's probability of being labelled toxic.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from dockflow.llm.common import fold, settle, smallest
from dockflow.llm.wordgrid import ALNUM, Words, batches

FOLDS, HELD, CURVE = 5, 0, 4  # number of folds, the one held out, the one that the curve is fitted on
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PRIOR = 3.0  # texts of each kind that the Dirichlet prior adds to a word
SURE = 4.0  # standard errors that a word's log-odds is lowered by
DRIFT = 0.05  # score of all other words, negative
TRAIN_DOCS = 40_000  # labelled rows that are fitted on, at most; they bound the lexicon too, whatever the table
SIGNIFICANT = 0.01  # p-value of a passage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def segments(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a sequence, in linear time.

    Its positive runs are given by the running total before (`left`) and after (`right`) each. A
    segment is (first run, last run, score). Each run starts as a segment; it swallows the
    nearest earlier segment that starts lower, if that one also ends lower.
    """
    found: list[list] = []  # first run, last run, total before, total after, earlier candidate
    for k in range(len(left)):
        first, low, high = k, left[k], right[k]
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                break
            first, low, up = found[j][0], found[j][2], found[j][4]
            del found[j:]
            j = up
        found.append([first, k, low, high, j])
    return [(a, b, high - low) for a, b, low, high, _ in found]


def text_segments(texts: list[bytes], lexicon: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, list[list[tuple]]]:
    """Words of each text, and its segments as (first word, last word, score)."""
    words = Words([t.lower() for t in texts], ALNUM)
    keys, values = lexicon
    hashes = words.hash
    at = np.minimum(np.searchsorted(keys, hashes), max(len(keys) - 1, 0))
    known = keys[at] == hashes if len(keys) else np.zeros(len(hashes), bool)
    where = np.flatnonzero(known)
    score = np.full(len(hashes), -DRIFT)
    score[where] = values[at[where]]
    total = np.concatenate([[0.0], np.cumsum(score)])
    out: list[list[tuple]] = [[] for _ in texts]
    cuts = np.searchsorted(where, words.first)
    for i in np.flatnonzero(np.diff(cuts)):
        place = where[cuts[i]:cuts[i + 1]]
        runs = segments(total[place], total[place + 1])
        out[i] = [(int(place[a] - words.first[i]), int(place[b] - words.first[i]), float(s)) for a, b, s in runs]
    return np.diff(words.first), out


def evidence(n_words: np.ndarray, best: np.ndarray, model: dict) -> np.ndarray:
    """Gumbel-standardised best score of texts; texts without a toxic word lie at the bottom."""
    return np.where(best > 0, model["rate"] * best - np.log(model["k"] * np.maximum(n_words, 1)), model["floor"])


def probability(x: np.ndarray, model: dict) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model["a"] * x + model["b"], -500, 500)))


def p_value(score: float, n_words: int, model: dict) -> float:
    """Chance that a text of so many ordinary words has a segment of this score or more."""
    return float(-np.expm1(-model["k"] * max(n_words, 1) * np.exp(-model["rate"] * score)))


def calibrate(n_words: np.ndarray, best: np.ndarray, label: np.ndarray) -> dict:
    """lambda and K from the maxima of texts labelled 0, then the logistic curve over all.

    The number of toxic words in ordinary texts is small, so the tail is fitted where it is: K is the rate per word
    of a positive segment, lambda the inverse of its mean score (the maximum-likelihood tail).
    """
    plain = label == 0
    hit = plain & (best > 0)
    rate = 1.0 / max(best[hit].mean(), 0.1) if hit.any() else 1.0
    rate = float(np.clip(rate, 0.2, 5.0))
    k = float((hit.sum() + 0.5) / max(n_words[plain].sum(), 1))
    model = {"rate": rate, "k": k, "floor": 0.0, "a": 1.0, "b": 0.0}
    some = best > 0
    x = evidence(n_words, best, model)
    model["floor"] = float(x[some].min() - 1) if some.any() else -5.0
    x = evidence(n_words, best, model)
    middle, scale = x.mean(), max(x.std(), 1e-6)
    z = np.column_stack([(x - middle) / scale, np.ones(len(x))])
    w = np.zeros(2)

    def loss(v: np.ndarray) -> float:
        return float(np.logaddexp(0, z @ v).sum() - label @ (z @ v) + 0.01 * v @ v)

    for _ in range(100):  # Newton steps of a ridge logistic regression, halved until they help
        p = 1 / (1 + np.exp(-z @ w))
        move = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 0.02 * np.eye(2), (label - p) @ z - 0.02 * w)
        while np.abs(move).max() > 1e-9 and loss(w + move) > loss(w):
            move = move / 2
        w = w + move
        if np.abs(move).max() < 1e-9:
            break
    a, b = w[0] / scale, w[1] - w[0] * middle / scale
    model["a"], model["b"] = max(float(a), 1e-6), float(b)
    return model


def word_scores(texts: DataFrame) -> DataFrame:
    """word, score, inner for all words with a positive score; texts: text, label, fold.

    A word counts once for each text, so that a text that repeats itself has no more weight. `inner` is the score
    without the curve's fold.
    """
    low = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    words = F.array_distinct(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)))
    inner = (F.col("fold") != CURVE).cast("int")
    seen = texts.select("label", (F.col("label") * inner).alias("inner_label"), inner.alias("inner"),
                        F.explode(words).alias("word"))
    counts = seen.groupBy("word").agg(
        F.sum("label").alias("toxic"), F.count("*").alias("texts"),
        F.sum("inner_label").alias("inner_toxic"), F.sum("inner").alias("inner_texts"))
    sums = texts.agg(F.sum("label"), F.count("*"), F.sum(F.col("label") * inner), F.sum(inner)).first()
    scored = counts.select("word", _log_odds("toxic", "texts", sums[0] or 0, sums[1]).alias("score"),
                           _log_odds("inner_toxic", "inner_texts", sums[2] or 0, sums[3] or 0).alias("inner"))
    return scored.filter("score > 0 or inner > 0")


def _log_odds(toxic: str, texts: str, all_toxic: int, all_texts: int) -> Column:
    """Lowered log-odds of a word; a word without texts scores nothing."""
    in1, in0 = F.col(toxic) + PRIOR, F.col(texts) - F.col(toxic) + PRIOR
    odds = (F.log(in1 / (all_toxic + PRIOR - F.col(toxic)))
            - F.log(in0 / (all_texts - all_toxic + PRIOR - F.col(texts) + F.col(toxic))))
    return F.when(F.col(texts) > 0, odds - SURE * F.sqrt(1 / in1 + 1 / in0) - DRIFT).otherwise(-DRIFT)


def lexicon_of(words: list[str], scores: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of words and their scores."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0)
    grid = Words([w.encode() for w in words], ALNUM)
    order = np.argsort(grid.hash)
    return grid.hash[order], np.asarray(scores)[order]


def gathered(scored: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Lexicons by `score` and by `inner`: words are hashed in tasks, 24 bytes each reach the driver."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                grid = Words([w.encode() for w in frame["word"]], ALNUM)
                yield pd.DataFrame({"hash": grid.hash.view(np.int64), "score": frame["score"].to_numpy(),
                                    "inner": frame["inner"].to_numpy()})

    found = scored.mapInPandas(work, "hash long, score double, inner double").toPandas()
    hashes = found["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    out = {}
    for kind in ("score", "inner"):
        values = found[kind].to_numpy(float)[order]
        out[kind] = hashes[order][values > 0], values[values > 0]
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> dict | None:
    """Word scores from the TRAIN_DOCS labelled rows outside the held-out fold with the smallest hashes of their id.

    Their ids are broadcast, so that no other text moves. Every word of the sample with a positive score is in the
    model. The curve is fitted on one fold, with word scores that do not know it. None where the rows lack one of the
    two labels.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter(
        "doc_id is not null and label in (0, 1)").withColumn("fold", fold("doc_id", FOLDS)).filter(
        F.col("fold") != HELD).dropDuplicates(["doc_id"])
    chosen = settle(smallest(known, "doc_id", TRAIN_DOCS))
    texts = settle(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(
        F.broadcast(chosen), "doc_id"))
    lexicon = gathered(word_scores(texts))
    held = docs.sparkSession.sparkContext.broadcast(lexicon["inner"])

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, raw in batches(frame, "text"):
                n, found = text_segments(raw, held.value)
                yield pd.DataFrame({"label": part["label"].to_numpy(), "n": n,
                                    "best": [max((s[2] for s in f), default=0.0) for f in found]})

    seen = texts.filter(F.col("fold") == CURVE).mapInPandas(work, "label int, n long, best double").toPandas()
    if seen["label"].nunique() < 2:
        return None
    return calibrate(seen["n"].to_numpy(), seen["best"].to_numpy(), seen["label"].to_numpy()) | {"lexicon": lexicon["score"]}


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", accept: float = 0.5) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, n_words, passages.

    A passage is a maximal scoring segment with a p-value of SIGNIFICANT or less: first and last
    word, score and p-value. Null and empty texts score like any text without toxic words; without labels
    of both kinds every text scores 0. Equal texts score alike, repeated rows are scored each, an empty
    table gives no rows. Labels, and other columns of docs, are never inputs of a score.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, label_col))

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = held.value
        for frame in frames:
            for part, raw in batches(frame, "text"):
                n, found = text_segments(raw, model["lexicon"] if model else lexicon_of([], []))
                best = np.array([max((s[2] for s in f), default=0.0) for f in found])
                score = probability(evidence(n, best, model), model) if model else np.zeros(len(raw))
                passages = [[(a, b, s, p) for a, b, s in f if (p := p_value(s, w, model)) <= SIGNIFICANT]
                            for f, w in zip(found, n)]
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "score": score, "n_words": n, "passages": passages})

    narrow = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    scored = narrow.mapInPandas(work, f"doc_id {kind}, score double, n_words long, passages array<struct<"
                                      "first_word: long, last_word: long, score: double, p: double>>")
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD).alias("held_out"), "score",
                         (F.col("score") >= accept).cast("int").alias("predicted"), "n_words", "passages")

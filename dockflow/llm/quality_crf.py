"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line with a word is labelled good or bad from its own features and those of the lines
before and after it; the chain's transitions tie neighbouring labels together. Forward-backward
gives each line's probability of being good, and their mean, weighted by length, is the
text's quality, which a logistic curve brings to the scale of the labels.

Only texts carry labels, so in training line labels are hidden: a text of label y has the weight
exp(AGREE * share of its characters in lines labelled y), summed over all labellings of its lines. That sum is
a chain's normaliser, since the share is a sum over lines; the fit maximises the likelihood of the texts'
labels by forward-backward over the chain tied to either label. A good text may so hold bad lines.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dockflow.llm.common import fold, smallest
from dockflow.llm.wordgrid import NOT_SPACE, Words, batches, count_before, mix, slices, span_hash

TRAIN_DOCS = 2000  # labelled rows that are fitted on, at most
TRAIN_LINES = 200  # lines in a row that a longer text is fitted on, from a place drawn by its words
FOLDS, HELD = 4, 2  # fixed values
ACCEPT = 0.7  # fixed value
AGREE = 12.0  # weight of a text's label on the share of its lines that agree with it
STEPS, RATE, RIDGE, NEIGHBOUR_RIDGE = 150, 0.1, 1e-3, 2e-2

_byte = np.arange(256)
_upper = (_byte >= 0x41) & (_byte <= 0x5A)
_letter = _upper | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0xC0)
_digit = (_byte >= 0x30) & (_byte <= 0x39)
_lead = (_byte & 0xC0) != 0x80


def _among(characters: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(characters)] = True
    return found


_symbol, _mark, _bar, _stop = _among(b"#*$%&<>"), _among(b"!?;:"), _among(b"|"), _among(b".,")


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line with a word, the line's text, and its characters."""
    words = Words(texts, NOT_SPACE)
    code = words.buffer
    ends = np.flatnonzero(code == 0x0A)
    begins = np.concatenate([[0], ends[:-1] + 1])
    first, last = np.searchsorted(words.start, begins), np.searchsorted(words.start, ends)
    worded = last > first
    begins, ends, first, last = begins[worded], ends[worded], first[worded], last[worded]
    line_text = np.searchsorted(words.text_start, begins, side="right") - 1
    if not len(begins):
        return np.zeros((0, 2 * 11)), line_text, np.zeros(0)

    def inside(of: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(of[code], dtype=np.int64)])
        return (total[ends] - total[begins]).astype(float)

    n = (last - first).astype(float)
    bounds = np.append(first, last[-1])  # words of a line are consecutive, and no word lies between lines
    hashes = words.hash
    line_of = np.repeat(np.arange(len(n)), last - first)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    salted = mix(hashes + line_of.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
    _, distinct = np.unique(salted, return_index=True)
    whole = mix(span_hash(code, begins, ends) + line_text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, earliest = np.unique(whole, return_index=True)
    seen = np.ones(len(n))
    seen[earliest] = 0
    characters = inside(_lead)
    letters = inside(_letter)
    total = np.concatenate([[0], np.cumsum(_letter[code], dtype=np.int64)])
    bare = total[words.end] == total[words.start]  # words without a letter
    rates = np.column_stack([
        np.log1p(n) / 4, letters / n / 8, inside(_symbol) / n, inside(_mark) / n, inside(_bar) / n,
        inside(_upper) / np.maximum(letters, 1), inside(_digit) / np.maximum(characters, 1),
        count_before(again, bounds) / n, np.bincount(line_of[distinct], minlength=len(n)) / n, seen,
        count_before(bare, bounds) / n])
    rates = np.minimum(rates, 3.0)
    return np.hstack([rates, np.sqrt(rates)]), line_text, characters


def with_neighbours(features: np.ndarray, line_text: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the line before and after it in its text, and a constant."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    joined = np.flatnonzero(line_text[1:] == line_text[:-1])
    before[joined + 1] = features[joined]
    after[joined] = features[joined + 1]
    return np.hstack([features, before, after, np.ones((len(features), 1))])


def _layout(line_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First line and number of lines of each text that has lines, longest first, and the texts."""
    texts, first, count = np.unique(line_text, return_index=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    return first[order], count[order], texts[order]


def marginals(odds: np.ndarray, line_text: np.ndarray, link: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over all texts at once.

    odds: each line's score for good over bad; link: 2 x 2 scores of a label and the next.
    Returns each line's probability of good, that of each transition within a text, and each text's log
    normaliser (in the order of `_layout`).
    """
    first, count, _ = _layout(line_text)
    n = len(odds)
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    own = np.column_stack([np.zeros(n), odds])
    longest = int(count[0]) if len(count) else 0
    active = [int(np.searchsorted(-count, -t, side="left")) for t in range(longest)]  # texts longer than t
    for t in range(longest):
        at = first[:active[t]] + t
        if t == 0:
            forward[at] = own[at]
        else:
            into = forward[at - 1][:, :, None] + link
            forward[at] = np.logaddexp(into[:, 0], into[:, 1]) + own[at]
    for t in range(longest - 2, -1, -1):
        at = first[:active[t + 1]] + t
        out = link + (own[at + 1] + backward[at + 1])[:, None, :]
        backward[at] = np.logaddexp(out[:, :, 0], out[:, :, 1])
    both = forward + backward
    norm = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - norm)
    pair = np.flatnonzero(line_text[1:] == line_text[:-1])
    joint = (forward[pair][:, :, None] + link + (own[pair + 1] + backward[pair + 1])[:, None, :]
             - norm[pair][:, None, None])
    return good, np.exp(joint), norm[first]


def text_quality(good: np.ndarray, characters: np.ndarray, line_text: np.ndarray, texts: int) -> np.ndarray:
    """Length-weighted mean probability of the lines of each text; a text without lines has 0."""
    weight = np.bincount(line_text, characters, minlength=texts)
    return np.bincount(line_text, good * characters, minlength=texts) / np.maximum(weight, 1)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def label_likelihood(odds: np.ndarray, share: np.ndarray, line_text: np.ndarray, link: np.ndarray,
                     label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of each text's label, and its slopes in the lines' odds and in the transitions.

    share is each line's part of its text. Texts without lines have a likelihood of one half.
    """
    texts = _layout(line_text)[2]
    tied = []
    log_sum = np.zeros((2, len(label)))
    for y in (0, 1):
        good, pairs, norm = marginals(odds + (2 * y - 1) * AGREE * share, line_text, link)
        log_sum[y, texts] = norm + (0.0 if y else AGREE)
        tied.append((good, pairs))
    truth = log_sum[label, np.arange(len(label))] - np.logaddexp(*log_sum)
    chance = np.exp(log_sum[1] - np.logaddexp(*log_sum))  # of label 1
    error = (label - chance)[line_text]
    by_odds = error * (tied[1][0] - tied[0][0])
    pair = np.flatnonzero(line_text[1:] == line_text[:-1])
    by_link = np.tensordot(error[pair], tied[1][1] - tied[0][1], axes=1)
    return truth, by_odds, by_link


def fit(features: np.ndarray, characters: np.ndarray, line_text: np.ndarray, label: np.ndarray) -> dict:
    """Weights by gradient steps on the labels' likelihood, then the curve to the labels' scale.

    line_text numbers the texts 0 .. len(label) - 1; every text counts the same, whatever its length. Neighbours'
    weights are held smaller than a line's own, as whole texts of one kind cannot tell them apart.
    """
    x = with_neighbours(features, line_text)
    middle, scale = x.mean(axis=0), x.std(axis=0)
    middle[-1], scale[scale < 1e-9] = 0.0, 1.0
    x = (x - middle) / scale
    share = characters / np.maximum(np.bincount(line_text, characters, minlength=len(label)), 1)[line_text]
    weights, link = np.zeros(x.shape[1]), np.zeros((2, 2))
    ridge = np.full(x.shape[1], NEIGHBOUR_RIDGE)
    ridge[:features.shape[1]], ridge[-1] = RIDGE, 0.0
    slope = [np.zeros_like(weights), np.zeros_like(link)]
    square = [np.zeros_like(weights), np.zeros_like(link)]
    for step in range(1, STEPS + 1):
        _, by_odds, by_link = label_likelihood(x @ weights, share, line_text, link, label)
        gradient = [by_odds @ x / len(label) - ridge * weights, by_link / len(label) - NEIGHBOUR_RIDGE * link]
        for k, value in enumerate((weights, link)):
            slope[k] = 0.9 * slope[k] + 0.1 * gradient[k]
            square[k] = 0.99 * square[k] + 0.01 * gradient[k] ** 2
            value += RATE * (slope[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)
    good, _, _ = marginals(x @ weights, line_text, link)
    evidence = _logit(text_quality(good, characters, line_text, len(label)))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of a ridge logistic regression on one number
        p = 1 / (1 + np.exp(-(a * evidence + b)))
        w = p * (1 - p) + 1e-9
        g = np.array([((label - p) * evidence).sum() - 1e-2 * a, (label - p).sum()])
        h = np.array([[(w * evidence ** 2).sum() + 1e-2, (w * evidence).sum()], [(w * evidence).sum(), w.sum() + 1e-6]])
        move = np.linalg.solve(h, g)
        a, b = a + move[0], b + move[1]
        if np.abs(move).max() < 1e-9:
            break
    return {"middle": middle, "scale": scale, "weights": weights, "link": link, "a": max(a, 1e-6), "b": b}


def score(texts: list[bytes], model: dict) -> tuple[np.ndarray, list[np.ndarray]]:
    """Quality of each text and its lines' probabilities of being good."""
    features, line_text, characters = line_features(texts)
    if not len(line_text):
        return np.zeros(len(texts)), [np.zeros(0)] * len(texts)
    x = (with_neighbours(features, line_text) - model["middle"]) / model["scale"]
    good, _, _ = marginals(x @ model["weights"], line_text, model["link"])
    quality = text_quality(good, characters, line_text, len(texts))
    value = 1 / (1 + np.exp(-(model["a"] * _logit(quality) + model["b"])))
    lines = np.bincount(line_text, minlength=len(texts))
    value[lines == 0] = 0.0
    return value, np.split(good, np.cumsum(lines)[:-1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> dict | None:
    """A model from the TRAIN_DOCS labelled rows with the smallest hashes of their id.

    Rows of the held-out fold are never read. A text of more than TRAIN_LINES lines gives that many in a row. None where
    the rows lack one of the two labels, or all have no words.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter(
        "doc_id is not null and label in (0, 1)").filter(fold("doc_id", FOLDS) != HELD).dropDuplicates(["doc_id"])
    chosen = smallest(known, "doc_id", TRAIN_DOCS)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(chosen, "doc_id")

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, texts in batches(frame, "text"):
                features, line_text, characters = line_features(texts)
                spans = []
                for i in np.unique(line_text):
                    a, b = np.searchsorted(line_text, [i, i + 1])
                    a += zlib.crc32(texts[i]) % max(b - a - TRAIN_LINES + 1, 1)
                    spans.append((i, slice(a, min(b, a + TRAIN_LINES))))
                if not spans:
                    continue
                yield pd.DataFrame({"doc_id": [str(part["doc_id"].iloc[i]) for i, _ in spans],
                                    "mark": [zlib.crc32(texts[i]) for i, _ in spans],
                                    "label": [part["label"].iloc[i] for i, _ in spans],
                                    "characters": [characters[s] for _, s in spans],
                                    "features": [features[s].ravel() for _, s in spans]})

    found = rows.mapInPandas(work, "doc_id string, mark long, label int, characters array<double>, "
                                   "features array<double>").toPandas()
    if found["label"].nunique() < 2:
        return None
    found = found.sort_values(["doc_id", "mark"], kind="stable")
    characters = found["characters"].tolist()
    line_text = np.repeat(np.arange(len(found)), [len(c) for c in characters])
    features = np.concatenate(found["features"].tolist()).reshape(len(line_text), -1)
    return fit(features, np.concatenate(characters), line_text, found["label"].to_numpy())


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", accept: float = ACCEPT) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, lines (each line's probability of being good).

    Null, empty and blank texts have no lines and score 0; without labels of both kinds every
    other text scores 0.5. Equal texts score alike, repeated rows are scored each, an empty table gives no
    rows. Labels, and other columns of docs, are never inputs of a score. Of repeated ids in labels one
    counts.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    model = train(docs, labels, id_col, text_col, label_col)
    held = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, texts in batches(frame, "text"):
                if held.value is None:
                    found = [0.5 if t.split() else 0.0 for t in texts], [[] for _ in texts]
                else:
                    found = score(texts, held.value)
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "score": found[0], "lines": list(found[1])})

    narrow = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    scored = narrow.mapInPandas(work, f"doc_id {kind}, score double, lines array<double>")
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD).alias("held_out"), "score",
                         (F.col("score") >= accept).cast("int").alias("predicted"), "lines")


def accepted(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """The rows of docs whose text is accepted, in one pass that carries the rows along.

    Without labels of both kinds all rows stay; with a model, null, empty and blank texts go. Repeated rows
    are judged alike, other columns are carried whatever their names, an empty table gives no rows.
    """
    model = train(docs, labels)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tables:
            for part, texts in slices(rows, "text"):
                if held.value is not None:
                    part = part.filter(pa.array(score(texts, held.value)[0] >= accept))
                yield part

    return docs.mapInArrow(work, docs.schema)

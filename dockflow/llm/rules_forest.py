"""Quality rules: an isolation forest on rule statistics, with a threshold from labelled rows.

Statistics are computed over every whole text. The forest splits a few hundred rows at a time at
random; rows that end up alone after few splits are unlike the others. How far is too far is read
from the scores of all labelled rows.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from dockflow.llm.common import settle, smallest
from dockflow.llm.wordgrid import NOT_SPACE, Words, batches, count_before, span_ids

SYMBOLS = b"#*$%&|<>"  # fixed value
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50  # fixed values

TREES, SAMPLE = 100, 256  # the forest is fitted on at most TREES * SAMPLE labelled rows
GOOD_FOR_BAD = 25  # rows labelled 1 in the sample for each one labelled 0, so that bad rows stay rare
BINS = 1000  # of scores, for the threshold
MAX_GOOD_LOST = 0.01  # share of rows labelled good that the threshold may reject

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_upper", "n_letters", "n_marks"]

_symbol = np.zeros(256, bool)
_symbol[list(SYMBOLS)] = True
_mark = np.zeros(256, bool)
_mark[list(b"!?;:")] = True
_byte = np.arange(256)
_upper = (_byte >= 0x41) & (_byte <= 0x5A)
_letter = _upper | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0xC0)  # a lead byte stands for a letter
_lead = (_byte & 0xC0) != 0x80
_newline = _byte == 0x0A


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for each pair of numbers from 0 up."""
    return a.astype(np.int64) * (int(b.max(initial=0)) + 1) + b


def statistics(texts: list[bytes]) -> pd.DataFrame:
    """The columns COUNTS and MORE of some texts."""
    words = Words(texts, NOT_SPACE)
    at, n = words.text_start, len(texts)
    out = {"n_words": np.diff(words.first)}
    code = words.buffer
    out["word_chars"] = count_before(_lead[code] & NOT_SPACE[code], at)
    out["n_symbols"] = count_before(_symbol[code], at)

    ends = np.flatnonzero(_newline[code])  # every text ends with one, which was added
    begins = np.concatenate([[0], ends[:-1] + 1])
    first_word = np.searchsorted(words.start, begins)
    worded = np.searchsorted(words.start, ends) > first_word
    begins, ends = begins[worded], ends[worded]
    line_text = np.searchsorted(at, begins, side="right") - 1
    out["n_lines"] = np.bincount(line_text, minlength=n)
    _, earliest = np.unique(paired(line_text, span_ids(code, begins, ends)), return_index=True)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(line_text[earliest], minlength=n)

    word = words.id
    repeated = np.zeros(len(word), bool)
    if len(word) >= 3:
        places = np.flatnonzero(words.text[:-2] == words.text[2:])
        window = words.text[places]
        for k in range(3):
            _, window, count = np.unique(paired(window, word[places + k]), return_inverse=True, return_counts=True)
        twice = places[count[window] > 1] if len(places) else places
        for k in range(3):
            repeated[twice + k] = True
    out["n_repeat_words"] = np.bincount(words.text[repeated], minlength=n)
    for name, of in (("n_upper", _upper), ("n_letters", _letter), ("n_marks", _mark)):
        out[name] = count_before(of[code], at)
    return pd.DataFrame({c: out[c].astype(np.int64) for c in COUNTS + MORE})


def ratios(stats: pd.DataFrame) -> np.ndarray:
    """What the forest splits on: word length, symbols and marks for each word, share of capitals.

    Shares, so that length alone makes no text unusual. Repetition is left to the base rules: a passage
    that stands twice in a good text is rare as well.
    """
    words = np.maximum(stats["n_words"].to_numpy(float), 1)
    return np.column_stack([
        stats["word_chars"] / words, stats["n_symbols"] / words,
        stats["n_upper"] / np.maximum(stats["n_letters"], 1), stats["n_marks"] / words]).astype(float)


def _average_path(n: np.ndarray) -> np.ndarray:
    """Mean length of an unsuccessful search among n rows, the usual unit of path lengths."""
    n = np.asarray(n, float)
    big = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(big - 1) + np.euler_gamma) - 2 * (big - 1) / big, np.where(n == 2, 1.0, 0.0))


def grow(rows: np.ndarray, seed: int) -> list[dict[str, np.ndarray]]:
    """Trees over random parts of the rows; a tree is arrays of feature, split, left child and depth."""
    draw = np.random.default_rng(seed)
    size = min(SAMPLE, len(rows))
    deepest = int(np.ceil(np.log2(max(size, 2))))
    forest = []
    for _ in range(TREES):
        nodes: list[list[float]] = []
        queue = [(rows[draw.choice(len(rows), size, replace=False)], 0)]
        while queue:
            part, depth = queue.pop(0)
            low, high = part.min(axis=0), part.max(axis=0)
            open_features = np.flatnonzero(high > low)
            if depth >= deepest or len(part) < 2 or not len(open_features):
                nodes.append([-1, 0.0, 0, depth + float(_average_path(len(part)))])
                continue
            f = draw.choice(open_features)
            split = draw.uniform(low[f], high[f])
            left = part[:, f] < split
            nodes.append([f, split, len(nodes) + len(queue) + 1, 0.0])
            queue += [(part[left], depth + 1), (part[~left], depth + 1)]
        table = np.array(nodes)
        forest.append({"feature": table[:, 0].astype(int), "split": table[:, 1],
                       "child": table[:, 2].astype(int), "length": table[:, 3]})
    return forest


def anomaly(forest: list[dict[str, np.ndarray]], rows: np.ndarray, sampled: int) -> np.ndarray:
    """Scores from 0 to 1; the shorter the paths, the higher."""
    if not forest or not len(rows):
        return np.zeros(len(rows))
    total = np.zeros(len(rows))
    for tree in forest:
        node = np.zeros(len(rows), int)
        while True:
            feature = tree["feature"][node]
            inner = np.flatnonzero(feature >= 0)
            if not len(inner):
                break
            at = node[inner]
            right = rows[inner, feature[inner]] >= tree["split"][at]
            node[inner] = tree["child"][at] + right
        total += tree["length"][node]
    unit = float(_average_path(min(SAMPLE, sampled))) or 1.0
    return 2.0 ** (-total / len(forest) / unit)


def threshold(histogram: list[tuple[int, int, int]], max_good_lost: float = MAX_GOOD_LOST) -> float:
    """The score from which a row is rejected, from counts of (bin, label).

    Of all bins that reject at most the given share of rows labelled 1, the one that
    separates the labels best; 2.0 (no row) without labels of both kinds.
    """
    counts = np.zeros((2, BINS + 1))
    for bin_, label, n in histogram:
        counts[label, bin_] += n
    if not counts.sum(axis=1).all():
        return 2.0
    above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] / counts.sum(axis=1, keepdims=True)
    gain = np.where(above[1] <= max_good_lost, above[0] - above[1], -1.0)
    best = int(np.argmax(gain))
    return best / BINS if gain[best] > 0 else 2.0


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics of every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, texts in batches(frame, "text"):
                out = statistics(texts)
                out.insert(0, "doc_id", part["doc_id"].to_numpy())
                yield out

    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS + MORE)
    return docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text").mapInPandas(work, schema)


def _scored(rows: DataFrame, forest: list, sampled: int) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(forest)  # at most TREES * 2 * SAMPLE nodes

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(anomaly=anomaly(held.value, ratios(frame), sampled))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(work, f"{fields}, anomaly double")


def judge(docs: DataFrame, labels: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> DataFrame:
    """Per document: doc_id, statistics, base_failed, anomaly, threshold, kept.

    The forest is fitted on the TREES * SAMPLE rows labelled 1 with the smallest hashes of their id (all,
    if there are fewer) and one row labelled 0 for each GOOD_FOR_BAD of them; the threshold comes from all labelled rows that pass the base
    rules. Null and empty texts have no words and fail them. Rows that tie score alike, repeated rows
    are judged each, without labels only the base rules decide, an empty table gives no rows. Other
    columns of docs and labels are not read.
    """
    stats = settle(measured(docs, id_col, text_col).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))))
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter(
        "doc_id is not null and label in (0, 1)").dropDuplicates(["doc_id"])
    labelled = settle(stats.filter("not base_failed").join(known, "doc_id"))
    good = smallest(labelled.filter("label = 1"), "doc_id", TREES * SAMPLE, seed).toPandas()
    bad = smallest(labelled.filter("label = 0"), "doc_id", -(-len(good) // GOOD_FOR_BAD), seed).toPandas()
    sample = pd.concat([good, bad], ignore_index=True)
    forest = grow(ratios(sample), seed) if len(sample) > 1 else []
    bins = _scored(labelled, forest, len(sample)).groupBy(
        F.floor(F.col("anomaly") * BINS).cast("int").alias("bin"), "label").agg(F.count("*").alias("n"))
    limit = threshold([(r["bin"], r["label"], r["n"]) for r in bins.collect()])  # BINS + 1 bins of two labels
    scored = _scored(stats, forest, len(sample)).withColumn("threshold", F.lit(limit))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < limit))

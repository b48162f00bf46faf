"""Near-duplicate classes by Order MinHash, verified by banded alignment.

A text is the sequence of its five-word shingles, each labelled with how often it has occurred before, so
no element repeats. A sketch takes the few elements with the smallest values of one hash function
and keeps them in text order: two texts share it if they share these elements *in that order*. Texts
that share a sketch are candidates. A candidate pair is verified by the
longest common subsequence L of the two sequences of n and m elements, within a band around the
diagonal that no qualifying alignment leaves: they are linked if L / (n + m - L) is 0.8 or
more. Linked texts form classes.

Texts under one sketch are not compared all with all. First each bucket's hub is compared with its
members, which settles groups of near copies. Where a bucket still holds several classes, its texts may
only have a passage in common. A pair at 0.8 or more also shares one of the rarest fifth (and one more) of
each text's elements, whatever the order of rarity, so these texts get new buckets by
those elements, and passages, being common, fall away. Further rounds give every bucket hubs, which are
compared with all members that are not known to be in their class; a hub then leaves the bucket. The
rounds end when each bucket holds one class: every candidate pair has been verified, lies in one class
anyway, or cannot reach 0.8.
"""

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from dockflow.llm.common import packed, release, row_key, settle, unpacked
from dockflow.llm.links import components
from dockflow.llm.numbering import numbered
from dockflow.llm.wordgrid import ALNUM, Words, batches, mix

SHINGLE = 5  # words
SKETCHES = 20  # a pair at 0.8 shares none of them with a probability of 0.00003
LONG, SHORT = (4, 64), (3, 80)  # elements of a sketch, for texts of at least 64 and at most 80 shingles
# A pair at 0.8 or more with one text outside a range lies in the other range with both texts.
HUBS = 64  # of a bucket in a round after the first; the number grows by this factor each round

_draw = np.random.default_rng(20)
_flip = _draw.integers(0, 2 ** 64, SKETCHES, np.uint64, endpoint=False)
_odd = _draw.integers(0, 2 ** 64, SKETCHES, np.uint64, endpoint=False) | np.uint64(1)
_step = np.uint64(0x9E3779B97F4A7C15)
_weights = _draw.integers(0, 2 ** 64, SHINGLE, np.uint64, endpoint=False) | np.uint64(1)


def sequences(texts: list[bytes]) -> tuple[list[np.ndarray], list[bytes]]:
    """Each text's labelled shingles in order, and a digest of its words.

    Words are runs of a-z (from either case), 0-9 and non-ASCII characters. A text of one to four words has one
    shingle, of all its words.
    """
    words = Words([t.lower() for t in texts], ALNUM)
    hashes, first = words.hash, words.first
    digests = words.digests(ALNUM)
    size = len(hashes)
    shingle = np.zeros(max(size - SHINGLE + 1, 0), np.uint64)
    for k in range(SHINGLE):
        shingle += hashes[k:size - SHINGLE + 1 + k] * _weights[k]
    shingle = mix(shingle)
    n_words = np.diff(first)
    count = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, (n_words > 0).astype(int))
    bounds = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(len(texts)), count)
    flat = np.zeros(bounds[-1], np.uint64)
    whole = n_words[owner] >= SHINGLE
    place = np.arange(bounds[-1]) - bounds[owner] + first[owner]
    flat[whole] = shingle[place[whole]]
    for i in np.flatnonzero((n_words > 0) & (n_words < SHINGLE)):
        flat[bounds[i]] = np.frombuffer(digests[i][:8], np.uint64)[0]
    salted = mix(flat + owner.astype(np.uint64) * _step)
    order = np.argsort(salted, kind="stable")
    run = np.ones(len(order), bool)
    run[1:] = salted[order][1:] != salted[order][:-1]
    starts = np.flatnonzero(run)
    rank = np.empty(len(order), np.uint64)
    rank[order] = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    labelled = mix(flat + (rank + np.uint64(1)) * _step)
    return [labelled[a:b] for a, b in zip(bounds[:-1], bounds[1:])], digests


def sketches(sequence: np.ndarray) -> np.ndarray:
    """The text's sketches as 64-bit values: SKETCHES of either or both sizes; none without words."""
    n = len(sequence)
    if not n:
        return np.zeros(0, np.int64)
    values = (sequence ^ _flip[:, None]) * _odd[:, None]
    out = []
    for size, fits in ((LONG[0], n >= LONG[1]), (SHORT[0], n <= SHORT[1])):
        if not fits:
            continue
        take = min(size, n)
        least = np.argpartition(values, take - 1, axis=1)[:, :take]
        chosen = sequence[np.sort(least, axis=1)]
        sketch = _odd * np.uint64(size)
        for k in range(take):
            sketch = mix(sketch + chosen[:, k])
        out.append(sketch)
    return np.concatenate(out).view(np.int64)


def common_length(x: np.ndarray, y: np.ndarray) -> int:
    """Longest common subsequence of two sequences without repeats, within the band.

    A link needs a distance n + m - 2 L of at most (n + m) / 9, and an alignment that leaves the diagonal by more has a
    larger one. As no element repeats, the subsequence is the longest rising run of matched positions.
    """
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= (len(x) + len(y)) // 9
    matched = j[near][np.argsort(i[near])]
    if len(matched) < 2 or (np.diff(matched) > 0).all():
        return len(matched)
    tails: list[int] = []
    for p in matched.tolist():
        at = bisect_left(tails, p)
        tails[at:at + 1] = [p]
    return len(tails)


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether L / (n + m - L) is 0.8 or more."""
    most, least = max(len(x), len(y)), min(len(x), len(y))
    return 5 * least >= 4 * most and 9 * common_length(x, y) >= 4 * (len(x) + len(y))


def _sketched(docs: DataFrame) -> DataFrame:
    """doc_id, rk, tk, digest, n, sketches of every document (rk: its row, tk: its text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, texts in batches(frame, "text"):
                found, digests = sequences(texts)
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(), "rk": part["rk"].to_numpy(), "tk": part["tk"].to_numpy(),
                    "digest": [d.hex() for d in digests], "n": [len(s) for s in found],
                    "sketches": [sketches(s) for s in found]})

    return docs.mapInPandas(work, f"doc_id {kind}, rk long, tk string, digest string, n long, sketches array<long>")


def _verified(pairs: DataFrame) -> DataFrame:
    """Those of the pairs x, y (with text_x, text_y) that are linked."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), 256):
                part = frame.iloc[start:start + 256]
                texts = dict(zip(part["x"], part["text_x"])) | dict(zip(part["y"], part["text_y"]))
                found = {}
                for some, raw in batches(pd.DataFrame({"node": list(texts), "text": list(texts.values())}), "text"):
                    found |= dict(zip(some["node"], sequences(raw)[0]))
                keep = [linked(found[a], found[b]) for a, b in zip(part["x"], part["y"])]
                yield part.loc[keep, ["x", "y"]]

    return pairs.mapInPandas(work, "x long, y long")


def _text_key(text: str):
    """Names a text, so that it can be found again without a pass through Python."""
    return F.md5(F.coalesce(F.col(text), F.lit("")))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, rk, class_id, class_size, kept.

    class_id is the smallest doc_id of the class (null if none has one) and that row is kept; of
    several such rows, one is marked. Texts with the same words are in one class, therefore so are all texts without
    words, null and empty ones included. Repeated rows and equal texts count in class_size. An empty table
    gives no rows; other columns of docs only enter rk, the fingerprint of the whole row.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), row_key(docs).alias("rk"), _text_key(text_col).alias("tk"),
                         F.col(text_col).alias("text"))
    wide = settle(_sketched(narrow))
    base = settle(wide.select("doc_id", "rk", "digest"))
    distinct = settle(wide.groupBy("digest").agg(F.min("tk").alias("tk"), F.first("n").alias("n"),
                                                 F.first("sketches").alias("sketches")))
    release(wide)
    nodes = settle(numbered(distinct, ["digest"], distinct.count(), out="node"))
    release(distinct)
    label = _labels(nodes, narrow)
    named = nodes.join(label, "node", "left").select("digest", F.coalesce("label", "node").alias("class"))
    texts = base.groupBy("digest").agg(F.count("*").alias("copies"), F.min("doc_id").alias("low"))
    sizes = texts.join(named, "digest").groupBy("class").agg(
        F.sum("copies").alias("class_size"), F.min("low").alias("class_id"))
    of_text = settle(named.join(sizes, "class").select("digest", "class", "class_id", "class_size"))
    rows = base.groupBy("doc_id", "rk", "digest").agg(F.count("*").alias("n")).join(of_text, "digest")
    first = rows.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("class").agg(
        F.min(F.struct("digest", "rk")).alias("first")).select("class", "first.digest", F.col("first.rk").alias("rk"))
    marked = rows.join(first.withColumn("stays", F.lit(True)), ["class", "digest", "rk"], "left")
    each = marked.withColumn("copy", F.explode(F.expr("sequence(1L, n)")))
    kept = F.coalesce("stays", F.lit(False)) & (F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return each.select("doc_id", "rk", "class_id", "class_size", kept.alias("kept"))


def _labels(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, label: the smallest node of its class, for nodes that are linked to others."""
    label = nodes.select("node", F.col("node").alias("label")).limit(0)
    placed = nodes.select("node", "n", F.col("n").alias("left"), F.explode("sketches").alias("s"))
    shared = placed.groupBy("s").agg(F.count("*").alias("size")).filter("size > 1")
    sized = settle(placed.join(shared, "s"))
    if sized.isEmpty():
        return label
    # A text in the middle of a group shares most sketches with others, and makes the best hub.
    weight = settle(sized.groupBy("node").agg(F.sum("size").alias("weight")))
    members = settle(sized.drop("size").join(weight, "node"))
    release(sized)
    needed = weight.join(nodes.select("node", "tk"), "node").select("node", "tk")
    texts = settle(docs.select("tk", "text").join(needed, "tk").groupBy("node").agg(F.first("text").alias("text")))
    links, tried, hubs_each = None, None, 1
    while True:
        # Buckets that hold more than one class, with each member's class.
        known = members.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed = known.groupBy("s").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a <> b").select("s")
        known = settle(known.join(mixed, "s"))
        release(members)
        if known.isEmpty():
            return label
        if hubs_each == HUBS:
            known, sketched = settle(_rare_buckets(known, texts)), known
            release(sketched)
        slot = F.pmod(F.xxhash64("node", F.lit(hubs_each)), F.lit(hubs_each))
        hubs = settle(known.withColumn("slot", slot).groupBy("s", "slot").agg(
            F.max(F.struct("weight", "node", "n", "left", "label")).alias("hub")).select(
            "s", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.left").alias("hub_left"),
            F.col("hub.label").alias("hub_label")))
        # Two texts have no more than the smaller `left` in common from their first common element on.
        met = known.join(hubs, "s").filter((F.col("label") != F.col("hub_label")) & (
            9 * F.least("left", "hub_left") >= 4 * (F.col("n") + F.col("hub_n"))))
        pairs = met.select(F.least("node", "hub").alias("x"), F.greatest("node", "hub").alias("y")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["x", "y"], "left_anti")
        pairs = settle(pairs)
        tried = pairs if tried is None else settle(tried.unionByName(pairs))
        found = settle(_verified(_with_texts(pairs, texts)))
        if not found.isEmpty():
            links = found if links is None else settle(links.unionByName(found))
            label = components(links)
        gone = hubs.select("s", F.col("hub").alias("node"))
        members = settle(known.drop("label").join(gone, ["s", "node"], "left_anti"))
        release(known, hubs)
        hubs_each *= HUBS


def _rare_buckets(known: DataFrame, texts: DataFrame) -> DataFrame:
    """Buckets of the members' rarest elements: s, node, n, left, weight, label.

    An element that no other of these texts has makes no bucket, but takes one of its text's places. `left`
    counts the text's elements from this one on, in order of rarity.
    """
    members = settle(known.select("node", "n", "weight", "label").distinct())

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, raw in batches(frame, "text"):
                found = sequences(raw)[0]
                yield pd.DataFrame({"node": part["node"].to_numpy().repeat([len(s) for s in found]),
                                    "s": np.concatenate(found).view(np.int64)})

    elements = settle(texts.join(members.select("node"), "node").mapInPandas(work, "node long, s long"))
    texts_of = elements.groupBy("s").agg(F.count("*").alias("texts")).filter("texts > 1")
    shared = elements.join(texts_of, "s")
    by_text = Window.partitionBy("node")
    alone = F.col("n") - F.count("*").over(by_text)
    rank = F.row_number().over(by_text.orderBy("texts", "s"))
    rare = shared.join(members, "node").withColumn("place", alone + rank).filter("place <= n div 5 + 1")
    return rare.select("s", "node", "n", (F.col("n") - F.col("place") + 1).alias("left"), "weight", "label")


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs x, y with the texts of both."""
    def side(name: str) -> DataFrame:
        return texts.select(F.col("node").alias(name), F.col("text").alias(f"text_{name}"))

    return pairs.join(side("y"), "y").join(side("x"), "x")


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, one of each class, with all their columns."""
    stay = classes(docs).filter("kept").select(F.col("doc_id").alias("id"), "rk", F.lit(1).cast("long").alias("copies"))
    rows = packed(docs, F.col("doc_id").alias("id"), row_key(docs).alias("rk"))
    return unpacked(rows, stay, ["id", "rk"])

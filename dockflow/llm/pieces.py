"""SentencePiece encoding and decoding by a max-plus scan.

A text's encoding is its segmentation into vocabulary pieces with the largest sum of scores.
Long texts are cut into chunks. Where a piece may stand across a cut, its overshoot into the next chunk
is the boundary's state, and a chunk is a matrix of the best score from each entering to each leaving
state. Max-plus products of matrices are associative, so a tree of them gives every boundary's
state on the best path; then each chunk is segmented on its own between two known ends. Beside a
score stands the rank of its entering state among those with the same leaving state, which decides ties.

The work of a chunk is small, because most positions cannot lie inside a piece: if no piece holds two
characters in a row, every segmentation passes between them. Entering states meet at the first
such position, leaving states part at the last, and between two of them the library's lattice
search runs on stretches short enough for its single-precision sums to be exact.

The scores of the model file are ranks of merges. They are read here as the scores of a unigram model, which
is what a best sum needs; pieces that the file leaves without a rank come right after the last one. The
vocabulary and its identifiers are the file's own. Equal sums go to the longer last piece, read from the
end of the text, so of two paths the one whose last differing boundary is earlier; cuts do not change that.
"""

import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from dockflow.llm.common import settle
from dockflow.llm.wordgrid import BATCH_BYTES

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 16_384  # characters of a chunk of a giant text
GIANT = 2 * CHUNK  # characters from which a text is cut
SNAP = 256  # characters before a cut in which a position that no piece stands across is looked for
EXACT = 480  # characters whose scores add up exactly in single precision
FAN = 32  # chunks that one node of the tree combines
SPACE, MASK = "▁", "￿"
UNKNOWN = -1e6  # of a character that has no piece; never on a path between other characters
UNRANKED = -1e9  # score of pieces without a rank in the file

# Protocol-buffer fields appended to a model: model type 1 (unigram), no blank added in front.
AS_UNIGRAM = b"\x12\x02\x18\x01" + b"\x1a\x02\x18\x00"

Item = str | list[int]  # a stretch for the library, or identifiers


def read_model(path: str = MODEL) -> bytes:
    """A model file as a unigram model without unranked pieces."""
    with open(path, "rb") as file:
        model = file.read() + AS_UNIGRAM
    found = sentencepiece.SentencePieceProcessor(model_proto=model)
    ranks = [found.get_score(i) for i in range(found.get_piece_size())]
    after = min(r for r in ranks if r > UNRANKED) - 1
    return model.replace(struct.pack("<f", UNRANKED), struct.pack("<f", after))


class Vocabulary:
    """The pieces of a model."""

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = library.get_piece_size()
        self.scores = np.array([library.get_score(i) for i in range(size)])
        self.ids: dict[str, int] = {}
        self.byte = [0] * 256
        self.raw = [b""] * size
        for i in range(size):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value], self.raw[i] = i, bytes([value])
            elif not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i)):
                self.ids[piece] = i
                self.raw[i] = piece.replace(SPACE, " ").encode()
        self.longest = max(map(len, self.ids))
        self.starts = {p[:n] for p in self.ids for n in range(1, len(p) + 1)}
        self.pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        single = "".join(sorted(c for c in self.ids if len(c) == 1))
        self.runs = re.compile(f"[{re.escape(single)}]+|[^{re.escape(single)}]+")
        blank_inside = any(p[1] == SPACE and p[0] != SPACE for p in self.pairs)
        stop = r"\Z" if blank_inside else rf"(?:(?<!{SPACE})(?={SPACE})|\Z)"
        self.stretch = re.compile(rf".{{1,{EXACT}}}{stop}|.+?{stop}", re.DOTALL)
        self.singles = set(single)
        self.library = library

    def parts(self, text: str, at: int) -> bool:
        """Whether every segmentation passes the position `at`."""
        return at <= 0 or at >= len(text) or text[at - 1:at + 1] not in self.pairs


def normal(text: str) -> str:
    """The text as the lattice sees it: blanks as a piece's mark, that mark itself as unknown."""
    return SPACE + text.replace(SPACE, MASK).replace(" ", SPACE)


def best_paths(voc: Vocabulary, text: str, start: int, stop: int, end: int) -> tuple[dict[int, float], dict[int, int]]:
    """Best scores from `start` of all positions up to `end`, by pieces that begin before `stop`."""
    best, back = {start: 0.0}, {}
    for i in range(start, stop):
        if (here := best.get(i)) is None:
            continue
        for n in range(1, min(voc.longest, end - i) + 1):
            piece = text[i:i + n]
            if piece not in voc.starts:
                if n == 1 and best.get(i + 1, -np.inf) < here + UNKNOWN:
                    best[i + 1], back[i + 1] = here + UNKNOWN, i
                break
            found = voc.ids.get(piece)
            score = here + (voc.scores[found] if found is not None else UNKNOWN) if found is not None or n == 1 else None
            if score is not None and best.get(i + n, -np.inf) < score:
                best[i + n], back[i + n] = score, i
    return best, back


def spelled(voc: Vocabulary, text: str) -> list[int]:
    """Byte pieces of characters without a piece of their own."""
    return [voc.byte[b] for b in text.replace(MASK, SPACE).encode("utf-8", "surrogatepass")]


def searched(voc: Vocabulary, text: str) -> list[int]:
    """The best segmentation by the plain search, for any text."""
    _, back = best_paths(voc, text, 0, len(text), len(text))
    ids, at = [], len(text)
    while at:
        piece = text[back[at]:at]
        ids.append([voc.ids[piece]] if piece in voc.ids else spelled(voc, piece))
        at = back[at]
    return [i for part in reversed(ids) for i in part]


def plan(voc: Vocabulary, text: str, source: str | None = None) -> list[Item]:
    """What to do with a normal text whose two ends are fixed, in order.

    `source` is the original text where it holds the mask character itself.
    """
    items: list[Item] = []
    for run in voc.runs.finditer(text):
        if run[0][0] not in voc.singles:
            if any(c in voc.starts for c in run[0]):
                return [searched(voc, text)]  # characters that only longer pieces hold
            if MASK in run[0] and source is not None:
                own = source[run.start():run.end()]
                items.append([voc.byte[b] for b in own.encode("utf-8", "surrogatepass")])
            else:
                items.append(spelled(voc, run[0]))
            continue
        for stretch in voc.stretch.finditer(run[0]):
            items.append(stretch[0] if len(stretch[0]) <= EXACT else searched(voc, stretch[0]))
    return items


def encode_all(voc: Vocabulary, plans: list[list[Item]]) -> list[np.ndarray]:
    """Identifiers of each plan, with one call to the library."""
    stretches = [item for items in plans for item in items if isinstance(item, str)]
    done = iter(voc.library.encode(stretches, num_threads=1) if stretches else [])
    return [np.array([i for item in items for i in (next(done) if isinstance(item, str) else item)], np.int32)
            for items in plans]


def source_of(text: str) -> str | None:
    """The original beside its normal form, where the two masks would be confused."""
    return " " + text if MASK in text else None


def decode_ids(voc: Vocabulary, ids, first: bool = True) -> bytes:
    """The UTF-8 text of identifiers; `first` drops the blank that encoding put in front."""
    raw = b"".join([voc.raw[i] for i in ids])
    return raw[1:] if first else raw


def cuts(voc: Vocabulary, text: str) -> list[int]:
    """Where a normal text is cut: near equal chunks, moved back to a position all segmentations pass."""
    n = max(1, round(len(text) / CHUNK))
    found = [0]
    for k in range(1, n):
        at = len(text) * k // n
        found.append(next((p for p in range(at, at - SNAP, -1) if voc.parts(text, p)), at))
    return [*found, len(text)]


Cell = tuple[int, int, float, int]  # entering state, leaving state, score, rank of the entering state


def boundaries(back: dict[int, int], at: int) -> list[int]:
    """The boundaries of a path that ends at `at`, from its end to its start."""
    found = [at]
    while at in back:
        at = back[at]
        found.append(at)
    return found


def ranks(paths: dict[int, list[int]]) -> dict[int, int]:
    """The order in which paths to one end, by entering state, win ties."""
    return {s: k for k, s in enumerate(sorted(paths, key=paths.get))}


def transfer(voc: Vocabulary, text: str, length: int) -> list[Cell]:
    """The matrix of a chunk as (entering state, leaving state, score, rank).

    `text` is the chunk with one character before (none at the start of a text: `\0`) and up to
    `longest` characters after it, so that its ends can be judged.
    """
    before, text = text[0], text[1:]
    left = 0 if before == "\0" or before + text[:1] not in voc.pairs else voc.longest - 1
    last = length >= len(text)
    right = last or voc.parts(text, length)
    meet = next((p for p in range(left, length + 1) if voc.parts(text, p) and p >= left), None)
    part = length if right else next((p for p in range(length, -1, -1) if voc.parts(text, p)), None)
    entries = range(left + 1)
    if meet is None or part is None or meet > part or (left and meet == 0):
        found = {s: best_paths(voc, text, s, length, len(text)) for s in entries}
        cells = []
        for t in [0] if right else range(voc.longest):
            ends = {s: boundaries(back, length + t) for s, (best, back) in found.items() if length + t in best}
            rank = ranks(ends)
            cells += [(s, t, float(found[s][0][length + t]), rank[s]) for s in ends]
        return cells
    heads = {s: best_paths(voc, text, s, meet, meet) for s in entries if s <= meet}
    heads = {s: (best[meet], boundaries(back, meet)) for s, (best, back) in heads.items() if meet in best}
    rank = ranks({s: path for s, (_, path) in heads.items()})
    body = score_of(voc, text[meet:part])
    tail = {0: 0.0} if part == length else {
        p - length: v for p, v in best_paths(voc, text, part, length, len(text))[0].items() if p >= length}
    return [(s, t, float(a + body + b), rank[s]) for s, (a, _) in heads.items() for t, b in tail.items()]


def score_of(voc: Vocabulary, text: str) -> float:
    """The best sum of scores of a normal text with fixed ends."""
    total = 0.0
    for item, ids in zip(items := plan(voc, text), encode_all(voc, [[i] for i in items])):
        total += float(voc.scores[ids].sum())
    return total + UNKNOWN * sum(len(r[0]) for r in voc.runs.finditer(text) if r[0][0] not in voc.singles)


def product(cells: list[list[Cell]]) -> list[Cell]:
    """Max-plus product of matrices in order."""
    total = {(s, t): (v, r) for s, t, v, r in cells[0]}
    for matrix in cells[1:]:
        by_entry: dict[int, list[tuple[int, float, int]]] = {}
        for s, t, v, r in matrix:
            by_entry.setdefault(s, []).append((t, v, r))
        joined: dict[tuple[int, int], tuple[float, tuple[int, int]]] = {}
        for (s, m), (v, r) in total.items():
            for t, w, q in by_entry.get(m, ()):
                # The later matrix decides a tie first, as paths are compared from their end.
                if (s, t) not in joined or (joined[s, t][0], (q, r)) < (v + w, joined[s, t][1]):
                    joined[s, t] = v + w, (q, r)
        by_exit: dict[int, dict[int, tuple[int, int]]] = {}
        for (s, t), (_, key) in joined.items():
            by_exit.setdefault(t, {})[s] = key
        rank = {t: ranks(keys) for t, keys in by_exit.items()}
        total = {(s, t): (v, rank[t][s]) for (s, t), (v, _) in joined.items()}
    return [(s, t, v, r) for (s, t), (v, r) in sorted(total.items())]


def route(cells: list[list[Cell]], enter: int, leave: int) -> list[int]:
    """The states at the boundaries between matrices on the best way from one state to another."""
    forward: list[dict[int, tuple[float, int, int]]] = [{enter: (0.0, 0, -1)}]
    for matrix in cells:
        step: dict[int, tuple[float, int, int]] = {}  # score, minus rank, entering state
        for s, t, v, r in matrix:
            if s in forward[-1]:
                step[t] = max(step.get(t, (-np.inf, 0, -1)), (forward[-1][s][0] + v, -r, s))
        forward.append(step)
    states = [leave]
    for step in reversed(forward[1:]):
        states.append(step[states[-1]][2])
    return states[::-1]


CELLS = "array<struct<s: int, t: int, v: double, r: int>>"


def _cells(value) -> list[Cell]:
    return [(c["s"], c["t"], c["v"], c["r"]) for c in value]


def _encoded_small(docs: DataFrame, held, kind: str) -> DataFrame:
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        voc = Vocabulary(held.value)
        for frame in frames:
            texts = [t if isinstance(t, str) else "" for t in frame["text"]]
            ids_col, start, size = frame["doc_id"].to_numpy(), 0, 0
            for i, text in enumerate(texts):
                size += len(text)
                if size < BATCH_BYTES and i < len(texts) - 1:
                    continue
                part = texts[start:i + 1]
                ids = encode_all(voc, [plan(voc, normal(t), source_of(t)) if t else [] for t in part])
                same = [not t or decode_ids(voc, e) == t.encode("utf-8", "surrogatepass") for t, e in zip(part, ids)]
                yield pd.DataFrame({"doc_id": ids_col[start:i + 1], "ids": ids, "round_trip": same})
                start, size = i + 1, 0

    return docs.mapInPandas(work, f"doc_id {kind}, ids array<int>, round_trip boolean")


def _chunks(texts: DataFrame, held) -> DataFrame:
    """key, k, text, length of the chunks of texts (key, text)."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        voc = Vocabulary(held.value)
        for frame in frames:
            for key, raw in zip(frame["key"], frame["text"]):
                text, source = normal(raw), source_of(raw)
                at = cuts(voc, text)
                for k, (a, b) in enumerate(zip(at, at[1:])):
                    seen = slice(max(a - 1, 0), b + voc.longest)
                    edge = "" if a else "\0"
                    yield pd.DataFrame({"key": [key], "k": [k], "text": [edge + text[seen]], "length": [b - a],
                                        "source": [None if source is None else edge + source[seen]]})

    return texts.mapInPandas(work, "key string, k long, text string, length long, source string")


def _matrices(chunks: DataFrame, held) -> DataFrame:
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        voc = Vocabulary(held.value)
        for frame in frames:
            yield pd.DataFrame({"key": frame["key"], "k": frame["k"], "cells": [
                transfer(voc, t, n) for t, n in zip(frame["text"], frame["length"])]})

    return chunks.mapInPandas(work, f"key string, k long, cells {CELLS}")


def _states(matrices: DataFrame, chunks_of_largest: int) -> DataFrame:
    """key, k, enter, leave of every chunk on its text's best path."""

    def up(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        return pd.DataFrame({"key": rows["key"].iloc[:1], "k": rows["k"].iloc[:1] // FAN,
                             "cells": [product([_cells(c) for c in rows["cells"]])]})

    def down(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("k")
        states = route([_cells(c) for c in rows["cells"]], int(rows["enter"].iloc[0]), int(rows["leave"].iloc[0]))
        return pd.DataFrame({"key": rows["key"], "k": rows["k"], "enter": states[:-1], "leave": states[1:]})

    block = F.expr(f"k div {FAN}L").alias("block")
    levels, width = [matrices], chunks_of_largest
    while width > 1:
        levels.append(settle(levels[-1].groupBy("key", block).applyInPandas(up, f"key string, k long, cells {CELLS}")))
        width = -(-width // FAN)
    zero = F.lit(0).cast("int")
    states = levels[-1].select("key", "k", zero.alias("enter"), zero.alias("leave"))
    for level in levels[-2::-1]:
        parents = states.withColumnRenamed("k", "block")
        inside = level.withColumn("block", block).join(parents, ["key", "block"])
        states = inside.groupBy("key", "block").applyInPandas(down, "key string, k long, enter int, leave int")
    return states


def _encoded_chunks(chunks: DataFrame, held) -> DataFrame:
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        voc = Vocabulary(held.value)
        for frame in frames:
            for row in frame.itertuples():
                a, b = 1 + row.enter, 1 + row.length + row.leave
                text = row.text[a:b]
                source = row.source[a:b] if isinstance(row.source, str) else None
                ids = encode_all(voc, [plan(voc, text, source)])[0]
                raw = source or text.replace(SPACE, " ").replace(MASK, SPACE)
                good = decode_ids(voc, ids, False) == raw.encode("utf-8", "surrogatepass")
                yield pd.DataFrame({"key": [row.key], "k": [row.k], "ids": [ids], "good": [good]})

    return chunks.mapInPandas(work, "key string, k long, ids array<int>, good boolean")


def encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text",
           giant: int = GIANT) -> DataFrame:
    """doc_id, ids, round_trip: the encoding of every whole text, and whether decoding gives it back.

    A null or empty text has no identifiers. Texts above `giant` characters are encoded once for all
    equal ones, in chunks over all tasks. Repeated rows and ids are encoded each, an empty table gives no
    rows, other columns of docs are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(read_model(model))  # half a megabyte
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    long = F.coalesce(F.length("text"), F.lit(0)) > giant
    small = _encoded_small(narrow.filter(~long), held, kind)
    large = narrow.filter(long).withColumn("key", F.md5("text"))
    distinct = large.groupBy("key").agg(F.first("text").alias("text"))
    chunks = settle(_chunks(distinct, held).repartition("key", "k"))
    matrices = settle(_matrices(chunks, held))
    largest = matrices.agg(F.max("k")).first()[0]
    if largest is None:
        return small
    states = _states(matrices, largest + 1)
    done = _encoded_chunks(chunks.join(states, ["key", "k"]), held).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"), F.min("good").alias("round_trip"))
    whole = done.select("key", F.flatten(F.col("parts.ids")).alias("ids"), "round_trip")
    return small.unionByName(large.select("doc_id", "key").join(whole, "key").select("doc_id", "ids", "round_trip"))


def decode(rows: DataFrame, model: str = MODEL, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """Add the text of a column of identifiers; null stays null. Bytes that are no UTF-8 become U+FFFD."""
    held = rows.sparkSession.sparkContext.broadcast(read_model(model))

    @F.pandas_udf("string")
    def text_of(column: pd.Series) -> pd.Series:
        voc = Vocabulary(held.value)
        return column.map(lambda ids: None if ids is None else decode_ids(voc, ids).decode("utf-8", "replace"))

    return rows.withColumn(out, text_of(F.col(ids_col)))

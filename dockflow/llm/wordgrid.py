"""Words of many texts at once, as arrays: positions and hashes, without a Python step per word."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

STEP = np.uint64(0x9E3779B97F4A7C15)
LONG_SPAN = 256  # bytes from which a span is hashed on its own
BATCH_BYTES = 1_000_000

_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~_space  # bytes of [^\x20\x09-\x0D]+ in UTF-8

ALNUM = np.ones(256, bool)  # bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ in UTF-8
for low, high in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    ALNUM[low:high + 1] = False


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def as_bytes(texts: pd.Series) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


def batches(frame: pd.DataFrame, column: str) -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    """Parts of a frame with about BATCH_BYTES of text each, so that arrays per byte stay small."""
    texts = as_bytes(frame[column])
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= BATCH_BYTES or i == len(texts) - 1:
            yield frame.iloc[start:i + 1], texts[start:i + 1]
            start, size = i + 1, 0


def slices(rows: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """As `batches`, for Arrow rows, which keep every type and null."""
    texts = [t or b"" for t in rows.column(column).cast(pa.binary()).to_pylist()]
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= BATCH_BYTES or i == len(texts) - 1:
            yield rows.slice(start, i + 1 - start), texts[start:i + 1]
            start, size = i + 1, 0


class Words:
    """The words of some texts: `start`, `end` (bytes in `buffer`), `text` (index), `hash`."""

    def __init__(self, texts: list[bytes], is_word: np.ndarray):
        joined = b"\n".join(texts) + b"\n"
        self.buffer = np.frombuffer(joined, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.text_start = np.concatenate([[0], np.cumsum(lengths)])
        inside = is_word[self.buffer]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        self.start, self.end = edge[0::2], edge[1::2]
        self.text = np.searchsorted(self.text_start, self.start, side="right") - 1
        self.first = np.searchsorted(self.start, self.text_start)  # first word of each text, then the total

    @property
    def hash(self) -> np.ndarray:
        """64-bit hash of each word."""
        return span_hash(self.buffer, self.start, self.end)

    @property
    def id(self) -> np.ndarray:
        """A number of each word, the same for the same bytes and for no others."""
        return span_ids(self.buffer, self.start, self.end)

    def digests(self, is_word: np.ndarray) -> list[bytes]:
        """Digest of each text's words: of their bytes, with one blank after each."""
        inside = is_word[self.buffer]
        kept = inside | np.concatenate([[False], inside[:-1]])
        words = np.where(inside, self.buffer, np.uint8(0x20))[kept].tobytes()
        at = np.concatenate([[0], np.cumsum(kept)])[self.text_start]
        return [hashlib.blake2b(words[a:b], digest_size=16).digest() for a, b in zip(at[:-1], at[1:])]


def span_hash(buffer: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges of a buffer, equal for equal bytes: each eight bytes are mixed into what came before."""
    blocks = np.ndarray(len(buffer), "<u8", np.concatenate([buffer, np.zeros(8, np.uint8)]).tobytes(), strides=(1,))
    size = end - start
    h = mix(size.astype(np.uint64) * STEP + np.uint64(1))
    open_ = np.flatnonzero(size < LONG_SPAN)
    for at in range(0, LONG_SPAN, 8):
        open_ = open_[size[open_] > at]
        if not len(open_):
            break
        block = blocks[start[open_] + at]
        beyond = np.maximum(8 * (at + 8 - size[open_]), 0).astype(np.uint64)
        h[open_] = mix(h[open_] * STEP + ((block << beyond) >> beyond))
    for i in np.flatnonzero(size >= LONG_SPAN):
        h[i] = np.frombuffer(hashlib.blake2b(buffer[start[i]:end[i]], digest_size=8).digest(), np.uint64)[0]
    return h


def span_ids(buffer: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Numbers of byte ranges, the same for the same bytes and for no others: equal hashes are compared byte by byte."""
    _, first, ids = np.unique(span_hash(buffer, start, end), return_index=True, return_inverse=True)
    other = first[ids]
    again = np.flatnonzero(other != np.arange(len(ids)))
    size = end[again] - start[again]
    if (size == end[other[again]] - start[other[again]]).all():
        for part in np.array_split(again, 1 + int(size.sum()) // BATCH_BYTES):
            size = end[part] - start[part]
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            if (buffer[np.repeat(start[part], size) + place] != buffer[np.repeat(start[other[part]], size) + place]).any():
                break
        else:
            return ids
    known: dict[bytes, int] = {}  # two ranges with one hash
    return np.array([known.setdefault(buffer[a:b].tobytes(), len(known)) for a, b in zip(start, end)], np.int64)


def count_before(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of a boolean or number array between consecutive bounds."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]

"""Alignment of two tokenizers' tokens over the bytes of a text, as an Arrow pipeline.

A task cuts its texts into parts at single blanks, which no token of either tokenizer spans, and fills blocks of BLOCK bytes with
whole documents (a longer document is a run of blocks of its own). What lies between single blanks is encoded once a block. The tokens of a block are two list arrays. Flattened with
their parents, a cumulative sum of their byte lengths, less the sum before each part, is where they end. A full outer hash join on
(part, end) gives every stretch of bytes that one pair of tokens shares: its keys are the ends of either side, and the
tokens over a stretch are the next ones that end. Ends of both sides close a group.

Id pairs are counted per block with a group-by; Spark adds the counts up, marks each B id's highest ones, and joins
the totals back to the blocks' distinct pairs, which are far fewer than links. Documents refer to the pairs
of their block by number, so they meet their counts block by block and no link is ever shuffled.
"""

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dockflow.llm.common import settle

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
PART = 8_192  # characters after which a part ends at the next single blank
BLOCK = 2_000_000  # bytes of text of a block
SINGLE_BLANK = re.compile(r"(?<=\S) (?=\S)")
SHIFT = 32  # bits of an end within its part


def byte_alphabet() -> dict[str, int]:
    """The letters of byte-level vocabularies: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def byte_tokens(model: str) -> list[bytes]:
    """Bytes of each id of a byte-level model."""
    found = tokenizers.Tokenizer.from_str(model)
    added = {t["id"]: t["content"] for t in json.loads(model).get("added_tokens", [])}
    letters = byte_alphabet()
    return [added[i].encode() if i in added else bytes(letters[c] for c in found.id_to_token(i)) for i in range(found.get_vocab_size())]


def piece_tokens(model: bytes) -> list[bytes]:
    """Bytes of each id of a piece model."""
    found = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [found.id_to_piece(i) for i in range(found.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if found.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]


def parts_of(text: str) -> list[str]:
    """The text cut at single blanks, which are left out: a blank before each part gives a blank and the text."""
    parts, start = [], 0
    while len(text) - start > PART and (cut := SINGLE_BLANK.search(text, start + PART)):
        parts.append(text[start:cut.start()])
        start = cut.end()
    return [*parts, text[start:]]


class Side:
    """One tokenizer: the bytes, byte lengths and decimal names of its ids."""

    def __init__(self, raw: list[bytes]):
        self.raw = pa.array(raw, pa.binary())
        self.lengths = pc.binary_length(self.raw).cast(pa.int64())
        self.names = pa.array(map(str, range(len(raw))), pa.string())


def lists(ids: list[list[int]]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
    flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32, offsets[-1])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))


def regrouped(ids: pa.ListArray, which: np.ndarray, starts: np.ndarray) -> pa.ListArray:
    """One list for each run of chosen lists; run i begins at starts[i]."""
    chosen = ids.take(pa.array(which))
    return pa.ListArray.from_arrays(chosen.offsets.take(pa.array(starts)), chosen.values)


def spelled(side: Side, tokens: pa.ListArray) -> pa.Array:
    """The joined bytes of each list of ids."""
    return pc.binary_join(pa.ListArray.from_arrays(tokens.offsets, side.raw.take(tokens.values)), b"")


def token_ends(side: Side, tokens: pa.ListArray) -> pa.Table:
    """key, id of each token; the key is its part and where it ends in it."""
    ids, parent = pc.list_flatten(tokens), pc.list_parent_indices(tokens).cast(pa.int64())
    total = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(side.lengths.take(ids))])
    before = total.take(tokens.offsets.slice(0, len(tokens)))
    end = pc.subtract(total.slice(1), before.take(parent))
    return pa.table({"key": pc.add(pc.shift_left(parent, SHIFT), end), "id": ids})


def grouped(names: pa.Array, ids: pa.Array, shared: pa.Array) -> pa.Array:
    """Comma-joined names of the ids of each group; a shared end closes one."""
    closes = pc.add(pc.indices_nonzero(shared), 1).cast(pa.int32())
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), closes])
    return pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(ids)), ",")


def ragged(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


class Aligned:
    """One block: its links and groups by part."""

    def __init__(self, a: Side, b: Side, a_tokens: pa.ListArray, b_tokens: pa.ListArray):
        ends = token_ends(a, a_tokens).rename_columns(["key", "a"]).join(
            token_ends(b, b_tokens).rename_columns(["key", "b"]), "key", join_type="full outer", use_threads=False)
        ends = ends.take(pc.sort_indices(ends["key"])).combine_chunks()
        a_id, b_id = ends["a"].combine_chunks(), ends["b"].combine_chunks()
        shared = pc.and_(a_id.is_valid(), b_id.is_valid())
        part = pc.shift_right(ends["key"].combine_chunks(), SHIFT)
        self.n = len(a_tokens)
        self.n_a, self.n_b = (pc.list_value_length(t).to_numpy(zero_copy_only=False) for t in (a_tokens, b_tokens))
        self.n_groups = np.bincount(part.filter(shared).to_numpy(), minlength=self.n)
        self.n_links = np.bincount(part.to_numpy(), minlength=self.n)
        self.links = pa.table({"part": part, "a": pc.fill_null_backward(a_id), "b": pc.fill_null_backward(b_id)})
        groups = pc.binary_join_element_wise(
            grouped(a.names, a_id.drop_null(), shared.filter(a_id.is_valid())),
            grouped(b.names, b_id.drop_null(), shared.filter(b_id.is_valid())), "|")
        self.groups = pc.binary_join(ragged(self.n_groups, groups), ";")

    def pairs(self) -> pa.Table:
        """number, a, b, n: the distinct id pairs and how many links hold them."""
        counted = self.links.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
        return pa.table({"number": pa.array(np.arange(counted.num_rows, dtype=np.int32)), "a": counted["a"], "b": counted["b"],
                         "n": counted["count_all"]})

    def by_document(self, document: np.ndarray, pairs: pa.Table) -> tuple[pa.ListArray, pa.ListArray]:
        """Numbers of each document's pairs, and how often it has them; `document` holds the place of each part's document."""
        own = self.links.set_column(0, "document", pa.array(document).take(self.links["part"]))
        counted = own.group_by(["document", "a", "b"], use_threads=False).aggregate([([], "count_all")]).join(
            pairs.select(["number", "a", "b"]), ["a", "b"], join_type="inner", use_threads=False)
        counted = counted.take(pc.sort_indices(counted, [("document", "ascending"), ("number", "ascending")])).combine_chunks()
        sizes = np.bincount(counted["document"].to_numpy(), minlength=int(document.max()) + 1)
        return ragged(sizes, counted["number"].combine_chunks()), ragged(sizes, counted["count_all"].combine_chunks())


SUMS = ["n_a", "n_b", "n_groups", "n_links"]


def out_schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("block", pa.int64()), ("number", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()),
                      ("row", pa.int64()), ("doc_id", kind), *[(c, pa.int64()) for c in SUMS], ("groups_sha256", pa.string()),
                      ("groups", pa.string()), ("numbers", pa.list_(pa.int32())), ("times", pa.list_(pa.int64()))])


def out_ddl(kind: str) -> str:
    return (f"block long, number int, a int, b int, n long, row long, doc_id {kind}, " + ", ".join(f"{c} long" for c in SUMS)
            + ", groups_sha256 string, groups string, numbers array<int>, times array<long>")


def filled(schema: pa.Schema, rows: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """Columns that are not given are null."""
    arrays = [columns[f.name].combine_chunks() if isinstance(columns.get(f.name), pa.ChunkedArray) else columns.get(f.name)
              for f in schema]
    return pa.RecordBatch.from_arrays(
        [pa.nulls(rows, f.type) if x is None else x.cast(f.type) for f, x in zip(schema, arrays)], schema=schema)


class Task:
    """Turns the documents of a task into pairs and fragments of documents, block by block."""

    def __init__(self, byte_model: str, piece_model: bytes, sides: tuple[Side, Side], kind: pa.DataType, keep_groups: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.byte_bpe = tokenizers.Tokenizer.from_str(byte_model)
        self.byte_bpe.encode_special_tokens = True
        self.piece_bpe = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        (self.a, self.b), self.schema, self.keep_groups = sides, out_schema(kind), keep_groups
        self.block = self.row = 0

    def encoded(self, parts: list[str]) -> tuple[pa.ListArray, pa.ListArray, np.ndarray]:
        """Ids of both sides, and whether both give the part's bytes back; what single blanks part is encoded once a block."""
        pieces = [SINGLE_BLANK.split(p) for p in parts]
        place: dict[str, int] = {}
        which = np.fromiter((place.setdefault(x, len(place)) for own in pieces for x in own), np.int64)
        starts = np.concatenate([[0], np.cumsum([len(own) for own in pieces])])
        unlike = list(place)
        with_blank = [" " + x for x in unlike]
        a = lists([e.ids for e in self.byte_bpe.encode_batch_fast(with_blank, add_special_tokens=False)])
        b = lists(self.piece_bpe.encode(unlike, num_threads=1))
        raw = pa.array([x.encode() for x in with_blank], pa.binary())
        same = pc.and_(pc.equal(spelled(self.a, a), raw), pc.equal(spelled(self.b, b), raw)).to_numpy(zero_copy_only=False)
        return regrouped(a, which, starts), regrouped(b, which, starts), np.logical_and.reduceat(same[which], starts[:-1])

    def work(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            self.block = self.block or batch.column(0)[0].as_py() << 32 if batch.num_rows else self.block
            self.row = self.row or self.block
            for i, text in enumerate(batch.column(2).to_pylist()):
                ids.append(batch.column(1).slice(i, 1))
                texts.append(text or "")
                size += len(texts[-1])
                if size >= BLOCK:
                    yield from self.documents(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield from self.documents(ids, texts)

    def documents(self, ids: list[pa.Array], texts: list[str]) -> Iterator[pa.RecordBatch]:
        """Encode documents BLOCK by BLOCK; one that does not come back whole has no tokens."""
        parts, owner = [], []
        for i, text in enumerate(texts):
            own = parts_of(text) if text else []
            parts += own
            owner += [i] * len(own)
        owner_of = np.array(owner, np.int64)
        cuts = np.searchsorted(np.cumsum([len(p) for p in parts]), np.arange(BLOCK, sum(map(len, parts)) + BLOCK, BLOCK))
        stretches = [(lo, hi) for lo, hi in itertools.pairwise(sorted({0, *map(int, cuts), len(parts)})) if hi > lo]
        encoded = [self.encoded(parts[lo:hi]) for lo, hi in stretches]
        whole = np.array([bool(t) for t in texts])
        for (lo, hi), (_, _, same) in zip(stretches, encoded):
            whole[owner_of[lo:hi][~same]] = False
        rows = np.arange(self.row, self.row + len(texts))
        self.row += len(texts)
        names = pa.concat_arrays(ids)
        if not whole.all():
            none = pa.array(np.flatnonzero(~whole))
            zero = pa.array(np.zeros(len(none), np.int64))
            yield filled(self.schema, len(none), {"row": pa.array(rows).take(none), "doc_id": names.take(none), **dict.fromkeys(SUMS, zero),
                                                  "groups_sha256": pa.array([""] * len(none)), "groups": pa.array([""] * len(none))})
        digests: dict[int, object] = {}
        for (lo, hi), (a, b, _) in zip(stretches, encoded):
            chosen = np.flatnonzero(whole[owner_of[lo:hi]])
            if len(chosen):
                where = pa.array(chosen)
                yield from self.block_rows(a.take(where), b.take(where), owner_of[lo:hi][chosen], owner_of[hi] if hi < len(parts) else -1,
                                           rows, names, digests)

    def block_rows(self, a: pa.ListArray, b: pa.ListArray, owner: np.ndarray, next_owner: int, rows: np.ndarray, names: pa.Array,
                   digests: dict) -> Iterator[pa.RecordBatch]:
        """The pairs of a block and the fragments of its documents; the fragment that ends a document has its digest."""
        block = Aligned(self.a, self.b, a, b)
        documents, first, document = np.unique(owner, return_index=True, return_inverse=True)
        pairs = block.pairs()
        numbers, times = block.by_document(document.astype(np.int64), pairs)
        shas: list[str | None] = []
        spoken: list[str] = []
        texts = block.groups.to_pylist()
        for d, lo, hi in zip(documents, first, [*first[1:], len(owner)]):
            said = ";".join(texts[lo:hi])
            begun = digests.pop(int(d), None)
            digest = begun or hashlib.sha256()
            digest.update((";" if begun else "").encode() + said.encode())
            if d == next_owner:
                digests[int(d)] = digest
            shas.append(None if d == next_owner else digest.hexdigest())
            spoken.append(said)
        number = pa.array(np.full(pairs.num_rows, self.block))
        yield filled(self.schema, pairs.num_rows, {"block": number, **{c: pairs[c] for c in pairs.column_names}})
        where = pa.array(documents)
        sums = {c: pa.array(np.add.reduceat(getattr(block, c).astype(np.int64), first)) for c in SUMS}
        yield filled(self.schema, len(documents), {
            "block": pa.array(np.full(len(documents), self.block)), "row": pa.array(rows).take(where), "doc_id": names.take(where), **sums,
            "groups_sha256": pa.array(shas, pa.string()), "numbers": numbers, "times": times,
            **({"groups": pa.array(spoken, pa.string())} if self.keep_groups else {})})
        self.block += 1


def summed(left: pa.Table, right: pa.Table, schema: pa.Schema) -> pa.Table:
    """A block's fragments with the corpus counts of their links; right: number, total, best of its pairs."""
    order = right.sort_by("number")
    total, best = order["total"].to_numpy(), order["best"].to_numpy()
    numbers, times = (pc.list_flatten(left[c].combine_chunks()).to_numpy() for c in ("numbers", "times"))
    parent = pc.list_parent_indices(left["numbers"].combine_chunks()).to_numpy()

    def by_fragment(values: np.ndarray) -> np.ndarray:
        out = np.zeros(left.num_rows, np.int64)
        np.add.at(out, parent, values)
        return out

    sums = {"n_best": by_fragment(times * best[numbers]), "count_sum": by_fragment(times * total[numbers])}
    return pa.table({f.name: pa.array(sums[f.name]) if f.name in sums else left[f.name] for f in schema}, schema=schema)


def aligned_blocks(docs: DataFrame, id_col: str, text_col: str, byte_model: str, piece_model: str, keep_groups: bool) -> DataFrame:
    """Pairs of blocks and fragments of documents, in one settled table; see `out_ddl`."""
    with open(byte_model, encoding="utf-8") as file:
        bytes_json = file.read()
    with open(piece_model, "rb") as file:
        pieces = file.read()
    held = docs.sparkSession.sparkContext.broadcast(  # two vocabulary files
        (bytes_json, pieces, (Side(byte_tokens(bytes_json)), Side(piece_tokens(pieces)))))
    kind = to_arrow_type(docs.schema[id_col].dataType)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return Task(*held.value, kind, keep_groups).work(batches)

    rows = docs.select((F.spark_partition_id() + 1).cast("long").alias("part"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    return settle(rows.mapInArrow(work, out_ddl(docs.schema[id_col].dataType.simpleString())))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_model: str = BYTE_MODEL,
          piece_model: str = PIECE_MODEL) -> DataFrame:
    """Per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The tokens are those of a blank and the text. A link is a pair of tokens over common bytes, and the count of its id
    pair is the number of links of the corpus that hold it; n_best are the links with the highest count of their B id.
    Null and empty texts, and texts that either side does not give back byte for byte, have no tokens: zeros and
    an empty groups_sha256, and they add nothing to counts. Repeated rows and ids are rows of their own; an empty
    table gives none. Other columns are not read. A long text is cut into parts, a stretch without
    single blanks is one part however long; beside a text, its ids and one block's arrays are in memory.
    """
    found = aligned_blocks(docs, id_col, text_col, byte_model, piece_model, False)
    pairs = found.filter("a is not null").select("block", "number", "a", "b", "n")
    counted = pairs.groupBy("a", "b").agg(F.sum("n").alias("total"))
    highest = F.max("total").over(Window.partitionBy("b"))  # a row for each A id at most
    rated = counted.withColumn("best", F.col("total") == highest)
    totals = pairs.join(rated, ["a", "b"]).select(F.col("block").alias("of_block"), "number", "total", "best")
    fragments = found.filter("row is not null").select("block", "row", "doc_id", *SUMS, "groups_sha256", "numbers", "times")
    ddl = docs.schema[id_col].dataType.simpleString()
    columns = ["row", "doc_id", *SUMS, "groups_sha256", "n_best", "count_sum"]
    schema = pa.schema([("row", pa.int64()), ("doc_id", to_arrow_type(docs.schema[id_col].dataType)), *[(c, pa.int64()) for c in SUMS],
                        ("groups_sha256", pa.string()), ("n_best", pa.int64()), ("count_sum", pa.int64())])
    met = fragments.filter("block is not null").groupBy("block").cogroup(totals.groupBy("of_block")).applyInArrow(
        lambda left, right: summed(left, right, schema),
        f"row long, doc_id {ddl}, " + ", ".join(f"{c} long" for c in SUMS) + ", groups_sha256 string, n_best long, count_sum long")
    none = fragments.filter("block is null").select(
        *[F.lit(0).cast("long").alias(c) if c in ("n_best", "count_sum") else c for c in columns])
    sums = [F.sum(c).alias(c) for c in (*SUMS, "n_best", "count_sum")]
    return met.select(*columns).unionByName(none).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), *sums, F.max("groups_sha256").alias("groups_sha256")).drop("row")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_model: str = BYTE_MODEL,
           piece_model: str = PIECE_MODEL) -> DataFrame:
    """row, block, doc_id, groups: the groups of each document as `a1,a2|b1;a3|b2`, those of a giant one block by block."""
    found = aligned_blocks(docs, id_col, text_col, byte_model, piece_model, True)
    return found.filter("row is not null").select("row", "block", "doc_id", "groups")

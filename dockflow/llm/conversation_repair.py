"""Repair of damaged conversations by depth-first branch-and-bound.

A repaired conversation is nothing, or an optional system turn and then user and assistant by turns. Each row is kept,
given another role or deleted, and empty turns may be inserted; the cheapest edits are wanted, and of those the
ones whose initials (D, I, K, R) come first in ASCII order. The search keeps an explicit stack of prefixes and goes
to the child with the least bound first: its cost so far plus the cheapest completion in cost alone. A prefix
is cut when its bound exceeds the incumbent's (cost, audit), or when the table of its node, the rows read and the role
given last, already holds a better one. The search ends with an empty stack, which proves the incumbent.

Rows are put in order by one range exchange over (conversation, turn, role, text), so a conversation with many
rows lies in several tasks. One that begins and ends within a task is solved there. The others are cut into chunks
of CHUNK rows at most: repeated turns are found by aggregation, every chunk is searched from each entering to each leaving
role, and a left fold of those tables gives the roles at the cuts. Only the fold (a few bytes a row) and a
digest that is sequential by nature see a long conversation in one place, and both read it as a stream.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dockflow.llm.common import settle

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs of edits, and of a truncated row that stays
START, SYSTEM, USER, ASSISTANT = range(4)  # role given last
ROLE_NAMES = {USER: "user", ASSISTANT: "assistant"}
AFTER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # the role that an inserted or reroled turn takes
KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
OPEN = {START: (0, ""), ASSISTANT: (0, ""), USER: (INSERT, "I"), SYSTEM: (2 * INSERT, "II")}  # edits after the last row
LEGAL = {"su", "ua", "au"}
FINE, CUT, GONE = 0, 1, 2  # a row as it is; truncated; to be deleted
CHUNK = 1024  # rows of a chunk
CHUNK_BYTES = 4_000_000  # text of a chunk, but for a single longer row
BLANKS = " \t\n\x0b\f\r"
NEVER = 1 << 60

Row = tuple[str, int]  # initial of the role, and its fault


def damage(rows: DataFrame) -> DataFrame:
    """Conversation rows with faults put in by crc32 of `conv_id:turn` modulo 20, nulls as one space.

    0 drops a row, 1 empties its text, 2 removes `.`, `!` and `?`, 3 repeats it, 4 makes it the user's. A dropped row stays
    as one with a null role, which is how `repair` knows of conversations without rows.
    """
    text = F.coalesce(F.col("text"), F.lit(" "))
    role = F.coalesce(F.col("role"), F.lit(" "))
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    dealt = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("_dealt"))
    d = F.col("_dealt")
    hurt = dealt.select(
        "conv_id", "turn", F.when(d == 0, None).when(d == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(d == 0, None).when(d == 1, F.lit("")).when(d == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
            F.col("text")).alias("text"), F.when(d == 3, 2).otherwise(1).alias("_times"))
    return hurt.withColumn("_time", F.explode(F.sequence(F.lit(1), "_times"))).drop("_times", "_time")


# --- the search ---------------------------------------------------------------------
def suffix_bounds(rows: list[Row], ends: dict[int, tuple[int, str]]) -> list[list[int]]:
    """bounds[i][role]: least cost of finishing from row i on with that role given last."""
    after = [ends.get(q, (NEVER, ""))[0] for q in range(4)]
    bounds = [after]
    for initial, fault in reversed(rows):
        own = [DELETE + after[q] for q in range(4)]
        if fault != GONE:
            extra = TRUNCATED * (fault == CUT)
            for q in range(4):
                own[q] = min(own[q], REROLE + extra + after[AFTER[q]])
                if (kept := KEEPS.get((q, initial))) is not None:
                    own[q] = min(own[q], KEEP + extra + after[kept])
        user, assistant = own[USER], own[ASSISTANT]  # an insertion leads to one of these
        own[USER], own[ASSISTANT] = min(user, INSERT + assistant), min(assistant, INSERT + user)
        own[START], own[SYSTEM] = min(own[START], INSERT + own[USER]), min(own[SYSTEM], INSERT + own[USER])
        after = own
        bounds.append(after)
    bounds.reverse()
    return bounds


def search(rows: list[Row], start: int, ends: dict[int, tuple[int, str]]) -> tuple[int, str] | None:
    """Least (cost, audit) from a role to one of the ends, None if no edits lead there."""
    bounds, n = suffix_bounds(rows, ends), len(rows)
    best: tuple[int, str] | None = None
    tables: list[dict[int, tuple[int, str]]] = [{} for _ in range(n + 1)]  # dominance: by rows read, then role
    stack = [(0, start, 0, "")]
    while stack:
        i, role, cost, audit = stack.pop()
        if (bound := cost + bounds[i][role]) >= NEVER:
            continue
        if best is not None and (bound, audit) > (best[0], best[1][:len(audit)]):
            continue
        if (seen := tables[i].get(role)) is not None and seen <= (cost, audit):
            continue
        tables[i][role] = (cost, audit)
        if i == n:
            if role in ends:
                found = (cost + ends[role][0], audit + ends[role][1])
                best = found if best is None or found < best else best
            continue
        initial, fault = rows[i]
        children = [(i + 1, role, cost + DELETE, audit + "D"), (i, AFTER[role], cost + INSERT, audit + "I")]
        if fault != GONE:
            stays = cost + TRUNCATED * (fault == CUT)
            if (kept := KEEPS.get((role, initial))) is not None:
                children.append((i + 1, kept, stays + KEEP, audit + "K"))
            children.append((i + 1, AFTER[role], stays + REROLE, audit + "R"))
        children.sort(key=lambda c: (c[2] + bounds[c[0]][c[1]], c[3]), reverse=True)  # the least is popped first
        stack += children
    return best


def apply(audit: str, role: int, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Turns (role, text) that edits make of rows, after the given role."""
    turns, at = [], 0
    for edit in audit:
        if edit == "I":
            role = AFTER[role]
            turns.append((ROLE_NAMES[role], ""))
            continue
        name, text = rows[at]
        at += 1
        if edit == "K":
            role = KEEPS[role, name[:1]]
            turns.append((name, text))
        elif edit == "R":
            role = AFTER[role]
            turns.append((ROLE_NAMES[role], text))
    return turns


# --- conversations within a task -----------------------------------------------------
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
EDITS_DDL = ", ".join(f"{c} long" for c in COUNTS) + ", audit string, turns array<struct<role: string, text: string>>"
CHUNK_DDL = "part long, seq long, rows array<struct<turn: long, role: string, text: string, fault: int>>"
_turns = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_rows = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("fault", pa.int32())]))


def spacing(turns: list[int]) -> tuple[int | None, int | None, int]:
    """Least and largest turn and the number of distinct ones, of turns in order."""
    return (turns[0], turns[-1], 1 + sum(a != b for a, b in zip(turns, turns[1:]))) if turns else (None, None, 0)


def illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def solved(rows: list[tuple], known: dict) -> dict:
    """A whole conversation's counts, edits and turns from rows (turn, role, text, fault) in order."""
    seen, duplicate, marked = set(), 0, []
    for _, role, text, fault in rows:
        again = (role, text) in seen
        seen.add((role, text))
        duplicate += again and fault != GONE
        marked.append((role[:1], GONE if again else fault))
    key = tuple(marked)
    if key not in known:
        if len(known) > 20_000:
            known.clear()
        known[key] = search(marked, START, OPEN)
    cost, audit = known[key]
    low, high, distinct = spacing([r[0] for r in rows if r[0] is not None])
    return {"gaps": high - low + 1 - distinct if distinct else 0, "blank": sum(r[3] == GONE for r in rows),
            "duplicate": duplicate, "truncated": sum(f == CUT for _, f in marked),
            "illegal": illegal([m[0] for m in marked]), "cost": cost, "audit": audit,
            "turns": [{"role": r, "text": t} for r, t in apply(audit, START, [r[1:3] for r in rows])]}


def within_tasks(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Whole conversations with their edits; the first and last of a task, and long ones, as chunks of rows."""
    schema = pa.schema([("conv_id", kind), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("turns", _turns),
                        ("part", pa.int64()), ("seq", pa.int64()), ("rows", _rows)])
    known: dict = {}
    out: list[dict] = []
    rows: list[tuple] = []
    nothing, part, first, seq, size, written = object(), 0, True, 0, 0, 0
    current: object = nothing

    def as_chunk() -> dict:
        return {"conv_id": current, "part": part, "seq": seq,
                "rows": [dict(zip(("turn", "role", "text", "fault"), r)) for r in rows]}

    for batch in batches:
        for part_of, conv, turn, role, text, fault in zip(*[batch.column(i).to_pylist() for i in range(6)]):
            if current is nothing or conv != current:
                if current is not nothing:
                    out.append(as_chunk() if first or seq else {"conv_id": current, **solved(rows, known)})
                    first = False
                current, part, rows, seq, size = conv, part_of, [], 0, 0
            if role is None:
                continue
            if len(rows) >= CHUNK or (rows and size + len(text) > CHUNK_BYTES):
                out.append(as_chunk())
                rows, seq, size = [], seq + 1, 0
            rows.append((turn, role, text, fault))
            size, written = size + len(text), written + len(text)
            if written > 1_000_000 or len(out) >= 2_000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, written = [], 0
    if current is not nothing:
        out.append(as_chunk())
    yield pa.RecordBatch.from_pylist(out, schema)


# --- conversations over several tasks --------------------------------------------------
def table_of(rows: list[Row]) -> list[dict]:
    """Least (cost, audit) of a chunk from each role to each role."""
    cells = []
    for entering in range(4):
        for leaving in range(4):
            if (found := search(rows, entering, {leaving: (0, "")})) is not None:
                cells.append({"entering": entering, "leaving": leaving, "cost": found[0], "audit": found[1]})
    return cells


_cells = pa.list_(pa.struct([("entering", pa.int32()), ("leaving", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
CELLS_DDL = "array<struct<entering: int, leaving: int, cost: long, audit: string>>"
_facts = {"low": pa.int64(), "high": pa.int64(), "distinct": pa.int64(), "blank": pa.int64(), "duplicate": pa.int64(),
          "truncated": pa.int64(), "illegal": pa.int64(), "head": pa.string(), "tail": pa.string()}
FACTS_DDL = ", ".join(f"{c} {'string' if t == pa.string() else 'long'}" for c, t in _facts.items())


def tables(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Counts and table of each chunk from its narrow rows (turn, initial, fault) and the places of repeated ones."""
    schema = pa.schema([("conv_id", kind), ("part", pa.int64()), ("seq", pa.int64()), *_facts.items(), ("cells", _cells)])
    for batch in batches:
        out = []
        for record in batch.to_pylist():
            rows, again = record["rows"], set(record["again"] or [])
            faults = [GONE if i in again else r["fault"] for i, r in enumerate(rows)]
            low, high, distinct = spacing([r["turn"] for r in rows if r["turn"] is not None])
            initials = [r["initial"] for r in rows]
            out.append({"conv_id": record["conv_id"], "part": record["part"], "seq": record["seq"],
                        "low": low, "high": high, "distinct": distinct, "blank": sum(r["fault"] == GONE for r in rows),
                        "duplicate": sum(rows[i]["fault"] != GONE for i in again), "truncated": sum(f == CUT for f in faults),
                        "illegal": illegal(initials), "head": initials[0] if rows else None,
                        "tail": initials[-1] if rows else None, "cells": table_of(list(zip(initials, faults)))})
        yield pa.RecordBatch.from_pylist(out, schema)


class Fold:
    """Left fold of one conversation's chunks; of its tables only what may still win is kept."""

    def __init__(self):
        self.cost, self.rank = {START: 0}, {START: 0}
        self.chunks: list[tuple] = []  # part, seq, {leaving: (entering, audit)}
        self.low = self.high = self.tail = None
        self.sums = dict.fromkeys(("distinct", "blank", "duplicate", "truncated", "illegal"), 0)

    def add(self, chunk: dict) -> None:
        for name in self.sums:
            self.sums[name] += chunk[name]
        if chunk["low"] is not None:
            self.sums["distinct"] -= self.high is not None and self.high == chunk["low"]
            self.low = chunk["low"] if self.low is None else self.low
            self.high = chunk["high"]
        if chunk["head"] is not None:
            self.sums["illegal"] += self.tail is not None and self.tail + chunk["head"] not in LEGAL
            self.tail = chunk["tail"]
        # Prefixes of the same rows differ before either ends, so their order is that of the entering roles.
        won: dict[int, tuple] = {}
        for cell in chunk["cells"]:
            entering, leaving = cell["entering"], cell["leaving"]
            if entering in self.cost:
                offer = (self.cost[entering] + cell["cost"], self.rank[entering], cell["audit"], entering)
                won[leaving] = min(won.get(leaving, offer), offer)
        order = sorted(won, key=lambda q: won[q][1:3])
        self.cost, self.rank = {q: w[0] for q, w in won.items()}, {q: n for n, q in enumerate(order)}
        self.chunks.append((chunk["part"], chunk["seq"], {q: (w[3], w[2]) for q, w in won.items()}))

    def finish(self, conv) -> Iterator[dict]:
        """One record a chunk: its edits and entering role; the last has the conversation's counts and audit."""
        leaving = min(self.cost, key=lambda q: (self.cost[q] + OPEN[q][0], self.rank[q]))
        cost, suffix = self.cost[leaving] + OPEN[leaving][0], OPEN[leaving][1]
        edits, role = [], leaving
        for *_, back in reversed(self.chunks):
            role, audit = back[role]
            edits.append((role, audit))
        edits.reverse()
        edits[-1] = (edits[-1][0], edits[-1][1] + suffix)
        for at, ((part, seq, _), (role, audit)) in enumerate(zip(self.chunks, edits)):
            record = {"conv_id": conv, "part": part, "seq": seq, "piece": at, "entering": role, "edits": audit}
            if at == len(edits) - 1:
                gaps = self.high - self.low + 1 - self.sums["distinct"] if self.low is not None else 0
                counts = {c: self.sums[c] for c in COUNTS[1:-1]}
                record |= {"gaps": gaps, **counts, "cost": cost, "audit": "".join(a for _, a in edits)}
            yield record


def folded(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Fold chunks that come in order."""
    schema = pa.schema([("conv_id", kind), ("part", pa.int64()), ("seq", pa.int64()), ("piece", pa.int64()),
                        ("entering", pa.int32()), ("edits", pa.string()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string())])
    nothing = object()
    current, fold = nothing, Fold()
    for batch in batches:
        for chunk in batch.to_pylist():
            if current is nothing or chunk["conv_id"] != current:
                if current is not nothing:
                    yield pa.RecordBatch.from_pylist(list(fold.finish(current)), schema)
                current, fold = chunk["conv_id"], Fold()
            fold.add(chunk)
    if current is not nothing:
        yield pa.RecordBatch.from_pylist(list(fold.finish(current)), schema)


def edited(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Turns of each chunk."""
    schema = pa.schema([("conv_id", kind), ("piece", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()),
                        ("turns", _turns)])
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            turns = apply(r["edits"], r["entering"], [(row["role"], row["text"]) for row in r["rows"]])
            out.append({name: r[name] for name in schema.names[:-1]} | {
                "turns": [{"role": role, "text": text} for role, text in turns]})
        yield pa.RecordBatch.from_pylist(out, schema)


def streamed(function, kind: pa.DataType):
    """The function as mapInArrow takes it."""
    return lambda batches: function(batches, kind)


def across_tasks(chunks: DataFrame, kind: pa.DataType, ddl: str) -> DataFrame:
    """Edits and turns of conversations that lie in several chunks, a row a chunk."""
    place = ["part", "seq"]
    rows = chunks.select("conv_id", *place, F.posexplode("rows").alias("at", "row")).select(
        "conv_id", *place, "at", F.sha2(F.concat(F.length("row.role"), F.lit(":"), "row.role", "row.text"), 256).alias("said"))
    spot = F.struct(*place, "at")
    repeated = rows.groupBy("conv_id", "said").agg(F.min(spot).alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = rows.alias("r").join(repeated.alias("f"), F.expr("r.conv_id <=> f.conv_id AND r.said = f.said")).filter(
        F.expr("struct(r.part, r.seq, r.at) <> f.first")).groupBy("r.conv_id", "r.part", "r.seq").agg(
        F.collect_list("r.at").alias("again"))  # CHUNK places at most
    narrow = chunks.select("conv_id", *place, F.transform("rows", lambda r: F.struct(
        r["turn"].alias("turn"), F.substring(r["role"], 1, 1).alias("initial"), r["fault"].alias("fault"))).alias("rows"))
    marked = narrow.alias("c").join(again.alias("a"), F.expr(
        "c.conv_id <=> a.conv_id AND c.part = a.part AND c.seq = a.seq"), "left").select("c.*", "a.again")
    searched = marked.mapInArrow(streamed(tables, kind), f"conv_id {ddl}, part long, seq long, {FACTS_DDL}, cells {CELLS_DDL}")
    edits = settle(searched.repartition("conv_id").sortWithinPartitions("conv_id", *place).mapInArrow(
        streamed(folded, kind), f"conv_id {ddl}, part long, seq long, piece long, entering int, edits string, "
                                + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"))
    found = chunks.alias("c").join(edits.alias("e"), F.expr(
        "c.conv_id <=> e.conv_id AND c.part = e.part AND c.seq = e.seq")).select(
        "c.conv_id", "e.piece", *[f"e.{c}" for c in (*COUNTS, "audit", "entering", "edits")], "c.rows")
    return found.mapInArrow(streamed(edited, kind), f"conv_id {ddl}, piece long, {EDITS_DDL}")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """The repaired conversations: conv_id, piece, gaps, blank, duplicate, truncated, illegal, cost, audit, turns.

    A conversation is one row, or, if it is long or lies in several tasks, a row for each of its pieces 0, 1, 2 ..., whose turns
    follow each other; its counts and its whole audit then stand in the last piece and are null in the others. Rows come
    in the order of turn (nulls first), role and text (its first 64 characters, then a hash); equal rows are copies of
    which the first is no duplicate.
    A null role means a row that is gone: it only says that the conversation exists, so one with nothing but such rows
    has zeros, an empty audit and no turns. A null text is blank; a role of another initial than s, u, a,
    or an empty one, is never kept. A null conversation id is an id. Other columns are left out; an empty table
    gives no rows. Texts of any length stay whole; a task holds CHUNK rows and CHUNK_BYTES of text at a time, or one longer row.
    """
    ddl = rows.schema[conv_col].dataType.simpleString()
    kind = to_arrow_type(rows.schema[conv_col].dataType)
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.rtrim(text, F.lit(BLANKS))
    fault = F.when(bare == "", GONE).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(CUT)
    named = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.col(role_col).alias("role"), text.alias("text"), fault.alias("fault"),
                        F.monotonically_increasing_id().alias("copy"))
    # The text's beginning and digest keep the keys of the exchange short; the copy lets equal rows spread.
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "start", "digest", "copy"]
    keyed = named.withColumn("start", F.left("text", F.lit(64))).withColumn("digest", F.xxhash64("text"))
    lying = keyed.repartitionByRange(*order).sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "start", "digest", "text").select(
        F.spark_partition_id().cast("long").alias("part"), "conv_id", "turn", "role", "text", "fault")
    done = settle(lying.mapInArrow(streamed(within_tasks, kind), f"conv_id {ddl}, {EDITS_DDL}, {CHUNK_DDL}"))
    whole = done.filter("part is null").select("conv_id", F.lit(0).cast("long").alias("piece"), *COUNTS, "audit", "turns")
    return whole.unionByName(across_tasks(done.filter("part is not null").select("conv_id", "part", "seq", "rows"), kind, ddl))


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """conv_id, piece, n, role, text: the turns of repaired conversations, in the order of piece and n."""
    return repaired.select("conv_id", "piece", F.posexplode("turns").alias("n", "turn")).select(
        "conv_id", "piece", "n", "turn.role", "turn.text")


# --- the digest of a conversation -----------------------------------------------------
def lines(turns: str) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def hashed(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """sha256 over the lines of pieces that come in order."""
    names = [*COUNTS, "audit"]
    schema = pa.schema([("conv_id", kind), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    nothing = object()
    current, digest, said, last = nothing, hashlib.sha256(), False, {}

    def result() -> dict:
        return {"conv_id": current, **{n: last[n] for n in names}, "repaired_sha256": digest.hexdigest()}

    for batch in batches:
        out = []
        for piece in batch.to_pylist():
            if current is nothing or piece["conv_id"] != current:
                if current is not nothing:
                    out.append(result())
                current, digest, said = piece["conv_id"], hashlib.sha256(), False
            if piece["n_turns"]:
                digest.update((b"\n" if said else b"") + piece["lines"].encode("utf-8", "surrogatepass"))
                said = True
            last = piece
        yield pa.RecordBatch.from_pylist(out, schema)
    if current is not nothing:
        yield pa.RecordBatch.from_pylist([result()], schema)


def report(repaired: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, the counts, cost, audit and repaired_sha256 of its `role:text` lines.

    A sha256 has to read its input in order, so the pieces of a conversation in several of them pass one task as a stream.
    """
    names = ["conv_id", *COUNTS, "audit"]
    short = repaired.filter("piece = 0 and audit is not null").select(*names, F.sha2(lines("turns"), 256).alias("repaired_sha256"))
    ddl = repaired.schema["conv_id"].dataType.simpleString()
    kind = to_arrow_type(repaired.schema["conv_id"].dataType)
    long = repaired.filter("piece > 0 or audit is null").select(*names, "piece", F.size("turns").alias("n_turns"), lines("turns").alias("lines"))
    streams = long.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(
        streamed(hashed, kind), f"conv_id {ddl}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string")
    return short.unionByName(streams)

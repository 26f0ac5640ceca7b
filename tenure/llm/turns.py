"""Conversation structure repair (operator 12): the cheapest edits that make the roles of a conversation alternate.

The roles may read `s?(ua)+` by their initials, or nothing. Four states are enough to say where a conversation
stands: nothing yet, after s, after u, after a. So the costs of all states at a place are a vector of four numbers,
and up to a common offset there are few of them. For each such vector and each block of four rows, seen as symbols,
a table holds the vector behind the block and the cost that it adds (Four Russians). A conversation is gone through by
lookups, one per block. Then the blocks are expanded backward: within a block, the states that lie on a
cheapest way are marked from its end to its start. A walk along the marks takes the smallest letter each time, so of all
cheapest edits the ASCII-least come out.

Rows become symbols (initial and fault) in Spark: equal rows are counted before anything is sorted, and a repeat is
found by the first turn of its role and text. A conversation that fills many tasks is range-partitioned by turn and
comes together as one byte per row, which is what its audit takes as well. Text travels once, to the repair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tenure.llm.blocks import worker_cache
from tenure.llm.tables import written

_WHITE = " \t\n\x0b\x0c\r"
INITIALS = "sua"
#: What a row can suffer from, in this order of precedence; its symbol is 4 * initial + fault.
SOUND, TRUNCATED, DUPLICATE, BLANK = range(4)
#: Costs of the edits.
REROLE, DELETE, INSERT, KEEP_TRUNCATED = 1, 2, 5, 5
START, AFTER_S, AFTER_U, AFTER_A = range(4)
ACCEPTING = (START, AFTER_A)
BLOCK = 4
#: Classes of rows: initial s, u, a or another, sound or truncated; and rows that have to go.
CLASSES = 9
MUST_GO = 8
FAR = 1 << 30
#: A state this much dearer than another lies on no cheapest way: five edits at most make up for the better state.
NEVER = 5 * INSERT
_REPAIRED = [StructField("place", LongType()), StructField("role", StringType()), StructField("text", StringType()), StructField("edit", StringType())]
_FLUSH = 2_000_000


def row_class(symbol: int) -> int:
    initial, fault = divmod(symbol, 4)
    return MUST_GO if fault in (DUPLICATE, BLANK) else 2 * initial + fault


def put(state: int) -> tuple[str, int]:
    """The role that an inserted or reroled row has in a state, and the state behind it."""
    return ("assistant", AFTER_A) if state == AFTER_U else ("user", AFTER_U)


def kept_state(state: int, initial: int) -> int | None:
    """The state behind a row that keeps its role, if that is allowed."""
    if initial == 0:
        return AFTER_S if state == START else None
    if initial == 1:
        return AFTER_U if state != AFTER_U else None
    return AFTER_A if initial == 2 and state == AFTER_U else None


def row_edits(state: int, kind: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state behind) of each edit of a row, the letters in ASCII order; an insertion is none of them."""
    found = [("D", DELETE, state)]
    if kind != MUST_GO:
        initial, fault = divmod(kind, 2)
        extra = KEEP_TRUNCATED if fault else 0
        kept = kept_state(state, initial)
        if kept is not None:
            found.append(("K", extra, kept))
        found.append(("R", REROLE + extra, put(state)[1]))
    return found


def inserted(costs: list[int]) -> list[int]:
    """Costs of the states when rows may be inserted at a place: two insertions lead from any state to any they reach."""
    costs = list(costs)
    for _ in range(2):
        for state in range(4):
            after = put(state)[1]
            costs[after] = min(costs[after], costs[state] + INSERT)
    return costs


def stepped(costs: list[int], kind: int) -> list[int]:
    """Costs of the states behind one more row."""
    out = [FAR] * 4
    for state in range(4):
        if costs[state] < FAR:
            for _, cost, after in row_edits(state, kind):
                out[after] = min(out[after], costs[state] + cost)
    return inserted(out)


def normalised(costs: list[int]) -> tuple[tuple[int, ...], int]:
    """The costs above the least one, those that no cheapest way passes as FAR; and the least one."""
    least = min(costs)
    return tuple(FAR if c - least > NEVER else c - least for c in costs), least


class BlockTables:
    """All normalised vectors, and for each of them and each block of symbols the vector behind it and the added cost."""

    def __init__(self) -> None:
        first, offset = normalised(inserted([0, FAR, FAR, FAR]))
        self.first_offset = offset
        self.vectors, number = [first], {first: 0}
        after, added = [], []
        for vector in self.vectors:  # grows while new vectors come up
            row = [normalised(stepped(list(vector), kind)) for kind in range(CLASSES)]
            for v, _ in row:
                if v not in number:
                    number[v] = len(self.vectors)
                    self.vectors.append(v)
            after.append([number[v] for v, _ in row])
            added.append([cost for _, cost in row])
        self.after1, self.added1 = after, added
        one, cost = np.array(after), np.array(added)
        self.after, self.added = one, cost
        for _ in range(BLOCK - 1):
            self.added = (self.added[:, :, None] + cost[self.after]).reshape(len(one), -1)
            self.after = one[self.after].reshape(len(one), -1)
        self.expansions: dict = {}
        self.walks: dict = {}

    def ends(self, kinds: np.ndarray) -> tuple[list[int], list[tuple[int, ...]], int]:
        """The vector before each block and behind the last, the blocks, and the offset of the last vector. One lookup a block."""
        whole = len(kinds) // BLOCK * BLOCK
        grid = kinds[:whole].reshape(-1, BLOCK)
        codes = grid @ (CLASSES ** np.arange(BLOCK - 1, -1, -1))
        vector, total, seen = 0, self.first_offset, [0]
        for code in codes.tolist():
            total += int(self.added[vector, code])
            vector = int(self.after[vector, code])
            seen.append(vector)
        blocks = [tuple(b) for b in grid.tolist()]
        if whole < len(kinds):
            rest = tuple(kinds[whole:].tolist())
            for kind in rest:
                total += self.added1[vector][kind]
                vector = self.after1[vector][kind]
            blocks.append(rest)
            seen.append(vector)
        return seen, blocks, total

    def expansion(self, vector: int, block: tuple[int, ...], marks: int) -> tuple[list, list]:
        """The costs inside a block, and the states on a cheapest way to the marked states at its end."""
        key = vector, block, marks
        if key not in self.expansions:
            if len(self.expansions) > 100_000:
                self.expansions.clear()
            costs = [list(self.vectors[vector])]
            for kind in block:
                costs.append(stepped(costs[-1], kind))
            on_way = [0] * len(block) + [with_insertions(costs[-1], marks)]
            for at in range(len(block) - 1, -1, -1):
                found = 0
                for state in range(4):
                    for _, cost, after in row_edits(state, block[at]):
                        if on_way[at + 1] >> after & 1 and costs[at][state] + cost == costs[at + 1][after] and costs[at][state] < FAR:
                            found |= 1 << state
                on_way[at] = with_insertions(costs[at], found)
            self.expansions[key] = costs, on_way
        return self.expansions[key]

    def walk(self, vector: int, block: tuple[int, ...], marks: int, state: int) -> tuple[str, int]:
        """The smallest letters along the marks of a block from a state at its start, and the state at its end."""
        key = vector, block, marks, state
        if key not in self.walks:
            if len(self.walks) > 100_000:
                self.walks.clear()
            costs, on_way = self.expansion(vector, block, marks)
            letters = []
            for at, kind in enumerate(block):
                while True:
                    options = [(letter, after, at + 1) for letter, cost, after in row_edits(state, kind) if on_way[at + 1] >> after & 1 and costs[at][state] + cost == costs[at + 1][after]]
                    after = put(state)[1]
                    if on_way[at] >> after & 1 and costs[at][state] + INSERT == costs[at][after]:
                        options.append(("I", after, at))
                    letter, state, next_at = min(options)
                    letters.append(letter)
                    if next_at > at:
                        break
            self.walks[key] = "".join(letters), state
        return self.walks[key]

    def repair(self, kinds: np.ndarray) -> tuple[int, str]:
        """The least cost, and the ASCII-least of the cheapest audits."""
        seen, blocks, offset = self.ends(kinds)
        last = self.vectors[seen[-1]]
        least = min(last[s] for s in ACCEPTING)
        goals = sum(1 << s for s in ACCEPTING if last[s] == least)
        marks = [0] * len(blocks) + [goals]
        for at in range(len(blocks) - 1, -1, -1):
            marks[at] = self.expansion(seen[at], blocks[at], marks[at + 1])[1][0]
        state, audit = START, []
        for at, block in enumerate(blocks):
            letters, state = self.walk(seen[at], block, marks[at + 1], state)
            audit.append(letters)
        while not goals >> state & 1:
            state = put(state)[1]
            audit.append("I")
        return offset + least, "".join(audit)


def with_insertions(costs: list[int], marks: int) -> int:
    """The marked states, and those from which cheapest insertions lead to them."""
    for _ in range(2):
        for state in range(4):
            after = put(state)[1]
            if marks >> after & 1 and costs[state] < FAR and costs[state] + INSERT == costs[after]:
                marks |= 1 << state
    return marks


def damage(conversations: DataFrame) -> DataFrame:
    """The turns after planted faults, by crc32(`conv_id:turn`) % 20; a null there, in role or in text counts as one space.

    0 drops the row, 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats it,
    4 gives it the role user. Other columns stay. An empty table gives an empty result.
    """
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.pmod(F.crc32(F.concat_ws(":", *spaced)), F.lit(20))
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    changed = conversations.withColumns({
        "role": F.when(kind == 4, "user").otherwise(role),
        "text": F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text),
    })
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).when(kind == 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(0))))
    names = {c.lower() for c in conversations.columns}
    copy = next(n for n in ("copy", *(f"copy{i}" for i in range(len(names) + 1))) if n not in names)
    return changed.select("*", copies.alias(copy)).select(*conversations.columns)


def _marked(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, symbol and n: distinct rows of each turn and how often they stand there."""
    text = F.coalesce("text", F.lit(" "))
    rest = F.rtrim(text, F.lit(_WHITE))
    fault = F.when(rest == "", BLANK).when(F.substring(rest, -1, 1).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    initial = F.coalesce(F.nullif(F.instr(F.lit(INITIALS), F.substring("role", 1, 1)), F.lit(0)) - 1, F.lit(3))
    initial = F.when(F.col("role") == "", 3).otherwise(initial)
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.unhex(F.sha2(text, 256)).alias("digest"), fault.alias("fault"))
    rows = rows.select("*", initial.alias("initial"))
    counted = rows.groupBy("conv_id", "turn", "role", "digest", "fault", "initial").agg(F.count("*").alias("n"))
    first = counted.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"))
    same = counted["conv_id"].eqNullSafe(first["conv_id"]) & (counted["role"] == first["role"]) & (counted["digest"] == first["digest"])
    joined = counted.join(first, same).select(counted["*"], first["first"]["turn"].alias("first"))
    again = ~F.col("turn").eqNullSafe(F.col("first")) & (F.col("fault") != BLANK)
    symbol = F.col("initial") * 4 + F.when(again, DUPLICATE).otherwise(F.col("fault"))
    return joined.select("conv_id", "turn", "role", "digest", symbol.cast("int").alias("symbol"), "n")


def _pieces(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per conversation of a sorted partition: its symbols, its first and last turn and its number of turns."""
    part = TaskContext.get().partitionId()
    now: dict | None = None
    for batch in batches:
        out = []
        for conv, turn, symbol, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "symbol", "n"))):
            if now is None or conv != now["conv_id"]:
                out += [now] if now else []
                now = {"conv_id": conv, "part": part, "symbols": bytearray(), "low": None, "high": None, "turns": 0}
            # A copy of a row in its own turn is a repeat, or as blank as the row.
            copy = symbol if symbol % 4 == BLANK else symbol // 4 * 4 + DUPLICATE
            now["symbols"] += bytes([symbol]) + bytes([copy]) * (n - 1)
            if turn is not None:
                now["low"] = turn if now["low"] is None else now["low"]
                now["turns"] += turn != now["high"]
                now["high"] = turn
        yield _batch(out, schema)
    yield _batch([now] if now else [], schema)


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bytes(r[f.name]) if f.name == "symbols" else r[f.name] for r in rows], f.type) for f in schema], schema=schema)


def _report(pieces: list[dict], tables: BlockTables) -> dict:
    """All measures of one conversation from its pieces in order."""
    symbols = np.frombuffer(b"".join(p["symbols"] for p in pieces), np.uint8)
    initials, faults = np.divmod(symbols, 4)
    cost, audit = tables.repair(np.array([row_class(s) for s in range(16)])[symbols])
    legal = np.zeros((4, 4), bool)
    legal[[0, 1, 2], [1, 2, 1]] = True
    dated = [p for p in pieces if p["low"] is not None]
    shared = sum(a["high"] == b["low"] for a, b in zip(dated, dated[1:]))
    gaps = dated[-1]["high"] - dated[0]["low"] + 1 - sum(p["turns"] for p in dated) + shared if dated else 0
    return {
        "gaps": gaps, "blank": int((faults == BLANK).sum()), "duplicate": int((faults == DUPLICATE).sum()), "truncated": int((faults == TRUNCATED).sum()),
        "illegal": int((~legal[initials[:-1], initials[1:]]).sum()), "cost": cost, "audit": audit,
    }


MEASURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audits(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation of `turns`.

    Rows are taken by turn (nulls first), ties by role and then by the SHA-256 of the text. Nulls in role and text
    count as one space; rows without a conv_id are one conversation. Rows that are equal throughout are repeats
    of one another. gaps are the turns missing between the first and the last one; the first fault of a row counts (blank,
    duplicate, truncated); illegal are neighbours whose initials are not su, ua or au. An empty table gives an empty result.
    Other columns, whatever their names, are not read.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    ordered = written(_marked(turns)).repartitionByRange(*order).sortWithinPartitions(*order)
    kind = turns.schema["conv_id"].dataType
    fields = [("conv_id", kind.simpleString()), ("part", "int"), ("symbols", "binary"), ("low", "long"), ("high", "long"), ("turns", "long")]
    arrow = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for first, rest in _peeked(batches):
            schema = pa.schema([("conv_id", first.schema.field("conv_id").type), *((n, arrow[t]) for n, t in fields[1:])])
            yield from _pieces(rest, schema)

    pieces = ordered.select("conv_id", F.col("turn").cast("long").alias("turn"), "symbol", "n").mapInArrow(cut, ", ".join(f"{n} {t}" for n, t in fields))
    gathered = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "symbols", "low", "high", "turns"))).alias("pieces"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = worker_cache("turns", "", BlockTables)
        for batch in batches:
            found = [_report(p, tables) for p in batch.column("pieces").to_pylist()]
            columns = [pa.array([f[m] for f in found], pa.int64()) for m in MEASURES]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns, pa.array([f["audit"] for f in found], pa.string())], ["conv_id", *MEASURES, "audit"])

    return gathered.mapInArrow(judge, f"conv_id {kind.simpleString()}, " + ", ".join(f"{m} long" for m in MEASURES) + ", audit string")


def _peeked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Iterator[pa.RecordBatch]]]:
    """The first batch and all batches, if there is one."""
    first = next(batches, None)
    if first is not None:

        def whole() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        yield first, whole()


def repair(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """conv_id, place, role, text and edit (K, R or I) of each row of the repaired conversations, place from 0.

    `audited` has conv_id and audit of these turns, as `audits` gives them. The rows of a partition stand in order.
    A conversation streams through one task, sorted on disk; the task holds one row and its place in the audit.
    """
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = turns.select("conv_id", F.lit(None).cast("string").alias("audit"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))
    heads = audited.select("conv_id", "audit", *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("digest", "binary"))])
    order = ["conv_id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "digest"]
    stream = heads.unionByName(rows).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "audit", "role", "text")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place, conv = "", 0, START, 0, None
        out: list[tuple] = []

        def flush(kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 5
            types = (kind, pa.int64(), pa.string(), pa.string(), pa.string())
            done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conv_id", "place", "role", "text", "edit"])
            out.clear()
            return done

        def insert() -> None:
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                role, state = put(state)
                out.append((conv, place, role, "", "I"))
                at, place = at + 1, place + 1

        for batch in batches:
            kind, size = batch.schema.field("conv_id").type, 0
            for row_conv, head, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text"))):
                if head is not None:
                    conv, audit, at, state, place = row_conv, head, 0, START, 0
                    insert()
                    continue
                edit, at = audit[at], at + 1
                if edit != "D":
                    if edit == "R":
                        role, state = put(state)
                    else:
                        state = kept_state(state, INITIALS.find(role[:1]) if role else 3)
                    out.append((conv, place, role, text, edit))
                    place += 1
                    size += len(text)
                insert()
                if size > _FLUSH:
                    size = 0
                    yield flush(kind)
            yield flush(kind)

    return stream.mapInArrow(rebuild, StructType([StructField("conv_id", turns.schema["conv_id"].dataType), *_REPAIRED]))


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of the `role:text` lines of each conversation; the rows of a conversation stand together, in order."""
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, open_hash, kind = None, None, None
        for batch in batches:
            kind, done = batch.schema.field("conv_id").type, []
            for row_conv, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text"))):
                if place == 0:
                    done += [(conv, open_hash.hexdigest())] if open_hash else []
                    conv, open_hash = row_conv, hashlib.sha256()
                open_hash.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())], ["conv_id", "repaired_sha256"])
        if open_hash:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([open_hash.hexdigest()])], ["conv_id", "repaired_sha256"])

    return repaired.mapInArrow(stream, StructType([repaired.schema["conv_id"], StructField("repaired_sha256", StringType())]))


def op12_turn_repair(conversations: DataFrame) -> DataFrame:
    """The audit of every conversation after planted faults, with the digest of its repaired text."""
    turns = damage(conversations.select("conv_id", "turn", "role", "text"))
    audited = written(audits(turns))
    hashed = digests(repair(turns, audited))
    every = conversations.select("conv_id").distinct()
    found = every.join(audited, every["conv_id"].eqNullSafe(audited["conv_id"]), "left").drop(audited["conv_id"])
    both = found.join(hashed, found["conv_id"].eqNullSafe(hashed["conv_id"]), "left").drop(hashed["conv_id"])
    numbers = [F.coalesce(F.col(m), F.lit(0)).cast("long").alias(m) for m in MEASURES]
    return both.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))

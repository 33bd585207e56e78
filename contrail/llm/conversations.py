"""Operator 13, conversation structure repair by integer weights.

A conversation shall read ``(s?(ua)+)?`` in the initials of its roles. Rows
are kept (K), given another role (R) or deleted (D), rows are inserted (I);
the cheapest edits win, among them the least audit text.

Cost and audit are one integer. Its high digits are the cost; below stand
``width`` octal digits, one for each place of the audit: D, I, K, R are 1 to
4, and places after the end are 0, so a text that another one begins with is
less. An edit's weight is its cost in the high digits plus its letter's digit
at its place. The plan is then the least integer on the way through a graph
with a node for (rows read, part of the pattern read). A node's least integer
is enough to go on from: of two ways to one node with equal costs neither
audit begins with the other (the longer one would hold more insertions and
cost more), so what follows does not change which is less.

Long conversations are cut. Rows are range-partitioned by conversation and
turn, so one conversation may lie in many partitions; each works out a table
from every part of the pattern to every other for its stretch, in blocks of
``BLOCK`` rows, and the tables of a conversation are joined in order. Equal
rows of one turn are one row with its number up to then. Texts take part as
hashes only; they are shuffled once, to write the repaired rows, which are
streamed in turn order and never held together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import stored
from contrail.session import ship_code

KEEP, DELETE, INSERT, REROLE, CUT_OFF = 0, 3, 2, 2, 1  # costs; CUT_OFF for a truncated row that stays
LETTERS = " DIKR"
BLOCK = 512
# parts of the pattern: nothing yet, after s, after u, after a; a text ends at START or after a
START, S, U, A = range(4)
STEPS = {START: {"s": S, "u": U}, S: {"u": U}, U: {"a": A}, A: {"u": U}}
GOOD, TRUNCATED, FORCED = range(3)
BATCH_BYTES = 4 << 20


def block_plans(rows: list[tuple[str, int]], start: int) -> dict[int, tuple[int, str]]:
    """Part of the pattern -> (cost, audit) of the cheapest edits of
    ``rows`` (initial, fault) that lead there from part ``start``."""
    width = 2 * len(rows) + 4
    top = 3 * width

    def edit(v: int, cost: int, letter: int) -> int:
        # the letter's place follows the lowest digit that is not 0
        place = (v & -v).bit_length() - 1 if v else top
        return v + (cost << top) + (letter << (place // 3 - 1) * 3)

    def insertions(best: dict[int, int]) -> None:
        for frm, to in ((START, U), (S, U), (A, U), (U, A)):
            if frm in best:
                v = edit(best[frm], INSERT, 2)
                if to not in best or v < best[to]:
                    best[to] = v

    best = {start: 0}
    insertions(best)
    for initial, fault in rows:
        after: dict[int, int] = {}
        for part, v in best.items():
            ways = [(part, edit(v, DELETE, 1))]
            if fault != FORCED:
                more = CUT_OFF if fault == TRUNCATED else 0
                for role, to in STEPS[part].items():
                    if role == initial:
                        ways.append((to, edit(v, KEEP + more, 3)))
                    if role != "s":
                        ways.append((to, edit(v, REROLE + more, 4)))
            for to, w in ways:
                if to not in after or w < after[to]:
                    after[to] = w
        insertions(after)
        best = after
    out = {}
    for part, v in best.items():
        digits = format(v & ((1 << top) - 1), "o").rjust(width, "0").rstrip("0")
        out[part] = (v >> top, "".join(LETTERS[int(d)] for d in digits))
    return out


def joined(first: dict[int, tuple[int, str]], second: dict[int, dict[int, tuple[int, str]]]) -> dict[int, tuple[int, str]]:
    """Plans of two stretches, one after the other."""
    out: dict[int, tuple[int, str]] = {}
    for mid, (cost, audit) in first.items():
        for to, (c, a) in second.get(mid, {}).items():
            way = (cost + c, audit + a)
            if to not in out or way < out[to]:
                out[to] = way
    return out


def _damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies of the rows after damage."""
    c = conversations
    space = F.lit(" ")
    rows = c.select(c["conv_id"].alias("conv_id"), c["turn"].cast("long").alias("turn"),
                    F.coalesce(c["role"].cast("string"), space).alias("role"),
                    F.coalesce(c["text"].cast("string"), space).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("k", F.crc32(key.cast("binary")) % 20).filter("k <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("k") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("k") == 1, F.lit("")).when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"), F.when(F.col("k") == 3, 2).otherwise(1).alias("copies"))


_ORDER = ["conv_id", "late", "turn", "role", "th"]  # nulls first; rows of one turn by role and hash of the text


def _faults(rows: DataFrame) -> DataFrame:
    """One row for the equal rows of a turn: conv_id, late (0: null turn),
    turn, role, th, n, blank, cut_off, repeated (all of them stand earlier)."""
    same = stored(rows.groupBy(
        "conv_id", F.col("turn").isNotNull().cast("int").alias("late"), "turn", "role", F.md5(F.col("text").cast("binary")).alias("th")).agg(
        F.sum("copies").cast("long").alias("n"), F.max(~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        F.max(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut_off")), "turns")
    first = same.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("th").alias("h")).agg(
        F.min(F.struct("late", "turn")).alias("first"))
    return same.join(first, same["conv_id"].eqNullSafe(first["c"]) & (same["role"] == first["r"]) & (same["th"] == first["h"])).select(
        *same.columns, ((F.col("first")["late"] < F.col("late")) | F.coalesce(F.col("first")["turn"] < F.col("turn"), F.lit(False))).alias("repeated"))


_WAY = pa.struct([("src", pa.int32()), ("dst", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_PIECE = "part int, ways array<struct<src:int,dst:int,cost:long,audit:string>>, head string, tail string, illegal long"


class _Piece:
    """The rows of one conversation in one partition, seen in order."""

    def __init__(self, conv, starts):
        self.conv, self.rows, self.illegal, self.head, self.tail = conv, [], 0, None, None
        self.plans = {s: {s: (0, "")} for s in starts}

    def add(self, initial: str, fault: int, n: int) -> None:
        if self.head is None:
            self.head = initial
        else:
            self.illegal += (self.tail + initial) not in ("su", "ua", "au")
        self.illegal += (n - 1) * ((initial + initial) not in ("su", "ua", "au"))
        self.tail = initial
        while n:
            self.rows.append((initial, fault))
            fault, n = FORCED, n - 1
            if len(self.rows) >= BLOCK:
                self.close()

    def close(self) -> None:
        if self.rows:
            entered = {p for plan in self.plans.values() for p in plan}
            table = {p: block_plans(self.rows, p) for p in entered}
            self.plans = {s: joined(plan, table) for s, plan in self.plans.items()}
            self.rows = []

    def row(self, part: int) -> tuple:
        self.close()
        ways = [{"src": s, "dst": d, "cost": c, "audit": a} for s, plan in self.plans.items() for d, (c, a) in plan.items()]
        return self.conv, part, ways, self.head, self.tail, self.illegal


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    piece, out, kind = None, [], None

    def flush():
        cols = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], kind), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.list_(_WAY)),
             pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.int64())],
            names=["conv_id", "part", "ways", "head", "tail", "illegal"])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv, initial, fault, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "initial", "fault", "n")), strict=True):
            if piece is None:  # the partition may begin inside a conversation
                piece = _Piece(conv, range(4))
            elif piece.conv != conv:
                out.append(piece.row(part))
                piece = _Piece(conv, (START,))
                if len(out) >= 2000:
                    yield flush()
                    out = []
            piece.add(initial, fault, n)
    if piece is not None:
        out.append(piece.row(part))
        yield flush()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the pieces of each conversation, in order."""
    for batch in batches:
        cost, audit, illegal = [], [], []
        for pieces in batch.column("pieces").to_pylist():
            plan, wrong, tail = {START: (0, "")}, 0, None
            for p in pieces:
                table: dict[int, dict] = {}
                for w in p["ways"]:
                    table.setdefault(w["src"], {})[w["dst"]] = (w["cost"], w["audit"])
                plan = joined(plan, table)
                wrong += p["illegal"] + (tail is not None and (tail + p["head"]) not in ("su", "ua", "au"))
                tail = p["tail"]
            c, a = min(plan[x] for x in (START, A) if x in plan)
            cost.append(c)
            audit.append(a)
            illegal.append(wrong)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(cost, pa.int64()), pa.array(audit, pa.string()), pa.array(illegal, pa.int64())],
            names=["conv_id", "cost", "audit", "illegal"])


def repair_plans(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of
    every conversation of ``rows`` (conv_id, turn, role, text, copies: how
    often the row stands there)."""
    ship_code()
    conv = rows.schema["conv_id"].dataType.simpleString()
    marked = stored(_faults(rows), "faults")
    n, one = F.col("n"), F.lit(0).cast("long")
    stats = marked.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), one).alias("gaps"),
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("repeated"), n).otherwise(n - 1)).alias("duplicate"),
        F.sum(F.when(~F.col("blank") & ~F.col("repeated") & F.col("cut_off"), 1).otherwise(0)).cast("long").alias("truncated"))
    fault = F.when(F.col("blank") | F.col("repeated"), FORCED).when(F.col("cut_off"), TRUNCATED).otherwise(GOOD)
    order = [F.col(c).asc_nulls_first() for c in _ORDER]
    pieces = (marked.select(*_ORDER, F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), "n")
              .repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "initial", "fault", "n")
              .mapInArrow(_pieces, f"conv_id {conv}, {_PIECE}"))
    plans = (pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "ways", "head", "tail", "illegal"))).alias("pieces"))
             .mapInArrow(_whole, f"conv_id {conv}, cost long, audit string, illegal long"))
    other = stats.withColumnRenamed("conv_id", "c")
    return plans.join(other, plans["conv_id"].eqNullSafe(other["c"])).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


class _Writer:
    """Walks through a conversation's audit along with its rows."""

    def __init__(self, conv, audit):
        self.conv, self.audit, self.at, self.part, self.place = conv, audit, 0, START, 0

    def _turned(self, letter, role, text):
        initial = role[:1] if letter == "K" else "a" if self.part == U else "u"
        self.part = STEPS[self.part][initial]
        self.place += 1
        return self.conv, self.place - 1, letter, role if letter == "K" else {"u": "user", "a": "assistant"}[initial], text

    def inserted(self):
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._turned("I", "", "")

    def row(self, role, text):
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            yield self._turned(letter, role, text)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    writer, out, held, kind = None, [], 0, None

    def flush():
        cols = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (kind, pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)],
            names=["conv_id", "place", "edit", "role", "text"])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv, copies, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "copies", "role", "text")), strict=True):
            if copies == 0:  # the audit stands before its rows
                new = list(writer.inserted()) if writer else []
                writer = _Writer(conv, text)
            else:
                new = [x for _ in range(copies) for x in writer.row(role, text)]
            out += new
            held += sum(len(x[4]) + 50 for x in new)
            if held > BATCH_BYTES:
                yield flush()
                out, held = [], 0
    if writer:
        out += writer.inserted()
    if out:
        yield flush()


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, place, edit, role, text: the rows of every repaired
    conversation by the ``audit`` of ``plans``. Inside a partition they are in
    order, and a conversation is in one partition."""
    ship_code()
    conv = rows.schema["conv_id"].dataType.simpleString()
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")  # never kept, so its text need not travel
    late = F.col("turn").isNotNull().cast("int")
    body = rows.select("conv_id", late.alias("late"), "turn", "role", F.md5(F.col("text").cast("binary")).alias("th"), "copies",
                       F.when(~blank, F.col("text")).otherwise(F.lit("")).alias("text"))
    head = plans.select("conv_id", F.lit(-1).alias("late"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                        F.lit("").alias("th"), F.lit(0).alias("copies"), F.col("audit").alias("text"))
    order = [F.col(c).asc_nulls_first() for c in _ORDER]
    return (head.unionByName(body).repartition("conv_id").sortWithinPartitions(*order)
            .select("conv_id", "copies", "role", "text")
            .mapInArrow(_repaired, f"conv_id {conv}, place long, edit string, role string, text string"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, sha, done, kind = None, None, [], None

    def flush():
        ids, hashes = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(hashes, pa.string())], names=["conv_id", "sha"])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for c, place, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "place", "role", "text")), strict=True):
            if place == 0:
                if sha is not None:
                    done.append((conv, sha.hexdigest()))
                conv, sha = c, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
        if len(done) >= 2000:
            yield flush()
            done = []
    if sha is not None:
        done.append((conv, sha.hexdigest()))
    if done:
        yield flush()


def repair_digest(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 of every conv_id of ``conversations`` (conv_id, turn,
    role, text), after the damage.

    Null roles and texts are one space, and so are null ids and turns where
    the damage hashes them; rows with a null conv_id are one conversation, rows
    with a null turn come first. Rows of one turn stand by role, then by the
    hash of their text; repeated rows of a turn are duplicates. An empty table
    gives no rows, a conversation without rows after the damage zeros; other
    columns are ignored, whatever their names. Same input, same result."""
    conv = conversations.schema["conv_id"].dataType.simpleString()
    rows = _damaged(conversations)
    plans = stored(repair_plans(rows), "plans")
    # the digest reads each partition of the repaired rows in their order
    sha = repaired(rows, plans).mapInArrow(_digests, f"conv_id {conv}, sha string").withColumnRenamed("conv_id", "d")
    plan = plans.withColumnRenamed("conv_id", "c")
    ids = conversations.select(conversations["conv_id"].alias("conv_id")).distinct()
    numbers = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    out = ids.join(plan, ids["conv_id"].eqNullSafe(plan["c"]), "left")
    return out.join(sha, out["conv_id"].eqNullSafe(sha["d"]), "left").select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))

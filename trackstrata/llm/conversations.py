"""Repair of conversation structure at least cost.

The rows of a conversation, by turn, are kept (0), given the role user or assistant (``REROLE``), or deleted (``DELETE``, a must for
blank rows and repeats); empty rows of these roles can be inserted anywhere (``INSERT``); a truncated row that stays costs
``TRUNCATED`` more. The cheapest edits that leave roles of the form ``(s?(ua)+)?`` are sought, and among them the ones with the
least audit, the string of the edits' initials.

Four states (nothing yet, after system, after user, after assistant) make each row a small table of costs from state to state. A
backward pass gives the cost still to come at every (row, state); the edits that keep to it are the optimal arcs. Arcs are ranked by the
first 1, 2, 4, ... letters of the audits that start with them: the rank for twice the length is the rank of the pair (rank of the arc,
rank of the arc that its pointer reaches), and the pointers double with it. The ranks choose the first arc, and the doubled pointers
then give the first 1, 2, 4, ... arcs of the path. A letter leaves a (row, state) at most once, so the path is settled by its audit.

Texts do not travel for this, only one row of flags per distinct (turn, role, text), dealt by ranges of (conversation, turn, ...), so one
conversation may span many tasks. Conversations inside a task are solved there. Of the others, each piece of at most ``piece_rows``
rows gives its table of costs; the tables of a conversation are chained, and the pieces then solved apart, for each state they
may begin in. Only the digest of the repaired text is one stream per conversation, as SHA-256 is sequential; it
passes through a task row by row, sorted by Spark.

Null roles and texts count as one blank. Rows of equal turns are ordered by role, then by the SHA-256 of the text; a null turn comes
first and is no turn. Null conversation ids are one conversation. Repeated rows are duplicates. ``times`` (a column of
whole numbers) repeats rows; a conversation with no row left gives zeros, an empty audit and the digest of the empty
string. An empty table gives an empty table. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
PIECE_ROWS = 200_000
FAR = 1 << 60
LETTERS = np.frombuffer(b"DIKR", np.uint8)  # ascending, as the least audit is sought
NEXT = (2, 2, 3, 2)  # the state after a user or assistant row, whichever may follow
SPACE = r"[^\x20\x09-\x0D]"
SYSTEM, USER, ASSISTANT, OTHER, LOST, CUT = 0, 1, 2, 3, 4, 8  # a row's code: initial, must go, truncated


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with faults by ``crc32`` of ``conv_id:turn`` modulo 20, and ``times`` for rows dropped or repeated."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    dice = F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(dice == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(dice == 1, F.lit("")).when(dice == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(dice == 0, 0).when(dice == 3, 2).otherwise(1).alias("times"),
    )


@dataclass
class Sequence:
    """Row codes, the costs still to come after the last row by state, whether rows may be inserted there, and the states to start from."""

    codes: bytes
    ends: tuple[int, ...]
    closes: bool
    starts: tuple[int, ...] = (0,)
    #: by start: (audit, state reached), None where the end cannot be reached
    paths: list[tuple[str, int] | None] = field(default_factory=list)
    cost: int = 0


def finish() -> tuple[int, ...]:
    return 0, 2 * INSERT, INSERT, 0


def costs(codes: bytes, ends: tuple[int, ...]) -> np.ndarray:
    """[row, state]: the least cost from before each row (and after the last) to the end."""
    v0, v1, v2, v3 = ends
    out = [(v0, v1, v2, v3)]
    for code in reversed(codes):
        b0, b1, b2, b3 = DELETE + v0, DELETE + v1, DELETE + v2, DELETE + v3
        if not code & LOST:
            extra, initial = TRUNCATED if code & CUT else 0, code & 3
            user = extra + v2 + (0 if initial == USER else REROLE)
            b2 = min(b2, extra + v3 + (0 if initial == ASSISTANT else REROLE))
            b0, b1, b3 = min(b0, user), min(b1, user), min(b3, user)
            if initial == SYSTEM:
                b0 = min(b0, extra + v1)
        by_user, by_answer = INSERT + min(b2, INSERT + b3), INSERT + min(b3, INSERT + b2)
        v0, v1, v2, v3 = min(b0, by_user), min(b1, by_user), min(b2, by_answer), min(b3, by_user)
        out.append((v0, v1, v2, v3))
    return np.array(out[::-1], np.int64)


def table_of(codes: bytes) -> list[int]:
    """Least cost from each state before the rows to each state after them, 16 values."""
    columns = [costs(codes, tuple(0 if s == end else FAR for s in range(4)))[0] for end in range(4)]
    return np.minimum(np.array(columns).T, FAR).ravel().tolist()


def least_paths(batch: list[Sequence]) -> None:
    """Fill in ``paths`` and ``cost`` of all sequences, ranking their arcs together."""
    lengths = np.array([len(s.codes) for s in batch])
    value = np.concatenate([costs(s.codes, s.ends) for s in batch])
    base = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]  # first node row of each sequence
    row = np.repeat(base, lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    code = np.frombuffer(b"".join(s.codes for s in batch), np.uint8).astype(np.int64)
    extra, initial, stays = np.where(code & CUT, TRUNCATED, 0), code & 3, (code & LOST) == 0
    closing = (base + lengths)[np.array([s.closes for s in batch], bool)]
    froms, tos, labels = [], [], []

    def arcs(rows: np.ndarray, state: int, to_rows: np.ndarray, to_state: int, cost, letter: int, allowed) -> None:
        good = allowed & (value[rows, state] < FAR) & (value[rows, state] == cost + value[to_rows, to_state])
        froms.append(rows[good] * 4 + state)
        tos.append(to_rows[good] * 4 + to_state)
        labels.append(np.full(int(good.sum()), letter))

    yes = np.ones(len(row), bool)
    for s in range(4):
        arcs(row, s, row + 1, s, DELETE, 0, yes)
        arcs(row, s, row, NEXT[s], INSERT, 1, yes)
        arcs(closing, s, closing, NEXT[s], INSERT, 1, np.ones(len(closing), bool))
        own = ASSISTANT if s == 2 else USER
        arcs(row, s, row + 1, NEXT[s], extra, 2, stays & (initial == own))
        arcs(row, s, row + 1, NEXT[s], extra + REROLE, 3, stays)
    arcs(row, 0, row + 1, 1, extra, 2, stays & (initial == SYSTEM))
    node, target, label = (np.concatenate(x) for x in (froms, tos, labels))
    order = np.lexsort((label, node))
    node, target, label = node[order], target[order], label[order]
    end = len(node)  # the arc after the last one: the least of all, and its own successor
    first = np.full(4 * len(value) + 1, end, np.int64)
    first[node[::-1]] = np.arange(end)[::-1]
    rank = np.append(label + 1, 0)
    pointers = [np.append(first[target], end)]
    while (pointers[-1] != end).any():
        step = pointers[-1]
        _, rank = np.unique(rank * (rank.max() + 1) + rank[step], return_inverse=True)
        pointers.append(step[step])
    starts = [(s, b * 4 + state) for s, b in zip(batch, base.tolist()) for state in s.starts]
    opened, closed = np.searchsorted(node, [n for _, n in starts]), np.searchsorted(node, [n for _, n in starts], side="right")
    chosen = [a + int(np.argmin(rank[a:b])) if b > a else end for a, b in zip(opened.tolist(), closed.tolist())]
    path = np.array(chosen, np.int64)[:, None]
    for step in pointers:
        if (path[:, -1] == end).all():
            break
        path = np.concatenate([path, step[path]], axis=1)
    letters = np.append(LETTERS[label], 0).astype(np.uint8)[path]
    used = (path != end).sum(axis=1)
    for i, (sequence, at) in enumerate(starts):
        reachable = value[at // 4, at % 4] < FAR
        last = int(target[path[i, used[i] - 1]]) % 4 if used[i] else at % 4
        sequence.paths.append((letters[i, : used[i]].tobytes().decode(), last) if reachable else None)
    for s, b in zip(batch, base.tolist()):
        s.cost = int(value[b, s.starts[0]])


def solve(sequences: list[Sequence], cells: int = 500_000) -> None:
    """``least_paths`` in batches of like length, so that (sequences x longest) stays below ``cells`` unless one alone is longer."""
    batch: list[Sequence] = []
    for s in sorted(sequences, key=lambda s: len(s.codes)):
        if batch and (sum(len(b.starts) for b in batch) + len(s.starts)) * 2 * (len(s.codes) + 1) > cells:
            least_paths(batch)
            batch = []
        batch.append(s)
    if batch:
        least_paths(batch)


def row_flags(rows: DataFrame) -> DataFrame:
    """Stored: one row per distinct (c, t, role, digest) with ``n`` repetitions, ``first`` if the role and text were not seen earlier, ``blank`` and ``cut``."""
    light = rows.select("c", "t", "role", "digest", "blank", "cut", "n").groupBy("c", "t", "role", "digest").agg(
        F.max("blank").alias("blank"), F.max("cut").alias("cut"), F.sum("n").alias("n")
    )
    light = stored(light)
    # the earliest turn of each (role, text), met again as a row: no join, so no hot key
    earliest = F.when(~F.max(F.col("t").isNull()), F.min("t"))
    no = F.lit(False)
    firsts = light.where("n > 0").groupBy("c", "role", "digest").agg(earliest.alias("t"))
    marks = firsts.select("c", "t", "role", "digest", no.alias("blank"), no.alias("cut"), F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("first"))
    both = light.withColumn("first", no).unionByName(marks)
    return stored(both.groupBy("c", "t", "role", "digest").agg(F.max("blank").alias("blank"), F.max("cut").alias("cut"), F.sum("n").alias("n"), F.max("first").alias("first")))


_STATS = ("blank", "duplicate", "truncated", "illegal")
_PIECE = (
    "piece bigint, open boolean, codes binary, costs array<bigint>, audit string, cost bigint, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, initials array<string>, turns array<bigint>, distinct bigint"
)


class _Piece:
    def __init__(self) -> None:
        self.codes = bytearray()
        self.stats = dict.fromkeys(_STATS, 0)
        self.first: str | None = None
        self.last: str | None = None
        self.turns: list[int] = []
        self.distinct = 0

    def add(self, turn: int | None, role: str, blank: bool, cut: bool, first: bool, n: int) -> None:
        initial = role[:1]
        if self.first is None:
            self.first = initial
        else:
            self.stats["illegal"] += self.last + initial not in ("su", "ua", "au")
        self.last = initial
        self.stats["illegal"] += n - 1
        code = "sua".find(initial) if initial else OTHER
        code = OTHER if code < 0 else code
        fresh = 1 if first and not blank else 0
        self.stats["blank"] += n if blank else 0
        self.stats["duplicate"] += 0 if blank else n - fresh
        self.stats["truncated"] += 1 if fresh and cut else 0
        self.codes += bytes([code | (CUT if cut else 0)]) * fresh + bytes([code | LOST]) * (n - fresh)
        if turn is not None:
            if not self.turns or self.turns[-1] != turn:
                self.distinct += 1
            self.turns = [self.turns[0] if self.turns else turn, turn]


def pieces(flags: DataFrame, piece_rows: int) -> DataFrame:
    """Stored: solved conversations, and pieces of those that may go on in another task or have over ``piece_rows`` rows."""
    order = [F.asc_nulls_first(c) for c in ("c", "t", "role", "digest")]
    sorted_rows = flags.where("n > 0").repartitionByRange(*order).sortWithinPartitions(*order).select("c", "t", "role", "blank", "cut", "first", "n")
    schema = T.StructType([flags.schema["c"], *T.StructType.fromDDL(_PIECE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        done: list[tuple] = []  # (conversation, piece number, piece, open)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 4096):
                    yield from zip(*(batch.slice(at, 4096).column(i).to_pylist() for i in range(7)))

        def out() -> pa.RecordBatch:
            sequences = [None if is_open else Sequence(bytes(p.codes), finish(), True) for _, _, p, is_open in done]
            solve([s for s in sequences if s is not None])
            data = [
                (
                    c, k, is_open, bytes(p.codes) if is_open else None, table_of(bytes(p.codes)) if is_open else None,
                    None if is_open else s.paths[0][0], None if is_open else s.cost, *p.stats.values(), [p.first, p.last], p.turns, p.distinct,
                )
                for (c, k, p, is_open), s in zip(done, sequences)
            ]
            done.clear()
            arrow = _arrow(schema)
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*data), arrow)], schema=arrow)

        piece, current, opened, waiting = None, None, True, 0
        for c, t, role, blank, cut, first, n in rows():
            if piece is not None and c != current:
                done.append((current, number, piece, opened))
                number, waiting, piece, opened = number + 1, waiting + len(piece.codes), None, False
                if waiting > piece_rows or len(done) >= 10_000:
                    yield out()
                    waiting = 0
            while n:
                if piece is not None and len(piece.codes) >= piece_rows:
                    done.append((current, number, piece, True))
                    number, piece, opened = number + 1, None, True
                    yield out()
                    waiting = 0
                if piece is None:
                    piece, current = _Piece(), c
                some = min(n, piece_rows)
                piece.add(t, role, blank, cut, first, some)
                n, first = n - some, False
        if piece is not None:
            done.append((current, number, piece, True))
        if done:
            yield out()

    return stored(sorted_rows.mapInArrow(run, schema))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _chained(group: pd.DataFrame) -> pd.DataFrame:
    """For the pieces of one conversation: the costs still to come after each, and the sums of the whole on its last row."""
    group = group.sort_values("piece").reset_index(drop=True)
    ends, after = list(finish()), []
    for table in reversed(group["costs"].tolist()):
        after.append(ends)
        steps = np.asarray(table, np.int64).reshape(4, 4)
        ends = np.minimum((steps + np.asarray(ends)).min(axis=1), FAR).tolist()
    links = [(a[1] + b[0]) not in ("su", "ua", "au") for a, b in zip(group["initials"], group["initials"][1:])]
    told = [t for t in group["turns"] if len(t)]
    again = sum(a[1] == b[0] for a, b in zip(told, told[1:]))
    out = group[["c", "piece"]].copy()
    out["ends"] = after[::-1]
    out["closes"] = [False] * (len(group) - 1) + [True]
    out["cost"] = ends[0]
    for name in ("blank", "duplicate", "truncated"):
        out[name] = int(group[name].sum())
    out["illegal"] = int(group["illegal"].sum()) + sum(links)
    out["gaps"] = int(told[-1][1] - told[0][0] + 1 - (group["distinct"].sum() - again)) if told else 0
    return out


def _walked(group: pd.DataFrame) -> pd.DataFrame:
    """The state in which each piece of one conversation begins."""
    group, state, begins = group.sort_values("piece").reset_index(drop=True), 0, []
    for reached in group["reached"]:
        begins.append(state)
        state = int(reached[state])
    out = group[["c", "piece"]].copy()
    out["begin"] = begins
    return out


_HEAD = "audit string, cost bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, gaps bigint"


def joined_pieces(solved: DataFrame, id_field: T.StructField) -> DataFrame:
    """(c, audit, cost, ...) of the conversations that lie in several pieces. A group has one small row per piece, never rows of text."""
    opened = solved.where("open")
    chain = "piece bigint, ends array<bigint>, closes boolean, cost bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, gaps bigint"
    small = opened.select("c", "piece", "costs", "blank", "duplicate", "truncated", "illegal", "initials", "turns", "distinct")
    chained = stored(small.groupBy("c").applyInPandas(_chained, T.StructType([id_field, *T.StructType.fromDDL(chain)])))
    work = opened.select("piece", "codes").join(chained.select("c", "piece", "ends", "closes"), "piece")
    work = work.select("c", "piece", "codes", "ends", "closes")
    schema = T.StructType([id_field, *T.StructType.fromDDL("piece bigint, audits array<string>, reached array<int>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = _arrow(schema)
        for batch in batches:
            for r in range(batch.num_rows):
                c, piece, codes, ends, closes = (batch.column(i)[r].as_py() for i in range(5))
                s = Sequence(codes, tuple(ends), closes, (0, 1, 2, 3))
                least_paths([s])
                data = (c, piece, [p and p[0] for p in s.paths], [p and p[1] for p in s.paths])
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(data, arrow)], schema=arrow)

    audits = stored(work.mapInArrow(run, schema))
    begins = audits.select("c", "piece", "reached").groupBy("c").applyInPandas(_walked, T.StructType([id_field, *T.StructType.fromDDL("piece bigint, begin int")]))
    picked = audits.select("piece", "audits").join(begins, "piece").select("c", "piece", F.get("audits", F.col("begin")).alias("audit"))
    parts = F.sort_array(F.collect_list(F.struct("piece", "audit")))
    whole = picked.groupBy("c").agg(F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"))
    sums = chained.where("closes").drop("piece", "ends", "closes").withColumnRenamed("c", "of")
    return whole.join(sums, F.col("c").eqNullSafe(F.col("of"))).drop("of")


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", times: str | None = None, piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """Per conversation: ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
    blank_text = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" "))
    repeated: Column = F.col(f"`{times}`").cast("bigint") if times else F.lit(1).cast("bigint")
    base = rows.select(
        F.col(f"`{conv_id}`").alias("c"),
        F.col(f"`{turn}`").cast("bigint").alias("t"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"),
        blank_text.alias("text"),
        F.greatest(F.coalesce(repeated, F.lit(0)), F.lit(0)).cast("bigint").alias("n"),
    )
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    blank = ~F.col("text").rlike(SPACE)
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    flags = row_flags(base.select("c", "t", "role", digest.alias("digest"), blank.alias("blank"), cut.alias("cut"), "n"))
    solved = pieces(flags, piece_rows)
    id_field = T.StructField("c", base.schema["c"].dataType)
    names = ["audit", "cost", *_STATS, "gaps"]
    turns = F.col("turns")
    gaps = F.when(F.size(turns) > 0, F.element_at(turns, -1) - F.element_at(turns, 1) + 1 - F.col("distinct")).otherwise(F.lit(0).cast("bigint"))
    heads = solved.where("not open").withColumn("gaps", gaps).select("c", *names).unionByName(joined_pieces(solved, id_field).select("c", *names))
    # conversations without a row left
    zero = F.lit(0).cast("bigint")
    heads = heads.unionByName(flags.select("c").distinct().select("c", F.lit("").alias("audit"), *[zero.alias(n) for n in names[1:]]))

    # the head of a conversation, then its rows in order
    nothing = F.lit(None)
    head = heads.select("c", F.lit(0).alias("kind"), F.struct(*names).alias("head"), nothing.cast("bigint").alias("t"), nothing.cast("string").alias("role"), nothing.cast("binary").alias("digest"), nothing.cast("string").alias("text"), F.length("audit").cast("bigint").alias("n"))
    lines = base.where("n > 0").select("c", F.lit(1).alias("kind"), nothing.cast(head.schema["head"].dataType).alias("head"), "t", "role", digest.alias("digest"), "text", "n")
    order = [F.asc_nulls_first("c"), F.col("kind"), *[F.asc_nulls_first(x) for x in ("t", "role", "digest")], F.desc("n")]
    stream = head.unionByName(lines).repartition("c").sortWithinPartitions(*order).select("c", "kind", "head", "role", "text", "n")
    schema = T.StructType([id_field, *T.StructType.fromDDL(_HEAD + ", repaired_sha256 string")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = _arrow(schema)
        ready: list[tuple] = []
        text_of: _Repaired | None = None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*ready))
            ready.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, arrow)], schema=arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                for c, kind, found, name, content, n in zip(*(batch.slice(at, 4096).column(i).to_pylist() for i in range(6))):
                    if kind == 0:
                        if text_of is not None and text_of.c == c:
                            continue  # the zeros, after the longer audit
                        if text_of is not None:
                            ready.append(text_of.row())
                        text_of = _Repaired(c, found)
                    else:
                        for _ in range(n):
                            text_of.take(name, content)
                if len(ready) >= 4096:
                    yield flush()
        if text_of is not None:
            ready.append(text_of.row())
        if ready:
            yield flush()

    done = stream.mapInArrow(run, schema)
    return done.select(F.col("c").alias(conv_id), "gaps", *_STATS, "cost", "audit", "repaired_sha256")


class _Repaired:
    """Digest of a repaired conversation while its rows pass by in order."""

    def __init__(self, c, head: dict) -> None:
        self.c, self.head, self.at, self.state, self.empty, self.hash = c, head, 0, 0, True, hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        self.hash.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False

    def _answer(self, text: str) -> None:
        self.state = NEXT[self.state]
        self._line("user" if self.state == 2 else "assistant", text)

    def _inserts(self) -> None:
        while self.head["audit"][self.at : self.at + 1] == "I":
            self.at += 1
            self._answer("")

    def take(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.head["audit"][self.at]
        self.at += 1
        if edit == "K":
            self.state = {"s": 1, "u": 2, "a": 3}[role[:1]]
            self._line(role, text)
        elif edit == "R":
            self._answer(text)

    def row(self) -> tuple:
        self._inserts()
        return (self.c, *self.head.values(), self.hash.hexdigest())

"""Conversation structure repair by a Viterbi search that runs in parallel stretches.

A repaired conversation is ``(s?(ua)+)?`` in the initials of its roles.  Every row is kept (0),
given another role (2) or deleted (3); empty turns can be inserted (2); a truncated row that
stays costs 1 more.  Blank and repeated rows must go.  The search has four states: nothing yet,
after the system turn, after a user, after an assistant.  ``back[i][state]`` is the least cost of
the rest of the conversation from row i on; the audit follows it from the front.

1. Rows are put in order by a range exchange, so that a conversation of any size lies in as many
   tasks as it needs, and cut into stretches.
2. Every stretch computes its costs backward at once: the last of a conversation from the true
   end, any other from a speculative vector of equal costs.  Only differences within a vector
   matter, so vectors are kept less their least entry; two that are then equal differ by a constant.
3. Fix-up passes run those stretches again whose right vector proved to be another one.  A run
   ends where its vector meets the one of the run before, so most end after a few rows.
4. With all vectors right, each stretch tells where it ends from each of the four states, these
   are followed from the front, and every stretch traces its own edits.

Rows that must go do not change a vector's differences, so they are not part of the search.
Vectors that never meet (long stretches of foreign roles alone) are, after ``FIX_UPS`` passes,
swept from the back in one task of one byte a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.shared import partitions, shared_folder, ship, staged

#: Rows of a stretch, and bytes of text after which it ends early.
STRETCH_ROWS, STRETCH_BYTES = 128, 1 << 20
FIX_UPS = 8

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT = "KRDI"
_COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
_NEXT_ROLE = ("user", "user", "assistant", "user")
_NEXT_STATE = (USER, USER, ASSISTANT, USER)
_AT_END, _UNKNOWN = (0, 4, 2, 0), (0, 0, 0, 0)
#: Code of a row that must go; others are four times "truncated" plus the place of the initial in "sua" (3: foreign).
_GOES = 8

_PIECE = (
    "part int, k int, conv_id long, opens boolean, closes boolean, codes binary, roles array<string>, texts array<string>,"
    " copies array<long>, min_turn long, max_turn long, n_turns long, blank long, duplicate long, truncated long,"
    " illegal long, first_initial string, last_initial string"
)
_STATS = ["min_turn", "max_turn", "n_turns", "blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial"]
_ANSWER = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string,"
    " repaired_sha256 string"
)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` after damage drawn from their ids; ``copies`` is 0 for a dropped row.

    Null roles and texts are one space, as are nulls in what the damage is drawn from.
    """
    space = F.lit(" ")
    drawn = F.crc32(
        F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    )
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (drawn % 20).alias("drawn"),
    )
    text = F.when(F.col("drawn") == 1, F.lit("")).when(F.col("drawn") == 2, F.regexp_replace("text", "[.!?]", ""))
    return rows.select(
        "conv_id", "turn", F.when(F.col("drawn") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.when(F.col("drawn") == 0, 0).when(F.col("drawn") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def repair_conversations(rows: DataFrame, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """Each conversation's stretches in order: ``conv_id``, ``g``, ``whole``, counts, ``cost``, ``audit``, ``repaired``.

    ``rows`` has ``conv_id``, ``turn``, ``role``, ``text`` and ``copies`` (0: the row only says that
    the conversation exists).  Rows are taken by turn, nulls first, ties by role and then by the
    SHA-256 of the text; equal rows stand together.  A null role or text is an empty one, null
    ids are one conversation, and an empty table gives no rows.  ``repaired`` is the stretch's
    ``role:text`` lines, each ended by a newline; ``whole`` marks a conversation of one stretch.
    """
    spark = rows.sparkSession
    ship(spark)
    folder = shared_folder(spark, "repair")
    pieces = staged(_in_order(rows).mapInArrow(lambda batches: _cut(batches, stretch_rows), _PIECE), folder, "pieces")
    pieces = _numbered(pieces)
    split = pieces.where("not whole")
    if not split.take(1):
        return pieces.withColumn("back", _literal(_AT_END)).withColumn("enter", F.lit(START)).mapInArrow(_traced, _traced_schema())
    split = staged(split.select("g", "conv_id", "opens", "closes", "codes"), folder, "split")
    known = _entered(split, _settled(split, folder), folder)
    with_costs = pieces.join(known, "g", "left").withColumn("back", F.coalesce("back", _literal(_AT_END)))
    return with_costs.withColumn("enter", F.coalesce("enter", F.lit(START))).mapInArrow(_traced, _traced_schema())


def summaries(stretches: DataFrame) -> DataFrame:
    """One row a conversation: ``gaps``, fault counts, ``cost``, ``audit`` and the SHA-256 of the repaired lines.

    Stretches of one conversation are hashed in order as a stream; a task holds its audit, one character a row.
    """
    several = stretches.where("not whole").repartition(partitions(stretches.sparkSession), "conv_id")
    several = several.sortWithinPartitions("conv_id", "g")
    one = stretches.where("whole").mapInArrow(_joined, _ANSWER)
    return one.unionByName(several.mapInArrow(_joined, _ANSWER))


def _in_order(rows: DataFrame) -> DataFrame:
    """Distinct rows of each conversation in order, with their copies and whether they are the first of their text."""
    none = F.lit("")
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", none).alias("role"), F.coalesce("text", none).alias("text"), F.col("copies").cast("long").alias("copies"),
    )
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    there = F.col("copies") > 0
    firsts = (
        rows.where(there & F.col("text").rlike(r"[^\x20\x09-\x0D]"))
        .groupBy("conv_id", "role", "digest")
        .agg(F.min("turn").alias("turn"), F.max(F.col("turn").isNull()).alias("undated"))
        .select(
            "conv_id", F.when(~F.col("undated"), F.col("turn")).alias("turn"), "role", "digest",
            F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies"), F.lit(1).alias("first"),
        )
    )
    # a dropped row is one mark a conversation; marks and rows meet in one aggregate, which takes any number of equal rows
    kept = [F.when(there, F.col(c)).alias(c) for c in ("turn", "role", "digest", "text")]
    every = rows.select("conv_id", *kept, "copies", F.lit(0).alias("first")).unionByName(firsts)
    distinct = every.groupBy("conv_id", "turn", "role", "digest").agg(
        F.first("text", ignorenulls=True).alias("text"), F.sum("copies").alias("copies"), F.max("first").alias("first")
    )
    keys = ["conv_id", "turn", "role", "digest"]
    ranged = distinct.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    return ranged.select("conv_id", "turn", "role", "text", "copies", "first")


class _Piece:
    """A stretch as it is filled."""

    def __init__(self, conv, opens: bool):
        self.conv, self.opens, self.closes = conv, opens, False
        self.codes, self.roles, self.texts, self.copies = bytearray(), [], [], []
        self.low = self.high = None
        self.n_turns = self.blank = self.duplicate = self.truncated = self.illegal = self.size = 0
        self.first = self.last = None

    def add(self, turn, role: str, text: str, copies: int, is_first: bool) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.n_turns = turn, self.n_turns + 1
        initial = role[:1]
        if self.first is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.illegal += copies - 1
        self.last = initial
        said = text.strip(SPACE)
        if not said:
            self.blank += copies
        else:
            self.duplicate += copies - is_first
        if said and is_first:
            cut_off = said[-1] not in ".!?"
            self.truncated += cut_off
            self.codes.append(4 * cut_off + ("sua".find(initial) if initial and initial in "sua" else 3))
        else:
            self.codes.append(_GOES)
        self.roles.append(role)
        self.texts.append(text)
        self.copies.append(copies)
        self.size += len(text)

    def row(self, part: int, k: int) -> tuple:
        return (
            part, k, self.conv, self.opens, self.closes, bytes(self.codes), self.roles, self.texts, self.copies, self.low,
            self.high, self.n_turns, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last,
        )


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {
        "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string(),
        "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()),
    }
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f[1]]) for c, f in zip(columns, fields)], [f[0] for f in fields])


def _in_batches(rows: Iterator[tuple], schema: str, weight) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about a megabyte, by ``weight`` of each."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + weight(row)
        if size > 1 << 20:
            yield _table(held, schema)
            held, size = [], 0
    if held:
        yield _table(held, schema)


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            yield from batch.slice(lo, 1000).to_pylist()


def _cut(batches: Iterator[pa.RecordBatch], stretch_rows: int) -> Iterator[pa.RecordBatch]:
    """The stretches of a task's rows, which come in order."""

    def pieces() -> Iterator[tuple]:
        part = TaskContext.get().partitionId()
        k, piece = 0, None
        for row in _rows_of(batches):
            new = piece is None or piece.conv != row["conv_id"]
            if new or len(piece.codes) >= stretch_rows or piece.size >= STRETCH_BYTES:
                if piece is not None:
                    piece.closes = new
                    yield piece.row(part, k)
                    k += 1
                piece = _Piece(row["conv_id"], new)
            if row["copies"]:
                piece.add(row["turn"], row["role"], row["text"], row["copies"], bool(row["first"]))
        if piece is not None:
            piece.closes = True
            yield piece.row(part, k)

    return _in_batches(pieces(), _PIECE, lambda p: sum(map(len, p[7])) + 20 * len(p[7]))


def _numbered(pieces: DataFrame) -> DataFrame:
    """Stretches with their number ``g`` in the whole order, and whether they really begin and end a conversation.

    The driver gets one row a task of the range exchange.
    """
    ends = F.struct("k", F.col("conv_id").alias("conv"))
    parts = pieces.groupBy("part").agg(F.count("*").alias("n"), F.min(ends).alias("head"), F.max(ends).alias("tail"))
    bounds, upto, before = [], 0, None
    for row in sorted(parts.collect(), key=lambda r: r.part):
        joins = before is not None and before[1] == row.head.conv
        if joins:
            bounds[-1][3] = True
        bounds.append([row.part, upto, joins, False, row.n])
        upto, before = upto + row.n, (row.part, row.tail.conv)
    bounds = pieces.sparkSession.createDataFrame(bounds, "part int, upto long, from_before boolean, goes_on boolean, n long")
    out = pieces.join(F.broadcast(bounds), "part").withColumns(
        {
            "g": F.col("upto") + F.col("k"),
            "opens": F.col("opens") & ~(F.col("from_before") & (F.col("k") == 0)),
            "closes": F.col("closes") & ~(F.col("goes_on") & (F.col("k") == F.col("n") - 1)),
        }
    )
    return out.withColumn("whole", F.col("opens") & F.col("closes")).drop("upto", "from_before", "goes_on", "n", "part", "k")


# The search.  Vectors are tuples of four costs, the least of them 0.


def _kept_to(state: int, initial: int) -> int | None:
    """The state after keeping a row whose initial is at that place of "sua"."""
    if initial == 0 and state == START:
        return SYSTEM
    if initial in (1, 2) and _NEXT_STATE[state] == initial + 1:
        return initial + 1
    return None


def _costs(code: int, after: tuple) -> list[int]:
    """Least costs from each state before a row, not brought down to 0."""
    cut_off, initial = divmod(code, 4)
    out = []
    for state in range(4):
        options = [_COST[DELETE] + after[state], _COST[REROLE] + cut_off + after[_NEXT_STATE[state]]]
        kept = _kept_to(state, initial)
        if kept is not None:
            options.append(cut_off + after[kept])
        out.append(min(options))
    out[USER], out[ASSISTANT] = min(out[USER], 2 + out[ASSISTANT]), min(out[ASSISTANT], 2 + out[USER])
    return [min(cost, 2 + out[_NEXT_STATE[state]]) for state, cost in enumerate(out)]


@lru_cache(maxsize=None)
def _before(code: int, after: tuple) -> tuple:
    """The vector before a row; there are few vectors, so every step is soon known."""
    costs = _costs(code, after)
    least = min(costs)
    return tuple(c - least for c in costs)


@lru_cache(maxsize=None)
def _edits(code: int, after: tuple, state: int) -> tuple[str, int, tuple[str | None, ...]]:
    """The least edits by ASCII that cost least up to and with a row; the state after it, and the lines' roles.

    A role of None is the row's own; a deleted row has no line.
    """
    cut_off, initial = divmod(code, 4)
    costs, audit, roles = _costs(code, after), "", []
    while True:
        kept = _kept_to(state, initial)
        options = [(_COST[DELETE] + after[state], DELETE), (_COST[INSERT] + costs[_NEXT_STATE[state]], INSERT)]
        if kept is not None:
            options.append((cut_off + after[kept], KEEP))
        options.append((_COST[REROLE] + cut_off + after[_NEXT_STATE[state]], REROLE))
        edit = min(options)[1]
        audit += edit
        if edit == DELETE:
            return audit, state, tuple(roles)
        if edit == KEEP:
            return audit, kept, (*roles, None)
        roles.append(_NEXT_ROLE[state])
        state = _NEXT_STATE[state]
        if edit == REROLE:
            return audit, state, tuple(roles)


def _literal(vector: tuple):
    return F.lit(_packed(vector))


def _packed(vector: tuple) -> int:
    return int.from_bytes(bytes(vector), "big")


def _unpacked(number: int) -> tuple:
    return tuple(number.to_bytes(4, "big"))


def _back(codes: bytes, right: tuple) -> tuple:
    for code in reversed(codes):
        if code != _GOES:
            right = _before(code, right)
    return right


def _speculated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every stretch backward, from the true end or from the speculative vector."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            right = _AT_END if row["closes"] else _UNKNOWN
            rows.append((row["g"], row["conv_id"], row["closes"], _packed(right), _packed(_back(row["codes"], right))))
        yield _table(rows, _STATE)


_STATE = "g long, conv_id long, closes boolean, back long, front long"


def _fixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches again from another right vector, as far as it differs from the run before by more than a constant."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            old, new, front = _unpacked(row["back"]), _unpacked(row["now"]), row["front"]
            for code in reversed(row["codes"]):
                if old == new:
                    break
                if code != _GOES:
                    old, new = _before(code, old), _before(code, new)
            rows.append((row["g"], row["conv_id"], row["closes"], row["now"], front if old == new else _packed(new)))
        yield _table(rows, _STATE)


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches from the last to the first of each conversation, each from the vector of the one after it."""
    right = _AT_END
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            right = _AT_END if row["closes"] else right
            left = _back(row["codes"], right)
            rows.append((row["g"], row["conv_id"], row["closes"], _packed(right), _packed(left)))
            right = left
        yield _table(rows, _STATE)


def _settled(split: DataFrame, folder: str) -> DataFrame:
    """``g`` and its right vector, ``back``, for every stretch of a conversation of several."""
    state = staged(split.select("g", "conv_id", "closes", "codes").mapInArrow(_speculated, _STATE), folder, "state_0")
    for turn in range(1, FIX_UPS + 1):
        after = state.select((F.col("g") - 1).alias("g"), F.col("front").alias("now"))
        seen = state.join(after, "g", "left").withColumn("now", F.when(F.col("closes"), F.col("back")).otherwise(F.col("now")))
        again = staged(seen.where("now <> back"), folder, f"again_{turn}")
        if not again.take(1):
            return state.select("g", "back")
        fixed = again.join(split.select("g", "codes"), "g").mapInArrow(_fixed, _STATE)
        state = staged(state.join(again.select("g"), "g", "left_anti").unionByName(fixed), folder, f"state_{turn}")
    swept = split.select("g", "conv_id", "closes", "codes").repartition(partitions(split.sparkSession), "conv_id")
    swept = swept.sortWithinPartitions("conv_id", F.desc("g")).mapInArrow(_swept, _STATE)
    return staged(swept, folder, "swept").select("g", "back")


def _entered(split: DataFrame, settled: DataFrame, folder: str) -> DataFrame:
    """``g``, ``back`` and ``enter``, the state in which the audit comes to the stretch.

    Each stretch says where it ends from each state; that is one short row a stretch, which are followed in order.
    """
    ends = split.join(settled, "g").select("g", "conv_id", "opens", "codes", "back").mapInArrow(
        _exits, "g long, conv_id long, opens boolean, back long, exits long"
    )
    ends = staged(ends, folder, "exits").repartition(partitions(split.sparkSession), "conv_id")
    followed = ends.sortWithinPartitions("conv_id", "g").mapInArrow(_followed, "g long, back long, enter int")
    return staged(followed, folder, "entered")


def _vectors(codes: bytes, right: tuple) -> list[tuple]:
    """The vector after each row."""
    after = [right] * len(codes)
    for i in range(len(codes) - 1, 0, -1):
        after[i - 1] = after[i] if codes[i] == _GOES else _before(codes[i], after[i])
    return after


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            after = _vectors(row["codes"], _unpacked(row["back"]))
            ends = []
            for state in range(4):
                for code, vector in zip(row["codes"], after):
                    if code != _GOES:
                        state = _edits(code, vector, state)[1]
                ends.append(state)
            rows.append((row["g"], row["conv_id"], row["opens"], row["back"], _packed(tuple(ends))))
        yield _table(rows, "g long, conv_id long, opens boolean, back long, exits long")


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state = START
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            state = START if row["opens"] else state
            rows.append((row["g"], row["back"], state))
            state = _unpacked(row["exits"])[state]
        yield _table(rows, "g long, back long, enter int")


def _traced_schema() -> str:
    kinds = dict(field.split() for field in _PIECE.split(", "))
    stats = ", ".join(f"{name} {kinds[name]}" for name in _STATS)
    return f"conv_id long, g long, opens boolean, closes boolean, whole boolean, {stats}, cost long, audit string, repaired string"


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every stretch with its edits and its repaired lines."""

    def traced() -> Iterator[tuple]:
        for row in _rows_of(batches):
            state, codes = row["enter"], row["codes"]
            audit, lines, cost = [], [], 0
            for i, after in enumerate(_vectors(codes, _unpacked(row["back"]))):
                if codes[i] == _GOES:
                    audit.append(DELETE * row["copies"][i])
                    cost += _COST[DELETE] * row["copies"][i]
                    continue
                edits, state, roles = _edits(codes[i], after, state)
                audit.append(edits + DELETE * (row["copies"][i] - 1))
                cost += sum(_COST[e] for e in edits) + _COST[DELETE] * (row["copies"][i] - 1)
                cost += codes[i] >= 4 and edits[-1] != DELETE
                own = edits[-1] != DELETE
                lines += [f"{role}:\n" for role in (roles[:-1] if own else roles)]
                if own:
                    lines.append(f"{row['roles'][i] if roles[-1] is None else roles[-1]}:{row['texts'][i]}\n")
            while row["closes"] and _AT_END[state]:
                audit.append(INSERT)
                cost += _COST[INSERT]
                lines.append(f"{_NEXT_ROLE[state]}:\n")
                state = _NEXT_STATE[state]
            head = (row["conv_id"], row["g"], row["opens"], row["closes"], row["whole"])
            yield (*head, *(row[name] for name in _STATS), cost, "".join(audit), "".join(lines))

    return _in_batches(traced(), _traced_schema(), lambda r: len(r[-1]) + len(r[-2]))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation from its stretches, which come in order; the lines are only hashed."""

    def joined() -> Iterator[tuple]:
        for row in _rows_of(batches):
            if row["opens"]:
                digest, audit, counts = hashlib.sha256(), [], dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
                low = high = last = None
                n_turns, empty = 0, True
            for name in counts:
                counts[name] += row[name]
            if row["min_turn"] is not None:
                n_turns += row["n_turns"] - (high == row["min_turn"])
                low, high = row["min_turn"] if low is None else low, row["max_turn"]
            if row["first_initial"] is not None:
                counts["illegal"] += last is not None and last + row["first_initial"] not in ("su", "ua", "au")
                last = row["last_initial"]
            audit.append(row["audit"])
            if row["repaired"]:  # newlines stand between lines only
                digest.update(("" if empty else "\n").encode() + row["repaired"][:-1].encode())
                empty = False
            if row["closes"]:
                gaps = 0 if low is None else min(high - low + 1 - n_turns, 2**63 - 1)
                faults = (counts[name] for name in ("blank", "duplicate", "truncated", "illegal", "cost"))
                yield (row["conv_id"], gaps, *faults, "".join(audit), digest.hexdigest())

    return _in_batches(joined(), _ANSWER, lambda r: len(r[-2]))

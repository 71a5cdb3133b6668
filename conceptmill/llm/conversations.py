"""Operator 11. Repair of conversations: weighted interval parsing (CYK) under a repair grammar.

The legal sequences of roles, ``(s?(ua)+)?`` by their initials, are a grammar in Chomsky
normal form: a nonterminal (p, q) stands for turns that lead from state p to state q, its
binary rules are (p, q) -> (p, m) (m, q), its terminal rules are the edits of one turn (keep,
new role, delete), and (p, q) -> empty by insertions is closed beforehand. A cell of a span
of turns holds the least (cost, audit) of each nonterminal. As nonterminals name the states
at both ends, any one split of a span gives its whole cell, so spans are combined bottom-up by
length, two neighbours of a length at a time, and n turns need n - 1 combinations.

Least cells of parts give the least cell of the whole: of two audits of one span with one cost
none is the beginning of the other (both hold a letter for each turn, so the longer one has more
insertions and costs more), hence a smaller part stays smaller whatever follows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from conceptmill.llm.common import written

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = ".!?"
# Costs of the edits; a turn that breaks off costs more unless it is deleted.
REROLE, DELETE, INSERT, BREAKS_OFF = 3, 4, 3, 3
LEGAL_PAIRS = {"su", "ua", "au"}
FINE, BLANK, BROKEN_OFF, REPEATED = range(4)
# States: nothing yet, after the system's turn, after a question, after an answer.
START, TOLD, ASKED, ANSWERED = range(4)
MOVES = {(START, "s"): TOLD, (START, "u"): ASKED, (TOLD, "u"): ASKED, (ASKED, "a"): ANSWERED, (ANSWERED, "u"): ASKED}
ENDINGS = (START, ANSWERED)
# The role that a new or renamed turn gets in each state.
NEXT = {START: "user", TOLD: "user", ASKED: "assistant", ANSWERED: "user"}
NEVER = (1 << 60, "")
# Turns of one conversation whose span is one row between tasks, and characters that order turns.
PIECE_TURNS = 1 << 16
HEAD = 40

Cell = list[tuple[int, str]]
PAIRS = [(p, q) for p in range(4) for q in range(4) if p == q or q >= ASKED or (p, q) == (START, TOLD)]
AT = {pair: i for i, pair in enumerate(PAIRS)}
RULES = [[(AT[p, m], AT[m, q]) for m in range(4) if (p, m) in AT and (m, q) in AT] for p, q in PAIRS]


def joined(left: Cell, right: Cell) -> Cell:
    """Cell of two neighbouring spans."""
    cell = []
    for rules in RULES:
        best = NEVER
        for a, b in rules:
            x, y = left[a], right[b]
            cost = x[0] + y[0]
            if cost <= best[0] and (cost < best[0] or x[1] + y[1] < best[1]):
                best = (cost, x[1] + y[1])
        cell.append(best)
    return cell


def _cell(options: dict[tuple[int, int], tuple[int, str]]) -> Cell:
    return [options.get(pair, NEVER) for pair in PAIRS]


def insertions() -> Cell:
    """Cell of an empty span: the cheapest insertions that lead from state to state."""
    one = _cell({(p, MOVES[p, role[0]]): (INSERT, "I") for p, role in NEXT.items()})
    cell = _cell({(p, p): (0, "") for p in range(4)})
    for _ in PAIRS:
        cell = [min(x) for x in zip(cell, joined(cell, one), strict=True)]
    return cell


EMPTY = insertions()


def turn_cell(initial: str, fault: int) -> Cell:
    """Cell of one turn with all insertions before and after it."""
    options = {(p, p): (DELETE, "D") for p in range(4)}
    if fault in (FINE, BROKEN_OFF):
        more = BREAKS_OFF if fault == BROKEN_OFF else 0
        for (p, role), q in MOVES.items():
            if role == initial:
                options[p, q] = (more, "K")
            elif role != "s":
                options[p, q] = (REROLE + more, "R")
    return joined(joined(EMPTY, _cell(options)), EMPTY)


CELLS = {(initial, fault): turn_cell(initial, fault) for initial in ("s", "u", "a", "") for fault in range(4)}


class Spans:
    """Neighbouring spans of a conversation, shorter ones last; equally long ones are combined."""

    def __init__(self) -> None:
        self.spans: list[tuple[int, Cell]] = []

    def add(self, cell: Cell, length: int = 1) -> None:
        while self.spans and self.spans[-1][0] <= length:
            before, left = self.spans.pop()
            cell, length = joined(left, cell), before + length
        self.spans.append((length, cell))

    def add_times(self, cell: Cell, times: int) -> None:
        """A span of ``times`` equal turns, by doubling."""
        length = 1
        while times:
            if times & 1:
                self.add(cell, length)
            times >>= 1
            if times:
                cell, length = joined(cell, cell), 2 * length

    def whole(self) -> Cell:
        cell, parts = EMPTY, [c for _, c in self.spans]
        for part in reversed(parts):
            cell = joined(part, cell)
        return cell


def best_parse(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    return min(cell[AT[START, q]] for q in ENDINGS)


class Piece:
    """What is known of consecutive turns of one conversation."""

    COUNTS = "blank", "duplicate", "truncated", "illegal", "n_turns"

    def __init__(self) -> None:
        self.spans, self.length = Spans(), 0
        self.counts = dict.fromkeys(self.COUNTS, 0)
        self.first_initial = self.last_initial = None
        self.first_turn = self.last_turn = None

    def add(self, turn: int | None, initial: str, fault: int, again: bool, copies: int) -> None:
        """``copies`` equal turns; ``again`` if an earlier turn has the same role and text."""
        if not copies:
            return
        first = REPEATED if again and fault != BLANK else fault
        rest = BLANK if fault == BLANK else REPEATED
        self.counts["blank"] += copies * (fault == BLANK)
        self.counts["duplicate"] += (first == REPEATED) + (copies - 1) * (rest == REPEATED)
        self.counts["truncated"] += first == BROKEN_OFF
        known = initial if initial in ("s", "u", "a") else ""
        self.spans.add(CELLS[known, first])
        self.spans.add_times(CELLS[known, rest], copies - 1)
        self._follow(known, known, (copies - 1) * (known + known not in LEGAL_PAIRS), turn, turn, int(turn is not None))
        self.length += 1

    def add_piece(self, row: dict) -> None:
        """The piece that follows, as it was written."""
        if row["first_initial"] is None:
            return
        for name in ("blank", "duplicate", "truncated"):
            self.counts[name] += row[name]
        self.spans.add([(c, a) for c, a in zip(row["costs"], row["audits"], strict=True)], max(1, row["length"]))
        self._follow(
            row["first_initial"], row["last_initial"], row["illegal"], row["first_turn"], row["last_turn"], row["n_turns"]
        )

    def _follow(self, first: str, last: str, illegal: int, first_turn: int | None, last_turn: int | None, n_turns: int) -> None:
        border = self.last_initial is not None and self.last_initial + first not in LEGAL_PAIRS
        self.counts["illegal"] += illegal + border
        self.first_initial = first if self.first_initial is None else self.first_initial
        self.last_initial = last
        if first_turn is not None:
            self.counts["n_turns"] += n_turns - (first_turn == self.last_turn)
            self.first_turn = first_turn if self.first_turn is None else self.first_turn
            self.last_turn = last_turn

    def row(self) -> dict:
        cell = self.spans.whole()
        return {
            **self.counts, "length": self.length, "first_initial": self.first_initial, "last_initial": self.last_initial,
            "first_turn": self.first_turn, "last_turn": self.last_turn,
            "costs": [c for c, _ in cell], "audits": [a for _, a in cell],
        }

    def report(self) -> dict:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.counts["n_turns"]
        cost, audit = best_parse(self.spans.whole())
        counts = {name: self.counts[name] for name in self.COUNTS[:4]}
        return {"gaps": gaps, **counts, "cost": cost, "audit": audit}


PIECE_SCHEMA = (
    "part int, piece int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, n_turns bigint, length bigint, "
    "first_initial string, last_initial string, first_turn bigint, last_turn bigint, costs array<bigint>, audits array<string>"
)
REPORT_SCHEMA = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _with_id(conversations: DataFrame, schema: str) -> StructType:
    return StructType([StructField("conv_id", conversations.schema["conv_id"].dataType), *StructType.fromDDL(schema)])


def _batches(rows: Iterator[dict], schema: StructType, size: int = 2000) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, held = to_arrow_schema(schema), []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, arrow)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, arrow)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            yield from batch.slice(start, 500).to_pylist()


def _plain(conversations: DataFrame) -> DataFrame:
    """The four columns, null role and text as one space, and what orders turns within a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text")).select(
        "*",
        F.substring("role", 1, HEAD).alias("role_head"),
        F.substring("text", 1, HEAD).alias("text_head"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("digest"),
    )


ORDER = ("turn", "role_head", "text_head", "digest")


def skeleton(conversations: DataFrame, also: DataFrame | None = None) -> DataFrame:
    """(conv_id, order columns, initial, fault, copies, again): turns without their texts, equal ones as one row.

    A group of equal turns, or of turns with one role and text, collapses before it is
    shuffled. ``also``: conversations without turns, as rows of no copies.
    """
    spoken = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (
        F.when(spoken == "", BLANK).when(~F.substring(spoken, -1, 1).isin(*ENDS), BROKEN_OFF).otherwise(FINE)
    )
    rows = (
        _plain(conversations)
        .select("conv_id", *ORDER, F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
        .groupBy("conv_id", *ORDER, "initial", "fault")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    repeated = (
        rows.groupBy(F.col("conv_id").alias("same_id"), F.col("digest").alias("same_digest"))
        .agg(F.min("turn").alias("least"), F.bool_or(F.isnull("turn")).alias("unplaced"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    same = F.col("conv_id").eqNullSafe(F.col("same_id")) & (F.col("digest") == F.col("same_digest"))
    again = F.col("turn").isNotNull() & (F.col("unplaced") | (F.col("turn") > F.col("least")))
    rows = rows.join(repeated, same, "left").select(
        "conv_id", *ORDER, "initial", "fault", "copies", F.coalesce(again, F.lit(False)).alias("again")
    )
    if also is not None:
        kinds = dict(rows.dtypes)
        fixed = {"fault": F.lit(FINE), "copies": F.lit(0).cast("bigint"), "again": F.lit(False)}
        none = [fixed.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in rows.columns[1:]]
        rows = rows.unionByName(also.select(F.col("conv_id").cast(kinds["conv_id"])).distinct().select("conv_id", *none))
    return rows


def conversation_report(conversations: DataFrame, also: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit): a row for each conversation.

    Turns stand in the order of their number, nulls first; turns of one number by the first
    characters of role and text, then by checksum. Sorted turns are cut into ranges, so a
    conversation may hold any share of all rows: each task parses its piece of it, and the pieces'
    spans are combined in turn. Text never moves.

    gaps: numbers that are missing between the least and the greatest. blank, duplicate,
    truncated: the first fault of each turn. illegal: neighbours whose roles may not follow
    each other. cost and audit: of the cheapest repair, one letter for each edit (Keep, Rerole,
    Delete, Insert), the least text of equally cheap ones.

    Null ids are one conversation. A null role or text counts as one space, an empty role as no
    known role. Conversations in ``also`` (conv_id) without turns have zeros and an empty
    audit. An empty table gives no rows. Other columns are ignored.
    """
    rows = written(skeleton(conversations, also), "turns")
    ordered = rows.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER)
    piece_schema, report_schema = _with_id(conversations, PIECE_SCHEMA), _with_id(conversations, REPORT_SCHEMA)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def pieces() -> Iterator[dict]:
            now, piece, number = None, None, 0
            for row in _rows(batches):
                if piece is None or row["conv_id"] != now or piece.length >= PIECE_TURNS:
                    if piece is not None:
                        yield {"conv_id": now, "part": part, "piece": number, **piece.row()}
                    now, piece, number = row["conv_id"], Piece(), number + 1
                piece.add(row["turn"], row["initial"], row["fault"], row["again"], row["copies"])
            if piece is not None:
                yield {"conv_id": now, "part": part, "piece": number, **piece.row()}

        yield from _batches(pieces(), piece_schema)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def reports() -> Iterator[dict]:
            now, piece = None, None
            for row in _rows(batches):
                if piece is None or row["conv_id"] != now:
                    if piece is not None:
                        yield {"conv_id": now, **piece.report()}
                    now, piece = row["conv_id"], Piece()
                piece.add_piece(row)
            if piece is not None:
                yield {"conv_id": now, **piece.report()}

        yield from _batches(reports(), report_schema)

    columns = ["conv_id", *ORDER, "initial", "fault", "copies", "again"]
    pieces = ordered.select(*columns).mapInArrow(parse, piece_schema)
    return (
        pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").mapInArrow(combine, report_schema)
    )


def edited(rows: Iterator[dict]) -> Iterator[dict]:
    """Turns after the edits. A row without a digest brings the audit of the turns that follow."""
    now, audit, at, state, place = None, "", 0, START, 0

    def turn(edit: str, role: str, text: str, number: int | None) -> dict:
        nonlocal state, place
        state = MOVES[state, role[0]]
        place += 1
        return {"conv_id": now, "place": place - 1, "edit": edit, "turn": number, "role": role, "text": text}

    def inserted() -> Iterator[dict]:
        nonlocal at
        while audit[at : at + 1] == "I":
            at += 1
            yield turn("I", NEXT[state], "", None)

    for row in rows:
        if row["digest"] is None:
            yield from inserted()
            now, audit, at, state, place = row["conv_id"], row["text"], 0, START, 0
            continue
        yield from inserted()
        edit, at = audit[at], at + 1
        if edit != "D":
            yield turn(edit, row["role"] if edit == "K" else NEXT[state], row["text"], row["turn"])
    yield from inserted()


def repaired_turns(conversations: DataFrame, report: DataFrame) -> DataFrame:
    """(conv_id, place, edit, turn, role, text): the turns that remain or are new, as ``report`` has them.

    ``report`` is of ``conversation_report`` over the same rows. place counts from 0; inserted
    turns have no number and an empty text. Turns of a conversation stand in order within one partition;
    they pass one by one, so memory does not grow with a conversation.
    """
    schema = _with_id(conversations, "place bigint, edit string, turn bigint, role string, text string")
    turns = _plain(conversations)
    kinds = dict(turns.dtypes)
    heads = report.select(
        "conv_id", *(F.col("audit").alias(c) if c == "text" else F.lit(None).cast(kinds[c]).alias(c) for c in turns.columns[1:])
    )

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(edited(_rows(batches)), schema, 500)

    placed = turns.unionByName(heads).withColumn("is_turn", F.isnotnull("digest"))
    ordered = placed.repartition("conv_id").sortWithinPartitions("conv_id", "is_turn", *ORDER)
    return ordered.select("conv_id", "turn", "role", "text", "digest").mapInArrow(edit, schema)


def conversation_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the ``role:text`` lines of each conversation of ``repaired_turns``."""
    schema = _with_id(turns, "repaired_sha256 string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sums() -> Iterator[dict]:
            now, total = None, None
            for row in _rows(batches):
                if row["place"] == 0:
                    if total is not None:
                        yield {"conv_id": now, "repaired_sha256": total.hexdigest()}
                    now, total = row["conv_id"], hashlib.sha256()
                else:
                    total.update(b"\n")
                total.update(f"{row['role']}:{row['text']}".encode())
            if total is not None:
                yield {"conv_id": now, "repaired_sha256": total.hexdigest()}

        yield from _batches(sums(), schema)

    return turns.select("conv_id", "place", "role", "text").mapInArrow(digest, schema)


def repair_conversations(conversations: DataFrame, also: DataFrame | None = None) -> DataFrame:
    """The report of each conversation with ``repaired_sha256`` of its repaired ``role:text`` lines.

    A conversation with no turn left has the digest of no bytes.
    """
    report = written(conversation_report(conversations, also), "repairs")
    sums = conversation_digests(repaired_turns(conversations, report)).withColumnRenamed("conv_id", "same_id")
    return (
        report.join(sums, F.col("conv_id").eqNullSafe(F.col("same_id")), "left")
        .drop("same_id")
        .withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())))
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with faults to repair, by crc32 of ``conv_id:turn`` modulo 20 (a null is one space).

    0 drops a turn, 1 empties its text, 2 takes out its ``.!?``, 3 repeats it, 4 makes it the user's.
    """
    conv_id, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    key = F.concat(conv_id, F.lit(":"), turn)
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    ).where("times > 0")
    return rows.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("times")

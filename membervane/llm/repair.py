"""Repair of the order of roles in conversations, at the least cost, by block tables (Four Russians).

The rows of a conversation become symbols; the cheapest edits are a walk through a machine of four states that accepts
``(s?(ua)+)?`` in role initials. What is left to pay from a row on is a vector of one cost per state. Less its smallest
entry it is one of a few vectors, so what a block of ``LENGTH`` symbols does to a vector is looked up in a table
made beforehand. Conversations are run through it block by block from the end; the vectors kept at the borders of blocks are then
expanded backward inside a block, row by row, wherever the walk comes through. As these are costs still to pay, the walk can
take at each step the least letter among the cheapest ones: ties are broken over the whole string, not block by block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Costs of edits, and what an unfinished text adds to a row that stays.
REROLE, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1
#: States: nothing yet, after the system's turn, after a user's, after an assistant's. Where a kept initial leads.
START, SYSTEM, USER, ASSISTANT = range(4)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Where a turn leads whose role is chosen, be it given to a row or inserted.
CHOSEN = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Costs left at the end: only an assistant's turn, or no turn, may be the last.
LAST = (0, 4, 2, 0)
#: Symbols: a row that must go, then kept initials (``x``: any other), the same unfinished, and one for no row at all.
GONE, NOTHING = 0, 9
ROWS = [("s", 0), ("u", 0), ("a", 0), ("x", 0), ("s", UNFINISHED), ("u", UNFINISHED), ("a", UNFINISHED), ("x", UNFINISHED)]
LENGTH = 4
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def _moves(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Edits that take the row away from before the walk: (letter, cost, next state)."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        initial, more = ROWS[symbol - 1]
        if (state, initial) in KEPT:
            out.append(("K", more, KEPT[state, initial]))
        out.append(("R", REROLE + more, CHOSEN[state]))
    return out


def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs left before a row, from those after it."""
    if symbol == NOTHING:
        return after
    costs = [min(cost + after[to] for _, cost, to in _moves(symbol, state)) for state in range(4)]
    for _ in range(2):
        costs = [min(cost, INSERT + costs[CHOSEN[state]]) for state, cost in enumerate(costs)]
    return tuple(costs)


class Tables:
    """Normalised vectors, and what each block of symbols does to each: number of the vector before it, and the costs it adds."""

    def __init__(self) -> None:
        self.vectors: list[tuple[int, ...]] = [LAST]
        numbers = {LAST: 0}
        single: list[list[tuple[int, int]]] = []
        for vector in self.vectors:  # grows while it is read
            row = []
            for symbol in range(NOTHING + 1):
                costs = _before(symbol, vector)
                least = min(costs)
                found = tuple(c - least for c in costs)
                if found not in numbers:
                    numbers[found] = len(self.vectors)
                    self.vectors.append(found)
                row.append((numbers[found], least))
            single.append(row)
        self.single = single
        self.blocks: list[list[tuple[int, int]]] = []
        for block in product(range(NOTHING + 1), repeat=LENGTH):
            row = []
            for number in range(len(self.vectors)):
                paid = 0
                for symbol in reversed(block):
                    number, more = single[number][symbol]
                    paid += more
                row.append((number, paid))
            self.blocks.append(row)
        self._walks: dict[tuple[int, int, int], tuple[str, int]] = {}

    def step(self, symbol: int, after: int, state: int) -> tuple[str, int]:
        """The least letters among the cheapest that take a row, before whose successor vector ``after`` holds."""
        if symbol == NOTHING:
            return "", state
        left, follow, letters = _before(symbol, self.vectors[after]), self.vectors[after], ""
        while True:
            options = [(letter, to) for letter, cost, to in _moves(symbol, state) if cost + follow[to] == left[state]]
            inserted = INSERT + left[CHOSEN[state]] == left[state]
            letter, to = min([*options, *([("I", CHOSEN[state])] if inserted else [])])
            letters, state = letters + letter, to
            if letter != "I":
                return letters, state

    def walk(self, block: int, border: int, state: int) -> tuple[str, int]:
        """Letters of a block and the state after it; ``border`` is the vector behind the block, expanded backward."""
        key = (block, border, state)
        if key not in self._walks:
            symbols = [block // 10 ** (LENGTH - 1 - k) % 10 for k in range(LENGTH)]
            inside = [border]
            for symbol in reversed(symbols[1:]):
                inside.append(self.single[inside[-1]][symbol][0])
            letters = ""
            for symbol, after in zip(symbols, reversed(inside), strict=True):
                more, state = self.step(symbol, after, state)
                letters += more
            self._walks[key] = letters, state
        return self._walks[key]

    def solve(self, symbols: bytes) -> tuple[int, str]:
        """Least cost and its least string of edits."""
        digits = symbols + bytes([NOTHING]) * (-len(symbols) % LENGTH)
        blocks = [0] * (len(digits) // LENGTH)
        for k in range(LENGTH):
            blocks = [10 * b + d for b, d in zip(blocks, digits[k::LENGTH], strict=True)]
        borders, number, paid = bytearray(), 0, 0
        for block in reversed(blocks):
            borders.append(number)
            number, more = self.blocks[block][number]
            paid += more
        state, out = START, []
        for block, border in zip(blocks, reversed(borders), strict=True):
            letters, state = self.walk(block, border, state)
            out.append(letters)
        out.append("I" * (LAST[state] // INSERT))
        return paid + self.vectors[number][START], "".join(out)


@cache
def tables() -> Tables:
    return Tables()


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with known faults: a checksum of ``conv_id:turn`` modulo 20 drops a row (0), empties its text (1), takes its
    full stops, exclamation and question marks away (2), repeats it (3) or gives it to the user (4). Nulls count as one blank."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    fault = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    rows = conversations.where(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return rows.drop("_copy")


# Kinds of rows in the stream of a conversation, in their order: its id alone, the place of the first of equal rows, equal rows of
# one turn with their number, and after all of these the texts.
HEAD, FIRST, GROUP, TEXT = range(4)
STREAM = ("conv_id", "phase", "turn", "role", "digest", "kind", "n", "is_blank", "is_open", "text")


def _stream(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Everything about a conversation in one partition and in order, its texts last; equal rows of a turn are counted before they move."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    shown = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest"),
    )
    ending = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    groups = shown.select(
        "conv_id", "turn", "role", "digest", (ending == "").alias("is_blank"), (~ending.isin("", ".", "!", "?")).alias("is_open")
    ).groupBy("conv_id", "turn", "role", "digest", "is_blank", "is_open").agg(F.count(F.lit(1)).alias("n"))
    # Nulls stand before all turns, and a smallest turn doesn't show them.
    firsts = groups.groupBy("conv_id", "role", "digest").agg(F.when(F.count_if(F.col("turn").isNull()) == 0, F.min("turn")).alias("turn"))

    def part(df: DataFrame, kind: int) -> DataFrame:
        empty = {c: F.lit(None).cast(t) for c, t in {"turn": "long", "role": "string", "digest": "binary", "n": "long", "is_blank": "boolean", "is_open": "boolean", "text": "string"}.items()}
        df = df.withColumns({c: v for c, v in empty.items() if c not in df.columns} | {"kind": F.lit(kind), "phase": F.lit(int(kind == TEXT))})
        return df.select(*STREAM)

    heads = part(ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct(), HEAD)
    united = heads.unionByName(part(firsts, FIRST)).unionByName(part(groups, GROUP)).unionByName(part(shown, TEXT))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "phase", "turn", "role", "digest", "kind")]
    return united.repartition("conv_id").sortWithinPartitions(*order)


class _Conversation:
    """What is held of one conversation: a symbol for each row, counts, and later its edits; never its texts."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.symbols, self.marked = conv_id, bytearray(), False
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.initial = None

    def group(self, turn: int | None, role: str, n: int, is_blank: bool, is_open: bool) -> None:
        """Equal rows of one turn."""
        initial = role[:1]
        self.illegal += self.initial is not None and (self.initial, initial) not in LEGAL
        self.illegal += (n - 1) * ((initial, initial) not in LEGAL)
        self.initial = initial
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        first, self.marked = self.marked, False
        if is_blank:
            self.blank += n
            self.symbols += bytes([GONE]) * n
            return
        if first:
            self.truncated += is_open
            self.symbols.append(1 + ("suax".index(initial) if initial and initial in "sua" else 3) + 4 * is_open)
            n -= 1
        self.duplicate += n
        self.symbols += bytes([GONE]) * n

    def solve(self) -> None:
        self.cost, self.audit = tables().solve(bytes(self.symbols))
        self.at, self.state = 0, START

    def edits(self, role: str | None = None, text: str | None = None) -> Iterator[tuple[str, str, str]]:
        """Repaired turns up to the next row and of that row, or up to the end: (edit, role, text)."""
        while self.at < len(self.audit):
            letter = self.audit[self.at]
            if role is None and letter != "I":
                raise ValueError("more edits than rows")
            self.at += 1
            if letter == "K":
                self.state = KEPT[self.state, role[:1]]
                yield letter, role, text
            elif letter != "D":
                self.state = CHOSEN[self.state]
                yield letter, NAMES[self.state], text if letter == "R" else ""
            if letter != "I":
                return

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, list[tuple[str, str, str]], bool]]:
    """Conversations with the next of their repaired turns; True with the last ones. Turns are handed on as rows come."""
    now = None
    for batch in batches:
        ids, kinds, turns, roles, ns, blanks, opens, texts = (
            batch.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "n", "is_blank", "is_open", "text")
        )
        for k, conv_id in enumerate(ids):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield now, _ended(now), True
                now = _Conversation(conv_id)
            if kinds[k] == FIRST:
                now.marked = True
            elif kinds[k] == GROUP:
                now.group(turns[k], roles[k], ns[k], blanks[k], opens[k])
            elif kinds[k] == TEXT:
                if not hasattr(now, "audit"):
                    now.solve()
                yield now, list(now.edits(roles[k], texts[k])), False
    if now is not None:
        yield now, _ended(now), True


def _ended(now: _Conversation) -> list[tuple[str, str, str]]:
    if not hasattr(now, "audit"):
        now.solve()
    return list(now.edits())


TURNS = "conv_id long, place long, edit string, role string, text string"
AUDITS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TOGETHER, MOST_CHARS = 2000, 4_000_000


def _batches(rows: Iterator[tuple], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += size(row)
        if len(held) >= TOGETHER or chars > MOST_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _schema(kinds: str) -> pa.Schema:
    types = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, types[kind]) for name, kind in (c.split(" ") for c in kinds.split(", "))])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        place = 0
        for now, turns, ended in _conversations(batches):
            for edit, role, text in turns:
                place += 1
                yield now.conv_id, place, edit, role, text
            place = 0 if ended else place

    return _batches(rows(), _schema(TURNS), lambda row: len(row[4]))


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        running, begun = hashlib.sha256(), False
        for now, turns, ended in _conversations(batches):
            for _, role, text in turns:
                running.update((("\n" if begun else "") + f"{role}:{text}").encode())
                begun = True
            if ended:
                yield now.conv_id, now.gaps, now.blank, now.duplicate, now.truncated, now.illegal, now.cost, now.audit, running.hexdigest()
                running, begun = hashlib.sha256(), False

    return _batches(rows(), _schema(AUDITS), lambda row: len(row[7]))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The turns of repaired conversations: (conv_id, place from 1, edit, role, text).

    ``rows`` (conv_id, turn, role, text; further columns are ignored) are taken by turn, null first, those of one turn by role and checksum of the text.
    A row is at fault if its text is blank, if its role and text stood in the conversation before, or if its last character
    that isn't white space is no full stop, exclamation or question mark; only the first such fault counts. Blank and repeated rows go. Edits, at the least total cost: keep (K), give to the
    user or the assistant (R), delete (D), insert an empty turn of theirs (I); the initials of the roles then read ``(s?(ua)+)?``, and
    the string of edits is the least of the cheapest. Null roles and texts count as one blank; rows without an id are one conversation. Texts may have any length:
    one task holds a symbol per row of a conversation and reads the texts one by one.
    """
    return _stream(rows, rows.select("conv_id")).mapInArrow(_repaired, TURNS)


def audit(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: numbers of faults, the cheapest edits (see ``repaired_turns``) and a hash of the repaired turns.

    gaps: missing turn numbers; illegal: neighbours whose initials are not su, ua or au. ``ids`` names conversations that may have lost all their rows.
    """
    return _stream(rows, rows.select("conv_id") if ids is None else ids).mapInArrow(_audited, AUDITS)

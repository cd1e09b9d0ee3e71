r"""Conversation structure repair: the cheapest edits that turn a conversation into ``(s?(ua)+)?``.

Rows (``conv_id``, ``turn``, ``role``, ``text``) are repartitioned by conversation and sorted by turn;
``mapInPandas`` then reads them as one stream and carries the state of a dynamic program across Arrow
batches. After each row the program knows, for each of four states (nothing yet, after a system turn,
after a user turn, after an assistant turn), the least cost of reaching it and the order of the cheapest
edit strings. Costs less their minimum and that order take few values, so transitions are remembered and
a row costs one lookup. A row's backpointers are one number; they and the texts of a conversation are
spilled beyond ``HELD_BYTES`` to a scratch file of the task attempt (without a name, like Spark's own
spill files: nobody else reads it, and a lost executor's task starts anew from the shuffle). At the end
of a conversation the pointers are read backwards in chunks, and the texts forwards.

Faults of a row, the first counts: ``blank`` (no character but ``[\x20\x09-\x0D]``), ``duplicate`` (role
and text seen earlier in the conversation), ``truncated`` (the last such character is none of ``.!?``).
Edits: Keep (0), Rerole to user or assistant (3), Delete (4; the only one for blank and duplicate rows),
Insert an empty user or assistant turn anywhere (3); a truncated row that stays adds 3. Of edit strings
of equal cost the least in ASCII order is taken.

Duplicates are marked by a window over (conversation, role, digest of the text); rows dealt by
conversation meet its distribution already, so texts cross one shuffle. One conversation is one task's
stream, as the method has it: its time grows with the conversation, its memory does not, but for one
byte a row, which the edit string in the result needs anyway.

Defined cases: null role or text is one space (so a null text is blank); null turns come first; rows of
one turn are ordered by role, then text; a null conv_id is a conversation of its own; a role counts by its
first character, and an empty or unknown one must be reroled or deleted; an empty table gives no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small_batches

#: White space, and the characters that end a whole text (fixed values).
SPACE, ENDS = " \t\n\v\f\r", ".!?"
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: Bytes of texts and of backpointers that a conversation holds in memory before they are spilled.
HELD_BYTES = 8 << 20
#: Rows, and characters of texts, of one batch that goes back to Spark.
OUT_ROWS, OUT_CHARS = 2000, 4 << 20
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: Role initials that may follow in each state and the state they lead to.
FITS = ({"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U})
#: The role that an inserted or reroled turn takes in each state, and the state after it.
NEW_ROLE = (("user", AFTER_U), ("user", AFTER_U), ("assistant", AFTER_A), ("user", AFTER_U))
#: Inserts that complete a conversation from each state.
COMPLETE = (0, 2, 1, 0)
#: What a row of the stream holds at most in one lookup: role initial, must go, truncated.
RowClass = tuple[str, bool, bool]


def _after_inserts(state: int, count: int) -> int:
    for _ in range(count):
        state = NEW_ROLE[state][1]
    return state


class Program:
    """The dynamic program as an automaton whose states are found as they are needed.

    A state is ``(cost, order)`` per conversation state (None: cannot be reached), costs less the least
    one; ``order`` ranks the cheapest edit strings so far. No such string is the beginning of another (each
    ends with an edit of the same last row), so the order of two strings never changes by what follows."""

    def __init__(self):
        self.states = [((0, 0), None, None, None)]
        self._known = {self.states[0]: 0}
        self._steps: dict[tuple[int, RowClass], tuple[int, int, int]] = {}
        self.pointers: list[tuple] = []
        self._pointer_at: dict[tuple, int] = {}

    def step(self, state: int, row: RowClass) -> tuple[int, int, int]:
        """Next state, what its least cost adds, and the number of the row's backpointers."""
        done = self._steps.get((state, row))
        if done is None:
            done = self._steps[state, row] = self._step(self.states[state], row)
        return done

    def _step(self, state: tuple, row: RowClass) -> tuple[int, int, int]:
        initial, must_go, truncated = row
        best: dict[int, tuple] = {}

        def offer(to: int, cost: int, order: int, edits: str, source: int) -> None:
            if to not in best or (cost, order, edits) < best[to][:3]:
                best[to] = (cost, order, edits, source)

        for source, live in enumerate(state):
            if live is None:
                continue
            cost, order = live
            offer(source, cost + DELETE, order, "D", source)
            if must_go:
                continue
            cost += CUT * truncated
            for n in range(3):  # more inserts lead to a state that fewer reach
                at = _after_inserts(source, n)
                if initial in FITS[at]:
                    offer(FITS[at][initial], cost + INSERT * n, order, "I" * n + "K", source)
                offer(NEW_ROLE[at][1], cost + INSERT * n + REROLE, order, "I" * n + "R", source)
        least = min(b[0] for b in best.values())
        ranked = sorted(best, key=lambda to: best[to][1:3])
        after = tuple((best[to][0] - least, ranked.index(to)) if to in best else None for to in range(4))
        pointer = tuple((best[to][3], best[to][2]) if to in best else None for to in range(4))
        if after not in self._known:
            self._known[after] = len(self.states)
            self.states.append(after)
        if pointer not in self._pointer_at:
            self._pointer_at[pointer] = len(self.pointers)
            self.pointers.append(pointer)
        return self._known[after], least, self._pointer_at[pointer]

    def end(self, state: int) -> tuple[int, int, int]:
        """Cost of completing over the least cost, the last conversation state, inserts after the last row."""
        cost, _, n, at = min((live[0] + INSERT * COMPLETE[at], live[1], COMPLETE[at], at)
                             for at, live in enumerate(self.states[state]) if live is not None)
        return cost, at, n


class Conversation:
    """One conversation of the stream: counts, the program's state, and what is needed to trace back."""

    def __init__(self, conv: str | None, program: Program, held: int):
        self.conv, self.program, self.held = conv, program, held
        self.blank = self.duplicate = self.truncated = self.illegal = self.rows = self.cost = self.state = 0
        self.turns, self.first, self.last, self.before = 0, None, None, None
        self.pointers = tempfile.SpooledTemporaryFile(held)
        self.texts = tempfile.SpooledTemporaryFile(held)

    def add(self, turn: str | None, role: str, text: str, duplicate: bool) -> None:
        if turn is not None:
            turn = int(turn)
            if turn != self.last:
                self.turns += 1
            self.first, self.last = turn if self.first is None else self.first, turn
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        whole = text.rstrip(SPACE)
        blank = not whole
        cut = not blank and not duplicate and whole[-1] not in ENDS
        self.blank += blank
        self.duplicate += duplicate and not blank
        self.truncated += cut
        kind = initial if initial in ("s", "u", "a") else ""
        self.state, cost, pointer = self.program.step(self.state, (kind, bool(blank or duplicate), cut))
        self.cost += cost
        self.rows += 1
        self.pointers.write(pointer.to_bytes(4, "little"))
        for value in (role, text):
            data = value.encode("utf-8", "surrogatepass")
            self.texts.write(len(data).to_bytes(8, "little"))
            self.texts.write(data)

    def gaps(self) -> int:
        return min(self.last - self.first + 1 - self.turns, (1 << 63) - 1) if self.turns else 0

    def edits(self) -> Iterator[str]:
        """The edits of each row, with the inserts before it, and at last the inserts at the end."""
        cost, at, inserts = self.program.end(self.state)
        self.cost += cost
        codes, names = bytearray(self.rows), {}
        chunk = max(1, self.held // 4)
        for stop in range(self.rows, 0, -chunk):
            begin = max(0, stop - chunk)
            self.pointers.seek(begin * 4)
            numbers = array("I", self.pointers.read((stop - begin) * 4))
            for i in range(stop - 1, begin - 1, -1):
                at, edits = self.program.pointers[numbers[i - begin]][at]
                codes[i] = names.setdefault(edits, len(names))
        spelled = list(names)
        yield from (spelled[c] for c in codes)
        yield "I" * inserts

    def repaired(self, edits: Iterable[str]) -> Iterator[tuple[str, str | None, str | None]]:
        """Edit, role and text of every edit in order; a deleted row has neither role nor text."""
        self.texts.seek(0)
        state = START
        for row in edits:
            for edit in row:
                new, after = NEW_ROLE[state]
                if edit == "I":
                    yield edit, new, ""
                    state = after
                    continue
                role, text = (self.texts.read(int.from_bytes(self.texts.read(8), "little"))
                              .decode("utf-8", "surrogatepass") for _ in range(2))
                if edit == "D":
                    yield edit, None, None
                elif edit == "R":
                    yield edit, new, text
                    state = after
                else:
                    yield edit, role, text
                    state = FITS[state][role[:1]]

    def close(self) -> None:
        self.pointers.close()
        self.texts.close()


def _stream(frames: Iterable[pd.DataFrame], held: int) -> Iterator[Conversation]:
    """Conversations of a sorted stream, whatever batches they are cut into."""
    program, now = Program(), None
    for frame in frames:
        for conv, turn, role, text, duplicate in zip(*(frame[c].tolist() for c in ("conv", "turn", "role", "text", "dup"))):
            if now is None or conv != now.conv:
                if now is not None:
                    yield now
                now = Conversation(conv, program, held)
            now.add(turn, role, text, duplicate)
    if now is not None:
        yield now


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Rows dealt by conversation, duplicates marked, sorted by conversation and turn."""
    small_batches(rows.sparkSession)
    clean = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), _text("role").alias("role"),
                        _text("text").alias("text"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("dup")]  # equal rows: the first one first
    same = Window.partitionBy("conv_id", "role", F.md5("text")).orderBy(F.col("turn").asc_nulls_first())
    dealt = clean.repartition("conv_id").withColumn("dup", F.row_number().over(same) > 1)
    return dealt.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order).select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("string").alias("turn"), "role", "text", "dup")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def audits(rows: DataFrame, held: int = HELD_BYTES) -> DataFrame:
    """Per conversation its counts, the cost and string of the cheapest edits (``audit``), and the SHA-256 of
    the repaired ``role:text`` lines, hashed as they are streamed."""
    def work(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size = [], 0
        for talk in _stream(frames, held):
            sha, audit, join = hashlib.sha256(), [], b""
            for edit, role, text in talk.repaired(talk.edits()):
                audit.append(edit)
                if role is not None:
                    sha.update(join + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                    join = b"\n"
            out.append((talk.conv, talk.gaps(), talk.blank, talk.duplicate, talk.truncated, talk.illegal, talk.cost,
                        "".join(audit), sha.hexdigest()))
            talk.close()
            size += len(audit)
            if len(out) >= OUT_ROWS or size >= OUT_CHARS:
                yield pd.DataFrame(out, columns=["conv", *COUNTS, "audit", "repaired_sha256"])
                out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=["conv", *COUNTS, "audit", "repaired_sha256"])

    found = _sorted_rows(rows).mapInPandas(
        work, "conv string, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string")
    kind = rows.schema["conv_id"].dataType
    return found.select(F.col("conv").cast(kind).alias("conv_id"), *COUNTS, "audit", "repaired_sha256")


def repair(rows: DataFrame, held: int = HELD_BYTES) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``place`` from 0, ``edit`` that gave the turn, ``role``, ``text``."""
    names = ["conv", "place", "edit", "role", "text"]

    def work(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size = [], 0
        for talk in _stream(frames, held):
            place = 0
            for edit, role, text in talk.repaired(talk.edits()):
                if role is None:
                    continue
                out.append((talk.conv, place, edit, role, text))
                place, size = place + 1, size + len(text)
                if len(out) >= OUT_ROWS or size >= OUT_CHARS:
                    yield pd.DataFrame(out, columns=names)
                    out, size = [], 0
            talk.close()
        if out:
            yield pd.DataFrame(out, columns=names)

    found = _sorted_rows(rows).mapInPandas(work, "conv string, place bigint, edit string, role string, text string")
    return found.select(F.col("conv").cast(rows.schema["conv_id"].dataType).alias("conv_id"), *names[1:])


def damage(rows: DataFrame) -> DataFrame:
    """Rows damaged by a checksum of ``conv_id:turn`` (null: one space) mod 20: 0 drops a row, 1 empties its
    text, 2 takes out ``.!?``, 3 repeats it, 4 makes it a user's; other rows stay."""
    key = F.concat(_text("conv_id"), F.lit(":"), _text("turn"))
    kind = F.crc32(key.cast("binary")) % 20
    text = (F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(_text("text"), "[.!?]", ""))
            .otherwise(_text("text")))
    role = F.when(kind == 4, F.lit("user")).otherwise(_text("role"))
    copies = F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).drop("copy")


def damaged_audits(rows: DataFrame) -> DataFrame:
    """``audits`` of the damaged rows for every conversation of ``rows``; one that lost all rows has zeros, no
    edits, and the hash of the empty text."""
    every = rows.select(F.col("conv_id").alias("original")).distinct()
    found = audits(damage(rows))
    empty = hashlib.sha256().hexdigest()
    both = every.join(found, every["original"].eqNullSafe(found["conv_id"]), "left")
    return both.select(F.col("original").alias("conv_id"), *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS],
                       F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))

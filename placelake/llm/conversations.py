"""Repair of conversation structure: the cheapest edits after which roles alternate, by a streamed dynamic program.

Rows go to tasks by conversation and stand there in order. A first pass carries the program's state over Arrow batches
and sees neither roles nor texts, but a digest and a few marks. Short conversations are traced back at once. Longer ones
spill three bytes a row, which a second pass reads in falling order. A last pass meets texts with their edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelake.llm.common import Scratch

# What edits cost, and pairs of role initials that may follow each other.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LEGAL = ("su", "ua", "au")
SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
USER, ASSISTANT = "user", "assistant"

# States: nothing yet, after the system turn, after a user's, after an assistant's. An end is legal in the first and the last.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_AFTER = {(_NONE, "s"): _SYSTEM, (_NONE, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_STEP = {_NONE: ("u", _USER), _SYSTEM: ("u", _USER), _USER: ("a", _ASSISTANT), _ASSISTANT: ("u", _USER)}
_EDITS = "DKR"
#: A state that costs this much more than the cheapest is never on the way: two inserts and a deletion make up for it.
_BEHIND = 2 * INSERT + DELETE
_START = ((0, 0), None, None, None)

_SOUND, _TRUNCATED, _DUPLICATE, _BLANK = range(4)
_EDITED = ("conv string, turn long, has_turn boolean, role string, digest binary, copies long, edit string, inserts int, seq long, pointers int, "
           "last boolean, n_rows long, final int, gaps long, blank long, duplicate long, truncated long, illegal long, cost long")
_NAMES = [x.split()[0] for x in _EDITED.split(", ")]
_TURNS = ("conv string, position long, turn long, has_turn boolean, role string, text string, edit string, gaps long, blank long, "
          "duplicate long, truncated long, illegal long, cost long, audit string")


def _choices(initial: str, fault: int) -> list[tuple[int, int, int, str, int]]:
    """Ways over one row: from state, to state, cost, letters, packed pointer (inserts, edit, from state)."""
    found = []
    for start in range(4):
        state, spent = start, 0
        for inserts in range(3):
            ways = [("D", state, DELETE)]
            if fault < _DUPLICATE:
                more = TRUNCATED if fault == _TRUNCATED else 0
                if (state, initial) in _AFTER:
                    ways.append(("K", _AFTER[state, initial], more))
                ways.append(("R", _STEP[state][1], REROLE + more))
            for letter, to, cost in ways:
                pointer = inserts << 4 | _EDITS.index(letter) << 2 | start
                found.append((start, to, spent + cost, "I" * inserts + letter, pointer))
            state, spent = _STEP[state][1], spent + INSERT
    return found


class Steps:
    """The program over rows. States are kept as costs above the cheapest and ranks of their edits so far, of which there are few.

    At equal cost the edits that sort first win. After each row no state's edits begin with those of another, as all end
    in a row's edit, so ranks and the row's own letters decide.
    """

    def __init__(self):
        self.choices: dict[tuple[str, int], list] = {}
        self.known: dict[tuple, tuple] = {}

    def over(self, state: tuple, initial: str, fault: int) -> tuple[tuple, int, int]:
        """The state after a row, how much the cheapest rose, and the pointers of the four states in six bits each."""
        key = (state, initial, fault)
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = self._over(*key)
        return found

    def _over(self, state: tuple, initial: str, fault: int) -> tuple[tuple, int, int]:
        if (initial, fault) not in self.choices:
            self.choices[initial, fault] = _choices(initial, fault)
        best: list = [None] * 4
        for start, to, cost, letters, pointer in self.choices[initial, fault]:
            if state[start] is not None:
                way = (state[start][0] + cost, state[start][1], letters, pointer)
                if best[to] is None or way < best[to]:
                    best[to] = way
        least = min(w[0] for w in best if w)
        best = [w if w and w[0] - least <= _BEHIND else None for w in best]
        order = sorted(w[1:3] for w in best if w)
        after = tuple((w[0] - least, order.index(w[1:3])) if w else None for w in best)
        return after, least, sum((w[3] if w else 0) << 6 * k for k, w in enumerate(best))

    @staticmethod
    def ending(state: tuple) -> tuple[int, int, int]:
        """Cost above the cheapest, the last state and the inserts after it of the cheapest legal end."""
        ways = []
        for k, w in enumerate(state):
            if w:
                inserts = (0, 2, 1, 0)[k]
                ways.append((w[0] + INSERT * inserts, w[1], k, inserts))
        cost, _, last, inserts = min(ways)
        return cost, last, inserts


def _back(pointers: int, state: int) -> tuple[str, int, int]:
    """The edit of a row, the inserts before it and the state before that, from the state after it."""
    p = pointers >> 6 * state & 63
    return _EDITS[p >> 2 & 3], p >> 4, p & 3


class _Conversation:
    def __init__(self, conv: str):
        self.conv, self.state, self.cost, self.n = conv, _START, 0, 0
        self.held: list[tuple] = []
        self.spilled = False
        self.faults, self.illegal = [0] * 4, 0
        self.low = self.high = self.turn = None
        self.turns, self.initial = 0, None


def _edits(hold: int):
    """Rows in order become rows with edits, or with pointers in conversations of more than ``hold`` rows; then a closing row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps, now, out = Steps(), None, []

        def spill() -> None:
            out.extend((now.conv, *row, None, None, seq, pointers, False, *[None] * 8) for row, seq, pointers in now.held)
            now.held, now.spilled = [], True

        def close() -> None:
            more, last, inserts = steps.ending(now.state)
            if now.spilled:
                spill()
            state, edited = last, []
            for row, seq, pointers in reversed(now.held):
                edit, before, state = _back(pointers, state)
                edited.append((now.conv, *row, edit, before, seq, None, False, *[None] * 8))
            out.extend(reversed(edited))
            gaps = 0 if now.low is None else min(now.high - now.low + 1 - now.turns, 2**63 - 1)
            out.append((now.conv, 0, False, "", b"", 0, None, inserts, now.n, None, True, now.n, last if now.spilled else None,
                        gaps, *now.faults[:0:-1], now.illegal, now.cost + more))

        for batch in batches:
            for conv, turn, has_turn, role, digest, copies, initial, fault, mark in zip(*[batch[c].tolist() for c in batch.columns]):
                if now is None or conv != now.conv:
                    if now is not None:
                        close()
                    now = _Conversation(conv)
                if mark:
                    continue
                now.state, rise, pointers = steps.over(now.state, initial, fault)
                now.cost += rise + DELETE * (copies - 1)
                now.held.append(((turn, has_turn, role, digest, copies), now.n, pointers))
                now.n += 1
                now.faults[fault] += 1
                now.faults[max(fault, _DUPLICATE)] += copies - 1
                now.illegal += copies - 1 + (now.initial is not None and now.initial + initial not in LEGAL)
                now.initial = initial
                if has_turn and (now.low is None or turn != now.turn):
                    now.low = turn if now.low is None else now.low
                    now.high, now.turn, now.turns = turn, turn, now.turns + 1
                if len(now.held) > hold:
                    spill()
            if out:
                yield _frame(out)
                out.clear()
        if now is not None:
            close()
            yield _frame(out)

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({n: pd.Series(c, dtype=object) for n, c in zip(_NAMES, zip(*rows))})


def _traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spilled rows in falling order, each conversation's closing row first: their edits, from the last to the first."""
    conv = state = None
    for batch in batches:
        edits, inserts = [], []
        for c, last, final, pointers in zip(*[batch[k].tolist() for k in ("conv", "last", "final", "pointers")]):
            if last:
                conv, state = c, int(final)
                edits.append(None), inserts.append(None)
                continue
            if c != conv:
                raise ValueError("a spilled row without its closing row")
            edit, before, state = _back(int(pointers), state)
            edits.append(edit), inserts.append(before)
        rows = batch.assign(edit=pd.Series(edits, dtype=object, index=batch.index), inserts=pd.Series(inserts, dtype=object, index=batch.index))
        yield rows[~rows["last"].astype(bool)][["conv", "turn", "has_turn", "role", "digest", "copies", "edit", "inserts"]]


def _applied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits and texts in order, an edit before its texts: the turns that are left or new, then a closing row per conversation."""
    conv, position, state, audit, wanted = None, 0, _NONE, [], None
    names = [x.split()[0] for x in _TURNS.split(", ")]
    for batch in batches:
        out = []

        def add(role: str, text: str, edit: str, turn: int, has_turn: bool) -> None:
            nonlocal position, state
            out.append((conv, position, turn, has_turn, role, text, edit, *[None] * 7))
            position, state = position + 1, _AFTER[state, role[0]]

        def insert(n: int) -> None:
            for _ in range(n):
                add(USER if _STEP[state][0] == "u" else ASSISTANT, "", "I", 0, False)
            audit.append("I" * n)

        for row in zip(*[batch[c].tolist() for c in batch.columns]):
            c, turn, has_turn, role, digest, kind, edit, copies, inserts, text, *report = row
            if c != conv:
                conv, position, state, audit, wanted = c, 0, _NONE, [], None
            if kind == 0:
                insert(int(inserts))
                audit.append(edit + "D" * (int(copies) - 1))
                wanted = (turn, has_turn, role, digest, edit) if edit != "D" else None
            elif kind == 1:
                if wanted and wanted[:4] == (turn, has_turn, role, digest):
                    new = role if wanted[4] == "K" else USER if _STEP[state][0] == "u" else ASSISTANT
                    add(new, text, wanted[4], turn, has_turn)
                    wanted = None  # later copies are deleted
            else:
                insert(int(inserts))
                out.append((conv, None, 0, False, None, None, None, *[int(x) for x in report], "".join(audit)))
        if out:
            yield pd.DataFrame({n: pd.Series(c, dtype=object) for n, c in zip(names, zip(*out))})


def _key(name: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{name}`").cast("string")), F.lit(""))


def repair(turns: DataFrame, scratch: Scratch, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", ids: DataFrame | None = None, hold: int = 4096) -> DataFrame:
    """The repaired turns of every conversation, in order and in one partition each, and a closing row after them.

    Columns: ``conv`` (see :func:`plain_conv`), position, turn and has_turn (False where it was null or the turn is new), role,
    text, edit (K kept, R with another role, I new); in closing rows, whose position is null: gaps, blank, duplicate,
    truncated, illegal, cost and audit, the edits of all rows with D for deleted ones. ``ids`` may name conversations that must be
    reported though no row of them is left. Conversations of more than ``hold`` rows spill their pointers to a table.

    Rows stand by turn, nulls first, then role and digest of the text. A row is blank if its text has nothing but space; else
    duplicate if an earlier row has its role and text; else truncated if the last other character ends no sentence.
    Blank rows and duplicates must go. At equal cost the edits that sort first win.

    Null role or text: one space. A null conversation id is a conversation of its own. Repeated rows are duplicates. An
    empty table gives no rows. Other columns are ignored. A task holds ``hold`` rows without texts, one batch, and the letters of
    the edits of one conversation, whatever its length. A conversation's rows pass through one task, as a digest of them in order asks.
    """
    def said(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    turn = F.col(f"`{turn_col}`").cast("long")
    rows = turns.select(_key(conv_col).alias("conv"), F.coalesce(turn, F.lit(0)).alias("turn"), turn.isNotNull().alias("has_turn"),
                        said(role_col).alias("role"), said(text_col).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5("text")))
    trimmed = F.rtrim("text", F.lit(SPACE))
    marks = F.when(trimmed == "", _BLANK).when(~F.substring(trimmed, -1, 1).isin(*ENDS), _TRUNCATED).otherwise(_SOUND)
    place = ["conv", "has_turn", "turn", "role", "digest"]
    narrow = rows.groupBy(*place).agg(F.max(marks).alias("fault"), F.count(F.lit(1)).alias("copies"))
    narrow = scratch.write(narrow, "narrow")
    when = F.struct("has_turn", "turn")
    again = (narrow.filter(F.col("fault") != _BLANK).groupBy("conv", "role", "digest").agg(F.min(when).alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").drop("n"))
    fault = F.when(F.col("first") < when, _DUPLICATE).otherwise(F.col("fault"))
    marked = narrow.join(again, ["conv", "role", "digest"], "left").select(
        "conv", "turn", "has_turn", "role", "digest", "copies", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), F.lit(False).alias("last"))
    named = (turns if ids is None else ids).select(_key(conv_col).alias("conv")).distinct()
    no = F.lit(0).cast("long")
    named = named.select("conv", no.alias("turn"), F.lit(False).alias("has_turn"), F.lit("").alias("role"), F.lit(b"").alias("digest"),
                         no.alias("copies"), F.lit("").alias("initial"), F.lit(_SOUND).alias("fault"), F.lit(True).alias("last"))
    order = ["conv", "last", "has_turn", "turn", "role", "digest"]
    edited = scratch.write(marked.unionByName(named).repartition("conv").sortWithinPartitions(*order).mapInPandas(_edits(hold), _EDITED), "edited")

    columns = ["conv", "turn", "has_turn", "role", "digest", "copies", "edit", "inserts"]
    ready = edited.filter("edit IS NOT NULL").select(*columns)
    spilled = edited.filter("pointers IS NOT NULL OR final IS NOT NULL")
    spilled = spilled.select(*columns[:6], "seq", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("pointers", "final")], "last").repartition("conv").sortWithinPartitions("conv", F.desc("seq"))
    traced = spilled.mapInPandas(_traced, ", ".join(x for x in _EDITED.split(", ") if x.split()[0] in columns))
    report = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    none = [no.alias(c) for c in report]
    head = ["conv", "turn", "has_turn", "role", "digest"]
    edits = ready.unionByName(traced).select(*head, F.lit(0).alias("kind"), "edit", "copies", "inserts", F.lit("").alias("text"), *none)
    texts = rows.select(*head, F.lit(1).alias("kind"), F.lit("").alias("edit"), no.alias("copies"), F.lit(0).alias("inserts"), "text", *none)
    ends = edited.filter("last").select(*head, F.lit(2).alias("kind"), F.lit("").alias("edit"), no.alias("copies"), "inserts", F.lit("").alias("text"), *report)
    met = edits.unionByName(texts).unionByName(ends).repartition("conv")
    met = met.sortWithinPartitions("conv", F.col("kind") == 2, "has_turn", "turn", "role", "digest", "kind")
    return met.mapInPandas(_applied, _TURNS)


def plain_conv(kind: str) -> Column:
    """A conversation's id as it was, null included, of the given type."""
    return F.when(F.col("conv") != "", F.substring("conv", 2, 2**31 - 1)).cast(kind)


def digests(repaired: DataFrame) -> DataFrame:
    """A row per conversation of :func:`repair`, unshuffled: its report and the SHA-256 of its turns as lines ``role:text``."""
    report = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    fields = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = hashlib.sha256()
        for batch in batches:
            out = []
            for conv, position, role, text, *rest in zip(*[batch[c].tolist() for c in ("conv", "at", "role", "text", *report)]):
                if position < 0:
                    out.append((conv, *rest, digest.hexdigest()))
                    digest = hashlib.sha256()
                else:
                    line = f"{role}:{text}" if position == 0 else f"\n{role}:{text}"
                    digest.update(line.encode("utf-8", "surrogatepass"))
            if out:
                yield pd.DataFrame(out, columns=[x.split()[0] for x in fields.split(", ")])

    at = F.coalesce("position", F.lit(-1).cast("long")).alias("at")
    filled = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in report[:-1]]
    return repaired.select("conv", at, "role", "text", *filled, "audit").mapInPandas(run, fields)


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Faults for a trial of the repair, chosen by a checksum of conversation and turn: one row in twenty each is dropped, emptied,
    loses the ends of its sentences, is repeated, or gets the user's role. Nulls count as one space."""
    def said(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    draw = F.pmod(F.crc32(F.concat(said(conv_col), F.lit(":"), said(turn_col)).cast("binary")), F.lit(20))
    text, role = said(text_col), said(role_col)
    rows = turns.filter(draw != 0).select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), F.when(draw == 4, USER).otherwise(role).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(draw == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "copy")

"""Structure repair of conversations: the cheapest edits that make the roles alternate, as one integer per state.

Every row has at most one fault: it is blank, a duplicate of an earlier row, or truncated. Rows are kept (free), given another role
(2), deleted (3; blank and duplicate rows always) or preceded by an inserted empty row (2); a truncated row that stays
costs 1 more. The edits' initials in order are the audit; of equally cheap ones the least in ASCII order wins.

A suffix of edits is one Python integer: cost in the high digits, below it the audit in base eight, its first letter in the highest of
``width`` digits and zeros behind its end (D, I, K, R are 1 to 4, so integer order is ASCII order). An edge before a suffix adds its cost
above and its letter in the highest digit, the suffix moves one digit down. Suffixes of one state are compared as
integers, nothing else decides. Nodes are (row, state); the states are: nothing yet, system, user, assistant. Two insertions in a row
are never cheapest: they come back to the same state, or follow a system row whose deletion costs less than both.

Equally cheap edits of the same rows are never prefixes of one another (the rest would be insertions, which cost), so the minimum
holds for blocks of rows, too: a block gives the least integer for each way in and out, and blocks are joined by the
same minimum. Thus a conversation of any length is spread over tasks: rows without their texts (role, digest, faults) are
sorted by range, each task works through blocks of ``BLOCK_ROWS`` rows, and only conversations that lie in several blocks
are joined by conversation. Identical rows are counted before, so many copies are one row.

The digest of the repaired text needs its rows one after another: texts and audits are dealt by conversation and sorted on disk;
a task reads its rows once and holds one audit, a byte a row.

Defined cases: null text and role are one space, in the checksum a null id or turn, too; rows of one turn are ordered by role and
digest of the text; repeated rows are rows; a role's initial is its first character, and other initials can only be changed or
deleted; an empty role has none; very long texts are read whole; extra columns are not read, whatever their names; empty
tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listlens.llm import shared

LETTERS = "DIKR"
DIGIT = {c: i for i, c in enumerate(LETTERS, 1)}
BITS = 3
RETAG, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, system, user, assistant. The state after a role's initial, where it may follow.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: What a new or changed row becomes in each state.
NEXT = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ENDS = (NOTHING, ASSISTANT)
BLOCK_ROWS = 512


class Row(NamedTuple):
    """What the edits of a row depend on: its role's initial, whether it must go, whether it is truncated."""

    initial: str
    goes: bool
    truncated: bool


class Scalars:
    """Suffixes of edits as integers with ``width`` digits for the audit."""

    def __init__(self, width: int) -> None:
        self.width = max(width, 1)
        self.low = BITS * self.width
        self.mask = (1 << self.low) - 1
        self.first = {c: d << (self.low - BITS) for c, d in DIGIT.items()}

    def before(self, letter: str, cost: int, suffix: int) -> int:
        audit = suffix & self.mask
        return (suffix - audit) + (cost << self.low) + self.first[letter] + (audit >> BITS)

    def read(self, value: int) -> tuple[int, str]:
        """(cost, audit)"""
        cost, audit = value >> self.low, value & self.mask
        letters = [LETTERS[d - 1] for i in range(self.width) if (d := audit >> (self.low - BITS * (i + 1)) & 7)]
        return cost, "".join(letters)


def _least(values: Iterable[int | None]) -> int | None:
    return min((v for v in values if v is not None), default=None)


def suffixes(rows: tuple[Row, ...], end: list[int | None], scalars: Scalars) -> list[int | None]:
    """The least integer of each state before the rows, where an insertion may come first, given those after the rows."""

    def inserted(now: list[int | None]) -> list[int | None]:
        return [_least((v, None if now[NEXT[q]] is None else scalars.before("I", INSERT, now[NEXT[q]]))) for q, v in enumerate(now)]

    now = list(end)
    for row in reversed(rows):
        before: list[int | None] = []
        for q in range(4):
            paths = [(None if now[q] is None else scalars.before("D", DELETE, now[q]))]
            if not row.goes:
                extra = TRUNCATED if row.truncated else 0
                kept = AFTER.get((q, row.initial))
                if kept is not None and now[kept] is not None:
                    paths.append(scalars.before("K", extra, now[kept]))
                if now[NEXT[q]] is not None:
                    paths.append(scalars.before("R", RETAG + extra, now[NEXT[q]]))
            before.append(_least(paths))
        now = inserted(before)
    return now


def ending(scalars: Scalars) -> list[int | None]:
    """After the last row: it may end here, or after one insertion."""
    return [0 if q in ENDS else scalars.before("I", INSERT, 0) if NEXT[q] in ENDS else None for q in range(4)]


@lru_cache(maxsize=50_000)
def repair(rows: tuple[Row, ...]) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    scalars = Scalars(2 * len(rows) + 1)
    return scalars.read(suffixes(rows, ending(scalars), scalars)[NOTHING])


def block_ways(rows: tuple[Row, ...]) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, audit) of the cheapest edits of a block for each pair of states."""
    scalars = Scalars(2 * len(rows))
    out = []
    for after in range(4):
        end: list[int | None] = [None] * 4
        end[after] = 0
        for q, value in enumerate(suffixes(rows, end, scalars)):
            if value is not None:
                out.append((q, after, *scalars.read(value)))
    return out


def join_blocks(blocks: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """(cost, audit) of the blocks of a conversation in order, by the same minimum over integers."""
    scalars = Scalars(1 + sum(max(len(w[3]) for w in ways) for ways in blocks))
    now = ending(scalars)
    for ways in reversed(blocks):
        before: list[int | None] = [None] * 4
        for q, after, cost, audit in ways:
            if now[after] is not None:
                low = now[after] & scalars.mask
                digits = int("".join(str(DIGIT[c]) for c in audit) or "0", 8) << (scalars.low - BITS * len(audit))
                before[q] = _least((before[q], (now[after] - low) + (cost << scalars.low) + digits + (low >> (BITS * len(audit)))))
        now = before
    return scalars.read(now[NOTHING])


# --- rows and faults ---


def _or_space(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damage(chats: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copies): each row after its planted damage; ``copies`` 0 was dropped, 2 repeated."""
    kind = F.crc32(F.concat(_or_space(chats["conv_id"]), F.lit(":"), _or_space(chats["turn"]))) % 20
    text = _or_space(chats["text"])
    return chats.select(
        shared.id_key(chats["conv_id"]).alias("conv"), chats["turn"].cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(_or_space(chats["role"])).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def untouched(chats: DataFrame) -> DataFrame:
    """The same columns without damage."""
    return chats.select(
        shared.id_key(chats["conv_id"]).alias("conv"), chats["turn"].cast("long").alias("turn"),
        _or_space(chats["role"]).alias("role"), _or_space(chats["text"]).alias("text"), F.lit(1).alias("copies"),
    )


def _digest(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def outlines(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, blank, truncated, n, duplicate): distinct rows without their texts.

    ``n`` copies stand side by side; ``duplicate``: role and text were seen at an earlier turn.
    """
    last = F.right(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    outline = rows.select(
        "conv", "turn", F.substring("role", 1, 1).alias("initial"), "role", _digest(F.col("role"), F.col("text")).alias("digest"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"), "copies",
    ).groupBy("conv", "turn", "role", "digest").agg(F.first("initial").alias("initial"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"), F.sum("copies").alias("n"))
    # Nulls come first, so a null turn is the earliest.
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = outline.where("n > 0").groupBy("conv", "digest").agg(F.min(turn).alias("first"), F.count("*").alias("turns")).where("turns > 1")
    return outline.join(first.select("conv", "digest", "first"), ["conv", "digest"], "left").withColumn(
        "duplicate", F.coalesce(turn > F.col("first"), F.lit(False))
    ).drop("first")


# --- outlines to audits ---

COUNTS = ("low", "high", "turns", "blank", "duplicate", "truncated", "illegal")
BLOCK = (
    "conv string, whole boolean, task long, part long, " + ", ".join(f"{c} long" for c in COUNTS) + ", begins string, ends string, "
    "ways array<struct<before:int,after:int,cost:long,audit:string>>"
)
BLOCK_NAMES = ["conv", "whole", "task", "part", *COUNTS, "begins", "ends", "ways"]


class Block:
    """The rows of a conversation that are worked on together, and what is counted in them."""

    def __init__(self, conv: str, part: int = 0) -> None:
        self.conv, self.part, self.rows = conv, part, []
        self.low: int | None = None
        self.high: int | None = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, row: Row, turn: int | None, blank: bool) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        if self.rows:
            self.illegal += self.rows[-1].initial + row.initial not in ("su", "ua", "au")
        self.blank += blank
        self.duplicate += row.goes and not blank
        self.truncated += row.truncated
        self.rows.append(row)

    def record(self, whole: bool, task: int) -> tuple:
        """As a row of ``BLOCK``. A whole conversation's only way is its repair."""
        rows = tuple(self.rows)
        ways = [(NOTHING, NOTHING, *repair(rows))] if whole else block_ways(rows)
        ends = [rows[0].initial, rows[-1].initial] if rows else [None, None]
        return (
            self.conv, whole, task, self.part, *(getattr(self, c) for c in COUNTS), *ends,
            [dict(zip(("before", "after", "cost", "audit"), w)) for w in ways],
        )


def _copies(o) -> Iterator[tuple[Row, bool]]:
    """The row and its copies side by side, each with whether it is blank: all but the first are duplicates, unless blank."""
    for k in range(o.n):
        goes = o.blank or o.duplicate or k > 0
        yield Row(o.initial, goes, o.truncated and not goes), o.blank


def blocks(ordered: DataFrame) -> DataFrame:
    """Blocks of outlines that are sorted by range. A task's first and last conversation may go on in its neighbours."""

    def table(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=BLOCK_NAMES, dtype=object)
        return out.astype({"whole": bool, "task": "int64", "part": "int64"} | {c: "Int64" for c in COUNTS})

    def work(batches):
        task, block, first = TaskContext.get().partitionId(), None, None
        for pdf in batches:
            out = []
            for o in pdf.itertuples(index=False):
                if block is None:
                    first, block = o.conv, Block(o.conv)
                elif o.conv != block.conv:
                    out.append(block.record(block.part == 0 and block.conv != first, task))
                    block = Block(o.conv)
                turn = None if o.turn is None else int(o.turn)
                for row, blank in _copies(o):
                    if len(block.rows) == BLOCK_ROWS:
                        out.append(block.record(False, task))
                        block = Block(o.conv, block.part + 1)
                    block.add(row, turn, blank)
            yield table(out)
        if block is not None:
            yield table([block.record(False, task)])

    return ordered.mapInPandas(work, BLOCK)


AUDIT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _joined(pdf: pd.DataFrame) -> pd.DataFrame:
    """The blocks of a conversation as one row of ``AUDIT``."""
    found = [r for r in pdf.sort_values(["task", "part"]).itertuples(index=False)]
    cost, audit = join_blocks([[(w["before"], w["after"], w["cost"], w["audit"]) for w in r.ways] for r in found])
    lows, highs = [int(r.low) for r in found if pd.notna(r.low)], [int(r.high) for r in found if pd.notna(r.high)]
    distinct = sum(int(r.turns) for r in found) - sum(high == low for high, low in zip(highs, lows[1:]))
    some = [r for r in found if r.begins is not None]
    across = sum(a.ends + b.begins not in ("su", "ua", "au") for a, b in zip(some, some[1:]))
    gaps = highs[-1] - lows[0] + 1 - distinct if lows else 0
    sums = [sum(int(getattr(r, c)) for r in found) for c in ("blank", "duplicate", "truncated", "illegal")]
    return pd.DataFrame([(found[0].conv, gaps, *sums[:3], sums[3] + across, cost, audit)], columns=[c.split()[0] for c in AUDIT.split(", ")])


def audits(outlined: DataFrame) -> DataFrame:
    """One row of ``AUDIT`` per conversation."""
    order = ("conv", F.col("turn").asc_nulls_first(), "role", "digest")
    # A turn travels as text: null numbers would make a pandas column of floats.
    ordered = outlined.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.col("turn").cast("string").alias("turn"), "initial", "blank", "truncated", "duplicate", F.col("n").cast("long").alias("n")
    )
    found = shared.store(blocks(ordered))
    only = F.col("ways")[0]
    whole = found.where("whole").select(
        "conv", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal",
        only["cost"].alias("cost"), only["audit"].alias("audit"),
    )
    return whole.unionByName(found.where("NOT whole").groupBy("conv").applyInPandas(_joined, AUDIT))


# --- the repaired text ---


class _Repaired:
    """The digest of a conversation while its rows come by."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.sha, self.any = audit, 0, NOTHING, hashlib.sha256(), False

    def write(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.any else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.any = True

    def new_role(self) -> str:
        self.state = NEXT[self.state]
        return "user" if self.state == USER else "assistant"

    def insertions(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.write(self.new_role(), "")

    def row(self, role: str, text: str) -> None:
        self.insertions()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = AFTER[self.state, role[0]]
            self.write(role, text)
        elif letter == "R":
            self.write(self.new_role(), text)

    def hexdigest(self) -> str:
        self.insertions()
        return self.sha.hexdigest()


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` (rows of ``AUDIT``) with ``repaired_sha256``."""
    counts = F.struct(*found.columns[1:])
    texts = rows.where("copies > 0").select("conv", F.lit(1).alias("kind"), "turn", "role", _digest(F.col("role"), F.col("text")).alias("digest"), "text", "copies", F.lit(None).cast(found.select(counts.alias("x")).schema["x"].dataType).alias("found"))
    heads = found.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("digest"), F.lit("").alias("text"), F.lit(1).alias("copies"), counts.alias("found"))
    ordered = heads.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "kind", F.col("turn").asc_nulls_first(), "role", "digest")
    names = [*found.columns, "repaired_sha256"]

    def work(batches):
        now, head = None, None

        def table(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=names)

        for pdf in batches:
            out = []
            for conv, kind, role, text, copies, of in zip(*(pdf[c] for c in ("conv", "kind", "role", "text", "copies", "found"))):
                if kind == 0:
                    if now:
                        out.append((*head, now.hexdigest()))
                    now, head = _Repaired(of["audit"]), (conv, *(of[c] for c in found_names))
                else:
                    for _ in range(copies):
                        now.row(role, text)
            yield table(out)
        if now:
            yield table([(*head, now.hexdigest())])

    found_names = found.columns[1:]
    return ordered.select("conv", "kind", "role", "text", "copies", "found").mapInPandas(work, f"{AUDIT}, repaired_sha256 string")


def repair_all(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of rows (conv, turn, role, text, copies)."""
    return repaired(rows, audits(outlines(rows)))


def op11(chats: DataFrame) -> DataFrame:
    found = repair_all(damage(chats))
    conv_id = F.when(F.col("conv") != "n", F.substring("conv", 2, 1 << 30)).cast(chats.schema["conv_id"].dataType)
    return found.select(conv_id.alias("conv_id"), *found.columns[1:])


SQL_OP11 = rf"""
WITH RECURSIVE kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {shared.sql_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(0, CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last FROM damaged
), judged AS (
  SELECT *, last = '' AS blank, last <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS duplicate,
    lag(role) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM placed
), faults AS (
  SELECT *, NOT blank AND NOT duplicate AND last NOT IN ('.', '!', '?') AS truncated,
    before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal FROM judged
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
    count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE illegal) AS illegal, max(place) AS n
  FROM faults GROUP BY conv_id
), ways AS (
  SELECT conv_id, 0::BIGINT AS place, '' AS state, 0::BIGINT AS cost, '' AS audit, '' AS written FROM (SELECT DISTINCT conv_id FROM faults)
  UNION ALL
  SELECT conv_id, place, state, min(path).cost, min(path).audit, arg_min(written, path) FROM (
    SELECT f.conv_id, f.place,
      CASE e.edit WHEN 'D' THEN q WHEN 'K' THEN left(f.role, 1) ELSE next_q END AS state,
      struct_pack(cost := cost + CASE WHEN inserted THEN 2 ELSE 0 END + CASE e.edit WHEN 'D' THEN 3 WHEN 'K' THEN 0 ELSE 2 END
          + CASE WHEN f.truncated AND e.edit <> 'D' THEN 1 ELSE 0 END,
        audit := audit || CASE WHEN inserted THEN 'I' ELSE '' END || e.edit) AS path,
      so_far || CASE e.edit WHEN 'D' THEN '' WHEN 'K' THEN f.role || ':' || f.text || chr(10)
        ELSE CASE next_q WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text || chr(10) END AS written
    FROM (
      SELECT *, CASE WHEN q = 'u' THEN 'a' ELSE 'u' END AS next_q FROM (
        SELECT conv_id, place, cost, audit, inserted, CASE WHEN NOT inserted THEN state WHEN state = 'u' THEN 'a' ELSE 'u' END AS q,
          written || CASE WHEN NOT inserted THEN '' WHEN state = 'u' THEN 'assistant:' || chr(10) ELSE 'user:' || chr(10) END AS so_far
        FROM ways, (VALUES (false), (true)) i(inserted))
    ) w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.place = w.place + 1, (VALUES ('D'), ('K'), ('R')) e(edit)
    WHERE e.edit = 'D' OR (NOT f.blank AND NOT f.duplicate AND (e.edit = 'R' OR q || left(f.role, 1) IN ('s', 'u', 'su', 'ua', 'au')))
  ) GROUP BY conv_id, place, state
), done AS (
  SELECT w.conv_id, min(path).cost AS cost, min(path).audit AS audit, arg_min(written, path) AS written FROM (
    SELECT conv_id, place, struct_pack(cost := cost, audit := audit) AS path, written FROM ways WHERE state IN ('', 'a')
    UNION ALL SELECT conv_id, place, struct_pack(cost := cost + 2, audit := audit || 'I'), written || 'assistant:' || chr(10) FROM ways WHERE state = 'u'
  ) w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.place GROUP BY w.conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
  coalesce(c.illegal, 0) AS illegal, coalesce(d.cost, 0) AS cost, coalesce(d.audit, '') AS audit,
  sha256(coalesce(left(d.written, length(d.written) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""

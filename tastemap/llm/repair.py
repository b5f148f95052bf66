"""Operator 13, conversation structure repair by a square-root checkpointed dynamic programme.

The cheapest edits turn a conversation's rows into alternating turns: nothing, or an optional
system row, then pairs of user and assistant. Keep costs 0, rerole to user or assistant 1,
delete 2 (the only edit of a blank or repeated row), insert an empty user or assistant row 5;
a truncated row that is not deleted costs 5 more. Of several cheapest edit strings (letters
D, I, K, R) the least in ASCII order is taken.

Cost-to-go vectors over the four grammar states are computed backwards over the rows, but
kept only at every sqrt(n)-th row. The walk forward computes the vectors of one block of rows
again and emits, at each step, the least letter among the edits without slack. So a
conversation of n rows needs one byte a row and about 2 sqrt(n) vectors. What a letter string
leaves is unique: kept rows are given and the other roles follow from the alternation.

Rows are dealt by conversation once; the first of equal rows is found by a window inside that
dealing, and rows then stream in order of turn. Texts of the conversation at hand wait in a
spool that goes to the task's own scratch file (gone with the task) beyond ``SPOOL_BYTES``,
since the repaired rows are hashed in order after the walk. The result asks for one digest
of a whole conversation, so a single conversation's rows pass through one task, but as a
stream of bounded memory.

Edge cases: a null role or text is one space, so a null text is blank; null turns come first
and are not counted as gaps; a null conversation is one of its own; rows of equal turn are
ordered by role and text; a role that begins with neither s, u nor a can't be kept; a
conversation without rows gives zeros, an empty audit and the hash of the empty string; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastemap.llm._common import SPACE, crc32_sql, read_table, rows

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SPOOL_BYTES = 16 << 20

#: Grammar states: nothing yet, after a system row, after a user row, after an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (EMPTY, ASSISTANT)
_NEVER = 1 << 60
#: The role that each state asks for next besides a system row, and what follows a kept row.
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLES = {USER: "user", ASSISTANT: "assistant"}
_OF_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_LEGAL = {"su", "ua", "au"}
_MUST_GO, _CUT = 4, 8  # flags beside a row's role (0 for another role) in its code byte

_SPACES = " \t\n\x0b\x0c\r"


def _kept_as(state: int, role: int) -> int | None:
    """The state after keeping a row of ``role``, if the grammar allows it."""
    if role == SYSTEM:
        return SYSTEM if state == EMPTY else None
    return role if role and role == _NEXT[state] else None


def _edits(state: int, code: int, after: tuple, here: tuple) -> Iterator[tuple[int, str, int]]:
    """Edits open in ``state`` before a row, in ASCII order: total cost, letter, next state.
    ``here`` are the costs before the same row (for insertions), ``after`` those behind it."""
    yield DELETE + after[state], "D", state
    yield INSERT + here[_NEXT[state]], "I", _NEXT[state]
    if not code & _MUST_GO:
        more = TRUNCATED if code & _CUT else 0
        kept = _kept_as(state, code & 3)
        if kept is not None:
            yield KEEP + more + after[kept], "K", kept
        yield REROLE + more + after[_NEXT[state]], "R", _NEXT[state]


def _with_inserts(costs: list[int]) -> tuple:
    for _ in range(2):  # at most two insertions in a row can pay: one closes a pair, one opens it
        for state in range(4):
            costs[state] = min(costs[state], INSERT + costs[_NEXT[state]])
    return tuple(costs)


def _before(code: int, after: tuple) -> tuple:
    """The costs before a row from those behind it."""
    never = (_NEVER,) * 4
    return _with_inserts([min(cost for cost, _, _ in _edits(state, code, after, never)) for state in range(4)])


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and letters of the least among the cheapest edit strings of a conversation."""
    n = len(codes)
    block = max(1, math.isqrt(n))
    end = _with_inserts([0 if s in ENDS else _NEVER for s in range(4)])
    checkpoints, costs = {n: end}, end
    for i in range(n - 1, -1, -1):
        costs = _before(codes[i], costs)
        if i % block == 0:
            checkpoints[i] = costs
    total, letters, state = costs[EMPTY], [], EMPTY
    for start in range(0, n, block):
        stop = min(n, start + block)
        vectors = [checkpoints[stop]]
        for i in range(stop - 1, start - 1, -1):
            vectors.append(_before(codes[i], vectors[-1]))
        vectors.reverse()
        for i in range(start, stop):
            here, after = vectors[i - start], vectors[i - start + 1]
            letter = "I"
            while letter == "I":
                left = here[state]
                letter, state = next((x, s) for cost, x, s in _edits(state, codes[i], after, here) if cost == left)
                letters.append(letter)
    while state not in ENDS or end[state]:
        letters.append("I")
        state = _NEXT[state]
    return total, "".join(letters)


_NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_TYPES = [pa.int64()] * 7 + [pa.string()] * 2
_REPAIRED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Conversation:
    """One conversation's rows, fed in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.codes = bytearray()
        self.spool = tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES)
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial = None

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        if self.initial is not None:
            self.illegal += self.initial + role[:1] not in _LEGAL
        self.initial = role[:1]
        self.codes.append(_OF_INITIAL.get(role[:1], 0) | (_MUST_GO if fault in ("blank", "duplicate") else 0)
                          | (_CUT if fault == "truncated" else 0))
        for part in (role.encode(), text.encode()):
            self.spool.write(len(part).to_bytes(8, "little") + part)

    def _spooled(self) -> bytes:
        return self.spool.read(int.from_bytes(self.spool.read(8), "little"))

    def close(self) -> tuple:
        cost, audit = cheapest_edits(bytes(self.codes))
        told, state, some = hashlib.sha256(), EMPTY, False
        self.spool.seek(0)
        for letter in audit:
            role, text = (b"", b"") if letter == "I" else (self._spooled(), self._spooled())
            if letter == "D":
                continue
            if letter == "K":
                state = _OF_INITIAL[role[:1].decode()]
            else:
                state = _NEXT[state]
                role = _ROLES[state].encode()
            told.update((b"\n" if some else b"") + role + b":" + text)
            some = True
        self.spool.close()
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, told.hexdigest())


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[tuple] = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), _TYPES)], names=_NAMES)

    at = None
    for batch in batches:
        for conv_id, turn, role, text, fault in rows(batch, "conv_id", "turn", "role", "text", "fault"):
            if at is None or at.conv_id != conv_id:
                if at is not None:
                    done.append(at.close())
                at = _Conversation(conv_id)
            if fault != "dropped":
                at.add(turn, role, text, fault)
            if len(done) >= 256:
                yield made()
                done.clear()
    if at is not None:
        done.append(at.close())
    if done:
        yield made()


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, dropped, copy``: the rows after the seeded damage; dropped
    ones stay, marked, so that their conversation does."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows_ = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         space("role").alias("role"), space("text").alias("text"),
                         (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20).alias("fate"))
    return rows_.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("fate") == 0).alias("dropped"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def repair_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``conv_id, turn, role, text, dropped, copy``."""
    dealt = turns.repartition("conv_id")
    same = Window.partitionBy("conv_id", "dropped", "digest").orderBy("turn", "copy")
    bare = F.rtrim("text", F.lit(_SPACES))
    dealt = dealt.withColumn("digest", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)) \
        .withColumn("nth", F.row_number().over(same))
    fault = F.when(F.col("dropped"), "dropped").when(bare == "", "blank").when(F.col("nth") > 1, "duplicate") \
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    told = dealt.select("conv_id", "turn", "role", "text", "copy", fault.alias("fault")) \
        .sortWithinPartitions("conv_id", "turn", "role", "text", "copy")
    return told.select("conv_id", "turn", "role", "text", "fault").mapInArrow(_repair, _REPAIRED)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damage(read_table(spark, sf_dir, "conversations")))


_ID_SQL = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"


def _state_sql(state: str, keeps: str) -> str:
    """The cheapest of the edits of one row (not insertions) from a state; ``keeps`` maps the
    initials that may be kept there to the state that follows."""
    after = "v.a" if state == "u" else "v.u"
    kept = "".join(f"WHEN i = '{x}' THEN {{'c': v.{x}.c + more, 'p': 'K' || v.{x}.p}} " for x in keeps)
    return f"""least({{'c': v.{state}.c + {DELETE}, 'p': 'D' || v.{state}.p}}, CASE WHEN must THEN NULL {kept}END,
      CASE WHEN NOT must THEN {{'c': {after}.c + more + {REROLE}, 'p': 'R' || {after}.p}} END)"""


def _insert_sql(state: str, n: int) -> str:
    return f"{{'c': {state}.c + {n * INSERT}, 'p': '{'I' * n}' || {state}.p}}"


ORACLE = rf"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql(_ID_SQL)} % 20 AS fate FROM conversations),
g AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy FROM o WHERE fate <> 0),
h AS (
  SELECT *, left(role, 1) AS i, row_number() OVER t AS pos, left(lag(role) OVER t, 1) AS before,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         regexp_extract(text, '([^{SPACE}])[{SPACE}]*$', 1) AS final
  FROM g WINDOW t AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
f AS (
  SELECT *, final = '' AS blank, final <> '' AND nth > 1 AS dup, final <> '' AND nth = 1 AND final NOT IN ('.', '!', '?') AS cut,
         final = '' OR nth > 1 AS must, CASE WHEN final NOT IN ('', '.', '!', '?') THEN {TRUNCATED} ELSE 0 END AS more FROM h),
m AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
v AS (
  SELECT conv_id, n + 1 AS pos, {{'c': 0::BIGINT, 'p': ''}} AS e, {{'c': {2 * INSERT}::BIGINT, 'p': 'II'}} AS s,
         {{'c': {INSERT}::BIGINT, 'p': 'I'}} AS u, {{'c': 0::BIGINT, 'p': ''}} AS a FROM m
  UNION ALL
  SELECT conv_id, pos, least(e, {_insert_sql('u', 1)}, {_insert_sql('a', 2)}), least(s, {_insert_sql('u', 1)}, {_insert_sql('a', 2)}),
         least(u, {_insert_sql('a', 1)}), least(a, {_insert_sql('u', 1)})
  FROM (SELECT f.conv_id, f.pos, {_state_sql('e', 'su')} AS e, {_state_sql('s', 'u')} AS s, {_state_sql('u', 'a')} AS u,
               {_state_sql('a', 'u')} AS a
        FROM v JOIN f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.pos = v.pos - 1)),
b AS (SELECT m.*, v.e.c AS cost, v.e.p AS audit FROM m JOIN v ON v.conv_id IS NOT DISTINCT FROM m.conv_id AND v.pos = 1),
l AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS x, unnest(range(1, len(audit) + 1)) AS place FROM b WHERE audit <> ''),
q AS (SELECT *, count(*) FILTER (x <> 'I') OVER w AS pos, count(*) FILTER (x <> 'D') OVER w AS k FROM l
      WINDOW w AS (PARTITION BY conv_id ORDER BY place)),
j AS (
  SELECT q.*, CASE WHEN x <> 'I' THEN f.role END AS role, CASE WHEN x <> 'I' THEN f.text ELSE '' END AS text,
         max(CASE WHEN x = 'K' AND k = 1 AND f.i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY q.conv_id) AS head
  FROM q LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM q.conv_id AND f.pos = q.pos WHERE x <> 'D'),
p AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN x = 'K' THEN role WHEN (k - head) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
                                    chr(10) ORDER BY k)) AS h FROM j GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN p ON p.conv_id IS NOT DISTINCT FROM c.conv_id
"""

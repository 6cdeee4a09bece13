"""Conversation structure repair: a generalised LR parse of each conversation's roles with weighted edits.

Grammar (by role initials): a conversation is empty, or an optional system turn and then pairs of user and assistant turns.  The parser
reads a conversation's rows in order with a graph-structured stack.  Each row is kept, given to the user or the assistant (rerole) or deleted, and turns may
be inserted anywhere; each edit has a weight.  Stacks with the same top accept the same continuations in this grammar, so they are merged
and the least (cost, audit) stays.  Audits of the same rows and cost are never beginnings of one another, so the merge keeps the
ASCII-least of the cheapest.

Rows are dealt out by ranges of (conversation, turn), so a conversation of any size is spread over tasks.  Rows that are alike in all columns
are one row with a count.  A task parses a piece of ``PIECE`` rows of a conversation from every stack top that can stand at its start;
the pieces of a conversation are then chained, one small row per piece.  The repaired text's hash has to read a conversation's rows in
order, so that last step streams each conversation through one task, holding its audit and one row.

Rows of one turn are ordered by role and then by the text's md5.  Null role and text are one space (the row is then blank or has no role to
keep), a null turn comes first, rows without conv_id are one conversation.  Empty tables give empty ones; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from raretide.llm.common import table, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # weights of the edits; TRUNCATED: of a row that breaks off and stays
PIECE = 1000
SPACE = " \t\n\x0b\x0c\r"
ROLE = {"u": "user", "a": "assistant"}

# The LR table of C -> | B | s B;  B -> P | B P;  P -> u a.  States: 0 begin, 1 s, 2 u, 3 u a, 4 P, 5 B, 6 s B, 7 B P.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (5, "u"): 2, (6, "u"): 2, (2, "a"): 3}
REDUCE = {3: ("P", 2), 4: ("B", 1), 7: ("B", 2)}
GOTO = {(0, "P"): 4, (0, "B"): 5, (1, "P"): 4, (1, "B"): 6, (5, "P"): 7, (6, "P"): 7}
ACCEPT = frozenset({0, 5, 6})
# The tops that can stand between two rows, each with its shortest stack.
STACKS = {0: (0,), 1: (0, 1), 2: (0, 2), 3: (0, 2, 3)}


@functools.lru_cache(maxsize=None)
def reduced(stack: tuple[int, ...]) -> tuple[int, ...]:
    while stack[-1] in REDUCE:
        symbol, n = REDUCE[stack[-1]]
        stack = stack[:-n]
        stack += (GOTO[stack[-1], symbol],)
    return stack


@functools.lru_cache(maxsize=None)
def shifted(stack: tuple[int, ...], symbol: str) -> tuple[int, ...] | None:
    """The stack after a turn with this role initial, or None."""
    for stack in (stack,) if (stack[-1], symbol) in SHIFT else (reduced(stack),):
        to = SHIFT.get((stack[-1], symbol))
        return stack + (to,) if to is not None else None


def accepts(stack: tuple[int, ...]) -> bool:
    return reduced(stack)[-1] in ACCEPT


Tops = dict  # stack top -> (cost, audit, stack): the graph-structured stack, equal tops merged


def merge(tops: Tops, cost: int, audit: str, stack: tuple[int, ...] | None) -> bool:
    if stack is None:
        return False
    best = tops.get(stack[-1])
    if best is None or (cost, audit) < best[:2]:
        tops[stack[-1]] = (cost, audit, stack)
        return True
    return False


def inserts(tops: Tops) -> None:
    """All that inserted turns can reach from here."""
    todo = list(tops)
    while todo:
        cost, audit, stack = tops[todo.pop()]
        for symbol in ROLE:
            to = shifted(stack, symbol)
            if merge(tops, cost + INSERT, audit + "I", to):
                todo.append(to[-1])


def consume(tops: Tops, initial: str, must_go: bool, truncated: bool) -> Tops:
    """The tops behind a row."""
    out: Tops = {}
    for cost, audit, stack in tops.values():
        merge(out, cost + DELETE, audit + "D", stack)
        if not must_go:
            left = cost + (TRUNCATED if truncated else 0)
            merge(out, left + KEEP, audit + "K", shifted(stack, initial))
            for symbol in ROLE:
                merge(out, left + REROLE, audit + "R", shifted(stack, symbol))
    return out


def step(tops: Tops, initial: str, blank: bool, repeated: bool, truncated: bool, n: int) -> Tops:
    """A row that occurs ``n`` times; its repeats have to go, before anything is inserted (D is less than I)."""
    inserts(tops)
    tops = consume(tops, initial, blank or repeated, truncated)
    return {k: (c + DELETE * (n - 1), a + "D" * (n - 1), s) for k, (c, a, s) in tops.items()} if n > 1 else tops


# ---------------------------------------------------------------- rows and their faults

def conversation_key(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def rows_of(conversations: DataFrame) -> DataFrame:
    """Rows with nulls filled, the key ``c`` and the order (``has_turn``, ``t``, ``role``, ``h``) of each conversation."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("role", "text"))
    return (conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
            .select("conv_id", conversation_key(F.col("conv_id")).alias("c"), F.col("turn").isNotNull().alias("has_turn"),
                    F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("t"), "role", "text", F.md5(F.col("text").cast("binary")).alias("h")))


def faults(rows: DataFrame) -> DataFrame:
    """Distinct rows without their texts: ``n`` (how often), ``blank``, ``repeated`` (role and text seen earlier), ``truncated``."""
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    slim = rows.select("c", "has_turn", "t", "role", "h", (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("broken"))
    each = slim.groupBy("c", "has_turn", "t", "role", "h").agg(F.count("*").alias("n"), F.max("blank").alias("blank"), F.max("broken").alias("broken"))
    first = slim.groupBy("c", "role", "h").agg(F.min(F.struct("has_turn", "t")).alias("at")).select(
        "c", "role", "h", F.col("at.has_turn").alias("has_turn"), F.col("at.t").alias("t"), F.lit(True).alias("first"))
    seen = F.col("first").isNull() & ~F.col("blank")
    return (each.join(first, ["c", "has_turn", "t", "role", "h"], "left")
            .select("c", "has_turn", "t", "role", "h", "n", "blank", seen.alias("repeated"),
                    (F.col("broken") & ~F.col("blank") & ~seen).alias("truncated")))


# ---------------------------------------------------------------- parse

_PATHS = "array<struct<enter:int,leave:int,cost:long,audit:string>>"
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_PIECES = ("c string, part int, piece int, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, "
           f"first_initial string, last_initial string, paths {_PATHS}")
_VERDICT = "c string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
LEGAL = frozenset({"su", "ua", "au"})
FLUSH = 2000


def _schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def _parse(kind: pa.Schema):
    """Sorted distinct rows -> pieces of conversations, each with the best paths between stack tops."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, piece, tops, known, last, number = [], None, {}, 0, None, 0

        def close() -> None:
            for enter, t in tops.items():
                piece["paths"] += [{"enter": enter, "leave": k, "cost": c, "audit": a} for k, (c, a, _) in t.items()]
            out.append(piece)

        for batch in batches:
            for r in batch.to_pylist():
                initial, n = r["role"][:1], r["n"]
                if piece and (piece["c"] != r["c"] or known >= PIECE):
                    close()
                    piece = None
                if piece is None:
                    begins = last is not None and last != r["c"]  # a task's first conversation may have begun in an earlier task
                    number, last, known = (number + 1 if last == r["c"] else 0), r["c"], 0
                    tops = {k: {k: (0, "", s)} for k, s in STACKS.items() if k == 0 or not begins}
                    piece = {"c": last, "part": r["part"], "piece": number, "low": None, "high": None, "turns": 0, **dict.fromkeys(_COUNTS, 0),
                             "first_initial": initial, "last_initial": None, "paths": []}
                piece["blank"] += n if r["blank"] else 0
                piece["duplicate"] += 0 if r["blank"] else n - 1 + r["repeated"]
                piece["truncated"] += r["truncated"]
                before = piece["last_initial"]
                piece["illegal"] += n - 1 + (before is not None and before + initial not in LEGAL)
                piece["last_initial"] = initial
                if r["has_turn"] and r["t"] != piece["high"]:
                    piece["turns"] += 1
                    piece["high"] = r["t"]
                    piece["low"] = r["t"] if piece["low"] is None else piece["low"]
                tops = {k: step(t, initial, r["blank"], r["repeated"], r["truncated"], n) for k, t in tops.items()}
                known += 1
            if len(out) >= FLUSH:
                yield pa.RecordBatch.from_pylist(out, schema=kind)
                out = []
        if piece:
            close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=kind)
    return run


def _chain(kind: pa.Schema):
    """Pieces in order -> the verdict of each conversation."""
    def verdict(s: dict) -> dict:
        tops = {k: (c, a, STACKS[k]) for k, (c, a) in s["tops"].items()}
        inserts(tops)
        cost, audit = min((c, a) for c, a, stack in tops.values() if accepts(stack))
        gaps = s["high"] - s["low"] + 1 - s["turns"] if s["turns"] else 0
        return {**{k: s[k] for k in ("c", *_COUNTS)}, "gaps": gaps, "cost": cost, "audit": "".join(s["done"]) + audit}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, out = None, []
        for batch in batches:
            for p in batch.to_pylist():
                if state is None or state["c"] != p["c"]:
                    if state:
                        out.append(verdict(state))
                    state = {"c": p["c"], **dict.fromkeys(_COUNTS, 0), "turns": 0, "low": None, "high": None, "initial": None, "tops": {0: (0, "")}, "done": []}
                for k in _COUNTS:
                    state[k] += p[k]
                if state["initial"] is not None:
                    state["illegal"] += state["initial"] + p["first_initial"] not in LEGAL
                state["initial"] = p["last_initial"]
                if p["turns"]:
                    state["turns"] += p["turns"] - (state["high"] == p["low"])
                    state["low"] = p["low"] if state["low"] is None else state["low"]
                    state["high"] = p["high"]
                tops: dict[int, tuple[int, str]] = {}
                for x in p["paths"]:
                    if x["enter"] in state["tops"]:
                        cost, audit = state["tops"][x["enter"]]
                        new = (cost + x["cost"], audit + x["audit"])
                        tops[x["leave"]] = min(new, tops.get(x["leave"], new))
                shared = os.path.commonprefix([a for _, a in tops.values()])  # said once: what is left stays short
                state["done"].append(shared)
                state["tops"] = {k: (c, a[len(shared):]) for k, (c, a) in tops.items()}
            if len(out) >= FLUSH:
                yield pa.RecordBatch.from_pylist(out, schema=kind)
                out = []
        if state:
            out.append(verdict(state))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=kind)
    return run


def verdicts(rows: DataFrame) -> DataFrame:
    """One row per key ``c`` that has rows: gaps, blank, duplicate, truncated, illegal, cost, audit."""
    order = ["c", "has_turn", "t", "role", "h"]
    dealt = faults(rows).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    pieces = dealt.mapInArrow(_parse(_schema(_PIECES)), _PIECES)
    return pieces.repartition("c").sortWithinPartitions("c", "part", "piece").mapInArrow(_chain(_schema(_VERDICT)), _VERDICT)


# ---------------------------------------------------------------- apply

class Repairer:
    """Applies an audit to the rows of one conversation as they come."""

    def __init__(self, audit: str):
        self.edits, self.stack = iter(audit), STACKS[0]

    def _put(self, symbol: str) -> None:
        self.stack = shifted(self.stack, symbol)

    def _open(self) -> str:
        """The role that the grammar asks for here, of user and assistant."""
        return next(s for s in ROLE if shifted(self.stack, s))

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        for edit in self.edits:
            if edit == "I" or edit == "R":
                symbol = self._open()
                self._put(symbol)
                yield ROLE[symbol], text if edit == "R" else ""
            elif edit == "K":
                self._put(role[:1])
                yield role, text
            if edit != "I":
                return

    def rest(self) -> Iterator[tuple[str, str]]:
        """Turns inserted behind the last row."""
        yield from self.row("", "")


def _streamed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's verdict row and behind it its rows in order, conversation by conversation in sorted tasks."""
    heads = found.select("c", F.lit(False).alias("is_row"), "conv_id", *_COUNTS, "gaps", "cost", "audit")
    body = rows.select("c", F.lit(True).alias("is_row"), "has_turn", "t", "role", "h", "text")
    both = heads.unionByName(body, allowMissingColumns=True)
    return both.repartition("c").sortWithinPartitions("c", "is_row", "has_turn", "t", "role", "h")


def _applied(digest: bool, kind: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, head, repairer, sha, place = [], None, None, None, 0

        def give(turns: Iterator[tuple[str, str]]) -> None:
            nonlocal place
            for role, text in turns:
                if digest:
                    sha.update(f"{chr(10) if place else ''}{role}:{text}".encode())
                else:
                    out.append({"conv_id": head["conv_id"], "place": place, "role": role, "text": text})
                place += 1

        def close() -> None:
            give(repairer.rest())
            if digest:
                out.append({**{k: head[k] for k in ("conv_id", "gaps", *_COUNTS, "cost", "audit")}, "repaired_sha256": sha.hexdigest()})

        for batch in batches:
            for r in batch.to_pylist():
                if r["is_row"]:
                    give(repairer.row(r["role"], r["text"]))
                else:
                    if head:
                        close()
                    head, repairer, sha, place = r, Repairer(r["audit"]), hashlib.sha256(), 0
            if len(out) >= FLUSH:
                yield pa.RecordBatch.from_pylist(out, schema=kind)
                out = []
        if head:
            close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=kind)
    return run


def judged(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """The verdict of every conversation of the table; one without rows has nothing to repair."""
    everyone = conversations.select("conv_id").distinct().withColumn("c", conversation_key(F.col("conv_id")))
    counts = [F.coalesce(k, F.lit(0)).alias(k) for k in ("gaps", *_COUNTS, "cost")]
    return everyone.join(verdicts(rows), "c", "left").select("c", "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"))


def repaired(conversations: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text."""
    rows = written(rows_of(conversations), "conversation-rows")
    kind = f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}, place long, role string, text string"
    return _streamed(rows, judged(conversations, rows)).mapInArrow(_applied(False, _schema(kind)), kind)


def report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """The verdict of every conversation with the sha256 of its repaired text."""
    kind = (f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
            "audit string, repaired_sha256 string")
    return _streamed(rows, judged(conversations, rows)).mapInArrow(_applied(True, _schema(kind)), kind)


# ---------------------------------------------------------------- the registered query

def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with faults put in by crc32(`conv_id:turn`) % 20: 0 drops a row, 1 empties its text, 2 removes
    its marks, 3 repeats it, 4 makes it the user's."""
    named = [F.coalesce(F.col(k).cast("string"), F.lit(" ")) for k in ("conv_id", "turn")]
    role, text = (F.coalesce(F.col(k).cast("string"), F.lit(" ")) for k in ("role", "text"))
    kind = F.col("__kind")
    new_text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return (conversations.select("conv_id", "turn", "role", "text", (F.crc32(F.concat_ws(":", *named).cast("binary")) % 20).alias("__kind"))
            .where(kind != 0)
            .select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), new_text.alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("__copy")).drop("__copy"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return report(conversations, rows_of(damaged(conversations)))


# The same by a recursive pass over rows that keeps the least (cost, audit) of each stack top (0 begin, 1 s, 2 u, 3 u a).
SQL = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
      lambda c, x: list_reduce(list_concat([xor(c, x)], range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)), 4294967295::BIGINT) % 20 AS k
  FROM conversations),
dam AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw WHERE k <> 0),
num AS (SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, role[1] AS initial,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM dam),
told AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM num),
flt AS (SELECT *, bare = '' AS blank, seen AND bare <> '' AS dup, NOT seen AND bare <> '' AND right(bare, 1) NOT IN ('.', '!', '?') AS trunc,
    coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS illegal FROM told),
ins(p, q, added) AS (VALUES (0, 0, []::VARCHAR[]), (0, 2, ['user:']), (0, 3, ['user:', 'assistant:']), (1, 1, []), (1, 2, ['user:']), (1, 3, ['user:', 'assistant:']),
    (2, 2, []), (2, 3, ['assistant:']), (3, 3, []), (3, 2, ['user:'])),
act(p, q, edit, symbol) AS (VALUES (0, 0, 'D', ''), (1, 1, 'D', ''), (2, 2, 'D', ''), (3, 3, 'D', ''), (0, 2, 'R', 'user'), (1, 2, 'R', 'user'), (2, 3, 'R', 'assistant'), (3, 2, 'R', 'user'),
    (0, 1, 'K', 's'), (0, 2, 'K', 'u'), (1, 2, 'K', 'u'), (2, 3, 'K', 'a'), (3, 2, 'K', 'u')),
dp(conv_id, i, top, best) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} FROM num
  UNION ALL
  SELECT f.conv_id, f.i, act.q, min({'cost': best.cost + 3 * len(added) + CASE edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN trunc AND edit <> 'D' THEN 3 ELSE 0 END,
      'audit': best.audit || repeat('I', len(added)) || edit,
      'lines': list_concat(best.lines, added, CASE edit WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text] ELSE [symbol || ':' || f.text] END)})
  FROM dp JOIN flt f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1 JOIN ins ON ins.p = dp.top JOIN act ON act.p = ins.q
  WHERE CASE edit WHEN 'D' THEN true WHEN 'R' THEN NOT (blank OR dup) ELSE NOT (blank OR dup) AND f.initial = symbol END
  GROUP BY f.conv_id, f.i, act.q),
stat AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT) AS blank, sum(dup::INT) AS duplicate,
    sum(trunc::INT) AS truncated, sum(illegal::INT) AS illegal FROM flt GROUP BY conv_id),
fin AS (SELECT dp.conv_id, min({'cost': best.cost + 3 * len(added), 'audit': best.audit || repeat('I', len(added)), 'lines': list_concat(best.lines, added)}) AS best
  FROM dp JOIN stat s ON s.conv_id IS NOT DISTINCT FROM dp.conv_id AND s.n = dp.i JOIN ins ON ins.p = dp.top WHERE ins.q IN (0, 3) GROUP BY dp.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN stat s ON s.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN fin f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
"""

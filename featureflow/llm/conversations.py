"""Conversation structure repair by scalar big-integer weights.

A conversation's rows, in turn order, are edited until the role initials read ``(s?(ua)+)?``: keep (K, cost 0), give
another role (R, 3), delete (D, 4; the only choice for blank and duplicate rows), insert an empty text (I, 3); a truncated
row that is not deleted adds 3. The edits form a DAG over (row, state of the pattern). The weight of a path is one integer:
its high digits are the cost, its low digits (base 8, of fixed width) the letters of the audit by position, zeros behind
the last one. The smallest integer is the cheapest path and, of those, the one whose audit is least in ASCII order, so the
DP needs nothing but integer additions and minima.

Two paths of equal cost between the same states are never prefixes of each other (the letters decide the roles; the longer
one would only add inserts, which cost). So minima can be taken block by block: rows are range-partitioned by conversation
and turn, each block of at most ``BLOCK_ROWS`` rows gives a table (state in, state out) -> (cost, audit), and only
conversations that may go on in another block meet again, as tables of their blocks. No task holds a whole conversation;
the digest of a long one streams its blocks in order.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from featureflow.llm.common import SPACES, c, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package installed

BLOCK_ROWS = 256        # rows of a block,
BLOCK_CHARS = 1 << 20   # or so many code points of text (a longer text is a block of its own)
START, SYSTEM, USER, ASSISTANT = range(4)  # states: nothing yet, after s, after u, after a
ACCEPTING = (START, ASSISTANT)
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}   # in ASCII order; 0 is the padding
AUDIT = str.maketrans("1234", "DIKR")
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 3, 4, 3, 3
BLANK, DUPLICATE, TRUNCATED, FINE = "blank", "duplicate", "truncated", ""
LEGAL = {"su", "ua", "au"}
MAX_LONG = 2**63 - 1


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text) damaged by crc32 of ``conv:turn`` modulo 20: 0 drops the row, 1 empties its text, 2
    takes its ``.!?``, 3 repeats it, 4 makes it a user's. Nulls read as one space in the sum, the role and the text."""
    gap = lambda x: F.coalesce(x.cast("string"), F.lit(" "))
    d = rows.select(c(conv).alias("conv"), c(turn).cast("long").alias("turn"), gap(c(role)).alias("role"), gap(c(text)).alias("text"),
                    (F.crc32(F.concat(gap(c(conv)), F.lit(":"), gap(c(turn))).cast("binary")) % 20).alias("fate")).where("fate <> 0")
    body = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (d.select("conv", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), body.alias("text"),
                     F.explode(copies).alias("copy")).drop("copy"))


def fault(text: Column) -> Column:
    """blank: no character but white space; truncated: the last such character is none of ``.!?``; else fine."""
    last = F.substring(F.rtrim(text, F.lit(SPACES)), -1, 1)
    return F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(FINE)


class Paths:
    """Smallest weights from one state to each, over the rows added so far. ``width`` digits hold any audit."""

    def __init__(self, start: int, width: int):
        self.width = width
        self.best: list = [None] * 4  # state -> (weight, letters so far)
        self.best[start] = (0, 0)

    def _step(self, path, cost: int, letter: str) -> tuple[int, int]:
        weight, n = path
        return weight + (cost << 3 * self.width) + (DIGIT[letter] << 3 * (self.width - 1 - n)), n + 1

    @staticmethod
    def _lower(best: list, state: int, path) -> None:
        if best[state] is None or path < best[state]:
            best[state] = path

    def insert(self) -> None:
        """An inserted turn between rows; a second one is tried after s or at the start, more never pay."""
        for a in (START, SYSTEM, ASSISTANT, USER):
            if self.best[a] is not None:
                self._lower(self.best, ASSISTANT if a == USER else USER, self._step(self.best[a], INSERT_COST, "I"))

    def row(self, initial: str, truncated: bool) -> None:
        more, old, self.best = TRUNCATED_COST * truncated, self.best, [None] * 4
        for a, path in enumerate(old):
            if path is None:
                continue
            self._lower(self.best, a, self._step(path, DELETE_COST, "D"))
            b = ASSISTANT if a == USER else USER
            if initial == ("a" if a == USER else "u"):
                self._lower(self.best, b, self._step(path, KEEP_COST + more, "K"))
            else:
                self._lower(self.best, b, self._step(path, REROLE_COST + more, "R"))
                if initial == "s" and a == START:
                    self._lower(self.best, SYSTEM, self._step(path, KEEP_COST + more, "K"))

    def deleted(self, n: int) -> None:
        """``n`` rows that must go. Inserts among them could as well stand behind them, where the audit is less."""
        every = ((1 << 3 * n) - 1) // 7 * DIGIT["D"]
        self.best = [p and (p[0] + (n * DELETE_COST << 3 * self.width) + (every << 3 * (self.width - p[1] - n)), p[1] + n) for p in self.best]

    def found(self) -> list[tuple[int, int, str]]:
        """(state, cost, audit) of the states that can be reached."""
        out = []
        for state, path in enumerate(self.best):
            if path is not None:
                low = path[0] & ((1 << 3 * self.width) - 1)
                digits = format(low >> 3 * (self.width - path[1]), "o") if path[1] else ""
                out.append((state, path[0] >> 3 * self.width, digits.translate(AUDIT)))
        return out


def block_paths(rows: list[dict], starts=range(4)) -> list[tuple[int, int, int, str]]:
    """(state in, state out, cost, audit) of a block of rows (role, kind, n: copies beyond the first must go; gone: the
    first as well)."""
    width = sum(r["n"] for r in rows) + 2 * len(rows) + 2
    out = []
    for start in starts:
        p = Paths(start, width)
        for r in rows:
            p.insert()
            if not r["gone"]:
                p.row(r["role"][:1], r["kind"] == TRUNCATED)
            if r["n"] - (not r["gone"]):
                p.deleted(r["n"] - (not r["gone"]))
        p.insert()
        out += [(start, *x) for x in p.found()]
    return out


def replay(rows: list[dict], audit: str, state: int) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that an audit leaves, from a state on."""
    each = (r for r in rows for _ in range(r["n"]))
    for letter in audit:
        r = None if letter == "I" else next(each)
        if letter == "D":
            continue
        expected = "assistant" if state == USER else "user"
        role = r["role"] if letter == "K" else expected
        state = SYSTEM if letter == "K" and role[:1] == "s" else ASSISTANT if state == USER else USER
        yield letter, role, r["text"] if r else ""


class Tally:
    """Counts over rows in order, which tallies of consecutive blocks add up to."""

    def __init__(self, first=None):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.head = self.tail = self.low = self.high = None
        self.__dict__.update(first or {})

    def add(self, r: dict) -> None:
        n, initial = r["n"], r["role"][:1]
        if r["kind"] == BLANK:
            self.blank += n
        else:
            self.duplicate += n - (not r["gone"])
            self.truncated += r["kind"] == TRUNCATED and not r["gone"]
        self.illegal += n - 1 + (self.tail is not None and self.tail + initial not in LEGAL)
        self.head, self.tail = initial if self.head is None else self.head, initial
        if r["turn"] is not None:
            self.turns += self.high != r["turn"]
            self.low, self.high = r["turn"] if self.low is None else self.low, r["turn"]

    def join(self, o: Tally) -> None:
        for k in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, k, getattr(self, k) + getattr(o, k))
        self.illegal += self.tail is not None and o.head is not None and self.tail + o.head not in LEGAL
        self.turns -= self.high is not None and self.high == o.low
        self.head, self.tail = o.head if self.head is None else self.head, o.tail if o.tail is not None else self.tail
        self.low, self.high = o.low if self.low is None else self.low, o.high if o.high is not None else self.high

    def gaps(self) -> int:
        return 0 if self.low is None else min(self.high - self.low + 1 - self.turns, MAX_LONG)


TALLY = "struct<blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,turns:bigint,head:string,tail:string,low:bigint,high:bigint>"
PATHS = "array<struct<a:int,b:int,cost:bigint,audit:string>>"
ROWS = "array<struct<turn:bigint,role:string,text:string,kind:string,gone:boolean,n:bigint>>"
TURNS = "array<struct<edit:string,role:string,text:string>>"
REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _report(tally: Tally, cost: int, audit: str) -> dict:
    return {"gaps": tally.gaps(), "blank": tally.blank, "duplicate": tally.duplicate, "truncated": tally.truncated,
            "illegal": tally.illegal, "cost": cost, "audit": audit}


def _lines(turns) -> str:
    return "\n".join(f"{role}:{text}" for _, role, text in turns)


def _named(turns) -> list[dict]:
    return [{"edit": e, "role": r, "text": t} for e, r, t in turns]


def _rows_of(batches) -> Iterator[dict]:
    for b in batches:
        for at in range(0, b.num_rows, 512):
            yield from b.slice(at, 512).to_pylist()


def _blocks(rows: Iterator[dict], keep_text: bool) -> Iterator[dict]:
    """Blocks of sorted rows. A block is open if its conversation may have others, in this or a neighbouring partition;
    a closed one is a whole conversation and gives its report at once."""
    block: list[dict] = []
    chars, edge, split = 0, True, False

    def close(is_open: bool) -> dict:
        tally = Tally()
        for r in block:
            tally.add(r)
        out = {"conv": block[0]["conv"], "pos": block[0]["pos"]}
        if is_open:
            paths = [dict(zip(("a", "b", "cost", "audit"), x, strict=True)) for x in block_paths(block)]
            return out | {"tally": tally.__dict__, "paths": paths, "rows": block}
        cost, audit = min((cost, audit) for _, b, cost, audit in block_paths(block, (START,)) if b in ACCEPTING)
        turns = list(replay(block, audit, START))
        return out | {"report": _report(tally, cost, audit), "sha256": hashlib.sha256(_lines(turns).encode()).hexdigest(),
                      "turns": _named(turns) if keep_text else None}
    for r in rows:
        if block and r["conv"] != block[0]["conv"]:
            yield close(edge or split)
            block, chars, edge, split = [], 0, False, False
        elif block and (len(block) >= BLOCK_ROWS or chars + len(r["text"]) > BLOCK_CHARS):
            yield close(True)
            block, chars, split = [], 0, True
        block.append(r)
        chars += len(r["text"])
    if block:
        yield close(True)


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int = 256) -> Iterator[pa.RecordBatch]:
    """Record batches of so many rows at most."""
    part: list[dict] = []
    for r in rows:
        part.append(r)
        if len(part) >= most:
            yield pa.RecordBatch.from_pylist(part, schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_pylist(part, schema=schema)


def _choose(blocks: Iterator[dict]) -> Iterator[dict]:
    """For the blocks of each conversation, in order, the state that the cheapest path enters them in and its audit there;
    the last one carries the report. Partial paths are (cost, audit of the block, state in, pos, partial path before)."""
    def less(x, y) -> bool:
        if x[0] != y[0]:
            return x[0] < y[0]
        mine, other = [], []
        while x is not y:  # back to where the two part: usually a few blocks
            mine.append(x[1])
            other.append(y[1])
            x, y = x[4], y[4]
        return "".join(reversed(mine)) < "".join(reversed(other))

    def end():
        path = None
        for state in ACCEPTING:
            if best[state] is not None and (path is None or less(best[state], path)):
                path = best[state]
        cost, back = path[0], []
        while path[4] is not None:
            back.append({"pos": path[3], "state": path[2], "audit": path[1]})
            path = path[4]
        back[0]["report"] = _report(tally, cost, "".join(x["audit"] for x in reversed(back)))
        yield from reversed(back)
    conv, best, tally = None, None, None
    for r in blocks:
        if best is None or r["conv"] != conv:
            if best is not None:
                yield from end()
            conv, tally = r["conv"], Tally()
            best = [(0, "", START, None, None), None, None, None]
        tally.join(Tally(r["tally"]))
        old, best = best, [None] * 4
        for p in r["paths"]:
            if old[p["a"]] is not None:
                path = (old[p["a"]][0] + p["cost"], p["audit"], p["a"], r["pos"], old[p["a"]])
                if best[p["b"]] is None or less(path, best[p["b"]]):
                    best[p["b"]] = path
    if best is not None:
        yield from end()


def _digests(pieces: Iterator[dict]) -> Iterator[dict]:
    """Report and digest of each conversation from its blocks, replayed in order."""
    sha, empty = hashlib.sha256(), True
    for r in pieces:
        for turn in replay(r["rows"], r["audit"], r["state"]):
            sha.update(("" if empty else "\n").encode() + _lines([turn]).encode())
            empty = False
        if r["report"] is not None:
            yield {"conv": r["conv"], "report": r["report"], "sha256": sha.hexdigest()}
            sha, empty = hashlib.sha256(), True


def _in_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` (rows to rows) over each partition in Arrow batches."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)
    return df.mapInArrow(lambda batches: _batches(fn(_rows_of(batches)), arrow), fields)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           keep_text: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(report, turns). The report has one row a conversation: conv, gaps (turns missing between the first and the last),
    blank, duplicate, truncated (rows by first fault), illegal (adjacent role initials that the pattern forbids), cost,
    audit and sha256 (of the repaired ``role:text`` lines). Turns, with ``keep_text`` only: (conv, pos, turns), the repaired
    turns (edit, role, text) of each block; blocks of a conversation are ordered by pos.

    Rows are taken by turn, nulls first, equal turns by role and text. Null roles and texts read as one space; rows of null
    conversations form one; repeated rows are duplicates; an empty table gives empty results. Very long texts are blocks of
    their own, extra columns are ignored. The conversation's column keeps its type; its name in the results is ``conv``.
    """
    gap = lambda x: F.coalesce(c(x).cast("string"), F.lit(" "))
    d = rows.select(c(conv).alias("conv"), c(turn).cast("long").alias("turn"), gap(role).alias("role"), gap(text).alias("text"))
    d = d.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    sized = lambda x: F.concat(F.length(x).cast("string"), F.lit(":"), x)
    named = F.coalesce(sized(F.col("conv").cast("string")), F.lit("-"))
    d = d.withColumn("same", F.md5(F.concat(named, sized(F.col("role")), F.col("text")).cast("binary"))).withColumn("kind", fault(F.col("text")))
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = d.where(F.col("kind") != BLANK).groupBy("same").agg(F.min(when).alias("first"), F.count(F.lit(1)).alias("turns_"))
    d = d.join(again.where("turns_ > 1").drop("turns_"), "same", "left")
    d = d.withColumn("gone", (F.col("kind") == BLANK) | F.coalesce(when > F.col("first"), F.lit(False))).drop("same", "first")
    order = ("conv", F.col("turn").asc_nulls_first(), "role", "text")
    by = ("conv", F.col("turn").asc_nulls_first(), F.substring("role", 1, 32), F.substring("text", 1, 64))
    d = d.repartitionByRange(*by).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())
    kind = rows.schema[conv].dataType.simpleString()
    report = f"report struct<{REPORT}>, sha256 string"
    blocks = stored(_in_arrow(d, lambda it: _blocks(it, keep_text),
                              f"conv {kind}, pos bigint, {report}, turns {TURNS}, tally {TALLY}, paths {PATHS}, rows {ROWS}"), "conversations-blocks")
    whole, parts = blocks.where("tally is null"), blocks.where("tally is not null")
    slim = parts.select("conv", "pos", "tally", "paths").repartition("conv").sortWithinPartitions("conv", "pos")
    chosen = stored(_in_arrow(slim, _choose, f"pos bigint, state int, audit string, report struct<{REPORT}>"), "conversations-paths")
    pieces = parts.select("conv", "pos", "rows").join(chosen, "pos")
    digests = _in_arrow(pieces.repartition("conv").sortWithinPartitions("conv", "pos"), _digests, f"conv {kind}, {report}")
    found = whole.select("conv", "report", "sha256").unionByName(digests)
    found = found.select("conv", *[F.col(f"report.{n}").alias(n) for n in NAMES], "sha256")
    if not keep_text:
        return found, None

    def replayed(it):
        for r in it:
            yield {"conv": r["conv"], "pos": r["pos"], "turns": _named(replay(r["rows"], r["audit"], r["state"]))}
    return found, whole.select("conv", "pos", "turns").unionByName(_in_arrow(pieces, replayed, f"conv {kind}, pos bigint, turns {TURNS}"))

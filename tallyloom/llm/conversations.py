"""Operator 12: repair of the structure of conversations by depth-first branch-and-bound.

A conversation must read, by the initials of its roles, ``(s?(ua)+)?``. Rows stand in the order of turn (nulls first); rows of one
turn in that of role, then of a digest of role and text. Its rows become one letter each (initial and fault). A search node is a row
and a state of the pattern; edits are its branches: Delete 3, Insert 2, Keep 0, Rerole 2, and 1 for a truncated row that stays. The
search has an explicit stack and takes branches in ASCII order of their initials, so what it meets later has the larger audit.
Suffix lower bounds are the cheapest costs of what is left when audits are ignored, by one pass from the end; a node whose cost and
bound exceed the incumbent (cost, audit) is cut. Each node's dominance table keeps the cheapest prefix that has reached it: prefixes
of one node and cost have equally many letters besides I, so neither begins the other, and the smaller one stays smaller whatever
follows. The stack running empty is the proof.

A conversation may hold any part of all rows. Rows of a conversation are dealt by ranges of turns, so a long one spreads over many
tasks; its letters are searched in blocks of at most ``block`` rows, for each state at either end, and the blocks' costs are put
together (16 numbers a block). Equal rows are summed before they are shuffled. What stays sequential is the digest (and text) of the
repaired conversation, since SHA-256 is: rows are streamed in order through the task of their conversation, one batch in memory beside its
audit. Null roles and texts are one space; an empty role has no initial and can't be kept; an empty table gives no rows; extra columns are ignored; a conversation is the rows of one
conv_id, null too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

BLOCK = 1 << 14
BLANKS = " \t\n\v\f\r"

#: Letters of rows: initials s, u, a and any other (x); in capitals the truncated, as digits those that must be deleted.
LETTERS, CUT_LETTERS, GONE_LETTERS = "suax", "SUAX", "0123"
FAR = 1 << 60
#: States: nothing yet, after a system row, after a user row, after an assistant row.
_AFTER = (2, 2, 3, 2)  # an inserted or renamed row is what must come next
_KEEP = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1), "x": (-1, -1, -1, -1)}
#: Of each letter: extra cost if it stays (-1: it can't), and the state that keeping it leads to.
RULES = {c.encode()[0]: (extra, _KEEP[LETTERS[k]]) for extra, row in ((0, LETTERS), (1, CUT_LETTERS), (-1, GONE_LETTERS)) for k, c in enumerate(row)}
LEGAL = {"su", "ua", "au"}
D, I, K, R = b"DIKR"


def lower_bounds(codes: bytes, end: int | None) -> list[tuple[int, int, int, int]]:
    """At each row and state, the least cost of what is left. end: the state after the last row (None: the end of a conversation)."""
    if end is None:
        now = (0, 4, 2, 0)  # inserts complete the last pair
    else:
        now = tuple(0 if s == end else FAR for s in range(4))
    out = [now]
    for c in reversed(codes):
        extra, keep = RULES[c]
        base = []
        for s in range(4):
            best = 3 + now[s]
            if extra >= 0:
                best = min(best, 2 + extra + now[_AFTER[s]])
                if keep[s] >= 0:
                    best = min(best, extra + now[keep[s]])
            base.append(best)
        now = tuple(min(base[s], 2 + base[_AFTER[s]], 4 + base[_AFTER[_AFTER[s]]]) for s in range(4))
        out.append(now)
    out.reverse()
    return out


def search(codes: bytes, begin: int, end: int | None, bounds: list[tuple[int, int, int, int]]) -> tuple[int, str] | None:
    """The cheapest cost and, of its audits, the ASCII-least, from the state ``begin`` to ``end`` (None: the end of a conversation)."""
    n, best, most = len(codes), None, bounds[0][begin]
    if most >= FAR:
        return None
    reached: list[dict[int, int]] = [{} for _ in range(n + 1)]
    path = bytearray()
    stack = [(0, begin, 0, 0, 0)]  # row, state, letters before it, its letter, cost
    while stack:
        i, s, depth, letter, cost = stack.pop()
        low = cost + bounds[i][s]
        if low > most or best and low >= best[0] or reached[i].get(s, FAR) <= cost:
            continue
        reached[i][s] = cost
        del path[max(0, depth - 1) :]
        if depth:
            path.append(letter)
        if i == n and (s in (0, 3) if end is None else s == end):
            best = (cost, path.decode())
            continue
        depth += 1
        if i < n:
            extra, keep = RULES[codes[i]]
            if extra >= 0:
                stack.append((i + 1, _AFTER[s], depth, R, cost + 2 + extra))
                if keep[s] >= 0:
                    stack.append((i + 1, keep[s], depth, K, cost + extra))
        if i < n or end is None:
            stack.append((i, _AFTER[s], depth, I, cost + 2))
        if i < n:
            stack.append((i + 1, s, depth, D, cost + 3))
    return best


def solve(codes: bytes, first: bool, last: bool) -> list[tuple[int, int, int, str, int]]:
    """(state at the begin, at the end, cost, audit, place of the audit among those of its begin) of a block. The last block of a
    conversation has the end -1."""
    found = []
    for end in [None] if last else range(4):
        bounds = lower_bounds(codes, end)
        for begin in [0] if first else range(4):
            if best := search(codes, begin, end, bounds):
                found.append((begin, -1 if end is None else end, *best))
    order = {x: k for k, x in enumerate(sorted({x[3] for x in found}))}
    return [(*x, order[x[3]]) for x in found]


def choose(blocks: pd.DataFrame) -> pd.DataFrame:
    """Of the blocks of one conversation, the state at the begin and the end of each on the cheapest way, ASCII-least."""
    blocks = blocks.sort_values(["part", "seq"], kind="stable")
    ways = [(key, list(zip(b["begin"], b["end"], b["cost"], b["place"], strict=True))) for key, b in blocks.groupby(["part", "seq"], sort=False)]
    togo, after = [], {-1: 0}
    for _, block in reversed(ways):
        now: dict[int, int] = {}
        for begin, end, cost, _ in block:
            if end in after:
                now[begin] = min(now.get(begin, FAR), cost + after[end])
        togo.append(after)
        after = now
    togo.reverse()
    out, s = [], 0
    for (key, block), after in zip(ways, togo, strict=True):
        _, place, end = min((cost + after[end], place, end) for begin, end, cost, place in block if begin == s and end in after)
        out.append((*key, s, end))
        s = end
    chosen = pd.DataFrame(out, columns=["part", "seq", "begin", "end"])
    chosen.insert(0, "conv_id", blocks["conv_id"].iloc[0])
    return chosen[["conv_id", "part", "seq", "begin", "end"]]


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that crc32 of ``conv_id:turn`` modulo 20 says: 0 drops the row, 1 empties its text, 2
    removes its full stops, exclamation and question marks, 3 repeats it, 4 makes it the user's."""
    one = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"), F.coalesce(F.col("turn").cast("string"), one)).cast("binary")) % 20
    plain = rows.select("conv_id", "turn", F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text"), kind.alias("kind")).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return plain.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def _same(a: DataFrame, b: DataFrame, keys: list[str], how: str) -> DataFrame:
    """An equi-join by keys that may be null."""
    other = b.withColumnsRenamed({k: f"{k}_b" for k in keys})
    on = [a[k].eqNullSafe(other[f"{k}_b"]) for k in keys]
    return a.join(other, on, how).drop(*(f"{k}_b" for k in keys))


def with_digest(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``same``, a digest of role and text."""
    one = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text"))
    return rows.withColumn("same", F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text").cast("binary"), 256)))


def coded(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, same, copies, blank, repeat, cut of each different row; ``repeat``: an earlier turn has the same."""
    end = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    each = rows.select("conv_id", "turn", "role", "same", (end == "").alias("blank"), (~end.isin(".", "!", "?")).alias("cut"))
    each = each.groupBy("conv_id", "turn", "role", "same", "blank", "cut").agg(F.count("*").alias("copies"))
    each = materialize(each, "rows")
    at = F.struct(F.col("turn").isNotNull().alias("later"), "turn")
    first = each.where("not blank").groupBy("conv_id", "same").agg(F.min(at).alias("first"), F.count("*").alias("turns")).where("turns > 1").drop("turns")
    out = _same(each, first, ["conv_id", "same"], "left")
    return out.withColumn("repeat", F.col("first").isNotNull() & ~at.eqNullSafe(F.col("first"))).drop("first")


def blocks_of(each: DataFrame, block: int) -> DataFrame:
    """conv_id, part, seq, codes: the letters of each conversation in blocks, in order of (part, seq)."""
    initial = F.substring("role", 1, 1)
    k = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(4)
    gone = F.substring(F.lit(GONE_LETTERS), k, F.lit(1))
    first = F.when(F.col("blank") | F.col("repeat"), gone).when(F.col("cut"), F.substring(F.lit(CUT_LETTERS), k, F.lit(1))).otherwise(F.substring(F.lit(LETTERS), k, F.lit(1)))
    keys = ["conv_id", "turn", "role", "same"]
    ordered = each.select(*keys, first.alias("first"), gone.alias("gone"), "copies").repartitionByRange(*keys).sortWithinPartitions(*keys)
    kind = each.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, at, codes, done = TaskContext.get().partitionId(), 0, (), bytearray(), []

        def flush(least: int) -> None:
            nonlocal seq
            while len(codes) >= least and codes:
                done.append((at[0], seq, bytes(codes[:block])))
                del codes[:block]
                seq += 1

        def result(column: pa.DataType) -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], column), pa.array([part] * len(done), pa.int32()), pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.binary())], ["conv_id", "part", "seq", "codes"])
            done.clear()
            return out

        column = None
        for b in batches:
            column = b["conv_id"].type
            for conv, first, gone, copies in zip(*(b[c].to_pylist() for c in ("conv_id", "first", "gone", "copies")), strict=True):
                if at != (conv,):
                    flush(1)
                    at = (conv,)
                codes += (first + gone * (copies - 1)).encode()
                flush(block)
            if done:
                yield result(column)
        flush(1)
        if done:
            yield result(column)

    return ordered.select("conv_id", "first", "gone", "copies").mapInArrow(run, f"conv_id {kind.simpleString()}, part int, seq long, codes binary")


def audits(each: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, cost, audit of each conversation that has rows."""
    cut = materialize(blocks_of(each, block), "blocks")
    at = F.struct("part", "seq")
    ends = cut.groupBy("conv_id").agg(F.min(at).alias("low"), F.max(at).alias("high"))
    cut = _same(cut, ends, ["conv_id"], "inner").select("conv_id", "part", "seq", "codes", (at == F.col("low")).alias("first"), (at == F.col("high")).alias("last"))
    id_type = each.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, row = [], []
            for i, (codes, first, last) in enumerate(zip(*(b[c].to_pylist() for c in ("codes", "first", "last")), strict=True)):
                ways = solve(codes, first, last)
                found += ways
                row += [i] * len(ways)
            row = pa.array(row, pa.int64())
            begin, end, cost, audit, place = zip(*found, strict=True) if found else ((),) * 5
            kept = [b[c].take(row) for c in ("conv_id", "part", "seq")]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x, pa.int64()) for x in (begin, end, cost)), pa.array(audit, pa.string()), pa.array(place, pa.int64())], ["conv_id", "part", "seq", "begin", "end", "cost", "audit", "place"])

    solved = materialize(cut.mapInArrow(run, f"conv_id {id_type}, part int, seq long, begin long, end long, cost long, audit string, place long"), "ways")
    many = ends.where("low < high").select("conv_id")
    long = _same(solved, many, ["conv_id"], "left_semi")
    chosen = long.select("conv_id", "part", "seq", "begin", "end", "cost", "place").groupBy("conv_id").applyInPandas(choose, f"conv_id {id_type}, part int, seq long, begin long, end long")
    pieces = _same(long, chosen, ["conv_id", "part", "seq", "begin", "end"], "left_semi")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "seq", "audit"))), lambda x: x["audit"]), "")
    whole = pieces.groupBy("conv_id").agg(F.sum("cost").alias("cost"), joined.alias("audit"))
    return _same(solved, many, ["conv_id"], "left_anti").select("conv_id", "cost", "audit").union(whole.select("conv_id", "cost", "audit"))


class Repair:
    """Carries out an audit on the rows of a conversation as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def _role(self) -> str:
        self.state = _AFTER[self.state]
        return "user" if self.state == 2 else "assistant"

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the rows inserted here."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield "I", self._role(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """What stands in place of a row, with what is inserted before it."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _KEEP[role[0]][self.state]
            yield "K", role, text
        elif edit == "R":
            yield "R", self._role(), text


def heads(rows: DataFrame, original: DataFrame, block: int) -> DataFrame:
    """One row for each conversation of ``original``: conv_id, gaps, blank, duplicate, truncated, cost, audit."""
    each = materialize(coded(rows), "coded")
    number = lambda c: c.cast("long")
    blank, repeat = F.col("blank"), F.col("repeat")
    turns = each.groupBy("conv_id", "turn").agg(
        F.sum(F.when(blank, F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(~blank, F.col("copies") - F.when(repeat, 0).otherwise(1)).otherwise(0)).alias("duplicate"),
        F.sum(number(~blank & ~repeat & F.col("cut"))).alias("truncated"),
    )
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    faults = turns.groupBy("conv_id").agg(number(gaps).alias("gaps"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    all_ids = original.select("conv_id").distinct()
    found = _same(_same(all_ids, faults, ["conv_id"], "left"), audits(each, block), ["conv_id"], "left")
    return found.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "cost")), F.coalesce("audit", F.lit("")).alias("audit"))


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "cost"]


def repair(rows: DataFrame, original: DataFrame | None = None, block: int = BLOCK, texts: bool = False) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation of ``original`` (else of
    ``rows``: conv_id, turn, role, text). With ``texts`` the repaired rows instead: conv_id, place (from 1), edit, role, text."""
    rows = with_digest(rows)
    head = heads(rows, rows if original is None else original, block)
    head = head.select("conv_id", F.lit(0).alias("kind"), *(F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "role", "text", "same")), *NUMBERS, "audit")
    body = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "same", *(F.lit(None).cast("long").alias(c) for c in NUMBERS), F.lit(None).cast("string").alias("audit"))
    ordered = head.union(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "same")
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, done, column = None, [], None  # own: conv_id, numbers, the repair, digest, rows so far, illegal pairs, last initial

        def put(made: Iterator[tuple[str, str, str]]) -> None:
            for edit, role, text in made:
                own["n"] += 1
                if texts:
                    done.append((own["id"], own["n"], edit, role, text))
                else:
                    own["digest"].update(f"{chr(10) if own['n'] > 1 else ''}{role}:{text}".encode())

        def close() -> None:
            put(own["repair"].inserted())
            if not texts:
                done.append((own["id"], *own["numbers"][:4], own["illegal"], own["numbers"][4], own["repair"].audit, own["digest"].hexdigest()))

        def result() -> pa.RecordBatch:
            types = [column, pa.int64(), pa.string(), pa.string(), pa.string()] if texts else [column, *[pa.int64()] * 6, pa.string(), pa.string()]
            names = ["conv_id", "place", "edit", "role", "text"] if texts else ["conv_id", *NUMBERS[:4], "illegal", "cost", "audit", "repaired_sha256"]
            out = pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], t) for k, t in enumerate(types)], names)
            done.clear()
            return out

        for b in batches:
            column = b["conv_id"].type
            for conv, kind, role, text, audit, *numbers in zip(*(b[c].to_pylist() for c in ("conv_id", "kind", "role", "text", "audit", *NUMBERS)), strict=True):
                if kind == 0:
                    if own:
                        close()
                    own = {"id": conv, "numbers": numbers, "repair": Repair(audit), "digest": hashlib.sha256(), "n": 0, "illegal": 0, "last": None}
                    continue
                initial = role[:1]
                own["illegal"] += own["last"] is not None and own["last"] + initial not in LEGAL
                own["last"] = initial
                put(own["repair"].row(role, text))
            if done:
                yield result()
        if own:
            close()
            if done:
                yield result()

    names = "place long, edit string, role string, text string" if texts else ", ".join(f"{c} long" for c in [*NUMBERS[:4], "illegal", "cost"]) + ", audit string, repaired_sha256 string"
    return ordered.select("conv_id", "kind", "role", "text", "audit", *NUMBERS).mapInArrow(run, f"conv_id {id_type}, {names}")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(damage(rows), rows)

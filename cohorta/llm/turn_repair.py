"""Repair of conversations: the cheapest edits that turn the roles into `(s?(ua)+)?`, by weighted interval parsing.

The repair grammar is in Chomsky normal form. A nonterminal names what a span does to the target pattern: `pq` for "from
state p to state q" (0 nothing yet, S after a system turn, U after a user turn, A after an assistant turn).

    binary rules    pr -> pq qr
    terminal rules  pq -> row, by Keep, Rerole or Delete of that row
    insertion       every cell is closed under Insert in front of and behind the span

A cell holds, for each nonterminal, the least (cost, audit). Cells are combined bottom-up by span length: 1, 2, 4, ...
Since a nonterminal names both of its ends, every split of a span gives the same cell (tests compare with all splits),
so one split per span is enough and a conversation of n rows takes n combinations. Within equal cost an audit is never
the beginning of another one of the same span (the rest would be inserts, which cost), so the least audit of two
joined spans is made of their least audits.

Spans are Spark rows: rows are numbered in order across the table, every BLOCK_RUNS runs are combined in one group, and the
spans of longer conversations meet in further rounds of FAN spans, so no task parses a whole hot conversation. Text moves
once, sorted by conversation, for the digest of the repaired turns, and is read as a stream: it is never held. What
belongs to one conversation by contract, its audit and its digest, is made as one value.

Order: by turn, null first; rows of one turn by role, then by the SHA-256 of their text. Equal rows of a conversation are one
run with a number of copies. Null role or text is one space, null conv_id or turn one space in the key of the damage; rows
with a null conv_id are one conversation. A conversation none of whose rows are left has zeros, an empty audit and the
digest of the empty text. An empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohorta.session import parallelism, stage

BLOCK_RUNS, FAN = 512, 256
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

#: The target pattern as steps (state, role initial, state); it may end in 0 or A.
STEPS = (("0", "s", "S"), ("0", "u", "U"), ("S", "u", "U"), ("U", "a", "A"), ("A", "u", "U"))
ENDS = ("0", "A")

STATES = "0SUA"
REACH = {p: {p} for p in STATES}
for _ in STATES:
    for _p, _, _q in STEPS:
        for _r in STATES:
            if _p in REACH[_r]:
                REACH[_r].add(_q)
NONTERMINALS = [p + q for p in STATES for q in STATES if q in REACH[p]]
AT = {name: k for k, name in enumerate(NONTERMINALS)}
RULES = [[(AT[p + q], AT[q + r]) for q in STATES if p + q in AT and q + r in AT] for p, r in NONTERMINALS]

Cell = list  # per nonterminal (cost, audit) or None


def join(left: Cell, right: Cell) -> Cell:
    """Binary rules: the least (cost, audit) of every nonterminal over two neighbouring spans."""
    out = []
    for rules in RULES:
        best = None
        for i, j in rules:
            x, y = left[i], right[j]
            if x is not None and y is not None:
                cost = x[0] + y[0]
                if best is None or cost < best[0]:
                    best = (cost, x[1] + y[1])
                elif cost == best[0]:
                    best = min(best, (cost, x[1] + y[1]))
        out.append(best)
    return out


def _inserts() -> Cell:
    """The empty span closed under Insert: the fewest inserts between two states."""
    cell: Cell = [(0, "") if p == q else None for p, q in NONTERMINALS]
    step: Cell = [(INSERT, "I") if any((p, x, q) in STEPS for x in "ua") else None for p, q in NONTERMINALS]
    for _ in STATES:
        cell = [min(filter(None, pair), default=None) for pair in zip(cell, join(cell, step))]
    return cell


EMPTY = _inserts()


def leaf(initial: str, gone: bool, truncated: bool) -> Cell:
    """Terminal rules of one row, closed under Insert."""
    cell: Cell = [None] * len(NONTERMINALS)

    def rule(name: str, cost: int, letter: str):
        if cell[AT[name]] is None or (cost, letter) < cell[AT[name]]:
            cell[AT[name]] = (cost, letter)

    for p in STATES:
        rule(p + p, DELETE, "D")
    if not gone:
        for p, role, q in STEPS:
            if role == initial:
                rule(p + q, KEEP + TRUNCATED * truncated, "K")
            if role in "ua":
                rule(p + q, REROLE + TRUNCATED * truncated, "R")
    return join(join(EMPTY, cell), EMPTY)


_LEAVES: dict = {}


def run(initial: str, gone: bool, truncated: bool, copies: int) -> Cell:
    """A row and its copies, which are duplicates of it and go."""
    key = (initial if initial in ("s", "u", "a") else "", gone, truncated)
    if key not in _LEAVES:
        _LEAVES[key] = leaf(*key)
    cell = _LEAVES[key]
    if copies > 1:
        rest: Cell = [(DELETE * (copies - 1), "D" * (copies - 1)) if p == q else None for p, q in NONTERMINALS]
        cell = join(cell, join(rest, EMPTY))
    return cell


def parse(cells: list[Cell]) -> Cell:
    """Bottom-up by span length: neighbours of length 1, then 2, 4, ... are combined."""
    while len(cells) > 1:
        pairs = [join(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(cells) - len(cells) % 2:]
    return cells[0] if cells else EMPTY


def best(cell: Cell) -> tuple[int, str]:
    return min(c for c in (cell[AT["0" + q]] for q in ENDS) if c is not None)


# --- damage, faults and order as columns -------------------------------------------------------------------------

_WHITE = " \t\n\x0b\x0c\r"


def damaged(df: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copies) after damage: `copies` is 2 where a row is repeated."""
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv").cast("string"), space), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), space))) % 20
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    return df.withColumn("kind", kind).filter("kind <> 0").select(
        "conv", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(
            text).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def _runs(rows: DataFrame) -> DataFrame:
    """One row per run of equal rows, in order: i (its number in the table), fault flags and copies; without text."""
    end = F.rtrim("text", F.lit(_WHITE))
    slim = rows.select(
        "conv", "turn", "role", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), "copies",
        (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    runs = stage(slim.groupBy("conv", "turn", "role", "digest").agg(
        F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated")), "runs")
    # The same role and text in several turns: all but the first are duplicates. Few rows, and one row per text.
    turn = F.struct("turn")  # a null turn is the least
    again = runs.groupBy("conv", "role", "digest").agg(F.min(turn).alias("first"), F.count(F.lit(1)).alias("turns")).filter(
        "turns > 1").select(*[F.col(c).alias(f"_{c}") for c in ("conv", "role", "digest", "first")])
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    runs = runs.join(again, same, "left").withColumn(
        "seen", F.col("_first").isNotNull() & ~turn.eqNullSafe(F.col("_first"))).select(*runs.columns, "seen")
    order = ["conv", "turn", "role", "digest"]
    at = stage(runs.repartitionByRange(max(parallelism(runs.sparkSession), 1), *order).sortWithinPartitions(*order)
               .withColumn("at", F.monotonically_increasing_id()), "runs-in-order")
    slot = F.shiftright("at", 33)
    sizes = at.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("slot", F.coalesce(  # one row per range partition
        F.sum("size").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return at.withColumn("slot", slot).join(F.broadcast(before), "slot").withColumn(
        "i", F.col("before") + F.col("at") % (1 << 33)).drop("slot", "before", "at")


# --- spans -------------------------------------------------------------------------------------------------------

COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
SPAN = pa.schema(
    [("conv", pa.int64()), ("block", pa.int64()), ("spans", pa.int64())] + [(c, pa.int64()) for c in COUNTS]
    + [(c, pa.int64()) for c in ("low", "high")] + [(c, pa.string()) for c in ("head", "tail")]
    + [("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
_SPAN_DDL = ("conv long, block long, spans long, " + ", ".join(f"{c} long" for c in COUNTS)
             + ", low long, high long, head string, tail string, costs array<long>, audits array<string>")


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _merge(spans: list[dict]) -> dict:
    """Neighbouring spans as one: the counts are sums but for what meets at the borders."""
    out = dict(spans[0])
    for s in spans[1:]:
        for c in COUNTS:
            out[c] += s[c]
        out["illegal"] += not _legal(out["tail"], s["head"])
        if s["low"] is not None:  # turns are in order, so a shared one lies at the border; null turns come first
            out["turns"] -= out["high"] is not None and out["high"] == s["low"]
            out["low"] = s["low"] if out["low"] is None else out["low"]
            out["high"] = s["high"]
        out["tail"] = s["tail"]
    out["cell"] = parse([s["cell"] for s in spans])
    return out


def _single(row: dict) -> dict:
    n, blank, seen, initial = row["copies"], row["blank"], row["seen"], row["role"][:1]
    cut = row["truncated"] and not blank and not seen
    return {
        "blank": n if blank else 0, "duplicate": 0 if blank else n - (not seen), "truncated": int(cut),
        "illegal": n - 1 if not _legal(initial, initial) else 0, "turns": int(row["turn"] is not None),
        "low": row["turn"], "high": row["turn"], "head": initial, "tail": initial,
        "cell": run(initial, blank or seen, cut, n)}


def _table(spans: list[dict]) -> pa.Table:
    for s in spans:
        cell = s.pop("cell")
        s["costs"] = [None if c is None else c[0] for c in cell]
        s["audits"] = [None if c is None else c[1] for c in cell]
    return pa.Table.from_pylist(spans, schema=SPAN)


def _first_spans(table: pa.Table) -> pa.Table:
    rows, groups = table.sort_by("i").to_pylist(), {}
    for row in rows:
        groups.setdefault(row["conv"], []).append(_single(row))
    return _table([_merge(g) | {"conv": conv, "block": rows[0]["block"], "spans": 1} for conv, g in groups.items()])


def _later_spans(table: pa.Table) -> pa.Table:
    rows, groups = table.sort_by("block").to_pylist(), {}
    for row in rows:
        row["cell"] = [None if c is None else (c, a) for c, a in zip(row.pop("costs"), row.pop("audits"))]
        groups.setdefault(row["conv"], []).append(row)
    return _table([_merge(g) | {"block": g[0]["block"] // FAN} for g in groups.values()])


def _conversations(runs: DataFrame, block_runs: int) -> DataFrame:
    """One span per conversation: blocks of runs first, then spans of neighbouring blocks, FAN at a time."""
    spans = runs.withColumn("block", F.floor(F.col("i") / block_runs).cast("long")).groupBy("block").applyInArrow(
        _first_spans, _SPAN_DDL)
    done = None
    while True:
        spans = stage(spans, "spans")
        # A conversation is at its end once it lies in one span.
        several = spans.groupBy("conv").agg(F.count(F.lit(1)).alias("parts")).filter("parts > 1").select(
            F.col("conv").alias("_conv"))
        several = stage(several, "long-conversations")
        same = F.col("conv").eqNullSafe(F.col("_conv"))
        whole = spans.join(several, same, "left_anti")
        done = whole if done is None else done.unionByName(whole)
        if several.isEmpty():
            return done
        spans = spans.join(several, same, "left_semi").withColumn("part", F.floor(F.col("block") / FAN)).groupBy(
            "conv", "part").applyInArrow(lambda t: _later_spans(t.drop_columns(["part"])), _SPAN_DDL)


# --- results -----------------------------------------------------------------------------------------------------

RESULT = pa.schema([("conv_id", pa.int64())] + [(c, pa.int64()) for c in (
    "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string()), ("repaired_sha256", pa.string())])
_RESULT_DDL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Writer:
    """Feeds the repaired turns of one conversation to a digest while its rows pass by in order."""

    def __init__(self, audit: str):
        self.audit, self.k, self.n, self.any, self.sha = audit, 0, 0, False, hashlib.sha256()

    def _put(self, role: str, text: str):
        self.sha.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True

    def _next(self) -> str:
        self.n += 1
        return "user" if self.n % 2 else "assistant"

    def inserts(self):
        while self.k < len(self.audit) and self.audit[self.k] == "I":
            self.k += 1
            self._put(self._next(), "")

    def row(self, role: str, text: str):
        self.inserts()
        letter = self.audit[self.k]
        self.k += 1
        if letter == "R":
            self._put(self._next(), text)
        elif letter == "K":
            if role[:1] != "s":
                self._next()
            self._put(role, text)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    head, writer = None, None

    def close() -> dict:
        writer.inserts()
        return head | {"repaired_sha256": writer.sha.hexdigest()}

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["stats"] is not None:
                if head is not None:
                    out.append(close())
                head = {"conv_id": row["conv"], **row["stats"]}
                writer = _Writer(head["audit"])
            else:
                for _ in range(row["copies"]):
                    writer.row(row["role"], row["text"])
        yield pa.RecordBatch.from_pylist(out, schema=RESULT)
    if head is not None:
        yield pa.RecordBatch.from_pylist([close()], schema=RESULT)


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", *, damage: bool = True, block_runs: int = BLOCK_RUNS) -> DataFrame:
    """One row per conversation: conv_id, gaps, counts of faults, cost, audit and the digest of the repaired turns.

    damage=False repairs the rows as they are; with it they are damaged first, as the contract of the query says.
    """
    named = df.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                      F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    space = F.lit(" ")
    rows = damaged(named) if damage else named.select(
        "conv", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        F.lit(1).alias("copies"))
    spans = _conversations(_runs(rows), block_runs)

    def finish(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in table:
            got = [best([None if c is None else (c, a) for c, a in zip(cs, au)]) for cs, au in zip(
                batch.column("costs").to_pylist(), batch.column("audits").to_pylist())]
            keep = [batch.column(c) for c in ("conv", "low", "high", "turns", *COUNTS[:4])]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array([c for c, _ in got], pa.int64()), pa.array([a for _, a in got], pa.string())],
                ["conv", "low", "high", "turns", *COUNTS[:4], "cost", "audit"])

    parsed = spans.mapInArrow(finish, "conv long, low long, high long, turns long, " + ", ".join(
        f"{c} long" for c in COUNTS[:4]) + ", cost long, audit string")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    zero = F.lit(0).cast("long")
    stats = F.struct(gaps.alias("gaps"), *[F.coalesce(c, zero).alias(c) for c in (*COUNTS[:4], "cost")],
                     F.coalesce("audit", F.lit("")).alias("audit"))
    every = named.select(F.col("conv").alias("conv_")).distinct()
    none = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("copies", "int"))]
    heads = every.join(parsed, F.col("conv_").eqNullSafe(F.col("conv")), "left").select(
        F.col("conv_").alias("conv"), *none, stats.alias("stats"))
    body = rows.withColumn("stats", F.lit(None).cast(heads.schema["stats"].dataType))
    order = [F.col("conv"), F.col("stats").isNull(), F.col("turn"), F.col("role"), F.col("digest")]
    return heads.unionByName(body).withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256))).repartition(
        "conv").sortWithinPartitions(*order).drop("digest").mapInArrow(_digests, _RESULT_DDL)

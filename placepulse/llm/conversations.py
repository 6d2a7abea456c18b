"""Repair of conversations: the cheapest edits that give every conversation a legal order of roles.

A conversation's rows in order are the layers of an acyclic graph whose nodes are what may come
next. Edges are the edits of a row and the insertions in front of it. Every edge adds to one
integer weight: the high digits count the cost, the low digits, one per place of the audit, spell the
letters of the edits from the left, with zeros behind the end. The least integer is therefore the cheapest
repair and, of equally cheap ones, the one whose audit is least in ASCII order. Letters are three
bits wide, so that a weight's low digits are its octal digits.

A conversation of any length is cut into blocks. A block's result is the matrix of least weights
between the nodes at its two ends, and matrices are multiplied (least, append) in a tree: also a
conversation with a third of all rows is worked on by many tasks. Only the digest of a repaired
conversation goes through its rows in one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placepulse.llm.common import saved
from placepulse.operators.joins import lookup_join

#: Rows of one block; only a conversation that is longer, or that crosses partitions, has several.
BLOCK = 256
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 3, 4, 3, 3
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
#: Nodes: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. 0 and 3 may end.
NODES = 4
#: The node after the one role that may be put in at a node.
AFTER = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
Weight = int | None


def _least(*weights: Weight) -> Weight:
    found = [w for w in weights if w is not None]
    return min(found) if found else None


def _prepend(letter: int, cost: int, weight: Weight, width: int) -> Weight:
    if weight is None:
        return None
    bits = 3 * width
    low = weight & ((1 << bits) - 1)
    return (((weight >> bits) + cost) << bits) | (letter << (bits - 3)) | (low >> 3)


def _backward(rows: str, ends: list[Weight], width: int) -> list[Weight]:
    """Least weight from every node in front of ``rows`` to the ends behind them.

    ``rows`` has two characters a row: the role's initial and the fault. More than two
    insertions in one place never pay: of three, two neighbours can go.
    """
    at = ends
    for i in range(len(rows) - 2, -1, -2):
        initial, fault = rows[i], rows[i + 1]
        row = [_prepend(DELETE, DELETE_COST, w, width) for w in at]
        if fault in "-t":
            more = TRUNCATED_COST if fault == "t" else 0
            keep = KEPT.get(initial)
            for node in range(NODES):
                changed = _prepend(REROLE, REROLE_COST + more, at[AFTER[node]], width)
                kept = None
                if keep and keep[node] is not None:
                    kept = _prepend(KEEP, KEEP_COST + more, at[keep[node]], width)
                row[node] = _least(row[node], changed, kept)
        one = [_least(w, _prepend(INSERT, INSERT_COST, row[AFTER[n]], width)) for n, w in enumerate(row)]
        at = [_least(w, _prepend(INSERT, INSERT_COST, one[AFTER[n]], width)) for n, w in enumerate(row)]
    return at


def weight(cost: int, audit: str, width: int) -> int:
    """One integer: the cost, then the letters, then zeros up to ``width`` digits."""
    digits = audit.translate(_DIGITS).ljust(width, "0")
    return (cost << (3 * width)) | (int(digits, 8) if digits else 0)


def spelled(value: int, width: int) -> tuple[int, str]:
    """Cost and audit of a weight."""
    low = value & ((1 << (3 * width)) - 1)
    return value >> (3 * width), (f"{low:0{width}o}" if width else "").rstrip("0").translate(_LETTERS)


_DIGITS = str.maketrans("DIKR", "1234")
_LETTERS = str.maketrans("1234", "DIKR")
#: What it takes to end at each node.
ENDINGS = [(0, ""), (2 * INSERT_COST, "II"), (INSERT_COST, "I"), (0, "")]


@lru_cache(maxsize=1 << 14)
def repair(rows: str) -> tuple[int, str]:
    """Cost and audit of one conversation."""
    width = 3 * (len(rows) // 2) + 2
    ends = [weight(cost, audit, width) for cost, audit in ENDINGS]
    return spelled(_backward(rows, ends, width)[0], width)


#: Least weights from node to node, and the number of their low digits.
Matrix = tuple[list[list[Weight]], int]


def block(rows: str) -> Matrix:
    width = 3 * (len(rows) // 2)
    columns = [_backward(rows, [0 if n == end else None for n in range(NODES)], width) for end in range(NODES)]
    return [[columns[end][node] for end in range(NODES)] for node in range(NODES)], width


def _append(x: Weight, x_width: int, y: Weight, y_width: int) -> Weight:
    """The weight of one way after the other."""
    if x is None or y is None:
        return None
    low_x, low_y = x & ((1 << (3 * x_width)) - 1), y & ((1 << (3 * y_width)) - 1)
    unused = ((low_x & -low_x).bit_length() - 1) // 3 if low_x else x_width
    cost = (x >> (3 * x_width)) + (y >> (3 * y_width))
    return (cost << (3 * (x_width + y_width))) | (low_x << (3 * y_width)) | (low_y << (3 * unused))


def multiply(a: Matrix, b: Matrix) -> Matrix:
    (x, wide), (y, wider) = a, b
    found = [
        [_least(*(_append(x[i][k], wide, y[k][j], wider) for k in range(NODES))) for j in range(NODES)]
        for i in range(NODES)
    ]
    return found, wide + wider


def product(matrices: list[Matrix]) -> Matrix:
    """The product in order, as a tree."""
    if not matrices:
        return block("")
    while len(matrices) > 1:
        matrices = [multiply(*matrices[i : i + 2]) if i + 1 < len(matrices) else matrices[i] for i in range(0, len(matrices), 2)]
    return matrices[0]


def finished(matrix: Matrix) -> tuple[int, str]:
    """Cost and audit of a conversation whose matrix this is."""
    held, width = matrix
    ways = [_append(held[0][n], width, weight(cost, audit, 2), 2) for n, (cost, audit) in enumerate(ENDINGS)]
    return spelled(_least(*ways), width + 2)


def _packed(matrix: Matrix) -> list[str | None]:
    held, width = matrix
    return [None if w is None else "{} {}".format(*spelled(w, width)) for line in held for w in line]


def _unpacked(entries: list[str | None]) -> Matrix:
    ways = [None if e is None else e.split(" ") for e in entries]
    width = max(len(w[1]) for w in ways if w)
    flat = [None if w is None else weight(int(w[0]), w[1], width) for w in ways]
    return [flat[NODES * i : NODES * (i + 1)] for i in range(NODES)], width


_LEGAL = {"su", "ua", "au"}
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_REPORT = ("gaps", *_COUNTS, "cost", "audit")


class _Run:
    """The rows of one conversation that one partition holds, in order."""

    def __init__(self, conv):
        self.conv, self.first, self.last, self.turns = conv, None, None, 0
        self.counts = dict.fromkeys("bdti", 0)
        self.head = self.tail = None
        self.rows: list[str] = []
        self.blocks: list[Matrix] = []

    def add(self, turn, initial: str | None, fault: str) -> None:
        if initial is None:
            return  # names a conversation, is no row of it
        if turn is not None and turn != self.last:
            self.turns += 1
            self.last = turn
            self.first = turn if self.first is None else self.first
        if fault != "-":
            self.counts[fault] += 1
        if self.tail is not None and self.tail + initial not in _LEGAL:
            self.counts["i"] += 1
        self.head = initial if self.head is None else self.head
        self.tail = initial
        self.rows.append(initial + fault)
        if len(self.rows) == BLOCK:
            self.blocks.append(block("".join(self.rows)))
            self.rows = []

    def matrix(self) -> Matrix:
        return product([*self.blocks, block("".join(self.rows))])

    def result(self, part: int, whole: bool) -> tuple:
        cost = audit = entries = None
        if whole:
            cost, audit = finished(self.matrix()) if self.blocks else repair("".join(self.rows))
        else:
            entries = _packed(self.matrix())
        counts = tuple(self.counts[k] for k in "bdti")
        return (self.conv, part, whole, self.first, self.last, self.turns, self.head, self.tail, *counts, cost, audit, entries)


_PIECE = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int64()), ("whole", pa.bool_()), ("first", pa.int64()), ("last", pa.int64()),
     ("turns", pa.int64()), ("head", pa.string()), ("tail", pa.string()), *((c, pa.int64()) for c in _COUNTS),
     ("cost", pa.int64()), ("audit", pa.string()), ("entries", pa.list_(pa.string()))]
)
_PIECE_DDL = (
    "conv_id BIGINT, part BIGINT, whole BOOLEAN, first BIGINT, last BIGINT, turns BIGINT, head STRING, tail STRING, "
    + ", ".join(f"{c} BIGINT" for c in _COUNTS)
    + ", cost BIGINT, audit STRING, entries ARRAY<STRING>"
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last conversation of a partition may go on in others; all between are whole."""
    run, part, number, out = None, 0, 0, []
    for batch in batches:
        for conv, part, turn, initial, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if run is None or conv != run.conv:
                if run is not None:
                    out.append(run.result(part, number > 0))
                    number += 1
                run = _Run(conv)
            run.add(turn, initial, fault)
        if len(out) >= 1000:
            yield _batch(out, _PIECE)
            out = []
    if run is not None:
        out.append(run.result(part, False))
    yield _batch(out, _PIECE)


_WHOLE = pa.schema([("conv_id", pa.int64()), *((c, pa.string() if c == "audit" else pa.int64()) for c in _REPORT)])
_WHOLE_DDL = "conv_id BIGINT, " + ", ".join(f"{c} {'STRING' if c == 'audit' else 'BIGINT'}" for c in _REPORT)


def _joined(table: pa.Table) -> pa.Table:
    """One conversation from its pieces, of which each partition it crosses has one."""
    first = last = tail = None
    turns, counts, matrices = 0, dict.fromkeys(_COUNTS, 0), []
    for p in sorted(table.to_pylist(), key=lambda p: p["part"]):
        matrices.append(_unpacked(p["entries"]))
        turns += p["turns"] - (p["first"] is not None and p["first"] == last)
        first = p["first"] if first is None else first
        last = last if p["last"] is None else p["last"]
        for c in _COUNTS:
            counts[c] += p[c]
        if p["head"] is not None:
            counts["illegal"] += tail is not None and tail + p["head"] not in _LEGAL
            tail = p["tail"]
    gaps = 0 if first is None else last - first + 1 - turns
    row = (table.column("conv_id")[0].as_py(), gaps, *counts.values(), *finished(product(matrices)))
    return pa.Table.from_batches([_batch([row], _WHOLE)])


def _columns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with an identity of the text within its conversation; nulls are one space."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("-"))
    same = F.sha2(F.concat_ws(":", conv, F.length(role), F.concat(role, text)), 256)
    return turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), text.alias("text"), same.alias("_same"),
    )


_ORDER = ("conv_id", "turn", "role", "_same")


def audit_conversations(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    ``turns`` has ``conv_id, turn, role, text``; ``ids`` has the ``conv_id`` of conversations to be reported
    even without rows (zeros, empty audit). Rows count by turn, nulls first; rows of one turn by
    role and then by a hash of their text, so that repeated rows are neighbours. A null id is a conversation of its own;
    null roles and texts are one space. Each row's first fault counts: blank, duplicate (role and text seen
    before, equal by SHA-256) or truncated. An empty table gives an empty result.
    """
    rows = _columns(turns)
    shown = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    own = F.when(shown == "", "b").when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), "t").otherwise("-")
    initial = F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("-")
    slim = rows.select("conv_id", "turn", "role", "_same", initial.alias("_initial"), own.alias("_own"))
    slim = saved(slim.withColumn("_place", F.monotonically_increasing_id()), "turns")
    repeated = slim.where("_own <> 'b'").groupBy("_same").agg(
        F.min(F.struct("turn", "_place")).alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    repeated = saved(repeated.where("_n > 1").select("_same", F.col("_first._place").alias("_first")), "repeated")
    found = lookup_join(slim, repeated, ["_same"], "left")
    fault = F.when((F.col("_own") != "b") & (F.col("_first") != F.col("_place")), "d").otherwise(F.col("_own"))
    found = found.select(*_ORDER, "_place", "_initial", fault.alias("_fault"))
    if ids is not None:
        named = ids.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
        found = found.unionByName(named, allowMissingColumns=True)
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*_ORDER, "_place"]
    dealt = found.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = dealt.select("conv_id", F.spark_partition_id().cast("bigint").alias("part"), "turn", "_initial", "_fault")
    pieces = saved(dealt.mapInArrow(_pieces, _PIECE_DDL), "pieces")
    gaps = F.coalesce(F.col("last") - F.col("first") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    whole = pieces.where("whole").select("conv_id", gaps, *_REPORT[1:])
    # At most two rows a partition.
    crossing = pieces.where("NOT whole").groupBy("conv_id").applyInArrow(_joined, _WHOLE_DDL)
    return whole.unionByName(crossing)


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The repaired rows of conversations, each led by the row that has its audit: ``head, letter, role, text``.

    A conversation ends with a row without letter.
    """
    head, audit, at, node = None, "", 0, 0

    def inserted(end: bool):
        nonlocal at, node
        while at < len(audit) and audit[at] == "I" or end and at < len(audit):
            node = AFTER[node]
            yield head, "I", ROLE[node], ""
            at += 1

    for row in rows:
        plan, role, text = row[-3:]
        if plan is not None:
            if head is not None:
                yield from inserted(True)
                yield head, None, None, None
            head, audit, at, node = row, plan, 0, 0
            continue
        yield from inserted(False)
        letter = audit[at]
        at += 1
        if letter != "D":
            node = KEPT[role[0]][node] if letter == "K" else AFTER[node]
            yield head, letter, role if letter == "K" else ROLE[node], text
    if head is not None:
        yield from inserted(True)
        yield head, None, None, None


def _streamed(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows of a conversation together and in order, its audit in front."""
    rows = _columns(turns).unionByName(audits, allowMissingColumns=True)
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *_ORDER[1:])
    return dealt.select("conv_id", *(c for c in _REPORT if c != "audit"), "audit", "role", "text")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, 256).columns), strict=True)


_DIGEST = pa.schema([*_WHOLE, ("repaired_sha256", pa.string())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, digest, first = [], hashlib.sha256(), True
    for head, letter, role, text in _edited(_rows(batches)):
        if letter is None:
            out.append((*head[:-2], digest.hexdigest()))
            digest, first = hashlib.sha256(), True
        else:
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        if len(out) >= 1000:
            yield _batch(out, _DIGEST)
            out = []
    yield _batch(out, _DIGEST)


def repair_report(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``audit_conversations`` and ``repaired_sha256``: of the repaired ``role:text``, joined by newlines."""
    audits = saved(audit_conversations(turns, ids), "audits")
    return _streamed(turns, audits).mapInArrow(_digests, _WHOLE_DDL + ", repaired_sha256 STRING")


_TURN = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, number, size = [], 0, 0
    for head, letter, role, text in _edited(_rows(batches)):
        if letter is None:
            number = 0
            continue
        out.append((head[0], number, role, text, letter))
        number += 1
        size += len(text) + 100
        if size > 1 << 20:
            yield _batch(out, _TURN)
            out, size = [], 0
    yield _batch(out, _TURN)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired rows: ``conv_id, turn`` (from 0 without gaps), ``role, text, edit`` (K, R or I)."""
    audits = saved(audit_conversations(turns), "audits")
    return _streamed(turns, audits).mapInArrow(_turns, "conv_id BIGINT, turn BIGINT, role STRING, text STRING, edit STRING")


def damaged(turns: DataFrame) -> DataFrame:
    """Rows damaged by ``crc32('conv_id:turn') % 20``, nulls being one space there and in role and text.

    0 drops the row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 makes its role user.
    """
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat_ws(":", *filled[:2]).cast("binary")) % 20
    role = F.when(kind == 4, "user").otherwise(filled[2])
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(filled[3], "[.!?]", "")).otherwise(filled[3])
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = turns.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy"))
    return rows.drop("_copy")

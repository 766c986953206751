"""Conversation structure repair by weighted CYK interval parsing (op12).

A conversation should read ``(s?(ua)+)?``: perhaps a system row, then user and
assistant rows in turn.  A repair keeps, reroles, deletes or inserts rows; the
cheapest one is the best parse of the row sequence under a weighted grammar in
Chomsky normal form.  Its nonterminals [p,q] are the fragments of the target
language that lead from state p to state q of the role order, with the rules
[p,q] -> [p,r] [r,q], a terminal rule for each edit of a row, and the closure of
insertions put around each terminal.  A cell of the chart holds, for a span of
rows and a nonterminal, the least (cost, audit); cells are combined bottom-up by
span length.  Up to ``BLOCK`` rows the chart has all spans and all splits.  Each
split of a longer span gives the same cells (the rules are closed under every
intermediate state), so beyond that only spans of doubled length are combined:
the work of a conversation is linear in its rows.

Two candidates of equal cost over the same rows are never prefixes of each other
(the longer one would have further insertions, which cost), so the least audit of
a concatenation is the concatenation of the least audits.

Rows move twice: narrow (a digest and one byte a row, from which the parse
follows) and with their text to the hash of the repaired conversation.  Both
times a task streams sorted rows; it holds one byte a row of one conversation,
never its texts.  The parse depends on the row symbols only and is done once for
each distinct sequence that a task meets.

Defined results: a null conv_id is a conversation of its own.  Null roles and
texts are one space; a null turn comes first and counts in no gap.  Rows of equal
turn come in the order of the MD5 of role and text, so equal rows are adjacent.
Repeated rows are duplicates.  Other columns are ignored.  An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# States of the role order: start, after system, after user, after assistant.
STEPS = {"s": [(0, 1)], "u": [(0, 2), (1, 2), (3, 2)], "a": [(2, 3)], "o": []}
ENDS = ((0, 0), (0, 3))
# Rows of which the chart holds all spans.
BLOCK = 8
# A row's symbol: CLASSES.index(initial) * 4 + FAULTS.index(fault) + FIRST; 0 is a row that is not there.
CLASSES, FAULTS, FIRST = "suao", ("", "blank", "duplicate", "truncated"), 65
BLANKS = " \t\n\x0b\x0c\r"

Cells = dict[tuple[int, int], tuple[int, str]]


def better(cells: Cells, span: tuple[int, int], cost: int, audit: str) -> None:
    if span not in cells or (cost, audit) < cells[span]:
        cells[span] = (cost, audit)


def combine(left: Cells, right: Cells) -> Cells:
    """Cells of two neighbouring spans put together: [p,q] -> [p,r] [r,q]."""
    out: Cells = {}
    for (p, r), (c, x) in left.items():
        for (r2, q), (d, y) in right.items():
            if r == r2:
                better(out, (p, q), c + d, x + y)
    return out


def insertions() -> Cells:
    """Closure of insertions: the cheapest way from p to q without a row."""
    once: Cells = {(p, q): (INSERT, "I") for role in "ua" for p, q in STEPS[role]}
    out: Cells = {(p, p): (0, "") for p in range(4)}
    for _ in range(3):
        for span, (cost, audit) in combine(out, once).items():
            better(out, span, cost, audit)
    return out


@lru_cache(maxsize=None)
def terminal(symbol: int) -> Cells:
    """Cells of one row, with the insertions before and after it."""
    kind, fault = CLASSES[(symbol - FIRST) // 4], FAULTS[(symbol - FIRST) % 4]
    row: Cells = {(p, p): (DELETE, "D") for p in range(4)}
    if fault not in ("blank", "duplicate"):
        extra = TRUNCATED if fault == "truncated" else 0
        for p, q in STEPS["u"] + STEPS["a"]:
            better(row, (p, q), REROLE + extra, "R")
        for p, q in STEPS[kind]:
            better(row, (p, q), extra, "K")
    around = insertions()
    return combine(combine(around, row), around)


@lru_cache(maxsize=1 << 14)
def chart(symbols: bytes) -> Cells:
    """CYK over all spans of a few rows, by span length."""
    n = len(symbols)
    cells = {(i, i + 1): terminal(s) for i, s in enumerate(symbols)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            j, out = i + length, {}
            for k in range(i + 1, j):
                for span, (cost, audit) in combine(cells[i, k], cells[k, j]).items():
                    better(out, span, cost, audit)
            cells[i, j] = out
    return cells[0, n]


def parse(symbols: bytes) -> tuple[int, str]:
    """Least cost of a repair, and the least audit of that cost."""
    if not symbols:
        return 0, ""
    spans = [chart(symbols[i:i + BLOCK]) for i in range(0, len(symbols), BLOCK)]
    while len(spans) > 1:
        merged = [combine(a, b) for a, b in zip(spans[::2], spans[1::2])]
        spans = merged + spans[len(merged) * 2:]
    return min(spans[0][end] for end in ENDS if end in spans[0])


def profile(symbols: bytes) -> tuple[int, int, int, int, int, str]:
    """Blank, duplicate and truncated rows, illegal neighbours, cost and audit."""
    code = np.array(bytearray(symbols), np.int64) - FIRST
    kind, fault = code // 4, code % 4
    s, u, a = (CLASSES.index(c) for c in "sua")
    x, y = kind[:-1], kind[1:]
    legal = ((x == s) & (y == u)) | ((x == u) & (y == a)) | ((x == a) & (y == u))
    return (*(int((fault == i).sum()) for i in (1, 2, 3)), int((~legal).sum()), *parse(symbols))


class Profiles(dict):
    """Profiles of short sequences, each worked out once; long ones aren't kept."""

    def __missing__(self, symbols: bytes):
        found = profile(symbols)
        if len(symbols) <= 4 * BLOCK and len(self) < 1 << 16:
            self[symbols] = found
        return found


def runs(keys: pa.Array) -> np.ndarray:
    """Where runs of equal keys begin (nulls are equal), and the end."""
    codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(codes)) + 1
    return np.concatenate([[0], cuts, [len(codes)]]).astype(np.int64)


SIGNED = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv_id, turn, symbol) -> one profile a conversation."""
    known = Profiles()
    now, symbols, lo, hi, turns = None, bytearray(), None, None, 0
    started, kind = False, None

    def close(out):
        gaps = hi - lo + 1 - turns if turns else 0
        out.append((now, gaps, *known[bytes(symbols)]))

    def batch_of(out):
        columns = list(zip(*out))
        types = [kind, *[pa.int64()] * 6, pa.string()]
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys, kind = batch.column(0), batch.column(0).type
        turn = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
        numbered = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
        symbol = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)
        at, out = runs(keys), []
        for a, b in zip(at, at[1:]):
            key = keys[int(a)].as_py()
            if not started or key != now:
                if started:
                    close(out)
                now, symbols, lo, hi, turns, started = key, bytearray(), None, None, 0, True
            there = symbol[a:b] > 0
            symbols += symbol[a:b][there].tobytes()
            t = turn[a:b][there & numbered[a:b]]
            if len(t):
                turns += 1 + int((np.diff(t) != 0).sum()) - int(hi is not None and hi == t[0])
                lo, hi = int(t[0]) if lo is None else lo, int(t[-1])
        if out:
            yield batch_of(out)
    if started:
        out = []
        close(out)
        yield batch_of(out)


class Repaired:
    """Running hash of one repaired conversation, row after row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.written, self.turn = audit, 0, 0, 0
        self.hash = hashlib.sha256()

    def put(self, role: str, text: str) -> None:
        self.hash.update(("\n" * (self.written > 0) + f"{role}:{text}").encode())
        self.written += 1

    def due(self) -> str:
        self.turn += 1
        return ("user", "assistant")[(self.turn - 1) % 2]

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.put(self.due(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self.put(self.due(), text)
        elif edit == "K":
            if role[:1] != "s":  # a kept system row takes no turn
                self.turn += 1
            self.put(role, text)

    def end(self) -> str:
        self.inserts()
        return self.hash.hexdigest()


def digest_repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted: the profile of a conversation, then its rows -> the profile with the
    hash of the repaired text."""
    head, open_ = None, None

    def close():
        return pa.RecordBatch.from_arrays(
            [*[head.column(n) for n in names], pa.array([open_.end()])], names=[*names, "repaired_sha256"])

    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    for batch in batches:
        is_row = batch.column(batch.schema.get_field_index("is_row")).to_pylist()
        roles = batch.column(batch.schema.get_field_index("role")).to_pylist()
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        out = []
        for i, r in enumerate(is_row):
            if r:
                open_.row(roles[i], texts[i])
            else:
                if head is not None:
                    out.append(close())
                head = batch.slice(i, 1)
                open_ = Repaired(head.column(head.schema.get_field_index("audit"))[0].as_py())
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if head is not None:
        yield close()


def damage(rows: DataFrame) -> DataFrame:
    """The rows with the damage that their number draws: conv_id, turn, role, text, gone."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = (F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate(said("text"), ".!?", ""))
            .otherwise(said("text")))
    role = F.when(F.col("draw") == 4, "user").otherwise(said("role"))
    copies = F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    drawn = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", draw.alias("draw"))
    return (drawn.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                         (F.col("draw") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy"))


def _digest() -> Column:
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cheapest repair and hash of the repaired text of each conversation
    of ``rows`` (conv_id, turn, role, text without nulls, gone: row left out)."""
    conv = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.withColumn("digest", _digest())
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = rows.select("conv_id", "turn", "digest", "gone", kind.alias("kind"), (body == "").alias("blank"),
                         (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("cut")).repartition("conv_id")
    # partitions by conversation serve this window as they are
    seen = F.row_number().over(Window.partitionBy("conv_id", "digest", "gone").orderBy(F.asc_nulls_first("turn"))) > 1
    fault = F.when(F.col("blank"), 1).when(F.col("seen"), 2).when(F.col("cut"), 3).otherwise(0)
    symbol = F.when(F.col("gone"), 0).otherwise(F.col("kind") * 4 + fault + FIRST)
    # of equal rows of one turn the first is the one that was not seen earlier
    signed = (narrow.withColumn("seen", seen).select("conv_id", "turn", "digest", "seen", symbol.alias("symbol"))
              .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "digest", "seen")
              .select("conv_id", "turn", "symbol")
              .mapInArrow(sign, f"conv_id {conv}, {SIGNED}"))
    both = signed.withColumn("is_row", F.lit(False)).unionByName(
        rows.where("NOT gone").select("conv_id", "turn", "digest", "role", "text", F.lit(True).alias("is_row")),
        allowMissingColumns=True)
    return (both.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", F.asc_nulls_first("turn"), "digest")
            .mapInArrow(digest_repaired, f"conv_id {conv}, {SIGNED}, repaired_sha256 string"))


def op12_dialogue_repair(conversations: DataFrame) -> DataFrame:
    return repair(damage(conversations))


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit: a character is put in, then eight shifts."""
    steps = ", ".join(["-1"] * 8)
    each = f"flatten([[CAST(ascii(x) AS BIGINT), {steps}] FOR x IN string_split({text}, '')])"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {each}), "
            "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384::BIGINT * (c & 1)) END), 4294967295::BIGINT)")


def repair_sql() -> str:
    """DuckDB SQL for the query's rows: the repaired sequence row by row, with the best
    (cost, audit, text) for each state of the role order."""
    blank = r"[\x20\x09-\x0D]"
    said = lambda c: f"coalesce(CAST({c} AS VARCHAR), ' ')"
    best = lambda options: f"list_min([x FOR x IN [{', '.join(options)}] IF x IS NOT NULL])"
    states = range(4)
    # the first edits: insertions alone
    start = ["{'c': 0, 'a': '', 't': ''}", "NULL", "{'c': 5, 'a': 'I', 't': 'user:'}", "{'c': 10, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:'}"]

    def put(s: int, cost: str, edit: str, line: str) -> str:
        glue = f"CASE WHEN b{s}.t = '' THEN '' ELSE b{s}.t || chr(10) END"
        return f"CASE WHEN b{s} IS NOT NULL AND {{when}} THEN {{{{'c': b{s}.c + {cost}, 'a': b{s}.a || '{edit}', 't': {glue} || {line}}}}} END"

    moves = {q: [f"CASE WHEN b{q} IS NOT NULL THEN {{'c': b{q}.c + 2, 'a': b{q}.a || 'D', 't': b{q}.t}} END"] for q in states}
    for kind, name in (("s", "system"), ("u", "user"), ("a", "assistant")):
        for p, q in STEPS[kind]:
            moves[q].append(put(p, "extra", "K", "role || ':' || body").format(when=f"usable AND kind = '{kind}'"))
            if kind != "s":
                moves[q].append(put(p, "extra + 1", "R", f"'{name}:' || body").format(when="usable"))
    stepped = ", ".join(f"{best(moves[q])} AS m{q}" for q in states)

    def insert(s: int, line: str, twice: bool = False) -> str:
        lines = f"'{line}:'" if not twice else f"'{line}:' || chr(10) || '{'assistant' if line == 'user' else 'user'}:'"
        glue = f"CASE WHEN m{s}.t = '' THEN '' ELSE m{s}.t || chr(10) END"
        return f"CASE WHEN m{s} IS NOT NULL THEN {{'c': m{s}.c + {10 if twice else 5}, 'a': m{s}.a || '{'II' if twice else 'I'}', 't': {glue} || {lines}}} END"

    closed = {0: ["m0"], 1: ["m1"], 2: ["m2", *[insert(s, "user") for s in (0, 1, 3)]],
              3: ["m3", insert(2, "assistant"), *[insert(s, "user", True) for s in (0, 1)]]}
    after = ", ".join(f"{best(closed[q])} AS n{q}" for q in states)
    return f"""
    WITH RECURSIVE drawn AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, {said('role')} AS role, {said('text')} AS body,
                            {_crc32_sql(f"({said('conv_id')} || ':' || {said('turn')})")} % 20 AS draw FROM conversations),
    damaged AS (SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
                       CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(body, '.!?', '') ELSE body END AS body
                FROM drawn, (SELECT range AS copy FROM range(0, 2)) r WHERE draw <> 0 AND (copy = 0 OR draw = 3)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || body)) AS n,
                      regexp_replace(body, '{blank}+$', '') AS bare FROM damaged),
    counted AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, body ORDER BY n) AS again FROM placed),
    judged AS (SELECT *, CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE 'o' END AS kind,
                      CASE WHEN bare = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM counted),
    edited AS MATERIALIZED (SELECT conv_id, n, role, body, kind, fault IN ('', 'truncated') AS usable, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra FROM judged),
    walk AS (SELECT conv_id, 0 AS n, {', '.join(f"{x} AS b{i}" for i, x in enumerate(x if x != 'NULL' else "CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR))" for x in start))}
             FROM (SELECT DISTINCT conv_id FROM conversations) c
             UNION ALL
             SELECT conv_id, n, {after.replace(' AS n', ' AS b')} FROM (
               SELECT w.conv_id, e.n, {stepped} FROM walk w JOIN edited e ON w.conv_id IS NOT DISTINCT FROM e.conv_id AND e.n = w.n + 1) s),
    ended AS (SELECT conv_id, {best(['b0', 'b3'])} AS won FROM walk QUALIFY n = max(n) OVER (PARTITION BY conv_id)),
    faults AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
                      count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
                      count(*) FILTER (WHERE before IS NOT NULL AND before || kind NOT IN ('su', 'ua', 'au')) AS illegal
               FROM (SELECT *, lag(kind) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM judged) j GROUP BY conv_id)
    SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, CAST(won.c AS BIGINT) AS cost, won.a AS audit, sha256(won.t) AS repaired_sha256
    FROM ended e LEFT JOIN faults f ON e.conv_id IS NOT DISTINCT FROM f.conv_id"""

"""Conversation repair against plain search over edit scripts."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from pixelchange.llm import dialogue_repair as dr
from pixelchange.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.helpers import table, write

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def damaged(rows):
    """{conv_id: rows after damage, in order}."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub(r"[.!?]", "", text) if draw == 2 else text
        kept += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest())
    return {c: sorted(v, key=key) for c, v in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """(cost, audit, repaired) over all states of the role order, row after row."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(best):
        for _ in range(3):
            for state, (c, x, done) in list(best.items()):
                for role in ("user", "assistant"):
                    if (to := step.get((state, role[0]))) is not None:
                        new = (c + 5, x + "I", done + [f"{role}:"])
                        best[to] = min(best.get(to, new), new)
        return best

    best = inserted({"": (0, "", [])})
    for (_, role, text), f in zip(rows, fault):
        after = {}
        for state, (c, x, done) in best.items():
            options = [(c + 2, x + "D", done, state)]
            if f not in ("blank", "duplicate"):
                extra = 5 * (f == "truncated")
                for cost, edit, as_ in ((0, "K", role), (1, "R", "user"), (1, "R", "assistant")):
                    if (to := step.get((state, as_[:1]))) is not None:
                        options.append((c + cost + extra, x + edit, done + [f"{as_}:{text}"], to))
            for cost, audit, d, to in options:
                after[to] = min(after.get(to, (cost, audit, d)), (cost, audit, d))
        best = inserted(after)
    return min(best[s] for s in ("", "a") if s in best)


def expected(rows):
    out = {}
    for conv, kept in damaged(rows).items():
        fault = faults(kept)
        cost, audit, done = cheapest(kept, fault)
        turns = {t for t, _, _ in kept if t is not None}
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                     *(fault.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                     hashlib.sha256("\n".join(done).encode()).hexdigest())
    return out


def found(df):
    rows = df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def symbols(seed, n):
    r = random.Random(seed)
    return bytes(dr.FIRST + 4 * r.choice([0, 1, 1, 2, 2, 3]) + r.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))


def as_rows(code):
    names = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    kinds = [names[dr.CLASSES[(c - dr.FIRST) // 4]] for c in code]
    return [(i, k, "") for i, k in enumerate(kinds)], [dr.FAULTS[(c - dr.FIRST) % 4] for c in code]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_parse_is_the_least_of_all_edit_scripts(n):
    """Every script of edits with up to two insertions in each gap."""
    gaps = ["", "I", "II"]
    for code in itertools.product(range(dr.FIRST, dr.FIRST + 16), repeat=n) if n < 3 else [symbols(s, n) for s in range(60)]:
        rows, fault = as_rows(code)
        best = None
        for edits in itertools.product("KRD", repeat=n):
            for holes in itertools.product(gaps, repeat=n + 1):
                audit = "".join(h + e for h, e in zip(holes, edits)) + holes[-1]
                cost, options = 0, [""]
                at = 0
                for e in audit:
                    if e == "I":
                        cost, options = cost + 5, [o + x for o in options for x in "ua"]
                        continue
                    f, role = fault[at], rows[at][1][0]
                    at += 1
                    if e == "D":
                        cost += 2
                        continue
                    if f in ("blank", "duplicate"):
                        options = []
                        break
                    cost += 5 * (f == "truncated") + (e == "R")
                    options = [o + x for o in options for x in (role if e == "K" else "ua")]
                if any(LEGAL.match(o) for o in options):
                    best = min(best or (cost, audit), (cost, audit))
        assert dr.parse(bytes(code)) == best


@pytest.mark.parametrize("n", [4, 7, 8, 9, 16, 17, 40, 200])
def test_long_spans_agree_with_a_pass_row_by_row(n):
    for seed in range(40 if n < 50 else 5):
        code = symbols(seed * 1000 + n, n)
        assert dr.parse(code) == cheapest(*as_rows(code))[:2]


def test_doubled_spans_equal_the_whole_chart():
    for seed in range(5):
        code = symbols(seed, 3 * dr.BLOCK)
        whole = dr.chart.__wrapped__(code)
        assert min(whole[e] for e in dr.ENDS if e in whole) == dr.parse(code)


def test_the_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op12_dialogue_repair"](spark, SF_SMALL)) == expected(rows)


def test_nulls_ties_repeats_and_long_conversations(spark):
    r = random.Random(5)
    rows = [(None, None, None, None), (None, 3, "user", "a."), (1, None, "user", "x."), (1, None, "user", "x."),
            (1, 5, None, "y"), (1, 5, "", " "), (2, 1, "assistant", "\t \n"), (2, 9, "system", "s?"),
            (3, 1, "tool", "z"), (3, 1, "tool", "z"), (3, 1, "System", "\x00."), (4, 7, "user", "w " * 50_000)]
    rows += [(7, i, r.choice(["user", "assistant", "system", "tool"]), r.choice(["a.", "b!", "c", "", "d?", f"e{i}."])) for i in range(700)]
    rows += [(c, i, r.choice(["user", "assistant"]), f"{c} {i}.") for c in range(100, 160) for i in range(r.randrange(1, 9))]
    df = table(spark, rows, SCHEMA)
    assert found(dr.op12_dialogue_repair(df)) == expected(rows)


def test_all_rows_dropped_and_empty_table(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "hello.")]
    assert found(dr.op12_dialogue_repair(table(spark, rows, SCHEMA))) == {
        gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert dr.op12_dialogue_repair(table(spark, [], SCHEMA)).collect() == []


def test_extra_columns_with_clashing_names(spark, tmp_root):
    rows = [(1, 0, "user", "hi.", 4, "k"), (1, 1, "assistant", "yes.", 5, "d")]
    df = table(spark, rows, SCHEMA + ", cost int, digest string").selectExpr("*", "1 AS is_row", "2 AS gone", "3 AS draw", "4 AS symbol")
    path = write(spark, tmp_root, conversations=df)
    assert found(QUERIES["op12_dialogue_repair"](spark, path)) == expected([r[:4] for r in rows])


@pytest.mark.parametrize("given", [True, False])
def test_sql(given, tmp_path):
    """The query's SQL against the search over edit scripts, on the given and on odd rows."""
    con = duckdb.connect()
    if given:
        con.execute(f"CREATE TABLE conversations AS SELECT conv_id, turn, role, text FROM read_parquet('{SF_SMALL}/conversations.parquet')")
    else:
        r = random.Random(6)
        con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
        rows = [(None, None, None, None), (None, 3, "user", "a."), (1, None, "user", "x."), (1, 5, "", " "), (2, 9, "system", "s?"), (2, 9, "system", "s?")]
        rows += [(c, i, r.choice(["user", "assistant", "system", "tool", None]), r.choice(["a.", "b!", "c", "", "d? \n", f"e{i}."])) for c in range(10, 90) for i in range(12)]
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    rows = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    out = con.execute(f"SELECT conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 FROM ({ORACLE['op12_dialogue_repair']}) q").fetchall()
    assert {r[0]: r[1:] for r in out} == expected(rows)

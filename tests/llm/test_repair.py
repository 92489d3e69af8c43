"""Conversation repair against a plain search over all edit sequences."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tessera.llm import queries, repair

SPACE = " \t\n\x0b\x0c\r"
FORM = re.compile(r"(s?(ua)+)?")
#: Beginnings of what the form allows.
BEGUN = re.compile(r"s?(ua)*u?")


def damaged(conv, turn, role, text):
    """The rows that a row becomes."""
    role, text = " " if role is None else role, " " if text is None else text
    key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
    h = zlib.crc32(key.encode()) % 20
    if h == 0:
        return []
    if h == 1:
        text = ""
    if h == 2:
        text = re.sub("[.!?]", "", text)
    if h == 4:
        role = "user"
    return [(turn, role, text)] * (2 if h == 3 else 1)


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else
                   "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, wrong):
    """Best first over all edit sequences (no states are merged)."""
    heap = [(0, "", 0, "", ())]
    while heap:
        cost, audit, i, initials, result = heapq.heappop(heap)
        if i == len(rows) and FORM.fullmatch(initials):
            return cost, audit, result
        more = []
        if not audit.endswith("III"):
            more += [(5, "I", i, role[0], ((role, ""),)) for role in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            more.append((2, "D", i + 1, "", ()))
            if wrong[i] not in ("blank", "duplicate"):
                extra = 5 if wrong[i] else 0
                more.append((extra, "K", i + 1, role[:1] or "?", ((role, text),)))
                more += [(1 + extra, "R", i + 1, r[0], ((r, text),)) for r in ("user", "assistant")]
        for c, letter, j, initial, kept in more:
            if BEGUN.fullmatch(initials + initial):
                heapq.heappush(heap, (cost + c, audit + letter, j, initials + initial, result + kept))


def twin(table):
    """The whole result by plain Python."""
    out = {}
    for conv in {r[0] for r in table}:
        rows = sorted((r for r in table if r[0] == conv), key=lambda r: (
            r[1] is not None, r[1] or 0, " " if r[2] is None else r[2], " " if r[3] is None else r[3]))
        rows = [x for r in rows for x in damaged(*r)]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        wrong = faults(rows)
        cost, audit, result = cheapest(rows, wrong)
        turns = [t for t, _, _ in rows if t is not None]
        initials = [role[:1] for _, role, _ in rows]
        digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in result).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, wrong.count("blank"),
                     wrong.count("duplicate"), wrong.count("truncated"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, digest)
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    found = {r[0]: r[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def report(spark, table):
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    return got(repair.report(repair.edits(repair.damage(df))))


def test_query_equals_a_plain_search(spark, sf_small):
    table = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert got(queries.op12_conversation_repair(spark, sf_small)) == twin(table)


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_conversations_equal_a_plain_search(spark, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "unicorn"]
    texts = ["One.", "Two!", "three", "", " \t\n", None, "Ünder the moon?", "A.\n", "four\x0b"]
    table = [(rng.choice([None, *range(40)]), rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice(roles), rng.choice(texts))
             for _ in range(150)]
    assert report(spark, table) == twin(table)


def test_conversations_without_rows_and_empty_tables(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert report(spark, [(gone, 0, "user", "Hello.")]) == {gone: nothing}
    assert report(spark, []) == {}


def run(rows):
    search, out, most = repair.Search(), [], 0
    for row in rows:
        out += search.feed(*row)
        most = max(most, search.unresolved())
    out += search.finish()
    return search.cost, "".join(letter for letter, _, _ in out), most


def test_ties_are_decided_by_whole_sequences():
    rng = random.Random(0)
    for _ in range(300):
        rows = [(None, rng.choice("suax"), None) for _ in range(rng.randrange(7))]
        wrong = [rng.choice([None, None, "blank", "truncated"]) for _ in rows]
        cost, audit, _ = run([(role, w == "blank", w == "truncated", i) for i, ((_, role, _), w) in enumerate(zip(rows, wrong))])
        want = cheapest([(t, role, "") for t, role, _ in rows], wrong)
        assert (cost, audit) == want[:2]


def test_a_long_conversation_stays_bounded():
    rows = [("ua"[i % 2], False, False, i) for i in range(50_000)]
    cost, audit, most = run(rows)
    assert (cost, audit) == (0, "K" * 50_000) and most <= 16
    rng = random.Random(3)
    rows = [(rng.choice("uuaas"), rng.random() < 0.1, rng.random() < 0.2, i) for i in range(20_000)]
    _, audit, most = run(rows)
    assert len(audit.replace("I", "")) == 20_000 and most < 400


def test_edits_are_those_that_the_report_counts(spark):
    table = [(1, 0, "assistant", "Hi."), (1, 1, "assistant", "There."), (2, 0, "system", "Be kind.")]
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").withColumnsRenamed({})
    df = df.selectExpr("*", "1 as step", "2 as edit", "3 as fault")  # clashing names
    script = [tuple(r) for r in repair.edits(df).orderBy("conv_id", "step").collect()]
    assert script == [(1, 0, "R", 0, "user", "Hi.", "assistant", None), (1, 1, "K", 1, "assistant", "There.", "assistant", None),
                      (2, 0, "D", 0, None, None, "system", None)]

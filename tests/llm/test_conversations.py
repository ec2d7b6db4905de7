import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from nearfield.llm import conversation_repair as cr

GAPS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = {"u": "user", "a": "assistant"}


def edits(tokens, most_inserts):
    """Every sequence of edits of ``(initial, fault)`` rows: cost, audit, initials, marks."""

    def go(i, inserts, cost, audit, shape, marks):
        if i == len(tokens):
            yield cost, audit, shape, marks
        else:
            initial, fault = tokens[i]
            yield from go(i + 1, inserts, cost + 3, audit + "D", shape, marks + "-")
            if fault != "2":
                extra = fault == "1"
                yield from go(i + 1, inserts, cost + extra, audit + "K", shape + initial, marks + "=")
                for r in "ua":
                    yield from go(i + 1, inserts, cost + 2 + extra, audit + "R", shape + r, marks + r)
        if inserts < most_inserts:
            for r in "ua":
                yield from go(i, inserts + 1, cost + 2, audit + "I", shape + r, marks + r.upper())

    yield from go(0, 0, 0, "", "", "")


def cheapest(tokens, most_inserts):
    found = edits(tokens, most_inserts)
    cost, audit, _, marks = min(x for x in found if re.fullmatch("(s?(ua)+)?", x[2]))
    return cost, audit, marks


def test_parser_equals_every_sequence_of_edits():
    machine = cr.Repair()
    for n in range(4):
        for tokens in itertools.product(itertools.product("sua ", "012"), repeat=n):
            got = machine.whole("".join(a for a, _ in tokens), "".join(b for _, b in tokens))
            assert got == cheapest(tokens, n + 1 if n < 3 else 2), tokens


def best(tokens):
    """The same by states of the expression: start, s, u, a."""
    go = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def put(front, state, value):
        if state is not None and (state not in front or value < front[state]):
            front[state] = value

    def inserted(front):
        for _ in range(4):
            for state, (cost, audit, marks) in list(front.items()):
                for r in "ua":
                    put(front, go.get((state, r)), (cost + 2, audit + "I", marks + r.upper()))
        return front

    front = {0: (0, "", "")}
    for initial, fault in tokens:
        new = {}
        for state, (cost, audit, marks) in inserted(front).items():
            put(new, state, (cost + 3, audit + "D", marks + "-"))
            if fault != "2":
                cost += fault == "1"
                put(new, go.get((state, initial)), (cost, audit + "K", marks + "="))
                for r in "ua":
                    put(new, go.get((state, r)), (cost + 2, audit + "R", marks + r))
        front = new
    return min(v for s, v in inserted(front).items() if s in (0, 3))


@pytest.mark.parametrize("size", [1, 2, 5, 50])
def test_chunks_join_to_the_whole(size):
    rng = random.Random(size)
    machine = cr.Repair()
    for _ in range(60):
        tokens = [(rng.choice("suuaa?"), rng.choice("000012")) for _ in range(rng.randrange(1, 40))]
        fold = cr.Fold(machine)
        for k in range(0, len(tokens), size):
            a, b = ("".join(x) for x in zip(*tokens[k : k + size]))
            fold.add(machine.transfer(a, b, True) + machine.transfer(a, b, False))
        cost, parts = fold.end()
        assert len(parts) == -(-len(tokens) // size)
        assert (cost, "".join(a for a, _ in parts), "".join(m for _, m in parts)) == best(tokens)


def test_other_grammar():
    rules = {"talk": (("turns",),), "turns": ((), ("turns", "u", "a"), ("turns", "u", "t", "a"))}
    machine = cr.Repair(rules, {"u": "user", "a": "assistant", "t": "tool"})
    assert machine.whole("utaua", "00000") == (0, "KKKKK", "=====")
    assert machine.whole("tau", "000") == (4, "IKKKI", "U===A")


def repaired(rows):
    """Of one conversation's ``(turn, role, text)``: the report, and the repaired rows."""

    def place(r):
        same = hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
        return (r[0] is not None, r[0] or 0, r[1].encode(), same)

    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=place)
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(GAPS)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
    code = {"blank": "2", "duplicate": "2", "truncated": "1", None: "0"}
    initials = [r[1][:1] or "\0" for r in rows]
    cost, audit, marks = best(list(zip(initials, map(code.get, faults))))
    out, k = [], 0
    for m in marks:
        if m in "UA":
            out.append((NAMES[m.lower()], ""))
            continue
        if m != "-":
            out.append((rows[k][1] if m == "=" else NAMES[m], rows[k][2]))
        k += 1
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit), out


def check(df):
    """Both outputs of ``repair`` against the plain version."""
    report, rows = cr.repair(df)
    by_conv = {}
    for r in df.collect():
        by_conv.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    want = {c: repaired(x) for c, x in by_conv.items()}
    assert report.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    assert {r.conv_id: tuple(r)[1:] for r in report.collect()} == {c: x[0] for c, x in want.items()}
    got = {}
    for r in sorted(rows.collect(), key=lambda r: (r.part, r.place)):
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {c: x[1] for c, x in want.items() if x[1]}
    lines = {c: "\n".join(f"{a}:{b}" for a, b in x[1]) for c, x in want.items() if x[1]}
    digests = {r.conv_id: r.repaired_sha256 for r in cr.digests(rows).collect()}
    assert digests == {c: hashlib.sha256(x.encode()).hexdigest() for c, x in lines.items()}


def talk(n, seed=1):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?\n", "é…", "long " * 300 + "."]
    roles = ["user", "assistant", "system", "tool", "User", "", None]
    weights = [8, 8, 3, 1, 1, 1, 1]
    rows = []
    for _ in range(n):
        role = rng.choices(roles, weights)[0]
        turn = rng.choice([None, *range(20)])
        text = rng.choice([*texts, None, f"number {rng.randrange(99)}."])
        rows.append((rng.choice([None, *range(30), *[7] * 30]), turn, role, text))
    return rows


@pytest.mark.parametrize("bits", [10, 3, 0])
def test_repair_equals_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(cr, "CHUNK_BITS", bits)
    check(spark.createDataFrame(talk(600), SCHEMA).repartition(5))


def test_repair_of_one_long_conversation(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"{t} text" + rng.choice("..?x")) for t in range(9000)]
    rows += [(2, 0, "system", "Only this.")] * 3
    check(spark.createDataFrame(rows, SCHEMA).repartition(6))


def test_repair_without_rows_and_with_clashing_names(spark):
    df = spark.createDataFrame(talk(40), SCHEMA)
    report, rows = cr.repair(df.limit(0))
    assert report.count() == rows.count() == cr.digests(rows).count() == 0
    renamed = df.selectExpr("conv_id AS place", "turn AS row", "role AS part", "text AS mark", "1 AS conv_id")
    got, _ = cr.repair(renamed, "place", "row", "part", "mark")
    want, _ = cr.repair(df)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def harm(conv_id, turn, role, text):
    names = [" " if x is None else str(x) for x in (conv_id, turn)]
    role, text = (" " if x is None else x for x in (role, text))
    way = zlib.crc32(":".join(names).encode()) % 20
    if way == 1:
        text = ""
    elif way == 2:
        text = re.sub("[.!?]", "", text)
    elif way == 4:
        role = "user"
    return [(turn, role, text)] * (0 if way == 0 else 2 if way == 3 else 1)


def test_query(spark, small, tmp_path):
    given = spark.read.parquet(f"{small}/conversations.parquet")
    odd = spark.createDataFrame([*talk(300), (500, 7, "user", "Alone.")], SCHEMA)
    given.unionByName(odd.withColumn("conv_id", odd.conv_id + 10_000)).write.parquet(f"{tmp_path}/conversations.parquet")
    by_conv = {}
    for r in spark.read.parquet(f"{tmp_path}/conversations.parquet").collect():
        by_conv.setdefault(r.conv_id, []).extend(harm(*r))
    want = Counter()
    for c, rows in by_conv.items():
        report, out = repaired(rows)
        text = "\n".join(f"{a}:{b}" for a, b in out)
        want[c, *report, hashlib.sha256(text.encode()).hexdigest()] += 1
    got = cr.op12_conversation_repair(spark, str(tmp_path))
    assert got.columns[-2:] == ["audit", "repaired_sha256"]
    assert Counter(map(tuple, got.collect())) == want
    assert any(not rows for rows in by_conv.values())

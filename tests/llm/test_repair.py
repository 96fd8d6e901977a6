"""Structure repair against an exhaustive search over edits, and edge cases of the query."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb

from tidewatch.llm import repair
from tidewatch.llm.queries import ORACLES

PATTERN = re.compile(r"(s?(ua)+)?")


def brute(initials, found):
    """Least (cost, audit) over every sequence of edits with up to two inserts at a place."""
    best = None
    choices = []
    for fault in found:
        choices.append("D" if fault in (repair.BLANK, repair.DUPLICATE) else "DKua")
    inserts = ["", "u", "a", "ua", "au", "uu", "aa"]
    for acts in itertools.product(*choices):
        for gaps in itertools.product(inserts, repeat=len(initials) + 1):
            roles, audit, cost = "", "", 0
            for i, gap in enumerate(gaps):
                roles += gap
                audit += "I" * len(gap)
                cost += 3 * len(gap)
                if i < len(acts):
                    act = acts[i]
                    audit += act if act in "DK" else "R"
                    cost += {"D": 4, "K": 0}.get(act, 3) + (3 if act != "D" and found[i] == repair.CUT_OFF else 0)
                    roles += "" if act == "D" else initials[i] if act == "K" else act
                    if act == "K" and initials[i] not in ("s", "u", "a"):
                        break
            else:
                if PATTERN.fullmatch(roles) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def test_cheapest_equals_exhaustive_search():
    rng = random.Random(2)
    kinds = [repair.SOUND, repair.SOUND, repair.CUT_OFF, repair.BLANK, repair.DUPLICATE]
    for length, rounds in ((0, 1), (1, 40), (2, 40), (3, 12)):
        for _ in range(rounds):
            initials = [rng.choice("suat") for _ in range(length)]
            found = [rng.choice(kinds) for _ in range(length)]
            cost, audit = repair.cheapest(initials, found)
            assert (cost, audit) == brute(initials, found)
            rows = [(i, f"{k}") for k, i in enumerate(initials)]
            assert PATTERN.fullmatch("".join(r[:1] for r, _ in repair.repaired(rows, audit)))


def test_equal_costs_take_the_least_audit():
    # A lone assistant row: deleting it costs 4, a user before it 3.
    assert repair.cheapest(["a"], [""]) == (3, "IK")
    # Re-roling and inserting cost the same here; I comes before K and R.
    assert repair.cheapest(["u", "u"], ["", ""])[1] == min("KR", "KR")
    assert repair.cheapest(["u", "a", "u"], [""] * 3) == (3, "KKKI")
    assert repair.cheapest([], []) == (0, "")
    assert repair.cheapest(["s"], [""]) == (4, "D")


def test_a_long_conversation_is_repaired_whole():
    rng = random.Random(4)
    n = 3000
    initials = [rng.choice("ua") for _ in range(n)]
    cost, audit = repair.cheapest(initials, [""] * n)
    rows = [(i, str(k)) for k, i in enumerate(initials)]
    out = "".join(r[:1] for r, _ in repair.repaired(rows, audit))
    assert PATTERN.fullmatch(out) and sum(audit.count(c) for c in "DKR") == n
    assert cost == 4 * audit.count("D") + 3 * audit.count("R") + 3 * audit.count("I")


def plain(rows):
    """The query in plain Python, from its description."""
    convs = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        held = convs.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = set()
    for conv, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, found = set(), []
        for _, role, text in held:
            ink = re.findall(r"[^\x20\x09-\x0D]", text)
            found.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in held]
        turns = {t for t, _, _ in held if t is not None}
        cost, audit = repair.cheapest(initials, found)
        lines = [f"{r}:{t}" for r, t in repair.repaired([(r, t) for _, r, t in held], audit)]
        out.add((
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[found.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return out


def odd_rows():
    rng = random.Random(9)
    roles = ["user", "assistant", "system", "tool", "", None, "usher", "ß"]
    texts = ["Yes.", "No!", "why", " \t\n", "", None, "Same.", "a" * 50_000, "end.\n ", "é"]
    rows = [(c, rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for c in range(-5, 120) for _ in range(rng.randint(1, 9))]
    rows += [(None, t, rng.choice(roles), rng.choice(texts)) for t in (None, 0, 1, 2, 2)]
    rows += rows[:20]
    # Conversations that lose every row.
    return rows + [(c, 0, "user", "x") for c in range(1000, 1100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]


def test_odd_conversations(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, True, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, _c boolean, cost int, repaired string")
    got = [tuple(r) for r in repair.digests(repair.repair(repair.damage(df))).collect()]
    assert len(got) == len(set(got)) == len({r[0] for r in rows}) and set(got) == plain(rows)
    assert any(r[7] == "" and r[8] == hashlib.sha256(b"").hexdigest() for r in got)
    assert repair.repair(repair.damage(df.limit(0))).count() == 0


def test_sql_of_odd_conversations():
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    rows = odd_rows()
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    result = con.execute(ORACLES["op11_repair"])
    names = [d[0] for d in result.description]
    assert names == ["conv_id", *repair.COUNTS, "audit", "repaired_sha256"]
    assert set(result.fetchall()) == plain(rows)


def test_rows_without_damage(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 3, "assistant", "So.")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in repair.repair(df).collect()}
    assert (got[1].audit, got[1].cost) == ("KK", 0)
    assert [(t.role, t.text) for t in got[2].repaired] == [("user", ""), ("assistant", "So.")]

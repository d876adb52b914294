import hashlib
import itertools
import random
import zlib

import pytest

from ledgerlens.llm import queries, repair

COLUMNS = "conv_id long, turn long, role string, text string"
NAMES = {"u": "user", "a": "assistant"}
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}  # what may be inserted or renamed to, by the last initial
BLANKS = " \t\n\x0b\x0c\r"


def told_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        end = text.rstrip(BLANKS)
        if not end:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if end[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def brute(rows):
    """Forward search over (last initial): the cheapest edits, then the least string, of rows (turn, role, text) in order."""
    found = {"": (0, "", ())}

    def inserts(states):
        out = {}
        for last, (cost, audit, lines) in states.items():
            for n in range(3):
                kept = out.get(last)
                if kept is None or (cost, audit) < kept[:2]:
                    out[last] = (cost, audit, lines)
                last = NEXT[last]
                cost, audit, lines = cost + 3, audit + "I", (*lines, NAMES[last] + ":")
        return out

    found = inserts(found)
    for (_, role, text), fault in zip(rows, told_faults(rows)):
        after = {}

        def put(last, cost, audit, lines):
            if last not in after or (cost, audit) < after[last][:2]:
                after[last] = (cost, audit, lines)

        for last, (cost, audit, lines) in found.items():
            put(last, cost + 4, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault else 0
            initial = role[:1]
            if initial and last + initial in ("s", "u", "su", "ua", "au"):
                put(initial, cost + extra, audit + "K", (*lines, f"{role}:{text}"))
            renamed = NEXT[last]
            put(renamed, cost + extra + 3, audit + "R", (*lines, f"{NAMES[renamed]}:{text}"))
        found = inserts(after)
    return min(v for k, v in found.items() if k in ("", "a"))


def expected(conversation):
    """Figures of one conversation's rows (turn, role, text) after damage."""
    rows = sorted(conversation, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults = told_faults(rows)
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, lines = brute(rows)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        blank = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def check(found, rows):
    by = {}
    for conv, *rest in rows:
        by.setdefault(conv, []).append(tuple(rest))
    for row in found:
        assert tuple(row)[1:] == expected(by.get(row[0], [])), row[0]


ROLES = ["user", "assistant", "system", "tool", "", "user", "assistant"]
TEXTS = ["Yes.", "No!", "cut", " ", "", "Why? \n", "é."]


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    return [
        (conv, rng.choice([None, *range(20)]), rng.choice(ROLES), rng.choice([*TEXTS, f"w{rng.random()}.", f"w{rng.random()}"]))
        for conv in range(convs)
        for _ in range(rng.randrange(1, longest))
    ]


@pytest.mark.parametrize("chunk", [1, 3, 256])
def test_repair_matches_a_plain_search(spark, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    rows = random_rows(chunk, 40, 14)
    df = spark.createDataFrame(rows, COLUMNS.replace("conv_id", "conv")).repartition(3)
    check(repair.digest(df.select("conv"), df).collect(), rows)


def test_query_with_damage_nulls_and_extra_columns(spark, tmp_path):
    rows = [r for r in random_rows(9, 60, 9)] + [(None, 3, None, None), (None, None, "user", "a."), (77, None, None, "b.")]
    rows += [(500, 1, "user", "Same."), (500, 1, "user", "Same.")]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], f"{COLUMNS}, place int, conv string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op11_repair(spark, str(tmp_path)).collect()
    assert {r.conv_id for r in found} == {r[0] for r in rows} and len(found) == len({r[0] for r in rows})
    check(found, damaged(rows))


def test_one_conversation_of_thousands_of_rows(spark, monkeypatch):
    """Rows that no vector converges on (all deleted), then alternating ones, over many chunks."""
    monkeypatch.setattr(repair, "CHUNK", 16)
    rows = [(1, i, "user", f"cut {i}") for i in range(600)] + [(1, 600 + i, ("user", "assistant")[i % 2], f"{i}.") for i in range(601)]
    rows += [(1, 2000 + i, "user", "again.") for i in range(500)] + [(2, 0, "system", "x.")]
    df = spark.createDataFrame(rows, COLUMNS.replace("conv_id", "conv"))
    check(repair.digest(df.select("conv"), df).collect(), rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], COLUMNS.replace("conv_id", "conv"))
    assert repair.digest(df.select("conv"), df).collect() == []


def test_edits_are_the_least_of_all_cheapest_strings():
    """Every string of edits with at most two inserts in a row, for all short conversations."""
    for n in range(1, 4):
        for codes in itertools.product("dsuaoSA", repeat=n):
            best = None
            gaps = itertools.product(("", "I", "II"), repeat=n + 1)
            for between, kept in itertools.product(gaps, itertools.product("DKR", repeat=n)):
                state, cost, legal = 0, 0, True
                for i, inserted in enumerate(between):
                    for _ in inserted:
                        state, cost = repair.EXPECTED[state], cost + 3
                    if i == n:
                        break
                    code, extra = codes[i], 3 if codes[i].isupper() else 0
                    if kept[i] == "D":
                        cost += 4
                    elif code == "d" or (kept[i] == "K" and state not in repair.KEPT[code.lower()]):
                        legal = False
                        break
                    else:
                        cost += extra + (3 if kept[i] == "R" else 0)
                        state = repair.EXPECTED[state] if kept[i] == "R" else repair.KEPT[code.lower()][state]
                audit = "".join(a + b for a, b in zip(between, [*kept, ""]))
                if legal and state in (0, 3) and (best is None or (cost, audit) < best):
                    best = cost, audit
            edits, state = repair.trace("".join(codes), 0, 0)
            told = ("".join(edits) + repair._tail(state)).translate(str.maketrans("uaUA", "IIRR"))
            assert told == best[1], codes

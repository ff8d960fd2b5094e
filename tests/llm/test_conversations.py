"""Conversation repair against an enumeration of all edits, and the bounds of its open stretch."""

import hashlib
import random
import time
import zlib

from murmura.llm import conversations as conv

SCHEMA = "conv_id long, turn long, role string, text string, fault string, present boolean, copy int, Edit string"
_SOLID = set(" \t\n\x0b\x0c\r")


def turns(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "clash", False, 5, "clash") for r in rows], SCHEMA).repartition(parts)


def body(text):
    return "".join(" " if c in _SOLID else c for c in text).rstrip(" ")


def damaged(rows):
    """The rows of each conversation after the damage, in order."""
    out = {}
    for c, turn, role, text in rows:
        kept = out.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate({ord(x): None for x in ".!?"}) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faulty(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, out = set(), []
    for turn, role, text in rows:
        fault = (
            "blank" if not body(text) else "duplicate" if (role, text) in seen
            else "truncated" if body(text)[-1] not in ".!?" else None
        )
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def legal(initials):
    rest = initials[1:] if initials.startswith("s") else initials
    return initials == "" or (len(rest) >= 2 and rest == "ua" * (len(rest) // 2))


def prefix(initials):
    rest = initials[1:] if initials.startswith("s") else initials
    return rest == ("ua" * len(rest))[: len(rest)]


def enumerated(rows):
    """Cheapest (cost, audit, turns written) among all edits of cost 2 * len(rows) at most: deleting all costs that."""
    most, best = 2 * len(rows), None

    def go(i, cost, audit, made):
        nonlocal best
        initials = "".join(r[:1] or "?" for r, _ in made)
        if cost > most or not prefix(initials):
            return
        if i == len(rows) and legal(initials) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, made)
        for role in ("user", "assistant"):
            go(i, cost + 5, audit + "I", [*made, (role, "")])
        if i < len(rows):
            _, role, text, fault = rows[i]
            go(i + 1, cost + 2, audit + "D", made)
            if fault not in ("blank", "duplicate"):
                cost += 5 if fault else 0
                go(i + 1, cost, audit + "K", [*made, (role, text)])
                for new in ("user", "assistant"):
                    go(i + 1, cost + 1, audit + "R", [*made, (new, text)])

    go(0, 0, "", [])
    return best


def plain(rows):
    """The best path of every state, whole: nothing is emitted early, ranked or dropped."""
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    roles = {"u": "user", "a": "assistant"}

    def relax(best, state, entry):
        if state not in best or entry[:2] < best[state][:2]:
            best[state] = entry

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, made) in list(best.items()):
                for r in roles:
                    if (state, r) in steps:
                        relax(best, steps[state, r], (cost + 5, audit + "I", (made, (roles[r], ""))))
        return best

    best = inserted({"": (0, "", None)})
    for _, role, text, fault in rows:
        new = {}
        for state, (cost, audit, made) in best.items():
            relax(new, state, (cost + 2, audit + "D", made))
            if fault not in ("blank", "duplicate"):
                cost += 5 if fault else 0
                if (state, role[:1]) in steps:
                    relax(new, steps[state, role[:1]], (cost, audit + "K", (made, (role, text))))
                for r in roles:
                    if (state, r) in steps:
                        relax(new, steps[state, r], (cost + 1, audit + "R", (made, (roles[r], text))))
        best = inserted(new)
    cost, audit, made = min(best[s] for s in ("", "a") if s in best)
    out = []
    while made:
        made, last = made
        out.append(last)
    return cost, audit, out[::-1]


def run(rows):
    """The operator's search: cost, audit, turns written, and the longest open stretch."""
    search, edits, widest = conv.Repair(), [], 0
    for row in rows:
        initial = row[1][:1]
        edits += search.push(row, initial if initial and initial in "sua" else "", row[3])
        widest = max(widest, search.open)
    edits += search.finish()
    made = [(role or row[1], row[2] if row else "") for edit, role, row in edits if edit != "D"]
    return search.cost, "".join(e for e, _, _ in edits), made, widest


def invented(rng, n):
    kinds = [None, None, None, "blank", "duplicate", "truncated"]
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", "ursula"]
    return [(i, rng.choice(roles), f"t{i}.", rng.choice(kinds)) for i in range(n)]


def test_cheapest_and_least_among_all_edits():
    rng = random.Random(11)
    for _ in range(400):
        rows = invented(rng, rng.randrange(6))
        assert run(rows)[:3] == enumerated(rows), rows


def test_longer_conversations_against_whole_paths():
    rng = random.Random(12)
    for _ in range(150):
        rows = invented(rng, rng.randrange(120))
        assert run(rows)[:3] == plain(rows)
    for roles in (["user"] * 61, ["assistant"] * 60, ["user", "user", "assistant"] * 20, ["system"] * 40):
        for fault in (None, "truncated"):
            rows = [(i, r, f"t{i}.", fault) for i, r in enumerate(roles)]
            assert run(rows)[:3] == plain(rows)


def test_open_stretch_stays_short():
    rng = random.Random(13)
    sound = [(i, ("user", "assistant")[i % 2], f"t{i}.", None) for i in range(20_000)]
    assert run(sound)[3] <= 12
    broken = [(*r[:3], rng.choice([None] * 12 + ["blank", "duplicate", "truncated"])) for r in sound if rng.random() > 0.03]
    assert run(broken)[3] <= 120


def test_ties_stay_cheap_where_nothing_coalesces():
    """Only user turns: whether the first one goes depends on the last, so the whole conversation stays open."""
    rows = [(i, "user", f"t{i}.", None) for i in range(40_001)]
    start = time.time()
    cost, audit, made, widest = run(rows)
    assert (cost, audit) == (20_002, "D" + "KR" * 20_000) and widest > 40_000 and time.time() - start < 30


CASES = (
    [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Hello!"), (1, 2, "assistant", "Hello!")]
    + [(2, None, "user", "no turn."), (2, None, "user", "no turn."), (2, 3, None, "no role."), (2, 7, "user", None)]
    + [(None, 1, "user", "null id."), (None, 2, "assistant", "null id too."), (None, None, None, None)]
    + [(3, i, "user", "") for i in range(9)]
    + [(4, i, ("user", "assistant")[i % 2], f"long {'x' * 100_000} {i}.") for i in range(30)]
    + [(5, i * i, "tool", "cut off  \n") for i in range(12)]
    + [(c, t, ("system", "user", "assistant")[(t + c) % 3], f"text {t % 5}{'.?! ,'[t % 5]}") for c in range(6, 40) for t in range(c % 9)]
    + [(50, 5, "user", "same turn b."), (50, 5, "user", "same turn a."), (50, 5, "assistant", "same turn a.")]
)


def expected(rows):
    out = []
    for c, kept in damaged(rows).items():
        own = faulty(kept)
        cost, audit, made = plain(own)
        found = sorted({r[0] for r in own if r[0] is not None})
        initials = [r[1][:1] for r in own]
        out.append((
            c, found[-1] - found[0] + 1 - len(found) if found else 0,
            *[sum(r[3] == f for r in own) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def test_report_of_every_odd_case(spark):
    rows = conv.report(conv.damage(turns(spark, CASES)), mark="present")
    assert sorted(map(tuple, rows.collect()), key=str) == expected(CASES)


def test_edits_carry_the_repaired_turns(spark):
    table = turns(spark, CASES)
    edits = conv.repair(table).collect()
    by_conv = {}
    for e in edits:
        by_conv.setdefault(e["conv_id"], []).append(e)
    undamaged = {}
    for c, t, r, x in CASES:
        undamaged.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    for c, kept in undamaged.items():
        own = sorted(by_conv[c], key=lambda e: e["place"])
        _, audit, made = plain(faulty(kept))
        assert "".join(e["edit"] for e in own) == audit
        assert [(e["role"], e["text"]) for e in own if e["edit"] != "D"] == made


def test_no_rows(spark):
    table = turns(spark, [])
    assert conv.report(conv.damage(table), mark="present").collect() == [] and conv.repair(table).collect() == []


def test_one_shuffle(spark):
    plan = conv.report(turns(spark, CASES))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(conv_id") == 1 and plan.count("Exchange hash") == 1

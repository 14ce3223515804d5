"""Conversation repair against an exhaustive search, and its awkward cases."""

import hashlib
import itertools
import random
import re
import zlib

from benchtrail.llm import conversation_repair as C

GAPS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, at long, run string, word string, fault string"


def exhaustive(word):
    """Least (cost, audit) over all edit sequences with at most two insertions in each gap."""
    rows = [(word[i], word[i + 1]) for i in range(0, len(word), 2)]
    best = None
    per_row = []
    for role, fault in rows:
        options = [("", "D", 2)]
        if fault != "d":
            extra = 5 if fault == "t" else 0
            options += [(role, "K", extra), ("u", "R", 1 + extra), ("a", "R", 1 + extra)]
        per_row.append(options)
    gap = [("", "", 0), *[(r, "I", 5) for r in "ua"], ("ua", "II", 10), ("au", "II", 10)]
    spots = [gap]
    for options in per_row:
        spots += [options, gap]
    for choice in itertools.product(*spots):
        if re.fullmatch("(s?(ua)+)?", "".join(c[0] for c in choice)):
            value = sum(c[2] for c in choice), "".join(c[1] for c in choice)
            best = value if best is None or value < best else best
    return best


def test_cells_equal_an_exhaustive_search():
    r = random.Random(5)
    letters = [a + b for a in "suao" for b in "ctd"]
    words = ["", *letters, *(a + b for a in letters for b in letters)] + ["".join(r.choices(letters, k=3)) for _ in range(60)]
    for word in words:
        assert C.cheapest(C.parse(word)) == exhaustive(word), word


def test_any_split_gives_the_same_cell():
    r = random.Random(6)
    for _ in range(30):
        parts = ["".join(r.choice("suao") + r.choice("cctd") for _ in range(r.randint(1, 30))) for _ in range(3)]
        whole = C.parse("".join(parts))
        assert whole == C.joined(C.parse(parts[0]), C.joined(C.parse(parts[1]), C.parse(parts[2])))
        assert C.unpack(C.pack(whole)) == whole


def brute(rows):
    """What the contract asks for, from (turn, role, text) of one conversation in order."""
    turns = [t for t, _, _ in rows if t is not None]
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.rstrip(GAPS)
        faults.append("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "c")
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    best = {0: (0, "", [])}

    def insert(states):
        for p, initial, q in [(0, "u", 2), (1, "u", 2), (3, "u", 2), (2, "a", 3), (3, "u", 2)]:
            if p in states:
                c, a, out = states[p]
                new = c + 5, a + "I", out + [f"{'user' if initial == 'u' else 'assistant'}:"]
                states[q] = min(states.get(q, new), new)
        return states

    insert(best)
    for (_, role, text), fault in zip(rows, faults):
        after = {p: (c + 2, a + "D", out) for p, (c, a, out) in best.items()}
        if fault in "tc":
            extra = 5 * (fault == "t")
            for p, (c, a, out) in best.items():
                options = [("K", 0, role, role[:1]), ("R", 1, "user", "u"), ("R", 1, "assistant", "a")]
                for edit, cost, to, initial in options:
                    q = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((p, initial))
                    if q is not None:
                        new = c + cost + extra, a + edit, out + [f"{to}:{text}"]
                        after[q] = min(after.get(q, new), new)
        best = insert(after)
    cost, audit, out = min(v for p, v in best.items() if p in (0, 3))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()), out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def conversations(seed=3, n=60):
    r = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(r.randint(0, 9)):
            role = r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = r.choice(["Fine.", "No end", " ", None, "", "Déjà vu?", f"text {turn}!", "same text. "])
            rows += [(conv, r.choice([turn, turn, None, 2]), role, text)] * r.choice([1, 1, 1, 2])
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], SCHEMA)


def expected(rows):
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {conv: brute(in_order(rs)) for conv, rs in by_conv.items()}


def answer(r):
    return r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256


def test_report_and_repaired_rows_match_brute_force(spark, monkeypatch):
    rows = conversations()
    long = [(1000, t, ["user", "assistant", "system"][t % 7 % 3], f"turn {t}" + ".!? x"[t % 5]) for t in range(300)]
    rows += long
    monkeypatch.setattr(C, "SPAN", 4)  # the long conversation takes several rounds of joining
    df = table(spark, rows)
    want = expected(rows)
    got = {r.conv_id: answer(r) for r in C.report(df, df).collect()}
    assert got == {conv: w for conv, (w, _) in want.items()}
    repaired = {}
    for r in C.repair(df).orderBy("key", "n").collect():
        assert r.n == len(repaired.setdefault(r.key, []))
        repaired[r.key].append(f"{r.role}:{r.text}")
    assert repaired == {"n" if conv is None else f"v{conv}": out for conv, (_, out) in want.items() if out}
    assert not any(re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in out)) is None for out in repaired.values())


def test_damage(spark):
    rows = [(c, t, "assistant", f"One. Two! {t}?") for c in range(40) for t in range(5)] + [(None, None, None, None), (3, None, "user", "a.b")]
    want = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate:
            text = "" if fate == 1 else " " if text is None else text
            row = (conv, turn, "user" if fate == 4 else " " if role is None else role, re.sub("[.!?]", "", text) if fate == 2 else text)
            want += [row] * (2 if fate == 3 else 1)
    assert sorted(map(tuple, C.damaged(table(spark, rows)).collect()), key=repr) == sorted(want, key=repr)


def test_conversations_without_rows_and_empty_tables(spark):
    none = table(spark, [])
    assert C.report(none, none).count() == 0 and C.repair(none).count() == 0
    gone = C.report(table(spark, [(1, 0, "user", "x"), (None, 1, None, None)]), none).collect()
    assert {r.conv_id for r in gone} == {1, None} and {answer(r) for r in gone} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_very_long_text_and_a_turn_said_by_many(spark):
    rows = [(1, 0, "user", "w " * 400_000 + "."), (1, 1, "assistant", "ok.")] + [(2, t % 2, "user", "hello there.") for t in range(500)]
    df = table(spark, rows)
    want = expected(rows)
    assert {r.conv_id: answer(r) for r in C.report(df, df).collect()} == {conv: w for conv, (w, _) in want.items()}

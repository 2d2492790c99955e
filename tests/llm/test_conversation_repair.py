import hashlib
import random
import re
import zlib

import pytest

from strata.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, fault string, live int, copy string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 3, "clash") for r in rows], SCHEMA)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]", text)


def spoilt(rows):
    """Rows after the planted damage, as the contract words it."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(key.encode()) % 20
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return out


def brute(convs, rows):
    """Every audit of a conversation is tried."""
    out = {}
    for conv in convs:
        own = sorted([r for r in rows if r[0] == conv],
                     key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        faults, seen = [], set()
        for _, _, role, text in own:
            kind = ("blank" if not words_of(text) else "duplicate" if (role, text) in seen
                    else "truncated" if words_of(text)[-1] not in ".!?" else None)
            seen.add((role, text))
            faults.append(kind)
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        found = []

        def go(i, shape, cost, audit, said, inserted):
            if cost > 4 * len(own):
                return
            if i == len(own) and re.fullmatch("(s?(ua)+)?", shape):
                found.append((cost, audit, "\n".join(said)))
            if not re.fullmatch("s?(ua)*u?", shape):
                return
            if inserted < 2:
                for role in ("user", "assistant"):
                    go(i, shape + role[0], cost + 3, audit + "I", said + [role + ":"], inserted + 1)
            if i < len(own):
                _, _, role, text = own[i]
                go(i + 1, shape, cost + 4, audit + "D", said, 0)
                if faults[i] not in ("blank", "duplicate"):
                    more = 3 if faults[i] else 0
                    if role[:1]:
                        go(i + 1, shape + role[0], cost + more, audit + "K", said + [role + ":" + text], 0)
                    for to in ("user", "assistant"):
                        go(i + 1, shape + to[0], cost + 3 + more, audit + "R", said + [to + ":" + text], 0)

        go(0, "", 0, "", [], 0)
        cost, audit, text = min(found)
        out[conv] = (conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal,
                     cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def random_rows(rng, convs, longest=6):
    rows = []
    for c in convs:
        for t in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([t, t, t, None, t + 3]), rng.choice(["user", "assistant", "user", "system", "tool", None, ""]),
                         rng.choice(["Hi there.", "So?", "cut", "é! ", " \n", "", None, "dot. ", "Yes!"])))
    return rows


def test_damaged_rows_equal_brute_force(spark):
    rng = random.Random(8)
    convs = [None, -4, *range(60)]
    rows = random_rows(rng, convs, 5) + [(3, 1, "user", "Hi there."), (3, 1, "user", "Hi there.")]
    rng.shuffle(rows)
    got = {r["conv_id"]: tuple(r) for r in cr.audits(cr.faulted(cr.damaged(frame(spark, rows)))).collect()}
    assert got == brute(convs, spoilt(rows))


def test_a_conversation_that_loses_all_rows_stays(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = cr.audits(cr.faulted(cr.damaged(frame(spark, [(gone, 0, "user", "Hi.")])))).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_no_rows_and_extreme_turns(spark):
    assert cr.repair(frame(spark, [])).collect() == []
    rows = [(1, -(1 << 63), "user", "A."), (1, (1 << 63) - 1, "assistant", "B.")]
    assert cr.repair(frame(spark, rows)).first()["gaps"] == (1 << 63) - 1


@pytest.mark.parametrize("modulus", [cr._MOD, 7])
def test_ties_survive_settling_and_colliding_hashes(monkeypatch, modulus):
    """Long conversations against a DP that keeps whole strings; with 7 hash values nearly all collide."""
    monkeypatch.setattr(cr, "_MOD", modulus)
    rng = random.Random(4)
    for settle in (3, 50, 4096):
        monkeypatch.setattr(cr, "SETTLE", settle)
        for _ in range(30):
            rows = [(rng.choice("uuaast"), rng.random() < .15, rng.random() < .3) for _ in range(rng.randint(0, 90))]
            run = cr.Repair()
            best = [(0, "", ""), None, None, None]

            def insert(best):
                for to, froms in ((1 + 1, (0, 1, 3)), (3, (2,))):
                    more = [(best[s][0] + 3, best[s][1] + "I", best[s][2] + "ua"[to - 2]) for s in froms if best[s]]
                    best[to] = min(more + ([best[to]] if best[to] else []), default=None)

            insert(best)
            for i, (initial, gone, cut) in enumerate(rows):
                run.row(initial, initial.encode(), b"t", gone, cut)
                new = [[], [], [], []]
                for s in range(4):
                    if best[s]:
                        c, a, r = best[s]
                        new[s].append((c + 4, a + "D", r))
                        if not gone:
                            c += 3 if cut else 0
                            to = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[s].get(initial)
                            if to:
                                new[to].append((c, a + "K", r + initial))
                            to = 3 if s == 2 else 2
                            new[to].append((c + 3, a + "R", r + "ua"[to - 2]))
                best = [min(n, default=None) for n in new]
                insert(best)
            want = min(b for b in (best[0], best[3]) if b)
            assert run.result()[:2] == want[:2]


def test_less_is_string_order():
    rng = random.Random(2)
    nodes = [cr.Node()]
    for _ in range(400):
        nodes.append(cr.Node(rng.choice("DIKR"), rng.choice(nodes[-30:])))
    for _ in range(3000):
        x, y = rng.choice(nodes), rng.choice(nodes)
        assert cr.less(x, y) == (cr.edits(x) < cr.edits(y))


def test_repaired_turns_hash_to_the_digest(spark):
    rng = random.Random(12)
    rows = random_rows(rng, range(40), 9)
    dealt = cr.faulted(cr.damaged(frame(spark, rows)))
    found = cr.audits(dealt)
    said = {}
    for r in sorted(cr.repaired_turns(dealt, found).collect(), key=lambda r: (r["conv_id"], r["position"])):
        said.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for r in found.collect():
        text = "\n".join(said.get(r["conv_id"], []))
        assert hashlib.sha256(text.encode()).hexdigest() == r["repaired_sha256"]

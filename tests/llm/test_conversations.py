import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lendlens.llm import conversations as cv
from lendlens.llm.conversations import Repair, Rows, Nodes, edits, matrix, moves_of, op11_conversation_repair, solve

from ..conftest import SF_SMALL

ROLES = {"s": "system", "u": "user", "a": "assistant"}


def outcome(rows, audit):
    """Repaired (role, text) lines and cost of an audit; None if it is not allowed."""
    lines, cost, rows = [], 0, list(rows)
    roles = []
    for e in audit:
        if e == "I":
            roles.append(("?", None, ""))
            cost += 3
            continue
        role, text, fault = rows.pop(0)
        if e == "D":
            cost += 4
            continue
        if fault == 2:
            return None
        cost += 3 * (e == "R") + 3 * (fault == 1)
        roles.append(("?" if e == "R" else role[:1], role if e == "K" else None, text))
    if rows:
        return None
    want = re.compile("(s?(ua)+)?")
    free = [k for k, r in enumerate(roles) if r[0] == "?"]
    for chosen in itertools.product("ua", repeat=len(free)):
        initials = [r[0] for r in roles]
        for k, c in zip(free, chosen):
            initials[k] = c
        if all(len(x) == 1 for x in initials) and want.fullmatch("".join(initials)):
            for (_, own, text), i in zip(roles, initials):
                lines.append(f"{own if own is not None else ROLES[i]}:{text}")
            return cost, lines
    return None


def enumerated(rows):
    """The cheapest and then least audit, by trying all (two insertions a place)."""
    blocks = [["I" * k + e for k in range(3) for e in "DKR"] for _ in rows] + [["", "I", "II"]]
    best = None
    for parts in itertools.product(*blocks):
        audit = "".join(parts)
        made = outcome(rows, audit)
        if made and (best is None or (made[0], audit) < best[:2]):
            best = (made[0], audit, made[1])
    return best


def dynamic(rows):
    """The same by one pass over the rows that keeps whole audits."""
    now = {0: (0, "")}
    after = {("K", 0, "s"): 1, ("K", 0, "u"): 2, ("K", 1, "u"): 2, ("K", 3, "u"): 2, ("K", 2, "a"): 3}
    step = {0: 2, 1: 2, 2: 3, 3: 2}

    def grown(states):
        out = dict(states)
        for _ in range(2):
            for q, (c, a) in list(out.items()):
                new = (c + 3, a + "I")
                out[step[q]] = min(out.get(step[q], new), new)
        return out
    for role, _, fault in rows:
        new = {}
        for q, (c, a) in grown(now).items():
            ways = [(q, c + 4, a + "D")]
            if fault < 2:
                ways.append((step[q], c + 3 + 3 * fault, a + "R"))
                if ("K", q, role[:1]) in after:
                    ways.append((after["K", q, role[:1]], c + 3 * fault, a + "K"))
            for to, cost, audit in ways:
                new[to] = min(new.get(to, (cost, audit)), (cost, audit))
        now = new
    cost, audit = min(v for q, v in grown(now).items() if q in (0, 3))
    state, lines, rest = 0, [], list(rows)
    names = {2: "user", 3: "assistant"}
    for e in audit:
        role, text, _ = ("", "", 0) if e == "I" else rest.pop(0)
        if e in "IR":
            state = step[state]
            lines.append(f"{names[state]}:{text}")
        elif e == "K":
            state = after["K", state, role[:1]]
            lines.append(f"{role}:{text}")
    return cost, audit, lines


def code(role, fault):
    return max(" sua".find(role[:1]) if role[:1] else 0, 0) + 4 * fault


ROW = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", " ", ""]), st.sampled_from(["x.", "y", ""]),
                st.integers(0, 2))


@settings(max_examples=60, deadline=None)
@given(st.lists(ROW, max_size=3))
def test_against_enumeration(rows):
    best = enumerated(rows)
    assert dynamic(rows) == best
    labels, state = edits(bytes(code(r, f) for r, _, f in rows))
    assert "".join(labels) + cv.LAST[state] == best[1]


@settings(max_examples=300, deadline=None)
@given(st.lists(ROW, max_size=60))
def test_against_dynamic_program(rows):
    labels, state = edits(bytes(code(r, f) for r, _, f in rows))
    assert "".join(labels) + cv.LAST[state] == dynamic(rows)[1]


@settings(max_examples=150, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=40), st.integers(1, 5))
def test_segments_meet_as_one(rows, size):
    codes = bytes(code(r, f) for r, _, f in rows)
    parts = [codes[k : k + size] for k in range(0, len(codes), size)]
    nodes = Nodes([moves_of(*matrix(Rows(p))) for p in parts])
    ways = list(solve(nodes, 0, len(nodes), 0, cv.ENDS))
    out = ""
    for k, (p, (start, _, to)) in enumerate(zip(parts, ways)):
        labels, state = edits(p, start, cv.ENDS if k == len(parts) - 1 else cv.only(to))
        out += "".join(labels)
    assert out + cv.LAST[state] == dynamic(rows)[1]


def brute(rows):
    """The query's result for (conv_id, turn, role, text) rows, by plain Python."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        seen, faulty, blank, dup, cut = set(), [], 0, 0, 0
        for turn, role, text in own:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = 0
            if not solid:
                blank, fault = blank + 1, 2
            elif (role, text) in seen:
                dup, fault = dup + 1, 2
            elif solid[-1] not in ".!?":
                cut, fault = cut + 1, 1
            seen.add((role, text))
            faulty.append((role, text, fault))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = dynamic(faulty)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, blank, dup, cut, illegal, cost, audit, sha)
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute(rows)
    got = op11_conversation_repair(spark, SF_SMALL).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[c] for c in NAMES) == want[r["conv_id"]]


AWKWARD = ([(1, t, ["system", "user", "assistant", None, "tool"][t % 5], f"line {t % 7}." if t % 3 else f"line {t}") for t in range(150)]
           + [(2, None, "user", "no turn."), (2, None, "user", "no turn."), (2, 5, "user", None), (2, 5, None, "x"), (2, 3, "assistant", " \n")]
           + [(None, 1, "user", "null id."), (None, 2, "assistant", "answer!"), (None, None, None, None)]
           + [(3, 1, "user", "same.")] * 40 + [(3, 2, "assistant", "same.")] * 3 + [(4, 2**40, "user", "far."), (4, 1, "us", "é中?\t")]
           + [(5, t, "user" if t % 2 else "assistant", "word " * 50_000 + f"{t}.") for t in range(3)] + [(6, 0, "", "x.")])


def conversations(spark, rows, path):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'own' as conv", "7 as block", "'own' as audit", "1 as digest").write.parquet(str(path / "conversations.parquet"))
    return str(path)


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_awkward_rows(spark, tmp_path, rows):
    got = op11_conversation_repair(spark, conversations(spark, rows, tmp_path)).collect()
    assert {r["conv_id"]: tuple(r[c] for c in NAMES) for r in got} == brute(rows) and len(got) == len(brute(rows))


def test_cut_into_segments(spark):
    """Segments of three rows and nodes of two children give the same."""
    given_ = cv.damaged(spark.createDataFrame(AWKWARD, "conv_id long, turn long, role string, text string"))
    repair = Repair(given_, segment=3, fan=2)
    want = brute(AWKWARD)
    got = {r["conv_id"]: tuple(r[c] for c in NAMES[:7]) for r in repair.report.collect()}
    assert got == {k: v[:7] for k, v in want.items() if k in got} and all(v[6] == "" for k, v in want.items() if k not in got)
    assert {r["conv_id"]: r["repaired_sha256"] for r in repair.digests().collect()} == {k: want[k][7] for k in got}
    lines = defaultdict(list)
    for r in sorted(repair.rows().collect(), key=lambda r: r["place"]):
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
        assert (r["turn"] is None) == (r["edit"] == "I") or r["conv_id"] in (2, None)
    assert {k: hashlib.sha256("\n".join(lines[k]).encode()).hexdigest() for k in got} == {k: want[k][7] for k in got}

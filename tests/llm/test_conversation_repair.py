"""Repair against a search over every edit sequence, and against a plain shortest path for long conversations."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest

from cyclonespark.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string, kind int, place int, digest string, cost int"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def damaged(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        conv_, turn_ = (" " if v is None else v for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        out[conv]
        if kind:
            role = "user" if kind == 4 else role
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    for turns in out.values():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return out


def faults(turns):
    seen, out = set(), []
    for _, role, text in turns:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    return out


def options(turn, fault):
    out = [(2, "D", None)]
    if fault not in ("blank", "duplicate"):
        stays = 5 * (fault == "truncated")
        out += [(stays, "K", turn[1:]), (1 + stays, "R", ("user", turn[2])), (1 + stays, "R", ("assistant", turn[2]))]
    return out


def by_search(turns, marks, most=2):
    """Every choice of edits with up to ``most`` insertions at each place."""
    inserts = [()] + [x for n in range(1, most + 1) for x in itertools.product(("user", "assistant"), repeat=n)]
    best = None
    steps = []
    for turn, fault in zip(turns, marks, strict=True):
        steps += [[(5 * len(x), "I" * len(x), [(r, "") for r in x]) for x in inserts], [(c, a, [t] if t else []) for c, a, t in options(turn, fault)]]
    steps.append([(5 * len(x), "I" * len(x), [(r, "") for r in x]) for x in inserts])
    for chosen in itertools.product(*steps):
        cost, audit = sum(x[0] for x in chosen), "".join(x[1] for x in chosen)
        if best and (cost, audit) >= best[:2]:
            continue
        made = [t for x in chosen for t in x[2]]
        if LEGAL.match("".join(r[:1] if r[:1] in "sua" and r else "?" for r, _ in made)):
            best = (cost, audit, made)
    return best


def by_path(turns, marks):
    """Relaxation over (rows, state) with whole audits and texts; insertions relaxed until nothing changes."""
    follow = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def closed(at):
        while True:
            new = dict(at)
            for q, (c, a, m) in at.items():
                for role in ("user", "assistant"):
                    if role[0] in follow[q]:
                        to, got = follow[q][role[0]], (c + 5, a + "I", [*m, (role, "")])
                        if to not in new or got[:2] < new[to][:2]:
                            new[to] = got
            if new == at:
                return at
            at = new

    at = closed({0: (0, "", [])})
    for turn, fault in zip(turns, marks, strict=True):
        new = {}
        for q, (c, a, m) in at.items():
            for cost, initial, made in options(turn, fault):
                to = q if made is None else follow[q].get(made[0][:1])
                got = (c + cost, a + initial, m + ([made] if made else []))
                if to is not None and (to not in new or got[:2] < new[to][:2]):
                    new[to] = got
        at = closed(new)
    return min((at[q] for q in (0, 3) if q in at), key=lambda x: x[:2])


def want(rows, solve):
    out = []
    for conv, turns in damaged(rows).items():
        marks = faults(turns)
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, made = solve(turns, marks)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out.append((conv, gaps, *(marks.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def run(spark, rows):
    table = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], SCHEMA).repartition(4)
    got = C.repair(table, C.damage(table))
    assert tuple(got.columns) == C.COLUMNS
    return sorted(map(tuple, got.collect()), key=repr)


def _rows(rng, convs, longest):
    rows = []
    for conv in convs:
        for _ in range(rng.randint(1, longest)):
            turn = rng.choice([None, *range(-1, 9)]) if longest < 9 else rng.randrange(10_000)
            rows.append((conv, turn, rng.choice(["system", "user", "assistant", "user", "assistant", None, "tool", "", "umpire"]), rng.choice([None, "", " \n\x0b", "Hi.", "Hi.", "no end", "end! \t", "é?", "日本", "x" * 9000 + "."])))
    return rows


def test_small_against_every_edit_sequence(spark):
    rows = _rows(random.Random(5), [None, *range(60)], 3)
    assert run(spark, rows) == want(rows, by_search)


@pytest.mark.parametrize("segment", [1, 3, 128])
def test_long_against_a_shortest_path(spark, monkeypatch, segment):
    rng = random.Random(segment)
    rows = _rows(rng, range(40), 8) + _rows(rng, [77, 78], 400) + [(1, 1, "user", "Same.")] * 7
    if segment < 128:  # local workers do not see a patched value, so the stream runs here
        monkeypatch.setattr(C, "SEGMENT", segment)
        got = []
        for conv, turns in damaged(rows).items():
            one, seen = C.Conversation(conv), set()
            for turn, role, text in turns:
                one.add(turn, role, text, (role, text) not in seen)
                seen.add((role, text))
            got.append(one.result())
        assert sorted(got, key=repr) == want(rows, by_path)
    else:
        assert run(spark, rows) == want(rows, by_path)


def test_whole_table(spark):
    path = "/root/testdata/sf0.001/conversations.parquet"
    table = spark.read.parquet(path)
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, C.repair(table, C.damage(table)).collect()), key=repr) == want(rows, by_path)


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.repair(none).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert run(spark, [(dropped, 0, "user", "Gone.")]) == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    clean = spark.createDataFrame([(1, 0, "system", "S."), (1, 1, "user", "U?"), (1, 2, "assistant", "A!")], "conv_id long, turn long, role string, text string")
    assert C.repair(clean).first().audit == "KKK"

"""Conversation repair against all edit scripts of small conversations and a plain dynamic program of long ones."""

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest
from helpers import bag
from plume.llm import repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, cost string, n long, audit int"
BLANK = " \t\n\x0b\x0c\r"


def _damaged(rows):
    out = defaultdict(list)
    for c, t, role, text in (r[:4] for r in rows):
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if hit == 1 else "".join(x for x in text if x not in ".!?") if hit == 2 else text
        role = "user" if hit == 4 else role
        out[c] += [(t, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    for rs in out.values():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    return out


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        end = text.rstrip(BLANK)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def _cheapest(rows, faults):
    """Dijkstra by (cost, audit) over (rows done, last initial): shortest, then ASCII-least."""
    todo, done = [(0, "", 0, "", ())], set()
    best = None
    while todo:
        cost, audit, i, last, text = heapq.heappop(todo)
        if best and cost > best[0]:
            break
        if i == len(rows) and last in ("", "a"):
            if best is None or (cost, audit) < best[:2]:
                best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in text))
        if (i, last) in done:
            continue
        done.add((i, last))
        want = "assistant" if last == "u" else "user"
        heapq.heappush(todo, (cost + 3, audit + "I", i, want[0], (*text, (want, ""))))
        if i == len(rows):
            continue
        _, role, said = rows[i]
        heapq.heappush(todo, (cost + 4, audit + "D", i + 1, last, text))
        if faults[i] not in ("blank", "duplicate"):
            more = 3 * (faults[i] == "truncated")
            heapq.heappush(todo, (cost + 3 + more, audit + "R", i + 1, want[0], (*text, (want, said))))
            if role[:1] == want[0] or role[:1] == "s" and last == "":
                heapq.heappush(todo, (cost + more, audit + "K", i + 1, role[:1], (*text, (role, said))))
    return best


def _all_scripts(rows, faults, most=5):
    """Every audit with at most ``most`` insertions in all, tried out."""
    got = []

    def go(i, last, cost, audit, left):
        if i == len(rows) and last in ("", "a"):
            got.append((cost, audit))
        want = "a" if last == "u" else "u"
        if left:
            go(i, want, cost + 3, audit + "I", left - 1)
        if i < len(rows):
            go(i + 1, last, cost + 4, audit + "D", left)
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                go(i + 1, want, cost + 3 + more, audit + "R", left)
                if rows[i][1][:1] == want or rows[i][1][:1] == "s" and last == "":
                    go(i + 1, rows[i][1][:1], cost + more, audit + "K", left)
    go(0, "", 0, "", most)
    return min(got)


def _expected(rows):
    left, out = _damaged(rows), []
    for c in {r[0] for r in rows}:
        rs = left.get(c, [])
        faults = _faults(rs)
        turns = {t for t, *_ in rs if t is not None}
        cost, audit, text = _cheapest(rs, faults) if rs else (0, "", "")
        out.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                    *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                    sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:])),
                    cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


def _frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(parts)


def _random(n, seed, longest=9):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rnd.randint(1, longest)):
            role = rnd.choice(["user", "assistant", "system", "tool", "user", "assistant"])
            rows.append((c, t + rnd.randint(0, 1), role, rnd.choice(["Yes.", "No", "", " \n", "Why?", "So be it! ", "um,"]) ))
    return rows


def _symbols(text):
    kind, fault = zip(*(divmod(ord(s) - repair.FIRST, 3) for s in text)) if text else ((), ())
    roles = [("system", "user", "assistant", "x")[k] for k in kind]
    return [(i, r, "") for i, r in enumerate(roles)], [("", "truncated", "blank")[f] for f in fault]


def test_matrices_give_the_best_of_all_scripts():
    rnd = random.Random(2)
    known = repair.grammar_table([])
    letters = [chr(repair.FIRST + i) for i in range(12)]
    for _ in range(400):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 5)))
        m, _ = repair._folded([known[s] for s in text])
        assert repair.result(m[repair.START]) == _all_scripts(*_symbols(text))


def test_rules_do_not_change_results(spark):
    rnd = random.Random(6)
    letters = [chr(repair.FIRST + i) for i in (0, 3, 6, 4, 8)]
    texts = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 60))) for _ in range(120)} | {"DG" * 700, "F" * 999})
    strings = spark.createDataFrame([(t,) for t in texts], "symbols string")
    for most in (0, 7, repair.RULES):
        now, rules = repair.re_pair(strings, most)
        known = repair.grammar_table(rules)
        assert len(rules) <= most and (most < 100 or len(rules) > 30)
        spelled = {s: s for s in known if s < "M"}
        for sym, a, b in rules:
            spelled[sym] = spelled[a] + spelled[b]
        for r in now.collect():
            assert "".join(spelled[s] for s in r.now) == r.symbols
            if most > 100:
                assert len(r.now) < max(12, len(r.symbols) / 2)
            m, ends = repair._folded([known[s] for s in r.now])
            rows, faults = _symbols(r.symbols)
            assert repair.result(m[repair.START]) == _cheapest(rows, faults)[:2]
            assert ends[2] == sum(a[1][0] + b[1][0] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("segment,fan", [(repair.SEGMENT, repair.FAN), (3, 2)])
def test_repair_matches_brute_force(spark, segment, fan):
    rows = _random(120, 1) + [(500, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(90)] + [
        (None, 1, "user", "No id."), (None, None, "user", "No turn."), (None, None, "assistant", "No id."),
        (600, None, None, None), (600, None, "user", None), (600, 3, None, "No role."), (600, 3, "", "Empty role."),
        (601, 5, "user", "Same turn."), (601, 5, "assistant", "Same turn."), (601, 5, "user", "Same turn."),
        (602, -4, "user", "Far."), (602, 9, "assistant", "Away."), (603, 1, "sage", "Initials count."),
        (603, 2, "ufo", "They do."), (603, 3, "ape", "So."), (604, 1, "user", "x" * 300_000 + "."),
        (605, 1, "User", "Capital."), (606, 1, "user", "é漢\U0001F600. \n")]
    rows += [(700 + i, 0, "user", "Only one.") for i in range(60)]  # some are dropped: no row is left
    got = repair.repair(_frame(spark, rows), segment=segment, fan=fan)
    assert bag(got.collect()) == bag(_expected(rows))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert repair.repair(_frame(spark, [])).count() == 0
    twice = rows[:60] * 2
    assert bag(repair.repair(_frame(spark, twice)).collect()) == bag(_expected(twice))


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert bag(repair.op11_repair_grammar(spark, SF).collect()) == bag(_expected(rows))

"""Hard negatives against a plain nested loop over exact Python numbers, and the SQL twin."""

import math
import random

import numpy as np
from helpers import bag
from plume.llm import negatives

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, row string, score int, g string"


def _brute(rows):
    ok = []
    for at, r in enumerate(rows):
        if r[2] is None or r[1] is None or any(x is None or not math.isfinite(x) for x in r[1]):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in r[1]]
        if sum(x * x for x in q) < 2**63:
            ok.append((at, r[0], (r[2] + 1) % 10 if r[0] is not None and r[0] % 7 == 0 else r[2], q))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for at, i, label, q in ok:
        if i is None or i % 50:
            continue
        same = sorted(((dot(q, c[3]), c[1]) for c in ok if c[2] == label and c[0] != at), key=order)
        other = sorted(((dot(q, c[3]), c[1]) for c in ok if c[2] != label), key=order)
        for p, pid in same[:5]:
            fit = [x for x in other if 50 * p <= 100 * x[0] <= 95 * p][:3]
            out += [(i, pid, k + 1, n, p, s) for k, (s, n) in enumerate(fit)]
    return out


def _rows(n, width, seed, labels=3, steps=8):
    rnd = random.Random(seed)
    return [(i, [rnd.randint(-steps, steps) / 16 + 0.25 for _ in range(width)], rnd.randrange(labels), "r", 1, "g")
            for i in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_strassen_is_the_plain_product():
    rnd = np.random.default_rng(3)
    for m, k, n in ((1, 1, 1), (7, 5, 3), (33, 64, 71), (128, 65, 129)):
        a, b = rnd.integers(-(2**26), 2**26, (m, k)), rnd.integers(-(2**26), 2**26, (n, k))
        for leaf in ((1, 2) if m < 20 else (16, 32)):
            assert (negatives.strassen(a, b, leaf) == a @ b.T).all()
    big = np.array([[2**31, 2**31 - 1], [-(2**31), 5]])
    assert (negatives.strassen(big, big, 1) == big @ big.T).all()


def test_mining_matches_a_nested_loop(spark):
    for seed, width, steps in ((1, 9, 8), (2, 3, 1)):  # the second has many equal scores
        rows = _rows(230, width, seed, steps=steps)
        for tiles in ((512, 8192), (2, 17)):
            got = negatives.mine(_frame(spark, rows), tile_a=tiles[0], tile_c=tiles[1])
            assert bag(got.collect()) == bag(_brute(rows)) and got.count() > 20


def test_odd_rows(spark):
    more = ("r", 1, "g")
    rows = _rows(120, 4, 5) + [
        (None, [0.5, 0.5, 0.25, 0.5], 1, *more), (500, None, 1, *more), (550, [0.5, None, 0.5, 0.5], 1, *more),
        (600, [0.5, float("nan"), 0.5, 0.5], 1, *more), (650, [0.5, float("inf"), 0.1, 0.1], 2, *more),
        (700, [0.5, 0.5, 0.5, 0.5], None, *more), (750, [], 2, *more), (800, [0.5], 1, *more),
        (850, [0.5] * 9, 1, *more), (900, [3e38, 0.0, 0.0, 0.0], 1, *more), (951, [0.5, 0.25, 0.5, 0.5], 1, *more)]
    assert bag(negatives.mine(_frame(spark, rows), tile_a=2, tile_c=30).collect()) == bag(_brute(rows))
    twice = rows + [r for r in rows if r[0] in (50, 100, 951, 3)]  # repeated rows, one an anchor
    assert bag(negatives.mine(_frame(spark, twice)).collect()) == bag(_brute(twice))
    for few in ([], rows[:1], [(0, [0.5], 1, *more), (50, [0.5], 1, *more)]):
        assert negatives.mine(_frame(spark, few)).count() == 0


def test_sql_twin(spark):
    from oracle_check import digest, duck
    df = negatives.op13_strassen_negatives(spark, SF)
    res = duck(SF).sql(negatives.SQL)
    assert sorted(df.columns) == sorted(res.columns)
    mine, theirs = [tuple(r) for r in df.collect()], res.fetchall()
    assert mine and digest(df.columns, mine) == digest(res.columns, theirs)

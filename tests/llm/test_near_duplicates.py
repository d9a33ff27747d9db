"""Fingerprints, SimHash groups, repeated passages: against brute force, with odd rows."""

import hashlib
import random
from collections import defaultdict

import xxhash
from helpers import bag, documents, empty, frame, odd
from plume.llm import components, simhash, spotsigs, suffixes


def _simhash(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def _expected_groups(rows, node, linked):
    of = _groups({node(r) for r in rows}, linked)
    low = {}
    for r in rows:
        if r[0] is not None:
            low[of[node(r)]] = min(low.get(of[node(r)], r[0]), r[0])
    return [(r[0], low.get(of[node(r)])) for r in rows]


def test_simhash_groups_match_brute_force(spark):
    rows = [r for r in odd() if len(r[1] or "") < 5000] + [
        (8000 + i, f"short note {i % 7} " + "tail " * (i % 3), "en", "s", 1, "", 1, "") for i in range(40)]
    fp = {r: _simhash(r[1]) for r in set(rows)}
    expected = _expected_groups(rows, lambda r: fp[r], lambda a, b: (a ^ b).bit_count() <= 2)
    got = simhash.near_duplicates(frame(spark, rows))
    assert bag(got.select("doc_id", "component_id").collect()) == bag(expected)
    assert {(r.doc_id, r.fp % (1 << 64)) for r in got.collect()} == {(r[0], fp[r]) for r in fp}
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_crowded_buckets_link_the_same(spark):
    random.seed(1)
    base = [random.getrandbits(64) for _ in range(4)]
    fps = set(base)
    for _ in range(150):
        x = random.choice(sorted(fps))
        for _ in range(random.randint(1, 4)):
            x ^= 1 << random.randrange(64)
        fps.add(x)
    table = simhash.pivot_table(spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long"))
    want = _groups(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    parts = defaultdict(set)
    for n, r in want.items():
        parts[r].add(n)
    for bucket in (256, 2):  # pairs in buckets, and the star of shared neighbours
        got = components.components(simhash.links(table, 2, bucket))
        mine = defaultdict(set)
        for r in got.collect():
            mine[r.component].add(r.node % (1 << 64))
        assert sorted(map(sorted, mine.values())) == sorted(sorted(p) for p in parts.values() if len(p) > 1)
    one = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() == 1}
    got = {tuple(sorted((r.a % (1 << 64), r.b % (1 << 64)))) for r in simhash.links(table, 1, 2).collect()}
    assert got == one


def test_one_of_each_group_stays(spark):
    rows = [r for r in odd() if len(r[1] or "") < 5000]
    kept = simhash.one_each(frame(spark, rows))
    fp = {r: _simhash(r[1]) for r in set(rows)}
    of = _groups(set(fp.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    assert kept.columns == [c.split()[0] for c in "doc_id text lang source n_chars score key size".split()]
    # An id of two texts names two groups, so groups are counted by fingerprint.
    assert sorted(of[_simhash(r.text)] for r in kept.collect()) == sorted(set(of.values()))


def test_null_and_repeated_ids_keep_every_group(spark):
    tail = ("en", "s", 1, "", 1, "")
    rows = [(None, f"text {i} without any id " + f"word{i} " * 9, *tail) for i in range(5)] + [
        (None, "text 0 without any id " + "word0 " * 9, *tail), (1, "one text under an id", *tail),
        (1, "quite another one of that same id", *tail), (1, "one text under an id", *tail),
        (0, "quite another one of that same id", *tail), (1, "one text under an id", *tail[:-1], "other")]
    fp = {r: _simhash(r[1]) for r in set(rows)}
    of = _groups(set(fp.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    want = {}
    for r in rows:
        want.setdefault(of[fp[r]], []).append(r)
    least = {g: min((r[0] is None, r[0] or 0) for r in rs) for g, rs in want.items()}
    for parts in (1, 5):
        kept = [tuple(r) for r in simhash.one_each(frame(spark, rows, parts)).collect()]
        assert sorted(of[fp[r]] for r in kept) == sorted(want) and len(want) == 7
        assert all((r[0] is None, r[0] or 0) == least[of[fp[r]]] for r in kept)


def test_long_chains_become_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (None, 5), (7, 6)], "a long, b long")
    got = components.components(links).collect()
    assert {r.node for r in got} == set(range(301)) and {r.component for r in got} == {0}
    assert components.components(links.where("a = 1000")).count() == 0


def test_spots_of_edited_and_next_texts(spark):
    rows = odd()
    got = {}
    for r in spotsigs.compare(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    ordered = sorted(rows, key=key)
    assert sum(map(len, got.values())) == len(rows)
    for i, r in enumerate(ordered):
        text, after = r[1] or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own = spotsigs.spots(text)
        want = (len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(own),
                spotsigs.likeness(own, spotsigs.spots(edited)), spotsigs.likeness(own, spotsigs.spots(after)))
        assert want in [(g.n_chars, g.edited_sha256, g.fingerprint, g.near_edited, g.near_next) for g in got[r[0]]]
    assert spotsigs.compare(empty(spark)).count() == 0
    one = spotsigs.compare(frame(spark, rows[:1])).first()
    assert one.near_next == 1.0


def test_spotsigs_near_duplicates_match_brute_force(spark):
    rows = odd()[:-1]
    more = [(7000 + i, r[1][:int(len(r[1]) * 0.97)], *r[2:]) for i, r in enumerate(documents()[:40])]
    rows += more
    sets = {r: tuple(spotsigs.spots(r[1])) for r in set(rows)}
    linked = lambda a, b: spotsigs.likeness(a, b) >= 0.8
    want = _expected_groups(rows, lambda r: sets[r], linked)
    got = spotsigs.near_duplicates(frame(spark, rows))
    assert bag(got.select("doc_id", "class_id").collect()) == bag(want)
    distinct = set(sets.values())
    links = {s: sum(linked(s, o) for o in distinct if o != s) for s in distinct}
    assert bag(got.select("doc_id", "n_links").collect()) == bag((r[0], links[sets[r]]) for r in rows)


def _passages(rows, n):
    words = [(r[0], (r[1] or "").encode().split()) for r in rows]
    seen = defaultdict(set)
    for i, (_, w) in enumerate(words):
        for s in range(len(w) - n + 1):
            seen[tuple(w[s:s + n])].add(i)
    out = []
    for doc_id, w in words:
        runs = []
        for s in range(len(w) - n + 1):
            if len(seen[tuple(w[s:s + n])]) > 1:
                if runs and s <= runs[-1][1]:
                    runs[-1][1] = s + n
                else:
                    runs.append([s, s + n])
        out += [(doc_id, s, e, e - s) for s, e in runs]
    return out


def test_passages_match_brute_force(spark):
    shared = " ".join(f"s{i}" for i in range(55))
    rows = [r for r in odd() if len(r[1] or "") < 50_000] + [
        (6000 + i, " ".join(f"w{i}_{j}" for j in range(30)) + " " + shared + f" end{i}", "en", "s", 1, "", 1, "")
        for i in range(30)] + [
        (6100, "rep " * 200, "en", "s", 1, "", 1, ""),  # repeats within itself only
        (6101, "both " * 130, "en", "s", 1, "", 1, ""), (6102, "x " + "both " * 90, "en", "s", 1, "", 1, "")]
    got = suffixes.passages(frame(spark, rows))
    assert bag(got.collect()) == bag(_passages(rows, 50))
    assert suffixes.passages(empty(spark)).count() == 0
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "61")  # runs of a key that pass the edges of many partitions
    try:
        assert bag(suffixes.passages(frame(spark, rows)).collect()) == bag(_passages(rows, 50))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert bag(suffixes.passages(frame(spark, rows[:60]), words=20, gram=5).collect()) == bag(_passages(rows[:60], 20))

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from table_rows import rows
from plume.operators import communities as LP
from plume.operators import graph as G
from plume.operators.iterate import MeetingEdges, SpreadEdges, dense_index, round_state
from plume.operators.pagerank import pagerank

# two 4-cliques joined by one edge, a dangling node, an isolated node, a reciprocal pair, a self-loop
CLIQUE_A, CLIQUE_B = ["a1", "a2", "a3", "a4"], ["b1", "b2", "b3", "b4"]
EDGES = ([(u, v, 1) for u, v in itertools.permutations(CLIQUE_A, 2)]
         + [(u, v, 2) for u, v in itertools.permutations(CLIQUE_B, 2)]
         + [("a1", "b1", 1), ("b4", "dangle", 3), ("p", "q", 1), ("q", "p", 5), ("s", "s", 2)])
NODES = sorted({u for e in EDGES for u in e[:2]} | {"iso"})


def graph(spark):
    e = spark.createDataFrame(EDGES, "source_user string, target_user string, weight long")
    v = spark.createDataFrame([(n,) for n in NODES], "username string")
    return v, e


def brute_pagerank(rounds=None, alpha=0.85, tol=1e-6, max_iter=100):
    idx = {n: i for i, n in enumerate(NODES)}
    n = len(NODES)
    w = np.zeros((n, n))
    for s, t, x in EDGES:
        w[idx[s], idx[t]] += x
    out = w.sum(axis=1)
    dangling = out == 0
    p = np.divide(w, out[:, None], out=np.zeros_like(w), where=out[:, None] > 0)
    x = np.full(n, 1.0 / n)
    for it in range(rounds or max_iter):
        last = x
        x = alpha * (last @ p + last[dangling].sum() / n) + (1 - alpha) / n
        if rounds is None and np.abs(x - last).sum() < n * tol:
            break
    return {node: x[idx[node]] for node in NODES}


def test_pagerank_matches_power_iteration(spark):
    v, e = graph(spark)
    got, info = pagerank(v, e, max_iter=7, tol=None)
    exp = brute_pagerank(rounds=7)
    g = {r["username"]: r["pagerank"] for r in got.collect()}
    assert info.iterations == 7
    assert all(abs(g[k] - exp[k]) < 1e-12 for k in NODES)
    assert abs(sum(g.values()) - 1.0) < 1e-9


def test_pagerank_converges(spark):
    v, e = graph(spark)
    got, info = pagerank(v, e)
    exp = brute_pagerank()
    g = {r["username"]: r["pagerank"] for r in got.collect()}
    assert info.converged and info.iterations < 100
    assert all(abs(g[k] - exp[k]) < 1e-9 for k in NODES)


def _stable(labels, pairs):
    nb = {}
    for a, b in pairs:
        nb.setdefault(a, set()).add(b)
        nb.setdefault(b, set()).add(a)
    for n, near in nb.items():
        votes = [labels[q] for q in near]
        if votes.count(labels[n]) < max(votes.count(x) for x in votes):
            return False
    return True


def _connected(labels, pairs):
    for name in set(labels.values()):
        left = {n for n, x in labels.items() if x == name}
        reached = {min(left)}
        while True:
            more = {b for a, b in pairs if a in reached and b in left} | {a for a, b in pairs if b in reached and a in left}
            if more <= reached:
                break
            reached |= more
        if reached != left:
            return False
    return True


SHAPES = {
    "pair": [("a", "b")],
    "star": [("h", f"l{i}") for i in range(6)],
    "path": [(f"n{i:02d}", f"n{i + 1:02d}") for i in range(30)],
    "bipartite": [(f"x{i}", f"y{j}") for i in range(4) for j in range(5)],
    "graph": sorted({tuple(sorted(e[:2])) for e in EDGES}),
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_label_propagation_is_stable_and_connected(spark, shape):
    pairs = SHAPES[shape]
    verts = spark.createDataFrame([(n,) for n in sorted({n for p in pairs for n in p})], "username string")
    labels, rounds = LP.label_propagation(verts, spark.createDataFrame(pairs, "a string, b string"))
    got = dict(rows(labels))
    assert _stable(got, pairs) and _connected(got, pairs) and rounds > 0
    if shape in ("pair", "star"):
        assert len(set(got.values())) == 1


def test_rounds_do_not_move_the_edges_and_hubs_are_dealt(spark):
    hub = [("hub", f"u{i}", float(i)) for i in range(300)] + [(f"u{i}", f"u{i + 1}", 1.0) for i in range(600)]
    spread = SpreadEdges(spark.createDataFrame(hub, "src string, dst string, p double"), "src", hub_edges=50)
    parts = (spread.edges.where("src = 'hub'").groupBy(F.spark_partition_id()).count().collect())
    assert len(parts) > 1 and spread.hubs.count() == 1
    state = spark.createDataFrame([(f"u{i}", 1.0) for i in range(601)] + [("hub", 2.0)], "src string, rank double")
    for _ in range(4):  # the edges' side of a later round has no exchange
        joined = spread.look_up(round_state(state))
        plan = joined.hint("merge")._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == len(hub)
        assert "p#" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)
    one = joined.where("src = 'hub'").agg(F.sum("rank")).first()[0]
    assert one == 600.0


def _numbered(spark, pairs, n):
    both = sorted({(a, b, False) for p in pairs for a, b in (p, p[::-1])}) + [(i, i, True) for i in range(n)]
    return spark.createDataFrame(both, "node long, nbr long, own boolean")


@pytest.mark.parametrize("block_edges", [1000, 20])  # without and with vertices that have more edges than a block
def test_votes_and_waits_are_counted_in_blocks_that_never_move(spark, block_edges):
    n = 60
    pairs = [(0, i) for i in range(50)] + [(i, (i * 7 + 3) % 55) for i in range(1, 55)]  # a hub, self-loops, lonely ones
    nb = MeetingEdges(_numbered(spark, pairs, n), block_edges)
    assert (nb.hubs is not None) == (block_edges == 20)
    label = {i: i * 5 % 7 for i in range(n)}
    near = {i: {b for p in pairs for a, b in (p, p[::-1]) if a == i} for i in range(n)}
    votes = {i: [label[q] for q in near[i]] for i in range(n)}
    want = {i: max({*votes[i], label[i]}, key=lambda x: (votes[i].count(x), x == label[i], x)) for i in range(n)}  # noqa: B023
    state = spark.createDataFrame(sorted(label.items()), "id long, label long")
    asked = LP.wishes(nb, state)
    assert rows(asked, "node", "label", "target") == [(i, label[i], want[i]) for i in range(n)]
    wish = {i: f"{want[i] * 3 % 7:032d}{want[i]:010d}" for i in range(n) if want[i] != label[i]}
    free = [(i, want[i]) for i in sorted(wish) if all(wish[i] >= wish.get(q, "") for q in near[i])]
    moves = LP.free_moves(nb, spark.createDataFrame([(i, w, want[i]) for i, w in sorted(wish.items())],
                                                    "id long, wish string, target long"))
    assert 0 < len(free) < len(wish) and rows(moves, "node", "new") == free
    if nb.hubs is None:  # the state is dealt; neither the packed edges nor what is counted passes an exchange
        plan = asked._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines()
        edges = next(i for i, x in enumerate(plan) if "Scan" in x and "packed" in x)
        assert not any("Exchange" in x for x in plan[:edges]) and any("Exchange hashpartitioning" in x for x in plan[edges:])


def test_spread_edges_are_not_dealt_again(spark):
    spread = SpreadEdges(spark.createDataFrame([(i % 20, i) for i in range(100)], "src long, dst long"), "src")
    state = spark.range(20).select(F.col("id").alias("src"), F.lit(1).alias("x"))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")  # as with a large state
    try:
        joined = spread.look_up(state)
        lines = joined._jdf.queryExecution().executedPlan().toString().splitlines()
        assert joined.count() == 100
    finally:
        spark.conf.set(name, before)
    scan = next(i for i, x in enumerate(lines) if "Scan" in x and "__edges" in x)
    assert any("SortMergeJoin" in x for x in lines[:scan]) and not any("Exchange" in x for x in lines[:scan])


def test_label_propagation_of_a_hub_beyond_a_block(spark):
    pairs = [("h", f"l{i:02d}") for i in range(40)] + [(f"l{i:02d}", f"l{i + 1:02d}") for i in range(0, 39, 3)]
    verts = spark.createDataFrame([(n,) for n in sorted({n for p in pairs for n in p} | {"alone"})], "username string")
    made = [sorted(rows(LP.label_propagation(verts, spark.createDataFrame(pairs, "a string, b string"), k)[0]))
            for k in (1000, 15)]
    assert made[0] == made[1] and _stable(dict(made[0]), pairs) and dict(made[0])["alone"] == "alone"


def test_communities_planted_cliques(spark):
    v, e = graph(spark)
    c = {r["username"]: r["community_id"] for r in LP.communities(v, G.undirected_edges(e)).collect()}
    assert len(c) == len(NODES)
    assert len({c[x] for x in CLIQUE_A}) == 1 and len({c[x] for x in CLIQUE_B}) == 1
    assert c["a1"] != c["b1"] and c["iso"] not in {c["a1"], c["b1"]}
    assert sorted(set(c.values())) == list(range(len(set(c.values()))))  # dense ids from 0


def test_dense_index(spark):
    keys = ["k%03d" % i for i in range(0, 300, 7)] * 2
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = dict(rows(dense_index(df, "k", "i", partitions=5)))
    assert got == {k: i for i, k in enumerate(sorted(set(keys)))}


def test_degree_invariants(spark):
    v, e = graph(spark)
    d = {r["username"]: r for r in G.degrees(v, e).collect()}
    total = sum(x for _, _, x in EDGES)
    assert sum(r["in_degree"] for r in d.values()) == total == sum(r["out_degree"] for r in d.values())
    assert all(r["degree"] == r["in_degree"] + r["out_degree"] for r in d.values())
    assert d["s"]["degree"] == 4.0 and d["iso"]["degree"] == 0.0


def _posts(spark, data):
    return spark.createDataFrame(data, "id long, username string, inReplyToTweetId long, mentions_array array<string>")


def test_edges(spark):
    posts = _posts(spark, [
        (1, "alice", None, ["alice", "bob", ""]),   # self-mention kept, '' dropped
        (2, "bob", 1, []),                          # reply bob -> alice
        (3, "alice", 3, ["bob"]),                   # self-reply kept, mention alice -> bob
        (4, "carol", 99, []),                       # reply to a missing post
        (5, "", None, ["dave"]),                    # unknown author: no edges
        (6, "dave", 5, []),                         # reply to a post without author
        (7, "bob", 1, []),                          # second reply bob -> alice
    ])
    got = rows(G.user_edges(posts))
    assert got == [("alice", "alice", "mention", 1), ("alice", "alice", "reply", 1), ("alice", "bob", "mention", 2),
                   ("bob", "alice", "reply", 2)]
    collapsed = rows(G.collapse_edges(G.user_edges(posts)), "source_user", "target_user", "weight", "type")
    assert ("alice", "alice", 2, "mention") in collapsed
    nodes = [r[0] for r in rows(G.nodes(posts))]
    assert nodes == ["alice", "bob", "carol", "dave"]


def test_subgraph_and_reports(spark):
    v, e = graph(spark)
    e = e.withColumn("type", F.lit("mention"))
    ranks, _ = pagerank(v, e, max_iter=5, tol=None)
    comms = LP.communities(v, G.undirected_edges(e))
    cent = G.centrality(v, e, ranks, comms)
    top = G.subgraph_nodes(cent, 4)
    assert [r["username"] for r in top.collect()] == ["b1", "b2", "b3", "b4"] or top.count() == 4
    sub = G.subgraph_edges(e, top)
    names = {r["username"] for r in top.collect()}
    assert all(r["source"] in names and r["target"] in names for r in sub.collect())
    tu = G.top_users(cent, "degree", 3)
    assert tu.columns == ["rank", "username", "degree", "in_degree", "out_degree", "pagerank", "community_id"]
    assert [r["rank"] for r in tu.collect()] == [1, 2, 3]
    members = G.community_top_members(cent, k=2, n=2)
    assert members.count() == 4

"""Packing: ids as the tokenizer gives them, every id in one piece, cuts as cheap as a plain dynamic program's."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import empty, frame, odd
from plume.llm import packing
from tokenizers import Tokenizer

ALPHABET = list("aAbBzZ '’sStTreRE<|>endoftext.,!?0123456789-_\t\n\x0b\x1c\x85\xa0éÉßçÇŸſŉİıΣς漢字😀́̈Å×÷\x00\x7f…½²")


@pytest.fixture(scope="module")
def encode():
    t = Tokenizer.from_file(packing.tokenizer_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_are_the_tokenizers(encode):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += [chr(a) + b for a in range(33, 0x180) for b in ("a", "'s")]
    texts += [None, "", "it's we've I'LL <|endoftext|> x<|startoftext|>y <|", "a" * 20_000, "End. Next.Not 3.14 \"So.\" ok"]
    known = packing.Words(packing.tokenizer_path(), most=500)  # the table is emptied on the way
    for s in range(0, len(texts), 200):
        ids, lengths, stops = known.ids(texts[s:s + 200])
        ends = np.cumsum(lengths)
        for t, n, e in zip(texts[s:s + 200], lengths, ends):
            assert ids[e - n:e].tolist() == encode(t), repr(t)
    ids, lengths, stops = known.ids(texts[-1:])
    before = {len(encode(t)) - 1 for t in ("End.", "End. Next.Not 3.14 \"So.\"")}
    assert set(stops.tolist()) == before
    assert [len(x) for x in known.ids([])] == [0, 0, 0]


def _cost(at, cost, chosen, size):
    total, before = 0, 0
    for k in chosen:
        n = at[k] - before
        assert 0 < n <= size
        total += cost[k] + packing.EACH + (0 if n & (n - 1) == 0 else size - n)
        before = at[k]
    return total


def _cheapest(at, cost, size):
    place, least = [0, *at], [0]
    for j in range(1, len(place)):
        gaps = [(place[j] - place[i], i) for i in range(j) if place[j] - place[i] <= size]
        least.append(min(least[i] + (0 if n & (n - 1) == 0 else size - n) for n, i in gaps)
                     + packing.EACH + cost[j - 1])
    return least[-1]


def test_cuts_cost_as_little_as_a_plain_dynamic_program():
    rnd = random.Random(9)
    for _ in range(150):
        size = rnd.choice([8, 20, 32])
        at = np.cumsum([rnd.randint(1, 8) for _ in range(rnd.randint(1, 60))])
        cost = np.array([rnd.choice([0, 1, 8]) for _ in at])
        got = packing.cuts(at, cost, size)
        assert got[-1] == len(at) - 1
        assert _cost(at.tolist(), cost.tolist(), got.tolist(), size) == _cheapest(at.tolist(), cost.tolist(), size)


def test_places_of_documents_and_sentences():
    at, cost = packing.places(np.array([1, 100, 101]), np.array([1, 5, 100]), step=32)
    assert at.tolist() == [1, 5, 37, 69, 100, 101] and cost.tolist() == [0, 1, 8, 8, 0, 0]
    at, cost = packing.places(np.empty(0, np.int64), np.empty(0, np.int64))
    assert len(at) == len(cost) == 0


@pytest.mark.parametrize("stretch,tail", [(packing.STRETCH, packing.TAIL), (40_000, packing.TAIL)])
def test_every_id_lies_in_one_piece(spark, encode, stretch, tail):
    rows = odd() + [(9100 + i, "no end of a sentence here " * i, "en", "s", 1, "", 1, "") for i in range(0, 900, 300)]
    got = packing.pack(frame(spark, rows, 3), stretch=stretch, tail=tail).collect()
    assert sorted(got[0].asDict()) == sorted(c.split()[0] for c in packing.OUT.split(", "))
    places, lengths = defaultdict(list), defaultdict(int)
    wanted = defaultdict(list)
    for r in rows:
        wanted[r[0]].append(encode(r[1]))
    pieces = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
        lengths[r.sequence_id] += r.length
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
    for p in places.values():
        at = 0
        for offset, n in sorted(p):
            assert offset == at and n > 0
            at += n
    assert max(lengths.values()) <= packing.SIZE
    filled = sum(0 if n & (n - 1) == 0 else packing.SIZE - n for n in lengths.values())
    assert filled < 0.01 * sum(lengths.values())
    for doc_id, texts in wanted.items():
        for ids in texts:  # copies have the same pieces unless they lie elsewhere: each copy is covered once
            mine = pieces[doc_id, len(ids)]
            copies = sum(len(t) == len(ids) for t in texts)
            assert sum(n for _, n, _ in mine) == copies * len(ids)
            for start, n, crc in mine:
                assert any(zlib.crc32(np.array(t[start:start + n], "<u4").tobytes()) == crc for t in texts)
            cover = sorted((s, s + n) for s, n, _ in mine)
            if copies == 1:
                assert cover[0][0] == 0 and all(a[1] == b[0] for a, b in zip(cover, cover[1:])) and cover[-1][1] == len(ids)


def test_empty_table(spark):
    assert packing.pack(empty(spark)).count() == 0


def test_query_packs_the_whole_table(spark, encode):
    got = packing.op12_pack_cuts(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert sum(r.length for r in got) == sum(len(encode(d.text)) for d in docs)

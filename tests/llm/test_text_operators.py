"""Decontamination, personal data, mixing, languages, quality: against brute force or held-out rows."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from helpers import SF, bag, documents, empty, frame, odd
from plume.llm import decontam, langid, mixing, pii, quality


def _lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def _words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(t))


def _contamination(rows, items):
    wins = {}
    for item, text in items:
        w = _words(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + k]), set()).add(item)
    sizes = {len(w) for w in wins}
    for r in rows:
        w, hit, found = _words(r[1]), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in wins:
                    hit |= set(range(i, i + k))
                    found |= wins[tuple(w[i:i + k])]
        names = sorted(str(f) for f in found if f is not None)
        yield (r[0], len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
               len(hit) > 0 and 20 * len(hit) >= len(w))


ITEMS = [(1, "Short item"), (2, None), (3, "..."), (None, "same words"), (4, "É same Words here"), (4, "Short item"),
         (5, " ".join(f"w{i}" for i in range(20)))]


@pytest.mark.parametrize("limit", [200_000, 0])
def test_contamination_matches_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", limit)
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = odd() + [(5000, "short ITEM, short item. same é", *[None] * 6), (5001, "same É same words HERE", *[None] * 6),
                    (5002, " ".join(f"W{i}" for i in range(3, 20)), *[None] * 6)]
    items = ITEMS + bench
    got = decontam.contamination(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert bag(got.collect()) == bag(_contamination(rows, items))


def test_clean_drops_the_contaminated(spark):
    rows = odd()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    bad = {(r[0], r[1]) for r, v in zip(rows, _contamination(rows, ITEMS)) if v[-1]}
    got = decontam.clean(frame(spark, rows), items)
    assert bag(got.collect()) == bag(r for r in rows if (r[0], r[1]) not in bad) and bad
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.clean(frame(spark, rows), none).count() == len(rows)
    assert decontam.clean(empty(spark), items).count() == 0


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def _base(text):
    out = []
    for o, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or max(map(int, m[0].split("."))) <= 255,
                    "card": 12 <= len(d) <= 19 and _luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), o, m.end(), kind))
    return sorted(out)


ODD_PII = ["a@b.c_d@e.f.g", ".@x.y", "1.2.3.4.5.6.7.8", "0255.1.1.1 256.1.1.1", "4111 1111-1111 1111", "\U0001F600 x@y.z",
           "+1 (938) 555-1226.", "++44 20 7946 0958 0", "4111111111111111111111", "1" * 30_000, "call 555-123-4567",
           "IBAN DE89 3704 0044 0532 0130 00", "IBAN DE88 3704 0044 0532 0130 00", "x " * 500 + "a@b.cd " * 300]


def test_base_spans_match_plain_patterns(spark):
    rows = odd() + [(4000 + i, t, *[None] * 6) for i, t in enumerate(ODD_PII)]
    want = []
    for r in rows:
        b = _base(r[1])
        digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in b).encode()).hexdigest()
        want.append((r[0], *[sum(x[3] == k for x in b) for k in BASE], digest))
    got = pii.pii(frame(spark, rows))
    assert bag(got.drop("spans", "scores").collect()) == bag(want)
    spans = {r.doc_id: r.spans for r in got.collect()}
    assert "iban:5:32" in spans[4011] and "iban" not in spans[4012] and "local_phone:5:17" in spans[4010]
    assert pii.pii(empty(spark)).count() == 0


def test_checks_and_context_words_decide(spark):
    pairs = [  # a proposal that is accepted, and one that a failed check or a missing word rejects
        ("my ssn is 123-45-6789 here", "order 123-45-6789 here", "national_id", 0.6),
        ("social security 123-45-6789", "social security 666-45-6789", "national_id", 0.6),
        ("call 555-234-4567", "part 555-234-4567", "local_phone", 0.6),
        ("fax: (555) 234-4567", "fax: (155) 234-4567", "local_phone", 0.6),
        ("DE89 3704 0044 0532 0130 00", "my bank account DE88 3704 0044 0532 0130 00", "iban", 0.6),
        ("IBAN DE89 3704 0044 0532 0130 00", "IBAN DE89 3704 0044 0532 0130 01", "iban", 0.8),
        ("password: sixteenletters0nly", "password: sixteenlettersonly", "secret", 0.6),
        ("token = 'a1b2c3d4e5f6a7b8c9'", "token = '12345678901234567890'", "secret", 0.6)]
    rows = [(2 * i + k, p[k], *[None] * 6) for i, p in enumerate(pairs) for k in (0, 1)]
    got = {r.doc_id: (r.spans, r.scores) for r in pii.pii(frame(spark, rows)).collect()}
    for i, (_, _, kind, score) in enumerate(pairs):
        assert got[2 * i][0].startswith(f"{kind}:") and float(got[2 * i][1]) == score, pairs[i]
        assert got[2 * i + 1] == ("", ""), pairs[i]
    far = "my ssn " + "x" * 40 + " 123-45-6789"
    assert pii.pii(frame(spark, [(1, far, *[None] * 6)])).first().spans == ""


def test_redaction(spark):
    rows = [(1, "x a@b.c y 192.168.0.1", "en", "s", 21, "", 1, ""), (2, None, None, None, None, None, None, None),
            (3, "", "en", "s", 0, "", 1, ""), (4, "nothing here", "en", "s", 12, "", 1, "")]
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(frame(spark, rows)).collect()}
    assert got == {1: ("x <EMAIL> y <IP>", 16), 2: (None, None), 3: ("", 0), 4: ("nothing here", 12)}
    again = pii.redact(pii.redact(frame(spark, odd())))
    assert bag(again.collect()) == bag(pii.redact(frame(spark, odd())).collect())


def _mix_targets(rows):
    size = {}
    for r in rows:
        size[r[3]] = size.get(r[3], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    names = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    full, total = set(), 1.5 * sum(size.values())
    while True:
        level = ((total - sum(2 * size[s] for s in full)) / w) if (w := sum(weight[s] for s in names if s not in full)) else 0
        more = {s for s in names if s not in full and level * weight[s] > 2 * size[s] + 1e-6}
        if not more:
            return size, {s: 2.0 * size[s] if s in full else level * weight[s] for s in names}
        full |= more


def test_mix_meets_its_targets_and_reruns_agree(spark):
    rows = odd()
    size, target = _mix_targets(rows)
    results = []
    for parts, bucket in ((3, 16), (7, 16), (5, 4096)):
        got = mixing.mix(frame(spark, rows, parts), bucket=bucket).collect()
        results.append(bag(got))
        assert len(got) == len(rows) and all(r.taken in (0, r.size, 2 * r.size) for r in got)
        assert bag((r.size, r.source_size) for r in got) == bag(
            (len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")), size[r[3]]) for r in rows)
        want = {round(size[s]): target[s] for s in target}
        for s in {r.source_size for r in got}:
            mine = [r for r in got if r.source_size == s]
            assert mine[0].target == pytest.approx(want[s])
            assert abs(sum(r.taken for r in mine) - want[s]) <= max(r.size for r in mine)
    assert results[0] == results[1]
    assert mixing.mix(empty(spark)).count() == 0


def test_mixed_rows_carry_their_columns(spark):
    rows = odd()
    got = mixing.mixed(frame(spark, rows))
    taken = mixing.mix(frame(spark, rows)).where("taken > 0")
    assert {"text", "lang", "source", "copies", "taken"} <= set(got.columns) and got.count() >= 1
    assert abs(got.count() - taken.count()) <= 6  # repeated ids are told apart, so their draws differ
    assert all(r.taken == r.copies * r.size and r.size == len(r.text.split()) for r in got.collect() if r.text.isascii())


def test_languages_of_held_out_documents(spark):
    rows = odd()
    docs = frame(spark, rows)
    out = langid.identify(docs.withColumn("held", langid.held_out()), langid.learned(docs))
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    real = [r for r in got if r.held and r.lang and len(r.text or "") > 40 and r.doc_id < 9000]
    assert sum(r.lang == r.lang_pred for r in real) >= 0.97 * len(real) and len(real) > 20
    assert {r.lang_pred for r in got if r.doc_id in (9001, 9002, 9003, 9004)} == {"und"}
    assert langid.identify(empty(spark), langid.learned(docs)).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, langid.learned(empty(spark))).collect()} == {"und"}


def _plain_counts(text):
    """N-grams of one to three characters, word by word."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    found = Counter()
    for i, w in enumerate(words):
        padded = f" {w} "
        found.update(w)
        found.update(padded[k:k + 2] for k in range(len(padded) - 1))
        found.update(padded[k:k + 3] for k in range(len(padded) - 2))
    pack = lambda g: sum(ord(c) << 21 * k for k, c in enumerate(g))
    return {pack(g): n for g, n in found.items()}


def test_counts_do_not_depend_on_the_parts():
    texts = [r[1] or "" for r in odd()[:40]] + ["", " ", "1", "a", "a b", "  ab  c ", "abc déf " * 50, "x" * 100,
                                               "\U0003134A\U00031350 \U00030000", "ÄÖ\U0001F600ß", "İIi ΣΑΣ"]
    for text in texts:
        want = _plain_counts(text)
        for chunk in (1, 2, 3, 7, langid.CHUNK):
            code, n = langid.counts(text, chunk)
            assert dict(zip(code.tolist(), n.tolist())) == want, (text[:40], chunk)
    long = "abc déf " * 300_000
    code, n = langid.counts(long)
    assert dict(zip(code.tolist(), n.tolist())) == _plain_counts(long)


def test_every_letter_counts(spark):
    docs = frame(spark, [(1, "\U0003134A\U00031350", "zh", "s", 2, "", 1, ""), (2, "plain words", "en", "s", 2, "", 1, "")])
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, langid.train(docs.select("text", "lang"))).collect()}
    assert got == {1: "zh", 2: "en"}


def test_context_pairs_cross_the_parts_of_a_long_text(spark, monkeypatch):
    docs = frame(spark, [(1, " ".join(f"w{i % 37}" for i in range(900)), "en", "s", 1, "", 1, "")])
    whole = quality.context_table(docs.select("text"))
    monkeypatch.setattr(quality, "PART", 7)
    assert np.array_equal(whole, quality.context_table(docs.select("text")))


def test_quality_learns_and_ignores_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    context = quality.context_table(docs.select("text"))
    net = quality.train(docs, labels.where(~quality.held_out()), context)
    got = quality.score(docs.select("doc_id", "text", quality.held_out().alias("held")), context, net)
    rows = got.join(labels, "doc_id").where("held").collect()
    y, s = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    assert (s[y == 1][:, None] > s[y == 0]).mean() > 0.9 and s.min() >= 0 and s.max() <= 1
    edges = quality.score(frame(spark, odd([])), context, net)
    assert edges.count() == 11 and edges.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    nothing = quality.train(docs.limit(0), labels, context)
    assert quality.score(docs.limit(3).select("text"), context, nothing).select("score").distinct().first()[0] == 0.5
    assert quality.score(empty(spark), context, net).count() == 0


def test_context_table_is_the_same_in_any_order(spark):
    rows = documents()[:60]
    a = quality.context_table(frame(spark, rows, 2).select("text"))
    b = quality.context_table(frame(spark, list(reversed(rows)), 7).select("text"))
    assert np.array_equal(a, b) and np.abs(quality.context_table(empty(spark).select("text"))).sum() == 0

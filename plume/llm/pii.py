"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score.

All in DataFrame functions.  A kind's matches are found by ``regexp_extract_all``; their places follow from the
lengths of what lies between them (``split`` by the same pattern), in code points.  Patterns are written with
possessive runs and start guards, so that their cost stays linear on long runs of digits or letters and no
match is lost: a guard forbids starts within a run except right behind the last match (``\\G``).

Base kinds (email, ip, card, phone) are kept whenever they are valid.  The other kinds are proposals with a
score: what their pattern is worth, more when their checksum or form holds, and more when one of their words
stands within ``NEAR`` characters before them (``WEIGHTS``); those of at least ``ACCEPT`` that overlap no base
span are added.  So an IBAN stands by its checksum alone, a national id or a local phone number needs both a
valid form and a word nearby, and a secret (whose word is part of the pattern) must mix letters and digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Kinds in their order, patterns, cheap first tests, and context words.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "national_id", "local_phone", "secret")
KINDS = BASE + ADDED
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9A-Za-z+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "secret": r"(?i)(?<![A-Za-z0-9_-])(?:token|secret|password|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_/+-]{16,256}",
}
FIRST = {
    "email": r"@[A-Za-z0-9-]+\.", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){11}", "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}", "national_id": r"[0-9]-[0-9]{2}-[0-9]", "local_phone": r"[0-9][.-][0-9]{4}",
    "secret": r"(?i)(?:token|secret|password|key)\s{0,3}[=:]",
}
CONTEXT_WORDS = {
    "email": "mail|contact|write", "ip": r"\bip\b|address|server|host", "card": "card|visa|payment|credit",
    "phone": r"phone|\btel\b|call|mobile|fax", "iban": "iban|account|bank", "national_id": r"\bssn\b|social security|\bid\b",
    "local_phone": r"phone|\btel\b|call|mobile|fax", "secret": "token|secret|password|key",
}
#: What a match scores by its pattern, by its check, and by a context word within ``NEAR`` characters before it.
WEIGHTS = {
    "email": (0.4, 0.3, 0.2), "ip": (0.2, 0.3, 0.2), "card": (0.1, 0.3, 0.2), "phone": (0.2, 0.3, 0.2),
    "iban": (0.1, 0.5, 0.2), "national_id": (0.1, 0.3, 0.2), "local_phone": (0.2, 0.2, 0.2), "secret": (0.3, 0.3, 0.0),
}
NEAR, ACCEPT = 40, 0.6

SPAN = "struct<start:int,ord:int,end:int,kind:string,score:double>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _mod97(c: Column) -> Column:
    """IBAN check: the first four characters move to the end, letters count 10 to 35, remainder 1."""
    bare = F.replace(c, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4)), "")
    def step(acc, ch):
        v = F.ascii(ch)
        return F.when(v < 58, (acc * 10 + v - 48) % 97).otherwise((acc * 100 + v - 55) % 97)
    return F.aggregate(F.filter(turned, lambda ch: ch != ""), F.lit(0), step) == 1


def _valid(kind: str, m: Column) -> Column:
    """Whether a match of the kind is well-formed (base kinds: whether it is kept)."""
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) <= F.when(
            F.ltrim(p, F.lit("0")) <= "255", 3).otherwise(2))
    if kind == "card":
        d = _digits(m)
        return F.length(d).between(12, 19) & F.call_function("luhn_check", d)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        return F.length(F.replace(m, F.lit(" "), F.lit(""))).between(15, 34) & _mod97(m)
    if kind == "national_id":
        return ~m.rlike(r"^(?:000|666|9)|-00-|-0000$")
    if kind == "local_phone":
        return _digits(m).rlike("^[2-9]")  # area codes do not start with 0 or 1
    if kind == "secret":
        value = F.regexp_extract(m, r"[=:]\s{0,3}[\"']?([A-Za-z0-9_/+-]+)$", 1)
        return value.rlike(r"[0-9]") & value.rlike(r"[A-Za-z]")
    return F.lit(True)


def _matches(kind: str, text: Column) -> Column:
    """Array of (start, end, match) of the kind in a text, in code points."""
    pattern = PATTERNS[kind]
    ms = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("out"))

    def step(acc, x):
        s = acc["at"] + x["gap"]
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(
            F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).alias("out"))
    zipped = F.zip_with(gaps, ms, lambda g, m: F.struct(g.alias("gap"), m.alias("m")))
    found = F.aggregate(F.filter(zipped, lambda z: z["m"].isNotNull()), start, step)["out"]
    return F.when(text.rlike(FIRST[kind]), found).otherwise(F.array().cast("array<struct<s:int,e:int,m:string>>"))


def _spans(kind: str, text: Column) -> Column:
    """Array of scored spans of the kind; base kinds: the valid ones, others: the accepted ones."""
    base = kind in BASE

    def scored(x):
        before = F.substring(text, F.greatest(x["s"] - NEAR, F.lit(0)) + 1, F.least(F.lit(NEAR), x["s"]))
        near = before.rlike(f"(?i){CONTEXT_WORDS[kind]}")
        pattern, check, context = WEIGHTS[kind]
        score = (F.lit(pattern) + F.when(_valid(kind, x["m"]), check).otherwise(0.0)
                 + F.when(near, context).otherwise(0.0))
        return F.struct(x["s"].alias("start"), F.lit(KINDS.index(kind)).alias("ord"), x["e"].alias("end"),
                        F.lit(kind).alias("kind"), F.round(score, 3).alias("score"))
    found = _matches(kind, text)
    if base:
        return F.transform(F.filter(found, lambda x: _valid(kind, x["m"])), scored)
    return F.filter(F.transform(found, scored), lambda x: x["score"] >= ACCEPT)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__base`` and ``__spans``: arrays of (start, ord, end, kind, score), sorted.

    Null and empty texts have empty arrays; nothing else of a row is read; rows are neither dropped nor joined.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # The first tests let most texts pass without a search; each kind's spans are one column.
    each = docs.withColumns({f"__{k}": _spans(k, t).cast(f"array<{SPAN}>") for k in KINDS})
    each = each.withColumn("__base", F.array_sort(F.concat(*[F.col(f"__{k}") for k in BASE])))
    more = F.filter(F.concat(*[F.col(f"__{k}") for k in ADDED]), lambda x: ~F.exists(
        "__base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return each.withColumn("__spans", F.array_sort(F.concat("__base", more))).drop(*[f"__{k}" for k in ADDED])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, counts of the base kinds, their digest, all spans, and their scores in the same order."""
    found = find(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")))
    return found.select(
        "doc_id", *[F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(_joined(F.col("__base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("__spans")).alias("spans"),
        F.array_join(F.transform("__spans", lambda x: x["score"].cast("string")), ",").alias("scores"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; ``n_chars``, if there, follows the text.

    Overlapping spans become one, named by the first.  Texts without spans stay as they are, null ones null.
    """
    cols = docs.columns
    found = find(docs, text)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, x):
        hidden = x["start"] < acc["at"]
        piece = F.array(F.substring(F.col(text), acc["at"] + 1, x["start"] - acc["at"]),
                        F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">")))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"),
                        F.when(hidden, acc["out"]).otherwise(F.concat(acc["out"], piece)).alias("out"))

    def done(acc):
        tail = F.substring(F.col(text), acc["at"] + 1, F.length(F.col(text)) - acc["at"])
        return F.array_join(F.concat(acc["out"], F.array(tail)), "")
    clean = F.when(F.size("__spans") == 0, F.col(text)).otherwise(F.aggregate("__spans", start, step, done))
    out = found.withColumn(text, clean)
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.when(F.size("__spans") > 0, F.length(F.col(text)).cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*cols)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document's whole text."""
    return pii(table(spark, sf_dir, "documents"))

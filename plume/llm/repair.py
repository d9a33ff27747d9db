"""Conversation structure repair by dynamic programming over a grammar-compressed text of roles and faults.

Each row of a conversation becomes one of twelve symbols: the initial of its role (s, u, a or another) and its fault
(none, truncated, or one that requires deletion).  The repaired initials must read ``(s?(ua)+)?``, which an automaton
of four states accepts, so a symbol is a min-plus transfer matrix between states: entry (p, q) is the least cost of
edits that lead from p to q over this row, with the ASCII-least string of edit initials of that cost (the audit).  Two
audits of one entry are never a prefix of each other, so the order of audits survives appending, and matrices of
longer stretches are products.

Conversations share their structure, so the products are shared too.  The different symbol strings are compressed by
Re-Pair: in each round the most frequent pairs of neighbours, counted over all strings, become rules; pairs that could
overlap wait for a later round.  Each rule gets one matrix, the product of its two symbols' matrices, evaluated bottom
up; its audits are ropes, which refer to the audits of the two symbols and are only spelled out at the end.  A string
then is the product of its few remaining symbols.  The number of rules is bounded by ``RULES``; a pair without a rule
costs a product in each string, nothing else.

No conversation is gathered into one task for this: rows are sorted by range, a long conversation falls into segments
of ``SEGMENT`` symbols, and the segments' matrices are multiplied in a reduction tree.  Only the digest of the
repaired text needs a conversation's rows in one task, since SHA-256 reads them in order; they are streamed from a
sort, after the conversation's audit, and never held.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import map_arrow, partitions, table, written

BLANKS = " \t\n\x0b\x0c\r"
INITIALS = "sua"           # the fourth class is every other initial
OK, CUT, GONE = range(3)   # faults: none, truncated, to be deleted
FIRST = 0x41               # terminals are "A" to "L"
RULE = 0x1000              # rules are characters from here on
RULES = 4096
ROUNDS = 24
SEGMENT = 4096
FAN = 64                   # segments that are multiplied in one task
REROLE, DELETE, INSERT, KEEP_CUT = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}

# ---------------------------------------------------------------- ropes and matrices


def _join(a, b):
    """Rope of two ropes; short ones become one string."""
    if not a or not b:
        return a or b
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= 32:
        return a + b
    return (a, b)


def spelled(rope) -> str:
    out, todo = [], [rope]
    while todo:
        r = todo.pop()
        if isinstance(r, str):
            out.append(r)
        else:
            todo += (r[1], r[0])
    return "".join(out)


def _before(a, b) -> bool:
    """Is rope ``a`` ASCII-less than ``b``?  Shared parts are skipped, not read."""
    x, y = [a], [b]
    while x and y:
        p, q = x.pop(), y.pop()
        if p is q:
            continue
        if not isinstance(p, str):
            x += (p[1], p[0])
            y.append(q)
        elif not isinstance(q, str):
            y += (q[1], q[0])
            x.append(p)
        else:
            n = min(len(p), len(q))
            if p[:n] != q[:n]:
                return p[:n] < q[:n]
            if p[n:]:
                x.append(p[n:])
            if q[n:]:
                y.append(q[n:])
    return bool(y) and not x


def _better(now, cost, rope) -> bool:
    return now is None or cost < now[0] or (cost == now[0] and _before(rope, now[1]))


def product(a: dict, b: dict) -> dict:
    """Min-plus product of two matrices, given by rows: ``{p: {q: (cost, rope)}}``."""
    out: dict = {}
    for p, row in a.items():
        got: dict = {}
        for m, (c, r) in row.items():
            for q, (d, s) in b.get(m, {}).items():
                if q not in got or c + d <= got[q][0]:
                    rope = _join(r, s)
                    if _better(got.get(q), c + d, rope):
                        got[q] = (c + d, rope)
        out[p] = got
    return out


#: Insertions between two rows; a second round trip through user and assistant only costs more.
INSERTED = {START: {START: (0, ""), USER: (INSERT, "I"), ASSISTANT: (2 * INSERT, "II")},
            SYSTEM: {SYSTEM: (0, ""), USER: (INSERT, "I"), ASSISTANT: (2 * INSERT, "II")},
            USER: {USER: (0, ""), ASSISTANT: (INSERT, "I")},
            ASSISTANT: {ASSISTANT: (0, ""), USER: (INSERT, "I")}}


def kept_state(state: int, initial: str) -> int | None:
    """The state after keeping a role of this initial, None if it may not stand here."""
    if initial == "s":
        return SYSTEM if state == START else None
    after = NEXT[state]
    return after if initial == ("u" if after == USER else "a") else None


def symbol(kind: int, fault: int) -> str:
    return chr(FIRST + 3 * kind + fault)


def terminal(sym: str) -> tuple[dict, tuple]:
    """Matrix of a row with the insertions before it, and its initials: first, last, illegal pairs within."""
    kind, fault = divmod(ord(sym) - FIRST, 3)
    initial = INITIALS[kind] if kind < 3 else ""
    row: dict = {}
    for p in range(4):
        row[p] = {p: (DELETE, "D")}
        if fault != GONE:
            more = KEEP_CUT if fault == CUT else 0
            for q, cost, edit in ((kept_state(p, initial), more, "K"), (NEXT[p], REROLE + more, "R")):
                if q is not None and _better(row[p].get(q), cost, edit):
                    row[p][q] = (cost, edit)
    return product(INSERTED, row), (initial, initial, 0)


def meet(a: tuple, b: tuple) -> tuple:
    """Initials of two stretches in a row: the pair where they meet may be illegal."""
    return a[0], b[1], a[2] + b[2] + (a[1] + b[0] not in ("su", "ua", "au"))


def grammar_table(rules: list[tuple[str, str, str]]) -> dict[str, tuple[dict, tuple]]:
    """Matrix and initials of every terminal and rule, bottom up."""
    out = {symbol(k, f): terminal(symbol(k, f)) for k in range(4) for f in range(3)}
    for sym, a, b in rules:
        out[sym] = product(out[a][0], out[b][0]), meet(out[a][1], out[b][1])
    return out


def result(row: dict) -> tuple[int, str]:
    """Least cost and audit of a whole conversation from the start row of its matrix."""
    best = None
    for q, (cost, rope) in product({START: row}, INSERTED)[START].items():
        if q in (START, ASSISTANT) and _better(best, cost, rope):
            best = (cost, rope)
    return best[0], spelled(best[1])


# ---------------------------------------------------------------- rows and symbols


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """``(conv_id, turn, role, text, n)``: every row after damage, with its number of copies (0: dropped)."""
    say = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(say(conv), F.lit(":"), say(turn)).cast("binary")) % 20
    return rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.when(hit == 4, "user").otherwise(say(role)).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate(say(text), ".!?", "")).otherwise(say(text)).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("n"))


def _digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.col(text), 256))


def _same(a: str, b: str, names: list[str]) -> list[Column]:
    return [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names]


def judged(rows: DataFrame) -> DataFrame:
    """One row per different (conv_id, turn, role, text) left by the damage: its copies ``n`` and faults.

    ``fresh`` is true where the first copy is the first of its role and text in the conversation.
    """
    end = F.rtrim("text", F.lit(BLANKS))
    one = (rows.where("n > 0").withColumn("blank", end == "")
           .withColumn("cut", ~F.right(end, F.lit(1)).isin(".", "!", "?"))
           .groupBy("conv_id", "turn", "role", _digest().alias("h"))
           .agg(F.sum("n").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut")))
    one = written(one, "repair-rows")
    names = ["conv_id", "role", "h"]
    first = one.groupBy(*names).agg(F.min(F.struct("turn")).alias("first"))  # a null turn is the least
    return (one.alias("x").join(first.alias("f"), _same("x", "f", names))
            .select("x.*", (~F.col("blank") & F.col("x.turn").eqNullSafe(F.col("f.first.turn"))).alias("fresh")))


def counts(rows: DataFrame) -> DataFrame:
    """Gaps and faults per conversation; sums by turn come first, so no conversation is gathered."""
    n, blank, fresh = F.col("n"), F.col("blank"), F.col("fresh").cast("long")
    turns = rows.groupBy("conv_id", "turn").agg(
        F.sum(F.when(blank, n).otherwise(0)).alias("blank"), F.sum(F.when(blank, 0).otherwise(n - fresh)).alias("duplicate"),
        F.sum(F.when(F.col("cut"), fresh).otherwise(0)).alias("truncated"))
    return turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])


def segments(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """``(conv_id, at, symbols)``: the rows of every conversation in order, ``at`` ascending."""
    kind = F.coalesce(F.nullif(F.instr(F.lit(INITIALS), F.left("role", F.lit(1))), F.lit(0)), F.lit(4)) - 1
    kind = F.when(F.length("role") == 0, 3).otherwise(kind).cast("int")
    fault = F.when(~F.col("fresh"), GONE).when(F.col("cut"), CUT).otherwise(OK)
    order = ["conv_id", "turn", "role", "h"]
    ranged = (rows.select(*order, kind.alias("kind"), fault.alias("fault"), F.col("n").cast("long").alias("n"))
              .repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
              .select("conv_id", "kind", "fault", "n"))
    schema = StructType([rows.schema["conv_id"], StructField("at", LongType()), StructField("symbols", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        at, conv, held, length, typ = TaskContext.get().partitionId() << 40, None, [], 0, None
        out: list[tuple] = []

        def flush():
            nonlocal held, length, at
            if held:
                out.append((conv, at, "".join(held)))
                at, held, length = at + 1, [], 0

        def done():
            got = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (typ, pa.int64(), pa.string()))], schema.names)
            out.clear()
            return got
        for b in batches:
            typ = b.schema.field("conv_id").type
            for c, k, f, n in zip(*(b.column(x).to_pylist() for x in ("conv_id", "kind", "fault", "n"))):
                if held and c != conv:
                    flush()
                conv = c
                held.append(symbol(k, f))
                length, n = length + 1, n - 1
                while n or length >= size:
                    if length >= size:
                        flush()
                        if len(out) >= 256:
                            yield done()
                    more = min(n, size - length)
                    if more:
                        held.append(symbol(k, GONE) * more)
                        length, n = length + more, n - more
            if out:
                yield done()
        flush()
        if out:
            yield done()
    return written(map_arrow(ranged, run, schema), "repair-segments")


# ---------------------------------------------------------------- grammar


def pairs(text: str) -> Iterator[str]:
    """Neighbouring symbols; of a run of one symbol, pairs that do not overlap."""
    last = ""
    for a, b in zip(text, text[1:]):
        p = a + b
        if a == b and last == p:
            last = ""
            continue
        last = p
        yield p


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got: Counter = Counter()  # at most one entry for each pair of symbols
    for b in batches:
        for s in b.column("now").to_pylist():
            got.update(pairs(s))
    if got:
        yield pa.RecordBatch.from_arrays([pa.array(list(got)), pa.array(list(got.values()), pa.int64())], ["pair", "n"])


def _replaced(rules: list[tuple[str, str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = "\n".join(b.column("now").to_pylist())
            for sym, x, y in rules:
                text = text.replace(x + y, sym)
            yield pa.RecordBatch.from_arrays([b.column("symbols"), pa.array(text.split("\n"), pa.string())],
                                             ["symbols", "now"])
    return run


def re_pair(strings: DataFrame, rules: int = RULES, rounds: int = ROUNDS) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """``(symbols, now)`` of the different strings, ``now`` in the symbols of the grammar, and its rules.

    A rule stands for a pair that occurs twice at least.  Pairs of one round cannot overlap: no symbol is the first
    of one and the second of another.
    """
    now = written(strings.select("symbols", F.col("symbols").alias("now")), "repair-strings")
    made: list[tuple[str, str, str]] = []
    for _ in range(rounds):
        top = (map_arrow(now.select("now"), _counted, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
               .where("n > 1").orderBy(F.desc("n"), "pair").limit(max(0, rules - len(made))).collect())
        firsts, seconds, new = set(), set(), []
        for r in top:
            a, b = r.pair
            if a not in seconds and b not in firsts and a != b or (a == b and a not in firsts | seconds):
                firsts.add(a)
                seconds.add(b)
                new.append((chr(RULE + len(made) + len(new)), a, b))
        if not new:
            break
        made += new
        now = written(map_arrow(now, _replaced(new), "symbols string, now string"), "repair-strings")
    return now, made


# ---------------------------------------------------------------- costs and audits

ENTRIES = "array<struct<p:int,q:int,cost:bigint,audit:string>>"
ENDS = ["first", "last", "illegal", "entries"]
KIND = f"symbols string, cost long, audit string, first string, last string, illegal long, entries {ENTRIES}"
ENTRY_TYPE = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
END_TYPES = [pa.string(), pa.string(), pa.int64(), ENTRY_TYPE]


def _matrix(entries: list[dict]) -> dict:
    out: dict = {p: {} for p in range(4)}
    for e in entries:
        out[e["p"]][e["q"]] = (e["cost"], e["audit"])
    return out


def _entries(m: dict) -> list[dict]:
    return [{"p": p, "q": q, "cost": c, "audit": spelled(r)} for p, row in m.items() for q, (c, r) in row.items()]


def _folded(parts: list[tuple[dict, tuple]]) -> tuple[dict, tuple]:
    m, ends = parts[0]
    for x, e in parts[1:]:
        m, ends = product(m, x), meet(ends, e)
    return m, ends


def _evaluated(known: dict[str, tuple[dict, tuple]]):
    """Cost, audit and matrix of every string from the matrices of its symbols."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["symbols", "cost", "audit", *ENDS]
        types = [pa.string(), pa.int64(), pa.string(), *END_TYPES]
        for b in batches:
            rows = []
            for full, now in zip(b.column("symbols").to_pylist(), b.column("now").to_pylist()):
                m, ends = _folded([known[c] for c in now])
                rows.append((full, *result(m[START]), *ends, _entries(m)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    return run


def _multiplied(part: pa.Table) -> pa.Table:
    """One row for some successive segments of a conversation."""
    part = part.sort_by("i")
    rows = part.select(ENDS).to_pylist()
    m, ends = _folded([(_matrix(r["entries"]), (r["first"], r["last"], r["illegal"])) for r in rows])
    values = [[v] for v in (*ends, _entries(m))]
    return pa.table([part.column("conv_id").slice(0, 1), part.column("g").slice(0, 1),
                     *[pa.array(v, t) for v, t in zip(values, END_TYPES)]], names=["conv_id", "i", *ENDS])


def _concluded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [result(_matrix(e)[START]) for e in b.column("entries").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), pa.array([c for c, _ in got], pa.int64()), pa.array([a for _, a in got], pa.string()),
             b.column("illegal")], ["conv_id", "cost", "audit", "illegal"])


def audits(rows: DataFrame, segment: int = SEGMENT, rules: int = RULES, fan: int = FAN) -> DataFrame:
    """``(conv_id, cost, audit, illegal)`` of every conversation that has rows; ``rows`` as ``judged`` gives them."""
    segs = segments(rows, segment)
    now, made = re_pair(segs.select("symbols").distinct(), rules)
    kinds = written(map_arrow(now, _evaluated(grammar_table(made)), KIND), "repair-kinds")
    per = Window.partitionBy("conv_id")
    numbered = segs.select("conv_id", "symbols", (F.row_number().over(per.orderBy("at")) - 1).cast("long").alias("i"),
                           F.count(F.lit(1)).over(per).alias("m"))
    numbered = written(numbered, "repair-numbered")
    single = numbered.where("m = 1").join(kinds, "symbols").select("conv_id", "cost", "audit", "illegal")
    parts = numbered.where("m > 1").join(kinds, "symbols").select("conv_id", "i", *ENDS)
    schema = parts.schema
    while True:
        parts = written(parts, "repair-parts")
        if not parts.agg(F.max("i")).first()[0]:
            break
        parts = (parts.withColumn("g", F.floor(F.col("i") / fan).cast("long")).groupBy("conv_id", "g")
                 .applyInArrow(_multiplied, schema))
    out = StructType([rows.schema["conv_id"]] + list(StructType.fromDDL("cost long, audit string, illegal long")))
    return written(single.unionByName(map_arrow(parts, _concluded, out)), "repair-audits")


# ---------------------------------------------------------------- repaired texts


class _Writer:
    """Digest of one conversation's repaired text, row by row along its audit."""

    def __init__(self, audit: bytes):
        self.audit, self.at, self.state, self.empty = audit, 0, START, True
        self.sha = hashlib.sha256()

    def _put(self, role: bytes, text: bytes) -> None:
        if not self.empty:
            self.sha.update(b"\n")
        self.empty = False
        self.sha.update(role + b":")
        self.sha.update(text)

    def _insert(self) -> None:
        while self.audit[self.at:self.at + 1] == b"I":
            self.at += 1
            self.state = NEXT[self.state]
            self._put(ROLES[self.state].encode(), b"")

    def row(self, role: bytes, text: bytes) -> None:
        self._insert()
        edit = self.audit[self.at:self.at + 1]
        self.at += 1
        if edit == b"K":
            self.state = kept_state(self.state, role[:1].decode("latin-1"))
            self._put(role, text)
        elif edit == b"R":
            self.state = NEXT[self.state]
            self._put(ROLES[self.state].encode(), text)

    def end(self) -> str:
        self._insert()
        return self.sha.hexdigest()


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)`` from the damaged rows (``damaged``) and the audits (``audits``).

    A conversation's audit comes before its rows in the sort; rows are streamed, copies are written as often as kept.
    """
    conv = rows.schema["conv_id"]
    texts = rows.where("n > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", _digest().alias("h"),
                                       F.col("text").cast("binary").alias("text"), F.col("n").cast("int").alias("n"))
    heads = found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
                         F.lit("").alias("role"), F.lit(b"").alias("h"), F.col("audit").cast("binary").alias("text"),
                         F.lit(0).alias("n"))
    both = (texts.unionByName(heads).repartition(partitions(rows.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", "kind", "turn", "role", "h")
            .select("conv_id", "kind", F.col("role").cast("binary").alias("role"), "text", "n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv_id, out = None, None, []
        for b in batches:
            typ = b.schema.field("conv_id").type
            for c, kind, role, text, n in zip(*(x.to_pylist() for x in b.columns)):
                if kind == 0:
                    if now:
                        out.append((conv_id, now.end()))
                    now, conv_id = _Writer(text), c
                for _ in range(n):
                    now.row(role, text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], typ), pa.array([x for _, x in out])],
                                                 ["conv_id", "repaired_sha256"])
                out = []
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([conv_id], typ), pa.array([now.end()])],
                                             ["conv_id", "repaired_sha256"])
    return map_arrow(both, run, StructType([conv, StructField("repaired_sha256", StringType())]))


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", segment: int = SEGMENT, rules: int = RULES, fan: int = FAN) -> DataFrame:
    """Per conversation id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    The rows are damaged first (``damaged``).  A null id is a conversation of its own; null roles and texts are one
    blank; null turns come first and count in no gap.  Rows of one turn go by role, then by the SHA-256 of their
    text, so copies are neighbours: the first of them may stay, the others are duplicates.  A conversation of which no
    row is left has zeros, an empty audit and the digest of the empty text.  An empty table gives no rows; other
    columns are ignored.
    """
    rows = damaged(conversations, conv, turn, role, text)
    faults = judged(rows)
    faults = written(faults, "repair-judged")
    found = audits(faults, segment, rules, fan)
    out = rows.select("conv_id").distinct()
    for more in (counts(faults), found, repaired(rows, found)):
        got = more.withColumnRenamed("conv_id", "__conv")
        out = out.join(got, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").drop("__conv")
    none = {**dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0), "audit": "",
            "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return out.select("conv_id", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in none.items()])


def op11_repair_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of the repaired text of every conversation."""
    return repair(table(spark, sf_dir, "conversations"))

"""Packing documents into token sequences by order-preserving dynamic programming.

The token ids of a partition's documents, each ended by ``END``, form one stream in stored order; a sequence is a
stretch of it of at most ``SIZE`` ids.  Cuts may lie at the end of a document, at the end of a sentence (cost
``SENTENCE``) or, ``STEP`` ids apart, inside a long sentence (cost ``INSIDE``); a sequence costs ``EACH`` and the ids
that fill it up to ``SIZE``, none if its length is a power of two.  The cheapest cuts are found by dynamic programming
over these places: the least cost before a place plus the place itself, over the last ``SIZE`` ids, is kept in a
monotone queue, and the lengths that need no filling are looked up one by one, so a place takes constant time.

Nothing is shuffled: each input partition is a stream of its own and ends with one sequence that may be filled.  A
stream is cut in stretches of ``STRETCH`` ids.  A stretch is cut as if it ended the stream, and its sequences are final
but for those near its end, which start the next stretch; so a task holds one stretch and one batch of texts.

Texts are split into words as the tokenizer splits them, and each different word is tokenised once, by a table that is
emptied when it holds more than ``WORDS_HELD``; the ids of a batch of texts are then looked up.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, table

SIZE = 2048
END = 1
SENTENCE = 1
INSIDE = 8
EACH = 2
STEP = 32
STRETCH = 1 << 20
TAIL = 16 * SIZE
WORDS_HELD = 1 << 19
#: Words after which a sentence ends: marks and closing quotes before a blank, or ends of pieces with odd characters.
LAST = "[.!?][\"')\\]]*[\\t-\\r ]$|[^ -~][\"')\\]]*[.!?][\"')\\]]*$|[。！？][\"')\\]]*$"
#: Letters of Latin-1 and Latin Extended-A whose lower-case form is one letter.
_LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017f"
SPACE = re.compile(r"[\t-\r ]+")
#: What is neither printable ASCII, ASCII white space nor one of these letters, or may start a special token.
ODD = re.compile(rf"[^\t-\r -~{_LETTERS}]|<\|")
#: The tokenizer's words in lower-case text without odd characters (fixed value: it must split as the tokenizer file
#: does); a word of punctuation takes one blank after it along, to tell the end of a sentence.
WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LETTERS}]+|[0-9]|[^\sa-z0-9{_LETTERS}]+[\t-\r ]?")
#: Bytes outside printable Latin-1 are shown by the characters from U+0100 on (the usual byte-level alphabet).
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
BYTES = {b: 256 + n for n, b in enumerate(_HIDDEN)}

COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
OUT = ", ".join(f"{c} long" for c in COLUMNS)


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def words(text: str, odd: set[str]) -> list[str]:
    """Pieces of ``text`` that are tokenised each by itself: words, and whole blank-free pieces with odd characters.

    The latter also go into ``odd``.  All that the tokenizer does to other text before its model is lower-casing and
    splitting (tested).
    """
    if not ODD.search(text):
        return WORD.findall(text.lower())
    out: list[str] = []
    for p in SPACE.split(text):
        if ODD.search(p):
            odd.add(p)
            out.append(p)
        else:
            out += WORD.findall(f"{p.lower()} ")
    return out


class Words:
    """Ids of texts, by a table of the words met so far."""

    def __init__(self, path: str, most: int = WORDS_HELD):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        self.odd: set[str] = set()
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.flat, self.begin = np.empty(0, np.uint32), np.empty(0, np.int64)
        self.count, self.ends = np.empty(0, np.int64), np.empty(0, bool)

    def places_of(self, words: pa.StringArray) -> np.ndarray:
        """Numbers of ``words`` (different ones) in the table; new ones are added."""
        if len(self.at) > self.most:
            self._clear()
        names = words.to_pylist()
        found = list(map(self.at.get, names))
        at = np.array([-1 if x is None else x for x in found], np.int64)
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            new = [names[i] for i in fresh.tolist()]
            at[fresh] = np.arange(len(self.at), len(self.at) + len(new))
            self.at.update(zip(new, at[fresh].tolist()))
            got, model = [], self.tokenizer.model.tokenize
            for w in new:
                if w in self.odd:
                    got.append(self.tokenizer.encode(w, add_special_tokens=False).ids)
                else:  # the model's alphabet has one character for each byte
                    w = w.rstrip()
                    got.append([t.id for t in model(w if w.isascii() else w.encode().decode("latin-1").translate(BYTES))])
            count = np.fromiter(map(len, got), np.int64, len(got))
            flat = np.fromiter(chain.from_iterable(got), np.uint32, int(count.sum()))
            ends = pc.match_substring_regex(words.take(pa.array(fresh)), LAST).to_numpy(zero_copy_only=False)
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(count) - count])
            self.count, self.ends = np.concatenate([self.count, count]), np.concatenate([self.ends, ends])
            self.flat = np.concatenate([self.flat, flat])
        return at

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, ``END`` after each; the ids of each text; the places after sentences (of all ids)."""
        self.odd.clear()
        lists = [words(t, self.odd) if t else [] for t in texts]
        coded = pa.array(list(chain.from_iterable(lists)), pa.string()).dictionary_encode()
        at = self.places_of(coded.dictionary)[coded.indices.to_numpy()]
        ends = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
        # Every text's ``END`` is a word of one id after its last word.
        count = np.insert(self.count[at], ends, 1)
        begin = np.insert(self.begin[at], ends, len(self.flat))
        stop = np.insert(self.ends[at], ends, False)
        after = np.cumsum(count)
        total = int(after[-1]) if len(after) else 0
        ids = np.append(self.flat, np.uint32(END))[np.repeat(begin - (after - count), count) + np.arange(total)]
        last = after[ends + np.arange(len(ends))]
        return ids, np.diff(last, prepend=0), np.unique(after[stop])


def places(last: np.ndarray, stops: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Where documents that end at ``last`` (ascending) may be cut, their ends included, and what each place costs."""
    end = last[-1] if len(last) else 0
    edge = np.union1d(last, stops[(stops > 0) & (stops < end)])
    ahead = np.concatenate([[0], edge[:-1]]) if len(edge) else edge
    inner = (edge - ahead - 1) // step
    nth = np.arange(int(inner.sum())) - np.repeat(np.cumsum(inner) - inner, inner) + 1
    at = np.concatenate([np.repeat(ahead, inner) + nth * step, edge]).astype(np.int64)
    cost = np.concatenate([np.full(len(nth), INSIDE), np.where(np.isin(edge, last), 0, SENTENCE)]).astype(np.int64)
    order = np.argsort(at, kind="stable")
    return at[order], cost[order]


def cuts(at: np.ndarray, cost: np.ndarray, size: int = SIZE, each: int = EACH) -> np.ndarray:
    """Indices into ``at`` of the cheapest cuts of the stream that starts at 0; the last place is always one.

    ``at`` ascends by gaps of at most ``size``.  Equal costs go to an unfilled last sequence, the longest of these.
    """
    where = np.concatenate([[0], at])
    pairs = []  # places that lie a power of two apart
    for k in range(size.bit_length()):
        if 1 << k <= size:
            i = np.searchsorted(where, where - (1 << k))
            j = np.flatnonzero(where[i] == where - (1 << k))
            pairs.append(np.stack([j, i[j]]))
    j, i = np.concatenate(pairs, axis=1)
    order = np.argsort(j, kind="stable")
    upto, exact = np.searchsorted(j[order], np.arange(len(where)), "right").tolist(), i[order].tolist()
    place, extra = where.tolist(), [0, *(cost + each).tolist()]
    least, back = [0], [0]
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (least + place, index), ascending
    for j in range(1, len(place)):
        p = place[j]
        while place[queue[0][1]] < p - size:
            queue.popleft()
        best, of = queue[0]
        best += size - p
        for i in exact[upto[j - 1]:upto[j]]:
            if least[i] <= best:
                best, of = least[i], i
        best += extra[j]
        least.append(best)
        back.append(of)
        best += p
        while queue and queue[-1][0] > best:
            queue.pop()
        queue.append((best, j))
    out, j = [], len(place) - 1
    while j:
        out.append(j - 1)
        j = back[j]
    return np.array(out[::-1], np.int64)


class Stream:
    """The documents of one partition; ``add`` and ``close`` give the pieces of finished sequences."""

    def __init__(self, partition: int, size: int = SIZE, stretch: int = STRETCH, tail: int = TAIL):
        self.size, self.stretch, self.tail = size, stretch, tail
        self.sequence = partition << 33
        self.docs: deque = deque()  # [id, ids, ids already packed]
        self.at, self.cost = np.empty(0, np.int64), np.empty(0, np.int64)
        self.held = 0

    def add(self, doc_ids: list, ids: np.ndarray, lengths: np.ndarray, stops: np.ndarray) -> Iterator[list[tuple]]:
        last = np.cumsum(lengths)
        self.docs.extend([d, ids[b - n:b], 0] for d, n, b in zip(doc_ids, lengths.tolist(), last.tolist()))
        at, cost = places(last, stops)
        done, first = 0, 0
        while first < len(at):
            upto = max(first + 1, int(np.searchsorted(at, done + self.stretch - self.held, "right")))
            self.at = np.concatenate([self.at, at[first:upto] - done + self.held])
            self.cost = np.concatenate([self.cost, cost[first:upto]])
            self.held += int(at[upto - 1]) - done
            done, first = int(at[upto - 1]), upto
            if first < len(at):
                yield self._pack(self.tail)

    def close(self) -> Iterator[list[tuple]]:
        if self.held:
            yield self._pack(0)

    def _pack(self, tail: int) -> list[tuple]:
        ends = self.at[cuts(self.at, self.cost, self.size)]
        keep = max(1, int(np.searchsorted(ends, self.held - tail, "right"))) if tail else len(ends)
        out, before = [], 0
        for end in ends[:keep].tolist():
            offset = 0
            while before + offset < end:
                doc = self.docs[0]
                doc_id, ids, start = doc
                n = min(len(ids) - start, end - before - offset)
                out.append((doc_id, start, n, zlib.crc32(ids[start:start + n].astype("<u4").tobytes()), len(ids),
                            self.sequence, offset))
                offset += n
                doc[2] = start + n
                if doc[2] == len(ids):
                    self.docs.popleft()
            self.sequence += 1
            before = end
        rest = self.at > before
        self.at, self.cost = self.at[rest] - before, self.cost[rest]
        self.held -= before
        return out


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, size: int = SIZE,
         stretch: int = STRETCH, tail: int = TAIL, most: int = WORDS_HELD) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``path`` names the tokenizer file (the same place on every executor).  Null and empty texts are a document of one
    id, ``END``; null ids keep their rows; repeated rows are documents of their own; an empty table gives no rows;
    other columns are ignored.  A document longer than ``size`` goes on in the next sequences.  Equal costs go to the
    longer last sequence, so reruns over the same partitions agree.
    """
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        known, stream = Words(path, most), Stream(TaskContext.get().partitionId(), size, stretch, tail)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], COLUMNS)
        for b in batches:
            for rows in stream.add(b.column("doc_id").to_pylist(), *known.ids(b.column("text").to_pylist())):
                yield batch(rows)
        for rows in stream.close():
            yield batch(rows)
    return map_arrow(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")),
                     run, OUT)


def op12_pack_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens over all documents."""
    return pack(table(spark, sf_dir, "documents"))

"""Language identification by rank-order profiles (out-of-place distance of the most frequent n-grams).

Texts are lower-cased, everything but letters becomes one space, and words count with a space at either end.
N-grams of one to three characters are packed into 64-bit codes.  A language's profile is the ``PROFILE`` most
frequent n-grams of all its training texts; a document's is that of its own text.  The distance to a language
adds up, over the document's profile, how many places each n-gram is out of place (``PROFILE`` places if the
language's profile lacks it); the nearest language wins, ties go to the first by name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import append, map_arrow, table

PROFILE = 400
UND = "und"
CHUNK = 1 << 20  # characters of a text that are counted at once
HELD = 300_000   # n-grams of a language that a task holds before it adds them up

_LETTERS: list = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter (built once a worker)."""
    if not _LETTERS:
        t = np.zeros(0x110000, bool)
        t[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        _LETTERS.append(t)
    return _LETTERS[0]


def _codes(lowered: str) -> np.ndarray:
    c = np.frombuffer(lowered.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    return np.where(_letters()[c], c, 32)


def _gram_parts(text: str, chunk: int) -> Iterator[np.ndarray]:
    """Packed n-grams of a text, part by part.

    A part starts with the last two characters of the one before, and its n-grams are those that end in what is new,
    so the parts together have exactly the n-grams of the whole.
    """
    lowered = text.lower()
    tail = np.array([32], np.int64)
    for i in range(0, len(lowered) + 1, chunk):
        new = _codes(lowered[i:i + chunk])
        if i + chunk > len(lowered):
            new = np.concatenate((new, [32]))
        c = np.concatenate((tail, new))
        c = np.concatenate((tail, c[len(tail):][(c[len(tail):] != 32) | (c[len(tail) - 1:-1] != 32)]))
        k = len(tail)
        one = c[k:][c[k:] != 32]
        two = (c[:-1] | c[1:] << 21)[k - 1:]
        three = (c[:-2] | c[1:-1] << 21 | c[2:] << 42)[max(0, k - 2):][c[1:-1][max(0, k - 2):] != 32]  # in one word
        yield np.concatenate((one, two, three))
        tail = c[-2:]


def counts(text: str | None, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text and their numbers, none without a letter; long texts are counted in parts."""
    parts = [np.unique(g, return_counts=True) for g in _gram_parts(text or "", chunk)]
    if len(parts) == 1:
        return parts[0]
    u, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return u, np.bincount(inv, np.concatenate([p[1] for p in parts]), len(u)).astype(np.int64)


def train(labelled: DataFrame, profile: int = PROFILE) -> dict[str, list[int]]:
    """Profiles by language from ``(text, lang)`` rows: packed n-grams, the most frequent first.

    Rows with a null text or language teach nothing.  Counts cover all rows: every task adds up its own by
    language before the shuffle.  What reaches the driver is ``profile`` n-grams a language.
    """
    def run(batches):
        held: dict[str, list] = {}

        def out(lang):
            parts = held.pop(lang)
            u, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(inv, np.concatenate([p[1] for p in parts]), len(u)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(u)), pa.array(u), pa.array(n)], ["lang", "code", "n"])
        sizes: dict[str, int] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = counts(text)
                held.setdefault(lang, []).append(got)
                sizes[lang] = sizes.get(lang, 0) + len(got[0])
                if sizes[lang] > HELD:
                    yield out(lang)
                    sizes[lang] = 0
        for lang in list(held):
            yield out(lang)

    known = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    n = map_arrow(known, run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    at = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    found: dict[str, list[int]] = {}
    for r in n.withColumn("at", at).where(F.col("at") <= profile).orderBy("lang", "at").collect():
        found.setdefault(r["lang"], []).append(r["code"])
    return found


class Ranker:
    """Scores texts against profiles; small (profile size times languages), so it travels with the task."""

    def __init__(self, profiles: dict[str, list[int]], profile: int = PROFILE):
        self.langs, self.most = sorted(profiles), profile
        self.codes = np.unique(np.array([c for v in profiles.values() for c in v], np.int64))
        self.rank = np.full((len(self.langs), len(self.codes) + 1), -1, np.int64)
        for i, name in enumerate(self.langs):
            self.rank[i, np.searchsorted(self.codes, profiles[name])] = np.arange(len(profiles[name]))

    def __call__(self, text: str | None) -> tuple[str, float]:
        code, n = counts(text)
        if not len(code) or not self.langs:
            return UND, 0.0
        top = np.lexsort((code, -n))[:self.most]
        at = np.searchsorted(self.codes, code[top])
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == code[top][known]
        rank = self.rank[:, np.where(known, at, len(self.codes))]
        far = np.where(rank < 0, self.most, np.abs(rank - np.arange(len(top))))
        near = 1.0 - far.sum(1) / (self.most * len(top))
        best = int(np.argmax(near))
        return self.langs[best], float(near[best] / near.sum()) if near.sum() > 0 else 0.0


def identify(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text",
             out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with two more columns: the predicted language and the winner's share of all likenesses (0 to 1).

    ``und`` and 0 for a null text or one without letters (and without any profile).  Every row stays, repeated
    rows too; an existing column of the same name is replaced.
    """
    ranker = Ranker(profiles)
    return append(docs, text, f"{out[0]} string, {out[1]} double",
                  lambda: lambda texts: [list(x) for x in zip(*map(ranker, texts))] if texts else [[], []])


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned(docs: DataFrame, profile: int = PROFILE) -> dict[str, list[int]]:
    """Profiles from the rows of ``docs`` that are not held out."""
    return train(docs.where(~held_out()).select("text", "lang"), profile)


def op7_langid_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, profiles learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = identify(docs.select("doc_id", held_out().alias("held_out"), "text"), learned(docs))
    return out.select("doc_id", "held_out", "lang_pred", "score")

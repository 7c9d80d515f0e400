"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, compatibility forms (full-width, circled,
mathematical letters) and Latin letters of any shape to plain ones by their Unicode
properties, look-alikes of other scripts to Latin, accents off, digits and signs that
stand for letters, in words that have letters, to those letters, everything else to
blanks. The lexicon has whole words and word
beginnings, each with its log odds of occurring in toxic against clean documents;
phrases of two words in which a listed word is harmless are exceptions and cancel it.
A text's score is the logistic of its summed weights per word (and in all), so long
texts are not toxic by length alone.

``fit`` learns all of this from a bounded sample of labelled documents: at most
``SAMPLE`` of them, those with the smallest hashes of their ids, one text each. All
terms of the sample that pass ``MIN_WEIGHT`` and ``MIN_Z`` are in the lexicon, and all
phrases that pass theirs are exceptions. Everything else - scoring - reads every text
whole, once.

Defined results: null, empty and blank texts have no words and get the score of a
text without any match; without labels of both kinds the lexicon is empty and all
scores equal the share of toxic labels (0 without any); repeated and contradictory
labels of a document count as toxic if one says so; of several texts of a labelled id
the one of the smallest hash is learned from; rows repeat as they stand; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SAMPLE = 20_000    # labelled documents that ``fit`` reads at most
PREFIX = range(4, 9)  # lengths of word beginnings that can be entries
MIN_WEIGHT, MIN_Z = 1.5, 4.0

# Look-alikes of Latin letters, and signs that stand for letters.
LOOK_ALIKE = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s",
              "ј": "j", "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "г": "r",
              "α": "a", "ο": "o", "ε": "e", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x",
              "ı": "i", "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ł": "l"}
DIGITS = {"0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
          "@": "a", "$": "s", "€": "e", "+": "t"}

# A Latin letter of another shape says so in its name: small capitals, script, turned, with hook.
_LATIN = re.compile(r"LATIN (?:CAPITAL |SMALL )?LETTER (?:SMALL CAPITAL |SCRIPT |OPEN |TURNED |REVERSED |DOTLESS |LONG |INSULAR )*"
                    r"([A-Z])(?: WITH .*)?")
_BEFORE_LETTER = re.compile(r"[!|](?=[^\W\d_])")  # an exclamation mark or bar for an i
_NO_LETTER = re.compile(rf"(?<!\S)[{re.escape(''.join(DIGITS))}]+(?!\S)")


def _plain(c: str) -> str:
    """What one lower-case character stands for; signs that may be letters stay."""
    if c in LOOK_ALIKE:
        return LOOK_ALIKE[c]
    if c in DIGITS:
        return c
    kind = unicodedata.category(c)
    if kind[0] == "M" or kind == "Cf":  # accents, and what is not seen
        return ""
    if kind[0] != "L":
        return " "
    name = _LATIN.fullmatch(unicodedata.name(c, ""))
    return name[1].lower() if name else c


class _Folded(dict):
    """Folding by code point, worked out when a character is first met."""

    def __missing__(self, c: int) -> str:
        parts = [chr(c)] if chr(c) in LOOK_ALIKE else unicodedata.normalize("NFKD", chr(c).lower())
        self[c] = "".join(map(_plain, "".join(parts).lower()))
        return self[c]


FOLD = _Folded()
LETTERS = str.maketrans(DIGITS)


def fold(text: str) -> str:
    """Folded words with one blank between and around them."""
    text = _BEFORE_LETTER.sub("i", text.lower()).translate(FOLD)
    return " " + " ".join(_NO_LETTER.sub(" ", text).translate(LETTERS).split()) + " "


@dataclass(frozen=True)
class Model:
    """Entries (" word " or " begin") with weights, exceptions (" one two "), and the
    logistic's coefficients (constant, per word, in all)."""
    weights: dict[str, float]
    exceptions: tuple[str, ...]
    coefficients: tuple[float, float, float]

    def automaton(self):
        a = ahocorasick.Automaton()
        for k, w in self.weights.items():
            a.add_word(k, (len(k), w))
        for k in self.exceptions:
            a.add_word(k, (len(k), None))
        if len(a):
            a.make_automaton()
        return a


def _hits(automaton, folded: str) -> dict[int, float]:
    """Weight of each matched word, by the place where it begins: that of its
    heaviest entry, none inside an exception phrase."""
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (size, w) in automaton.iter(folded):
        start = end - size + 1
        if w is None:
            spared.append((start, end))
        elif w > best.get(start, 0.0):
            best[start] = w
    for start, end in spared:
        for at in range(start, end):
            best.pop(at, None)
    return best


def _features(automaton, text: str) -> tuple[float, float]:
    folded = fold(text)
    total = sum(_hits(automaton, folded).values()) if len(automaton) else 0.0
    return float(np.log1p(100 * total / max(1, folded.count(" ") - 1))), float(np.log1p(total))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients by Newton's method; the constant is not shrunk."""
    x = np.column_stack((np.ones(len(x)), x))
    c = np.zeros(x.shape[1])
    penalty = np.diag([1e-6, *[ridge * len(x) / 100] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ c)
        c += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return c


def sample_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """``_id, _y`` of at most SAMPLE labelled documents."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    rows = rows.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_y"))
    return rows.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Learns the lexicon, its exceptions and the score from labelled documents."""
    picked = sample_labels(labels, id_col, label_col)
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # an id that comes a million times is one text: picked before the shuffle and after it
    sample = stored(texts.join(F.broadcast(picked), "_id").groupBy("_id").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"), F.max("_y").alias("_y")).drop("_id"), "toxicity-sample")
    n = {r["_y"]: r["n"] for r in sample.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        share = toxic / max(1, toxic + clean)
        return Model({}, (), (float(np.log((share + 1e-6) / (1 - share + 1e-6))), 0.0, 0.0))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = set(fold(text or "").split())
                found = {f" {w} " for w in words if len(w) > 2}
                found.update(f" {w[:k]}" for w in words for k in PREFIX if len(w) >= k)
                yield pa.record_batch([pa.array(list(found), pa.string()), pa.array([y] * len(found), pa.int32())],
                                      names=["term", "y"])

    def odds(t, c):
        return F.log((t + 0.5) / (toxic + 1)) - F.log((c + 0.5) / (clean + 1))

    counted = (sample.mapInArrow(terms, "term string, y int").groupBy("term")
               .agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
               .withColumn("w", odds(F.col("t"), F.col("c")))
               .withColumn("z", F.col("w") / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))))
    # Terms of the sample only, each in several of its texts: bounded by SAMPLE.
    lexicon = counted.where((F.col("w") >= MIN_WEIGHT) & (F.col("z") >= MIN_Z))
    weights = {r["term"]: r["w"] for r in sorted(lexicon.collect(), key=lambda r: r["term"])}
    first = Model(weights, (), (0.0, 0.0, 0.0))

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = first.automaton()
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                folded, found = fold(text or ""), set()
                for at in _hits(automaton, folded) if len(automaton) else ():
                    end = folded.index(" ", at + 1)
                    if at:
                        found.add(folded[folded.rindex(" ", 0, at):end + 1])
                    if end + 1 < len(folded):
                        found.add(folded[at:folded.index(" ", end + 1) + 1])
                yield pa.record_batch([pa.array(list(found), pa.string()), pa.array([y] * len(found), pa.int32())],
                                      names=["phrase", "y"])

    harmless = (sample.mapInArrow(phrases, "phrase string, y int").groupBy("phrase")
                .agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
                .where((F.col("c") >= 3) & (odds(F.col("t"), F.col("c")) <= -MIN_WEIGHT)))
    second = Model(weights, tuple(sorted(r["phrase"] for r in harmless.collect())), (0.0, 0.0, 0.0))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = second.automaton()
        for b in batches:
            x = [_features(automaton, t or "") for t in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array([a for a, _ in x], pa.float64()), pa.array([c for _, c in x], pa.float64()),
                                   b.column(1)], names=["a", "b", "y"])

    # At most SAMPLE rows of three numbers; sorted, so that reruns agree.
    rows = sorted((r["a"], r["b"], r["y"]) for r in
                  sample.mapInArrow(measured, "a double, b double, y int").collect())
    data = np.array(rows)
    c = _logistic(data[:, :2], data[:, 2])
    return Model(second.weights, second.exceptions, tuple(map(float, c)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``score``, 0 to 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        k0, k1, k2 = model.coefficients
        for b in batches:
            x = [_features(automaton, t or "") for t in b.column(1).to_pylist()]
            s = [1 / (1 + np.exp(-min(30.0, max(-30.0, k0 + k1 * p + k2 * q)))) for p, q in x]
            yield pa.record_batch([b.column(0), pa.array(s, pa.float64())], names=[id_col, "score"])

    read = docs.select(F.col(id_col), F.col(text_col))
    kind = read.schema[0].dataType.simpleString()
    return read.mapInArrow(run, f"`{id_col}` {kind}, score double")


def held_out(id_col: str = "doc_id") -> F.Column:
    """Documents whose labels are never learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0

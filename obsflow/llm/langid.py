"""Language identification of mixed-language text.

Script ranges narrow the candidates of each word, a hashed character n-gram
model scores the word for every candidate, and Viterbi with a penalty for
switching labels the words, so spans of several languages come apart.  A text's
language is the one whose spans hold most of its letters; the score is that
share of the letters.

The model has ``BUCKETS`` counts a language and is summed by Spark from all
training rows; what reaches the driver is bounded by languages x BUCKETS rows,
whatever the input.

Defined results: null text and text without a letter get ``und`` and score 0;
without any training row every text does.  Repeated rows are labelled one by
one.  Rows with a null id are never held out and never learned from.  Other
columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import cuts
from .common import id_mod, release, small_batches, table

BUCKETS = 1 << 15
ORDERS = (1, 2, 3, 4)
#: Added to each count.
SMOOTH = 0.5
#: Natural log of the odds against a change of language between two words.
SWITCH = 12.0
#: A language writes in a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01
#: What a word's score for a language that doesn't write in its script is below
#: the best of those that do.
FOREIGN = -60.0
#: Rows handled at a time; bounds a worker's memory.
ROWS = 256

#: First code points of blocks and the script of their letters.
SCRIPTS = (
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"), (0x0B00, "Odia"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Burmese"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"),
    (0xA000, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"),
    (0xFB50, "Arabic"), (0xFE20, "Other"), (0xFE70, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"),
    (0x10000, "Other"), (0x20000, "Han"), (0x32000, "Other"),
)
NAMES = tuple(dict.fromkeys(name for _, name in SCRIPTS))


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point whether it is a letter, and its script's number."""
    alpha = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    script = np.zeros(0x110000, np.int8)
    for start, name in SCRIPTS:
        script[start:] = NAMES.index(name)
    return alpha, script


@dataclass
class Grams:
    """n-grams of a list of words: bucket and word of each, and the words'
    number of letters and script (of the first letter; -1 without letters)."""

    bucket: np.ndarray
    word: np.ndarray
    n_letters: np.ndarray
    script: np.ndarray


def grams(words: list[str]) -> Grams:
    """The hashed n-grams of the letters of each word, its ends marked."""
    alpha, script = _letters()
    cp = np.frombuffer((" " + " ".join(words) + " ").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    cp = cp[alpha[cp] | (cp == 32)].astype(np.uint64)
    end = cp == 32
    of = np.cumsum(end) - 1
    n_letters = np.bincount(of[~end], minlength=len(words))
    kind = np.full(len(words), -1, np.int8)
    starts = np.nonzero(end[:-1] & ~end[1:])[0]
    kind[of[starts]] = script[cp[starts + 1].astype(np.int64)]
    h = np.zeros(len(cp), np.uint64)
    inner = np.ones(len(cp), bool)  # no border strictly inside the n-gram
    buckets, owners = [], []
    for n in range(1, max(ORDERS) + 1):
        h = h[: len(cp) - n + 1] * np.uint64(0x100000001B3) + cp[n - 1 :]
        if n > 2:
            inner = inner[: len(cp) - n + 1] & ~end[n - 2 : len(cp) - 1]
        ok = inner[: len(cp) - n + 1] & ~(end[: len(cp) - n + 1] & (end[n - 1 :] if n < 3 else False))
        if n in ORDERS:
            mixed = (h[ok] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            buckets.append((mixed >> np.uint64(64 - 15)).astype(np.int32))
            owners.append(of[: len(cp) - n + 1][ok])
    return Grams(np.concatenate(buckets), np.concatenate(owners), n_letters, kind)


def _words(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(word number at each place, distinct words, where each text's words end)."""
    parts = pc.utf8_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    coded = parts.flatten().dictionary_encode()
    begin = parts.offsets.to_numpy()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist(), begin - begin[0]


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray  # language x bucket
    writes: np.ndarray  # language x script

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(word x language, letters of each word); 0 for words without letters."""
        g = grams(words)
        out = np.stack([np.bincount(g.word, weights=row[g.bucket], minlength=len(words)) for row in self.logp], 1)
        known = self.writes[:, g.script].T & (g.script >= 0)[:, None]
        best = np.where(known, out, -np.inf).max(1, keepdims=True)
        out = np.where(~known & known.any(1)[:, None], best + FOREIGN, out)
        out[g.n_letters == 0] = 0
        return out - out.max(1, keepdims=True), g.n_letters


def viterbi(scores: np.ndarray, code: np.ndarray, begin: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language number of every word.  scores: distinct word x language;
    code: the distinct word at each place; begin: where each text begins.

    All texts advance together, a word at a time, longest first.
    """
    n = np.diff(begin)
    order = np.argsort(-n, kind="stable")
    n_sorted = n[order]
    steps = int(n_sorted[0]) if len(n_sorted) else 0
    active = np.searchsorted(-n_sorted, -np.arange(steps), side="left")  # texts longer than t
    at = begin[:-1][order]
    stay = np.empty((len(code), scores.shape[1]), bool)
    best = np.empty(len(code), np.int16)
    place = np.cumsum(active) - active
    total = np.zeros((len(n), scores.shape[1]))
    for t in range(steps):
        k = active[t]
        before = total[:k]
        top = before.argmax(1)
        jump = before[np.arange(k), top] - switch
        keep = before >= jump[:, None]
        rows = slice(place[t], place[t] + k)
        stay[rows], best[rows] = keep, top
        total[:k] = np.where(keep, before, jump[:, None]) + scores[code[at[:k] + t]]
    out = np.empty(len(code), np.int16)
    state = total.argmax(1)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        now = state[:k]
        out[at[:k] + t] = now
        rows = slice(place[t], place[t] + k)
        state[:k] = np.where(stay[rows][np.arange(k), now], now, best[rows])
    return out


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from all rows with text and a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts.forget()
        counts: dict[str, np.ndarray] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                code, words, begin = _words(b.column(0))
                g = grams(words) if words else None
                lang = np.array(b.column(1).to_pylist(), object)
                owner = np.repeat(lang, np.diff(begin))
                for name in dict.fromkeys(owner.tolist()):
                    own = np.bincount(code[owner == name], minlength=len(words))
                    there = g.script >= 0
                    c = counts.setdefault(name, np.zeros(BUCKETS + len(NAMES)))
                    c[:BUCKETS] += np.bincount(g.bucket, weights=own[g.word], minlength=BUCKETS)
                    c[BUCKETS:] += np.bincount(g.script[there], weights=(own * g.n_letters)[there], minlength=len(NAMES))
        for name, c in counts.items():
            k = np.nonzero(c)[0]
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(k)), pa.array(k.astype(np.int32)), pa.array(c[k].astype(np.int64))], names=["lang", "bucket", "n"])

    rows = df.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text is not null and lang is not null")
    summed = rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    with small_batches(df.sparkSession):
        got = summed.toPandas()  # at most languages x (BUCKETS + scripts) rows
    languages = sorted(got["lang"].unique().tolist())
    count = np.zeros((len(languages), BUCKETS + len(NAMES)))
    count[np.searchsorted(languages, got["lang"].to_numpy().astype(str)) if len(got) else [], got["bucket"].to_numpy().astype(int)] = got["n"].to_numpy().astype(float)
    c, s = count[:, :BUCKETS] + SMOOTH, count[:, BUCKETS:]
    return Model(languages, np.log(c / c.sum(1, keepdims=True)), s >= SCRIPT_SHARE * s.sum(1, keepdims=True) + (s == 0))


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and n_spans, the number of language spans."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays([b.column(0), *_label(b.column(1), m)], names=["doc_id", "lang_pred", "score", "n_spans"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, n_spans long")


def _label(texts: pa.Array, m: Model) -> list[pa.Array]:
    code, words, begin = _words(texts)
    n, k = len(texts), len(m.languages)
    letters = np.zeros((n, max(k, 1)))
    spans = np.zeros(n, np.int64)
    if k and words:
        scores, n_letters = m.word_scores(words)
        lang = viterbi(scores, code, begin)
        owner = np.repeat(np.arange(n), np.diff(begin))
        letters = np.bincount(owner * k + lang, weights=n_letters[code], minlength=n * k).reshape(n, k)
        changed = np.ones(len(lang), bool)
        changed[1:] = (lang[1:] != lang[:-1]) | (owner[1:] != owner[:-1])
        spans = np.bincount(owner[changed], minlength=n)
    total = letters.sum(1)
    top = letters.argmax(1)
    score = np.divide(letters[np.arange(n), top], total, out=np.zeros(n), where=total > 0)
    names = np.array(m.languages or ["und"], object)
    spans[total == 0] = 0
    return [pa.array(np.where(total > 0, names[top], "und").tolist(), pa.string()), pa.array(score), pa.array(spans)]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(id_mod(doc_id, 5) == 0, F.lit(False))


def training_rows(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return df.filter(id_mod(F.col(id_col), 5) != 0)


def filter_documents(df: DataFrame, least_score: float = 0.3) -> DataFrame:
    """The rows of ``df`` with a language that holds at least ``least_score`` of
    their letters, with all their columns; learned from ``df`` itself."""
    shared = df.sparkSession.sparkContext.broadcast(fit(training_rows(df)))

    # Only texts go to Python and only verdicts come back.
    @F.arrow_udf("boolean")
    def keeps(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cuts.forget()
        for texts in batches:
            verdicts = []
            for at in range(0, len(texts), ROWS):
                lang, score, _ = _label(texts.slice(at, ROWS), shared.value)
                verdicts.append(pc.and_(pc.not_equal(lang, "und"), pc.greater_equal(score, least_score)))
            yield pa.concat_arrays(verdicts) if verdicts else pa.array([], pa.bool_())
            pa.default_memory_pool().release_unused()
        release()

    return df.filter(keeps(F.col("text")))


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = predict(docs, fit(training_rows(docs)))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_spans")

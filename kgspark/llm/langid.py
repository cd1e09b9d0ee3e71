"""Language identification: scripts narrow the candidates, Viterbi labels spans of words.

Training counts hashed character n-grams (1 to ``MAX_GRAM`` characters of each word with its two
borders) per language over all labelled training rows; the counts are a table of
``BUCKETS`` x languages, whatever the corpus size, summed map-side before one small shuffle. A
word's score in a language is the mean over its n-grams of log((count + a) / (total + a * BUCKETS)).

A word's candidates are the languages that training saw in the word's script (by code-point
range; all languages if none was seen in it). Per document, Viterbi over the words' scores with a
penalty for each switch of language gives spans; words without letters take the label around them.
The document's language is the one with most letters in its spans, ties to the smaller name. The
score is the share of the document's letters in spans of that language, times the posterior of the
language among the candidates in these spans, so it lies in 0..1.

Defined cases: null text, no letters, or no labelled training row: ``und`` with score 0 and no
spans; null ``lang`` rows are not learned from; repeated rows count as often as they occur; texts
of any length are labelled whole; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, kept, small_batches, slices

MAX_GRAM = 4
BUCKETS = 1 << 17
ALPHA = 0.1
#: Cost of a change of language, in units of a word's mean log score.
SWITCH = 4.0
UNDETERMINED = "und"
#: First code point of each script range and the script's number (fixed values; 0: no letters of
#: a script, 1: Latin, 2: Greek, 3: Cyrillic, 4: Armenian, 5: Hebrew, 6: Arabic, 7: Indic,
#: 8: Thai and Lao, 9: Tibetan and Burmese, 10: Georgian, 11: Hangul, 12: Ethiopic, 13: Khmer,
#: 14: Mongolian, 15: kana, 16: Han, 17: other).
RANGES = [(0x0000, 0), (0x0041, 1), (0x005B, 0), (0x0061, 1), (0x007B, 0), (0x00AA, 1), (0x00AB, 0),
          (0x00B5, 1), (0x00B6, 0), (0x00BA, 1), (0x00BB, 0), (0x00C0, 1), (0x00D7, 0), (0x00D8, 1),
          (0x00F7, 0), (0x00F8, 1), (0x0300, 0),
          (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0900, 7),
          (0x0E00, 8), (0x0F00, 9), (0x10A0, 10), (0x1100, 11), (0x1200, 12), (0x13A0, 17),
          (0x1780, 13), (0x1800, 14), (0x18B0, 17), (0x1E00, 1), (0x1F00, 2), (0x2000, 0),
          (0x3040, 15), (0x3100, 16), (0x3130, 11), (0x3190, 16), (0xA000, 17), (0xAC00, 11),
          (0xD7B0, 17), (0xF900, 16), (0xFB00, 1), (0xFB07, 17), (0xFE00, 0), (0xFE70, 6),
          (0xFF00, 0), (0xFF21, 1), (0xFF3B, 0), (0xFF41, 1), (0xFF5B, 15), (0xFFE0, 0),
          (0x10000, 17), (0x1F000, 0), (0x20000, 16), (0xE0000, 0)]
_STARTS = np.array([a for a, _ in RANGES])
_SCRIPTS = np.array([s for _, s in RANGES], np.int8)
SCRIPTS = 18
#: Most words whose scores a Python worker remembers, and that training holds before counting them.
MOST_WORDS = 300_000
#: Words whose n-grams are looked up at once.
STEP_WORDS = 40_000
#: Words labelled side by side.
GROUP_WORDS = 1_000_000
#: Multipliers of the n-gram hash, one per position (odd 64-bit constants of a generator).
_MULTIPLY = np.random.default_rng(11).integers(1, 1 << 62, MAX_GRAM, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Words:
    """Distinct lower-case words as code points, for work on all of them at once. Only letters
    count; a word's script is that of most of its letters (0: none)."""

    def __init__(self, words: list[str]):
        self.n = len(words)
        joined = "\x02" + "\x03\x02".join(words) + "\x03"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        script = _SCRIPTS[np.searchsorted(_STARTS, points, side="right") - 1]
        word = np.cumsum(points == 2) - 1
        if int(word[-1]) != self.n - 1:  # a word holds control characters: borders by length
            size = np.array([len(w) + 2 for w in words])
            word = np.repeat(np.arange(self.n), size)
            script[points < 4] = 0
        seen = np.bincount(word * SCRIPTS + script, minlength=self.n * SCRIPTS).reshape(self.n, SCRIPTS)
        seen[:, 0] = 0
        self.letters = seen.sum(axis=1)
        self.script = seen.argmax(axis=1)
        border = np.zeros(len(points), bool)
        border[np.flatnonzero(np.r_[True, word[1:] != word[:-1]])] = True
        border[np.flatnonzero(np.r_[word[1:] != word[:-1], True])] = True
        keep = (script > 0) | border
        self.points, self.word = np.where(border, 1, points)[keep], word[keep]

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, bucket) of every n-gram; none crosses a word's border."""
        words, buckets = [], []
        key = np.zeros(len(self.points), np.uint64)
        for n in range(1, MAX_GRAM + 1):
            m = len(self.points) - n + 1
            if m <= 0:
                break
            key = key[:m] * np.uint64(0x9E3779B97F4A7C15) + (self.points[n - 1:].astype(np.uint64) + np.uint64(n)) * _MULTIPLY[n - 1]
            inside = self.word[:m] == self.word[n - 1:]
            if n == 1:
                inside &= self.points > 1
            words.append(self.word[:m][inside])
            buckets.append((key[inside] >> np.uint64(64 - 17)).astype(np.int64))
        return np.concatenate(words), np.concatenate(buckets)


def _split(batch: pa.RecordBatch) -> list[list[str]]:
    """Lower-case words between white space, per text."""
    return [(t or "").lower().split() for t in batch.column("text").to_pylist()]


class Model:
    """Log scores per n-gram and language, and the languages of each script."""

    def __init__(self, langs: list[str], counts: np.ndarray, by_script: np.ndarray):
        self.langs = langs
        total = counts.sum(axis=0)
        self.table = (np.log(counts + ALPHA) - np.log(total + ALPHA * BUCKETS)).astype(np.float32)
        none = by_script.sum(axis=1, keepdims=True) == 0
        self.candidates = (by_script > 0) | none

    def scores(self, words: Words) -> np.ndarray:
        """Mean log score per word and language; -inf outside the word's candidates."""
        if not self.langs:
            return np.zeros((words.n, 0), np.float32)
        at, buckets = words.grams()
        n = np.maximum(np.bincount(at, minlength=words.n), 1)
        out = np.stack([np.bincount(at, self.table[buckets, k], words.n) / n
                        for k in range(len(self.langs))], axis=1).astype(np.float32)
        out[~self.candidates[words.script]] = -np.inf
        out[words.script == 0] = 0.0  # words without letters say nothing
        return out


def train(docs: DataFrame) -> Model:
    """Model from all rows of ``text``, ``lang`` with a language. Only the table of ``BUCKETS``
    counts per language and the script counts reach the driver."""
    small_batches(docs.sparkSession)
    rows = docs.where("lang is not null").select("text", "lang")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept()
        tables: dict[str, np.ndarray] = {}
        held: dict[str, Counter] = {}

        def add(lang: str) -> None:
            every, counts = list(held[lang]), np.fromiter(held[lang].values(), np.int64)
            table = tables.setdefault(lang, np.zeros(BUCKETS + SCRIPTS, np.int64))
            for i in range(0, len(every), STEP_WORDS):
                words, times = Words(every[i:i + STEP_WORDS]), counts[i:i + STEP_WORDS]
                at, bucket = words.grams()
                table[:BUCKETS] += np.bincount(bucket, times[at], BUCKETS).astype(np.int64)
                table[BUCKETS:] += np.bincount(words.script, times * words.letters, SCRIPTS).astype(np.int64)
            held[lang].clear()

        for batch in slices(batches, "text"):
            for lang, words in zip(batch.column("lang").to_pylist(), _split(batch)):
                held.setdefault(lang, Counter()).update(words)
            if sum(map(len, held.values())) > MOST_WORDS:
                for lang in [k for k in held if held[k]]:
                    add(lang)
        for lang in [k for k in held if held[k]]:
            add(lang)
        for lang, table in tables.items():
            some = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some)), pa.array(some, pa.int32()), pa.array(table[some])],
                ["lang", "slot", "n"])
        del tables, held
        give_back()

    total = (rows.mapInArrow(count, "lang string, slot int, n bigint")
             .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(total["lang"].unique())
    counts = np.zeros((BUCKETS + SCRIPTS, len(langs)), np.int64)
    for k, lang in enumerate(langs):
        mine = total[total["lang"] == lang]
        counts[mine["slot"].to_numpy(), k] = mine["n"].to_numpy()
    by_script = counts[BUCKETS:].astype(float)
    if langs:  # a language belongs to a script with one letter in a thousand or more
        by_script[by_script < 0.001 * np.maximum(by_script.sum(axis=0), 1)] = 0
    return Model(langs, counts[:BUCKETS], by_script)


def viterbi(scores: np.ndarray, counts: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of every word; documents of ``counts`` words stand one after the other and are
    processed side by side, longest first, one word each per step."""
    n_lang = scores.shape[1]
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    sizes = counts[order]
    back = np.zeros((len(scores), n_lang), np.int8 if n_lang < 128 else np.int16)
    best = np.zeros((len(order), n_lang), np.float32)
    own = np.arange(n_lang)
    steps = int(sizes[0]) if len(sizes) else 0
    active = len(order) - np.searchsorted(sizes[::-1], np.arange(steps), side="right")
    for t in range(steps):
        k = active[t]
        here = best[:k]
        top = here.argmax(axis=1)
        peak = here[np.arange(k), top][:, None] - switch
        jump = here < peak
        at = starts[:k] + t
        back[at] = np.where(jump, top[:, None], own)
        here = np.where(jump, peak, here) + scores[at]
        best[:k] = here - here.max(axis=1, keepdims=True)
    labels = np.zeros(len(scores), np.int16)
    state = best.argmax(axis=1) if len(order) else np.zeros(0, np.int64)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = starts[:k] + t
        labels[at] = state[:k]
        state[:k] = back[at, state[:k]]
    return labels


class Scores:
    """Scores and letters of words; each distinct word is scored once, in a table of bounded size."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.langs)), np.float32)
        self.letters = np.zeros(0, np.int32)

    def of(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Rows for all words of all texts, one after the other."""
        new = [w for w in dict.fromkeys(chain.from_iterable(texts)) if w not in self.index]
        if self.index and len(self.index) + len(new) > MOST_WORDS:
            self._clear()
            new = list(dict.fromkeys(chain.from_iterable(texts)))
        if new:
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            for i in range(0, len(new), STEP_WORDS):
                words = Words(new[i:i + STEP_WORDS])
                self.scores = np.concatenate([self.scores, self.model.scores(words)])
                self.letters = np.concatenate([self.letters, words.letters.astype(np.int32)])
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(texts)), np.int64)
        return self.scores[at], self.letters[at]


def _labelled(group: list[tuple], model: Model, spans: bool) -> pa.RecordBatch:
    """Labels of a group of batches, as one batch in the same order."""
    rest = [g[0] for g in group]
    counts, by_word, letters, few = (np.concatenate([g[i] for g in group]) for i in range(1, 5))
    group.clear()
    n_docs, n_lang = len(counts), len(model.langs)
    pred, score, runs = [UNDETERMINED] * n_docs, np.zeros(n_docs), [[] for _ in range(n_docs)]
    if n_lang:
        labels = viterbi(by_word, counts)
        doc = np.repeat(np.arange(n_docs, dtype=np.int32), counts)
        share = np.bincount(doc.astype(np.int64) * n_lang + labels, letters, n_docs * n_lang).reshape(n_docs, n_lang)
        total, top = share.sum(axis=1), share.argmax(axis=1)
        # posterior of the document's language over the words of its own spans; words of one
        # text are far from independent, hence the root
        mine = labels == top[doc]
        n = np.sqrt(np.maximum(np.bincount(doc[mine], minlength=n_docs), 1))
        mean = np.stack([np.bincount(doc[mine], np.maximum(by_word[mine, k], -50.0), n_docs) / n
                         for k in range(n_lang)], axis=1)
        posterior = np.exp(mean - mean.max(axis=1, keepdims=True))
        posterior /= posterior.sum(axis=1, keepdims=True)
        every = np.arange(n_docs)
        score = np.where(few, 0.0, share[every, top] / np.maximum(total, 1) * posterior[every, top])
        score = np.where((total == 0) & ~few, 1 / n_lang, score)  # letters of no known range
        pred = [UNDETERMINED if f else model.langs[k] for k, f in zip(top.tolist(), few.tolist())]
        if spans:
            edge = np.flatnonzero(np.r_[True, (labels[1:] != labels[:-1]) | (doc[1:] != doc[:-1])][:len(doc)])
            first = (np.cumsum(counts) - counts)[doc[edge]]
            sizes = np.diff(np.append(edge, len(doc)))
            for d, k, a, n in zip(doc[edge].tolist(), labels[edge].tolist(), (edge - first).tolist(), sizes.tolist()):
                if not few[d]:
                    runs[d].append({"lang": model.langs[k], "first": a, "words": n})
    rest = pa.Table.from_batches(rest).combine_chunks()
    columns = {k: rest.column(k).combine_chunks() for k in rest.column_names}
    columns |= {"lang_pred": pa.array(pred, pa.string()), "score": pa.array(score, pa.float64())}
    if spans:
        columns["spans"] = pa.array(runs, SPANS)
    return pa.RecordBatch.from_pydict(columns)


SPANS = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("words", pa.int64())]))


def label(docs: DataFrame, model: Model, keys: list[str] = ["doc_id"],  # noqa: B006
          spans: bool = False) -> DataFrame:
    """``keys``, ``lang_pred``, ``score`` of every row; with ``spans`` also the labelled spans,
    as (lang, first word, words) where words stand between white space. ``text`` may be a key."""
    small_batches(docs.sparkSession)
    # keys travel in one column, so none of their names can clash with the operator's
    packed = F.struct(*([F.col(k) for k in keys if k != "text"] or [F.lit(0)]))
    rows = docs.select(packed.alias("packed"), F.col("text").cast("string").alias("text"))
    passed = ["packed", *["text"] * ("text" in keys)]
    schema = T.StructType([rows.schema[c] for c in passed]).add("lang_pred", "string").add("score", "double")
    if spans:
        schema = schema.add("spans", T.ArrayType(T.StructType().add("lang", "string").add("first", "long").add("words", "long")))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept()
        model, known = shared.value, Scores(shared.value)
        group, size = [], 0
        for batch in slices(batches, "text"):
            texts = _split(batch)
            counts = np.array([len(ws) for ws in texts], np.int64)
            by_word, letters = known.of(texts)
            none = np.bincount(np.repeat(np.arange(len(counts)), counts), letters, len(counts)) == 0
            few = [bool(k) and not any(map(str.isalpha, chain.from_iterable(ws))) for ws, k in zip(texts, none)]
            rest = batch.select(passed)
            group.append((rest, counts, by_word, letters, np.array(few, bool)))
            size += len(letters)
            if size >= GROUP_WORDS:
                yield _labelled(group, model, spans)
                group, size = [], 0
        if group:
            yield _labelled(group, model, spans)
        del known, group
        give_back()

    found = rows.mapInArrow(work, schema)
    return found.select(*[F.col("text") if k == "text" else F.col("packed")[k].alias(k) for k in keys],
                        "lang_pred", "score", *["spans"] * spans)

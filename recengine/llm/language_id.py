"""Language ID (operator 1): known words by per-language log frequency, unseen words by character n-grams.

Training takes the texts with a language from a sample of documents, chosen by a hash of doc_id and text so that they hold about
MAX_TRAIN_BYTES at most (all of them while they fit); nothing else of the corpus is fitted. From it come two tables of at
most MAX_ENTRIES rows by languages, the most frequent first:
  words    log frequency of each word in each language (add SMOOTH)
  n-grams  log frequency of the n-grams, n = MAX_N to 1, of the distinct words, written <word>
A text's words are its runs of letters, lower-cased. A known word adds its log frequencies. An unseen word backs off to
the longest n of which it has a known n-gram and adds the mean of these; if there is none, it adds nothing. The language with the
greatest sum wins (ties: the first by code point); the score is its share of exp(sum) over all languages.

Whole texts are read; only text is an input of a prediction. Null texts, texts without a letter, and any text if nothing could be learned,
are ``und`` with score 0. Null languages are not learned from. The model is broadcast; its size is bounded by MAX_ENTRIES.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recengine.llm.common import batches_of, table

MAX_TRAIN_BYTES = 64 << 20
MAX_ENTRIES = 200_000
MAX_N = 5
SMOOTH = 0.5
#: Unseen words that a task remembers.
MAX_REMEMBERED = 100_000
UNDETERMINED = "und"

letters = regex.compile(r"\p{L}+").findall


def words_of(text: str | None) -> list[str]:
    return letters(text.lower()) if text else []


def ngrams(word: str, n: int) -> list[str]:
    w = f"<{word}>"
    return [w[i:i + n] for i in range(len(w) - n + 1)]


def held_out(doc_id: Column, remainder: int = 2, of: int = 4) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of == remainder, F.lit(False))


class LanguageModel:
    def __init__(self, words: dict[str, dict[str, int]], grams: dict[str, dict[str, int]]):
        """words and grams: counts by entry and language."""
        self.languages = sorted({x for c in words.values() for x in c})
        self.words, self.word_scores = self._scores(words, lambda w: 0)
        self.grams, self.gram_scores = self._scores(grams, len)

    def _scores(self, counts, group):
        """Log relative frequencies; each group (n-gram length) is a distribution of its own."""
        place = {e: i for i, e in enumerate(counts)}
        n = np.array([[counts[e].get(x, 0) for x in self.languages] for e in counts], np.float64).reshape(
            len(counts), len(self.languages)) + SMOOTH
        kind = np.array([group(e) for e in counts], np.int64)
        for k in np.unique(kind):
            n[kind == k] /= n[kind == k].sum(0)
        return place, np.log(n)

    def unseen(self, word: str) -> np.ndarray:
        for n in range(MAX_N, 0, -1):
            found = [i for g in ngrams(word, n) if (i := self.grams.get(g)) is not None]
            if found:
                return self.gram_scores[found].mean(0)
        return np.zeros(len(self.languages))


class Predictor:
    """Predictions with the scores of unseen words remembered."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self._start()

    def _start(self):
        self.learned: dict[str, int] = {}
        self.scores = np.vstack([self.model.word_scores, np.zeros((MAX_REMEMBERED, len(self.model.languages)))])

    def _learn(self, word: str) -> int:
        place = self.learned.get(word)
        if place is None:
            place = self.learned[word] = len(self.model.words) + len(self.learned)
            self.scores[place] = self.model.unseen(word)
        return place

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.model.languages:
            return UNDETERMINED, 0.0
        total = np.zeros(len(self.model.languages))
        for i in range(0, len(words), MAX_REMEMBERED // 2):
            part = words[i:i + MAX_REMEMBERED // 2]
            if len(self.learned) + len(part) > MAX_REMEMBERED:
                self.learned.clear()  # so that no place is used twice within a part
            at = list(map(self.model.words.get, part))
            if None in at:
                at = [self._learn(w) if k is None else k for w, k in zip(part, at)]
            total += self.scores[at].sum(0)
        best = int(np.argmax(total))
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def _counted(rows: DataFrame, limit: int) -> dict[str, dict[str, int]]:
    """Counts of the most frequent entries (entry, lang, n), at most ``limit`` rows by languages."""
    top = rows.groupBy("entry").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "entry").limit(limit)
    out: dict[str, dict[str, int]] = {}
    for entry, lang, n in rows.join(top, "entry").orderBy(F.desc("all"), "entry", "lang").select("entry", "lang", "n").toLocalIterator():
        out.setdefault(entry, {})[lang] = n
    return out


def train(docs: DataFrame, max_bytes: int = MAX_TRAIN_BYTES, max_entries: int = MAX_ENTRIES) -> LanguageModel:
    """Learns from (text, lang) of ``docs`` (doc_id picks the sample)."""
    from pyspark import StorageLevel
    d = docs.where("text is not null and lang is not null")
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    part = min(1.0, max_bytes / max(1, size))
    if part < 1:
        d = d.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) < int(part * (1 << 40)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums: dict[tuple[str, str], int] = {}
            for text, lang in zip(b["text"].to_pylist(), b["lang"].to_pylist()):
                for w in words_of(text):
                    sums[w, lang] = sums.get((w, lang), 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.string()),
                                              pa.array(list(sums.values()), pa.int64())], names=["entry", "lang", "n"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums: dict[tuple[str, str], int] = {}
            for word, lang in zip(b["entry"].to_pylist(), b["lang"].to_pylist()):
                for n in range(1, MAX_N + 1):
                    for g in ngrams(word, n):
                        sums[g, lang] = sums.get((g, lang), 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.string()),
                                              pa.array(list(sums.values()), pa.int64())], names=["entry", "lang", "n"])

    kind = "entry string, lang string, n long"
    words = d.select("text", "lang").mapInArrow(count, kind).groupBy("entry", "lang").agg(F.sum("n").alias("n"))
    words = words.persist(StorageLevel.MEMORY_AND_DISK)
    languages = max(1, words.select("lang").distinct().count())
    limit = max(1, min(max_entries, max_entries * 8 // languages))
    grams = words.mapInArrow(split, kind).groupBy("entry", "lang").agg(F.sum("n").alias("n"))
    model = LanguageModel(_counted(words, limit), _counted(grams, limit))
    words.unpersist()
    return model


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Adds lang_pred and score to ``docs``, from the column text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(shared.value)
        for b in batches_of(batches, 500):
            found = [predictor(t) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(b[f.name] for f in keep), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*(f.name for f in keep), "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    schema = StructType([*keep, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.select(*[f.name for f in keep]).mapInArrow(run, schema)


def identify(docs: DataFrame, held: Column | None = None) -> DataFrame:
    """(doc_id, held_out, text, lang_pred, score): trained on the documents that are not held out, for all."""
    d = docs.select("doc_id", "text", "lang", (held_out(F.col("doc_id")) if held is None else held).alias("held_out"))
    model = train(d.where(~F.col("held_out")))
    return predict(d.drop("lang"), model)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")

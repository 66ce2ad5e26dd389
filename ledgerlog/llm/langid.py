"""Language identification by known words first, then shorter and shorter character n-grams.

A word seen in training scores its smoothed log frequency in each language. An unseen word is
read from left to right as the longest known n-grams, from ``LONGEST`` characters down to one;
a character no language has scores the same for all. A text's score is the posterior of its
best language under equal priors.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import hashed_sample, pieces

UNDETERMINED = "und"
SAMPLE = 500
LONGEST = 4
LEAST_COUNT = 3
SMOOTHING = 0.5
KEPT_WORDS = 200_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """The words in lower case; none if the text has no letter."""
    found = _WORD.findall(text.lower()) if text else []
    # The pattern also passes numerals such as Roman or fraction characters, which are no letters.
    return found if any(w[0].isalpha() or any(map(str.isalpha, w)) for w in found) else []


def grams_of(word: str, n: int) -> Iterator[str]:
    marked = f"^{word}$"
    return (marked[i:i + n] for i in range(len(marked) - n + 1))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (n = 0) and n-grams of a partition, by language."""
    words: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            words.setdefault(lang, Counter()).update(words_of(text))
    for lang, known in words.items():
        counts = {(0, w): c for w, c in known.items()}
        grams: Counter = Counter()
        for word, count in known.items():
            for n in range(1, LONGEST + 1):
                for gram in grams_of(word, n):
                    grams[n, gram] += count
        counts.update(grams)
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys)), pa.array([n for n, _ in keys], pa.int32()),
             pa.array([g for _, g in keys]), pa.array([counts[k] for k in keys], pa.int64())],
            ["lang", "n", "gram", "count"])


class Model:
    """Log frequencies of words (n = 0) and n-grams, one column per language."""

    def __init__(self, counts: pa.Table):
        self.langs = sorted(set(counts.column("lang").to_pylist()))
        column = {lang: i for i, lang in enumerate(self.langs)}
        self.rows: list[dict[str, int]] = []
        self.logs: list[np.ndarray] = []
        for n in range(LONGEST + 1):
            part = counts.filter(pc.equal(counts.column("n"), n))
            grams = part.column("gram").to_pylist()
            rows = {g: i for i, g in enumerate(dict.fromkeys(grams))}
            seen = np.zeros((len(rows), len(self.langs)))
            seen[[rows[g] for g in grams], [column[x] for x in part.column("lang").to_pylist()]] = part.column("count")
            self.rows.append(rows)
            self.logs.append(np.log(seen + SMOOTHING) - np.log(seen.sum(0) + SMOOTHING * (len(rows) + 1)))

    def start(self) -> None:
        """The vectors of known words; those of unseen words are added up to a bound."""
        self.index = dict(self.rows[0])
        self.vectors = np.zeros((len(self.index) + KEPT_WORDS, len(self.langs)))
        self.vectors[:len(self.index)] = self.logs[0]

    def backoff(self, word: str) -> np.ndarray:
        marked = f"^{word}$"
        score = np.zeros(len(self.langs))
        at = 0
        while at < len(marked):
            for n in range(min(LONGEST, len(marked) - at), 0, -1):
                row = self.rows[n].get(marked[at:at + n])
                if row is not None:
                    score += self.logs[n][row]
                    break
            at += n
        return score

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.langs:
            return UNDETERMINED, 0.0
        if not hasattr(self, "index"):
            self.start()
        total = np.zeros(len(self.langs))
        for begin in range(0, len(words), KEPT_WORDS // 2):
            part = words[begin:begin + KEPT_WORDS // 2]
            ids = list(map(self.index.get, part))
            if None in ids:
                fresh = dict.fromkeys(w for w, i in zip(part, ids) if i is None)
                if len(self.index) + len(fresh) > len(self.vectors):
                    self.start()
                    fresh = dict.fromkeys(w for w in part if w not in self.index)
                for w in fresh:
                    self.vectors[len(self.index)] = self.backoff(w)
                    self.index[w] = len(self.index)
                ids = list(map(self.index.__getitem__, part))
            total += self.vectors[ids].sum(0)
        best = int(total.argmax())
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          usable: Column | None = None, sample: int = SAMPLE) -> Model:
    """A model of at most ``sample`` documents per language, chosen by a hash of their keys.

    Their whole texts are counted in tasks; only words and n-grams counted ``LEAST_COUNT`` times
    reach the driver. Rows with a NULL key, text or language teach nothing, nor do those for
    which ``usable`` does not hold.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"),
                       (F.lit(True) if usable is None else usable).alias("usable"))
    rows = rows.where("usable AND id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    chosen = hashed_sample(rows.select("id", "lang"), "lang", "id", sample).select("id").distinct()
    counts = (rows.join(F.broadcast(chosen), "id", "left_semi").select("lang", "text")  # at most ``sample`` ids a language
              .mapInArrow(_counted, "lang string, n int, gram string, count bigint")
              .groupBy("lang", "n", "gram").agg(F.sum("count").alias("count"))
              .where(F.col("count") >= LEAST_COUNT))
    return Model(counts.toArrow())


def _predicted(shared, names: list[str], again: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in pieces(batches, "text"):
            found = [model.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column("text" if n == again else n) for n in names), pa.array([x for x, _ in found], pa.string()),
                 pa.array([x for _, x in found], pa.float64())], [*names, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, then ``lang_pred`` and ``score`` (0 to 1) for every row.

    NULL texts and texts without a letter get ``und`` and 0, as does everything under a model
    that has seen nothing. Equal scores go to the first language in order of its name. Repeated
    rows stay; columns besides ``keep`` are ignored, and names may clash with the results only if
    they are not kept; an empty table gives an empty result.
    """
    names = [f"c{i}" for i in range(len(keep))]
    again = next((n for c, n in zip(keep, names) if c == text), None)  # a kept text is sent to the task once
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names) if n != again),
                       F.col(f"`{text}`").alias("text"))
    kinds = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names))).schema.fields
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kinds]
                       + ["lang_pred string", "score double"])
    out = rows.mapInArrow(_predicted(docs.sparkSession.sparkContext.broadcast(model), names, again), schema)
    return out.select(*(F.col(n).alias(c) for c, n in zip(keep, names)), "lang_pred", "score")

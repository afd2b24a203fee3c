"""A convolutional text classifier for toxicity, trained in numpy.

Words are embedded by hashing: a word's vector is the sum of the table rows of
its hash and of the hashes of its first characters, so that unseen words of a
known stem are known too. Filters of several widths slide over the words, each
keeps its maximum over the whole text, and a logistic unit turns the maxima
into a score. Scores see the text only.

`max_rows` bounds the labelled rows drawn for the fit on the driver. A quarter of
them (by hash) is kept from the fit; this quarter and all labelled rows that were
not drawn are scored on Spark and calibrate one threshold per language. The driver
sees their counts per language and score cell (`RESOLUTION`) only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from skerry.llm.shared import SLICE_ROWS, map_slices, stored

MAX_ROWS = 8_000
MEMO_WORDS = 100_000
# Cells per unit of the log odds in which scores are counted; a threshold lies between two cells.
RESOLUTION = 1024
# Upper- and lower-case of one word are one word; everything outside letters, digits and above ASCII separates.
SEPARATORS = bytes(b if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(SEPARATORS).split()


@dataclass(frozen=True)
class Shape:
    buckets: int = 1 << 15
    dim: int = 16
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    stems: tuple[int, ...] = (4, 5, 6)

    def columns(self) -> list[tuple[int, int, int]]:
        """(width, position in the filter, first column) of the projection; a position has `filters` columns."""
        pairs = [(w, j) for w in self.widths for j in range(w)]
        return [(w, j, at * self.filters) for at, (w, j) in enumerate(pairs)]

    def features(self, word: bytes) -> list[int]:
        """Table rows of a word: its own, and one per stem length."""
        text = word.decode(errors="replace")
        keys = [word, *(f"{n}:{text[:n]}".encode() for n in self.stems)]
        return [crc32(k) % self.buckets for k in keys]


@dataclass
class TextCnn:
    shape: Shape
    table: np.ndarray
    project: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    offset: float
    thresholds: dict[str | None, float] = field(default_factory=dict)

    @classmethod
    def fresh(cls, shape: Shape, seed: int) -> TextCnn:
        rng = np.random.default_rng(seed)
        units = len(shape.widths) * shape.filters
        return cls(
            shape,
            rng.normal(0, 0.3, (shape.buckets, shape.dim)).astype(np.float32),
            rng.normal(0, 0.3, (shape.dim, sum(shape.widths) * shape.filters)).astype(np.float32),
            np.zeros(units, np.float32),
            rng.normal(0, 0.3, units).astype(np.float32),
            0.0,
        )

    def convolve(self, rows: np.ndarray) -> list[np.ndarray]:
        """Filter outputs per width from the projected words of one text; texts shorter than a filter are padded."""
        n, size = self.shape.filters, len(rows)
        widest = max(self.shape.widths)
        if size < widest:
            rows = np.concatenate([rows, np.zeros((widest - size, rows.shape[1]), np.float32)])
            size = widest
        outs: list[np.ndarray] = []
        for width, position, first in self.shape.columns():
            part = rows[position : size - width + 1 + position, first : first + n]
            outs = [*outs, part] if position == 0 else [*outs[:-1], outs[-1] + part]
        return outs

    def pool(self, rows: np.ndarray) -> np.ndarray:
        best = np.concatenate([out.max(axis=0) for out in self.convolve(rows)])
        return np.maximum(best + self.bias, 0)

    def score(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(pooled.astype(np.float64) @ self.weight.astype(np.float64) + self.offset)))

    def project_words(self, words: list[bytes]) -> np.ndarray:
        features = np.array([self.shape.features(w) for w in words], np.int64)
        return self.table[features].sum(axis=1) @ self.project

    def scorer(self) -> Callable[[list[str]], np.ndarray]:
        """Scores of whole texts; the projections of the last words are remembered in one array."""
        known: dict[bytes, int] = {}
        held = np.empty((MEMO_WORDS, self.project.shape[1]), np.float32)

        def run(texts: list[str]) -> np.ndarray:
            pooled = np.zeros((len(texts), len(self.bias)), np.float32)
            for at, text in enumerate(texts):
                words = words_of(text)
                fresh = list({w for w in words if w not in known})
                if len(known) + len(fresh) > MEMO_WORDS:
                    known.clear()
                    fresh = list(set(words))
                if len(fresh) > MEMO_WORDS:  # one text with more words than are remembered
                    unique = sorted(fresh)
                    number = {w: i for i, w in enumerate(unique)}
                    pooled[at] = self.pool(self.project_words(unique)[[number[w] for w in words]])
                    continue
                if fresh:
                    first = len(known)
                    held[first : first + len(fresh)] = self.project_words(fresh)
                    known.update(zip(fresh, range(first, first + len(fresh))))
                ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                pooled[at] = self.pool(held[ids])
            return self.score(pooled)

        return run


def fit(
    texts: list[str], labels: np.ndarray, shape: Shape = Shape(), epochs: int = 8, rate: float = 0.5, seed: int = 7
) -> TextCnn:
    """Train on whole texts, one text at a time, in a fixed random order; classes weigh the same in total."""
    model = TextCnn.fresh(shape, seed)
    number: dict[bytes, int] = {}
    documents = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], np.int32) for t in texts]
    features = np.array([shape.features(w) for w in number], np.int32).reshape(-1, 1 + len(shape.stems))
    grown = [np.full(a.shape, 1e-2, np.float32) for a in (model.table, model.project, model.bias, model.weight)]
    grown_offset = 1e-2
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.02, 0.98))
    gain = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    columns, n = shape.columns(), shape.filters
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for at in order.permutation(len(documents)):
            ids = documents[at]
            unique, back = np.unique(ids, return_inverse=True)
            vectors = model.table[features[unique]].sum(axis=1)
            outs = model.convolve((vectors @ model.project)[back])
            peaks = [out.argmax(axis=0) for out in outs]
            raw = np.concatenate([out[p, np.arange(n)] for out, p in zip(outs, peaks)]) + model.bias
            pooled = np.maximum(raw, 0)
            miss = float((model.score(pooled[None])[0] - labels[at]) * gain[at])
            if abs(miss) < 1e-3:
                continue
            down = miss * model.weight * (raw > 0)
            _step(model.weight, grown[3], miss * pooled, rate)
            _step(model.bias, grown[2], down, rate)
            grown_offset += miss * miss
            model.offset -= rate * miss / grown_offset**0.5
            # Each maximum sends its error to the words under the filter and to the filter's columns.
            to_words, to_project = np.zeros_like(vectors), np.zeros_like(model.project)
            for width, position, first in columns:
                which = shape.widths.index(width)
                errors = down[which * n : which * n + n]
                spots = peaks[which] + position
                live = (spots < len(ids)) & (errors != 0)
                if not live.any():
                    continue
                hit = back[spots[live]]
                cols = first + np.flatnonzero(live)
                to_project[:, cols] += vectors[hit].T * errors[live]
                np.add.at(to_words, hit, errors[live][:, None] * model.project[:, cols].T)
            touched = np.flatnonzero(np.abs(to_words).sum(axis=1))
            _step(model.project, grown[1], to_project, rate)
            rows = features[unique[touched]].ravel()
            _step_rows(model.table, grown[0], rows, np.repeat(to_words[touched], features.shape[1], axis=0), rate)
    return model


def _step(values: np.ndarray, grown: np.ndarray, slope: np.ndarray, rate: float) -> None:
    grown += slope * slope
    values -= rate * slope / np.sqrt(grown)


def _step_rows(values: np.ndarray, grown: np.ndarray, rows: np.ndarray, slopes: np.ndarray, rate: float) -> None:
    unique, back = np.unique(rows, return_inverse=True)
    slope = np.zeros((len(unique), values.shape[1]), np.float32)
    np.add.at(slope, back, slopes)
    grown[unique] += slope * slope
    values[unique] -= rate * slope / np.sqrt(grown[unique])


def best_threshold(scores: np.ndarray, labels: np.ndarray, fallback: float) -> float:
    """The middle of the widest range of thresholds with the greatest F1; the fallback without both classes."""
    return threshold_of_cells(scores, scores, np.ones(len(labels)), labels, fallback)


def threshold_of_cells(
    least: np.ndarray, most: np.ndarray, rows: np.ndarray, toxic: np.ndarray, fallback: float
) -> float:
    """`best_threshold` from the least and greatest score, rows and toxic rows of cells that do not overlap."""
    if not 0 < toxic.sum() < rows.sum():
        return fallback
    order = np.argsort(-least, kind="stable")
    least, most, rows, toxic = least[order], most[order], rows[order], toxic[order]
    hits = np.cumsum(toxic)
    f1 = 2 * hits / (np.cumsum(rows) + toxic.sum())
    ends = np.append(most[1:], 0.0)
    f1[least == ends] = -1  # ties stay together
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    at = best[np.argmax(least[best] - ends[best])]
    return float((least[at] + ends[at]) / 2)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    lang_col: str = "lang",
    max_rows: int = MAX_ROWS,
    shape: Shape = Shape(),
    least_labels: int = 20,
    least_class: int = 10,
) -> TextCnn:
    """Fit on labelled rows whose crc32(doc_id as text) mod 3 is not 1, at most about `max_rows` of them (by hash).

    All labelled rows that were not fitted calibrate the thresholds. A document
    with several labels has the greatest one; NULL labels and ids count as
    unlabelled, repeated documents once. A language with fewer than
    `least_labels` calibration rows, or `least_class` of either class, takes the
    common threshold.
    Without labels the model stays as drawn, with threshold 0.5.
    """
    return learn(docs, labels, label_col, lang_col, max_rows, shape, least_labels, least_class)[0]


def learn(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", lang_col: str = "lang", max_rows: int = MAX_ROWS,
    shape: Shape = Shape(), least_labels: int = 20, least_class: int = 10, keep: tuple[str, ...] = (), text_col: str = "text",
) -> tuple[TextCnn, DataFrame]:
    """`train`, and the stored scores it calibrated on: a row per row of `docs` with doc_id, lang, score and the columns `keep`.

    Every text is scored once; labels meet scores, so no text is shuffled.
    """
    marked = (
        labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
    )
    marked = stored(marked, "labels")
    rows = marked.count()
    lot = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20))
    drawn = lot < int(min(1.0, max_rows / max(1, rows)) * (1 << 20))
    to_fit = drawn & (F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(4)) != 0)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    )
    # About `max_rows` ids at most, so this side is bounded by the parameter.
    got = texts.join(F.broadcast(marked.where(to_fit)), "doc_id").toPandas()
    got = got.sort_values(["doc_id", "text", "lang"]).drop_duplicates("doc_id")
    model = fit(list(got["text"]), got["label"].to_numpy(np.float64), shape)
    scored = stored(_scored(docs, model, keep, text_col, lang_col), "scores")
    light = scored.select("doc_id", SCORE_LANG, SCORE_TEXT, SCORE)
    model.thresholds = calibrate(light.join(marked.where(~to_fit), "doc_id"), least_labels, least_class)
    return model, scored


# Names no column of documents has.
SCORE_LANG, SCORE_TEXT, SCORE = "__lang", "__text", "__score"


def _scored(docs: DataFrame, model: TextCnn, keep: tuple[str, ...], text_col: str, lang_col: str) -> DataFrame:
    """doc_id, language, a hash of the text and its score, besides the columns `keep`; one narrow pass."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own = [F.col("doc_id").cast("long").alias("doc_id")] if "doc_id" not in keep else []
    source = docs.select(
        *[F.col(f"`{c}`") for c in keep], *own, F.col(f"`{lang_col}`").cast("string").alias(SCORE_LANG),
        F.xxhash64(text).alias(SCORE_TEXT), text.alias("__read"),
    )
    names = source.columns[:-1]
    fields = StructType([*(source.schema[c] for c in names), StructField(SCORE, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = held.value.scorer()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                made = pa.array(score(part.column(len(names)).to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], made], names=[*names, SCORE])

    return source.mapInArrow(run, fields)


def calibrate(rows: DataFrame, least_labels: int, least_class: int) -> dict[str | None, float]:
    """The common threshold (under None) and those of languages from all of `rows`: scores with labels.

    Of a repeated document one row counts: the first by hash of its text and by
    language. Scores are counted in cells of the log odds, so the driver gets at
    most some 61,000 rows per language.
    """
    first = F.min(F.struct(SCORE_TEXT, F.col(SCORE_LANG).isNull().alias("none"), SCORE_LANG, SCORE)).alias("row")
    single = rows.groupBy("doc_id").agg(F.first("label").alias("label"), first).select(
        "label", F.col(f"row.{SCORE}").alias("score"), F.col(f"row.{SCORE_LANG}").alias("lang")
    )
    score = F.least(F.greatest("score", F.lit(1e-13)), F.lit(1 - 1e-13))
    cell = F.floor(F.log(score / (1 - score)) * RESOLUTION).alias("cell")
    counts = F.min("score").alias("least"), F.max("score").alias("most"), F.count("*").alias("rows"), F.sum("label").alias("toxic")
    cells = stored(single.groupBy("lang", cell).agg(*counts), "cells")
    merged = F.min("least").alias("least"), F.max("most").alias("most"), F.sum("rows").alias("rows"), F.sum("toxic").alias("toxic")
    every = cells.groupBy("cell").agg(*merged).toPandas()
    common = _threshold(every, 0.5)
    classes = cells.where("lang IS NOT NULL").groupBy("lang").agg(F.sum("toxic").alias("t"), F.sum("rows").alias("n"))
    enough = classes.where((F.col("n") >= least_labels) & (F.least("t", F.col("n") - F.col("t")) >= least_class)).select("lang")
    own = cells.join(enough, "lang").toPandas()
    return {None: common} | {lang: _threshold(part, common) for lang, part in own.groupby("lang")}


def _threshold(cells, fallback: float) -> float:
    return threshold_of_cells(*(cells[c].to_numpy(np.float64) for c in ("least", "most", "rows", "toxic")), fallback)


def held_out(id_col: str):
    """True for ids whose crc32 as text leaves 1 by 3; a NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_texts(docs: DataFrame, model: TextCnn, cut: float = 0.7, lang_col: str = "lang") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (score >= cut), threshold and rejected (score >= threshold).

    The score is of the whole text alone; the language only picks the
    calibrated threshold. A NULL or empty text gets the score of no words. The
    model is broadcast: its size is set by its shape, whatever the corpus.
    """
    return _judged(_scored(docs, model, (), "text", lang_col), model, cut)


def classify(docs: DataFrame, labels: DataFrame, cut: float = 0.7, lang_col: str = "lang", **options) -> DataFrame:
    """`train` and `score_texts` on the same rows, each text scored once."""
    model, scored = learn(docs, labels, lang_col=lang_col, **options)
    return _judged(scored, model, cut)


def _judged(scored: DataFrame, model: TextCnn, cut: float) -> DataFrame:
    limit = _limit(model, SCORE_LANG)
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        F.col(SCORE).alias("score"),
        (F.col(SCORE) >= cut).cast("int").alias("predicted"),
        limit.alias("threshold"),
        (F.col(SCORE) >= limit).alias("rejected"),
    )


def _limit(model: TextCnn, lang_col: str) -> Column:
    """The threshold of the row's language; the common one where the language has none."""
    common = F.lit(model.thresholds.get(None, 0.5))
    own = [x for lang, t in model.thresholds.items() if lang is not None for x in (F.lit(lang), F.lit(t))]
    return F.coalesce(F.try_element_at(F.create_map(*own), F.col(f"`{lang_col}`").cast("string")), common) if own else common


def reject(docs: DataFrame, model: TextCnn, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of `docs` whose score is under the threshold of their language; one narrow pass, all columns kept."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        limits, run = held.value.thresholds, held.value.scorer()

        def keep(part: pa.RecordBatch) -> pa.RecordBatch:
            scores = run([t or "" for t in part.column(text_col).to_pylist()])
            most = [limits.get(lang, limits[None]) for lang in part.column(lang_col).to_pylist()]
            return part.filter(pa.array(scores < np.array(most)))

        return keep

    return map_slices(docs, make)


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """`train` and `reject` on the same rows: all columns stored once beside the score, so each text is scored once."""
    model, scored = learn(docs, labels, keep=tuple(docs.columns), **options)
    kept = scored.where(F.col(SCORE) < _limit(model, SCORE_LANG))
    return kept.select(*[f"`{c}`" for c in docs.columns])

"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

``document_statistics`` turns every whole text into a short vector of
statistics (lengths, repetition, case, symbols); language, source, id and
label are no part of it. Statistics are standardised over all documents.
Random Fourier features approximate a Gaussian kernel over them; each task sums its
part of the normal equations, the parts are summed on the executors, and the
driver solves one small system. Calibration pools adjacent violators over
counts of raw scores on rows that the regression didn't see.

Folds are by ``crc32(doc_id as text) mod 5``: 0 is held out, 1 to 3 fit the
ridge, 4 fits the calibration.

Defined results: a null text is the empty text and gets a score as any other;
null labels and labels of absent documents are ignored; repeated label rows
count each; without any usable training row every score is 1; a null id is
held out; repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklake.llm.common import small_batches, stage, text_or_empty, tree_sum

FEATURES = ("words", "word_length", "capitals", "symbols", "bars", "exclamations", "digits", "points",
            "distinct_words", "distinct_pairs", "stutter", "top_word", "line_words", "repeated_lines",
            "plain_words", "wide_bytes")
N_FOURIER, WIDTH, RIDGE, SEED = 320, 3.0, 1e-4, 20240
THRESHOLD = 0.3
#: Raw scores are counted in bins of this width for the calibration.
BIN = 0.002

_CAPITALS = bytes(range(65, 91))
_ASCII_LETTERS = bytes(range(97, 123)) + _CAPITALS


def document_statistics(text: str) -> list[float]:
    """The statistics named in ``FEATURES``, each bounded or on a log scale."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    if not n:
        return [0.0] * len(FEATURES)
    gone = lambda chars: len(raw) - len(raw.translate(None, chars))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    stutter = sum(map(bytes.__eq__, words, words[1:]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = max(1, gone(_ASCII_LETTERS))
    chars = sum(map(len, words))
    return [
        np.log1p(n), min(chars / n, 40.0) / 5, gone(_CAPITALS) / letters, min(gone(b"#*$%&<>") / n, 3.0),
        min(gone(b"|") / n, 2.0), min(gone(b"!") / n, 2.0), gone(b"0123456789") / size, min(gone(b".,;:?") / n, 2.0),
        len(counts) / n, pairs / max(1, n - 1), stutter / max(1, n - 1), max(counts.values()) / n,
        np.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)),
        letters / max(1, chars), (len(raw) - len(text)) / size]


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def run(batches):
        import pyarrow as pa

        names = ["doc_id", *FEATURES]
        for batch in batches:
            table = np.array([document_statistics(t.as_py()) for t in batch.column(1)], dtype="f8")
            table = table.reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, table.T)], names)

    return (small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES)))


def fold(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5))


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None
    raw_at: np.ndarray
    score_at: np.ndarray

    def fourier(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        waves = np.cos(z @ self.frequencies + self.phases) * np.sqrt(2.0 / self.phases.size)
        return np.hstack([waves, z, np.ones((len(z), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.fourier(x) @ self.weights, -1, 2)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(x))
        return np.interp(self.raw(x), self.raw_at, self.score_at)


def pool_adjacent_violators(values, weights) -> np.ndarray:
    """The non-decreasing fit of ``values`` that is nearest in weighted squares."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.array([v for v, _, n in blocks for _ in range(n)])


def _matrix(batch) -> np.ndarray:
    return np.column_stack([np.asarray(batch[f], dtype="f8") for f in FEATURES])


def train(features: DataFrame, labels: DataFrame, n_fourier: int = N_FOURIER, ridge: float = RIDGE) -> QualityModel:
    """Fit on the labelled rows outside the held-out fold; ``labels`` has doc_id and quality."""
    stats = features.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in FEATURES for f in (F.avg, F.stddev_pop)]).first()
    mean = np.array([stats[f"avg_{c}"] or 0.0 for c in FEATURES])
    scale = np.array([max(stats[f"stddev_pop_{c}"] or 0.0, 1e-3) for c in FEATURES])
    draw = np.random.default_rng(SEED)
    empty = QualityModel(mean, scale, draw.normal(size=(len(FEATURES), n_fourier)) / WIDTH,
                         draw.uniform(0, 2 * np.pi, n_fourier), None, np.zeros(1), np.zeros(1))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
    rows = stage(features.join(marks.where("quality IS NOT NULL").withColumn("fold", fold()).where("fold <> 0"),
                               "doc_id"), "labelled")
    width = n_fourier + len(FEATURES) + 1

    def normal_equations(batches):
        import pandas as pd

        total = np.zeros((width, width + 1))
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.iloc[at:at + 2048]
                z = empty.fourier(_matrix(part))
                total += z.T @ np.column_stack([z, part["quality"].to_numpy()])
        yield pd.DataFrame({"sums": [total.tobytes()]})

    sums = tree_sum(rows.where("fold < 4").mapInPandas(normal_equations, "sums binary"), "sums")
    if sums is None or not sums.any():
        return empty
    sums = sums.reshape(width, width + 1)
    gram, target = sums[:, :width], sums[:, width]
    penalty = ridge * gram[-1, -1] * np.eye(width)
    penalty[-1, -1] = 0
    weights = np.linalg.solve(gram + penalty + 1e-9 * np.eye(width), target)
    fitted = QualityModel(mean, scale, empty.frequencies, empty.phases, weights, np.zeros(1), np.zeros(1))

    def raw_scores(batches):
        import pandas as pd

        for batch in batches:
            yield pd.DataFrame({"raw": fitted.raw(_matrix(batch)), "quality": batch["quality"].to_numpy()})

    bins = (rows.where("fold = 4").mapInPandas(raw_scores, "raw double, quality double")
            .groupBy(F.round(F.col("raw") / BIN).cast("long").alias("bin"))
            .agg(F.sum("quality").alias("good"), F.count(F.lit(1)).alias("n"))
            .orderBy("bin").collect())  # at most 3 / BIN rows
    if bins:
        at = np.array([b["bin"] * BIN for b in bins])
        level = pool_adjacent_violators([b["good"] / b["n"] for b in bins], [float(b["n"]) for b in bins])
    else:
        at, level = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return QualityModel(mean, scale, fitted.frequencies, fitted.phases, weights, at, np.clip(level, 0, 1))


def score_features(features: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            table = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(table))], ["doc_id", "score"])

    scored = features.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Scores of all documents; statistics are computed once and kept as a table."""
    features = stage(feature_table(docs), "statistics")
    return score_features(features, train(features, labels), threshold)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold."""
    model = train(stage(feature_table(docs, id_col, text_col), "statistics"), labels)
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                table = np.array([document_statistics(t.as_py() or "") for t in batch.column(at)], dtype="f8")
                yield batch.filter(pa.array(model.score(table) >= threshold))

    return docs.mapInArrow(run, docs.schema)

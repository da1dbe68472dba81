"""Toxicity as a severity grade: cumulative-link ordinal regression on sparse word features."""

from __future__ import annotations

import re
from array import array
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresieve.llm.common import arrow_map, pick

#: At most this many labelled documents, and so many code points of them, are learned
#: from: whole texts, taken in the order of a hash of their id.
MAX_LABELLED = 6_000
MAX_CHARS = 20_000_000
#: A feature is a cue if the odds of its documents to be toxic are this many times the odds of all.
CUE_ODDS = 20.0
#: A feature comes in so many labelled documents at least, and its presence differs
#: between toxic and other documents by this chi-square; the MAX_FEATURES best are kept.
MIN_DOCUMENTS = 3
MIN_CHI2 = 12.0
MAX_FEATURES = 4096
#: Besides whole words, the first letters of longer words are features.
PREFIXES = (5, 6, 7)
#: A feature's value is log(1 + its occurrences in 100 words); shorter texts count as of this length.
SHORT_WORDS = 80
#: Penalties and steps of the fit.
L1, STEPS, RATE = 5e-5, 600, 0.1
#: A document is flagged when its probability of any grade over 0 reaches this.
FLAG_AT = 0.5

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> Counter:
    """How often each lower-case run of letters comes in a text."""
    return Counter(_WORD.findall(text.lower()))


def features(counts: Counter, known=None) -> dict[str, float]:
    """Values of the words and prefixes of a text; with `known`, only of these features."""
    sums: Counter = Counter()
    for word, n in counts.items():
        if known is None or word in known:
            sums[word] += n
        for k in PREFIXES:
            if len(word) <= k:
                break
            start = "^" + word[:k]
            if known is None or start in known:
                sums[start] += n
    unit = 100 / max(SHORT_WORDS, counts.total())
    return {x: float(np.log1p(n * unit)) for x, n in sums.items()}


@dataclass
class Ordinal:
    """P(grade <= k | x) = sigmoid(cut_k - w.x), one w for all grades and rising cuts."""

    weights: dict[str, float] = field(default_factory=dict)
    cuts: tuple[float, ...] = ()

    def at_least(self, counts: Counter) -> list[float]:
        """P(grade >= k) for k = 1, 2, ..."""
        z = sum(self.weights[x] * v for x, v in features(counts, self.weights).items())
        return [1 / (1 + float(np.exp(min(700.0, c - z)))) for c in self.cuts]


class Cells:
    """The features of some texts as arrays: a text's row, a feature's column, its value; each text is read once."""

    def __init__(self, texts: list[str]):
        index: dict[str, int] = {}
        rows, cols, vals = array("i"), array("i"), array("d")
        for r, text in enumerate(texts):
            found = features(words(text))
            rows.extend([r] * len(found))
            cols.extend([index.setdefault(x, len(index)) for x in found])
            vals.extend(found.values())
        self.n, self.names = len(texts), list(index)
        self.rows, self.cols, self.vals = np.array(rows, np.int32), np.array(cols, np.int32), np.array(vals)

    def presence(self, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many toxic and how many other texts hold each feature."""
        inside = np.bincount(self.cols, toxic[self.rows], minlength=len(self.names))
        return inside, np.bincount(self.cols, minlength=len(self.names)) - inside


def _held_often(toxic: np.ndarray, inside: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """Features that MIN_DOCUMENTS texts of the smaller class hold."""
    return (inside if toxic.sum() * 2 <= len(toxic) else outside) >= MIN_DOCUMENTS


def _screened(cells: Cells, toxic: np.ndarray) -> list[int]:
    """Columns of the features whose presence tells toxic texts best."""
    n1, n = int(toxic.sum()), len(toxic)
    inside, outside = cells.presence(toxic)
    gap, every = inside / n1 - outside / (n - n1), (inside + outside) / n
    chi2 = gap**2 / (np.maximum(every * (1 - every), 1e-12) * (1 / n1 + 1 / (n - n1)))
    good = np.flatnonzero(_held_often(toxic, inside, outside) & (chi2 >= MIN_CHI2)).tolist()
    return sorted(good, key=lambda i: (-chi2[i], cells.names[i]))[:MAX_FEATURES]


def fit_ordinal(texts: list[str] | Cells, grades: np.ndarray) -> Ordinal:
    """Fits weights and cuts by Adam steps with soft thresholding of the weights.

    Deterministic. Cuts stay in order as the logs of their gaps are learned. Without
    texts, or with one grade only, nothing is ever flagged.
    """
    levels = int(grades.max(initial=0))
    if not len(grades) or levels == 0 or not (grades == 0).any():
        return Ordinal({}, (50.0,) * max(1, levels))
    cells = texts if isinstance(texts, Cells) else Cells(texts)
    chosen = _screened(cells, grades > 0)
    vocab = [cells.names[i] for i in chosen]
    place = np.full(len(cells.names), -1)
    place[chosen] = range(len(chosen))
    known = place[cells.cols] >= 0
    rows, cols, vals = cells.rows[known], place[cells.cols[known]], cells.vals[known]
    n, at = cells.n, np.arange(cells.n)
    w = np.zeros(len(vocab) + levels)  # weights, first cut, logs of gaps
    w[len(vocab)] = np.log((grades == 0).sum() / (grades > 0).sum())
    m, v = np.zeros_like(w), np.zeros_like(w)
    column, one = np.zeros((n, 1)), np.ones((n, 1))
    for t in range(1, STEPS + 1):
        gaps = np.exp(w[len(vocab) + 1 :])
        cuts = w[len(vocab)] + np.concatenate([[0.0], np.cumsum(gaps)])
        z = np.bincount(rows, vals * w[cols], minlength=n)
        p = 1 / (1 + np.exp(np.clip(z[:, None] - cuts[None, :], -60, 60)))  # P(grade <= k)
        d = p * (1 - p)
        mass = np.maximum(np.hstack([p, one])[at, grades] - np.hstack([column, p])[at, grades], 1e-9)
        upper, lower = np.hstack([d, column])[at, grades] / mass, np.hstack([column, d])[at, grades] / mass
        g_cuts = np.array([lower[grades == k + 1].sum() - upper[grades == k].sum() for k in range(levels)]) / n
        g = np.concatenate(
            [
                np.bincount(cols, (vals * (upper - lower)[rows]), minlength=len(vocab)) / n,
                [g_cuts.sum()],
                np.cumsum(g_cuts[::-1])[::-1][1:] * gaps,
            ]
        )
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = RATE * (1 - t / (STEPS + 1)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-4)
        w = w - step * m / (1 - 0.9**t)
        u = w[: len(vocab)]
        w[: len(vocab)] = np.sign(u) * np.maximum(np.abs(u) - step[: len(vocab)] * L1, 0)
    cuts = w[len(vocab)] + np.concatenate([[0.0], np.cumsum(np.exp(w[len(vocab) + 1 :]))])
    return Ordinal({vocab[i]: float(w[i]) for i in np.flatnonzero(w[: len(vocab)])}, tuple(float(c) for c in cuts))


def severity_grades(texts: list[str] | Cells, toxic: np.ndarray) -> np.ndarray:
    """Grades for binary labels: 0 not toxic, else 1 or 2 by the density of cues.

    Cues are the features that come almost only in toxic texts. Toxic texts in which
    their values sum to more than in the median toxic text are of grade 2.
    """
    toxic = np.asarray(toxic, bool)
    grades = toxic.astype(np.int64)
    if not toxic.any() or toxic.all():
        return grades
    cells = texts if isinstance(texts, Cells) else Cells(texts)
    prior = toxic.sum() / (~toxic).sum()
    inside, outside = cells.presence(toxic)
    cue = _held_often(toxic, inside, outside) & (inside >= MIN_DOCUMENTS) & ((inside + 0.5) / (outside + 0.5) / prior >= CUE_ODDS)
    density = np.bincount(cells.rows, cells.vals * cue[cells.cols], minlength=cells.n)
    grades[toxic & (density > np.median(density[toxic]))] = 2
    return grades


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Ordinal:
    """The model of a bounded sample of the labelled documents (MAX_LABELLED, MAX_CHARS).

    Texts are taken in hash order of their ids; one that no longer fits is skipped.
    A document with several labels has their largest, one with several rows the
    shortest text (of these, that of the least hash), so repeated rows teach once;
    null labels, texts and ids teach nothing. Empty texts teach that they have no
    features. Tables without rows, or labels of one kind, give a model that flags
    nothing. Only the named columns are read, so others can't clash.
    """
    known = pick(labels, doc_id=id_col, toxic=label_col).where("doc_id is not null and toxic is not null")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    chosen = known.toPandas()
    if chosen.empty:
        return fit_ordinal([], np.zeros(0, np.int64))
    spark = docs.sparkSession
    chosen["place"] = range(len(chosen))
    held = pick(docs, doc_id=id_col, text=text_col).where("text is not null")
    held = held.join(F.broadcast(spark.createDataFrame(chosen)), "doc_id").withColumn("n", F.length("text")).withColumn("hash", F.xxhash64("text"))
    sizes = held.groupBy("place").agg(F.min(F.struct("n", "hash")).alias("least")).select("place", "least.n", "least.hash").toPandas()  # at most MAX_LABELLED rows
    taken, free = [], MAX_CHARS
    for row in sizes.sort_values("place").itertuples(index=False):
        if row.n <= free:
            taken.append((int(row.place), int(row.n), int(row.hash)))
            free -= row.n
    if not taken:
        return fit_ordinal([], np.zeros(0, np.int64))
    picked = F.broadcast(spark.createDataFrame(taken, "place bigint, n int, hash bigint"))
    rows = held.join(picked, ["place", "n", "hash"], "left_semi").groupBy("place").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    rows = rows.toPandas().sort_values("place")
    cells = Cells(rows["text"].tolist())
    return fit_ordinal(cells, severity_grades(cells, rows["toxic"].to_numpy() > 0))


def score(docs: DataFrame, model: Ordinal, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, expected_severity, grade (the likeliest), p_toxic, toxic.

    expected_severity is the sum of P(grade >= k) over k. The whole text is read,
    whatever its length; null and empty text have no features and the severity that
    the cuts give. Of equally likely grades the lowest is taken. Repeated rows give
    repeated rows, an empty table none. Only the two columns are read.
    """
    id_type = dict(docs.dtypes)[id_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in batches:
            found = [own.at_least(words(t.as_py() or "")) for t in batch.column("text")]
            p = np.array(found).reshape(len(found), -1)
            mass = -np.diff(np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p.sum(axis=1)), pa.array(mass.argmax(axis=1).astype("i4")), pa.array(p[:, 0]), pa.array(p[:, 0] >= FLAG_AT)],
                ["doc_id", "expected_severity", "grade", "p_toxic", "toxic"],
            )

    return arrow_map(pick(docs, doc_id=id_col, text=text_col), run, f"doc_id {id_type}, expected_severity double, grade int, p_toxic double, toxic boolean")

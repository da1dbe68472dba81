"""Language ID by multilingual mixture inference: EM over language proportions, set chosen by penalised likelihood."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresieve.llm.common import arrow_map, others, pick, quoted

#: Letter trigrams are hashed to 2 ** FEATURE_BITS features.
FEATURE_BITS = 15
#: Languages whose features a task counts at once, and whose probabilities are looked at side by side.
BLOCK = 256
SMOOTHING = 0.5
#: Neighbouring trigrams share letters, so a text has about a third as many independent ones.
OVERLAP = 3.0
EM_ROUNDS = 25
#: Code points that are looked at at once, so a text of any length needs bounded memory.
CHUNK = 1 << 20
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _lowered() -> np.ndarray:
    """Of each code point its lower case, or a space if it isn't a letter.

    By the sign alone, without regard to its neighbours, so that a text may be cut
    anywhere; of a lower case of several signs the first is taken.
    """
    points = (ord(chr(i).lower()[0]) if chr(i).isalpha() else 32 for i in range(0x110000))
    return np.fromiter(points, np.uint32, 0x110000)


def trigram_counts(text: str) -> tuple[np.ndarray, np.ndarray, bool]:
    """(features, their counts, whether there is a letter) of a text; what isn't a letter is a space.

    A trigram counts by its middle letter. Chunks overlap by the neighbours of their
    ends, so any size of chunk gives the same counts.
    """
    total = np.zeros(1 << FEATURE_BITS, np.int64)
    for s in range(0, len(text), CHUNK):
        part = text[max(0, s - 1) : s + CHUNK + 1]
        points = _lowered()[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")]
        x = np.concatenate([points[:0] if s else np.full(1, 32, np.uint32), points, points[:0] if s + CHUNK < len(text) else np.full(1, 32, np.uint32)])
        middle = x[1:-1] != 32
        h = x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        total += np.bincount((h >> np.uint32(32 - FEATURE_BITS))[middle], minlength=len(total))
    at = np.flatnonzero(total)
    return at, total[at], len(at) > 0


class Model:
    """Smoothed log-probabilities of the features of each language, held as the counts that aren't 0.

    Up to BLOCK languages lie in one dense block; more are laid out block by block,
    for the features of a text alone, so a model takes 8 bytes for each feature
    that a language has, however many languages there are.
    """

    def __init__(self, languages: list[str], counts: np.ndarray):
        at = np.nonzero(counts)
        self._hold(languages, at[0], at[1], counts[at])

    @classmethod
    def of_counts(cls, languages: list[str], language: np.ndarray, feature: np.ndarray, n: np.ndarray) -> Model:
        """The model of single counts, sorted by language."""
        model = cls.__new__(cls)
        model._hold(languages, language, feature, n)
        return model

    def _hold(self, languages, language, feature, n) -> None:
        self.languages, self.feature, self.n = languages, feature.astype(np.int32), n.astype(np.float64)
        self.ends = np.searchsorted(language, np.arange(len(languages) + 1))
        totals = np.add.reduceat(np.append(self.n, 0), self.ends[:-1]) * (np.diff(self.ends) > 0) if languages else np.zeros(0)
        self.totals = totals + SMOOTHING * (1 << FEATURE_BITS)
        self._dense = None

    def __getstate__(self):
        return self.__dict__ | {"_dense": None}

    def block(self, first: int, at: np.ndarray) -> np.ndarray:
        """(languages from `first` on, at most BLOCK; features `at`): log-probabilities."""
        last = min(first + BLOCK, len(self.languages))
        if len(self.languages) <= BLOCK:
            if self._dense is None:
                self._dense = self._laid_out(0, last, np.arange(1 << FEATURE_BITS))
            return self._dense[:, at].astype(np.float64)
        return self._laid_out(first, last, at).astype(np.float64)

    def _laid_out(self, first: int, last: int, at: np.ndarray) -> np.ndarray:
        place = np.full(1 << FEATURE_BITS, -1)
        place[at] = np.arange(len(at))
        held = slice(self.ends[first], self.ends[last])
        row = np.repeat(np.arange(last - first), np.diff(self.ends[first : last + 1]))
        column = place[self.feature[held]]
        smooth = np.full((last - first, len(at)), SMOOTHING)
        smooth[row[column >= 0], column[column >= 0]] += self.n[held][column >= 0]
        return np.log(smooth / self.totals[first:last, None]).astype(np.float32)

    def blocks(self, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        for first in range(0, len(self.languages), BLOCK):
            yield first, self.block(first, at)

    def _fit(self, p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
        """EM for the proportions of the rows of p; (proportions, log-likelihood)."""
        share = np.full(len(p), 1 / len(p))
        for _ in range(EM_ROUNDS):
            joint = share[:, None] * p
            new = (joint / joint.sum(axis=0)) @ n / n.sum()
            done = np.abs(new - share).max() < 1e-4
            share = new
            if done:
                break
        return share, float(np.log(share @ p) @ n)

    def proportions(self, at: np.ndarray, n: np.ndarray) -> dict[int, float]:
        """Proportions of the languages in the chosen set, of which no addition pays its penalty.

        Sets grow from the likeliest language, by the one that adds most. The log-
        likelihood is concave in the proportions, so its slope towards a language
        bounds what any share of it can add: languages whose slope is under the
        penalty need no EM, and the result is the same.
        """
        best = int(np.argmax(np.concatenate([log_p @ n for _, log_p in self.blocks(at)])))
        base = self.block(best // BLOCK * BLOCK, at)[best % BLOCK]  # all likelihoods are ratios to the best language's
        chosen, held, share, value = [best], {best: np.ones(len(at))}, np.ones(1), 0.0
        price = OVERLAP * 0.5 * np.log(max(2.0, n.sum() / OVERLAP))
        while len(chosen) < len(self.languages):
            now = np.stack([held[x] for x in chosen])
            steep = []
            for first, log_p in self.blocks(at):
                p = np.exp(log_p - base)
                slope = (p / (share @ now)) @ n - n.sum()
                steep += [(-slope[i], first + i, p[i]) for i in np.flatnonzero(slope > price).tolist() if first + i not in chosen]
            found = [(self._fit(np.vstack([now, row]), n), i, row) for _, i, row in sorted(steep, key=lambda x: x[:2])]
            found = [(v, s, i, row) for (s, v), i, row in found if v - value > price]
            if not found:
                break
            value, share, i, held[i] = max(found, key=lambda x: x[0])
            chosen.append(i)
            while len(chosen) > 2:  # a member that the new one replaces no longer pays
                rest = [x for x in chosen if x != chosen[int(np.argmin(share))]]
                s, v = self._fit(np.stack([held[x] for x in rest]), n)
                if value - v > price:
                    break
                chosen, share, value = rest, s, v
        return dict(zip(chosen, share.tolist()))

    def predict(self, text: str | None) -> tuple[str, float, list[tuple[str, float]]]:
        """(language of the largest proportion, score, all proportions); `und` and 0 without a letter.

        score: that proportion times the probability of the likeliest language, were
        the text in one language, so that very short texts don't score 1.
        """
        at, n, letters = trigram_counts(text or "")
        if not letters or not self.languages:
            return UNDETERMINED, 0.0, []
        found = sorted(((v, self.languages[i]) for i, v in self.proportions(at, n.astype(np.float64)).items()), key=lambda x: (-x[0], x[1]))
        alone = np.concatenate([log_p @ n for _, log_p in self.blocks(at)]) / OVERLAP
        sure = 1 / np.exp(alone - alone.max()).sum()
        return found[0][1], float(min(1.0, found[0][0] * max(sure, 1 / len(alone)) ** (len(found) == 1))), [(lang, v) for v, lang in found]


def held_out(doc_id: Column) -> Column:
    """Documents whose id, as text, has a CRC-32 of remainder 2 to 4 are never learned from; nor are null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of all labelled rows of docs: those with a text and a language.

    Repeated rows count as often as they come, whole texts whatever their length; other
    columns aren't read; null labels and texts teach nothing. Without labelled rows
    the model knows no language. Tasks count their features by language, BLOCK languages at a time; only
    these counts are shuffled. Their sums come to the driver: at most 2 ** FEATURE_BITS
    numbers a language (0.4 MB), however many documents and languages there are.
    """

    def passed(sums):
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["lang", "feature", "n"])

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if lang not in sums and len(sums) >= BLOCK:
                    yield from passed(sums)
                    sums = {}
                at, n, _ = trigram_counts(text)
                sums.setdefault(lang, np.zeros(1 << FEATURE_BITS, np.int64))[at] += n
        yield from passed(sums)

    labelled = pick(docs, lang=lang_col, text=text_col).where("lang is not null and text is not null")
    table = arrow_map(labelled, count, "lang string, feature int, n bigint").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    langs, language = np.unique(np.array(table.column("lang").to_pylist(), object), return_inverse=True)
    order = np.lexsort((table.column("feature").to_numpy(), language))
    return Model.of_counts(langs.tolist(), language[order], table.column("feature").to_numpy()[order], table.column("n").to_numpy()[order])


def annotate(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with lang_pred, score (0 to 1) and languages (map of proportions), which replace columns of these names.

    Reads the whole text and nothing else of a row. lang_pred is `und`, with score 0,
    where the text is null or has no letter, or where nothing was learned. Of equal
    proportions the language that sorts first is taken. Repeated rows give repeated
    rows, an empty table none. Rows keep their places: there is no shuffle and no join.
    """
    added = {"lang_pred": "string", "score": "double", "languages": "map<string,double>"}
    docs = docs.select(*quoted(others(docs, added)))
    at = docs.columns.index(text_col)
    names = [*docs.columns, *added]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in batches:
            found = [own.predict(t) for t in batch.column(at).to_pylist()]
            columns = [
                pa.array([x[0] for x in found], pa.string()),
                pa.array([x[1] for x in found], pa.float64()),
                pa.array([x[2] for x in found], pa.map_(pa.string(), pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return arrow_map(docs, run, ", ".join([*fields, *[f"{k} {v}" for k, v in added.items()]]))


def lettered(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text has a letter, by annotate's own rule, whatever was learned.

    Null and empty text has none; texts of any length are read up to their first
    letter; repeated rows stay or go alike; an empty table gives no rows; all columns
    return as they are, whatever their names.
    """
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array([any(map(str.isalpha, t or "")) for t in batch.column(at).to_pylist()], pa.bool_()))

    return arrow_map(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and what annotate adds."""
    return annotate(pick(docs, doc_id=id_col, text=text_col), model).drop("text")


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learns from the labelled rows that aren't held out and predicts every row; adds held_out.

    One row per row of docs: doc_id, lang_pred, score, languages, held_out (false for
    a null id, which teaches nothing either). Edge cases as in train and annotate.
    """
    model = train(docs.where(~held_out(F.col(id_col))), text_col, lang_col)
    out = identify(docs, model, id_col, text_col)
    return out.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)))

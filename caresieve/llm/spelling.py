"""Spelling variants: words within one edit of each other, found by PartEnum signatures of their letters."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresieve.llm.common import arrow_map, cut, pick
from caresieve.operators.skew import Steps

MIN_CHARS, MIN_COUNT = 5, 3
#: A run loses a code point where this divides its hash.
DAMAGE = 97
#: A form comes at least so many times as often as its variant.
FORM_RATIO = 2
#: Parts that the letter dimensions are cut into, of which all but two (replaced letter) or one (added letter) must agree.
REPLACED_PARTS, ADDED_PARTS = 4, 2
#: Code points of a text that are split at once, and different words that a task counts before it passes them on.
CHUNK, HELD_WORDS = 1 << 20, 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def runs(text: str) -> Counter:
    """How often each lower-cased run of letters comes in the text; long texts go in pieces that end between runs."""
    text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes: A-Z only
    found: Counter = Counter()
    at = 0
    while at < len(text):
        end = min(len(text), at + CHUNK)
        if end < len(text) and (m := _RUN.match(text, end)):  # the piece may end inside a run: go on to its end
            end = m.end()
        found.update(_RUN.findall(text, at, end))
        at = end
    return found


def damaged(doc_id, run: str) -> str:
    """The run, without one code point where the hash of id and run asks for it."""
    h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode("utf-8", "surrogatepass"))
    return run if h % DAMAGE else run[: h % len(run)] + run[h % len(run) + 1 :]


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: every word of at least min_chars code points that comes min_count times or more.

    A task adds words up before they are shuffled, and passes them on when it holds
    HELD_WORDS of them, so its memory is bounded at any vocabulary.
    """

    def batch_of(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for word, n in runs(text or "").items():
                    if len(word) >= min_chars and len(word := damaged(doc_id, word)) >= min_chars:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield batch_of(held)
                    held = Counter()
        yield batch_of(held)

    counted = arrow_map(pick(docs, doc_id=id_col, text=text_col), run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def part_signatures(word: str, parts: int, free: int) -> Iterator[bytes]:
    """PartEnum signatures of the word's letters for Hamming distance `free`.

    The letters are a set of dimensions (letter, how many of it came before), which
    hash into `parts`; two sets that differ in `free` dimensions agree on all parts
    but `free` of them, so on one of the signatures at least.
    """
    seen: Counter = Counter()
    part: list[list[str]] = [[] for _ in range(parts)]
    for letter in sorted(word):
        part[(ord(letter) * 31 + seen[letter] * 7) * 0x9E3779B1 % (1 << 32) * parts >> 32].append(letter)
        seen[letter] += 1
    joined = ["".join(p) for p in part]
    for keep in combinations(range(parts), parts - free):
        yield "|".join([str(keep), *(joined[i] for i in keep)]).encode("utf-8", "surrogatepass")


def signatures(word: str) -> Iterator[tuple[int, int]]:
    """(role, key) of a word: role 0 meets itself (equal length), 1 the shorter and 2 the longer of two lengths.

    One edit leaves the first or the last half of the (shorter) word as it is, so
    each signature holds that half, its side and the length beside the letters' parts.
    """

    def keys(role: int, length: int, parts: int, free: int) -> Iterator[tuple[int, int]]:
        half = length // 2
        sides = [f"{length}<{word[:half]}".encode("utf-8", "surrogatepass"), f"{length}>{word[len(word) - (length - half) :]}".encode("utf-8", "surrogatepass")]
        for letters in part_signatures(word, parts, free):
            for side in sides:
                yield role, xxhash.xxh3_64_intdigest(side + b"/" + letters) - (1 << 63)

    yield from keys(0, len(word), REPLACED_PARTS, 2)
    yield from keys(1, len(word), ADDED_PARTS, 1)
    yield from keys(2, len(word) - 1, ADDED_PARTS, 1)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b), a and b once in each order: the words at one inserted, deleted or replaced code point.

    words: word and n, each word once, none empty. Words of one signature meet in a
    plain equi-join, whose large keys the adaptive join splits; the edit distance is
    tested in the join, so candidates that fail are never rows.
    """

    def run(batches):
        for batch in batches:
            found = [list(signatures(w)) for w in batch.column("word").to_pylist()]
            at = pa.array([i for i, f in enumerate(found) for _ in f], pa.int32())
            flat = [x for f in found for x in f]
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in flat], pa.int32()), pa.array([k for _, k in flat], pa.int64()), batch.column("word").take(at), batch.column("n").take(at)], ["role", "key", "word", "n"])

    keyed = cut(arrow_map(words, run, "role int, key bigint, word string, n bigint"))

    def side(role: int, name: str) -> DataFrame:
        return keyed.where(F.col("role") == role).select("key", F.col("word").alias(name), F.col("n").alias(f"n_{name}"))

    one_edit = F.levenshtein("a", "b", 1) == 1
    replaced = side(0, "a").join(side(0, "b").withColumnRenamed("key", "key_b"), (F.col("key") == F.col("key_b")) & (F.col("a") < F.col("b")) & one_edit)
    added = side(1, "a").join(side(2, "b").withColumnRenamed("key", "key_b"), (F.col("key") == F.col("key_b")) & one_edit)
    found = replaced.select("a", "n_a", "b", "n_b").unionByName(added.select("a", "n_a", "b", "n_b")).distinct()
    back = found.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b"))
    return found.unionByName(back)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): the last word that forms lead to.

    Forms never lead in a circle, as counts rise along them. Each round doubles the
    way that a row has gone; a round is a table in the shared folder.
    """
    steps = Steps(forms.sparkSession)
    try:
        now = steps.keep(forms.select("word", F.col("form").alias("root")))
        while True:
            step = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
            now = steps.keep(now.join(step, now["root"] == step["at"], "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
            steps.forget(before=steps.held)
            if now.where("moved").isEmpty():
                return cut(now.select("word", "root"))
            now = now.drop("moved")
    finally:
        steps.forget()


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word of the texts: word, form, root, n, n_near, form_n.

    Words are maximal runs of letters, A-Z lowered, where DAMAGE says so without one
    code point; those of min_chars code points that come min_count times. Two words
    are near if they differ by one inserted, deleted or replaced code point. A word's
    form is its near word of the largest n, of equal ones the first in code-point
    order, if that n is FORM_RATIO times its own; root is where forms lead to, the
    word itself without any. Whole texts of any length are read; null and empty ones
    have no words; a null id hashes as an empty one; repeated rows count as often as they come; only the
    two columns are read, so others can't clash; an empty table gives no rows.
    """
    words = cut(word_counts(docs, min_chars, min_count, id_col, text_col))
    best = near_pairs(words).groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("word"))).alias("best"))
    best = best.select(F.col("a").alias("__a"), "n_near", "best")
    formed = words.join(best, words["word"] == best["__a"], "left")
    is_form = -F.col("best.less") >= FORM_RATIO * F.col("n")
    formed = cut(formed.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")))
    ends = roots(formed.where("form is not null").select("word", "form"))
    out = formed.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

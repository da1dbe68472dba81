import re
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from caresieve.llm import spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    """word -> (form, root, n, n_near, form_n) by comparing all words."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= 3}
    out = {}
    for w in n:
        near = sorted((-n[v], v) for v in n if one_edit(w, v))
        form = near[0][1] if near and -near[0][0] >= 2 * n[w] else None
        out[w] = [form, w, n[w], len(near), n[form] if form else None]
    for w, x in out.items():
        while out[x[1]][0]:
            x[1] = out[x[1]][0]
    return {w: tuple(x) for w, x in out.items()}


def got(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def rows_of_words():
    import random

    rng = random.Random(3)
    base = ["thing", "colour", "analyse", "straße", "niñobar", "aaaaa", "aaaaaa", "aaaaaaa", "elephant", "rückgrat"]
    words = []
    for w in base:
        words += [w] * 60
        for k in range(12):
            i, how = rng.randrange(len(w)), rng.randrange(3)
            c = rng.choice("abcdeßü")
            v = [w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]][how]
            words += [v] * rng.choice([3, 4, 14, 30])
            j = rng.randrange(len(v))
            words += [v[:j] + rng.choice("xyz") + v[j + 1 :]] * rng.choice([3, 6])
    rng.shuffle(words)
    rows = [(i, " ".join(w.upper() if rng.random() < 0.1 and "ß" not in w else w for w in words[i::50])) for i in range(50)]
    return rows + [(60, None), (61, ""), (62, "1 2 3 ... ×÷ a bb"), (None, "thing-thing thing"), (3, rows[3][1]), (4, rows[4][1]), (63, "letters" * 4000 + " colour" * 300)]


def test_variants_equal_all_pairs(spark):
    rows = rows_of_words()
    docs = spark.createDataFrame([(i, t, "y", "y", "y") for i, t in rows], "doc_id bigint, text string, word string, n string, `a.b` string").repartition(7)
    want = plain(rows)
    assert any(x[1] not in (w, x[0]) for w, x in want.items())  # forms of forms
    assert got(spelling.variants(docs)) == want


def test_no_words(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (2, "a b c d")], "doc_id bigint, text string")).count() == 0


def test_chunks_and_held_words_change_nothing(spark, monkeypatch):
    text = "Colour thing, aé-Niño×bar " * 40 + "x" * 500
    whole = spelling.runs(text)
    for size in (1, 7, 64):
        monkeypatch.setattr(spelling, "CHUNK", size)
        assert spelling.runs(text) == whole
    assert whole["niño×bar"] == 40 and "Colour" not in whole


letters = st.text(alphabet="abcdé", min_size=5, max_size=9)


@settings(max_examples=400, deadline=None)
@given(letters, st.integers(0, 8), st.sampled_from("abcdé"), st.sampled_from(["drop", "add", "replace"]))
def test_near_words_share_a_signature(word, at, letter, how):
    at %= len(word)
    other = {"drop": word[:at] + word[at + 1 :], "add": word[:at] + letter + word[at:], "replace": word[:at] + letter + word[at + 1 :]}[how]
    if other == word:
        return
    short, long = sorted([word, other], key=len)
    if len(short) == len(long):
        assert {k for r, k in spelling.signatures(short) if r == 0} & {k for r, k in spelling.signatures(long) if r == 0}
    else:
        assert {k for r, k in spelling.signatures(short) if r == 1} & {k for r, k in spelling.signatures(long) if r == 2}


@pytest.mark.parametrize("free, parts", [(1, 2), (2, 4), (2, 5)])
def test_signatures_cover_every_set_of_that_distance(free, parts):
    for a, b in [("aabbcc", "aabbcd"), ("listen", "silent"), ("abcde", "abcd")]:
        diff = sum(((Counter(a) - Counter(b)) + (Counter(b) - Counter(a))).values())
        if diff <= free:
            assert set(spelling.part_signatures(a, parts, free)) & set(spelling.part_signatures(b, parts, free))

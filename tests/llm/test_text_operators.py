"""Operators that look at one text at a time, against plain Python."""

import hashlib
import math
import os
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caresieve.llm import bpe, language_id, pii, pii_model, quality, toxicity

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
KEY = lambda r: str(r)


# ---- quality rules


def plain_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(edge, rows):
    got = quality.quality_rules(edge).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    want = []
    for doc_id, text, *_ in rows:
        n = plain_counts(text)
        want.append((doc_id, *n, n[0] < 20 or 100 * n[4] > 30 * n[0]))
    assert sorted(map(tuple, got), key=KEY) == sorted(want, key=KEY)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), min_size=0, max_size=40).map(" ".join), min_size=1, max_size=6))
def test_repeated_windows_of_few_words(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.n_repeat_words for r in quality.measure(df).collect()}
    assert got == {i: plain_counts(t)[4] for i, t in enumerate(texts)}


def test_quality_verdicts(spark, empty):
    good = "the quick brown fox and the lazy dog went to a river in the morning because it was warm and nobody else of the village had come"
    df = spark.createDataFrame([(1, good), (2, "###### " * 30 + good), (3, "nobody speaks words " * 1), (4, "zzz yyy " + " ".join(f"q{i}" for i in range(300)))], "doc_id bigint, text string")
    got = {r.doc_id: (r.kept, r.failed_rules) for r in quality.quality_rules(df).collect()}
    assert got[1] == (True, "")
    assert not got[2][0] and "symbol_ratio" in got[2][1]
    assert "n_words" in got[3][1] and "stop_word_ratio" in got[4][1]
    assert quality.quality_rules(empty).count() == 0


def test_quality_runs_without_python(edge):
    plan = quality.quality_rules(edge)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hash" not in plan.replace("Exchange hashpartitioning(doc_id", "")


# ---- BPE


def reference_encoding():
    return bpe._encoding(bpe._rank_bytes(RANKS), public_tokenizers.PATTERN)


def test_bpe_digests_and_round_trip(edge, rows, empty):
    enc = reference_encoding()
    out = bpe.encode(edge, RANKS, public_tokenizers.PATTERN)
    want = []
    for doc_id, text, *_ in rows:
        ids = np.array(enc.encode_ordinary(text or ""), "<u4")
        want.append((doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()), key=KEY) == sorted(want, key=KEY)
    back = bpe.decode(out, RANKS, public_tokenizers.PATTERN)
    assert sorted((r.doc_id, bytes(r.bytes)) for r in back.collect()) == sorted((r[0], (r[1] or "").encode()) for r in rows)
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_decoding_gives_bytes_that_need_not_be_text(spark):
    enc = reference_encoding()
    half = enc.encode_ordinary("😀")[:1]
    df = spark.createDataFrame([(1, half), (2, None), (3, [])], "doc_id bigint, token_ids array<int>")
    got = {r.doc_id: r.bytes if r.bytes is None else bytes(r.bytes) for r in bpe.decode(df, RANKS, public_tokenizers.PATTERN).collect()}
    assert got == {1: enc.decode_bytes(half), 2: None, 3: b""}


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab'st1 \n\t .,\x1c\x85  é😀"), max_size=60), st.integers(1, 9))
def test_cuts_change_no_id(text, size):
    enc = reference_encoding()
    parts = list(bpe.pieces(text, size))
    assert "".join(parts) == text
    assert bpe.encode_text(enc, text, size).tolist() == enc.encode_ordinary(text)


def test_long_texts_are_cut(rows):
    text = max((r[1] or "" for r in rows), key=len)
    assert len(list(bpe.pieces(text))) > 1


def test_a_large_rank_file_is_refused(tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_RANK_BYTES", 10)
    (tmp_path / "f").write_bytes(b"x" * 11)
    with pytest.raises(ValueError):
        bpe._rank_bytes(str(tmp_path / "f"))


# ---- personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(d):
    total = 0
    for i, c in enumerate(d[::-1]):
        total += sum(divmod(int(c) * 2, 10)) if i % 2 else int(c)
    return total % 10 == 0


def plain_base(text):
    out = [(*m.span(), "email") for m in EMAIL.finditer(text)]
    out += [(*m.span(), "ip") for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(*m.span(), "card") for m in CARD.finditer(text) if 14 <= len(d := re.sub(r"[ -]", "", m.group())) <= 19 and plain_luhn(d)]
    out += [(*m.span(), "phone") for m in PHONE.finditer(text) if 10 <= len(re.findall("[0-9]", m.group())) <= 15]
    return sorted(out, key=lambda x: (x[0], pii.KINDS.index(x[2])))


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab.-_%+@@..019 ()é\n"), max_size=50))
def test_base_spans(text):
    assert pii.base_spans(text) == plain_base(text)


def test_base_spans_of_real_shapes():
    text = "Mail a.b-1@mail7.example.com, call +1 (743) 555-3824 from 10.0.0.256 or 192.168.001.5, card 4111 1111 1111 1111 and 4111-1111-1111-1112."
    assert pii.base_spans(text) == plain_base(text)
    assert [x[2] for x in pii.base_spans(text)] == ["email", "phone", "ip", "card"]


@pytest.fixture(scope="module")
def tagger():
    return pii_model.trained()


def test_gradients():
    t = pii_model.Tagger(1, np.float64)
    rng = np.random.default_rng(0)
    texts, tags = zip(*(pii_model.labelled(rng, 16) for _ in range(3)))
    ids, tags = pii_model.codes(list(texts), 16), np.stack(tags)
    _, g = t.loss(ids, tags)
    for k in g:
        at = tuple(int(rng.integers(0, s)) for s in t.p[k].shape)
        at = (at[0], int(ids[0, 3]), at[2]) if k == "wx" else at
        kept, sides = t.p[k][at], []
        for d in (1e-5, -1e-5):
            t.p[k][at] = kept + d
            sides.append(t.loss(ids, tags)[0])
        t.p[k][at] = kept
        assert g[k][at] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-7)


def plain_viterbi(t, ids):
    """The best path with every transition looked at."""
    e, trans = t.emissions(ids), t.p["trans"] + t.block
    score, back = e[:, 0] + t.p["first"], []
    for i in range(1, ids.shape[1]):
        paths = score[:, :, None] + trans
        back.append(paths.argmax(1))
        score = paths.max(1) + e[:, i]
    tags = [score.argmax(1)]
    for b in reversed(back):
        tags.append(b[np.arange(len(ids)), tags[-1]])
    return np.stack(tags[::-1], axis=1)


def test_decoding_is_the_best_path(tagger):
    from itertools import product

    t = pii_model.Tagger(3)
    ids = pii_model.codes(["a@1"], 3)
    e, trans = t.emissions(ids)[0], t.p["trans"] + t.block
    best = max(product(range(pii_model.TAGS), repeat=3), key=lambda y: t.p["first"][y[0]] + sum(e[i, k] for i, k in enumerate(y)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
    assert tuple(t.decode(ids)[0]) == best
    rng = np.random.default_rng(5)
    ids = pii_model.codes([pii_model.labelled(rng)[0] for _ in range(60)], pii_model.TRAIN_LENGTH)
    for own in (t, tagger):
        assert (own.decode(ids) == plain_viterbi(own, ids)).all()


def gold(tags):
    """(start, end, kind) of tags."""
    out, start = [], None
    for i, t in enumerate([*tags, 0]):
        if start is not None and (t % 2 == 1 or t == 0):
            out.append((start, i, pii_model.KINDS[(tags[start] - 1) // 2]))
            start = None
        if t and start is None:
            start = i
    return set(out)


def test_held_out_spans(tagger, monkeypatch):
    """Precision and recall of whole spans on texts that training has not seen, without any check after the tagger."""
    monkeypatch.setattr(pii, "checked", lambda kind, span: True)
    rng = np.random.default_rng(12345)
    hits, found, want = Counter(), Counter(), Counter()
    for _ in range(120):
        text, tags = pii_model.labelled(rng, 1500)
        got = set(pii.model_spans(tagger, [text])[0])
        own = gold(tags.tolist())
        hits.update(k for *_, k in got & own)
        found.update(k for *_, k in got)
        want.update(k for *_, k in own)
    assert hits.total() / found.total() > 0.93 and hits.total() / want.total() > 0.93
    for k in pii_model.KINDS:
        assert hits[k] / found[k] > 0.85 and hits[k] / want[k] > 0.85, k


def test_the_tagger_finds_secrets_in_documents_and_little_else(tagger):
    """Documents hold secrets that no pattern of the base knows."""
    import duckdb

    texts = [t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    want = {(i, *m.span(1)) for i, t in enumerate(texts) for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', t)}
    added = {(i, s, e) for i, spans in enumerate(pii.all_spans(tagger, texts)) for s, e, _, base in spans if not base}
    assert len(want) > 10 and len(added & want) >= 0.9 * len(want) and len(added - want) <= 0.1 * len(want) + 1


def test_training_is_repeatable():
    a, b = (pii_model.train(steps=3, texts=200) for _ in range(2))
    assert all((a.p[k] == b.p[k]).all() for k in a.p) and a.pack() == pii_model.Tagger.unpack(a.pack()).pack()


@pytest.mark.skipif(not os.environ.get("RETRAIN"), reason="three minutes: set RETRAIN=1")
def test_training_gives_the_shipped_weights(tagger):
    again = pii_model.train()
    rng = np.random.default_rng(2)
    texts = [pii_model.labelled(rng, 1500)[0] for _ in range(40)]
    one, two = ({(i, *x) for i, s in enumerate(pii.model_spans(t, texts)) for x in s} for t in (tagger, again))
    assert len(one & two) / len(one | two) > 0.95


def test_the_model_adds_what_patterns_miss(tagger):
    text = "write to anna.k(at)example.com now, or call (555) 234-5678 today. Version 2.0. of the text has 1234 words"
    found = [(text[s:e], k, b) for s, e, k, b in pii.all_spans(tagger, [text])[0]]
    assert ("anna.k(at)example.com", "email", False) in found and all(k != "ip" for _, k, _ in found)


def test_spans_do_not_depend_on_where_windows_lie(tagger):
    text = 'you may use token = "ab12cd34ef567890ab12cd34ef567890" and call (555) 234-5678 now. '
    want = None
    for shift in range(0, 260, 13):
        before = ("plain words only " * 20)[:shift]
        got = [(s - shift, e - shift, k) for s, e, k in pii.model_spans(tagger, [before + text + "plain words only " * 30])[0]]
        want = want or got
        assert {k for *_, k in got} == {"secret", "phone"} and got == want


def test_checks_after_the_tagger():
    assert pii.checked("card", "4111 1111 1111 1111") and not pii.checked("card", "4111 1111 1111 1112")
    assert pii.checked("ip", "10.0.0.255") and not pii.checked("ip", "10.0.0.256") and not pii.checked("ip", "1.1.1.0999")
    assert pii.checked("secret", "x") and pii.checked("phone", "1")


def test_a_span_that_windows_cut_is_joined():
    assert pii.reconcile([(10, 64, "card", 0), (30, 80, "card", 0), (200, 210, "ip", 5), (205, 212, "ip", 9)]) == [(10, 80, "card"), (205, 212, "ip")]
    # a span that lies whole in its window is trusted before one that was cut off
    assert pii.reconcile([(10, 64, "card", 0), (30, 40, "ip", 3)]) == [(30, 40, "ip")]


def test_long_runs_of_digits_take_linear_time():
    for text in ("1" * 1_000_000, "1." + "2" * 1_000_000, "1.2.3." * 200_000, "+" + "1" * 1_000_000, "a@" * 300_000, "4 " * 500_000):
        began = time.perf_counter()
        pii.base_spans(text)
        assert time.perf_counter() - began < 3
    text = "1" * 50 + ".2.3.4 " + "0" * 60 + "10.2.3.4 256.1.1.1.1 1.2.3.4.5.6.7.8"
    assert pii.base_spans(text) == plain_base(text)


def test_pii_over_tables(edge, rows, empty, tagger):
    got = pii.find(edge, tagger).collect()
    assert sorted((r.doc_id, [(x.start, x.end, x.kind) for x in r.spans if x.base]) for r in got) == sorted((r[0], plain_base(r[1] or "")) for r in rows)
    assert pii.find(empty, tagger).count() == 0
    red = pii.redact(edge.sparkSession.createDataFrame([(1, "a 10.1.2.3 b", "k"), (2, None, "k")], "doc_id bigint, text string, spans string"), tagger)
    assert sorted(map(tuple, red.collect())) == [(1, "a [IP] b", "k"), (2, None, "k")]
    red = pii.redact(edge, tagger)
    assert red.columns == edge.columns and pii.redact(empty, tagger).count() == 0
    given = Counter((r.doc_id, r.text, r.spans if "spans" in edge.columns else None) for r in edge.collect())
    assert sum((given - Counter((r.doc_id, r.text, r.spans if "spans" in edge.columns else None) for r in red.collect())).values()) <= 2
    long = "some words 10.1.2.3 here " * 8000
    assert edge.sparkSession.createDataFrame([(1, long), (2, "")], "doc_id bigint, text string").transform(lambda d: pii.redact(d, tagger)).collect()[0].text == long.replace("10.1.2.3", "[IP]")


def test_the_query_of_personal_data(spark):
    import hashlib as h

    import duckdb

    from caresieve.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op6_pii"](spark, "/root/testdata/sf0.001").collect()}
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    assert len(got) == len(rows)
    for i, text in rows:
        base, r = plain_base(text or ""), got[i]
        assert r.base_sha256 == h.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in base).encode()).hexdigest()
        n = Counter(k for *_, k in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (n["email"], n["ip"], n["card"], n["phone"])
        spans = [x.split(":") for x in r.spans.split(",") if x]
        assert len(spans) == r.n_spans == len(base) + r.n_added and {(int(s), int(e), k) for k, s, e in spans} >= set(base)
        assert spans == sorted(spans, key=lambda x: (int(x[1]), pii.KINDS.index(x[0]), int(x[2])))


# ---- language ID


def corpus(spark):
    import random

    rng = random.Random(1)
    parts = {"en": ["the", "and", "thing", "with", "house", "water"], "de": ["der", "und", "schön", "haus", "nicht", "wasser"], "fr": ["le", "été", "maison", "avec", "eau", "très"]}
    rows = [(i, " ".join(rng.choice(parts[lang]) for _ in range(rng.randint(3, 60))), lang) for i, lang in enumerate(rng.choice(list(parts)) for _ in range(400))]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), rows, parts


def test_language_held_out_accuracy(spark):
    import zlib

    df, rows, _ = corpus(spark)
    got = {r.doc_id: r for r in language_id.language_id(df).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert all(got[r[0]].held_out == (r in held) for r in rows)
    assert np.mean([got[i].lang_pred == lang for i, _, lang in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_held_out_labels_teach_nothing(spark):
    import zlib

    df, rows, _ = corpus(spark)
    held = language_id.held_out(F.col("doc_id"))
    spoiled = df.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    assert sorted(map(str, language_id.language_id(df).collect())) == sorted(map(str, language_id.language_id(spoiled).collect()))
    assert any(zlib.crc32(str(r[0]).encode()) % 4 == 2 for r in rows)


def test_mixtures(spark):
    df, _, parts = corpus(spark)
    model = language_id.train(df)
    en, de = (" ".join(parts[x] * 30) for x in ("en", "de"))
    lang, score, found = model.predict(en + " " + de)
    assert {x for x, _ in found} == {"en", "de"} and 0.3 < score < 0.7
    assert [x for x, _ in model.predict(en)[2]] == ["en"]
    at, n, _ = language_id.trigram_counts(en + " " + de)
    assert sum(model.proportions(at, n.astype(float)).values()) == pytest.approx(1)


def plain_em(p, n, rounds=3000):
    """Proportions and log-likelihood of a mixture, feature by feature, to convergence."""
    share = [1 / len(p)] * len(p)
    for _ in range(rounds):
        new = [0.0] * len(p)
        for f, k in enumerate(n):
            mass = sum(share[i] * p[i][f] for i in range(len(p)))
            for i in range(len(p)):
                new[i] += k * share[i] * p[i][f] / mass
        new = [x / sum(n) for x in new]
        done = max(abs(a - b) for a, b in zip(new, share)) < 1e-9
        share = new
        if done:
            break
    return share, sum(k * math.log(sum(share[i] * p[i][f] for i in range(len(p)))) for f, k in enumerate(n))


def test_the_set_is_the_best_of_all_subsets(spark):
    """Against EM over every subset of languages, under the same price a language."""
    from itertools import combinations

    rng = np.random.default_rng(8)
    df, _, parts = corpus(spark)
    model = language_id.train(df)
    for shares in ((40, 0, 0), (30, 10, 0), (20, 0, 20), (14, 14, 14), (36, 3, 0), (6, 0, 0), (3, 3, 0), (30, 2, 8)):
        text = " ".join(" ".join(rng.choice(parts[lang], k)) for lang, k in zip(("en", "de", "fr"), shares) if k)
        at, n, _ = language_id.trigram_counts(text)
        p = np.exp(model.block(0, at).astype(float)).tolist()
        price = language_id.OVERLAP * 0.5 * math.log(max(2.0, n.sum() / language_id.OVERLAP))
        best = None
        for size in (1, 2, 3):
            for chosen in combinations(range(3), size):
                share, value = plain_em([p[i] for i in chosen], n.tolist())
                if best is None or value - price * size > best[0]:
                    best = (value - price * size, dict(zip(chosen, share)))
        found = model.proportions(at, n.astype(float))
        assert set(found) == set(best[1]), (shares, found, best)
        assert all(abs(found[i] - best[1][i]) < 0.01 for i in found)
        lang = model.predict(text)[0]
        assert lang == model.languages[max(best[1], key=best[1].get)]


def test_small_shares_join_the_set():
    rng = np.random.default_rng(3)
    words = [["".join(rng.choice(list(letters), 5)) for _ in range(40)] for letters in ("abcdefgh", "efghijkl", "ijklmnop", "mnopqrst", "qrstuvwx", "uvwxyzab", "acegikmo", "bdfhjlnp", "cgkosw", "dhlptx", "eimquy")]
    counts = np.zeros((len(words), 1 << language_id.FEATURE_BITS))
    for i, w in enumerate(words):
        at, n, _ = language_id.trigram_counts(" ".join(w * 20))
        counts[i, at] = n
    model = language_id.Model([str(i) for i in range(len(words))], counts)

    def text(i, n):
        return " ".join(rng.choice(words[i], n))

    found = dict(model.predict(text(0, 1900) + " " + text(3, 100))[2])
    assert set(found) == {"0", "3"} and 0.03 < found["3"] < 0.07
    found = dict(model.predict(" ".join(text(i, 200) for i in range(11)))[2])
    assert len(found) == 11 and all(0.06 < v < 0.12 for v in found.values())
    assert [x for x, _ in model.predict(text(5, 2000))[2]] == ["5"]


def test_language_edges(edge, empty, rows, spark):
    got = language_id.language_id(edge)
    assert got.count() == len(rows)
    no_letter = {r[0] for r in rows if not any(c.isalpha() for c in r[1] or "")}
    assert {r.doc_id for r in got.where("lang_pred = 'und'").collect()} >= no_letter - {r[0] for r in rows if any(c.isalpha() for c in r[1] or "")}
    assert language_id.language_id(empty).count() == 0
    unlabelled = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    assert language_id.language_id(unlabelled).first().lang_pred == "und"


@settings(max_examples=80, deadline=None)
@given(st.text(st.sampled_from("aßÉ İΣς.\n中x-😀"), max_size=60), st.integers(1, 9))
def test_chunks_of_any_size_give_the_same_counts(text, chunk):
    whole, kept = language_id.trigram_counts(text), language_id.CHUNK
    language_id.CHUNK = chunk
    try:
        parts = language_id.trigram_counts(text)
    finally:
        language_id.CHUNK = kept
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist() and whole[2] == parts[2] == any(map(str.isalpha, text))
    assert whole[1].sum() == sum(map(str.isalpha, text))


def test_very_many_languages(spark, monkeypatch):
    """More labels than a block: the same answers as from one block."""
    rows = [(i, " ".join(chr(97 + (i * 7 + k) % 26) * 3 + chr(97 + (i + k * k) % 26) for k in range(30)), f"l{i % 60:02}") for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    want = {r.doc_id: (r.lang_pred, round(r.score, 9), {k: round(v, 9) for k, v in r.languages.items()}) for r in language_id.language_id(df).collect()}
    monkeypatch.setattr(language_id, "BLOCK", 16)
    got = {r.doc_id: (r.lang_pred, round(r.score, 9), {k: round(v, 9) for k, v in r.languages.items()}) for r in language_id.language_id(df).collect()}
    assert got == want
    many = spark.range(700).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("word"), F.md5(F.col("id").cast("string"))).alias("text"), F.col("id").cast("string").alias("lang"))
    model = language_id.train(many)
    assert len(model.languages) == 700 and model.predict(many.first().text)[0] == "0"


# ---- toxicity


def toxic_corpus(n=400):
    rng = np.random.default_rng(0)
    plain = [f"w{chr(97 + i)}{chr(97 + j)}rd" for i in range(20) for j in range(20)]
    texts, toxic = [], []
    for i in range(n):
        words = [plain[k] for k in rng.integers(0, len(plain), int(rng.integers(20, 200)))]
        bad = i % 8 == 0
        for _ in range(int(rng.integers(2, 5)) * max(1, len(words) // 50) if bad else 0):
            words[int(rng.integers(len(words)))] = ["scumbag", "idiotic", "worthless"][int(rng.integers(3))]
        texts.append(" ".join(words))
        toxic.append(int(bad))
    return texts, np.array(toxic)


def test_ordinal_fit_finds_held_out_toxic_texts():
    texts, toxic = toxic_corpus()
    grades = toxicity.severity_grades(texts[:300], toxic[:300])
    assert set(grades) == {0, 1, 2} and ((grades > 0) == (toxic[:300] > 0)).all()
    model = toxicity.fit_ordinal(texts[:300], grades)
    assert list(model.cuts) == sorted(model.cuts)
    p = np.array([model.at_least(toxicity.words(t)) for t in texts[300:]])
    assert ((p[:, 0] >= 0.5) == (toxic[300:] > 0)).mean() > 0.97
    assert (p[:, 0] >= p[:, 1]).all()
    assert model == toxicity.fit_ordinal(texts[:300], grades)


def test_the_fit_against_a_plain_optimiser():
    """The penalised likelihood of the fit is that which proximal gradient steps with numerical slopes reach."""
    texts, toxic = toxic_corpus(160)
    grades = toxicity.severity_grades(texts, toxic)
    model = toxicity.fit_ordinal(texts, grades)
    vocab = sorted(set(model.weights) | {"scumbag", "idiotic", "worthless", "^scumb", "^idiot", "^worth"})
    x = np.array([[toxicity.features(toxicity.words(t)).get(v, 0.0) for v in vocab] for t in texts])

    def loss(w):
        cuts = np.array([w[-2], w[-2] + np.exp(w[-1])])
        p = 1 / (1 + np.exp(-(cuts[None] - (x @ w[:-2])[:, None])))
        steps = np.diff(np.hstack([np.zeros((len(x), 1)), p, np.ones((len(x), 1))]), axis=1)
        return -np.log(np.maximum(steps[np.arange(len(x)), grades], 1e-9)).mean()

    def whole(w):
        return loss(w) + toxicity.L1 * np.abs(w[:-2]).sum()

    w, rate = np.zeros(len(vocab) + 2), 4.0
    for _ in range(1500):
        slope = np.array([(loss(w + d) - loss(w - d)) / 2e-5 for d in np.eye(len(w)) * 1e-5])
        while True:
            new = w - rate * slope
            new[:-2] = np.sign(new[:-2]) * np.maximum(np.abs(new[:-2]) - rate * toxicity.L1, 0)
            if whole(new) <= whole(w) + 1e-12 or rate < 1e-6:
                break
            rate /= 2
        w, rate = new, rate * 1.5
    fitted = np.array([*(model.weights.get(v, 0.0) for v in vocab), model.cuts[0], np.log(model.cuts[1] - model.cuts[0])])
    assert whole(fitted) <= whole(w) + 0.003


def test_scores_against_the_formula(spark, edge, rows):
    model = toxicity.Ordinal({"alpha": 0.7, "^stra": 0.2, "beta": -0.4, "^alpha": 9.0}, (0.5, 1.5))
    got = sorted((r.doc_id, round(r.expected_severity, 9), r.grade, round(r.p_toxic, 9), r.toxic) for r in toxicity.score(edge, model).collect())
    want = []
    for i, text, *_ in rows:
        runs = re.findall(r"[^\W\d_]+", (text or "").lower())
        n = Counter(runs)
        n.update(f"^{w[:k]}" for w in runs for k in (5, 6, 7) if len(w) > k)
        z = sum(w * math.log1p(n[f] * 100 / max(80, len(runs))) for f, w in model.weights.items() if n[f])
        p = [1 / (1 + math.exp(c - z)) for c in model.cuts]
        mass = [1 - p[0], p[0] - p[1], p[1]]
        want.append((i, round(sum(p), 9), mass.index(max(mass)), round(p[0], 9), p[0] >= 0.5))
    assert got == sorted(want)


def test_toxicity_over_tables(spark, edge, empty, rows):
    texts, toxic = toxic_corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)] + [(0, 0), (None, 1), (5, None), (10**6, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert np.mean([got[i].toxic == bool(t) for i, t in enumerate(toxic)]) > 0.97
    assert all(0 <= r.expected_severity <= 2 for r in got.values())
    assert toxicity.score(edge, model).count() == len(rows)
    assert toxicity.score(empty, model).count() == 0
    nothing = toxicity.train(docs, labels.limit(0))
    assert toxicity.score(docs, nothing).where("toxic").count() == 0


def test_toxicity_sample_skips_what_does_not_fit(spark, monkeypatch):
    texts, toxic = toxic_corpus()
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)], "doc_id bigint, toxic int")
    first = labels.orderBy(F.xxhash64("doc_id"), "doc_id").first().doc_id
    seen = []
    start = toxicity.Cells.__init__
    monkeypatch.setattr(toxicity.Cells, "__init__", lambda self, t: (seen.append(t), start(self, t))[1])
    monkeypatch.setattr(toxicity, "severity_grades", lambda c, y: np.asarray(y).astype(np.int64))
    monkeypatch.setattr(toxicity, "fit_ordinal", lambda c, g: toxicity.Ordinal({"x": 1.0}, (0.0,)))
    monkeypatch.setattr(toxicity, "MAX_CHARS", sum(map(len, texts)))
    docs = spark.createDataFrame([(i, "x " * 10**6 if i == first else t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    model = toxicity.train(docs, labels)
    assert sorted(seen[-1]) == sorted(t for i, t in enumerate(texts) if i != first) and model.weights


def test_toxicity_takes_one_row_of_an_id(spark, monkeypatch):
    texts, toxic = toxic_corpus(80)
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)], "doc_id bigint, toxic int")
    seen = []
    start = toxicity.Cells.__init__
    monkeypatch.setattr(toxicity.Cells, "__init__", lambda self, t: (seen.append(t), start(self, t))[1])
    docs = spark.createDataFrame([*enumerate(texts), *[(3, texts[3])] * 500, (4, texts[4] + " longer")], "doc_id bigint, text string")
    toxicity.train(docs.repartition(4), labels)
    assert sorted(seen[-1]) == sorted(texts)

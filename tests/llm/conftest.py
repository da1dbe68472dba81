import random

import pytest

#: Names that operators use themselves, so that their presence in the input is tested.
CLASHING = ["n_lines", "n_dropped", "fp", "shard", "kept", "key", "bucket", "n_copies", "score", "id", "rank", "a.b", "MIX_KEY", "Lang_Pred", "my text"]
CLASHING += ["stratum", "rate", "rate_", "ident", "part", "n_source", "__stratum", "__rate", "lost_id", "Lost_Keys", "__lost", "__id", "hash", "same", "first", "row", "salt", "salts", "mask", "norm", "h", "chain", "toxic", "place"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)


def texts():
    """Texts with the awkward cases: null, empty, blank, very long, tied, repeated, not ASCII."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "and", "Straße", "été", "niño", "x", "—", "😀smile", "#$%"]

    def text(n):
        return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\n", ". ", "\t", "\x0b"]) for _ in range(n))

    base = [None, "", " \t\n\x0b\x0c\r", "word", "one two", "\n\n\n", "A b C", "a B c", "ÀÉ", "a b c", "x" * 3000, "😀" * 12, "same line here\nsame line here\nother line here\nshort"]
    base += ["Same Line Here \nother LINE here\nunique for one", "  same line here\t", "short\nshort\nshort", "a b c d e f g h " * 9, "a b c d e f g h i a b c d e f g h", "é combining", "\x1c\x1d sep \x85 nel"]
    base += [text(n) for n in (5, 30, 80, 300)]
    base += [text(25_000)]
    near = text(60)
    base += [near, near, near.upper(), near + " tail", near.replace(" ", "\n"), near.replace("alpha", "omega", 1)]
    return base


def records():
    rows = []
    for i, t in enumerate(texts()):
        rows.append((i * 7 % 101 + 1, t, [None, "en", "fr"][i % 3], [None, "a", "b", "b", "b"][i % 5], None if t is None else len(t)))
    rows.append(rows[4])  # a repeated row
    rows.append((rows[30][0], *rows[30][1:]))
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    """The awkward rows, over several partitions, with clashing columns."""
    return spark.createDataFrame([(*r, *(["y"] * len(CLASHING))) for r in records()], SCHEMA).repartition(4, "doc_id")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return records()

"""A bidirectional LSTM over characters with a CRF over tags, in numpy: forward, gradients, training, decoding.

`python -m caresieve.llm.pii_model` trains the tagger from made-up labelled texts
and writes pii_weights.npz, which `trained` reads; a test trains it again.
"""

from __future__ import annotations

import io
import os
from functools import lru_cache

import numpy as np

#: What the tagger tells apart; patterns know the first four only.
KINDS = ("email", "ip", "card", "phone", "secret")
#: Tag 0 is outside; kind k begins with 1 + 2k and goes on with 2 + 2k.
TAGS = 1 + 2 * len(KINDS)
#: The signs that have a code of their own.
SIGNS = "abcdefghijklmnopqrstuvwxyz @.-_+()[]{}/:,;'\"=#*%\n"
PAD, DIGIT, LETTER, OTHER = 0, 1, 2, 3
CODES = 4 + len(SIGNS)
HIDDEN = 16
NEVER = -1e4

TRAIN_LENGTH, TEXTS, BATCH, STEPS, RATE, SEED = 96, 16384, 128, 1500, 0.012, 7
WEIGHTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "pii_weights.npz")


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    table[[i for i in range(0x110000) if chr(i).isalpha()]] = LETTER
    table[ord("0") : ord("9") + 1] = DIGIT
    for i, c in enumerate(SIGNS):
        table[ord(c)] = table[ord(c.upper())] = 4 + i
    return table


def codes(texts: list[str], length: int) -> np.ndarray:
    """Codes of texts of at most `length` code points, padded."""
    out = np.full((len(texts), length), PAD, np.uint8)
    for row, t in zip(out, texts):
        row[: len(t)] = _table()[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4")]
    return out


def allowed() -> np.ndarray:
    """(from, to) penalties: a span goes on only after its own kind."""
    t = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        t[:, 2 + 2 * k] = NEVER
        t[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0
    return t


class Tagger:
    """Parameters; axis 0 of those of the LSTM is the direction.

    Gates are clipped to 0 .. 1, what they let in and out to -1 .. 1 (a hard sigmoid and
    a hard tanh): one pass each in numpy, where tanh costs ten.
    """

    SHAPES = {"wx": (2, CODES, 4 * HIDDEN), "wh": (2, HIDDEN, 4 * HIDDEN), "b": (2, 4 * HIDDEN), "wo": (2 * HIDDEN, TAGS), "bo": (TAGS,), "trans": (TAGS, TAGS), "first": (TAGS,)}

    def __init__(self, seed: int = SEED, dtype=np.float32):
        rng = np.random.default_rng(seed)
        self.p = {k: (rng.normal(0, 0.15, s) if k in ("wx", "wh", "wo") else np.zeros(s)).astype(dtype) for k, s in self.SHAPES.items()}
        self.p["b"][:, : 3 * HIDDEN] = 0.5  # gates half open
        self.p["b"][:, HIDDEN : 2 * HIDDEN] = 0.85  # and those that forget nearly closed
        self.block = allowed().astype(dtype)

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.p)
        return out.getvalue()

    @classmethod
    def unpack(cls, raw: bytes) -> Tagger:
        out = cls()
        with np.load(io.BytesIO(raw)) as f:
            out.p = {k: f[k] for k in cls.SHAPES}
        return out

    def _buffer(self, name: str, shape: tuple[int, ...], dtype) -> np.ndarray:
        """Memory that is used again by the next call: fresh pages cost more than the sums."""
        held = self.__dict__.setdefault("held", {})
        if name not in held or held[name].shape != shape or held[name].dtype != dtype:
            held[name] = np.empty(shape, dtype)
        return held[name]

    def states(self, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
        """(T, N, 2 HIDDEN) outputs of both directions, valid until the next call; keep: gets what the gradients need."""
        p, (n, length), h_ = self.p, ids.shape, HIDDEN
        both = np.stack([ids.T, ids.T[::-1]])  # (2, T, N)
        dtype = p["wx"].dtype
        # gates apart, so that each is one stretch of memory
        table = np.ascontiguousarray((p["wx"] + p["b"][:, None]).reshape(2, CODES, 4, h_).transpose(2, 0, 1, 3)).reshape(-1, h_)
        wh = np.ascontiguousarray(p["wh"].reshape(2, h_, 4, h_).transpose(2, 0, 1, 3))
        start = CODES * np.arange(8).reshape(4, 2, 1)
        h, c = np.zeros((2, n, h_), dtype), np.zeros((2, n, h_), dtype)
        out = self._buffer("out", (length, n, 2 * h_), dtype)
        y, step = self._buffer("y", (4, 2, n, h_), dtype), self._buffer("step", (4, 2, n, h_), dtype)
        ig, tc = np.empty((2, n, h_), dtype), np.empty((2, n, h_), dtype)
        zero, one = dtype.type(0), dtype.type(1)
        for t in range(length):
            np.take(table, start + both[:, t], axis=0, out=y, mode="clip")
            np.matmul(h, wh, out=step)
            y += step
            np.clip(y[:3], zero, one, out=y[:3])
            np.clip(y[3], -one, one, out=y[3])
            if keep is not None:
                keep.append((h.copy(), c.copy(), y.transpose(1, 2, 0, 3).reshape(2, n, 4 * h_)))
            np.multiply(y[0], y[3], out=ig)
            c *= y[1]
            c += ig
            np.clip(c, -one, one, out=tc)
            if keep is not None:
                keep[-1] += (tc.copy(),)
            np.multiply(y[2], tc, out=h)
            out[t, :, :h_] = h[0]
            out[length - 1 - t, :, h_:] = h[1]
        if keep is not None:
            keep.append((both, out))
        return out

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """(N, T, TAGS) scores of the tags."""
        return (self.states(ids) @ self.p["wo"] + self.p["bo"]).transpose(1, 0, 2)

    def loss(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood a character, and its gradients."""
        keep: list = []
        p, (n, length), h_ = self.p, ids.shape, HIDDEN
        e = (self.states(ids, keep) @ p["wo"] + p["bo"]).astype(np.float64)  # (T, N, TAGS)
        both, out = keep.pop()
        trans = p["trans"].astype(np.float64) + self.block
        rows, places = np.arange(n), np.arange(length)[:, None]
        gold_tags = tags.T  # (T, N)
        # forward and backward in probabilities, each step scaled to sum 1
        top = e.max(axis=2, keepdims=True)
        weight, step = np.exp(e - top), np.exp(trans)
        alpha, beta, scales = np.zeros_like(e), np.ones_like(e), np.zeros((length, n, 1))
        for t in range(length):
            a = np.exp(p["first"].astype(np.float64))[None] * weight[0] if t == 0 else (alpha[t - 1] @ step) * weight[t]
            scales[t] = a.sum(1, keepdims=True)
            alpha[t] = a / scales[t]
        for t in range(length - 2, -1, -1):
            beta[t] = (weight[t + 1] * beta[t + 1] / scales[t + 1]) @ step.T
        log_z = np.log(scales[..., 0]).sum(0) + top[..., 0].sum(0)
        gold = p["first"][gold_tags[0]] + e[places, rows[None], gold_tags].sum(0) + trans[gold_tags[:-1], gold_tags[1:]].sum(0)
        scale = 1 / (n * length)
        mean = float((log_z - gold).sum() * scale)

        de = alpha * beta  # marginals
        de[places, rows[None], gold_tags] -= 1
        g = {"first": de[0].sum(0) * scale}
        ahead = (weight[1:] * beta[1:] / scales[1:]).reshape(-1, TAGS)
        pair = (alpha[:-1].reshape(-1, TAGS).T @ ahead) * step
        np.subtract.at(pair, (gold_tags[:-1].ravel(), gold_tags[1:].ravel()), 1)
        g["trans"] = pair * scale
        de = (de * scale).astype(out.dtype)
        g["wo"] = np.tensordot(out, de, ((0, 1), (0, 1)))
        g["bo"] = de.sum((0, 1))
        dh_all = de @ p["wo"].T  # (T, N, 2H)
        dhs = np.stack([dh_all[..., :h_], dh_all[::-1, :, h_:]])  # in the order in which each direction ran
        dh, dc = np.zeros((2, n, h_), out.dtype), np.zeros((2, n, h_), out.dtype)
        back = p["wh"].transpose(0, 2, 1)
        da_all = np.zeros((2, length, n, 4 * h_), out.dtype)
        for t in range(length - 1, -1, -1):
            _, c0, y, tc = keep[t]
            i, f, o, gg = y[..., :h_], y[..., h_ : 2 * h_], y[..., 2 * h_ : 3 * h_], y[..., 3 * h_ :]
            free = np.concatenate([(y[..., : 3 * h_] > 0) & (y[..., : 3 * h_] < 1), np.abs(gg) < 1], axis=-1)
            dh = dh + dhs[:, t]
            dc = dc + dh * o * (np.abs(tc) < 1)
            da = np.concatenate([dc * gg, dc * c0, dh * tc, dc * i], axis=-1) * free
            da_all[:, t] = da
            dh = da @ back
            dc = dc * f
        flat = da_all.reshape(2, -1, 4 * h_)
        before = np.stack([k[0] for k in keep], axis=1).reshape(2, -1, h_)
        g["wh"] = before.transpose(0, 2, 1) @ flat
        g["b"] = flat.sum(1)
        seen = np.eye(CODES, dtype=out.dtype)[both.reshape(2, -1)]
        g["wx"] = seen.transpose(0, 2, 1) @ flat
        return mean, g

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The best tags of each window (Viterbi).

        First a bound: what the best span of each kind that ends at a place can gain
        over staying outside, with the best way into it and out of it. Where no span
        gains anything the path outside is the best one, and needs no search.
        """
        p = self.p
        e = self._buffer("e", (ids.shape[1], TAGS, len(ids)), p["wo"].dtype)
        np.matmul(p["wo"].T, self.states(ids).transpose(0, 2, 1), out=e)
        e += p["bo"][:, None]
        trans = p["trans"] + self.block
        rest, on = trans[0, 0], np.arange(2, TAGS, 2)
        into = np.maximum(trans[:, on - 1].max(axis=0), p["first"][on - 1] - p["first"][0] + rest) - rest
        onward = np.maximum(trans[on - 1, on], trans[on, on]) - rest
        out_of = max(0.0, float(trans[1:, 0].max() - rest))
        into, onward = into[:, None], onward[:, None]
        reach = np.full((len(on), len(ids)), NEVER, e.dtype)
        best = reach.copy()
        for t, now in enumerate(e):
            reach += now[2::2]
            reach += onward
            begin = now[1::2] + into
            np.maximum(reach, begin, out=reach)
            if t == 0:  # a window may begin inside a span
                np.maximum(reach, now[2::2] + (p["first"][on] - p["first"][0])[:, None], out=reach)
            reach -= now[0]
            np.maximum(best, reach, out=best)
        tags = np.zeros(ids.shape, np.int8)
        some = np.flatnonzero(best.max(axis=0) + out_of > -1e-3)
        if len(some):
            tags[some] = self._best_path(e[:, :, some], trans)
        return tags

    def _best_path(self, e: np.ndarray, trans: np.ndarray) -> np.ndarray:
        """A span goes on only from its own kind, so only the tags that may follow any other are looked at from all."""
        length, _, n = e.shape
        begins, on = [0, *range(1, TAGS, 2)], np.arange(2, TAGS, 2)
        to_begin, first_on, next_on = trans[:, begins][:, :, None], trans[on - 1, on][:, None], trans[on, on][:, None]
        score = np.empty((length, TAGS, n), e.dtype)
        score[0] = e[0] + self.p["first"][:, None]
        for t in range(1, length):
            last = score[t - 1]
            score[t, begins] = (last[:, None] + to_begin).max(axis=0)
            np.maximum(last[1::2] + first_on, last[2::2] + next_on, out=score[t, 2::2])
            score[t] += e[t]
        tags = np.zeros((n, length), np.int8)
        at = score[-1].argmax(axis=0)
        for t in range(length - 1, -1, -1):
            tags[:, t] = at
            if t:
                at = (score[t - 1] + trans[:, at]).argmax(axis=0)
        return tags

    def spans(self, ids: np.ndarray) -> list[list[tuple[int, int, str]]]:
        """(start, end, kind) in each window."""
        tags = self.decode(ids)
        out: list[list[tuple[int, int, str]]] = [[] for _ in tags]
        for w in np.flatnonzero(tags.any(axis=1)).tolist():
            start = None
            for i, t in enumerate([*tags[w].tolist(), 0]):
                if start is not None and (t == 0 or t % 2 == 1 or (t - 2) // 2 != start[1]):
                    out[w].append((start[0], i, KINDS[start[1]]))
                    start = None
                if t and start is None:
                    start = (i, (t - 1) // 2)
        return out


def labelled(rng: np.random.Generator, length: int = TRAIN_LENGTH) -> tuple[str, np.ndarray]:
    """A made-up text with the tags of its spans: the labelled data that the tagger learns from.

    Prose of invented words in several alphabets, lists, code and log lines, with spans
    of each kind, and what only looks like them: dates, versions, prices, hashes.
    """

    def pick(xs):
        return xs[rng.integers(len(xs))]

    def signs(alphabet, n):
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))

    def digits(n):
        return signs("0123456789", n)

    foreign = pick(["", "", "éèàçêîñóíáúü", "äöüß", "éèêçù", "óíáñú", "жизнедлому", "中文字母语言"])

    def word(lo=1, hi=10):
        letters = "etaoinshrdlucmfwypvbgkqjxz" + foreign * int(rng.integers(1, 3))
        w = "".join(letters[int(len(letters) * rng.random() ** 1.6)] for _ in range(rng.integers(lo, hi)))
        draw = rng.random()
        return w.capitalize() if draw < 0.15 else w.upper() if draw < 0.2 else w

    def name():
        return signs("etaoinshrdlucmfwypvbgk", rng.integers(2, 9))

    def email():
        at = pick(["@"] * 9 + ["(at)", "[at]", " (at) ", " [at] ", "{at}"])
        dot = "." if "at" not in at or rng.random() < 0.5 else pick(["(dot)", " [dot] ", " (dot) "])
        user = name() + pick(["", "." + digits(2), "_" + name(), "." + name(), digits(2), "-" + name(), "+" + name()])
        return user + at + dot.join([name() + pick(["", digits(1)]), *([pick(["example", name()])] if rng.random() < 0.6 else []), pick(["com", "org", "net", "de", "fr", "es", "io"])])

    def ip():
        return ".".join(str(x) for x in rng.integers(0, 256, 4))

    def card():
        n = pick([16, 16, 16, 16, 15, 14, 19])
        d, sep = digits(n), pick(["", "", "", " ", "-"])
        return sep.join(d[i : i + 4] for i in range(0, n, 4))

    def phone():
        a, b, c = digits(3), digits(3), digits(4)
        return pick([f"+{digits(1)} ({a}) {b}-{c}"] * 3 + [f"+{digits(2)} {a} {b} {c}", f"+{digits(2)}{a}{b}{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{digits(1)}-{a}-{b}-{c}", f"00{digits(2)} {a} {b}{c}"])

    def value():
        alphabet = pick(["0123456789abcdef"] * 3 + ["0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0123456789_-"])
        return signs(alphabet, pick([16, 20, 24, 32, 32, 40, 40, 40, 48]))

    def secret():
        """Only the value is the span; what names it is told apart by its context."""
        named = pick(["token", "token", "api_key", "secret", "password", "key", "access_token", "passwd", "client_secret"])
        named = pick([named, named, named.upper(), named.capitalize()])
        mark = pick([' = "', ' = "', '="', ": ", '": "', " = '", "='"])
        close = mark[-1] if mark[-1] in "\"'" else ""
        return named + mark, value(), close

    def nothing():
        return pick(
            [
                f"Version {digits(1)}.{digits(1)}.", f"{digits(1)}.{digits(1)}", f"{digits(1)}.", digits(rng.integers(1, 6)), f"{rng.integers(1900, 2030)}-{digits(2)}-{digits(2)}", f"{digits(2)}/{digits(2)}/{digits(4)}",
                f"${digits(2)}.{digits(2)}", f"{digits(2)}:{digits(2)}", f"{digits(2)}%", f"v{digits(1)}.{digits(1)}.{digits(1)}", "4.0", "@" + name(), "(" + name() + ")", f"{digits(1)},{digits(3)},{digits(3)}", f"{digits(3)}{name()}{digits(2)}",
                value(), "commit " + signs("0123456789abcdef", 40), f'{name()} = "{word()}"', f'"{word()} {word()}"', f"key: {word()}", f"the token {word()}", f"{name()}={digits(3)};", f"<{name()} class=\"{name()}\">", "# " + word(), "- " + word(), "...", "=" * int(rng.integers(2, 12)),
                "#" * int(rng.integers(1, 6)), f"{name()}_{name()}({name()})", f"http://{name()}.com/{name()}", f"[{digits(1)}]", f"({digits(4)})", signs("#*$%&|<>", 4), f"no. {digits(3)}", f"{word()}'{word(1, 3)}", "a" * int(rng.integers(3, 40)),
            ]
        )

    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    busy = pick([0.0, 0.06, 0.2, 0.3])
    text, tags, last, ends = "", [], False, []
    while len(text) < 2 * length:
        draw, before, after = rng.random(), "", ""
        if draw < busy and not last:  # two numbers side by side could be read as one
            kind = pick(KINDS)
            k = KINDS.index(kind)
            before, part, after = secret() if kind == "secret" else ("", makers[kind](), pick([""] * 8 + ["!!", "###", "%%%", "***", "&&&", "$$$", ".", ",", ")"]))
            own = [1 + 2 * k] + [2 + 2 * k] * (len(part) - 1)
        else:
            part = nothing() if draw < busy + 0.1 else word()
            own = [0] * len(part)
        last = any(own)
        gap = pick([" "] * 16 + [", ", ". ", "\n", "!! ", "### ", " | ", "; ", "*** ", "%%% ", "\t", "  ", "-", "\r\n", ".\n", "&&& ", "$$$ "])
        ends.append(len(text) + len(before + part + after))
        text += before + part + after + gap
        tags += [0] * len(before) + own + [0] * (len(after) + len(gap))
    cut = int(rng.integers(0, length))
    keep = length
    if rng.random() < 0.2:  # a text that ends of its own accord, which a window's end isn't
        keep = max([e - cut for e in ends if 3 <= e - cut <= rng.integers(3, length + 1)], default=length)
    tags = np.array((tags[cut : cut + keep] + [0] * length)[:length])
    return text[cut : cut + keep], tags


def train(seed: int = SEED, steps: int = STEPS, texts: int = TEXTS) -> Tagger:
    """Adam over batches of the labelled texts; the same tagger for the same seed."""
    rng = np.random.default_rng(seed)
    made = [labelled(rng) for _ in range(texts)]
    ids, tags = codes([t for t, _ in made], TRAIN_LENGTH), np.stack([y for _, y in made])
    tagger = Tagger(seed)
    m = {k: np.zeros(s) for k, s in Tagger.SHAPES.items()}
    v = {k: np.zeros(s) for k, s in Tagger.SHAPES.items()}
    for t in range(1, steps + 1):
        some = rng.choice(texts, BATCH, replace=False)
        _, g = tagger.loss(ids[some], tags[some])
        norm = np.sqrt(sum(float((x.astype(np.float64) ** 2).sum()) for x in g.values()))
        rate = RATE * (0.5 + 0.5 * np.cos(np.pi * t / steps))
        shrink = min(1.0, 0.25 / (norm + 1e-9))
        for k, x in g.items():
            x = x.astype(np.float64) * shrink
            m[k] = 0.9 * m[k] + 0.1 * x
            v[k] = 0.99 * v[k] + 0.01 * x * x
            tagger.p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)).astype(tagger.p[k].dtype)
    return tagger


@lru_cache(maxsize=1)
def trained() -> Tagger:
    """The tagger for production: the weights that `train` gave."""
    with open(WEIGHTS, "rb") as f:
        return Tagger.unpack(f.read())


if __name__ == "__main__":
    with open(WEIGHTS, "wb") as out:
        out.write(train().pack())

"""Personal data: exact patterns, and a character BiLSTM with CRF transitions beside them.

The patterns give the base spans of four kinds. The network reads every character of every text: a
text's windows of `WINDOW` characters overlap by `2 * MARGIN`, two LSTMs read each window in either
direction, a linear layer scores the tags and Viterbi decoding picks the best sequence (a kind may
only follow itself or nothing). Of each window the tags away from its inner edges count, so the
windows' tags form one sequence for the whole text, and spans are read off that. A span of the
network is added if it touches no base span, beats "nothing" by `MARGIN_SCORE` in log odds, and holds what
its kind must hold (`plausible`); base spans always stay.

The network is trained in numpy on labelled spans: excerpts of about `DOCS` documents chosen by a
hash (that bound is the only sample), with their base spans and with seeded personal data put
between words, written as the patterns expect and in other common ways, and look-alikes that are
none. Training is seeded: the same rows give the same network.

Defined results: a null or empty text has no spans; spans of one kind never overlap, those of
different kinds may; repeated rows are found alike; an empty table gives an empty result; extra
columns are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrack.llm.common import batch_rows, col, fresh

KINDS = ("email", "ip", "card", "phone")

# The patterns of the base spans.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}

#: Holds every ip and card that may stay: both are made of these characters, begin and end with a digit and are no shorter.
NUMERIC = re.compile(r"[0-9][\x20.0-9-]{5,}[0-9]")

Span = tuple[str, int, int]

#: Documents whose excerpts are learned from, about; excerpts of each, characters of an excerpt.
DOCS, EXCERPTS, EXCERPT = 300, 2, 80
WINDOW, MARGIN = 512, 32
#: Log odds by which an added span must beat "nothing".
MARGIN_SCORE = 6.0
HIDDEN, STEPS, BATCH, RATE, SEED = 8, 220, 64, 0.03, 11
#: Windows decoded at a time, at most.
CHUNK = 2048
TAGS = 1 + len(KINDS)
BARRED = -1e4


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _holds(kind: str, found: str) -> bool:
    """What a match of the pattern must also be."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in found.split("."))
    digits = digits_of(found)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns: kinds as listed, then by start; failing matches are dropped."""
    places = [m.span() for m in NUMERIC.finditer(text)]
    spans = _emails(text)
    for kind, where in (("ip", places), ("card", places), ("phone", [(0, len(text))] if "+" in text else [])):
        for place in where:
            spans += [(kind, *m.span()) for m in PATTERNS[kind].finditer(text, *place) if _holds(kind, m.group())]
    return spans


LOCAL = re.compile(r"[A-Za-z0-9._%+-]")


def _emails(text: str) -> list[Span]:
    """As finditer, but looking back from each @, which a local part must end at."""
    spans, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text[start - 1]):
            start -= 1
        m = PATTERNS["email"].match(text, start) if start < at else None
        if m:
            spans.append(("email", *m.span()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return spans


def plausible(kind: str, found: str) -> bool:
    """Whether a span of the network holds what its kind must hold."""
    digits = digits_of(found)
    if kind == "email":
        low = found.lower()
        return bool(re.fullmatch(r"[^\s]+\s?[(\[{<]?\s?(@|at)\s?[)\]}>]?\s?[^\s]+([.]|\s?[(\[{<]\s?dot\s?[)\]}>]\s?)[a-z0-9-]+.*", low)) and (
            "@" in low or bool(re.search(r"[(\[{<]\s?at\s?[)\]}>]", low))
        )
    if kind == "ip":
        parts = re.findall(r"[0-9]+", found)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and bool(re.search(r"[-()+./ ]", found.strip()))


# --- characters ---

# Classes: 0 after the end, 1 not ASCII, 2 blank; digits are one class, letters have no case.
_CLASS = np.ones(129, np.uint8)
for _c in range(128):
    _s = chr(_c)
    _CLASS[_c] = 2 if _c <= 32 or _c == 127 else 3 + ord("0") - 33 if _s.isdigit() else 3 + ord(_s.lower()) - 33
CLASSES = int(_CLASS.max()) + 1


def codes(text: str) -> np.ndarray:
    return _CLASS[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 128)]


# --- the network ---


@dataclass
class Tagger:
    """inputs[d]: (4 * HIDDEN, CLASSES), recurrent[d]: (4 * HIDDEN, HIDDEN) for directions forward and
    backward; gates in order input, forget, output, candidate. emit: (TAGS, 2 * HIDDEN)."""

    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    emit: np.ndarray
    bias: np.ndarray
    moves: np.ndarray  # (from, to)

    def read(self, x: np.ndarray, d: int, e: np.ndarray) -> None:
        """Add to `e` (steps, TAGS, texts) what the states of one direction over classes x (steps, texts) emit.

        A step works on the texts from the first one that has a character there, so texts in
        ascending order of length cost no more than their characters; any order gives the same."""
        h3 = 3 * HIDDEN
        scale = np.where(np.arange(4 * HIDDEN) < h3, 0.5, 1.0).astype(np.float32)[:, None]
        inputs, recurrent = self.inputs[d] * scale, self.recurrent[d] * scale
        inputs[:h3, 0] = -100  # after the end all gates are shut: state and output are zero
        inputs, recurrent = np.ascontiguousarray(inputs.T), np.ascontiguousarray(recurrent.T)
        emit = np.ascontiguousarray(self.emit[:, d * HIDDEN : (d + 1) * HIDDEN])
        steps, n = x.shape
        there = x > 0
        firsts = np.where(there.any(1), there.argmax(1), n).tolist()
        room = [np.empty(size * n, np.float32) for size in (4 * HIDDEN, 4 * HIDDEN, HIDDEN, TAGS)]
        gate = np.dtype((np.void, 4 * HIDDEN))  # HIDDEN floats that are moved as one
        states, outputs, width = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32), -1
        for k in range(steps) if d == 0 else range(steps - 1, -1, -1):
            first = firsts[k]
            if first == n:
                continue
            if width != n - first:
                width = n - first
                z, more, t = (r[: r.size // n * width].reshape(width, -1) for r in room[:3])
                gates = more.reshape(4, width, HIDDEN)  # takes z gate by gate, when `more` is in z
                by_gate, by_text, shut = gates.view(gate)[:, :, 0], z.view(gate).T, gates[:3]
                emitted = room[3][: TAGS * width].reshape(TAGS, width)
                c, h = states[first:], outputs[first:]
            np.take(inputs, x[k, first:], axis=0, out=z, mode="clip")
            np.matmul(h, recurrent, out=more)
            z += more
            by_gate[...] = by_text
            np.tanh(gates, out=gates)
            shut *= 0.5
            shut += 0.5
            c *= gates[1]
            np.multiply(gates[0], gates[3], out=t)
            c += t
            np.tanh(c, out=t)
            np.multiply(gates[2], t, out=h)
            np.matmul(emit, h.T, out=emitted)
            e[k, :, first:] += emitted

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(steps, TAGS, texts)"""
        steps, n = x.shape
        e = np.zeros((steps, TAGS, n), np.float32)
        e += self.bias[:, None]
        for d in (0, 1):
            self.read(x, d, e)
        return e

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best tags (steps, texts), and each one's emission above that of tag 0."""
        e = self.emissions(x)
        after = x == 0
        if after.any():
            np.copyto(e[:, 0], 0, where=after)
            np.copyto(e[:, 1:], BARRED, where=after[:, None])
        steps, _, n = e.shape
        score = np.empty_like(e)
        score[0] = e[0]
        stay, enter = np.diagonal(self.moves)[1:, None], self.moves[0, 1:, None]
        to_none = self.moves[:, 0][:, None]
        # Whether a kind goes on at a step (or begins there), and whether "nothing" follows a kind.
        stays, leaves = np.empty((steps, TAGS - 1, n), bool), np.empty((steps, n), bool)
        on, new = np.empty((TAGS - 1, n), np.float32), np.empty((TAGS - 1, n), np.float32)
        none = np.empty((TAGS, n), np.float32)
        for k in range(1, steps):
            before, now = score[k - 1], score[k]
            np.add(before[1:], stay, out=on)
            np.add(before[0], enter, out=new)
            np.greater(on, new, out=stays[k])
            np.maximum(on, new, out=now[1:])
            np.add(before, to_none, out=none)
            none.max(0, out=now[0])
            np.greater(now[0], none[0], out=leaves[k])
            now += e[k]
        tags = np.zeros((steps, n), np.uint8)
        tags[-1] = score[-1].argmax(0)
        for k in range(steps - 1, 0, -1):
            now, before = tags[k], tags[k - 1]
            inside = now.nonzero()[0]
            if len(inside):
                own = now[inside]
                before[inside] = own * stays[k, own - 1, inside]
            left = (leaves[k] & (now == 0)).nonzero()[0]
            if len(left):
                before[left] = (score[k - 1][:, left] + to_none).argmax(0)
        gain = np.zeros((steps, n), np.float32)
        k, j = tags.nonzero()
        gain[k, j] = e[k, tags[k, j], j] - e[k, 0, j]
        return tags, gain


def _barred() -> np.ndarray:
    bar = np.zeros((TAGS, TAGS), bool)
    bar[1:, 1:] = ~np.eye(TAGS - 1, dtype=bool)
    return bar


def _logsum(z: np.ndarray, axis: int) -> np.ndarray:
    top = z.max(axis, keepdims=True)
    return (top + np.log(np.exp(z - top).sum(axis, keepdims=True))).squeeze(axis)


def train(rows: list[tuple[str, list[Span]]]) -> Tagger:
    """A tagger from (text, spans) rows by gradient descent on the CRF's likelihood (Adam)."""
    rnd = np.random.default_rng(SEED)
    H, h4 = HIDDEN, 4 * HIDDEN
    p: dict[str, np.ndarray] = {"emit": rnd.normal(0, 0.3, (TAGS, 2 * H)), "bias": np.zeros(TAGS), "moves": np.zeros((TAGS, TAGS))}
    for d in "01":
        p["in" + d] = rnd.normal(0, 0.3, (h4, CLASSES))
        p["in" + d][H : 2 * H] += 1.0  # remember at first
        p["re" + d] = rnd.normal(0, 0.3, (h4, H))
    bar = _barred()
    length = max([len(t) for t, _ in rows], default=1)
    x = np.zeros((length, len(rows)), np.uint8)
    y = np.zeros((length, len(rows)), np.int64)
    for k, (text, spans) in enumerate(rows):
        x[: len(text), k] = codes(text)
        for kind, start, end in spans:
            y[start:end, k] = 1 + KINDS.index(kind)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))

    def forward(xs: np.ndarray, w: np.ndarray, u: np.ndarray, order: list[int]) -> tuple:
        n = xs.shape[1]
        zs, cs, hs = {}, {-1: np.zeros((H, n))}, {-1: np.zeros((H, n))}
        before = -1
        for k in order:
            z = w[:, xs[k]] + u @ hs[before]
            z[: 3 * H] = 0.5 * np.tanh(0.5 * z[: 3 * H]) + 0.5
            z[3 * H :] = np.tanh(z[3 * H :])
            zs[k] = z * (xs[k] > 0)
            cs[k] = zs[k][H : 2 * H] * cs[before] + zs[k][:H] * zs[k][3 * H :]
            hs[k] = zs[k][2 * H : 3 * H] * np.tanh(cs[k])
            before = k
        return zs, cs, hs

    def backward(xs: np.ndarray, w: np.ndarray, u: np.ndarray, order: list[int], kept: tuple, dh_out: np.ndarray) -> tuple:
        zs, cs, hs = kept
        n = xs.shape[1]
        dw, du, dh, dc = np.zeros_like(w), np.zeros_like(u), np.zeros((H, n)), np.zeros((H, n))
        for place in range(len(order) - 1, -1, -1):
            k, before = order[place], order[place - 1] if place else -1
            z, t = zs[k], np.tanh(cs[k])
            dh = dh + dh_out[k]
            i, f, o, g = z[:H], z[H : 2 * H], z[2 * H : 3 * H], z[3 * H :]
            dc = dc + dh * o * (1 - t * t)
            dz = np.concatenate([dc * g * i * (1 - i), dc * cs[before] * f * (1 - f), dh * t * o * (1 - o), dc * i * (1 - g * g)])
            one = np.zeros((n, CLASSES))
            one[np.arange(n), xs[k]] = 1
            dw += dz @ one
            du += dz @ hs[before].T
            dh, dc = u.T @ dz, dc * f
        return dw, du

    for step in range(1, STEPS + 1 if rows else 1):
        own = rnd.choice(len(rows), min(BATCH, len(rows)), replace=False)
        xs, ys = x[:, own], y[:, own]
        used = max(1, int((xs > 0).any(1).sum()))
        xs, ys = xs[:used], ys[:used]
        n, there = xs.shape[1], xs > 0
        orders = {"0": list(range(used)), "1": list(range(used - 1, -1, -1))}
        kept = {d: forward(xs, p["in" + d], p["re" + d], orders[d]) for d in "01"}
        states = np.stack([np.concatenate([kept["0"][2][k], kept["1"][2][k]]) for k in range(used)])
        moves = np.where(bar, BARRED, p["moves"])
        e = (p["emit"] @ states + p["bias"][:, None]) * there[:, None]
        e[:, 1:] += np.where(there, 0, BARRED)[:, None]
        a, b = np.empty_like(e), np.zeros_like(e)
        a[0] = e[0]
        for k in range(1, used):
            a[k] = _logsum(a[k - 1][:, None] + moves[:, :, None], 0) + e[k]
        for k in range(used - 2, -1, -1):
            b[k] = _logsum(moves[:, :, None] + (e[k + 1] + b[k + 1])[None], 1)
        total = _logsum(a[-1], 0)
        de = np.exp(a + b - total)
        np.add.at(de, (np.arange(used)[:, None], ys, np.arange(n)[None]), -1.0)
        de *= there[:, None] / n
        dm = np.zeros((TAGS, TAGS))
        for k in range(1, used):
            pair = np.exp(a[k - 1][:, None] + moves[:, :, None] + (e[k] + b[k])[None] - total)
            dm += (pair * there[k]).sum(2)
            np.add.at(dm, (ys[k - 1], ys[k]), -there[k].astype(float))
        grads = {"emit": np.einsum("ktn,khn->th", de, states), "bias": de.sum((0, 2)), "moves": np.where(bar, 0, dm / n)}
        dstates = np.matmul(p["emit"].T, de)
        for d, part in (("0", slice(0, H)), ("1", slice(H, 2 * H))):
            grads["in" + d], grads["re" + d] = backward(xs, p["in" + d], p["re" + d], orders[d], kept[d], dstates[:, part])
        norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
        rate = RATE * (1 - 0.9 * step / STEPS)
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / max(norm, 1e-12))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    f32 = {k: v.astype(np.float32) for k, v in p.items()}
    return Tagger(
        [f32["in0"], f32["in1"]], [f32["re0"], f32["re1"]], f32["emit"], f32["bias"],
        np.where(bar, np.float32(BARRED), f32["moves"]),
    )


# --- labelled spans ---


def _card(rnd: np.random.Generator) -> str:
    body = str(rnd.integers(3, 7)) + "".join(map(str, rnd.integers(0, 10, 14)))
    return next(body + str(k) for k in range(10) if luhn(body + str(k)))


def _letters(rnd: np.random.Generator, low: int, high: int) -> str:
    return "".join(chr(97 + k) for k in rnd.integers(0, 26, rnd.integers(low, high)))


def personal(rnd: np.random.Generator) -> tuple[str, str]:
    """A kind and made-up personal data of it, in one of several ways of writing."""
    kind = KINDS[rnd.integers(0, 4)]
    way = int(rnd.integers(0, 4))
    if kind == "email":
        name, host = _letters(rnd, 2, 9), _letters(rnd, 3, 8)
        if rnd.random() < 0.5:
            name += "." + str(rnd.integers(1, 99))
        end = ("com", "org", "net", "example.com")[rnd.integers(0, 4)]
        at, dot = (("@", "."), ("@", "."), (" [at] ", " [dot] "), ("(at)", "."))[way]
        return kind, name + at + host + dot + end
    if kind == "ip":
        return kind, ((".", ".", "[.]", " . ")[way]).join(map(str, rnd.integers(1, 256, 4)))
    if kind == "card":
        card = _card(rnd)
        return kind, ("", " ", "-", ".")[way].join(card[k : k + 4] for k in range(0, 16, 4))
    a, b, c = rnd.integers(200, 999), rnd.integers(200, 999), rnd.integers(1000, 9999)
    return kind, (f"+1 ({a}) {b}-{c}", f"+{rnd.integers(20, 99)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}")[way]


def look_alike(rnd: np.random.Generator) -> str:
    """Something with digits or signs that is no personal data."""
    way = int(rnd.integers(0, 8))
    n = rnd.integers
    return (
        str(n(0, 100_000)), f"{n(1900, 2100)}-{n(1, 13):02d}-{n(1, 29):02d}", f"{n(1, 9)}.{n(0, 20)}.{n(0, 20)}",
        f"{n(1, 999)},{n(0, 999):03d}.{n(0, 99):02d}", "".join("0123456789abcdef"[k] for k in n(0, 16, 24)),
        f"@{_letters(rnd, 3, 8)}", f"{n(0, 24):02d}:{n(0, 60):02d}", f"{_letters(rnd, 2, 6)}.{_letters(rnd, 2, 6)}",
    )[way]


def labelled(excerpts: list[str]) -> list[tuple[str, list[Span]]]:
    """Training rows: each excerpt with its base spans, and with data or look-alikes put between words."""
    rnd = np.random.default_rng(SEED)
    rows = []
    for text in excerpts:
        rows.append((text, base_spans(text)))
        words, parts, spans, at = text.split(" "), [], [], 0
        places = set(rnd.integers(0, len(words) + 1, 2).tolist())
        for k in range(len(words) + 1):
            for extra in [None] * (k in places) + words[k : k + 1]:
                if extra is None:
                    kind, extra = personal(rnd) if rnd.random() < 0.7 else ("", look_alike(rnd))
                    if kind:
                        spans.append((kind, at, at + len(extra)))
                parts.append(extra)
                at += len(extra) + 1
        new = " ".join(parts)
        spans += [s for s in base_spans(new) if not any(s[1] < e and b < s[2] for _, b, e in spans)]
        rows.append((new, spans))
    return rows


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Tagger:
    """A tagger from excerpts of a bounded sample of `docs`."""
    own = docs.select(col(id_col).alias("i"), col(text_col).alias("t")).filter(F.col("t").isNotNull())
    n = docs.count()
    n_chars = F.length("t")
    excerpts = F.array(*(F.substring("t", F.floor(n_chars * k / EXCERPTS).cast("int") + 1, F.lit(EXCERPT)) for k in range(EXCERPTS)))
    taken = own.filter(F.pmod(F.xxhash64("i"), F.lit(1 << 20)) < int(min(1.0, DOCS / max(n, 1)) * (1 << 20)))
    found = taken.select(F.explode(excerpts).alias("e")).filter("e <> ''").collect()
    return train(labelled(sorted({r["e"] for r in found})))


# --- whole texts ---


def tag_texts(tagger: Tagger, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its characters' tags and gains, from overlapping windows put together."""
    all_codes = [codes(t) for t in texts]
    step = WINDOW - 2 * MARGIN
    windows = [
        (min(WINDOW, len(c) - at), k, at)
        for k, c in enumerate(all_codes)
        for at in range(0, max(1, len(c) - 2 * MARGIN), step)
        if len(c)
    ]
    windows.sort()
    found = [(np.zeros(len(c), np.uint8), np.zeros(len(c), np.float32)) for c in all_codes]
    chunks = -(-len(windows) // CHUNK)
    for n in range(chunks):
        part = windows[len(windows) * n // chunks : len(windows) * (n + 1) // chunks]
        x = np.zeros((len(part), part[-1][0]), np.uint8)
        for j, (size, k, at) in enumerate(part):
            x[j, :size] = all_codes[k][at : at + size]
        tags, gain = tagger.decode(np.ascontiguousarray(x.T))
        for j in tags.any(0).nonzero()[0].tolist():  # the others are as `found` has them
            size, k, at = part[j]
            first = MARGIN if at else 0
            last = size if at + size == len(all_codes[k]) else size - MARGIN
            for whole, own in zip(found[k], (tags, gain), strict=True):
                whole[at + first : at + last] = own[first:last, j]
    return found


def added_spans(text: str, tags: np.ndarray, gain: np.ndarray, base: list[Span]) -> list[Span]:
    """Spans of the tags that may join the base spans."""
    if not tags.any():
        return []
    edges = np.flatnonzero(np.diff(tags, prepend=0, append=0))
    spans = []
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if not tags[start]:
            continue
        kind, odds = KINDS[tags[start] - 1], float(gain[start:end].sum())
        while start < end and text[start].isspace():
            start += 1
        while end > start and text[end - 1].isspace():
            end -= 1
        if odds >= MARGIN_SCORE and plausible(kind, text[start:end]) and not any(b < end and start < e for _, b, e in base):
            spans.append((kind, start, end))
    return spans


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


SPANS = "array<struct<kind string, start int, end int, base boolean>>"


def find(docs: DataFrame, tagger: Tagger, text_col: str = "text", into: str = "spans") -> DataFrame:
    """`docs` with all spans of its whole texts in `into` (renamed if taken), by kind as listed, then
    start; `base` tells those of the patterns."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

    @F.arrow_udf(SPANS)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = [
                [
                    {"kind": s[0], "start": s[1], "end": s[2], "base": s in set(base)}
                    for s in ordered(base + added)
                ]
                for base, added in all_spans(tagger, [t or "" for t in batch.to_pylist()])
            ]
            yield pa.array(out, pa.list_(kind))

    batch_rows(docs.sparkSession)
    return docs.withColumn(fresh(docs, into), of(col(text_col)))


def all_spans(tagger: Tagger, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Base and added spans of whole texts."""
    found = []
    for text, (tags, gain) in zip(texts, tag_texts(tagger, texts), strict=True):
        base = base_spans(text)
        found.append((base, added_spans(text, tags, gain, base)))
    return found


def mask_text(text: str, spans: list[Span]) -> str:
    """The text with [KIND] for each span; of overlapping spans the first names what they cover together."""
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def mask(docs: DataFrame, tagger: Tagger, text_col: str = "text") -> DataFrame:
    """`docs` with personal data replaced in `text_col`; null stays null."""

    @F.arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = batch.to_pylist()
            spans = all_spans(tagger, [t or "" for t in texts])
            yield pa.array(
                [None if t is None else mask_text(t, base + added) for t, (base, added) in zip(texts, spans, strict=True)],
                pa.string(),
            )

    batch_rows(docs.sparkSession)
    return docs.withColumn(text_col, of(col(text_col)))


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op7(docs: DataFrame) -> DataFrame:
    """Counts and digest are of the base spans; `spans` has all, `n_added` counts the network's own."""
    found = find(docs.select("doc_id", "text"), fit(docs))
    base = F.filter("spans", lambda s: s["base"])

    def of_kind(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(of_kind, KINDS),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_added"),
    )

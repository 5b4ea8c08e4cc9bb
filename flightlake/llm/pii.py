"""Personal data: fixed patterns, and a character BiLSTM with a CRF that adds to them.

The patterns give the base spans.  A bidirectional LSTM over characters with CRF transitions
is trained in numpy on labelled windows: base spans as they stand, the same spans rewritten
with other separators and words before them (`varied`), and windows without any.  A card
number is one to learn from whatever its check digit, which no tagger can see.  At most
TRAIN_WINDOWS windows and PLAIN_WINDOWS without a span are taken, those with the smallest
digests; this is the only bounded sample.

Every text is then read whole in overlapping windows.  Each position takes its tag from the
window in which it lies most central, so a span of any length is read across windows.  The
spans of a text that hold what their kind needs (`plausible`) compete, and those of the
greatest total weight that overlap neither each other nor a base span are added.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
WIDTH, STRIDE, HIDDEN = 256, 224, 12
TRAIN_WIDTH, TRAIN_STRIDE = 64, 32
TRAIN_WINDOWS, PLAIN_WINDOWS = 2000, 500
_GROUP = 512
_TAGS = 1 + 2 * len(KINDS)  # O, then begin and inside of each kind
_PAD, _OTHER = 0, 1
_SYMBOLS = "@.-+() _%:/=\"',;!?#&*$|\n"
_HIGH = 2 + len(_SYMBOLS) + 3
_CODES = _HIGH + 1
_CODE = np.full(128, _OTHER, np.uint8)
for _i, _c in enumerate(_SYMBOLS):
    _CODE[ord(_c)] = 2 + _i
_CODE[48:58] = 2 + len(_SYMBOLS)
_CODE[65:91] = 3 + len(_SYMBOLS)
_CODE[97:123] = 4 + len(_SYMBOLS)

_HINT = re.compile("[0-9@]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_NUMBER = re.compile("[0-9]+")
_BETWEEN = re.compile(r"(?<=[0-9])[^0-9]+(?=[0-9])")
_BRACKETED_AT = re.compile(r"[(\[{<]\s*at\s*[)\]}>]", re.IGNORECASE)
#: other ways to write a kind's separators, which the patterns do not know
VARIANTS = {
    0: ("(at)", " (at) ", " [at] ", " @ "),
    1: (" . ", "(.)", "[.]"),
    2: ("/", ".", "_", " - ", "  "),
    3: ("/", " / ", "_", ":"),
}
LEADS = ("", "", "contact ", "number: ", "(see) ", "id=")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str, check_cards: bool = True) -> list[Span]:
    """Leftmost matches of every pattern that also pass its check, by kind and start."""
    out: list[Span] = []
    if not _HINT.search(text):
        return out
    last = 0
    for m in _DOMAIN.finditer(text):
        at = m.start()
        low = at
        while low > last and text[low - 1] in _LOCAL:
            low -= 1
        if low < at:
            out.append((0, low, m.end()))
            last = m.end()
    # a number is read from its first digit: a later start in it can only fail alike
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups()):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and (luhn(digits) or not check_cards):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def codes(text: str) -> np.ndarray:
    """Small character classes; digits are one class, so are lower and upper case letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _CODE[np.minimum(points, 127)], np.uint8(_HIGH))


def varied(text: str, spans: Iterable[Span], seed: int) -> tuple[str, list[Span]]:
    """The text with its spans written in other ways, and where they are then."""
    rng = random.Random(seed)
    out: list[str] = []
    found: list[Span] = []
    size = last = 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], s[0])):
        if start < last:
            continue
        span, mark = text[start:end], rng.choice(VARIANTS[kind])
        if kind == 0:
            span = span.replace("@", mark)
        elif kind == 2:
            digits = _digits(span)
            span = mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
        else:
            span = _BETWEEN.sub(mark, span)
        before = text[last:start] + rng.choice(LEADS)
        size += len(before)
        found.append((kind, size, size + len(span)))
        size += len(span)
        out += [before, span]
        last = end
    return "".join(out) + text[last:], found


def window_starts(length: int, width: int = WIDTH, stride: int = STRIDE) -> np.ndarray:
    """Starts of the overlapping windows that cover a text."""
    return np.arange(0, max(length - (width - stride), min(length, 1)), stride)


class Tagger:
    """BiLSTM over character classes, linear emissions, CRF transitions."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fresh(cls, seed: int = 7) -> "Tagger":
        rng = np.random.default_rng(seed)
        w: dict[str, np.ndarray] = {}
        for side in "fb":
            w[f"x{side}"] = rng.normal(0, 0.3, (_CODES, 4 * HIDDEN)).astype(np.float32)
            w[f"x{side}"][:, HIDDEN : 2 * HIDDEN] += 1.0  # the forget gate starts open
            w[f"h{side}"] = rng.normal(0, 0.3, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        w["out"] = rng.normal(0, 0.3, (2 * HIDDEN, _TAGS)).astype(np.float32)
        w["bias"] = np.zeros(_TAGS, np.float32)
        w["move"] = np.zeros((_TAGS, _TAGS), np.float32)
        return cls(w)

    def _lstm(self, x: np.ndarray, side: str, keep: bool):
        """States by position of windows x (n, width); the backward side reads from the end."""
        n, width = x.shape
        k = HIDDEN
        half = np.ones(4 * k, np.float32)  # sigmoid(a) = tanh(a / 2) / 2 + 1 / 2
        half[: 3 * k] = 0.5
        gates_x, wh = self.w[f"x{side}"] * half, self.w[f"h{side}"] * half
        h = np.zeros((n, k), gates_x.dtype)
        c = np.zeros((n, k), gates_x.dtype)
        out, kept = np.zeros((width, n, k), gates_x.dtype), []
        columns = np.ascontiguousarray(x.T)
        for t in range(width) if side == "f" else range(width - 1, -1, -1):
            a = gates_x.take(columns[t], axis=0)
            a += h @ wh
            np.tanh(a, out=a)
            apart = np.ascontiguousarray(a.reshape(n, 4, k).transpose(1, 0, 2))
            gate, g = apart[:3] * 0.5 + 0.5, apart[3]
            before = (h, c)
            c = gate[1] * c + gate[0] * g
            tc = np.tanh(c)
            h = gate[2] * tc
            out[t] = h
            if keep:
                kept.append((t, before, gate, g, tc))
        return out, kept

    def emissions(self, x: np.ndarray, keep: bool = False):
        f, kf = self._lstm(x, "f", keep)
        b, kb = self._lstm(x, "b", keep)
        both = np.concatenate([f, b], axis=2)
        return both @ self.w["out"] + self.w["bias"], both, kf, kb

    def transitions(self) -> np.ndarray:
        """Learned moves; going on inside a kind is open only from that kind."""
        move = self.w["move"].copy()
        for kind in range(len(KINDS)):
            shut = [t for t in range(_TAGS) if t not in (1 + 2 * kind, 2 + 2 * kind)]
            move[shut, 2 + 2 * kind] = -1e4
        return move

    def gradients(self, x: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tags and its gradients."""
        n, width = x.shape
        e, both, kf, kb = self.emissions(x, keep=True)
        move = self.transitions()

        def lse(a, axis):
            top = a.max(axis=axis, keepdims=True)
            return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)

        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        for t in range(1, width):
            alpha[t] = e[t] + lse(alpha[t - 1][:, :, None] + move, 1)
        for t in range(width - 2, -1, -1):
            beta[t] = lse(move + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        total = lse(alpha[-1], 1)
        rows = np.arange(n)
        d_e = np.exp(alpha + beta - total[None, :, None])
        d_move = np.zeros_like(move)
        gold = np.zeros(n, np.float64)
        for t in range(width):
            y = tags[:, t]
            gold += e[t, rows, y]
            d_e[t, rows, y] -= 1
            if t:
                gold += move[tags[:, t - 1], y]
                pair = alpha[t - 1][:, :, None] + move + (e[t] + beta[t])[:, None, :] - total[:, None, None]
                d_move += np.exp(pair).sum(0)
                np.subtract.at(d_move, (tags[:, t - 1], y), 1)
        d_e /= n
        grads = {"move": d_move / n, "bias": d_e.sum((0, 1))}
        grads["out"] = both.reshape(-1, 2 * HIDDEN).T @ d_e.reshape(-1, _TAGS)
        d_both = d_e @ self.w["out"].T
        k = HIDDEN
        for side, kept, part in (("f", kf, slice(0, k)), ("b", kb, slice(k, 2 * k))):
            wh = self.w[f"h{side}"]
            gx, gh = np.zeros_like(self.w[f"x{side}"]), np.zeros_like(wh)
            dh_next, dc_next = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
            for t, (h0, c0), gate, g, tc in reversed(kept):
                dh = d_both[t][:, part] + dh_next
                i, f, o = gate
                dc = dh * o * (1 - tc * tc) + dc_next
                da = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                np.add.at(gx, x[:, t], da)
                gh += h0.T @ da
                dh_next, dc_next = da @ wh.T, dc * f
            grads[f"x{side}"], grads[f"h{side}"] = gx, gh
        return float((total - gold).mean()), grads

    def fit(self, x: np.ndarray, tags: np.ndarray, steps: int = 360, batch: int = 64, rate: float = 0.06, seed: int = 11) -> list[float]:
        """Adam over shuffled batches, its rate falling to nothing; returns the losses."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        losses, order, at = [], rng.permutation(len(x)), 0
        for step in range(1, steps + 1):
            if at + batch > len(x):
                order, at = rng.permutation(len(x)), 0
            rows = order[at : at + batch]
            at += batch
            loss, grads = self.gradients(x[rows], tags[rows])
            losses.append(loss)
            now = rate * 0.5 * (1 + np.cos(np.pi * (step - 1) / steps))
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            for name, g in grads.items():
                g = g * min(1.0, 5.0 / max(norm, 1e-9))
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                step_size = (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
                self.w[name] = (self.w[name] - now * step_size).astype(np.float32)
        return losses

    def _scores(self, x: np.ndarray) -> np.ndarray:
        """The emissions of windows as (width, tag, window), without what only training needs.

        Windows lie along the last axis, so gates are whole rows; the states kept here are
        twice those of `_lstm`, and the weights that read them are halved.
        """
        n, width = x.shape
        k, kind = HIDDEN, self.w["xf"].dtype
        columns = np.ascontiguousarray(x.T)
        half = np.ones(4 * k, kind)
        half[: 3 * k] = 0.5
        e, more = np.empty((width, _TAGS, n), kind), np.empty((_TAGS, n), kind)
        gates = np.empty((4 * k, n), kind)
        i, f, o, g = gates.reshape(4, k, n)
        for side, at in (("f", 0), ("b", k)):
            wx, wh = self.w[f"x{side}"] * half, np.ascontiguousarray((self.w[f"h{side}"] * half).T) / 2
            out = np.ascontiguousarray(self.w["out"][at : at + k].T) / 2
            h, c, tc = (np.zeros((k, n), kind) for _ in range(3))
            for t in range(width) if side == "f" else range(width - 1, -1, -1):
                np.matmul(wh, h, out=gates)
                gates += wx.take(columns[t], axis=0).T
                np.tanh(gates, out=gates)
                gates[: 3 * k] += 1
                c *= f
                g *= i
                c += g
                c *= 0.5
                np.tanh(c, out=tc)
                np.multiply(o, tc, out=h)
                if side == "f":
                    np.matmul(out, h, out=e[t])
                else:
                    e[t] += np.matmul(out, h, out=more)
        e += self.w["bias"][:, None]
        return e

    def _open(self, e: np.ndarray, slack: float = 0.05) -> np.ndarray:
        """Windows whose best tags may be other than O throughout; none of them is missed.

        Scores are differences from O throughout.  A run of tags starts from O, or from the
        best tag before it by the best move of any; a window is open when some run, left again
        or at the window's end, is not below zero by more than rounding.
        """
        move = self.transitions()
        move -= move[0, 0]
        begin, inside = np.arange(1, _TAGS, 2), np.arange(2, _TAGS, 2)
        enter, across = move[0, begin, None], move[1:, begin].max(0)[:, None]
        on, stay, leave = move[begin, inside, None], move[inside, inside, None], move[1:, 0].max()
        run = e[0, 1:] - e[0, 0]
        top = np.full(e.shape[2], -np.inf, e.dtype)
        for now in e[1:]:
            best = run.max(0)
            np.maximum(top, best + leave, out=top)
            after = now[1:] - now[0]
            after[1::2] += np.maximum(run[::2] + on, run[1::2] + stay)
            after[::2] += np.maximum(best + across, enter)
            run = after
        return np.flatnonzero(np.maximum(top, run.max(0)) > -slack)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of each window and, by position, how far they are above O.

        A window may open inside a span that began before it.  The way to the best score is
        looked for only in windows that a bound leaves open; in the others it is O throughout.
        """
        e = self._scores(x)
        open_ = self._open(e)
        tags, gain = np.zeros(x.shape, np.int8), np.zeros(x.shape, np.float32)
        if len(open_):
            tags[open_], gain[open_] = self._best(np.ascontiguousarray(e[:, :, open_].transpose(0, 2, 1)), self.transitions())
        return tags, gain

    def _best(self, e: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi over the emissions of windows."""
        width, n, _ = e.shape
        score, back = e[0].copy(), np.zeros((width, n, _TAGS), np.int8)
        for t in range(1, width):
            all_ = score[:, :, None] + move
            back[t] = all_.argmax(1)
            score = all_.max(1) + e[t]
        tags = np.zeros((n, width), np.int64)
        tags[:, -1] = score.argmax(1)
        for t in range(width - 1, 0, -1):
            tags[:, t - 1] = back[t][np.arange(n), tags[:, t]]
        chosen = np.take_along_axis(e, tags.T[:, :, None], 2)[:, :, 0]
        gain = (chosen - e[:, :, 0]).T
        gain[:, 1:] += move[tags[:, :-1], tags[:, 1:]] - move[0, 0]
        return tags, gain


def plausible(kind: int, text: str) -> bool:
    """What any span of the kind must have, however it is written; the model's spans are held to it."""
    n = len(_digits(text))
    if kind == 0:
        return "@" in text[1:-1] or _BRACKETED_AT.search(text, 1) is not None
    if kind == 1:
        parts = [p.lstrip("0") or "0" for p in _NUMBER.findall(text)]
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return 13 <= n <= 19 and luhn(_digits(text)) if kind == 2 else 9 <= n <= 15


def tagged_spans(tagger: Tagger, code: list[np.ndarray]) -> list[list[tuple[float, Span]]]:
    """Spans with weights of each text, read whole; `code` holds the texts' classes."""
    length = np.array([len(c) for c in code], np.int64)
    place = np.cumsum(length + WIDTH) - (length + WIDTH)
    padded = np.full(int((length + WIDTH).sum()), _PAD, np.uint8)
    starts, low, high = [], [], []
    margin = (WIDTH - STRIDE) // 2
    for c, at in zip(code, place.tolist()):
        padded[at : at + len(c)] = c
        s = window_starts(len(c))
        first, last = s + margin, s + STRIDE + margin
        first[:1], last[-1:] = 0, len(c)
        starts.append(s + at)
        low.append(first + at)
        high.append(last + at)
    begin, low, high = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (starts, low, high))
    where, tag, gain = [], [], []
    for at in range(0, len(begin), _GROUP):
        part = slice(at, at + _GROUP)
        tags, gains = tagger.decode(padded[begin[part, None] + np.arange(WIDTH)])
        row, column = np.nonzero(tags)
        position = begin[part][row] + column
        mine = (position >= low[part][row]) & (position < high[part][row])
        where += position[mine].tolist()
        tag += tags[row[mine], column[mine]].tolist()
        gain += gains[row[mine], column[mine]].tolist()
    out: list[list[tuple[float, Span]]] = [[] for _ in code]
    at = 0
    while at < len(where):
        end, weight = at + 1, gain[at]
        while end < len(where) and where[end] == where[end - 1] + 1 and tag[end] % 2 == 0 and (tag[end] - 1) // 2 == (tag[at] - 1) // 2:
            weight += gain[end]
            end += 1
        if weight > 0:
            i = int(np.searchsorted(place, where[at], "right")) - 1
            first = where[at] - int(place[i])
            out[i].append((weight, ((tag[at] - 1) // 2, first, first + end - at)))
        at = end
    return out


def reconcile(candidates: list[tuple[float, Span]], taken: list[Span]) -> list[Span]:
    """The spans of greatest total weight that overlap neither each other nor `taken`."""
    free = sorted(
        ((w, s) for w, s in candidates if not any(s[1] < e and b < s[2] for _, b, e in taken)), key=lambda c: (c[1][2], c[1])
    )
    ends = [s[2] for _, s in free]
    best: list[tuple[float, tuple]] = [(0.0, ())]
    for i, (w, s) in enumerate(free):
        total, chain = best[bisect_right(ends, s[1], 0, i)]
        best.append(max(best[-1], (total + w, (s, chain)), key=lambda b: b[0]))
    out, chain = [], best[-1][1]
    while chain:
        out.append(chain[0])
        chain = chain[1]
    return out


def written(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def labelled_windows(text: str, spans: Iterable[Span]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes and tags of every window to learn from; the first of overlapping spans counts."""
    code = np.concatenate([codes(text), np.full(TRAIN_WIDTH, _PAD, np.uint8)])
    tags = np.zeros(len(code), np.uint8)
    for kind, start, end in spans:
        if not tags[start:end].any():
            tags[start:end] = 2 + 2 * kind
            tags[start] = 1 + 2 * kind
    for s in window_starts(len(text), TRAIN_WIDTH, TRAIN_STRIDE).tolist():
        yield code[s : s + TRAIN_WIDTH], tags[s : s + TRAIN_WIDTH]


def _training(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows with their tags, as bytes: those with a digit, an `@` or a span, and one of each text without them."""
    for batch in batches:
        out = []
        for text in batch.column("text").to_pylist():
            if not text:
                continue
            seed = zlib.crc32(text.encode("utf-8", "surrogatepass"))
            if not _HINT.search(text):
                starts = window_starts(len(text), TRAIN_WIDTH, TRAIN_STRIDE)
                at = int(starts[seed % len(starts)])
                x, y = next(labelled_windows(text[at : at + TRAIN_WIDTH], []))
                out.append((True, x.tobytes(), y.tobytes()))
                continue
            base = base_spans(text, check_cards=False)
            both = [(text, base), varied(text, base, seed)] if base else [(text, base)]
            for form, spans in both:
                for i, (x, y) in enumerate(labelled_windows(form, spans)):
                    if y.any() or _HINT.search(form, i * TRAIN_STRIDE, i * TRAIN_STRIDE + TRAIN_WIDTH):
                        out.append((False, x.tobytes(), y.tobytes()))
        kinds = (pa.bool_(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=["plain", "x", "y"])


def fit_tagger(docs: DataFrame, windows: int = TRAIN_WINDOWS, plain: int = PLAIN_WINDOWS) -> Tagger | None:
    """Tagger of base spans and their variants; None where no text has any."""
    found = docs.select(F.col("text").cast("string")).mapInArrow(_training, "plain boolean, x binary, y binary")
    digest = F.md5(F.concat("x", "y"))
    rows = []
    for kind, most in ((F.col("plain"), plain), (~F.col("plain"), windows)):
        rows += found.filter(kind).select("x", "y").distinct().orderBy(digest, "x", "y").limit(most).collect()
    if not any(any(r.y) for r in rows):
        return None
    x = np.array([np.frombuffer(r.x, np.uint8) for r in rows])
    y = np.array([np.frombuffer(r.y, np.uint8) for r in rows]).astype(np.int64)
    tagger = Tagger.fresh()
    tagger.fit(x, y, batch=min(64, len(x)))
    return tagger


def find_personal_data(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for every row of `docs`.

    Counts and `spans` are of all spans, base and added; offsets are code points, ends
    exclusive.  Null text counts as empty.  Repeated rows come out as often as they went
    in; other columns are ignored; an empty table gives an empty result.
    """
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
    shared = docs.sparkSession.sparkContext.broadcast(None if tagger is None else tagger.w)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None if shared.value is None else Tagger(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            added: list[list[Span]] = [[] for _ in texts]
            if model is not None:
                for i, spans in enumerate(tagged_spans(model, [codes(t) for t in texts])):
                    able = [(w, s) for w, s in spans if plausible(s[0], texts[i][s[1] : s[2]])]
                    added[i] = reconcile(able, base[i])
            every = [sorted(b + a) for b, a in zip(base, added)]
            counts = [pa.array([sum(s[0] == k for s in spans) for spans in every], pa.int64()) for k in range(len(KINDS))]
            digest = [hashlib.sha256(written(b).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array(digest), pa.array([written(s) for s in every]),
                 pa.array([len(a) for a in added], pa.int64())], names=names)

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return texts.mapInArrow(run, schema)

"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions that adds spans.

The base spans follow four fixed patterns. The tagger is trained in numpy, on the driver, from
labelled spans of a sample of bounded size: windows of texts around base spans, clean windows
with digits, and the same windows with the span rewritten as people write it to get past a
pattern (spelled-out marks, other separators), labelled as before. Its weights have a fixed
size and travel with the tasks.

Every text is read whole. What an added span must look like is fixed (`holds`): digits with at
most three other marks between two of them, or a local part, an at sign or a spelled-out one, and
a domain with dots or spelled-out ones, of any length. Text that fits neither form can hold no
span, so only the stretches around all that does are decoded, whole and with a margin on both
sides. Each stretch is cut into windows that overlap by half. Each window is decoded, and a character's label scores are summed over
all windows that cover it, weighted by how far inside it lies; one CRF decoding over the
summed scores of a whole stretch then settles the labels, so windows cannot contradict each
other. Of its spans those are added that are certain enough, hold what their kind needs and
overlap no base span.

Defined cases: a null or empty text has no spans; repeated rows get equal results; long texts
are decoded in batches of bounded size; an empty table gives no rows; without labelled spans
in the sample nothing is added; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import table

# The kinds in the order of results, and their patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind, then start."""
    out: list[Span] = []
    # Local parts hold no at sign, so each at sign ends one run of them at most.
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            out.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    if "." in text:
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                out.append((3, *m.span()))
    return out


# ---------------------------------------------------------------- the tagger

#: Characters with an input of their own; others share one by class.
ALPHABET = "abcdefghijklmnopqrstuvwxyz@.+-_()[]{}<>,;:/ \n"
CODES = len(ALPHABET) + 4
#: Labels: none, then begin and inside of each kind.
LABELS = 1 + 2 * len(KINDS)
HIDDEN, EMBEDDED = 24, 12
WINDOW, STRIDE = 64, 32
#: Characters of context on both sides of what could be a span.
MARGIN = 40
#: Bounds of the training sample: documents read (expected), and windows held on the driver.
SAMPLE_DOCUMENTS, SAMPLE_WINDOWS = 20_000, 2_000
EPOCHS, RATE, BATCH = 25, 0.01, 128
#: Least mean log-odds of an added span's labels against no label.
CERTAIN = 4.0
#: Bounds of what is decoded together.
WINDOWS_AT_ONCE, CHARS_AT_ONCE = 512, 100_000

# Forms of added spans: digits with few marks between them, and a local part, at, and a domain.
_SEP = r"[\s\[\](){}<>-]{0,3}"
_TAIL = rf"(?:@|\bat\b){_SEP}[\w-]+(?:{_SEP}(?:\.|\bdot\b){_SEP}[\w-]+)+"
_RUN = r"[0-9](?:[^\w\n]{0,3}[0-9])+"
_AT, _DIGITS = re.compile(_TAIL, re.I), re.compile(_RUN)
_MAIL_FORM = re.compile(rf"[\w.%+-]+{_SEP}{_TAIL}", re.I)
_NUMBER_FORM = re.compile(rf"[+(]{{0,2}}{_RUN}\)?")
_NAME, _BETWEEN = re.compile(r"[\w.%+-]"), re.compile(r"[\s\[\](){}<>-]")
#: Digits that an address, the shortest kind, has at least.
_LEAST_DIGITS = 4


def _code_table() -> np.ndarray:
    codes = np.full(0x250, CODES - 1, np.int8)
    for c in range(0x250):
        char = chr(c)
        if char.lower() in ALPHABET:
            codes[c] = ALPHABET.index(char.lower())
        elif char.isdigit():
            codes[c] = len(ALPHABET)
        elif char.isalpha():
            codes[c] = len(ALPHABET) + 1
        elif char.isspace():
            codes[c] = ALPHABET.index(" ")
        else:
            codes[c] = len(ALPHABET) + 2
    return codes


_CODES = _code_table()


def encode(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < len(_CODES), _CODES[np.minimum(points, len(_CODES) - 1)], CODES - 1).astype(np.int64)


@dataclass
class Tagger:
    """Weights: embedding, one LSTM a direction, emissions, CRF transitions and starts."""

    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 11) -> Tagger:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        p = {"embed": draw(CODES, EMBEDDED) * 3, "out": draw(2 * HIDDEN, LABELS), "bias": np.zeros(LABELS, np.float32)}
        for way in ("f", "b"):
            p[f"x{way}"], p[f"h{way}"] = draw(EMBEDDED, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN)
            p[f"c{way}"] = np.repeat([0, 1, 0, 0], HIDDEN).astype(np.float32)
        p["move"], p["start"] = np.zeros((LABELS, LABELS), np.float32), np.zeros(LABELS, np.float32)
        return Tagger(p)

    def _lstm(self, x: np.ndarray, way: str) -> tuple[np.ndarray, list]:
        """States of one direction over x (time, batch, features), and what the gradient needs."""
        steps, batch, _ = x.shape
        h = c = np.zeros((batch, HIDDEN), np.float32)
        out, kept = np.empty((steps, batch, HIDDEN), np.float32), []
        inputs = x @ self.p[f"x{way}"] + self.p[f"c{way}"]
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            gates = inputs[t] + h @ self.p[f"h{way}"]
            s = 1 / (1 + np.exp(-gates[:, : 3 * HIDDEN]))
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            g = np.tanh(gates[:, 3 * HIDDEN :])
            before_h, before_c = h, c
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            kept.append((t, i, f, o, g, before_h, before_c, tc))
        return out, kept

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """Emission scores (batch, time, labels) of windows (batch, time)."""
        x = self.p["embed"][codes.T]
        both = np.concatenate([self._lstm(x, "f")[0], self._lstm(x, "b")[0]], 2)
        return (both @ self.p["out"] + self.p["bias"]).transpose(1, 0, 2)

    def loss_gradient(self, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the CRF over windows, and its gradient."""
        p, grad = self.p, {}
        batch, steps = codes.shape
        x = p["embed"][codes.T]
        forward, kept_f = self._lstm(x, "f")
        backward, kept_b = self._lstm(x, "b")
        both = np.concatenate([forward, backward], 2)
        emit = both @ p["out"] + p["bias"]

        def soft(z, axis):
            top = z.max(axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(z - top).sum(axis))

        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        alpha[0] = emit[0] + p["start"]
        for t in range(1, steps):
            alpha[t] = emit[t] + soft(alpha[t - 1][:, :, None] + p["move"], 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = soft(p["move"][None] + (emit[t + 1] + beta[t + 1])[:, None, :], 2)
        total = soft(alpha[-1], 1)
        truth = labels.T
        rows = np.arange(batch)
        own = p["start"][truth[0]] + emit[np.arange(steps)[:, None], rows, truth].sum(0)
        own = own + p["move"][truth[:-1], truth[1:]].sum(0)
        marginal = np.exp(alpha + beta - total[:, None])
        d_emit = marginal.copy()
        d_emit[np.arange(steps)[:, None], rows, truth] -= 1
        pair = np.zeros_like(p["move"])
        for t in range(1, steps):
            z = alpha[t - 1][:, :, None] + p["move"] + (emit[t] + beta[t])[:, None, :] - total[:, None, None]
            pair += np.exp(z).sum(0)
        np.add.at(pair, (truth[:-1], truth[1:]), -1)
        d_start = marginal[0].sum(0)
        np.add.at(d_start, truth[0], -1)
        grad["move"], grad["start"] = pair / batch, d_start / batch
        d_emit /= batch
        grad["out"] = np.tensordot(both, d_emit, ((0, 1), (0, 1)))
        grad["bias"] = d_emit.sum((0, 1))
        d_both = d_emit @ p["out"].T
        d_x = self._lstm_gradient(x, d_both[:, :, :HIDDEN], kept_f, "f", grad)
        d_x += self._lstm_gradient(x, d_both[:, :, HIDDEN:], kept_b, "b", grad)
        grad["embed"] = np.zeros_like(p["embed"])
        np.add.at(grad["embed"], codes.T, d_x)
        return float((total - own).mean()), grad

    def _lstm_gradient(self, x, d_out, kept, way, grad) -> np.ndarray:
        d_x, d_wx, d_wh = np.empty_like(x), np.zeros_like(self.p[f"x{way}"]), np.zeros_like(self.p[f"h{way}"])
        d_c, d_h, d_b = 0, 0, 0
        for t, i, f, o, g, before_h, before_c, tc in reversed(kept):
            dh = d_out[t] + d_h
            dc = d_c + dh * o * (1 - tc * tc)
            gates = np.concatenate([dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            d_wx += x[t].T @ gates
            d_wh += before_h.T @ gates
            d_b = d_b + gates.sum(0)
            d_x[t] = gates @ self.p[f"x{way}"].T
            d_h, d_c = gates @ self.p[f"h{way}"].T, dc * f
        grad[f"x{way}"], grad[f"h{way}"], grad[f"c{way}"] = d_wx, d_wh, d_b
        return d_x

    def best_path(self, emit: np.ndarray) -> np.ndarray:
        """Viterbi labels of one stretch (time, labels)."""
        best, back = emit[0] + self.p["start"], np.empty(emit.shape, np.int8)
        for t in range(1, len(emit)):
            z = best[:, None] + self.p["move"]
            back[t] = z.argmax(0)
            best = z.max(0) + emit[t]
        path = np.empty(len(emit), np.int64)
        path[-1] = best.argmax()
        for t in range(len(emit) - 1, 0, -1):
            path[t - 1] = back[t][path[t]]
        return path


def train(windows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> Tagger:
    """Adam over shuffled batches of windows (n, WINDOW) and their labels."""
    tagger, rng = Tagger.fresh(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    second = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            _, grad = tagger.loss_gradient(windows[some], labels[some])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            step += 1
            for k, g in grad.items():
                g = g * min(1.0, 5 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                m, v = first[k] / (1 - 0.9**step), second[k] / (1 - 0.999**step)
                tagger.p[k] = (tagger.p[k] - RATE * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return tagger


# ---------------------------------------------------------------- labelled windows


def _disguised(kind: int, found: str, rng: np.random.Generator) -> str:
    """The span as people write it to get past a pattern."""
    if kind == 0:
        at = ["@", " @ ", " at ", " [at] ", " (at) ", "(at)", "[at]"][rng.integers(7)]
        dot = [".", ".", " dot ", " [dot] ", "(dot)"][rng.integers(5)]
        local, _, domain = found.partition("@")
        return local + at + domain.replace(".", dot)
    if kind == 1:
        return found.replace(".", [".", "[.]", " . ", "."][rng.integers(4)])
    if kind == 2:
        digits = re.sub("[^0-9]", "", found)
        mark = ["", " ", "-", ".", "/"][rng.integers(5)]
        return mark.join(digits[k : k + 4] for k in range(0, len(digits), 4))
    digits = re.sub("[^0-9]", "", found)
    front = ["+", "00", "+", ""][rng.integers(4)]
    mark = ["", " ", "-", ".", "/"][rng.integers(5)]
    cut = rng.integers(2, 4)
    return front + digits[:cut] + mark + digits[cut : cut + 3] + mark + digits[cut + 3 :]


def labelled_windows(texts: list[tuple[int, str, list[Span]]], seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Windows and labels from short texts with their spans, as they are and disguised."""
    rng = np.random.default_rng(seed)
    windows, labels = [], []
    for _, text, spans in texts:
        for turn in range(2 if spans else 1):
            out, marks, end = "", [], 0
            for kind, a, b in sorted(spans, key=lambda s: s[1]):
                if a < end:
                    continue
                out += text[end:a]
                found = text[a:b] if not turn else _disguised(kind, text[a:b], rng)
                marks.append((kind, len(out), len(out) + len(found)))
                out, end = out + found, b
            out += text[end:]
            codes, truth = encode(out), np.zeros(len(out), np.int64)
            for kind, a, b in marks:
                truth[a:b] = 2 + 2 * kind
                truth[a] = 1 + 2 * kind
            for kind, a, b in marks or [(0, len(out) // 2, len(out) // 2)]:
                start = max(0, min(len(out) - WINDOW, (a + b) // 2 - int(rng.integers(8, WINDOW - 8))))
                windows.append(_padded(codes[start : start + WINDOW], ALPHABET.index("\n")))
                labels.append(_padded(truth[start : start + WINDOW], 0))
    return np.array(windows).reshape(-1, WINDOW), np.array(labels).reshape(-1, WINDOW)


def _padded(values: np.ndarray, fill: int) -> np.ndarray:
    return np.concatenate([values, np.full(WINDOW - len(values), fill, np.int64)])


def sample_for_training(docs: DataFrame) -> list[tuple[int, str, list[Span]]]:
    """At most SAMPLE_WINDOWS stretches of a sample of `docs` (text), with base spans and without."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                spans = base_spans(text or "")
                for kind, a, b in spans:
                    start = max(0, a - WINDOW)
                    piece = text[start : b + WINDOW]
                    inside = [(k, x - start, y - start) for k, x, y in spans if x >= start and y <= b + WINDOW]
                    rows.append((kind, piece, [v for s in inside for v in s]))
                marks = re.search(r"[0-9]", text or "")
                if not spans and text:
                    middle = marks.start() if marks else len(text) // 2
                    rows.append((4 if marks else 5, text[max(0, middle - WINDOW) : middle + WINDOW], []))
            yield pd.DataFrame(rows, columns=["kind", "piece", "flat"])

    share = min(1.0, SAMPLE_DOCUMENTS / max(docs.count(), 1))
    first = docs.where(F.shiftrightunsigned(F.xxhash64("text", F.lit("pii")), 11) < int(share * (1 << 53)))
    pieces = first.mapInPandas(cut, "kind int, piece string, flat array<int>")
    few = pieces.orderBy(F.col("kind") == 5, F.xxhash64("piece")).limit(SAMPLE_WINDOWS).collect()
    return [(r.kind, r.piece, [tuple(r.flat[k : k + 3]) for k in range(0, len(r.flat), 3)]) for r in few]


# ---------------------------------------------------------------- decoding whole texts


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Parts of the text, in order of their starts by form, in which every span that `holds` lies."""
    for m in _DIGITS.finditer(text):
        if sum(c in "0123456789" for c in m.group()) >= _LEAST_DIGITS:
            yield max(0, m.start() - 2), min(len(text), m.end() + 1)
    end = 0
    for m in _AT.finditer(text):
        # The local part, before up to three marks, and marks that could belong to it.
        start = m.start()
        while start > max(0, m.start() - 3) and _BETWEEN.match(text, start - 1):
            start -= 1
        while start > end and _NAME.match(text, start - 1):
            start -= 1
        if start < m.start():
            yield start, m.end()
        end = m.start()


def stretches(text: str) -> list[tuple[int, int]]:
    """The candidates of a text with a margin, merged where they touch."""
    out: list[list[int]] = []
    for start, end in sorted(candidates(text)):
        a, b = max(0, start - MARGIN), min(len(text), end + MARGIN)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def emissions(tagger: Tagger, pieces: list[np.ndarray]) -> list[np.ndarray]:
    """Label scores of coded stretches: windows that overlap by half, summed with a weight by depth.

    Windows of all stretches go through the tagger together, a bounded number at a time.
    """
    weight = 1.0 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]).astype(np.float32)
    total = [np.zeros((len(p), LABELS), np.float32) for p in pieces]
    mass = [np.zeros((len(p), 1), np.float32) for p in pieces]
    places = [(k, s) for k, p in enumerate(pieces) for s in range(0, max(1, len(p) - STRIDE), STRIDE)]
    for at in range(0, len(places), WINDOWS_AT_ONCE):
        some = places[at : at + WINDOWS_AT_ONCE]
        cut = np.array([_padded(pieces[k][s : s + WINDOW], ALPHABET.index("\n")) for k, s in some])
        for (k, s), scores in zip(some, tagger.scores(cut)):
            n = min(WINDOW, len(pieces[k]) - s)
            total[k][s : s + n] += scores[:n] * weight[:n, None]
            mass[k][s : s + n] += weight[:n, None]
    return [t / m for t, m in zip(total, mass)]


def holds(kind: int, found: str) -> bool:
    """What a span of a kind must look like."""
    if kind == 0:
        return _MAIL_FORM.fullmatch(found) is not None
    if not _NUMBER_FORM.fullmatch(found):
        return False
    digits = sum(c in "0123456789" for c in found)
    if kind == 1:
        numbers = re.findall("[0-9]+", found)
        return len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers)
    if kind == 2:
        return 13 <= digits <= 19 and _luhn(re.sub("[^0-9]", "", found))
    return 9 <= digits <= 15


def _spans_on(tagger: Tagger, emit: np.ndarray) -> list[Span]:
    """(kind, start, end) of the certain spans on the best path of a stretch."""
    path = tagger.best_path(emit)
    odds = emit[np.arange(len(path)), path] - emit[:, 0]
    out, start = [], 0
    while start < len(path):
        label, end = path[start], start + 1
        if label:
            inside = 2 + 2 * ((label - 1) // 2)
            while end < len(path) and path[end] == inside:
                end += 1
            if odds[start:end].mean() >= CERTAIN:
                out.append((int((label - 1) // 2), start, end))
        start = end
    return out


def added_spans(tagger: Tagger, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """Of each text the spans of the tagger that are certain, hold what their kind needs and overlap no base span."""
    out: list[list[Span]] = [[] for _ in texts]
    held: list[tuple[int, int, int]] = []

    def decode() -> None:
        for (k, a, _), emit in zip(held, emissions(tagger, [encode(texts[k][a:b]) for k, a, b in held])):
            text = texts[k]
            for kind, x, y in _spans_on(tagger, emit):
                x, y = a + x, a + y
                while y > x and text[y - 1] in " .,;:\n":
                    y -= 1
                while x < y and text[x] in " .,;:\n":
                    x += 1
                if y > x and holds(kind, text[x:y]) and not any(s < y and x < e for _, s, e in base[k]):
                    out[k].append((kind, x, y))
        held.clear()

    chars = 0
    for k, text in enumerate(texts):
        for a, b in stretches(text):
            held.append((k, a, b))
            chars += b - a
            if chars >= CHARS_AT_ONCE:
                decode()
                chars = 0
    decode()
    return out


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tagger: Tagger | None = None) -> DataFrame:
    """(doc_id, base, added) of every row: arrays of struct(kind, start, stop), sorted."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if tagger is None:
        windows, labels = labelled_windows(sample_for_training(narrow.select("text").where("text <> ''")))
        tagger = train(windows, labels) if labels.any() else None
    model = narrow.sparkSession.sparkContext.broadcast(tagger)
    span = "array<struct<kind:int,start:int,stop:int>>"

    @F.pandas_udf(f"struct<base:{span},added:{span}>")
    def spans(texts: pd.Series) -> pd.DataFrame:
        base = []
        for text in texts:
            base.append(base_spans(text or ""))
        whole = [text or "" for text in texts]
        added = added_spans(model.value, whole, base) if model.value is not None else [[] for _ in whole]
        rows = lambda found: [[dict(zip(("kind", "start", "stop"), s)) for s in sorted(own)] for own in found]
        return pd.DataFrame({"base": rows(base), "added": rows(added)})

    return narrow.select("doc_id", spans("text").alias("found")).select("doc_id", "found.base", "found.added")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["stop"])), ","
        )

    def number_of(kind: int):
        # The function has one parameter: to a second one Spark passes the index of the element.
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [number_of(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )

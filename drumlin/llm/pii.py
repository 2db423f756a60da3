"""Personal data: base rules, and a character BiLSTM with CRF transitions that finds what they miss.

Base rules find emails, ip addresses, payment cards and phone numbers by pattern and check. A
bidirectional LSTM over character classes with a linear-chain CRF, trained in numpy on windows
around the spans the rules label in a bounded sample of documents (some rewritten: separators
changed, country codes dropped, signs spelt out), then tags overlapping windows of every text. Each
character takes its tag from the window in which it stands farthest from an edge, and the tags of
the whole text make spans. A span is added if it overlaps no base span and holds what its kind
must hold: so no window without a digit or an at sign can add one, and such windows are not decoded.

Results for edge cases: null text is empty and has no span; texts are read whole, whatever their
length; with nothing to learn from only base spans are found; repeated rows get a result each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drumlin.llm.common import chunks, strings, tidy

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

# -- base rules ---------------------------------------------------------------------------------

#: The patterns of the base rules. An email's local part is looked up backwards from
#: its sign, and digit runs are taken whole, which finds the same matches in linear time.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done, "email"
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    found = list(_emails(text)) if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split(".")):
                found.append((m.start(), m.end(), "ip"))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(DIGIT.findall(m[0])) <= 15:
                    found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


# -- characters and windows ---------------------------------------------------------------------

WINDOW, STRIDE = 64, 32
PAD, NUMBER, LOWER, UPPER, SPACE, OTHER = range(6)
SIGNS = "@.+-(),;:\"'=_%[]/#\n"
N_CLASSES = 6 + len(SIGNS)
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
TRIGGER = re.compile(r"[0-9@]|[\[(]at[\])]", re.I)


def _class_table() -> np.ndarray:
    table = np.full(0x250, LOWER, np.uint8)
    for i in range(0xC0):
        c = chr(i)
        table[i] = NUMBER if c in "0123456789" else LOWER if c.islower() else UPPER if c.isupper() else SPACE if c.isspace() else OTHER
    for i, c in enumerate(SIGNS):
        table[ord(c)] = 6 + i
    return table


CLASSES = _class_table()


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return CLASSES[np.minimum(points, len(CLASSES) - 1)]


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a trigger."""
    starts: dict[int, None] = {}
    for m in TRIGGER.finditer(text):
        k = m.start() // STRIDE
        for start in ((k - 1) * STRIDE, k * STRIDE):
            if start >= 0:
                starts[start] = None
    return list(starts)


def _window(codes: np.ndarray, start: int) -> np.ndarray:
    out = np.zeros(WINDOW, np.uint8)
    part = codes[start : start + WINDOW]
    out[: len(part)] = part
    return out


# -- the model ----------------------------------------------------------------------------------


def _allowed() -> np.ndarray:
    """0 where a tag may follow, else a large negative number: inside only after the same kind."""
    table = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        table[:, inside] = -1e4
        table[[inside - 1, inside], inside] = 0
    return table


ALLOWED = _allowed()
FIRST = np.array([0.0 if t == 0 or t % 2 else -1e4 for t in range(TAGS)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Model:
    """Of each direction: input (by class), recurrent weights; then output weights, biases, transitions."""

    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    output: np.ndarray
    bias: np.ndarray
    moves: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.output, self.bias, self.moves]

    @staticmethod
    def new(hidden: int, seed: int) -> Model:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.3, shape)
        inputs = [draw(N_CLASSES, 4 * hidden) for _ in range(2)]
        for x in inputs:
            x[:, hidden : 2 * hidden] += 0.5  # gates that forget start open
        return Model(inputs, [draw(hidden, 4 * hidden) for _ in range(2)], draw(2 * hidden, TAGS), np.zeros(TAGS), np.zeros((TAGS, TAGS)))

    def states(self, x: np.ndarray, way: int, keep: list | None = None) -> np.ndarray:
        """Hidden states of one direction, (windows, places, hidden)."""
        w, u = self.inputs[way], self.recurrent[way]
        hidden = u.shape[0]
        h = c = np.zeros((len(x), hidden), w.dtype)
        out = np.empty((len(x), x.shape[1], hidden), w.dtype)
        for t in range(x.shape[1]) if way == 0 else range(x.shape[1] - 1, -1, -1):
            z = w[x[:, t]] + h @ u
            gates = _sigmoid(z[:, : 3 * hidden])
            g = np.tanh(z[:, 3 * hidden :])
            before, old = c, h
            c = gates[:, hidden : 2 * hidden] * before + gates[:, :hidden] * g
            tc = np.tanh(c)
            h = gates[:, 2 * hidden :] * tc
            out[:, t] = h
            if keep is not None:
                keep.append((t, gates, g, before, tc, old))
        return out

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.states(x, 0), self.states(x, 1)], axis=2) @ self.output + self.bias

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tags of each window (Viterbi)."""
        e = self.emissions(x)
        moves = (self.moves + ALLOWED).astype(e.dtype)
        score = e[:, 0] + FIRST.astype(e.dtype)
        back = np.empty(e.shape, np.int8)
        for t in range(1, e.shape[1]):
            step = score[:, :, None] + moves
            back[:, t] = step.argmax(axis=1)
            score = step.max(axis=1) + e[:, t]
        tags = np.empty(e.shape[:2], np.int8)
        tags[:, -1] = score.argmax(axis=1)
        at = np.arange(len(x))
        for t in range(e.shape[1] - 1, 0, -1):
            tags[:, t - 1] = back[at, t, tags[:, t]]
        return tags

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean negative log likelihood of tags y, in the order of parameters()."""
        n, length = x.shape
        keeps: list[list] = [[], []]
        hs = [self.states(x, way, keeps[way]) for way in range(2)]
        both = np.concatenate(hs, axis=2)
        e = both @ self.output + self.bias
        moves = self.moves + ALLOWED
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + FIRST
        for t in range(1, length):
            alpha[:, t] = _log_sum(alpha[:, t - 1][:, :, None] + moves, 1) + e[:, t]
        for t in range(length - 2, -1, -1):
            beta[:, t] = _log_sum(moves + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        total = _log_sum(alpha[:, -1], 1)
        de = np.exp(alpha + beta - total[:, None, None])
        de[np.arange(n)[:, None], np.arange(length), y] -= 1
        dmoves = np.zeros_like(moves)
        for t in range(1, length):
            dmoves += np.exp(alpha[:, t - 1][:, :, None] + moves + (e[:, t] + beta[:, t])[:, None, :] - total[:, None, None]).sum(axis=0)
        np.add.at(dmoves, (y[:, :-1], y[:, 1:]), -1.0)
        dboth = de @ self.output.T
        hidden = self.recurrent[0].shape[0]
        dinputs, drecurrent = [], []
        for way in range(2):
            dw, du = np.zeros_like(self.inputs[way]), np.zeros_like(self.recurrent[way])
            dh = dc = np.zeros((n, hidden))
            for t, gates, g, before, tc, old in reversed(keeps[way]):
                dh = dh + dboth[:, t, way * hidden : (way + 1) * hidden]
                i, f, o = gates[:, :hidden], gates[:, hidden : 2 * hidden], gates[:, 2 * hidden :]
                dc = dc + dh * o * (1 - tc**2)
                dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g**2)], axis=1)
                np.add.at(dw, x[:, t], dz)
                du += old.T @ dz
                dh, dc = dz @ self.recurrent[way].T, dc * f
            dinputs.append(dw)
            drecurrent.append(du)
        doutput = np.tensordot(both, de, axes=([0, 1], [0, 1]))
        return [g / n for g in [*dinputs, *drecurrent, doutput, de.sum(axis=(0, 1)), dmoves]]


def fit(x: np.ndarray, y: np.ndarray, *, hidden: int = 12, epochs: int = 10, batch: int = 48, rate: float = 0.02, seed: int = 3) -> Model:
    model, rng = Model.new(hidden, seed), np.random.default_rng(seed)
    params = model.parameters()
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            rows = order[at : at + batch]
            step += 1
            for i, g in enumerate(model.gradients(x[rows], y[rows])):
                g = np.clip(g, -1, 1)
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.99 * v[i] + 0.01 * g**2
                params[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)
    return Model(*[[p.astype(np.float32) for p in group] for group in (model.inputs, model.recurrent)], *[p.astype(np.float32) for p in (model.output, model.bias, model.moves)])


# -- training windows ---------------------------------------------------------------------------


def rewritten(value: str, kind: str, draw: int) -> str:
    """Another way to write the same datum."""
    if kind == "phone":
        value = re.sub(r"^\+[0-9]{1,3}[ .-]*", "", value) if draw % 2 else value
        return re.sub(r"[ ().-]+", ("-", ".", " ")[draw % 3], value).strip("-. ") if draw % 5 < 3 else value
    if kind == "card":
        digits = DIGIT.findall(value)
        return ("-", " ", ".", "")[draw % 4].join("".join(digits[i : i + 4]) for i in range(0, len(digits), 4))
    if kind == "email" and draw % 2:
        at, dot = (("[at]", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) "), (" @ ", "."))[draw // 2 % 4]
        return value.replace("@", at).replace(".", dot)
    return value


def training_windows(text: str) -> list[tuple[str, list[Span]]]:
    """A window around each base span, one with the datum rewritten, and one around other digits."""
    out: list[tuple[str, list[Span]]] = []
    spans = base_spans(text)
    for i, (start, end, kind) in enumerate(spans):
        if end - start > WINDOW - 8:
            continue
        draw = start * 7 + i
        room = WINDOW - (end - start)
        for value in dict.fromkeys((text[start:end], rewritten(text[start:end], kind, draw))):
            left = text[max(0, start - draw % room) : start]
            window = (left + value + text[end : end + WINDOW])[:WINDOW]
            # Neighbours that the window shows whole.
            marks = [s for s in base_spans(window) if not (s[0] < len(left) + len(value) and len(left) < s[1])]
            marks.append((len(left), min(len(left) + len(value), WINDOW), kind))
            out.append((window, sorted(marks)))
    taken = [(s, e) for s, e, _ in spans]
    for j, m in enumerate(re.finditer(r"[0-9]+", text)):
        if not any(s < m.end() and m.start() < e for s, e in taken) and j % 3 == 0:
            start = max(0, m.start() - m.start() % STRIDE)
            window = text[start : start + WINDOW]
            out.append((window, base_spans(window)))
    return out


def _tags(spans: list[Span]) -> np.ndarray:
    y = np.zeros(WINDOW, np.int64)
    for start, end, kind in spans:
        k = 1 + 2 * KINDS.index(kind)
        y[start:end] = k + 1
        y[start : start + 1] = k
    return y


def train(docs: DataFrame, *, sample_docs: int = 8000, windows: int = 900) -> Model | None:
    """The model of about ``sample_docs`` documents' base spans, from at most ``windows`` windows."""
    rows = docs.select("doc_id", "text")
    n = rows.count()
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1_000_003)) / 1_000_003 < sample_docs / max(n, 1)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                (w, ",".join(f"{s}:{e}:{k}" for s, e, k in spans), *dict.fromkeys(k for _, _, k in spans), "none")[:3]
                for text in strings(batch["text"])
                for w, spans in training_windows(text)
            ]
            yield pd.DataFrame(found, columns=["window", "spans", "kind"])

    found = rows.where(drawn & F.col("text").rlike("[0-9@]")).select("text").mapInPandas(tidy(cut), "window string, spans string, kind string")
    # A hash decides which windows stay, the same number of each kind.
    taken = found.dropDuplicates().groupBy("kind").agg(
        F.slice(F.array_sort(F.collect_list(F.struct(F.md5(F.concat("window", "spans")).alias("at"), "window", "spans"))), 1, windows // 5).alias("w")
    )
    chosen = sorted((r["window"], r["spans"]) for group in taken.collect() for r in group["w"])
    if not any(spans for _, spans in chosen):
        return None
    x = np.stack([_window(classes(w), 0) for w, _ in chosen])
    y = np.stack([_tags([(int(s), int(e), k) for s, e, k in (p.split(":") for p in spans.split(",") if p)]) for _, spans in chosen])
    return fit(x, y)


# -- finding ------------------------------------------------------------------------------------


def holds(value: str, kind: str) -> bool:
    """Whether a span holds what its kind must hold."""
    digits = "".join(DIGIT.findall(value))
    if kind == "email":
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+ ?(?:@|[\[(]at[\])]) ?[A-Za-z0-9-]+(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]+)+", value, re.I))
    if kind == "ip":
        parts = re.split(r" ?\. ?", value)
        return len(parts) == 4 and all(re.fullmatch("[0-9]{1,3}", x) and int(x) <= 255 for x in parts)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits) and bool(re.fullmatch(r"[0-9]+(?:[ .\-]{1,3}[0-9]+)*", value))
    return 10 <= len(digits) <= 15 and bool(re.fullmatch(r"\+?[0-9]{0,3}[ .\-]{0,2}\(?[0-9]{2,4}\)?(?:[ .\-]{1,2}[0-9]{2,4}){2,4}", value))


def _assemble(text: str, starts: list[int], tags: np.ndarray) -> list[Span]:
    """Spans from the tags of a text's windows: each character takes the tag of its most central window."""
    best: dict[int, tuple[int, int]] = {}
    for start, line in zip(starts, tags, strict=True):
        if not line.any():
            continue
        for i in np.flatnonzero(line):
            depth = min(i, WINDOW - 1 - i) if start else WINDOW - 1 - i
            at = start + int(i)
            if at < len(text) and depth >= best.get(at, (-1, 0))[0]:
                best[at] = (int(depth), int(line[i]))
    known = set(starts)
    spans: list[list] = []
    for at in sorted(best):
        depth, tag = best[at]
        # Another window may see the character better and call it nothing.
        other = [s for s in ((at // STRIDE) * STRIDE, (at // STRIDE - 1) * STRIDE) if s in known]
        if any((min(at - s, WINDOW - 1 - at + s) if s else WINDOW - 1 - at) > depth for s in other):
            continue
        kind = KINDS[(tag - 1) // 2]
        if spans and spans[-1][1] == at and spans[-1][2] == kind and tag % 2 == 0:
            spans[-1][1] = at + 1
        else:
            spans.append([at, at + 1, kind])
    return [(s, e, k) for s, e, k in spans]


def _settle(text: str, spans: list[Span], taken: list[Span]) -> list[Span]:
    """Candidates widened to whole words, trimmed and checked."""
    out: list[Span] = []
    for start, end, kind in spans:
        while start and text[start - 1] in LOCAL | {"("} and text[start] in LOCAL | {"("}:
            start -= 1
        while end < len(text) and text[end].isalnum() and text[end - 1].isalnum():
            end += 1
        while start < end and not (text[start].isalnum() or text[start] in "(+"):
            start += 1
        while start < end and not text[end - 1].isalnum():
            end -= 1
        clear = not any(s < end and start < e for s, e, _ in [*taken, *out])
        if clear and holds(text[start:end], kind):
            out.append((start, end, kind))
    return out


def find_spans(texts: list[str], model: Model | None) -> list[list[tuple[int, int, str, bool]]]:
    """Start, end, kind and whether a base rule found it, by start, then kind."""
    base = [base_spans(x) for x in texts]
    more: list[list[Span]] = [[] for _ in texts]
    if model is not None:
        starts = [window_starts(x) if TRIGGER.search(x) else [] for x in texts]
        jobs = [(i, s) for i, line in enumerate(starts) for s in line]
        tags = np.zeros((len(jobs), WINDOW), np.int8)
        codes, last = np.zeros(0, np.uint8), -1
        for at in range(0, len(jobs), 2048):
            x = np.zeros((len(jobs[at : at + 2048]), WINDOW), np.uint8)
            for row, (i, s) in enumerate(jobs[at : at + 2048]):
                if i != last:
                    codes, last = classes(texts[i]), i
                x[row] = _window(codes, s)
            tags[at : at + 2048] = model.decode(x)
        at = 0
        for i, line in enumerate(starts):
            part = tags[at : at + len(line)]
            at += len(line)
            if part.any():
                more[i] = _settle(texts[i], _assemble(texts[i], line, part), base[i])
    return [
        sorted([(*s, True) for s in a] + [(*s, False) for s in b], key=lambda s: (s[0], KINDS.index(s[2])))
        for a, b in zip(base, more, strict=True)
    ]


SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("base", T.BooleanType())])
)


def find(docs: DataFrame, model: Model | None, *, text: str = "text") -> DataFrame:
    """The rows without the text, with ``spans`` (start, end in code points, kind, base)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in (text, "spans")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = strings(batch[text])
            for start, end in chunks(texts):
                spans = find_spans(texts[start:end], sent.value)
                rows = [[dict(zip(("start", "end", "kind", "base"), s, strict=True)) for s in line] for line in spans]
                yield batch[keep][start:end].assign(spans=rows)

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("spans", SPANS)])
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text)).mapInPandas(tidy(run), schema)


def masked(text: str, spans: list[tuple[int, int, str, bool]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first, longest names it."""
    out, done = [], 0
    for start, end, kind, _ in sorted(spans, key=lambda s: (s[0], -s[1], KINDS.index(s[2]))):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: Model | None, *, text: str = "text") -> DataFrame:
    """The rows with personal data in ``text`` replaced; null stays null."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = strings(batch[text])
            found: list[str] = []
            for start, end in chunks(texts):
                spans = find_spans(texts[start:end], sent.value)
                found += [masked(x, s) if s else x for x, s in zip(texts[start:end], spans, strict=True)]
            batch[text] = [new if isinstance(old, str) else None for new, old in zip(found, batch[text], strict=True)]
            yield batch

    return docs.mapInPandas(tidy(run), docs.schema)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def registered(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    docs = docs.select("doc_id", "text")
    found = find(docs, train(docs))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))

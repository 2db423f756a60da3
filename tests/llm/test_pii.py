import hashlib
import random
import re

import numpy as np

from drumlin.llm import pii
from drumlin.llm.common import table
from tests.llm.frames import docs, rows

SF_DIR = "/root/testdata/sf0.01"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    odd = [int(d) for d in digits[::-1][::2]]
    even = [2 * int(d) for d in digits[::-1][1::2]]
    return (sum(odd) + sum(d - 9 if d > 9 else d for d in even)) % 10 == 0


def brute(text):
    out = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_rules():
    random.seed(2)
    texts = ["a@b.c@d.e.f x@y", "1.2.3.4.5.6.7.8 999.1.1.1.2", "4111 1111-1111 1111", "+1 (212) 555-0100 +12", "00001.2.3.4"]
    texts += ["".join(random.choices("1234567890.@+- ab()", k=random.randrange(60))) for _ in range(3000)]
    for text in texts:
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("9" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "a@" * 100_000):
        pii.base_spans(text)


def test_gradients():
    rng = np.random.default_rng(0)
    model = pii.Model.new(3, 1)
    x = rng.integers(0, pii.N_CLASSES, (4, 7)).astype(np.uint8)
    y = np.tile([0, 1, 2, 0, 3, 4, 0], (4, 1))

    def loss():
        e, moves = model.emissions(x), model.moves + pii.ALLOWED
        a = e[:, 0] + pii.FIRST
        gold = a[np.arange(4), y[:, 0]]
        for t in range(1, 7):
            a = pii._log_sum(a[:, :, None] + moves, 1) + e[:, t]
            gold = gold + moves[y[:, t - 1], y[:, t]] + e[np.arange(4), t, y[:, t]]
        return (pii._log_sum(a, 1) - gold).mean()

    for p, g in zip(model.parameters(), model.gradients(x, y), strict=True):
        for at in [tuple(rng.integers(0, n) for n in p.shape) for _ in range(4)]:
            old = p[at]
            p[at] = old + 1e-5
            up = loss()
            p[at] = old - 1e-5
            down = loss()
            p[at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-4


def test_whole_table(spark):
    frame = table(spark, SF_DIR, "documents")
    texts = {r.doc_id: r.text or "" for r in frame.collect()}
    found = pii.registered(frame).collect()
    assert len(found) == len(texts)
    for r in found:
        base = brute(texts[r.doc_id])
        listed = ",".join(f"{k}:{s}:{e}" for s, e, k in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, _, k in base) for kind in pii.KINDS]
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def test_tagger_adds_rewritten_data(spark):
    model = pii.train(table(spark, "/root/testdata/sf0.1", "documents"))
    text = "Then he said thonder (743) 555-3824 erin and that is the anre of it."
    (spans,) = pii.find_spans([text * 3], model)
    assert {(text * 3)[s:e] for s, e, _, _ in spans} >= {"(743) 555-3824"}
    clean = ["no digits here at all", "order 12345678 of 2024-01-02 costs 3.14159", 'token = "2321bac4d15ec8f90433955bf9d3cf61"']
    assert pii.find_spans(clean, model) == [[], [], []]


def test_windows_meet():
    text = "x" * 70 + " 4111 1111 1111 1111 " + "y" * 70
    starts = pii.window_starts(text)
    tags = np.zeros((len(starts), pii.WINDOW), np.int8)
    for row, s in enumerate(starts):
        for at in range(s, s + pii.WINDOW):
            if 71 <= at < 90:
                tags[row, at - s] = 5 if at == 71 else 6
    assert pii._assemble(text, starts, tags) == [(71, 90, "card")]


def test_edge_cases(spark):
    for frame in (docs(spark), docs(spark, extra=True)):
        found = pii.registered(frame).collect()
        assert len(found) == len(rows())
        by = {r.doc_id: r for r in found}
        assert by[7].n_email == 1 and by[7].n_phone == 1 and by[3].spans == ""
    assert pii.registered(docs(spark, empty=True)).count() == 0
    clean = {r.doc_id: r.text for r in pii.redact(docs(spark, extra=True), None).collect()}
    assert clean[7].endswith("mail me at [EMAIL] or [PHONE]") and clean[3] is None

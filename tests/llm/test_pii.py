import hashlib
import random
import re

import numpy as np
import pytest

from snapmart.llm import pii
from tests.llm.conftest import EDGE, SF

TEXTS = [
    "", "@", "a@b", "a@b.c", "x a.b+c%d-e_f@g-h.i.j k", "a@b@c.d", "a@b.c@d.e", "é@b.c", "a@b..c", "..@..", "a@b.c.", "1.2.3.4",
    "1.2.3.4.5.6.7.8", "256.1.1.1", "01.002.3.4", "1.2.3", "0000000001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1111.",
    "4111  1111 1111 1111", "41111111111111112", "4111111111111111", "+1 (234) 567-8901", "+12345678", "+1.2.3.4.5.6.7.8.9", "++44 20 7946 0958",
    "+1234567890123456", "+1 234 567 890 ", "call +44-20-7946-0958, or 10.0.0.1", "٣٤٥ +٣٤٥", "a" * 3000 + "@", "1" * 6000, "1 " * 2000,
]


def brute_force_digest(text: str | None) -> str:
    """Hash of the base spans, from the patterns as they are stated, for tests."""
    text, out = text or "", []
    stated = (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    )
    for kind, pattern in enumerate(stated):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fits = (
                True,
                all(int(p) <= 255 for p in m.group().split(".")) if kind == 1 else True,
                13 <= len(digits) <= 19 and pii._luhn(digits),
                9 <= len(digits) <= 15,
            )[kind]
            if fits:
                out.append(f"{pii.KINDS[kind]}:{m.start()}:{m.end()}")
    return hashlib.sha256(",".join(out).encode()).hexdigest()


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_follow_the_patterns(text):
    own = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.base_spans(text))
    if "1" * 5000 in text:
        assert own == ""
        return
    assert hashlib.sha256(own.encode()).hexdigest() == brute_force_digest(text)


def test_base_spans_of_random_texts():
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choice("ab1234@.@-+ ()%é\n0") for _ in range(rng.randint(0, 60)))
        own = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.base_spans(text))
        assert hashlib.sha256(own.encode()).hexdigest() == brute_force_digest(text), text


def test_gradient_matches_differences():
    tagger = pii.Tagger.fresh(1)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    rng = np.random.default_rng(0)
    codes, labels = rng.integers(0, pii.CODES, (3, 7)), rng.integers(0, pii.LABELS, (3, 7))
    _, grad = tagger.loss_gradient(codes, labels)
    for name, g in grad.items():
        for _ in range(3):
            at = tuple(rng.integers(0, s) for s in g.shape)
            old, step = tagger.p[name][at], 1e-3
            tagger.p[name][at] = old + step
            up = tagger.loss_gradient(codes, labels)[0]
            tagger.p[name][at] = old - step
            down = tagger.loss_gradient(codes, labels)[0]
            tagger.p[name][at] = old
            assert abs((up - down) / (2 * step) - g[at]) < 2e-3, name


def test_best_path_matches_all_paths():
    import itertools

    tagger = pii.Tagger.fresh(2)
    rng = np.random.default_rng(3)
    tagger.p["move"] = rng.standard_normal((pii.LABELS, pii.LABELS)).astype(np.float32)
    emit = rng.standard_normal((4, pii.LABELS)).astype(np.float32)

    def value(path):
        return tagger.p["start"][path[0]] + sum(emit[t, y] for t, y in enumerate(path)) + sum(
            tagger.p["move"][a, b] for a, b in zip(path, path[1:])
        )

    best = max(itertools.product(range(pii.LABELS), repeat=4), key=value)
    assert tuple(tagger.best_path(emit)) == best


def synthetic(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randint(2, 8)))
    out = []
    for k in range(n):
        digits = lambda m: "".join(rng.choice("0123456789") for _ in range(m))
        card = digits(15)
        card += next(d for d in "0123456789" if pii._luhn(card + d))
        found = [
            f"{word()}.{digits(2)}@{word()}.{word()}.com", ".".join(str(rng.randint(0, 255)) for _ in range(4)), card,
            f"+{digits(2)} {digits(3)} {digits(6)}", f"{digits(4)} {word()}",
        ][k % 5]
        words = [word() for _ in range(30)]
        words.insert(rng.randint(5, 25), found)
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def tagger():
    texts = synthetic(500, 1)
    windows, labels = pii.labelled_windows([(0, t, pii.base_spans(t)) for t in texts])
    return pii.train(windows, labels)


def test_held_out_accuracy(tagger):
    texts = synthetic(200, 2)
    windows, labels = pii.labelled_windows([(0, t, pii.base_spans(t)) for t in texts], seed=3)
    got = np.array([tagger.best_path(e) for e in tagger.scores(windows)])
    assert (got == labels).mean() > 0.97
    inside = labels > 0
    assert ((got > 0) & inside).sum() > 0.85 * inside.sum()


def test_disguised_spans_are_found(tagger):
    """Held-out texts whose spans are rewritten so that no pattern finds them whole."""
    rng = np.random.default_rng(7)
    texts, want = [], []
    for text in synthetic(400, 21):
        for kind, a, b in pii.base_spans(text)[:1]:
            hidden = pii._disguised(kind, text[a:b], rng)
            changed = text[:a] + hidden + text[b:]
            if not any(x < a + len(hidden) and a < y for _, x, y in pii.base_spans(changed)):
                texts.append(changed)
                want.append((kind, a, a + len(hidden)))
    found = pii.added_spans(tagger, texts, [pii.base_spans(t) for t in texts])
    hit = [any(x < e and s < y for _, x, y in own) for own, (_, s, e) in zip(found, want)]
    assert len(want) > 100 and np.mean(hit) >= 0.9
    for kind in range(4):
        of_kind = [h for h, (k, *_) in zip(hit, want) if k == kind]
        assert not of_kind or np.mean(of_kind) >= 0.8, kind


def test_clean_text_has_no_added_spans(tagger):
    for clean in ("some words go here and then reach me under " * 20, "in 1999 and 2003 there were 12 of 40 left", "Version 2.0 (section 3)"):
        assert pii.added_spans(tagger, [clean], [[]]) == [[]]


FORMS = [
    (0, "bob-at-mail-dot-example-dot-com"), (0, "x" * 60 + " [at] host [dot] net"), (0, "é.b@c.d"), (0, "a (at) b.c"), (1, "10[.]0 . 0.1"),
    (1, "255/255/0-1"), (2, "4111.1111/1111 1111"), (3, "(0044) 20 7946-0958"), (3, "+44/20/79460958"), (0, "n" * 3000 + " at h dot i"),
]


def test_every_span_that_holds_lies_in_a_stretch():
    rng = random.Random(8)
    for kind, found in FORMS:
        assert pii.holds(kind, found)
    bits = ["at", "dot", "@", ".", "-", " ", "[", ")", "\n", "ab", "é", "1", "22", "4111", "+", "/", "x@y.z", "%"]
    pieces = FORMS + [(k, "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))) for _ in range(30_000) for k in range(4)]
    held = [(k, f) for k, f in pieces if pii.holds(k, f)]
    assert {k for k, _ in held[len(FORMS):]} >= {0, 3} and len(held) > 500
    for kind, found in held:
        before, after = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40))), "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        text = f"{before}{found}{after}"
        start, end = len(before), len(before) + len(found)
        assert any(a <= start and end <= b for a, b in pii.stretches(text)), (kind, found, text)


def test_windows_of_a_long_stretch_agree(tagger):
    text = " ".join(synthetic(30, 9))
    codes = pii.encode(text)
    (emit,) = pii.emissions(tagger, [codes])
    assert emit.shape == (len(text), pii.LABELS)
    # Far from the ends the summed scores do not depend on where the stretch begins.
    (other,) = pii.emissions(tagger, [codes[pii.STRIDE :]])
    assert (np.abs(emit[200:400] - other[200 - pii.STRIDE : 400 - pii.STRIDE]) < 1e-3).all()


def test_edge_rows(spark, edge, clashing, empty, tagger):
    for docs in (edge, clashing):
        got = pii.find_personal_data(docs, tagger=tagger).collect()
        assert len(got) == len(EDGE) and all(r.base == [] for r in got)
    assert pii.find_personal_data(empty).count() == 0
    assert pii.find_personal_data(edge).count() == len(EDGE)  # nothing labelled: nothing is added


def test_query(spark):
    got = pii.op3_pii(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id for r in got} == set(docs)
    for r in got:
        assert r.base_sha256 == brute_force_digest(docs[r.doc_id])
        base = {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.base_spans(docs[r.doc_id] or "")}
        spans = r.spans.split(",") if r.spans else []
        assert base <= set(spans) and len(spans) == len(base) + r.n_added


def test_query_counts_each_kind(spark, tmp_path):
    """Rows with one, several and no spans of a kind, in any order of kinds."""
    mail, ip, card, phone = "a@b.co", "10.0.0.1", "4111 1111 1111 1111", "+44-20-7946-0958"
    rows = [
        (1, f"{ip}, {card}", (0, 1, 1, 0)), (2, f"{phone}; {phone}; {mail}", (1, 0, 0, 2)), (3, f"{mail} {mail} {mail}", (3, 0, 0, 0)),
        (4, f"{card}; {phone}, {ip}; {mail}", (1, 1, 1, 1)), (5, f"{card}", (0, 0, 1, 0)), (6, None, (0, 0, 0, 0)), (7, "none", (0, 0, 0, 0)),
        (8, "0" * 5000 + "1.2.3.4, " + "0" * 5000 + "256.2.3.4", (0, 1, 0, 0)),
    ]
    spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.op3_pii(spark, str(tmp_path)).collect()}
    assert got == {doc_id: counts for doc_id, _, counts in rows}

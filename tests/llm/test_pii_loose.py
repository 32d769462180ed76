"""Personal data in loose formats, planted in documents that the model has not seen."""

import random
import re

import pytest

from pairloom.llm import pii

WORDS = "onat erndly thess tihaing ringst beanoust thontionwh eredthou mente".split()


def card(rng):
    body = "4" + "".join(rng.choices("0123456789", k=14))
    return next(body + c for c in "0123456789" if pii.luhn(body + c))


def said(rng, s):
    return " ".join([*rng.choices(WORDS, k=6), s, *rng.choices(WORDS, k=6)]) + "."


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows, planted, wrong, at = [], [], [], 0
    for _ in range(150):
        phone = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(0, 9999):04d}"
        mail, ip = f"{rng.choice(WORDS)}.{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com", ".".join(str(rng.randint(1, 255)) for _ in range(4))
        bad = f"9{rng.randint(10**15, 10**16 - 1)}"
        lines = [said(rng, s) for s in (phone, mail, ip, card(rng), f'"a{rng.randint(10**9, 10**10 - 1)}f"', bad)]
        rows.append((at, "\n".join(lines)))
        at += 1
    for make in (
        lambda: ("phone", f"{rng.randint(200, 999)}-555-{rng.randint(0, 9999):04d}"), lambda: ("phone", f"({rng.randint(200, 999)}) 555-{rng.randint(0, 9999):04d}"),
        lambda: ("phone", f"1.{rng.randint(200, 999)}.555.{rng.randint(0, 9999):04d}"), lambda: ("email", f"{rng.choice(WORDS)}(at)example.org"),
        lambda: ("email", f"{rng.choice(WORDS)} [at] example [dot] org"), lambda: ("ip", "[.]".join(str(rng.randint(1, 255)) for _ in range(4))),
        lambda: ("card", ".".join(re.findall("....", card(rng)))),
    ):
        for _ in range(10):
            kind, s = make()
            text = said(rng, s)
            rows.append((at, text))
            planted.append((at, kind, text.index(s), text.index(s) + len(s)))
            at += 1
    for s in ("2024-01-31 12:30", "4111.1111.1111.1112", "name(at)place", "10[.]0[.]0[.]256", "555-0100"):
        rows.append((at, said(rng, s)))
        wrong.append(at)
        at += 1
    return rows, planted, wrong


def test_planted_loose_spans_are_found(spark, corpus):
    rows, planted, wrong = corpus
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    models = pii.fit_spans(docs)
    assert set(models) == set(pii.KINDS) and all(m["threshold"] < 1 for m in models.values())
    got = {r.doc_id: r for r in pii.find_spans(docs, models).collect()}
    hit = [any((s["kind"], s["start"], s["end"]) == (kind, a, b) for s in got[d].spans) for d, kind, a, b in planted]
    assert all(not got[d].base for d, *_ in planted) and sum(hit) >= 0.9 * len(hit)
    assert not any(got[d].spans for d in wrong)


def test_failed_checks_are_no_matches():
    assert pii.could_be("email", "a [at] b [dot] org") and not pii.could_be("email", "a(at)b")
    assert pii.could_be("ip", "10[.]0[.]0[.]1") and not pii.could_be("ip", "10[.]0[.]0[.]256")
    assert pii.could_be("phone", "415-555-0100 ") and not pii.could_be("phone", "2024-01-31 12") and not pii.could_be("card", "4111.1111.1111.1112")

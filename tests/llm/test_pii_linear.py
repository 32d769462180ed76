"""Contract spans on runs that stretch matching: against the patterns as stated, and in time linear in the text."""

import random
import re
import time

from pairloom.llm import pii

# the patterns of the contract, as stated
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def stated(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            s, digits = m[0], re.sub("[^0-9]", "", m[0])
            if kind == "ip":
                ok = all(int(p) <= 255 for p in s.split("."))
            elif kind == "card":
                ok = 12 <= len(digits) <= 19 and pii.luhn(digits)
            else:
                ok = kind == "email" or 9 <= len(digits) <= 15
            if ok:
                out.append((m.start(), kind, m.end()))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[1])))


def test_spans_are_those_of_the_stated_patterns():
    rng = random.Random(7)
    parts = ["1", "12", "256", ".", "..", "@", "a", "b-c", "_", "%", " ", "-", "+", "(", ")", "\n", "x.org", "4111 1111 1111 1111", "+1 (415) 555-0100", "me@x.org", "1.2.3.4", "é"]
    found = 0
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 25)))
        want = stated(text)
        assert pii.base_spans(text) == want, text
        found += len(want)
    assert found > 1000


def test_an_address_with_thousands_of_digits_is_dropped():
    text = "1" * 5000 + ".1.1.1 and 0000000000001.2.3.4 and 10.0.0.1"
    assert [s[1] for s in pii.base_spans(text)] == ["ip", "ip"]


def test_long_runs_take_linear_time():
    mail = " ann@x.org"
    for run in ("1" * 1_000_000, "a" * 1_000_000, "." * 1_000_000, "1." * 500_000, "a@" * 500_000, "+1 " * 330_000, "a@b.c_" * 160_000, "1.2.3.4 " * 20_000):
        text = run + mail
        start = time.perf_counter()
        base = pii.base_spans(text)
        pii.candidates(text, base)
        assert (len(text) - 9, "email", len(text)) in base
        assert time.perf_counter() - start < 60, run[:10]


def test_covers():
    cover = pii.Cover([(3, 5), (4, 8), (10, 12)])
    assert [cover.meets(*s) for s in ((0, 3), (0, 4), (7, 8), (8, 10), (9, 11), (12, 13))] == [False, True, True, False, True, False]
    cover.add(8, 10)
    assert cover.meets(8, 9)

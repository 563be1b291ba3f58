"""Personal data: base spans against plain patterns, labelers, estimation, and planted cases."""

from __future__ import annotations

import random
import re

import pytest

from tidemark.llm import pii

KINDS = ["email", "ip", "card", "phone"]


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(digits(m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def test_base_spans_match_plain_patterns_on_random_text():
    rng = random.Random(12)
    parts = ["a", "B.", "@", "x@y.z", "@b.c", "-", ".", " ", "1", "255", "256", "4111 1111 1111 1111", "+1", "(555) ", "555-1234", "é", "\n", "0", "4111111111111111", "..", "+", "1.2.3.4"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for part in ("a", "1", "@", "a@", "1.", "+1 ", "1 ", "a.", "@a.", "4111", "(2"):
        pii.extra_spans(part * 100_000, pii.base_spans(part * 100_000))


def test_extra_spans_overlap_nothing():
    text = "joe [at] mail [dot] example [dot] org or call (555) 234-5678, 4111.1111.1111.1111, fe80:0:0:0:1:2:3:4, +1 (555) 234-5678"
    base = pii.base_spans(text)
    extra = pii.extra_spans(text, base)
    assert [k for *_, k in extra] == ["email", "phone", "card", "ip"]
    assert all(b <= c or d <= a for a, b, _ in extra for c, d, _ in base)


def test_estimation_recovers_labelers():
    rng = random.Random(3)
    counts, true = {}, {}
    for _ in range(20_000):
        t = rng.random() < 0.4
        vote = "".join(rng.choices("yn-", [0.8, 0.1, 0.1] if t else [0.1, 0.6, 0.3])[0] for _ in range(5))
        counts["ip", vote] = counts.get(("ip", vote), 0) + 1
        true["ip", vote] = true.get(("ip", vote), 0) + t
    p = pii.estimate({k: float(n) for k, n in counts.items()})
    error = sum(n * abs(p[k] - true[k] / n) for k, n in counts.items()) / 20_000
    assert error < 0.05


def test_queries_rows(spark):
    texts = [
        None, "", "nothing here", "mail joe@example.com and ann@x.org now", "ip address 10.1.2.3 or 300.1.2.3", "card 4111 1111 1111 1111!",
        "+1 (918) 555-3922 call", "üñ 🙂 joe@example.com", "call me: (212) 555-0187 today", "contact: joe [at] example [dot] com",
        "order 212.555.0187x and 1234.5678.9012.3456", "9777946427004852",
    ]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "x"), (None, texts[5], "x")]
    rows += [(100 + i, f"write to u{i}@site{i}.org, tel +1 212 555 0{i:03d}, visa card 4111111111111111", "x") for i in range(50)]
    out = pii.find(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    assert len(out) == len(rows)
    for i, text, _ in rows:
        want = plain(text or "")
        for r in (r for r in out if r["doc_id"] == i):
            assert r["base_spans"] == ",".join(f"{k}:{a}:{b}" for a, b, k in want)
            assert [r[f"n_{k}"] for k in KINDS] == [sum(x[2] == k for x in want) for k in KINDS]
            assert set(filter(None, r["base_spans"].split(","))) <= set(filter(None, r["spans"].split(",")))
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[7]["spans"] == "email:5:20"  # positions are code points
    assert by_id[9]["spans"] == "email:9:35"  # spelled out, with a cue before it
    assert [by_id[i]["spans"] for i in (0, 1, 2, 10)] == [""] * 4
    again = pii.find(spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_near_misses_are_candidates_and_learn_to_be_no_spans(spark):
    texts = ["see 300.1.2.3 and 1.2.3.999", "order 4111111111111112", "+12 34 call", "by @someone here", "joe@localhost", "version 1.2.3.4000"]
    for text in texts:
        assert pii.base_spans(text) == [] and pii.extra_spans(text, []) != []
        assert all("n" in pii.votes(text, *span, False) for span in pii.extra_spans(text, []))
    rng = random.Random(7)
    rows = []
    for i in range(400):
        good = [f"mail u{i}@site{i}.org", f"tel +1 212 555 0{i:03d}", "visa card 4111111111111111", f"host ip 10.{i % 200}.3.{i % 250}"]
        bad = [f"by @user{i} ", f"order {4111111111110000 + 10 * i + (i % 9) + 1}", f"+{i} {i}", f"version 1.{i % 90}.3.{300 + i}"]
        rows.append((i, ", ".join(rng.sample(good, 2) + rng.sample(bad, 2)) + "."))
    rows += [(1000, "contact: joe [at] mail [dot] example [dot] com"), (1001, "order 1234.5678.9012.3456"), (1002, "call me (212) 555-0187")]
    out = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows[:400]:
        want = plain(text)
        assert out[i]["spans"] == ",".join(f"{k}:{a}:{b}" for a, b, k in want)  # no near miss is taken
    assert out[1000]["spans"].startswith("email:9:") and out[1001]["spans"] == "" and out[1002]["spans"].startswith("phone:8:")


def plain_estimate(counts, rounds=50, prior=2.0):
    """The same estimation, written out candidate by candidate for one kind."""
    from math import exp, log, prod

    pseudo = {True: dict(zip("yn-", (0.5, 0.1, 0.4), strict=True)), False: dict(zip("yn-", (0.2, 0.4, 0.4), strict=True))}
    p = {v: 1 / (1 + exp(-(v.count("y") - 2 * v.count("n") - 1))) for v in counts}
    total = sum(counts.values())
    for _ in range(rounds):
        share = {t: {v: (p[v] if t else 1 - p[v]) * n for v, n in counts.items()} for t in (True, False)}
        common = min(0.99, max(0.01, (sum(share[True].values()) + prior) / (total + 2 * prior)))
        rates = {}
        for t in (True, False):
            for k in range(5):
                told = {c: prior * pseudo[t][c] + sum(s for v, s in share[t].items() if v[k] == c) for c in "yn-"}
                rates[t, k] = {c: x / sum(told.values()) for c, x in told.items()}
        odds = {v: log(common / (1 - common)) + log(prod(rates[True, k][v[k]] / rates[False, k][v[k]] for k in range(5))) for v in counts}
        p = {v: 1 / (1 + exp(-x)) for v, x in odds.items()}
    return p


def test_estimation_equals_a_plain_version():
    rng = random.Random(21)
    counts = {"".join(rng.choices("yn-", k=5)): rng.randint(1, 300) for _ in range(40)}
    got = pii.estimate({("card", v): float(n) for v, n in counts.items()})
    want = plain_estimate(counts)
    assert all(abs(got["card", v] - want[v]) < 1e-9 for v in counts)


def test_empty_table(spark):
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("kind", KINDS)
def test_votes_have_one_letter_per_labeler(kind):
    assert re.fullmatch(r"[yn-]{5}", pii.votes("+1.2.3.4 a@b.c", 0, 8, kind, True))

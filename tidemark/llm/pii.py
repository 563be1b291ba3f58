"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs the labelers, and a
classifier trained on the weighed votes decides.

1. One pass over the whole texts finds candidates of both classes. Base candidates follow fixed patterns and always count.
   Extra ones are looser (spelled-out e-mail addresses, national phone numbers, IPv6 addresses, card numbers parted by dots
   or slashes) or near misses: what begins like a base span and fails its rule (digits without a checksum, quads above 255,
   too few or many digits, an ``@`` without a domain). Near misses teach the labelers' rates for what is no personal data.
2. Five labelers vote yes, no or nothing on each candidate: strict pattern (no for a near miss), gazetteer (domain endings,
   card issuer prefixes, reserved address blocks, area codes), words before it that speak for or against it, its borders,
   and a checksum or length rule.
3. Candidates are counted by kind, votes and shape: a bounded table, whatever the corpus. On it, expectation-maximisation
   finds per kind how often each labeler is right (both classes, three outcomes) and how common true spans are.
4. A logistic classifier over votes, kind and shape learns from those probabilities, weighted by the counts.
5. An extra candidate becomes a span if the classifier gives it at least ``accept``; no other rule follows. Base spans are
   never dropped.

Scale: texts are read once, by tasks that need no shuffle; what they find is stored (spans only, no text), and counting
pre-aggregates before its shuffle. Patterns are linear in the length of a text, also on long runs of one character.

Defined cases: null and empty texts have no spans. Repeated rows are judged each. With no candidates nothing is learned.
Positions are code points, end exclusive.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "gazetteer", "context", "border", "check")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGIT = re.compile(r"[0-9]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}"
    r"(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z0-9-]{1,63}){1,4}"
)
NATIONAL = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])")
IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
PARTED_CARD = re.compile(r"(?<![0-9A-Za-z./])[0-9]{4}(?:[./][0-9]{4}){3}(?![0-9A-Za-z/])")

# Gazetteers.
DOMAIN_ENDINGS = frozenset("com org net edu gov io info biz de fr es uk eu us ca ch at it nl example test".split())
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "22", "23", "24", "25", "26", "27")
CUES = {
    "email": re.compile(r"mail|contact|write to|adresse|correo", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|login from", re.I),
    "card": re.compile(r"card|visa|amex|karte|carte|tarjeta|payment", re.I),
    "phone": re.compile(r"tel|phone|call|fax|mobile|m[oó]vil|handy|fon\b", re.I),
}
# words before a number that say it is something else
AGAINST = {
    "email": re.compile(r"\bby @?$|\bvia @?$|twitter|handle", re.I),
    "ip": re.compile(r"version|release|section|chapter|§|\bv\.? ?$", re.I),
    "card": re.compile(r"order|invoice|isbn|serial|tracking|\bid\b|article|bestell|rechnung", re.I),
    "phone": re.compile(r"order|invoice|isbn|serial|tracking|\bid\b|bestell|rechnung", re.I),
}
CUE_WIDTH = 32
HANDLE = re.compile(r"@[A-Za-z0-9-]{2,}")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def email_spans(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping; each ``@`` looks back over its local part, so a long run is read once."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        done = match.end() if match else at + 1
        if match:
            out.append((start, done))
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), ordered by start, then kind as listed."""
    out = [(a, b, "email") for a, b in email_spans(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), m.end(), "ip"))
        for m in CARD.finditer(text):
            d = digits_of(m[0])
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(digits_of(m[0])) <= 15:
                    out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def near_misses(text: str) -> list[tuple[int, int, str]]:
    """What begins like a base span and fails its rule; may overlap base spans."""
    found = []
    if "@" in text:
        for m in HANDLE.finditer(text):
            start = m.start()
            while start > max(0, m.start() - 64) and text[start - 1] in LOCAL:
                start -= 1
            found.append((start, m.end(), "email"))
    if DIGIT.search(text):
        found += [(m.start(), m.end(), "ip") for m in IP.finditer(text)]
        found += [(m.start(), m.end(), "card") for m in CARD.finditer(text) if 12 <= len(digits_of(m[0])) <= 20]
        if "+" in text:
            found += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text)]
    return found


def extra_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Looser candidates and near misses that overlap neither base spans nor each other, leftmost first."""
    found = near_misses(text)
    if "at]" in text or "at)" in text or "AT]" in text or "AT)" in text:
        found += [(m.start(), m.end(), "email") for m in SPELLED.finditer(text)]
    if DIGIT.search(text):
        found += [(m.start(), m.end(), "phone") for m in NATIONAL.finditer(text)]
        found += [(m.start(), m.end(), "card") for m in PARTED_CARD.finditer(text)]
        if ":" in text:
            found += [(m.start(), m.end(), "ip") for m in IPV6.finditer(text)]
    if not found:
        return []
    out, taken, at, end = [], sorted((a, b) for a, b, _ in base), 0, 0
    for a, b, kind in sorted(found):
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if a >= end and not any(x < b for x, _ in taken[at : at + 1]):
            out.append((a, b, kind))
            end = b
    return out


def votes(text: str, start: int, end: int, kind: str, is_base: bool) -> str:
    """One letter per labeler: y, n or - (no opinion)."""
    span = text[start:end]
    d = digits_of(span)
    strict = {"email": HANDLE, "ip": IP, "card": CARD, "phone": PHONE}[kind]
    # a near miss has a base span's form and not its rule; a looser candidate has another form
    missed = strict.search(span) if kind == "email" else strict.fullmatch(span)
    pattern = "y" if is_base else "n" if missed else "-"
    if kind == "email":
        last = re.split(r"[.\])(\[ ]+", span.rstrip(".-"))[-1].lower()
        gazetteer = "y" if last in DOMAIN_ENDINGS else "-"
        check = "y" if len(span) <= 254 and re.search(r"[.\])]", span.split("@")[-1]) else "n"
    elif kind == "ip":
        first = span.split(".")[0].lstrip("0") or "0"
        gazetteer = "-" if ":" in span else "n" if first in ("0", "127", "255") or len(first) > 3 or int(first) > 255 else "y"
        quad = span.split(".")
        check = "y" if ":" in span or all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in quad) else "n"
    elif kind == "card":
        gazetteer = "y" if d.startswith(CARD_PREFIXES) else "-"
        check = "y" if 14 <= len(d) <= 19 and luhn(d) and len(set(d)) > 1 else "n"
    else:
        gazetteer = "y" if span[0] == "+" and span[1] != "0" else "-"
        check = "y" if 10 <= len(d) <= 15 and len(set(d)) > 2 else "n"
    lead = text[max(0, start - CUE_WIDTH) : start]
    context = "y" if CUES[kind].search(lead) else "n" if AGAINST[kind].search(lead) else "-"
    before, after = text[start - 1 : start], text[end : end + 1]
    border = "n" if before.isalnum() or after.isalnum() else "y"
    return pattern + gazetteer + context + border + check


def shape(text: str, start: int, end: int) -> str:
    """A coarse form of a span: size class and whether it has separators."""
    span = text[start:end]
    size = "s" if len(span) < 12 else "m" if len(span) < 20 else "l"
    return size + ("p" if any(c in " ().-/[]:" for c in span) else "-")


def candidates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, base spans as text, and all candidates (start, end, kind, base, votes, shape). ``docs``: doc_id, text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for text in pdf["text"]:
                text = text if isinstance(text, str) else ""
                base = base_spans(text)
                rows = [(*s, True) for s in base] + [(*s, False) for s in extra_spans(text, base)]
                found.append(
                    [
                        {"s": a, "e": b, "kind": k, "base": is_base, "votes": votes(text, a, b, k, is_base), "shape": shape(text, a, b)}
                        for a, b, k, is_base in rows
                    ]
                )
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "found": found})

    kind = docs.schema["doc_id"].dataType.simpleString()
    entry = "struct<s:long,e:long,kind:string,base:boolean,votes:string,shape:string>"
    return docs.mapInPandas(run, f"doc_id {kind}, found array<{entry}>")


def estimate(counts: dict[tuple[str, str], float], rounds: int = 50, prior: float = 2.0) -> dict[tuple[str, str], float]:
    """Probability that a candidate is true per (kind, votes), by expectation-maximisation over the vote counts.

    The start is the balance of votes; ``prior`` pseudo-counts keep labelers with little evidence near better than chance.
    """
    out: dict[tuple[str, str], float] = {}
    outcome = {"y": 0, "n": 1, "-": 2}
    for kind in sorted({k for k, _ in counts}):
        patterns = sorted(v for k, v in counts if k == kind)
        weight = np.array([counts[kind, v] for v in patterns])
        seen = np.array([[outcome[c] for c in v] for v in patterns])
        balance = (seen == 0).sum(axis=1) - 2 * (seen == 1).sum(axis=1)
        p = 1 / (1 + np.exp(-(balance - 1.0)))
        believed = np.array([[0.5, 0.1, 0.4], [0.2, 0.4, 0.4]])  # of a true and of a false candidate
        for _ in range(rounds):
            share = np.stack((p, 1 - p)) * weight
            common = np.clip((share[0].sum() + prior) / (weight.sum() + 2 * prior), 0.01, 0.99)
            logs = np.log([common, 1 - common])[:, None] + np.zeros((2, len(patterns)))
            for labeler in range(seen.shape[1]):
                told = np.stack([np.bincount(seen[:, labeler], s, 3) for s in share]) + prior * believed
                logs += np.log(told / told.sum(axis=1, keepdims=True))[:, seen[:, labeler]]
            p = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -500, 500)))
        out.update({(kind, v): float(x) for v, x in zip(patterns, p, strict=True)})
    return out


def features(kind: str, vote: str, form: str) -> np.ndarray:
    row = [1.0] + [float(kind == k) for k in KINDS]
    for c in vote:
        row += [float(c == "y"), float(c == "n")]
    return np.array(row + [float(form[0] == "s"), float(form[0] == "l"), float(form[1] == "p")])


def train_classifier(
    counts: dict[tuple[str, str, str], float], true: dict[tuple[str, str], float], rounds: int = 300, ridge: float = 1e-3
) -> np.ndarray:
    """Weights of a logistic classifier on the expected labels, by damped Newton steps on the weighted mean loss."""
    keys = sorted(counts)
    x = np.stack([features(*k) for k in keys])
    y = np.array([true[k[0], k[1]] for k in keys])
    kind_total = {kind: sum(n for k, n in counts.items() if k[0] == kind) for kind in KINDS}
    n = np.array([counts[k] / kind_total[k[0]] for k in keys])  # kinds weigh alike, however common
    n /= n.sum()
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        curve = x.T @ (x * (n * p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        w -= np.linalg.solve(curve, x.T @ (n * (p - y)) + ridge * w) * 0.5
    return w


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = 0.9) -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base), base_spans and spans (kind:start:end lists)."""
    thin = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = store(candidates(thin), "pii-candidates")
    counted = (
        found.select(F.explode("found").alias("c"))
        .groupBy("c.kind", "c.votes", "c.shape")
        .agg(F.count("*").alias("n"))
        .collect()  # at most 4 kinds x 3^5 votes x 6 shapes
    )
    by_shape = {(r["kind"], r["votes"], r["shape"]): float(r["n"]) for r in counted}
    by_votes: dict[tuple[str, str], float] = {}
    for (kind, vote, _), n in by_shape.items():
        by_votes[kind, vote] = by_votes.get((kind, vote), 0.0) + n
    yes: list[str] = []
    if by_shape:
        w = train_classifier(by_shape, estimate(by_votes))
        for kind, vote, form in sorted(by_shape):
            score = 1 / (1 + math.exp(-float(features(kind, vote, form) @ w)))
            if score >= accept:
                yes.append(f"{kind}/{vote}/{form}")
    wanted = F.array(*[F.lit(x) for x in yes]).cast("array<string>")
    is_base = F.filter("found", lambda c: c["base"])
    chosen = F.filter(
        "found", lambda c: c["base"] | F.array_contains(wanted, F.concat_ws("/", c["kind"], c["votes"], c["shape"]))
    )

    def listed(spans):
        rank = lambda c: F.array_position(F.array(*[F.lit(k) for k in KINDS]), c["kind"])
        ordered = F.sort_array(
            F.transform(spans, lambda c: F.struct(c["s"].alias("s"), rank(c).alias("r"), c["kind"].alias("kind"), c["e"].alias("e")))
        )
        return F.array_join(F.transform(ordered, lambda c: F.concat_ws(":", c["kind"], c["s"].cast("string"), c["e"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter(is_base, lambda c: c["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{k}") for k in KINDS],
        listed(is_base).alias("base_spans"),
        listed(chosen).alias("spans"),
    )

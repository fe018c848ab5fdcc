"""Personal data by weak supervision.

Candidates are the matches of strict patterns for four kinds of personal data, and of looser ones for these,
for secrets such as keys and tokens, and for bank accounts. Labelers vote for or against each candidate, or
abstain: patterns, lists (gazetteers), the words around it, and its structure. Expectation-maximisation
estimates how reliable each labeler is, from the counts of every pattern of votes over all documents;
the counts are few, whatever the number of documents. A vote for never speaks against, however rare its
kind is. The posteriors then train a logistic classifier on the shape of the spans, which decides on the
looser candidates; none is taken that no labeler votes for, or that its structure (such as a checksum)
rules out. Matches of the strict patterns always stay.

Texts are read once. Each document keeps its candidates in one row, so nothing is joined.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import stage

KINDS = ("email", "ip", "card", "phone", "secret", "iban")

#: Kinds that have a strict pattern.
STRICT = KINDS[:4]

#: Posterior and classifier probability that a looser candidate needs.
ACCEPT = 0.9

# The strict patterns.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9][0-9.]*")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser patterns.
SPOKEN = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?"
    r"[A-Za-z0-9-]{1,63}\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?[A-Za-z]{2,24}(?![A-Za-z0-9-])"
)
SPOKEN_HINT = re.compile(r"[\[(]dot[\])]|\x20dot\x20")
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-]*[0-9])")

SECRET = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
KNOWN_KEY = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abpr]-|sk-[A-Za-z0-9]{20,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{10,}")
HEX = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})")
NAMED = re.compile(r"""["'\x60]?\s*(?:[:=]|=>|is|ist|est|es)\s*["'\x60]?$""", re.I)

# Gazetteers.
TOP_LEVEL = frozenset("com org net edu gov int info io biz de fr es it nl uk eu us ca ch at be pl se no fi dk pt ie jp cn in br au".split())
CALLING = tuple("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 351 352 353 358 420 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91".split())
COUNTRIES = frozenset("AD AT BE BG CH CY CZ DE DK EE ES FI FR GB GI GR HR HU IE IS IT LI LT LU LV MC MT NL NO PL PT RO SE SI SK SM TR".split())
ISSUERS = ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "60", "62", "65", "2")

CONTEXT = 32
FOR = {
    "email": re.compile(r"mail|contact|write|reach|kontakt|schreib|correo|courriel|contacto", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|adresse|login|client|dirección", re.I),
    "card": re.compile(r"card|visa|master|credit|debit|amex|karte|carte|tarjeta", re.I),
    "secret": re.compile(r"token|secret|api[_-]?key|access[_-]?key|passw|pwd|bearer|credential|private|auth", re.I),
    "iban": re.compile(r"iban|account|konto|compte|cuenta|bank|bic|swift", re.I),
    "phone": re.compile(r"tel|phone|call|fax|mobile|cell|anruf|appel|llam|whatsapp", re.I),
}
AGAINST = re.compile(r"version|release|order|invoice|isbn|issn|serial|sku|ticket|chapter|section|figure|ref\b|no\.", re.I)

LABELERS = ("pattern", "gazetteer", "context", "border", "structure")

SPANS = "array<struct<kind: tinyint, start: int, stop: int, base: boolean, votes: int, shape: int>>"
SPAN = pa.struct(
    [
        ("kind", pa.int8()),
        ("start", pa.int32()),
        ("stop", pa.int32()),
        ("base", pa.bool_()),
        ("votes", pa.int32()),
        ("shape", pa.int32()),
    ]
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from the sign in their middle, as a run of letters without one costs nothing then."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        at = text.find("@", max(at + 1, done))


def matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, stop, strict) of the strict patterns' matches; failing ones are not strict."""
    for start, stop in _emails(text):
        yield 0, start, stop, True
    if DOTTED.search(text):
        if "." in text:
            for run in DOTTED.finditer(text):
                if run.group().count(".") >= 3:
                    for m in IP.finditer(text, run.start(), run.end()):
                        parts = m.group().split(".")
                        yield 1, m.start(), m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m.group().replace(" ", "").replace("-", "")
                yield 2, m.start(), m.end(), 16 <= len(digits) <= 19 and luhn(digits)
        if "+" in text:
            for m in PHONE.finditer(text):
                yield 3, m.start(), m.end(), 8 <= sum(c.isdigit() for c in m.group()) <= 15


def mod97(account: str) -> bool:
    """Whether the check digits of a bank account are right."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _looser(text: str) -> Iterator[tuple[int, int, int]]:
    if SPOKEN_HINT.search(text):
        for m in SPOKEN.finditer(text):
            yield 0, m.start(), m.end()
    if DOTTED.search(text):
        for m in LOCAL_PHONE.finditer(text):
            yield 3, m.start(), m.end()
        for m in SECRET.finditer(text):
            if any(c.isdigit() for c in m.group()) and any(c.isalpha() for c in m.group()):
                yield 4, m.start(), m.end()
        for m in IBAN.finditer(text):
            yield 5, m.start(), m.end()


def _digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def _votes(text: str, kind: int, start: int, stop: int, strict: bool) -> list[int]:
    """A vote of each labeler: 1 for, -1 against, 0 abstains."""
    span, digits = text[start:stop], _digits(text[start:stop])
    pattern = 1 if strict else (0 if kind in (0, 3) else -1)
    if kind == 0:
        listed = 1 if re.split(r"[^A-Za-z]+", span.lower())[-1] in TOP_LEVEL else 0
        structure = 1 if len(span) <= 254 and ".." not in span else -1
    elif kind == 1:
        listed = 1 if span.startswith(("10.", "192.168.", "127.", "172.")) else 0
        structure = 1 if strict and not any(len(p) > 1 and p[0] == "0" for p in span.split(".")) else -1
    elif kind == 2:
        listed = 1 if digits.startswith(ISSUERS) else -1
        structure = 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
    elif kind == 4:
        pattern = 1 if KNOWN_KEY.match(span) or HEX.fullmatch(span.rstrip("=")) else 0
        listed = 1 if NAMED.search(text[max(0, start - CONTEXT) : start]) else 0
        mixed = sum(a.isdigit() != b.isdigit() for a, b in zip(span, span[1:]))
        structure = 1 if mixed >= 4 else (-1 if mixed < 2 or "/" in span and span.count("/") > 2 else 0)
    elif kind == 5:
        pattern, listed = 0, 1 if span[:2] in COUNTRIES else -1
        structure = 1 if mod97(span.replace(" ", "")) else -1
    else:
        led = re.search(r"\+([0-9]{1,3})[\x20.-]?$", text[max(0, start - 5) : start])
        listed = (1 if digits.startswith(CALLING) else -1) if span[0] == "+" else int(bool(led) and led[1] in CALLING)
        structure = 1 if (8 if span[0] == "+" else 10) <= len(digits) <= 15 else -1
    left = text[max(0, start - CONTEXT) : start]
    around = left + " " + text[stop : stop + CONTEXT]
    context = -1 if AGAINST.search(left) else (1 if FOR[KINDS[kind]].search(around) else 0)
    inside = (start > 0 and text[start - 1].isalnum()) or (stop < len(text) and text[stop].isalnum())
    return [pattern, listed, context, -1 if inside else 0, structure]


def _shape(span: str) -> int:
    """A span's shape in few values: its digits, separators, letters and length."""
    digits, letters = len(_digits(span)), sum(c.isalpha() for c in span)
    marks = len(span) - digits - letters
    bins = (min(digits // 4, 5), min(marks // 2, 3), 0 if not letters else (1 if letters > digits else 2), min(len(span) // 8, 4), "@" in span, span[0] == "+")
    code = 0
    for value, size in zip(bins, (6, 4, 3, 5, 2, 2)):
        code = code * size + int(value)
    return code


def _features(shape: int, votes: int) -> list[float]:
    """What the classifier sees of a span: its shape, and what its structure says."""
    out: list[float] = [float(_vote_row(votes)[LABELERS.index("structure")] == v) for v in range(3)]
    for size in (2, 2, 5, 3, 4, 6):
        out += [float(shape % size == i) for i in range(size)]
        shape //= size
    return [1.0, *out]


def candidates(text: str) -> list[dict]:
    """All candidates of a text. Looser ones that touch a strict match are left out."""
    strict, rest = [], []
    for kind, start, stop, base in matches(text):
        (strict if base else rest).append((kind, start, stop))
    rest += _looser(text)
    if rest and strict:
        order = sorted((a, b) for _, a, b in strict)
        starts = np.array([a for a, _ in order])
        ends = np.maximum.accumulate(np.array([b for _, b in order]))
        rest = [x for x in rest if not ((i := int(np.searchsorted(starts, x[2]))) and ends[i - 1] > x[1])]
    out = []
    for base, found in ((True, strict), (False, rest)):
        for kind, start, stop in found:
            code = 0
            for v in _votes(text, kind, start, stop, base):
                code = code * 3 + v + 1
            out.append(dict(kind=kind, start=start, stop=stop, base=base, votes=code, shape=_shape(text[start:stop])))
    return out


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, found = batch.column(0), []
        for text in batch.column(1):
            found.append(candidates(text.as_py()) if text.is_valid else [])
        yield pa.record_batch([ids, pa.array(found, pa.list_(SPAN))], names=["__key", "found"])


@dataclass
class Aggregate:
    """What the labelers' votes and the spans' shapes say: probabilities by (kind, votes) and (kind, votes, shape)."""

    posterior: dict[tuple[int, int], float]
    classifier: dict[tuple[int, int, int], float]

    def accepted(self) -> list[tuple[int, int, int]]:
        """(kind, votes, shape) of the looser candidates that count as personal data."""
        return [
            (k, v, s) for (k, v, s), q in self.classifier.items() if min(self.posterior[k, v], q) >= ACCEPT and supported(v)
        ]


def supported(code: int) -> bool:
    """Whether some labeler votes for a candidate and its structure does not rule it out."""
    row = _vote_row(code)
    return max(row) == 2 and row[LABELERS.index("structure")] > 0


def _vote_row(code: int) -> list[int]:
    out = []
    for _ in LABELERS:
        out.append(code % 3)
        code //= 3
    return out[::-1]


#: Candidates that each labeler is taken to have judged rightly beforehand, per label.
RIGHT = 4.0


def estimate(votes: np.ndarray, base: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Posterior of each pattern of votes, by expectation-maximisation; strict matches are known to be true.

    ``votes`` holds 0 (against), 1 (abstains) or 2 (for) of each labeler. Labelers are no worse than chance: a
    Beta prior has each right on ``RIGHT`` candidates more than wrong, and no vote counts for its opposite.
    """
    posterior = np.where(base, 1.0, 0.5 + 0.4 * np.tanh((votes - 1).sum(1)))
    choices = np.stack([votes == v for v in range(3)], 2).astype(float)
    prior_yes, prior_no = np.array([1.0, 1.0, 1.0 + RIGHT]), np.array([1.0 + RIGHT, 1.0, 1.0])
    for _ in range(rounds):
        # How many candidates are true is judged by the looser ones alone; strict matches say nothing of them.
        loose = counts * ~base
        yes, no = counts * posterior, counts * (1 - posterior)
        prior = ((loose * posterior).sum() + 1) / (loose.sum() + 2)
        given_yes = (np.einsum("i,ijk->jk", yes, choices) + prior_yes) / (yes.sum() + prior_yes.sum())
        given_no = (np.einsum("i,ijk->jk", no, choices) + prior_no) / (no.sum() + prior_no.sum())
        weight = np.log(given_yes / given_no)
        weight[:, 0], weight[:, 2] = np.minimum(weight[:, 0], 0), np.maximum(weight[:, 2], 0)
        odds = np.log(prior / (1 - prior)) + np.einsum("ijk,jk->i", choices, weight)
        posterior = np.where(base, 1.0, 1 / (1 + np.exp(-np.clip(odds, -500, 500))))
    return posterior


def _logistic(features: np.ndarray, target: np.ndarray, weight: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights of a logistic regression on soft targets, by gradient steps with a small penalty."""
    w, scale = np.zeros(features.shape[1]), max(1.0, weight.sum())
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-features @ w))
        w += 2.0 * (features.T @ (weight * (target - p)) / scale - 1e-4 * w)
    return w


def aggregate(found: DataFrame) -> Aggregate:
    """Weighs the labelers and trains the classifier; ``found`` has the candidates of each document.

    The counts that come to the driver are bounded by the patterns there are: at most 3^5 of votes and
    1,440 shapes for each kind, whatever the number of documents.
    """
    spans = found.select(F.explode("found").alias("s")).select("s.kind", "s.base", "s.votes", "s.shape")
    rows = spans.groupBy("kind", "base", "votes", "shape").agg(F.count("*").alias("n")).collect()
    posterior, classifier = {}, {}
    for kind in range(len(KINDS)):
        own = sorted((r.base, r.votes, r.shape, r.n) for r in rows if r.kind == kind)
        if not own:
            continue
        base = np.array([r[0] for r in own])
        counts = np.array([r[3] for r in own], float)
        p = estimate(np.array([_vote_row(r[1]) for r in own]), base, counts)
        w = _logistic(np.array([_features(r[2], r[1]) for r in own]), p, counts)
        for (is_base, votes, shape, _), chance in zip(own, p):
            if not is_base:
                posterior[kind, votes] = float(chance)
                classifier[kind, votes, shape] = float(1 / (1 + np.exp(-np.array(_features(shape, votes)) @ w)))
    return Aggregate(posterior, classifier)


def extract(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, found): the candidates of each whole text. A null text counts as empty and has none."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("__key"), "text").mapInArrow(_extract, f"__key {kind}, found {SPANS}")
    return stage(rows.withColumnRenamed("__key", key), "pii-candidates")


def _digest(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    parts = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"].cast("int")), s["start"], s["stop"]))
    return F.concat_ws(",", parts)


def find(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: key, base and all spans as arrays of (kind, start, stop), sorted by kind as
    listed in ``KINDS`` and start, in code points with the end exclusive.

    Null and empty texts have no spans. Rows that repeat are told alike, and an empty table gives no
    rows. Columns other than key and text are not looked at.
    """
    found = extract(docs, key)
    chosen = aggregate(found).accepted()
    slim = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))
    # One number per accepted (kind, votes, shape); the list is as bounded as the patterns are.
    code = lambda s: (s["kind"].cast("int") * 243 + s["votes"]) * 1440 + s["shape"]
    codes = [(k * 243 + v) * 1440 + s for k, v, s in chosen]
    keep = (lambda s: s["base"] | code(s).isin(codes)) if codes else (lambda s: s["base"])
    return found.select(
        key,
        F.sort_array(F.transform(F.filter("found", lambda s: s["base"]), slim)).alias("base"),
        F.sort_array(F.transform(F.filter("found", keep), slim)).alias("spans"),
    )


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base spans by kind, their digest, and all spans as text."""
    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [number(kind).alias(f"n_{name}") for kind, name in enumerate(STRICT)]
    return found.select(
        key,
        *counts,
        F.sha2(_digest(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _digest(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans merge under the first."""
    out, at = [], 0
    for start, stop, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, stop)
    return "".join([*out, text[at:]])


def base_digest(spans: list[tuple[int, int, int]]) -> str:
    """The digest of spans as ``digest`` gives it, for tests and other callers without Spark."""
    listed = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))
    return hashlib.sha256(listed.encode()).hexdigest()

r"""Personal data: base patterns, and weak supervision for what they miss.

The base patterns find e-mail addresses, IP addresses, card and phone numbers. Looser
patterns propose further candidates, such as two card numbers side by side, which the
base reads as one long number and drops. Labelers (strict form, gazetteer, context,
edges) vote on every candidate of the corpus. Expectation-maximisation over the
counted vote patterns estimates the labelers' reliabilities and each pattern's
probability; these train a logistic span classifier, whose accepted candidates are
added where they don't overlap a base span.

What leaves the scans is the count of each pattern of kind, votes and shape bits, a
table whose size is fixed by their number. Texts are never shuffled.

Defined results: null and empty texts have no spans; offsets are code points; rows
are handled one by one, so repeated rows and null ids keep their own result; without
any candidate nothing is added.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import blocks, column, id_text, tidy

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.9
BLOCK_BYTES = 4 << 20
Span = tuple[str, int, int]

# Fixed values of the contract, with a guard that lets no scan start inside a run of
# digits (the leftmost match can't), which keeps long runs linear.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Looser forms.
LOOSE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64}\s?(?:\[at\]|\(at\)|\[@\])\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\.|\[dot\]|\(dot\))\s?[A-Za-z0-9-]{2,63}){1,4}", re.I),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([\x20.-])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])"),
    "phone": re.compile(r"(?:(?<![0-9])00|\+)[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])|(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
}

# Gazetteers.
TOP_LEVEL = frozenset("com org net edu gov info io co uk de fr es it nl eu us ca au example test".split())
CARD_ISSUER = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5)")
CALLING_CODES = ("1", "33", "34", "39", "44", "49", "31", "41", "43", "61", "81", "86", "91")
FOR, AGAINST = {
    "email": re.compile(r"mail|contact|write|courriel|correo|kontakt", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|login|adresse", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|debit|karte|carte|tarjeta", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax|cell|llame|appel|ruf", re.I),
}, re.compile(r"version|order|invoice|isbn|sku|token|hash|serial|timestamp|[=#$]\s*\"?$", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind; failing ones are dropped."""
    found: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:  # the local part is the whole run before an @, back to the last match
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            found.append(("email", start, m.end()))
            end = m.end()
        else:
            end = max(end, at)  # no earlier start can match across this @
        at = text.find("@", max(at + 1, end))
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        d = digits_of(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(digits_of(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def candidates(text: str) -> list[Span]:
    return [(kind, *m.span()) for kind, pattern in LOOSE.items() for m in pattern.finditer(text)]


# Votes: 1 for, 0 against, 2 abstains.

def strict_form(kind: str, s: str) -> int:
    d = digits_of(s)
    if kind == "card":
        return int(luhn(d) and len(set(d)) > 1)
    if kind == "phone":
        return int(8 <= len(d) <= 15 and len(set(d)) > 1)
    return 1


def gazetteer(kind: str, s: str) -> int:
    if kind == "card":
        return int(bool(CARD_ISSUER.match(s)))
    if kind == "phone":
        lead = s[1:] if s[0] == "+" else s[2:] if s.startswith("00") else None
        return 2 if lead is None else int(lead.startswith(CALLING_CODES))
    if kind == "email":
        return 1 if re.split(r"[^A-Za-z0-9]+", s)[-1].lower() in TOP_LEVEL else 2
    return 2


def context(kind: str, text: str, start: int) -> int:
    before = text[max(0, start - 32):start]
    return 0 if AGAINST.search(before) else 1 if FOR[kind].search(before) else 2


def edges(text: str, start: int, end: int) -> int:
    """Against when the candidate is a part of a longer token; for between spaces."""
    a, b = text[start - 1:start], text[end:end + 1]
    if (a and (a.isalnum() or a in "._-/=")) or (b and (b.isalnum() or b in "_/=")):
        return 0
    return 1 if not a.strip() and not b.strip() else 2


def votes(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    s = text[start:end]
    return strict_form(kind, s), gazetteer(kind, s), context(kind, text, start), edges(text, start, end)


def shape(s: str) -> int:
    """Shape bits: separators, brackets, leading plus, repeated digits."""
    d = digits_of(s)
    return (any(c in s for c in " .-")) | (("(" in s) << 1) | ((s[:1] == "+") << 2) | ((len(set(d)) <= 3) << 3)


N_LABELERS, N_SHAPES = 4, 16


def code_of(kind: str, text: str, start: int, end: int) -> int:
    """The candidate's kind, votes and shape as one number below 4 * 3**4 * 16."""
    code = KINDS.index(kind)
    for v in votes(kind, text, start, end):
        code = code * 3 + v
    return code * N_SHAPES + int(shape(text[start:end]))


def decode(code: int) -> tuple[int, tuple[int, ...], int]:
    code, bits = divmod(code, N_SHAPES)
    v = []
    for _ in range(N_LABELERS):
        code, x = divmod(code, 3)
        v.append(x)
    return code, tuple(reversed(v)), bits


# Reliabilities and the classifier, over counted patterns

def reliabilities(codes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """EM for labelers that err independently given the truth.

    Returns (P(truth) per pattern, P(vote | truth) per labeler). The start trusts each
    labeler's vote a little, which fixes which of the two classes is "personal data".
    """
    v = np.array([decode(int(c))[1] for c in codes])
    p = np.clip(0.5 + 0.15 * ((v == 1).sum(1) - (v == 0).sum(1)), 0.05, 0.95)
    table = np.zeros((N_LABELERS, 2, 3))
    for _ in range(rounds):
        for j in range(N_LABELERS):
            for truth, w in ((0, (1 - p) * counts), (1, p * counts)):
                seen = np.bincount(v[:, j], weights=w, minlength=3) + 1.0
                table[j, truth] = seen / seen.sum()
        prior = (np.sum(p * counts) + 1) / (counts.sum() + 2)
        odds = np.log(prior / (1 - prior)) + sum(np.log(table[j, 1, v[:, j]] / table[j, 0, v[:, j]]) for j in range(N_LABELERS))
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return p, table


def inputs(codes: np.ndarray) -> np.ndarray:
    """The classifier's inputs: one per kind, per labeler and vote, and per shape bit."""
    x = np.zeros((len(codes), 1 + len(KINDS) + 3 * N_LABELERS + 4))
    for i, c in enumerate(codes):
        kind, v, bits = decode(int(c))
        x[i, 0] = 1
        x[i, 1 + kind] = 1
        for j, vote in enumerate(v):
            x[i, 5 + 3 * j + vote] = 1
        x[i, -4:] = [(bits >> b) & 1 for b in range(4)]
    return x


def fit_classifier(codes: np.ndarray, counts: np.ndarray, p: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Ridge logistic regression on the probabilities, by Newton steps."""
    x, w = inputs(codes), np.zeros(1 + len(KINDS) + 3 * N_LABELERS + 4)
    weight = counts / counts.sum() * min(counts.sum(), 1e4)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - q)) - 0.1 * w
        hessian = (x * (weight * q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.linalg.solve(hessian, gradient)
    return w


@dataclass(frozen=True)
class SpanModel:
    accepted: frozenset  # codes whose probability reaches ACCEPT and whose form is strict
    probability: dict


def holding(texts: pa.Array) -> np.ndarray:
    """Whether a text has an @, a bracketed at or a digit at all."""
    return np.asarray(pc.match_substring_regex(texts, r"[0-9@]|[\[(][aA][tT][\])]|[0-9A-Fa-f]:"))


def count_patterns(documents: DataFrame) -> dict[int, int]:
    def run(batches):
        for table in blocks(batches, "text", BLOCK_BYTES):
            texts = column(table, "text")
            seen: dict[int, int] = {}
            for text in texts.filter(pa.array(holding(texts))).to_pylist():
                for span in candidates(text):
                    c = code_of(span[0], text, *span[1:])
                    seen[c] = seen.get(c, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], ["code", "n"])

    counted = id_text(documents).select("text").mapInArrow(tidy(run), "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return {r["code"]: r["n"] for r in counted.collect()}  # at most 4 * 3**4 * 16 rows


def train(documents: DataFrame) -> SpanModel:
    counted = count_patterns(documents)
    if not counted:
        return SpanModel(frozenset(), {})
    codes = np.array(sorted(counted))
    counts = np.array([counted[c] for c in codes], float)
    p, _ = reliabilities(codes, counts)
    w = fit_classifier(codes, counts, p)
    # Every code that a later text can hold is judged, not just those counted here.
    every = np.arange(len(KINDS) * 3 ** N_LABELERS * N_SHAPES)
    q = 1 / (1 + np.exp(-np.clip(inputs(every) @ w, -30, 30)))
    return SpanModel(frozenset(int(c) for c in every[q >= ACCEPT] if decode(int(c))[1][0] == 1), dict(zip(every.tolist(), q.tolist())))


def all_spans(text: str, model: SpanModel) -> tuple[list[Span], list[Span]]:
    """(base spans, base and added ones), each by kind, then start."""
    base = base_spans(text)
    order = lambda s: (KINDS.index(s[0]), s[1])
    taken = sorted((a, b) for _, a, b in base)
    added: list[Span] = []
    for kind, a, b in sorted(candidates(text), key=lambda s: (s[1], KINDS.index(s[0]))):
        if code_of(kind, text, a, b) in model.accepted and not any(a < y and x < b for x, y in taken):
            added.append((kind, a, b))
            taken.append((a, b))
    return sorted(base, key=order), sorted(base + added, key=order)


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


FOUND = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"


def find_personal_data(documents: DataFrame, model: SpanModel) -> DataFrame:
    """Per row the base counts, the digest of the base spans, and all spans."""
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches):
        for table in blocks(batches, "text", BLOCK_BYTES):
            texts = column(table, "text")
            out = []
            for text, some in zip(texts, holding(texts)):
                base, every = all_spans(text.as_py(), model) if some else ([], [])
                digest = hashlib.sha256(written(base).encode()).hexdigest() if base else nothing
                out.append((*[sum(s[0] == k for s in base) for k in KINDS], digest, written(every)))
            types = [pa.int64()] * len(KINDS) + [pa.string()] * 2
            cols = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            yield pa.RecordBatch.from_arrays([column(table, "doc_id"), *cols], ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return id_text(documents).mapInArrow(tidy(run), FOUND)


def redact(text: str, model: SpanModel) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, end = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in all_spans(text, model)[1]):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join(out) + text[end:]


def redact_documents(documents: DataFrame, model: SpanModel, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The rows, with all their columns, with personal data in ``text_col`` replaced
    (and ``length_col``, where there is one, brought up to date). Null stays null."""

    def run(batches):
        for table in blocks(batches, text_col, BLOCK_BYTES):
            texts = column(table, text_col)
            some = np.asarray(pc.fill_null(pa.array(holding(pc.fill_null(texts, ""))), False)) & np.asarray(texts.is_valid())
            new = pa.array([redact(t.as_py(), model) if h else t.as_py() for t, h in zip(texts, some)], pa.string())
            table = table.set_column(table.schema.get_field_index(text_col), text_col, new)
            if length_col in table.schema.names:
                field = table.schema.get_field_index(length_col)
                table = table.set_column(field, length_col, pc.utf8_length(new).cast(table.schema.field(field).type))
            yield from table.to_batches()

    return documents.mapInArrow(tidy(run), documents.schema)

"""Personal data: labelers vote on candidate spans, EM weighs them, a classifier decides."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm._store import saved
from quillon.llm._words import buffers
from quillon.llm.toxicity import Rows, logistic, probability

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("format", "checksum", "gazetteer", "context", "border")

# Kinds are found left to right without overlap. Runs of digits are matched possessively and
# only from their start: a match that begins inside a run would have begun at its start.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Further ways of writing the same data, offered as candidates; none overlaps a base span of its kind.
_MORE = (
    ("email", 1, re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[\[({](?:at|AT)[\])}]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[\[({](?:dot|DOT)[\])}])\x20?[A-Za-z0-9-]{1,63}){1,4}")),
    ("ip", 2, re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    ("card", 3, re.compile(r"(?<![0-9.])[0-9]{4}\.[0-9]{4}\.[0-9]{4}\.[0-9]{4}(?![0-9.])")),
    ("phone", 4, re.compile(r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])")),
    ("phone", 5, re.compile(r"(?<![0-9+])00[1-9][0-9]{0,2}[\x20-][0-9][\x20()0-9-]{5,14}[0-9](?![0-9])")),
)
#: Words in the 40 characters before a span that speak for its kind, and words that speak against any (fixed values).
_FOR = {
    "email": re.compile(r"e-?mail|mailto|contact|write to|correo|courriel|adresse", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|addr|dns|ping|adresse", re.I),
    "card": re.compile(r"card|visa|mastercard|amex|credit|debit|carte|karte|tarjeta|payment", re.I),
    "phone": re.compile(r"phone|tel\b|tel[.:]|mobile|cell|fax|call|whatsapp|telefon|téléphone|teléfono|sms", re.I),
}
_AGAINST = re.compile(r"version|release|token|secret|key|hash|commit|serial|isbn|issn|order|invoice|build|uuid|sha|\bid\b|\bv$|#$|[=/]\x20?[\"']?$", re.I)
#: Top-level domains, issuer prefixes and country calling codes that exist (fixed values).
_TLDS = set("com org net edu gov mil int info biz name pro io ai co me tv app dev de fr es it uk eu us ca au jp cn in br ru ch at be nl se no dk fi pl pt ie cz gr hu ro nz mx ar za kr tr".split())
_ISSUERS = re.compile(r"4|5[1-5]|2(?:2[2-9]|[3-6]|7[01]|720)|3[47]|3(?:0[0-5]|[689])|6(?:011|4[4-9]|5)|35|62|50|5[6-9]|6")
_CALLING = re.compile(r"1|7|2[07]|3[0123469]|4[013456789]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-6]|3[578]|42|5[09]|6[7-9]|8[058]|9[679]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Base spans of e-mail addresses, each '@' looked at once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        end = at + 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, (end := domain.end())
        # Nothing before an '@' can belong to a later address.
        done = end
        at = text.find("@", end)


def _digits(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def candidates(text: str) -> list[tuple[str, int, int, int, bool]]:
    """(kind, start, end, form, base) of all spans to be judged; form 0 is the base way of writing."""
    out = [("email", s, e, 0, True) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        out.append(("ip", *m.span(), 0, all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if len(digits) >= 13:
            out.append(("card", *m.span(), 0, 14 <= len(digits) <= 19 and luhn(digits)))
    for m in _PHONE.finditer(text):
        out.append(("phone", *m.span(), 0, 10 <= len(_digits(m[0])) <= 15))
    for kind, form, pattern in _MORE:
        base = [(s, e) for k, s, e, f, b in out if k == kind and (b or f)]
        out += [(kind, *m.span(), form, False) for m in pattern.finditer(text) if not any(s < m.end() and m.start() < e for s, e in base)]
    return out


def votes(text: str, kind: str, start: int, end: int, form: int, base: bool) -> list[int]:
    """What each labeler says of a span: 1 for, -1 against, 0 nothing."""
    value, before, after = text[start:end], text[max(0, start - 40) : start], text[end : end + 1]
    digits = _digits(value)
    if kind == "email":
        tld = re.split(r"[.\s\])}]+", value.rstrip("])}"))[-1].lower()
        check, known = (1 if not re.search(r"\.\.|^\.|--|-\.|\.-", value) else -1), (1 if tld in _TLDS else -1)
    elif kind == "ip":
        parts = value.split(".") if form == 0 else []
        check = 1 if form == 2 else (1 if all(p == "0" or not p.startswith("0") for p in parts) and all(len(p) < 4 and int(p) <= 255 for p in parts) else -1)
        known = 0 if form == 2 or check < 0 else (-1 if int(parts[0]) in (0, 127) or int(parts[0]) >= 224 else 1)
    elif kind == "card":
        check, known = (1 if luhn(digits) else -1), (1 if _ISSUERS.match(digits) else -1)
    else:
        check = 1 if 10 <= len(digits) <= 15 else -1
        own = digits.removeprefix("00")
        known = (1 if _CALLING.match(own) else -1) if form != 4 else (1 if digits[0] in "23456789" and digits[3] in "23456789" else -1)
    context = -1 if _AGAINST.search(before) else (1 if _FOR[kind].search(before) else 0)
    border = -1 if (before[-1:].isalnum() or before[-1:] in {"_", "-", ".", ","} and before[-1:] and before[-2:-1].isdigit()) or after.isalnum() or after == "_" else 1
    return [1 if base else (0 if form else -1), check, known, context, border]


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, spans): kind, start, end, base and the code of form and votes."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("base", pa.bool_()), ("code", pa.int32())]))
    for rows in batches:
        data, offsets = buffers(rows.column(1))
        own = data[int(offsets[0]) : int(offsets[-1])] if len(offsets) > 1 else data[:0]
        tell = np.concatenate([[0], np.cumsum(((own >= 48) & (own <= 57)) | (own == 64) | (own == 91) | (own == 40) | (own == 123))])
        at = offsets - offsets[0]
        # Every candidate holds a digit, an '@' or an opening bracket.
        some = np.flatnonzero(tell[at[1:]] > tell[at[:-1]])
        texts = rows.column(1).take(pa.array(some)).to_pylist()
        spans: list[list[dict]] = [[] for _ in range(rows.num_rows)]
        for row, text in zip(some.tolist(), texts, strict=True):
            for k, start, end, form, base in candidates(text):
                code = form
                for v in votes(text, k, start, end, form, base):
                    code = code * 3 + v + 1
                spans[row].append({"start": start, "kind": KINDS.index(k), "end": end, "base": base, "code": code})
        for lo in range(0, rows.num_rows, 5000):
            yield pa.RecordBatch.from_arrays([rows.column(0).slice(lo, 5000), pa.array(spans[lo : lo + 5000], kind)], ["id", "spans"])


def decode(code: int) -> tuple[int, list[int]]:
    found = []
    for _ in LABELERS:
        code, v = divmod(code, 3)
        found.append(v - 1)
    return code, found[::-1]


def reliabilities(votes_: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of each vote pattern, P(vote | truth) by labeler) by expectation-maximisation.

    Labelers are taken as independent given the truth, which is not seen. It begins
    with the share of votes for a span; each labeler is smoothed towards being right.
    """
    spoken = np.abs(votes_).sum(1)
    p = np.clip((votes_.clip(0).sum(1) + 0.5) / (spoken + 1.0), 0.02, 0.98)
    prior = np.array([[3.0, 1.0, 1.0], [1.0, 1.0, 3.0]])  # by truth: against, silent, for
    table = np.zeros((2, votes_.shape[1], 3))
    for _ in range(rounds):
        weight = np.stack([(1 - p) * counts, p * counts])
        for v in (-1, 0, 1):
            table[:, :, v + 1] = weight @ (votes_ == v) + prior[:, v + 1][:, None]
        table /= table.sum(2, keepdims=True)
        share = np.clip((p * counts).sum() / counts.sum(), 0.01, 0.99)
        logs = [np.log(table[t][np.arange(votes_.shape[1]), votes_ + 1]).sum(1) for t in (0, 1)]
        p = 1 / (1 + np.exp(np.clip(logs[0] + np.log(1 - share) - logs[1] - np.log(share), -30, 30)))
    return p, table


def accepted(patterns: list[tuple[int, int, int]], threshold: float = 0.9) -> list[tuple[int, int]]:
    """The (kind, code) of spans that the classifier takes, from (kind, code, count) of all candidates.

    For each kind EM gives every pattern a posterior; a logistic regression on votes and
    form is trained on all spans, each pattern weighing as often as it occurs.
    """
    out = []
    for kind in range(len(KINDS)):
        own = sorted((code, n) for k, code, n in patterns if k == kind)
        if not own:
            continue
        forms, v = zip(*(decode(code) for code, _ in own), strict=True)
        v, n = np.array(v), np.array([c for _, c in own], float)
        p, _ = reliabilities(v, n)
        x = np.hstack([(v == t) * 1.0 for t in (-1, 0, 1)] + [np.array(forms)[:, None] == np.arange(len(_MORE) + 1)])
        share = np.sqrt(n / n.sum() * len(n))[:, None]
        # Soft labels: each pattern stands for both truths, by its posterior.
        rows = np.repeat(np.arange(len(n)), np.maximum(1, np.round(20 * share[:, 0])).astype(int))
        w = logistic(Rows.of(x[rows] * 1.0), p[rows], 0.5, 400, 1e-6)
        out += [(kind, code) for (code, _), q in zip(own, probability(Rows.of(x * 1.0), w), strict=True) if q >= threshold]
    return out


def personal_data(docs: DataFrame, threshold: float = 0.9, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans array<struct<start, kind, end, base>>): one row per document, spans sorted by start, then kind.

    Offsets are code points, the end exclusive; kinds count from 0 in the order of KINDS.
    Base spans are those of the four base patterns that pass their check. Every match of
    these patterns and of further ways of writing is a candidate; LABELERS vote on it;
    the votes' patterns, of which there are few however many spans, are counted over all
    documents, and EM and the final classifier see these counts. A candidate that is no
    base span is added if the classifier gives it ``threshold`` or more.

    Null or empty text has no spans; ids may be null or repeated; an empty table gives
    no rows; other columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {source.schema['id'].dataType.simpleString()}, spans array<struct<start: bigint, kind: int, end: bigint, base: boolean, code: int>>"
    found = saved(source.mapInArrow(_find, schema), "spans")
    each = found.select(F.explode("spans").alias("s"))
    patterns = each.groupBy("s.kind", "s.code").agg(F.count(F.lit(1)).alias("n")).collect()
    taken = accepted([tuple(r) for r in patterns], threshold)
    keys = F.array(*[F.lit(kind * (1 << 20) + code) for kind, code in taken]) if taken else F.array().cast("array<int>")
    keep = F.filter("spans", lambda s: s["base"] | F.array_contains(keys, s["kind"] * (1 << 20) + s["code"]))
    keep = F.array_sort(F.transform(keep, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base"))))
    return found.select(F.col("id").alias(id_col), keep.alias("spans"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_<kind> for each, base_sha256, spans): base counts and digest, and all spans as text."""
    names = F.array(*map(F.lit, KINDS))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(id_col, *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))

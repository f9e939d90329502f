"""Personal data by weak supervision.

Fixed base patterns (e-mail, IP address, payment card, phone) give spans that
always stay. Wider patterns propose more. Labelers then vote on every span, for
(+), against (-) or not at all (0): a validity check, the wide pattern's shape,
a gazetteer (issuer prefixes, calling codes, top-level domains, reserved
addresses, given names), words before the span, its borders, and the variety of
its characters. Expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is, with no labelled data; the posteriors
train a logistic classifier over span features, which decides on the proposed
spans.

Documents are scanned once; spans stay in their document's row. Only the counts
of (kind, votes, features) patterns are shuffled and reach the driver: kinds,
votes and features are few and discrete, so at most ``MAX_PATTERNS`` rows by
construction, however large the corpus.

Defined results: a null or empty text has no spans; repeated rows and null ids
are handled row by row; an empty table gives no rows; without candidates the
classifier accepts nothing beyond the base; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.scratch import small_batches, stored

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "name", "secret", "ssn")
LABELERS = ("validity", "shape", "gazetteer", "context", "borders", "variety")
#: Feature bits of a span: its kind, then these.
FLAGS = ("valid", "invalid", "known", "reserved", "told", "denied", "free", "glued", "varied", "plain", "separated")
N_FEATURES = len(KINDS) + len(FLAGS)
#: Votes and flags follow from seven three-way or two-way signals of each kind.
MAX_PATTERNS = len(KINDS) * 3 ** len(LABELERS) * 2

# Payment card issuer prefixes, calling codes, top-level domains and given names.
CARD_ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "62")
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46",
                 "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81",
                 "82", "84", "86", "90", "91", "92", "94", "351", "352", "353", "358", "380", "420", "421", "971", "972")
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "it", "nl", "eu", "info", "ch", "at", "us")
GIVEN_NAMES = ("James", "Mary", "John", "Patricia", "Robert", "Jennifer", "Michael", "Linda", "William", "Elizabeth",
               "David", "Barbara", "Richard", "Susan", "Joseph", "Jessica", "Thomas", "Sarah", "Charles", "Karen",
               "Hans", "Anna", "Peter", "Ursula", "Jean", "Marie", "Pierre", "Sophie", "Carlos", "Carmen", "Luis")
CONTEXT = {"email": r"e-?mail|contact|write to|courriel|correo", "ip": r"\bip\b|address|host|server|login",
           "card": r"card|visa|credit|karte|carte|tarjeta|payment", "phone": r"phone|call|tel\b|tel[.:]|mobile|fax",
           "iban": r"iban|bank|account|konto", "name": r"name|dear|mrs?\b|ms\b|dr\b|signed|regards",
           "secret": r"token|secret|passw(?:or)?d|key|auth|bearer", "ssn": r"ssn|social security|tax id"}
DENIED = r"version|release|isbn|issn|page|chapter|section|figure|total|order|invoice|sha1|md5|commit|checksum|build"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGIT = re.compile(r"[0-9]")
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can't start within a run of digits: it would have started with the run.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NATIONAL = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
HEX = re.compile(r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,}+(?![0-9A-Za-z])")
GIVES = re.compile(r"[:=]")
SECRET_WORD = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|api[_ -]?key|access[_ -]?key|auth|bearer)[\"']?\s{0,3}$")
SECRET_VALUE = re.compile(r"\s{0,3}[\"']?([^\s\"',;]{8,})")
SPELT_AT = re.compile(r"\s?[\[(]at[\])]\s?([A-Za-z0-9-]+(?:\s?(?:\.|[\[(]dot[\])])\s?[A-Za-z0-9-]+)+)")
NAME = re.compile(rf"\b(?:{'|'.join(GIVEN_NAMES)}) [A-Z][a-z]+(?!\w)")
TOLD = {kind: re.compile(f"(?i){words}") for kind, words in CONTEXT.items()}
NOT_TOLD = re.compile(f"(?i){DENIED}")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _local_start(text: str, at: int, least: int) -> int:
    while at > least and text[at - 1] in LOCAL:
        at -= 1
    return at


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping: what precedes an @ back to the last match, and the host that follows it."""
    at, least = text.find("@"), 0
    while at >= 0:
        start, host = _local_start(text, at, least), HOST.match(text, at + 1)
        if start < at and host:
            yield start, host.end()
            least = host.end()
        at = text.find("@", max(at + 1, least))


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _ip_valid(text: str) -> bool:
    return all(_small(part) for part in text.split("."))


def _card_valid(text: str) -> bool:
    digits = only_digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's spans, by start and kind."""
    out = [("email", s, e) for s, e in _emails(text)]
    if DIGIT.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if _ip_valid(m[0])]
        out += [("card", *m.span()) for m in CARD.finditer(text) if m.end() - m.start() >= 12 and _card_valid(m[0])]
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(only_digits(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[1], BASE_KINDS.index(x[0]), x[2]))


def _iban_valid(text: str) -> bool:
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def proposals(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of the wider patterns that overlap no base span."""
    out = []
    if DIGIT.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if not _ip_valid(m[0])]
        out += [("card", *m.span()) for m in CARD.finditer(text)
                if 12 <= len(only_digits(m[0])) <= 19 and not _card_valid(m[0])]
        out += [("phone", *m.span()) for m in NATIONAL.finditer(text)]
        out += [("ssn", *m.span()) for m in SSN.finditer(text)]
        out += [("iban", *m.span()) for m in IBAN.finditer(text)]
        out += [("secret", *m.span()) for m in HEX.finditer(text)]
    for m in GIVES.finditer(text):
        if SECRET_WORD.search(text, max(0, m.start() - 24), m.start()) and (v := SECRET_VALUE.match(text, m.end())):
            out.append(("secret", *v.span(1)))
    if "at)" in text or "at]" in text:
        for m in SPELT_AT.finditer(text):
            start = _local_start(text, m.start(), 0)
            if start < m.start():
                out.append(("email", start, m.end()))
    out += [("name", *m.span()) for m in NAME.finditer(text)]
    # The longest first where proposals overlap; none over a base span.
    taken = sorted((s, e) for _, s, e in base)
    kept: list[tuple[str, int, int]] = []
    position = 0
    out.sort(key=lambda x: (x[1], -x[2], KINDS.index(x[0])))
    end = -1
    for kind, s, e in out:
        while position < len(taken) and taken[position][1] <= s:
            position += 1
        if s >= end and not (position < len(taken) and taken[position][0] < e):
            kept.append((kind, s, e))
            end = e
    return kept


def _sign(for_it: bool, against: bool) -> int:
    return int(for_it) - int(against)


def judged(text: str, kind: str, start: int, end: int, base: bool) -> tuple[str, int]:
    """The labelers' votes and the feature bits of a span."""
    span, before = text[start:end], text[max(0, start - 40):start]
    digits = only_digits(span)
    valid = base or (kind == "iban" and _iban_valid(span)) or (
        kind == "ssn" and span[:3] not in ("000", "666") and span[0] != "9" and span[4:6] != "00")
    invalid = not valid and kind in ("ip", "card", "iban", "ssn")
    known = reserved = False
    if kind == "card":
        known, reserved = digits.startswith(CARD_ISSUERS), not digits.startswith(CARD_ISSUERS)
    elif kind == "phone":
        known = not span.startswith("+") or digits.startswith(CALLING_CODES)
        reserved = not known
    elif kind == "email":
        known = span.rpartition(".")[2].lower() in DOMAINS
    elif kind == "ip":
        reserved = span.startswith(("0.", "127.", "255."))
    elif kind == "name":
        known = True
    told, denied = bool(TOLD[kind].search(before)), bool(NOT_TOLD.search(before))
    left, right = text[start - 1:start], text[end:end + 1]
    glued = left.isalnum() or right.isalnum() or left == "_" or right == "_"
    letters = len(set(span.lower()))
    varied = letters >= (4 if kind in BASE_KINDS or kind == "ssn" else 6)
    separated = any(c in " -.()" for c in span)
    votes = (_sign(valid, invalid), int(base or kind in ("phone", "iban", "ssn") or (kind == "secret" and varied)),
             _sign(known, reserved), _sign(told, denied and not told), _sign(not glued, glued), _sign(varied, not varied))
    flags = (valid, invalid, known, reserved, told, denied, not glued, glued, varied, not varied, separated)
    bits = 1 << KINDS.index(kind)
    for k, on in enumerate(flags):
        bits |= int(on) << (len(KINDS) + k)
    return "".join("-0+"[v + 1] for v in votes), bits


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,votes:string,bits:int>>"


def candidate_spans(text: Column) -> Column:
    """All candidate spans of a text, with their votes and features."""

    @F.pandas_udf(SPANS)
    def spans(bodies: pd.Series) -> pd.Series:
        out = []
        for body in bodies:
            body = body if isinstance(body, str) else ""
            base = base_spans(body)
            found = [(k, s, e, True) for k, s, e in base] + [(k, s, e, False) for k, s, e in proposals(body, base)]
            out.append([dict(zip(("kind", "start", "end", "base", "votes", "bits"), (k, s, e, b, *judged(body, k, s, e, b))))
                        for k, s, e, b in found])
        return pd.Series(out, dtype=object)

    return spans(text)


def reliabilities(counts: pd.DataFrame, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns (``kind, votes, n``).

    Returns each pattern's probability to be personal data, and for each labeler
    the probabilities of its votes (-, 0, +) given not / given personal data.
    """
    votes = np.array([["-0+".index(c) for c in v] for v in counts["votes"]])
    kinds, n = counts["kind"].map(KINDS.index).to_numpy(), counts["n"].to_numpy(dtype=float)
    post = np.clip(0.5 + 0.15 * (votes - 1).sum(axis=1), 0.02, 0.98)  # at first, the labelers are alike
    table = np.zeros((len(LABELERS), 2, 3))
    for _ in range(rounds):
        for y, weight in enumerate((n * (1 - post), n * post)):
            for k in range(len(LABELERS)):
                # A labeler is taken to vote its way more often than not, as if seen a few times.
                prior = np.array([3.0, 2.0, 1.0])[:: -1 if y else 1]
                seen = np.bincount(votes[:, k], weights=weight, minlength=3) + prior
                table[k, y] = seen / seen.sum()
        share = (np.bincount(kinds, weights=n * post, minlength=len(KINDS)) + 1) / (
            np.bincount(kinds, weights=n, minlength=len(KINDS)) + 2)
        odds = np.log(share[kinds] / (1 - share[kinds]))
        for k in range(len(LABELERS)):
            odds += np.log(table[k, 1, votes[:, k]] / table[k, 0, votes[:, k]])
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return post, table


def classifier(bits: np.ndarray, target: np.ndarray, n: np.ndarray, rounds: int = 50, ridge: float = 1.0) -> np.ndarray:
    """Weights (bias last) of a ridge logistic regression on feature bits, by Newton steps over weighted patterns."""
    x = np.array([[b >> k & 1 for k in range(N_FEATURES)] + [1] for b in bits], dtype=float)
    weights = np.zeros(N_FEATURES + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (n * (target - p)) - ridge * weights
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(N_FEATURES + 1)
        step = np.linalg.solve(curve, slope)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def trained(spans: DataFrame) -> np.ndarray:
    """Classifier weights from all candidate spans of ``spans``."""
    each = spans.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.bits")
    counts = each.groupBy("kind", "votes", "bits").agg(F.count("*").alias("n"))
    counts = counts.toPandas().sort_values(["kind", "votes", "bits"], ignore_index=True)
    if not len(counts):
        return np.append(np.zeros(N_FEATURES), -1.0)
    patterns = counts.groupby(["kind", "votes"], as_index=False)["n"].sum()
    post, _ = reliabilities(patterns)
    patterns["p"] = post
    counts = counts.merge(patterns[["kind", "votes", "p"]], on=["kind", "votes"])
    return classifier(counts["bits"].to_numpy(), counts["p"].to_numpy(), counts["n"].to_numpy(dtype=float))


def _chosen(weights: np.ndarray, spans: str = "spans") -> Column:
    def accepted(s: Column) -> Column:
        odds = F.lit(float(weights[-1]))
        for k in range(N_FEATURES):
            odds = odds + F.when(s["bits"].bitwiseAND(F.lit(1 << k)) != 0, float(weights[k])).otherwise(0.0)
        return s["base"] | (odds > 0)

    rank = F.create_map(*[F.lit(x) for k, kind in enumerate(KINDS) for x in (kind, k)])
    kept = F.transform(F.filter(spans, accepted), lambda s: F.struct(
        s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"),
        s["base"].alias("base")))
    return F.sort_array(kept)


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` with ``spans``: structs of start, rank of the kind, end, kind and base, in order."""
    small_batches(docs.sparkSession)
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), candidate_spans(F.col(text)).alias("spans")), "pii-spans")
    return rows.withColumn("spans", _chosen(trained(rows)))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def span_digests(found: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["base"])

    def counted(kind: str) -> Column:
        of_kind = F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(counted, BASE_KINDS), F.sha2(span_text(base), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))


def replaced(text: Column, spans: Column) -> Column:
    """The text with its spans (in order) replaced by their kinds; overlapping ones as one, named for the first."""

    @F.pandas_udf("string")
    def replace(bodies: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for body, own in zip(bodies, found):
            if own is None or not len(own):
                out.append(body)
                continue
            parts, at = [], 0
            for s in own:
                if s["start"] >= at:
                    parts += [body[at:s["start"]], f"<{s['kind']}>"]
                at = max(at, s["end"])
            out.append("".join([*parts, body[at:]]))
        return pd.Series(out, dtype=object)

    return replace(text, spans)


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span found in ``text`` replaced by its kind in angle brackets; other columns as they were."""
    small_batches(docs.sparkSession)
    rows = stored(docs.select(F.struct(*docs.columns).alias("row"), candidate_spans(F.col(text)).alias("spans")), "pii-texts")
    clean = replaced(F.col("row")[text], _chosen(trained(rows)))
    return rows.select(*[(clean if c == text else F.col("row")[c]).alias(c) for c in docs.columns])

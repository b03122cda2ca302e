"""Personal data by weak-supervision aggregation.

Base spans (email, ip, card, phone) come from four fixed patterns and always stay.

More candidates come from failed base matches (a telephone number that swallowed the next
number, card-shaped groups inside a run of digits) and from wider patterns: spelled-out mail
addresses, addresses with a mark around ``@``, IPv6 addresses, addresses with marked dots,
telephone numbers without a plus sign or in digit words, card numbers with other
separators.  Labelers vote on every candidate: yes, no, or nothing.
    regex       the strict form of the kind fits (digit counts, check sum, valid address)
    gazetteer   a known top-level domain, an assigned address range, a country or area code form, issuer digits
    context     a word for this kind stands shortly before
    counter     a word for other numbers (order, version, price, ...) stands shortly before
    shape       the candidate touches letters, digits, decimal marks or operators
Expectation-maximisation over the vote patterns of all candidates in the corpus estimates
each labeler's reliability per kind; base spans take part as sure positives.  A logistic
span classifier is trained on the posteriors, and candidates that reach ``LEAST`` and do
not overlap a kept span are added.

Patterns are matched without backtracking over long runs, so time is linear in a text.
Texts are read twice (votes, spans); only vote patterns are shuffled, of which there are
at most 3^5 per kind.

Defined results
    null or empty text: no spans
    null doc_id and repeated rows: every row is searched
    overlapping candidates of a kind: the leftmost, then the longest, stays
    corpora without candidates: base spans only
    extra input columns: not read
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policyscan.session import stage

KINDS = ("email", "ip", "card", "phone")
LEAST = 0.9
ROUNDS = 20

# The base patterns, in forms that scan each run of characters once.
EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Wider patterns.
SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\s?(?:[\[({<]\s?at\s?[\])}>]|\sat\s|\s?@\s?)\s?"
    r"[A-Za-z0-9-]{1,63}(?:\s?(?:[\[({<]\s?dot\s?[\])}>]|\sdot\s|\.)\s?[A-Za-z0-9-]{1,63}){1,4}",
    re.IGNORECASE,
)
SPELLED_MARK = re.compile(r"[\[({<]\s?(?:at|dot)\s?[\])}>]|\sdot\s|\s@|@\s", re.IGNORECASE)
LOCAL_PHONE = re.compile(
    r"(?<![0-9+.(-])(?:1[ .-])?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"
)
PREFIXED_PHONE = re.compile(r"(?<![0-9+.(-])00[1-9](?:[ .()-]{0,2}[0-9]){7,13}(?![0-9])")
DIGIT_WORD = r"(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)"
SPOKEN_PHONE = re.compile(rf"\b{DIGIT_WORD}(?:[ ,-]{{1,2}}{DIGIT_WORD}){{6,14}}\b", re.IGNORECASE)
_OTHER = r"(?:[./_\u2013\u2014\u00a0]|[ -]{2,3})"
WIDE_CARD = re.compile(
    rf"(?<![0-9])(?:[0-9]{{4}}(?:{_OTHER}[0-9]{{4}}){{3}}|3[0-9]{{3}}{_OTHER}[0-9]{{6}}{_OTHER}[0-9]{{5}})(?![0-9])"
)
_DOT = r"(?: ?[\[({] ?(?:\.|dot) ?[\])}] ?| \. | dot )"
MARKED_IP = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9.])", re.IGNORECASE)
IPV6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
NUMBER = re.compile(r"[0-9]+")
#: Groups of the digits of a card as it is printed.
CARD_GROUPS = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3))

# Gazetteers and context words.
DOMAINS = frozenset("com org net edu gov io info biz de fr es uk eu ch at it nl be pl us ca au example".split())
CONTEXT = {
    "email": ("mail", "email", "e-mail", "contact", "write", "correo", "courriel", "kontakt"),
    "ip": ("ip", "host", "address", "server"),
    "card": ("card", "visa", "mastercard", "credit", "amex", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "tel.", "telefono", "appelez", "ring"),
}
COUNTER = ("order", "version", "invoice", "ref", "id", "isbn", "page", "section", "price", "total", "model", "no.")
LABELERS = ("regex", "gazetteer", "context", "counter", "shape")
WINDOW = 24
WORD = re.compile(r"[^\W\d_][\w.-]*")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def valid_address(text: str) -> bool:
    """IPv6, or four parts up to 255 whatever stands between them."""
    if ":" in text:
        try:
            return ipaddress.IPv6Address(text) is not None
        except ValueError:
            return False
    return all(int(part) <= 255 for part in NUMBER.findall(text))


def first_phone(run: str) -> int:
    """End of the longest start of a failed run that ends before a blank and has 9 to 15 digits; 0: none."""
    best = n = 0
    for part in re.finditer(r"[^ ]+", run):
        for digit in NUMBER.finditer(part.group()):
            n += digit.end() - digit.start()
            last = part.start() + digit.end()
            if n > 15:
                return best
        if n >= 9:
            best = last
    return best


def card_groups(run: str) -> list[tuple[int, int]]:
    """Card-shaped groups of digits in a failed run, from the left."""
    groups = [m.span() for m in NUMBER.finditer(run)]
    out, k = [], 0
    while k < len(groups):
        step, (begin, end) = 1, groups[k]
        if 13 <= end - begin <= 19:
            out.append((begin, end))
        else:
            for shape in CARD_GROUPS:
                some = groups[k : k + len(shape)]
                if tuple(e - b for b, e in some) == shape and luhn(digits_of(run[begin : some[-1][1]])):
                    out.append((begin, some[-1][1]))
                    step = len(shape)
                    break
        k += step
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind as listed, then start; ends are exclusive, places are code points."""
    spans = []
    if "@" in text:
        done = 0
        for m in EMAIL_TAIL.finditer(text):
            begin = m.start()
            while begin > done and text[begin - 1] in EMAIL_LOCAL:
                begin -= 1
            if begin < m.start():
                spans.append(("email", begin, m.end()))
                done = m.end()
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = digits_of(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m.group())) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Wider matches that do not touch a base span."""
    found = []
    if SPELLED_MARK.search(text):
        # Only around a mark: the wide pattern never runs over whole texts.
        at, done = 0, 0
        while m := SPELLED_MARK.search(text, at):
            begin, end = max(done, m.start() - 70), min(len(text), m.end() + 330)
            for hit in SPELLED.finditer(text, begin, end):
                if hit.start() <= m.start() < hit.end():
                    found.append(("email", hit.start(), hit.end()))
                    done = hit.end()
                    break
            at = max(m.end(), done)
    if text.count(":") > 1:
        found += [("ip", m.start(), m.end()) for m in IPV6.finditer(text) if len(m.group()) > 2 and valid_address(m.group())]
    found += [("ip", m.start(), m.end()) for m in MARKED_IP.finditer(text)]
    found += [("card", m.start(), m.end()) for m in WIDE_CARD.finditer(text)]
    whole = {(b, e) for kind, b, e in base if kind == "card"}
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and m.span() not in whole:
            found += [("card", m.start() + b, m.start() + e) for b, e in card_groups(m.group())]
    for pattern in (LOCAL_PHONE, PREFIXED_PHONE, SPOKEN_PHONE):
        found += [("phone", m.start(), m.end()) for m in pattern.finditer(text)]
    if "+" in text:
        whole = {(b, e) for kind, b, e in base if kind == "phone"}
        for m in PHONE.finditer(text):
            if m.span() not in whole and (end := first_phone(m.group())):
                found.append(("phone", m.start(), m.start() + end))
    taken = sorted((b, e) for _, b, e in base)
    out, edge, k = [], -1, 0
    for kind, begin, end in sorted(found, key=lambda s: (s[1], -s[2])):
        while k < len(taken) and taken[k][1] <= begin:
            k += 1
        if begin >= edge and not (k < len(taken) and taken[k][0] < end):
            out.append((kind, begin, end))
            edge = end
    return out


def votes(text: str, kind: str, begin: int, end: int) -> tuple[int, ...]:
    """One vote per labeler: 1 yes, -1 no, 0 nothing."""
    span = text[begin:end]
    digits = digits_of(span)
    before = {w.lower() for w in WORD.findall(text[max(0, begin - WINDOW) : begin])}
    if kind == "email":
        strict = 1 if re.search(r"@|[\[({<]\s?at\s?[\])}>]", span, re.IGNORECASE) else -1
        last = WORD.findall(span)[-1].lower().rsplit(".", 1)[-1] if WORD.search(span) else ""
        known = 1 if last in DOMAINS else -1
    elif kind == "card":
        strict = 1 if luhn(digits) else -1
        known = 1 if digits[:1] in "3456" else -1
    elif kind == "ip":
        strict = 1 if valid_address(span) else -1
        parts = NUMBER.findall(span)
        if ":" in span:
            known = 1 if span[0] in "23fF" and span.count(":") > 2 or span == "::1" else -1
        else:
            known = 1 if 9 < int(parts[0]) < 224 else -1
    else:
        n = len(digits) or len(re.findall(DIGIT_WORD, span, re.IGNORECASE))
        strict = 1 if 9 <= n <= 15 else -1
        coded = re.match(r"[+(]|00[1-9]", span) or re.fullmatch(r"(?:1[ .-])?[2-9][0-9]{2}[ .-][0-9]{3}[ .-][0-9]{4}", span)
        known = 1 if coded or not digits else -1
    context = 1 if before & set(CONTEXT[kind]) else 0
    counter = -1 if before & set(COUNTER) else 0
    left, right = text[begin - 1 : begin], text[end : end + 1]
    shape = -1 if left.isalnum() or right.isalnum() or left in "=/$€£*" and left or right in "%*/=" and right else 0
    return strict, known, context, counter, shape


class Reliability:
    """Rates of every labeler's votes (no, nothing, yes) given a true or false candidate of a kind."""

    def __init__(self):
        yes, no = [0.1, 0.2, 0.7], [0.5, 0.3, 0.2]
        self.rates = np.tile(np.array([no, yes])[:, None, :], (1, len(LABELERS), 1))
        self.prior = 0.3

    def posterior(self, vote: np.ndarray) -> np.ndarray:
        logs = np.log(np.clip(self.rates, 1e-6, 1))
        odds = np.log(self.prior / (1 - self.prior))
        for v in range(len(LABELERS)):
            odds = odds + logs[1, v, vote[:, v] + 1] - logs[0, v, vote[:, v] + 1]
        return 1 / (1 + np.exp(-odds))

    def fit(self, vote: np.ndarray, times: np.ndarray, sure: np.ndarray) -> "Reliability":
        """``sure`` rows are true whatever the votes; five imagined votes hold every rate."""
        start = self.rates.copy()
        for _ in range(ROUNDS):
            q = np.where(sure, 1.0, self.posterior(vote))
            for y, share in enumerate((1 - q, q)):
                weight = share * times
                for v in range(len(LABELERS)):
                    counted = np.bincount(vote[:, v] + 1, weights=weight, minlength=3)
                    self.rates[y, v] = (counted + 5 * start[y, v]) / (weight.sum() + 5)
            free = ~sure
            self.prior = float(np.clip(((q * times)[free].sum() + 1.5) / (times[free].sum() + 5), 0.01, 0.99))
        return self


def features(vote: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """One bias per kind, and a yes and a no column per labeler."""
    bias = np.stack([kind == k for k in KINDS], axis=1)
    return np.concatenate((bias, vote > 0, vote < 0), axis=1).astype(np.float64)


def train(vote: np.ndarray, kind: np.ndarray, soft: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Logistic regression on posteriors by Newton's steps."""
    x = features(vote, kind)
    w = np.zeros(x.shape[1])
    scale = times / max(times.sum(), 1) * min(times.sum(), 10_000)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curvature = (x * (scale * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.eye(x.shape[1])
        w -= np.linalg.solve(curvature, x.T @ (scale * (p - soft)) + w)
    return w


def vote_patterns(docs: DataFrame) -> DataFrame:
    """How often each kind's candidates got each pattern of votes; ``sure``: base spans."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counter: Counter = Counter()
            for text in frame["text"]:
                if text:
                    base = base_spans(text)
                    counter.update((k, True, *votes(text, k, b, e)) for k, b, e in base)
                    counter.update((k, False, *votes(text, k, b, e)) for k, b, e in candidates(text, base))
            if counter:
                rows = pd.DataFrame([list(k) for k in counter], columns=["kind", "sure", *LABELERS])
                yield rows.assign(n=list(counter.values()))

    schema = "kind string, sure boolean, " + ", ".join(f"{v} int" for v in LABELERS) + ", n long"
    counted = docs.select("text").mapInPandas(run, schema)
    return counted.groupBy("kind", "sure", *LABELERS).agg(F.sum("n").alias("n"))


def fit(patterns: DataFrame) -> np.ndarray | None:
    """Weights of the span classifier; None without any candidate.  At most 2 * 4 * 3^5 rows are read."""
    rows = patterns.toPandas().sort_values(["kind", "sure", *LABELERS])
    if not len(rows):
        return None
    vote, kind = rows[list(LABELERS)].to_numpy(np.int64), rows["kind"].to_numpy()
    times, sure = rows["n"].to_numpy(np.float64), rows["sure"].to_numpy(bool)
    soft = np.zeros(len(rows))
    for k in KINDS:
        mine = kind == k
        if mine.any():
            model = Reliability().fit(vote[mine], times[mine], sure[mine])
            soft[mine] = np.where(sure[mine], 1.0, model.posterior(vote[mine]))
    return train(vote, kind, soft, times)


def added_spans(text: str, base: list[tuple[str, int, int]], w: np.ndarray | None) -> list[tuple[str, int, int]]:
    """Candidates that the classifier accepts."""
    more = candidates(text, base) if w is not None else []
    if not more:
        return []
    vote = np.array([votes(text, *s) for s in more], np.int64)
    p = 1 / (1 + np.exp(-features(vote, np.array([s[0] for s in more])) @ w))
    return [s for s, q in zip(more, p, strict=True) if q >= LEAST]


def joined(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ",".join(f"{k}:{b}:{e}" for k, b, e in ordered)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, base counts per kind, base_sha256, spans, n_spans (base and added)."""
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    w = fit(stage(vote_patterns(narrow), "vote-patterns"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts, hashes, spans, totals = [], [], [], []
            for text in frame["text"]:
                base = base_spans(text) if text else []
                counter = Counter(k for k, _, _ in base)
                counts.append([counter[k] for k in KINDS])
                hashes.append(hashlib.sha256(joined(base).encode()).hexdigest())
                every = base + (added_spans(text, base, w) if text else [])
                spans.append(joined(every))
                totals.append(len(every))
            out = pd.DataFrame(counts, columns=[f"n_{k}" for k in KINDS], index=frame.index)
            yield pd.concat((frame[["doc_id"]], out), axis=1).assign(base_sha256=hashes, spans=spans, n_spans=totals)

    kind = narrow.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_spans long"
    return narrow.mapInPandas(run, schema)

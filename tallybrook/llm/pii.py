"""Personal data by weak supervision.

Regex, gazetteer, context and checksum labelers vote on every candidate span of the whole
text. Spark counts how often each pattern of votes occurs; expectation-maximisation on these
counts estimates how reliable each labeler is for each kind, and a logistic span classifier is
trained on the same counts with the resulting probabilities as labels. Spans of the base
patterns always stay; the classifier decides about the others. Only pattern counts reach the
driver: their number is bounded by labelers and shapes, not by the data, and they cover all
documents.
"""

import re
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .common import stage

# Kinds in the order of the result, and the patterns of the base spans.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser patterns that only propose candidates.
LOOSE = {
    "email": re.compile(
        # the whole local part and every label, whatever their length
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\s?(?:\(at\)|\[at\]|\{at\})\s?[A-Za-z0-9-]+"
        r"(?:\s?(?:\.|\(dot\)|\[dot\]|\{dot\})\s?[A-Za-z0-9-]+)+\b"
    ),
    "ip": re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "phone": re.compile(r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])"),
    "secret": re.compile(
        # the whole token: to the closing quote, or to white space if none is opened or closed in
        # the line; a full stop or comma after a bare token stays outside
        r"(?i)\b(?:password|passwd|pwd|token|api[_-]?key|secret)\s?[:=]\s?"
        r"(?:([\"'])(?:((?:\\.|(?!\1)[^\n\\]){8,}+)(?=\1)|(?![^\n]*\1)(\S{8,}+))|([^\s\"']\S{7,}(?<![.,;])))"
    ),
}
ALL_KINDS = (*KINDS, "secret")
# Gazetteers: last labels of mail domains, and words that stand near a kind of span.
TOP_LEVEL = frozenset("com org net edu gov io de fr es uk eu info co us ch at it nl".split())
NEAR = {
    "email": frozenset("email mail e-mail contact write correo courriel kontakt".split()),
    "ip": frozenset("ip address host server adresse".split()),
    "card": frozenset("card visa mastercard credit karte carte tarjeta".split()),
    "phone": frozenset("phone call tel mobile telefon fax tél teléfono".split()),
    "secret": frozenset("password token key secret login user".split()),
}
# Words that name something else that looks alike.
OTHER = frozenset("isbn issn version order invoice figure page chapter sku id".split())
LABELERS = ("strict", "loose", "gazetteer", "context", "checksum")
PRIOR_RIGHT = 0.8  # reliability of a labeler before any evidence, with PRIOR_WEIGHT votes
PRIOR_WEIGHT = 20.0
ACCEPT = 0.5

SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,pattern:string>>"


def luhn(digits):
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text):
    """(kind, start, end) of the base patterns, leftmost and non-overlapping per kind."""
    found = []
    if "@" in text:
        # only the run before an @ can start a match, which spares the quadratic search
        last, at = 0, text.find("@")
        while at >= 0:
            begin = at
            while begin > last and LOCAL.match(text[begin - 1]):
                begin -= 1
            m = begin < at and DOMAIN.match(text, at + 1)
            if m:
                found.append(("email", begin, m.end()))
                last = m.end()
            at = text.find("@", max(at + 1, last))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def votes_on(text, kind, start, end, base):
    """One letter per labeler: y, n or - (abstains)."""
    span = text[start:end]
    around = re.findall(r"\w[\w-]*", f"{text[max(0, start - 40):start]} {text[end:end + 20]}".lower())
    digits = re.sub(r"[^0-9]", "", span)
    if kind == "email":
        known = span.rstrip(".").rsplit(".", 1)[-1].lower() in TOP_LEVEL
    elif kind == "secret":
        known = any(c.isdigit() for c in span) and any(c.isalpha() for c in span)
    else:
        known = None
    if kind == "card":
        check = luhn(digits)
    elif kind == "phone":
        check = len(set(digits)) > 3
    elif kind == "secret":
        check = len(set(span)) >= 8
    else:
        check = None
    context = True if not NEAR[kind].isdisjoint(around) else False if not OTHER.isdisjoint(around) else None
    letter = {True: "y", False: "n", None: "-"}
    return "".join(letter[v] for v in (True if base else None, True if not base else None, known, context, check))


def candidate_spans(text):
    """All candidates of a text by start, then kind: (kind, start, end, base, pattern)."""
    base = base_spans(text)
    taken = defaultdict(list)
    for kind, start, end in base:
        taken[kind].append((start, end))
    found = [(*s, True) for s in base]
    for kind, pattern in LOOSE.items():
        for m in pattern.finditer(text):
            start, end = m.span(m.lastindex or 0)
            if not any(s < end and start < e for s, e in taken[kind]):
                found.append((kind, start, end, False))
    found.sort(key=lambda s: (s[1], ALL_KINDS.index(s[0])))
    return [
        (k, s, e, b, f"{k}:{votes_on(text, k, s, e, b)}:{min(6, (e - s).bit_length())}") for k, s, e, b in found
    ]


def find_candidates(docs, row_id="doc_id", text="text"):
    """One row per row of `docs`: its id and the array of candidates."""

    def run(frames):
        for f in frames:
            spans = [candidate_spans(t) if t else [] for t in f.iloc[:, 1]]
            spans = [[dict(zip(("kind", "start", "end", "base", "pattern"), s)) for s in x] for x in spans]
            yield pd.DataFrame({row_id: f.iloc[:, 0], "spans": spans})

    kind = docs.schema[row_id].dataType.simpleString()
    return docs.select(row_id, text).mapInPandas(run, f"`{row_id}` {kind}, spans {SPANS}")


def estimate(patterns):
    """Probability that a candidate is personal data, per vote pattern, by EM.

    `patterns` maps pattern -> count. Each kind has a prior and each labeler a reliability;
    a labeler that abstains says nothing. Reliabilities start at PRIOR_RIGHT and stay above
    one half, so that the labelers' common sense fixes which class is which.
    """
    result = {}
    for kind in ALL_KINDS:
        own = sorted(p for p in patterns if p.split(":")[0] == kind)
        if not own:
            continue
        n = np.array([patterns[p] for p in own], float)
        v = np.array([[{"y": 1, "n": -1, "-": 0}[c] for c in p.split(":")[1]] for p in own])
        right, prior = np.full(len(LABELERS), PRIOR_RIGHT), 0.5
        for _ in range(50):
            odds = np.log(prior / (1 - prior)) + (v * np.log(right / (1 - right))).sum(axis=1)
            p = 1 / (1 + np.exp(-odds))
            agree = ((v == 1) * p[:, None] + (v == -1) * (1 - p)[:, None]) * n[:, None]
            right = (agree.sum(0) + PRIOR_RIGHT * PRIOR_WEIGHT) / (((v != 0) * n[:, None]).sum(0) + PRIOR_WEIGHT)
            right = np.clip(right, 0.55, 0.99)
            prior = np.clip((p @ n + 0.5 * PRIOR_WEIGHT) / (n.sum() + PRIOR_WEIGHT), 0.05, 0.95)
        result |= dict(zip(own, p))
    return result


def _features(pattern):
    kind, votes, size = pattern.split(":")
    x = [1.0, *(float(kind == k) for k in ALL_KINDS)]
    x += [{"y": 1.0, "n": -1.0, "-": 0.0}[c] for c in votes]
    return x + [float(size == str(s)) for s in range(1, 7)]


def accepted_patterns(patterns):
    """Patterns that the trained span classifier accepts."""
    labels = estimate(patterns)
    own = sorted(labels)
    if not own:
        return []
    x = np.array([_features(p) for p in own])
    y = np.array([labels[p] for p in own])
    n = np.array([patterns[p] for p in own], float)
    w = np.zeros(x.shape[1])
    for _ in range(25):  # Newton steps of ridge logistic regression on weighted soft labels
        p = 1 / (1 + np.exp(-x @ w))
        h = (x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (n * (y - p)) - w)
    return [q for q, p in zip(own, 1 / (1 + np.exp(-x @ w))) if p >= ACCEPT]


def fit(candidates):
    """Patterns accepted after counting the votes on all candidates."""
    votes = candidates.select(F.explode("spans").alias("s")).groupBy("s.pattern").count()
    return accepted_patterns({r["pattern"]: r["count"] for r in votes.collect()})


def find_pii(spark, docs, row_id="doc_id", text="text"):
    """`row_id` and the kept `spans` (kind, start, end, base), one row per row of `docs`.

    Positions are code points, the end exclusive. Null and empty texts have no spans; repeated
    rows are judged each and count in the statistics; other columns are ignored.
    """
    found = stage(spark, find_candidates(docs, row_id, text), "pii")
    accepted = F.array(*[F.lit(p) for p in fit(found)]).cast("array<string>")
    keep = F.filter("spans", lambda s: s["base"] | F.array_contains(accepted, s["pattern"]))
    return found.select(row_id, keep.alias("spans"))


def redact(spark, docs, text="text", row_id="doc_id"):
    """`docs` with every span of personal data in `text` replaced by its kind in brackets.

    Overlapping spans become one, named after the first. A null text stays null; texts
    without spans stay as they are. All columns are kept, in order.
    """
    accepted = frozenset(fit(stage(spark, find_candidates(docs, row_id, text), "pii")))

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        def one(t):
            spans = [s for s in candidate_spans(t) if s[3] or s[4] in accepted] if t else []
            out, at, last = [], 0, None
            for kind, start, end, _, _ in spans:
                if last is None or start >= last:
                    out += [t[at:start], f"[{kind.upper()}]"]
                at = last = max(end, last or 0)
            return "".join([*out, t[at:]]) if spans else t

        return texts.map(one)

    return docs.withColumn(text, clean(text)).select(*docs.columns)


def digest(found):
    """The counts, the hash of the base spans and the list of all spans."""

    def listed(spans):
        return F.concat_ws(
            ",",
            F.transform(
                spans,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
        )

    base = F.filter("spans", lambda s: s["base"])
    counts = [
        F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")  # noqa: B023
        for kind in KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )

"""Personal data: labelers vote on spans, their reliabilities are estimated, a classifier decides.

Base spans follow fixed rules and always stay. Looser candidates, such as spelled-out
addresses, numbers without a plus sign and matches that fail a rule's check, are added if
the final classifier takes them for personal data. It is trained without labels:

1. For every candidate, regex, gazetteer and context labelers vote for, against or abstain.
2. Expectation-maximisation over all votes estimates how often each labeler casts each vote
   on real and on other spans, and from that the probability of every combination of votes.
3. A logistic regression on votes and traits of the span is fitted to those probabilities.

Votes and traits are a handful of small codes, so their combinations are counted in Spark
over all documents, and what is collected is one row per combination (``COMBINATIONS`` at
most), whatever the corpus. Everything else is column expressions over one row per
document: nothing is shuffled but the counts, and no Python runs on executors.

The patterns take time in proportion to the text: runs are possessive and begin where a
run can begin.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.staging import evaluated_once
from fareloom.llm.common import prepare, stored

KINDS = ("email", "ip", "card", "phone")

# The base rules. A match of the stated pattern begins at the first character of a run, or
# where the match before ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?=[0-9])(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# Spans the base rules miss: written otherwise, or lost in a longer match that fails its check.
_AT = r"(?:[ ]at[ ]|[ ]?[\[({<][ ]?(?:at|@)[ ]?[\])}>][ ]?)"
_DOT = r"(?:[ ]dot[ ]|[ ]?[\[({<][ ]?(?:dot|\.)[ ]?[\])}>][ ]?|\.)"
LOOSE = {
    "email": rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}"
    rf"(?:{_DOT}[A-Za-z0-9-]{{2,63}}){{1,4}}",
    "ip": r"(?i)(?=[0-9a-f]{1,4}:)(?<![0-9a-z:.])(?:(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}"
    r"|(?:[0-9a-f]{1,4}:){1,6}(?::[0-9a-f]{1,4}){1,6})(?![0-9a-z:])",
    "card": r"(?=[0-9]{4})(?<![0-9])[0-9]{4}([\x20-]?|[./_]|\x20{2,3})[0-9]{4}\1[0-9]{4}\1[0-9]{4}"
    r"(?![0-9])",
    "phone": r"(?=[(0-9+])(?:\+[0-9]{1,3}[ .-]?\([0-9]{1,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
    r"|\+[0-9]{9,15}(?![0-9])"
    r"|(?<![0-9+.-])(?<![0-9][ ])(?:00[0-9]{1,3}[ .-])?(?:\([0-9]{2,4}\)[ ]?|[0-9]{2,4}[ .-])"
    r"[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])(?![ .-][0-9]))",
}

# What a text must hold to be searched at all: cheaper to look for than the pattern itself.
GUARD = {
    (False, "email"): r"@",
    (False, "phone"): r"\+[0-9]",
    (True, "email"): rf"(?i){_AT}[A-Za-z0-9-]{{1,63}}{_DOT}[A-Za-z0-9-]{{2}}",
    (True, "ip"): r":[0-9A-Fa-f]{0,4}:",
}

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"

# Gazetteers: fixed values.
# Generic and frequent national top-level domains.
DOMAINS = (
    "com org net edu gov mil int info biz name io co me app dev ai eu uk us ca au nz de fr es it "
    "nl be ch at se no dk fi pl pt ie cz ru ua tr in cn jp kr br mx ar za ng gh ke"
).split()
# Country calling codes of one and two digits; those of three begin with 21-26, 29, 35, 37, 38,
# 42, 50, 59, 67, 68, 80, 85, 87, 88, 96, 97, 99.
CALLING = (
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 "
    "64 65 66 81 82 84 86 90 91 92 93 94 95 98"
).split()
CALLING_3 = "21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 80 85 87 88 96 97 99".split()
# First digits of payment cards.
ISSUERS = r"(?:3(?:0[0-5]|[47689])|4|5[1-5]|6(?:011|4[4-9]|5|2)|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|35)"

_FOR = {
    "email": r"(?i)(?:e-?mail|mailto|mail|contact|write|reach|courriel|correo)\W{1,3}(?:\w+\W{1,2}){0,2}$",
    "ip": r"(?i)(?:\bip(?:v[46])?|host|server|address|addr|client|gateway)\W{1,3}(?:\w+\W{1,2}){0,2}$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta)\W{1,3}(?:\w+\W{1,2}){0,2}$",
    "phone": r"(?i)(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp|sms|ring)\W{1,3}(?:\w+\W{1,2}){0,2}$",
}
_AGAINST = (
    r"(?i)(?:version|release|section|chapter|build|order|invoice|isbn|issn|serial|sku|ref|tracking"
    r"|model|part|page|article|look|meet|arrive)\W{1,3}(?:\w+\W{1,2}){0,1}$"
)
BEFORE = 48  # characters before a span that the context labelers see

LABELERS = ("rule", "form", "gazetteer", "number", "context for", "context against", "edges")
TRAITS = 6  # codes of length, in steps of 8 characters, as the labelers do not see it
COMBINATIONS = len(KINDS) * 3 ** len(LABELERS) * TRAITS

# What is believed of the votes (against, none, for) before any are seen, on real spans and
# on others. Weighs as much as SHARE times a kind's candidates, LEAST at least. What check
# sums and counts say is known beforehand: votes that only go together do not unlearn it.
_REAL = [(2, 13, 85), (5, 15, 80), (5, 35, 60), (0.2, 9.8, 90), (1, 69, 30), (2, 97, 1), (10, 5, 85)]
_OTHER = [(10, 40, 50), (40, 20, 40), (40, 35, 25), (85, 10, 5), (1, 98, 1), (30, 69, 1), (40, 5, 55)]
SHARE = np.array([0.1, 0.1, 0.1, 20.0, 0.1, 0.1, 0.1])
LEAST = 50.0
THRESHOLD = 0.5


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of up to 20 digits passes: zeros in front change nothing."""
    padded = F.lpad(digits, 20, "0")

    def digit(i: Column) -> Column:
        d = F.substring(padded, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    places = F.sequence(F.lit(1), F.lit(20))
    return F.aggregate(F.transform(places, digit), F.lit(0), lambda a, d: a + d) % 10 == 0


def running(values: Column, step: Callable[[Column, Column], Column], block: int = 256) -> Column:
    """Each element combined with all before it, in blocks so that long arrays stay cheap.

    ``values`` are longs from 0 up, in a column; ``step`` adds two of them or takes the greater.
    """
    zero = F.lit(0).cast("bigint")

    def from_(start: Column, part: Column) -> Column:
        grown = F.aggregate(
            part, F.array(start), lambda a, v: F.concat(a, F.array(step(F.element_at(a, -1), v)))
        )
        return F.slice(grown, F.lit(2), F.size(part))

    starts = F.sequence(F.lit(1), F.size(values), F.lit(block))
    blocks = F.transform(starts, lambda s: F.slice(values, s, F.lit(block)))
    totals = F.transform(blocks, lambda b: F.aggregate(b, zero, step))
    before = F.slice(F.concat(F.array(zero), from_(zero, totals)), F.lit(1), F.size(totals))
    joined = F.flatten(F.zip_with(blocks, before, lambda b, s: from_(s, b)))
    return F.when(F.size(values) > 0, joined).otherwise(values)


def _add(a: Column, b: Column) -> Column:
    return a + b


def _greater(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _vote(for_: Column, against: Column) -> Column:
    return F.when(for_, 1).when(against, -1).otherwise(0).cast("tinyint")


def _judged(kind: str, loose: bool, m: Column) -> Column:
    """A match with the votes of all labelers, its trait, and whether the base rule takes it."""
    said, digits = m["said"], _digits(m["said"])
    yes, no = F.lit(True), F.lit(False)
    if kind == "email":
        good = no if loose else yes
        end = F.lower(F.regexp_extract(said, r"([A-Za-z0-9-]+)$", 1))
        spelled = said.rlike(r"[\[({<]") | said.rlike(r"(?i)[ ]at[ ].*[ ]dot[ ]")
        form = spelled if loose else said.rlike(r"^[A-Za-z0-9][^@]*@[A-Za-z0-9]")
        known = end.isin(DOMAINS)
        unknown = ~known if loose else ~end.rlike("^[a-z]{2,}$")
        # A word before "at" is no name of a mailbox unless it looks like one.
        handle = said.rlike(r"^[A-Za-z]*[0-9._+-]")
        number = (handle | said.rlike(r"[\[({<]")) if loose else yes
        failed = ~(handle | spelled) if loose else ~said.rlike("[A-Za-z]")
    elif kind == "ip":
        good = no if loose else said.rlike(rf"^(?:{_PART}(?:\.|$)){{4}}$")
        form = yes if loose else ~said.rlike(r"(?:^|\.)0[0-9]")
        unknown = said.rlike(r"^(?:0|127|255)\." if not loose else r"^(?:::|0*:)")
        known = said.rlike(r"^(?i)(?:2[0-9a-f]{3}|f[de])") if loose else ~unknown
        number = (F.size(F.split(said, ":")) <= 8) if loose else good
        failed = ~number
    elif kind == "card":
        good = no if loose else luhn(digits)
        form = F.length(digits).isin(15, 16) & said.rlike(
            r"^[0-9]+$|^[0-9]{4}([^0-9]+)[0-9]{4}\1[0-9]{4}\1[0-9]{4}$|^[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}$"
        )
        known = digits.rlike(f"^{ISSUERS}")
        unknown = ~known
        number = luhn(digits)
        failed = ~number
    else:
        count = F.length(digits)
        good = no if loose else count.between(9, 15)
        form = said.rlike(
            r"^(?:00[0-9]{1,3}[ .-])?\(?[0-9]{3,4}\)?[ .-]?[0-9]{3,4}[ -][0-9]{4}$"
            if loose
            else r"^\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9])[0-9 .-]+$"
        )
        code = F.regexp_replace(said, r"^(?:\+|00)", "")
        prefix = f"^(?:{'|'.join([*CALLING, *[f'{c}[0-9]' for c in CALLING_3]])})"
        known = (said.rlike(r"^(?:\+|00)")) & code.rlike(prefix)
        unknown = said.rlike(r"^(?:\+|00)") & ~known
        number = count.between(9, 15)
        failed = ~number
    glued = m["before"].rlike(r"[\p{L}\p{N}_]$") | m["after"].rlike(r"^[\p{L}\p{N}_]")
    votes = F.array(
        F.lit(0 if loose else 1).cast("tinyint"),
        _vote(form, ~form),
        _vote(known, unknown),
        _vote(number & ~failed, failed),
        _vote(m["before"].rlike(_FOR[kind]), no),
        _vote(no, m["before"].rlike(_AGAINST)),
        _vote(~glued, glued),
    )
    return F.struct(
        m["start"].alias("start"),
        F.lit(KINDS.index(kind)).cast("tinyint").alias("kind"),
        (~good).alias("added"),
        m["end"].alias("end"),
        votes.alias("votes"),
        F.least(F.floor(F.length(said) / 8), F.lit(TRAITS - 1)).cast("tinyint").alias("trait"),
    )


def _found(docs: DataFrame, text: str, patterns: dict[str, str], loose: bool) -> DataFrame:
    """The given rows, with a column of judged matches per kind; null for none.

    Gaps between the matches and the matches are taken apart once; their lengths add up to
    offsets. Each step is a column of its own, since what a lambda mentions is worked out
    again for every element.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    parts = {}
    for kind, pattern in patterns.items():
        there = whole.rlike(GUARD.get((loose, kind), pattern))
        parts[f"gaps_{kind}"] = F.when(there, F.split(whole, pattern, -1))
        parts[f"said_{kind}"] = F.when(there, F.regexp_extract_all(whole, F.lit(pattern), F.lit(0)))
    docs = evaluated_once(docs, parts)
    steps = {
        f"steps_{kind}": F.zip_with(
            F.slice(f"gaps_{kind}", F.lit(1), F.size(f"said_{kind}")),
            f"said_{kind}",
            lambda g, m: (F.length(g) + F.length(m)).cast("bigint"),
        )
        for kind in patterns
    }
    docs = evaluated_once(docs, steps)
    docs = evaluated_once(docs, {f"ends_{k}": running(F.col(f"steps_{k}"), _add) for k in patterns})

    def match(kind: str) -> Column:
        gaps, n = F.col(f"gaps_{kind}"), F.size(f"said_{kind}")
        rows = F.arrays_zip(
            F.col(f"said_{kind}").alias("said"),
            F.col(f"ends_{kind}").alias("end"),
            F.slice(gaps, F.lit(1), n).alias("gap"),
            F.slice(gaps, F.lit(2), n).alias("next"),
        )
        around = F.transform(
            rows,
            lambda m: F.struct(
                (m["end"] - F.length(m["said"])).alias("start"),
                m["end"].alias("end"),
                m["said"].alias("said"),
                F.right(m["gap"], F.lit(BEFORE)).alias("before"),
                F.left(m["next"], F.lit(1)).alias("after"),
            ),
        )
        return F.transform(around, lambda m: _judged(kind, loose, m))

    docs = evaluated_once(docs, {f"{'loose' if loose else 'base'}_{k}": match(k) for k in patterns})
    made = [f"{part}_{k}" for part in ("gaps", "said", "steps", "ends") for k in patterns]
    return docs.drop(*made)


_SPAN = "start:bigint,kind:tinyint,added:boolean,end:bigint,votes:array<tinyint>,trait:tinyint"


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """The given rows with ``spans``: base spans and candidates, in order of start and kind.

    Offsets are code points, the end exclusive. A null text is empty. A candidate that begins
    inside a base span of its kind is none. A given column named ``spans`` is replaced.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("text", F.col("row")[text])
    rows = _found(_found(rows, "text", BASE, False), "text", LOOSE, True)
    none = F.array().cast(f"array<struct<{_SPAN}>>")
    both = {
        f"all_{k}": F.array_sort(
            F.concat(
                F.coalesce(F.filter(f"base_{k}", lambda s: ~s["added"]), none),
                F.coalesce(F.col(f"loose_{k}"), none),
            )
        )
        for k in KINDS
    }
    rows = evaluated_once(rows.select("row", *[c.alias(n) for n, c in both.items()]), {
        f"reach_{k}": F.transform(
            f"all_{k}", lambda s: F.when(~s["added"], s["end"]).otherwise(F.lit(0).cast("bigint"))
        )
        for k in KINDS
    })
    rows = evaluated_once(
        rows, {f"covered_{k}": running(F.col(f"reach_{k}"), _greater) for k in KINDS}
    )

    def free(kind: str) -> Column:
        seen = F.zip_with(
            f"all_{kind}", f"covered_{kind}", lambda s, c: F.struct(s.alias("s"), c.alias("c"))
        )
        left = F.filter(seen, lambda x: ~x["s"]["added"] | (x["c"] <= x["s"]["start"]))
        return F.transform(left, lambda x: x["s"])

    spans = F.array_sort(F.concat(*[free(k) for k in KINDS]))
    return rows.select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c != "spans"], spans.alias("spans")
    )


@dataclass
class Model:
    """Weights of the classifier per kind: of each vote of each labeler, and of each trait."""

    bias: np.ndarray  # [kind]
    votes: np.ndarray  # [kind, labeler, vote + 1]
    traits: np.ndarray  # [kind, trait]
    reliability: np.ndarray  # [kind, real or not, labeler, vote + 1], as EM estimates it

    def logit(self, span: Column) -> Column:
        """The log odds that a span is personal data."""

        def table(values: np.ndarray) -> Column:
            return F.array(*[F.lit(float(v)) for v in values.ravel()])

        kind, width = span["kind"].cast("int"), 3 * len(LABELERS)
        weights = table(self.votes)
        said = F.transform(
            span["votes"],
            lambda v, i: F.get(weights, kind * width + i * 3 + v.cast("int") + 1),
        )
        own = F.get(table(self.traits), kind * TRAITS + span["trait"].cast("int"))
        start = F.get(table(self.bias), kind) + own
        return F.aggregate(said, start, lambda a, w: a + w)


def expectation_maximisation(votes: np.ndarray, n: np.ndarray, rounds: int = 200):
    """Probability of being real for each combination of votes, and the reliabilities.

    ``votes`` holds 0 (against), 1 (none) or 2 (for) per combination and labeler, ``n`` how
    often the combination occurs. Labelers are taken as independent given the truth.
    """
    prior = np.array([_REAL, _OTHER], np.float64)
    table = prior / prior.sum(axis=2, keepdims=True)
    prior = table * np.maximum(LEAST, SHARE * n.sum())[None, :, None]
    share = np.array([0.5, 0.5])
    labelers = np.arange(votes.shape[1])
    real = np.full(len(n), 0.5)
    for _ in range(rounds):
        log = np.log(share)[:, None] + np.log(table[:, labelers, votes]).sum(axis=2)
        new = 1 / (1 + np.exp(np.clip(log[1] - log[0], -500, 500)))
        done = np.abs(new - real).max(initial=0) < 1e-9
        real = new
        if done:
            break
        of = np.stack([n * real, n * (1 - real)])
        share = (of.sum(axis=1) + LEAST / 2) / (n.sum() + LEAST)
        table = prior.copy()
        for v in range(3):
            table[:, :, v] += of @ (votes == v)
        table /= table.sum(axis=2, keepdims=True)
    return real, table


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights, the bias first, of a regression on probabilities ``y``; Newton's method."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, n = np.zeros(x.shape[1]), n / n.sum()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + ridge * w
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(found: DataFrame) -> Model:
    """A model from the spans of all rows; kinds without a candidate follow the priors alone."""
    span = found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.trait")
    counts = span.groupBy("kind", "votes", "trait").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.orderBy("kind", "votes", "trait").collect()  # COMBINATIONS at most
    kinds, width = len(KINDS), 3 * len(LABELERS)
    model = Model(
        np.zeros(kinds),
        np.zeros((kinds, len(LABELERS), 3)),
        np.zeros((kinds, TRAITS)),
        np.zeros((kinds, 2, len(LABELERS), 3)),
    )
    for k in range(kinds):
        own = [r for r in rows if r["kind"] == k]
        votes = np.array([r["votes"] for r in own], np.int64).reshape(-1, len(LABELERS)) + 1
        n = np.array([r["n"] for r in own], np.float64)
        real, model.reliability[k] = expectation_maximisation(votes, n)
        if not own:
            continue
        x = np.zeros((len(own), width + TRAITS))
        for i in range(len(LABELERS)):
            x[np.arange(len(own)), 3 * i + votes[:, i]] = 1
        x[np.arange(len(own)), width + np.array([r["trait"] for r in own])] = 1
        w = logistic(x, real, n)
        model.bias[k] = w[0]
        model.votes[k] = w[1 : 1 + width].reshape(-1, 3)
        model.traits[k] = w[1 + width :]
    return model


def detected(found: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``candidates`` with ``spans`` cut to base spans and those the model takes.

    A span is a struct of start, kind, added, end and probability.
    """

    def scored(s: Column) -> Column:
        return F.struct(
            s["start"],
            F.element_at(F.array(*map(F.lit, KINDS)), s["kind"].cast("int") + 1).alias("kind"),
            s["added"],
            s["end"],
            (1 / (1 + F.exp(-model.logit(s)))).alias("probability"),
        )

    spans = F.transform("spans", scored)
    return found.withColumn("spans", F.filter(spans, lambda s: ~s["added"] | (s["probability"] >= threshold)))


def _listed(spans: Column) -> Column:
    said = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(said, ",")


def query(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans, one row per given row.

    A null or empty text has no span. Null and repeated ids are rows like any other. Without
    any candidate the model is that of the priors and nothing is added. Other columns are not
    read.
    """
    prepare(docs.sparkSession)
    found = stored(candidates(docs.select("doc_id", "text")).select("doc_id", "spans"), "spans")
    out = detected(found, fit(found))
    base = F.filter("spans", lambda s: ~s["added"])
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size("base") - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}")
        for k in KINDS
    ]
    return out.withColumn("base", base).select(
        "doc_id",
        *counts,
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("bigint").alias("n_added"),
    )

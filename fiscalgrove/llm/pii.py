"""Personal data by weak supervision.

Base patterns find e-mail addresses, IP addresses, card and phone numbers. Wider patterns find candidate spans; labelers (a
pattern's format, gazetteers, the words before, the shape) vote on each: yes, no or nothing. The counts
of the vote patterns, a table of bounded size, let expectation-maximisation estimate how reliable each
labeler is; its posteriors train a logistic span classifier over votes and surface features. Candidates
that it accepts are added to the base spans. Texts go through built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalgrove.llm.shared import let, stored

# Equal to the plain patterns, but linear: a run is entered at its start or where the last match ended, is never given back, and
# repeated groups are written as single characters with look-around, which Java's matcher runs in a loop.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-]++(?:[A-Za-z0-9.-](?<=[A-Za-z0-9-]|[A-Za-z0-9-]\.(?=[A-Za-z0-9-])))*+"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[0-9 -](?<=[0-9]|[0-9][ -](?=[0-9])))++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: base kinds, in the order of equal starts
BASE = ("email", "ip", "card", "phone")
#: kinds that the method adds
ADDED = ("number", "secret", "mail")

# seven or more digits with single separators, not inside a word or a decimal number
NUMBER = r"(?<![0-9A-Za-z.,_+-])[(+]?[0-9](?:[0-9 ().-](?<=[0-9]|[0-9][ ().-](?=[ (0-9])|[0-9]\)[ -](?=[0-9])|[0-9][ -]\((?=[0-9]))){6,}+(?![0-9A-Za-z_])"
SECRET = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}+"
MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}+){1,8}+"

# fixed values: gazetteers and cue words of the labelers
TLDS = ["com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "uk", "eu", "example"]
CALLING_CODES = ["1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "81", "86", "91"]
CUES = ["token", "key", "secret", "password", "passwd", "pwd", "bearer", "auth", "card", "account", "iban", "phone", "tel", "mobile", "call", "fax", "mail", "contact", "ssn", "passport"]
COUNTER_CUES = ["version", "page", "isbn", "issn", "sha", "commit", "checksum", "md5", "figure", "table", "item", "no", "total", "usd", "eur"]
#: characters before a span that the context labeler reads
CONTEXT = 32
LABELERS = ("format", "gazetteer", "context", "shape")
EM_ROUNDS = 50


def located(text: Column, pattern: str) -> Column:
    """array<struct<start,end,match,before>> of the leftmost non-overlapping matches, in code points. The gaps of a split and the
    matches take turns, so running sums of their lengths are the places."""

    def spans(matches: Column) -> Column:
        def zipped(gaps: Column) -> Column:
            pairs = F.zip_with(matches, F.slice(gaps, F.lit(1), F.size(matches)), lambda m, g: F.struct(m.alias("m"), g.alias("g")))
            start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string,before:string>>").alias("out"))

            def add(acc: Column, p: Column) -> Column:
                begin = acc["at"] + F.length(p["g"])
                end = begin + F.length(p["m"])
                near = F.substring(p["g"], -CONTEXT, CONTEXT)
                return F.struct(end.alias("at"), F.array_append(acc["out"], F.struct(begin.alias("start"), end.alias("end"), p["m"].alias("match"), near.alias("before"))).alias("out"))

            return F.aggregate(pairs, start, add, lambda acc: acc["out"])

        return F.when(F.size(matches) == 0, F.array().cast("array<struct<start:int,end:int,match:string,before:string>>")).otherwise(
            let(F.split(text, pattern, -1), zipped))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Does a string of digits pass? Every second digit from the right counts double, less 9 above 9."""
    def weighed(acc: Column, i: Column) -> Column:
        d = number.substr(F.length(number) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), weighed) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$".replace("0*+", "0*"))
    if kind == "card":
        return let(digits(match), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False)))
    return F.length(digits(match)).between(9, 15)


def base_spans(text: Column) -> Column:
    """array<struct<start,kind,end>>: valid base matches, by start and kind."""
    gate = {"email": F.instr(text, "@") > 0, "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9][ -]?[0-9]"), "phone": F.instr(text, "+") > 0}
    pattern = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def of_kind(i: int, kind: str) -> Column:
        hits = F.filter(located(text, pattern[kind]), lambda s: valid(kind, s["match"]))
        return F.when(gate[kind], F.transform(hits, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("kind"), s["end"].alias("end")))).otherwise(none)

    found = [of_kind(i, kind) for i, kind in enumerate(BASE)]
    return F.array_sort(F.concat(*found))


def candidates(text: Column) -> Column:
    """array<struct<start,end,match,before,kind>> of the wide patterns."""
    none = F.array().cast("array<struct<start:int,end:int,match:string,before:string,kind:string>>")
    gate = {"number": text.rlike("[0-9]"), "secret": text.rlike("[A-Za-z0-9+/_=-]{24}"), "mail": text.rlike(r"[(\[]at[)\]]")}
    pattern = {"number": NUMBER, "secret": SECRET, "mail": MAIL}
    # a secret mixes digits and letters; a run of one sort is a word or a rule
    fits = {"number": lambda s: F.length(digits(s["match"])) >= 7, "secret": lambda s: s["match"].rlike("[0-9]") & s["match"].rlike("[A-Za-z]"), "mail": lambda s: F.lit(True)}

    def of_kind(kind: str) -> Column:
        hits = F.filter(located(text, pattern[kind]), fits[kind])
        return F.when(gate[kind], F.transform(hits, lambda s: F.struct(
            *[s[c].alias(c) for c in ("start", "end", "match", "before")], F.lit(kind).alias("kind")))).otherwise(none)

    return F.concat(*map(of_kind, ADDED))


def _any_word(words: list[str]) -> str:
    return r"(?<![a-z])(?:" + "|".join(words) + r")(?![a-z])"


def votes(c: Column) -> dict[str, Column]:
    """Each labeler's vote on a candidate: 1 yes, -1 no, 0 nothing."""
    yes, no, nothing = F.lit(1), F.lit(-1), F.lit(0)
    n, match, before = F.length(digits(c["match"])), c["match"], F.lower(c["before"])
    number, secret = c["kind"] == "number", c["kind"] == "secret"
    distinct = F.size(F.array_distinct(F.split(match, "")))
    return {
        "format": F.when(number, F.when(n.between(9, 19), yes).when(n > 19, no).otherwise(nothing)).when(
            secret, F.when(match.rlike("^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$") | match.rlike("^(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9]).*$"), yes).otherwise(nothing)).otherwise(yes),
        "gazetteer": F.when(number, F.when(match.rlike(r"^[(+]?(?:" + "|".join(CALLING_CODES) + r")[ (.-]") | (n.between(13, 16) & digits(match).rlike("^(?:4|5[1-5]|3[47]|6011)")), yes).otherwise(nothing)).when(
            secret, F.when(F.lower(match).rlike("[a-z]{12,}"), no).otherwise(nothing)).otherwise(
            F.when(F.lower(match).rlike(r"[.)\] ](?:" + "|".join(TLDS) + ")$"), yes).otherwise(nothing)),
        "context": F.when(before.rlike(_any_word(CUES)), yes).when(before.rlike(_any_word(COUNTER_CUES)), no).otherwise(nothing),
        "shape": F.when(number, F.when(distinct <= 3, no).when(n >= 9, yes).otherwise(nothing)).when(
            secret, F.when(distinct <= 6, no).when(distinct >= 10, yes).otherwise(nothing)).otherwise(nothing),
    }


def features(c: Column) -> dict[str, Column]:
    """Surface features of a candidate, each of a few values."""
    return {
        "kind": c["kind"],
        "size": F.least(F.floor(F.length(c["match"]) / 8), F.lit(8)).cast("string"),
        "digits": F.floor(4 * F.length(digits(c["match"])) / F.length(c["match"])).cast("string"),
        "quoted": c["before"].rlike("""["'=:] ?$""").cast("string"),
    }


def described(text: Column) -> Column:
    """Candidates with votes and features, those that touch no base span: array<struct<start,end,kind,votes,features>>."""
    return F.transform(candidates(text), lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"),
        F.struct(*[v.cast("string").alias(k) for k, v in votes(c).items()]).alias("votes"),
        F.struct(*[v.alias(k) for k, v in features(c).items()]).alias("features")))


def estimate(patterns: dict[tuple[str, tuple[str, ...]], int]) -> dict[tuple[str, tuple[str, ...]], float]:
    """Expectation-maximisation over vote patterns. patterns: (kind, votes) -> count. Returns the posterior of each. The reliabilities
    (how likely each vote is, given the truth) are estimated per labeler and kind; votes are independent given the truth. It starts from the
    majority of votes; one pseudo-count keeps every vote possible."""
    post = {p: 1 / (1 + math.exp(-sum(map(int, p[1])))) for p in patterns}
    for _ in range(EM_ROUNDS):
        tally: dict[tuple, float] = {}
        for (kind, vs), n in patterns.items():
            for y, weight in ((1, post[kind, vs]), (0, 1 - post[kind, vs])):
                tally[kind, y] = tally.get((kind, y), 1.0) + n * weight
                for j, v in enumerate(vs):
                    tally[kind, y, j, v] = tally.get((kind, y, j, v), 1.0) + n * weight
        for kind, vs in patterns:
            odds = math.log(tally[kind, 1]) - math.log(tally[kind, 0])
            for j, v in enumerate(vs):
                odds += sum(s * (math.log(tally[kind, y, j, v]) - math.log(tally[kind, y] + 2)) for y, s in ((1, 1), (0, -1)))
            post[kind, vs] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post


def train(rows: list[tuple[tuple[str, ...], float, int]], rounds: int = 300, rate: float = 1.0, ridge: float = 1e-3) -> dict[str, float]:
    """Logistic regression on soft labels. rows: (active features, label, count); gradient steps on their weighted mean."""
    total = sum(n for _, _, n in rows) or 1
    weights: dict[str, float] = {f: 0.0 for active, _, _ in rows for f in active}
    for _ in range(rounds):
        slope = {f: ridge * w for f, w in weights.items()}
        for active, label, n in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[f] for f in active)))))
            for f in active:
                slope[f] += (p - label) * n / total
        for f in weights:
            weights[f] -= rate * slope[f]
    return weights


def classifier(found: DataFrame) -> dict[str, float]:
    """The weights of the span classifier, from all candidates in ``found`` (column ``candidates``). What reaches the driver is one row
    per combination of votes and features: 3 kinds, 3^4 votes, 9 sizes, 5 digit shares, 2 quotes at most."""
    parts = [f"c.votes.{v}" for v in LABELERS] + [f"c.features.{f}" for f in ("kind", "size", "digits", "quoted")]
    grouped = found.select(F.explode("candidates").alias("c")).groupBy(*[F.col(p).alias(p.replace(".", "_")) for p in parts]).agg(F.count(F.lit(1)).alias("n")).collect()
    rows = [(tuple(r[: len(LABELERS)]), tuple(r[len(LABELERS) : -1]), r[-1]) for r in sorted(grouped)]
    patterns: dict[tuple, int] = {}
    for vs, fs, n in rows:
        patterns[fs[0], vs] = patterns.get((fs[0], vs), 0) + n
    post = estimate(patterns)
    return train([(names(vs, fs), post[fs[0], vs], n) for vs, fs, n in rows])


def names(vs: tuple, fs: tuple) -> tuple[str, ...]:
    return ("bias", *(f"{k}={fs[0]}:{v}" for k, v in zip(LABELERS, vs)), *(f"{k}={v}" for k, v in zip(("kind", "size", "digits", "quoted"), fs)))


def accepted(c: Column, weights: dict[str, float]) -> Column:
    """Does the classifier take the candidate for personal data?"""
    if not weights:
        return F.lit(False)
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    own = lambda name: F.coalesce(F.element_at(table, name), F.lit(0.0))
    score = own(F.lit("bias"))
    for k in LABELERS:
        score += own(F.concat(F.lit(f"{k}="), c["kind"], F.lit(":"), c["votes"][k]))
    for k in ("kind", "size", "digits", "quoted"):
        score += own(F.concat(F.lit(f"{k}="), c["features"][k]))
    return score > 0


def all_spans(base: Column, cands: Column, weights: dict[str, float]) -> Column:
    """array<struct<start,kind,end>>: base spans, and the accepted candidates that touch none of them."""
    free = F.filter(cands, lambda c: accepted(c, weights) & ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    order = F.create_map(*[F.lit(x) for i, k in enumerate(ADDED) for x in (k, len(BASE) + i)])
    more = F.transform(free, lambda c: F.struct(c["start"].alias("start"), F.element_at(order, c["kind"]).alias("kind"), c["end"].alias("end")))
    return F.array_sort(F.concat(base, more))


def joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in BASE + ADDED])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``base`` and ``spans`` as arrays of (start, kind, end).

    A null or empty text has no spans. Ids may be null or repeated: rows stand for themselves. An empty table gives no rows (and trains
    no classifier). Other columns are not looked at. The text is read once; spans and candidates are stored without it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = stored(docs.select(F.col(id_col).alias("id"), base_spans(text).alias("base"), described(text).alias("candidates")), "pii")
    return found.select(F.col("id").alias(id_col), "base", all_spans(F.col("base"), F.col("candidates"), classifier(found)).alias("spans"))


def report(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    def count(i: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long").alias(f"n_{BASE[i]}")

    n = [count(i) for i in range(len(BASE))]
    return spans.select(id_col, *n, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def masked(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` with every span replaced by its kind in square brackets, such as ``[EMAIL]``; ``length_col``, if there,
    is counted anew where the text changed. Null texts stay null. The classifier learns from a first
    pass over the texts; a second one finds the spans again, so no copy of the texts takes disk and no key is needed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    weights = classifier(docs.select(described(text).alias("candidates")))
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), base_spans(text).alias("base"), described(text).alias("candidates"))
    spans = all_spans(F.col("base"), F.col("candidates"), weights)
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in BASE + ADDED])
    old = F.col("row")[text_col]

    def rewritten(found: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

        def add(acc: Column, s: Column) -> Column:
            # a span that starts inside the one before only moves the end
            piece = F.concat(old.substr(acc["at"] + 1, s["start"] - acc["at"]), F.get(tags, s["kind"]))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], F.array_append(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

        return F.aggregate(found, start, add, lambda acc: F.concat(F.array_join(acc["out"], ""), old.substr(acc["at"] + 1, F.length(old))))

    new = let(spans, lambda s: F.when(F.size(s) > 0, rewritten(s)).otherwise(old))
    out = found.select("row", new.alias("text"))
    row, changed = F.col("row"), ~F.col("text").eqNullSafe(F.col("row")[text_col])
    fields = []
    for c in docs.columns:
        value = F.col("text") if c == text_col else row[c]
        if c == length_col:
            value = F.when(changed, F.length("text")).otherwise(row[c]).cast(docs.schema[c].dataType)
        fields.append(value.alias(c))
    return out.select(*fields)

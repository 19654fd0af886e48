"""Personal data by weak supervision, in DataFrame operations throughout.

Candidates are wider than the base patterns: whatever a base pattern matches, valid or not, and spellings it does not
reach. Four labelers vote for or against each candidate or abstain: the base pattern with its check, a form check, a
gazetteer, and words near it. Expectation-maximisation (Dawid and Skene's model with two classes, per kind) estimates how
reliable each labeler is from the counts of vote patterns, of which there are at most 3^4 per kind, however many texts
there are. The posteriors then train the final classifier, naive Bayes over features of a span, again from grouped counts.
Base spans always stay; other candidates are spans if the classifier says so. They never overlap base spans of their kind,
as the wide patterns cannot match within, or run into, what a base pattern matches. What a base pattern matches but its
check refuses is never a span; it is known to be false, which anchors the estimation.

A text is read once; candidates, which are few, are stored with it as an array, and everything later works on those. No text
is shuffled. Positions come from the lengths of the pieces between and of the matches, so they are code points, and no
character is reserved as a mark. The patterns are written so that they need no more than linear time on long runs.

Defined cases: a null or empty text has no spans; null and repeated ids are rows of their own; an empty table gives no rows;
other columns are ignored. Without any candidate there is nothing to estimate and the classifier accepts none.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changefold.llm.common import stored, table

#: Kinds in their order. The patterns, with possessive repeats and starts at the edge of a run, which match
#: just what the plain ones do.
KINDS = ["email", "ip", "card", "phone"]
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Spellings beyond the base patterns.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++"
    r"(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)++(?![A-Za-z0-9._%+-]*+@)",
    "phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
}
_PART = "0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
_IP = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"
#: Words before a span that speak for its kind.
CONTEXT = {
    "email": "mail|contact|write|reach",
    "ip": "ip|server|host|address|login",
    "card": "card|visa|mastercard|amex|credit|payment",
    "phone": "phone|tel|call|mobile|fax|contact",
}
#: Gazetteer: top-level names, first digits of card issuers, and country codes.
GAZETTEER = {
    "email": r"(?i)(?:\.|dot[\])]\x20?)(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$",
    "ip": r"^(?!0|127\.|169\.254\.|22[4-9]|2[3-5])",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^\+(?:1|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])|^\(?[2-9]",
}
FORM = {"email": r"^.{6,80}$", "ip": r"^[0-9.]{7,15}$", "card": r"^[0-9]{4}[0-9\x20-]{9,20}[0-9]$", "phone": r"^[+(]?[0-9].{6,18}$"}
LABELERS = ["pattern", "form", "gazetteer", "context"]
FEATURES = [*LABELERS, "length", "digits"]
ROUNDS = 50
#: Code points before a span that count as its context.
NEAR = 40
_CHUNK = 256
_SIZED = "struct<gap:int,size:int,match:string,before:string>"
_SPAN = "struct<start:int,end:int,match:string,before:string>"


def luhn(digits: Column) -> Column:
    """True where a string of digits has a right check digit."""
    n = F.length(digits)

    def worth(i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda total, i: total + worth(i)) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """Whether what a base pattern matched passes its check."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(_IP)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(10, 15) if kind == "phone" else F.lit(True)


def _sized(text: Column, pattern: str, tried: Column) -> Column:
    """Length of the gap before each match, of the match, the match, and its context; empty where it is not tried."""
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
    matched = F.transform(
        F.filter(pieces, lambda p: p["match"].isNotNull()),
        lambda p: F.struct(
            F.length(p["gap"]).alias("gap"),
            F.length(p["match"]).alias("size"),
            p["match"].alias("match"),
            F.right(p["gap"], F.lit(NEAR)).alias("before"),
        ),
    )
    return F.when(tried, matched.cast(f"array<{_SIZED}>")).otherwise(F.array().cast(f"array<{_SIZED}>"))


def _spans(name: str) -> Column:
    """Starts and ends from the column `name` of `_sized`: running sums, in chunks so that very many matches stay cheap."""
    return F.expr(f"""
      flatten(zip_with(
        {name}_chunks,
        aggregate(
          {name}_chunks, struct(0 as at, cast(array() as array<int>) as starts),
          (acc, part) -> struct(
            acc.at + aggregate(part, 0, (n, x) -> n + x.gap + x.size) as at, concat(acc.starts, array(acc.at)) as starts)
        ).starts,
        (part, base) -> aggregate(
          part, struct(base as at, cast(array() as array<{_SPAN}>) as spans),
          (acc, x) -> struct(
            acc.at + x.gap + x.size as at,
            concat(acc.spans, array(struct(
              acc.at + x.gap as start, acc.at + x.gap + x.size as end, x.match as match, x.before as before))) as spans)
        ).spans))""")


def _once(frame: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """Add columns behind a generator, which the optimizer does not pull apart: each is computed once per row."""
    each = F.struct(*(c.alias(n) for n, c in columns.items()))
    return frame.select(*keep, F.inline(F.array(each)))


def candidates(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` of `docs`, and `spans` of its column `text`: an array of (start, kind, end, base, votes...)."""
    names = [(f"base_{k}", k, BASE[k]) for k in KINDS] + [(f"wide_{k}", k, f"(?:{BASE[k]})|(?:{WIDE[k]})") for k in WIDE]
    text = F.coalesce("text", F.lit(""))
    digits, at = text.rlike("[0-9]"), F.contains(text, F.lit("@"))
    tried = {
        "base_email": at,
        "base_ip": digits & F.contains(text, F.lit(".")),
        "base_card": digits,
        "base_phone": digits & F.contains(text, F.lit("+")),
        "wide_email": text.rlike(r"[\[(]at[\])]"),
        "wide_phone": text.rlike("[0-9]{3}[\\x20.-][0-9]{4}"),
    }
    sized = _once(docs, keep, {name: _sized(text, pattern, tried[name]) for name, _, pattern in names})
    chunks = {
        f"{n}_chunks": F.expr(
            f"if(size({n}) = 0, cast(array() as array<array<{_SIZED}>>), "
            f"transform(sequence(0, (size({n}) - 1) div {_CHUNK}), c -> slice({n}, cast(c as int) * {_CHUNK} + 1, {_CHUNK})))"
        )
        for n, _, _ in names
    }
    located = _once(_once(sized, keep, chunks), keep, {n: _spans(n) for n, _, _ in names})

    def voted(name: str, kind: str) -> Column:
        spans, wide = F.col(name), name.startswith("wide")
        if wide:  # the base pattern's own matches are in the scan only so that none is run into
            spans = F.filter(spans, lambda s: ~s["match"].rlike(f"^(?:{BASE[kind]})$"))

        def vote(s: Column) -> Column:
            good = F.lit(False) if wide else valid(kind, s["match"])
            said = s["before"].rlike(f"(?i)(?<![a-z])(?:{CONTEXT[kind]})")
            share = F.length(F.regexp_replace(s["match"], "[^0-9]", "")) * 4 / F.length(s["match"])
            return F.struct(
                s["start"].alias("start"),
                F.lit(KINDS.index(kind)).alias("kind"),
                s["end"].alias("end"),
                good.alias("base"),
                (F.lit(0) if wide else F.when(good, 1).otherwise(-1)).alias("pattern"),
                F.when(s["match"].rlike(FORM[kind]), 1).otherwise(-1).alias("form"),
                F.when(s["match"].rlike(GAZETTEER[kind]), 1).otherwise(-1).alias("gazetteer"),
                F.when(said, 1).otherwise(0).alias("context"),
                F.least(F.length(s["match"]) / 8, F.lit(5)).cast("int").alias("length"),
                share.cast("int").alias("digits"),
            )

        fields = "start:int,kind:int,end:int,base:boolean," + ",".join(f"{x}:int" for x in FEATURES)
        return F.transform(spans, vote).cast(f"array<struct<{fields}>>")

    return located.select(*keep, F.array_sort(F.concat(*(voted(n, k) for n, k, _ in names))).alias("spans"))


def reliabilities(counts: dict[tuple[int, tuple[int, ...]], int]) -> dict[tuple[int, tuple[int, ...]], float]:
    """Posterior that a candidate is true, by kind and votes, from the numbers of candidates with those votes.

    Two classes, votes independent given the class; votes of 0 count as a third outcome. Refused base matches (a first
    vote of -1) are known to be false. Each kind is estimated by itself; outcomes start from one pseudo count."""
    posterior = {}
    for kind in {k for k, _ in counts}:
        mine = {votes: n for (k, votes), n in counts.items() if k == kind}
        belief = {v: 0.0 if v[0] < 0 else (0.9 if sum(v) > 0 else 0.5 if sum(v) == 0 else 0.1) for v in mine}
        for _ in range(ROUNDS):
            prior = [1.0, 1.0]
            table = [[{-1: 1.0, 0: 1.0, 1: 1.0} for _ in LABELERS] for _ in range(2)]
            for votes, n in mine.items():
                for true in range(2):
                    weight = n * (belief[votes] if true else 1 - belief[votes])
                    prior[true] += weight
                    for labeler, vote in enumerate(votes):
                        table[true][labeler][vote] += weight
            for votes in mine:
                if votes[0] < 0:
                    continue
                score = [
                    math.log(prior[true]) + sum(math.log(table[true][i][v] / (prior[true] + 2)) for i, v in enumerate(votes))
                    for true in range(2)
                ]
                belief[votes] = 1 / (1 + math.exp(min(700.0, max(-700.0, score[0] - score[1]))))
        posterior |= {(kind, votes): p for votes, p in belief.items()}
    return posterior


def train(spans: DataFrame) -> dict[str, float]:
    """Weights of the span classifier by `kind:feature:value`, and `kind` for the prior, from a frame of candidates."""
    rows = spans.groupBy("kind", *FEATURES).agg(F.count("*").alias("n")).collect()  # at most 9,720 patterns
    counts: dict = defaultdict(int)
    for r in rows:
        counts[r["kind"], tuple(r[x] for x in LABELERS)] += r["n"]
    posterior = reliabilities(counts)
    sums: dict = defaultdict(lambda: [1.0, 1.0])
    for r in rows:
        p = posterior[r["kind"], tuple(r[x] for x in LABELERS)]
        for key in [str(r["kind"]), *(f"{r['kind']}:{x}:{r[x]}" for x in FEATURES)]:
            sums[key][0] += r["n"] * (1 - p)
            sums[key][1] += r["n"] * p
    weights = {}
    for key, (false, true) in sums.items():
        weight = math.log(true / false)
        if ":" in key:  # P(value | class), the kind's sums being those of the class
            all_false, all_true = sums[key.split(":")[0]]
            weight -= math.log(all_true / all_false)
        weights[key] = weight
    return weights


def accepted(spans: str, weights: dict[str, float]) -> Column:
    """The candidates of the array column `spans` that are base spans or that the classifier takes for true."""
    if not weights:
        return F.filter(spans, lambda s: s["base"])
    known = F.create_map(*(F.lit(x) for pair in sorted(weights.items()) for x in pair))

    def weight(key: Column) -> Column:
        return F.coalesce(F.element_at(known, key), F.lit(0.0))

    def taken(s: Column) -> Column:
        kind = s["kind"].cast("string")
        score = weight(kind)
        for x in FEATURES:
            score = score + weight(F.concat_ws(":", kind, F.lit(x), s[x].cast("string")))
        return s["base"] | ((s["pattern"] >= 0) & (score > 0))

    return F.filter(spans, taken)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined, in the order of start and kind."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): base counts, the digest of the base spans, and all spans."""
    found = stored(candidates(docs, ["doc_id"]), "personal-data")
    weights = train(found.select(F.inline("spans")))
    base = F.filter("spans", lambda s: s["base"])

    def n(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == KINDS.index(kind)))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(n, KINDS), F.sha2(listed(base), 256).alias("base_sha256"), listed(accepted("spans", weights)).alias("spans")
    )


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets and `n_chars` to match; other columns as they are.

    Spans that overlap are replaced together, by the kind of the first. Candidates are found once to train the classifier
    and once more as the texts pass, so no text is shuffled or stored and ids need not be unique."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    found = stored(candidates(rows, ["text"]).select("spans").filter("size(spans) > 0"), "personal-data")
    weights = train(found.select(F.inline("spans")))
    passing = _once(candidates(rows, ["row", "text"]), ["row", "text"], {"taken": accepted("spans", weights)})
    names = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + ")"
    redacted = F.expr(f"""
      aggregate(taken, struct(0 as at, cast(array() as array<string>) as parts),
        (acc, s) -> if(s.start < acc.at, struct(greatest(acc.at, s.end) as at, acc.parts as parts), struct(
          s.end as at, concat(acc.parts, array(substring(text, acc.at + 1, s.start - acc.at), {names}[s.kind])) as parts)),
        acc -> array_join(acc.parts, '') || substring(text, acc.at + 1))""")
    whole = F.col("text").isNull() | (F.size("taken") == 0)
    out = passing.select("row", F.when(whole, F.col("text")).otherwise(redacted).alias("clean"), (~whole).alias("changed"))
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns}
    columns["text"] = F.col("clean")
    if "n_chars" in columns:
        length = F.length("clean").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("changed"), length).otherwise(F.col("row.n_chars"))
    return out.select(*(c.alias(n) for n, c in columns.items()))


def op3_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Find the personal data in every document."""
    return find_personal_data(table(spark, sf_dir, "documents"))

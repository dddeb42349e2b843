"""Personal data by weak supervision. DataFrame and SQL functions only.

Labelers vote on candidate spans, and each may abstain: the strict pattern with its check (regex), value lists (gazetteer), cue
words before the span that speak for it or against it (context) and the span's form (shape). Candidates are the matches of the
strict patterns and those of looser ones that overlap none of these. Their votes are counted by kind and vote pattern, a table
of at most 4 * 3 ** 4 rows; from it expectation-maximisation estimates each labeler's reliability per kind and a posterior for
each pattern, and a logistic span classifier is trained on these posteriors. Spans of the strict patterns that pass their
checks always stay. Loose candidates are added where the classifier gives at least ADD: votes for them must outweigh the
prior, which for numbers that only look like a phone is against them, so a number without a cue, or with a cue such as
"order", is left alone.

Positions come from splitting a text at its matches: a match starts where the pieces and matches before it end, which is summed
up in runs of RUN matches, so that a text with very many spans takes no quadratic time. The strict patterns are possessive and
start only at the end of the last match or at the start of a run, which changes no match but keeps them linear in very long
runs.

Defined results: a null text is an empty one; very long texts are read whole; spans are in code points, end exclusive; spans of
different kinds may overlap, added ones overlap no match of a strict pattern; ties in start follow the order of KINDS; repeated
rows are judged each; an empty table gives no rows; columns other than the named ones are ignored, or kept by `redact`, whatever
their names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import renamed, saved

KINDS = ["email", "ip", "card", "phone"]

# The contract's patterns, made possessive.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"[A-Za-z0-9._%+-]{1,64}\x20?[\[({]\x20?(?:at|AT|@)\x20?[\])}]\x20?[A-Za-z0-9-]{1,63}(?:\x20?[\[({]\x20?(?:dot|DOT)\x20?[\])}]\x20?[A-Za-z0-9-]{1,63}|\.[A-Za-z0-9-]{1,63})+",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# The lists of the gazetteer. Last labels of mail hosts, endings of file names, leading digits of card issuers, country
# calling codes, addresses that belong to no one.
DOMAINS = """com org net edu gov mil int info biz io co me tv eu uk de fr es it nl ch at be ca us au jp cn in br mx ru pl se no dk fi ie pt
gr cz hu ro tr il za kr nz ar cl""".split()
FILES = "png jpg jpeg gif svg html htm css js json xml txt pdf zip py".split()
ISSUERS = "22 23 24 25 26 27 30 34 35 36 37 38 40 41 42 43 44 45 46 47 48 49 50 51 52 53 54 55 56 57 58 60 62 63 64 65 67".split()
CALLING = """1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94
95 98 212 213 216 218 234 254 351 352 353 354 355 356 357 358 359 370 371 372 373 374 375 376 380 381 385 386 387 389 420 421 852 853 855 880
886 960 961 962 963 964 965 966 968 971 972 973 974 975 976 977 992 993 994 995 996 998""".split()
NOBODY = "0.0.0.0 127.0.0.1 255.255.255.255 255.255.255.0 1.1.1.1 8.8.8.8 8.8.4.4".split()
# Words before a span that speak for a kind, and words that speak against all.
CUES = {
    "email": r"(?i)(?:e-?mail|mailto|contact|correo|courriel|write to|reach)",
    "ip": r"(?i)(?:\bip\b|ipv[46]|server|host|address|adresse|client|login)",
    "card": r"(?i)(?:card|visa|credit|debit|payment|carte|tarjeta|karte)",
    "phone": r"(?i)(?:phone|\btel\b|\bcall\b|mobile|\bcell\b|\bfax\b|telefon|t[eé]l[eé]phone|tel[eé]fono)",
}
AGAINST = r"(?i)(?:order|invoice|\bref\b|reference|isbn|\bsku\b|part no|version|serial|ticket|\bcase\b|\bpage\b|build|tracking)"
SHAPE = {
    "email": r"^.{5,80}$",
    "ip": r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$|:",
    "card": r"^[0-9]{15,16}$|^[0-9]{4}(?:[\x20-][0-9]{4}){3}$",
    "phone": r"^\+|^\([0-9]{3}\)\x20|^([0-9]{3})([.-])[0-9]{3}\2[0-9]{4}$",
}
#: Characters before a span in which cue words count.
BEFORE = 40
#: The classifier's least probability for an added span.
ADD = 0.9
#: Matches that are summed up at a time.
RUN = 512
LABELERS = ["regex", "gazetteer", "context", "shape"]
#: Prior counts of (personal data, not) among the matches of the loose patterns, and among those of the strict ones.
LOOSE_PRIOR, STRICT_PRIOR = {"email": (3.0, 1.0), "ip": (3.0, 1.0), "card": (1.0, 3.0), "phone": (1.0, 3.0)}, (1.0, 1.0)
#: Prior counts of each labeler's votes (right, wrong): what it is believed to be worth before any votes are seen.
WORTH = {"regex": (45.0, 5.0), "gazetteer": (4.0, 1.0), "context": (9.0, 1.0), "shape": (4.0, 1.0)}


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


def _list(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _digits(m: str) -> str:
    return f"regexp_replace({m}, r'[^0-9]', '')"


def _check(kind: str, m: str) -> str:
    """SQL for whether a match of the strict pattern passes."""
    if kind == "ip":
        return f"{m} rlike r'^{OCTET}(?:\\.{OCTET}){{3}}$'"
    if kind == "phone":
        return f"length({_digits(m)}) between 9 and 15"
    if kind == "card":
        luhn = f"aggregate(transform(split(reverse({_digits(m)}), ''), (c, i) -> if(i % 2 = 0, int(c), if(int(c) > 4, 2 * int(c) - 9, 2 * int(c)))), 0, (a, x) -> a + x)"
        return f"(case when length({_digits(m)}) between 12 and 19 then {luhn} % 10 = 0 else false end)"
    return "true"


def _listed(kind: str, m: str) -> str:
    """SQL for the gazetteer's vote: 1, 0, or -1 where its lists say nothing."""
    if kind == "email":
        last = f"lower(regexp_extract({m}, r'([A-Za-z]+)[^A-Za-z]*$', 1))"
        return f"case when {last} in {_list(DOMAINS)} then 1 when {last} in {_list(FILES)} then 0 else -1 end"
    if kind == "ip":
        return f"case when {m} in {_list(NOBODY)} or {m} rlike r'^(?:0+:){{7}}' then 0 when {m} rlike r'^(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])[.]|^(?i:2[0-9a-f]{{3}}|3[0-9a-f]{{3}}|f[cd][0-9a-f]{{2}}|fe80):' then 1 else -1 end"
    if kind == "card":
        return f"if(left({_digits(m)}, 2) in {_list(ISSUERS)}, 1, 0)"
    d = _digits(m)
    codes = _list(CALLING)
    return f"case when {m} like '+%' then if(left({d}, 1) in {codes} or left({d}, 2) in {codes} or left({d}, 3) in {codes}, 1, 0) else if({d} rlike r'^[2-9][0-8][0-9][2-9]', 1, 0) end"


def _found(text: str, pattern: str) -> tuple[str, str]:
    """SQL for the matches of a pattern, and, over columns m (matches) of a text, for (start, end, m, before) of each."""
    p = _quoted(pattern)
    matches = f"if({text} rlike {p}, regexp_extract_all({text}, {p}, 0), cast(array() as array<string>))"
    return matches, f"if(size(m) > 0, split({text}, {p}), cast(array() as array<string>))"


_PLACE = "struct<start:int,end:int,m:string,before:string>"
_PLACED = f"""flatten(transform(runs, (run, j) -> aggregate(run, named_struct('at', begins[j], 'out', cast(array() as array<{_PLACE}>)),
    (acc, s) -> named_struct('at', acc.at + s.n, 'out', concat(acc.out, array(named_struct('start', acc.at + s.n - length(s.m), 'end', acc.at + s.n, 'm', s.m, 'before', s.before)))), acc -> acc.out)))"""


def _votes(kind: str, strict: bool) -> str:
    """SQL from places to candidate spans."""
    base = _check(kind, "s.m") if strict else "false"
    cue, no = f"s.before rlike {_quoted(CUES[kind])}", f"s.before rlike {_quoted(AGAINST)}"
    return f"""transform(places, s -> named_struct('start', s.start, 'end', s.end, 'kind', {KINDS.index(kind)}, 'base', {base}, 'loose', {"false" if strict else "true"},
        'gazetteer', {_listed(kind, "s.m")}, 'context', case when {cue} and not {no} then 1 when {no} and not {cue} then 0 else -1 end, 'shape', int(s.m rlike {_quoted(SHAPE[kind])})))"""


def candidates(docs: DataFrame, column: str) -> DataFrame:
    """docs with an array of candidate spans, strict ones first; written once, as all that follows reads it twice."""
    text = f"c{docs.columns.index('text')}"
    flat = renamed(docs).withColumn("whole", F.coalesce(F.col(text), F.lit("")))
    parts = []
    for i, (kind, pattern, strict) in enumerate([(k, STRICT[k], True) for k in KINDS] + [(k, p, False) for k, p in LOOSE.items()]):
        matches, gaps = _found("whole", pattern)
        # one step after the other, so that each is worked out once
        flat = flat.withColumn("m", F.expr(matches)).withColumn("g", F.expr(gaps))
        flat = flat.withColumn("z", F.expr(f"transform(m, (x, i) -> named_struct('n', length(g[i]) + length(x), 'm', x, 'before', right(g[i], {BEFORE})))"))
        flat = flat.withColumn("runs", F.expr(f"transform(sequence(0, greatest(0, size(z) - 1) div {RUN}), j -> slice(z, cast(j * {RUN} + 1 as int), {RUN}))"))
        flat = flat.withColumn("begins", F.expr("aggregate(transform(runs, run -> aggregate(run, 0, (a, s) -> a + s.n)), array(0), (a, n) -> concat(a, array(element_at(a, -1) + n)))"))
        flat = flat.withColumn("places", F.expr(_PLACED)).withColumn(f"s{i}", F.expr(_votes(kind, strict))).drop("m", "g", "z", "runs", "begins", "places")
        parts.append(f"s{i}")
    flat = flat.withColumn("strict", F.concat(*parts[: len(KINDS)])).withColumn("loose", F.concat(*parts[len(KINDS) :]))
    flat = flat.withColumn("loose", F.expr("filter(loose, s -> not exists(strict, b -> b.start < s.end and s.start < b.end))"))
    flat = flat.withColumn("spans", F.concat("strict", "loose")).drop("whole", "strict", "loose", *parts)
    return saved(flat.toDF(*docs.columns, column), "pii-candidates")


def _vote_counts(df: DataFrame, column: str) -> list[tuple]:
    """(kind, votes, how many): votes of regex, gazetteer, context and shape, 1 for, 0 against, -1 for none."""
    s = df.select(F.explode(column).alias("s"))
    regex = F.when(F.col("s.loose"), -1).when(F.col("s.base"), 1).otherwise(0)
    rows = s.groupBy(F.col("s.kind").alias("kind"), regex.alias("regex"), F.col("s.gazetteer").alias("g"), F.col("s.context").alias("c"), F.col("s.shape").alias("p")).count()
    return sorted((r.kind, (r.regex, r.g, r.c, r.p), r["count"]) for r in rows.collect())


def reliabilities(counts: list[tuple], rounds: int = 50) -> dict[tuple, float]:
    """Posterior that a span of (kind, votes) is personal data, by expectation-maximisation over two classes per kind.

    Loose and strict matches have priors of their own, labelers are shared. A labeler whose votes come out worse than chance
    is taken to say nothing."""
    out: dict[tuple, float] = {}
    for kind in {k for k, _, _ in counts}:
        own = [(v, n) for k, v, n in counts if k == kind]
        priors = {True: LOOSE_PRIOR[KINDS[kind]], False: STRICT_PRIOR}
        rate = [(a / (a + b), b / (a + b)) for a, b in (WORTH[x] for x in LABELERS)]  # P(1 | data), P(1 | not)
        share = {loose: a / (a + b) for loose, (a, b) in priors.items()}
        post: dict[tuple, float] = {}
        for _ in range(rounds):
            for v, _ in own:
                odds = math.log(share[v[0] < 0] / (1 - share[v[0] < 0]))
                for (yes, no), x in zip(rate, v):
                    odds += 0.0 if x < 0 else math.log(yes / no) if x else math.log((1 - yes) / (1 - no))
                post[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            for loose, (a, b) in priors.items():
                some = [(post[v] * n, n) for v, n in own if (v[0] < 0) == loose]
                share[loose] = (sum(y for y, _ in some) + a) / (sum(n for _, n in some) + a + b)
            rate = []
            for i, (a, b) in enumerate(WORTH[x] for x in LABELERS):
                said = [(post[v] * n, (1 - post[v]) * n, v[i]) for v, n in own if v[i] >= 0]
                yes = (sum(y for y, _, x in said if x) + a) / (sum(y for y, _, _ in said) + a + b)
                no = (sum(z for _, z, x in said if x) + b) / (sum(z for _, z, _ in said) + a + b)
                rate.append((yes, no) if yes > no else ((yes + no) / 2,) * 2)
        out |= {(kind, v): p for v, p in post.items()}
    return out


def _features(kind: int, votes: tuple) -> list[float]:
    """Whether the span is loose or not, and each vote for and against, all by kind: labelers are worth other things elsewhere."""
    own = [float(votes[0] >= 0), float(votes[0] < 0)] + [float(x == y) for x in votes for y in (1, 0)]
    return [x if kind == k else 0.0 for k in range(len(KINDS)) for x in own]


def train(counts: list[tuple], post: dict[tuple, float], rounds: int = 25, decay: float = 1e-2) -> list[float]:
    """Weights of the span classifier: ridge logistic regression on the posteriors by Newton's method, each pattern weighted by
    its root of count."""
    import numpy as np

    if not counts:
        return [0.0] * len(_features(0, (0, 0, 0, 0)))
    x = np.array([_features(k, v) for k, v, _ in counts])
    y, n = np.array([post[k, v] for k, v, _ in counts]), np.sqrt([n for *_, n in counts])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - y)) + decay * w
        w -= np.linalg.solve((x * (n * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + decay * np.eye(len(w)), grad)
    return w.tolist()


def spans_column(column: str, weights: list[float], add: float = ADD):
    """All spans that stay, sorted by start and kind: strict ones, and loose ones that the classifier adds."""
    c, size = f"`{column}`", len(weights) // len(KINDS)
    kinds = []
    for k in range(len(KINDS)):
        own = weights[k * size : (k + 1) * size]
        votes = [f"case s.{name} when 1 then {own[2 + 2 * i]!r}D when 0 then {own[3 + 2 * i]!r}D else 0D end" for i, name in enumerate(LABELERS) if name != "regex"]
        kinds.append(f"when s.kind = {k} then {own[1]!r}D + {' + '.join(votes)}")
    logit = f"(case {' '.join(kinds)} end)"
    added = f"filter({c}, s -> s.loose and {logit} >= {math.log(add / (1 - add))!r}D)"
    return F.expr(f"array_sort(transform(concat(filter({c}, s -> s.base), {added}), s -> struct(s.start, s.kind, s.end, s.base)))")


def _fresh(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def annotate(docs: DataFrame, column: str) -> DataFrame:
    """docs with a column of (start, kind, end, base) spans."""
    raw = _fresh(docs, "__candidates")
    held = candidates(docs, raw)
    counts = _vote_counts(held, raw)
    return held.withColumn(column, spans_column(raw, train(counts, reliabilities(counts)))).drop(raw)


def redact(docs: DataFrame) -> DataFrame:
    """docs with each span replaced by its kind in brackets; n_chars, where present, is counted anew."""
    column = _fresh(docs, "__pii")
    names = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + ")"
    held = annotate(docs, column)
    text = f"""aggregate(`{column}`, named_struct('at', 0, 'out', ''),
        (acc, s) -> case when s.end <= acc.at then acc when s.start < acc.at then named_struct('at', s.end, 'out', acc.out)
            else named_struct('at', s.end, 'out', concat(acc.out, substring(text, acc.at + 1, s.start - acc.at), {names}[s.kind])) end,
        acc -> concat(acc.out, substring(text, acc.at + 1)))"""
    held = held.withColumn("text", F.expr(f"case when text is null or size(`{column}`) = 0 then text else {text} end")).drop(column)
    if "n_chars" in docs.columns:
        held = held.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return held.select(docs.columns)


def op2(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = annotate(docs, "s")
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    joined = lambda x: f"concat_ws(',', transform({x}, x -> concat_ws(':', {names}[x.kind], x.start, x.end)))"
    n = [F.expr(f"cast(size(filter(s, x -> x.base and x.kind = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    base = F.sha2(F.expr(joined("filter(s, x -> x.base)")), 256)
    return held.select("doc_id", *n, base.alias("base_sha256"), F.expr(joined("s")).alias("spans"))

"""Personal data by weak supervision, in DataFrame functions only.

Candidates come from patterns that are wider than what counts; regex, gazetteer, context and boundary labelers vote on
each (1 yes, 0 abstain, -1 no), and none of them is always right. One pass counts vote-and-feature patterns (a table
bounded by the number of patterns, not by the data); expectation maximisation on those counts estimates each labeler's
reliability for each kind, and the posteriors train a naive Bayes span classifier over votes and surface features. The
second pass applies it row by row: no join, no shuffle. Base spans always stay; of the base kinds, what fails the rule
takes part in the estimates and goes; the classifier decides on the candidates of the further kinds.

All patterns are written so that Java's matcher runs in linear time without recursion (possessive quantifiers).
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of the listing, with their patterns; those after the fourth are added by the method.
KINDS = ["email", "ip", "card", "phone", "secret", "ssn", "iban", "phone_local"]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?i:token|secret|api[_-]?key|passw(?:or)?d)[\x20]?+[=:][\x20]?+[\x22\x27]?+[A-Za-z0-9_+/=-]{16,}+|(?<![A-Za-z0-9_+/=.:-])[A-Za-z0-9_+/=-]{24,}+",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[\x20]?+[A-Z0-9]{4}){2,7}+(?:[\x20]?+[A-Z0-9]{1,3}+)?+(?![A-Za-z0-9])",
    "phone_local": r"(?<![0-9+()-])\(?+[0-9]{3}\)?+[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}
NEEDS = {"email": "@", "phone": "+"}
#: Words before a span that speak for its kind, and words that speak against personal data of any kind.
CONTEXT = {
    "email": "mail|contact|write|reach", "ip": r"\bip\b|host|server|addr", "card": "card|visa|master|pay|amex", "phone": "phone|call|tel|fax|mobile",
    "secret": "token|secret|key|passw|credential|bearer", "ssn": "ssn|social", "iban": "iban|bank|account", "phone_local": "phone|call|tel|fax|mobile",
}
AGAINST = r"version|release|isbn|issn|invoice|order no|sku|build|commit|revision|sha-?(?:1|256)|md5|checksum|chapter|section|page|figure|example"
#: Gazetteers, fixed values. Top-level domains; first numbers of addresses that name no host on the net; issuer prefixes
#: of cards; country calling codes; prefixes of issued tokens; social security numbers known from print; IBAN lengths.
DOMAINS = "com org net edu gov mil int info biz io ai app dev me tv co us uk de fr es it nl be ch at se no dk fi pl pt gr ie cz hu ro ru ua tr il in cn jp kr tw hk sg au nz ca mx br ar cl za eu asia name pro mobi xyz online site".split()
SPECIAL_NETS = "0 10 127 169 224 225 226 227 228 229 230 231 232 233 234 235 236 237 238 239 240 255".split()
ISSUERS = "4 51 52 53 54 55 222 223 224 225 226 23 24 25 26 270 271 2720 34 37 6011 644 645 646 647 648 649 65 35 36 38 39 300 301 302 303 304 305 62 50 56 57 58 63 67".split()
CALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 212 213 216 218 220 221 233 234 254 255 256 351 352 353 354 355 356 357 358 359 370 371 372 373 374 375 380 381 385 386 387 420 421 852 853 855 856 880 886 960 961 962 963 964 965 966 967 968 971 972 973 974 975 976 977 992 993 994 995 996 998".split()
TOKEN_PREFIXES = "AKIA ASIA AIza ghp_ gho_ ghu_ ghs_ glpat- xoxb- xoxp- sk_live_ sk_test_ rk_live_ pk_live_ npm_ pypi- eyJ".split()
PRINTED_SSN = "078-05-1120 219-09-9999 457-55-5462 123-45-6789 111-11-1111 987-65-4321".split()
IBAN_LENGTHS = {"AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "TR": 26}
TOLL_FREE = "800 822 833 844 855 866 877 888".split()
VOTES = ["v_rule", "v_gazetteer", "v_context", "v_edge"]
#: Weights of the votes in the first posteriors, before any reliability is known.
TRUST = (2.0, 1.0, 1.0, 0.5)
#: The least log-odds of a vote of trust 1, and the most that the share of true candidates of a kind counts for.
CHANCE, PRIOR_MOST = 0.5, 2.0
FEATURES = [*VOTES, "f_size", "f_before", "f_after"]
#: Candidates that the rates over all kinds count for beside those of the kind itself.
POOLED = 20.0


def _array(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _digits(text: str) -> str:
    return f"regexp_replace({text}, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    d = f"CAST(substring(reverse({digits}), i, 1) AS INT)"
    return f"aggregate(sequence(1, greatest(length({digits}), 1)), 0, (s, i) -> s + IF(i % 2 = 1, coalesce({d}, 0), coalesce(2 * {d} - IF({d} > 4, 9, 0), 0))) % 10 = 0"


def _mod97(text: str) -> str:
    """Whether the check digits of an IBAN fit: letters count as 10 to 35, the first four characters go last."""
    code = f"regexp_replace({text}, ' ', '')"
    moved = f"concat(substring({code}, 5), left({code}, 4))"
    step = "s * IF(c RLIKE '[A-Z]', 100, 10) + IF(c RLIKE '[A-Z]', ascii(c) - 55, ascii(c) - 48)"
    return f"aggregate(filter(split({moved}, ''), c -> c <> ''), 0, (s, c) -> ({step}) % 97) = 1"


def _rule(kind: str, text: str) -> str:
    """The regex labeler's vote. Of the base kinds it decides."""
    digits = _digits(text)
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    yes_no = lambda condition: f"IF({condition}, 1, -1)"
    return {
        "email": "1",
        "ip": yes_no(f"{text} RLIKE '^{part}(?:[.]{part}){{3}}$'"),
        "card": yes_no(f"length({digits}) BETWEEN 12 AND 19 AND {_luhn(digits)}"),
        "phone": yes_no(f"length({digits}) BETWEEN 9 AND 15"),
        "secret": f"CASE WHEN NOT {text} RLIKE '[0-9]' OR NOT {text} RLIKE '[A-Za-z]' THEN -1 WHEN {text} RLIKE '[=:][ ]?.{{16}}' THEN 1 WHEN {text} RLIKE '^(?:[A-Za-z]+[-_/=+]|[0-9]+[-_/=+])+[A-Za-z0-9]*$' THEN -1 ELSE 0 END",
        "ssn": yes_no(f"NOT {text} RLIKE '^(?:000|666|9)|-00-|-0000$'"),
        "iban": yes_no(_mod97(text)),
        "phone_local": yes_no(f"{digits} RLIKE '^[2-9][0-8][0-9][2-9]'"),
    }[kind]


def _gazetteer(kind: str, text: str) -> str:
    digits, code = _digits(text), f"regexp_replace({text}, ' ', '')"
    starts = lambda values, of: f"exists({_array(values)}, g -> startswith({of}, g))"
    lengths = "map(" + ", ".join(f"'{k}', {n}" for k, n in IBAN_LENGTHS.items()) + ")"
    return {
        "email": f"IF(array_contains({_array(DOMAINS)}, lower(substring_index({text}, '.', -1))), 1, -1)",
        "ip": f"IF(array_contains({_array(SPECIAL_NETS)}, substring_index({text}, '.', 1)), -1, 0)",
        "card": f"IF({starts(ISSUERS, digits)}, 1, -1)",
        "phone": f"IF({starts(CALLING, digits)}, 1, -1)",
        "secret": f"IF({starts(TOKEN_PREFIXES, text)}, 1, 0)",
        "ssn": f"IF(array_contains({_array(PRINTED_SSN)}, {text}), -1, 0)",
        "iban": f"IF(coalesce(try_element_at({lengths}, left({code}, 2)), 0) = length({code}), 1, -1)",
        "phone_local": f"IF(array_contains({_array(TOLL_FREE)}, left({digits}, 3)), 1, 0)",
    }[kind]


#: ``before`` and ``after`` are what stands around a span: up to CONTEXT_LENGTH characters since the last match, and one.
SPAN = "STRUCT<start: INT, end: INT, text: STRING, before: STRING, after: STRING>"
CONTEXT_LENGTH = 40
#: Code points of the blocks in which overlaps are looked for.
BLOCK = 4096


def _matches(text: Column, kind: str) -> Column:
    """An array of spans: the leftmost non-overlapping matches, in code points.

    Places are running sums over the pieces between matches. An array grows by copying, so the matches are gathered in
    runs of the square root of their number and these joined at the end: some ten thousand matches in one text are cheap.
    """
    pattern = PATTERNS[kind]
    none, no_runs = F.expr(f"CAST(array() AS ARRAY<{SPAN}>)"), F.expr(f"CAST(array() AS ARRAY<ARRAY<{SPAN}>>)")

    def once(value: Column, use) -> Column:
        return F.element_at(F.transform(F.array(value), use), 1)

    def grown(s: Column, x: Column) -> Column:
        begin = s["at"] + x["gap"]
        end = begin + F.length(x["text"])
        return F.struct(end.alias("at"), F.array_append(s["out"], F.struct(begin.alias("start"), end.alias("end"), x["text"].alias("text"), x["before"].alias("before"), x["after"].alias("after"))).alias("out"))

    def walked(z: Column) -> Column:
        run = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(z))).cast("int"))

        def joined(s: Column, k: Column) -> Column:
            inner = F.aggregate(F.slice(z, k * run + 1, run), F.struct(s["at"].alias("at"), none.alias("out")), grown)
            return once(inner, lambda r: F.struct(r["at"].alias("at"), F.array_append(s["out"], r["out"]).alias("out")))

        return F.flatten(F.aggregate(F.sequence(F.lit(0), F.floor(F.size(z) / run).cast("int")), F.struct(F.lit(0).alias("at"), no_runs.alias("out")), joined, lambda s: s["out"]))

    both = F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("f"))

    def paired(s: Column) -> Column:
        gaps = F.zip_with(F.slice(s["p"], 1, F.size(s["f"])), F.slice(s["p"], 2, F.size(s["f"])), lambda a, c: F.struct(F.length(a).alias("gap"), F.right(a, F.lit(CONTEXT_LENGTH)).alias("before"), F.left(c, F.lit(1)).alias("after")))
        return F.zip_with(gaps, s["f"], lambda g, b: F.struct(g["gap"].alias("gap"), b.alias("text"), g["before"].alias("before"), g["after"].alias("after")))

    sieve = text.contains(NEEDS[kind]) if kind in NEEDS else text.rlike({"secret": r"[A-Za-z0-9_+/=-]{16}"}.get(kind, "[0-9]"))
    return F.when(sieve, once(once(both, paired), walked)).otherwise(none)


def candidates(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of docs), ``text`` (null counts as empty), ``base``, ``failed`` and ``more``: arrays of spans that
    are base spans, candidates of the base kinds that fail their rule, and candidates of the other kinds."""
    out = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    out = out.select("row", "text", *(_matches(F.col("text"), kind).alias(kind) for kind in KINDS))
    ruled = [f"transform({kind}, x -> named_struct('start', x.start, 'kind', {k}, 'end', x.end, 'text', x.text, 'before', x.before, 'after', x.after, 'rule', {_rule(kind, 'x.text')})) AS {kind}" for k, kind in enumerate(KINDS)]
    out = out.selectExpr("row", "text", *ruled)
    base, more = (", ".join(kinds) for kinds in (KINDS[:4], KINDS[4:]))
    out = out.selectExpr("row", "text", f"concat({base}) AS listed", f"concat({more}) AS more")
    out = out.selectExpr("row", "text", "array_sort(filter(listed, x -> x.rule = 1)) AS base", "filter(listed, x -> x.rule < 1) AS failed", "more")
    # names bound by a lambda are computed once a row; a column that is used once would be computed wherever it is used
    blocks = f"transform(sequence(0, length(text) DIV {BLOCK}), k -> filter(s.base, b -> b.start < (k + 1) * {BLOCK} AND b.end > k * {BLOCK}))"
    near = f"slice(blocks, m.start DIV {BLOCK} + 1, m.end DIV {BLOCK} - m.start DIV {BLOCK} + 1)"
    apart = f"IF(size(s.more) = 0 OR size(s.base) = 0, s.more, transform(array({blocks}), blocks -> filter(s.more, m -> NOT exists({near}, block -> exists(block, b -> b.start < m.end AND b.end > m.start))))[0])"
    out = out.selectExpr("row", "text", f"transform(array(named_struct('base', base, 'failed', failed, 'more', more)), s -> named_struct('base', s.base, 'failed', s.failed, 'more', {apart}))[0] AS spans")
    return out.select("row", "text", "spans.base", "spans.failed", "spans.more")


def _case(values: dict[str, str]) -> str:
    return "CASE x.kind " + " ".join(f"WHEN {KINDS.index(k)} THEN {v}" for k, v in values.items()) + " END"


def _voted(spans: str) -> Column:
    """Votes and features of each span; patterns go through SQL string literals, so backslashes are doubled."""
    esc = lambda v: v.replace("\\", "\\\\").replace("'", "\\'")
    before, last, following = "lower(x.before)", "right(x.before, 1)", "x.after"
    near = "lower(concat(x.before, IF(x.kind = 4, left(x.text, 12), '')))"
    char = "CASE WHEN {0} = '' THEN 'end' WHEN {0} RLIKE '[a-z0-9A-Z]' THEN 'word' WHEN {0} RLIKE '[ \\\\n\\\\t]' THEN 'space' ELSE 'mark' END"
    gaz = _case({k: _gazetteer(k, "x.text") for k in KINDS})
    ctx = _case({k: f"CASE WHEN {near} RLIKE '{esc(v)}' THEN 1 WHEN {before} RLIKE '{esc(AGAINST)}' THEN -1 ELSE 0 END" for k, v in CONTEXT.items()})
    return F.expr(
        f"transform({spans}, x -> named_struct('span', x, 'kind', x.kind, 'v_rule', CAST(x.rule AS STRING), 'v_gazetteer', CAST({gaz} AS STRING), 'v_context', CAST({ctx} AS STRING), "
        f"'v_edge', IF({last} RLIKE '[A-Za-z0-9]' OR {following} RLIKE '[A-Za-z0-9]', '-1', '1'), 'f_size', CAST(least(length(x.text) DIV 6, 9) AS STRING), "
        f"'f_before', {char.format(last)}, 'f_after', {char.format(following)}))"
    )


def train(docs: DataFrame, rounds: int = 60) -> dict[str, float]:
    """Log-odds of the span classifier, from vote patterns over all documents. The driver sees pattern counts alone."""
    seen = candidates(docs.select("text")).select(F.explode(_voted("concat(base, failed, more)")).alias("x")).select("x.kind", *(f"x.{c}" for c in FEATURES))
    rows = [(r["kind"], tuple(r[c] for c in FEATURES), r["n"]) for r in seen.groupBy("kind", *FEATURES).agg(F.count("*").alias("n")).orderBy("kind", *FEATURES).collect()]
    post = {(k, f): 1 / (1 + math.exp(0.5 - sum(w * int(v) for w, v in zip(TRUST, f, strict=False)))) for k, f, _ in rows}
    kinds = sorted({k for k, _, _ in rows})
    for _ in range(rounds):
        seen_votes, prior = defaultdict(float), defaultdict(lambda: 1.0)
        for k, f, n in rows:
            p = min(max(post[k, f], 1e-6), 1 - 1e-6)
            for y, w in ((1, p * n), (0, (1 - p) * n)):
                prior[k, y] += w
                for j in range(len(VOTES)):
                    seen_votes[k, j, f[j], y] += w
                    seen_votes[None, j, f[j], y] += w
        # over all kinds; a vote agrees with the truth somewhat more often than not before anything is seen
        agrees = lambda v, y: 1.0 + ((v == "1" and y == 1) or (v == "-1" and y == 0))
        pooled = {(j, v, y): seen_votes[None, j, v, y] + agrees(v, y) for j in range(len(VOTES)) for v in ("-1", "0", "1") for y in (0, 1)}
        total = {(j, y): sum(pooled[j, v, y] for v in ("-1", "0", "1")) for j in range(len(VOTES)) for y in (0, 1)}
        rate = {}
        for k in kinds:
            for j in range(len(VOTES)):
                for v in ("-1", "0", "1"):
                    odds = [(seen_votes[k, j, v, y] + POOLED * pooled[j, v, y] / total[j, y]) / (prior[k, y] - 1 + POOLED) for y in (0, 1)]
                    rate[k, j, v] = math.log(odds[1] / odds[0])
                # no labeler is worse than chance; without that, votes that always go together name their own truth
                rate[k, j, "1"], rate[k, j, "-1"] = max(rate[k, j, "1"], CHANCE * TRUST[j]), min(rate[k, j, "-1"], -2 * CHANCE * TRUST[j])
        for k, f, _ in rows:
            z = max(min(math.log(prior[k, 1] / prior[k, 0]), PRIOR_MOST), -PRIOR_MOST) + sum(rate[k, j, f[j]] for j in range(len(VOTES)))
            post[k, f] = 1 / (1 + math.exp(-max(min(z, 50), -50)))
    weights: dict[str, float] = {}
    soft, base = defaultdict(lambda: 0.5), defaultdict(lambda: 1.0)
    for k, f, n in rows:
        for y, w in ((1, post[k, f] * n), (0, (1 - post[k, f]) * n)):
            base[k, y] += w
            for c, v in zip(FEATURES, f, strict=True):
                soft[k, c, v, y] += w
    for k in kinds:
        weights[f"{k}"] = math.log(base[k, 1] / base[k, 0])
        for c, v in sorted({(c, v) for kk, f, _ in rows if kk == k for c, v in zip(FEATURES, f, strict=True)}):
            weights[f"{k}|{c}|{v}"] = math.log(soft[k, c, v, 1] / base[k, 1]) - math.log(soft[k, c, v, 0] / base[k, 0])
    return weights


def find_pii(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``row`` (all columns of docs), ``text``, ``base`` (spans of the four listed kinds) and ``all_spans`` (those and the
    accepted others).

    A span is struct<start, kind, end, text, rule>, code points, end exclusive; kind is a place in KINDS. Null or empty
    text has no spans; every row is kept, repeated rows too; an empty table trains nothing and gives no rows; columns may
    have any names.
    """
    weights = train(docs) if weights is None else weights
    table = ", ".join(f"'{k}', {v!r}D" for k, v in weights.items()) or "'', 0D"
    get = lambda key: f"coalesce(try_element_at(map({table}), {key}), 0D)"
    score = " + ".join([get("CAST(x.kind AS STRING)"), *(get(f"concat(x.kind, '|{c}|', x.{c})") for c in FEATURES)])
    out = candidates(docs).select("row", "text", "base", _voted("more").alias("voted"))
    return out.selectExpr("row", "text", "base", f"array_sort(concat(base, transform(filter(voted, x -> {score} >= 0), x -> x.span))) AS all_spans")


def listed(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, x -> concat(element_at({_array(KINDS)}, x.kind + 1), ':', x.start, ':', x.end)), ',')")


def summarise(found: DataFrame) -> DataFrame:
    """doc_id, counts by base kind, the digest of the base spans, all spans and their number, for each row of find_pii."""
    counts = [F.expr(f"CAST(size(filter(base, x -> x.kind = {k})) AS BIGINT)").alias(f"n_{kind}") for k, kind in enumerate(KINDS[:4])]
    return found.select(F.col("row.doc_id").alias("doc_id"), *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("all_spans").alias("spans"), F.expr("CAST(size(all_spans) AS BIGINT)").alias("n_spans"))


def redact(found: DataFrame) -> DataFrame:
    """The rows given to find_pii, each span of all_spans replaced by its kind in angle brackets; overlapping spans are
    replaced as one. A text without spans, null and empty ones too, stays as it is, and so do all other columns.

    Spans are taken in runs of the square root of their number, each with its own part of the text, so that a text with
    many spans is not copied for each of them."""
    names = _array([f"<{k}>" for k in KINDS])
    run = "greatest(16, CAST(ceil(sqrt(size(all_spans))) AS INT))"
    spans = f"slice(all_spans, k * {run} + 1, {run})"
    until = f"greatest(s.at, coalesce(array_max(transform({spans}, x -> x.end)), 0))"
    walk = (
        "aggregate({spans}, named_struct('at', s.at, 'out', ''), (t, x) -> IF(x.start < t.at, named_struct('at', greatest(t.at, x.end), 'out', t.out), "
        f"named_struct('at', x.end, 'out', concat(t.out, substring(c, t.at - s.at + 1, x.start - t.at), element_at({names}, x.kind + 1)))), t -> t.out)"
    ).replace("{spans}", spans)
    part = f"transform(array(substring(s.rest, 1, {until} - s.at)), c -> {walk})[0]"
    whole = (
        f"aggregate(sequence(0, size(all_spans) DIV {run}), named_struct('at', 0, 'out', '', 'rest', text), (s, k) -> "
        f"named_struct('at', {until}, 'out', concat(s.out, {part}), 'rest', substring(s.rest, {until} - s.at + 1)), s -> concat(s.out, s.rest))"
    )
    fields = [f.name for f in found.schema["row"].dataType.fields]
    return found.select(*(F.expr(f"IF(size(all_spans) = 0, row.text, {whole})").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in fields))

"""Personal data: fixed patterns, and weak labelers whose reliabilities are estimated.

Base spans are the matches of fixed patterns. Beside them stand candidates of looser kinds:
national phones, identity numbers, spelled-out addresses, bank accounts, passports, names and
street addresses. Each of the LABELERS says something about a candidate or nothing; a labeler
speaks either for personal data or against it, and of some kinds only. How often which labelers spoke together is
counted over the whole table. Expectation maximisation on these counts estimates, for each
kind, how often a labeler speaks where it is right and where it is wrong, and so the
probability of each candidate. A logistic span classifier is then fitted to these
probabilities, from the votes and from the form of a candidate and its neighbours (FORMS),
and decides. A candidate that no labeler speaks for stays out.

The estimates start from PRIOR, which weighs as much as STRENGTH candidates of a kind; so a
text's added spans depend on the other texts of its table, and in small tables on the prior.

Null and empty texts give no spans; texts of any length are read whole; repeated rows are
scored alike; an empty table gives no rows. Where candidates of two kinds overlap, both are
spans. Columns called like the result (parameters `base`, `spans`) are replaced.
"""

from __future__ import annotations

from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimbrook.llm.common import join_spans, matches, stage

KINDS = ["email", "ip", "card", "phone"]
# Possessive forms of the contract's patterns: same matches, no recursion on long runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
LOOSE = {
    # Not what a country code stands before, which is a base span.
    "national_phone": r"(?<![0-9+.(-])(?<!\+[0-9]{1,3}[ .-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "identity": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "spelled_email": r"(?i)\b[a-z0-9._-]{2,40} ?(?:\[at\]|\(at\)) ?[a-z0-9-]{2,40} ?(?:\[dot\]|\(dot\)|\.) ?[a-z]{2,12}\b",
    "account": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "passport": r"\b[A-Z]{1,2}[0-9]{6,8}\b",
    "name": r"\b[A-Z][a-z]++(?: [A-Z]\.)? [A-Z][a-z]++\b",
    "street": r"\b[0-9]{1,5} (?:[A-Z][a-z]++ ){1,3}?(?:Street|Avenue|Road|Lane|Drive|Boulevard|Square|Court)\b|\b[A-Z][a-zäöüß]+?(?:straße|strasse|gasse|allee|platz|weg) [0-9]{1,4}\b",
}
NEAR = 40
ROUNDS = 50
GROUPS = 20000
STRENGTH = 20.0
ACCEPT = 0.7
NAMES = Path(__file__).parent / "gazetteer"


def _words(file: str) -> str:
    return "|".join((NAMES / file).read_text("utf-8").split())


def _valid(c: Column) -> Column:
    """The rule that a true span of its kind keeps: ranges, check digits, known endings."""
    m, kind = c["match"], c["kind"]
    code = F.translate(m, " ", "")
    turned = F.concat(F.substr(code, F.lit(5)), F.left(code, F.lit(4)))
    # A letter counts as two digits, A as 10; the remainder by 97 is taken piece by piece.
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda a, x: F.when(x.rlike("[A-Z]"), (a * 100 + F.ascii(x) - 55) % 97).when(x.rlike("[0-9]"), (a * 10 + F.ascii(x) - 48) % 97).otherwise(a),
    )
    return (
        F.when(kind == "identity", ~m.rlike("^(000|666|9)|-00-|-0000$"))
        .when(kind == "national_phone", m.rlike(r"^\(?[2-9][0-9]{2}\)?[ .-][2-9]"))
        .when(kind == "spelled_email", m.rlike(r"(?i)[\[(]at.*(com|org|net|edu|io|de|fr|es|uk)$"))
        .when(kind == "account", rest == 1)
        .otherwise(False)
    )


PERSON, HOME, NUMBERS = ["name"], ["street"], ["national_phone", "identity", "account", "passport"]
ANY = list(LOOSE)
# Each labeler: for personal data (1) or against it (-1), of which kinds it can speak, and when.
LABELERS = {
    "valid": (1, ["national_phone", "identity", "spelled_email", "account"], _valid),
    "first_name": (1, PERSON, lambda c: F.lower(c["match"]).rlike(rf"^(?:{_words('first_names.txt')})\b")),
    "surname": (1, PERSON, lambda c: F.lower(c["match"]).rlike(rf"\b(?:{_words('surnames.txt')})$")),
    "title": (1, PERSON, lambda c: c["before"].rlike(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)\.? $")),
    "contact": (1, ["national_phone", "spelled_email"], lambda c: c["before"].rlike(r"(?i)\b(?:call|phone|tel|telephone|mobile|fax|contact|mail|email|write to|reach)\b")),
    "person": (1, PERSON, lambda c: c["before"].rlike(r"(?i)\b(?:my name is|name:|signed|regards,?|contact|patient|born|i am|attn:?|dear) *$")),
    "number": (1, ["identity", "account", "passport"], lambda c: c["before"].rlike(r"(?i)\b(?:ssn|social security|identity|passport|iban|account|bank)\b")),
    "home": (1, HOME, lambda c: c["before"].rlike(r"(?i)\b(?:lives?|living|resid\w+|address|home|at|wohnt|ship to|mail to)\b")),
    "town": (1, HOME, lambda c: c["after"].rlike(r"^,? (?:[A-Z][a-z]+,? )?(?:[A-Z]{2} )?[0-9]{5}\b")),
    "company": (1, ANY, lambda c: F.concat_ws(" ", c["before"], c["after"]).rlike(r"[A-Za-z0-9]@[A-Za-z0-9]|\+[0-9]{2}")),
    "goods": (-1, ANY, lambda c: c["before"].rlike(r"(?i)\b(?:order|invoice|part|version|model|serial|isbn|page|chapter|figure|item|ticket|sku|build)\b[^.]*$")),
    "dummy": (-1, ANY, lambda c: F.concat_ws(" ", c["before"], c["match"], c["after"]).rlike(r"(?i)\b(?:example|sample|dummy|placeholder|fake|fictional)\b|xxxx|123-45-6789")),
    "repeated": (-1, NUMBERS, lambda c: F.regexp_replace(c["match"], "[^0-9]", "").rlike(r"^([0-9])\1{5,}$")),
    "place": (-1, PERSON, lambda c: c["match"].rlike(r"\b(?:New|North|South|East|West|United|Saint|City|River|Lake|Street|University|Monday|Sunday|January|June)\b")),
}
# What the classifier sees beside the votes.
FORMS = {
    "begins_line": lambda c: c["before"].rlike(r"(?:^|\n)\s*$"),
    "after_colon": lambda c: c["before"].rlike(r"[:=] *$"),
    "inside_code": lambda c: c["before"].rlike(r"[/=_#]$") | c["after"].rlike(r"^[/=_#]"),
    "ends_sentence": lambda c: c["after"].rlike(r"^\s*(?:[.!?]|$)"),
    "long": lambda c: F.char_length(c["match"]) > 16,
    "brackets": lambda c: c["match"].rlike(r"[\[(]"),
    "among_digits": lambda c: F.concat(c["before"], c["after"]).rlike(r"[0-9]{3}"),
}
# How often a labeler speaks of a true and of a false candidate, before anything is counted.
PRIOR = {1: (0.4, 0.05), -1: (0.03, 0.3)}


def _luhn(match: Column) -> Column:
    digits = F.reverse(F.translate(match, " -", ""))

    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), lambda a, i: a + value(i))
    return F.char_length(digits).between(13, 19) & (total % 10 == 0)


def base_spans(text: Column) -> Column:
    spans = {k: matches(text, PATTERNS[k], k, r) for r, k in enumerate(KINDS)}
    keep = {
        "email": lambda s: F.lit(True),
        "ip": lambda s: s["match"].rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
        "card": lambda s: F.when(F.char_length(s["match"]).between(13, 40), _luhn(s["match"])).otherwise(False),
        "phone": lambda s: F.char_length(F.regexp_replace(s["match"], "[^0-9]", "")).between(9, 15),
    }
    return F.concat(*[F.filter(spans[k], keep[k]) for k in KINDS])


def candidates(text: Column, pattern: str, kind: str, rank: int) -> Column:
    """All matches with code-point positions and what stands before and after.

    The surroundings come from the pieces between matches, so a text is not walked again.
    Texts without a match are passed once.
    """
    pieces = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between")
    )
    fields = "kind:string,rank:int,start:int,end:int,match:string,before:string,after:string"
    none = F.array().cast(f"array<struct<{fields}>>")

    def spans(p: Column) -> Column:
        at = lambda array, i: F.coalesce(F.get(p[array], i), F.lit(""))

        def step(state: Column, i: Column) -> Column:
            begin = state["at"] + F.char_length(at("between", i))
            end = begin + F.char_length(at("found", i))
            span = F.struct(
                F.lit(kind).alias("kind"),
                F.lit(rank).alias("rank"),
                begin.alias("start"),
                end.alias("end"),
                at("found", i).alias("match"),
                F.right(F.concat(at("found", i - 1), at("between", i)), F.lit(NEAR)).alias("before"),
                F.left(F.concat(at("between", i + 1), at("found", i + 1)), F.lit(NEAR)).alias("after"),
            )
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

        places = F.sequence(F.lit(0), F.size(p["found"]) - 1)
        start = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.when(F.size(p["found"]) == 0, none).otherwise(F.aggregate(places, start, step, lambda s: s["out"]))

    # The pieces are bound once, as the only element of an array.
    return F.when(text.rlike(pattern), F.flatten(F.transform(F.array(pieces), spans))).otherwise(none)


def _bits(tests: list[Column]) -> Column:
    out = F.lit(0)
    for j, test in enumerate(tests):
        out = out + F.when(test, 1 << j).otherwise(0)
    return out


def _said(c: Column) -> Column:
    return _bits([c["kind"].isin(kinds) & rule(c) for _, kinds, rule in LABELERS.values()])


def _form(c: Column) -> Column:
    return _bits([rule(c) for rule in FORMS.values()])


def _unpack(bits: np.ndarray, width: int) -> np.ndarray:
    return ((bits[:, None] >> np.arange(width)) & 1).astype(float)


def reliabilities(
    said: np.ndarray, counts: np.ndarray, signs: list[int], rounds: int = ROUNDS, strength: float = STRENGTH
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of a true span for each vote pattern of a kind, by expectation maximisation;
    also how often each labeler speaks of true ones, and of false ones.

    `said` has a row for each pattern and a column for each labeler, `counts` how many
    candidates have it.
    """
    yes0, no0 = (np.array([PRIOR[s][k] for s in signs]) for k in (0, 1))
    share, hit, miss = 0.5, yes0, no0
    for _ in range(rounds):
        yes = np.log(share) + said @ np.log(hit) + (1 - said) @ np.log(1 - hit)
        no = np.log(1 - share) + said @ np.log(miss) + (1 - said) @ np.log(1 - miss)
        post = 1 / (1 + np.exp(np.clip(no - yes, -60, 60)))
        mass, rest = (post * counts).sum(), ((1 - post) * counts).sum()
        share = (mass + strength / 2) / (mass + rest + strength)
        hit = ((post * counts) @ said + strength * yes0) / (mass + strength)
        miss = (((1 - post) * counts) @ said + strength * no0) / (rest + strength)
    return post, hit, miss


def span_classifier(features: np.ndarray, counts: np.ndarray, post: np.ndarray, rounds: int = 40, ridge: float = 1.0) -> np.ndarray:
    """Logistic weights (bias last) fitted to the probabilities of `reliabilities`, by Newton's method."""
    x = np.hstack([features, np.ones((len(features), 1))])
    # Frequent groups weigh by the root of their number, so that rare kinds are learnt too.
    weight, w = np.sqrt(counts), np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - post)) + ridge * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(curve, slope)
    return w


def fit(counted: list[tuple[int, int, int, int]]) -> np.ndarray | None:
    """Weights for kinds, votes and forms from (kind, votes, form, number) of candidates."""
    if not counted:
        return None
    kind, said, form, n = np.array(counted, "int64").T
    votes, post = _unpack(said, len(LABELERS)), np.zeros(len(n))
    for k in np.unique(kind):
        own = kind == k
        able = [j for j, (_, kinds, _) in enumerate(LABELERS.values()) if list(LOOSE)[k - len(KINDS)] in kinds]
        signs = [list(LABELERS.values())[j][0] for j in able]
        patterns, place = np.unique(said[own], return_inverse=True)
        post[own] = reliabilities(_unpack(patterns, len(LABELERS))[:, able], np.bincount(place, n[own]), signs)[0][place]
    most = np.argsort(-n, kind="stable")[:GROUPS]
    kinds = (kind[:, None] == np.arange(len(LOOSE)) + len(KINDS)).astype(float)
    features = np.hstack([kinds, votes, _unpack(form, len(FORMS))])
    return span_classifier(features[most], n[most].astype(float), post[most])


def loose_spans(text: Column) -> Column:
    return F.concat(*[candidates(text, p, k, len(KINDS) + r) for r, (k, p) in enumerate(LOOSE.items())])


def find_personal_data(docs: DataFrame, text: str = "text", base: str = "base", spans: str = "spans") -> DataFrame:
    """`docs` with `base` and `spans`: arrays of (kind, rank, start, end, match).

    Columns of `docs` that have these names are replaced; other names may be given.

    One pass counts how many candidates of each kind have the same votes and form, of which
    there are at most 7 * 2 ** 21 and in practice some hundreds; a second one finds the spans
    and applies the classifier as an expression. The classifier is fitted to the GROUPS most
    frequent of them, the reliabilities to all.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    counts = docs.select(F.explode(loose_spans(whole)).alias("c")).select(
        F.col("c.rank").alias("kind"), _said(F.col("c")).alias("said"), _form(F.col("c")).alias("form")
    )
    counts = stage(counts.groupBy("kind", "said", "form").count(), "pii-votes")
    weights = fit([tuple(r) for r in counts.orderBy("kind", "said", "form").collect()])
    for_it = sum(1 << j for j, (sign, _, _) in enumerate(LABELERS.values()) if sign > 0)

    def accepted(c: Column) -> Column:
        by_kind, rest = weights[: len(LOOSE)], weights[len(LOOSE) : -1]
        kind = F.get(F.array(*[F.lit(float(w)) for w in by_kind]), c["rank"] - len(KINDS))

        def decide(v: Column) -> Column:
            z = kind + F.lit(float(weights[-1]))
            for j, w in enumerate(rest):
                z = z + F.when(v.bitwiseAND(F.lit(1 << j)) != 0, F.lit(float(w))).otherwise(0.0)
            return (v.bitwiseAND(F.lit(for_it)) != 0) & (z >= float(np.log(ACCEPT / (1 - ACCEPT))))

        bits = _said(c) + F.shiftleft(_form(c), len(LABELERS))
        return F.exists(F.array(bits), decide)

    plain = lambda c: F.struct(c["kind"], c["rank"], c["start"], c["end"], c["match"])
    order = lambda spans: F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["rank"], s["start"], s["end"], s["kind"], s["match"]))), plain
    )
    found = docs.withColumn(base, order(base_spans(whole)))
    if weights is None:
        return found.withColumn(spans, F.col(base))
    more = F.transform(F.filter(loose_spans(whole), accepted), plain)
    return found.withColumn(spans, order(F.concat(F.col(base), more)))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with every span replaced by `[kind]`; overlapping spans become the first one's.

    All columns of `docs` stay, whatever their names.
    """
    found = find_personal_data(docs, text, "__pii_base", "__pii_spans")
    by_start = F.array_sort(F.transform("__pii_spans", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        piece = F.concat(F.substring(F.col(text), a["at"] + 1, s["start"] - a["at"]), F.lit("["), s["kind"], F.lit("]"))
        return F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(
            F.struct(s["end"].alias("at"), F.concat(a["out"], F.array(piece)).alias("out"))
        )

    rest = lambda a: F.concat(F.array_join(a["out"], ""), F.substring(F.col(text), a["at"] + 1, F.char_length(F.col(text))))
    clean = F.when(F.size("__pii_spans") == 0, F.col(text)).otherwise(F.aggregate(by_start, state, step, rest))
    return found.withColumn(text, clean).drop("__pii_base", "__pii_spans")


def digest(found: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(join_spans(F.col("base")), 256).alias("base_sha256"),
        join_spans(F.col("spans")).alias("spans"),
    )

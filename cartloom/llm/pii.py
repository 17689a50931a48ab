"""Personal data by weak supervision.

Base spans of four kinds come from fixed patterns. Candidates for further private spans are tokens of at
least ``MIN_TOKEN`` characters with a digit, values assigned to a word like ``password`` (with or without
a digit), account numbers in groups and national phone numbers. Labelers vote on them: patterns (the
base patterns and further forms, with their check digits), shapes of keys, a gazetteer of words that
announce private data, assignments to words of secrets, the context (quotes, signs), and plain figures and words.
Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is, without
labels, and what share of the candidates is private. Its posteriors train the final classifier, naive
Bayes over features of the span and its surroundings, which decides. A candidate of a known form has
values of its own for length and digits, as its form explains both; feature values that were not seen
speak for neither side, so small tables give the same verdicts as large ones wherever they know the
value. Candidates it accepts that touch no base span are added with the kind ``secret``. Names of people
are never candidates.

Counts of (votes, features) cover all candidates of all texts. They are what reaches the driver: at
most ``MAX_CELLS`` rows, the product of the values, whatever the corpus. Votes, features and the
trained classifier are column expressions.

Null texts count as empty. Rows are independent: repeated rows and null ids give rows of their own. An
empty table gives an empty result; without candidates nothing is added. Only the named columns are
read. Offsets are code points, the end exclusive. All patterns take linear time on long runs: runs are
entered at their start only and never given back.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import bind, match_spans, text_or_empty

KINDS = ("email", "ip", "card", "phone")
ADDED = "secret"
# The patterns of the four kinds. Possessive repeats and the look-behinds change no
# match: a leftmost match starts where its run starts, or where the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Cheap conditions without which no text has a match that counts.
NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){12}", "phone": r"\+[0-9]"}

MIN_TOKEN = 8
MIN_VALUE = 6
_TOKEN = "A-Za-z0-9@._%+/-"
_ENDS = r"(?![A-Za-z0-9@_%+/-])(?!\.[A-Za-z0-9])"
# Words to which secrets are assigned.
SECRET_WORDS = ("apikey", "api_key", "auth", "credential", "key", "login", "passwd", "password", "pwd", "secret", "token")
_ASSIGNED = rf"(?i:{'|'.join(SECRET_WORDS)})[\"']?\x20{{0,2}}[=:]\x20{{0,2}}[\"']?"
_VALUE = r"[^\s\"',;<>]"
CANDIDATES = "|".join((
    rf"(?<=[=:\"'\x20])(?<={_ASSIGNED}){_VALUE}{{{MIN_VALUE - 1},}}[^\s\"',;<>.]",
    rf"(?<![{_TOKEN}])[A-Z]{{2}}[0-9]{{2}}(?:\x20[A-Z0-9]{{4}}){{2,7}}(?:\x20[A-Z0-9]{{1,3}})?{_ENDS}",
    rf"\([0-9]{{2,5}}\)\x20?[0-9]{{3,8}}(?:[\x20-][0-9]{{2,5}}){{0,3}}{_ENDS}",
    rf"(?<![{_TOKEN}])0[0-9]{{1,4}}(?:\x20[0-9]{{2,8}}){{1,4}}{_ENDS}",
    rf"(?<![{_TOKEN}])(?=[{_TOKEN.replace('0-9', '')}]*+[0-9])[{_TOKEN}]{{{MIN_TOKEN - 1},}}[A-Za-z0-9](?:={{1,2}}+(?![{_TOKEN}]))?",
))
# Forms of further private numbers, beside the base patterns.
IBAN = r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?$"
SOCIAL_NUMBER = r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"
NATIONAL_PHONE = r"^(?:\([0-9]{2,5}\)\x20?|0[0-9]{1,4}[\x20/-]|[0-9]{3}-(?=[0-9]{3}-[0-9]{4}$))[0-9]+(?:[\x20-][0-9]+)*$"
# Words that announce private data.
GAZETTEER = (
    "account", "address", "api", "apikey", "auth", "bearer", "card", "contact", "credential", "email", "iban", "id", "ip",
    "key", "login", "mail", "passport", "passwd", "password", "phone", "private", "pwd", "secret", "ssn", "tel", "token", "user",
)
CONTEXT = 24


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def part(i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + part(i))
    return total % 10 == 0


def _is_card(match: Column) -> Column:
    return bind(_digits(match), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))


def _is_iban(match: Column) -> Column:
    """The check of account numbers: the first four characters at the end, letters as 10 to 35, rest 1 by 97."""
    def rest(code: Column) -> Column:
        def add(state: Column, i: Column) -> Column:
            char = F.substring(code, i, F.lit(1))
            letter = char.rlike("[A-Z]")
            return F.when(letter, state * 100 + F.ascii(char) - 55).otherwise(state * 10 + F.ascii(char) - 48) % 97

        return F.aggregate(F.sequence(F.lit(1), F.length(code)), F.lit(0), add)

    turned = bind(F.replace(match, F.lit(" "), F.lit("")), lambda c: F.concat(F.substring(c, F.lit(5), F.length(c)), F.left(c, F.lit(4))))
    return F.when(match.rlike(IBAN), bind(turned, rest) == 1).otherwise(False)


def _is_ip(match: Column) -> Column:
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: F.when(F.length(p) > 3, False).otherwise(
        F.coalesce(F.when(p == "", 0).otherwise(p.cast("int")), F.lit(0)) <= 255))


def _holds(kind: str, match: Column) -> Column:
    if kind == "ip":
        return _is_ip(match)
    if kind == "card":
        return _is_card(match)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _span(kind: str, x: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"))



def base_spans(text: Column) -> dict[str, Column]:
    """Per kind: the array of its spans, in order."""
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")

    def of(kind: str) -> Column:
        spans = match_spans(text, PATTERNS[kind])
        good = F.transform(F.filter(spans, lambda x: _holds(kind, x["match"])), lambda x: _span(kind, x))
        return F.coalesce(F.when(text.rlike(NEEDED[kind]), good), empty)

    return {kind: of(kind) for kind in KINDS}


# How many votes each labeler knows: 0 abstains, 1 says no, 2 says yes; two of them never say no.
VOTES = {"pattern": 3, "shape": 3, "gazetteer": 2, "assignment": 2, "context": 3, "figure": 3}
FEATURES = {"length": 7, "digits": 6, "letters": 6, "opening": 4, "announced": 3}
MAX_CELLS = math.prod(VOTES.values()) * math.prod(FEATURES.values())


def candidates(text: Column) -> Column:
    """Structs of ``start``, ``end``, votes and features of each candidate of a text; null without any."""
    def cells(x: Column) -> Column:
        token = x["match"]
        before = F.right(x["before"], F.lit(CONTEXT))
        last, next_ = F.right(F.rtrim(x["before"]), F.lit(1)), F.left(x["after"], F.lit(1))
        size, digits = F.length(token), F.length(_digits(token))
        announced = F.exists(F.split(F.lower(before), "[^a-z]+"), lambda w: w.isin(*GAZETTEER))
        quoted, assigned = last.isin('"', "'"), last.isin("=", ":")
        word = token.rlike("^[a-z]+$")
        named = before.rlike(_ASSIGNED + "$") & (~word | quoted | (last == "="))
        known = token.rlike(PATTERNS["email"]) | token.rlike(PATTERNS["ip"]) | _is_card(token)
        phone = token.rlike(NATIONAL_PHONE) & digits.between(8, 12) & (announced | token.startswith("("))
        formed = ~known & (_is_iban(token) | token.rlike(SOCIAL_NUMBER) | phone)
        free = ~known & ~formed
        mixed = token.rlike("^[A-Za-z0-9+/=_-]{16,}$") & token.rlike("[A-Za-z]")
        plain = ~token.rlike("[A-Za-z]")
        yes, no, none = F.lit(2), F.lit(1), F.lit(0)
        return F.struct(
            x["start"].alias("start"), x["end"].alias("end"), known.alias("known"),
            F.when(~free, yes).when(plain | (word & ~named), no).otherwise(none).alias("pattern"),
            F.when(mixed & (digits >= 4), yes).when(free & ~named & (size < 12), no).otherwise(none).alias("shape"),
            F.when(announced | named, yes).otherwise(none).alias("gazetteer"),
            F.when(named, yes).otherwise(none).alias("assignment"),
            F.when(quoted | assigned, yes).when(next_.isin("%", "$") | last.isin("$", "#"), no).otherwise(none).alias("context"),
            F.when(free & plain, no).when(free & ~named & (digits * 4 < size), no).otherwise(none).alias("figure"),
            F.when(~free, 6).when(size < 10, 0).when(size < 13, 1).when(size < 17, 2).when(size < 24, 3).when(size < 40, 4).otherwise(5)
            .alias("length"),
            F.when(~free, 5).otherwise(F.least(F.floor(digits * 4 / size), F.lit(4))).cast("int").alias("digits"),
            F.when(known, 4).when(formed, 5).when(plain, 0).when(token.rlike("^[0-9a-f]+$"), 1).when(token.rlike("^[A-Za-z0-9]+$"), 2)
            .otherwise(3).alias("letters"),
            F.when(quoted, 1).when(assigned, 2).when(last == "", 3).otherwise(0).alias("opening"),
            F.when(named, 2).when(announced, 1).otherwise(0).alias("announced"),
        )

    return F.when(text.rlike(f"[0-9]|{_ASSIGNED}"), F.transform(match_spans(text, CANDIDATES), cells))


@dataclass
class SpanModel:
    reliability: dict[str, float]  # per labeler: the chance that its yes or no is right
    private_share: float
    log_odds: dict[str, list[float]]  # per feature and value
    prior: float

    def score(self, cell: Column) -> Column:
        total = F.lit(self.prior)
        for name, odds in self.log_odds.items():
            total = total + F.get(F.array(*map(F.lit, odds)), cell[name])
        return total


def estimate(cells: list[dict], rounds: int = 50, prior_yes: float = 0.8) -> SpanModel:
    """EM over the counts of vote patterns, then naive Bayes from its posteriors."""
    names = list(VOTES)
    patterns: dict[tuple[int, ...], int] = {}
    for c in cells:
        votes = tuple(c[n] for n in names)
        patterns[votes] = patterns.get(votes, 0) + c["n"]

    def posterior(votes: tuple[int, ...], share: float, right: list[float]) -> float:
        odds = math.log(share / (1 - share))
        for vote, r in zip(votes, right, strict=True):
            odds += math.log(r / (1 - r)) * (vote == 2) - math.log(r / (1 - r)) * (vote == 1)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))

    share, right = 0.3, [prior_yes] * len(names)
    for _ in range(rounds if patterns else 0):
        belief = {v: posterior(v, share, right) for v in patterns}
        total = sum(patterns.values())
        # Neither class is taken to hold more than nine candidates of ten, however many base spans a small table has.
        share = min(0.9, max(0.1, sum(belief[v] * n for v, n in patterns.items()) / total))
        for i in range(len(names)):
            # Labelers are better than a coin: two imagined right votes and one wrong, and a floor.
            hit = 2 + sum((belief[v] if v[i] == 2 else 1 - belief[v]) * n for v, n in patterns.items() if v[i])
            seen = 3 + sum(n for v, n in patterns.items() if v[i])
            right[i] = min(0.99, max(0.55, hit / seen))
    belief = {v: posterior(v, share, right) for v in patterns}
    yes_all, no_all = 1.0, 1.0
    yes, no = ({f: [0.0] * k for f, k in FEATURES.items()} for _ in range(2))
    for c in cells:
        p = belief[tuple(c[n] for n in names)]
        yes_all, no_all = yes_all + p * c["n"], no_all + (1 - p) * c["n"]
        for f in FEATURES:
            yes[f][c[f]] += p * c["n"]
            no[f][c[f]] += (1 - p) * c["n"]
    # One imagined candidate per value, shared by the classes as all candidates are: an unseen value has odds of 1.
    part_yes, part_no = yes_all / (yes_all + no_all), no_all / (yes_all + no_all)
    log_odds = {
        f: [math.log((yes[f][i] + part_yes) / yes_all) - math.log((no[f][i] + part_no) / no_all) for i in range(k)] for f, k in FEATURES.items()
    }
    return SpanModel(dict(zip(names, right, strict=True)), share, log_odds, math.log(yes_all / no_all))


def train(docs: DataFrame, text_col: str = "text") -> SpanModel:
    cell = docs.select(F.explode(candidates(text_or_empty(F.col(text_col)))).alias("c"))
    counts = cell.groupBy(*[F.col(f"c.{n}").alias(n) for n in (*VOTES, *FEATURES)]).agg(F.count("*").alias("n"))
    return estimate([row.asDict() for row in counts.collect()])  # at most MAX_CELLS rows


def find_private_spans(docs: DataFrame, model: SpanModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, the spans of each base kind and of ``secret``, as arrays of (kind, start, end)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
    accepted = F.transform(
        F.filter(candidates(F.col("text")), lambda c: ~c["known"] & (model.score(c) > 0)), lambda c: _span(ADDED, c)
    )
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    kinds = [spans.alias(kind) for kind, spans in base_spans(F.col("text")).items()]
    found = rows.select("doc_id", *kinds, F.coalesce(accepted, empty).alias("accepted"))
    apart = F.filter("accepted", lambda c: ~F.exists(F.concat(*KINDS), lambda x: (x["start"] < c["end"]) & (c["start"] < x["end"])))
    return found.select("doc_id", *KINDS, apart.alias(ADDED))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def mask(docs: DataFrame, model: SpanModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` with every span replaced by its kind in brackets; of overlapping spans the
    first (of those the longest) is replaced.
    """
    whole = F.struct(F.col(id_col).alias("id"), F.col(text_col).alias("text")).alias("row")
    found = find_private_spans(docs.select(whole, F.col(text_col).alias("text")), model, "row").withColumnRenamed("doc_id", "row")
    spans = F.sort_array(F.transform(F.concat(*KINDS, ADDED), lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("longest"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = text_or_empty(F.col("row.text"))

    def put(state: Column, x: Column) -> Column:
        skip = x["start"] < state["at"]
        return F.struct(
            F.when(skip, state["at"]).otherwise(-x["longest"]).alias("at"),
            F.when(skip, state["out"]).otherwise(F.concat(
                state["out"], F.substring(text, state["at"] + 1, x["start"] - state["at"]), F.lit("["), x["kind"], F.lit("]")
            )).alias("out"),
        )

    masked = F.aggregate(spans, start, put, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return found.select(F.col("row.id").alias(id_col), masked.alias(text_col))

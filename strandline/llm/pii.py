"""Personal data by weak supervision, in DataFrame operations only.

Candidates are all matches of the four base patterns, whether or not they pass their checks, and of looser patterns.
Labelers vote on each candidate or abstain: the check of its pattern, a gazetteer (domain endings, issuers' digits, calling
codes, address ranges), the words before it, how it is set off from its neighbours, and its form. For each kind,
expectation-maximisation estimates how reliable each labeler is there. Its posteriors then label the candidates from which the
final span classifier is trained for each kind, naive Bayes over the check, digits, length, punctuation, gazetteer, words
before, characters on either side and the number of candidates in the text. It decides which candidates beyond the base spans count. Base spans always stay.

Places come from replacing each match by itself between two private characters and summing the lengths of the pieces in
between, in blocks of about the root of their number, so that a text of n matches takes n ** 1.5 steps. Repeats inside patterns are rewritten: a separator that belongs to a match becomes a private character of the
same length first, which leaves patterns without nested repeats, so that long texts take time in proportion.

Defined results: a null or empty text has no spans; null ids and repeated rows are searched each; private characters of a
text count as others that no pattern knows; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import keep
from .weak_supervision import posteriors, vote_pattern

KINDS = ("email", "ip", "card", "phone")
#: Private characters: before and after a match, and in place of inner dots and inner separators.
OPEN, CLOSE, DOT, GAP = "\ue000", "\ue001", "\ue002", "\ue003"

#: Base patterns (fixed by the contract), with inner dots and inner separators already replaced.
_LOCAL = rf"[A-Za-z0-9._%+{DOT}-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++{DOT}[A-Za-z0-9{DOT}-]++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = rf"(?<![0-9{GAP}])[0-9{GAP}]{{2,}}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Looser patterns: written-out addresses, and telephone numbers without a plus sign.
LOOSE_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}+(?:\.| ?[(\[]dot[)\]] ?)[A-Za-z]{2,24}+"
LOOSE_PHONE = r"(?<![0-9+(] ?)(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])"

#: Gazetteers: endings that aren't countries' (those come from the platform), calling codes of the numbering plan, first digits of card
#: issuers, and address ranges that belong to no person.
ENDINGS = (
    "com org net edu gov mil int info biz name pro aero coop museum jobs mobi travel tel cat asia post app dev blog shop store online site tech cloud email live life news world "
    "global group agency company digital media network solutions systems services support team today zone eu uk su ac"
).split()
CALLING_CODES = (
    r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-689][0-9]|3[578][0-9]|42[013]|5[09][0-9]|6[789][0-9]|8[0578][0-9]|9[679][0-9])"
)
ISSUERS = r"^(?:4|5[0-9]|6[0-9]|3[45789]|36|30[0-5]|35|2[2-7])"
NO_ONES = r"^0*(?:0|127|169\.0*254|22[4-9]|2[3-5][0-9])\."
CONTEXT = (
    r"(?i)\b(?:e-?mail|mail|contact|write|reach|phone|tel|mobile|cell|call|fax|whatsapp|sms|card|visa|mastercard|credit|debit|account|ip|host|address|login|from|"
    r"adresse|telefon|handy|anruf|karte|konto|teléfono|telefono|móvil|llame|correo|tarjeta|téléphone|courriel|appelez|carte)\b[^\n]{0,24}$"
)
AGAINST = r"(?i)\b(?:version|release|build|order|invoice|part|item|serial|isbn|issn|doi|ref|reference|id|section|article|chapter|ticket|tracking|model|sku|release|figure|table)\b[^\n]{0,16}$"
BEFORE = 40
#: Values of each feature of the final classifier, at most.
VALUES = 8


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of the value, which is worked out once however often it occurs there."""
    return F.get(F.transform(F.array(value), use), 0)


FOUND = "array<struct<start:int,end:int,value:string,before:string,after:string>>"


def _matches(text: Column, pattern: str) -> Column:
    """Array of the matches, their start and end in code points, what they hold and what is next to them."""
    return _bound(F.split(F.regexp_replace(text, pattern, f"{OPEN}$0{CLOSE}"), OPEN), _places)


def _places(pieces: Column) -> Column:
    def step(s: Column, piece: Column) -> Column:
        value, rest = F.substring_index(piece, CLOSE, 1), F.substring_index(piece, CLOSE, -1)
        end = s["at"] + F.length(value)
        one = F.struct(s["at"].alias("start"), end.alias("end"), value.alias("value"), s["before"].alias("before"), F.left(rest, F.lit(1)).alias("after"))
        return F.struct((end + F.length(rest)).alias("at"), F.right(F.concat(s["before"], value, rest), F.lit(BEFORE)).alias("before"), F.concat(s["found"], F.array(one)).alias("found"))

    def block(s: Column, part: Column) -> Column:
        own = F.aggregate(part, F.struct(s["at"].alias("at"), s["before"].alias("before"), F.array().cast(FOUND).alias("found")), step)
        return _bound(own, lambda o: F.struct(o["at"].alias("at"), o["before"].alias("before"), F.concat(s["found"], F.array(o["found"])).alias("found")))

    rest, first = F.size(pieces) - 1, F.get(pieces, 0)
    each = F.greatest(F.lit(16), F.ceil(F.sqrt(rest)).cast("int"))
    parts = F.transform(F.sequence(F.lit(0), F.ceil(rest / each).cast("int") - 1), lambda k: F.slice(pieces, k * each + 2, each))
    start = F.struct(F.length(first).alias("at"), F.right(first, F.lit(BEFORE)).alias("before"), F.array().cast(f"array<{FOUND}>").alias("found"))
    return F.when(rest > 0, F.flatten(F.aggregate(parts, start, block)["found"])).otherwise(F.array().cast(FOUND))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    value = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.get(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d.cast("int"))))
    return F.aggregate(value, F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _cut(found: Column, kind: int, loose: bool = False) -> Column:
    """Candidates (start, kind, end, value, before, after, loose) of one pattern; loose ones match no base pattern."""
    plain = lambda x: F.translate(x, DOT + GAP, ". ")
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"), plain(m["value"]).alias("value"),
            plain(m["before"]).alias("before"), plain(m["after"]).alias("after"), F.lit(loose).alias("loose"),
        ),
    )


def _valid(c: Column) -> Column:
    """The checks of the base patterns (fixed by the contract)."""
    digits, parts = F.length(_digits(c["value"])), F.split(c["value"], r"\.")
    ip = F.forall(parts, lambda p: F.length(F.regexp_replace(p, "^0+(?=.)", "")) <= 3) & F.forall(parts, lambda p: F.lpad(F.right(p, F.lit(3)), 3, "0") <= "255")
    return (
        F.when(c["loose"], F.lit(False)).when(c["kind"] == 0, F.lit(True)).when(c["kind"] == 1, ip)
        .when(c["kind"] == 2, digits.between(14, 19) & luhn(_digits(c["value"])))
        .otherwise(digits.between(10, 15))
    )


def _listed(c: Column, endings: list[str]) -> Column:
    kind, value, digits = c["kind"], c["value"], _digits(c["value"])
    return (
        F.when(kind == 0, F.lower(F.regexp_extract(value, r"([A-Za-z]+)$", 1)).isin(*endings))
        .when(kind == 1, ~value.rlike(NO_ONES))
        .when(kind == 2, digits.rlike(ISSUERS))
        .otherwise(~value.startswith("+") | digits.rlike(CALLING_CODES))
    )


def _rules(c: Column, endings: list[str]) -> list[tuple[Column, Column]]:
    """Labelers, as (votes no, votes yes)."""
    kind, value, digits = c["kind"], c["value"], _digits(c["value"])
    listed = _listed(c, endings)
    apart = ~c["before"].rlike(r"[\p{L}\p{N}.]$") & ~c["after"].rlike(r"[\p{L}\p{N}]")
    formed = F.when(kind == 0, F.length(value) <= 254).when(kind == 1, F.length(value) <= 15).when(kind == 2, F.length(digits).between(13, 19)).otherwise(F.length(digits).between(7, 15))
    return [
        (~_valid(c) & ~c["loose"], _valid(c)),
        (~listed, listed),
        (c["before"].rlike(AGAINST), c["before"].rlike(CONTEXT) & ~c["before"].rlike(AGAINST)),
        (~apart, apart),
        (~formed, formed),
    ]


def _features(c: Column, endings: list[str], n: Column) -> list[Column]:
    """What the final classifier sees of a candidate, each a number below ``VALUES``; ``n``: candidates in the text."""
    side = lambda x: F.when(x.rlike(r"[\p{L}\p{N}]"), 1).when(x.rlike(r"[^\s]"), 2).otherwise(0)
    return [
        F.when(c["loose"], 1).when(_valid(c), 2).otherwise(0),
        F.least(F.floor(F.length(_digits(c["value"])) / 3), F.lit(7)),
        F.least(F.floor(F.length(c["value"]) / 5), F.lit(7)),
        F.least(F.length(F.regexp_replace(c["value"], r"[\p{L}\p{N}]", "")), F.lit(7)),
        F.when(_listed(c, endings), 1).otherwise(0),
        F.when(c["before"].rlike(AGAINST), 0).when(c["before"].rlike(CONTEXT), 2).otherwise(1),
        side(F.right(c["before"], F.lit(1))),
        side(c["after"]),
        F.when(n <= 1, 0).when(n <= 4, 1).otherwise(2),
    ]


N_FEATURES, N_RULES = 9, 5


def endings_of(spark: SparkSession) -> list[str]:
    """Endings of domains: the fixed ones, and the codes of all countries as the platform lists them."""
    countries = spark.sparkContext._jvm.java.util.Locale.getISOCountries()
    return sorted({*ENDINGS, *(c.lower() for c in countries)})


def candidates(documents: DataFrame) -> DataFrame:
    """doc_id and the array ``found`` of candidates (start, kind, end, base, pattern of votes, form) of each document; the form
    holds the features as digits."""
    endings = endings_of(documents.sparkSession)
    text = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("raw"))
    numbers, at = F.col("raw").rlike("[0-9]"), F.col("raw").contains("@")
    clean = text.withColumn("text", F.when(numbers | at | F.col("raw").contains("at"), F.regexp_replace("raw", f"[{OPEN}-{GAP}]", "�")).otherwise(""))
    t, none = F.col("text"), F.array().cast(FOUND)
    dotted = F.regexp_replace(t, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT)
    joined = F.regexp_replace(t, r"(?<=[0-9])[\x20-](?=[0-9])", GAP)
    matched = clean.select(
        "doc_id", "text",
        F.when(at, _matches(dotted, EMAIL)).otherwise(none).alias("m0"),
        F.when(numbers, _matches(t, IP)).otherwise(none).alias("m1"),
        F.when(numbers, _matches(joined, CARD)).otherwise(none).alias("m2"),
        F.when(t.contains("+"), _matches(t, PHONE)).otherwise(none).alias("m3"),
        F.when(t.rlike(r"[(\[]at[)\]]"), _matches(t, LOOSE_EMAIL)).otherwise(none).alias("m4"),
        F.when(numbers, _matches(t, LOOSE_PHONE)).otherwise(none).alias("m5"),
    )
    long_runs = F.filter("m2", lambda m: m["end"] - m["start"] >= 13)
    cut = [_cut(long_runs if k == 2 else F.col(f"m{k}"), k) for k in range(4)] + [_cut(F.col("m4"), 0, loose=True), _cut(F.col("m5"), 3, loose=True)]

    def judged(c: Column, n: Column) -> Column:
        form = sum((F.lit(VALUES**k) * x.cast("int") for k, x in enumerate(_features(c, endings, n))), F.lit(0))
        return F.struct(c["start"], c["kind"], c["end"], _valid(c).alias("base"), vote_pattern(_rules(c, endings)).alias("pattern"), form.cast("int").alias("form"))

    return matched.select("doc_id", _bound(F.concat(*cut), lambda every: _bound(F.size(every), lambda n: F.transform(every, lambda c: judged(c, n)))).alias("found"))


def _value(form: Column, k: Column | int) -> Column:
    return F.floor(form / F.pow(F.lit(float(VALUES)), F.lit(k) if isinstance(k, int) else k)).cast("int") % VALUES


def classifier(found: DataFrame) -> dict[tuple[int, int, int], float]:
    """The final classifier: for each (kind, feature, value) the logarithm of its share among true candidates over that among
    false ones, and for each (kind, -1, 0) the logarithm of the odds. At most kinds * features * values numbers."""
    counts = found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.pattern", "c.form").agg(F.count("*").alias("n"))
    counts = keep(counts, "pii-patterns")
    by_pattern = counts.groupBy("kind", "pattern").agg(F.sum("n").alias("n"))
    start = {"prior": 0.7, "votes_if_yes": (0.05, 0.25, 0.7), "votes_if_no": (0.5, 0.3, 0.2)}
    fitted = posteriors(by_pattern, N_RULES, **start, by=("kind",)).select("kind", "pattern", "posterior")
    labelled = keep(counts.join(fitted, ["kind", "pattern"]), "pii-posteriors")
    yes, no = F.sum(F.col("n") * F.col("posterior")), F.sum(F.col("n") * (1 - F.col("posterior")))
    totals = labelled.groupBy("kind").agg(yes.alias("all_yes"), no.alias("all_no"))
    each = labelled.withColumn("feature", F.explode(F.array(*map(F.lit, range(N_FEATURES))))).withColumn("value", _value(F.col("form"), F.col("feature")))
    sums = each.groupBy("kind", "feature", "value").agg(yes.alias("yes"), no.alias("no")).join(totals, "kind")
    log_share = F.log((F.col("yes") + 1) / (F.col("all_yes") + VALUES)) - F.log((F.col("no") + 1) / (F.col("all_no") + VALUES))
    odds = totals.select("kind", F.lit(-1).alias("feature"), F.lit(0).alias("value"), F.log((F.col("all_yes") + 1) / (F.col("all_no") + 1)).alias("weight"))
    weights = sums.select("kind", "feature", "value", log_share.alias("weight")).union(odds)
    return {(r["kind"], r["feature"], r["value"]): r["weight"] for r in weights.collect()}


def _probability(c: Column, weights: dict[tuple[int, int, int], float]) -> Column:
    """The classifier's probability that a candidate is personal data."""
    if not weights:
        return F.lit(0.0)
    table = F.create_map(*(F.lit(x) for (kind, k, v), w in sorted(weights.items()) for x in ((kind * 100 + k) * VALUES + v, float(w))))
    score = F.coalesce(F.element_at(table, (c["kind"] * 100 - 1) * VALUES), F.lit(0.0))
    for k in range(N_FEATURES):
        score = score + F.coalesce(F.element_at(table, (c["kind"] * 100 + k) * VALUES + _value(c["form"], k)), F.lit(0.0))
    return 1 / (1 + F.exp(-score))


def find(documents: DataFrame, least: float = 0.97) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every document."""
    found = keep(candidates(documents), "pii-candidates")
    weights = classifier(found)
    spans = F.transform("found", lambda c: F.struct(c["start"], c["kind"], c["end"], c["base"], (~c["base"] & (_probability(c, weights) >= least)).alias("likely")))
    split = found.select("doc_id", F.filter(spans, lambda c: c["base"]).alias("base"), F.filter(spans, lambda c: c["likely"]).alias("more"))
    apart = split.withColumn("more", F.filter("more", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))))

    def text(spans: Column) -> Column:
        ordered = F.array_sort(F.transform(spans, lambda c: F.struct(c["start"], c["kind"], c["end"])))
        return F.concat_ws(",", F.transform(ordered, lambda c: F.concat_ws(":", F.get(F.array(*map(F.lit, KINDS)), c["kind"]), c["start"], c["end"])))

    counts = [F.expr(f"size(filter(base, c -> c.kind = {k}))").cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return apart.select("doc_id", *counts, F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(F.concat("base", "more")).alias("spans"))

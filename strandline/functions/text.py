"""Text normalisation and extraction as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points of the normalisation rules.
DIACRITICS = "[\u064b-\u065f\u0670]"
ALIF_FORMS, ALIF = "\u0623\u0625\u0622\u0671", "\u0627"
HAMZA_SEATS, HAMZA = "\u0624\u0626", "\u0621"
TAA_MARBUTA, HAA = "\u0629", "\u0647"
TATWEEL = "\u0640"

#: Transmission phrases, in order, with their labels.
TRANSMISSION_PHRASES = (
    ("حدثنا", "haddathana"),
    ("أخبرنا", "akhbarana"),
    ("سمعت", "samitu"),
    ("عن", "an"),
    ("قال", "qala"),
    ("أنبأنا", "anba_ana"),
    ("ناولني", "nawalani"),
    (r"كتب\s+إلي", "kataba_ilayya"),
)
#: Fixed value: words that delimit names in English chains.
ENGLISH_DELIMITERS = r"(?iU)\b(?:Narrated|reported\s+by|on\s+the\s+authority\s+of|from|who\s+heard\s+from)\b"

#: Grade rules in order; the first rule with a needle in the text wins.
GRADE_RULES = (
    (("صحيح لغيره", "sahih li ghayrihi", "sahih li-ghayrihi"), "sahih_li_ghayrihi"),
    (("حسن لغيره", "hasan li ghayrihi", "hasan li-ghayrihi"), "hasan_li_ghayrihi"),
    (("موضوع", "mawdu", "fabricat"), "mawdu"),
    (("ضعيف", "daif", "da'if", "weak"), "daif"),
    (("صحيح", "sahih", "authentic"), "sahih"),
    (("حسن", "hasan", "good"), "hasan"),
)
#: What marks a collection as shia, and suffixes of files of vocalised text.
SHIA_INDICATORS = ("nahj", "kafi", "tahdhib", "istibsar", "man-la")
VOCALISED = r"(?i)[-_]?(?:tashkeel|diacritics|with[-_]?diacritics)"

_OPEN, _CLOSE = "\ue000", "\ue001"
_SPACE = r"(?U)[\s\x1c-\x1f]+"


def strip_diacritics(text: Column) -> Column:
    return F.regexp_replace(text, DIACRITICS, "")


def normalize_alif(text: Column) -> Column:
    return F.translate(text, ALIF_FORMS, ALIF * len(ALIF_FORMS))


def normalize_hamza(text: Column) -> Column:
    return F.translate(text, HAMZA_SEATS, HAMZA * len(HAMZA_SEATS))


def normalize_taa_marbuta(text: Column) -> Column:
    return F.translate(text, TAA_MARBUTA, HAA)


def strip_tatweel(text: Column) -> Column:
    return F.translate(text, TATWEEL, "")


def clean_whitespace(text: Column) -> Column:
    """Runs of Unicode white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, _SPACE, " "))


def strip(text: Column) -> Column:
    """Without Unicode white space at the ends."""
    return F.regexp_replace(text, rf"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def normalize_arabic(text: Column) -> Column:
    spelled = normalize_taa_marbuta(normalize_hamza(normalize_alif(strip_diacritics(text))))
    return clean_whitespace(strip_tatweel(spelled))


def is_arabic(text: Column) -> Column:
    return text.rlike("[\u0600-\u06ff]")


def match_spans(text: Column, pattern: str) -> Column:
    """Array of (start, end) of all matches, in code points: matches are put between private characters and the
    lengths of the pieces in between add up."""
    plain = F.regexp_replace(text, f"[{_OPEN}{_CLOSE}]", "\ufffd")
    pieces = F.split(F.regexp_replace(plain, pattern, f"{_OPEN}$0{_CLOSE}"), _OPEN)

    def places(parts: Column) -> Column:
        """Sums in blocks of about the root of their number, so that n matches take n ** 1.5 steps."""

        def step(s: Column, piece: Column) -> Column:
            size = F.instr(piece, _CLOSE) - 1
            found = F.array(F.struct(s["at"].alias("start"), (s["at"] + size).alias("end")))
            return F.struct((s["at"] + F.length(piece) - 1).alias("at"), F.concat(s["found"], found).alias("found"))

        def block(s: Column, part: Column) -> Column:
            own = F.aggregate(part, F.struct(s["at"].alias("at"), F.array().cast(spans).alias("found")), step)
            return F.get(F.transform(F.array(own), lambda o: F.struct(o["at"].alias("at"), F.concat(s["found"], F.array(o["found"])).alias("found"))), 0)

        rest = F.size(parts) - 1
        each = F.greatest(F.lit(16), F.ceil(F.sqrt(rest)).cast("int"))
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(rest / each).cast("int") - 1), lambda k: F.slice(parts, k * each + 2, each))
        start = F.struct(F.length(F.get(parts, 0)).alias("at"), F.array().cast(f"array<{spans}>").alias("found"))
        return F.when(rest > 0, F.flatten(F.aggregate(blocks, start, block)["found"])).otherwise(F.array().cast(spans))

    spans = "array<struct<start:int,end:int>>"
    return F.get(F.transform(F.array(pieces), places), 0)


def transmission_phrases(text: Column) -> Column:
    """Array of (start, end, label) of all phrases, each searched by itself, sorted by place."""
    found = [
        F.transform(match_spans(text, f"(?U){pattern}"), _labelled(label))
        for pattern, label in TRANSMISSION_PHRASES
    ]
    return F.array_sort(F.concat(*found))


def _labelled(label: str):
    return lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(label).alias("label"))


def strip_html(text: Column) -> Column:
    """Without tags and character references; nothing left gives null."""
    bare = F.regexp_replace(F.regexp_replace(text, "<[^>]+>", ""), "&[a-zA-Z]+;|&#[0-9]+;", "")
    return F.nullif(strip(bare), F.lit(""))


def tag_body(text: Column, tag: str) -> Column:
    """The first element's body, or null."""
    return F.nullif(strip(F.regexp_extract(text, rf"(?s)<{tag}>(.*?)</{tag}>", 1)), F.lit(""))


def tag_bodies(text: Column, tag: str) -> Column:
    """All elements' bodies, stripped, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(rf"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1)), strip)


def between_tags(text: Column, tag: str) -> Column:
    """The text before each element, back to the element before it, in order."""
    pieces = F.split(text, rf"(?s)<{tag}>.*?</{tag}>")
    return F.transform(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), strip)


def clean_name(text: Column) -> Column:
    """Stripped, without closing punctuation; nothing left gives null."""
    return F.nullif(F.regexp_replace(strip(text), r"[.,;:!?()]+$", ""), F.lit(""))


def collection_slug(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_"))


def edition_collection(name: Column) -> Column:
    """What follows the first hyphen."""
    return F.regexp_replace(name, "^[^-]*-", "")


def file_collection(name: Column) -> Column:
    """A file's collection: its name without its ending and without a suffix for vocalised text; the case stays."""
    stem = F.regexp_replace(name, r"\.[^.]+$", "")
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(stem, VOCALISED, ""), "^[-_ ]+|[-_ ]+$", ""), F.lit("")), stem)


def normalize_grade(raw: Column) -> Column:
    text = F.lower(normalize_arabic(raw))
    out = F.when(F.coalesce(raw, F.lit("")) == "", "unknown")
    for needles, grade in GRADE_RULES:
        hit = F.lit(False)
        for needle in needles:
            hit = hit | text.contains(normalize_arabic(F.lit(needle)) if not needle.isascii() else F.lit(needle))
        out = out.when(hit, grade)
    return out.otherwise("unknown")


def detect_sect(edition: Column) -> Column:
    return F.when(F.lower(edition).rlike("|".join(SHIA_INDICATORS)), "shia").otherwise("sunni")


def prefix_key(text: Column) -> Column:
    """The blocking key: the first two code points."""
    return F.substring(text, 1, 2)

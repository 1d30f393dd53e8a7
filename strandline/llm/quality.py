"""Quality by weak supervision, in DataFrame operations only.

Each rule votes good or bad on a document, or abstains between its two thresholds. Documents fall into vote patterns, at most
3 ** rules of them; expectation-maximisation over the counted patterns of documents within the hard limits estimates how
many of these are good and how often each rule's votes are right, without labels. A document stays if its pattern's posterior probability
of being good is at least the threshold, whichever rules vote bad, unless a hard limit (too few words, mostly repeated) rejects it.

Repeated three-word windows are found within each row: windows become 64-bit hashes, and only rows where one repeats
sort them. No row leaves its task, and only counts of patterns are shuffled.

Defined results: null and empty texts have no words, which fails the word limit; null ids and repeated rows are judged each;
further columns are ignored; an empty table gives no rows; very long texts need memory for a few numbers a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import TEXTS, keep
from .weak_supervision import posteriors, vote_pattern

#: Fixed by the contract: words, and characters that count as symbols.
SPACE, WORD, SYMBOL = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]", r"[#*$%&|<>]"
MIN_WORDS, MOST_REPEATED_PERCENT = 50, 50


def features(documents: DataFrame, carry: bool = False) -> DataFrame:
    """Counts for each document, whole texts; ``carry``: with the row itself as the struct ``document``."""
    rest = [F.struct(*documents.columns).alias("document")] if carry else []
    more = ["document"] if carry else []
    text = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *rest)
    bare = text.withColumn("bare", F.regexp_replace("text", SPACE, ""))
    words = bare.withColumn("words", F.filter(F.split("text", SPACE), lambda w: w != "")).withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)))
    n = F.size("words")
    windows = words.withColumn(
        "windows",
        F.when(n >= 3, F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))).otherwise(F.array().cast("array<long>")),
    )
    counted = windows.select(
        "doc_id", "windows", *more,
        n.cast("long").alias("n_words"),
        F.length("bare").cast("long").alias("word_chars"),
        F.regexp_count("bare", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(r"[.!?\"'”…][\x20\x09-\x0D]*\z"))).cast("long").alias("n_closed_lines"),
        F.regexp_count("bare", F.lit(r"\p{L}")).cast("long").alias("n_letters"),
        F.regexp_count("bare", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("bare", F.lit("!!")).cast("long").alias("n_exclaimed"),
    )
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    ordered = counted.withColumn(
        "ordered", F.when(repeats, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:long,i:int>>"))
    )
    twice = ordered.withColumn(
        "starts",
        F.array_sort(F.transform(F.filter("ordered", lambda x, j: (x["h"] == F.get("ordered", j - 1)["h"]) | (x["h"] == F.get("ordered", j + 1)["h"])), lambda x: x["i"])),
    )
    covered = F.aggregate(
        F.transform("starts", lambda s, j: F.least(F.lit(3), F.coalesce(F.get("starts", j + 1) - s, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x
    )
    return twice.select(*more, "doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_closed_lines", "n_letters", "n_upper", "n_exclaimed", covered.alias("n_repeat_words"))


def rules() -> dict[str, tuple[Column, Column]]:
    """Name -> (votes bad, votes good); neither: abstains. Each rule has a threshold of its own on either side."""
    words, chars, lines, letters = F.col("n_words"), F.col("word_chars"), F.col("n_lines"), F.col("n_letters")
    symbols, repeated, copied, upper = F.col("n_symbols"), F.col("n_repeat_words"), F.col("n_dup_lines"), F.col("n_upper")
    return {
        "symbols": (10 * symbols > words, 50 * symbols <= words),
        "repeated_windows": (5 * repeated > words, 20 * repeated <= words),
        "repeated_lines": (4 * copied > lines, 10 * copied <= lines),
        "capitals": (10 * upper > 3 * letters, 10 * upper <= letters),
        "exclamations": (20 * F.col("n_exclaimed") > words, 200 * F.col("n_exclaimed") <= words),
        "letters": (10 * letters < 7 * chars, 10 * letters >= 9 * chars),
        "word_length": ((chars > 12 * words) | (chars < 2 * words), (2 * chars >= 7 * words) & (chars <= 7 * words)),
        "open_lines": (10 * F.col("n_closed_lines") < lines, 10 * F.col("n_closed_lines") >= 8 * lines),
    }


#: Where the estimates start: rates of bad votes, abstentions and good votes on good and on bad documents.
START = {"prior": 0.8, "votes_if_yes": (0.05, 0.25, 0.7), "votes_if_no": (0.4, 0.3, 0.3)}


def _failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def _voted(counted: DataFrame) -> DataFrame:
    return counted.withColumn("pattern", vote_pattern(list(rules().values())))


def _fitted(voted: DataFrame, rounds: int) -> DataFrame:
    """Posterior of each pattern of votes, estimated from the documents within the hard limits."""
    counts = voted.groupBy("pattern").agg(F.sum(F.when(_failed(), 0).otherwise(1)).alias("n"))
    return keep(posteriors(counts, len(rules()), rounds, **START).select("pattern", "posterior"), "quality-posteriors")


def judge(documents: DataFrame, threshold: float = 0.5, rounds: int = 30) -> DataFrame:
    """doc_id, counts, base_failed, posterior and kept for each document."""
    voted = keep(_voted(features(documents)), "quality-features")
    return voted.join(F.broadcast(_fitted(voted, rounds)), "pattern").select(  # at most 3 ** 8 patterns
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        _failed().alias("base_failed"), (~_failed() & (F.col("posterior") >= threshold)).alias("kept"), "posterior",
    )


def accepted(documents: DataFrame, threshold: float = 0.5, rounds: int = 30) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns. Documents are written once beside their votes, so that
    counts are taken once."""
    voted = keep(_voted(features(documents, carry=True)).select("document", "pattern", "n_words", "n_repeat_words"), "quality-votes", TEXTS)
    judged = voted.join(F.broadcast(_fitted(voted, rounds)), "pattern")  # at most 3 ** 8 patterns
    return judged.where(~_failed() & (F.col("posterior") >= threshold)).select("document.*")

"""Text functions as Column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space that strip() takes off, sentence ends, legacy ends, emoji blocks.
BLANK = r"[\s\x{A0}\x{3000}]"
ENDS = r"[。！？!?；;.]+|[\r\n]+"
LEGACY_ENDS = r"[。！？；…!?;.]+"
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}]"
#: Ideographs, whose runs have no spaces between words.
HAN = r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}]"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
TAG = r"<[^>]+>"


def bound(value: Column, use) -> Column:
    """use(value) with the value worked out once, however often use names it and within whatever lambda."""
    return F.get(F.transform(F.array(value), use), 0)


def strip(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")


def sentences(text: Column, ends: str = ENDS) -> Column:
    """The sentences of a text that aren't blank, in order."""
    return F.filter(F.transform(F.split(text, ends), strip), lambda x: x != "")


def sentences_or_blank(found: Column) -> Column:
    """The sentences, or one blank one where nothing is left, so that no text goes without a row."""
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("")))


def sentences_legacy(text: Column, least: int = 2, most: int = 120) -> Column:
    """Sentences of least characters or more; longer ones than most are split again at commas."""
    parts = F.flatten(F.transform(
        sentences(text, LEGACY_ENDS),
        lambda x: F.when(F.length(x) > most, F.transform(F.split(x, "[，,]+"), strip)).otherwise(F.array(x))))
    return F.filter(parts, lambda x: F.length(x) >= least)


def squeeze(text: Column) -> Column:
    """One space for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def without_tags(html: Column) -> Column:
    return squeeze(F.regexp_replace(html, TAG, " "))


def clean(text: Column, noise: tuple[str, ...] = (), keep_emoji: bool = False, keep_latin: bool = True) -> Column:
    """Without control characters, tags, emoji, surplus white space, the given patterns and, if asked for, Latin letters, in that order."""
    out = F.regexp_replace(F.regexp_replace(text, CONTROL, ""), TAG, " ")
    out = squeeze(out if keep_emoji else F.regexp_replace(out, EMOJI, ""))
    for pattern in noise:
        out = F.regexp_replace(out, pattern, "")
    return out if keep_latin else F.regexp_replace(out, "[A-Za-z]", "")


def validity(cleaned: Column, least: int = 1) -> tuple[Column, Column]:
    """parse_error and error_msg of a cleaned text."""
    bad = F.length(F.coalesce(cleaned, F.lit(""))) < least
    return bad, F.when(bad, "text too short")


def tokens(text: Column, least: int = 2) -> Column:
    """Words of letters, digits and _ in lower case, of least characters or more.

    A run of ideographs is a word of its own kind: it gives each pair of neighbours, as no dictionary parts it. Any
    other segmentation is a column of words, which ngrams() and the counts take as well."""
    words = F.split(F.regexp_replace(F.lower(text), f"({HAN}+)", " $1 "), r"[^\p{L}\p{N}_]+")
    pairs = lambda x: F.transform(F.sequence(F.lit(1), F.length(x) - 1), lambda i: F.substring(x, i, 2))
    parted = lambda own: F.when(F.exists(own, lambda x: x.rlike(f"^{HAN}{{2}}")), F.flatten(F.transform(
        own, lambda x: F.when(x.rlike(f"^{HAN}{{2}}"), pairs(x)).otherwise(F.array(x))))).otherwise(own)
    return F.filter(bound(words, parted), lambda x: F.length(x) >= least)


def ngrams(words: Column, n: int) -> Column:
    """Each run of n neighbouring words, joined."""
    return bound(words, lambda own: F.when(F.size(own) >= n, F.transform(
        F.sequence(F.lit(1), F.size(own) - n + 1), lambda i: F.array_join(F.slice(own, i, n), " "))).otherwise(F.array().cast("array<string>")))


def file_name(name: Column) -> Column:
    """A name that file systems take."""
    return F.substring(F.regexp_replace(strip(name), r'[\\/:*?"<>|\s]+', "_"), 1, 120)


def is_term(term: Column, least: int = 2, most: int = 20, stop: tuple[str, ...] = ()) -> Column:
    """A term of fitting length with a letter, that isn't digits, marks or a stop word."""
    ok = F.length(term).between(least, most) & term.rlike(r"\p{L}") & ~term.rlike(r"^[0-9]+$")
    return ok & ~F.lower(term).isin(*stop) if stop else ok


def prompt(l1: Column, l2: Column, sentence: Column) -> Column:
    """The one template for training and inference."""
    return F.concat_ws("", F.lit("["), l1, F.lit("::"), l2, F.lit("] "), F.regexp_replace(sentence, r"[\r\n]+", " "))

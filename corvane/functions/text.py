"""Text functions as Catalyst expressions: nothing here leaves the JVM."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions import lexicon as L


def nothing(text: Column) -> Column:
    """A null text reads as empty."""
    return F.coalesce(text, F.lit(""))


def count_class(text: Column, chars: str) -> Column:
    """How many characters are of a regex character class."""
    return F.length(F.regexp_replace(text, f"[^{chars}]", "")).cast("long")


def count_word(text: Column, word: str) -> Column:
    """Occurrences of a word that do not overlap."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(word), F.lit("")))) / F.lit(len(word))).cast("long")


def cjk_count(text: Column) -> Column:
    return count_class(text, L.CJK_CLASS)


def english_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(L.ENGLISH_WORD), F.lit(0))).cast("long")


def english_ratio(text: Column) -> Column:
    """English words among English words and CJK characters, to 3 places; 0 without either."""
    words, cjk = english_words(text), cjk_count(text)
    return F.when(words + cjk > 0, F.round(words / (words + cjk), 3)).otherwise(F.lit(0.0))


def language_features(df, text_col: str):
    """df with the counts that the Mandarin ratio and the language rest on, each computed once."""
    t = nothing(F.col(text_col))
    any_of = lambda words: t.rlike("|".join(map(re.escape, words)))
    clean = reduce(lambda c, w: F.replace(c, F.lit(w), F.lit("")), L.NEUTRAL_WORDS, t)
    # most texts have none of a list's words: one search tells, and the passes for each word are for the others
    total = lambda words: F.when(any_of(words), reduce(lambda a, b: a + b, (count_word(t, w) for w in words))).otherwise(F.lit(0).cast("long"))
    present = F.when(any_of(L.MANDARIN_WORDS), reduce(lambda a, b: a + b, (F.when(F.contains(t, F.lit(w)), len(w)).otherwise(0) for w in L.MANDARIN_WORDS))).otherwise(0)
    mando = F.when(any_of(L.NEUTRAL_WORDS), count_class(clean, L.MANDARIN_CHARS)).otherwise(count_class(t, L.MANDARIN_CHARS))
    df = df.withColumns(
        {
            "f_cjk": cjk_count(t), "f_eng": english_ratio(t), "f_simplified": count_class(t, L.SIMPLIFIED_CHARS), "f_mando": mando,
            "f_canto": count_class(t, L.CANTONESE_CHARS), "f_mando_words": total(L.MANDARIN_WORDS), "f_canto_words": total(L.CANTONESE_WORDS), "f_present": present.cast("long"),
        }
    )
    score = {"f_ms": F.col("f_simplified") * 2.0 + F.col("f_mando") * 1.5 + F.col("f_mando_words") * 2.5, "f_cs": F.col("f_canto") * 1.5 + F.col("f_canto_words") * 2.5}
    return df.withColumns(score)


def mandarin_ratio() -> Column:
    """Of the features of language_features: how much of the CJK text reads as Mandarin, to 3 places; 0.16 at least once it says so."""
    own = F.col("f_simplified") + F.col("f_mando")
    n = F.greatest(F.col("f_cjk"), F.lit(1))
    capped = lambda c: F.least(F.lit(1.0), F.greatest(F.lit(0.16), c))
    r = (
        F.when((F.col("f_cjk") == 0) | (F.col("f_ms") == 0), 0.0)
        .when((F.col("f_cs") > 0) & (F.col("f_ms") >= 0.3 * F.col("f_cs")), capped(own / n))
        .when(F.col("f_cs") > 0, own / n)
        .otherwise(capped((own + F.col("f_present")) / n))
    )
    return F.round(r, 3)


def detected_language() -> Column:
    ms, cs = F.col("f_ms"), F.col("f_cs")
    return (
        F.when((F.col("f_eng") >= 0.85) | (F.col("f_cjk") == 0), "eng").when(F.col("f_eng") >= 0.35, "mixed")
        .when((cs > 0) & (ms > 0) & (ms >= 0.3 * cs) & (cs >= 0.3 * ms), "mixed").when((cs > 0) & (cs > ms), "yue").when(ms > 0, "cmn").otherwise("yue")
    )


def language_confidence() -> Column:
    ms, cs = F.col("f_ms"), F.col("f_cs")
    one = lambda s: F.round(F.least(F.lit(1.0), 0.5 + s * 0.1), 2)
    share = lambda a: F.round(F.try_divide(a, cs + ms), 2)
    return (
        F.when((F.col("f_eng") >= 0.85) | (F.col("f_cjk") == 0), F.col("f_eng")).when(F.col("f_eng") >= 0.35, F.round("f_eng", 2))
        .when((cs > 0) & (ms > 0) & (ms >= 0.3 * cs) & (cs >= 0.3 * ms), 0.8).when((cs > 0) & (ms > 0) & (cs > ms), share(cs)).when((cs > 0) & (ms > 0), share(ms))
        .when(cs > 0, one(cs)).when(ms > 0, one(ms)).otherwise(0.5)
    )


def normalize_text(text: Column) -> Column:
    """For comparison of transcripts: digits as CJK numerals, without punctuation."""
    return F.regexp_replace(F.translate(nothing(text), "0123456789０１２３４５６７８９", "零一二三四五六七八九零一二三四五六七八九"), r"\p{P}", "")


def normalize_mark(mark: Column) -> Column:
    return F.translate(mark, ",?!;:", "，？！；：")


def tokens(text: Column) -> Column:
    return F.filter(F.split(nothing(text), r"\s+"), lambda x: x != "")


def count_syllables(jyutping: Column) -> Column:
    return F.size(F.filter(tokens(jyutping), lambda x: x.rlike("^[a-z]+[1-6]$"))).cast("long")


# The onsets and rimes of the romanisation.
ONSETS = "b p m f d t n l g k ng gw kw w h z c s j".split()
RIMES = "aa aai aau aam aan aang aap aat aak a ai au am an ang ap at ak e ei eu em eng ep ek i iu im in ing ip it ik o oi ou on ong ot ok u ui un ung ut uk oe oeng oek eoi eon eot yu yun yut m ng".split()
SYLLABLE = f"^(?:(?:{'|'.join(sorted(ONSETS, key=len, reverse=True))})?(?:{'|'.join(sorted(RIMES, key=len, reverse=True))}))[1-6]$"


def valid_fraction(jyutping: Column) -> Column:
    """The share of tokens that are syllables of the inventory, to 3 places; 1 for an empty text."""
    t = tokens(jyutping)
    return F.when(F.size(t) == 0, 1.0).otherwise(F.round(F.size(F.filter(t, lambda x: x.rlike(SYLLABLE))) / F.greatest(F.size(t), F.lit(1)), 3))


def strip_tags(text: Column) -> Column:
    return F.trim(F.regexp_replace(nothing(text), r"<\|[^|]*\|>", ""))


def tag_of(text: Column, values: list[str]) -> Column:
    """The first of the tags <|value|>, in upper case; UNKNOWN without one."""
    found = F.upper(F.regexp_extract(nothing(text), rf"(?i)<\|({'|'.join(values)})\|>", 1))
    return F.when(found == "", "UNKNOWN").otherwise(found)


#: White space as Unicode has it.
SPACES = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def slugify(text: Column) -> Column:
    """Lower case; letters and digits of any script, joined by one _ where there was space, _ or -; 40 characters."""
    t = F.regexp_replace(F.lower(nothing(text)), rf"[^\p{{L}}\p{{N}}_{SPACES}-]", "")
    return F.substring(F.regexp_replace(F.regexp_replace(t, rf"[{SPACES}_-]+", "_"), "^_+|_+$", ""), 1, 40)


def short_hash(text: Column, size: int) -> Column:
    return F.substring(F.md5(text.cast("binary")), 1, size)


def shard_index(key: Column, shards: int) -> Column:
    return F.conv(short_hash(key, 8), 16, 10).cast("long") % shards


def traditional(text: Column, characters: dict[str, str], phrases: dict[str, str] | None = None) -> Column:
    """A text in traditional characters: phrases first, the longest before shorter ones, then single characters. Empty and null texts stay.

    Natively; the tables are parameters."""
    out = text
    for a in sorted(phrases or {}, key=lambda p: (-len(p), p)):
        out = F.replace(out, F.lit(a), F.lit(phrases[a]))
    if characters:
        out = F.translate(out, "".join(characters), "".join(characters.values()))
    return F.when(F.coalesce(text, F.lit("")) != "", out).otherwise(text)

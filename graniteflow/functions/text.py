"""Text columns: cleaning, tokens, stop words, stems."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from graniteflow.functions.stopwords import STOP_WORDS

WORD = r"[\p{L}\p{N}_]{2,}"
SENTENCE_END = r"[.!?]\s+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(col) -> Column:
    """Markup and noise removal. The order of the steps is part of the result."""
    c = F.regexp_replace(_col(col), r"(?md)^https?://.*[\r\n]*", "")
    c = F.replace(c, F.lit("<br />"), F.lit(" "))
    c = F.replace(c, F.lit("&quot;"), F.lit('"'))
    c = F.replace(c, F.lit("&#39;"), F.lit('"'))
    c = F.replace(c, F.lit("\n"), F.lit(" "))
    c = F.replace(c, F.lit(" u "), F.lit(" you "))
    c = F.replace(c, F.lit("`"), F.lit(""))
    c = F.regexp_replace(c, " +", " ")
    c = F.regexp_replace(c, "!{2,}", "!")
    c = F.regexp_replace(c, r"\?{2,}", "?")
    c = F.replace(c, F.lit("&amp;"), F.lit("and"))
    c = F.replace(c, F.lit("\r"), F.lit(" "))
    c = F.regexp_replace(c, r"[^\x00-\x7F]", "")
    return F.regexp_replace(c, "(?d)<.*?>", "")


def tokens(col) -> Column:
    """Lower-case words of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(_col(col)), F.lit(WORD), F.lit(0))


def sentences(df: DataFrame, col: str) -> DataFrame:
    """One row per sentence with its position."""
    parts = F.split(F.col(col), SENTENCE_END)
    return df.select("*", F.posexplode(parts).alias("sentence_no", "sentence"))


def legal_words(col, stop_words: list[str] = STOP_WORDS) -> Column:
    """Drop stop words and every word that holds a digit."""
    return F.filter(_col(col), lambda w: is_legal(w, stop_words))


def is_legal(word, stop_words: list[str] = STOP_WORDS) -> Column:
    """Neither a stop word (hash lookup) nor a word with a digit."""
    return ~(_col(word).isin(stop_words) | F.rlike(_col(word), F.lit(r"\p{Nd}")))


def split_words(col) -> Column:
    """Words between white space; empty text has none."""
    return F.filter(F.split(F.trim(_col(col)), r"\s+"), lambda w: w != "")


def strip_hashtags(text, tags) -> Column:
    """Remove each of the row's own tags from its text, in tag order."""
    removed = F.aggregate(
        _col(tags), _col(text), lambda t, h: F.replace(t, F.concat(F.lit("#"), h), F.lit(""))
    )
    return F.trim(removed)


def parse_list(col) -> Column:
    """Array from a list literal such as ``['a', "it's"]``, either quote style."""
    quoted = F.regexp_extract_all(
        _col(col), F.lit(r"""'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*\""""), F.lit(0)
    )
    inner = lambda q: F.substring(q, F.lit(2), F.length(q) - 2)
    return F.transform(quoted, lambda q: F.regexp_replace(inner(q), r"\\(.)", "$1"))


def distinct_values(df: DataFrame, col: str, separator: str = "|") -> DataFrame:
    """Number of different values in a multi-value text column."""
    parts = F.explode(F.split(F.col(col), re.escape(separator))).alias("value")
    return df.select(parts).agg(F.countDistinct("value").alias("n_values"))


def lemmatize(words: DataFrame, lemmas: DataFrame, form: str = "token") -> DataFrame:
    """Left join of word rows with a (form, pos, lemma) table; unknown forms stay.

    Rows without a ``pos`` column count as nouns. The join carries no hint, so
    a small lemma table is broadcast and a large one is shuffled.
    """
    pos = F.coalesce(F.col("pos"), F.lit("n")) if "pos" in words.columns else F.lit("n")
    table = lemmas.select(
        F.col("form").alias("_form"), F.col("pos").alias("_pos"), F.col("lemma").alias("_lemma")
    )
    keyed = words.withColumn("_word", F.lower(F.col(form))).withColumn("_tag", pos)
    hit = (F.col("_word") == F.col("_form")) & (F.col("_tag") == F.col("_pos"))
    return (
        keyed.join(table, hit, "left")
        .withColumn("lemma", F.coalesce("_lemma", "_word"))
        .drop("_form", "_pos", "_lemma", "_word", "_tag")
    )


# ---------------------------------------------------------------- stemming
# Suffix tables of the published Porter algorithm with the
# widely used extensions (short "ied"/"ies" words, "fulli", "bli", "logi").
_STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"), ("logi", "log"),
]
_STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
_STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]
_IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}


_LETTERS = str.maketrans({ch: "v" if ch in "aeiou" else "c" for ch in map(chr, range(97, 123))})
_SYLLABLE = re.compile("v+c+")


def _shape(stem: str) -> str:
    """Letters as c (consonant) or v (vowel); y is a vowel after a consonant."""
    if "y" not in stem and stem.isascii():
        return stem.translate(_LETTERS)
    out = []
    for i, ch in enumerate(stem):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem: str) -> int:
    return len(_SYLLABLE.findall(_shape(stem)))


def _short_end(stem: str) -> bool:
    shape = _shape(stem)
    if len(stem) == 2:
        return shape == "vc"
    return shape.endswith("cvc") and stem[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    found = [s for s in suffixes if word.endswith(s)]
    return max(found, key=len) if found else None


def _plural(w: str) -> str:
    if w.endswith("ies"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("sses"):
        return w[:-2]
    return w[:-1] if w.endswith("s") and not w.endswith("ss") else w


def _past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    suffix = _longest(w, ("ed", "ing"))
    if suffix is None or "v" not in _shape(w[: -len(suffix)]):
        return w
    w = w[: -len(suffix)]
    if w.endswith(("at", "bl", "iz")):
        return w + "e"
    if len(w) > 1 and w[-1] == w[-2] and _shape(w)[-1] == "c":
        return w if w[-1] in "lsz" else w[:-1]
    return w + "e" if _measure(w) == 1 and _short_end(w) else w


def _swap(w: str, table) -> str:
    rules = dict(table)
    suffix = _longest(w, rules)
    if suffix is None:
        return w
    stem = w[: -len(suffix)]
    base = w[:-3] if suffix == "logi" else stem
    if _measure(base) == 0:
        return w
    out = stem + rules[suffix]
    return _swap(out, table) if suffix == "alli" else out


def _trim(w: str) -> str:
    suffix = _longest(w, _STEP_4)
    if suffix is None:
        return w
    stem = w[: -len(suffix)]
    if _measure(stem) <= 1 or (suffix == "ion" and not stem.endswith(("s", "t"))):
        return w
    return stem


def porter_stem(word: str) -> str:
    """Stem of one word."""
    w = word.lower()
    if w in _IRREGULAR:
        return _IRREGULAR[w]
    if len(w) <= 2:
        return w
    w = _past(_plural(w))
    if w.endswith("y") and len(w) > 2 and _shape(w[:-1])[-1] == "c":
        w = w[:-1] + "i"
    w = _trim(_swap(_swap(w, _STEP_2), _STEP_3))
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _short_end(w[:-1])):
            w = w[:-1]
    if w.endswith("ll") and _measure(w[:-1]) > 1:
        w = w[:-1]
    return w


@F.pandas_udf(StringType())
def stem(words: pd.Series) -> pd.Series:
    """Stem column: each different word of an Arrow batch is worked out once."""
    return words.map({w: porter_stem(w) for w in words.dropna().unique()})

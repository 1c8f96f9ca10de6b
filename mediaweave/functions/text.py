"""Scalar text functions: search normalisation, n-grams, time stamps, subtitle markup, names and tokens."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: Grams of a word that a query may hold.
MAX_QUERY_GRAMS = 128


#: Runs of letters and numbers: the characters of the Unicode categories L and N, and no others.
_WORD = re.compile(r"[^\W_]+")


def normal_words(value: str) -> list[str]:
    """NFKC, case folding, and the runs of letters and numbers that remain."""
    return _WORD.findall(value.lower() if value.isascii() else unicodedata.normalize("NFKC", value).casefold())


def normalize_text(value: str) -> str:
    """NFKC, case folding, one space for every run of characters other than letters and numbers."""
    return " ".join(normal_words(value))


@pandas_udf(T.StringType())
def normalize_udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(lambda t: None if t is None else normalize_text(t))


def normalized(text: Column) -> Column:
    """normalize_text as built-in functions, for text that NFKC leaves alone and whose only special case folding is that of the
    sharp s. The JVM's letter and number classes follow the same Unicode categories."""
    return F.trim(F.regexp_replace(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), r"[^\p{L}\p{N}]+", " "))


def words(text: Column) -> Column:
    """Words of normalised text; none for empty text."""
    return F.filter(F.split(text, " "), lambda w: w != "")


def word_grams(word: Column, least: int = 2, most: int = 3) -> Column:
    """Grams of one word, by size and then place. A size beyond the word has none (a sequence must not run downwards)."""
    none = F.array().cast("array<string>")

    def of_size(n: int) -> Column:
        at = F.sequence(F.lit(1), F.length(word) - (n - 1))
        return F.when(F.length(word) >= n, F.transform(at, lambda i: F.substr(word, i, F.lit(n)))).otherwise(none)

    return F.concat(*map(of_size, range(least, most + 1)))


def character_ngrams(text: Column, least: int = 2, most: int = 3) -> Column:
    """Distinct grams inside words of normalised text, in order of first appearance. A word that comes again has no new ones."""
    return F.array_distinct(F.flatten(F.transform(F.array_distinct(words(text)), lambda w: word_grams(w, least, most))))


def search_terms(text: Column) -> tuple[Column, Column]:
    """Distinct words, and distinct grams, of normalised text."""
    return F.array_distinct(words(text)), character_ngrams(text)


def query_grams(text: Column) -> Column:
    return F.slice(character_ngrams(text), 1, MAX_QUERY_GRAMS)


def fmt_ts(seconds: Column) -> Column:
    """mm:ss, truncated; minutes grow without bound."""
    whole = F.floor(seconds).cast("long")
    return F.format_string("%02d:%02d", F.floor(whole / 60).cast("long"), whole % 60)


def optional_text(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def vtt_seconds(stamp: Column) -> Column:
    """Seconds of H:MM:SS.mmm or MM:SS.mmm, to 3 places; null where the stamp is not valid."""
    parts = F.split(stamp, ":")
    n = F.size(parts)
    second = F.element_at(parts, -1).try_cast("double")
    minute = F.try_element_at(parts, F.lit(-2)).try_cast("int")
    hour = F.when(n == 3, parts[0].try_cast("int")).otherwise(F.lit(0))
    good = n.isin(2, 3) & (hour >= 0) & (minute >= 0) & (minute < 60) & (second >= 0) & (second < 60)
    return F.when(good, F.round(hour * 3600 + minute * 60 + second, 3))


_NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def strip_markup(line: Column) -> Column:
    """One line without style overrides and tags, with the commonest entities replaced and spaces collapsed; all built in."""
    text = F.regexp_replace(line, r"\{\\[^}]*\}", "")
    text = F.regexp_replace(text, "<[^>]*>", "")
    for entity, char in _NAMED:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, r"[\s ]+", " "))


_OVERRIDE, _TAG = re.compile(r"\{\\[^}]*\}"), re.compile(r"<[^>]*>")


def plain_text(lines: list[str]) -> str:
    """Lines without markup, every entity replaced, empty ones dropped."""
    out = (" ".join(html.unescape(_TAG.sub("", _OVERRIDE.sub("", x))).split()) for x in lines)
    return "\n".join(x for x in out if x)


@pandas_udf(T.StringType())
def plain_text_udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(lambda t: None if t is None else plain_text(t.split("\n")))


def instant(text: Column) -> Column:
    """The instant of an ISO 8601 time that names its offset from UTC; any other text is an error, null stays null."""
    good = text.rlike(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d(:\d\d([.,]\d{1,6})?)?(Z|[+-]\d\d:?\d\d(:\d\d)?)$")
    return F.when(good, F.replace(text, F.lit(","), F.lit(".")).cast("timestamp")).otherwise(F.when(text.isNotNull(), F.raise_error(F.lit("a time must be ISO 8601 with its offset from UTC")).cast("timestamp")))


def frame_name(scene: Column, index: Column, count: Column) -> Column:
    return F.when(count == 1, F.format_string("scene_%03d.jpg", scene)).otherwise(F.format_string("scene_%03d_%02d.jpg", scene, index))


#: Image media types by suffix.
MEDIA_TYPES = {".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".webp": "image/webp"}


def image_media_type(path: Column) -> Column:
    suffix = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    table = F.create_map(*(F.lit(x) for pair in MEDIA_TYPES.items() for x in pair))
    return F.try_element_at(table, suffix)


def ocr_languages(languages: list[str]) -> list[str]:
    """Trimmed, lower-cased, distinct; each must be letters, digits and underscores."""
    out = list(dict.fromkeys(x.strip().lower() for x in languages))
    if not out or not all(re.fullmatch(r"[a-z0-9_]+", x) for x in out):
        raise ValueError("languages must be non-empty names of letters, digits and underscores")
    return out


def safe_relative_path(path: Column) -> Column:
    """Whether a path is relative, normal and stays below its root."""
    return path.isNotNull() & (path != "") & ~path.rlike(r"^/|\\|(^|/)\.{1,2}(/|$)|//|\x00")


@dataclass(frozen=True)
class TokenCounter:
    """Counts and truncates text by an injected tokenizer: `split` gives tokens whose concatenation is the text.

    `additive` says that texts on lines of their own count as their sum, as white space splits them.
    """

    model_name: str = "whitespace"
    split: Callable[[str], list[str]] | None = None
    additive: bool | None = None

    def __post_init__(self):
        object.__setattr__(self, "additive", self.split is None if self.additive is None else self.additive)
        object.__setattr__(self, "split", self.split or (lambda text: re.findall(r"\s*\S+", text)))

    def count(self, text: str) -> int:
        return len(self.split(text))

    def truncate(self, text: str, tokens: int) -> str:
        return "".join(self.split(text)[: max(0, tokens)]).rstrip()


def tokenizer_model(name: str) -> str:
    """The full model id of a sentence-transformer's tokenizer."""
    return name if "/" in name else f"sentence-transformers/{name}"

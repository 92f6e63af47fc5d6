"""A rule-based English stemmer, applied to the distinct words of a table only.

It follows the published description of the English (Porter 2) stemmer: endings are taken off or replaced if they lie in the part of the
word behind its first, or second, vowel and consonant.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values of the published rules --------------------------------------------------------
VOWELS = "aeiouy"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = "cdeghkmnrt"
LONG_STARTS = ("gener", "commun", "arsen")
WHOLE_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli",
    "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
LEFT_AS_THEY_ARE = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ational": "ate",
    "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous",
    "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": ""}
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion")
# --- end of fixed values ------------------------------------------------------------------------

_REGION = re.compile(rf"[{VOWELS}][^{VOWELS}]")
_VOWEL = re.compile(rf"[{VOWELS}]")
_SHORT_END = re.compile(rf"(?:^[{VOWELS}][^{VOWELS}]|[^{VOWELS}][{VOWELS}][^{VOWELS}wxY])$")


def _regions(word: str) -> tuple[int, int]:
    """Where the parts behind the first and the second vowel and consonant begin."""
    start = next((len(s) for s in LONG_STARTS if word.startswith(s)), None)
    if start is None:
        found = _REGION.search(word)
        start = found.end() if found else len(word)
    found = _REGION.search(word, start)
    return start, found.end() if found else len(word)


def _ending(word: str, endings) -> str | None:
    """The longest of the endings the word has."""
    return max((e for e in endings if word.endswith(e)), key=len, default=None)


def _plural(word: str) -> str:
    end = _ending(word, ("sses", "ied", "ies", "us", "ss", "s"))
    if end == "sses":
        return word[:-2]
    if end in ("ied", "ies"):
        return word[:-2] if len(word) > 4 else word[:-1]
    return word[:-1] if end == "s" and _VOWEL.search(word[:-2]) else word


def _past(word: str, first: int) -> str:
    end = _ending(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if end is None:
        return word
    rest = word[: -len(end)]
    if end.startswith("eed"):
        return rest + "ee" if len(rest) >= first else word
    if not _VOWEL.search(rest):
        return word
    if rest.endswith(("at", "bl", "iz")):
        return rest + "e"
    if rest.endswith(DOUBLES):
        return rest[:-1]
    return rest + "e" if len(rest) <= first and _SHORT_END.search(rest) else rest


def _derived(word: str, first: int, second: int) -> str:
    end = _ending(word, STEP_2)
    if end and len(word) - len(end) >= first:
        rest = word[: -len(end)]
        if not (end == "ogi" and not rest.endswith("l") or end == "li" and rest[-1:] not in tuple(LI_ENDINGS)):
            word = rest + STEP_2[end]
    end = _ending(word, STEP_3)
    if end and len(word) - len(end) >= (second if end == "ative" else first):
        word = word[: -len(end)] + STEP_3[end]
    end = _ending(word, STEP_4)
    if end and len(word) - len(end) >= second and (end != "ion" or word[: -len(end)].endswith(("s", "t"))):
        word = word[: -len(end)]
    if word.endswith("e") and (len(word) > second or len(word) > first and not _SHORT_END.search(word[:-1])):
        return word[:-1]
    return word[:-1] if word.endswith("ll") and len(word) > second else word


def english_stem(word: str) -> str:
    """The stem of one lower-case word; words of one or two letters and words without a vowel keep their form."""
    if len(word) <= 2:
        return word
    if word in WHOLE_WORDS:
        return WHOLE_WORDS[word]
    word = re.sub(rf"(^|[{VOWELS}])y", r"\1Y", word.removeprefix("'"))
    first, second = _regions(word)
    end = _ending(word, ("'", "'s", "'s'"))
    word = _plural(word[: -len(end)] if end else word)
    if word in LEFT_AS_THEY_ARE:
        return word
    word = _past(word, first)
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in VOWELS:
        word = word[:-1] + "i"
    return _derived(word, first, second).replace("Y", "y")


def stem_table(words: DataFrame) -> DataFrame:
    """(word, stem) for every distinct word of ``words`` (word)."""

    def stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("word")
            yield pa.RecordBatch.from_arrays([found, pa.array([english_stem(w) for w in found.to_pylist()], pa.string())], ["word", "stem"])

    return words.select("word").filter(F.col("word").isNotNull()).distinct().mapInArrow(stems, "word string, stem string")


def stem_words(rows: DataFrame) -> DataFrame:
    """``rows`` with a column ``word``, and its ``stem`` joined back."""
    return rows.join(stem_table(rows), "word", "left")

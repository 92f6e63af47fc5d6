"""Text columns: tokens, light stemming, clean-up, stop words and hash buckets.

Each step exists as an expression over one word (for exploded rows and lambdas) and over a token
array; ``post_tokens`` is all of them in one pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------
SPACE = r"[ \t\n\x0B\f\r]"
# ASCII punctuation except @, typographic quotes and dashes, and the symbol/emoji ranges
# U+1F000-1F3FF, U+1F400-1F7FF, U+2600-27FF.
NOISE = r"[!-/:-?\[-`{-~‘“’”—–\x{1F000}-\x{1F3FF}\x{1F400}-\x{1F7FF}\x{2600}-\x{27FF}]"
DROP_IF_CONTAINS = ("http", "…", "@")
DROP_IF_EQUAL = ("rt", "")
# URLs, URLs cut off at the end of the text, and mentions.
LINKS_AND_MENTIONS = r"(https?\S+| htt?p?s?…$|@\S+)"
# Words of at least two letters, digits or underscores.
WORD = r"[\p{L}\p{N}_]{2,}"
# The English stop words of Spark's own StopWordsRemover, pinned so that results do not move with
# the Spark version.
STOP_WORDS = tuple(
    """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
    """.split()
)
# --- end of fixed values ----------------------------------------------------------------------

_UINT32 = 4294967295


def tokenize(text: Column) -> Column:
    """Lower-case and split at every single white-space character."""
    return F.split(F.lower(text), SPACE)


def stem_word(word: Column) -> Column:
    """Plural removal after Harman's S stemmer; the first rule whose ending fits decides."""

    def ends(*suffixes: str) -> Column:
        test = F.lit(False)
        for suffix in suffixes:
            test = test | word.endswith(suffix)
        return test

    def cut(n: int) -> Column:
        return F.substring(word, F.lit(1), F.char_length(word) - n)

    return (
        F.when(~ends("s"), word)
        .when(ends("ies"), F.when(ends("eies", "aies"), word).otherwise(F.concat(cut(3), F.lit("y"))))
        .when(ends("es"), F.when(ends("aes", "ees", "oes"), word).otherwise(cut(1)))
        .when(ends("us", "ss") | (word == "s"), word)
        .otherwise(cut(1))
    )


def sanitize_word(word: Column) -> Column:
    # most words are plain letters; a cheap test spares them the wide character class
    return F.when(word.rlike("^[a-z0-9]*$"), word).otherwise(F.regexp_replace(word, NOISE, ""))


def keep_word(word: Column) -> Column:
    """False for links, mentions, cut-off words, the retweet mark and empty strings."""
    keep = ~word.isin(*DROP_IF_EQUAL)
    for part in DROP_IF_CONTAINS:
        keep = keep & ~word.contains(part)
    return keep


def stem_tokens(tokens: Column) -> Column:
    return F.transform(tokens, stem_word)


def sanitize_tokens(tokens: Column) -> Column:
    return F.filter(F.transform(tokens, sanitize_word), keep_word)


def remove_stopwords(tokens: Column, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Drop stop words and keep repeated words."""
    return F.filter(tokens, lambda w: ~w.isin(*stop_words))


def post_tokens(text: Column, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """tokenize -> stem -> sanitize -> stop words, in one pass over the words of a post."""
    words = F.transform(tokenize(text), lambda w: sanitize_word(stem_word(w)))
    return F.filter(words, lambda w: keep_word(w) & ~w.isin(*stop_words))


def string_hash(word: Column) -> Column:
    """The JVM's 32-bit string hash (31*h + code unit), as a signed number in a LONG."""

    def add(h: Column, char: Column) -> Column:
        code = F.ascii(char)
        beyond = code - 65536
        # a character above U+FFFF counts as its two UTF-16 units
        pair = (h * 31 + 55296 + F.shiftright(beyond, 10)) * 31 + 56320 + beyond.bitwiseAND(1023)
        return F.when(code < 65536, h * 31 + code).otherwise(pair).bitwiseAND(F.lit(_UINT32))

    h = F.aggregate(F.split(word, ""), F.lit(0).cast("long"), add)
    return F.when(h > 2147483647, h - F.lit(_UINT32 + 1)).otherwise(h)


def hash_bucket(word: Column, dims: int = 100) -> Column:
    return F.pmod(string_hash(word), F.lit(dims)).cast("int")


def java_hashes(words: list[str]) -> np.ndarray:
    """The same hash for a list of words, one character position of all words at a time."""
    units = [np.frombuffer(w.encode("utf-16-le"), dtype=np.uint16) for w in words]
    length = np.array([len(u) for u in units], dtype=np.int64)
    order = np.argsort(-length, kind="stable")
    out = np.zeros(len(words), dtype=np.uint32)
    for pos in range(int(length.max(initial=0))):
        live = order[: np.searchsorted(-length[order], -pos, side="left")]
        out[live] = out[live] * np.uint32(31) + np.array([units[i][pos] for i in live], dtype=np.uint32)
    return out.view(np.int32)


def bucket_counts(tokens: Column, dims: int = 100) -> Column:
    """Token counts per hash bucket, as a dense ARRAY<DOUBLE>.

    Spark has no JVM string hash, and hashing character by character in lambdas is about ten times
    slower than the rest of the text pipeline. Here only the distinct words of an Arrow batch are hashed.
    """

    @F.arrow_udf("array<double>")
    def count(lists: pa.Array) -> pa.Array:
        words = lists.flatten().dictionary_encode()
        bucket = np.mod(java_hashes(words.dictionary.to_pylist()), dims)
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        cell = row * dims + bucket[words.indices.to_numpy()]
        counts = np.bincount(cell, minlength=len(lists) * dims).astype(np.float64)
        offsets = pa.array(np.arange(0, len(counts) + 1, dims), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(counts))

    return count(F.coalesce(tokens, F.array().cast("array<string>")))  # no text has no words


def word_counts(words: Column) -> Column:
    """The distinct words of a list with their counts, formed inside the row."""

    @F.arrow_udf("array<struct<word:string,n:bigint>>")
    def count(lists: pa.Array) -> pa.Array:
        found = lists.flatten().dictionary_encode()
        size = max(1, len(found.dictionary))
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        cells, n = np.unique(row * size + found.indices.to_numpy(), return_counts=True)
        offsets = pa.array(np.searchsorted(cells, np.arange(len(lists) + 1) * size), pa.int32())
        names = found.dictionary.take(pa.array(cells % size))
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([names, pa.array(n, pa.int64())], names=["word", "n"]))

    return count(F.coalesce(words, F.array().cast("array<string>")))


def token_hash_buckets(tokens: Column, dims: int = 100) -> Column:
    """The hash bucket of every token, hashed once per distinct word of an Arrow batch."""

    @F.arrow_udf("array<int>")
    def buckets(lists: pa.Array) -> pa.Array:
        words = lists.flatten().dictionary_encode()
        bucket = np.mod(java_hashes(words.dictionary.to_pylist()), dims).astype(np.int32)
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(bucket[words.indices.to_numpy()]))

    return buckets(F.coalesce(tokens, F.array().cast("array<string>")))


def clean_text(text: Column) -> Column:
    """Remove links, cut-off links at the end and mentions."""
    return F.regexp_replace(text, LINKS_AND_MENTIONS, "")


def stem_text(text: Column) -> Column:
    """Stem every word and join the words by single blanks."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: stem_word(F.lower(w))), " ")


def plain_words(text: Column, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Words of two or more characters without stop words, as used by the exploration reports."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return remove_stopwords(words, stop_words)

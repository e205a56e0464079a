"""Text analysis as JVM-side column expressions (no Python UDFs).

The analyzer lower-cases and cuts at the default word boundaries of Unicode (UAX #29), with no stop
words and no stemming. A token is a segment that holds a letter or a decimal digit:

* letters and digits stand together; marks and format characters stay with what they follow;
* a single MidLetter or MidNumLet (``:`` ``·`` ``.`` ``'`` ``’`` ...) joins two letters, a MidNum or
  MidNumLet (``,`` ``;`` ``.`` ``'`` ...) two digits, but neither joins a letter to a digit: ``don't``,
  ``e.g``, ``3.14`` and ``1,000`` are one token, ``fig.3`` two;
* ExtendNumLet (``_`` and other connectors) joins and belongs to what it touches;
* Katakana runs are tokens, each Han or Hiragana character is one, and runs of Thai, Lao, Myanmar or
  Khmer, which need a dictionary, stay whole;
* a token of more than 255 characters is cut every 255 characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TOKEN = 255

# Word-break classes of UAX #29 as character class contents.
MID_LETTER = ":\u00b7\u0387\u055f\u05f4\u2027\ufe13\ufe55\uff1a"
MID_NUM = ",;\u037e\u0589\u060c\u060d\u066c\u07f8\u2044\ufe10\ufe14\ufe50\ufe54\uff0c\uff1b"
MID_NUM_LET = ".'\u2018\u2019\u2024\ufe52\uff07\uff0e"
_OWN_RULES = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\u30FC\p{IsThai}\p{IsLao}\p{IsMyanmar}\p{IsKhmer}"  # letters with rules of their own


def _rules() -> str:
    """The rules as one pattern of java.util.regex. Every quantifier is possessive: no run gives
    characters back, so that matching is linear and does not recurse however long a token is."""
    extend = r"[\p{M}\p{Cf}]*+"
    # ranges of letters that are tested first, for speed: they are members of the general class behind them
    common = r"a-z\u00DF-\u00F6\u00F8-\u02AF\u03AC-\u03CE\u0430-\u0481"
    letter = rf"[{common}[^\P{{L}}{_OWN_RULES}]\p{{Nl}}]"
    letters = rf"{letter}[{letter}\p{{M}}\p{{Cf}}]*+"
    digits = r"[0-9\p{Nd}][0-9\p{Nd}\p{M}\p{Cf}]*+"
    connector = rf"(?:\p{{Pc}}{extend})"
    words = rf"{letters}(?:[{MID_LETTER}{MID_NUM_LET}]{extend}{letters})*+"
    numbers = rf"{digits}(?:[{MID_NUM}{MID_NUM_LET}]{extend}{digits})*+"
    piece = rf"(?:(?:{words}|{numbers})++|[\p{{IsKatakana}}\u30FC][\p{{IsKatakana}}\u30FC\p{{M}}\p{{Cf}}]*+)"
    joined = rf"{connector}*+{piece}(?:{connector}++{piece})*+{connector}*+"
    one = rf"[\p{{IsHan}}\p{{IsHiragana}}]{extend}"
    run = r"[\p{IsThai}\p{IsLao}\p{IsMyanmar}\p{IsKhmer}][\p{IsThai}\p{IsLao}\p{IsMyanmar}\p{IsKhmer}\p{M}\p{Cf}]*+"
    # most characters between tokens fail the first test
    return rf"(?=[a-z\p{{L}}\p{{Nl}}\p{{Nd}}\p{{Pc}}])(?:{joined}|{one}|{run})"


# Most words: letters of Latin-1 before a character that never joins what stands around it. They are the
# same tokens by the rules, found in half the time; what does not end like this goes through the rules.
PLAIN_WORD = r"""[a-z\u00DF-\u00F6\u00F8-\u00FF]+(?=[ \n\t,;!?()"\-]|\z|[.:][ \n])"""
RULES_PATTERN = _rules()
JAVA_TOKEN_PATTERN = f"{PLAIN_WORD}|{RULES_PATTERN}"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def chopped(token: Column) -> Column:
    """ARRAY<STRING>: the token, or its pieces of ``MAX_TOKEN`` characters."""
    last = F.floor((F.length(token) - 1) / MAX_TOKEN).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(token, i * MAX_TOKEN + 1, F.lit(MAX_TOKEN)))
    return F.when(F.length(token) > MAX_TOKEN, pieces).otherwise(F.array(token))


def may_be_long(text: Column) -> Column:
    """Whether a text can hold a token beyond ``MAX_TOKEN`` characters: it is not a row of shorter runs
    between spaces, which looks at every character once."""
    run = rf"\S{{0,{MAX_TOKEN}}}+"
    return ~F.rlike(text, F.lit(rf"\A(?:{run}\s)*+{run}\z"))


def tokens(text: str | Column) -> Column:
    """ARRAY<STRING> of lower-cased word tokens in text order."""
    lower = F.lower(_c(text))
    found = F.regexp_extract_all(lower, F.lit(JAVA_TOKEN_PATTERN), 0)
    return F.when(may_be_long(lower), F.flatten(F.transform(found, chopped))).otherwise(found)


def keyword_terms(value: str | Column) -> Column:
    """A keyword field is one term: the whole value (empty array for NULL)."""
    v = _c(value)
    return F.when(v.isNull(), F.array().cast("array<string>")).otherwise(F.array(v))


def with_term_counts(df: DataFrame, toks: str, out: str = "terms") -> DataFrame:
    """Add ``out`` = ARRAY<STRUCT<term, tf>>: the distinct terms of the token array column ``toks``
    with their counts, computed inside the row.

    Sort the tokens, find the end of each run of equal tokens, take run lengths. A document's
    tokens live in one row, so term vectors need no shuffle. The sorted array and the run ends
    are materialised as columns first: an array expression used inside a lambda would be
    re-evaluated for every element.
    """
    s, e = f"_{out}_sorted", f"_{out}_ends"
    df = df.withColumn(s, F.sort_array(F.col(toks)))
    # tokens are not null, and get() is null beyond the ends
    df = df.withColumn(e, F.filter(
        F.sequence(F.lit(1), F.greatest(F.size(F.col(s)), F.lit(1))),
        lambda i: ~F.get(F.col(s), i).eqNullSafe(F.get(F.col(s), i - 1))))
    return df.withColumn(out, F.transform(
        F.col(e),
        lambda x, k: F.struct(
            F.get(F.col(s), x - 1).alias("term"),
            (x - F.coalesce(F.get(F.col(e), k - 1), F.lit(0))).cast("bigint").alias("tf"),
        ),
    )).drop(s, e)


def normalize_newlines(text: str | Column) -> Column:
    """CRLF / CR to LF, and drop one final newline (whole-file reads)."""
    t = F.regexp_replace(_c(text), r"\r\n?", "\n")
    return F.regexp_replace(t, r"\n\z", "")


def line_slice(text: str | Column, top: int, bottom: int) -> Column:
    """Keep the first ``top`` lines and the last ``bottom`` lines, each line at most once.

    ``top`` / ``bottom`` of 0 disable that part; when the parts overlap the text is kept whole.
    """
    if top < 0 or bottom < 0:
        raise ValueError("top and bottom must be >= 0")
    lines = F.split(_c(text), "\n", -1)
    n = F.size(lines)
    head = F.slice(lines, 1, F.least(F.lit(top), n)) if top > 0 else F.array().cast("array<string>")
    start = F.greatest(F.lit(top), n - F.lit(bottom))
    tail = F.slice(lines, start + 1, n - start) if bottom > 0 else F.array().cast("array<string>")
    # slice() rejects a start beyond the end, so guard the empty case.
    tail = F.when(n - start > 0, tail).otherwise(F.array().cast("array<string>")) if bottom > 0 else tail
    return F.array_join(F.concat(head, tail), "\n")


def shingles(toks: str, k: int) -> Column:
    """ARRAY<STRING> of the k-token shingles (space-joined) of the token-array COLUMN ``toks``
    (pass a column name: the array is read inside a lambda and must be materialised)."""
    t = F.col(toks)
    n = F.size(t)
    return F.when(n >= k, F.transform(
        F.sequence(F.lit(1), n - F.lit(k - 1)),
        lambda i: F.array_join(F.slice(t, i, k), " "),
    )).otherwise(F.array().cast("array<string>"))


def shingle_rows(df: DataFrame, toks: str, k: int, out: str = "sh") -> DataFrame:
    """A row per k-token shingle of the token-array COLUMN ``toks``: the other columns and ``out``, the
    shingle as a struct of its tokens. Shifted arrays are zipped and exploded, which runs as generated
    code; ``shingles`` evaluates an expression tree per token."""
    t = F.col(toks)
    shifted = [F.slice(t, j + 1, F.greatest(F.size(t) - j, F.lit(0))).alias(f"t{j}") for j in range(k)]
    others = [c for c in df.columns if c != toks]
    return df.select(*others, F.explode_outer(F.arrays_zip(*shifted)).alias(out)).where(F.col(f"{out}.t{k - 1}").isNotNull())

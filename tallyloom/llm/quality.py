"""Line-first cleaning: every line is judged, failing lines go, gutted documents are rejected.

A line with at least one word fails if one of three rules holds:

* punctuation: no word ends a sentence, or more than half of the words end in ``!`` or ``?``;
* navigation: two or more separators standing as words, and at least one per three words;
* boilerplate: phrases of web furniture, standing as words, hold at least 30 % of the words, or at
  least 30 % of the words carry ``#*$%&<>{}``.

Removed lines take their words with them.  A document is kept if its base checks pass (ten
words or more, at most 20 % of them in repeated five-word windows) and it lost at most half of
its words.

Defined cases: null and empty texts have no words and are rejected; blank lines never fail;
every row is judged by itself, so ties and repeated rows do not matter; all columns of the
input stay, but columns with the names of the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, columns_of, n_words

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_LOST_PERCENT = 50
SYMBOLS = "#*$%&|<>"

SENTENCE_END = r"[.!?\x{2026}\x{3002}][)\]\x{22}\x{27}\x{bb}\x{201d}]*(?:[\x20\x09-\x0D]|\z)"
SHOUT = r"[!?][\x20\x09-\x0D]|[!?]\z"
SEPARATOR = r"(?:\A|[\x20\x09-\x0D])[|>/\x{bb}\x{b7}\x{2022}](?:[\x20\x09-\x0D]|\z)"
# A word is tried from its start only, and never again with a shorter part of it: linear in long words.
SYMBOL_WORD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D#*$%&<>{}]*+[#*$%&<>{}]"
FURNITURE = (
    r"(?i)lorem ipsum|enable javascript|cookie policy|privacy policy|terms of (?:use|service)"
    r"|all rights reserved|click here|sign in|log in|skip to (?:main )?content|subscribe to our"
)
# The phrases as whole words.
PHRASE = r"(?i)(?<![\p{L}\p{N}])(?:" + FURNITURE.removeprefix("(?i)") + r")(?![\p{L}\p{N}])"

_SPACES = " \t\n\x0b\f\r"
ADDED = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_bad_lines", "clean_text",
    "lost_words", "kept",
)


def line_fails(line: Column) -> Column:
    words = F.regexp_count(line, F.lit(WORD))
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    furniture = F.array_join(F.regexp_extract_all(line, F.lit(PHRASE), F.lit(0)), " ")
    return line.rlike(WORD) & (
        ~line.rlike(SENTENCE_END)
        | (F.regexp_count(line, F.lit(SHOUT)) * 2 > words)
        | ((separators >= 2) & (separators * 3 >= words))
        | (line.rlike(PHRASE) & (F.regexp_count(furniture, F.lit(WORD)) * 10 >= words * 3))
        | (F.regexp_count(line, F.lit(SYMBOL_WORD)) * 10 >= words * 3)
    )


def let(value: Column, body) -> Column:
    """``body`` applied to a value that is computed once, also where it is used many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(text: Column) -> Column:
    """Words of a text that lie in five-word windows found twice or more in it.

    Windows are hashed to 64 bits and sorted with their places; equal neighbours give the
    places of repeated windows, and the union of the stretches they cover is counted.
    """
    hashed = lambda w, i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
    windows = lambda w: F.when(
        F.size(w) >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: hashed(w, i)),
    ).otherwise(F.array().cast("array<bigint>"))
    ordered = lambda h: F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    pairs = lambda o: F.zip_with(
        F.slice(o, 1, F.size(o) - 1),
        F.slice(o, 2, F.size(o) - 1),
        lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])).otherwise(F.array().cast("array<int>")),
    )
    covered = lambda places: F.aggregate(
        places,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n"), (i + WINDOW).alias("end")),
        lambda a: a["n"],
    )
    places = lambda h: F.sort_array(F.array_distinct(F.flatten(let(ordered(h), pairs))))
    repeated = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(places(h))).otherwise(F.lit(0).cast("bigint"))
    words = F.split(F.trim(text, F.lit(_SPACES)), SPACE + "+")
    return let(let(words, windows), repeated)


def judge(docs: DataFrame, max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """Adds the base figures, ``base_failed``, ``n_bad_lines``, ``lost_words``, ``clean_text`` and ``kept``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.split(text, "\n")
    worded = F.filter(lines, lambda x: x.rlike(WORD))
    squeezed = F.translate(text, _SPACES, "")
    good = F.filter(lines, lambda x: ~line_fails(x))
    measured = docs.select(
        *columns_of(docs, ADDED),
        n_words(text).alias("n_words"),
        F.length(squeezed).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(worded, lambda w: F.size(w) - F.size(F.array_distinct(w))).cast("long").alias("n_dup_lines"),
        repeat_words(text).alias("n_repeat_words"),
        F.size(lines).alias("__lines"),
        good.alias("__good"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    clean = measured.withColumns(
        {
            "base_failed": failed,
            "n_bad_lines": (F.col("__lines") - F.size("__good")).cast("long"),
            "clean_text": F.array_join("__good", "\n"),
        }
    ).drop("__lines", "__good")
    lost = F.when(F.col("n_bad_lines") == 0, F.lit(0).cast("long")).otherwise(F.col("n_words") - n_words(F.col("clean_text")))
    return clean.withColumn("lost_words", lost).withColumn(
        "kept", ~F.col("base_failed") & (F.col("lost_words") * 100 <= F.col("n_words") * max_lost_percent)
    )


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """Kept documents with their failing lines removed and ``n_chars`` adjusted, in the columns of the input."""
    packed = docs.select(F.struct(*columns_of(docs)).alias("__row"), "text")
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return judge(packed, **options).where("kept").select(
        *[new[c].alias(c) if c in new else F.col(f"__row.`{c}`") for c in docs.columns]
    )

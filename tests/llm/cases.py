"""Tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size int, kept string, n_words string, "
    "n_lines string, copy string, position string, node string, score string, host string, `odd.name` int"
)

SENTENCE = "The quick brown fox jumps over the lazy dog near the old river bank today."
LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000)) + "."

TEXTS = [
    (1, SENTENCE, "a"),
    (1, SENTENCE, "a"),
    (2, SENTENCE, "b"),
    (3, None, "a"),
    (4, "", "b"),
    (5, " \t\n\x0b\f\r ", None),
    (None, SENTENCE, "a"),
    (None, None, None),
    (6, LONG, "a"),
    (7, "short text", "c"),
    (8, "line one of the text.\nline one of the text.\nOther words follow here, don't they?", "c"),
    (9, "  LINE ONE of the text.\n\nanother line entirely, with words.", "a"),
    (10, "日本語の文章です。 été naïve – “quoted” 😀", "ü"),
    (11, " odd spaces　here \r\n and   there\t\tend ", "b"),
    (12, "a b c d e f g h i j " * 6, "b"),
    (13, "x" * 3000, "b"),
    (14, "Home | About | Contact | Login | Search | Help\nClick here!! NOW!! BUY!! IT!!", "c"),
    (14, "the same id with another text, which is a sentence of its own.", "c"),
]


def table(spark, rows=TEXTS):
    return spark.createDataFrame(
        [(i, t, "en", s, len(t or ""), 7, "no", "x", "y", "z", "p", "n", "s", "h", 1) for i, t, s in rows], SCHEMA
    )


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)

from pyspark.sql import functions as F

from tallyloom.functions import bands, naming
from tallyloom.functions import text as X
from tallyloom.operators import cleaning as C
from tallyloom.operators import ngrams as N


def one(df, *columns):
    return [tuple(r) if len(r) > 1 else r[0] for r in df.select(*columns).collect()]


def test_repo_url_parts(rows):
    df = rows([("https://example.org/o/x.github.io.git",), ("nothing",)], "u string")
    u = F.col("u")
    assert one(df, naming.repo_owner(u), naming.repo_short_name(u)) == [("o", "xhub.io"), (None, None)]
    assert one(df, naming.clean_repo_url(u))[0] == "https://example.org/o/xhub.io"
    assert one(df, naming.clean_repo_url(u, suffix_only=True))[0] == "https://example.org/o/x.github.io"
    assert one(df, naming.owner_slash_repo(u)) == ["o/xhub.io", None]


def test_qualified_class_name(rows):
    paths = ["m/src/main/java/a/B.java", "src/java/a/B.java", "lib/src/B.java", "a/B.java", None]
    df = rows([(p,) for p in paths], "p string")
    assert one(df, naming.qualified_class_name(F.col("p"))) == ["a.B", "a.B", "B", "a.B", ""]


def test_record_id(rows):
    df = rows([("r", "0123456789", "A.java", 5, 7)], "r string, s string, p string, a bigint, b bigint")
    got = one(df, naming.record_id(*[F.col(c) for c in "rspab"]))
    assert got == ["r@0123456:A.java#5-7"]


def test_standardisation(rows):
    df = rows([("\\a\\b.java/", "f(int  a,\n\tint b) ", "  Big/Repo \n")], "p string, s string, r string")
    assert one(df, X.standardize_path(F.col("p"))) == ["a/b.java"]
    assert one(df, X.normalize_signature(F.col("s"))) == ["f(int a, int b)"]
    assert one(df, X.standardize_repo_name(F.col("r"))) == ["big/repo"]


def test_text_metrics(rows):
    text = "a b　c\u001cd\u0085e²½_é́ x"
    df = rows([(text,), ("a\n\n  \n\tb\r",), ("",)], "t string")
    got = one(df, *X.text_metrics(F.col("t")))
    assert got[0][:2] == (5, 6)
    assert got[1][2] == 2
    assert got[2] == (0, 0, 0)


# A method, its tokens in level order and its metrics.
METHOD = (
    "public static void main(String[] args) {\n        System.out.println("
    "\"互联网 Java 工程师进阶知识完全扫盲\");\n    }"
)
METHOD_TOKENS = [
    "void", "main", "public", "static", "(", ")", "{", "}", "args", ";", "String", ".", "println", "[", "]",
    "System", ".", "out", "(", ")", "\"",
    "互联网 Java 工程师进阶知识完全扫盲", "\"",
]


def test_golden_method(rows):
    df = rows([(METHOD, METHOD_TOKENS, 0)], "t string, code_tokens array<string>, row_ord bigint")
    assert one(df, *X.text_metrics(F.col("t"))) == [(21, 12, 3)]
    assert one(df, F.size("code_tokens"), F.size(F.array_distinct("code_tokens"))) == [(23, 19)]
    grams = N.extract_ngrams(df, 3).orderBy("pos").collect()
    assert len(grams) == 24
    assert (grams[0].ctx, grams[0].nxt) == (["<START>", "<START>"], "void")


def test_complexity_band(rows):
    df = rows([(v,) for v in (0, 1, 2, 3, 5, 6, 10, 11, None)], "c bigint")
    low, medium, high, very = (label for _, label in bands.COMPLEXITY_BANDS)
    want = [None, low, low, medium, medium, high, high, very, None]
    assert one(df, bands.complexity_band(F.col("c"))) == want


def test_valid_method_name(rows):
    names = ["ab", "a", "a b", "$x", "été", "", None, "ab\n"]
    df = rows([(n,) for n in names], "method_name string")
    assert one(df.where(C.valid_method_name()), "method_name") == ["ab", "$x", "été"]


def test_decode_tokens(rows):
    df = rows([('["a", "b\\"c"]',), ("['a', 'b\\'c']",), ("broken",), (None,)], "s string")
    strict = one(df, X.decode_tokens(F.col("s")))
    assert strict[0] == ["a", 'b"c'] and strict[2:] == [None, None]
    lenient = one(df, X.decode_tokens(F.col("s"), python_repr=True))
    assert lenient[:2] == [["a", 'b"c'], ["a", "b'c"]]


def test_format_predictions(rows):
    df = rows([([("a", 0.1234), ("b", 0.5)],), ([],)], "p array<struct<token:string,prob:double>>")
    assert one(df, bands.format_predictions(F.col("p"))) == ["a (0.123), b (0.500)", ""]

"""Character classes shared by every text operator.

Fixed values.  They spell out what the regular-expression engines in use here
(Java's and RE2) must agree on, so that a count is the same wherever it is taken.
"""

# Members of a bracket expression: every character Unicode calls whitespace.
WS_CHARS = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WORD_CHARS = r"\p{L}\p{N}_"

WS = f"[{WS_CHARS}]"
NOT_WS = f"[^{WS_CHARS}]"
WORD = f"[{WORD_CHARS}]+"
# A word, or one character that is neither a word character nor whitespace.
WORD_OR_SYMBOL = f"{WORD}|[^{WORD_CHARS}{WS_CHARS}]"
# A character a method name cannot contain.
NOT_NAME_CHAR = f"[^{WORD_CHARS}$]"
EDGE_WS = rf"^{WS}+|{WS}+\z"

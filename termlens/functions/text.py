"""Text column expressions: tokenizer (T1-T4), cleaners (T5-T8, T11),
ids and hashes (T9, T10, S6, S7).

All of these are built-in Spark expressions, so they run inside
whole-stage codegen on the executors; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
#
# English stopword list (179 words), in the reference's order.  Words with an
# apostrophe can never match: punctuation is deleted before the lookup, so
# "don't" arrives as "dont".  They stay in the list to keep it identical.
STOPWORDS: tuple[str, ...] = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll", "you'd", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it",
    "it's", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this",
    "that", "that'll", "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has",
    "had", "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as",
    "until", "while", "of", "at", "by", "for", "with", "about", "against", "between", "into", "through", "during",
    "before", "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each",
    "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too",
    "very", "s", "t", "can", "will", "just", "don", "don't", "should", "should've", "now", "d", "ll", "m", "o", "re",
    "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't",
    "hasn", "hasn't", "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn",
    "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't",
    "wouldn", "wouldn't",
)

# The whitespace set of Python's str.split() / re "\s" (29 code points),
# written out so Java regex (Spark) and RE2 (DuckDB) agree with it.
WHITESPACE_CLASS = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# Characters deleted before splitting: everything that is neither a word
# character (letter, number, underscore) nor whitespace.
NON_WORD_PATTERN = r"[^\p{L}\p{N}_" + WHITESPACE_CLASS + r"]"
SPLIT_PATTERN = r"[" + WHITESPACE_CLASS + r"]+"
# After the deletion above, every remaining non-word character is
# whitespace, so splitting on runs of non-word characters is the same split
# with a much cheaper character class.
WORD_BREAK_PATTERN = r"[^\p{L}\p{N}_]+"
# The deleted class as Java tests it fastest: the common characters, listed one by one, are looked up in a table
# before any Unicode category, and a run of characters is one match.
DROP_RUN_PATTERN = r"[^ abcdefghijklmnopqrstuvwxyz0123456789_\p{L}\p{N}" + WHITESPACE_CLASS + r"]+"

# Mis-encoded quote and dash residues and their replacements.
FUNNY_TOKENS = (
    ("xe2x80x9c", " "),
    ("xe2x80x9d", " "),
    ("xe2x80x94", " "),
    ("xe2x80x99", "'"),
    ("xe2x80x98", "'"),
)
# Licence boilerplate markers (T8): text outside START/END marker lines is cut.
BOILERPLATE_START = r"\*\*\* ?START OF (THE|THIS) PROJECT GUTENBERG EBOOK[^*]*\*\*\*"
BOILERPLATE_END = r"\*\*\* ?END OF (THE|THIS) PROJECT GUTENBERG EBOOK[^*]*\*\*\*"
# ---------------------------------------------------------------------------


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_for_terms(text: str | Column) -> Column:
    """T1 first half: lowercase, then delete every non-word, non-space char."""
    return F.regexp_replace(F.lower(_col(text)), DROP_RUN_PATTERN, "")


def raw_tokens(text: str | Column) -> Column:
    """T1 split: whitespace split of the normalised text (no empty tokens)."""
    toks = F.split(normalize_for_terms(text), WORD_BREAK_PATTERN)
    return F.filter(toks, lambda t: t != "")


def tokens(text: str | Column) -> Column:
    """Tokens in order, stopwords removed (duplicates kept).

    The stopword test compiles to a hash-set lookup (InSet) inside codegen.
    """
    stop = list(STOPWORDS)
    toks = F.split(normalize_for_terms(text), WORD_BREAK_PATTERN)
    return F.filter(toks, lambda t: (t != "") & ~t.isin(stop))


def term_set(text: str | Column) -> Column:
    """The document's distinct terms as array<string>, first-seen order.

    Line-by-line tokenisation followed by a set union gives the same set as
    one pass over the whole text, because the line break is whitespace.
    ``array_except(tokens, ['', stopwords...])`` removes empty tokens and
    stopwords and de-duplicates in one code-generated expression (a lambda
    ``filter`` would force the whole projection out of whole-stage codegen).
    """
    toks = F.split(normalize_for_terms(text), WORD_BREAK_PATTERN)
    drop = F.array(*[F.lit(w) for w in ("",) + STOPWORDS])
    return F.array_except(toks, drop)


def term_weight(terms: str | Column) -> Column:
    """T4: W = number of distinct non-stopword terms (bigint)."""
    return F.size(_col(terms)).cast("bigint")


def normalize_whitespace(text: str | Column) -> Column:
    """T5: collapse every whitespace run to one space and trim."""
    return F.trim(F.regexp_replace(_col(text), SPLIT_PATTERN, " "), F.lit(" "))


def strip_escape_residue(text: str | Column) -> Column:
    r"""Drop backslashes and an n/r/t that directly follows one.

    The reference loop also loses the last character of the text; that is
    an indexing slip and is not reproduced.
    """
    return F.regexp_replace(_col(text), r"\\[nrt]?", "")


def replace_funny_tokens(text: str | Column) -> Column:
    """Replace mis-encoded quote/dash residues, then re-join on spaces."""
    out = _col(text)
    for bad, good in FUNNY_TOKENS:
        out = F.replace(out, F.lit(bad), F.lit(good))
    return normalize_whitespace(out)


def strip_boilerplate(text: str | Column) -> Column:
    """Keep only the part between START and END licence markers.

    Texts without markers are returned unchanged.
    """
    t = _col(text)
    after_start = F.when(
        F.regexp_instr(t, F.lit(BOILERPLATE_START)) > 0,
        F.regexp_replace(t, r"(?s)^.*?" + BOILERPLATE_START, ""),
    ).otherwise(t)
    return F.when(
        F.regexp_instr(after_start, F.lit(BOILERPLATE_END)) > 0,
        F.regexp_replace(after_start, r"(?s)" + BOILERPLATE_END + r".*$", ""),
    ).otherwise(after_start)


def clean_text(text: str | Column) -> Column:
    """P7 cleaning chain: boilerplate, whitespace, escape residue, funny tokens."""
    return replace_funny_tokens(strip_escape_residue(normalize_whitespace(strip_boilerplate(text))))


def basename(path: str | Column) -> Column:
    """Last path component."""
    return F.regexp_extract(_col(path), r"([^/]*)$", 1)


def query_hash(text: str | Column) -> Column:
    """First 8 hex digits of the MD5 of the UTF-8 text."""
    return F.substring(F.md5(_col(text).cast("binary")), 1, 8)


def escape_tabs_newlines(text: str | Column) -> Column:
    """Tab, newline and carriage return each become a space."""
    return F.translate(_col(text), "\t\n\r", "   ")


def book_id_from_link(link: str | Column) -> Column:
    """Integer after the last '/' of a link."""
    return F.element_at(F.split(_col(link), "/"), -1).try_cast("int")


def file_id(row_index: str | Column) -> Column:
    """Zero-padded 1-based file name, e.g. 0 -> '00001.txt'."""
    return F.format_string("%05d.txt", (_col(row_index) + 1).cast("bigint"))

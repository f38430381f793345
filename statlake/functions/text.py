"""Text work on article bodies: cleaning, chunking, question intent, comparison."""

from __future__ import annotations

import re
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

# ---------------------------------------------------------------- cleaning

# The cleaning rules in order. They stay within the syntax that Java
# and RE2 read alike (no lookaround, no back-references).
BLANKS = "[ \\t\\n\\x0B\\f\\r\\xA0]+"
CLEAN_RULES = [
    ("(?s)<!--.*?-->", " "),
    ("(?is)<script[^>]*>.*?</script[^>]*>", " "),
    ("(?is)<style[^>]*>.*?</style[^>]*>", " "),
    ("(?s)<[^>]*>", " "),
    ("&nbsp;?", " "),
    ("&lt;?", "<"),
    ("&gt;?", ">"),
    ("&quot;?", '"'),
    ("&#39;|&apos;", "'"),
    ("&copy;?", "\u00a9"),
    ("&reg;?", "\u00ae"),
    ("&middot;?", "\u00b7"),
    ("&ndash;", "\u2013"),
    ("&mdash;", "\u2014"),
    ("&lsquo;", "\u2018"),
    ("&rsquo;|&#8217;", "\u2019"),
    ("&ldquo;", "\u201c"),
    ("&rdquo;", "\u201d"),
    ("&hellip;", "\u2026"),
    ("&amp;?", "&"),
    (BLANKS, " "),
]


def clean_html(text: Column) -> Column:
    """Visible text of HTML: tags become one space, blanks collapse. NULL stays NULL.

    Built-in expressions only; entities beyond the listed ones stay as they are.
    """
    return F.trim(reduce(
        lambda c, rule: F.regexp_replace(c, F.lit(rule[0]), F.lit(rule[1])), CLEAN_RULES, text))


class _Visible(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden and data.strip():
            self.parts.append(data.strip())


@F.pandas_udf(StringType())
def clean_html_strict(text: pd.Series) -> pd.Series:
    """Like ``clean_html`` with a real parser: every entity, broken markup."""
    def visible(html):
        if html is None:
            return None
        parser = _Visible()
        parser.feed(html)
        parser.close()
        return re.sub(r"\s+", " ", " ".join(parser.parts)).strip()

    return text.map(visible)


# ---------------------------------------------------------------- chunking

# From coarse to fine; what none of them cuts is cut into characters.
SEPARATORS = ("\n\n", "\n", " ")
# White space as a class that Java and RE2 read alike.
WHITE = "\\x09-\\x0D\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
# A sentence and the white space behind it.
SENTENCE = f"(?s)[^{WHITE}].*?(?:[.!?]+[{WHITE}]+|\\z)"


def stripped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, f"^[{WHITE}]+", ""), f"[{WHITE}]+$", "")


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def cut_behind(text: Column, separator: str) -> Column:
    """Pieces that end with the separator; the last one need not."""
    def pieces(parts: Column) -> Column:
        whole = F.transform(parts, lambda p, i: F.when(
            i < F.size(parts) - 1, F.concat(p, F.lit(separator))).otherwise(p))
        return F.filter(whole, lambda p: p != "")

    return bound(F.split(text, separator, -1), pieces)


def atoms(text: Column, size: int, separators: tuple[str, ...] = SEPARATORS) -> Column:
    """The text as pieces of at most ``size`` characters, cut behind the coarsest separator.

    A piece without the separator is handed on whole to the next finer one.
    """
    if separators:
        finer = F.flatten(F.transform(cut_behind(text, separators[0]), lambda p: atoms(p, size, separators[1:])))
    else:
        finer = F.regexp_extract_all(text, F.lit("(?s)."), 0)
    return F.when(text == "", F.array().cast("array<string>")).when(
        F.length(text) <= size, F.array(text)).otherwise(finer)


def packed(pieces: Column, weight, size: int, overlap: int) -> Column:
    """Runs of pieces of at most ``size``, each joined to one text.

    A fold over the pieces' numbers that carries where the open run begins and its weight.
    Where a piece doesn't fit, the run is closed and the next one begins with the trailing
    pieces that weigh at most ``overlap`` and leave room for the piece.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than the chunk size")

    def state(runs: Column, first: Column, load: Column) -> Column:
        return F.struct(runs.alias("runs"), first.alias("first"), load.alias("load"))

    def run(first: Column, end: Column) -> Column:
        return F.array(F.struct(first.alias("first"), end.alias("end")))

    def back(weights: Column, first: Column, end: Column, most: Column) -> Column:
        """Where the trailing pieces begin that weigh at most ``most``, and their weight."""
        def step(a: Column, k: Column) -> Column:
            fits = (a["at"] == k + 1) & (a["load"] + F.get(weights, k) <= most)
            return F.when(fits, F.struct(k.alias("at"), (a["load"] + F.get(weights, k)).alias("load"))).otherwise(a)

        return F.aggregate(F.sequence(end - 1, first, F.lit(-1)), F.struct(end.alias("at"), F.lit(0).alias("load")), step)

    def runs_of(weights: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            w = F.get(weights, i)
            close = bound(back(weights, a["first"], i, F.least(F.lit(overlap), size - w)), lambda t: state(
                F.concat(a["runs"], run(a["first"], i)), t["at"], t["load"] + w))
            return F.when((a["load"] + w > size) & (i > a["first"]), close).otherwise(
                state(a["runs"], a["first"], a["load"] + w))

        none = F.array().cast("array<struct<first:int,end:int>>")
        n = F.size(weights)
        return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), n - 1), state(none, F.lit(0), F.lit(0)), step,
                                         lambda a: F.concat(a["runs"], run(a["first"], n)))).otherwise(none)

    def texts(p: Column) -> Column:
        runs = bound(F.transform(p, lambda s: weight(s).cast("int")), runs_of)
        return F.transform(runs, lambda r: stripped(F.array_join(F.transform(
            F.sequence(r["first"], r["end"] - 1), lambda k: F.get(p, k)), "")))

    return F.filter(bound(pieces, texts), lambda c: c != "")


def recursive_chunks(text: Column, size: int, overlap: int) -> Column:
    return packed(atoms(text, size), F.length, size, overlap)


def sentence_chunks(text: Column, size: int, overlap: int) -> Column:
    """Whole sentences packed up to ``size`` words; a longer sentence stays whole."""
    words = lambda s: F.regexp_count(s, F.lit(f"[^{WHITE}]+"))
    return packed(F.regexp_extract_all(text, F.lit(SENTENCE), 0), words, size, overlap)


def token_chunks(text: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` words that advance by ``size - overlap``."""
    def windows(words: Column) -> Column:
        starts = F.sequence(
            F.lit(0), F.greatest(F.size(words) - overlap - 1, F.lit(0)), F.lit(size - overlap))
        return F.when(F.size(words) > 0, F.transform(
            starts, lambda s: F.array_join(F.slice(words, s + 1, size), " ")))

    # The outer transform binds the split words once; inlined, every window would
    # split the whole text again.
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    return F.get(F.transform(F.array(words), windows), F.lit(0))


def chunk(df: DataFrame, text_col: str, strategy: str, size: int = 350, overlap: int = 75,
          separator: str = "\n\n") -> DataFrame:
    """One row per chunk with ``chunk_index`` and ``chunk_text``; a map-only step.

    All strategies are built-in expressions.
    """
    text = F.col(text_col)
    if strategy == "paragraphs":
        pieces = F.split(text, re.escape(separator))
    elif strategy == "tokens":
        pieces = token_chunks(text, size, overlap)
    elif strategy == "recursive":
        pieces = recursive_chunks(text, size, overlap)
    elif strategy == "sentences":
        pieces = sentence_chunks(text, size, overlap)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return df.select("*", F.posexplode(pieces).alias("chunk_index", "chunk_text"))


# ---------------------------------------------------------------- questions

# Chart words in order of precedence, change words, wish words.
CHART_TYPES = [
    ("bar", ("bar chart", "bar graph")),
    ("line", ("line chart", "line graph")),
    ("pie", ("pie chart",)),
    ("scatter", ("scatter",)),
]
CHANGE_WORDS = ("make", "change", "convert", "switch", "show as", "display as")
WISH_WORDS = ("show", "plot", "chart", "graph", "visualize", "display")


def _mentions(text: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def chart_intent(question: Column, has_previous: Column) -> dict[str, Column]:
    """``is_change``, ``wants_chart`` and ``chart_type`` of a question.

    A change of an existing result always wants a chart; a question that names no
    type falls back to the bare word "bar", then to a line.
    """
    text = F.lower(question)
    named = reduce(
        lambda c, rule: c.when(_mentions(text, rule[1]), rule[0]),
        CHART_TYPES[1:], F.when(_mentions(text, CHART_TYPES[0][1]), CHART_TYPES[0][0]))
    change = _mentions(text, CHANGE_WORDS) & named.isNotNull()
    wants = (change & has_previous) | _mentions(text, WISH_WORDS)
    guessed = F.when(wants & text.contains("bar"), "bar").otherwise("line")
    return {
        "is_change": change,
        "wants_chart": wants,
        "chart_type": F.coalesce(named, guessed),
    }


# ---------------------------------------------------------------- comparison


def word_set(text: Column) -> Column:
    """Distinct lower-case words of the whole text."""
    return F.array_distinct(F.filter(F.split(F.lower(text), BLANKS), lambda w: w != ""))


def compare_words(a: Column, b: Column) -> dict[str, Column]:
    """Shared and one-sided word counts of two ``word_set`` columns, and Jaccard."""
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - shared
    return {
        "n_shared": shared,
        "n_left_only": F.size(a) - shared,
        "n_right_only": F.size(b) - shared,
        "jaccard": F.coalesce(
            F.try_divide(shared.cast("double"), either.cast("double")), F.lit(0.0)),
    }

"""Line-first quality rules (operator 12).

Every line is judged by itself: a line without any sentence mark, a menu and site boilerplate fail and leave the text. A
document is rejected if it is too short or repeats itself, or if its lines lost more than a share of its words' characters.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hourline.llm.common import add_columns
from hourline.llm.wordnames import WORD, number_words, repeated

LEAST_WORDS, WINDOW, MOST_REPEATED = 10, 5, 20
#: Percent of the words' characters that lines may take with them.
MOST_LOST = 30
SYMBOLS = "#*$%&|<>"
#: A line is no prose with more than so many symbols, or separators alone between white space, to 100 words.
MOST_SYMBOLS, MOST_SEPARATORS = 50, 15
SENTENCE_END = r"""[.!?…。！？][)"'”’»\]]*([\x20\x09-\x0D]|$)"""
SEPARATOR = r"[|>»›•·/→]+"
#: Phrases of site furniture; they count in lines of BOILERPLATE_WORDS words at most.
BOILERPLATE = [
    "accept cookies", "all rights reserved", "click here", "cookie policy", "enable javascript", "forgot your password", "log in to your account",
    "lorem ipsum", "powered by", "privacy policy", "read more", "share this", "sign up for", "skip to content", "subscribe to our newsletter",
    "terms and conditions", "terms of service", "terms of use", "use of cookies",
]
BOILERPLATE_WORDS = 25
_end, _separator, _furniture = re.compile(SENTENCE_END), re.compile(SEPARATOR), re.compile("|".join(BOILERPLATE))
_lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def line_fault(line: str, words: list[str]) -> str | None:
    """The rule that a line with words breaks, the first of: navigation, boilerplate, punctuation."""
    n = len(words)
    if 100 * sum(map(bool, map(_separator.fullmatch, words))) > MOST_SEPARATORS * n:
        return "navigation"
    if n <= BOILERPLATE_WORDS and _furniture.search(line.translate(_lower)):
        return "boilerplate"
    if not _end.search(line) or 100 * sum(map(line.count, SYMBOLS)) > MOST_SYMBOLS * n:
        return "punctuation"
    return None


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "navigation", "boilerplate", "punctuation", "lost_chars"]
FIELDS = [
    *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
    T.StructField("cleaned", T.StringType()),
]


def judge(text: str | None) -> tuple:
    """The values of FIELDS for a text."""
    text = text or ""
    words = WORD.findall(text)
    chars, faults, seen, kept = len("".join(words)), dict.fromkeys(("navigation", "boilerplate", "punctuation"), 0), set(), []
    again = lost = 0
    for line in text.split("\n"):
        own = WORD.findall(line)
        fault = line_fault(line, own) if own else None
        if own:
            again += line in seen
            seen.add(line)
        if fault:
            faults[fault] += 1
            lost += len("".join(own))
        else:
            kept.append(line)
    n_repeat = int(repeated(number_words(words), WINDOW).sum())
    failed = len(words) < LEAST_WORDS or 100 * n_repeat > MOST_REPEATED * len(words)
    counts = (len(words), chars, sum(map(text.count, SYMBOLS)), again, n_repeat, *faults.values(), lost)
    return (*counts, failed, not failed and 100 * lost <= MOST_LOST * chars, "\n".join(kept))


def clean_lines(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """All columns and those of FIELDS: counts of words and of lines that broke each rule, ``lost_chars`` that they took,
    ``base_failed``, ``kept`` and ``cleaned``, the text without them.

    Null texts are empty, and an empty text fails. Lines without a word break no rule and are no copies. Input columns
    that have such a name are replaced.
    """

    def make():
        return lambda texts: list(zip(*map(judge, texts))) or [[] for _ in FIELDS]

    return add_columns(docs, text, FIELDS, make, keep_text)

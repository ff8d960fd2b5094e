"""Text cleaning, tokenising and keyword matching as native Column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a link, a tag, blank space, a word and a token.
# The classes are spelled out because Java's \w and \s are narrower than the
# Unicode word and space classes the cleaning rules are defined with.
LINK = r"(?U)(?:http|www)[^\s\x1c-\x1f]+"
TAG = r"[@#][\p{L}\p{N}_]+"
BLANKS = r"(?U)[\s\x1c-\x1f]+"
WORD_CHAR = r"\p{L}\p{N}_"
TOKEN = r"[a-z\p{L}]+(?:'[a-z\p{L}]+)*|!"
APOSTROPHE = "\u2019"  # as typed on most phones; the same as '


def remove_links(text: Column) -> Column:
    """Drop every link. The substring test spares link-free rows the regex."""
    has_link = F.contains(text, F.lit("http")) | F.contains(text, F.lit("www"))
    return F.when(has_link, F.regexp_replace(text, LINK, "")).otherwise(text)


def _has_tag(text: Column) -> Column:
    return F.contains(text, F.lit("@")) | F.contains(text, F.lit("#"))


def collapse_blanks(text: Column) -> Column:
    """One space for every run of blank characters, none at either end."""
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def strip_markup(text: Column) -> Column:
    """Links first, then tags: the part of cleaning that can change tokens.

    Tags are looked for in the text as it came, since removing links adds none;
    so each row goes through each regex once at most.
    """
    linkless = remove_links(text)
    return F.when(_has_tag(text), F.regexp_replace(linkless, TAG, "")).otherwise(linkless)


def clean_text(text: Column) -> Column:
    """The whole cleaning rule: no links, no tags, single spaces."""
    return collapse_blanks(strip_markup(text))


def tokens(text: Column) -> Column:
    """Lower-case words and exclamation marks of ``text`` in order.

    No token contains a blank, so ``tokens(strip_markup(t))`` equals
    ``tokens(clean_text(t))`` and scoring can leave out the blank collapse.
    """
    # ``replace`` searches bytes; ``translate`` would look up every character.
    lowered = F.replace(F.lower(text), F.lit(APOSTROPHE), F.lit("'"))
    # Without an apostrophe, splitting gives the same tokens for less.
    spaced = F.replace(lowered, F.lit("!"), F.lit(" ! "))
    return F.when(
        F.contains(lowered, F.lit("'")), F.regexp_extract_all(lowered, F.lit(TOKEN), F.lit(0))
    ).otherwise(F.array_remove(F.split(spaced, r"[^\p{L}!]+"), ""))


def any_keyword(text: Column, keywords: Sequence[str]) -> Column:
    """True where any keyword occurs as a whole token, compared in lower case.

    A keyword of several words needs each of its words somewhere in the text.
    All one-word keywords share a single pass over the text.
    """
    split = [k.lower().split() for k in keywords if k.split()]
    if not split:
        raise ValueError("at least one keyword is needed")
    lowered = F.lower(text)
    singles = sorted({words[0] for words in split if len(words) == 1})
    tests = [_whole_token(lowered, singles)] if singles else []
    for words in split:
        if len(words) > 1:
            tests.append(reduce(and_, [_whole_token(lowered, [w]) for w in words]))
    return reduce(or_, tests)


def _whole_token(text: Column, words: Sequence[str]) -> Column:
    """The substring test comes first: texts without the word skip the regex."""
    present = reduce(or_, [F.contains(text, F.lit(w)) for w in words])
    options = "|".join(re.escape(w) for w in words)
    bounded = f"(?:^|[^{WORD_CHAR}])(?:{options})(?:[^{WORD_CHAR}]|$)"
    return present & F.rlike(text, F.lit(bounded))


def search_expression(keywords: Sequence[str]) -> str:
    """The keywords as one search string, as a search service takes them."""
    return " OR ".join(keywords)

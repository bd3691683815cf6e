"""Tokenising text with built-in expressions, and the stop-word lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.functions.scalars import BLANK_CLASS

PUNCTUATION = rf"[^\p{{L}}\p{{N}}_{BLANK_CLASS}]"
BLANK_RUN = rf"[{BLANK_CLASS}]+"

# Default stop words. Contractions cannot match once punctuation
# is deleted; they stay so that the list is complete.
STOP_WORDS = (
    "a about above after again against all am an and any are aren't as at be because been before "
    "being below between both but by can't cannot could couldn't did didn't do does doesn't doing "
    "don't down during each few for from further had hadn't has hasn't have haven't having he he'd "
    "he'll he's her here here's hers herself him himself his how how's i i'd i'll i'm i've if in "
    "into is isn't it it's its itself let's me more most mustn't my myself no nor not of off on "
    "once only or other ought our ours ourselves out over own same shan't she she'd she'll she's "
    "should shouldn't so some such than that that's the their theirs them themselves then there "
    "there's these they they'd they'll they're they've this those through to too under until up "
    "very was wasn't we we'd we'll we're we've were weren't what what's when when's where where's "
    "which while who who's whom why why's with won't would wouldn't you you'd you'll you're you've "
    "your yours yourself yourselves inc com www"
).split()

# Words the extended list adds to the default one.
DOMAIN_STOP_WORDS = (
    "jan feb mar apr may jun jul aug sep oct nov dec vehicle car truck suv van"
).split()

# The shorter list, without contractions.
SHORT_STOP_WORDS = (
    "a about above after again against all am an and any are as at be because been before being "
    "below between both but by can could did do does doing down during each few for from had has "
    "have having he her here hers herself him himself his how i if in into is it its itself me more "
    "most my myself no nor not of off on once only or other our ours out over own same she so some "
    "such than that the their theirs them then there these they this those through to too under "
    "until up very was we were what when where which while who why with would you your yours"
).split()

# The shortest list.
MINIMAL_STOP_WORDS = "and the is in it to for with on at from by an a of".split()

STOP_LISTS = {
    "default": STOP_WORDS,
    "domain": STOP_WORDS + DOMAIN_STOP_WORDS,
    "short": SHORT_STOP_WORDS,
    "minimal": MINIMAL_STOP_WORDS,
    "none": [],
}


def raw_words(text: Column, punct: str = "") -> Column:
    """Lower-case words of ``text``, punctuation replaced by ``punct``; may hold ''."""
    return F.split(F.regexp_replace(F.lower(text), PUNCTUATION, punct), BLANK_RUN)


def keep_word(word: Column, stop: Iterable[str] = STOP_WORDS, min_len: int = 3) -> Column:
    """Whether ``word`` is long enough and no stop word (a hash-set lookup)."""
    keep = F.length(word) >= max(min_len, 1)
    stop = list(stop)
    return keep & ~word.isin(stop) if stop else keep


def tokens(
    text: Column, stop: Iterable[str] = STOP_WORDS, min_len: int = 3, punct: str = ""
) -> Column:
    """Array of the kept words, in order and with repeats; null text gives []."""
    stop = list(stop)
    words = F.filter(raw_words(text, punct), lambda word: keep_word(word, stop, min_len))
    return F.coalesce(words, F.array().cast("array<string>"))

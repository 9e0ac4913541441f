"""English stems: the five steps that M. F. Porter published in 1980 ("An algorithm for suffix stripping").

A stem is measured by how often a vowel run is followed by a consonant run in it; rules strip or replace an ending where
the stem that is left is long enough by that measure.
"""

from __future__ import annotations

import functools
import re

# Fixed values of the published algorithm: endings, what they become, in the order in which they are tried.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
STEP_3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def shape(word: str) -> str:
    """v for a vowel and c for a consonant at each place; y is a vowel after a consonant."""
    out = ""
    for at, letter in enumerate(word):
        out += "v" if letter in "aeiou" or (letter == "y" and at and out[-1] == "c") else "c"
    return out


def measure(stem: str) -> int:
    return len(re.findall("v+c+", shape(stem)))


def short_end(stem: str) -> bool:
    """consonant, vowel, consonant at the end, the last one not w, x or y."""
    return shape(stem).endswith("cvc") and stem[-1] not in "wxy"


def longest(word: str, endings) -> str | None:
    return max((e for e in endings if word.endswith(e)), key=len, default=None)


def replaced(word: str, rules) -> str:
    table = dict(rules)
    end = longest(word, table)
    return word if end is None or measure(word[: -len(end)]) == 0 else word[: -len(end)] + table[end]


@functools.lru_cache(200_000)
def stem(word: str) -> str:
    """The stem of a word in lower case. Words of one or two letters, and those with other signs than a to z, stay as they are."""
    if len(word) < 3 or not re.fullmatch("[a-z]+", word):
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    cut = None
    if word.endswith("eed"):
        word = word[:-1] if measure(word[:-3]) else word
    elif (end := longest(word, ("ed", "ing"))) and "v" in shape(word[: -len(end)]):
        cut = word[: -len(end)]
    if cut is not None:
        if cut.endswith(("at", "bl", "iz")):
            word = cut + "e"
        elif len(cut) > 1 and cut[-1] == cut[-2] and shape(cut)[-1] == "c" and cut[-1] not in "lsz":
            word = cut[:-1]
        else:
            word = cut + "e" if measure(cut) == 1 and short_end(cut) else cut
    if word.endswith("y") and "v" in shape(word[:-1]):
        word = word[:-1] + "i"
    word = replaced(replaced(word, STEP_2), STEP_3)
    if (end := longest(word, STEP_4)) and measure(left := word[: -len(end)]) > 1 and (end != "ion" or left.endswith(("s", "t"))):
        word = left
    if word.endswith("e") and ((m := measure(word[:-1])) > 1 or (m == 1 and not short_end(word[:-1]))):
        word = word[:-1]
    return word[:-1] if word.endswith("ll") and measure(word) > 1 else word

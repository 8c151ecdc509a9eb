"""Label derivation: 0 is cat, 1 is dog, -1 is undecided."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

# The words looked for as substrings.
CAT_WORDS = ("cat", "kitten", "feline")
DOG_WORDS = ("dog", "puppy", "canine")


def _words_present(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(add, [F.contains(text, F.lit(w)).cast("int") for w in words])


def tag_label(tags: Column) -> Column:
    """Side with more of its words present wins; a tie, an empty or NULL text gives -1."""
    text = F.lower(F.coalesce(tags, F.lit("")))
    cats, dogs = _words_present(text, CAT_WORDS), _words_present(text, DOG_WORDS)
    return F.when(cats > dogs, 0).when(dogs > cats, 1).otherwise(-1)


def assigned_label(url: Column, keyword: Column | None = None, seed: int = 42) -> Column:
    """Label from the keyword, else from the URL, else a reproducible coin toss on the URL."""
    word = F.lower(F.coalesce(keyword, F.lit(""))) if keyword is not None else F.lit("")
    link = F.lower(F.coalesce(url, F.lit("")))
    first_digit = F.substring(F.md5(F.concat(link, F.lit(f"|{seed}"))), 1, 1)
    coin = F.contains(F.lit("13579bdf"), first_digit).cast("int")
    return (
        F.when(F.contains(word, F.lit("cat")), 0)
        .when(F.contains(word, F.lit("dog")), 1)
        .when(F.contains(link, F.lit("cat")), 0)
        .when(F.contains(link, F.lit("dog")), 1)
        .otherwise(coin)
    )


def effective_label(label: Column, url: Column, keyword: Column, seed: int = 42) -> Column:
    """The tag label unless it is undecided."""
    return F.when(label == -1, assigned_label(url, keyword, seed)).otherwise(label)

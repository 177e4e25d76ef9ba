"""A language scorer of built-in expressions: the share of a text's function words that are one language's own.

It stands in where documents bring no language of their own; another scorer is any function of a text column that gives
a struct of language and score.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as tx

#: Function words that tell these languages apart.
PROFILES = {
    "de": "der die das und nicht ist ein eine mit von zu den auf für sich dem auch werden bei".split(),
    "en": "the of and to in is that for it was with as on be by this are from or an".split(),
    "es": "el los las del que una por con para como más pero sus este entre cuando sin sobre también y".split(),
    "fr": "le les des est une dans qui pour pas sur au avec ce il sont par plus ou aux et".split(),
    "it": "il di che gli della per non sono con del una alla nel dei anche più delle è questo come".split(),
}
LEAST = 1  # function words, below which nothing is said


def language_of(text: Column) -> Column:
    """struct(language, score): the language with the most function words and its share of all of them; null and 0 without any.

    Ties go to the first name in order.
    """
    low = F.transform(tx.tokens(F.coalesce(text, F.lit(""))), lambda w: F.lower(w))

    def scored(words: Column) -> Column:
        own = lambda k: F.size(F.filter(words, lambda w: w.isin(*PROFILES[k])))
        hits = F.array(*[F.struct(own(k).alias("n"), F.lit(-i).alias("turn"), F.lit(k).alias("language")) for i, k in enumerate(sorted(PROFILES))])
        total = lambda h: F.aggregate(h, F.lit(0), lambda s, x: s + x["n"])
        best = lambda h: F.array_max(h)
        return tx.bound(hits, lambda h: F.struct(F.when(total(h) >= LEAST, best(h)["language"]).alias("language"), tx.per(best(h)["n"], total(h)).alias("score")))

    return tx.bound(low, scored)

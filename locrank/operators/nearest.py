"""For keys that a join loses: the nearest key of the other side by edit distance.

Two keys within the distance have a rest in common: what is left of each after leaving out up to
`distance` code points. Keys with a rest in common are at most twice the distance apart, so keys meet
few others however many there are and however alike they begin. A key of n code points has about
n ** distance rests.

Keys that would have too many are divided into grams of q code points. An edit changes at most q
grams, so of the q * distance + 1 rarest grams of two keys within the distance at least one is common
to both (prefix filter). Those with few different grams meet in their rests all the same. Keys that
meet differ in length by at most the distance and are verified by their edit distance.
"""

from functools import reduce
from itertools import count
from math import comb

from pyspark.sql import functions as F
from pyspark.sql import Window

from locrank.storage import keep

_PAD = "\x01"

# Rests that a name may have; longer names meet in their rarest grams.
MOST_RESTS = 256


def _grams(names, q):
    """name, gram for the different grams of distinct names, padded at both ends."""
    padded = F.concat(F.lit(_PAD * (q - 1)), F.col("name"), F.lit(_PAD * (q - 1)))
    starts = F.sequence(F.lit(1), F.char_length(padded) - q + 1)
    grams = F.array_distinct(F.transform(starts, lambda at: F.substring(padded, at, F.lit(q))))
    return names.select("name", F.size(grams).alias("size"), F.explode(grams).alias("gram"))


def _shortened(distance):
    """The names without up to `distance` code points."""

    def less(name):
        places = F.sequence(F.lit(1), F.char_length(name))
        size = F.char_length(name)
        one = F.transform(places, lambda at: F.concat(F.substring(name, F.lit(1), at - 1), F.substring(name, at + 1, size)))
        return F.when(F.char_length(name) > 0, one).otherwise(F.array(name))

    return reduce(
        lambda found, _: F.array_distinct(F.concat(found, F.flatten(F.transform(found, less)))), range(distance), F.array("name")
    )


def _longest(distance, most):
    """The most code points that a name with up to `most` rests has."""
    return next(n for n in count() if sum(comb(n + 1, k) for k in range(distance + 1)) > most)


def _signs(lost, known, distance, q):
    """sign, name, side: what the names of lost (side 0) and known (side 1) meet in.

    Names of up to `shortest` code points, and `distance` more, meet in their rests, names of more
    than `shortest` in their grams, so a pair of names meets in the one or the other.
    """
    shortest = _longest(distance, MOST_RESTS)
    long = F.char_length("name") > shortest
    both = lost.select("name", F.lit(0).alias("side")).unionAll(known.select("name", F.lit(1).alias("side")))
    names = keep(both.where("name is not null").distinct(), "near-names")
    grams = keep(_grams(names.where(long).select("name").distinct(), q).join(names, "name"), "near-grams")
    often = grams.groupBy("gram").agg(F.count("*").alias("n"))
    order = Window.partitionBy("name", "side").orderBy("n", "gram")
    ranked = grams.join(often, "gram").withColumn("rank", F.row_number().over(order))
    prefix = ranked.where((F.col("rank") <= q * distance + 1) & (F.col("size") > q * distance))
    # Names within the distance of one with few grams have few more.
    few = grams.where((F.col("size") <= 2 * q * distance) & (F.char_length("name") > shortest + distance))
    short = names.where(F.char_length("name") <= shortest + distance)
    whole = keep(few.select("name", "side").distinct(), "near-few").unionAll(short)
    # Hashes move; names that meet by a hash alone are too far apart. The seeds part rests from grams.
    rests = whole.select(F.explode(_shortened(distance)).alias("rest"), "name", "side")
    rests = rests.select(F.xxhash64(F.lit(0), "rest").alias("sign"), "name", "side")
    rare = prefix.select(F.xxhash64(F.lit(1), "gram").alias("sign"), "name", "side")
    # Kept, as Spark does not see before how many rests there are and would broadcast them by the names' size.
    return keep(rare.unionAll(rests), "near-signs")


def near_names(lost, known, distance=1, q=3):
    """name, near, distance for every name of lost(name) and known(name) at most `distance` edits apart.

    * Null names are near nothing, equal names are 0 apart; repeated names count once.
    * The empty name is a name like any other. Empty tables give no row.

    Grams are counted once over both sides; both sides of the join come straight from a shuffle, so
    Spark splits hot grams, of which the rarest come first in any case. No pair within the distance is
    left out, and no pairs are formed but those with a rest or a rare gram in common.
    """
    signs = _signs(lost, known, distance, q)
    a = signs.where("side = 0").select("sign", "name")
    b = signs.where("side = 1").select("sign", F.col("name").alias("near"))
    lengths = F.abs(F.char_length("name") - F.char_length("near")) <= distance
    apart = F.levenshtein("name", "near", distance)
    pairs = a.join(b, "sign").where(lengths & (apart >= 0)).select("name", "near", apart.alias("distance"))
    return pairs.distinct()


def nearest_names(lost, known, distance=1, q=3):
    """name, near, distance for every name of lost(name): its nearest name in known(name), the smallest
    of several; null where none is within the distance."""
    near = near_names(lost, known, distance, q)
    best = near.groupBy("name").agg(F.min(F.struct("distance", "near")).alias("best"))
    names = lost.select("name").distinct().join(best, "name", "left")
    return names.select("name", F.col("best.near").alias("near"), F.col("best.distance").alias("distance"))

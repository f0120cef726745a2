"""Generating and resolving matches: blocking lanes, pair features, exclusive assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import PLACEHOLDERS, normalise, tokens


#: Lanes of ``blocking_keys``.
LANES = ("name", "first", "sorted", "sound", "numbers", "letters", "grams", "postcode", "address")


def blocking_keys(name: Column, address: Column) -> dict[str, Column]:
    """Arrays of blocking keys of a normalised name and address, by lane: the name, its first token, its sorted tokens, how it sounds, its numbers, its first letters without blanks, its runs of four letters; the address's numbers of four to seven digits, and all of it."""
    words = tokens(name)
    joined = F.replace(name, F.lit(" "), F.lit(""))
    sound = F.array_join(F.transform(words, F.soundex), " ")
    numbers = F.array_join(F.array_sort(F.regexp_extract_all(name, F.lit("(\\d+)"))), " ")
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(joined) - 3, F.lit(1))), lambda k: F.substring(joined, k, F.lit(4)))
    one = {"name": name, "first": words[0], "sorted": F.array_join(F.array_sort(words), " "), "sound": sound, "numbers": numbers, "letters": F.substring(joined, 1, 6), "address": address}
    many = {"grams": F.array_distinct(grams), "postcode": F.array_distinct(F.regexp_extract_all(address, F.lit("(?<![0-9])([0-9]{4,7})(?![0-9])")))}
    return {k: F.array(v) for k, v in one.items()} | many


def _keyed(df: DataFrame, name: str, lanes: tuple[str, ...], nfkc: bool) -> DataFrame:
    """``name, country, lane, key``, and the address's different words."""
    address = F.col("business_address") if "business_address" in df.columns else F.lit("")
    rows = df.select(F.col("entity_id").alias(name), "country", normalise(F.col("business_name"), nfkc).alias("n"), normalise(address, nfkc).alias("a"))
    keys = blocking_keys(F.col("n"), F.col("a"))
    named = lambda lane: lambda key: F.struct(F.lit(lane).alias("lane"), key.alias("key"))
    lane = F.explode(F.flatten(F.array(*[F.transform(keys[k], named(k)) for k in lanes])))
    rows = rows.select(name, "country", F.array_distinct(F.filter(tokens(F.col("a")), lambda t: (t != "") & ~t.isin(*PLACEHOLDERS))).alias("words"), lane.alias("l"))
    return rows.select(name, "country", "words", "l.lane", "l.key").filter((F.col("key") != "") & F.col("key").isNotNull())


def block_sizes(left: DataFrame, right: DataFrame, lanes: tuple[str, ...] = ("name", "sorted"), nfkc: bool = True) -> DataFrame:
    """``country, lane, key, left_n, right_n, pairs`` of every block that has rows on both sides; counted by task before anything is dealt out."""
    count = lambda df, name, n: _keyed(df, name, lanes, nfkc).groupBy("country", "lane", "key").agg(F.count(F.lit(1)).alias(n))
    both = count(left, "s1_id", "left_n").join(count(right, "target_id", "right_n"), ["country", "lane", "key"])
    return both.withColumn("pairs", F.col("left_n") * F.col("right_n"))


def blocking_pairs(left: DataFrame, right: DataFrame, lanes: tuple[str, ...] = ("name", "sorted"), nfkc: bool = True, most_pairs: int | None = None) -> DataFrame:
    """``s1_id, target_id, lanes``: pairs of records of one country that share a lane's key; empty keys pair nothing. Each pair comes once with all lanes that found it.

    With ``most_pairs``, a block of more pairs pairs only records that share a
    word of their addresses too (placeholders don't count); ``block_sizes`` tells
    which blocks those are. Without, all pairs of every block come.
    """
    a, b = _keyed(left, "s1_id", lanes, nfkc), _keyed(right, "target_id", lanes, nfkc)
    block = ["country", "lane", "key"]
    if most_pairs is None:
        pairs = a.drop("words").join(b.drop("words"), block)
    else:
        crowded = block_sizes(left, right, lanes, nfkc).filter(F.col("pairs") > most_pairs).select(*block, F.lit(True).alias("crowded"))
        # Rows of a crowded block go under each word of their address, all others under none.
        words = F.when(F.col("crowded"), F.col("words")).otherwise(F.array(F.lit("")))
        split = lambda df, name: df.join(crowded, block, "left").select(name, *block, F.explode(words).alias("word"))
        pairs = split(a, "s1_id").join(split(b, "target_id"), [*block, "word"])
    return pairs.groupBy("s1_id", "target_id").agg(F.array_join(F.array_sort(F.collect_set("lane")), ",").alias("lanes"))


def pair_features(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` with the Jaccard overlap of the tokens of columns ``a`` and ``b``, and their edit distance over the longer length. Placeholder tokens are left out."""
    words = lambda c: F.array_distinct(F.filter(tokens(F.col(c)), lambda t: (t != "") & ~t.isin(*PLACEHOLDERS)))
    both, either = F.size(F.array_intersect(words(a), words(b))), F.size(F.array_union(words(a), words(b)))
    longest = F.greatest(F.char_length(a), F.char_length(b))
    return pairs.withColumn("jaccard", F.when(either > 0, both / either).otherwise(0.0)).withColumn("edit_distance", F.when(longest > 0, F.levenshtein(a, b) / longest).otherwise(0.0))


def tfidf_cosine(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """``s1_id, target_id, cosine`` of the texts of both records by term counts times log((1 + n) / (1 + records with the term)) + 1.

    ``left`` and ``right`` have ``id, text`` (normalised). Only terms that both
    records of a pair share are joined; pairs without any have 0.
    """
    rows = left.select("id", "text").unionByName(right.select("id", "text"))
    terms = rows.select("id", F.explode(tokens(F.col("text"))).alias("term")).filter(F.col("term") != "").groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))
    n = rows.agg(F.count(F.lit(1)).alias("n"))
    idf = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")).crossJoin(F.broadcast(n)).select("term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))
    weights = terms.join(idf, "term").select("id", "term", (F.col("tf") * F.col("idf")).alias("w"))
    norms = weights.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    unit = weights.join(norms, "id").select("id", "term", (F.col("w") / F.col("norm")).alias("w"))
    a = pairs.select("s1_id", "target_id").join(unit.select(F.col("id").alias("s1_id"), "term", F.col("w").alias("wa")), "s1_id")
    dots = a.join(unit.select(F.col("id").alias("target_id"), "term", F.col("w").alias("wb")), ["target_id", "term"]).groupBy("s1_id", "target_id").agg(F.sum(F.col("wa") * F.col("wb")).alias("cosine"))
    return pairs.select("s1_id", "target_id").join(dots, ["s1_id", "target_id"], "left").select("s1_id", "target_id", F.coalesce("cosine", F.lit(0.0)).alias("cosine"))


def exclusive_assignment(scored: DataFrame) -> DataFrame:
    """The best pair of each target by ``score``, ties to the smaller entity id: no target is given away twice."""
    best = F.struct((-F.col("score")).alias("s"), F.col("s1_id").alias("i"))
    return scored.groupBy("target_id").agg(F.min(best).alias("b")).select(F.col("b.i").alias("s1_id"), "target_id", (-F.col("b.s")).alias("score"))


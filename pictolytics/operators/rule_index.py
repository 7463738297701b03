"""Literal rules from a table of any size, found by an index of anchors.

A value may begin and end inside words. Its white space parts it: what lies between two white spaces is a whole
word of any text that holds the value, the first part ends a word and the last one begins one, and a value
without white space lies within a word. A value with two neighbouring parts or more is known by the q-grams at the place
where two of them meet, hashed; of its pairs the one that fewest values share, the longest of these, is its
anchor. Texts are joined with the anchors by the hashes of their neighbouring words' ends, of a length that occurs, so
that the index is as large as the rules, however many words the texts have. For values with a single part, what it
can stand for is looked up among the different words of the corpus, also by q-grams, and the part whose words are rarest
is the anchor, joined by the hashes of words. What is joined is verified by ``contains``: the time depends on the texts and
on what they hold, hardly on the number of rules.

``rule_index`` looks word pairs up in the corpus as well, and takes the rarest.

Most hashes of a text belong to no anchor. They are dropped where they are made, by a bitmap whose size follows
the number of anchors up to a fixed bound; beyond it more of them pass, to be dropped by the join.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pictolytics.session import stored

#: Characters of a q-gram. Shorter parts are their own q-gram.
SIZE = 4
#: Bits of a bitmap for each hash, and its greatest number of 64-bit words (8 MB).
BITS_EACH = 16
MOST_WORDS = 1 << 20
#: A rule index of more bytes is not held by every task.
HELD_BYTES = 16 << 20
#: Of a hash and a rule in that index.
ROW_BYTES = 40
#: A word that every text has, for values without any word.
EVERYWHERE = ""


def _split(text: Column) -> Column:
    return F.split(text, r"\s+", -1)


def _cut(posts: DataFrame, text: str, *kept: str, gaps: bool = False) -> DataFrame:
    """``kept`` and, for each word of the texts, its place ``at``, ``left`` and the right neighbour ``right``, null for the last word.

    With ``gaps`` also the white space ``gap`` between the two.

    No lambda takes part, so that Spark compiles all of it into the loop over the words, where a text is no more than
    a reference. Outer, so that no filter on the words is made up and pushed below, which would cut every text twice.
    """
    between = [F.regexp_extract_all(F.col(text), F.lit(r"\s+"), F.lit(0)).alias("_gaps")] if gaps else []
    cut = posts.select(*kept, _split(F.col(text)).alias("_words"), *between)
    words = cut.select(*kept, *cut.columns[len(kept) :], F.posexplode_outer("_words").alias("at", "left"))
    gap = [F.get("_gaps", F.col("at")).alias("gap")] if gaps else []
    return words.select(*kept, "at", "left", F.get("_words", F.col("at") + 1).alias("right"), *gap)


def _grams(word: Column, size: int) -> Column:
    """All pieces of ``size`` characters."""
    return F.array_distinct(F.regexp_extract_all(word, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def _place(h: Column, words: int) -> Column:
    return F.pmod(h, F.lit(words)).cast("int")


def _bit(h: Column) -> Column:
    return F.shiftright(h, 40).bitwiseAND(F.lit(63)).cast("int")


def _bitmap(hashes: DataFrame, n: int) -> tuple[Column, int]:
    """A scalar array of 64-bit words in which the bits of the hashes ``h`` are set, and its length."""
    words = min(MOST_WORDS, 1 << max(0, math.ceil(math.log2(max(1, n * BITS_EACH / 64)))))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(F.col("h")))
    some = hashes.groupBy(_place(F.col("h"), words).cast("bigint").alias("id")).agg(F.bit_or(one).alias("word"))
    every = hashes.sparkSession.range(words).join(some, "id", "left").select("id", F.coalesce("word", F.lit(0)).alias("word"))
    pairs = F.sort_array(F.collect_list(F.struct("id", "word")))  # ``words`` rows, which are bounded
    return every.agg(F.transform(pairs, lambda p: p["word"])).scalar(), words


def _possible(posts: DataFrame, text: str, hashes: DataFrame, n: int, sizes: list[tuple[int, int]], single: bool) -> DataFrame:
    """``posts`` with ``h``: a row for each place of a word, or of two words' ends of these sizes, whose hash has its bit set.

    ``left``, ``gap`` and ``right`` are what stands at that place.
    """
    bits, size = _bitmap(hashes, n)
    cut = _cut(posts, text, *posts.columns, gaps=True)
    # Each end of a word is cut and hashed once; the pairs of lengths combine hashes only.
    lasts = {a: _last(F.col("left"), F.lit(a)).alias(f"_last{a}") for a, _ in sizes}
    firsts = {b: _first(F.col("right"), F.lit(b)).alias(f"_first{b}") for _, b in sizes}
    whole = [F.xxhash64("left").alias("_word"), F.when(F.col("at") == 0, F.xxhash64(F.lit(EVERYWHERE))).alias("_everywhere")] if single else []
    place = [*posts.columns, "left", "gap", "right"]
    cut = cut.select(*place, *lasts.values(), *firsts.values(), *whole)
    words = [F.col("_word"), F.col("_everywhere")] if single else []
    own = F.array(*words, *[F.xxhash64(f"_last{a}", f"_first{b}") for a, b in sizes] or [F.lit(None).cast("bigint")])
    rows = cut.select(*place, F.explode(own).alias("h"))
    return rows.where(F.getbit(F.get(bits, _place(F.col("h"), size)), _bit(F.col("h"))) == 1)


def _last(word: Column, n: Column) -> Column:
    """Hash of the last ``n`` characters, of all of a shorter word."""
    return F.xxhash64(F.right(word, n))


def _first(word: Column, n: Column) -> Column:
    return F.xxhash64(F.left(word, n))


def _parts(values: DataFrame) -> DataFrame:
    """``value``, ``kind``, ``part`` and ``next``: what a text must show where the value occurs.

    Pairs of neighbouring parts where there are some, else single parts, else the word that every text has.
    """
    parts = _split(F.col("value"))
    last = F.size(parts) - 1

    def single(p: Column, i: Column) -> Column:
        kind = F.when(last == 0, "within").when(i == 0, "end").otherwise("begin")
        return F.struct(F.when((i > 0) & (i < last), "whole").otherwise(kind).alias("kind"), p.alias("part"), F.lit("").alias("next"))

    def pair(p: Column, i: Column) -> Column:
        left, right = F.when(i == 0, "end").otherwise("whole"), F.when(i + 1 == last, "begin").otherwise("whole")
        return F.struct(F.concat_ws(" ", left, right).alias("kind"), p.alias("part"), F.coalesce(F.get(parts, i + 1), F.lit("")).alias("next"))

    singles = F.filter(F.transform(parts, single), lambda x: x["part"] != "")
    pairs = F.filter(F.transform(parts, pair), lambda x: (x["part"] != "") & (x["next"] != ""))
    none = F.array(F.struct(F.lit("whole").alias("kind"), F.lit(EVERYWHERE).alias("part"), F.lit("").alias("next")))
    used = F.when(F.size(pairs) > 0, pairs).when(F.size(singles) > 0, singles).otherwise(none)
    return values.select("value", F.explode(used).alias("x")).select("value", "x.*")


def _wanted_only(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` whose ``key`` may be among the ``key`` of ``keys``, hashes both, not to be broadcast.

    Rows of the corpus are many more than their files tell, as words repeat and keys are exploded. So they go through a
    bitmap where they are made, and what is left is shuffled.
    """
    hashes = keys.select(F.col("key").alias("h")).distinct()
    bits, size = _bitmap(hashes, hashes.count())
    return rows.where(F.getbit(F.get(bits, _place(F.col("key"), size)), _bit(F.col("key"))) == 1).hint("merge")


def _pair_matches(parts: DataFrame, posts: DataFrame, text: str, size: int) -> DataFrame:
    """Word pairs of the corpus that two parts can stand for: ``kind``, ``part``, ``next``, hash and count."""
    wanted = parts.where(F.contains("kind", F.lit(" "))).select("kind", "part", "next").distinct()
    ends = [F.least(F.char_length(c), F.lit(size)).alias(n) for c, n in (("part", "a"), ("next", "b"))]
    wanted = wanted.select("*", *ends).withColumn("key", F.xxhash64(F.right("part", F.col("a")), F.left("next", F.col("b"))))
    sizes = [tuple(r) for r in wanted.select("a", "b").distinct().collect()]  # at most the square of ``size``
    met = _cut(posts, text).where(F.col("right").isNotNull())
    # Partial counts leave a row per word pair and task, however common it is.
    met = met.groupBy("left", "right").agg(F.count("*").alias("n"))
    keys = F.array(*[F.xxhash64(F.right("left", F.lit(a)), F.left("right", F.lit(b))) for a, b in sizes] or [F.lit(None).cast("bigint")])
    found = _wanted_only(met.withColumn("key", F.explode(F.array_distinct(keys))), wanted).join(wanted, "key")
    whole_left, whole_right = F.startswith("kind", F.lit("whole")), F.endswith("kind", F.lit("whole"))
    left = F.endswith("left", "part") & (~whole_left | (F.col("left") == F.col("part")))
    right = F.startswith("right", "next") & (~whole_right | (F.col("right") == F.col("next")))
    return found.where(left & right).select("kind", "part", "next", F.xxhash64("left", "right").alias("h"), "n")


def _word_matches(parts: DataFrame, posts: DataFrame, text: str, size: int) -> DataFrame | None:
    """The same for single parts and words; None where there is no single part, which saves a pass over the texts."""
    length = F.least(F.char_length("part"), F.lit(size))
    wanted = parts.where(~F.contains("kind", F.lit(" "))).select("kind", "part", length.alias("size")).distinct()
    kinds = {r[0]: sorted(r[1]) for r in wanted.groupBy("kind").agg(F.collect_set("size")).collect()}  # four kinds, ``size`` sizes
    if not kinds:
        return None
    words = posts.select(F.explode_outer(F.concat(_split(F.col(text)), F.array(F.lit(EVERYWHERE)))).alias("word"))
    words = words.where(F.col("word").isNotNull())
    vocabulary = stored(words.groupBy("word").agg(F.count("*").alias("n")), "vocabulary")
    kept = ("kind", "part", "word", "n")
    out = []
    if "whole" in kinds:
        keyed = wanted.where("kind = 'whole'").withColumn("key", F.xxhash64("part"))
        found = _wanted_only(vocabulary.withColumn("key", F.xxhash64("word")), keyed)
        out.append(keyed.join(found, "key").where(F.col("part") == F.col("word")).select(*kept))
    for kind, cut, holds in (("begin", F.left, F.startswith), ("end", F.right, F.endswith)):
        if kind in kinds:
            keyed = wanted.where(F.col("kind") == kind).withColumn("key", F.xxhash64(cut("part", F.col("size"))))
            keys = F.array_distinct(F.array(*[F.xxhash64(cut(F.col("word"), F.lit(s))) for s in kinds[kind]]))
            ends = _wanted_only(vocabulary.select("word", "n", F.explode(keys).alias("key")), keyed)
            out.append(keyed.join(ends, "key").where(holds("word", "part")).select(*kept))
    if "within" in kinds:
        # Of the q-grams of a part that lies anywhere in a word, the one that fewest words hold is looked up.
        within = wanted.where("kind = 'within'")
        own = F.coalesce(*[F.when(F.col("size") == s, _grams(F.col("part"), s)) for s in kinds["within"]])
        keyed = within.select("part", F.explode(own).alias("gram")).select("part", F.xxhash64("gram").alias("key"))
        grams = vocabulary.select("word", "n", F.explode(F.concat(*[_grams(F.col("word"), s) for s in kinds["within"]])).alias("gram"))
        grams = stored(_wanted_only(grams.select("word", "n", F.xxhash64("gram").alias("key")), keyed), "grams").hint("merge")
        held = grams.groupBy("key").agg(F.count("*").alias("words"))
        rarest = keyed.join(held, "key").groupBy("part").agg(F.min(F.struct("words", "key")).alias("r")).select("part", F.col("r.key").alias("key"))
        found = rarest.join(grams, "key").where(F.contains("word", "part"))
        out.append(found.select(F.lit("within").alias("kind"), "part", "word", "n").distinct())
    return reduce(DataFrame.unionByName, out).select("kind", "part", F.lit("").alias("next"), F.xxhash64("word").alias("h"), "n")


def _values(rules: DataFrame) -> DataFrame:
    """``rule``, ``value`` and ``tags``, written once."""
    values = rules.where(F.col("value").isNotNull() & F.col("tag").isNotNull()).groupBy("value").agg(F.sort_array(F.collect_set("tag")).alias("tags"))
    return stored(values.select(F.monotonically_increasing_id().alias("rule"), "value", "tags"), "rules")


def _by_words(values: DataFrame, parts: DataFrame, matches: DataFrame) -> DataFrame:
    """``h`` and ``rule``: of each value the part whose words, or word pairs, are rarest."""
    matches = stored(matches, "rule-words")
    part = ["kind", "part", "next"]
    weights = matches.groupBy(*part).agg(F.sum("n").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), *part)).alias("x")
    anchors = parts.join(weights, part, "left").groupBy("value").agg(rarest).where(F.col("x.n") > 0).select("value", *[f"x.{c}" for c in part])
    index = matches.join(anchors, part).join(values, "value")
    return index.select("h", "rule").distinct()


def _by_ends(values: DataFrame, parts: DataFrame, size: int) -> DataFrame:
    """``h``, ``rule``, ``a`` and ``b``: of each value the two neighbouring parts whose meeting ends fewest values share."""
    ends = [F.least(F.char_length(c), F.lit(size)).alias(n) for c, n in (("part", "a"), ("next", "b"))]
    pairs = parts.where(F.contains("kind", F.lit(" "))).select("value", "part", "next", *ends)
    pairs = pairs.withColumn("h", F.xxhash64(_last(F.col("part"), F.col("a")), _first(F.col("next"), F.col("b"))))
    shared = pairs.groupBy("h").agg(F.count_distinct("value").alias("n"))
    length = F.char_length("part") + F.char_length("next")
    best = F.min(F.struct("n", (-F.col("a") - F.col("b")).alias("ends"), (-length).alias("length"), "h", "a", "b")).alias("x")
    anchors = pairs.join(shared, "h").groupBy("value").agg(best)
    return anchors.join(values, "value").select("x.h", "rule", "x.a", "x.b")


def rule_index(posts: DataFrame, rules: DataFrame, text: str = "text", size: int = SIZE) -> DataFrame:
    """``h``, ``value`` and ``tags``: hashes of the words, or word pairs, of each value's anchor; written once.

    ``rules`` has columns ``value`` and ``tag``; null values and tags stand for nothing. An index made for some
    posts holds for these only: a value that has a part without any word there has no row.
    """
    values = _values(rules)
    parts = _parts(values)
    matches, single = _pair_matches(parts, posts, text, size), _word_matches(parts, posts, text, size)
    index = stored(_by_words(values, parts, matches.unionByName(single) if single else matches), "rule-index")
    return index.join(values, "rule").select("h", "value", "tags")


def tag_by_rule_table(
    posts: DataFrame, rules: DataFrame, key: str = "tweet_id", text: str = "text", size: int = SIZE, held_bytes: int = HELD_BYTES
) -> DataFrame:
    """``key`` and ``tags`` (sorted, different) of the posts in whose text a value of ``rules`` occurs.

    The counterpart of ``tag_by_rules`` for rules ``(value, tag)`` that are data. Values are literal and compared as
    they are; an empty one occurs in every text, a null one in none, and a null text holds none. Rows with
    the same key and text give one row, those without a key too. Empty tables give no rows.

    An index of up to ``held_bytes`` goes to where the texts are. A larger one is joined with the hashes alone,
    and the texts with what they may hold, once.
    """
    values = _values(rules)
    parts = stored(_parts(values), "rule-parts")
    ends = stored(_by_ends(values, parts, size), "rule-ends")
    sizes = [tuple(r) for r in ends.select("a", "b").distinct().collect()]  # at most the square of ``size``
    index, words = ends.select("h", "rule"), _word_matches(parts, posts, text, size)
    if words:
        index = stored(index.unionByName(_by_words(values, parts.where(~F.contains("kind", F.lit(" "))), words)), "rule-index")
    tags_bytes = F.aggregate("tags", F.lit(0).cast("bigint"), lambda acc, t: acc + F.octet_length(t))
    held = index.count() * ROW_BYTES + (values.agg(F.sum(F.octet_length("value") + tags_bytes + 64)).first()[0] or 0)
    hashes = index.select("h").distinct()
    named = posts.where(F.col(text).isNotNull())
    named = named.select(F.col(key).alias("_key"), F.unhex(F.md5(text)).alias("_own"), F.col(text).alias("_text"))
    possible = _possible(named, "_text", hashes, hashes.count(), sizes, words is not None)
    if held <= held_bytes:
        # A value of two parts occurs where its two words meet, so that the text need not be searched.
        parted = _split(F.col("value"))
        two = (F.size(parted) == 2) & (F.get(parted, F.lit(0)) != "") & (F.get(parted, F.lit(1)) != "")
        met = possible.join(F.broadcast(index), "h").join(F.broadcast(values.select("*", two.alias("_two"))), "rule")
        here = F.contains(F.concat("left", "gap", "right"), F.col("value"))
        hits = met.where(F.when(F.col("_two"), here).otherwise(F.contains("_text", "value"))).select("_key", "_own", "tags")
    else:
        hits = possible.select("_key", "_own", "h").distinct().join(index, "h").join(values, "rule")
        maybe = hits.groupBy("_key", "_own").agg(F.collect_set(F.struct("value", "tags")).alias("_maybe"))
        maybe = maybe.toDF("_of", "_of_own", "_maybe")
        joined = named.join(maybe, F.col("_key").eqNullSafe(F.col("_of")) & (F.col("_own") == F.col("_of_own")))
        met = F.filter("_maybe", lambda m: F.contains("_text", m["value"]))
        hits = joined.select("_key", "_own", F.explode_outer(F.transform(met, lambda m: m["tags"])).alias("tags"))
    # A post meets the same tags by many values; they are told apart by hash before they are collected.
    single = hits.distinct().select("_key", "_own", F.explode("tags").alias("tag")).distinct()
    found = single.groupBy("_key", "_own").agg(F.sort_array(F.collect_list("tag")).alias("tags"))
    return found.select(F.col("_key").alias(key), "tags")

"""Benchmark decontamination by templates: catches copied questions and re-parameterised ones.

Numbers, names and units become typed placeholders, windows of the resulting template are joined by
hash with those of the benchmark, and what stood in the placeholders must be consistent: one value of
the question goes with one value of the document, for names also the other way round. Windows of the lower-cased
words themselves are joined as well: they find copies in which case or line breaks hide the names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pictolytics.llm.common import by_name, by_place, landed

WINDOW = 6
LEAST_LITERAL = 3
COVERAGE = 0.5
#: So many item words in a row are a leak, whatever their share of the item.
RUN = 13
#: Benchmark windows up to this number are broadcast (24 bytes each, some 12 MB); more are shuffled.
BROADCAST_WINDOWS = 500_000

# Marks in front of a word: U+0001 number, U+0002 name, U+0003 unit; U+0004 joins the parts of a number.
# Units that may follow a number.
UNITS = (
    "km m cm mm mi mile miles ft foot feet in inch inches yd yards kg g mg lb lbs oz ton tons tonnes l ml liter liters "
    "litre litres meter meters metre metres s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years usd eur dollar dollars euro euros cent cents percent degree degrees mph kph kw kwh w v hz"
).replace(" ", "|")


def _marked(text: Column) -> Column:
    """Words parted by one space, lower-cased; numbers, names and units carry a mark in front."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s\p{Z}\x01-\x04]+", " ")
    has_digits = F.regexp_like(t, F.lit(r"[0-9]"))
    t = F.regexp_replace(t, r"(?=\p{Lu})(?<=[\p{Ll},;] )\p{Lu}\p{Ll}+(?![\p{L}\p{N}])", "\x02$0")
    digits = F.regexp_replace(t, r"(?<=[0-9])[.,:/](?=[0-9])", "\x04")
    digits = F.regexp_replace(digits, r"(?<![\p{L}\p{N}\x04])[0-9][0-9\x04]*", "\x01$0 ")
    t = F.lower(F.when(has_digits, digits).otherwise(t))
    t = F.trim(F.regexp_replace(t, r"[^\p{L}\p{M}\p{N}\x01-\x04]+", " "))
    units = F.regexp_replace(t, rf"(\x01[^ ]+) ({UNITS})(?= |$)", "$1 \x03$2")
    return F.when(has_digits, units).otherwise(t)


def _hashes(words: Column, size: int, same: int) -> Column:
    """Position and hash of every window of so many words; ``same`` goes along."""
    last = F.size(words) - size
    return F.transform(
        F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(i.alias("pos"), F.xxhash64(*[F.get(words, i + j) for j in range(size)]).alias("hash"), F.lit(same).alias("same")),
    )


def _windows(df: DataFrame, size: int, short: list[int], *keys: str) -> DataFrame:
    """keys, position and hash of the windows of the column ``_marked``: of its words, and of its template.

    ``_words``: how many words have to be the same, 0 in a template window. ``short``: sizes of which there are
    windows of words, too. A template window with a placeholder equals no window of words, so both kinds share one column.
    """
    has_marks = F.regexp_like("_marked", F.lit(r"[\x01-\x03]"))
    cut = df.select(
        *keys,
        F.split(F.translate("_marked", "\x01\x02\x03", ""), " ").alias("_w"),
        F.when(has_marks, F.split(F.regexp_replace("_marked", r"([\x01-\x03])[^ ]+", "$1"), " ")).alias("_t"),
    )
    template = F.coalesce(_hashes(F.col("_t"), size, 0), F.array().cast("array<struct<pos:int,hash:bigint,same:int>>"))
    words = [_hashes(F.col("_w"), n, n) for n in (size, *short)]
    found = cut.select(*keys, F.explode(F.concat(*words, template)).alias("_x"))
    return found.select(*keys, F.col("_x.pos").alias("_pos"), F.col("_x.hash").alias("_hash"), F.col("_x.same").alias("_words"))


def _identity(key: str, text: str) -> Column:
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.coalesce(F.col(text), F.lit(""))))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    least_literal: int = LEAST_LITERAL,
    coverage: float = COVERAGE,
    run: int = RUN,
    identity: bool = False,
) -> DataFrame:
    """key, item, ``coverage``, ``n_windows``, ``kind`` (exact or reparameterised) of every leaked item.

    An item leaks into a document if windows found there, with consistent placeholders, cover at least
    ``coverage`` of the item's words, or ``run`` of them in a row in one place. Where placeholders are filled anew, windows need ``least_literal`` words
    that are none. Items shorter than a window are found as a whole, by their words, wherever these stand.
    Texts that are null or have no words match nothing. Documents are told apart by key and text:
    repeated rows are reported once, a null key does no harm, and neither do other columns. Repeated items
    are reported each. ``identity`` adds ``_doc``, the digest by which ``without_leaks`` drops documents.
    """
    items = benchmark.select(F.col(item).alias("_item"), F.col(item_text).alias("_text")).where("_text is not null").distinct()
    items = items.select("_item", F.xxhash64("_text").alias("_same"), _marked(F.col("_text")).alias("_marked"))
    words = F.split("_marked", " ")
    slots = F.filter(
        F.transform(F.sequence("_pos", F.col("_pos") + size - 1), lambda q: F.struct(q.alias("q"), F.get(words, q).alias("was"))),
        lambda s: s["was"].rlike(r"^[\x01-\x03]"),
    )
    items = items.where(F.col("_marked") != "").withColumn("_n", F.size(words))
    short = sorted(r[0] for r in items.where(F.col("_n") < size).select("_n").distinct().collect())  # under ``size`` numbers
    asked = _windows(items, size, short, "_item", "_same", "_marked", "_n")
    asked = asked.select("_item", "_same", "_n", F.col("_pos").alias("_at"), "_hash", "_words", slots.alias("_slots"))
    alike = (F.col("_words") == 0) & F.size("_slots").between(1, size - least_literal)
    asked = asked.where(alike | (F.col("_words") == F.least("_n", F.lit(size)))).withColumn("_plain", F.col("_words") > 0).drop("_words")
    index = F.broadcast(asked) if asked.count() <= BROADCAST_WINDOWS else asked

    texts = docs.select(F.col(key).alias("_id"), _identity(key, text).alias("_doc"), _marked(F.col(text)).alias("_marked"))
    hits = _windows(texts, size, short, "_id", "_doc").drop("_words").join(index, "_hash").drop("_hash")
    hits = hits.withColumn("_line", F.col("_pos") - F.col("_at"))

    pair = ["_id", "_doc", "_item", "_same", "_n"]
    lines = hits.groupBy(*pair, "_line").agg(
        F.collect_set(F.when(F.col("_plain"), F.col("_at"))).alias("_words"),  # at most the item's windows
        F.collect_set(F.when(~F.col("_plain"), F.col("_at"))).alias("_ats"),
        F.array_distinct(F.flatten(F.collect_set(F.when(~F.col("_plain"), F.col("_slots"))))).alias("_slots"),
    )
    # Written once: the texts are cut here, and what follows knows how little there is.
    lines = landed(lines, "template-lines")
    line = ["_doc", "_item", "_same", "_line"]
    filled = lines.where(F.size("_slots") > 0).select(*line, F.explode("_slots").alias("s"))
    # Few lines have placeholders; only their documents are looked at again.
    again = texts.join(filled.select("_doc").distinct(), "_doc", "left_semi").select("_doc", "_marked").distinct()
    now = F.get(F.split("_marked", " "), F.col("_line") + F.col("s.q"))
    found = filled.join(again, "_doc").select(*line, F.col("s.q").alias("q"), F.col("s.was").alias("was"), now.alias("now"))
    # Of the values that stand for one value, the most frequent one counts; of equally frequent ones none does.
    valued = found.groupBy(*line, "was", "now").agg(F.count("*").alias("c"), F.collect_list("q").alias("qs"))
    valued = valued.groupBy(*line).agg(F.collect_list(F.struct("was", "now", "c", "qs")).alias("v"))

    def is_name(x: Column) -> Column:
        return x["was"].startswith("\x02")

    def other(x: Column, y: Column) -> Column:
        of_two = (y["was"] == x["was"]) & (y["now"] != x["now"])
        for_two = is_name(x) & is_name(y) & (y["was"] != x["was"]) & (y["now"] == x["now"])
        return (of_two | for_two) & (y["c"] >= x["c"])

    def places(which) -> Column:
        wrong = F.filter("v", lambda x: which(x) & F.exists("v", lambda y: other(x, y)))
        return F.flatten(F.transform(wrong, lambda x: x["qs"]))

    judged = valued.select(*line, places(lambda x: ~is_name(x)).alias("_wrong"), places(is_name).alias("_wrong_names"))
    none = F.array().cast("array<int>")
    if filled.isEmpty():
        judged_lines = lines.withColumns({"_wrong": none, "_wrong_names": none})
    else:
        on = [lines[c].eqNullSafe(judged[c]) for c in line]
        judged_lines = lines.join(judged, on, "left").select(lines["*"], *[F.coalesce(c, none).alias(c) for c in ("_wrong", "_wrong_names")])

    def over(a: Column, places: str) -> Column:
        return F.exists(places, lambda q: q.between(a, a + size - 1))

    used = F.filter("_ats", lambda a: ~over(a, "_wrong") & ~over(a, "_wrong_names"))
    denied = F.filter("_ats", lambda a: over(a, "_wrong_names"))

    def reach(ats: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(ats, lambda a: F.sequence(a, a + F.least("_n", F.lit(size)) - 1))))

    # A name that stands for two speaks against the whole of its windows, a number only against itself.
    alike_at = F.array_except(reach(used), reach(denied))
    judged_lines = judged_lines.select(*pair, "_words", used.alias("_ats"), reach(F.col("_words")).alias("_same_at"), alike_at.alias("_alike_at"))

    def longest(places: Column) -> Column:
        """The most numbers in a row among different ones."""
        begin = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("n"), F.lit(0).alias("most"))

        def step(state: Column, q: Column) -> Column:
            n = F.when(q == state["last"] + 1, state["n"] + 1).otherwise(F.lit(1))
            return F.struct(q.alias("last"), n.alias("n"), F.greatest(state["most"], n).alias("most"))

        return F.aggregate(F.array_sort(places), begin, step)["most"]

    whole = judged_lines.groupBy(*pair).agg(
        F.size(F.array_distinct(F.flatten(F.collect_set(F.array_union("_words", "_ats"))))).alias("_windows"),
        F.size(F.array_distinct(F.flatten(F.collect_set("_same_at")))).alias("_same_words"),
        F.size(F.array_distinct(F.flatten(F.collect_set(F.array_union("_same_at", "_alike_at"))))).alias("_covered"),
        F.max(longest(F.array_union("_same_at", "_alike_at"))).alias("_run"),
    )
    return (
        whole.where("_windows > 0")
        .select("_id", "_doc", "_item", (F.col("_covered") / F.col("_n")).alias("coverage"), F.col("_windows").cast("long").alias("n_windows"), (F.col("_same_words") == F.col("_covered")).alias("_exact"), "_run")
        .where((F.col("coverage") >= coverage) | (F.col("_run") >= run))
        .select(
            F.col("_id").alias(key),
            F.col("_item").alias(item),
            "coverage",
            "n_windows",
            F.when(F.col("_exact"), "exact").otherwise("reparameterised").alias("kind"),
            *(["_doc"] if identity else []),
        )
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` less the documents that an item of the benchmark leaked into.

    Null and empty texts stay, and repeated rows stay or go together. Columns keep their names, whatever these are.
    An empty table on either side drops nothing.
    """
    placed, (own_key, own_text) = by_place(docs, key, text)
    found = find_leaks(placed, benchmark, own_key, own_text, identity=True, **options).select("_doc").distinct()
    kept = placed.withColumn("_doc", _identity(own_key, own_text)).join(landed(found, "leaks"), "_doc", "left_anti")
    return by_name(kept, docs.columns)

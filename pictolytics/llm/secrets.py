"""Secret scans: single patterns, and credentials in several parts linked by an interval join.

A weak part (a user name, a short password, a bare 40-character key, a service address) means little
alone. It is reported only where a complementary part lies within ``REACH`` characters: identifiers,
secrets and addresses confirm each other, any two of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pictolytics.llm.common import by_name, by_place, landed

REACH = 200

# The base patterns.
ASSIGN = r"""(?=[pPsStTaA])((?i:password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}

# Parts that count only together.
WEAK = {
    "identifier": r"""(?<![A-Za-z0-9_])(?=[aAcCuUlL])(?i:access_?key_?id|account_?id|client_?id|user_?name|user_?id|user|login)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9+/_.@-]{3,}""",
    "key": r"""(?<![A-Za-z0-9_])(?=[pPkKaA])(?i:pass|pwd|passphrase|private_?key|auth_?key)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9+/_.=!@#$%^&*-]{4,}|(?<![A-Za-z0-9+/=])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])""",
    "endpoint": r"""(?i:https?|jdbc:[a-z]+|postgres|mysql|redis|amqp|s3)://[A-Za-z0-9._:@/-]++|(?<![A-Za-z0-9.-])[a-z0-9-]{1,63}(?:\.[a-z0-9-]{1,63}){1,8}:[0-9]{2,5}""",
}
KINDS = [*BASE, *WEAK]
_SPANS = "array<struct<kind:int,start:bigint,end:bigint>>"


def spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Leftmost non-overlapping matches of a pattern as (kind, start, end), in code points.

    What lies between the matches comes from ``split``, so positions are running sums of lengths.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(found.alias("m"), F.slice(F.split(text, pattern), F.lit(1), F.size(found)).alias("g"))
    none = F.array().cast(_SPANS)

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.char_length(pair["g"])
        end = start + F.char_length(pair["m"])
        one = F.array(F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end")))
        more = one if keep is None else F.when(keep(pair["m"]), one).otherwise(none)
        return F.struct(end.alias("at"), F.concat(state["out"], more).alias("out"))

    walked = F.aggregate(pairs, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out")), step)["out"]
    return F.when(F.regexp_like(text, F.lit(pattern)), walked).otherwise(none)


def _base(text: Column) -> dict[str, Column]:
    long_value = {"assign": lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 2)) >= 6}
    return {k: spans(text, p, KINDS.index(k), long_value.get(k)) for k, p in BASE.items()}


def _links(docs: DataFrame, text: Column, key: Column, reach: int) -> DataFrame:
    """Key of a text, and its weak parts that complementary ones confirm."""
    weak = {k: spans(text, p, KINDS.index(k)) for k, p in WEAK.items()}
    base = _base(text)
    classes = [F.concat(base["access"], weak["identifier"]), F.concat(base["assign"], base["hex"], weak["key"]), weak["endpoint"]]
    held = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(classes)])
    two = F.filter(F.array(held), lambda p: sum((F.size(p[f"_{i}"]) > 0).cast("int") for i in range(len(classes))) > 1)
    # Outer, so that no filter on the parts is made up and pushed below, which would look for all of them twice.
    parts = docs.select(key.alias("_key"), F.explode_outer(two).alias("p")).where(F.col("p").isNotNull()).select("_key", "p.*")
    parts = landed(parts, "credential-parts")

    def rows(places: tuple[int, ...], prefix: str, margin: int) -> DataFrame:
        """One row per part of these classes and bin that its interval, wider by ``margin``, touches."""
        def named(i: int) -> Column:
            return F.transform(f"_{i}", lambda x: F.struct(F.lit(i).alias("of"), x.alias("x")))

        each = F.concat(*map(named, places))
        one = parts.select("_key", F.explode(each).alias("e")).select("_key", "e.*").distinct()
        low, high = F.col("x.start") - margin, F.col("x.end") + margin
        bins = F.sequence(F.floor(low / reach), F.floor(high / reach))
        return one.select("_key", F.col("of").alias(f"{prefix}_of"), F.col("x").alias(prefix), F.explode(bins).alias("_bin"))

    near = (F.col("i.start") - reach < F.col("s.end")) & (F.col("s.start") < F.col("i.end") + reach)
    # A bin of `reach` characters has room for few parts, so its pairs are few.
    pairs = rows((0, 1), "i", reach).join(rows((1, 2), "s", 0), ["_key", "_bin"]).where(near & (F.col("i_of") < F.col("s_of")))
    confirmed = pairs.select("_key", F.explode(F.array("i", "s")).alias("x")).where(F.col("x.kind") >= len(BASE))
    return confirmed.groupBy("_key").agg(F.collect_set("x").alias("_weak"))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """``docs`` with ``spans``: array of (kind, start, end), ordered by start, then kind; ends exclusive.

    ``kind`` numbers ``KINDS``. Base spans are always there; weak parts are added where confirmed. A
    null text counts as empty and has none. Rows are told apart by key and text, so repeated rows get the
    same spans each and a null key does no harm. Other columns pass through, whatever their names, except one
    named ``spans``, which is replaced. An empty table gives an empty one.
    """
    placed, (own_key, own_text) = by_place(docs, key, text)
    return by_name(_scanned(placed, own_key, own_text, reach), docs.columns, "spans")


def _scanned(docs: DataFrame, key: str, text: str, reach: int) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    own = F.md5(F.concat_ws(":", F.col(key).cast("string"), whole))
    links = _links(docs, whole, own, reach)
    kept = docs.columns
    base = docs.select(*kept, own.alias("_key"), F.concat(*_base(whole).values()).alias("_base"))
    joined = base.join(links, "_key", "left")
    every = F.concat("_base", F.coalesce("_weak", F.array().cast(_SPANS)))
    ordered = F.array_sort(F.transform(every, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))))
    back = F.transform(ordered, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return joined.select(*kept, back.alias("spans"))


def listed(found: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(found, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"]))
    return F.array_join(one, ",")


def base_only(found: Column, kind: str | None = None) -> Column:
    if kind is None:
        return F.filter(found, lambda x: x["kind"] < len(BASE))
    return F.filter(found, lambda x: x["kind"] == KINDS.index(kind))


def redact(text: Column, found: Column, mark: str = "<SECRET>") -> Column:
    """The text with every span replaced; overlapping spans become one mark."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, x: Column) -> Column:
        fresh = F.substring(text, (state["at"] + 1).cast("int"), (x["start"] - state["at"]).cast("int"))
        out = F.when(x["start"] >= state["at"], F.concat(state["out"], fresh, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), out.alias("out"))

    walked = F.aggregate(found, start, step, lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return F.when(F.size(found) > 0, walked).otherwise(text)

"""The questions bound to the given tables: name -> (session, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pictolytics.functions.patterns import FACE_EMOJI
from pictolytics.functions.text import register_sql_functions, word_tokens
from pictolytics.operators import authors as A
from pictolytics.operators import counts as C
from pictolytics.operators import history as H
from pictolytics.operators import rule_index
from pictolytics.operators import sampling as S
from pictolytics.operators import tagging as G
from pictolytics.operators import tokens as T
from pictolytics.operators.heavy import most_used_sketched
from pictolytics.plans import questions as Q
from pictolytics.session import configure, shared_dir
from pictolytics.sources import cube as B
from pictolytics.sources import derived as D
from pictolytics.sources import pages as P
from pictolytics.sources import records as R
from pictolytics.sources.schemas import AUTHOR_COLUMNS, POST_COLUMNS
from pictolytics.sources.token_table import read_token_table, write_token_table
from pictolytics.streaming import live, run
from pictolytics.streaming.landing import LandingFolder

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Arguments of the registered queries, shared with their SQL counterparts.
FOLLOWERS = 500_000
BASE = "🙏"
PER_SLOT = 3
SPAN_DAYS = 31
STEP_MINUTES = 30
RULES = [("👍", "approval"), ("🙏", "thanks"), ("❤", "affection"), ("😍", "affection"), ("RT @", "repost"), (" and 🎉", "party")]
REGEX = "🙏|👍"
# The landed files hold posts of all times, so that triggers do not come in the order of time.
FILES, FILES_PER_TRIGGER = 8, 3
# Landed files hold whole texts, which take most of the disk.
COMPRESSION = "gzip"
# Texts that are gathered in pages at a time; each portion shuffles the documents once more.
PORTION_BYTES = 12 << 30


def query(f: Query) -> Query:
    @wraps(f)
    def bound(spark: SparkSession, folder: str) -> DataFrame:
        return f(configure(spark), folder)

    REGISTRY[f.__name__] = bound
    return bound


def _emoji(spark: SparkSession, folder: str) -> DataFrame:
    return Q.emoji_of(D.posts(spark, folder))


def _words(spark: SparkSession, folder: str, name: str, per_post: bool = False) -> DataFrame:
    return T.explode_words(D.table(spark, folder, name), per_post)


def _plain(df: DataFrame, *names: str) -> DataFrame:
    """Time stamps without a zone, as the test tables hold them."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


# Most used


@query
def top_emoji(spark, folder):
    return Q.most_used(_emoji(spark, folder))


@query
def top_ten_emoji(spark, folder):
    return Q.most_used(_emoji(spark, folder), limit=10)


@query
def emoji_table(spark, folder):
    kept = [c for c in POST_COLUMNS if c != "text"]
    return _plain(_emoji(spark, folder).select(*kept, "emoji"), "time")


@query
def top_emoji_by_day(spark, folder):
    return Q.most_used_by_time(_emoji(spark, folder), "daily")


@query
def top_emoji_by_hour(spark, folder):
    return Q.most_used_by_time(_emoji(spark, folder), "hourly")


@query
def top_emoji_by_day_hour(spark, folder):
    return Q.most_used_by_time(_emoji(spark, folder), "dailyAndHourly")


@query
def top_emoji_all_grains(spark, folder):
    return Q.most_used_by_every_grain(_emoji(spark, folder))


@query
def top_emoji_by_date(spark, folder):
    return Q.most_used_by_time(_emoji(spark, folder), "date")


@query
def top_emoji_by_day_english(spark, folder):
    return Q.most_used_by_time(Q.emoji_of(D.posts(spark, folder), lang="en"), "daily")


# Languages, engagement, tones


@query
def lang_compare(spark, folder):
    return Q.compare_languages(_emoji(spark, folder), "es", "en")


@query
def lang_share(spark, folder):
    return Q.compare_language_shares(_emoji(spark, folder), "es", "en")


@query
def avg_likes(spark, folder):
    return Q.average_engagement(_emoji(spark, folder), likes=True)


@query
def avg_reposts(spark, folder):
    return Q.average_engagement(_emoji(spark, folder), likes=False)


@query
def tone_breakdown(spark, folder):
    return Q.tone_breakdown(_emoji(spark, folder))


@query
def variant_emoji(spark, folder):
    return Q.variants_of(D.posts(spark, folder), BASE)


@query
def regex_emoji(spark, folder):
    """Emoji that a regular expression finds, once per post."""
    return Q.variants_of(D.posts(spark, folder), REGEX, regex=True).select("emoji", "total")


@query
def sql_functions(spark, folder):
    """The functions offered to SQL, on the posts' texts."""
    register_sql_functions(spark)
    D.posts(spark, folder).createOrReplaceTempView("pictolytics_posts")
    return spark.sql(
        "SELECT base_emoji(e) AS base, emoji_tone(e) AS tone, count(*) AS n FROM (SELECT explode_outer(found) AS e "
        "FROM (SELECT emoji_tokens(text) AS found FROM pictolytics_posts)) WHERE e IS NOT NULL GROUP BY ALL"
    )


@query
def long_chain_emoji(spark, folder):
    """Posts with a chain of joined emoji as long as their document: each chain is one token."""
    chained = D.posts(spark, folder).withColumn(
        "text", F.concat(F.lit("a "), F.expr("repeat('👩‍', length(text))"), F.lit("👩"))
    )
    tokens = T.explode_emoji(chained.select("tweet_id", "text"))
    return tokens.select("tweet_id", F.char_length("emoji").alias("n_chars"))


# Authors


@query
def top_emoji_known_authors(spark, folder):
    """Over the posts of authors with few followers only, by way of a semi-join."""
    known = D.authors(spark, folder).where(F.col("followers_count") <= FOLLOWERS)
    return Q.most_used(Q.emoji_of(D.posts(spark, folder), known_authors=known))


@query
def famous_emoji(spark, folder):
    return Q.used_by_followed_authors(D.posts(spark, folder), D.authors(spark, folder), FOLLOWERS)


@query
def posts_with_authors(spark, folder):
    joined = A.with_authors(D.post_heads(spark, folder), D.authors(spark, folder))
    flagged = T.select_posts(D.with_texts(joined, spark, folder)).withColumn("is_repost", T.is_repost(F.col("text")))
    return _plain(flagged.select(*POST_COLUMNS, "is_repost", *AUTHOR_COLUMNS), "time")


@query
def posts_with_authors_dealt(spark, folder):
    """The same join by the way taken for author tables too large to broadcast."""
    joined = A.with_authors_dealt(D.post_heads(spark, folder), D.authors(spark, folder))
    return _plain(T.select_posts(D.with_texts(joined, spark, folder)), "time")


@query
def latest_authors(spark, folder):
    """Author snapshots as pages carry them: one per post, with a follower count that moves."""
    joined = A.with_authors(D.post_times(spark, folder), D.authors(spark, folder))
    moved = joined.withColumn("followers_count", F.col("followers_count") + F.col("tweet_id"))
    return A.latest_authors(moved.select(*AUTHOR_COLUMNS, F.col("time").alias("page_time")))


# Rules, search, slots


@query
def tag_by_rules(spark, folder):
    tagged = G.tag_by_rules(D.posts(spark, folder), RULES)
    return tagged.select("tweet_id", F.array_join("tags", ",").alias("tags"))


@query
def tag_by_token_rules(spark, folder):
    """Documents by the roles that use one of their words in a conversation."""
    # Turns and documents lie in few row groups: dealt over all tasks before they are cut.
    turns = D.table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").repartition("conv_id", "turn")
    spoken = T.explode_words(turns, per_post=True)
    rules = spoken.select(F.col("word").alias("value"), F.col("role").alias("tag")).distinct()
    documents = D.table(spark, folder, "documents").select("doc_id", "text").repartition("doc_id")
    return G.tag_by_token_rules(T.explode_words(documents, per_post=True), rules, "word", key="doc_id")


@query
def tag_by_rule_table(spark, folder):
    """Posts by literal rules of a table: every two neighbouring words of the benchmark, and the emoji of a list."""
    words = word_tokens(F.col("text"))
    following = F.slice(words, F.lit(2), F.lit(1 << 30))
    pairs = F.filter(F.zip_with(words, following, lambda a, b: F.concat(a, F.lit(" "), b)), lambda p: p.isNotNull())
    asked = D.table(spark, folder, "benchmark").select(F.explode(pairs).alias("value"))
    asked = asked.select("value", F.concat(F.lit("pair of "), F.length("value")).alias("tag"))
    listed = D.table(spark, folder, "events").select(F.explode(F.split(F.lit(D.PALETTE), ",")).alias("value"), "event_type").distinct()
    rules = asked.unionByName(listed.select("value", F.col("event_type").alias("tag")))
    tagged = rule_index.tag_by_rule_table(D.posts(spark, folder), rules)
    return tagged.select("tweet_id", F.array_join("tags", ",").alias("tags"))


@query
def contains_any(spark, folder):
    return G.containing_any(D.posts(spark, folder), FACE_EMOJI).select("tweet_id", "lang")


def _now(posts: DataFrame) -> Column:
    return F.timestamp_micros(posts.agg(F.max(F.unix_micros("time")) + 11_000_000).scalar())


@query
def newest_per_slot(spark, folder):
    posts = D.post_times(spark, folder)
    found = Q.historical_sample(posts, _now(posts), STEP_MINUTES, SPAN_DAYS, PER_SLOT)
    return _plain(found, "slot_end", "time")


@query
def newest_before_slot(spark, folder):
    posts = D.post_times(spark, folder)
    found = Q.historical_sample(posts, _now(posts), STEP_MINUTES, SPAN_DAYS, PER_SLOT, bounded=False)
    return _plain(found, "slot_end", "time")


# Sources


def _landed_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages gather posts by their ids, so texts are shuffled: portion by portion, whose shuffle files go as it is written."""
    heads, authors, landing = D.post_heads(spark, folder), D.authors(spark, folder), shared_dir(spark, "pages")
    for portion in P.portions_of(heads, max(1, -(-D.text_bytes(spark, folder) // PORTION_BYTES))):
        pages = P.pack_pages(portion, authors, late=lambda rows: D.with_texts(rows, spark, folder))
        R.write_landing(pages, landing, compression=COMPRESSION)
    return P.read_pages(spark, landing)


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all posts; the texts join them last, so that only documents move."""
    return P.pack_records(D.post_heads(spark, folder), D.authors(spark, folder), lambda rows: D.with_texts(rows, spark, folder))


def _in_files(records: DataFrame) -> DataFrame:
    """In FILES parts. The join with the texts has dealt the records by a hash, so that each part holds posts of all times."""
    return records.coalesce(FILES)


@query
def pages_roundtrip(spark, folder):
    """Posts written as JSON pages and read back."""
    return _plain(A.unique_posts(P.flatten_posts(_landed_pages(spark, folder))), "time")


@query
def pages_lineage(spark, folder):
    """Posts with the cursor and the time of their page."""
    posts = P.flatten_posts(_landed_pages(spark, folder), lineage=True)
    return _plain(posts.select("tweet_id", "page_token", "page_time"), "page_time")


@query
def record_author_arrays(spark, folder):
    """Post and author fields of landed records, the authors of a record as arrays."""
    records = _records(spark, folder)
    landed = R.read_records(spark, R.write_landing(records, shared_dir(spark, "records"), 100_000, COMPRESSION))
    joined = [F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("name", "username", "followers_count")]
    return R.author_arrays(landed).select("tweet_id", *joined)


@query
def landing_compacted(spark, folder):
    """Records that a stream lands before and after a compaction, some followed and archived, each read once."""
    records = _in_files(_records(spark, folder))
    arrived, home = shared_dir(spark, "arrived"), LandingFolder(spark, shared_dir(spark, "home"), compression=COMPRESSION)
    R.write_landing(records, arrived, 1_000_000, COMPRESSION)
    parts = R.read_record_stream(spark, arrived, FILES_PER_TRIGGER)
    first = F.pmod(F.xxhash64("data.id"), F.lit(2)) == 0
    home.land(parts.where(first), 10_000, "first")
    run.totals_so_far(home.follow(FILES_PER_TRIGGER).groupBy(F.col("data.lang").alias("lang")).count())
    home.compact()
    home.retire(0)
    home.land(parts.where(~first), 10_000, "second")
    return _plain(R.flatten_records(home.read()).select(*POST_COLUMNS, "username"), "time")


@query
def pages_authors(spark, folder):
    """Authors of the JSON pages; each is listed on every page that has one of their posts."""
    return A.latest_authors(P.flatten_authors(_landed_pages(spark, folder)))


@query
def top_emoji_from_table(spark, folder):
    """Cut once, stored by date without the text, then asked."""
    path = write_token_table(_emoji(spark, folder), shared_dir(spark, "tokens"))
    return Q.most_used_by_time(read_token_table(spark, path), "date")


def _cube(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads, each of which touches all dates."""
    path = shared_dir(spark, "cube")
    for load in (0, 1):
        B.add_to_cube(_emoji(spark, folder).where(F.col("tweet_id") % 2 == load), path, f"load{load}")
    return B.read_cube(spark, path)


@query
def top_emoji_from_cube(spark, folder):
    return B.usage_from_cube(_cube(spark, folder))


@query
def avg_likes_from_cube(spark, folder):
    return B.average_from_cube(_cube(spark, folder))


@query
def lang_compare_from_cube(spark, folder):
    return B.languages_from_cube(_cube(spark, folder), "es", "en")


@query
def top_emoji_by_day_hour_from_cube(spark, folder):
    counts = B.counts_from_cube(_cube(spark, folder), ["day_of_week", "hour"])
    return Q.named_days(C.winners(counts, ["day_of_week", "hour"], few_buckets=True))


@query
def emoji_rank_changes(spark, folder):
    """Entries, exits and moves among the five most used emoji, from date to date."""
    counts = C.count_by(C.with_buckets(_emoji(spark, folder), ["date"]), ["date", "emoji"])
    return H.rank_changes(counts, 5)


# Streams


def _landed_stream(spark: SparkSession, folder: str) -> DataFrame:
    landing = R.write_landing(_in_files(_records(spark, folder)), shared_dir(spark, "landing"), 1_000_000, COMPRESSION)
    return R.flatten_records(R.read_record_stream(spark, landing, FILES_PER_TRIGGER))


@query
def famous_emoji_stream(spark, folder):
    """Posts landed as JSON lines and followed as a stream."""
    return run.totals_so_far(live.live_famous(_landed_stream(spark, folder), FOLLOWERS))


@query
def variant_emoji_stream(spark, folder):
    return run.totals_so_far(live.live_variants(_landed_stream(spark, folder), BASE))


@query
def regex_emoji_stream(spark, folder):
    return run.totals_so_far(live.live_variants(_landed_stream(spark, folder), REGEX, regex=True))


@query
def hourly_emoji_stream_open(spark, folder):
    """All hours, open ones too, whatever the order of the files."""
    windows = live.live_windows_open(_landed_stream(spark, folder), 3600, once=True)
    return _plain(run.totals_so_far(windows), "window_start")


@query
def hourly_emoji_stream(spark, folder):
    """Closed hours only: an hour is written once the newest post is an hour past its end."""
    windows = live.live_windows(D.post_stream(spark, folder), "1 hour", "1 hour")
    table = shared_dir(spark, "windows")
    run.append_windows(windows, table, shared_dir(spark, "windows-checkpoint"))
    return _plain(spark.read.schema(windows.schema).parquet(table), "window_start", "window_end")


@query
def famous_emoji_sink(spark, folder):
    """The totals of followed authors as a table for other programs, exactly once by batch."""
    followed = _landed_stream(spark, folder).where(F.col("followers_count") > FOLLOWERS)
    return run.totals_into(live.cut_once(followed), shared_dir(spark, "famous")).read()


@query
def tag_by_rules_stream(spark, folder):
    """Live posts by a rule table that every batch reads anew."""
    folder_out = shared_dir(spark, "tagged")
    run.tags_into(_landed_stream(spark, folder), lambda: spark.createDataFrame(RULES, "value string, tag string"), folder_out)
    tagged = spark.read.schema("tweet_id string, tags array<string>, batch int").parquet(f"{folder_out}/tags")
    return tagged.select(F.col("tweet_id").cast("bigint").alias("tweet_id"), F.array_join("tags", ",").alias("tags"))


@query
def top_emoji_by_hour_stream(spark, folder):
    """The winner of every closed hour, by two aggregations in a row."""
    winners = live.live_winners(D.post_stream(spark, folder), "1 hour", "1 hour")
    table = shared_dir(spark, "winners")
    run.append_windows(winners, table, shared_dir(spark, "winners-checkpoint"))
    return _plain(spark.read.schema(winners.schema).parquet(table), "window_start", "window_end")


@query
def newest_per_slot_stream(spark, folder):
    """The newest posts of each slot from files in any order; the table holds a few rows per slot."""
    stream = _landed_stream(spark, folder)
    slotted = S.assign_slots(stream.select("tweet_id", "time"), _now(D.post_times(spark, folder)), STEP_MINUTES, SPAN_DAYS)
    table = run.newest_into(slotted.withColumn("tweet_id", F.col("tweet_id").cast("bigint")), shared_dir(spark, "newest"), PER_SLOT)
    return _plain(S.newest_per_slot(table.read(), PER_SLOT), "time").select("slot", "position", "tweet_id", "time")


# The same operators on other tokens


@query
def words_top(spark, folder):
    return Q.most_used(_words(spark, folder, "documents"), "word")


@query
def top_words_sketched(spark, folder):
    """The first hundred words, by a summary and an exact recount."""
    documents = D.table(spark, folder, "documents").select("doc_id", "text").repartition("doc_id")
    return most_used_sketched(T.explode_words(documents), 100)


@query
def words_lang_compare(spark, folder):
    return Q.compare_languages(_words(spark, folder, "documents"), "es", "en", "word")


@query
def words_role_compare(spark, folder):
    words = _words(spark, folder, "conversations")
    return C.two_groups(words, "role", "user", "assistant", "word")


@query
def event_type_by_hour(spark, folder):
    events = D.table(spark, folder, "events").select("event_type", F.col("ts").cast("timestamp").alias("time"))
    return Q.most_used_by_time(events, "hourly", "event_type")


@query
def event_type_by_day(spark, folder):
    events = D.table(spark, folder, "events").select("event_type", F.col("ts").cast("timestamp").alias("time"))
    return Q.most_used_by_time(events, "daily", "event_type")

"""The registered questions in plain SQL, for an independent engine on the same tables."""

from __future__ import annotations

from pictolytics.functions.patterns import EMOJI_PATTERN, FACE_EMOJI, PRESENTATION_SELECTOR, TONE_PATTERN
from pictolytics.plans.registry import BASE, FOLLOWERS, PER_SLOT, REGEX, RULES, SPAN_DAYS, STEP_MINUTES
from pictolytics.sources.derived import _SECOND, AUTHOR_EXPRESSIONS, PALETTE, POST_EXPRESSIONS
from pictolytics.sources.schemas import AUTHOR_COLUMNS, POST_COLUMNS

_SELECTOR = f"chr({ord(PRESENTATION_SELECTOR)})"
_CUT = f"unnest(regexp_extract_all(text, '{EMOJI_PATTERN}'))"


def _columns(expressions: dict[str, str], names: list[str]) -> str:
    return ", ".join(f"{expressions[n]} AS {n}" for n in names)


_VIEWS = {
    "posts": f"""SELECT {_columns(POST_EXPRESSIONS, POST_COLUMNS)} FROM events
        JOIN documents ON doc_id = event_id % (SELECT count(*) FROM documents)""",
    "authors": f"SELECT {_columns(AUTHOR_EXPRESSIONS, AUTHOR_COLUMNS)} FROM customer",
    "tokens": f"SELECT *, replace({_CUT}, {_SELECTOR}, '') AS emoji FROM posts WHERE NOT starts_with(text, 'RT')",
    "once": f"SELECT DISTINCT tweet_id, author_id, replace({_CUT}, {_SELECTOR}, '') AS emoji FROM posts",
    "doc_words": r"""SELECT * FROM (SELECT doc_id, lang, unnest(regexp_split_to_array(text, '\s+')) AS word
        FROM documents) WHERE word <> ''""",
    "talk_words": r"""SELECT * FROM (SELECT role, unnest(regexp_split_to_array(text, '\s+')) AS word
        FROM conversations) WHERE word <> ''""",
}


def _sql(query: str, *views: str) -> str:
    needs = {"tokens": ["posts"], "once": ["posts"]}
    names = [n for n in _VIEWS if n in views or any(n in needs.get(v, []) for v in views)]
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({_VIEWS[n]})" for n in names) + " " + query


def _best(buckets: dict[str, str], token: str, name: str, source: str) -> str:
    """Winners per bucket with ties, by rank."""
    named = ", ".join(f"{e} AS {b}" for b, e in buckets.items())
    keys = ", ".join(buckets)
    return (
        f"SELECT {keys}, {token}, {name} FROM (SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY {name} DESC) AS r "
        f"FROM (SELECT {named}, {token}, count(*) AS {name} FROM {source} GROUP BY ALL)) WHERE r = 1"
    )


_DAY = {"day_of_week": "dayname(time)"}
_HOUR = {"hour": "CAST(hour(time) AS INTEGER)"}


def _compare(group: str, first: str, second: str, token: str, source: str) -> str:
    def side(v: str) -> str:
        return f"(SELECT {token}, count(*) AS {v}_total FROM {source} WHERE {group} = '{v}' GROUP BY {token})"

    return f"SELECT {token}, {first}_total, {second}_total FROM {side(first)} FULL JOIN {side(second)} USING ({token})"


def _average(measure: str, name: str) -> str:
    return f"SELECT emoji, avg({measure}) AS {name} FROM tokens GROUP BY emoji HAVING count(*) > 10"


_STEP = STEP_MINUTES * 60 * 1_000_000
_LAST = -(-SPAN_DAYS * 24 * 60 // STEP_MINUTES)
_NOW = "(SELECT max(epoch_us(time)) + 11000000 FROM posts)"
_END = f"make_timestamp({_NOW} - CASE WHEN slot = 0 THEN 10000000 ELSE (slot + 1) * {_STEP} END)"
_LATEST = "ORDER BY time DESC, tweet_id DESC"

_TAGS = ", ".join(f"CASE WHEN contains(text, '{value}') THEN '{tag}' END" for value, tag in RULES)
_FACES = ", ".join(f"'{f.replace(PRESENTATION_SELECTOR, '')}'" for f in FACE_EMOJI)
_FAMOUS = f"""SELECT emoji, count(*) AS total FROM once JOIN authors ON author_id = user_id
    WHERE followers_count > {FOLLOWERS} GROUP BY emoji"""
_VARIANTS = f"SELECT emoji, count(*) AS total FROM once WHERE contains(emoji, '{BASE}') GROUP BY emoji"
_MATCHING = f"SELECT emoji, count(*) AS total FROM once WHERE regexp_matches(emoji, '{REGEX}') GROUP BY emoji"
_BASE = f"regexp_replace(emoji, '{TONE_PATTERN}', '', 'g')"
_TONE = f"regexp_extract(emoji, '({TONE_PATTERN})', 1)"
_NO_TEXT = ", ".join(c for c in POST_COLUMNS if c != "text")

ORACLES: dict[str, str] = {
    "top_emoji": _sql("SELECT emoji, count(*) AS usage FROM tokens GROUP BY emoji", "tokens"),
    "top_ten_emoji": _sql(
        "SELECT emoji, count(*) AS usage FROM tokens GROUP BY emoji ORDER BY usage DESC, emoji LIMIT 10", "tokens"
    ),
    "emoji_table": _sql(f"SELECT {_NO_TEXT}, emoji FROM tokens", "tokens"),
    "top_emoji_by_day": _sql(_best(_DAY, "emoji", "popularity", "tokens"), "tokens"),
    "top_emoji_by_hour": _sql(_best(_HOUR, "emoji", "occurrence", "tokens"), "tokens"),
    "top_emoji_by_day_hour": _sql(_best(_DAY | _HOUR, "emoji", "n", "tokens"), "tokens"),
    "top_emoji_by_date": _sql(_best({"date": "CAST(time AS DATE)"}, "emoji", "n", "tokens"), "tokens"),
    "top_emoji_from_table": _sql(_best({"date": "CAST(time AS DATE)"}, "emoji", "n", "tokens"), "tokens"),
    "top_emoji_from_cube": _sql("SELECT emoji, count(*) AS usage FROM tokens GROUP BY emoji", "tokens"),
    "avg_likes_from_cube": _sql(_average("like_count", "average_likes"), "tokens"),
    "lang_compare_from_cube": _sql(_compare("lang", "es", "en", "emoji", "tokens"), "tokens"),
    "top_emoji_by_day_hour_from_cube": _sql(_best(_DAY | _HOUR, "emoji", "n", "tokens"), "tokens"),
    "emoji_rank_changes": _sql(
        """, c AS (SELECT CAST(time AS DATE) AS date, emoji, count(*) AS n FROM tokens GROUP BY ALL),
        days AS (SELECT date, row_number() OVER (ORDER BY date) AS day FROM (SELECT DISTINCT date FROM c)),
        top AS (SELECT date, day, emoji, n, CAST(row_number() OVER (PARTITION BY date ORDER BY n DESC, emoji) AS INTEGER) AS rank
            FROM c JOIN days USING (date) QUALIFY rank <= 5),
        pairs AS (SELECT coalesce(t.day, b.day + 1) AS day, coalesce(t.emoji, b.emoji) AS emoji, t.rank, b.rank AS before, t.n
            FROM top t FULL JOIN top b ON t.emoji = b.emoji AND t.day = b.day + 1)
        SELECT date, emoji, CASE WHEN rank IS NULL THEN 'leaves' WHEN before IS NULL THEN 'enters' WHEN rank < before THEN 'up'
            WHEN rank > before THEN 'down' ELSE 'same' END AS change, rank, before, n FROM pairs JOIN days USING (day)""",
        "tokens",
    ).replace(") , c AS", "), c AS"),
    "top_emoji_known_authors": _sql(
        f"""SELECT emoji, count(*) AS usage FROM tokens
            WHERE author_id IN (SELECT user_id FROM authors WHERE followers_count <= {FOLLOWERS}) GROUP BY emoji""",
        "tokens",
        "authors",
    ),
    "top_emoji_by_day_english": _sql(
        _best(_DAY, "emoji", "popularity", "(SELECT * FROM tokens WHERE lang = 'en')"), "tokens"
    ),
    "top_emoji_all_grains": _sql(
        f"""SELECT 'day' AS grain, day_of_week, CAST(NULL AS INTEGER) AS hour, emoji, n
              FROM ({_best(_DAY, "emoji", "n", "tokens")})
        UNION ALL SELECT 'hour', NULL, hour, emoji, n FROM ({_best(_HOUR, "emoji", "n", "tokens")})
        UNION ALL SELECT 'day_hour', day_of_week, hour, emoji, n FROM ({_best(_DAY | _HOUR, "emoji", "n", "tokens")})""",
        "tokens",
    ),
    "lang_compare": _sql(_compare("lang", "es", "en", "emoji", "tokens"), "tokens"),
    "lang_share": _sql(
        f"""SELECT *, es_share / nullif(en_share, 0) AS share_ratio FROM (
            SELECT emoji, es_total, en_total,
                CAST(coalesce(es_total, 0) AS DOUBLE) / sum(es_total) OVER () AS es_share,
                CAST(coalesce(en_total, 0) AS DOUBLE) / sum(en_total) OVER () AS en_share
            FROM ({_compare("lang", "es", "en", "emoji", "tokens")}))""",
        "tokens",
    ),
    "avg_likes": _sql(_average("like_count", "average_likes"), "tokens"),
    "avg_reposts": _sql(_average("retweet_count", "average_retweets"), "tokens"),
    "tone_breakdown": _sql(
        f"""SELECT {_BASE} AS base_emoji, {_TONE} AS tone, count(*) AS total FROM tokens
            WHERE regexp_matches(emoji, '{TONE_PATTERN}') GROUP BY ALL""",
        "tokens",
    ),
    "variant_emoji": _sql(f"SELECT emoji, total, {_BASE} AS base_emoji, {_TONE} AS tone FROM ({_VARIANTS})", "once"),
    "famous_emoji": _sql(_FAMOUS, "once", "authors"),
    "posts_with_authors": _sql(
        """SELECT posts.*, authors.*, starts_with(text, 'RT') AS is_repost FROM posts
            JOIN authors ON author_id = user_id WHERE NOT starts_with(text, 'RT')""",
        "posts",
        "authors",
    ),
    "posts_with_authors_dealt": _sql(
        """SELECT posts.*, authors.* FROM posts
            JOIN authors ON author_id = user_id WHERE NOT starts_with(text, 'RT')""",
        "posts",
        "authors",
    ),
    "latest_authors": _sql(
        """SELECT user_id, name, username, followers_count + tweet_id AS followers_count, following_count,
            authors.tweet_count, listed_count FROM posts JOIN authors ON author_id = user_id
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY time DESC, tweet_id DESC) = 1""",
        "posts",
        "authors",
    ),
    "tag_by_rules": _sql(
        f"""SELECT tweet_id, array_to_string(list_sort(list_distinct([{_TAGS}])), ',') AS tags FROM posts
            WHERE len(list_distinct([{_TAGS}])) > 0""",
        "posts",
    ),
    "tag_by_token_rules": _sql(
        """SELECT DISTINCT doc_id, tag FROM (SELECT DISTINCT doc_id, word FROM doc_words)
            JOIN (SELECT DISTINCT word, role AS tag FROM talk_words) USING (word)""",
        "doc_words",
        "talk_words",
    ),
    # No emoji is part of a word pair, so pairs are looked for in the documents, with and without what marks a repost.
    "tag_by_rule_table": rf"""WITH rules AS (
            SELECT DISTINCT value, 'pair of ' || length(value) AS tag FROM (
                SELECT unnest(list_transform(range(len(ws) - 1), lambda i: ws[i + 1] || ' ' || ws[i + 2])) AS value
                FROM (SELECT list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS ws FROM benchmark))),
        heads AS (SELECT DISTINCT CASE WHEN event_id % 7 = 0 THEN 'RT @x: ' ELSE '' END AS head FROM events),
        pairs AS (SELECT DISTINCT head, doc_id, tag FROM heads, documents JOIN rules ON contains(head || text || ' ', value)),
        ends AS (SELECT event_id, {_SECOND} AS e, split_part('{PALETTE}', ',', CAST((event_id * 7 + user_id) % 16 + 1 AS INT)) || ' and ' ||
            {_SECOND} || CASE WHEN event_id % 3 = 0 THEN {_SECOND} ELSE '' END AS tail FROM events),
        emoji AS (SELECT unnest(string_split('{PALETTE}', ',')) AS value), types AS (SELECT DISTINCT event_type AS tag FROM events)
        SELECT tweet_id, string_agg(tag, ',' ORDER BY tag) AS tags FROM (
            SELECT event_id AS tweet_id, tag FROM events JOIN pairs ON doc_id = event_id % (SELECT count(*) FROM documents)
                AND head = CASE WHEN event_id % 7 = 0 THEN 'RT @x: ' ELSE '' END
            UNION SELECT event_id, tag FROM ends JOIN emoji ON contains(tail, value), types) GROUP BY tweet_id""",
    "contains_any": _sql(
        f"""SELECT tweet_id, lang FROM posts
            WHERE list_has_any(regexp_extract_all(replace(text, {_SELECTOR}, ''), '{EMOJI_PATTERN}'), [{_FACES}])""",
        "posts",
    ),
    "newest_per_slot": _sql(
        f"""SELECT slot, {_END} AS slot_end, position, tweet_id, time FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY slot {_LATEST}) AS INTEGER) AS position FROM (
                SELECT tweet_id, time, greatest((age + {_STEP - 1}) // {_STEP} - 2, 0) AS slot
                FROM (SELECT tweet_id, time, {_NOW} - epoch_us(time) AS age FROM posts)
                WHERE age > 10000000 AND age <= {_LAST * _STEP}))
            WHERE position <= {PER_SLOT}""",
        "posts",
    ),
    "newest_before_slot": _sql(
        f"""SELECT slot, slot_end, position, tweet_id, time
            FROM (SELECT range AS slot FROM range({_LAST - 1})) grid
            JOIN LATERAL (SELECT {_END} AS slot_end) ON true
            JOIN LATERAL (SELECT tweet_id, time, CAST(row_number() OVER ({_LATEST}) AS INTEGER) AS position
                FROM posts WHERE time < slot_end AND {_NOW} - epoch_us(time) <= {_LAST * _STEP}
                {_LATEST} LIMIT {PER_SLOT}) ON true""",
        "posts",
    ),
    "pages_roundtrip": _sql(
        f"""SELECT CAST(tweet_id AS VARCHAR) AS tweet_id, CAST(author_id AS VARCHAR) AS author_id,
            {", ".join(POST_COLUMNS[2:])} FROM posts""",
        "posts",
    ),
    "pages_lineage": _sql(
        """SELECT CAST(tweet_id AS VARCHAR) AS tweet_id, CAST(tweet_id // 100 AS VARCHAR) AS page_token,
            first(time) OVER (PARTITION BY tweet_id // 100 ORDER BY CAST(tweet_id AS VARCHAR)) AS page_time FROM posts""",
        "posts",
    ),
    "record_author_arrays": _sql(
        """SELECT CAST(posts.tweet_id AS VARCHAR) AS tweet_id, name, username,
            CAST(followers_count AS VARCHAR) AS followers_count FROM posts JOIN authors ON author_id = user_id""",
        "posts",
        "authors",
    ),
    "landing_compacted": _sql(
        f"""SELECT CAST(tweet_id AS VARCHAR) AS tweet_id, CAST(author_id AS VARCHAR) AS author_id,
            {", ".join(POST_COLUMNS[2:])}, username FROM posts LEFT JOIN authors ON author_id = user_id""",
        "posts",
        "authors",
    ),
    "pages_authors": _sql(
        f"""SELECT CAST(user_id AS VARCHAR) AS user_id, {", ".join(AUTHOR_COLUMNS[1:])} FROM authors
            WHERE user_id IN (SELECT author_id FROM posts)""",
        "posts",
        "authors",
    ),
    "famous_emoji_stream": _sql(_FAMOUS, "once", "authors"),
    "famous_emoji_sink": _sql(_FAMOUS, "once", "authors"),
    "tag_by_rules_stream": _sql(
        """SELECT tweet_id, string_agg(tag, ',' ORDER BY tag) AS tags FROM (SELECT DISTINCT tweet_id, tag FROM posts
            JOIN (SELECT * FROM (VALUES {rules}) AS r (value, tag)) ON contains(text, value)) GROUP BY tweet_id""".replace(
            "{rules}", ", ".join(f"('{value}', '{tag}')" for value, tag in RULES)
        ),
        "posts",
    ),
    "variant_emoji_stream": _sql(_VARIANTS, "once"),
    "top_emoji_by_hour_stream": _sql(
        """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, emoji, n FROM (
                SELECT date_trunc('hour', time) AS window_start, emoji, count(*) AS n FROM tokens GROUP BY ALL)
            WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(time) - INTERVAL 1 HOUR FROM posts WHERE NOT starts_with(text, 'RT'))
            QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY n DESC, emoji) = 1""",
        "tokens",
    ),
    "newest_per_slot_stream": _sql(
        f"""SELECT slot, CAST(row_number() OVER (PARTITION BY slot {_LATEST}) AS INTEGER) AS position, tweet_id, time FROM (
                SELECT tweet_id, time, greatest((age + {_STEP - 1}) // {_STEP} - 2, 0) AS slot
                FROM (SELECT tweet_id, time, {_NOW} - epoch_us(time) AS age FROM posts)
                WHERE age > 10000000 AND age <= {_LAST * _STEP})
            QUALIFY position <= {PER_SLOT}""",
        "posts",
    ),
    "hourly_emoji_stream": _sql(
        """SELECT date_trunc('hour', time) AS window_start, date_trunc('hour', time) + INTERVAL 1 HOUR AS window_end,
            emoji, count(*) AS n FROM tokens
            WHERE date_trunc('hour', time) + INTERVAL 1 HOUR
                <= (SELECT max(time) - INTERVAL 1 HOUR FROM posts WHERE NOT starts_with(text, 'RT'))
            GROUP BY ALL""",
        "tokens",
    ),
    "regex_emoji": _sql(_MATCHING, "once"),
    "regex_emoji_stream": _sql(_MATCHING, "once"),
    "hourly_emoji_stream_open": _sql(
        "SELECT date_trunc('hour', time) AS window_start, emoji, count(*) AS n FROM tokens GROUP BY ALL", "tokens"
    ),
    "sql_functions": _sql(
        f"""SELECT regexp_replace(e, '{TONE_PATTERN}', '', 'g') AS base, regexp_extract(e, '({TONE_PATTERN})', 1) AS tone,
            count(*) AS n FROM (SELECT {_CUT} AS e FROM posts) GROUP BY ALL""",
        "posts",
    ),
    "long_chain_emoji": _sql(
        "SELECT tweet_id, CAST(2 * length(text) + 1 AS INTEGER) AS n_chars FROM posts", "posts"
    ),
    "words_top": _sql("SELECT word, count(*) AS usage FROM doc_words GROUP BY word", "doc_words"),
    "top_words_sketched": _sql(
        "SELECT word, count(*) AS usage FROM doc_words GROUP BY word ORDER BY usage DESC, word LIMIT 100", "doc_words"
    ),
    "words_lang_compare": _sql(_compare("lang", "es", "en", "word", "doc_words"), "doc_words"),
    "words_role_compare": _sql(_compare("role", "user", "assistant", "word", "talk_words"), "talk_words"),
    "event_type_by_hour": _best(_HOUR, "event_type", "occurrence", "(SELECT event_type, ts AS time FROM events)"),
    "event_type_by_day": _best(_DAY, "event_type", "popularity", "(SELECT event_type, ts AS time FROM events)"),
}

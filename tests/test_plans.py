"""What the physical plans must look like."""

import re

import pytest
from conftest import TABLES, plan_of
from pyspark.sql import functions as F

from pictolytics.operators import authors as A
from pictolytics.operators import tagging as G
from pictolytics.operators.tokens import select_posts
from pictolytics.plans import questions as Q
from pictolytics.plans.registry import REGISTRY
from pictolytics.streaming import live


@pytest.fixture
def stored(spark, make_posts, make_authors, tmp_path):
    """Posts and authors in parquet, as a user would keep them."""
    make_posts([{"author_id": i % 4, "lang": "es" if i % 2 else "en"} for i in range(40)]).write.parquet(f"{tmp_path}/posts")
    make_authors({i: 100 * i for i in range(4)}).write.parquet(f"{tmp_path}/authors")
    return spark.read.parquet(f"{tmp_path}/posts"), spark.read.parquet(f"{tmp_path}/authors")


def final(plan):
    return plan.split("== Initial Plan ==")[0] if "== Initial Plan ==" in plan else plan


def scans(plan):
    return len(re.findall(r"Scan parquet", final(plan)))


def test_language_and_columns_reach_the_scan(stored):
    plan = plan_of(Q.compare_languages(Q.emoji_of(stored[0]), "es", "en"))
    assert "In(lang, [en,es])" in plan
    assert "ReadSchema: struct<lang:string,text:string>" in plan
    assert "Python" not in plan
    assert scans(plan) == 1


def test_repost_filter_reaches_the_scan(stored):
    assert "Not(StringStartsWith(text,RT))" in plan_of(Q.most_used(Q.emoji_of(stored[0])))


def test_text_is_cut_once_and_within_codegen(stored):
    plan = plan_of(Q.most_used(Q.emoji_of(stored[0])))
    details = plan.split("== Initial Plan ==")[1]
    generates = re.findall(r"\(\d+\) Generate \[codegen id.*?\n\n", details, re.S)
    assert len(generates) == 1 and generates[0].count("regexp_extract_all") == 1
    assert not re.search(r"\(\d+\) (Filter|Project)[^\n]*\n[^\n]*\n[^\n]*regexp_extract_all", details)


def test_winners_share_one_shuffle_of_the_counts(stored):
    for profile in ("daily", "hourly", "dailyAndHourly"):
        plan = final(plan_of(Q.most_used_by_time(Q.emoji_of(stored[0]), profile)))
        assert scans(plan) == 1 and "ReusedExchange" in plan
        assert "BroadcastHashJoin LeftSemi" in plan and "Window" not in plan


def test_all_grains_scan_once(stored):
    assert scans(plan_of(Q.most_used_by_every_grain(Q.emoji_of(stored[0])))) == 1


def test_average_is_one_aggregation(stored):
    plan = final(plan_of(Q.average_engagement(Q.emoji_of(stored[0]), min_support=1)))
    assert scans(plan) == 1 and "Join" not in plan


def test_top_k_needs_no_full_sort(stored):
    assert "TakeOrderedAndProject" in plan_of(Q.most_used(Q.emoji_of(stored[0]), limit=3))


def test_followed_authors_count_before_a_shuffled_join(stored, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    posts, authors = stored
    plan = final(plan_of(Q.used_by_followed_authors(posts, authors, 100)))
    join, cut = plan.index("SortMergeJoin LeftSemi"), plan.index("Generate")
    assert plan[join:cut].count("HashAggregate") >= 2  # partial and final count lie below the join
    assert "GreaterThan(followers_count,100)" in plan_of(Q.used_by_followed_authors(posts, authors, 100))


def test_small_author_tables_leave_posts_in_place(stored):
    posts, authors = stored
    plan = final(plan_of(A.with_authors(posts, authors)))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and " Exchange" not in plan


def test_slots_are_pruned_before_the_shuffle(stored):
    plan = final(plan_of(Q.historical_sample(stored[0], F.lit("2024-01-02").cast("timestamp"), per_slot=3)))
    assert plan.count("WindowGroupLimit") == 2
    assert "ReadSchema: struct<tweet_id:bigint,time:timestamp>" in plan_of(
        Q.historical_sample(stored[0], F.lit("2024-01-02").cast("timestamp"), per_slot=3)
    )


def test_no_python_worker_in_any_registered_query(spark):
    for name in sorted(n for n in REGISTRY if "_stream" not in n):
        plan = plan_of(REGISTRY[name](spark, TABLES), run=False)
        for slow in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert slow not in plan, (name, slow)


def test_dealt_join_has_no_cross_join(stored):
    plan = plan_of(A.with_authors_dealt(*stored))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert select_posts(stored[0]).count() == 40


def test_rules_and_texts_are_evaluated_once(stored):
    tagged = plan_of(G.tag_by_rules(stored[0], [("aaa", "x"), ("bbb", "y")]), run=False)
    assert tagged.count("contains(text") == 2 or tagged.lower().count("contains(") == 2
    live_plan = plan_of(live.live_variants(stored[0], "🙏"), run=False)
    # The list is cut in one place; the union with posts without an id repeats the branch as a whole.
    assert "regexp_extract_all" not in "".join(x for x in live_plan.splitlines() if x.startswith("Condition"))


def test_texts_join_after_the_authors(spark, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    for name in ("posts_with_authors", "posts_with_authors_dealt"):
        plan = REGISTRY[name](spark, TABLES)._jdf.queryExecution().optimizedPlan().toString()
        joins = [x for x in plan.splitlines() if "Join Inner" in x]
        # The join with the documents stands above the one with the authors, so that no text is dealt by author.
        assert "doc_id" in joins[0] and any("user_id" in x for x in joins[1:]), (name, joins)


def test_whole_posts_from_heads(spark):
    from pictolytics.sources import derived as D

    heads = D.post_heads(spark, TABLES)
    assert "text" not in heads.columns and "lang" not in heads.columns
    more = heads.withColumns({"user_id": F.lit(-1), "doc_id": F.lit("x"), "value": F.lit(2)})  # names of the event's columns
    whole, posts = D.with_texts(more, spark, TABLES), D.posts(spark, TABLES)
    assert whole.columns == [*posts.columns, "user_id", "doc_id", "value"]
    plain = whole.select(*posts.columns)
    assert plain.exceptAll(posts).isEmpty() and posts.exceptAll(plain).isEmpty()
    assert whole.where("user_id = -1 AND doc_id = 'x' AND value = 2").count() == posts.count()

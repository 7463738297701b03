import json
from datetime import datetime

import pytest

from pictolytics.operators.authors import latest_authors, unique_posts
from pictolytics.sources import derived as D
from pictolytics.sources import pages as P
from pictolytics.sources import records as R
from pictolytics.plans.questions import emoji_of
from pictolytics.sources.schemas import AUTHOR_COLUMNS, POST_COLUMNS, infer_schema
from pictolytics.sources.token_table import read_token_table, write_token_table
from conftest import TABLES, plan_of


def post(i, author="7", **more):
    return {
        "id": str(i),
        "author_id": author,
        "created_at": f"2020-11-{i:02d}T04:04:16.000Z",
        "lang": "en",
        "text": f"post {i} 😀",
        "public_metrics": {"retweet_count": 1, "reply_count": 2, "like_count": 3, "quote_count": 4},
    } | more


def user(i, followers=10):
    metrics = {"followers_count": followers, "following_count": 1, "tweet_count": 2, "listed_count": 3}
    return {"id": str(i), "name": f"N{i}", "username": f"u{i}", "public_metrics": metrics}


def page(posts, users, token=None):
    found = {"data": posts, "includes": {"users": users}}
    return found | ({"meta": {"next_token": token, "result_count": len(posts)}} if token else {})


@pytest.fixture
def landed(tmp_path):
    def write(*objects, indent=None, name="a.json"):
        (tmp_path / name).write_text("\n".join(json.dumps(o, indent=indent) if o else "" for o in objects))
        return str(tmp_path)

    return write


def test_pages_are_flattened_by_name(spark, landed):
    path = landed(page([post(1), post(2, withheld={"copyright": True})], [user(7)], "next"))
    pages = P.read_pages(spark, path)
    posts = P.flatten_posts(pages).orderBy("tweet_id")
    assert posts.columns == POST_COLUMNS
    assert tuple(posts.first()) == ("1", "7", datetime(2020, 11, 1, 4, 4, 16), "en", 3, 4, 2, 1, "post 1 😀")
    authors = P.flatten_authors(pages)
    assert authors.columns == [*AUTHOR_COLUMNS, "page_time"]
    assert tuple(authors.first()) == ("7", "N7", "u7", 10, 1, 2, 3, datetime(2020, 11, 1, 4, 4, 16))


def test_optional_parts_may_be_missing(spark, landed):
    path = landed(page([post(1)], [user(7)]), {"meta": {"result_count": 0}}, {"data": []}, name="b.json")
    pages = P.read_pages(spark, path)
    assert P.flatten_posts(pages).count() == 1
    assert P.flatten_authors(pages).count() == 1


def test_page_lineage(spark, landed):
    path = landed(page([post(3), post(4)], [user(7)], "tok1"), page([post(5)], [user(7)], "tok2"))
    rows = P.flatten_posts(P.read_pages(spark, path), lineage=True).orderBy("tweet_id").collect()
    assert [(r.tweet_id, r.page_token, r.page_time.day) for r in rows] == [("3", "tok1", 3), ("4", "tok1", 3), ("5", "tok2", 5)]


def test_pretty_printed_pages(spark, landed):
    path = landed(page([post(1)], [user(7)]), indent=2)
    assert P.flatten_posts(P.read_pages(spark, path, multi_line=True)).count() == 1


def test_unreadable_time_is_null(spark, landed):
    path = landed(page([post(1, created_at="yesterday")], []))
    assert P.flatten_posts(P.read_pages(spark, path)).first().time is None


def test_overlapping_pages(spark, landed):
    path = landed(page([post(1), post(2)], [user(7, 10)]), page([post(2), post(3)], [user(7, 12), user(8)]))
    pages = P.read_pages(spark, path)
    assert unique_posts(P.flatten_posts(pages)).count() == 3
    assert {(r.user_id, r.followers_count) for r in latest_authors(P.flatten_authors(pages)).collect()} == {("7", 12), ("8", 10)}


def test_records_with_blank_lines(spark, landed):
    records = [{"data": post(i), "includes": {"users": [user(7, 10 + i), user(8)]}} for i in (1, 2)]
    path = landed(records[0], None, records[1], None)
    rows = R.flatten_records(R.read_records(spark, path)).orderBy("tweet_id").collect()
    assert [(r.tweet_id, r.user_id, r.followers_count) for r in rows] == [("1", "7", 11), ("2", "7", 12)]
    arrays = R.author_arrays(R.read_records(spark, path)).orderBy("tweet_id").where("tweet_id = 1").first()
    assert (arrays.name, arrays.followers_count) == (["N7", "N8"], [11, 10])


def test_record_without_author(spark, landed):
    path = landed({"data": post(1), "includes": {"users": []}}, {"data": post(2)})
    rows = R.flatten_records(R.read_records(spark, path)).collect()
    assert [r.followers_count for r in rows] == [None, None]


def test_landing_files_have_at_most_so_many_lines(spark, tmp_path):
    path = str(tmp_path / "landing")
    R.write_landing(spark.range(25).coalesce(1), path, 10)
    sizes = [len(f.read_text().splitlines()) for f in (tmp_path / "landing").glob("*.json")]
    assert sorted(sizes) == [5, 10, 10]


def test_inferred_schema_is_only_an_aid(spark, landed):
    assert "data array<struct<" in infer_schema(spark, landed(page([post(1)], [user(7)])))


def test_pages_and_records_round_trip(spark, make_posts, make_authors, tmp_path):
    posts = make_posts([{"tweet_id": i, "author_id": i % 3, "text": f"{i} 👍"} for i in range(250)])
    authors = make_authors({0: 5, 1: 6})
    pages = P.pack_pages(posts, authors)
    assert pages.count() == 3
    read = P.read_pages(spark, R.write_landing(pages, str(tmp_path / "pages")))
    back = P.flatten_posts(read).orderBy("time", "tweet_id")
    ids = [str(c) for c in posts.withColumns({c: posts[c].cast("string") for c in ("tweet_id", "author_id")}).orderBy("time", "tweet_id").collect()]
    assert [str(r) for r in back.collect()] == ids
    assert {r.user_id for r in latest_authors(P.flatten_authors(read)).collect()} == {"0", "1"}
    records = R.write_landing(P.pack_records(posts, authors), str(tmp_path / "records"))
    assert R.flatten_records(R.read_records(spark, records)).count() == 167


def test_derived_posts_cover_the_whole_tables(spark):
    posts = D.posts(spark, TABLES)
    documents = D.table(spark, TABLES, "documents")
    assert posts.columns == POST_COLUMNS
    assert posts.count() == D.table(spark, TABLES, "events").count()
    used = documents.join(posts, posts["text"].contains(documents["text"]), "left_semi")
    assert used.count() == documents.count()
    assert D.authors(spark, TABLES).columns == AUTHOR_COLUMNS


def test_token_table_reads_only_the_dates_asked_for(spark, make_posts, tmp_path):
    posts = make_posts([{"time": f"2024-01-0{d}T12:00:00Z", "text": "😀 🎉"} for d in (1, 2, 2, 3)])
    path = write_token_table(emoji_of(posts), str(tmp_path / "tokens"))
    assert read_token_table(spark, path).count() == 8
    some = read_token_table(spark, path, "2024-01-02", "2024-01-02")
    assert "text" not in some.columns and some.count() == 4
    assert "PartitionFilters: [isnotnull(token_date" in plan_of(some)


def test_broken_lines_are_returned(spark, tmp_path):
    lines = ['{"data": {"id": "1", "text": "x"}}', "", '{"data": {"id": ', "no json at all"]
    (tmp_path / "records.json").write_text("\n".join(lines))
    assert sorted(r.line for r in R.broken_lines(spark, str(tmp_path)).collect()) == sorted(lines[2:])


def test_a_rerun_replaces_the_dates_it_writes(spark, make_posts, tmp_path):
    tokens = emoji_of(make_posts([{"tweet_id": 1}, {"tweet_id": 2, "time": "2024-01-02T00:00:00Z"}]))
    path = str(tmp_path / "tokens")
    write_token_table(tokens, path)
    write_token_table(tokens.where("tweet_id = 1"), path)
    assert read_token_table(spark, path).count() == 2


def test_landed_files_are_packed_and_texts_come_late(spark, make_posts, make_authors, tmp_path):
    posts = make_posts([{"tweet_id": i, "author_id": i % 3, "text": f"{i} 👍 " + "some words " * 50} for i in range(250)])
    authors = make_authors({0: 5, 1: 6})
    texts = posts.select("tweet_id", "text")

    def late(rows):
        return rows.join(texts, "tweet_id")

    for pack, read in ((P.pack_pages, lambda p: P.flatten_posts(P.read_pages(spark, p))), (P.pack_records, lambda p: R.flatten_records(R.read_records(spark, p)))):
        plain = R.write_landing(pack(posts, authors).coalesce(1), str(tmp_path / f"plain-{pack.__name__}"))
        small = R.write_landing(pack(posts.drop("text"), authors, late=late).coalesce(1), str(tmp_path / f"small-{pack.__name__}"), compression="gzip")
        assert sorted(map(str, read(small).collect())) == sorted(map(str, read(plain).collect()))
        sizes = [sum(f.stat().st_size for f in (tmp_path / f"{n}-{pack.__name__}").glob("*.json*")) for n in ("plain", "small")]
        assert sizes[1] * 3 < sizes[0], sizes


def test_pages_are_gathered_in_portions(spark, monkeypatch, tmp_path):
    """The same pages however many portions; a written portion leaves no shuffle files behind."""
    from conftest import TABLES
    from pictolytics.plans import registry

    whole = registry.REGISTRY["pages_lineage"](spark, TABLES).collect()
    calls = []
    write = registry.R.write_landing
    monkeypatch.setattr(registry.R, "write_landing", lambda *a, **b: calls.append(1) or write(*a, **b))
    monkeypatch.setattr(registry, "PORTION_BYTES", registry.D.text_bytes(spark, TABLES) // 3 + 1)
    before = _shuffled_bytes(spark)
    parted = registry._landed_pages(spark, TABLES)
    assert len(calls) == 3 and parted.count() == 10 and len({p.page_token for p in parted.collect()}) == 10
    assert sorted(registry.REGISTRY["pages_lineage"](spark, TABLES).collect()) == sorted(whole)
    assert len(calls) == 6 and _shuffled_bytes(spark) - before < registry.D.text_bytes(spark, TABLES) / 20


def _shuffled_bytes(spark):
    """Of shuffle files that are still there."""
    import time
    from pathlib import Path

    time.sleep(1)  # they are removed in the background
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(f.stat().st_size for d in folders for f in Path(d).rglob("shuffle_*.data"))

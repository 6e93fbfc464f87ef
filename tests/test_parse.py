"""Text parsing and quarantine: hand-written lines for each parsing rule."""

import pytest

from tasteflow.sources.text import parse_movies, parse_rating_events, parse_ratings, parse_tags


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def outcome(parsed):
    ok = [tuple(r) for r in parsed.rows.collect()]
    bad = sorted((r["value"], r["reason"]) for r in parsed.rejects.collect())
    return ok, bad


MOVIE_OK = "13^Balto (1995)^^78 minutes^February 19, 2002^1995^English ^Adventure|Animation|Children ^Kevin Bacon ^Simon Wells"


def test_movie_line_parses_and_trims(spark):
    ok, bad = outcome(parse_movies(lines(spark, [MOVIE_OK])))
    assert bad == []
    assert ok == [(13, "Balto (1995)", "", "78 minutes", "February 19, 2002", "1995", "English",
                   "Adventure|Animation|Children", "Kevin Bacon", "Simon Wells")]


def test_movie_with_nine_fields_is_rejected(spark):
    line = "1^a^b^c^d^e^f^g^h"
    ok, bad = outcome(parse_movies(lines(spark, [line])))
    assert ok == [] and bad == [(line, "field_count")]


def test_movie_with_empty_last_field_is_accepted(spark):
    ok, bad = outcome(parse_movies(lines(spark, ["2^a^b^c^d^e^f^g^h^"])))
    assert bad == [] and ok[0][0] == 2 and ok[0][-1] == ""


def test_movie_id_with_blank_in_front_is_rejected(spark):
    line = " 3^a^b^c^d^e^f^g^h^i"
    ok, bad = outcome(parse_movies(lines(spark, [line])))
    assert bad == [(line, "bad_mid")]


def test_tab_and_cr_around_a_field_are_trimmed(spark):
    ok, _ = outcome(parse_movies(lines(spark, ["4^\tname\r^b^c^d^e^f^g^h^i"])))
    assert ok[0][1] == "name"


def test_rating_rules(spark):
    values = [
        "1,1339,3.5,1260759125",      # ok
        "1,31,2.5,1260759144,extra",  # extra field ignored
        "1,31,good,1260759144",       # text score
        "1,31,2.5",                   # three fields
        " 1,31,2.5,1260759144",       # blank before an id
        "1,31, 2.5 ,1260759144",      # blanks around a score are fine
        "1,31,4.0,12.5",              # decimal timestamp
        "x,31,4.0,1",                 # bad uid
        "1,y,4.0,1",                  # bad mid
    ]
    ok, bad = outcome(parse_ratings(lines(spark, values)))
    assert sorted(ok) == [(1, 31, 2.5, 1260759144), (1, 31, 2.5, 1260759144), (1, 1339, 3.5, 1260759125)]
    assert bad == sorted([
        ("1,31,good,1260759144", "bad_score"),
        ("1,31,2.5", "field_count"),
        (" 1,31,2.5,1260759144", "bad_uid"),
        ("1,31,4.0,12.5", "bad_timestamp"),
        ("x,31,4.0,1", "bad_uid"),
        ("1,y,4.0,1", "bad_mid"),
    ])


def test_tag_with_comma_is_rejected(spark):
    values = ["15,100365,documentary,1425876220", "15,7478,Cambodia, history,1170560997", "15,7478, Cambodia ,1170560997"]
    ok, bad = outcome(parse_tags(lines(spark, values)))
    assert sorted(ok) == [(15, 7478, "Cambodia", 1170560997), (15, 100365, "documentary", 1425876220)]
    assert bad == [("15,7478,Cambodia, history,1170560997", "bad_timestamp")]


def test_event_with_three_fields_is_rejected(spark):
    ok, bad = outcome(parse_rating_events(lines(spark, ["6|1033|5.0|949949638", "6|1033|5.0"])))
    assert ok == [(6, 1033, 5.0, 949949638)]
    assert bad == [("6|1033|5.0", "field_count")]


def test_require_clean_fails_on_bad_line(spark):
    with pytest.raises(ValueError):
        parse_ratings(lines(spark, ["1,2,x,3"])).require_clean()


def test_loader_one_pass_with_quarantine(spark, tmp_dir):
    import os

    from tasteflow.plans import loader
    from tasteflow.sources.tables import TableStore

    def land(name, values):
        path = os.path.join(tmp_dir, name)
        lines(spark, values).write.text(path)
        return path

    movies = land("movies", [MOVIE_OK, "1^a^b^c^d^e^f^g^h"])
    ratings = land("ratings", ["1,13,3.5,1260759125", "1,13,x,1"])
    tags = land("tags", ["15,13,documentary,1425876220"])
    store = TableStore(root=os.path.join(tmp_dir, "tables"))
    loaded = loader.load_text_inputs(spark, movies, ratings, tags, store, rating_buckets=4)
    assert [r.mid for r in loaded.movies.collect()] == [13]
    assert [tuple(r)[:4] for r in loaded.ratings.collect()] == [(1, 13, 3.5, 1260759125)]
    assert "uid_bucket" in loaded.ratings.columns
    assert sorted(tuple(r) for r in loaded.rejects.collect()) == [
        ("movie", "1^a^b^c^d^e^f^g^h", "field_count"), ("rating", "1,13,x,1", "bad_score"),
    ]
    index = store.read(spark, loader.INDEX_TABLE).collect()
    assert [(r.mid, r.tags) for r in index] == [(13, "documentary")]


def test_a_line_end_is_not_part_of_a_number(spark):
    from tasteflow.functions.text import strict_int, strict_long

    df = spark.createDataFrame([("4",), ("4\n",), ("4\r",), ("\n4",), ("-7",)], "v string")
    assert [tuple(r) for r in df.select(strict_int("v"), strict_long("v")).collect()] == [
        (4, 4), (None, None), (None, None), (None, None), (-7, -7)]

import csv
import json

import pytest

from tripleloom.operators.clean import FIELDS, clean_movies
from tripleloom.operators.lift import cast_rows, split_cast
from tripleloom.sources.tabular import read_clean_movies, read_csv, write_csv

MOVIES = [  # id, title, release_date, runtime, vote_count, vote_average, genres, companies, countries
    ("1", " First ", "1999-03-01", "121.0", "1000", "8.0", ["Drama", "War"], ["Studio A"], ["Land"]),
    ("2", "Tie later", "2000-01-01", "", "1500", "8.5", [], [], []),
    ("3", "Tie, \"quoted\"\nline", "2001-01-01", "90.5", "1500", "8.5", None, ["S"], ["L"]),
    ("4", "Too few votes", "2001-01-01", "90", "999", "9.9", [], [], []),
    ("5", "", "2001-01-01", "90", "5000", "9", [], [], []),
    ("6", "No date", "", "90", "5000", "9", [], [], []),
    ("7", "No credits", "2001-01-01", "90", "5000", "9", [], [], []),
    ("8", "No director", "2001-01-01", "90", "5000", "9", [], [], []),
]
CREDITS = [
    ("1", [dict(id=9, name="Old", order=0, character="x")], [dict(id=1, name="Old", job="Director")]),
    (
        "1",
        [
            dict(id=13, name="C", order=2, character="c|d"), dict(id=11, name=" A ", order=0, character=None),
            dict(id=12, name="B", order=1, character="  b\t b "), dict(id=14, name="D", order=2, character="late"),
        ],
        [dict(id=5, name="W", job="Writer"), dict(id=6, name=" Dee ", job="Director"), dict(id=7, name="E", job="Director")],
    ),
    ("2", [], [dict(id=6, name="Dee", job="Director")]),
    ("3", [dict(id=1, name="N", order=3)], [dict(id=8, name="Gee", job="Director")]),
    ("4", [], [dict(id=6, name="Dee", job="Director")]),
    ("5", [], [dict(id=6, name="Dee", job="Director")]),
    ("6", [], [dict(id=6, name="Dee", job="Director")]),
    ("8", [], [dict(id=6, name="Dee", job="Producer")]),
]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")

    def named(items):
        return "" if items is None else json.dumps([{"name": i} for i in items])

    with open(folder / "movies.csv", "w", encoding="utf-8", newline="") as f:
        out = csv.writer(f)
        out.writerow(["id", "title", "release_date", "runtime", "vote_count", "vote_average", "genres",
                      "production_companies", "production_countries"])
        out.writerows([*m[:6], *map(named, m[6:])] for m in MOVIES)
    with open(folder / "credits.csv", "w", encoding="utf-8", newline="") as f:
        out = csv.writer(f)
        out.writerow(["movie_id", "title", "cast", "crew"])
        out.writerows((i, "t", json.dumps(c), json.dumps(w)) for i, c, w in CREDITS)
    return [read_csv(spark, str(folder / n), ordinal=True) for n in ("movies.csv", "credits.csv")]


def test_rules_and_order(raw):
    rows = [r.asDict() for r in clean_movies(*raw).collect()]
    assert [r["id"] for r in rows] == ["2", "3", "1"]
    assert list(rows[0]) == FIELDS
    assert rows[2] == dict(
        id="1", title="First", year="1999", release_date="1999-03-01", runtime="121", director_id="6",
        director_name="Dee", genre="Drama", genres="Drama|War", cast_ids="11|12|13", cast_names="A|B|C",
        cast_characters="|b b|c/d", studio="Studio A", country="Land",
    )
    assert rows[1]["title"] == 'Tie, "quoted"\nline' and rows[1]["genre"] == "" and rows[1]["runtime"] == "90"
    assert rows[0]["runtime"] == "" and rows[0]["cast_ids"] == ""


def test_cut_comes_after_the_drops(raw):
    assert [r["id"] for r in clean_movies(*raw, limit=2).collect()] == ["2", "3"]


def test_written_table_reads_back(spark, raw, tmp_path):
    cleaned = clean_movies(*raw)
    write_csv(cleaned, str(tmp_path / "clean"), FIELDS)
    back = read_clean_movies(spark, str(tmp_path / "clean"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, cleaned.collect()))
    cast = cast_rows(split_cast(back)).where("movie_id = '1'").orderBy("billing_order").collect()
    assert [(r["billing_order"], r["actor_id"], r["character"]) for r in cast] == [(1, "11", ""), (2, "12", "b b"), (3, "13", "c/d")]


def test_compressed_files_read_like_others(spark, tmp_path):
    rows = [("1", 'a "quoted", cell', ""), ("2", "x" * 100, "é"), ("3", "y" * 100, "z")]
    frame = spark.createDataFrame(rows * 200, "id string, title string, genre string").repartition(3)
    for name, compression in (("plain", None), ("packed", "gzip")):
        write_csv(frame, str(tmp_path / name), compression=compression)
    plain, packed = (sum(f.stat().st_size for f in (tmp_path / n).glob("part-*")) for n in ("plain", "packed"))
    back = read_csv(spark, str(tmp_path / "packed"), ordinal=True, line_breaks=False)
    assert sorted(tuple(r)[:3] for r in back.collect()) == sorted(rows * 200) and packed < plain / 4
    assert back.select("ordinal").distinct().count() == 600

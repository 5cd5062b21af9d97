import hashlib

from pyspark.sql import functions as F

from notelake.functions.links import link_key
from notelake.operators import curate

G = "https://github.com"


def test_file_links(spark):
    cases = {
        f"{G}/o/r/blob/main/d/a.ipynb?x=1#L2": ("o", "r", "main", "d/a.ipynb"),
        "http://github.com/o/r/blob/v1/a#b?c": ("o", "r", "v1", "a"),
        f"{G}/o/r/tree/main/a": (None,) * 4,
        f"x{G}/o/r/blob/main/a": (None,) * 4,
        f"{G}/o/r/blob/main/": (None,) * 4,
    }
    df = spark.createDataFrame([(u,) for u in cases], "file_url string")
    for r in curate.parse_blob_url(df).collect():
        assert tuple(r[1:]) == cases[r.file_url]


def test_repository_links(spark):
    cases = {
        f"{G}/o/r.git/": ("o", "r", "o/r"), f" {G}/o/r\n": ("o", "r", "o/r"),
        f"{G}/o/r.x": ("o", "r.x", "o/r.x"), f"{G}/o/r/issues": (None,) * 3,
        f"{G}/o": (None,) * 3,
    }
    df = spark.createDataFrame([(u,) for u in cases], "repo_url string")
    for r in curate.parse_repo_url(df).collect():
        assert tuple(r[1:]) == cases[r.repo_url]


def test_link_key(spark):
    url = f"{G}/o/r/blob/main/a.ipynb"
    key = spark.createDataFrame([(url,)], "u string").select(link_key(F.col("u"))).first()[0]
    assert key == hashlib.sha1(url.encode()).hexdigest()
    assert key == "c224349413debb6df541bf292d032d6cf36df7df"


def raw_hit(seq, fragments, keyword="head"):
    return (seq, "asc", ("o/r", f"{G}/o/r"), f"u{seq}", [(f,) for f in fragments], "q", keyword, "t")


RAW = ("seq long, sort_order string, repository struct<full_name:string,html_url:string>, "
       "html_url string, text_matches array<struct<fragment:string>>, search_query string, "
       "keyword string, found_at string")


def test_matching_hits(spark):
    rows = [raw_hit(0, ["x.head(1)"]), raw_hit(1, ["x.head (1)", "y"]), raw_hit(2, []),
            raw_hit(3, [None, "a.head()"]), raw_hit(4, ["x.a.b("], "a.b"), raw_hit(5, ["xxaxb("], "a.b")]
    found = curate.match_hits(spark.createDataFrame(rows, RAW))
    assert sorted(r.seq for r in found.collect()) == [0, 3, 4]


HIT = "seq long, repo_name string, repo_url string, file_url string, keyword string"


def hits(spark, *rows):
    return spark.createDataFrame(list(rows), HIT)


def test_last_result_wins(spark):
    asc = hits(spark, (0, "a", "u", "x", "asc0"), (1, "a", "u", "y", "asc1"), (2, "a", "u", "", "k"))
    desc = hits(spark, (0, "a", "u", "x", "d0"), (1, "a", "u", "x", "d1"), (2, "a", "u", None, "k"))
    assert {r.file_url: r.keyword for r in curate.dedupe_hits(asc, desc).collect()} == {
        "x": "d1", "y": "asc1"}


def test_insert_or_ignore(spark):
    stored = hits(spark, (0, "a", "u", "x", "old")).drop("seq").withColumn("id", F.lit(7))
    new = hits(spark, (1, "a", "u", "x", "new"), (3, "a", "u", "y", "second"),
               (2, "a", "u", "y", "first"), (4, "a", None, "z", "k"), (5, "a", "u", "w", None),
               (6, "a", "u", None, "k"))
    both, inserted = curate.insert_or_ignore(stored, new)
    assert {r.file_url: r.keyword for r in both.collect()} == {"x": "old", "y": "first", "w": None}
    assert inserted.count() == 2
    ids = curate.assign_ids(stored, inserted).collect()
    assert {r.file_url: r.id for r in ids} == {"y": 8, "w": 9}
    assert curate.insert_or_ignore(both, new)[1].count() == 0


def test_statistics(spark):
    df = hits(spark, (0, "a", "u", "x", None), (1, "b", "u", "y", "k"), (2, "b", "u", "z", "k"))
    assert tuple(curate.hit_stats(df).first()) == (3, 2, 1)


def test_search_strings(spark):
    vocab = spark.createDataFrame([(" head ",), ("",), (None,), ("sum",)], "function string")
    rows = curate.expand_queries(vocab.coalesce(1)).orderBy("line", "slot").collect()
    assert [r.keyword for r in rows] == ["head"] * 4 + ["sum"] * 4
    assert rows[0].query == '".head(" extension:ipynb'
    assert rows[3].query == '".head(" "import pandas" ".read_" extension:ipynb'


def test_link_map(spark):
    url = f"{G}/o/r/blob/main/a.ipynb"
    nb = spark.createDataFrame([(0, "o/r", url), (1, "other", url), (2, None, "x")],
                               "seq long, repo_name string, file_url string")
    rows = {r.file_link: tuple(r) for r in curate.link_map(nb).collect()}
    sha = lambda s: hashlib.sha1(s.encode()).hexdigest()
    assert rows == {url: ("o/r", f"{G}/o/r", url, sha(url)), "x": ("", "", "x", sha("x"))}
    assert curate.link_map(nb, curate.link_map(nb)).count() == 0


def test_unique_repositories(spark):
    links = spark.createDataFrame(
        [(0, f"{G}/o/r.git"), (1, f"{G}/o/r"), (2, "x"), (3, f"{G}/p/r/")],
        "seq long, repo_url string")
    assert sorted(map(tuple, curate.unique_repos(links).collect())) == [
        ("o", "r", "o/r"), ("p", "r", "p/r")]


def test_csv_files_of_chosen_trees(spark):
    tree = [("blob", "a.CSV"), ("tree", "x.csv"), ("blob", "b.txt"), ("blob", "d/é.csv")]
    rows = [("one", "main", 1, tree), ("one", "dev", 0, None),
            ("empty", "main", 1, []), ("empty", "master", 2, tree), ("none", "main", 1, None)]
    responses = spark.createDataFrame(
        rows, "repo_name string, ref string, priority int, "
              "tree array<struct<type:string,path:string>>")
    chosen = curate.choose_tree(responses)
    counts = {r.repo_name: (r.repo_url, r.csv_count) for r in curate.csv_counts(chosen).collect()}
    assert counts == {"one": (f"{G}/one", 2), "empty": (f"{G}/empty", 0), "none": (f"{G}/none", 0)}
    assert sorted(r.file_url for r in curate.csv_files(chosen).collect()) == [
        f"{G}/one/blob/main/a.CSV", f"{G}/one/blob/main/d/é.csv"]


def test_derived_links(spark):
    df = spark.createDataFrame([("o", "r", "main", "d/a.ipynb"), (None, "r", None, None)],
                               "owner string, repo string, ref string, path string")
    rows = curate.build_links(df).collect()
    assert tuple(rows[0][4:]) == (
        "https://api.github.com/repos/o/r/contents/d/a.ipynb?ref=main", f"{G}/o/r",
        f"{G}/o/r/blob/main/d/a.ipynb")
    assert rows[1].repo_link == ""

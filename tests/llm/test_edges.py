"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import public_tokenizers
from notelake.llm import (
    byte_bpe, chats, decontaminate, html_text, katz, near_dup, quality, sharding, token_counts,
    toxicity,
)

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")

LONG = "some words that go on and on " * 4000
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog", "en"), (2, None, "en"), (3, "", None),
    (None, "a text without an id of its own, but with words", None), (5, LONG, "en"),
    (6, " \n\t ", "xx"), (7, "you are a moron", "en"), (7, "you are a moron", "en"),
    (8, "né café — naïve 北京 \U0001f600 <|endoftext|> \0 x", "fr"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with columns whose names the operators use for themselves."""
    frame = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string")
    for name in ("n_tokens", "score", "kept", "digest", "slot", "shard", "group", "key", "w", "n"):
        frame = frame.withColumn(name, F.lit("mine"))
    return frame


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 0, 1), (7, 1, 1), (7, None, 0), (None, 1, 0)], "doc_id bigint, toxic int, quality int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, "quick brown fox jumps over"), (2, None), (3, ""), (3, "quick  BROWN fox jumps over")],
        "item_id bigint, text string")


OPERATORS = {
    "token_counts": lambda d, l, i: token_counts.count_tokens(d, WORD),
    "byte_bpe": lambda d, l, i: byte_bpe.digest_texts(d, BYTE),
    "encoded": lambda d, l, i: byte_bpe.encode_texts(d, BYTE),
    "near_dup": lambda d, l, i: near_dup.near_duplicates(d),
    "quality": lambda d, l, i: quality.assess(d, PIECE),
    "toxicity": lambda d, l, i: toxicity.score(d, toxicity.fit(d, l)),
    "katz": lambda d, l, i: katz.score(d),
    "sharding": lambda d, l, i: sharding.place(d, ["a", "b", "c"]),
    "decontaminate": lambda d, l, i: decontaminate.find_items(d, i),
    "kept_good": lambda d, l, i: quality.keep_good(d, PIECE),
    "kept_clean": lambda d, l, i: toxicity.keep_clean(d, toxicity.fit(d, l)),
    "kept_one": lambda d, l, i: near_dup.keep_one(d),
    "kept_uncontaminated": lambda d, l, i: decontaminate.keep_clean(d, i),
}
ONE_EACH = ("token_counts", "byte_bpe", "encoded", "near_dup", "quality", "toxicity", "katz",
            "sharding")


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(name, docs, labels, items):
    found = OPERATORS[name](docs.limit(0), labels.limit(0), items.limit(0))
    assert found.collect() == []
    if name.startswith("kept"):
        assert found.dtypes == docs.dtypes


@pytest.mark.parametrize("name", ONE_EACH)
def test_a_row_for_every_row(name, docs, labels, items):
    found = OPERATORS[name](docs, labels, items)
    ids = sorted(str(r["doc_id"]) for r in found.collect())
    assert ids == sorted(str(r[0]) for r in ROWS)


def test_operators_without_other_tables(docs, labels, items):
    assert toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).agg(
        F.max("score")).first()[0] < 0.5
    assert decontaminate.keep_clean(docs, items.limit(0)).count() == len(ROWS)


def test_values_of_the_edge_cases(docs, labels, items):
    counts = {r["doc_id"]: r for r in token_counts.count_tokens(docs, WORD).collect()}
    assert (counts[2].n_bytes, counts[2].n_tokens, counts[2].over_limit) == (0, 0, False)
    assert counts[5].over_limit and counts[6].n_tokens == 0
    copies = {r["doc_id"]: r for r in near_dup.near_duplicates(docs).collect()}
    assert [(copies[i].n_shingles, copies[i].component_id, copies[i].kept) for i in (2, 3, 6)] == [
        (0, 2, True), (0, 3, True), (0, 6, True)]
    assert copies[7].n_shingles == 1 and copies[None].component_id is None and copies[None].kept
    rules = {r["doc_id"]: r for r in quality.assess(docs, PIECE).collect()}
    assert rules[2].base_failed and not rules[2].kept and rules[2].entropy == 0
    assert not rules[1].kept and rules[1].n_words == 9
    assert rules[5].n_repeat_words == rules[5].n_words == 28000
    scored = {r["doc_id"]: r for r in katz.score(docs).collect()}
    assert scored[2].n_tokens == scored[3].n_tokens == 1 and scored[None].held_out
    found = decontaminate.find_items(docs, items).orderBy("item_id").collect()
    assert [(r.doc_id, r.item_id, r.distance, r.start, r.end) for r in found] == [
        (1, 1, 0, 4, 30), (1, 3, 0, 4, 30)]
    assert near_dup.keep_one(docs).where("doc_id = 7").count() == 1
    assert near_dup.keep_one(docs).count() == len(ROWS) - 1
    assert [r["doc_id"] for r in quality.keep_good(docs, PIECE).collect()].count(2) == 0


def test_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (2, None, ""), (None, "v", "<p>a &amp; b"),
            (4, "w", "<div>" * 3000 + "deep" + "</div>" * 10),
            (5, "x", "plain  text\n only"), (6, "y", "</p></p><nav>menu")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn(
        "text", F.lit("mine"))
    found = {(r.page_id, r.url): (r.text, r.n_chars)
             for r in html_text.extract_pages(pages).collect()}
    assert found == {(1, "u"): ("", 0), (2, None): ("", 0), (None, "v"): ("a & b", 5),
                     (4, "w"): ("deep", 4), (5, "x"): ("plain text only", 15), (6, "y"): ("", 0)}
    assert html_text.extract_pages(pages).count() == len(rows)
    assert html_text.extract_pages(pages.limit(0)).collect() == []


def test_chats(spark):
    a, b, c = ("user", "hi"), ("assistant", "hello"), ("user", None)
    rows = [(1, 0, *a), (2, 0, *a), (2, 1, *b), (3, 0, *a), (3, 1, *b), (3, 2, *c),
            (4, 0, *a), (4, 1, *b), (4, 2, *c), (4, 2, *c), (5, 0, "user", "other"),
            (None, None, None, None), (6, 0, "user", ""), (7, 0, *a), (7, 1, *b), (7, 2, "user", "")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    turns = turns.withColumn("position", F.lit(1)).withColumn("x", F.lit(1))
    found = {}
    for r in chats.format_chats(turns).orderBy("conv_id", "position").collect():
        found.setdefault((r.conv_id, r.n_turns, r.copies), []).append(r.rendered)
    assert {k: "".join(v) for k, v in found.items()} == {
        (3, 3, 2): "<|user|>\nhi\n<|end|>\n<|assistant|>\nhello\n<|end|>\n<|user|>\n\n<|end|>\n",
        (5, 1, 1): "<|user|>\nother\n<|end|>\n", (None, 1, 1): "<|unknown|>\n\n<|end|>\n",
        (6, 1, 1): "<|user|>\n\n<|end|>\n",
        (7, 3, 1): "<|user|>\nhi\n<|end|>\n<|assistant|>\nhello\n<|end|>\n<|user|>\n\n<|end|>\n"}
    assert chats.format_chats(turns.limit(0)).collect() == []


def test_long_conversation_in_blocks(spark):
    whole = spark.range(3000).selectExpr(
        "1L as conv_id", "id as turn", "'user' as role", "cast(id % 7 as string) as text")
    part = whole.where("turn < 1000").withColumn("conv_id", F.lit(2))
    other = whole.where("turn < 1000").withColumn("conv_id", F.lit(0)).withColumn(
        "text", F.when(F.col("turn") == 10, "y").otherwise(F.col("text")))
    found = chats.format_chats(whole.unionByName(part).unionByName(other))
    summary = found.groupBy("conv_id").agg(
        F.count(F.lit(1)), F.max("position"), F.countDistinct("position")).orderBy("conv_id")
    assert [tuple(r) for r in summary.collect()] == [(0, 1000, 1000, 1000), (1, 3000, 3000, 3000)]


def test_shards_are_read_as_they_were_written(spark, docs, tmp_path):
    names = ["01", "2", "x"]
    for name, rows in (("some", docs), ("none", docs.limit(0))):
        path = str(tmp_path / name)
        sharding.write_shards(rows, path, names)
        found = sharding.read_shards(docs, path)
        wanted = sharding.place(rows, names).select(found.columns)
        assert dict(found.dtypes)["shard"] == "string" and found.dtypes == wanted.dtypes
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_kept_is_the_key_of_the_component(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (1, " ".join([*words, "x"])), (2, " ".join([*words, "y"]))]
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found.collect()) == [
        (1, 1, True), (1, 1, True), (2, 1, False)]
    one = near_dup.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert [r.doc_id for r in one.collect()] == [1]
